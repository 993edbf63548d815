"""Budget codes: zero-padded decimal strings of two digits a level, after two leading zeros."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pad_left(c: Column, width: int) -> Column:
    """Zeros before shorter text; longer text stays whole."""
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, "0"))


def even_length(c: Column) -> Column:
    return F.when(F.length(c) % 2 == 1, F.concat(F.lit("0"), c)).otherwise(c)


def dotted(c: Column) -> Column:
    """0020670142 as 20.67.01.42."""
    return F.regexp_replace(F.substring(c, 3, 1000), "(..)(?=.)", "$1.")


def public_code(c: Column) -> Column:
    """TOTAL for 00; null for income and functional codes; dotted else."""
    return F.when(c == "00", "TOTAL").when(c.startswith("0000") | c.startswith("C"), F.lit(None)).otherwise(dotted(c))


def prefixes(c: Column) -> Column:
    """Sorted distinct forms of each level of a code: plain, after 00, dotted."""
    body = F.substring(c, 3, 1000)
    ends = F.sequence(F.lit(2), F.greatest(F.length(body), F.lit(2)), F.lit(2))
    forms = F.flatten(F.transform(ends, lambda n: F.array(body.substr(F.lit(1), n), F.concat(F.lit("00"), body.substr(F.lit(1), n)), F.regexp_replace(body.substr(F.lit(1), n), "(..)(?=.)", "$1."))))
    return F.when(F.length(body) >= 2, F.array_sort(F.array_distinct(forms))).otherwise(F.array().cast("array<string>"))


def normalise(c: Column) -> Column:
    """A ten-digit code out of report forms (11 marks with separators, 8 or 7 digits, closing .0); null if it is none."""
    x = F.regexp_replace(F.trim(c.cast("string")), r"\.0$", "")
    bare = F.regexp_replace(x, "[-=]", "")
    plain = ~x.rlike("[-=]")
    return F.when((F.length(x) == 11) & (F.length(bare) == 8), F.concat(F.lit("00"), bare)).when((F.length(x) == 8) & plain, F.concat(F.lit("00"), x)).when((F.length(x) == 7) & plain, F.concat(F.lit("000"), x))


def levels(c: Column) -> Column:
    """The code's ancestors and itself: 4, 6, 8 and 10 digits."""
    return F.transform(F.sequence(F.lit(4), F.greatest(F.length(c), F.lit(4)), F.lit(2)), lambda n: c.substr(F.lit(1), n))


def breadcrumbs(titles: Column, years: Column) -> Column:
    """First year, then the titles on the way."""
    return F.concat_ws(" / ", F.array_min(years).cast("string"), F.array_join(titles, " / "))
