"""Report sheets as tables of text: finding header lines, checking samples, and keeping what failed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.project import q


def cells(df: DataFrame, line: str) -> Column:
    """A line's cells without white space around them and no-break spaces."""
    return F.transform(q(line), lambda c: F.trim(F.replace(F.coalesce(c, F.lit("")), F.lit("\xa0"), F.lit(" "))))


def headers(df: DataFrame, required: Mapping[str, Sequence[str]], keys: Sequence[str] = ("report", "sheet"), number: str = "n", line: str = "cells", within: int = 20) -> DataFrame:
    """keys, header_line, names, error of each sheet.

    The header is the first of the leading lines with over four different filled cells; it must hold one name of each
    required kind. df: a row for each line with its number and its array of cells.
    """
    tidy = df.where(q(number) <= within).withColumn("__c", cells(df, line))
    filled = F.filter("__c", lambda c: c != "")
    wide = tidy.where((F.size(filled) >= 2) & (F.size(F.array_distinct(filled)) > 4))
    first = wide.groupBy(*map(q, keys)).agg(F.min_by(F.struct(q(number).alias("header_line"), F.col("__c").alias("names")), q(number)).alias("h"))
    sheets = df.select(*map(q, keys)).distinct()
    out = sheets.join(first, list(keys), "left")
    error = F.when(F.col("h").isNull(), "no header line")
    for kind, names in required.items():
        error = F.coalesce(error, F.when(~F.arrays_overlap(F.col("h.names"), F.array(*map(F.lit, names))), f"no {kind} column"))
    return out.select(*map(q, keys), "h.header_line", "h.names", error.alias("error"))


def records(df: DataFrame, found: DataFrame, fields: Mapping[str, Sequence[str]], keys: Sequence[str] = ("report", "sheet"), number: str = "n", line: str = "cells") -> DataFrame:
    """Lines after each good sheet's header as rows: a field is the first of its names that the header has."""
    good = found.where(F.col("error").isNull()).drop("error")
    rows = df.join(good, list(keys)).where(q(number) > F.col("header_line")).withColumn("__c", cells(df, line))

    def cell(names: Sequence[str]) -> Column:
        place = F.coalesce(*[F.nullif(F.array_position("names", n), F.lit(0)) for n in names])
        return F.nullif(F.get("__c", (place - 1).cast("int")), F.lit(""))

    return rows.select(*map(q, keys), number, *[cell([f, *names]).alias(f) for f, names in fields.items()])


def load_results(found: DataFrame, rows: DataFrame, keys: Sequence[str] = ("report", "sheet")) -> DataFrame:
    """A row for each report: sheets read, rows, and the errors of the others."""
    counts = rows.groupBy(*map(q, keys)).agg(F.count(F.lit(1)).alias("n"))
    joined = found.join(counts, list(keys), "left")
    errors = F.array_join(F.array_sort(F.collect_set("error")), "\n")
    return joined.groupBy(q(keys[0])).agg(F.count(F.when(F.col("error").isNull(), 1)).alias("sheets"), F.sum(F.coalesce("n", F.lit(0))).alias("rows"), F.nullif(errors, F.lit("")).alias("load_error"))
