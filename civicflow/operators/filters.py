"""Row filters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .project import q


def equals(conditions: Sequence[Mapping[str, Any]]) -> Column:
    """Whether a row equals one of the mappings in all its fields; null equals null."""
    out = F.lit(False)
    for mapping in conditions:
        one = F.lit(True)
        for name, value in mapping.items():
            one = one & q(name).eqNullSafe(F.lit(value))
        out = out | one
    return out


def filter_rows(df: DataFrame, in_: Sequence[Mapping[str, Any]] = (), out: Sequence[Mapping[str, Any]] = (), where: Column | None = None, legacy_any: bool = False) -> DataFrame:
    """Rows that equal one of in_ and none of out. legacy_any drops only rows that equal all of out at once."""
    if in_:
        df = df.where(equals(in_))
    if out:
        drop = F.lit(True) if legacy_any else F.lit(False)
        for mapping in out:
            drop = drop & equals([mapping]) if legacy_any else drop | equals([mapping])
        df = df.where(~drop)
    return df if where is None else df.where(where)


def not_null(df: DataFrame, *names: str) -> DataFrame:
    for n in names:
        df = df.where(q(n).isNotNull())
    return df


def filled(df: DataFrame, *names: str) -> DataFrame:
    """Rows in which the columns are neither null, empty, nor zero."""
    from ..functions.values import truthy

    for n in names:
        df = df.where(truthy(q(n), df.schema[n].dataType))
    return df


def without_phrases(df: DataFrame, columns: Sequence[str], phrases: Sequence[str]) -> DataFrame:
    bad = F.lit(False)
    for c in columns:
        for p in phrases:
            bad = bad | F.coalesce(q(c).contains(p), F.lit(False))
    return df.where(~bad)


def any_item(df: DataFrame, array: str, field: str, *values: Any) -> DataFrame:
    """Rows whose array of structs has, for each value, an item with it."""
    for v in values:
        df = df.where(F.array_contains(F.transform(q(array), lambda x: x[field]), v))
    return df


def last_years(df: DataFrame, year: str, target: str, as_of: dt.date, amount: str | None = None, weeks: int = 26, years: int = 3) -> DataFrame:
    """target is the amount, or true, in the years since some before as_of, 0 or false in others and without a year."""
    least = (as_of - dt.timedelta(weeks=weeks)).year - years
    inside = F.coalesce(q(year) >= least, F.lit(False))
    return df.withColumn(target, inside if amount is None else F.when(inside, q(amount)).otherwise(F.lit(0)))


def stamp_seen(df: DataFrame, as_of: dt.date, column: str = "__seen_date") -> DataFrame:
    return df.withColumn(column, F.lit(as_of.isoformat()))


def seen_lately(df: DataFrame, as_of: dt.date, days: int = 2, column: str = "__seen_date") -> DataFrame:
    return df.where(q(column) > (as_of - dt.timedelta(days=days)).isoformat())


def without_reserve(df: DataFrame, code: str = "budget_code", item: str = "leading_item", title: str = "budget_title") -> DataFrame:
    """Changes of the reserve office's own codes go unless it leads them; adds code:title."""
    return df.where(~q(code).startswith("0047") | (q(item) == 47)).withColumn("code_title", F.concat_ws(":", q(code), q(title)))


def roofs(df: DataFrame, code: str = "code") -> DataFrame:
    return df.where(F.length(q(code)) == 4)


def non_empty_budgets(df: DataFrame, measures: Sequence[str], history: str | None = "history") -> DataFrame:
    """Rows in which a measure of the year, or of a year of the history map, is not zero."""
    square = lambda c: F.pow(F.coalesce(c.cast("double"), F.lit(0.0)), 2)
    total = sum((square(q(m)) for m in measures), F.lit(0.0))
    if history:
        per_year = lambda acc, s: acc + sum((square(s[m]) for m in measures), F.lit(0.0))
        total = total + F.coalesce(F.aggregate(F.map_values(q(history)), F.lit(0.0), per_year), F.lit(0.0))
    return df.where(total > 0)


def individuals(df: DataFrame, ident: str, fingerprint: str, deny: Sequence[str] = ()) -> DataFrame:
    """Rows of persons: a name that is not foreign, an id of six digits or more that is not denied and checks."""
    from ..functions.ids import israeli_id

    named = (q(fingerprint) != "") & (q(fingerprint) != "<empty>") & ~q(fingerprint).rlike("^[A-Za-z]")
    df = df.where(named & (F.length(q(ident)) >= 6) & israeli_id(q(ident)))
    return df.where(~q(ident).isin(*deny)) if deny else df


def reject_rows(df: DataFrame, sum_words: Sequence[str], names: Sequence[str], least: int = 8) -> tuple[DataFrame, DataFrame]:
    """(good rows, counts of rejects by reason): rows with a total's words, or with few filled columns."""
    filled_n = sum((F.when(q(c).isNotNull() & (q(c).cast("string") != ""), 1).otherwise(0) for c in names), F.lit(0))
    totals = F.lit(False)
    for c in names:
        for w in sum_words:
            totals = totals | F.coalesce(q(c).cast("string").contains(w), F.lit(False))
    reason = F.when(totals, "total").when(filled_n <= least, "empty")
    marked = df.withColumn("__reason", reason)
    bad = marked.where(F.col("__reason").isNotNull()).groupBy(F.col("__reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    return marked.where(F.col("__reason").isNull()).drop("__reason"), bad
