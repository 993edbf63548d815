"""Grouping with named aggregates, and other aggregations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .project import q

Fields = Mapping[str, str | Mapping[str, Any] | None]


def aggregate(name: str, source: str, kind: str, order_by: Sequence[str] = ()) -> Column:
    """One named aggregate of a column. Those that depend on order need order_by, of which the last may break all ties."""
    c = q(source)
    if kind in ("first", "last", "array") and not order_by:
        raise ValueError(f"{kind} of {source} needs order_by")
    order = F.struct(*[q(o) for o in order_by]) if order_by else None
    if kind == "sum":
        out = F.sum(c)
    elif kind == "max":
        out = F.max(c)
    elif kind == "min":
        out = F.min(c)
    elif kind == "avg":
        out = F.avg(c)
    elif kind == "count":
        out = F.count(F.lit(1))
    elif kind == "any":
        out = F.min(c)  # any value of the group, the same one each time
    elif kind == "set":
        out = F.array_sort(F.collect_set(c))
    elif kind == "last":
        out = F.max_by(c, F.when(c.isNotNull(), order))
    elif kind == "first":
        out = F.min_by(c, F.when(c.isNotNull(), order))
    elif kind == "array":
        pairs = F.collect_list(F.when(c.isNotNull(), F.struct(order.alias("o"), c.alias("v"))))
        out = F.transform(F.array_sort(pairs), lambda x: x["v"])
    elif kind == "median":
        out = F.median(c)
    elif kind == "upper_median":
        values = F.array_sort(F.collect_list(c))
        out = F.get(values, F.floor(F.size(values) / 2).cast("int"))
    else:
        raise ValueError(f"no aggregate {kind}")
    return out.alias(name)


def normal_fields(fields: Fields) -> list[tuple[str, str, str]]:
    """(target, source, aggregate) of each field; a field without an aggregate takes any value of the group."""
    out = []
    for name, spec in fields.items():
        spec = {"name": spec} if isinstance(spec, str) else dict(spec or {})
        out.append((name, spec.get("name", name), spec.get("aggregate", "any")))
    return out


def group(df: DataFrame, keys: Sequence[str], fields: Fields, order_by: Sequence[str] = ()) -> DataFrame:
    """One row a key with the fields. Counters are counted by value first, so that a frequent value is one row."""
    specs = [s for s in normal_fields(fields) if s[0] not in keys]
    plain = [s for s in specs if s[2] != "counters"]
    made = [aggregate(n, s, k, order_by) for n, s, k in plain] or [F.count(F.lit(1)).alias("__n")]
    out = df.groupBy(*map(q, keys)).agg(*made)
    for name, source, _ in (s for s in specs if s[2] == "counters"):
        out = null_safe_join(out, counters(df, keys, source, name), keys)
    order = [n for n in fields if n not in keys]
    return out.select(*map(q, keys), *map(q, order))


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & q(k).eqNullSafe(q(f"__r_{k}"))
    return left.join(renamed, on, how).drop(*[f"__r_{k}" for k in keys])


def counters(df: DataFrame, keys: Sequence[str], source: str, name: str) -> DataFrame:
    """name: array of struct(value, count), frequent values first, then by value; an array column counts its items."""
    kind = dict(df.dtypes)[source]
    values = df.withColumn("__v", F.explode(q(source)) if kind.startswith("array") else q(source)).where(F.col("__v").isNotNull())
    counted = values.groupBy(*map(q, keys), "__v").agg(F.count(F.lit(1)).alias("__c"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("__c")).alias("n"), F.col("__v").alias("v"))))
    return counted.groupBy(*map(q, keys)).agg(F.transform(ordered, lambda x: F.struct(x["v"].alias("value"), (-x["n"]).alias("count"))).alias(name))


def distinct_rows(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*map(q, names)).distinct()


def keep_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the order."""
    ranked = df.withColumn("__rn", F.row_number().over(Window.partitionBy(*map(q, keys)).orderBy(*order)))
    return ranked.where(F.col("__rn") == 1).drop("__rn")


def last_values(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row a key with each other column's last value that is not null."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*map(q, keys)).agg(*[aggregate(c, c, "last", order_by) for c in rest]).select(*map(q, df.columns))


def sole_member(df: DataFrame, keys: Sequence[str], member: str, name: str | None = None) -> DataFrame:
    """Keys with exactly one different member."""
    return df.groupBy(*map(q, keys)).agg(F.count_distinct(q(member)).alias("__n"), F.min(q(member)).alias(name or member)).where("__n = 1").drop("__n")


def integer_share(part: Column, whole: Column, scale: int = 100) -> Column:
    """scale * part / whole without its fraction; null for an empty whole."""
    return F.expr("0L") + F.floor(F.abs(part * scale / F.nullif(whole, F.lit(0)))) * F.signum(part * whole).cast("long")


def weighted_mean(df: DataFrame, keys: Sequence[str], value: str, weight: str, name: str) -> DataFrame:
    return df.groupBy(*map(q, keys)).agg((F.sum(q(value) * q(weight)) / F.nullif(F.sum(q(weight)), F.lit(0))).alias(name))


def average_of_sums(df: DataFrame, keys: Sequence[str], inner: Sequence[str], value: str, name: str) -> DataFrame:
    """The mean over inner groups of their sums."""
    sums = df.groupBy(*map(q, [*keys, *inner])).agg(F.sum(q(value)).alias("__s"))
    return sums.groupBy(*map(q, keys)).agg(F.avg("__s").alias(name))


def sums_by_category(df: DataFrame, keys: Sequence[str], category: str, value: str, names: Mapping[Any, str]) -> DataFrame:
    """A column for each category with the sum of its rows, 0 without any."""
    return df.groupBy(*map(q, keys)).agg(*[F.sum(F.when(q(category).eqNullSafe(F.lit(k)), q(value)).otherwise(F.lit(0))).alias(n) for k, n in names.items()])


def rollup_levels(df: DataFrame, levels: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """Sums at each depth of the levels in one pass of grouping sets; depth tells how many of them a row has."""
    sums = [F.sum(c).alias(n) for n, c in values.items()]
    rolled = df.rollup(*map(q, levels)).agg(*sums, F.grouping_id().alias("__g"))
    depth = F.lit(len(levels)) - F.length(F.regexp_replace(F.bin("__g"), "0", ""))
    return rolled.withColumn("depth", depth.cast("int")).drop("__g")


def rollup_codes(df: DataFrame, code: str, values: Sequence[str], keys: Sequence[str] = (), widths: Sequence[int] = (2, 4)) -> DataFrame:
    """Sums for each prefix of a code: every row counts once for each of its ancestors."""
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("depth"), F.substring(q(code), 1, w).alias("code")) for i, w in enumerate(widths, 1)]))
    wide = df.select(*map(q, keys), *map(q, values), each.alias("__l"))
    return wide.groupBy(*map(q, keys), F.col("__l.depth").alias("depth"), F.col("__l.code").alias("code")).agg(*[F.sum(q(v)).alias(v) for v in values])


def specialisation(df: DataFrame, group_by: str, category: str, top: int = 3, groups: int | None = None) -> DataFrame:
    """For each group the categories whose share of it most exceeds their mean share, weighted by log10 of their count.

    The mean is over all groups, a known number of them or those of the table; equal scores share a rank.
    """
    counts = df.groupBy(q(group_by), q(category)).agg(F.count(F.lit(1)).alias("cnt"))
    share = counts.withColumn("pct", F.col("cnt") / F.sum("cnt").over(Window.partitionBy(q(group_by))))
    number = F.lit(groups) if groups else F.lit(df.select(q(group_by)).where(q(group_by).isNotNull()).distinct().count())
    mean = share.groupBy(q(category)).agg((F.sum("pct") / number).alias("mean_pct"))
    scored = share.join(mean, category).withColumn("score", (F.col("pct") - F.col("mean_pct")) * F.log10("cnt"))
    return scored.withColumn("rank", F.rank().over(Window.partitionBy(q(group_by)).orderBy(F.desc("score")))).where(F.col("rank") <= top)


def merge_maps(df: DataFrame, keys: Sequence[str], column: str, order_by: Sequence[str], name: str | None = None) -> DataFrame:
    """One map a key out of the maps of its rows; of entries with the same key the last row's stays."""
    entries = df.select(*map(q, keys), F.struct(*map(q, order_by)).alias("__o"), F.explode(q(column)).alias("__k", "__v"))
    last = entries.groupBy(*map(q, keys), "__k").agg(F.max_by("__v", "__o").alias("__v"))
    return last.groupBy(*map(q, keys)).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("__k", "__v")))).alias(name or column))


def to_map(df: DataFrame, keys: Sequence[str], name_column: str, value: Column, name: str) -> DataFrame:
    """Rows of a key as a map from a column's values."""
    return df.groupBy(*map(q, keys)).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(q(name_column).alias("k"), value.alias("v"))))).alias(name))


def collate(df: DataFrame, keys: Sequence[str], name: str, order_by: Sequence[str] | None = None) -> DataFrame:
    """Columns besides the keys as one struct; with order_by, the structs of a key as an array."""
    rest = F.struct(*[q(c) for c in df.columns if c not in keys])
    if order_by is None:
        return df.select(*map(q, keys), rest.alias(name))
    pairs = F.array_sort(F.collect_list(F.struct(F.struct(*map(q, order_by)).alias("o"), rest.alias("v"))))
    return df.groupBy(*map(q, keys)).agg(F.transform(pairs, lambda x: x["v"]).alias(name))
