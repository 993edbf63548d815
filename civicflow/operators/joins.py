"""Lookup joins: the source is brought to one row a key first, so that a join never multiplies target rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.values import template
from .aggregates import Fields, group, normal_fields
from .project import q


def keyed(df: DataFrame, key: Sequence[str] | str, prefix: str) -> tuple[DataFrame, list[str]]:
    """df with its key as columns; a text key is a template."""
    if isinstance(key, str):
        return df.withColumn(f"{prefix}0", template(key)), [f"{prefix}0"]
    for i, name in enumerate(key):
        df = df.withColumn(f"{prefix}{i}", q(name))
    return df, [f"{prefix}{i}" for i in range(len(key))]


def lookup_join(target: DataFrame, source: DataFrame, source_key: Sequence[str] | str, target_key: Sequence[str] | str, fields: Fields, full: bool = True, null_safe: bool = True, order_by: Sequence[str] = ()) -> DataFrame:
    """target with fields of the source's rows of the same key, aggregated.

    full keeps target rows without a match. With null_safe, null keys match each other. No side is broadcast by
    force: the planner does so for sides it has measured.
    """
    left, lk = keyed(target, target_key, "__t")
    right, rk = keyed(source, source_key, "__s")
    small = group(right, rk, fields, order_by)
    named = small.withColumnsRenamed({n: f"__f_{n}" for n, _, _ in normal_fields(fields)})
    on = F.lit(True)
    for a, b in zip(lk, rk):
        on = on & (F.col(a).eqNullSafe(F.col(b)) if null_safe else F.col(a) == F.col(b))
    joined = left.join(named, on, "left" if full else "inner").drop(*lk, *rk)
    new = {n: F.col(f"`__f_{n}`") for n, _, _ in normal_fields(fields)}
    old = [q(c) for c in target.columns if c not in new]
    return joined.select(*old, *[c.alias(n) for n, c in new.items()])


def absent_from(df: DataFrame, other: DataFrame | None, keys: Sequence[str], other_keys: Sequence[str] | None = None) -> DataFrame:
    """Rows whose key other does not have; all rows if there is no other table yet."""
    if other is None:
        return df
    seen = other.select(*[q(b).alias(f"__a_{a}") for a, b in zip(keys, other_keys or keys)]).distinct()
    on = F.lit(True)
    for a in keys:
        on = on & (q(a) == q(f"__a_{a}"))
    return df.join(seen, on, "left_anti")


def superseded(df: DataFrame, ident: str, fix_for: str) -> DataFrame:
    """Rows that no other row corrects."""
    return absent_from(df, df.where(q(fix_for).isNotNull()), [ident], [fix_for])


def enrich(df: DataFrame, table: DataFrame, on: Sequence[str], into: str | None = None) -> DataFrame:
    """Left join of a table of one row a key; into merges its columns into a struct column of that name."""
    rest = [c for c in table.columns if c not in on]
    joined = df.join(table.dropDuplicates(list(on)), list(on), "left")
    if into is None:
        return joined.select(*[q(c) for c in df.columns], *[q(c) for c in rest])
    return joined.withColumn(into, F.struct(*map(q, rest))).select(*map(q, df.columns), q(into))


def lookup_array(df: DataFrame, array: str, table: DataFrame, key: str, value: str, name: str, row_id: Sequence[str]) -> DataFrame:
    """name: the table's value for each item of an array that it has, in the array's order."""
    items = df.select(*map(q, row_id), F.posexplode(q(array)).alias("__p", "__c"))
    found = items.join(table.select(q(key).alias("__c"), q(value).alias("__v")).dropDuplicates(["__c"]), "__c")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("__p", "__v"))), lambda x: x["__v"])
    lists = found.groupBy(*map(q, row_id)).agg(ordered.alias(name))
    joined = df.join(lists, list(row_id), "left")
    empty = F.array().cast(lists.schema[name].dataType)
    return joined.select(*map(q, df.columns), F.coalesce(q(name), empty).alias(name))


def lookup_or(df: DataFrame, table: DataFrame, on: Sequence[str], value: str, default: Column, name: str) -> DataFrame:
    named = table.select(*map(q, on), q(value).alias("__v")).dropDuplicates(list(on))
    return df.join(named, list(on), "left").select(*map(q, df.columns), F.coalesce("__v", default).alias(name))


def lookup_once(df: DataFrame, fixes: DataFrame, on: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """df with the fixes' columns on the first row of each key only."""
    first = F.row_number().over(Window.partitionBy(*map(q, on)).orderBy(*map(q, order_by)))
    ranked = df.withColumn("__rn", first)
    rest = [c for c in fixes.columns if c not in on]
    named = fixes.dropDuplicates(list(on)).withColumn("__rn", F.lit(1))
    return ranked.join(named, [*on, "__rn"], "left").select(*map(q, df.columns), *map(q, rest))


def resolve(df: DataFrame, known: DataFrame, ident: str | None, fingerprint: str) -> DataFrame:
    """entity_id, entity_name, entity_kind by the row's id, else by its fingerprint.

    known: id, name, kind, fingerprint. Of entries that share a fingerprint the one with the least id is taken.
    """
    by_print = known.groupBy("fingerprint").agg(F.min(F.struct("id", "name", "kind")).alias("__p")).withColumnRenamed("fingerprint", "__fp")
    out = df.join(by_print, q(fingerprint) == F.col("__fp"), "left")
    match = F.col("__p")
    if ident:
        by_id = known.groupBy(F.col("id").alias("__id")).agg(F.min(F.struct("id", "name", "kind")).alias("__i"))
        out = out.join(by_id, q(ident) == F.col("__id"), "left")
        match = F.coalesce(F.col("__i"), match)
    return out.select(*map(q, df.columns), match["id"].alias("entity_id"), match["name"].alias("entity_name"), match["kind"].alias("entity_kind"))


def full_outer(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All keys of both, each once."""
    r = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & (q(k) == q(f"__r_{k}"))
    joined = left.join(r, on, "full")
    rest = [c for c in [*left.columns, *right.columns] if c not in keys]
    return joined.select(*[F.coalesce(q(k), q(f"__r_{k}")).alias(k) for k in keys], *map(q, rest))


def parents(df: DataFrame, key: str, parent: str, value: str, depth: int = 3) -> DataFrame:
    """parent1 to parentN: the value of each ancestor, by joins up the hierarchy."""
    known = df.select(q(key).alias("__k"), q(parent).alias("__p"), q(value).alias("__v")).dropDuplicates(["__k"])
    out = df.withColumn("__up", q(parent))
    for i in range(1, depth + 1):
        step = known.select(F.col("__k").alias("__up"), F.col("__p").alias("__next"), F.col("__v").alias(f"parent{i}"))
        out = out.join(step, "__up", "left").withColumn("__up", F.col("__next")).drop("__next")
    return out.drop("__up")
