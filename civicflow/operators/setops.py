"""Unions and differences."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..package import Package, Selector
from .project import q


def concatenate(tables: Sequence[DataFrame], fields: Mapping[str, Sequence[str] | None]) -> DataFrame:
    """All rows of the tables under the target fields: a field takes the first of its source names, its own included,
    that a table has, and null where it has none; other columns go."""
    out = None
    for df in tables:
        row = []
        for target, sources in fields.items():
            held = [c for c in [target, *(sources or [])] if c in df.columns]
            row.append((F.coalesce(*map(q, held)) if len(held) > 1 else q(held[0]) if held else F.lit(None)).alias(target))
        part = df.select(*row)
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no tables to concatenate")
    return out


def concatenate_resources(package: Package, sources: Selector, target: str, fields: Mapping[str, Sequence[str] | None]) -> Package:
    names = package.select(sources)
    merged = concatenate([package.resources[n] for n in names], fields)
    kept = {n: d for n, d in package.resources.items() if n not in names}
    return package.with_resources({**kept, target: merged})


def union_distinct(*tables: DataFrame) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out.distinct()


def append(df: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of another table after df's, null where they lack a column."""
    return df.unionByName(rows.select(*[c for c in rows.columns if c in df.columns]), allowMissingColumns=True)


def with_variants(df: DataFrame, variants: Sequence[Mapping[str, Column]]) -> DataFrame:
    """Each row and a copy for each variant, with the variant's columns in place, in one pass."""
    names = sorted({c for v in variants for c in v})
    rows = F.explode(F.array(F.struct(*[q(c).alias(c) for c in names]), *[F.struct(*[v.get(c, q(c)).cast(df.schema[c].dataType).alias(c) for c in names]) for v in variants]))
    wide = df.withColumn("__v", rows)
    return wide.select(*[F.col("__v")[c].alias(c) if c in names else q(c) for c in df.columns])


def difference(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(other.select(*keys).distinct(), list(keys), "left_anti")


def shared_items(a: Column, b: Column) -> Column:
    return F.array_intersect(a, b)


def any_shared(a: Column, b: Column) -> Column:
    return F.coalesce(F.arrays_overlap(a, b), F.lit(False))
