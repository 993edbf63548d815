"""Entities: registries brought together, money received, fingerprints, people's events."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scores import amount_score
from ..operators.aggregates import group, merge_maps
from ..operators.joins import lookup_join
from ..operators.setops import concatenate
from ..udfs.names import fingerprint_udf


def consolidate(registries: Sequence[DataFrame]) -> DataFrame:
    """One row an id out of compact registries, earlier ones first: greatest name, first kind, all details, later ones over earlier."""
    fields = {c: None for c in ("id", "name", "name_en", "kind", "kind_he", "details", "precedence")}
    rows = concatenate([r.withColumn("precedence", F.lit(i)) for i, r in enumerate(registries)], fields)
    one = group(rows, ["id"], {"name": {"aggregate": "max"}, "name_en": {"aggregate": "max"}, "kind": {"aggregate": "first"}, "kind_he": {"aggregate": "first"}}, ["precedence", "name"])
    return one.join(merge_maps(rows, ["id"], "details", ["precedence", "name"]), "id", "left")


def fingerprints(entities: DataFrame, unique: bool = True) -> DataFrame:
    """id, name, kind, fingerprint; of entities that share one, the least id's if unique."""
    rows = entities.select("id", "name", "kind").withColumn("fingerprint", fingerprint_udf("name"))
    if not unique:
        return rows
    return rows.groupBy("fingerprint").agg(F.min(F.struct("id", "name", "kind")).alias("e")).select("e.*", "fingerprint")


def received(entities: DataFrame, sources: Mapping[str, DataFrame], ident: str = "id") -> DataFrame:
    """entities with received_amount, each source's part of it, min_year, max_year and score.

    sources: entity_id, amount, year (or min_year and max_year) tables by name. Each is summed by entity first.
    """
    parts = []
    for name, df in sources.items():
        a, b = ("min_year", "max_year") if "min_year" in df.columns else ("year", "year")
        one = df.groupBy("entity_id").agg(F.sum("amount").alias("amount"), F.min(a).alias("min_year"), F.max(b).alias("max_year"))
        parts.append(one.withColumn("source", F.lit(name)))
    rows = concatenate(parts, {c: None for c in ("entity_id", "amount", "min_year", "max_year", "source")})
    wide = rows.groupBy("entity_id").agg(F.sum("amount").alias("received_amount"), *[F.sum(F.when(F.col("source") == n, F.col("amount"))).alias(f"received_{n}") for n in sources], F.min("min_year").alias("min_year"), F.max("max_year").alias("max_year"))
    fields = {c: None for c in wide.columns if c != "entity_id"}
    joined = lookup_join(entities, wide, ["entity_id"], [ident], fields, null_safe=False)
    return joined.withColumn("score", amount_score(F.col("received_amount")))


def people_events(sources: Sequence[tuple[DataFrame, Mapping[str, Column]]]) -> DataFrame:
    """event, when, full_name, company, title, sources from tables of different shape, one mapping of Columns each."""
    names = ["event", "when", "full_name", "company", "title", "sources"]
    out = None
    for df, columns in sources:
        part = df.select(*[columns.get(n, F.lit(None)).alias(n) for n in names])
        out = part if out is None else out.unionByName(part)
    return out.where(F.col("full_name").isNotNull() & (F.trim("full_name") != ""))


def people(events: DataFrame) -> DataFrame:
    """A person a row with events in order of time, and a score of how many."""
    entry = F.struct("when", "event", "company", "title", "sources")
    return events.groupBy("full_name").agg(F.array_sort(F.collect_list(entry)).alias("details")).withColumn("score", F.size("details").cast("double"))
