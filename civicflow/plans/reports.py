"""Reports on organisations by field of activity and district, and the enrichments of their pages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.aggregates import counters, integer_share
from ..operators.project import q


def subset_report(df: DataFrame, keys: Sequence[str], subsets: Mapping[str, Column], measures: Mapping[str, Column]) -> DataFrame:
    """report: for each subset of a key's rows, its measures, as a map; all subsets in one pass.

    measures are aggregates' inputs: name to Column, summed; count is always there.
    """
    marked = df.withColumn("__s", F.explode(F.filter(F.array(*[F.when(test, F.lit(n)) for n, test in subsets.items()]), lambda x: x.isNotNull())))
    grouped = marked.groupBy(*map(q, keys), "__s").agg(F.count(F.lit(1)).alias("count"), *[F.sum(c).alias(n) for n, c in measures.items()])
    entry = F.struct(F.col("__s").alias("k"), F.struct("count", *measures).alias("v"))
    return grouped.groupBy(*map(q, keys)).agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("report"))


def activity_report(ngos: DataFrame, key: str, other: str) -> DataFrame:
    """For each value of key (an array column is unwound): organisations, turnover, median, and counts of the other column."""
    active = ngos.where("association_status_active")
    wide = active.withColumn(key, F.explode(q(key))) if dict(active.dtypes)[key].startswith("array") else active
    sums = wide.groupBy(q(key)).agg(F.count(F.lit(1)).alias("count"), F.sum("association_yearly_turnover").alias("turnover"), F.median("association_yearly_turnover").alias("median_turnover"))
    return sums.join(counters(wide, [key], other, "counts"), key, "left")


def sole_in(df: DataFrame, keys: Sequence[str], ident: str = "id") -> DataFrame:
    """Organisations that are the only one of their key."""
    return df.groupBy(*map(q, keys)).agg(F.count_distinct(q(ident)).alias("n"), F.min(q(ident)).alias(ident)).where("n = 1").drop("n")


def ranked(df: DataFrame, keys: Sequence[str], measure: str, most: int, name: str) -> DataFrame:
    """id and rank of the greatest in their key, ties together."""
    w = Window.partitionBy(*map(q, keys)).orderBy(q(measure).desc())
    return df.where(q(measure) > 0).withColumn(name, F.rank().over(w)).where(q(name) <= most)


def upper_median(df: DataFrame, keys: Sequence[str], measure: str, name: str) -> DataFrame:
    """The value at place n / 2 + 1 of n in order, without gathering them: ranks and counts decide."""
    w = Window.partitionBy(*map(q, keys)).orderBy(q(measure))
    rows = df.where(q(measure).isNotNull()).withColumn("__r", F.row_number().over(w)).withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(*map(q, keys))))
    return rows.where(F.col("__r") == F.floor(F.col("__n") / 2) + 1).select(*map(q, keys), q(measure).alias(name))


def approval_share(df: DataFrame, keys: Sequence[str], test: Column, name: str) -> DataFrame:
    """Whole percent of a key's rows that pass."""
    sums = df.groupBy(*map(q, keys)).agg(F.count(F.when(test, 1)).alias("a"), F.count(F.lit(1)).alias("b"))
    return sums.select(*map(q, keys), integer_share(F.col("a"), F.col("b")).alias(name))


def received_ranks(orgs: DataFrame, spending: DataFrame, kinds: Mapping[str, Column], field: str, most: int = 3) -> DataFrame:
    """For each kind of money, the organisations of a field that received most."""
    out = None
    for name, test in kinds.items():
        sums = spending.where(test).groupBy("entity_id").agg(F.sum("amount").alias("amount"))
        part = ranked(orgs.join(sums, orgs["id"] == sums["entity_id"]), [field], "amount", most, "rank").select(F.lit(name).alias("kind"), q(field), "id", "amount", "rank")
        out = part if out is None else out.unionByName(part)
    return out


def sankey(df: DataFrame, source: str, target: str, amount: str, most: int = 10, others: str = "אחרים") -> DataFrame:
    """links: struct(source, target, value) of the largest targets of a source, the rest under others."""
    sums = df.groupBy(q(source), q(target)).agg(F.sum(q(amount).cast("double")).alias("value"))
    w = Window.partitionBy(q(source)).orderBy(F.desc("value"), q(target))
    merged = sums.withColumn("t", F.when(F.row_number().over(w) <= most, q(target)).otherwise(others)).groupBy(q(source), "t").agg(F.sum("value").alias("value"))
    return merged.select(q(source).alias("source"), F.col("t").alias("target"), "value")


def line_chart(history: Column, measure: str, title: str) -> Column:
    """A line trace over a history map: struct(name, x, y)."""
    entries = F.array_sort(F.map_entries(history))
    return F.struct(F.lit(title).alias("name"), F.transform(entries, lambda e: e["key"]).alias("x"), F.transform(entries, lambda e: e["value"][measure].cast("double")).alias("y"))


def normalised_series(df: DataFrame, year: str, value: str, references: Mapping[str, DataFrame]) -> DataFrame:
    """value by each yearly reference (year, value), as columns value_<name>."""
    out = df
    for name, ref in references.items():
        r = ref.select(q("year").alias("__y"), q("value").cast("double").alias("__v"))
        out = out.join(r, q(year) == F.col("__y"), "left").withColumn(f"{value}_{name}", q(value).cast("double") / F.nullif(F.col("__v"), F.lit(0.0))).drop("__y", "__v")
    return out


def service_report(left: DataFrame, middle: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Three yearly tables side by side, each key once."""
    from ..operators.joins import full_outer

    return full_outer(full_outer(left, middle, keys), right, keys)
