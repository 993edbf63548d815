"""Support programs: titles, ministries, recipients and use by year of each program key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scores import program_score


def _spans(rows: DataFrame, column: str, name: str) -> DataFrame:
    """Years of each value, and the value of the latest last year."""
    spans = rows.where(F.col(column).isNotNull() & (F.col(column) != "")).groupBy("program_key", column).agg(F.min("year_requested").alias("a"), F.max("year_requested").alias("b"))
    entry = F.struct(F.col("b").alias("max_year"), F.col("a").alias("min_year"), F.col(column).alias("value"))
    return spans.groupBy("program_key").agg(F.max(entry)["value"].alias(name), F.array_sort(F.collect_list(entry)).alias(f"all_{name}"))


def _use(paid: Column, approved: Column) -> Column:
    return paid / F.nullif(approved, F.lit(0.0))


def analyse_programs(df: DataFrame) -> DataFrame:
    """A row a program: latest title and ministry, totals, years, recipients and kinds with their use of what was approved.

    All parts are groupings that combine before they shuffle; a program's arrays hold its recipients, kinds or years,
    never its payments.
    """
    rows = df.where(F.col("program_key").isNotNull()).withColumn("approved", F.coalesce(F.col("amount_approved").cast("double"), F.lit(0.0))).withColumn("paid", F.coalesce(F.col("amount_paid").cast("double"), F.lit(0.0))).withColumn("kind", F.coalesce(F.nullif("entity_kind", F.lit("")), F.lit("other")))
    sums = [F.sum("approved").alias("approved"), F.sum("paid").alias("paid")]
    by_entity_year = rows.where(F.col("entity_id").isNotNull()).groupBy("program_key", "entity_id", "year_requested").agg(*sums, F.min("entity_name").alias("name"), F.min("kind").alias("kind")).withColumn("use", _use(F.col("paid"), F.col("approved")))
    by_entity = by_entity_year.groupBy("program_key", "entity_id").agg(F.min("name").alias("name"), F.min("kind").alias("kind"), F.sum("approved").alias("total_approved"), F.sum("paid").alias("total_paid"), F.avg("use").alias("average_use"))
    recipient = F.struct((-F.col("total_paid")).alias("order"), F.col("entity_id").alias("id"), "name", "kind", "total_approved", "total_paid", "average_use")
    recipients = by_entity.groupBy("program_key").agg(F.count(F.lit(1)).alias("total_entities"), F.avg("average_use").alias("average_use"), F.array_sort(F.collect_list(recipient)).alias("recipients"))
    entity_use = by_entity_year.groupBy("program_key", "year_requested").agg(F.avg("use").alias("average_use"))
    by_year = rows.where(F.col("year_requested").isNotNull()).groupBy("program_key", "year_requested").agg(*sums).join(entity_use, ["program_key", "year_requested"], "left")
    years = by_year.groupBy("program_key").agg(F.array_sort(F.collect_list(F.struct(F.col("year_requested").alias("year"), "approved", "paid", "average_use"))).alias("per_year"), F.min("year_requested").alias("min_year"), F.max("year_requested").alias("max_year"))
    kind_year = rows.groupBy("program_key", "kind", "year_requested").agg(F.count(F.lit(1)).alias("n"), *sums).withColumn("use", F.when(F.col("year_requested").isNotNull(), _use(F.col("paid"), F.col("approved"))))
    by_kind = kind_year.groupBy("program_key", "kind").agg(F.sum("n").alias("count"), F.sum("approved").alias("total_approved"), F.sum("paid").alias("total_paid"), F.avg("use").alias("average_use"))
    totals = by_kind.groupBy("program_key").agg(F.sum("count").alias("n"), F.sum("total_approved").alias("total_approved"), F.sum("total_paid").alias("total_paid"), F.count(F.lit(1)).alias("total_entity_kinds"), F.array_sort(F.collect_list(F.struct("kind", "count", "total_approved", "total_paid", "average_use"))).alias("kinds"))
    share = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0.0)), F.lit(0.0))
    totals = totals.withColumn("entity_kinds", F.transform("kinds", lambda k: F.struct(k["kind"].alias("kind"), k["count"].alias("count"), k["total_approved"].alias("total_approved"), k["total_paid"].alias("total_paid"), k["average_use"].alias("average_use"), (k["count"] / F.col("n")).alias("pct"), share(k["total_approved"], F.col("total_approved")).alias("pct_approved"), share(k["total_paid"], F.col("total_paid")).alias("pct_paid")))).drop("kinds", "n")
    request = rows.groupBy("program_key").agg(F.max_by("request_type", F.struct("year_requested", "request_type")).alias("request_type"))
    out = totals.join(years, "program_key", "left").join(recipients, "program_key", "left").join(_spans(rows, "support_title", "title"), "program_key", "left").join(_spans(rows, "supporting_ministry", "supporting_ministry"), "program_key", "left").join(request, "program_key", "left")
    span = F.col("max_year") - F.col("min_year") + 1
    text = F.when(F.col("min_year") < F.col("max_year"), F.concat_ws("-", F.col("min_year").cast("string"), F.col("max_year").cast("string"))).otherwise(F.col("min_year").cast("string"))
    return out.withColumn("year_span", span).withColumn("year_range", text).withColumn("score", program_score(F.col("total_approved"), F.col("year_span"))).fillna({"total_entities": 0})


def payments(df: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """payments: the structs of each key's rows, in order of their fields."""
    return df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("payments"))
