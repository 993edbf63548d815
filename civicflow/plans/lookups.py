"""The questions that pages ask of the database, as functions of tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.aggregates import specialisation
from ..operators.project import q
from ..operators.windows import latest


def latest_titles(budget: DataFrame, digits: int = 10) -> DataFrame:
    """code, year, title of the last year in which a full code had a revised amount."""
    live = budget.where((F.length("code") == digits) & (F.col("net_revised") > 0)).groupBy("code").agg(F.max("year").alias("year"))
    return budget.join(live, ["code", "year"]).select("code", "year", "title")


def distinct_members(df: DataFrame, array: str) -> DataFrame:
    """One row: how many different items the arrays hold."""
    return df.select(F.explode(q(array)).alias("x")).agg(F.count_distinct("x").alias("x"))


def payments(supports: DataFrame, contracts: DataFrame) -> DataFrame:
    """year, payer, amount, id of both, equal rows once, as the union of the two is distinct."""
    a = supports.select(F.col("year_paid").alias("year"), F.col("supporting_ministry").alias("payer"), F.col("amount_paid").alias("amount"), F.col("entity_id").alias("id"))
    b = contracts.select(F.col("min_year").alias("year"), F.col("publisher_name").alias("payer"), F.col("executed").alias("amount"), F.col("entity_id").alias("id"))
    return a.unionByName(b).distinct()


def recent_payments(paid: DataFrame, orgs: DataFrame, as_of: dt.date, years: float = 4.5) -> DataFrame:
    """Payments of some years before as_of to known organisations."""
    edge = as_of.year + (as_of - dt.date(as_of.year, 1, 1)).days / 365.25 - years
    return paid.where((F.col("year") > edge) & (F.col("amount") > 0)).join(orgs.select("id").distinct(), "id")


def payer_totals(paid: DataFrame) -> DataFrame:
    return paid.groupBy("payer").agg(F.sum("amount").alias("amount"))


def district_report(orgs: DataFrame, districts: int = 7) -> DataFrame:
    """district, totals and the fields of activity that stand out there."""
    wide = orgs.where("association_status_active").select(F.col("association_field_of_activity").alias("foa"), F.explode("association_activity_region_districts").alias("district"))
    top = specialisation(wide, "district", "foa", 3, districts)
    fields = top.groupBy("district").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "foa"))), lambda x: x["foa"]).alias("foas"))
    return wide.groupBy("district").agg(F.count(F.lit(1)).alias("totals")).join(fields, "district", "left")


def spending_of_year(contracts: DataFrame, year: int) -> DataFrame:
    return contracts.where(F.year("order_date") == year).agg(F.sum("volume").alias("x"))


def tender_counts(tenders: DataFrame, year: int) -> DataFrame:
    """tender_type, tenders and publishers with any date in the year."""
    inside = F.lit(False)
    for c in ("claim_date", "start_date", "last_update_date"):
        inside = inside | F.coalesce(F.year(c) == year, F.lit(False))
    return tenders.where(inside).groupBy("tender_type").agg(F.count(F.lit(1)).alias("tenders"), F.count_distinct("publisher").alias("publishers"))


def income_list(spending: DataFrame, orgs: DataFrame, field: str) -> DataFrame:
    """Organisations of each field of activity with what they received, most first by rank."""
    joined = spending.groupBy("entity_id").agg(F.sum("amount").alias("amount")).join(orgs, F.col("entity_id") == F.col("id"))
    return joined.where(F.col("amount") > 0).select(q(field), "id", "name", "amount").withColumn("rank", F.row_number().over(Window.partitionBy(q(field)).orderBy(F.desc("amount"), "id")))


def municipality_names(series: DataFrame, symbols: DataFrame, header: str) -> DataFrame:
    """symbol, names in order of first year, latest_year. symbols: symbol; series: name, year, header, value."""
    known = series.where(q("header") == header).join(symbols, q("value") == q("symbol"))
    first = known.groupBy("symbol", "name").agg(F.min("year").alias("y"), F.max("year").alias("z"))
    return first.groupBy("symbol").agg(F.transform(F.array_sort(F.collect_list(F.struct("y", "name"))), lambda x: x["name"]).alias("names"), F.max("z").alias("latest_year"))


def latest_values(series: DataFrame, names: Sequence[str]) -> DataFrame:
    """The last value under each header of the names."""
    return latest(series.where(q("name").isin(*names)), ["header"], ["year"]).select("header", "year", "value")


def comparison(series: DataFrame, header: str) -> DataFrame:
    """name and number of the header's latest year, for names whose latest year that is."""
    rows = series.where(q("header") == header)
    last = latest(rows, ["name"], ["year"]).withColumn("number", F.col("value").try_cast("double"))
    top = last.agg(F.max("year").alias("year"))
    return last.join(F.broadcast(top), "year").select("name", "year", "number")


def offices_by_function(budget: DataFrame, year: int) -> DataFrame:
    """office, function and revised amount: what each office spends on each functional class of its budget's leaves."""
    leaves = budget.where((F.col("year") == year) & (F.length("code") == 10) & ~F.col("code").startswith("0000"))
    classes = leaves.select(F.substring("code", 1, 4).alias("office"), F.from_json(F.get("func_cls_json", F.lit(0)), "array<string>").alias("f"), "net_revised")
    return classes.groupBy("office", F.get("f", F.lit(1)).alias("function")).agg(F.sum("net_revised").alias("net_revised"))


def budget_items(budget: DataFrame, codes: Sequence[str], first: int, last: int) -> DataFrame:
    """Items under any of the codes in a span of years."""
    under = F.lit(False)
    for c in codes:
        under = under | F.col("code").startswith(c)
    return budget.where(under & F.col("year").between(first, last))


def due_subscriptions(items: DataFrame, lists: DataFrame, users: DataFrame, log: DataFrame, now: dt.datetime, days: int = 5) -> DataFrame:
    """email and its items, for users whose last mail is some days old, or who had none."""
    sent = log.groupBy("email").agg(F.max("send_time").alias("last_send_time"))
    joined = items.join(lists.where("name = 'searches'").select(q("id").alias("list_id"), "user_id"), "list_id").join(users.select(q("id").alias("user_id"), "email"), "user_id").join(sent, "email", "left")
    due = joined.where(F.col("last_send_time").isNull() | (F.lit(now) > F.col("last_send_time") + F.make_dt_interval(days=F.lit(days))))
    entry = F.struct("title", "url", "properties")
    return due.groupBy("email").agg(F.array_sort(F.array_distinct(F.collect_list(entry))).alias("items"))


def simple_decision(tenders: DataFrame, table: DataFrame, keys: Sequence[str], default: Column) -> DataFrame:
    """The conversion table's word for a tender's keys, else the default."""
    named = table.select(*map(q, keys), q("simple_decision").alias("__d")).dropDuplicates(list(keys))
    on = F.lit(True)
    right = named.withColumnsRenamed({k: f"__k_{k}" for k in keys})
    for k in keys:
        on = on & q(k).eqNullSafe(q(f"__k_{k}"))
    return tenders.join(right, on, "left").select(*map(q, tenders.columns), F.coalesce("__d", default).alias("simple_decision"))


def service_totals(services: DataFrame, amounts: Mapping[str, str]) -> DataFrame:
    """office, year and totals of its services' yearly budgets (array of structs under manualBudget)."""
    wide = services.select("office", F.explode("manualBudget").alias("b"))
    return wide.groupBy("office", F.col("b.year").alias("year")).agg(F.count(F.lit(1)).alias("services"), *[F.sum(F.col(f"b.{c}")).alias(n) for n, c in amounts.items()])
