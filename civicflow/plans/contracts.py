"""Contracts and tenders: latest reports, united spending, awardees, timelines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dates import min_max_year, period_date
from ..operators.project import q
from ..operators.setops import concatenate


def latest_contracts(reports: DataFrame, keys: Sequence[str] = ("order_id", "budget_code", "publisher_key")) -> DataFrame:
    """A row a contract with each column's last reported value, and payments: period and amount executed by then."""
    period = F.concat_ws("-", F.col("report_year").cast("string"), F.col("report_period").cast("string"))
    rows = reports.withColumn("timestamp", period)
    order = F.struct("report_year", "report_period", "report_url")
    rest = [c for c in rows.columns if c not in keys]
    last = [F.max_by(q(c), F.when(q(c).isNotNull(), order)).alias(c) for c in rest]
    by_period = rows.groupBy(*keys, "timestamp").agg(F.max_by("executed", order).alias("executed"))
    paid = by_period.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("timestamp", "executed"))).alias("payments"))
    out = rows.groupBy(*keys).agg(*last).join(paid, list(keys))
    a, b = min_max_year(F.col("start_date"), F.col("end_date"), F.col("order_date"))
    return out.withColumn("min_year", a).withColumn("max_year", b)


def united_spending(contracts: DataFrame, supports: DataFrame, contract_fields: Mapping[str, Sequence[str]], support_fields: Mapping[str, Sequence[str]]) -> DataFrame:
    names = list(dict.fromkeys([*contract_fields, *support_fields, "spending_type"]))
    a = concatenate([contracts.withColumn("spending_type", F.lit("contract"))], {n: contract_fields.get(n) for n in names})
    b = concatenate([supports.withColumn("spending_type", F.lit("support"))], {n: support_fields.get(n) for n in names})
    return a.unionByName(b).where((F.col("amount") != 0) & F.col("amount").isNotNull())


TENDER_KEY = ("publication_id", "tender_type", "tender_id")


def contracts_of_tenders(tenders: DataFrame, contracts: DataFrame) -> DataFrame:
    """Contracts with the keys of the tenders they name, but for those ordered before the tender began."""
    named = contracts.select("*", F.explode("tender_key").alias("__key"))
    keyed = named.withColumn("__k", F.from_json("__key", "array<string>"))
    own = tenders.select(*[q(c).cast("string").alias(f"__t{i}") for i, c in enumerate(TENDER_KEY)], *map(q, TENDER_KEY), F.col("start_date").alias("__from"))
    on = F.lit(True)
    for i in range(3):
        on = on & (F.get("__k", F.lit(i)) == F.col(f"__t{i}"))
    joined = keyed.join(own, on & (F.col("__from").isNull() | F.col("order_date").isNull() | (F.col("__from") <= F.col("order_date"))))
    return joined.drop("__key", "__k", "__from", "__t0", "__t1", "__t2")


def awardees(tenders: DataFrame, contracts: DataFrame, unknown: str = "לא ידוע") -> DataFrame:
    """tenders with contract_volume, contract_executed and awardees: each supplier's sums, and at each time of the
    tender's payments what all its contracts had been paid by then."""
    own = contracts_of_tenders(tenders, contracts)
    supplier = F.coalesce(F.nullif("entity_name", F.lit("")), F.array_max("supplier_name"), F.lit(unknown))
    rows = own.withColumn("supplier", supplier)
    winner = tenders.where(F.col("entity_id").isNotNull()).select(*map(q, TENDER_KEY), "entity_id", "entity_kind", F.col("entity_name").alias("supplier"), F.lit(False).alias("contract_is_active"), "volume", F.lit(None).cast(contracts.schema["executed"].dataType).alias("executed"))
    both = rows.select(*map(q, TENDER_KEY), "entity_id", "entity_kind", "supplier", "contract_is_active", "volume", "executed").unionByName(winner)
    sums = both.groupBy(*TENDER_KEY, "supplier").agg(F.min("entity_id").alias("entity_id"), F.min("entity_kind").alias("entity_kind"), F.bool_or("contract_is_active").alias("active"), F.sum(F.coalesce("volume", F.lit(0))).alias("volume"), F.sum(F.coalesce("executed", F.lit(0))).alias("executed"), F.count(F.lit(1)).alias("count"))
    paid = rows.withColumn("contract", F.xxhash64("order_id", "budget_code", "publisher_key")).select(*map(q, TENDER_KEY), "supplier", "contract", F.explode("payments").alias("p")).select(*map(q, TENDER_KEY), "supplier", "contract", F.col("p.timestamp").alias("t"), F.col("p.executed").alias("x"))
    # What a contract adds at a time is its step from the one before; running sums of steps are the totals by then.
    w = Window.partitionBy(*TENDER_KEY, "contract").orderBy("t")
    steps = paid.withColumn("step", F.col("x") - F.coalesce(F.lag("x").over(w), F.lit(0))).groupBy(*TENDER_KEY, "supplier", "t").agg(F.sum("step").alias("step"))
    times = steps.select(*TENDER_KEY, "t").distinct()
    grid = times.join(sums.select(*TENDER_KEY, "supplier"), list(TENDER_KEY)).join(steps, [*TENDER_KEY, "supplier", "t"], "left")
    running = grid.withColumn("total", F.sum(F.coalesce("step", F.lit(0))).over(Window.partitionBy(*TENDER_KEY, "supplier").orderBy("t")))
    lists = running.groupBy(*TENDER_KEY, "supplier").agg(F.array_sort(F.collect_list(F.struct(F.col("t").alias("timestamp"), F.col("total").cast("double").alias("executed")))).alias("payments"))
    entry = F.struct((-F.col("executed")).alias("o1"), (-F.col("volume")).alias("o2"), "entity_id", F.col("supplier").alias("entity_name"), "entity_kind", "active", "volume", "executed", "count", F.coalesce("payments", F.array().cast("array<struct<timestamp:string,executed:double>>")).alias("payments"))
    found = sums.join(lists, [*TENDER_KEY, "supplier"], "left").groupBy(*TENDER_KEY).agg(F.array_sort(F.collect_list(entry)).alias("awardees"))
    totals = rows.groupBy(*TENDER_KEY).agg(F.sum("volume").alias("contract_volume"), F.sum("executed").alias("contract_executed"))
    return tenders.join(totals, list(TENDER_KEY), "left").join(found, list(TENDER_KEY), "left").fillna(0, ["contract_volume", "contract_executed"])


# What happens in a tender's life, by its type, column, title and order among events of a day.
EVENTS = [("office", "claim_date", "מועד אחרון להגשה", 2), ("exemptions", "claim_date", "תאריך אחרון להגשת השגות", 2), ("central", "claim_date", "מועד אחרון להגשה", 2), ("office", "publication_date", "תאריך פרסום המכרז", 0), ("exemptions", "start_date", "תחילת תקופת התקשרות", 0), ("central", "publication_date", "תאריך פרסום המכרז", 0), ("exemptions", "end_date", "תום תקופת ההתקשרות", 2), ("central", "end_date", "תאריך סיום תוקף מכרז", 2)]
CANCELLED, CANCELLED_TITLE, FUTURE, FUTURE_TITLE = "בוטל", "המכרז בוטל", "עתידי", "תאריך פרסום צפוי"


def timeline(tenders: DataFrame) -> DataFrame:
    """timeline: a tender's events, latest first, each with the share paid by then once anything was."""

    def event(time: Column, title: Column | str, major: bool, priority: Column | int, url: Column | None = None, percent: Column | None = None) -> Column:
        return F.struct(time.cast("string").alias("timestamp"), (priority if isinstance(priority, Column) else F.lit(priority)).alias("priority"), (title if isinstance(title, Column) else F.lit(title)).alias("title"), F.lit(major).alias("major"), (url if url is not None else F.lit(None).cast("string")).alias("url"), (percent if percent is not None else F.lit(None).cast("double")).alias("percent"))

    majors = []
    for kind, column, title, priority in EVENTS:
        soon = (F.col("decision") == FUTURE) if (kind, column) == ("central", "end_date") else F.lit(False)
        soon = F.coalesce(soon, F.lit(False))
        majors.append(F.when((F.col("tender_type") == kind) & q(column).isNotNull(), event(q(column), F.when(soon, FUTURE_TITLE).otherwise(title), True, F.when(soon, 0).otherwise(priority))))
    majors.append(F.when(F.col("decision") == CANCELLED, event(F.col("last_update_date"), CANCELLED_TITLE, True, 2)))
    files = F.transform(F.filter("documents", lambda d: d["update_time"].isNotNull() & (d["update_time"] != "")), lambda d: event(d["update_time"], F.concat(F.lit("צירוף קובץ: "), d["description"]), False, 1, d["link"]))
    all_paid = F.flatten(F.transform("awardees", lambda a: a["payments"]))
    volume = F.coalesce(F.col("contract_volume").cast("double"), F.lit(0.0))

    def paid_by(t: Column) -> Column:
        own = F.filter(all_paid, lambda p: p["timestamp"] == t)
        return F.aggregate(own, F.lit(0.0), lambda acc, p: acc + p["executed"].cast("double"))

    def payment(t: Column) -> Column:
        paid = paid_by(t)
        percent = F.when(volume > 0, 100 * paid / volume).otherwise(0.0)
        day = period_date(F.split(t, "-")[0].try_cast("int"), F.split(t, "-")[1].try_cast("int"), publication=False)
        title = F.concat(F.lit("תשלום של ₪"), F.format_number(paid, 0), F.lit(", "), F.format_string("%.0f", percent), F.lit("% מהסכום"))
        return event(day, title, True, 3, percent=percent)

    times = F.array_distinct(F.transform(all_paid, lambda p: p["timestamp"]))
    payments = F.filter(F.transform(times, payment), lambda e: e["timestamp"].isNotNull())
    none = F.array().cast("array<struct<timestamp:string,priority:int,title:string,major:boolean,url:string,percent:double>>")
    listed = F.array_sort(F.concat(F.filter(F.array(*majors), lambda e: e.isNotNull()), F.coalesce(files, none), F.coalesce(payments, none)))
    # Oldest first, each event takes the last share known before it; then turned round.
    carried = F.aggregate(listed, none, lambda acc, e: F.concat(acc, F.array(e.withField("percent", F.coalesce(e["percent"], F.get(acc, F.size(acc) - 1)["percent"])))))
    return tenders.withColumn("timeline", F.reverse(carried))
