"""Social services and other activities: budgets, suppliers, tenders, beneficiaries, and what was spent on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import add_years
from ..functions.values import first_number
from ..operators.project import q

# Kinds of suppliers, kinds of tenders, and what regulations say, in the order in which they are looked for.
BUSINESS, THIRD_SECTOR, MUNICIPAL, OTHER, MIXED = "עסקי", "מגזר שלישי", "רשויות מקומיות", "אחר", "משולב"
KINDS = {"company": BUSINESS, "association": THIRD_SECTOR, "ottoman-association": THIRD_SECTOR, "cooperative": THIRD_SECTOR, "municipality": MUNICIPAL}
TENDER_KINDS = {"regular": "מכרז רגיל", "closed": "מכרז סגור", "frame": "מכרז מסגרת", "pool": "מכרז מאגר", "na": "אחר"}
REGULATIONS = [("תקנה 3(4)(ב)", "התקשרות המשך"), ("התקשרות המשך", "התקשרות המשך"), ("מכרז סגור", "מכרז סגור"), ("ספק יחיד", "ספק יחיד"), ("מימוש זכות ברירה", "מימוש אופציה"), ("מיזם משותף", "מיזם משותף"), ("הקרן הקיימת לישראל", "מיזם משותף"), ("ג'וינט ישראל", "מיזם משותף"), ("ההסתדרות הציונית", "מיזם משותף"), ("הסוכנות היהודית", "מיזם משותף"), ("רשות מקומית", "התקשרות עם רשות מקומית")]
NATIONAL, REGIONAL = "ארצי", "אזורי"


def _labelled(c: Column, names: dict[str, str], other: str) -> Column:
    out = F.lit(other)
    for k, v in names.items():
        out = F.when(c == k, v).otherwise(out)
    return out


def budgets(df: DataFrame, this_year: int, column: str = "manualBudget") -> DataFrame:
    """current_budget, budget_utilization, min and max activity years, currently_active and score, of an array of
    struct(year, approved, executed)."""
    positive = lambda c: F.when(c > 0, c)
    now = F.filter(q(column), lambda e: e["year"] == this_year)
    current = F.get(F.filter(F.transform(now, lambda e: F.coalesce(positive(e["approved"]), positive(e["executed"]))), lambda x: x.isNotNull()), F.lit(0))
    used = F.filter(now, lambda e: (e["approved"] != 0) & (e["executed"] != 0))
    years = F.transform(F.filter(q(column), lambda e: (F.coalesce(e["approved"], F.lit(0)) != 0) | (F.coalesce(e["executed"], F.lit(0)) != 0)), lambda e: e["year"])
    first = F.get(used, F.lit(0))
    out = df.withColumn("current_budget", current).withColumn("budget_utilization", first["executed"] / first["approved"] * 100)
    out = out.withColumn("min_activity_year", F.array_min(years)).withColumn("max_activity_year", F.array_max(years))
    return out.withColumn("currently_active", F.coalesce(F.col("current_budget") != 0, F.lit(False))).withColumn("score", F.coalesce(first_number(F.col("current_budget")) / 1000, F.lit(1000)))


def suppliers(df: DataFrame, this_year: int, first_year: int = 2020) -> DataFrame:
    """suppliers with their years of activity, none of which drops one; counts by kind, their mixture, size class and coverage.

    A service that is no longer active ends its suppliers' activity with its own; those that were active then count.
    df: budgets' columns and suppliers, an array of struct(entity_id, entity_name, entity_kind, year_activity_start,
    year_activity_end, geo).
    """
    ended = ~F.col("currently_active") & F.col("max_activity_year").isNotNull()
    clean = lambda c: F.regexp_replace(c, "</?em>", "")
    some = lambda c: F.nullif(c, F.lit(0))

    def one(s: Column) -> Column:
        own_end = some(s["year_activity_end"])
        end = F.when(ended, F.least(own_end, F.col("max_activity_year"))).otherwise(own_end)
        a = F.greatest(F.coalesce(some(s["year_activity_start"]), F.lit(first_year)), F.col("min_activity_year"))
        b = F.least(F.coalesce(end, F.lit(this_year)), F.col("max_activity_year"))
        years = F.when(a <= b, F.sequence(a.cast("int"), b.cast("int"))).otherwise(F.array().cast("array<int>"))
        return F.struct(clean(s["entity_id"]).alias("entity_id"), clean(s["entity_name"]).alias("entity_name"), s["entity_kind"].alias("entity_kind"), _labelled(s["entity_kind"], KINDS, OTHER).alias("sector"), end.alias("year_activity_end"), years.alias("activity_years"), F.coalesce(s["geo"], F.array().cast("array<string>")).alias("geo"), own_end.isNull().alias("counted"))

    fixed = F.filter(F.transform(F.coalesce("suppliers", F.array()), one), lambda s: F.size(s["activity_years"]) > 0)
    out = df.withColumn("__n", F.size(F.coalesce("suppliers", F.array()))).withColumn("suppliers", fixed)
    counted = F.filter("suppliers", lambda s: s["counted"])
    ids = lambda test=None: F.size(F.array_distinct(F.transform(counted if test is None else F.filter(counted, test), lambda s: s["entity_id"])))
    sectors = F.array_distinct(F.transform(counted, lambda s: s["sector"]))
    out = out.withColumn("supplier_count", ids()).withColumn("supplier_count_company", ids(lambda s: s["sector"] == BUSINESS)).withColumn("supplier_count_association", ids(lambda s: s["sector"] == THIRD_SECTOR)).withColumn("supplier_count_municipality", ids(lambda s: s["sector"] == MUNICIPAL))
    out = out.withColumn("supplier_kinds", F.when(F.size(sectors) == 1, F.get(sectors, F.lit(0))).when(F.size(sectors) > 1, MIXED))
    out = out.withColumn("supplier_count_category", F.when(F.col("__n") == 1, "1").when(F.col("__n").between(2, 5), "2-5").when(F.col("__n") >= 6, "6+"))
    return out.withColumn("geo_coverage", F.when(F.array_contains(F.flatten(F.transform(counted, lambda s: s["geo"])), NATIONAL), NATIONAL).otherwise(REGIONAL)).drop("__n")


def tenders(df: DataFrame, as_of: Column) -> DataFrame:
    """A tender a row with sub_kind_he, end_date out of its date range, end_date_extended by its options, and active.

    df: sub_kind, regulation, tender_type, date_range, end_date (text, ISO), option_duration, active.
    """
    by_rule = F.lit(None).cast("string")
    for phrase, kind in reversed(REGULATIONS):
        by_rule = F.when(F.col("regulation").contains(phrase), kind).otherwise(by_rule)
    kind = F.when(F.col("sub_kind").isNotNull() & (F.col("sub_kind") != ""), _labelled(F.col("sub_kind"), TENDER_KINDS, OTHER)).otherwise(F.coalesce(by_rule, F.lit(OTHER)))
    given = F.nullif("end_date", F.lit(""))
    extended = F.date_format(add_years(F.to_date(given), F.col("option_duration").try_cast("int")), "yyyy-MM-dd")
    end = F.coalesce(given, F.when(F.length("date_range") > 22, F.right("date_range", F.lit(10))))
    active = F.coalesce("active", F.when((F.col("tender_type") == "exemptions") & end.isNotNull(), F.when(end > F.date_format(as_of, "yyyy-MM-dd"), "yes").otherwise("no")))
    return df.withColumns({"sub_kind_he": kind, "end_date_extended": extended, "active": active, "end_date": end})


def beneficiaries(df: DataFrame, this_year: int) -> DataFrame:
    """current_beneficiaries: the first count of a year up to now."""
    known = F.filter("beneficiaries", lambda b: (b["num_beneficiaries"] > 0) & (b["year"] <= this_year))
    return df.withColumn("current_beneficiaries", F.get(known, F.lit(0))["num_beneficiaries"])


def mapped_budget(mappings: DataFrame, raw: DataFrame, measures: Sequence[str] = ("net_allocated", "net_revised", "net_executed")) -> DataFrame:
    """A row a service and year: each mapped budget item's amounts times its part in percent.

    mappings: doc_id, code, year, part. An item counts in all years in which its code has the title it has in the
    mapping's year and a revised amount.
    """
    titled = mappings.join(raw.select("code", "year", "title"), ["code", "year"]).select("doc_id", "code", "title", "part")
    items = titled.join(raw.where("net_revised > 0"), ["code", "title"])
    return items.groupBy("doc_id", "year").agg(*[F.sum(F.floor(F.coalesce(q(m), F.lit(0))).cast("long") * F.col("part") / 100).alias(m) for m in measures])


def spending_of(mappings: DataFrame, contracts: DataFrame) -> DataFrame:
    """Contracts of the budget codes of each service."""
    return mappings.select("doc_id", F.col("code").alias("budget_code")).distinct().join(contracts, "budget_code")


def spending_suppliers(spending: DataFrame) -> DataFrame:
    """Suppliers of each service with sums and years, largest volume first in rank."""
    from pyspark.sql.window import Window

    sums = spending.groupBy("doc_id", "entity_item_id").agg(F.max("supplier").alias("supplier"), F.sum("volume").alias("volume"), F.sum("executed").alias("executed"), F.concat_ws("-", F.coalesce(F.min("min_year").cast("string"), F.lit("")), F.coalesce(F.max("max_year").cast("string"), F.lit(""))).alias("years"))
    return sums.withColumn("rank", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("volume"), "entity_item_id")))


def spending_tenders(spending: DataFrame, tenders: DataFrame) -> DataFrame:
    """Tenders of a service's contracts with what was contracted and paid in it."""
    keyed = spending.select("doc_id", "volume", "executed", F.explode("tender_key").alias("k")).withColumn("k", F.from_json("k", "array<string>"))
    sums = keyed.groupBy("doc_id", F.get("k", F.lit(0)).alias("publication_id"), F.get("k", F.lit(1)).alias("tender_type"), F.get("k", F.lit(2)).alias("tender_id")).agg(F.sum("volume").alias("svc_volume"), F.sum("executed").alias("svc_executed"))
    return sums.join(tenders.withColumns({c: q(c).cast("string") for c in ("publication_id", "tender_type", "tender_id")}), ["publication_id", "tender_type", "tender_id"])


def questionnaire(df: DataFrame, principles: dict[str, list[tuple[str, float, float, str | None]]]) -> DataFrame:
    """A score of 0 to 1 for each principle: answers times weights over the best possible sum.

    principles: name to (question, weight, best answer, column that marks it irrelevant). A question that is marked
    irrelevant counts neither way; an unanswered one counts as 0.
    """
    out = {}
    for name, questions in principles.items():
        got, best = F.lit(0.0), F.lit(0.0)
        for column, weight, most, irrelevant in questions:
            counts = F.lit(True)
            if irrelevant:
                kind = dict(df.dtypes)[irrelevant]
                counts = ~F.coalesce(F.size(q(irrelevant)) > 0 if kind.startswith("array") else q(irrelevant).cast("boolean"), F.lit(False))
            got = got + F.when(counts, F.coalesce(q(column).cast("double"), F.lit(0.0)) * weight).otherwise(0.0)
            best = best + F.when(counts, weight * most).otherwise(0.0)
        out[name] = got / F.nullif(best, F.lit(0.0))
    return df.withColumns(out)
