"""National and municipal budgets: phases and hierarchy, children, categories, topical sums, rollups, item histories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.codes import even_length, pad_left
from ..operators.joins import lookup_once
from ..operators.project import q
from ..state.lineage import cut

# Phases by their word, the state's own code and title, the title of what has none.
PHASES = {"מקורי": "allocated", "מאושר": "revised", "ביצוע": "executed"}
STATE, STATE_TITLE, UNKNOWN = "00", "המדינה", "לא ידוע"
LEVELS = [("admin_cls_code_2", "admin_cls_title_2"), ("admin_cls_code_4", "admin_cls_title_4"), ("admin_cls_code_6", "admin_cls_title_6"), ("admin_cls_code_8", "admin_cls_title_8")]
PAIR = "struct<code:string,title:string>"


def phase_rows(raw: DataFrame, last_completed_year: int) -> DataFrame:
    """raw with phase as a suffix; rows after the last completed year count as revised as well."""
    names = F.create_map(*[F.lit(x) for p in PHASES.items() for x in p])
    own = F.try_element_at(names, F.col("phase"))
    phases = F.when(F.col("year") > last_completed_year, F.array(own, F.lit("revised"))).otherwise(F.array(own))
    return raw.withColumn("phase", F.explode(phases))


def hierarchy_rows(raw: DataFrame, measures: Sequence[str], last_completed_year: int, factors: Mapping[str, int] | None = None, fixes: DataFrame | None = None, order_by: Sequence[str] = ()) -> DataFrame:
    """A row for each level that a budget line counts in: its four administrative levels, the state, and two functional ones.

    Columns year, code, title, depth, parent, hierarchy and each measure by phase. fixes (year, code, measures) change
    the first revised row of a program, on all levels but the lowest.
    """
    factors = factors or {}
    lines = phase_rows(raw, last_completed_year)
    for m in measures:
        lines = lines.withColumn(m, F.coalesce(q(m), F.lit(0)) * factors.get(m, 1))
    if fixes is not None:
        lines = lines.withColumn("__program", F.when(F.col("phase") == "revised", pad_left(F.col("admin_cls_code_6"), 8)))
        named = fixes.select("year", F.col("code").alias("__program"), *[q(m).alias(f"__fix_{m}") for m in measures])
        lines = lookup_once(lines, named, ["year", "__program"], order_by)
        fixed = {m: F.when((q(m) != 0) & F.col("__program").isNotNull(), q(m) + F.coalesce(q(f"__fix_{m}"), F.lit(0))).otherwise(q(m)) for m in measures}
    else:
        fixed = {m: q(m) for m in measures}
    codes = [even_length(q(c)) for c, _ in LEVELS]
    padded = [pad_left(c, 4 + 2 * i) for i, c in enumerate(codes)]
    titles = [F.coalesce(F.nullif(q(t), F.lit("")), F.lit(UNKNOWN)) for _, t in LEVELS]
    income = codes[0].cast("int") == 0
    root = F.when(income, F.array().cast(f"array<{PAIR}>")).otherwise(F.array(F.struct(F.lit(STATE).alias("code"), F.lit(STATE_TITLE).alias("title"))))
    no_parents = F.array().cast(f"array<{PAIR}>")

    def level(code: Column, title: Column, depth: int, hierarchy: Column, parent: Column, low: bool = False) -> Column:
        return F.struct(code.alias("code"), title.alias("title"), F.lit(depth).alias("depth"), hierarchy.alias("hierarchy"), parent.alias("parent"), F.lit(low).alias("low"))

    out, above = [], root
    for i, (code, title) in enumerate(zip(padded, titles)):
        here = q(LEVELS[i][0]).isNotNull()
        parent = F.get(above, F.size(above) - 1)["code"]
        out.append(F.when(here, level(code, title, i + 1, above, parent, low=4 + 2 * i >= 10)))
        above = F.when(here, F.concat(above, F.array(F.struct(code.alias("code"), title.alias("title"))))).otherwise(above)
    leaf = F.get(above, F.size(above) - 1)["code"]
    loans = F.coalesce(F.col("econ_cls_code_2") == "266", F.lit(False))
    of_state = (leaf >= "0001") & ((leaf < "0084") | loans)
    functional = (leaf < "0084") | loans | leaf.startswith("0000")
    one, two = F.col("func_cls_code_1").cast("int"), F.col("func_cls_code_2").cast("int")
    c1, c2 = F.concat(F.lit("C"), one.cast("string")), F.format_string("C%d%02d", one, two)
    t1, t2 = q("func_cls_title_1"), F.concat_ws(" / ", q("func_cls_title_1"), q("func_cls_title_2"))
    # Functional levels stand under the state, which an income line's do not once the state has taken their place in the order.
    under = F.when((leaf < "0084") | loans, F.array(F.struct(F.lit(STATE).alias("code"), F.lit(STATE_TITLE).alias("title")))).otherwise(no_parents)
    out.append(F.when(of_state, level(F.lit(STATE), F.lit(STATE_TITLE), 0, no_parents, F.lit(None).cast("string"))))
    out.append(F.when(functional, level(c1, t1, -2, under, F.lit(None).cast("string"))))
    out.append(F.when(functional, level(c2, t2, -1, F.concat(under, F.array(F.struct(c1.alias("code"), t1.alias("title")))), c1)))
    wide = lines.withColumn("__l", F.explode(F.filter(F.array(*out), lambda x: x.isNotNull())))
    amounts = []
    for phase in PHASES.values():
        for m in measures:
            value = F.when(F.col("__l.low"), q(m)).otherwise(fixed[m])
            amounts.append(F.when(F.col("phase") == phase, value).alias(f"{m}_{phase}"))
    rest = [c for c in ("non_repeating", "econ_cls_code_1", "econ_cls_title_1", "econ_cls_code_2", "econ_cls_title_2", "func_cls_code_1", "func_cls_title_1", "func_cls_code_2", "func_cls_title_2") if c in raw.columns]
    return wide.select("year", *[F.col(f"__l.{c}").alias(c) for c in ("code", "title", "depth", "parent", "hierarchy")], F.col("admin_cls_code_0").alias("budget_kind_code") if "admin_cls_code_0" in raw.columns else F.lit(None).alias("budget_kind_code"), *map(q, rest), *amounts)


def rolled_up(rows: DataFrame, measures: Sequence[str]) -> DataFrame:
    """One row a year and code: sums of all measures, sorted sets of the classes."""
    sums = [F.sum(q(f"{m}_{p}")).alias(f"{m}_{p}") for p in PHASES.values() for m in measures]
    sets = [F.array_sort(F.collect_set(q(c))).alias(c) for c in ("non_repeating", "budget_kind_code") if c in rows.columns]
    classes = []
    if {"func_cls_code_1", "func_cls_title_1"} <= set(rows.columns):
        classes.append(F.array_sort(F.collect_set(F.to_json(F.array("func_cls_code_1", "func_cls_title_1", "func_cls_code_2", "func_cls_title_2")))).alias("func_cls_json"))
    if {"econ_cls_code_1", "econ_cls_title_1"} <= set(rows.columns):
        classes.append(F.array_sort(F.collect_set(F.to_json(F.array("econ_cls_code_1", "econ_cls_title_1", "econ_cls_code_2", "econ_cls_title_2")))).alias("econ_cls_json"))
    return rows.groupBy("year", "code").agg(F.min("title").alias("title"), F.min("depth").alias("depth"), F.min("parent").alias("parent"), F.min("hierarchy").alias("hierarchy"), *sums, *sets, *classes)


def fill_revised(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Allocated amounts as revised ones where a row has no revised amount at all."""
    none = F.lit(True)
    for m in measures:
        none = none & (F.coalesce(q(f"{m}_revised"), F.lit(0)) == 0)
    return df.withColumns({f"{m}_revised": F.when(none, q(f"{m}_allocated")).otherwise(q(f"{m}_revised")) for m in measures})


def with_children(df: DataFrame) -> DataFrame:
    """children: the rows of the year whose parent a row is, in code order; revised amounts fall back to allocated."""
    child = F.struct("code", "title", F.col("net_allocated").cast("long").alias("net_allocated"), F.coalesce("net_revised", "net_allocated").cast("long").alias("net_revised"))
    kids = df.where(F.col("parent").isNotNull()).groupBy("year", F.col("parent").alias("code")).agg(F.array_sort(F.collect_list(child)).alias("children"))
    return df.join(kids, ["year", "code"], "left")


def topical_sums(rows: DataFrame, category: str, names: Mapping[str, str], keys: Sequence[str] = ("year", "code")) -> DataFrame:
    """Revised net amounts of each category in a column of its own."""
    return rows.groupBy(*map(q, keys)).agg(*[F.sum(F.when(q(category) == k, q("net_revised")).otherwise(0)).alias(n) for k, n in names.items()])


def municipal_rollup(raw: DataFrame, keys: Sequence[str], levels: Sequence[tuple[str, str]], phases: Mapping[str, str], value: str = "value") -> DataFrame:
    """Sums by phase of each level of a municipal budget, lowest last, in one pass over grouping sets.

    levels: (code, title) columns from the broadest to the card. depth tells the level of a row.
    """
    pivoted = raw.groupBy(*map(q, keys), *[q(c) for pair in levels for c in pair]).agg(*[F.max(F.when(F.col("phase") == k, q(value))).alias(n) for k, n in phases.items()])
    sets = [F.struct(F.lit(i + 1).alias("depth"), q(c).alias("code"), q(t).alias("title"), (q(levels[i - 1][0]) if i else F.lit(None).cast("string")).alias("parent")) for i, (c, t) in enumerate(levels)]
    wide = pivoted.select(*map(q, keys), *phases.values(), F.explode(F.array(*sets)).alias("l")).where(F.col("l.code").isNotNull())
    return wide.groupBy(*map(q, keys), "l.depth", "l.code", "l.parent").agg(F.min("l.title").alias("title"), *[F.sum(n).alias(n) for n in phases.values()])


def with_history(df: DataFrame, keys: Sequence[str], fields: Sequence[str], year: str = "year") -> DataFrame:
    """The latest row of each key with history: a map from year to the fields."""
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct(q(year).alias("y"), F.struct(*map(q, fields)).alias("v")))))
    latest = df.withColumn("__rn", F.row_number().over(Window.partitionBy(*map(q, keys)).orderBy(F.desc(year)))).where("__rn = 1").drop("__rn")
    return latest.join(df.groupBy(*map(q, keys)).agg(entries.alias("history")), list(keys))


def connect_years(df: DataFrame, curated: DataFrame | None = None, measures: Sequence[str] = ("net_allocated", "net_revised", "net_executed"), threshold: int = 80) -> DataFrame:
    """chain_id of each (year, code): items of successive years that are the same, the id being its earliest year and code.

    Year by year, an item is last year's of a curated mapping, or of the same code and a similar title, or, failing
    both, of those that all its children continue. Items without amounts, but for codes that end in 99, and those not
    meant to repeat begin a chain. Pointers to earlier items double their reach from round to round, so that rounds go
    with the logarithm of the number of years.

    df: year, code, title, parent, non_repeating (array) and the measures; curated: year, code, prev_code.
    """
    from ..udfs.fuzzy import similarity

    total = sum((F.abs(F.coalesce(q(m).cast("double"), F.lit(0.0))) for m in measures if m in df.columns), F.lit(0.0))
    once = (F.size("non_repeating") == 1) & F.array_contains("non_repeating", "1") if "non_repeating" in df.columns else F.lit(False)
    dead = ((total == 0) & ~F.col("code").endswith("99") | F.coalesce(once, F.lit(False))) & ~F.col("code").startswith("C")
    items = df.select("year", "code", "title", "parent", dead.alias("dead"))
    before = items.select((F.col("year") + 1).alias("year"), "code", F.col("title").alias("old"))
    same = items.where(~F.col("dead")).join(before, ["year", "code"]).withColumn("s", similarity("partial")("title", "old")).where(F.col("s") > threshold).select("year", "code", F.col("code").alias("prev_code"))
    if curated is not None:
        fixed = items.join(curated, ["year", "code"]).select("year", "code", "prev_code")
        same = same.join(fixed.select("year", "code").distinct(), ["year", "code"], "left_anti").unionByName(fixed)
    # An item without a match is all its children's together, if each child has one.
    kids = items.where(F.col("parent").isNotNull()).join(same.groupBy("year", "code").agg(F.collect_set("prev_code").alias("found")), ["year", "code"], "left")
    through = kids.groupBy("year", F.col("parent").alias("code")).agg(F.bool_and(F.col("found").isNotNull()).alias("all"), F.flatten(F.collect_list("found")).alias("found")).where("all")
    open_ = items.where(~F.col("dead")).join(same.select("year", "code").distinct(), ["year", "code"], "left_anti")
    split = open_.join(through, ["year", "code"]).select("year", "code", F.explode("found").alias("prev_code"))
    links = cut(same.unionByName(split).distinct())
    steps = links.join(items.select((F.col("year") + 1).alias("year"), F.col("code").alias("prev_code")), ["year", "prev_code"], "left_semi")
    # Each item points at the earliest of its chains that it has seen; pointers of pointers reach twice as far.
    first = items.join(steps.select("year", "code").distinct(), ["year", "code"], "left_anti").select("year", "code", F.col("year").alias("to_year"), F.col("code").alias("to_code"), F.lit(True).alias("end"))
    begins = first.select(F.col("year").alias("to_year"), F.col("code").alias("to_code"), F.lit(True).alias("__end"))
    back = steps.select("year", "code", (F.col("year") - 1).cast(items.schema["year"].dataType).alias("to_year"), F.col("prev_code").alias("to_code")).join(begins, ["to_year", "to_code"], "left").select("year", "code", "to_year", "to_code", F.coalesce("__end", F.lit(False)).alias("end"))
    points = cut(first.unionByName(back))
    while not (open_ := points.where(~F.col("end"))).isEmpty():
        onward = points.select(F.col("year").alias("to_year"), F.col("code").alias("to_code"), F.col("to_year").alias("__y"), F.col("to_code").alias("__c"), F.col("end").alias("__end"))
        further = open_.join(onward, ["to_year", "to_code"]).select("year", "code", F.col("__y").alias("to_year"), F.col("__c").alias("to_code"), F.col("__end").alias("end"))
        points = cut(points.where("end").unionByName(further).distinct())
    chain = F.concat_ws("/", F.col("to_year").cast("string"), "to_code")
    return points.groupBy("year", "code").agg(F.min(chain).alias("chain_id"))


def chain_history(df: DataFrame, chains: DataFrame, measures: Sequence[str]) -> DataFrame:
    """The latest items of each chain with history: year to summed measures and sorted code:title pairs."""
    joined = df.join(chains, ["year", "code"])
    yearly = joined.groupBy("chain_id", "year").agg(*[F.sum(q(m)).alias(m) for m in measures], F.array_sort(F.collect_set(F.concat_ws(":", "code", "title"))).alias("code_titles"))
    entry = F.struct(F.col("year").alias("y"), F.struct(*measures, "code_titles").alias("v"))
    history = yearly.groupBy("chain_id").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("history"), F.max("year").alias("year"))
    return joined.join(history, ["chain_id", "year"])

