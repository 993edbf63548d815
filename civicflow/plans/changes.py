"""Budget changes: exploded codes, transfer groups that balance, and their summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import lookup_or
from ..operators.project import q
from ..state.lineage import cut
from .balancing import balanced_groups, few_lines, groups_of_few

MEASURES = ["net_expense_diff", "gross_expense_diff", "allocated_income_diff", "commitment_limit_diff", "personnel_max_diff"]


def code_rows(df: DataFrame, code: str = "budget_code") -> DataFrame:
    """A row for each of the code's four levels."""
    return df.withColumn(code, F.explode(F.transform(F.array(*[F.lit(n) for n in (4, 6, 8, 10)]), lambda n: q(code).substr(F.lit(1), n))))


def individual_changes(df: DataFrame, array: str = "change_list") -> DataFrame:
    """code:title items as rows of budget_code and budget_title beside the other columns."""
    from ..functions.text import split_once

    items = df.select(*[q(c) for c in df.columns if c != array], F.explode(q(array)).alias("__c"))
    head, tail = split_once(F.col("__c"))
    return items.withColumn("budget_code", head).withColumn("budget_title", tail).drop("__c")


def _any_moved(measures: Sequence[str]) -> Column:
    moved = F.lit(False)
    for m in measures:
        moved = moved | (F.coalesce(q(m), F.lit(0)) != 0)
    return moved


def known_groups(lines: DataFrame, known: DataFrame) -> DataFrame:
    """date_kind, trcode, key of the known groups (date_kind, serial, trcodes) all of whose codes lines still have.

    Of groups that share a code the one with the least serial comes first. Groups that come first for all of their codes
    are taken together, those that share a code with them fall away, and so on until none is left.

    Groups go by their numbers, so that no code carries the others of its group along.
    """
    codes = F.array_sort(F.array_distinct("trcodes"))
    listed = known.select("date_kind", "serial", codes.alias("codes")).distinct()
    first = F.row_number().over(Window.partitionBy("date_kind").orderBy("serial", "codes"))
    numbered = listed.withColumn("key", first)  # before the codes come apart
    items = numbered.select("date_kind", "key", F.size("codes").alias("n"), F.explode("codes").alias("trcode"))
    there = lines.select(F.col("date_kind").alias("__d"), F.col("trcode").alias("__t")).distinct()
    same = F.col("date_kind").eqNullSafe(F.col("__d")) & (F.col("trcode") == F.col("__t"))
    kind = Window.partitionBy("date_kind", "key")
    found = items.join(there, same, "left_semi").withColumn("have", F.count(F.lit(1)).over(kind))
    left = cut(found.where(F.col("have") == F.col("n")).select("date_kind", "key", "trcode"))
    out = left.limit(0)
    while not left.isEmpty():
        ahead = F.min("key").over(Window.partitionBy("date_kind", "trcode")) < F.col("key")
        told = cut(left.withColumn("ahead", ahead).withColumn("ahead", F.max("ahead").over(kind)))
        taken = told.where(~F.col("ahead")).drop("ahead")
        out = out.unionByName(taken)
        rest = told.where("ahead").drop("ahead")
        if rest.isEmpty():
            break
        gone = taken.select(F.col("date_kind").alias("__d"), F.col("trcode").alias("__t"))
        hit = rest.join(gone, same, "left_semi").select(F.col("date_kind").alias("__d"), F.col("key").alias("__k")).distinct()
        left = cut(rest.join(hit, F.col("date_kind").eqNullSafe(F.col("__d")) & (F.col("key") == F.col("__k")), "left_anti"))
    return out


def change_groups(df: DataFrame, measures: Sequence[str] = MEASURES, known: DataFrame | None = None) -> DataFrame:
    """group_id of each change code: transfers of the reserve on one date kind that sum to zero in all measures.

    df: trcode, date_kind, budget_code, leading_item and measures. Groups have two to six changes of different leading
    items, small groups first, then those whose codes come first; other changes stand alone. A group's id is its first
    change of positive sum, else its first.

    known: date_kind, serial, trcodes (an array), the groups of an earlier run as group_cache gives them. Those all of
    whose codes are still there are taken before any search, in the order of serial.
    """
    changes = df.where(F.col("leading_item") != 47)
    reserve = F.coalesce(F.col("budget_code").startswith("0047") & _any_moved(measures), F.lit(False))
    amounts = F.array(*[F.when(F.col("reserve"), F.round(F.coalesce(q(m), F.lit(0)).cast("double") * 1000).cast("long")).otherwise(0) for m in measures])
    own = F.when(~F.col("budget_code").startswith("0047"), sum((F.coalesce(q(m).cast("double"), F.lit(0.0)) for m in measures), F.lit(0.0)))
    leader = F.when(F.col("reserve"), F.xxhash64("leading_item")).otherwise(0)
    lines = changes.withColumn("reserve", reserve).select("trcode", F.when(F.col("reserve"), F.col("date_kind")).alias("date_kind"), "reserve", leader.alias("leader"), amounts.alias("amounts"), own.alias("own"), F.monotonically_increasing_id().alias("line"))
    lines = lines.withColumn("moved", F.exists("amounts", lambda x: x != 0))
    # lines that move nothing have kinds of their own
    kind = F.when(F.col("moved"), F.coalesce(F.concat(F.lit("="), F.col("date_kind").cast("string")), F.lit(""))).otherwise(F.concat(F.lit("-"), F.coalesce(F.col("trcode").cast("string"), F.lit(""))))
    lines = lines.withColumn("kind", kind)
    # of a code without a line of the reserve, one row stands for it
    code = Window.partitionBy("trcode").orderBy(F.desc("reserve"))
    total = F.sum("own").over(code.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = lines.withColumn("total", total).withColumn("place", F.row_number().over(code)).where(F.col("reserve") | (F.col("place") == 1)).drop("own", "place")
    one = F.struct("trcode", "total")
    groups = None
    if known is not None:
        rows = cut(rows)
        mine = known_groups(rows.where("reserve"), known).select(F.col("date_kind").alias("__d"), F.col("trcode").alias("__t"), "key")
        same = F.col("date_kind").eqNullSafe(F.col("__d")) & (F.col("trcode") == F.col("__t")) & F.col("reserve")
        groups = rows.join(mine, same).groupBy("date_kind", "key").agg(F.collect_set(one).alias("group")).select("group")
        lines = rows = cut(rows.join(mine, same, "left_anti"))
    few = lines.where("moved").groupBy(F.xxhash64("kind").alias("bucket")).count().where(F.col("count") > few_lines())
    many = cut(few.select("bucket"))
    if not many.isEmpty():
        large = F.xxhash64("kind") == F.col("bucket")
        left = cut(rows.join(many, large & F.col("moved"), "left_semi"))
        place = F.row_number().over(Window.partitionBy("kind").orderBy("trcode", "amounts", "line"))
        found = balanced_groups(cut(left.withColumn("idx", place).select("line", "kind", "idx", "leader", "amounts")))
        named = left.join(found, "line", "left").groupBy(F.coalesce("first", "line")).agg(F.collect_set(one).alias("group")).select("group")
        groups = named if groups is None else groups.unionByName(named)
        rows = rows.join(many, large & F.col("moved"), "left_anti")
    searched = groups_of_few(rows, ["trcode", "amounts", "line"], ["trcode", "total"])
    groups = searched if groups is None else groups.unionByName(searched)
    codes = F.array_distinct(F.transform("group", lambda c: c["trcode"]))
    positive = F.array_min(F.transform(F.filter("group", lambda c: c["total"] > 0), lambda c: c["trcode"]))
    return groups.select(F.explode(codes).alias("trcode"), F.coalesce(positive, F.array_min(codes)).alias("group_id"), F.size(codes).cast("long").alias("size"))


def group_cache(df: DataFrame, groups: DataFrame) -> DataFrame:
    """date_kind, serial, trcodes of the reserve's groups in what change_groups gave for df, for its next run."""
    codes = df.where((F.col("leading_item") != 47) & F.col("budget_code").startswith("0047")).select("date_kind", "trcode").distinct()
    return groups.join(codes, "trcode").groupBy("date_kind", "group_id").agg(F.array_sort(F.collect_set("trcode")).alias("trcodes")).select("date_kind", F.crc32("group_id").alias("serial"), "trcodes")


def zero_sum_pairs(df: DataFrame, keys: Sequence[str], ident: str, amount: str) -> DataFrame:
    """Pairs of rows of a key whose amounts cancel, by an equality join on the amount's size: the n-th of each sign meet."""
    sized = df.where(q(amount) != 0).select(*map(q, keys), q(ident).alias("i"), F.abs(q(amount)).alias("size"), (q(amount) > 0).alias("up"))
    n = F.row_number().over(Window.partitionBy(*map(q, keys), "size", "up").orderBy("i"))
    ranked = sized.withColumn("n", n)
    on = [*keys, "size", "n"]
    return ranked.where("up").drop("up").withColumnRenamed("i", "credit").join(ranked.where("not up").drop("up").withColumnRenamed("i", "debit"), on)


def summaries(df: DataFrame, titles: DataFrame, keys: Sequence[str] = ("transaction_id",), measures: Sequence[str] = MEASURES[:4]) -> DataFrame:
    """from and to: the four-digit offices of a transaction with their sums, most moved first; offices of zero are in both."""
    office = df.withColumn("office", F.substring("budget_code", 1, 4)).groupBy(*map(q, keys), "year", "office").agg(*[F.sum(q(m)).alias(m) for m in measures])
    named = lookup_or(office.withColumnRenamed("office", "code"), titles, ["year", "code"], "title", F.col("code"), "title")
    entry = F.struct((-F.abs(q(measures[0]))).alias("order"), F.col("code"), F.col("title"), *map(q, measures))
    listed = named.groupBy(*map(q, keys)).agg(F.array_sort(F.collect_list(entry)).alias("all"))
    pick = lambda test: F.transform(F.filter("all", test), lambda x: F.struct(x["code"].alias("code"), x["title"].alias("title"), *[x[m].alias(m) for m in measures]))
    return listed.select(*map(q, keys), pick(lambda x: x[measures[0]] <= 0).alias("from"), pick(lambda x: x[measures[0]] >= 0).alias("to"))


def mark_pending(tables: dict[str, DataFrame], pending: str) -> DataFrame:
    """All tables together with pending, true for the one of that name."""
    out = None
    for name, df in tables.items():
        part = df.withColumn("pending", F.lit(name == pending))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out
