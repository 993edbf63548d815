"""Grouping of similar titles and of support programs over years."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import hebrew_only
from ..operators.chains import components
from ..operators.project import q
from ..operators.windows import top_and_others
from ..state.lineage import cut
from ..udfs.fuzzy import similarity


#: Titles are similar at this score of a hundred.
SIMILAR = 90


def title_keys(df: DataFrame, side: str) -> DataFrame:
    """df (title t) with gram: runs of characters one of which similar titles share.

    A title of 10 characters or more that is similar to another has at most a tenth of its own amiss or a fifth cut off,
    so three in a row agree; a shorter one is contained, but for what is cut off. Of one or two characters, it is whole.
    """
    n = F.length("t")
    grams = lambda k: F.transform(F.sequence(F.lit(1), n - (k - 1)), lambda i: F.col("t").substr(i, F.lit(k)))
    short = F.when(n < 3, F.array("t")).otherwise(grams(3))
    every = F.when(n < 2, grams(1)).when(n < 3, F.concat(grams(1), grams(2))).otherwise(F.concat(grams(1), grams(2), grams(3)))
    return df.withColumn("gram", F.explode(F.array_distinct(short if side == "short" else every)))


def cluster_names(titles: DataFrame) -> DataFrame:
    """root, tag of each cluster of titles (root, t): the first words in a row of its longest title that others have too.

    Of titles of equal length the greatest counts; where others have none of its words it is the name as a whole.
    """
    longest = titles.groupBy("root").agg(F.max_by("t", F.struct(F.length("t"), "t")).alias("longest"))
    words = longest.select("root", F.posexplode(F.filter(F.split("longest", r"(?U)\s+"), lambda w: w != "")).alias("pos", "word"))
    met = words.join(titles, "root").where(similarity("partial")("word", "t") >= SIMILAR)
    shared = met.groupBy("root", "pos", "word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    # positions less their numbers are the same along a stretch
    stretch = F.col("pos") - F.row_number().over(Window.partitionBy("root").orderBy("pos"))
    listed = shared.withColumn("stretch", stretch).groupBy("root").agg(F.array_sort(F.collect_list(F.struct("pos", "stretch", "word"))).alias("w"))
    first = F.transform(F.filter("w", lambda x: x["stretch"] == F.col("w")[0]["stretch"]), lambda x: x["word"])
    return longest.join(listed.select("root", F.array_join(first, " ").alias("run")), "root", "left").select("root", F.coalesce("run", "longest").alias("tag"))


def similar_titles(titles: DataFrame) -> DataFrame:
    """k, t of each title with tag, the name of its cluster: single linkage by similarity within a key k.

    Titles of a key meet where they share a gram, and pairs are scored wherever they are. What two similar titles do not share touches at most 0.71 grams a character of the
    shorter, so its rarest grams, one more than those, are enough, and the commonest never bring titles together.
    """
    ids = titles.withColumn("id", F.xxhash64("k", "t"))
    b = title_keys(ids, "long").select("k", "gram", F.col("t").alias("t2"), F.col("id").alias("b"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy("n", "gram"))
    a = title_keys(ids, "short").join(b.groupBy("k", "gram").agg(F.count(F.lit(1)).alias("n")), ["k", "gram"])
    a = a.select("k", "gram", F.col("t").alias("t1"), F.col("id").alias("a"), "n").withColumn("r", rank).where(F.col("r") <= F.floor(0.71 * F.length("t1")) + 1).drop("r", "n")
    # The shorter of two titles looks for the longer; of equal length the lesser does.
    first = F.struct(F.length("t1"), "t1") < F.struct(F.length("t2"), "t2")
    pairs = a.join(b, ["k", "gram"]).where(first).select("a", "b", "t1", "t2").distinct()
    near = pairs.where(similarity("partial")("t2", "t1") >= SIMILAR).select("a", "b")
    found = components(near).select(F.col("node").alias("id"), "root")

    grouped = ids.join(found, "id", "left").withColumn("root", F.coalesce("root", "id"))
    names = cluster_names(grouped.join(found.select("root").distinct(), "root", "left_semi").select("root", "t"))
    return grouped.join(names, "root", "left").select("k", "t", F.coalesce("tag", "t").alias("tag"))


def spending_clusters(df: DataFrame, keys: list[str], title: str = "title", amount: str = "amount", most: int = 4, others: str = "אחרים") -> DataFrame:
    """tag, amount, count, amounts of the largest clusters of similar titles of a key, and of all others together.

    Amounts are summed by title first; amounts themselves never gather in a task.
    """
    rows = df.where(q(title).isNotNull() & (q(title) != "") & q(amount).isNotNull() & (q(amount) != 0))
    by_title = rows.groupBy(*map(q, keys), q(title).alias("t")).agg(F.sum(q(amount).cast("double")).alias("amount"), F.count(F.lit(1)).alias("count"))
    by_title = by_title.withColumn("k", F.to_json(F.struct(*map(q, keys))))
    tags = similar_titles(by_title.select("k", "t"))
    tagged = by_title.join(tags, ["k", "t"]).groupBy(*map(q, keys), "tag").agg(F.sum("amount").alias("amount"), F.sum("count").alias("count"))
    return top_and_others(tagged, keys, "tag", ["amount", "count"], most, others)


def program_keys(df: DataFrame) -> DataFrame:
    """df (budget_code, support_title, year_requested, amount_approved) with program_key.

    Programs grow from year to year: what is asked for under a code and a short title belongs to the program that had
    both in an earlier year, else to one that had either of them; of several the oldest. Without one it belongs with
    the least code of the same title and office (the code's first four digits) in its own year, else it begins a program
    that is named by code and short title. Rows without amount, title, code or year have none.

    A year is a round of equality joins with one program a code, a short title and both, made from all earlier years, so
    that no rows meet more than one.
    """
    short = F.substring(hebrew_only(F.coalesce("support_title", F.lit(""))), 1, 15)
    marked = df.withColumn("__short", short)
    used = marked.where((F.col("amount_approved") > 0) & F.col("support_title").isNotNull() & ~F.col("support_title").isin("", "אינו מוקצה"))
    items = used.groupBy(F.col("budget_code").alias("code"), F.col("__short").alias("short"), F.col("year_requested").alias("year")).agg(F.min("support_title").alias("title"))
    items = cut(items.where(F.col("code").isNotNull() & F.col("short").isNotNull() & F.col("year").isNotNull()))
    years = sorted(r["year"] for r in items.select("year").distinct().collect())
    keyed = cut(items.limit(0).select("code", "short", "year", F.struct(F.col("year").alias("born"), F.lit("").alias("name")).alias("program")))
    for year in years:
        now = items.where(F.col("year") == year)
        for i, on in enumerate((["code", "short"], ["code"], ["short"])):
            now = now.join(keyed.groupBy(*on).agg(F.min("program").alias(f"p{i}")), on, "left")
        own = F.struct(F.lit(year).cast(items.schema["year"].dataType).alias("born"), F.concat("code", F.lit("_"), "short").alias("name"))
        old = F.coalesce("p0", F.least("p1", "p2"))
        least = now.groupBy("short", "title", F.substring("code", 1, 4).alias("office")).agg(F.min_by(F.coalesce(old, own), "code").alias("first"))
        now = now.withColumn("office", F.substring("code", 1, 4)).join(least, ["short", "title", "office"])
        keyed = cut(keyed.unionByName(now.select("code", "short", "year", F.coalesce(old, "first").alias("program"))))
    found = keyed.select(F.col("code").alias("budget_code"), F.col("short").alias("__short"), F.col("year").alias("year_requested"), F.col("program.name").alias("program_key"))
    joined = marked.join(found, ["budget_code", "__short", "year_requested"], "left")
    return joined.select(*map(q, df.columns), "program_key")
