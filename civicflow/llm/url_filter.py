"""URL filters: a blocked Bloom filter passes possible hits to an exact hash join. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import hold

#: A block has 8 words of 64 bits; a URL sets one bit in each word of one block.
WORDS = 8
BITS_PER_URL = 16
#: Bound of the broadcast filter: 2**18 blocks of 9 longs are 19 MB. A longer list only passes more rows to the join.
MAX_BLOCKS = 1 << 18
SALTS = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rest_of(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.expr("substring(__url, instr(__url, '://') + 3)")).otherwise(F.lit(""))


def with_parts(df: DataFrame, url: str) -> DataFrame:
    """df with __url, host and path; a null URL or one without :// has both empty."""
    rest = rest_of(F.col("__url"))
    return (
        df.withColumn("__url", F.col(f"`{url}`").cast("string"))
        .withColumn("host", F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER))
        .withColumn("path", F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))
        .withColumn("host", F.coalesce("host", F.lit("")))
        .withColumn("path", F.coalesce("path", F.lit("")))
    )


def canonical() -> Column:
    """host without www. or m., path without closing slashes or .html, the query's sorted parameters but tracking ones.

    Of columns host, path and __url; null where there is no host.
    """
    query = F.regexp_extract(F.col("__url"), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike("^(utm_|ref=)")))
    path = F.regexp_replace(F.regexp_replace(F.col("path"), "/+$", ""), r"(/index)?\.html?$", "")
    text = F.concat(F.regexp_replace("host", r"^(www|m)\.", ""), path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")))
    return F.when(F.col("host") != "", text)


def rule_columns(rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """rule and its verdict by the longest rule that fits; rules are a short list of (verdict, host/path)."""
    rule = verdict = F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        host, path = text.partition("/")[0], "/" + text.partition("/")[2]
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def bit(j: int) -> Column:
    return F.expr(f"1L << cast((shiftrightunsigned(__h2, {6 * j}) & 63L) as int)")


def hashed(df: DataFrame, key: str, blocks: int) -> DataFrame:
    return df.withColumn("__block", F.xxhash64(key).bitwiseAND(F.lit(blocks - 1))).withColumn("__h2", F.xxhash64(key, F.lit(1)))


def bloom_blocks(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """One row a block that has bits set: __block, w0 to w7."""
    return hashed(listed, key, blocks).groupBy("__block").agg(*[F.bit_or(bit(j)).alias(f"w{j}") for j in range(WORDS)])


def filter_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str]], url: str = "url", id_col: str = "page_id", list_url: str = "url") -> DataFrame:
    """id_col, host, path, rule, verdict of each page.

    The rule that fits decides; other pages are blocked if the list has their canonical URL and allowed else. Null and
    odd URLs have no canonical form and are allowed. Rows are judged one by one: repeated rows give repeated verdicts,
    ties between rules go to the one later in text order, an empty list allows all. Other columns are not read. Only
    possible hits are shuffled, salted so that a URL with a third of all rows is spread over SALTS tasks.
    """
    keys = hold(with_parts(listed.select(F.col(f"`{list_url}`").alias("__listed")), "__listed").select(canonical().alias("canon")).where(F.col("canon").isNotNull()).distinct())
    n = keys.count()
    blocks = min(MAX_BLOCKS, 1 << max(0, (n * BITS_PER_URL // (64 * WORDS)).bit_length()))
    rule, verdict = rule_columns(rules)
    judged = with_parts(pages.select(F.col(f"`{id_col}`"), F.col(f"`{url}`")), url).withColumn("rule", rule).withColumn("verdict", verdict).withColumn("canon", F.when(F.col("rule").isNull(), canonical()))
    probed = hashed(judged, "canon", blocks).join(F.broadcast(bloom_blocks(keys, "canon", blocks)), "__block", "left")
    possible = F.col("canon").isNotNull()
    for j in range(WORDS):
        possible = possible & (F.coalesce(F.col(f"w{j}"), F.lit(0)).bitwiseAND(bit(j)) != 0)
    probed = probed.withColumn("possible", possible).select(id_col, "host", "path", "rule", "verdict", "canon", "possible")
    salted = keys.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumn("__listed", F.lit(True))
    hits = probed.where("possible").withColumn("__salt", F.pmod(F.xxhash64(F.col(id_col), F.col("path")), F.lit(SALTS)).cast("int"))
    hits = hits.join(salted, ["canon", "__salt"], "left").withColumn("verdict", F.when(F.col("__listed"), "block").otherwise("allow"))
    out = [id_col, "host", "path", "rule", "verdict"]
    return hits.select(*out).unionByName(probed.where(~F.col("possible")).select(*out[:-1], F.coalesce("verdict", F.lit("allow")).alias("verdict")))
