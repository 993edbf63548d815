"""Rows that belong together through chains of links, and joins on keys that a large share of all rows has."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..state.lineage import cut, files
from .project import q

#: A key is heavy with more rows than this and than a thousandth of all.
HEAVY_ROWS = 5_000
#: The stars settle in about the logarithm of the longest chain; beyond this something is wrong.
MAX_ROUNDS = 60


def is_heavy(weight: int, total: int) -> bool:
    return weight > max(HEAVY_ROWS, total // 1000)


def looked_up(rows: DataFrame, table: DataFrame, on: str, weight: str, total: int, how: str = "inner", most: int | None = None) -> DataFrame:
    """rows joined to a table of one row a key, so that the rows of a heavy key do not gather in one task.

    The table's column weight, which is dropped, says how many of all total rows have the key. Keys with over a
    thousandth of them are fewer than a thousand: these are broadcast, and their rows stay where they are. how is
    inner or left; null keys have no row in the table. most, if known, is the largest weight: without heavy keys it is
    a plain join.
    """
    least = max(HEAVY_ROWS, total // 1000)
    heavy = table.where(F.col(weight) > least).drop(weight)
    if not is_heavy(total if most is None else most, total) or (most is None and heavy.isEmpty()):
        return rows.join(table.drop(weight), on, how)
    light = table.where(F.col(weight) <= least).drop(weight)
    at_once = rows.join(F.broadcast(heavy), on)
    return at_once.unionByName(rows.join(F.broadcast(heavy.select(on)), on, "left_anti").join(light, on, how))


def components(edges: DataFrame, nodes: int | None = None) -> DataFrame:
    """node, root for each node of an edge; root is the least node that it reaches.

    edges has a and b of one type that can be ordered; nulls and loops are dropped, repeated edges count once. Isolated
    nodes do not appear. nodes, about how many there are in all, sizes the first checkpoint. Large and small stars
    alternate until there are only stars around their least nodes.
    """
    now = cut(edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).distinct(), nodes)
    rows, most, settled = _state(now)
    for _ in range(MAX_ROUNDS):
        if settled:
            break
        large = _large_star(now, rows, most)
        large = cut(large, rows) if is_heavy(most, 2 * rows) else large  # what a heavy node needs reads its input often
        now = cut(_small_star(large, rows, most), rows)
        rows, most, settled = _state(now)
    else:
        raise RuntimeError("components did not settle")
    roots = now.groupBy("m").agg(F.count(F.lit(1)).alias("n")).select(F.col("m").alias("node"), F.col("m").alias("root"))
    return now.select(F.col("v").alias("node"), F.col("m").alias("root")).unionByName(roots.coalesce(files(rows)))


def _state(edges: DataFrame) -> tuple[int, int, bool]:
    """How many edges there are, the most of one node, and whether each greater end has no other edge: all are stars."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.lit(1).alias("up")), F.struct(F.col("m").alias("u"), F.lit(0).alias("up")))).alias("e"))
    nodes = ends.groupBy("e.u").agg(F.count(F.lit(1)).alias("n"), F.sum("e.up").alias("up"))
    n, most, loose = nodes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0)), F.count(F.when((F.col("up") > 0) & (F.col("n") > 1), 1))).first()
    return max(1, n // 2), most, loose == 0


def _large_star(edges: DataFrame, rows: int, most: int) -> DataFrame:
    """Each node's greater neighbours are tied to its least neighbour or itself. A star's centre may have most edges.

    Without heavy nodes a node's edges meet once, and what is repeated stays for the small star.
    """
    both = edges.select(F.col("v").alias("u"), F.col("m").alias("w")).unionByName(edges.select(F.col("m").alias("u"), F.col("v").alias("w")))
    if not is_heavy(most, 2 * rows):
        tied = both.withColumn("l", F.least("u", F.min("w").over(Window.partitionBy("u"))))
        return tied.where(F.col("w") > F.col("u")).select(F.col("w").alias("v"), F.col("l").alias("m"))
    least = both.groupBy("u").agg(F.min("w").alias("l"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "l").alias("l"), "n")
    out = looked_up(both.where(F.col("w") > F.col("u")), least, "u", "n", 2 * rows, most=most).select(F.col("w").alias("v"), F.col("l").alias("m"))
    return out.where(F.col("v") != F.col("m")).distinct()


def _small_star(edges: DataFrame, rows: int, most: int) -> DataFrame:
    """Each node and its lesser neighbours are tied to the least of them. The large star gives no node more of these."""
    if not is_heavy(most, 2 * rows):
        tied = edges.withColumn("l", F.min("m").over(Window.partitionBy("v")))
        ends = tied.select(F.explode(F.array("v", "m")).alias("v"), F.col("l").alias("m"))
        return ends.where(F.col("v") != F.col("m")).distinct()
    least = edges.groupBy("v").agg(F.min("m").alias("l"), F.count(F.lit(1)).alias("n"))
    joined = looked_up(edges, least, "v", "n", 2 * rows, most=most)
    out = joined.select(F.col("m").alias("v"), F.col("l").alias("m")).unionByName(least.select("v", F.col("l").alias("m")))
    return out.where(F.col("v") != F.col("m")).distinct()


def label_chains(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """pairs with chain: one and the same text for all pairs that alternating shared values of a and of b reach.

    Pairs with a null in a or b are dropped.
    """
    known = pairs.where(q(a).isNotNull() & q(b).isNotNull()).withColumn("__a", F.concat(F.lit("a/"), q(a).cast("string"))).withColumn("__b", F.concat(F.lit("b/"), q(b).cast("string")))
    known = cut(known)
    found = components(known.select(F.col("__a").alias("a"), F.col("__b").alias("b")))
    weights = known.groupBy("__a").agg(F.count(F.lit(1)).alias("__n"))
    table = weights.join(found.select(F.col("node").alias("__a"), F.col("root").alias("chain")), "__a")
    return looked_up(known, table, "__a", "__n", known.count()).drop("__a", "__b")
