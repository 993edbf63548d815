"""Approximate nearest neighbours by balanced posting lists.

Centroids of lists of about equal size are fitted on a bounded sample and searched through a neighbour graph held in
memory. A vector near the boundary of several lists is replicated to them; a query reads the lists whose centroids are
nearly as close as its closest. All scores are exact cosines of the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .storage import hold, looked_up

#: Rows that centroids are fitted on at most, and their bytes; all rows are indexed.
SAMPLE, SAMPLE_BYTES = 65_536, 32 << 20
LIST_ROWS = 150
#: Sampled rows a centroid has at least, so there are 16,384 lists at most, and as many as it has where there are more.
SAMPLE_ROWS, ENOUGH_ROWS = 4, 64
#: A vector goes to the lists within this ratio of its closest centroid's distance, at most so many.
REPLICA_RATIO, MAX_REPLICAS = 1.04, 3
#: A query reads the lists within this ratio, at least so many, and at most so many of 512 lists: more of more lists, by
#: the root of their number.
PROBE_RATIO, MIN_PROBES, MAX_PROBES = 1.30, 24, 96
DEGREE, BEAM = 24, 128
#: A list of more rows has lists of its own: centroids fitted on so many of its rows at most, in a task. A vector goes to
#: at most so many of them, a query reads those within the ratio, at least and at most so many.
LONG_LIST, LIST_SAMPLE = 4096, 65_536
INNER_RATIO, MIN_INNER, MAX_INNER, INNER_ROWS = 1.20, 3, 32, 16_384
PART_ROWS, PART_QUERIES = 4096, 1024


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; they are scaled by their greatest component first, as squares of very large or tiny ones are not numbers."""
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True, initial=0), 5e-324)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def balanced_centroids(x: np.ndarray, lists: int, seed: int = 5) -> np.ndarray:
    """Centres of about equal shares of x: the largest share is halved along its two-means direction until there are enough."""
    import heapq

    shares = [(-len(x), 0, np.arange(len(x)))]
    serial = 0
    while len(shares) < lists and -shares[0][0] > 1:
        _, _, own = heapq.heappop(shares)
        rng = np.random.default_rng(seed + serial)
        a, b = x[own[rng.integers(len(own))]], x[own[rng.integers(len(own))]]
        for _ in range(6):
            lean = x[own] @ (a - b)
            order = np.argsort(lean, kind="stable")
            low, high = own[order[: len(own) // 2]], own[order[len(own) // 2 :]]
            a, b = x[high].mean(axis=0), x[low].mean(axis=0)
        for half in (low, high):
            serial += 1
            heapq.heappush(shares, (-len(half), serial, half))
    return np.stack([x[own].mean(axis=0) for _, _, own in shares]) if len(x) else x


class CentroidGraph:
    """Centroids with links to their nearest ones and some far ones; whole batches search it together."""

    def __init__(self, centroids: np.ndarray, degree: int = DEGREE):
        self.c = centroids
        n = len(centroids)
        k = min(degree, n - 1) if n > 1 else 0
        near = np.zeros((n, k), np.int64)
        norm = (centroids**2).sum(axis=1)
        for a in range(0, n, 1024):
            d = norm[None, :] - 2 * centroids[a : a + 1024] @ centroids.T
            d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
            near[a : a + 1024] = np.argpartition(d, k - 1, axis=1)[:, :k] if k else 0
        far = np.random.default_rng(3).integers(0, n, (n, min(8, k)))
        self.links = np.concatenate([near, far], axis=1)
        self.entries = np.unique(np.linspace(0, n - 1, min(n, 32)).astype(np.int64))
        self.norm = norm

    def search(self, q: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """(places, squared distances) of about the beam nearest centroids of each query, nearest first."""
        n, m = len(self.c), len(q)
        beam = min(beam, n)
        rows = np.arange(m)[:, None]
        own = (q**2).sum(axis=1)[:, None]
        seen = np.zeros((m, n + 1), bool)
        place = np.full((m, beam), n, np.int64)
        dist = np.full((m, beam), np.inf)
        done = np.zeros((m, beam), bool)
        fresh = np.broadcast_to(self.entries, (m, len(self.entries))).copy()
        step = max(1, min(8, beam))
        while True:
            dup = seen[rows, fresh]
            seen[rows, fresh] = True
            sortd = np.sort(fresh, axis=1)
            order = np.argsort(fresh, axis=1, kind="stable")
            again = np.zeros_like(dup)
            np.put_along_axis(again, order, np.concatenate([np.zeros((m, 1), bool), sortd[:, 1:] == sortd[:, :-1]], axis=1), axis=1)
            at = np.minimum(fresh, n - 1)
            d = self.norm[at] - 2 * np.einsum("mkd,md->mk", self.c[at], q) + own
            d[dup | again | (fresh == n)] = np.inf
            place, dist, done = np.concatenate([place, fresh], axis=1), np.concatenate([dist, d], axis=1), np.concatenate([done, np.zeros(d.shape, bool)], axis=1)
            best = np.argsort(dist, axis=1, kind="stable")[:, :beam]
            place, dist, done = np.take_along_axis(place, best, 1), np.take_along_axis(dist, best, 1), np.take_along_axis(done, best, 1)
            open_ = np.where(done | np.isinf(dist), np.inf, dist)
            pick = np.argsort(open_, axis=1, kind="stable")[:, :step]
            live = np.isfinite(np.take_along_axis(open_, pick, 1))
            if not live.any():
                return place, np.maximum(dist, 0)
            done[rows, pick] |= live
            chosen = np.where(live, np.take_along_axis(place, pick, 1), n)
            links = np.concatenate([self.links, np.full((1, self.links.shape[1]), n)])[chosen].reshape(m, -1)
            fresh = links


def nearest_lists(graph: CentroidGraph, x: np.ndarray, ratio: float, least: int, most: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, list) pairs: each row's lists within the distance ratio."""
    rows, lists = [], []
    for a in range(0, len(x), 512):
        place, dist = graph.search(x[a : a + 512], beam)
        take = (np.sqrt(dist) <= ratio * np.sqrt(dist[:, :1]) + 1e-9) & np.isfinite(dist)
        take[:, :least] = np.isfinite(dist[:, :least])
        take[:, most:] = False
        r, c = np.nonzero(take)
        rows.append(r + a)
        lists.append(place[r, c])
    return np.concatenate(rows), np.concatenate(lists)


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def assign(rows: DataFrame, graph, ratio: float, least: int, most: int, beam: int) -> DataFrame:
    """rows (id long, v array) with the list of each of their postings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                r, lists = nearest_lists(graph.value, unit(matrix(b.column("v"))), ratio, least, most, beam)
                yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(r)), b.column("v").take(pa.array(r)), pa.array(lists)], names=["id", "v", "list"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("list", T.LongType())]))


def usable(df: DataFrame, vector: str, id_col: str) -> tuple[DataFrame, int]:
    """id, v of the rows that take part: no null, non-finite or zero vector, and of the commonest length only; that length."""
    v = F.col("v")
    # A zero vector of any scale: the greatest component decides, as squares of tiny ones vanish.
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v")).where(
        F.col("id").isNotNull() & v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    )
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    d = sizes[0]["d"] if sizes else -1
    return rows.where(F.size("v") == d), max(1, d)


def nearest(df: DataFrame, vector: str = "embedding", id_col: str = "vec_id", every: int = 50, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k best found for each row whose id is divisible by every, by cosine.

    Ties go to the smaller id. Vectors null, zero, of another length than most or with components null or not finite
    take no part, nor do null ids. Copies of a vector are searched once: of each only the k + 1 smallest ids can be
    among a query's k nearest, so no others are carried, which loses nothing. Of rows with a repeated id the least vector
    counts. An
    empty table gives no rows; other columns are not read.
    """
    spark = df.sparkSession
    rows, d = usable(df, vector, id_col)
    by_vector = Window.partitionBy("v").orderBy("id")
    rows = rows.groupBy("id").agg(F.min("v").alias("v"))
    few = hold(rows.withColumn("r", F.row_number().over(by_vector)).where(F.col("r") <= k + 1))
    asked = hold(rows.where(F.col("id") % every == 0))
    heads = few.where("r = 1").select("id", "v")
    n = heads.count()
    held = min(SAMPLE, SAMPLE_BYTES // (8 * d))
    lists = max(1, min(n // LIST_ROWS, held // SAMPLE_ROWS))
    held = min(held, lists * ENOUGH_ROWS)
    share = min(1.0, 1.2 * held / max(n, 1))
    sample = (heads if share == 1.0 else heads.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(share * (1 << 20)))).select("v").limit(held).toPandas()["v"]
    x = unit(np.stack(sample.to_numpy()).astype(np.float64)) if len(sample) else np.zeros((0, 1))
    lists = max(1, min(lists, len(x) // SAMPLE_ROWS))
    most = int(MAX_PROBES * max(1.0, lists / 512) ** 0.5)
    graph = spark.sparkContext.broadcast(CentroidGraph(balanced_centroids(x, lists)) if len(x) else None)
    postings = hold(assign(heads, graph, REPLICA_RATIO, 1, MAX_REPLICAS, 32))
    one = hold(asked.groupBy("v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n")))
    probes = assign(one.select("id", "v"), graph, PROBE_RATIO, MIN_PROBES, most, max(BEAM, most + most // 3))
    found = searched(*refined(postings, hold(probes), d), k + 1)
    best = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    top = found.dropDuplicates(["q", "id"]).withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).select("q", "id", "score")
    # back from distinct vectors to rows, on either side
    copies = few.select(F.col("id").alias("copy"), "v").join(heads.withColumnRenamed("id", "head"), "v").select("head", "copy")
    wide = top.join(copies, top["id"] == copies["head"]).select("q", F.struct((-F.col("score")).alias("s"), F.col("copy").alias("i")).alias("c"))
    # At most k + 1 copies of each of k + 1 vectors: one short list for all askers with the same vector.
    lists_of = wide.groupBy("q").agg(F.array_sort(F.collect_list("c")).alias("best"))
    answers = one.withColumnRenamed("id", "q").join(lists_of, "q").select("v", "n", "best")
    total = asked.count()
    own = looked_up(asked, answers, "v", "n", total).select(F.col("id").alias("query_id"), F.slice(F.filter("best", lambda c: c["i"] != F.col("id")), 1, k).alias("best"))
    return own.select("query_id", F.posexplode("best").alias("p", "c")).select("query_id", (F.col("p") + 1).alias("rank"), F.col("c.i").alias("vec_id"), (-F.col("c.s")).alias("score"))


def refined(postings: DataFrame, probes: DataFrame, d: int) -> tuple[DataFrame, DataFrame]:
    """Both with the rows of long lists dealt to lists within them, so that lists stay short however many rows there are.

    A list's centroids are fitted in one task on a bounded sample of its rows, and go to the parts of its rows and of its
    queries by a join; no task holds all centroids or a whole list.
    """
    long_ = hold(postings.groupBy("list").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > LONG_LIST))
    if long_.isEmpty():
        return postings, probes
    table = F.broadcast(long_)  # there are at most SAMPLE / SAMPLE_ROWS lists

    def fit(t: pa.Table) -> pa.Table:
        x = unit(matrix(t.column("v").combine_chunks()))
        c = balanced_centroids(x, max(1, min(t.column("n")[0].as_py() // LIST_ROWS, len(x) // SAMPLE_ROWS)))
        flat = pa.ListArray.from_arrays(pa.array(np.arange(len(c) + 1) * c.shape[1], pa.int32()), pa.array(c.ravel()))
        return pa.table({"list": pa.array(np.full(len(c), t.column("list")[0].as_py())), "inner": pa.array(np.arange(len(c))), "c": flat})

    fits = SAMPLE_BYTES // (8 * d)
    rate = F.least(F.lit(1.0), min(LIST_SAMPLE, fits) / F.col("n"))
    sample = postings.join(table, "list").where(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 20)) < rate * (1 << 20))
    centroids = hold(sample.select("list", "n", "v").groupBy("list").applyInArrow(fit, "list long, inner long, c array<double>"))
    parts = F.ceil(F.col("n") / min(INNER_ROWS, fits)).cast("int")
    spread = centroids.join(table, "list").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).select("list", "part", "inner", "c")

    def inner(rows: DataFrame, ratio: float, least: int, most: int) -> DataFrame:
        def deal(key, left: pa.Table, right: pa.Table) -> pa.Table:
            own, lists = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            if left.num_rows and right.num_rows:
                x, c = unit(matrix(left.column("v").combine_chunks())), matrix(right.sort_by("inner").column("c").combine_chunks())
                for a in range(0, len(x), 512):
                    d = np.maximum(1 + (c**2).sum(axis=1) - 2 * x[a : a + 512] @ c.T, 0)
                    m = min(most, d.shape[1])
                    some = np.argpartition(d, m - 1, axis=1)[:, :m]
                    best = np.take_along_axis(some, np.argsort(np.take_along_axis(d, some, 1), axis=1, kind="stable"), 1)
                    near = np.sqrt(np.take_along_axis(d, best, 1))
                    take = near <= ratio * near[:, :1] + 1e-9
                    take[:, :least] = True
                    r, j = np.nonzero(take)
                    own.append(r + a)
                    lists.append(best[r, j])
            own, lists = np.concatenate(own), np.concatenate(lists)
            at = pa.array(own)
            return pa.table({"id": left.column("id").take(at), "v": left.column("v").take(at), "list": pa.array((lists + 1 << 32) + (left.column("list").take(at).to_numpy() if len(own) else 0))})

        dealt = rows.join(table, "list").withColumn("part", F.pmod(F.xxhash64("id"), parts).cast("int")).select("id", "v", "list", "part")
        deeper = dealt.groupBy("list", "part").cogroup(spread.groupBy("list", "part")).applyInArrow(deal, "id long, v array<double>, list long")
        return hold(rows.join(table, "list", "left_anti").select("id", "v", "list").unionByName(deeper))

    return inner(postings, REPLICA_RATIO, 1, MAX_REPLICAS), inner(probes, INNER_RATIO, MIN_INNER, MAX_INNER)


def searched(postings: DataFrame, probes: DataFrame, k: int) -> DataFrame:
    """q, id, score: the k best of each part of each list for each query that reads it.

    A list's rows and its queries are cut into parts of bounded size; each pair of parts is a group of its own.
    """
    sizes = postings.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).cast("int").alias("np"))
    loads = probes.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / PART_QUERIES).cast("int").alias("nq"))
    plan = hold(sizes.join(loads, "list"))
    held = postings.join(plan, "list").withColumn("p", F.pmod(F.xxhash64("id"), F.col("np")).cast("int")).withColumn("u", F.explode(F.sequence(F.lit(0), F.col("nq") - 1)))
    asked = probes.join(plan, "list").withColumn("u", F.pmod(F.xxhash64("id"), F.col("nq")).cast("int")).withColumn("p", F.explode(F.sequence(F.lit(0), F.col("np") - 1)))

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        none = pa.table({"q": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not left.num_rows or not right.num_rows:
            return none
        ids = left.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], matrix(left.column("v").combine_chunks())[order]
        qids, q = right.column("id").to_numpy(), matrix(right.column("v").combine_chunks())
        rough = unit(q) @ unit(x).T
        m = min(k, rough.shape[1])
        edge = np.partition(rough, rough.shape[1] - m, axis=1)[:, rough.shape[1] - m]
        a, b = np.nonzero(rough >= edge[:, None] - 1e-9)
        # one and the same sum for each pair, whatever its neighbours in a product of matrices are
        u, v = x[b] / np.abs(x[b]).max(axis=1, keepdims=True), q[a] / np.abs(q[a]).max(axis=1, keepdims=True)
        score = (u * v).sum(axis=1) / (np.sqrt((u * u).sum(axis=1)) * np.sqrt((v * v).sum(axis=1)))
        rank = np.lexsort((ids[b], -score, a))
        a, b, score = a[rank], b[rank], score[rank]
        first = np.searchsorted(a, a)
        top = np.arange(len(a)) - first < m
        return pa.table({"q": pa.array(qids[a[top]]), "id": pa.array(ids[b[top]]), "score": pa.array(score[top])})

    keys = ["list", "p", "u"]
    return held.select(*keys, "id", "v").groupBy(*keys).cogroup(asked.select(*keys, "id", "v").groupBy(*keys)).applyInArrow(run, "q long, id long, score double")
