"""Mixing sources to target weights by Pfair scheduling.

A source whose share is w releases its j-th block at floor(j/w) and must have it scheduled by ceil((j+1)/w), in exact
fractions of the weights themselves; earliest-deadline-first over one slot a step meets all deadlines, so at any slot a
source that has not run out is less than one block from its share. The driver walks the blocks, not the rows, and keeps
the sources' counts at the start of each range of blocks; tasks schedule the ranges from there.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Mapping, Sequence
from fractions import Fraction
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import BROADCAST_ROWS, cut, hold, small_side

BLOCK_ROWS = 16
#: Blocks that the driver walks at most, some ten seconds a million; blocks of larger tables hold more rows instead.
MAX_BLOCKS = 10_000_000
PERIOD = 2_000
#: Sources are few and named by the caller's targets; this bounds what the driver holds.
MAX_SOURCES = 100_000
BUCKET_ROWS = 5_000
#: A bucket of so many times as many rows is hot.
HOT_BUCKET = 3


def walk(shares: Sequence[Fraction], blocks: Sequence[int], done: Sequence[int] | None = None, slot: int = 0) -> Iterator[tuple[int, int, int]]:
    """(source, block, slot) of each block by rising slot, from a slot at which done blocks of the sources are scheduled.

    shares sum to 1 at most. Ties go to the lesser source; slots for which no block is released stay empty.
    """
    num, den = [w.numerator for w in shares], [w.denominator for w in shares]
    done = list(done) if done is not None else [0] * len(shares)
    waiting = [(done[i] * den[i] // num[i], i) for i in range(len(shares)) if done[i] < blocks[i]]  # release, source
    heapq.heapify(waiting)
    ready: list[tuple[int, int]] = []  # deadline, source
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            _, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(done[i] + 1) * den[i] // num[i]), i))
        _, i = heapq.heappop(ready)
        yield i, done[i], slot
        done[i] += 1
        slot += 1
        if done[i] < blocks[i]:
            heapq.heappush(waiting, (done[i] * den[i] // num[i], i))


def ranges(shares: Sequence[Fraction], blocks: Sequence[int], size: int) -> Iterator[tuple[int, list[int]]]:
    """Slot, and blocks done of each source, before every size-th block."""
    done = [0] * len(shares)
    for k, (i, _, slot) in enumerate(walk(shares, blocks)):
        if k % size == 0:
            yield slot, list(done)
        done[i] += 1


def exact_shares(weights: Mapping[str, float]) -> dict[str, Fraction]:
    total = sum(map(Fraction, weights.values()))
    return {s: Fraction(w) / total for s, w in weights.items()}


def pfair_period(shares: Mapping[str, int]) -> list[tuple[str, int, int]]:
    """(source, block within the period, slot) for integer shares; the period is their sum."""
    names = sorted(shares)
    exact = exact_shares(shares)
    return [(names[i], j, t) for i, j, t in walk([exact[s] for s in names], [shares[s] for s in names])]


def integer_shares(weights: Mapping[str, float], period: int = PERIOD) -> dict[str, int]:
    """Shares of a period in proportion to the weights, one at least, by largest remainder."""
    period = max(period, 2 * len(weights))
    total = sum(weights.values())
    exact = {s: w / total * period for s, w in weights.items()}
    out = {s: max(1, int(x)) for s, x in exact.items()}
    for s in sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))[: max(0, period - sum(out.values()))]:
        out[s] += 1
    return out


def tempered(counts: Mapping[str, int], power: float = 0.5) -> dict[str, float]:
    """Weights that flatten the sources' own sizes."""
    return {s: n**power for s, n in counts.items() if n}


def mix(df: DataFrame, targets: Mapping[str, float] | None = None, source: str = "source", id_col: str = "doc_id", block_rows: int = BLOCK_ROWS, period: int = PERIOD) -> DataFrame:
    """df with mix_slot and mix_pos; sorting by both gives the mixture. All rows stay, each once.

    A task schedules period blocks, or more of very many sources. Blocks have block_rows rows, and more where there
    would be over MAX_BLOCKS of them.

    targets gives each source's weight, above 0; without it, weights are the roots of the sources' row counts. Null sources are
    a source of their own; sources without a target get the least weight given. A source that has run out leaves its
    slots empty, the others keep their order and shares. Rows of a source are dealt into blocks by a hash of the id;
    ties and repeated rows take neighbouring places in no set order. An empty table gives no rows.
    """
    if any(not 0 < w < float("inf") for w in (targets or {}).values()):
        raise ValueError("targets are positive and finite; filter out the rows of a source that is to have no share")
    spark, names = df.sparkSession, df.columns
    own = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    key, ident = F.coalesce(F.col(f"c{names.index(source)}").cast("string"), F.lit("\0null")), f"c{names.index(id_col)}"
    keyed = own.withColumn("__s", key).withColumn("__h", F.xxhash64(ident))
    counts = {r["__s"]: r["n"] for r in own.select(key.alias("__s")).groupBy("__s").agg(F.count(F.lit(1)).alias("n")).limit(MAX_SOURCES + 1).collect()}
    if len(counts) > MAX_SOURCES:
        raise ValueError(f"over {MAX_SOURCES} sources; group them first")
    weights = {s: targets.get(s, min(targets.values())) for s in counts} if targets else tempered(counts)
    shares = exact_shares(weights)
    order = sorted(counts)
    block_rows = max(block_rows, -(-sum(counts.values()) // MAX_BLOCKS))
    blocks = [-(-counts[s] // block_rows) for s in order]
    # Rows before a row in its source: those of earlier buckets and those before it in its own; buckets follow the size.
    sizes = [(s, -(-n // BUCKET_ROWS)) for s, n in counts.items()]
    plan = spark.createDataFrame(sizes, "__s string, __nb int")
    slots = scheduled(spark, order, [shares[s] for s in order], blocks, max(period, 10 * len(order)))
    slots = F.broadcast(slots) if sum(blocks) <= BROADCAST_ROWS else slots
    dealt = keyed.join(F.broadcast(plan), "__s").withColumn("__b", F.pmod("__h", F.col("__nb")).cast("int"))
    lots = own.select(key.alias("__s"), F.xxhash64(ident).alias("__h")).join(F.broadcast(plan), "__s").groupBy("__s", F.pmod("__h", F.col("__nb")).cast("int").alias("__b")).agg(F.count(F.lit(1)).alias("__n"))
    dealt, lots = without_hot_buckets(dealt, lots)
    within = F.row_number().over(Window.partitionBy("__s", "__b", "__u").orderBy("__h", ident)) - 1
    before = lots.select("__s", "__b", "__u", (F.sum("__n").over(Window.partitionBy("__s").orderBy("__b", "__u")) - F.col("__n")).alias("__before"))
    ranked = dealt.withColumn("__r", within).join(before, ["__s", "__b", "__u"]).withColumn("__r", F.col("__r") + F.col("__before"))
    placed = ranked.withColumn("__j", F.floor(F.col("__r") / block_rows)).join(slots, ["__s", "__j"])
    return placed.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], F.col("__t").alias("mix_slot"), (F.col("__r") % block_rows).cast("int").alias("mix_pos"))


def without_hot_buckets(rows: DataFrame, lots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rows and lots with __u: buckets that one id fills, or none at all, are cut into parts by their rows' places.

    Ids that are all different fill buckets about evenly, so few or none are hot. What is counted of these are the same
    held rows that are placed.
    """
    lots = cut(lots.withColumn("__u", F.lit(0).cast("long")))
    hot = lots.where(F.col("__n") > HOT_BUCKET * BUCKET_ROWS)
    rows = rows.withColumn("__u", F.lit(0).cast("long"))
    if hot.isEmpty():
        return rows, lots
    marks = small_side(hot.select("__s", "__b", F.ceil(F.col("__n") / BUCKET_ROWS).alias("__k")))
    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("__k"))
    split = hold(rows.join(marks, ["__s", "__b"]).withColumn("__u", place).drop("__k"))
    counted = split.groupBy("__s", "__b", "__u").agg(F.count(F.lit(1)).alias("__n"))
    rest = lots.join(marks.drop("__k"), ["__s", "__b"], "left_anti")
    return rows.join(marks.drop("__k"), ["__s", "__b"], "left_anti").unionByName(split), rest.unionByName(counted)


def scheduled(spark: SparkSession, names: list[str], shares: list[Fraction], blocks: list[int], size: int) -> DataFrame:
    """__s, __j, __t: the slot of each source's blocks, made in tasks of size blocks."""
    starts = spark.createDataFrame(list(ranges(shares, blocks, size)), "slot long, done array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for slot, done in zip(b.column("slot").to_pylist(), b.column("done").to_pylist()):
                i, j, t = zip(*islice(walk(shares, blocks, done, slot), size))
                yield pa.RecordBatch.from_arrays([pa.array([names[k] for k in i]), pa.array(j, pa.int64()), pa.array(t, pa.int64())], names=["__s", "__j", "__t"])

    return starts.mapInArrow(run, "__s string, __j long, __t long")


def mixed_order(df: DataFrame, targets: Mapping[str, float] | None = None, source: str = "source", id_col: str = "doc_id") -> DataFrame:
    """The rows of df in the order of the mixture, as range partitions.

    As mix(): null sources are a source, repeated rows stay each, an empty table gives no rows, names may be any.
    """
    return mix(df, targets, source, id_col).orderBy("mix_slot", "mix_pos").select(*[F.col(f"`{c}`") for c in df.columns])
