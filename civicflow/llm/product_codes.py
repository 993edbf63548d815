"""Product codes of vectors: codebooks fitted over columnar blocks, with sums and counts that merge in a reduction tree.

Vectors become integers, so that every sum and distance is exact and no order of merging changes a result. A block
holds some thousand vectors by component: for each component one array over all its vectors. Distances to the entries
of a codebook add up component by component, and each round's sums and counts come to the driver through treeAggregate
as one small tensor, whose size depends on the codebooks alone.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .storage import cut, hold, looked_up

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Integer components that one block holds at most; it bounds what a task has in memory.
BLOCK_VALUES = 1 << 18
#: Components below this give distances and sums within 64 bits for as many as 2^12 of them in a vector; larger ones are worked out with Python's integers.
SAFE = 1 << 24


@dataclass
class Codebooks:
    """entries[k] holds part k's entries, by entry and component of the part; bounds cut a vector into parts."""

    entries: list[np.ndarray]
    bounds: list[int]

    @property
    def dim(self) -> int:
        return self.bounds[-1]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(x)) for e in self.entries for x in e.ravel()).encode()).hexdigest()


def integers(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of each, as 64-bit integers, or as Python's where some are large."""
    values = values.astype(np.float64)
    with np.errstate(over="ignore"):
        scaled = np.floor(values * scale)
    if not len(values.ravel()) or np.abs(scaled).max() < SAFE:
        return scaled.astype(np.int64)
    whole = [int(x) * scale if abs(x) > 2.0**52 else math.floor(x * scale) for x in values.ravel().tolist()]
    return np.array(whole, object).reshape(values.shape)


def part_bounds(dim: int, parts: int) -> list[int]:
    """Where consecutive parts begin and the last ends; equal ones if parts divides dim, else the first are one longer."""
    size, more = divmod(dim, parts)
    return [k * size + min(k, more) for k in range(parts + 1)]


def nearest_entries(columns: np.ndarray, books: Codebooks) -> tuple[np.ndarray, np.ndarray]:
    """(codes, distances) by part and vector of a block with one row a component; ties go to the lower entry."""
    n, parts = columns.shape[1], len(books.entries)
    codes, least = np.zeros((parts, n), np.int64), np.zeros((parts, n), columns.dtype)
    for k, entries in enumerate(books.entries):
        own = columns[books.bounds[k] : books.bounds[k + 1]]
        distance = np.zeros((len(entries), n), np.result_type(columns, entries) if entries.dtype != object else object)
        for d in range(len(own)):
            off = own[d][None, :] - entries[:, d][:, None]
            distance += off * off
        codes[k] = distance.argmin(axis=0)
        found = np.take_along_axis(distance, codes[k][None, :], 0)[0]
        if found.dtype == object and least.dtype != object:
            least = least.astype(object)
        least[k] = found
    return codes, least


def add_block(total: tuple[list[np.ndarray], np.ndarray], columns: np.ndarray, books: Codebooks) -> tuple[list[np.ndarray], np.ndarray]:
    """total (sums by part, entry and component; counts by part and entry) with a block's vectors added in place."""
    sums, counts = total
    codes, _ = nearest_entries(columns, books)
    for k in range(len(sums)):
        own = columns[books.bounds[k] : books.bounds[k + 1]]
        if own.dtype == object and sums[k].dtype != object:
            sums[k] = sums[k].astype(object)
        np.add.at(sums[k], codes[k], own.T)
        np.add.at(counts[k], codes[k], 1)
    return sums, counts


def merge(a: tuple[list[np.ndarray], np.ndarray], b: tuple[list[np.ndarray], np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    return [x + y for x, y in zip(a[0], b[0])], a[1] + b[1]


def fit(blocks: RDD, first: Codebooks, rounds: int = ROUNDS, depth: int = 2) -> Codebooks:
    """Codebooks after some rounds of assigning all vectors and moving each entry to the floor of its vectors' mean.

    blocks are arrays of one row a component. An entry that no vector takes stays where it is.
    """
    books = first
    for _ in range(rounds):
        now = books

        def zero() -> tuple[list[np.ndarray], np.ndarray]:
            return [np.zeros(e.shape, np.int64) for e in now.entries], np.zeros((len(now.entries), len(now.entries[0])), np.int64)

        # the empty tensor is made where a partition begins, so that partitions never add into one that they share
        sums, counts = blocks.treeAggregate(None, lambda t, c, now=now, zero=zero: add_block(t or zero(), c, now), lambda a, b: merge(a, b) if a and b else a or b, depth) or zero()
        entries = []
        for k, e in enumerate(now.entries):
            used = counts[k] > 0
            moved = (e if sums[k].dtype != object else e.astype(object)).copy()
            moved[used] = sums[k][used] // counts[k][used][:, None]
            entries.append(smaller(moved))
        books = Codebooks(entries, now.bounds)
    return books


def smaller(values: np.ndarray) -> np.ndarray:
    """64-bit integers where all are small enough for these."""
    return values.astype(np.int64) if values.dtype == object and all(abs(x) < SAFE for x in values.ravel()) else values


def column_blocks(df: DataFrame, vector: str, dim: int, scale: int = SCALE, block_values: int = BLOCK_VALUES) -> DataFrame:
    """One row for each block: its vectors' integers by component, as bytes of 64-bit ones or as decimal text."""
    rows = max(1, block_values // max(1, dim))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = b.column(0).flatten().to_numpy(zero_copy_only=False)
            for a in range(0, b.num_rows, rows):
                own = integers(values[a * dim : (a + rows) * dim].reshape(-1, dim), scale).T
                plain = own.dtype == np.int64
                data = np.ascontiguousarray(own).tobytes() if plain else ",".join(map(str, own.ravel().tolist())).encode()
                yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary()), pa.array([plain])], names=["data", "plain"])

    return W.lean(df).select(F.col(vector)).mapInArrow(run, "data binary, plain boolean")


def block_arrays(blocks: DataFrame, dim: int) -> RDD:
    def array(row) -> np.ndarray:
        flat = np.frombuffer(row["data"], np.int64) if row["plain"] else np.array([int(x) for x in bytes(row["data"]).split(b",")], object)
        return flat.reshape(dim, -1)

    return blocks.rdd.map(array)


def product_codes(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, Codebooks]:
    """(rows, codebooks): id_col, label, code and error of each vector that has only finite components, and what they refer to.

    Components become floor(scale * x); vectors are cut into equal consecutive parts. A part's codebook starts as that
    part of the vectors with the smallest ids, ascending, and is fitted in rounds over all vectors. code has two hex
    digits for each part's entry, error is the squared distance summed over parts (null where it exceeds 64 bits; the
    code is right all the same).

    Rows whose vector is null or holds a null, a NaN or an infinity are dropped. Repeated ids and vectors count once a
    row; of one id the lesser vector comes first, and null ids come last. With fewer vectors than entries codebooks are
    that short. Where parts does not divide the length, the first parts are one longer; a length under parts is refused.
    Vectors of another length than the one with the smallest id take no part: their code and error are null. An empty
    table, or one without finite vectors, gives no rows and empty codebooks. Other columns are not read.
    """
    if not (0 < entries <= 256 and parts > 0):
        raise ValueError("codes have two hex digits a part")
    v = F.col("__v")
    source = df.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{vector}`").alias("__v"), F.col(f"`{label}`").alias("__label"))
    number = source.schema["__v"].dataType.elementType
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) if isinstance(number, (T.FloatType, T.DoubleType)) else F.exists(v, lambda x: x.isNull())
    source = source.where(v.isNotNull() & ~F.coalesce(bad, F.lit(False)))
    order = [F.asc_nulls_last("__id"), F.asc("__v")]
    first = source.orderBy(*order).limit(1).collect()
    schema = T.StructType([T.StructField(id_col, source.schema["__id"].dataType), T.StructField("label", source.schema["__label"].dataType), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if not first:
        return df.sparkSession.createDataFrame([], schema), Codebooks([], [0])
    dim = len(first[0]["__v"])
    if dim < parts:
        raise ValueError(f"vectors of {dim} components have no {parts} parts")
    whole = source.where(F.size(v) == dim)
    start = integers(np.array([r["__v"] for r in whole.orderBy(*order).limit(entries).collect()], np.float64), scale)
    bounds = part_bounds(dim, parts)
    books = Codebooks([smaller(start[:, bounds[k] : bounds[k + 1]]) for k in range(parts)], bounds)
    blocks = hold(column_blocks(whole, "__v", dim, scale))
    books = fit(block_arrays(blocks, dim), books, rounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("__v")
            size = np.diff(lists.offsets.to_numpy()) if b.num_rows else np.zeros(0, np.int64)
            same = np.flatnonzero(size == dim)
            code, error = np.full(b.num_rows, None, object), np.full(b.num_rows, None, object)
            step = max(1, BLOCK_VALUES // dim)
            for a in range(0, len(same), step):
                own = same[a : a + step]
                values = lists.take(pa.array(own)).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                codes, least = nearest_entries(integers(values, scale).T, books)
                text = np.ascontiguousarray(codes.T).astype(np.uint8).tobytes().hex()
                code[own] = [text[i : i + 2 * parts] for i in range(0, len(text), 2 * parts)]
                error[own] = [e if e < 1 << 63 else None for e in map(int, least.sum(axis=0))]
            yield pa.RecordBatch.from_arrays([b.column("__id"), b.column("__label"), pa.array(code, pa.string()), pa.array(error, pa.int64())], names=[id_col, "label", "code", "error"])

    return W.lean(source).mapInArrow(run, schema), books


def with_label_errors(coded: DataFrame) -> DataFrame:
    """coded and label_error, its errors summed by label, nulls together; a label may have most of all rows."""
    held = hold(coded)
    rows = held.withColumn("__label", F.struct(F.col("label").isNull(), "label"))
    sums = cut(rows.groupBy("__label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("__n")))
    return looked_up(rows, sums, "__label", "__n", held.count()).drop("__label")
