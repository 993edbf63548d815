"""Periodic runs of words: repeated k-gram masking, then Main-Lorentz on the segments that survive it.

A run of smallest period q has at least max(min_words, exponent * q) words, so all but its last q words begin a second
copy of themselves q words on: each of its words lies in a k-gram that the document repeats, where k is the least
overlap of such a run with itself shifted by its period. Words outside repeated k-grams therefore belong to no run, and
what is left are short segments. Main and Lorentz halve a segment and look for the repetitions across its middle; here
all halves of one size are worked on together, for all documents of a batch.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W

MIN_WORDS = 6
EXPONENT = 4
#: Two primes under 2^31: sums of products stay inside 64 bits.
_PRIMES = (np.uint64(2_147_483_629), np.uint64(2_147_483_587))
_MIX = np.uint64(0x9E3779B97F4A7C15)

RUN = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("period", T.LongType())])


def least_overlap(min_words: int = MIN_WORDS, exponent: int = EXPONENT) -> int:
    """The least number of words that a run shares with itself shifted by its period."""
    return min(max(min_words, exponent * q) - q for q in range(1, min_words + 1))


def _ranges(sizes: np.ndarray) -> np.ndarray:
    """0..size-1 of each size, one after the other."""
    total = np.cumsum(sizes)
    return np.arange(total[-1] if len(total) else 0) - np.repeat(total - sizes, sizes)


def _grams(codes: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit mixture of the k codes from each place on, for as many places as have so many."""
    n = max(0, len(codes) - k + 1)
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h = (h ^ (codes[i : i + n].astype(np.uint64) + np.uint64(1))) * _MIX
        h ^= h >> np.uint64(29)
    return h


def surviving(codes: np.ndarray, doc_start: np.ndarray, k: int) -> np.ndarray:
    """Which words lie in a k-gram that occurs twice or more in their own document.

    k-grams count as the same by 64 bits; an accidental match only lets a word through that later finds no run.
    """
    inside = np.zeros(len(codes) + 1, np.int32)
    grams = _grams(codes, k)
    if not len(grams):
        return inside[:-1] > 0
    doc = np.repeat(np.arange(len(doc_start) - 1), np.diff(doc_start))
    at = np.flatnonzero(doc[: len(grams)] == doc[k - 1 :])  # those that do not reach into the next document
    key = (grams[at] ^ (doc[at].astype(np.uint64) + np.uint64(1)) * _MIX) * _MIX
    order = np.argsort(key)
    ranked = key[order]
    same = np.flatnonzero(ranked[1:] == ranked[:-1])
    twice = np.zeros(len(at), bool)
    twice[order[same]] = twice[order[same + 1]] = True
    np.add.at(inside, at[twice], 1)
    np.add.at(inside, np.minimum(at[twice] + k, len(codes)), -1)
    return np.cumsum(inside[:-1]) > 0


class Equal:
    """How far two places of one sequence of codes agree, forwards and backwards, by halving over two 31-bit checksums."""

    def __init__(self, codes: np.ndarray, attempt: int):
        n = len(codes)
        rng = np.random.default_rng(11 + attempt)
        self.codes, self.sums, self.powers = codes, [], []
        for prime in _PRIMES:
            base = np.uint64(rng.integers(1 << 20, 1 << 30))
            small, large = np.ones(4096, np.uint64), np.ones((n >> 12) + 2, np.uint64)
            for i in range(1, 4096):
                small[i] = small[i - 1] * base % prime
            step = small[-1] * base % prime
            for i in range(1, len(large)):
                large[i] = large[i - 1] * step % prime
            self.powers.append((small, large))
            sums = np.zeros(n + 1, np.uint32)
            last = np.uint64(0)
            for a in range(0, n, 1 << 18):
                i = np.arange(a, min(n, a + (1 << 18)))
                terms = (codes[i].astype(np.uint64) + np.uint64(1)) % prime * (small[i & 4095] * large[i >> 12] % prime) % prime
                run = (np.cumsum(terms, dtype=np.uint64) + last) % prime
                sums[i + 1] = run
                last = run[-1]
            self.sums.append(sums)

    def same(self, a: np.ndarray, period: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether codes[a:a+size] and the same period further on agree."""
        out = np.ones(len(a), bool)
        for prime, sums, (small, large) in zip(_PRIMES, self.sums, self.powers):
            here = (sums[a + size].astype(np.uint64) + prime - sums[a].astype(np.uint64)) % prime
            there = (sums[a + period + size].astype(np.uint64) + prime - sums[a + period].astype(np.uint64)) % prime
            out &= here * (small[period & 4095] * large[period >> 12] % prime) % prime == there
        return out

    def extent(self, a: np.ndarray, period: np.ndarray, most: np.ndarray, back: bool = False) -> np.ndarray:
        """The largest size up to most for which codes[a:a+size], or codes[a-size:a], recur a period further on."""
        lo, hi = np.zeros(len(a), np.int64), np.maximum(most, 0)
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            size = (lo[open_] + hi[open_] + 1) >> 1
            ok = self.same(a[open_] - size if back else a[open_], period[open_], size)
            lo[open_[ok]] = size[ok]
            hi[open_[~ok]] = size[~ok] - 1


def _across(codes: np.ndarray, grams: np.ndarray, equal: Equal, seg_lo: np.ndarray, seg_hi: np.ndarray, half: int, k: int, exponent: int, right: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of what repeats across the middle of each block of 2 * half words, inside the block.

    A run across the middle has half of its exponent, two periods or more, on one side; right says on which to look.
    """
    blocks = np.maximum(0, -(-(seg_hi - seg_lo - half) // (2 * half)))
    lo = np.repeat(seg_lo, blocks) + _ranges(blocks) * 2 * half
    end = np.repeat(seg_hi, blocks)
    mid = lo + half
    hi = np.minimum(mid + half, end)
    side = (hi - mid if right else mid - lo) // (exponent // 2)
    p = _ranges(side) + 1
    lo, mid, hi = (np.repeat(x, side) for x in (lo, mid, hi))
    at = mid if right else mid - 2 * p
    ok = codes[at] == codes[at + p]
    deep = ok & (p >= k)
    if deep.any():
        i = np.flatnonzero(deep)
        ok[i] = grams[at[i]] == grams[at[i] + p[i]]
    lo, mid, hi, p = (x[ok] for x in (lo, mid, hi, p))
    if right:
        a, b = equal.extent(mid, p, mid - lo, back=True), equal.extent(mid, p, hi - mid - p)
        ok = b >= p
        return (mid - a)[ok], (mid + p + b)[ok], p[ok]
    a, b = equal.extent(mid - p, p, mid - p - lo, back=True), equal.extent(mid - p, p, hi - mid)
    ok = a >= p
    return (mid - p - a)[ok], (mid + b)[ok], p[ok]


def find_runs(codes: np.ndarray, doc_start: np.ndarray, min_words: int = MIN_WORDS, exponent: int = EXPONENT) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length, period) of all runs, in that order, and which words were searched.

    Found intervals are compared word by word in the end; should a checksum have lied, all is done again with others.
    """
    k = least_overlap(min_words, exponent)
    searched = surviving(codes, doc_start, k)
    doc = np.repeat(np.arange(len(doc_start) - 1), np.diff(doc_start))
    goes_on = np.zeros(len(codes) + 1, bool)  # whether a word and the one before belong together
    goes_on[1:-1] = searched[1:] & searched[:-1] & (doc[1:] == doc[:-1])
    seg_lo, seg_hi = np.flatnonzero(searched & ~goes_on[:-1]), np.flatnonzero(searched & ~goes_on[1:]) + 1
    long = seg_hi - seg_lo >= min_words
    seg_lo, seg_hi = seg_lo[long], seg_hi[long]
    none = np.zeros(0, np.int64)
    if not len(seg_lo):
        return none, none, none, none, searched
    # the surviving segments alone, one after the other
    size = seg_hi - seg_lo
    place = np.repeat(seg_lo, size) + _ranges(size)
    own = codes[place]
    hi = np.cumsum(size)
    lo = hi - size
    grams = np.concatenate([_grams(own, k), np.zeros(k, np.uint64)])
    for attempt in range(8):
        found = _segment_runs(own, grams, lo, hi, k, min_words, exponent, attempt)
        if found is not None:
            break
    else:
        raise RuntimeError("checksums of word sequences failed eight times")
    start, end, period = found
    whole = place[start]
    of = doc[whole]
    order = np.lexsort((period, whole, of))
    return of[order], (whole - doc_start[of])[order], (end - start)[order], period[order], searched


def _segment_runs(codes: np.ndarray, grams: np.ndarray, lo: np.ndarray, hi: np.ndarray, k: int, min_words: int, exponent: int, attempt: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(start, end, period) of the runs inside lo:hi; none if a checksum was the same for different words."""
    equal, parts, half = Equal(codes, attempt), [], 1
    while 2 * half < min_words:
        half *= 2
    while half < (hi - lo).max():
        some = hi - lo > half
        parts += [_across(codes, grams, equal, lo[some], hi[some], half, k, exponent, right) for right in (True, False)]
        half *= 2
    start, end, period = (np.concatenate([p[i] for p in parts]) for i in range(3)) if parts else (np.zeros(0, np.int64),) * 3
    ok = end - start >= np.maximum(min_words, exponent * period)
    start, end, period = start[ok], end[ok], period[ok]
    # those that go on outside their block are found whole in a larger one
    first, last = lo[np.searchsorted(lo, start, side="right") - 1], hi[np.searchsorted(hi, end)]
    ok = ~((start > first) & (codes[start - 1] == codes[start - 1 + period])) & ~((end < last) & (codes[np.minimum(end, len(codes) - 1)] == codes[end - period]))
    start, end, period = start[ok], end[ok], period[ok]
    # of one interval's periods the smallest counts
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    for a, b, p in zip(start.tolist(), end.tolist(), period.tolist()):
        if not np.array_equal(codes[a : b - p], codes[a + p : b]):
            return None
    return start, end, period


def collapsed_words(n: int, doc_start: np.ndarray, doc: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of n words stay when each run keeps its first period only."""
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, doc_start[doc] + start + period, 1)
    np.add.at(cover, doc_start[doc] + start + length, -1)
    return np.cumsum(cover[:-1]) == 0


def repeat_tail(codes: np.ndarray, doc_start: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """codes in which the documents with a seed that ends in 0 repeat from some word on, by the rest g of the seed.

    Word i >= a becomes word a + (i - a) % p, where a = g % n and p = 1 + (n - a) // (3 + g % 8).
    """
    out = codes.copy()
    for d in np.flatnonzero((seeds >= 0) & (seeds % 10 == 0) & (np.diff(doc_start) > 0)).tolist():
        lo, n, g = int(doc_start[d]), int(doc_start[d + 1] - doc_start[d]), int(seeds[d]) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        i = np.arange(a, n)
        out[lo + i] = codes[lo + a + (i - a) % p]
    return out


def joined_words(w: W.Words, codes: np.ndarray, doc_start: np.ndarray) -> pa.Array:
    """The words of each document, joined by one space."""
    lists = pa.LargeListArray.from_arrays(pa.array(doc_start, pa.int64()), w.vocab.take(pa.array(codes)))
    return pc.binary_join(lists, pa.scalar(b" ", pa.large_binary())).cast(pa.large_string())


def periodic_runs(df: DataFrame, text: str = "text", id_col: str = "doc_id", min_words: int = MIN_WORDS, exponent: int = EXPONENT, repeated_tails: bool = False) -> DataFrame:
    """id_col, n_words, n_searched, runs (start, length, period) by start and period, and the collapsed text of each row.

    Words are `[^\\x20\\x09-\\x0D]+`. A run is a stretch of at least max(min_words, exponent * period) words in which
    words one smallest period apart are the same, and which no neighbour extends. The collapsed text has the words,
    joined by one space, that no run contains after its first period. n_searched words survive the mask. With
    repeated_tails, one in ten documents by the checksum of its id is changed to end in repetitions first; null ids are
    not. min_words is 2 or more and exponent 4 or more.

    Null and empty texts have no words, no runs and an empty collapsed text. Rows with null or repeated ids are taken
    one by one, each for itself. A document is searched whole, in the task that has its row, whatever its length. An
    empty table gives no rows. Columns other than the two named are not read.
    """
    if min_words < 2 or exponent < 4:
        raise ValueError("a run has two words and four periods at least")
    source = W.lean(df).select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text}`").cast("string").alias("__text"))
    fields = [T.StructField(id_col, source.schema["__id"].dataType), T.StructField("n_words", T.LongType()), T.StructField("n_searched", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())]
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in W.slices(batches, "__text"):
            w = W.split_words(b.column("__text"))
            codes = w.codes.astype(np.int64)
            if repeated_tails:
                seeds = np.array([-1 if i is None else zlib.crc32(str(i).encode()) for i in b.column("__id").to_pylist()], np.int64)
                codes = repeat_tail(codes, w.doc_start, seeds)
            doc, start, length, period, searched = find_runs(codes, w.doc_start, min_words, exponent)
            keep = collapsed_words(len(codes), w.doc_start, doc, start, length, period)
            kept = np.concatenate([[0], np.cumsum(keep)])[w.doc_start]
            runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], fields=list(run_type))
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(w.n_docs + 1)), pa.int32()), runs)
            columns = [b.column("__id"), pa.array(w.counts(), pa.int64()), pa.array(W.sums_by_doc(searched, w.doc_start), pa.int64()), lists, joined_words(w, codes[keep], kept).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return source.mapInArrow(run, T.StructType(fields))


def run_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row for each of periodic_runs: the longest run, how many there are, and checksums of all and of the text."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    # the greatest length, then the smallest start and period
    best = F.reduce("runs", F.element_at("runs", 1), lambda a, r: F.when((r["length"] > a["length"]) | ((r["length"] == a["length"]) & ((r["start"] < a["start"]) | ((r["start"] == a["start"]) & (r["period"] < a["period"])))), r).otherwise(a))
    some = found.withColumn("__best", F.when(F.size("runs") > 0, best))
    return some.select(
        F.col(f"`{id_col}`"), F.size("runs").cast("long").alias("n_runs"),
        *[F.col("__best")[x].alias(x) for x in ("start", "length", "period")],
        F.expr("1000 * __best.length div __best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
        "n_words", "n_searched",
    )
