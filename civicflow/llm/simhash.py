"""Near-duplicates by SimHash with bit-sliced comparison.

Fingerprints that agree on the bits of a mask meet in a bucket. There they are stored as vertical bit planes, so that
one word operation compares 64 pairs; carry-save counters hold all 64 distances, and a block of pairs is left as soon
as all of them exceed the radius. A bucket gives its spanning links only, so a group of n copies gives n - 1 of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.chains import components
from . import words as W
from .storage import BROADCAST_ROWS, cut, hold, looked_up, small_side
from .url_filter import BITS_PER_URL, MAX_BLOCKS, WORDS, bit, bloom_blocks, hashed

SEED = 42
#: Larger buckets are split into parts that meet pair by pair, each in a task of its own.
PART = 2048
#: In buckets over so many rows, a few rows are first compared with all: whatever is near one of them needs no more.
PIVOT_ROWS, PIVOTS = 64, 8
ONE = np.uint64(1)


def shingle_hashes(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of the n-word shingles of all texts, A-Z lower-cased, and the number of shingles of each text."""
    from xxhash import xxh64_intdigest as xxh

    w = W.split_words(texts, lower=True)
    at = np.zeros(len(w.start) + 1, np.int64)
    np.cumsum(w.end - w.start + 1, out=at[1:])
    spaced = np.full(at[-1], 32, np.uint8)
    letters = np.ones(len(spaced), bool)
    letters[at[1:] - 1] = False
    spaced[letters] = w.data[W.SPACED[w.data] > 0]
    count = w.counts()
    shingles = np.where(count > 0, np.maximum(count - n + 1, 1), 0)
    doc = np.repeat(np.arange(len(count)), shingles)
    first = w.doc_start[:-1][doc] + np.arange(len(doc)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    last = np.minimum(first + n, w.doc_start[1:][doc])
    raw = spaced.tobytes()
    return np.fromiter((xxh(raw[a:b], SEED) for a, b in zip(at[first].tolist(), (at[last] - 1).tolist())), np.uint64, len(first)), shingles


#: Odd, so that no byte's share is lost.
BASE = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(w: W.Words) -> np.ndarray:
    length = w.end - w.start
    if not len(length):
        return np.zeros(0, np.uint64)
    first = np.cumsum(length) - length
    power = np.cumprod(np.full(int(length.max()), BASE, np.uint64))
    place = np.arange(int(length.sum())) - np.repeat(first, length)
    return mixed(np.add.reduceat((w.data[W.SPACED[w.data] > 0].astype(np.uint64) + ONE) * power[place], first), 2)


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's different n-word shingles, rising, and their number; A-Z lower-cased.

    Words are hashed by polynomials of their bytes and shingles by their words' hashes, whole arrays at a time.
    """
    w = W.split_words(texts, lower=True)
    own = word_hashes(w)
    count = w.counts()
    size = np.where(count > 0, np.maximum(count - n + 1, 1), 0)
    doc = np.repeat(np.arange(len(count)), size)
    first = w.doc_start[:-1][doc] + np.arange(len(doc)) - np.repeat(np.cumsum(size) - size, size)
    words = np.minimum(n, count)[doc]
    hashes = words.astype(np.uint64)
    for k in range(n):
        some = words > k
        hashes[some] = (hashes[some] + own[first[some] + k]) * BASE
    hashes = mixed(hashes, 1)
    ends = np.cumsum(size)
    sets = [np.unique(hashes[e - c : e]) for e, c in zip(ends.tolist(), size.tolist())]
    return np.concatenate(sets) if sets else hashes, np.array([len(x) for x in sets], np.int64)


def bit_counts(hashes: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    """How many of each text's hashes set each of the 64 bits; every text has one at least.

    Eight bits are summed at a time in the bytes of a word, over runs of 255 hashes at most, so that no byte overflows.
    """
    runs = -(-shingles // 255)
    first = np.repeat(np.cumsum(shingles) - shingles, runs)
    run_start = first + 255 * (np.arange(len(first)) - np.repeat(np.cumsum(runs) - runs, runs))
    counts = np.zeros((len(first), 64), np.int64)
    for k in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & np.uint64(0x0101010101010101), run_start)
        counts[:, k::8] = lanes.astype("<u8").view(np.uint8).reshape(-1, 8)
    return np.add.reduceat(counts, np.cumsum(runs) - runs, axis=0)


def mixed(hashes: np.ndarray, k: int) -> np.ndarray:
    """The k-th 64 further bits of each hash; k = 0 gives the hash."""
    if not k:
        return hashes
    x = hashes + np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(hashes: np.ndarray, shingles: np.ndarray, width: int = 1) -> np.ndarray:
    """width words of 64 bits a text; a bit is 1 if set in over half of the text's hashes; no hashes give 0."""
    out = np.zeros((len(shingles), width), np.uint64)
    some = np.flatnonzero(shingles)
    if len(some):
        for k in range(width):
            ones = 2 * bit_counts(mixed(hashes, k), shingles[some]) > shingles[some, None]
            out[some, k] = np.packbits(ones, axis=1, bitorder="little").view("<u8").ravel()
    return out


def names_of(width: int) -> list[str]:
    return [f"f{k}" for k in range(width)]


def fingerprint_table(df: DataFrame, n: int, text: str, keep: list[str], width: int = 1) -> DataFrame:
    """keep (renamed k0, k1, ...) and the fingerprint's words f0, f1, ... as signed longs. Null text is empty, so 0."""
    source = W.lean(df).select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").cast("string").alias("__text"))
    kept, words = source.schema.fields[:-1], names_of(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in W.slices(batches, "__text"):
            fp = fingerprints(*shingle_hashes(b.column("__text"), n), width).view(np.int64)
            yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in kept], *[pa.array(np.ascontiguousarray(fp[:, k])) for k in range(width)]], names=[*[f.name for f in kept], *words])

    return source.mapInArrow(run, T.StructType([*kept, *[T.StructField(w, T.LongType()) for w in words]]))


class UnionFind:
    """Labels of 0..n-1, joined by arrays of pairs; gives the pairs that joined something."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        r = self.parent[x]
        while True:
            up = self.parent[r]
            if (up == r).all():
                return r
            r = up

    def join(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Indexes of the pairs used."""
        used = []
        left = np.arange(len(a))
        while len(left):
            ra, rb = self.roots(a[left]), self.roots(b[left])
            left = left[ra != rb]
            if not len(left):
                break
            hi, lo = np.maximum(ra, rb)[ra != rb], np.minimum(ra, rb)[ra != rb]
            _, first = np.unique(hi, return_index=True)  # each root is hung once a round, always under a lesser one
            self.parent[hi[first]] = lo[first]
            used.append(left[first])
        self.parent = self.roots(np.arange(len(self.parent)))
        return np.concatenate(used) if used else np.zeros(0, np.int64)


def close_links(group_end: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning pairs of rows of the same group at most radius bits apart; row i's group ends before group_end[i].

    fps has a row of 64-bit words for each row. A shift s lines row i up with row i + s: one word of a plane and the
    word s bits on differ where those pairs do. The counters start so that they run over at radius + 1 differences.
    """
    n, width = fps.shape
    words = -(-n // 64)
    planes = np.zeros((64 * width, words + 1), np.uint64)
    for j in range(64 * width):
        bits = np.packbits(((fps[:, j // 64] >> np.uint64(j % 64)) & ONE).astype(bool), bitorder="little")
        planes[j, :words].view(np.uint8)[: len(bits)] = bits
    run = group_end - np.arange(n)
    cells = np.zeros(words * 64, np.int64)
    cells[:n] = run
    cells = cells.reshape(words, 64)
    longest = cells.max(axis=1, initial=0)
    digits = (radius + 1).bit_length() if radius & (radius + 1) else radius.bit_length()
    start = (1 << digits) - (radius + 1)
    groups, found_a, found_b = UnionFind(n), [], []
    for shift in range(1, int(run.max(initial=1))):
        q, r = divmod(shift, 64)
        live = np.flatnonzero(longest > shift)
        if not len(live):
            break
        valid = np.packbits(cells[live] > shift, axis=1, bitorder="little").view(np.uint64).ravel()
        over = np.zeros(len(live), np.uint64)
        counter = [np.full(len(live), ~np.uint64(0) if start >> k & 1 else np.uint64(0)) for k in range(digits)]
        near, far = np.minimum(live + q, words), np.minimum(live + q + 1, words)
        for j in range(64 * width):
            p = planes[j]
            other = p[near] if not r else (p[near] >> np.uint64(r)) | (p[far] << np.uint64(64 - r))
            carry = p[live] ^ other
            for k in range(digits):
                counter[k], carry = counter[k] ^ carry, counter[k] & carry
            over |= carry
            if j % 8 == 7:
                alive = (valid & ~over) != 0
                if not alive.all():
                    live, near, far, valid, over = live[alive], near[alive], far[alive], valid[alive], over[alive]
                    counter = [c[alive] for c in counter]
                    if not len(live):
                        break
        if len(live):
            hit = np.unpackbits((valid & ~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            at, lane = np.nonzero(hit)
            a = live[at] * 64 + lane
            used = groups.join(a, a + shift)
            found_a.append(a[used])
            found_b.append(a[used] + shift)
    if not found_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_a), np.concatenate(found_b)


def bucket_links(group_end: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that chain the rows of each group as all its pairs at most radius bits apart do.

    In long groups a few pivots are compared with every row. Rows that hang together through pivots need not meet each
    other: of the largest such set none do, and all others go on, to be compared with all rows. A group of near copies
    is linear then.
    """
    n = len(fps)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = np.concatenate([[0], np.flatnonzero(group_end[1:] != group_end[:-1]) + 1])
    order, end = np.arange(n), group_end.copy()
    found_a, found_b = [], []
    for a, b in zip(start.tolist(), group_end[start].tolist()):
        if b - a <= PIVOT_ROWS:
            continue
        hung, pivots, free = UnionFind(b - a), [], np.ones(b - a, bool)
        while len(pivots) < PIVOTS and free.any():
            p = int(free.argmax())
            near = np.bitwise_count(fps[a:b] ^ fps[a + p]).sum(axis=1) <= radius
            other = np.flatnonzero(near)
            other = other[other != p]
            hung.join(np.full(len(other), p), other)
            found_a.append(np.full(len(other), a + p))
            found_b.append(a + other)
            pivots.append(p)
            free &= ~near
        label = hung.parent
        apart = label != np.bincount(label).argmax()
        apart[pivots] = False
        left = np.flatnonzero(apart)
        order[a:b] = a + np.concatenate([left, np.flatnonzero(~apart)])
        end[a + len(left) : b] = np.arange(a + len(left), b) + 1
    a, b = close_links(end, fps[order], radius)
    return np.concatenate([*found_a, order[a]]).astype(np.int64), np.concatenate([*found_b, order[b]]).astype(np.int64)


def by_group(batches: Iterator[pa.RecordBatch], key: str, rows: int) -> Iterator[pa.Table]:
    """Tables of about rows rows from batches sorted by key, never cutting a group."""
    held: list[pa.RecordBatch] = []
    n = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        n += b.num_rows
        if n < rows:
            continue
        whole = pa.Table.from_batches(held).combine_chunks()
        keys = whole.column(key).to_numpy()
        cut_at = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
        if cut_at:
            yield whole.slice(0, cut_at)
        rest = whole.slice(cut_at)
        held, n = rest.to_batches(), rest.num_rows
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def group_ends(keys: np.ndarray) -> np.ndarray:
    edge = np.append(np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys))
    return np.repeat(edge, np.diff(np.concatenate([[0], edge])))


def in_parts(rows: DataFrame, key: str, spread: str, part: int) -> DataFrame:
    """rows with __g: the key, or for keys of over part rows a pair of their parts; any two rows of a key share a __g.

    __g is a hash: keys that collide are compared together, which does no harm.
    """
    large = small_side(rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > part))
    sized = rows.join(large, key, "left").withColumn("__parts", F.coalesce(F.ceil(F.col("__n") / part).cast("int"), F.lit(1)))
    sized = sized.withColumn("__own", F.pmod(F.xxhash64(spread, F.lit(7)), F.col("__parts")).cast("int"))
    paired = sized.withColumn("__o", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)))
    return paired.withColumn("__g", F.when(F.col("__parts") == 1, F.col(key)).otherwise(F.xxhash64(key, F.least("__own", "__o"), F.greatest("__own", "__o")))).drop("__n", "__parts", "__own", "__o")


def exact_masks(radius: int, n: int) -> list[list[int]]:
    """Lists of bits so that any two fingerprints within the radius agree on one: of radius + 1 bands, one is equal.

    Over about a million fingerprints each rest is cut into bands again, for longer lists and smaller buckets.
    """

    def bands(bits: list[int]) -> list[list[int]]:
        edges = [len(bits) * i // (radius + 1) for i in range(radius + 2)]
        return [bits[a:b] for a, b in zip(edges, edges[1:])]

    every = list(range(64))
    if n <= 1 << 20:
        return bands(every)
    return [b + c for b in bands(every) for c in bands([x for x in every if x not in b])]


def bucket_keys(masks: list[list[int]], width: int) -> Column:
    """Array of a hash for each mask of the fingerprint's bits under it."""

    def under(bits: list[int], k: int) -> Column:
        m = sum(1 << (b - 64 * k) for b in bits if b // 64 == k)
        return F.col(f"f{k}").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m).cast("long"))

    return F.array(*[F.xxhash64(F.lit(i), *[under(bits, k) for k in range(width)]) for i, bits in enumerate(masks)])


def links(prints: DataFrame, radius: int, masks: list[list[int]], width: int = 1) -> DataFrame:
    """Spanning links a, b of ids whose fingerprints share a mask's bits and are within the radius.

    prints has a long id and f0, f1, ... of each; ids are distinct.
    """
    words = names_of(width)
    keyed = prints.select("id", *words, F.explode(bucket_keys(masks, width)).alias("__k"))
    rows = in_parts(keyed, "__k", "id", PART).select("__g", "id", *words)

    return compared(rows, radius, width).distinct()


def compared(rows: DataFrame, radius: int, width: int) -> DataFrame:
    """Links a, b that chain the ids of rows (__g, id, f0, ...) as all pairs within the radius that share a __g do.

    Links of rows that share several __g come again.
    """
    words = names_of(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in by_group(batches, "__g", 1 << 16):
            keys, ids = t.column("__g").to_numpy(), t.column("id").to_numpy()
            once = np.append(True, (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1]))
            once &= group_ends(keys) - np.searchsorted(keys, keys) > 1
            at = np.flatnonzero(once)
            if len(at):
                fps = np.stack([t.column(w).to_numpy()[at] for w in words], axis=1).view(np.uint64)
                a, b = bucket_links(group_ends(keys[at]), fps, radius)
                yield pa.RecordBatch.from_arrays([pa.array(ids[at][a]), pa.array(ids[at][b])], names=["a", "b"])

    return rows.repartition("__g").sortWithinPartitions("__g", "id").mapInArrow(run, "a long, b long")


def near_duplicates(df: DataFrame, text: str = "text", id_col: str = "doc_id", n: int = 3, radius: int = 3) -> DataFrame:
    """id_col, fingerprint (16 hex digits) and component_id: the least id that chains of links reach.

    Two texts link if their fingerprints differ in at most radius bits; every such pair is found. Null and empty texts
    and those without words have fingerprint zero, linked like any other. Null ids stay but name no component unless
    all of it are null. Repeated rows and copies share a fingerprint and are compared once. An empty table gives no
    rows. Other columns are not read.
    """
    docs = hold(fingerprint_table(df, n, text, [id_col]))
    first = hold(docs.groupBy("f0").agg(F.min("k0").alias("least"), F.count(F.lit(1)).alias("n")))
    prints, rows = first.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    found = components(links(first.select(F.col("f0").alias("id"), "f0"), radius, exact_masks(radius, prints)), prints)
    rooted = hold(first.join(found.withColumnRenamed("node", "f0"), "f0", "left").select("f0", "least", "n", F.coalesce("root", "f0").alias("root")))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("size"))
    by_fp = looked_up(rooted, named, "root", "size", prints).select("f0", "component_id", "n")
    return looked_up(docs, by_fp, "f0", "n", rows).select(F.col("k0").alias(id_col), F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id")


# --- groups of texts whose shingle sets are similar, found through fingerprints and checked exactly ---

#: Words of the fingerprint of a set. A bit of two sets of similarity 0.8 differs with a chance of 0.19 at most: that is of
#: sets of 4 and 5 shingles, as the bit of an even number of them that ties is 0. Of 256 bits 48 do in the mean, with a
#: deviation of 6.2; the radius is 7.7 deviations up, which about a pair in 10^11 exceeds. Sets that share no shingle differ in
#: 128 with a deviation of 8.
WIDTH = 4
SET_RADIUS = 96
#: Texts with a common shingle in front that are compared in one group; near copies need one comparison each there.
SET_PART = 1 << 15
#: Texts of a chain that are compared in one group.
VERIFY_PART = 256
#: Shingles that are taken for common, and counters that a task finds them with. They set the order in which shingles
#: are looked at, and so how much is compared, never what is found.
COMMON, COUNTERS = 100_000, 1 << 20
#: A shingle is common if it is in over this share of a task's texts, and in so many at least.
COMMON_SHARE, COMMON_LEAST = 1 / 500, 8


def similar_links(sets: list[np.ndarray], tenths: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Spanning pairs of sets whose Jaccard similarity is tenths / 10 or more."""
    m = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    every = np.concatenate(sets) if m else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(m), size)
    _, column, count = np.unique(every, return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    inter = np.zeros((m, m), np.float32)
    step = 4096
    for a in range(0, int(shared.sum()), step):
        lo, hi = np.searchsorted(column, [a, a + step])
        dense = np.zeros((m, step), np.float32)
        dense[owner[lo:hi], column[lo:hi] - a] = 1
        inter += dense @ dense.T
    inter = inter.astype(np.int64)
    union = size[:, None] + size[None, :] - inter
    a, b = np.nonzero(np.triu(10 * inter >= tenths * union, 1) & (union > 0))
    used = UnionFind(m).join(a, b)
    return a[used], b[used]


def common_shingles(texts: DataFrame, n: int) -> np.ndarray:
    """Hashes of common shingles, the rarest first.

    A task counts its texts' shingles in COUNTERS counters; those in over COMMON_SHARE of its texts are named.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, docs, named = np.zeros(COUNTERS, np.int64), 0, np.zeros(0, np.uint64)
        for b in W.slices(batches, "t"):
            hashes, _ = shingle_sets(b.column("t"), n)
            slot = (hashes & np.uint64(COUNTERS - 1)).astype(np.int64)
            counters += np.bincount(slot, minlength=COUNTERS)
            docs += b.num_rows
            named = np.union1d(named, hashes[counters[slot] > max(COMMON_LEAST, COMMON_SHARE * docs)])
        count = counters[(named & np.uint64(COUNTERS - 1)).astype(np.int64)]
        some = count > max(COMMON_LEAST, COMMON_SHARE * docs)
        yield pa.RecordBatch.from_arrays([pa.array(named[some].view(np.int64)), pa.array(count[some])], names=["h", "n"])

    found = texts.select("t").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "h").limit(COMMON)
    return found.select("h").toArrow().column("h").to_numpy()[::-1].view(np.uint64)


def leading(hashes: np.ndarray, size: np.ndarray, common: np.ndarray, rank: np.ndarray, tenths: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the first shingles of each set, in an order that is the same everywhere: common ones come last.

    Sets of similarity tenths / 10 share one of their first size - ceil(size * tenths / 10) + 1.
    """
    doc = np.repeat(np.arange(len(size)), size)
    at = np.minimum(np.searchsorted(common, hashes), max(len(common) - 1, 0))
    place = np.where(common[at] == hashes, rank[at], 0) if len(common) else np.zeros(len(hashes), np.int64)
    order = np.argsort(doc * (len(common) + 1) + place, kind="stable")
    first = np.arange(len(doc)) - np.repeat(np.cumsum(size) - size, size)
    used = first < np.repeat(size + 1 - -(-size * tenths // 10), size)
    return doc[used], hashes[order][used]


def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows __k, id, sorted by both, of keys that two ids or more have, with a hash of a key's ids as __g.

    Near copies share dozens of shingles, and of all the keys that the same ids have one is enough.
    """
    for t in by_group(batches, "__k", 1 << 16):
        keys, ids = t.column("__k").to_numpy(), t.column("id").to_numpy()
        at = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])))
        keys, ids = keys[at], ids[at]
        start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        size = np.diff(np.append(start, len(keys)))
        group = np.repeat(np.add.reduceat(mixed(ids.view(np.uint64), 3), start), size)
        _, first = np.unique(group[start], return_index=True)
        told = np.zeros(len(start), bool)
        told[first] = True
        used = np.repeat(told & (size > 1), size)
        yield pa.RecordBatch.from_arrays([pa.array(group[used].view(np.int64)), pa.array(ids[used])], names=["__g", "id"])


def candidates(texts: DataFrame, n: int, tenths: int) -> DataFrame:
    """Links a, b that chain the keys of texts (key, t): they share a leading shingle and have near fingerprints.

    Any two sets of the similarity share one, so only the fingerprints' radius can miss a pair. Most shingles are in one
    text only, so they meet by their hash and the text's key alone, and fingerprints join what has met. The texts of a
    common shingle are counted, and split into parts that meet pair by pair if they are many.
    """
    found = common_shingles(texts, n)
    order = np.argsort(found)
    shared = texts.sparkSession.sparkContext.broadcast((found[order], order + 1))
    words = names_of(WIDTH)
    kinds = ("rare", "often")
    schema = T.StructType([*[T.StructField(c, T.LongType()) for c in ("id", *words)], *[T.StructField(c, T.ArrayType(T.LongType())) for c in kinds]])

    def lists(doc: np.ndarray, first: np.ndarray, texts: int) -> pa.Array:
        ends = np.zeros(texts + 1, np.int32)
        np.cumsum(np.bincount(doc, minlength=texts), out=ends[1:])
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(first.view(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, rank = shared.value
        seen: set[int] = set()
        for b in W.slices(batches, "t"):
            fresh = [i for i, k in enumerate(b.column("key").to_pylist()) if not (k in seen or seen.add(k))]
            if len(seen) > 1 << 18:  # a text that comes again only gives its rows again
                seen.clear()
            own = b.take(pa.array(fresh, pa.int64()))
            hashes, size = shingle_sets(own.column("t"), n)
            fp = fingerprints(hashes, size, WIDTH).view(np.int64)
            doc, first = leading(hashes, size, common, rank, tenths)
            often = common[np.minimum(np.searchsorted(common, first), len(common) - 1)] == first if len(common) else np.zeros(len(first), bool)
            yield pa.RecordBatch.from_arrays([own.column("key"), *[pa.array(np.ascontiguousarray(fp[:, k])) for k in range(WIDTH)], *[lists(doc[o], first[o], own.num_rows) for o in (~often, often)]], names=schema.names)

    # One row a text: its key and fingerprint would take more room than its shingles, were they with each.
    known = hold(texts.select("key", "t").mapInArrow(run, schema))
    rare, often = (known.select(F.explode(c).alias("__k"), "id") for c in kinds)
    meeting = rare.repartition("__k").sortWithinPartitions("__k", "id").mapInArrow(met, "__g long, id long").distinct()
    often = in_parts(hold(often.distinct()), "__k", "id", SET_PART).select("__g", "id")
    prints = known.select("id", *words).dropDuplicates(["id"])
    return compared(meeting.unionByName(often).join(prints, "id").select("__g", "id", *words), SET_RADIUS, WIDTH)


def might_be_in(rows: DataFrame, key: Column, keys: DataFrame, n: int) -> DataFrame:
    """rows with __may: true where key, a long, is one of the n of keys (key), and rarely else. No row is shuffled.

    The filter is bounded; of very many keys it only passes more.
    """
    blocks = min(MAX_BLOCKS, 1 << max(0, (n * BITS_PER_URL // (64 * WORDS)).bit_length()))
    probed = hashed(rows.withColumn("__key", key), "__key", blocks).join(F.broadcast(bloom_blocks(keys, "key", blocks)), "__block", "left")
    may = F.lit(True)
    for j in range(WORDS):
        may = may & (F.coalesce(F.col(f"w{j}"), F.lit(0)).bitwiseAND(bit(j)) != 0)
    return probed.withColumn("__may", may).select(*[F.col(f"`{c}`") for c in rows.columns], "__may")


def parted(rows: DataFrame, marks: list[Column], table: DataFrame, every: DataFrame, most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows whose marks are in the held table (__i, __k, __o), and the others; every has the marks of all rows.

    Wide rows stay where they are: over most marks are not broadcast but go into a filter, and which of every it takes
    for the table's is worked out from the marks alone.
    """
    names = ["__i", "__k", "__o"]
    same = F.lit(True)
    for c, m in zip(names, marks):
        same = same & m.eqNullSafe(F.col(c))
    n = table.count()
    if n <= (BROADCAST_ROWS if most is None else most):
        few = F.broadcast(table)
        return rows.join(few, same, "left_semi"), rows.join(few, same, "left_anti")
    keys = table.select(F.xxhash64(*names).alias("key"))
    taken = might_be_in(every.select(*names), F.xxhash64(*names), keys, n).where("__may").alias("e")
    spared = small_side(taken.join(table.alias("t"), [F.col(f"e.{c}").eqNullSafe(F.col(f"t.{c}")) for c in names], "left_anti").select(*names))
    marked = might_be_in(rows, F.xxhash64(*marks), keys, n)
    possible = marked.where("__may").drop("__may")
    return possible.join(spared, same, "left_anti"), marked.where(~F.col("__may")).drop("__may").unionByName(possible.join(spared, same, "left_semi"))


def similar_groups(df: DataFrame, text: str, id_col: str, n: int = 5, tenths: int = 8) -> DataFrame:
    """key, other, group of each text that is in a group: two hashes of the text, and a key that stands for the group.

    Texts of a group are chained by pairs whose n-word shingle sets have a Jaccard similarity of tenths / 10 or more.
    Only texts in chains of candidates are read again and compared. Null texts and those without words are in no group,
    repeated rows and copies count once, an empty table gives no rows, other columns are not read. Of two unlike texts
    with one and the same key, of which ten thousand million texts have two or three, one is compared; the other hash
    tells that the group is not the other's.
    """
    texts = df.select(F.col(f"`{text}`").cast("string").alias("t"), F.xxhash64(f"`{id_col}`").alias("row")).where(F.col("t").isNotNull()).withColumn("key", F.xxhash64("t"))
    least = F.min(F.struct("row", F.xxhash64(F.lit(1), "t").alias("other")))
    once = hold(texts.groupBy("key").agg(least.alias("m")).select("key", "m.row", "m.other"))
    texts_n = once.count()
    chains = components(candidates(W.lean(texts), n, tenths), texts_n)
    # One row stands for all copies of a text; with its number in the key, copies do not gather anywhere.
    members = cut(once.join(chains, once["key"] == chains["node"]).select("key", "row", "other", F.col("root").alias("chain")), texts_n)
    members_n = members.count()
    if members_n <= BROADCAST_ROWS:
        members = F.broadcast(members)
    else:  # only texts in chains are shuffled
        texts = might_be_in(texts, F.xxhash64("key", "row"), members.select(F.xxhash64("key", "row").alias("key")), members_n).where("__may").drop("__may")
    found = components(verified(texts.join(members.drop("other"), ["key", "row"]), n, tenths, texts_n), texts_n)
    return found.select(F.col("node").alias("key"), F.col("root").alias("group")).join(members.select("key", "other"), "key")


def verified(rows: DataFrame, n: int, tenths: int, texts_n: int) -> DataFrame:
    """Links a, b that chain keys as all pairs of a chain with similar shingle sets do.

    All texts of a chain meet. In one of over VERIFY_PART, each is first compared with the text that names the chain:
    those similar to it hang together, so only the others meet all, in parts. Near copies of one text cost one
    comparison each. Each narrow step is checkpointed: a plan that held tables are nested in repeats them at each use,
    and the driver would plan and describe dozens of copies. texts_n, how many texts there are in all, sizes these.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in W.slices(batches, "t"):
            hashes, size = shingle_sets(b.column("t"), n)
            ends = np.cumsum(size)
            own = [hashes[e - c : e].tobytes() for e, c in zip(ends.tolist(), size.tolist())]
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("chain"), pa.array(own, pa.binary())], names=["key", "chain", "set"])

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            same = []
            for x, y in zip(b.column("set").to_pylist(), b.column("pivot").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                inter = len(np.intersect1d(x, y, assume_unique=True))
                same.append(10 * inter >= tenths * (len(x) + len(y) - inter) > 0)
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("chain"), pa.array(same, pa.bool_())], names=["key", "chain", "near"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in by_group(batches, "__g", 64):
            group, key, own = t.column("__g").to_numpy(), t.column("key").to_numpy(), t.column("set").to_pylist()
            for a, b in zip(np.flatnonzero(np.append(True, group[1:] != group[:-1])), np.unique(group_ends(group))):
                if b - a > 1:
                    i, j = similar_links([np.frombuffer(s, np.uint64) for s in own[a:b]], tenths)
                    yield pa.RecordBatch.from_arrays([pa.array(key[a + i]), pa.array(key[a + j])], names=["a", "b"])

    small = hold(rows.select("key", "chain", "t").mapInArrow(sets, "key long, chain long, set binary").dropDuplicates(["key"]))
    long_ = small_side(small.groupBy("chain").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > VERIFY_PART), expected=texts_n)
    short = small.join(long_, "chain", "left_anti").select("key", F.col("chain").alias("__g"))
    # The naming text goes to as many tasks as its chain fills, so that none gets a whole chain.
    lots = F.ceil(F.col("n") / VERIFY_PART).cast("int")
    rest = small.join(long_, "chain")
    pivots = rest.where(F.col("key") == F.col("chain")).select("chain", F.col("set").alias("pivot"), F.explode(F.sequence(F.lit(0), lots - 1)).alias("lot"))
    met = rest.withColumn("lot", F.pmod(F.xxhash64("key"), lots).cast("int")).join(pivots, ["chain", "lot"])
    told = cut(met.select("key", "chain", "set", "pivot").mapInArrow(near, "key long, chain long, near boolean"))
    hung = told.where(F.col("near") & (F.col("key") != F.col("chain"))).select(F.col("chain").alias("a"), F.col("key").alias("b"))
    halves = {x: F.ceil(F.count(F.when(c, 1)) / (VERIFY_PART // 2)).cast("int").alias(x) for x, c in (("far", ~F.col("near")), ("by", F.col("near")))}
    open_ = small_side(told.groupBy("chain").agg(*halves.values()).where("far > 0"), expected=texts_n)
    mine = lambda n: F.pmod(F.xxhash64("key", F.lit(3)), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1)).alias("o")
    told = told.join(open_, "chain")
    far, by = told.where(~F.col("near")).withColumn("p", mine("far")), told.where("near").withColumn("p", mine("by"))
    among = far.select("key", "chain", "p", each("far")).select("key", F.xxhash64("chain", F.least("p", "o"), F.greatest("p", "o")).alias("__g"))
    out = far.where("by > 0").select("key", "chain", "p", each("by")).select("key", F.xxhash64("chain", "p", "o", F.lit("by")).alias("__g"))
    back = by.select("key", "chain", "p", each("far")).select("key", F.xxhash64("chain", "o", "p", F.lit("by")).alias("__g"))
    parts = short.unionByName(among).unionByName(out).unionByName(back)
    return parts.join(small.select("key", "set"), "key").repartition("__g").sortWithinPartitions("__g", "key").mapInArrow(run, "a long, b long").unionByName(hung)


def drop_near_duplicates(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """df with one row of each group of similar texts: the one with the least id, nulls last; others are dropped.

    Copies of a text are one group, blank ones too, and are told by 128 bits of hash; of repeated rows one stays. Null
    texts are each kept. An empty table gives no rows; other columns come along whatever their names.
    """
    names = df.columns
    own = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    t, i = f"c{names.index(text)}", f"c{names.index(id_col)}"
    key, other = F.xxhash64(F.col(t).cast("string")), F.xxhash64(F.lit(1), F.col(t).cast("string"))
    keyed = hold(own.where(F.col(t).isNotNull()).select(F.col(i).alias("id"), key.alias("key"), other.alias("other")).groupBy("id", "key", "other").agg(F.count(F.lit(1)).alias("rows")))
    # Counted by text, then by group: neither copies nor a large group gather in a join.
    by_text = keyed.groupBy("key", "other").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id")).alias("least"))
    group = F.struct(F.coalesce("group", "key").alias("g"), F.when(F.col("group").isNull(), F.col("other")).alias("o"))
    grouped = by_text.join(similar_groups(df, text, id_col), ["key", "other"], "left").withColumn("group", group)
    first = grouped.groupBy("group").agg(F.min(F.struct("least.none", "least.id", "key", "other")).alias("f")).select(F.col("f.key").alias("__k"), F.col("f.other").alias("__o"), F.col("f.id").alias("__i"))
    is_first = (F.col("key") == F.col("__k")) & (F.col("other") == F.col("__o")) & F.col("id").eqNullSafe(F.col("__i"))
    marks = [F.col("id").alias("__i"), F.col("key").alias("__k"), F.col("other").alias("__o")]
    every, own_marks = keyed.select(*marks), [F.col(i), key, other]
    lost = hold(keyed.join(first, is_first, "left_anti").select(*marks))
    _, kept = parted(own, own_marks, lost, every)
    repeated = hold(keyed.where("rows > 1").select(*marks))
    if not repeated.isEmpty():
        again, once = parted(kept, own_marks, repeated, every)
        kept = once.unionByName(again.dropDuplicates([i, t]))
    return kept.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(names)])
