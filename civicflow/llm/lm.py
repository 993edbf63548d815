"""N-gram language-model scores of whole texts.

Texts are coded once into blocks of words and word numbers. A block asks for what all training texts say of its words,
then of its pairs and triples: its distinct ones go to shards, packed, and a shard answers each block in the order asked.
All training words are numbered and all pairs and triples counted exactly. A shard makes an Elias-Fano trie of the
training texts' pairs and triples that fall to it, maps its levels into memory and looks up there what blocks ask for;
neither the driver nor a task holds the whole model.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .elias_fano import NgramTrie, mapped
from .storage import local_folder, written

BLOCK_BYTES = 8 << 20
#: Blocks whose distinct pairs and triples make up about one shard.
SHARD_BLOCKS = 2
#: The end token's number, and what stands for no next word.
END, NONE = 0, (1 << 31) - 1
DISCOUNT = 0.5
SMOOTHING = 0.1
FOLDS = 10


def training(id_col: str) -> Column:
    """Whether a row is learned from; a null id is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS != 0, F.lit(False))


def merged(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Neighbouring batches put together while their texts hold max_bytes at most."""
    held, size = [], 0
    for b in batches:
        own = pc.sum(pc.binary_length(b.column(column))).as_py() or 0
        if held and size + own > max_bytes:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(b)
        size += own
    if held:
        yield pa.concat_batches(held)


def blocks(df: DataFrame, text: str, id_col: str) -> DataFrame:
    source = W.lean(df).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").cast("string").alias("__text")).withColumn("train", training("id"))
    kind = source.schema["id"].dataType
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(kind)), T.StructField("train", T.ArrayType(T.BooleanType())), T.StructField("sizes", T.ArrayType(T.IntegerType())), T.StructField("n_codes", T.LongType()), T.StructField("codes", T.BinaryType()), T.StructField("n_words", T.LongType()), T.StructField("words", T.BinaryType()), T.StructField("counts", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 32
        for i, b in enumerate(merged(W.slices(batches, "__text", BLOCK_BYTES), "__text", BLOCK_BYTES)):
            w = W.split_words(b.column("__text"), lower=True)
            train = b.column("train").to_numpy(zero_copy_only=False)
            used = np.repeat(train, w.counts())
            counts = np.bincount(w.codes[used], minlength=len(w.vocab)).astype(np.int64)
            one = lambda a, t: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a.cast(t))
            yield pa.RecordBatch.from_arrays(
                [pa.array([base + i]), one(b.column("id"), b.column("id").type), one(b.column("train"), pa.bool_()), one(pa.array(w.counts()), pa.int32()), pa.array([len(w.codes)]), pa.array([packed(w.codes, "<u4")], pa.binary()), pa.array([len(w.vocab)]), squeezed(b" ".join(w.vocab_list())), squeezed(counts.astype("<i8").tobytes())],
                names=schema.names,
            )

    return source.mapInArrow(run, schema)


def squeezed(raw: bytes) -> pa.Array:
    """One value: the length and the compressed bytes."""
    return pa.array([len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)], pa.binary())


def expanded(b: pa.RecordBatch | pa.Table, name: str, i: int) -> bytes:
    raw = b.column(name)[i].as_py()
    n = int.from_bytes(raw[:8], "little")
    return pa.decompress(raw[8:], n, "zstd", asbytes=True) if n else b""


def words_of(b: pa.RecordBatch | pa.Table, i: int) -> list[bytes]:
    """The block's distinct words; none holds a blank."""
    return expanded(b, "words", i).split(b" ") if b.column("n_words")[i].as_py() else []


def decoded(b: pa.RecordBatch | pa.Table, i: int) -> tuple[np.ndarray, np.ndarray]:
    return unpacked(b.column("codes")[i].as_py(), "<u4"), np.asarray(b.column("sizes")[i].values, np.int64)


def with_ends(numbers: np.ndarray, sizes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts' words each followed by the end token, and the n+1 offsets."""
    offsets = np.concatenate([[0], np.cumsum(sizes + 1)])
    out = np.full(offsets[-1], end, numbers.dtype)
    keep = np.ones(len(out), bool)
    keep[offsets[1:] - 1] = False
    out[keep] = numbers
    return out, offsets


def shifted(tokens: np.ndarray, offsets: np.ndarray, by: int) -> np.ndarray:
    """The token by places before each within its text, -1 where there is none."""
    out = np.full(len(tokens), -1, tokens.dtype)
    out[by:] = tokens[:-by]
    starts = offsets[:-1]
    for k in range(by):
        at = starts + k
        out[at[at < offsets[1:]]] = -1
    return out


def packed(a: np.ndarray, kind: str, rising: bool = False) -> bytes:
    """The numbers as compressed planes of bytes; rising ones as steps."""
    a = np.diff(a, prepend=0) if rising else a
    raw = np.ascontiguousarray(a.astype(kind)).view(np.uint8).reshape(len(a), -1).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpacked(raw: bytes, kind: str, rising: bool = False) -> np.ndarray:
    n, width = int.from_bytes(raw[:8], "little"), np.dtype(kind).itemsize
    flat = np.frombuffer(pa.decompress(raw[8:], n, "zstd", asbytes=True) if n else b"", np.uint8)
    a = np.ascontiguousarray(flat.reshape(width, -1).T).view(kind).ravel().astype(np.int64)
    return np.cumsum(a) if rising else a


def real(code: np.ndarray, book: np.ndarray) -> bytes:
    """Numbers of a book by their codes of 8 bits, packed with the part of the book that they use."""
    used = np.flatnonzero(np.bincount(code, minlength=256))
    short = np.zeros(256, np.uint8)
    short[used] = np.arange(len(used))
    raw = len(used).to_bytes(2, "little") + book[used].astype("<f4").tobytes() + short[code].tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unreal(raw: bytes) -> np.ndarray:
    raw = pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), "zstd", asbytes=True)
    n = int.from_bytes(raw[:2], "little")
    return np.frombuffer(raw, "<f4", n, 2).astype(np.float64)[np.frombuffer(raw, np.uint8, offset=2 + 4 * n)] if n else np.zeros(0)


def sharded(of: np.ndarray) -> tuple[np.ndarray, dict[int, slice]]:
    """Places in the order of their shards, and where each shard's are in that order; shards without any have none."""
    order = np.argsort(of, kind="stable")
    some, start = np.unique(of[order], return_index=True)
    return order, {s: slice(a, b) for s, a, b in zip(some.tolist(), start.tolist(), [*start[1:].tolist(), len(of)])}


#: What goes between blocks and shards; block -1 is a shard's own account, with two numbers.
MAIL = T.StructType([T.StructField("block", T.LongType()), T.StructField("shard", T.IntegerType()), T.StructField("kind", T.IntegerType()), *[T.StructField(c, T.BinaryType()) for c in "abcde"], T.StructField("x", T.LongType()), T.StructField("y", T.LongType())])
MAIL_ARROW = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("kind", pa.int32()), *[(c, pa.binary()) for c in "abcde"], ("x", pa.int64()), ("y", pa.int64())])
WORDS, GRAMS, FOLLOWERS = 1, 2, 3


def mail(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_pylist([dict(zip(MAIL_ARROW.names, r)) for r in rows], MAIL_ARROW)


def letter(block: int, shard: int, kind: int, *blobs: bytes, x: int = 0, y: int = 0) -> tuple:
    return (block, shard, kind, *blobs, *[None] * (5 - len(blobs)), x, y)


def word_shards(words: list[bytes], shards: int) -> tuple[np.ndarray, dict[int, slice]]:
    return sharded(np.fromiter((zlib.crc32(w) % shards for w in words), np.int64, len(words)))


def word_asks(coded: DataFrame, shards: int) -> DataFrame:
    """Each block's distinct words and their counts, by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                words, counts, block = words_of(b, i), np.frombuffer(expanded(b, "counts", i), "<i8"), b.column("block")[i].as_py()
                order, edge = word_shards(words, shards)
                rows = []
                for s, own in edge.items():
                    at = order[own]
                    rows.append(letter(block, s, WORDS, squeezed(b" ".join([words[k] for k in at.tolist()]))[0].as_py(), packed(counts[at], "<u4")))
                yield from mail(rows).to_batches()

    return coded.select("block", "n_words", "words", "counts").mapInArrow(run, MAIL)


def word_answers(asks: DataFrame, shards: int) -> DataFrame:
    """Number (-1 for words of held-out texts alone) and count of each word asked for; the shard's tokens and words."""

    def run(t: pa.Table) -> pa.Table:
        asked = [expanded(t, "a", i).split(b" ") for i in range(t.num_rows)]
        n = np.concatenate([unpacked(b, "<u4") for b in t.column("b").to_pylist()])
        code = pa.array([w for own in asked for w in own], pa.large_binary()).dictionary_encode().indices.to_numpy()
        c = np.bincount(code, n).astype(np.int64)
        number = np.empty(len(c), np.int64)
        number[np.argsort(-c, kind="stable")] = np.arange(len(c))
        number = np.where(c > 0, 1 + number * shards + t.column("shard")[0].as_py(), -1)
        if number.max() >= NONE:
            raise ValueError("over two thousand million words")
        out, at = [letter(-1, t.column("shard")[0].as_py(), WORDS, x=int(c.sum()), y=int((c > 0).sum()))], 0
        for block, own in zip(t.column("block").to_pylist(), asked):
            k = code[at : at + len(own)]
            out.append(letter(block, t.column("shard")[0].as_py(), WORDS, packed(number[k], "<i4"), packed(c[k], "<i8")))
            at += len(own)
        return mail(out)

    return asks.groupBy("shard").applyInArrow(run, MAIL)


class Grams:
    """A block's distinct pairs, each with the words that follow it; a pair's entries are those next words.

    Each place whose word and the one before are known is an entry's: its pair with the next word, or with NONE after
    the end token and before a word without number. Training texts have none such, so a pair's entries sum to its count.
    """

    def __init__(self, tokens: np.ndarray, offsets: np.ndarray, used: np.ndarray, shards: int):
        one = shifted(tokens, offsets, 1)
        after = np.append(tokens[1:], -1)
        after[offsets[1:] - 1] = -1
        self.place = np.flatnonzero((tokens >= 0) & (one >= 0))
        after = np.where(after[self.place] < 0, NONE, after[self.place])
        self.pairs, rank = np.unique(one[self.place] << 32 | tokens[self.place], return_inverse=True)
        key, self.entry = np.unique(rank << 32 | after, return_inverse=True)
        self.pair, self.next = key >> 32, key & 0xFFFFFFFF
        self.n = np.bincount(self.entry, used[self.place], len(key)).astype(np.int64)
        of = ((self.pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % shards
        self.pair_order, self.pair_edge = sharded(of)
        self.order, self.edge = sharded(of[self.pair])


def numbered(left: pa.Table, right: pa.Table, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[int, slice]]:
    """Number and count of each of the block's words, from the shards' answers, and where each shard's words are."""
    words = words_of(left, 0)
    order, edge = word_shards(words, shards)
    number, count = np.full(len(words), -1, np.int64), np.zeros(len(words), np.int64)
    for kind, s, a, b in zip(*[right.column(c).to_pylist() for c in ("kind", "shard", "a", "b")]):
        if kind == WORDS:
            at = order[edge[s]]
            number[at], count[at] = unpacked(a, "<i4"), unpacked(b, "<i8")
    return number, count, order, edge


def block_grams(left: pa.Table, number: np.ndarray, shards: int) -> tuple[Grams, np.ndarray, np.ndarray]:
    codes, sizes = decoded(left, 0)
    tokens, offsets = with_ends(number[codes] if len(codes) else np.zeros(0, np.int64), sizes, END)
    used = np.repeat(np.asarray(left.column("train")[0].values.to_numpy(zero_copy_only=False), bool), np.diff(offsets))
    return Grams(tokens, offsets, used, shards), tokens, offsets


def gram_asks(coded: DataFrame, answers: DataFrame, shards: int) -> DataFrame:
    """Each block's distinct pairs with their next words and counts, and the counts of the pairs' first words, by shard."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        number, count, _, _ = numbered(left, right, shards)
        g = block_grams(left, number, shards)[0]
        by_number = np.argsort(number, kind="stable")
        numbers, counts = number[by_number], count[by_number]
        rows = []
        for s, own in g.pair_edge.items():
            mine, at = g.pair_order[own], g.order[g.edge[s]]
            size = np.diff(np.append(np.searchsorted(g.pair[at], mine), len(at)))
            first = counts[np.searchsorted(numbers, np.unique(g.pairs[mine] >> 32))]
            rows.append(letter(left.column("block")[0].as_py(), s, GRAMS, packed(g.pairs[mine], "<i8", True), packed(size, "<u4"), packed(g.next[at], "<u4"), packed(g.n[at], "<u4"), packed(first, "<i8")))
        return mail(rows)

    return coded.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, MAIL)


def shard_trie(distinct: np.ndarray, c2: np.ndarray, c1: np.ndarray, triples: np.ndarray, c3: np.ndarray, folder: str | None) -> NgramTrie:
    """The trie of what training texts have of a shard's pairs (with counts c2, and c1 of their first words) and triples."""
    some = np.flatnonzero(c2)
    pairs = distinct[some]
    place = np.full(len(distinct), -1, np.int64)
    place[some] = np.arange(len(some))
    used = (c3 > 0) & (triples & 0xFFFFFFFF != NONE)
    _, where = np.unique(pairs >> 32, return_index=True)
    return NgramTrie(mapped(NgramTrie.arrays(pairs, c2[some], c1[some][where], place[triples[used] >> 32], triples[used] & 0xFFFFFFFF, c3[used], DISCOUNT), folder))


def answered(t: pa.Table, shards: int, folder: str | None) -> pa.Table:
    """A shard's answers to all blocks, out of a trie of its training pairs and triples."""
    shard = t.column("shard")[0].as_py()
    pairs = [unpacked(a, "<i8", True) for a in t.column("a").to_pylist()]
    sizes = [unpacked(b, "<u4") for b in t.column("b").to_pylist()]
    n = np.concatenate([unpacked(d, "<u4") for d in t.column("d").to_pylist()])
    distinct, rank = np.unique(np.concatenate(pairs), return_inverse=True)
    key = np.repeat(rank, np.concatenate(sizes)) << 32
    key |= np.concatenate([unpacked(c, "<u4") for c in t.column("c").to_pylist()])
    triples, entry = np.unique(key, return_inverse=True)
    del key
    c3 = np.bincount(entry, n, len(triples)).astype(np.int64)
    c2 = np.bincount(triples >> 32, c3, len(distinct)).astype(np.int64)
    firsts = np.concatenate([np.unique(own >> 32) for own in pairs])
    first, where = np.unique(firsts, return_index=True)
    c1 = np.concatenate([unpacked(e, "<i8") for e in t.column("e").to_pylist()])[where]
    trie = shard_trie(distinct, c2, c1[np.searchsorted(first, distinct >> 32)], triples, c3, folder)
    begun_by, begun = np.unique(distinct[c2 > 0] >> 32, return_counts=True)
    node = trie.pair(distinct >> 32, distinct & 0xFFFFFFFF)
    w2, left, w3 = trie.weight2.codes(node), trie.left3.codes(node), trie.weight3.codes(trie.triple(node[triples >> 32], triples & 0xFFFFFFFF))
    book2, book3, book_left = (np.append(x.book, none) for x, none in ((trie.weight2, 0.0), (trie.weight3, 0.0), (trie.left3, 1.0)))
    out, p, q = [], 0, 0
    for block, own, size in zip(t.column("block").to_pylist(), pairs, sizes):
        r, e = rank[p : p + len(own)], entry[q : q + int(size.sum())]
        out.append(letter(block, shard, GRAMS, real(w3[e], book3), real(w2[r], book2), real(left[r], book_left)))
        p, q = p + len(own), q + len(e)
    order, edge = sharded((begun_by - 1) % shards)
    for s, own in edge.items():
        at = order[own]
        out.append(letter(-1, s, FOLLOWERS, packed(begun_by[at], "<i8", True), packed(begun[at], "<i8")))
    return mail(out)


def gram_answers(asks: DataFrame, shards: int, folder: str | None = None) -> DataFrame:
    """Weights of the triples and pairs asked for, and what pairs leave; for words, how many pairs they begin.

    The tries' levels are mapped from files in the folder, or from memory without one.
    """
    return asks.groupBy("shard").applyInArrow(lambda t: answered(t, shards, folder), MAIL)


def follower_answers(words: DataFrame, begun: DataFrame, shards: int) -> DataFrame:
    """How many different pairs each word asked for begins."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        asked = [unpacked(a, "<i4") for a in left.column("a").to_pylist()]
        total = np.zeros(max((int(a.max()) // shards + 2 for a in asked), default=1), np.int64)
        for a, b in zip(right.column("a").to_pylist(), right.column("b").to_pylist()):
            total[(unpacked(a, "<i8", True) - 1) // shards] += unpacked(b, "<i8")
        return mail([letter(block, key[0].as_py(), FOLLOWERS, packed(np.where(a > 0, total[(a - 1) // shards], 0), "<i8")) for block, a in zip(left.column("block").to_pylist(), asked)])

    return words.groupBy("shard").cogroup(begun.groupBy("shard")).applyInArrow(run, MAIL)


def score_texts(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """id_col, held_out, n_tokens, n_known, train_tokens, base_score and score of each text.

    base_score uses smoothed unigram counts, score the interpolated trigram model with absolute discounting over all
    pairs and triples of the training texts, whose weights have 8 bits; both are log10 of the whole text with its end token. Null and empty texts
    are their end token alone. Null ids are held out; repeated rows count each; ties cannot arise; an empty table gives
    no rows; other columns are not read.
    """
    coded = written(blocks(df, text, id_col), "lm-blocks")
    n_blocks, ends = coded.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size(F.filter("train", lambda t: t))), F.lit(0))).first()
    shards = max(1, -(-n_blocks // SHARD_BLOCKS))
    words = written(word_answers(word_asks(coded, shards), shards), "lm-words")
    tokens, vocabulary = words.where("block < 0").agg(F.coalesce(F.sum("x"), F.lit(0)), F.coalesce(F.sum("y"), F.lit(0))).first()
    words = words.where("block >= 0")
    grams = written(gram_answers(gram_asks(coded, words, shards), shards, local_folder(df.sparkSession)), "lm-grams")
    followers = follower_answers(words, grams.where("block < 0"), shards)
    answers = words.unionByName(grams.where("block >= 0")).unionByName(followers)
    return scored(coded, answers, shards, tokens + ends, vocabulary + (ends > 0), ends, id_col)


def scored(coded: DataFrame, answers: DataFrame, shards: int, n_all: int, vocabulary: int, ends: int, id_col: str) -> DataFrame:
    kind = coded.schema["ids"].dataType.elementType
    whole = n_all + SMOOTHING * (vocabulary + 1)
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()), T.StructField("train_tokens", T.LongType()), T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        number, count, order, edge = numbered(left, right, shards)
        g, tokens, offsets = block_grams(left, number, shards)
        begun = np.zeros(len(number), np.int64)
        w3, w2, left3 = np.zeros(len(g.n)), np.zeros(len(g.pairs)), np.ones(len(g.pairs))
        for kind_, s, a, b, c in zip(*[right.column(x).to_pylist() for x in ("kind", "shard", "a", "b", "c")]):
            if kind_ == FOLLOWERS:
                begun[order[edge[s]]] = unpacked(a, "<i8")
            elif kind_ == GRAMS:
                w3[g.order[g.edge[s]]] = unreal(a)
                mine = g.pair_order[g.pair_edge[s]]
                w2[mine], left3[mine] = unreal(b), unreal(c)
        codes, sizes = decoded(left, 0)
        c1, _ = with_ends(count[codes].astype(np.float64) if len(codes) else np.zeros(0), sizes, ends)
        heads, _ = with_ends(begun[codes] if len(codes) else np.zeros(0, np.int64), sizes, 0)
        p1 = (c1 + SMOOTHING) / whole
        p = interpolated(p1, c1, heads, g, w2, left3, w3, tokens, offsets)
        first = offsets[:-1]
        n = len(sizes)
        return pa.table(
            {
                id_col: left.column("ids")[0].values,
                "held_out": pa.array(~np.asarray(left.column("train")[0].values.to_numpy(zero_copy_only=False), bool)),
                "n_tokens": pa.array(sizes + 1),
                "n_known": pa.array(np.add.reduceat((c1 > 0).astype(np.int64), first)),
                "train_tokens": pa.array(np.full(n, n_all, np.int64)),
                "base_score": pa.array(np.add.reduceat(np.log10(p1), first)),
                "score": pa.array(np.add.reduceat(np.log10(p), first)),
            }
        )

    texts = coded.select("block", "ids", "train", "sizes", "codes", "n_words", "words")
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)


def interpolated(p1, c1, heads, g: Grams, w2, left3, w3, tokens, offsets) -> np.ndarray:
    """P(word | two words before) of each place: what a context's discounts leave goes to the shorter context."""
    p = p1.copy()
    inner = np.ones(len(p), bool)
    inner[offsets[:-1]] = False
    at = np.flatnonzero(inner)
    at = at[c1[at - 1] > 0]
    p[at] *= DISCOUNT * heads[at - 1] / c1[at - 1]
    pair = g.pair[g.entry]
    p[g.place] += w2[pair]
    some = tokens[g.place] != END  # a pair that ends in the end token has no next place
    at, pair, own = g.place[some] + 1, pair[some], w3[g.entry[some]]
    p[at] = p[at] * left3[pair] + np.where(tokens[at] >= 0, own, 0)
    return p
