"""Packing token sequences: bounded-space online best-fit.

A task keeps a fixed number of open bins. A bitset over free space finds the tightest bin that still takes a piece in
one shift; when no bin takes it and all are open, the fullest closes.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .storage import hold

CAPACITY = 4096
END_ID = 1
OPEN_BINS = 16_384
#: Pieces that one packing task gets at most, about; with so many small pieces the bins left open at its end hardly count.
ROWS_PER_TASK = 50_000
#: Pieces that lie next to each other in a given order and are placed longest first.
WINDOW = 64
#: Words whose ids a worker remembers; later ones are encoded each time. This bounds its memory and changes no result.
REMEMBERED = 200_000
#: Words that are encoded in one text.
JOINED = 512

PIECE_FIELDS = [T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())]


_RUNS = re.compile("[A-Za-z]+|[0-9]|[^A-Za-z0-9]+")
_MARKS = "".join(chr(i) for i in range(33, 127) if not chr(i).isalnum())


class BestFit:
    def __init__(self, capacity: int = CAPACITY, open_bins: int = OPEN_BINS):
        self.capacity, self.open_bins = capacity, open_bins
        self.bits, self.n_open, self.n_bins = 0, 0, 0
        self.by_free: dict[int, list[int]] = defaultdict(list)

    def _take(self, free: int) -> int:
        stack = self.by_free[free]
        found = stack.pop()
        if not stack:
            self.bits &= ~(1 << free)
        self.n_open -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        """Bin number and offset of a piece of 1 to capacity tokens."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            found = self._take(free)
        else:
            free, found = self.capacity, self.n_bins
            self.n_bins += 1
        if left := free - length:
            if self.n_open == self.open_bins:
                self._take((self.bits & -self.bits).bit_length() - 1)
            self.by_free[left].append(found)
            self.bits |= 1 << left
            self.n_open += 1
        return found, self.capacity - free


class WordIds:
    """Ids of white-space separated words by a tokenizer that never joins across white space, each word encoded once.

    New words are encoded many in a text. The tokenizer marks the last id of each of its own words; where the number
    of those in a word is plain, counting marks tells the words' ids apart, and other words are encoded one by one.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.words = pa.array([], pa.large_binary())
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    @staticmethod
    def parts(word: str) -> int:
        """How many words the tokenizer makes of this one, letters, single digits and runs of marks each; 0 if it is not plain."""
        if word.isalpha():
            return 1 if word.isascii() or word.lower().isalpha() and unicodedata.is_normalized("NFC", word) else 0
        if "'" in word or "<|" in word:
            return 0
        if word.isascii():
            return len(_RUNS.findall(word)) if word.isprintable() else 0
        core = word.strip(_MARKS)
        if not (core.isalpha() and core.lower().isalpha() and unicodedata.is_normalized("NFC", word)):
            return 0
        at = word.index(core)
        return 1 + (at > 0) + (at + len(core) < len(word))

    def all_parts(self, words: pa.Array) -> tuple[list[str], np.ndarray]:
        """The words as texts and their parts(); words of letters only are told by whole-array functions."""
        text = words.cast(pa.large_string())
        lower = pc.utf8_lower(text)
        letters = pc.and_(pc.and_(pc.utf8_is_alpha(text), pc.utf8_is_alpha(lower)), pc.equal(pc.utf8_normalize(text, form="NFC"), text))
        parts = letters.to_numpy(zero_copy_only=False).astype(np.int64)
        texts = text.to_pylist()
        for i in np.flatnonzero(parts == 0).tolist():
            parts[i] = self.parts(texts[i])
        return texts, parts

    def encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and how many each has."""
        texts, parts = self.all_parts(words)
        plain = np.flatnonzero(parts)
        groups = [plain[a : a + JOINED] for a in range(0, len(plain), JOINED)]
        made = self.encode([" ".join([texts[i] for i in g]) for g in groups], add_special_tokens=False) if groups else []
        size = np.zeros(len(words), np.int64)
        order, runs = [], []
        for g, e in zip(groups, made):
            own = np.array(e.ids, np.uint32)
            marks = np.flatnonzero(self.ends[own])
            if len(marks) != parts[g].sum() or marks[-1] != len(own) - 1:  # cut otherwise than expected: one by one
                parts[g] = 0
                continue
            size[g] = np.diff(marks[np.cumsum(parts[g]) - 1], prepend=-1)
            order.append(g)
            runs.append(own)
        odd = np.flatnonzero(parts == 0)
        if len(odd):
            alone = [np.array(e.ids, np.uint32) for e in self.encode([texts[i] for i in odd], add_special_tokens=False)]
            size[odd] = [len(x) for x in alone]
            order.append(odd)
            runs += alone
        flat = np.concatenate(runs) if runs else np.zeros(0, np.uint32)
        if len(order) < 2:
            return flat, size
        # from the order in which they were encoded to that of the words
        placed = np.concatenate(order)
        first = np.zeros(len(words), np.int64)
        first[placed] = np.cumsum(size[placed]) - size[placed]
        total = np.cumsum(size)
        return flat[np.repeat(first - total + size, size) + np.arange(total[-1])], size

    def look_up(self, vocab: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first, size): word i's ids stand at ids[first[i]:first[i] + size[i]]."""
        place = pc.fill_null(pc.index_in(vocab, self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = np.flatnonzero(place < 0)
        if not len(new):
            return self.flat, self.first[place], self.size[place]
        words = vocab.take(pa.array(new))
        made, size = self.encoded(words)
        starts = len(self.flat) + np.cumsum(size) - size
        if len(self.words) >= REMEMBERED:
            first, n = (self.first[place], self.size[place])
            first[new], n[new] = starts, size
            return np.concatenate([self.flat, made]), first, n
        place[new] = len(self.words) + np.arange(len(new))
        self.words = pa.concat_arrays([self.words, words])
        self.first, self.size = np.concatenate([self.first, starts]), np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, made])
        return self.flat, self.first[place], self.size[place]

    def documents(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by END_ID, and the n+1 offsets."""
        w = W.split_words(texts)
        flat, first, sizes = self.look_up(w.vocab)
        size = sizes[w.codes]
        total = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=total[1:])
        ids = flat[np.repeat(first[w.codes] - total[:-1], size) + np.arange(total[-1])]
        offsets = total[w.doc_start] + np.arange(w.n_docs + 1)
        out = np.full(offsets[-1], END_ID, np.uint32)
        keep = np.ones(len(out), bool)
        keep[offsets[1:] - 1] = False
        out[keep] = ids
        return out, offsets


def pieces(df: DataFrame, tokenizer_path: str, text: str = "text", id_col: str = "doc_id", capacity: int = CAPACITY, order_by: Sequence[str] = ()) -> DataFrame:
    """id_col, piece, start, length, ids_crc32 of each text's ids cut at capacity; null text is empty, so one end id.

    With order_by, a text's values of those columns come along as __o0, __o1 and so on.
    """
    places = [f"__o{i}" for i in range(len(order_by))]
    source = W.lean(df).select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text}`").cast("string").alias("__text"), *[F.col(f"`{c}`").alias(p) for c, p in zip(order_by, places)])
    schema = T.StructType([T.StructField(id_col, source.schema["__id"].dataType), *PIECE_FIELDS, *[T.StructField(p, source.schema[p].dataType) for p in places]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = ("word ids", tokenizer_path)
        encoder = W.kept(key, lambda: WordIds(tokenizer_path))
        for b in W.slices(batches, "__text", key=key):
            ids, offsets = encoder.documents(b.column("__text"))
            n = np.diff(offsets)
            parts = -(-n // capacity)
            doc = np.repeat(np.arange(len(n)), parts)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
            start = piece * capacity
            length = np.minimum(capacity, n[doc] - start)
            raw, at = memoryview(ids.astype("<u4").tobytes()), (offsets[doc] + start) * 4
            crc = [zlib.crc32(raw[a : a + 4 * k]) for a, k in zip(at.tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays([b.column("__id").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), *[b.column(p).take(pa.array(doc)) for p in places]], names=[id_col, "piece", "start", "length", "ids_crc32", *places])

    return source.mapInArrow(run, schema)


def pack(items: DataFrame, id_col: str = "doc_id", capacity: int = CAPACITY, open_bins: int = OPEN_BINS, tasks: int | None = None) -> DataFrame:
    """Pieces with sequence_id and offset.

    Pieces are dealt by a hash of document and piece, so that no source or long document gathers in a task, and each
    task packs its own. They arrive longest first, then by the hash, so a task that runs again packs the same way; a
    task's pieces hardly ever fill the open bins, so short ones find the gaps that long ones leave.
    """
    spread = F.xxhash64(id_col, "piece", "ids_crc32")
    dealt = items.repartition(max(1, tasks or 1), spread).sortWithinPartitions(F.desc("length"), spread, id_col, "piece", "ids_crc32")
    schema = T.StructType([*items.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, bins = TaskContext.get().partitionId() << 36, BestFit(capacity, open_bins)
        for b in batches:
            placed = [bins.place(n) for n in b.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([base + x for x, _ in placed], pa.int64()), pa.array([x for _, x in placed], pa.int64())], names=[*b.schema.names, "sequence_id", "offset"])

    return dealt.mapInArrow(run, schema)


def pack_in_order(items: DataFrame, order_by: Sequence[str], id_col: str = "doc_id", capacity: int = CAPACITY, open_bins: int = OPEN_BINS, tasks: int | None = None, window: int = WINDOW) -> DataFrame:
    """Pieces with sequence_id and offset, so that sequences by rising number begin in the order of the pieces.

    A task has a range of the order. It places a window of neighbours at a time, longest first; later pieces also fill
    gaps that earlier windows have left. The columns of order_by are dropped.
    """
    by = [*[F.col(f"`{c}`") for c in order_by], F.col(f"`{id_col}`"), F.col("ids_crc32"), F.col("piece")]
    held = hold(items)  # it is sampled for the ranges before it is dealt
    dealt = held.repartitionByRange(max(1, tasks or 1), *by).sortWithinPartitions(*by).drop(*order_by)
    schema = T.StructType([*dealt.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, bins, rest = TaskContext.get().partitionId() << 36, BestFit(capacity, open_bins), None

        def placed(t: pa.Table) -> pa.RecordBatch:
            length = t.column("length").to_numpy()
            order = np.lexsort((-length, np.arange(len(length)) // window))
            at = np.array([bins.place(n) for n in length[order].tolist()], np.int64).reshape(-1, 2)
            own = t.take(pa.array(order)).combine_chunks().to_batches()[0]
            return pa.RecordBatch.from_arrays([*own.columns, pa.array(base + at[:, 0]), pa.array(at[:, 1])], names=[*own.schema.names, "sequence_id", "offset"])

        for b in batches:
            both = pa.Table.from_batches([b] if rest is None else [*rest.to_batches(), b])
            whole = len(both) // window * window
            rest = both.slice(whole)
            if whole:
                yield placed(both.slice(0, whole))
        if rest is not None and len(rest):
            yield placed(rest)

    return dealt.mapInArrow(run, schema)


def pack_documents(df: DataFrame, tokenizer_path: str, text: str = "text", id_col: str = "doc_id", order_by: Sequence[str] = ()) -> DataFrame:
    """All texts of df as pieces placed in sequences of CAPACITY tokens.

    Null and empty texts are their end id alone. Repeated rows are packed once each; null ids pack like others; only
    texts longer than a sequence are cut. An empty table gives no rows. Columns other than the two named are not read.

    A text has at most as many tokens as bytes, so its bytes bound its pieces; tasks are as many as all pieces need.

    With order_by, sequences keep the order of the texts, as pack_in_order() says; without, there are the fewest.
    """
    most = F.ceil((F.coalesce(F.octet_length(F.col(f"`{text}`").cast("string")), F.lit(0)) + 1) / CAPACITY)
    tasks = -(-(df.agg(F.sum(most)).first()[0] or 0) // ROWS_PER_TASK)
    if order_by:
        return pack_in_order(pieces(df, tokenizer_path, text, id_col, order_by=order_by), [f"__o{i}" for i in range(len(order_by))], id_col, tasks=tasks)
    return pack(pieces(df, tokenizer_path, text, id_col), id_col, tasks=tasks)
