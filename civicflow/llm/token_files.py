"""Token ids in binary files: one array of ids a file, and where documents begin as an Elias-Fano sequence.

A file is what `elias_fano.write_flat` writes: a header that says what stands where, then

- `meta`: partition, number in it, documents, ids, documents without an id
- `ids`: ids of all its documents, 16 bits each if the vocabulary allows, else 32
- `starts/...`: where each document begins, and where the last ends
- `docs/...`: the documents' own ids, as differences from the first, and `first`; or `docs` where they span over 62 bits

and a line end. Documents stand in rising order of their ids, in a file, over the files of a partition and over
partitions; none is cut.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .elias_fano import _ONES, _U, EliasFano, _byte_ones, _select, joined, part, read_flat, write_flat
from .packing import JOINED, WordIds
from .storage import hold, small_side

END_ID = 2
#: A file is closed once it has so many ids; a document stays whole, so a file may have as many more as its last one.
FILE_IDS = 1 << 23
#: Bytes of texts that are encoded together; the more, the fewer units are encoded twice.
PASS_BYTES = 1 << 22
#: Every so many ones of a bitmap the place of one is kept.
SAMPLE = 64

#: Marks besides ASCII's six that may count as white space in the tokenizer's own splitting; and how special tokens begin.
_ODD_SPACE = r"[\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}-\x{202f}\x{205f}-\x{2060}\x{3000}\x{feff}]|<\|"


class Offsets(EliasFano):
    """An Elias-Fano sequence whose select structure is one 32-bit place for every SAMPLE ones; words between are counted."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.n, self.low_bits, self.universe = (int(x) for x in arrays["head"])
        self.high, self.low, self.sample = arrays["high"], arrays["low"], arrays["sample"]

    @staticmethod
    def arrays(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
        made = EliasFano.arrays(values, universe)
        low_bits = int(made["head"][1])
        values = np.asarray(values, np.int64)[::SAMPLE]
        made["sample"] = ((values >> low_bits) + np.arange(len(values)) * SAMPLE).astype(np.uint32)
        del made["ones"]
        return made

    @property
    def nbytes(self) -> int:
        return sum(a.nbytes for a in (self.high, self.low, self.sample))

    def select(self, i: np.ndarray) -> np.ndarray:
        """Place of the i-th one of the upper bits."""
        at = self.sample[i // SAMPLE].astype(np.int64)
        word, left = at >> 6, i % SAMPLE
        bits = self.high[word] >> (at & 63).astype(np.uint64) << (at & 63).astype(np.uint64)
        out, open_ = np.zeros(len(i), np.int64), np.arange(len(i))
        while len(open_):
            ones = (_byte_ones(bits) * _ONES >> _U[56]).astype(np.int64)
            here = left < ones
            found = open_[here]
            base = np.arange(len(found)) * 64
            out[found] = word[here] * 64 + _select(bits[here], base, base + left[here]) - base
            word, left, open_ = word[~here] + 1, (left - ones)[~here], open_[~here]
            bits = self.high[word]
        return out

    def get(self, i: np.ndarray) -> np.ndarray:
        i = np.asarray(i, np.int64)
        return ((self.select(i) - i) << self.low_bits) | self._low(i)


def cut_units(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(codes, units, first): stretches of texts that a byte-level tokenizer never joins, coded; text i has codes first[i]:first[i+1].

    A unit is a word with the single blank before it, a word without one, the last mark of a stretch of white space
    that is no blank, or all of such a stretch before its last mark, or at the end of a text the whole of it. These
    are where the tokenizer's own splitting always begins anew.
    """
    data, byte_start = W.text_bytes(texts)
    n = len(data)
    space = np.zeros(n + 1, bool)
    space[:n] = W.SPACED[data] == 0
    begins = np.zeros(n + 1, bool)
    begins[byte_start] = True
    before = np.zeros(n + 1, bool)
    before[1:] = space[:-1]
    before[begins] = False
    after = np.zeros(n + 1, bool)
    after[:-1] = space[1:]
    ends = np.zeros(n + 1, bool)
    ends[:-1] = begins[1:]
    blank = np.zeros(n + 1, bool)
    blank[1:] = data == 32
    cut = begins | (space & ~before) | (space & before & ~after & ~ends) | (~space & before & ~blank)
    start = np.flatnonzero(cut[:n])
    offsets = np.append(start, n)
    units = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    coded = units.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary, np.searchsorted(start, byte_start)


class UnitIds(WordIds):
    """Ids of texts by a byte-level tokenizer that splits at white space, each different unit encoded once.

    Units with a blank before the word are encoded many in a text, other words between line ends; the lengths of the
    tokens in bytes tell their ids apart. Texts in which white space other than ASCII's, or the mark of a special token,
    could change where units begin are encoded whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.size_of[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self.wide = len(self.size_of) > 1 << 16
        self.words = pa.array([], pa.large_binary())
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        length = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        head, tail = (np.frombuffer(b"".join(pc.binary_slice(words, i, j).to_pylist()), np.uint8) for i, j in ((0, 1), (-1, None)))
        marks = W.SPACED[tail] == 0
        size, order, runs, odd = np.zeros(len(words), np.int64), [], [], [np.flatnonzero(marks)]
        for some, sep in ((~marks & (head == 32), b""), (~marks & (head != 32), b"\n")):
            place = np.flatnonzero(some)
            groups = [place[a : a + JOINED] for a in range(0, len(place), JOINED)]
            made = self.encode([sep.join(words.take(pa.array(g)).to_pylist()).decode() for g in groups], add_special_tokens=False) if groups else []
            for g, e in zip(groups, made):
                own = np.array(e.ids, np.uint32)
                upto = np.cumsum(self.size_of[own])
                end = np.cumsum(length[g] + len(sep)) - len(sep)
                last = np.searchsorted(upto, end)
                first = np.append(0, last[:-1] + 1 + len(sep))  # a line end is one token
                if upto[-1] != end[-1] or (upto[last] != end).any() or (sep and (upto[last[:-1] + 1] != end[:-1] + 1).any()):
                    odd.append(g)  # cut otherwise than expected: one by one
                    continue
                size[g] = last + 1 - first
                order.append(g)
                runs.append(np.delete(own, last[:-1] + 1) if sep else own)
        alone = np.concatenate(odd)
        if len(alone):
            made = [np.array(e.ids, np.uint32) for e in self.encode([x.decode() for x in words.take(pa.array(alone)).to_pylist()], add_special_tokens=False)]
            size[alone] = [len(x) for x in made]
            order.append(alone)
            runs += made
        flat = np.concatenate(runs) if runs else np.zeros(0, np.uint32)
        placed = np.concatenate(order) if order else np.zeros(0, np.int64)
        first = np.zeros(len(words), np.int64)
        first[placed] = np.cumsum(size[placed]) - size[placed]
        total = np.cumsum(size)
        return flat[np.repeat(first - total + size, size) + np.arange(len(flat))], size

    def documents(self, texts: pa.Array, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by end_id, and the n+1 offsets."""
        odd = pc.fill_null(pc.match_substring_regex(texts, _ODD_SPACE), False)
        whole = np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist()
        rest = pc.if_else(odd, pa.scalar("", texts.type), texts) if whole else texts
        codes, units, first_unit = cut_units(rest)
        flat, first, sizes = self.look_up(units)
        size = sizes[codes]
        total = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=total[1:])
        ids = flat[np.repeat(first[codes] - total[:-1], size) + np.arange(total[-1])]
        offsets = total[first_unit] + np.arange(len(texts) + 1)
        out = np.full(offsets[-1], end_id, np.uint32)
        keep = np.ones(len(out), bool)
        keep[offsets[1:] - 1] = False
        out[keep] = ids
        if not whole:
            return out, offsets
        # texts that were encoded whole go between
        runs = np.split(out, offsets[1:-1])
        for i, e in zip(whole, self.encode([texts[i].as_py() for i in whole], add_special_tokens=False)):
            runs[i] = np.append(np.array(e.ids, np.uint32), np.uint32(end_id))
        return np.concatenate(runs), np.concatenate([[0], np.cumsum([len(r) for r in runs])])


def gathered(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = PASS_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches put together until a text column holds max_bytes or more."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.column(column).nbytes
        if size >= max_bytes:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def file_bytes(task: int, number: int, ids: np.ndarray, sizes: np.ndarray, docs: np.ndarray, nulls: int) -> bytes:
    """A file of the format above; docs are the ids of its documents but for the last ones, which have none."""
    starts = np.concatenate([[0], np.cumsum(sizes)])
    arrays = {"meta": np.array([task, number, len(sizes), len(ids), nulls], np.int64), "ids": ids, **joined({"starts": Offsets.arrays(starts, len(ids))})}
    if len(docs) and int(docs[-1]) - int(docs[0]) >= 1 << 62:
        arrays["docs"] = docs
    else:
        first = docs[:1]
        arrays |= {"first": first, **joined({"docs": Offsets.arrays(docs - docs[0] if len(docs) else docs, int(docs[-1] - docs[0]) if len(docs) else 1)})}
    out: list[bytes] = []
    write_flat(arrays, out.append)
    return b"".join(out)


class TokenFile:
    """A file's documents by their place in it; a buffer or a mapped file is read where it is."""

    def __init__(self, buffer):
        arrays = read_flat(buffer)
        self.task, self.number, self.n, self.n_ids, self.nulls = (int(x) for x in arrays["meta"])
        self.all_ids, self.offsets = arrays["ids"], Offsets(part(arrays, "starts"))
        self.raw = arrays.get("docs")
        if self.raw is None:
            self.docs, self.first = Offsets(part(arrays, "docs")), arrays["first"]

    def starts(self, i: np.ndarray) -> np.ndarray:
        """Where documents begin; that of n is where the last ends."""
        return self.offsets.get(i)

    def ids(self, i: int) -> np.ndarray:
        a, b = self.starts(np.array([i, i + 1]))
        return self.all_ids[a:b]

    def doc_ids(self) -> pa.Array:
        known = self.n - self.nulls
        own = self.raw if self.raw is not None else self.docs.get(np.arange(known)) + (self.first[0] if known else 0)
        return pa.concat_arrays([pa.array(own, pa.int64()), pa.nulls(self.nulls, pa.int64())])


def write_tokens(df: DataFrame, path: str, tokenizer_path: str, text: str = "text", id_col: str = "doc_id", end_id: int = END_ID, file_ids: int = FILE_IDS) -> None:
    """Writes each text's ids and end_id to files below path, in ascending order of id_col, which is a whole number.

    Spark's own writer puts the files in place once a task is done, in any store that it can write, and one that fails
    leaves none. Rows are dealt by ranges of id, and of text and place where ids are the same, so that no id gathers in
    a task; null ids come last. Null and empty texts are their end id alone; repeated rows are written once each. An
    empty table makes a folder without documents. Columns other than the two named are not read.
    """
    if not isinstance(df.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"{id_col} is no whole number")
    source = W.lean(df).select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"), F.xxhash64(F.col(f"`{text}`")).alias("tie"), F.monotonically_increasing_id().alias("row"))
    order = [F.asc_nulls_last("id"), F.asc("tie"), F.asc("row")]
    dealt = source.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number, held = TaskContext.get().partitionId(), 0, 0
        key = ("unit ids", tokenizer_path)
        encoder = W.kept(key, lambda: UnitIds(tokenizer_path))
        kind = np.uint32 if encoder.wide or end_id >= 1 << 16 else np.uint16
        ids, sizes, docs = [], [], []

        def file() -> pa.RecordBatch:
            own = pa.concat_arrays(docs)
            data = file_bytes(task, number, np.concatenate(ids), np.concatenate(sizes), own.drop_null().to_numpy(), own.null_count)
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["data"])

        for b in gathered(W.slices(batches, "text", key=key), "text"):
            made, offsets = encoder.documents(b.column("text"), end_id)
            ids.append(made.astype(kind))
            sizes.append(np.diff(offsets))
            docs.append(b.column("id"))
            held += len(made)
            if held >= file_ids:
                yield file()
                number, held = number + 1, 0
                ids, sizes, docs = [], [], []
        if held:
            yield file()

    # the text writer writes a row's bytes as they are, and a line end
    dealt.mapInArrow(run, "data binary").select(F.col("data").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).option("compression", "none").text(path)


def read_documents(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """id_col, start, n_tokens, ids_crc32 and file (task, number) of each document in the files below path.

    start counts the ids of all documents before it, over all files: files' totals add up within a task's files, and
    tasks' totals over tasks, of which there is one row each. ids_crc32 is that of the ids as little-endian 32-bit ones.
    """
    files = W.lean(spark.read.format("binaryFile").load(path)).select("content")
    schema = f"task long, number long, `{id_col}` long, at long, n_tokens long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                own = TokenFile(content.as_py())
                starts = own.starts(np.arange(own.n + 1))
                crc = np.zeros(own.n, np.int64)
                step = 1 << 10
                for a in range(0, own.n, step):
                    cuts = starts[a : a + step + 1]
                    raw = memoryview(own.all_ids[cuts[0] : cuts[-1]].astype("<u4").tobytes())
                    at = ((cuts - cuts[0]) * 4).tolist()
                    crc[a : a + step] = [zlib.crc32(raw[i:j]) for i, j in zip(at, at[1:])]
                columns = [np.full(own.n, own.task), np.full(own.n, own.number), own.doc_ids(), starts[:-1], np.diff(starts), crc]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns], names=["task", "number", id_col, "at", "n_tokens", "ids_crc32"])

    rows = hold(files.mapInArrow(run, schema))
    totals = rows.groupBy("task", "number").agg(F.sum("n_tokens").alias("__n"))
    before = lambda w: F.coalesce(F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tasks = totals.groupBy("task").agg(F.sum("__n").alias("__n")).select("task", before(Window.orderBy("task")).alias("__task"))
    bases = totals.select("task", "number", before(Window.partitionBy("task").orderBy("number")).alias("__file")).join(tasks, "task")
    found = rows.join(small_side(bases), ["task", "number"])
    return found.select(f"`{id_col}`", (F.col("__task") + F.col("__file") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "task", "number")
