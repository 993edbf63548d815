"""Splitting Arrow text columns into dictionary-coded words with whole-array NumPy passes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Bytes of a batch that Spark hands to a Python worker, and of texts that one pass works on; both bound its memory.
BATCH_BYTES = 1 << 20
PASS_BYTES = 1 << 20

#: Byte classes: 0 separates words, 1 and above are words of one class each, SINGLE is a word per byte.
SINGLE = 9



#: `[^\x20\x09-\x0D]+`
SPACED = np.ones(256, np.uint8)
SPACED[[9, 10, 11, 12, 13, 32]] = 0
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z
ALNUM = np.zeros(256, np.uint8)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = 1
#: letters and bytes of non-ASCII characters, single digits, runs of other ASCII marks
PIECES = np.full(256, 2, np.uint8)
PIECES[:33] = PIECES[127] = 0
PIECES[48:58] = SINGLE
PIECES[65:91] = PIECES[97:123] = PIECES[128:] = 1

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@dataclass
class Words:
    """Words of a batch of texts: codes into vocab, and for text i the words doc_start[i]:doc_start[i+1]."""

    codes: np.ndarray
    vocab: pa.Array
    doc_start: np.ndarray
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray
    byte_start: np.ndarray

    @property
    def n_docs(self) -> int:
        return len(self.doc_start) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.doc_start)

    def vocab_list(self) -> list[bytes]:
        return self.vocab.to_pylist()


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the n+1 byte offsets; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def split_words(texts: pa.Array, lower: bool = False, classes: np.ndarray = SPACED) -> Words:
    data, byte_start = text_bytes(texts)
    if lower:
        data = LOWER[data]
    n = len(data)
    cls = classes[data]
    before = np.zeros(n, np.uint8)
    before[1:] = cls[:-1]
    starts = byte_start[:-1]
    before[starts[starts < n]] = 0
    inside = cls > 0
    first = inside & ((cls != before) | (cls == SINGLE))
    start = np.flatnonzero(first)
    # a word ends where the next begins or its class stops
    after_is_new = np.ones(n + 1, bool)
    after_is_new[:n] = first | ~inside
    after_is_new[byte_start] = True
    end = np.flatnonzero(inside & after_is_new[1:]) + 1
    lengths = end - start
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    packed = np.ascontiguousarray(data[inside])
    words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
    coded = words.dictionary_encode()
    return Words(coded.indices.to_numpy(), coded.dictionary, np.searchsorted(start, byte_start), start, end, data, byte_start)


def lean(df: DataFrame) -> DataFrame:
    """df, with its session's Arrow batches bounded by bytes, as rows may hold texts of any length."""
    name, conf = "spark.sql.execution.arrow.maxBytesPerBatch", df.sparkSession.conf
    if conf.get(name, None) != f"{BATCH_BYTES}b":
        conf.set(name, f"{BATCH_BYTES}b")
    return df


def give_back() -> None:
    """Freed memory of the C allocator back to the system, where the library can do so."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


_KEPT: dict[tuple, object] = {}


def kept(key: tuple, make: Callable[[], object]) -> object:
    """What a worker keeps between tasks of one operator; it goes when the worker serves another."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = PASS_BYTES, key: tuple = ()) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the named text column holds about max_bytes at most, one row at least.

    The worker's arrays come from the system's allocator, which gives large ones back at once. key is that of what
    the operator keeps, if it does.
    """
    if key not in _KEPT:
        _KEPT.clear()
    pa.set_memory_pool(pa.system_memory_pool())
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = np.cumsum(size) // max_bytes
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            yield batch.slice(a, b - a)
        give_back()


def sums_by_doc(values: np.ndarray, doc_start: np.ndarray) -> np.ndarray:
    """Sum of per-word values for each text."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[doc_start[1:]] - total[doc_start[:-1]]


def as_batch(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name].cast(f.type) for f in schema], schema=schema)
