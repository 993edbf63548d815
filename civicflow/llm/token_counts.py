"""Greedy word-piece lengths by a linear longest-match automaton.

The vocabulary is a trie. Each node has a failure link and the number of pieces that following it pops, so that a
word's length in pieces falls out of one walk over its characters; no piece is ever built.
"""

from __future__ import annotations

import itertools
import json
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W

#: A word's last byte is a symbol of its own, 256 above the byte, as pieces that end a word differ from those within.
ENDING = 256
SYMBOLS = 512


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str) -> list[tuple[int, ...]]:
    """Pieces of a tokenizers file with word-end marks, as symbol tuples."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    end, table, special = model["model"].get("end_of_word_suffix") or "", byte_symbols(), {x["content"] for x in model["added_tokens"]}
    out = []
    for piece in model["model"]["vocab"]:
        if piece in special:
            continue
        ends = bool(end) and piece.endswith(end)
        body = [table[c] for c in (piece[: -len(end)] if ends else piece)]
        if body:
            out.append((*body[:-1], body[-1] + ENDING * ends))
    return out


#: From this place on, so few words that are still longer are walked one by one.
LONG, FEW = 64, 32


class LongestMatch:
    """Automaton over symbol tuples; arrays only, so that it broadcasts as it is. Its size is that of the vocabulary."""

    def __init__(self, pieces: Iterable[tuple[int, ...]]):
        children: list[dict[int, int]] = [{}]
        final = [False]
        for piece in pieces:
            node = 0
            for s in piece:
                if (to := children[node].get(s)) is None:
                    to = children[node][s] = len(children)
                    children.append({})
                    final.append(False)
                node = to
            final[node] = True
        n = len(children)
        link, popped = np.full(n, -1, np.int32), np.zeros(n, np.int32)
        queue = deque([0])
        while queue:
            u = queue.popleft()
            for s, v in children[u].items():
                queue.append(v)
                if final[v]:
                    link[v], popped[v] = 0, 1
                    continue
                z, p = int(link[u]), int(popped[u])
                while z >= 0 and s not in children[z]:
                    p += int(popped[z])
                    z = int(link[z])
                if z >= 0:
                    link[v], popped[v] = children[z][s], p
        edges = sorted((u * SYMBOLS + s, v) for u, d in enumerate(children) for s, v in d.items())
        self.keys = np.array([k for k, _ in edges], np.int64)
        self.to = np.array([v for _, v in edges], np.int32)
        self.link, self.popped = link, popped

    def step(self, node: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        key = node.astype(np.int64) * SYMBOLS + symbol
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.to[at], -1)

    def lengths(self, vocab: pa.Array) -> np.ndarray:
        """Pieces of each word, all words at once by character position; a word that no pieces cover counts as one."""
        n = len(vocab)
        if not n:
            return np.zeros(0, np.int64)
        _, offsets, data = vocab.buffers()
        offsets = np.frombuffer(offsets, np.int64)[vocab.offset : vocab.offset + n + 1]
        data = np.frombuffer(data, np.uint8)
        size = np.diff(offsets)
        order = np.argsort(-size, kind="stable")
        node, count, lost = np.zeros(n, np.int32), np.zeros(n, np.int64), np.zeros(n, bool)
        live_until = np.searchsorted(-size[order], -np.arange(int(size.max()) + 1), side="left")
        for p in range(int(size.max())):
            w = order[: live_until[p]]
            w = w[~lost[w]]
            if p >= LONG and len(w) <= FEW:
                for i in w.tolist():
                    node[i], count[i], lost[i] = self._walk(data[offsets[i] + p : offsets[i + 1]].tobytes(), int(node[i]), int(count[i]))
                break
            symbol = data[offsets[w] + p].astype(np.int64) + ENDING * (size[w] == p + 1)
            self._advance(node, count, lost, w, symbol)
        left = np.flatnonzero((node > 0) & ~lost)
        while len(left):
            count[left] += self.popped[node[left]]
            node[left] = self.link[node[left]]
            lost[left[node[left] < 0]] = True
            left = left[node[left] > 0]
        count[lost] = 1
        return count

    def _walk(self, rest: bytes, node: int, count: int) -> tuple[int, int, bool]:
        """State, count and whether the word is lost after the rest of one word, symbol by symbol."""
        if not hasattr(self, "_table"):
            self._table = dict(zip(self.keys.tolist(), self.to.tolist())), self.link.tolist(), self.popped.tolist()
        table, link, popped = self._table
        for symbol in itertools.chain(rest[:-1], [rest[-1] + ENDING]):
            while (to := table.get(node * SYMBOLS + symbol)) is None:
                count += popped[node]
                node = link[node]
                if node < 0:
                    return node, count, True
            node = to
        return node, count, False

    def _advance(self, node, count, lost, w, symbol) -> None:
        while len(w):
            to = self.step(node[w], symbol)
            hit = to >= 0
            node[w[hit]] = to[hit]
            w, symbol = w[~hit], symbol[~hit]
            count[w] += self.popped[node[w]]
            node[w] = self.link[node[w]]
            gone = node[w] < 0
            lost[w[gone]] = True
            w, symbol = w[~gone], symbol[~gone]


def token_counts(df: DataFrame, automaton: LongestMatch, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns with n_words and n_tokens of each text.

    Texts are lower-cased; words are runs of letters (any non-ASCII character counts as one), single digits, and runs
    of other ASCII marks. Null and empty texts have 0 words and tokens. Each row is counted on its own, so repeated
    rows and ties give repeated results; long texts cost in proportion to their length; other columns are not read.
    """
    matcher = df.sparkSession.sparkContext.broadcast(automaton)
    kept = W.lean(df).select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("__text"))
    fields = [f for f in kept.schema.fields if f.name != "__text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in W.slices(batches, "__text"):
            w = W.split_words(pc.utf8_lower(b.column("__text").cast(pa.large_string())), classes=W.PIECES)
            length = matcher.value.lengths(w.vocab)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(f.name) for f in fields], pa.array(w.counts(), pa.int64()), pa.array(W.sums_by_doc(length[w.codes], w.doc_start), pa.int64())],
                names=[*[f.name for f in fields], "n_words", "n_tokens"],
            )

    schema = T.StructType([*fields, T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType())])
    return kept.mapInArrow(run, schema)
