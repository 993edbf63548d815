"""Elias-Fano sequences and an n-gram trie made of them, for whole-array queries over flat, memory-mapped levels."""

from __future__ import annotations

import json
import mmap
import os
import tempfile
from collections.abc import Callable

import numpy as np

#: _SELECT[b, k]: place of the k-th one of byte b
_SELECT = np.zeros((256, 8), np.uint64)
for _b in range(256):
    for _k, _p in enumerate([p for p in range(8) if _b >> p & 1]):
        _SELECT[_b, _k] = _p
_ONES, _TOPS = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
_U = [np.uint64(i) for i in range(65)]
#: Queries, and rows of a sequence, that one pass works on; this bounds what it holds.
PASS = 1 << 16


def _byte_ones(words: np.ndarray) -> np.ndarray:
    """Ones of each byte of 64-bit words, in the bytes' places."""
    s = words - ((words >> _U[1]) & np.uint64(0x5555555555555555))
    s = (s & np.uint64(0x3333333333333333)) + ((s >> _U[2]) & np.uint64(0x3333333333333333))
    return (s + (s >> _U[4])) & np.uint64(0x0F0F0F0F0F0F0F0F)


def _select(words: np.ndarray, before: np.ndarray, k: np.ndarray, flip: bool = False) -> np.ndarray:
    """Place of the k-th one of a bitmap of 64-bit words (zero, if flipped); before[i] of them stand before word i."""
    at = np.searchsorted(before, k, side="right") - 1
    word = ~words[at] if flip else words[at]
    left = (k - before[at]).astype(np.uint64)
    upto = _byte_ones(word) * _ONES  # byte b: ones in bytes 0 to b
    place = (((((left * _ONES) | _TOPS) - upto) & _TOPS) >> _U[7]) * _ONES >> _U[56] << _U[3]
    left = left - ((upto << _U[8]) >> place & np.uint64(255))
    return at * 64 + (place + _SELECT[(word >> place & np.uint64(255)).astype(np.int64), left.astype(np.int64)]).astype(np.int64)


class EliasFano:
    """A sorted sequence of non-negative integers in about 2 + log2(universe / n) bits each, and a quarter for places.

    Its arrays are flat, so that they can be views of one buffer or of a memory-mapped file.
    """

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.n, self.low_bits, self.universe = (int(x) for x in arrays["head"])
        self.high, self.ones, self.low = arrays["high"], arrays["ones"], arrays["low"]
        self.zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones

    @staticmethod
    def arrays(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
        """The arrays of a sequence of values up to universe."""
        values, n, universe = np.asarray(values, np.int64), len(values), max(int(universe), 1)
        low_bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        bits = np.zeros(((n + (universe >> low_bits) + 1 + 63) // 64 + 1) * 64, bool)
        bits[(values >> low_bits) + np.arange(n)] = True
        high = np.packbits(bits, bitorder="little").view("<u8")
        ones = np.concatenate([[0], np.cumsum((_byte_ones(high) * _ONES >> _U[56]).astype(np.int64))])[:-1]
        packed = [np.zeros(0, np.uint8)]
        for a in range(0, n if low_bits else 0, PASS):
            packed.append(np.packbits((values[a : a + PASS, None] >> np.arange(low_bits) & 1).astype(bool).ravel(), bitorder="little"))
        return {"head": np.array([n, low_bits, universe], np.int64), "high": high, "ones": ones, "low": np.concatenate([*packed, np.zeros(16, np.uint8)])}

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        return cls(cls.arrays(values, universe))

    @property
    def nbytes(self) -> int:
        return sum(a.nbytes for a in (self.high, self.ones, self.low))

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.int64)
        at = i * self.low_bits
        byte, out = at >> 3, np.zeros(len(i), np.uint64)
        for k in range((self.low_bits + 14) // 8):
            out |= self.low[byte + k].astype(np.uint64) << _U[8 * k]
        return ((out >> (at & 7).astype(np.uint64)) & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        i = np.asarray(i, np.int64)
        return ((_select(self.high, self.ones, i) - i) << self.low_bits) | self._low(i)

    def _before_high(self, h: np.ndarray) -> np.ndarray:
        """Elements whose high part is less than h."""
        return np.where(h > 0, _select(self.high, self.zeros, np.maximum(h - 1, 0), flip=True) - (h - 1), 0)

    def successor(self, x: np.ndarray, lo: np.ndarray | int = 0, hi: np.ndarray | int | None = None) -> np.ndarray:
        """Index of the first element of lo:hi not less than each x, which is at most the universe; hi if there is none."""
        return self._place(np.asarray(x, np.int64), lo, hi)[0]

    def _place(self, x: np.ndarray, lo: np.ndarray | int, hi: np.ndarray | int | None) -> tuple[np.ndarray, np.ndarray]:
        """Successors of x in lo:hi, and the end of the elements there with a high part of at most that of x."""
        h = x >> self.low_bits
        hi = self.n if hi is None else hi
        lo, hi = np.clip(self._before_high(h), lo, hi), np.clip(self._before_high(h + 1), lo, hi)
        end, want = hi.copy(), x & ((1 << self.low_bits) - 1)
        while True:  # the elements of one high part are few; halve all ranges together
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo, end
            mid = (lo[open_] + hi[open_]) >> 1
            less = self._low(mid) < want[open_]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]

    def find(self, x: np.ndarray, lo: np.ndarray | int = 0, hi: np.ndarray | int | None = None) -> np.ndarray:
        """Index of each x in lo:hi, or -1."""
        x = np.asarray(x, np.int64)
        if not self.n:
            return np.full(len(x), -1, np.int64)
        at, end = self._place(np.minimum(x, self.universe), lo, hi)
        # Elements before end have the high part of x, so the low parts tell.
        same = self._low(np.minimum(at, self.n - 1)) == x & ((1 << self.low_bits) - 1)
        return np.where((at < end) & (x <= self.universe) & same, at, -1)


class Children:
    """A trie level: the words below each node of the level above, in rising order, and pointers to where they start.

    A word is kept relative to its context: one more than it, plus the last value of the contexts before, so that the
    whole level rises. A query reads the pointers of its context and takes the successor between them.
    """

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.pointer, self.words = EliasFano(part(arrays, "pointer")), EliasFano(part(arrays, "words"))

    @staticmethod
    def arrays(parent: np.ndarray, word: np.ndarray, parents: int) -> dict[str, np.ndarray]:
        """parent rises and counts from 0; word rises within a parent."""
        start = np.searchsorted(parent, np.arange(parents + 1))
        last = np.zeros(parents, np.int64)
        some = start[1:] > start[:-1]
        last[some] = word[start[1:][some] - 1] + 1
        base = np.cumsum(last) - last
        rising = word + 1 + base[parent] if len(word) else np.zeros(0, np.int64)
        return joined({"pointer": EliasFano.arrays(start, len(word)), "words": EliasFano.arrays(rising, int(last.sum()))})

    def find(self, parent: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Index in the level of each word below its parent, or -1; -1 for a parent is none.

        Neighbours with the same parent read its pointers once.
        """
        out = np.full(len(parent), -1, np.int64)
        for a in range(0, len(parent), PASS):
            own, w = parent[a : a + PASS], word[a : a + PASS]
            some = np.flatnonzero(own >= 0)
            if not len(some) or not self.words.n:
                continue
            new = np.append(True, own[some][1:] != own[some][:-1])
            node, run = own[some][new], np.cumsum(new) - 1
            lo, hi = self.pointer.get(node), self.pointer.get(node + 1)
            base = np.where(lo > 0, self.words.get(np.maximum(lo - 1, 0)), 0)
            here = (lo < hi)[run]
            some, run = some[here], run[here]
            out[a + some] = self.words.find(w[some] + 1 + base[run], lo[run], hi[run])
        return out


class Quantised:
    """Positive numbers as codes of 8 bits: 255 equal steps of their logarithms, each standing for the mean of those in it."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.code, self.book = arrays["code"], arrays["book"]

    @staticmethod
    def arrays(values: np.ndarray) -> dict[str, np.ndarray]:
        logs = np.log10(values) if len(values) else np.zeros(0)
        least = logs.min(initial=0.0)
        step = max((logs.max(initial=least) - least) / 254.999, 1e-12)
        code = ((logs - least) / step).astype(np.int64).clip(0, 254)
        total, n = np.bincount(code, logs, 255), np.bincount(code, minlength=255)
        return {"code": code.astype(np.uint8), "book": 10 ** (total / np.maximum(n, 1))}

    def codes(self, i: np.ndarray) -> np.ndarray:
        """The codes at places i; 255 where i is -1."""
        return np.where(i >= 0, self.code[i], np.uint8(255)) if len(self.code) else np.full(len(i), 255, np.uint8)

    def get(self, i: np.ndarray, none: float) -> np.ndarray:
        """The numbers at places i; none where i is -1."""
        return np.append(self.book, none)[self.codes(i)]


class NgramTrie:
    """Discounted probabilities of bigrams and trigrams over numbered words, and what each bigram leaves to shorter ones.

    Level 1 holds the first words, level 2 the words that follow them, level 3 those that follow these pairs.
    """

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.first = EliasFano(part(arrays, "first"))
        self.second, self.third = Children(part(arrays, "second")), Children(part(arrays, "third"))
        self.weight2, self.weight3, self.left3 = (Quantised(part(arrays, x)) for x in ("weight2", "weight3", "left3"))

    @staticmethod
    def arrays(pairs: np.ndarray, pair_counts: np.ndarray, first_counts: np.ndarray, parent: np.ndarray, word: np.ndarray, counts: np.ndarray, discount: float) -> dict[str, np.ndarray]:
        """pairs: sorted u << 32 | v; first_counts: of each different u; parent: the pair's index of each triple, sorted, and its last word."""
        first, of = np.unique(pairs >> 32, return_inverse=True)
        followers = np.bincount(parent, minlength=len(pairs))
        return joined({
            "first": EliasFano.arrays(first, first[-1] if len(first) else 0),
            "second": Children.arrays(of, pairs & 0xFFFFFFFF, len(first)),
            "third": Children.arrays(parent, word, len(pairs)),
            "weight2": Quantised.arrays((pair_counts - discount) / first_counts[of]),
            "weight3": Quantised.arrays((counts - discount) / pair_counts[parent]),
            "left3": Quantised.arrays(discount * np.maximum(followers, 1) / pair_counts),
        })

    def pair(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        return self.second.find(np.concatenate([np.zeros(0, np.int64), *[self.first.find(u[a : a + PASS]) for a in range(0, len(u), PASS)]]), v)

    def triple(self, pair: np.ndarray, w: np.ndarray) -> np.ndarray:
        return self.third.find(pair, w)


def part(arrays: dict[str, np.ndarray], name: str) -> dict[str, np.ndarray]:
    return {k[len(name) + 1 :]: a for k, a in arrays.items() if k.startswith(name + "/")}


def joined(parts: dict[str, dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return {f"{name}/{k}": a for name, own in parts.items() for k, a in own.items()}


def write_flat(arrays: dict[str, np.ndarray], write: Callable[[bytes], object]) -> None:
    """A header that says what stands where, and the arrays one after the other at multiples of eight bytes."""
    head, at = {}, 0
    for name, a in arrays.items():
        head[name] = [a.dtype.str, at, len(a)]
        at += -(-a.nbytes // 8) * 8
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 8)
    write(len(text).to_bytes(8, "little") + text)
    for a in arrays.values():
        write(np.ascontiguousarray(a).tobytes() + bytes(-a.nbytes % 8))


def read_flat(buffer: bytes | mmap.mmap) -> dict[str, np.ndarray]:
    """Views of the arrays; nothing is copied."""
    size = int.from_bytes(buffer[:8], "little")
    return {name: np.frombuffer(buffer, dtype, n, 8 + size + at) for name, (dtype, at, n) in json.loads(buffer[8 : 8 + size]).items()}


def mapped(arrays: dict[str, np.ndarray], folder: str | None) -> dict[str, np.ndarray]:
    """The arrays as views of a file in the folder that is mapped into memory, and goes with the last view.

    Where the folder is none that this machine can open, they are views of one buffer.
    """
    if folder is None or not os.path.isdir(folder):
        whole: list[bytes] = []
        write_flat(arrays, whole.append)
        return read_flat(b"".join(whole))
    with tempfile.TemporaryFile(dir=folder) as f:
        write_flat(arrays, f.write)
        f.flush()
        return read_flat(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
