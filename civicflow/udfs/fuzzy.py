"""String similarity: 0 to 100, by matching blocks."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from difflib import SequenceMatcher
from heapq import heappush, heappushpop

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.chains import looked_up
from ..operators.project import q
from ..state.lineage import cut


def ratio(a: str, b: str) -> int:
    return round(100 * SequenceMatcher(None, a, b, autojunk=False).ratio()) if a and b else 0


def partial_ratio(a: str, b: str) -> int:
    """The shorter text against its best aligned window of the longer."""
    if not a or not b:
        return 0
    short, long_ = sorted((a, b), key=len)
    best = 0.0
    for block in SequenceMatcher(None, short, long_, autojunk=False).get_matching_blocks():
        start = max(0, block.b - block.a)
        score = SequenceMatcher(None, short, long_[start : start + len(short)], autojunk=False).ratio()
        best = max(best, score)
        if best > 0.995:
            return 100
    return round(100 * best)


def token_sort_ratio(a: str, b: str) -> int:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def weighted_ratio(a: str, b: str) -> int:
    """The best of plain, sorted-word and, for texts of unlike length, partial similarity at a discount."""
    if not a or not b:
        return 0
    unlike = max(len(a), len(b)) / min(len(a), len(b)) >= 1.5
    return round(max(ratio(a, b), 0.95 * token_sort_ratio(a, b), 0.9 * partial_ratio(a, b) if unlike else 0))


SCORERS = {"ratio": ratio, "partial": partial_ratio, "weighted": weighted_ratio, "token_sort": token_sort_ratio}


def similarity(kind: str = "partial"):
    scorer = SCORERS[kind]

    @F.pandas_udf("int")
    def score(a: pd.Series, b: pd.Series) -> pd.Series:
        memo: dict[tuple, int] = {}
        out = []
        for pair in zip(a, b):
            if pair[0] is None or pair[1] is None:
                out.append(None)
                continue
            if pair not in memo:
                memo[pair] = scorer(*pair)
            out.append(memo[pair])
        return pd.Series(out, dtype="Int32")

    return score


#: Different texts and candidates of a block that meet in one group.
LOT_TEXTS, LOT_OPTIONS = 512, 8192
#: Pairs that are bounded at once, few enough for their arrays to be used again and again instead of coming new from the system.
PAIRS = 8192
#: Tasks in which groups meet, two for each of them and so many at most; their bytes do not tell how much work they are.
MEETINGS = 4096
#: Texts of up to so many characters, a bit of a word each, are aligned with options of up to so many.
ALIGNED_TEXT, ALIGNED_OPTION = 64, 256
#: Characters fall into so many buckets, each of which counts to LEVELS; bigrams fall into as many bits.
BUCKETS, LEVELS = 64, 4


def _bits(places: list[list[int]]) -> np.ndarray:
    """Rows of 256 bits, as four words, with the named ones set."""
    flags = np.zeros((len(places), 256), bool)
    for i, own in enumerate(places):
        flags[i, own] = True
    return np.packbits(flags, axis=1, bitorder="little").view("<u8")


class Signatures:
    """What bounds the characters that texts can have in common: counts of characters, and which bigrams there are.

    A bucket of characters has one bit for each of its first LEVELS characters, so common bits are common characters;
    those above are counted apart.
    """

    def __init__(self, texts: Sequence[str]):
        self.length = np.array([len(t) for t in texts], np.int64)
        chars, over, pairs = [], [], []
        for t in texts:
            counts = Counter(ord(c) % BUCKETS for c in t)
            chars.append([b * LEVELS + i for b, n in counts.items() for i in range(min(n, LEVELS))])
            over.append(sum(max(0, n - LEVELS) for n in counts.values()))
            pairs.append([(ord(x) * 37 + ord(y)) % 256 for x, y in zip(t, t[1:])])
        self.chars, self.over, self.pairs = _bits(chars), np.array(over, np.int64), _bits(pairs)
        self.texts, self._columns = texts, None

    def columns(self) -> tuple[dict[str, int], np.ndarray]:
        """A number for each character, and the numbers at each place of all texts, a row a place; no character is the last one."""
        if self._columns is None:
            known = {c: n for n, c in enumerate(sorted({c for t in self.texts if len(t) <= ALIGNED_OPTION for c in t}))}
            out = np.full((min(int(self.length.max(initial=0)), ALIGNED_OPTION), len(self.texts)), len(known), np.int32)
            for i, t in enumerate(self.texts):
                if len(t) <= ALIGNED_OPTION:
                    out[: len(t), i] = [known[c] for c in t]
            self._columns = known, out
        return self._columns

    def in_order(self, i: int, j: np.ndarray, other: Signatures) -> np.ndarray:
        """The longest common subsequences of text i and the others' j, whose characters matching blocks are part of.

        Each column of all others is one step on words of 64 bits, of which zeros count what is common (Hyyro's recurrence).
        """
        known, columns = other.columns()
        marks = np.zeros(len(known) + 1, np.uint64)
        for at, c in enumerate(self.texts[i]):
            if c in known:
                marks[known[c]] |= np.uint64(1 << at)
        v = np.full(len(j), ~np.uint64(0))
        for row in columns:
            u = v & marks[row[j]]
            v = (v + u) | (v - u)
        return np.bitwise_count(~v).astype(np.int64)

    def common(self, i: slice, other: Signatures) -> np.ndarray:
        """At least as many characters as texts i have in common with each of the others."""
        n = np.minimum(self.over[i, None], other.over[None, :])
        for w in range(4):
            n += np.bitwise_count(self.chars[i, w, None] & other.chars[None, :, w])
        return np.minimum(n, np.minimum(self.length[i, None], other.length[None, :]))

    def in_blocks(self, i: np.ndarray, j: np.ndarray, other: Signatures) -> np.ndarray:
        """At least as many characters as matching blocks of texts i and the others' j hold, by bigrams that one has alone.

        With m characters in blocks there are at most a + b - 2 m others, so at most one more block than that, and so at
        least 3 m - a - b - 1 bigrams inside blocks, which both texts have.
        """
        a, b = self.length[i], other.length[j]
        mine = np.bitwise_count(self.pairs[i] & ~other.pairs[j]).sum(axis=1)
        theirs = np.bitwise_count(other.pairs[j] & ~self.pairs[i]).sum(axis=1)
        return (np.minimum(a - 1 - mine, b - 1 - theirs) + a + b + 1) // 3


class Bounds:
    """Bounds from above on the scores of texts and options, before any is worked out; -1 where one of them is missing."""

    def __init__(self, texts: Sequence[str | None], options: Sequence[str | None], kind: str):
        self.kind = kind
        sort = lambda x: [" ".join(sorted(t.split())) for t in x]
        one, two = [t or "" for t in texts], [t or "" for t in options]
        self.none = np.array([t is None for t in texts]), np.array([t is None for t in options])
        self.plain = None if kind == "token_sort" else (Signatures(one), Signatures(two))
        self.sorted = (Signatures(sort(one)), Signatures(sort(two))) if kind in ("token_sort", "weighted") else None

    @staticmethod
    def _share(common: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return np.minimum(100.0, 100.0 * common / np.maximum(whole, 1))

    def _part(self, common: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of the shorter text and a window of the other, which at its end has no more than what they have in common."""
        return self._share(2 * common, np.minimum(a, b) + common)

    def rough(self, i: slice) -> np.ndarray:
        """Of texts i and all options, by the characters that they have in common."""
        if self.kind == "token_sort":
            a, b = self.sorted
            out = self._share(2 * a.common(i, b), a.length[i, None] + b.length[None, :])
        else:
            a, b = self.plain
            common = a.common(i, b)
            out = self._part(common, a.length[i, None], b.length[None, :]) if self.kind == "partial" else self._share(2 * common, a.length[i, None] + b.length[None, :])
        if self.kind == "weighted":
            c, d = self.sorted
            out = np.maximum(out, 0.95 * (0.5 + self._share(2 * c.common(i, d), c.length[i, None] + d.length[None, :])))
            long_ = np.maximum(a.length[i, None], b.length[None, :]) >= 1.5 * np.minimum(a.length[i, None], b.length[None, :])
            out = np.where(long_, np.maximum(out, 0.9 * (0.5 + self._part(common, a.length[i, None], b.length[None, :]))), out)
        out = out + 0.5  # scores are rounded
        out[self.none[0][i], :] = -1
        out[:, self.none[1]] = -1
        return out

    def close(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Of pairs, by their bigrams; only what is one comparison of whole texts is bounded by these."""
        if self.kind not in ("ratio", "token_sort"):
            return np.full(len(i), 101.0)
        a, b = self.plain if self.kind == "ratio" else self.sorted
        return self._share(2 * a.in_blocks(i, j, b), a.length[i] + b.length[j]) + 0.5

    def aligned(self, i: int, j: np.ndarray) -> np.ndarray:
        """Of text i and options j, by what they have in common in one order; rounded as scores are."""
        out = np.full(len(j), 101.0)
        if self.kind in ("ratio", "token_sort"):
            a, b = self.plain if self.kind == "ratio" else self.sorted
            if a.length[i] <= ALIGNED_TEXT:
                short = np.flatnonzero(b.length[j] <= ALIGNED_OPTION)
                out[short] = np.rint(100 * (2.0 * a.in_order(i, j[short], b) / np.maximum(a.length[i] + b.length[j[short]], 1)))
        return out


def best_options(texts: Sequence[tuple], options: Sequence[tuple], k: int, threshold: float, kind: str) -> list[list[tuple[float, int]]]:
    """For each text the (score, option number) of its k best options of the threshold or more, of equal ones the later.

    Texts and options are tuples of fields; a score is the mean over the fields that both have, 0 if there are none.
    Options are scored in the order of their bounds, until no bound reaches the k-th best score.
    """
    scorer, fields = SCORERS[kind], range(len(texts[0]))
    bounds = [Bounds([t[f] for t in texts], [o[f] for o in options], kind) for f in fields]
    out = []
    step = max(1, PAIRS // max(1, len(options)))
    for lo in range(0, len(texts), step):
        rough = [b.rough(slice(lo, lo + step)) for b in bounds]
        known = sum((r >= 0).astype(np.int64) for r in rough)
        mean = sum(np.maximum(r, 0) for r in rough) / np.maximum(known, 1)
        for i in range(len(mean)):
            some = np.flatnonzero(mean[i] >= threshold)
            own = mean[i][some]
            if len(bounds) == 1 and len(some):
                own = np.where(known[i][some] > 0, np.minimum(own, bounds[0].close(np.full(len(some), lo + i), some)), own)
                left = own >= threshold
                some, own = some[left], own[left]
                own = np.where(known[i][some] > 0, np.minimum(own, bounds[0].aligned(lo + i, some)), own)
            best: list[tuple[float, int]] = []  # the worst first
            for n in np.argsort(-own, kind="stable"):
                if own[n] < (best[0][0] if len(best) == k else threshold):
                    break
                j = int(some[n])
                scores = [scorer(a, b) for a, b in zip(texts[lo + i], options[j]) if a is not None and b is not None]
                score = sum(scores) / len(scores) if scores else 0.0
                if score >= threshold and (len(best) < k or (score, j) > best[0]):
                    (heappush if len(best) < k else heappushpop)(best, (score, j))
            out.append(sorted(best, reverse=True))
    return out


def top_matches(df: DataFrame, candidates: DataFrame, fields: Sequence[tuple[str, str]], k: int = 5, threshold: float = 0, kind: str = "weighted", blocks: Sequence[str] = ()) -> DataFrame:
    """df with matches: the k best candidates of at least the threshold, as structs of score and the candidate's fields.

    fields pairs columns of df with columns of candidates; a score is the mean over the fields that both have, or 0. Of
    equal scores the greater fields come first. Rows and candidates have the block columns in common, if there are any;
    a null in one matches nothing. Rows without any field have no matches.

    Different texts of a block meet its different candidates in groups of bounded size. There, counts of common
    characters and bigrams, then common subsequences, bound scores, words of 64 bits at a time; few pairs are scored
    themselves.
    """
    block = F.to_json(F.struct(*map(q, blocks))) if blocks else F.lit("")
    known = F.lit(True)
    for b in blocks:
        known = known & q(b).isNotNull()
    some = lambda cols: F.coalesce(*[q(c) for c in cols]).isNotNull()
    left, right = [f for f, _ in fields], [f for _, f in fields]
    entry = lambda cols: F.struct(*[q(c).cast("string").alias(f"f{i}") for i, c in enumerate(cols)])
    texts = df.where(known & some(left)).select(block.alias("__b"), entry(left).alias("__t")).distinct()
    options = candidates.where(known & some(right)).select(block.alias("__b"), entry(right).alias("__o")).distinct()
    sizes = []
    for rows, n, most in ((texts, "__nt", LOT_TEXTS), (options, "__no", LOT_OPTIONS)):
        sizes.append(rows.groupBy("__b").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias(n), F.count(F.lit(1)).alias(f"{n}_rows")))
    plan = cut(sizes[0].join(sizes[1], "__b"))
    totals = plan.agg(*[F.coalesce(F.sum(f"{n}_rows"), F.lit(0)) for n in ("__nt", "__no")], F.coalesce(F.sum(q("__nt").cast("long") * q("__no")), F.lit(0))).first()
    lots = ["__b", "__nt", "__no"]
    mine = looked_up(texts, plan.select(*lots, "__nt_rows"), "__b", "__nt_rows", totals[0])
    dealt = mine.withColumn("__p", F.pmod(F.xxhash64("__t"), F.col("__nt")).cast("int")).withColumn("__r", F.explode(F.sequence(F.lit(0), F.col("__no") - 1))).select("__b", "__p", "__r", "__t")
    theirs = looked_up(options, plan.select(*lots, "__no_rows"), "__b", "__no_rows", totals[1])
    offered = theirs.withColumn("__r", F.pmod(F.xxhash64("__o"), F.col("__no")).cast("int")).withColumn("__p", F.explode(F.sequence(F.lit(0), F.col("__nt") - 1))).select("__b", "__p", "__r", "__o")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        own, given = ([tuple(x.values()) for x in t.column(c).to_pylist()] for t, c in ((left, "__t"), (right, "__o")))
        order = sorted(range(len(given)), key=lambda i: tuple((x is not None, x or "") for x in given[i]))
        found = best_options(own, [given[i] for i in order], k, threshold, kind) if own and given else []
        i = [n for n, f in enumerate(found) for _ in f]
        return pa.table({"__b": left.column("__b").take(pa.array(i, pa.int64())), "__t": left.column("__t").take(pa.array(i, pa.int64())), "score": pa.array([s for f in found for s, _ in f], pa.float64()), "__o": right.column("__o").take(pa.array([order[j] for f in found for _, j in f], pa.int64()))})

    shape = T.StructType([*dealt.select("__b", "__t").schema.fields, T.StructField("score", T.DoubleType()), offered.schema["__o"]])
    keys = ["__b", "__p", "__r"]
    tasks = max(1, min(2 * totals[2], MEETINGS))
    scored = dealt.repartition(tasks, *keys).groupBy(*keys).cogroup(offered.repartition(tasks, *keys).groupBy(*keys)).applyInArrow(run, shape)
    named = F.struct(F.col("score"), *[F.col("__o")[f"f{i}"].alias(c) for i, c in enumerate(right)])
    best = scored.groupBy("__b", "__t").agg(F.slice(F.reverse(F.array_sort(F.collect_list(F.struct("score", "__o", named.alias("m"))))), 1, k).alias("__m"))
    best = best.select(F.col("__b").alias("__block"), F.col("__t").alias("__text"), F.transform("__m", lambda x: x["m"]).alias("matches"))
    marked = df.withColumn("__block", F.when(known, block)).withColumn("__text", entry(left))
    joined = marked.join(best, ["__block", "__text"], "left")
    return joined.select(*map(q, df.columns), F.coalesce("matches", F.array().cast(best.schema["matches"].dataType)).alias("matches"))


def best_match(df: DataFrame, candidates: DataFrame, text: str, candidate: str, blocks: Sequence[str], threshold: int, kind: str = "ratio", keep_below: bool = False) -> DataFrame:
    """df with match and match_score: the best candidate of the same block columns; of equal scores the greatest text.

    Below the threshold there is no match unless keep_below.
    """
    if not blocks:
        raise ValueError("name the columns that a row and its candidates share")
    found = top_matches(df, candidates, [(text, candidate)], 1, 0 if keep_below else threshold, kind, blocks)
    first = F.get("matches", F.lit(0))
    return found.select(*map(q, df.columns), first[candidate].alias("match"), first["score"].cast("int").alias("match_score"))
