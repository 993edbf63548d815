"""Quality rules with host-level verdicts: rule failures by host, shrunk with an empirical beta prior."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .storage import hold, small_side

METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
#: A host whose shrunk failure rate of a rule reaches this has that rule turned against each of its failing documents.
HOST_RATE = 0.5
#: Least strength, in documents, of the prior.
MIN_PRIOR = 2.0

#: Soft rules: one alone does not reject a document, but it does where most of the host fails it.
SOFT_RULES = {
    "symbols": "n_symbols * 10 > n_words",
    "dup_lines": "n_dup_lines >= 3",
    "word_length": "word_chars < 2 * n_words or word_chars > 15 * n_words",
    "repeats": "100 * n_repeat_words > 30 * n_words",
}


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def repeat_words(codes: np.ndarray, n: int) -> int:
    """Words inside n-word windows that occur twice or more, the first occurrence included."""
    if len(codes) < n + 1:
        return 0
    key = codes[: len(codes) - n + 1].astype(np.uint64)
    for i in range(1, n):
        key = (key << np.uint64(21)) | codes[i : len(codes) - n + 1 + i].astype(np.uint64)
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    inside = np.zeros(len(codes), bool)
    for i in range(n):
        inside[i : i + len(key)] |= twice
    return int(inside.sum())


def dup_lines(text: bytes) -> int:
    if b"\n" not in text:
        return 0
    seen, found = set(), 0
    for line in text.split(b"\n"):
        if line in seen:
            found += 1
        elif line.strip():
            seen.add(line)
    return found


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """The five metrics of each text. Windows are exact: codes of a slice have at most 21 bits, as it has 1 MB at most, but for one long text."""
    w = W.split_words(texts)
    if len(w.vocab) >= 1 << 21:  # a single huge text: number its words as they are; windows compare in two steps
        own = [huge(w)] if w.n_docs == 1 else [[x[m][0] for m in METRICS] for x in (measure(texts.slice(i, 1)) for i in range(w.n_docs))]
        return dict(zip(METRICS, np.array(own, np.int64).T))
    n = w.n_docs
    raw = w.data.tobytes()
    leads = np.zeros(len(w.data) + 1, np.int64)
    np.cumsum(((w.data & 0xC0) != 0x80) & (W.SPACED[w.data] > 0), out=leads[1:])
    marks = np.zeros(len(w.data) + 1, np.int64)
    np.cumsum(SYMBOLS[w.data], out=marks[1:])
    lo, hi = w.byte_start[:-1], w.byte_start[1:]
    cuts = w.doc_start.tolist()
    return {
        "n_words": w.counts().astype(np.int64),
        "word_chars": leads[hi] - leads[lo],
        "n_symbols": marks[hi] - marks[lo],
        "n_dup_lines": np.array([dup_lines(raw[a:b]) for a, b in zip(lo.tolist(), hi.tolist())], np.int64),
        "n_repeat_words": np.array([repeat_words(w.codes[cuts[i] : cuts[i + 1]], 3) for i in range(n)], np.int64),
    }


def huge(w: W.Words) -> tuple[int, int, int, int, int]:
    """The same for one text with over two million distinct words: pairs are numbered first, then pairs with a word."""
    chars = int((((w.data & 0xC0) != 0x80) & (W.SPACED[w.data] > 0)).sum())
    codes = w.codes.astype(np.int64)
    pairs = np.unique(codes[:-1] * len(w.vocab) + codes[1:], return_inverse=True)[1]
    triples = np.unique(pairs[:-1] * len(w.vocab) + codes[2:], return_inverse=True, return_counts=True)
    twice = triples[2][triples[1]] > 1
    inside = np.zeros(len(codes), bool)
    for i in range(3):
        inside[i : i + len(twice)] |= twice
    return len(codes), chars, int(SYMBOLS[w.data].sum()), dup_lines(w.data.tobytes()), int(inside.sum())


def metrics_udf():
    @F.pandas_udf(T.StructType([T.StructField(m, T.LongType()) for m in METRICS]))
    def metrics(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string(), from_pandas=True)], names=["t"])
            found = [pd.DataFrame(measure(b.column("t"))) for b in W.slices(iter([batch]), "t")]
            yield pd.concat(found, ignore_index=True) if found else pd.DataFrame({m: np.zeros(0, np.int64) for m in METRICS})

    return metrics.asNondeterministic()  # else it is worked out twice, for a filter that is pushed down and for the rest


def text_metrics(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """keep (renamed k0, k1, ...) and the five metrics, over Arrow batches."""
    source = W.lean(df).select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").cast("string").alias("__text"))
    kept = source.schema.fields[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in W.slices(batches, "__text"):
            found = measure(b.column("__text"))
            yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in kept], *[pa.array(found[m], pa.int64()) for m in METRICS]], names=[*[f.name for f in kept], *METRICS])

    return source.mapInArrow(run, T.StructType([*kept, *[T.StructField(m, T.LongType()) for m in METRICS]]))


def host_verdicts(measured: DataFrame, host: str, rate: float = HOST_RATE) -> DataFrame:
    """host and bad_<rule> of each host that a soft rule is turned against.

    A rule's failures by host follow a beta-binomial; its prior's mean and strength come from the hosts' own rates by
    the method of moments, so a host with few documents keeps close to the others. All counts are partial sums first.
    """
    fails = {r: F.coalesce(F.expr(c), F.lit(False)).cast("long") for r, c in SOFT_RULES.items()}
    by_host = measured.where(F.col(host).isNotNull()).groupBy(host).agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"f_{r}") for r, c in fails.items()])
    moments = by_host.agg(F.avg(1 / F.col("n")).alias("inv"), *[x for r in SOFT_RULES for x in (F.avg(F.col(f"f_{r}") / F.col("n")).alias(f"m_{r}"), F.var_pop(F.col(f"f_{r}") / F.col("n")).alias(f"v_{r}"))])
    both = by_host.crossJoin(F.broadcast(moments))  # one row of moments
    for r in SOFT_RULES:
        m, v = F.col(f"m_{r}"), F.col(f"v_{r}")
        spread = m * (1 - m)
        between = F.greatest(v - spread * F.col("inv"), spread * 1e-3)  # the hosts' variance without that of sampling
        strength = F.greatest(F.lit(MIN_PRIOR), F.when(between > 0, spread / between - 1).otherwise(F.lit(1e6)))
        shrunk = (F.col(f"f_{r}") + m * strength) / (F.col("n") + strength)
        both = both.withColumn(f"bad_{r}", shrunk >= rate)
    bad = [F.col(f"bad_{r}") for r in SOFT_RULES]
    return small_side(both.where(F.greatest(*bad)).select(host, *bad))


def judge(measured: DataFrame, verdicts: DataFrame, host: str) -> DataFrame:
    """measured with base_failed and kept: false by the base rules, or if the host's verdict hits what the row fails."""
    joined = measured.join(verdicts, host, "left")
    hit = F.lit(False)
    for r, c in SOFT_RULES.items():
        hit = hit | (F.coalesce(F.col(f"bad_{r}"), F.lit(False)) & F.coalesce(F.expr(c), F.lit(False)))
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~hit)


def quality(df: DataFrame, text: str = "text", id_col: str = "doc_id", host: str = "source") -> DataFrame:
    """id_col, the metrics, base_failed and kept of each row.

    Null and empty texts have no words and fail the base rules. Rows without a host get no host verdict. Repeated rows
    count each; ties cannot arise; long texts are measured whole; an empty table gives no rows. Other columns are not
    read, so their names may clash. The measured rows, without texts, are held as both passes need them.
    """
    measured = hold(text_metrics(df, text, [id_col, host]))
    return judge(measured, host_verdicts(measured, "k1"), "k1").select(F.col("k0").alias(id_col), *METRICS, "base_failed", "kept")


def keep_good(df: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The rows of df that quality() keeps, with df's columns. Texts stay where they are and are measured twice.

    Null, empty and short texts go; rows without a host get no host verdict; repeated rows are judged each; an empty
    table gives no rows; other columns come along whatever their names.
    """
    names = df.columns
    own = W.lean(df).select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    t, h = f"c{names.index(text)}", f"c{names.index(host)}"
    verdicts = host_verdicts(text_metrics(df, text, [host]), "k0").withColumnRenamed("k0", h)
    measured = own.withColumn("m", metrics_udf()(F.col(t).cast("string"))).select("*", "m.*").drop("m")
    return judge(measured, verdicts, h).where("kept").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
