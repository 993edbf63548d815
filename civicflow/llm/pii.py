"""Personal data by bootstrapped contextual extraction.

Seeds are what fixed patterns find, and keys of high entropy. Their contexts become lexical patterns; Spark scores the
bipartite graph of patterns and instances in rounds: a pattern by the share of its instances believed in, an instance
by the patterns it occurs in. Patterns that end with high confidence mark the identifiers that no seed shape catches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .storage import cut, hold, looked_up, small_side

KINDS = ["email", "ip", "card", "phone"]
ROUNDS = 3
#: A pattern counts if it has this many different instances and at least this confidence.
MIN_INSTANCES = 3
MIN_CONFIDENCE = 0.6

#: The base patterns.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: Characters before the @ of an address.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

#: What a pattern may mark: a run of letters, digits and few marks, of 8 characters or more, with a digit.
TOKEN = re.compile(r"[A-Za-z0-9][A-Za-z0-9_./+=-]{6,}[A-Za-z0-9=]")
HEX_KEY = re.compile(r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})\Z")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: an address begins where the run of local characters before its @ does, after the last match."""
    out, at, floor = [], text.find("@"), 0
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            floor = m.end()
            at = text.find("@", floor)
        else:
            floor = at + 1  # no address reaches over an @
            at = text.find("@", at + 1)
    return out


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def base_spans(text: str, digits: bool, ats: bool) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all base matches by kind, then start."""
    out = [("email", a, b) for a, b in emails(text)] if ats else []
    if digits:
        out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(map(_small, m[0].split(".")))]
        for m in CARD.finditer(text):
            d = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(d) <= 19 and luhn(d):
                out.append(("card", m.start(), m.end()))
        if "+" in text:
            out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return out


def context(text: str, start: int, end: int) -> str:
    """Pattern of what surrounds a span: the last three pieces before it, digits as 0, and the mark after it."""
    left = re.sub("[0-9]", "0", text[max(0, start - 32) : start]).lower()
    pieces = re.findall(r"[^\W\d_]+|0+|[^\w\s]|_", left)[-3:]
    glued = not left[-1:].isspace()
    after = text[end : end + 1]
    return " ".join(pieces) + ("|" if glued else "| ") + (after if after and not after.isalnum() and not after.isspace() else "")


def candidates(text: str, base: list[tuple[str, int, int]], digits: bool) -> list[tuple[str, str, str, int, int]]:
    """(pattern, instance, seed kind or '', start, end) of the base spans and of other tokens that look like identifiers."""
    out = [(context(text, a, b), text[a:b], kind, a, b) for kind, a, b in base]
    if digits:
        taken = sorted((a, b) for _, a, b in base)
        starts = [a for a, _ in taken]
        reach = np.maximum.accumulate([b for _, b in taken]).tolist() if taken else []
        for m in TOKEN.finditer(text):
            a, b = m.span()
            value = m[0]
            if not any(c in "0123456789" for c in value):
                continue
            i = int(np.searchsorted(starts, b)) - 1 if starts else -1
            if i >= 0 and reach[i] > a:
                continue
            key = HEX_KEY.match(value) and any(c in "abcdef" for c in value)
            out.append((context(text, a, b), value, "key" if key else "", a, b))
    return out


def spell(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


CANDIDATE = T.ArrayType(T.StructType([T.StructField("pattern", T.StringType()), T.StructField("instance", T.LongType()), T.StructField("seed", T.StringType()), T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())]))
ARROW_CANDIDATE = pa.list_(pa.struct([("pattern", pa.string()), ("instance", pa.int64()), ("seed", pa.string()), ("a", pa.int32()), ("b", pa.int32())]))


def flags(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Whether each text has a digit, and an @."""
    data, start = W.text_bytes(texts)
    some = []
    for mask in ((data >= 48) & (data <= 57), data == 64):
        total = np.zeros(len(data) + 1, np.int64)
        np.cumsum(mask, out=total[1:])
        some.append(total[start[1:]] > total[start[:-1]])
    return some[0], some[1]


def found_in(texts: pa.Array) -> Iterator[tuple[str, list[tuple[str, int, int]], bool]]:
    digits, ats = flags(texts)
    some = digits | ats
    for i in range(len(texts)):
        text = (texts[i].as_py() or "") if some[i] else ""
        yield text, base_spans(text, bool(digits[i]), bool(ats[i])) if some[i] else [], bool(digits[i])


def scan(df: DataFrame, text: str, id_col: str) -> DataFrame:
    """id, key, base (the spans as text) and candidates of each row; key is xxhash64 of id and text."""
    source = W.lean(df).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").cast("string").alias("__text")).withColumn("key", F.xxhash64("id", "__text"))
    schema = T.StructType([source.schema["id"], source.schema["key"], T.StructField("base", T.StringType()), T.StructField("candidates", CANDIDATE)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest as xxh

        for b in W.slices(batches, "__text"):
            base, cands = [], []
            for content, spans, digits in found_in(b.column("__text")):
                base.append(spell(spans))
                cands.append([{"pattern": p, "instance": xxh(v.encode()) - (1 << 63), "seed": s, "a": x, "b": y} for p, v, s, x, y in candidates(content, spans, digits)] if digits or spans else [])
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("key"), pa.array(base, pa.string()), pa.array(cands, ARROW_CANDIDATE)], names=["id", "key", "base", "candidates"])

    return source.mapInArrow(run, schema)


def score_patterns(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """pattern and kind of the patterns that end with enough confidence.

    edges: pattern, instance, seed, one row an occurrence. Occurrences are counted before they are joined, and only
    patterns with MIN_INSTANCES instances are, so that a pattern or instance with a third of all rows is one row each.
    """
    pairs = hold(edges.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")))
    wide = pairs.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("seed") != "", F.col("seed"))).alias("kind")).where(F.col("n") >= MIN_INSTANCES)
    wide = cut(wide)
    size = wide.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    pairs = hold(looked_up(pairs, wide.select("pattern", "n"), "pattern", "n", size))
    rows = F.count(F.lit(1)).alias("n")
    belief = pairs.groupBy("instance").agg(F.max(F.when(F.col("seed") != "", 1.0).otherwise(0.0)).alias("belief"), rows)
    for k in range(rounds):
        conf = looked_up(pairs, belief, "instance", "n", size).groupBy("pattern").agg((F.sum("belief") / F.count(F.lit(1))).alias("conf"), rows)
        conf = cut(conf, size)
        if k + 1 < rounds:
            strong = looked_up(pairs, conf, "pattern", "n", size).withColumn("p", F.when(F.col("seed") != "", 1.0).otherwise(F.when(F.col("conf") >= MIN_CONFIDENCE, F.col("conf")).otherwise(0.0)))
            # one less the product of doubts, over the instance's patterns
            doubt = F.sum(F.log(F.greatest(1 - F.col("p"), F.lit(1e-6))))
            belief = cut(strong.groupBy("instance").agg((1 - F.exp(doubt)).alias("belief"), rows), size)
    return conf.where(F.col("conf") >= MIN_CONFIDENCE).join(wide.where(F.col("kind").isNotNull()).select("pattern", "kind"), "pattern").select("pattern", "kind")


def added_spans(scanned: DataFrame) -> DataFrame:
    """id, key and added (array of structs kind, a, b) of the rows to which good patterns add spans."""
    flat = hold(scanned.select("id", "key", F.explode("candidates").alias("c")).select("id", "key", "c.*"))
    good = score_patterns(flat.select("pattern", "instance", "seed"))
    loose = flat.where(~F.col("seed").isin(KINDS))
    weights = loose.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    hits = looked_up(loose, good.join(weights, "pattern"), "pattern", "n", flat.count())
    return small_side(hits.groupBy("id", "key").agg(F.array_sort(F.collect_set(F.struct("kind", "a", "b"))).alias("added")))


def all_spans(base: list[tuple[str, int, int]], added: list[dict]) -> list[tuple[str, int, int]]:
    order = {k: i for i, k in enumerate(KINDS)}
    spans = set(base) | {(x["kind"], x["a"], x["b"]) for x in added}
    return sorted(spans, key=lambda s: (order.get(s[0], len(order)), s[0], s[1], s[2]))


def find_personal_data(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """id_col, counts of the base kinds, base_sha256 and spans of each row.

    Base spans are leftmost matches of each kind; patterns add tokens in contexts that mostly hold seeds, under the
    kind of those seeds. Null and empty texts have no spans; long texts are scanned whole, in time that grows with
    their length; repeated rows get the same spans each; equal spans count once; an empty table gives no rows. Null
    ids stay. Other columns are not read. Texts are read once; what is kept of them is spans and candidates.
    """
    scanned = hold(scan(df, text, id_col))
    added = added_spans(scanned)
    both = scanned.select(F.col("id"), F.col("key"), "base").join(added.withColumnRenamed("id", "__id"), (scanned["key"] == added["key"]) & F.col("id").eqNullSafe(F.col("__id")), "left")
    base = F.filter(F.split("base", ","), lambda s: s != "")
    extra = F.transform(F.coalesce("added", F.array().cast("array<struct<kind:string,a:int,b:int>>")), lambda x: F.concat_ws(":", x["kind"], x["a"].cast("string"), x["b"].cast("string")))
    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s.startswith(kind + ":"))).cast("long").alias(f"n_{kind}")

    return both.select(F.col("id").alias(id_col), *map(count, KINDS), F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), F.concat_ws(",", F.array_distinct(F.concat(base, extra))).alias("spans"))


def mask_udf():
    @F.pandas_udf(T.StringType())
    def mask(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, added in parts:
            out = []
            found = found_in(pa.array(texts, pa.large_string(), from_pandas=True))
            for text, extra, (_, base, _) in zip(texts, added, found):
                out.append(text if text is None else masked(text, all_spans(base, list(extra) if extra is not None else [])))
            yield pd.Series(out, dtype=object)

    return mask


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """text with each span replaced by its kind in angle brackets; of spans that overlap, one mark covers all."""
    if not spans:
        return text
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join(out) + text[at:]


def mask_personal_data(df: DataFrame, text: str = "text", id_col: str = "doc_id", length: str | None = "n_chars") -> DataFrame:
    """df with all spans masked in the text, and its length column, if it has one, made to follow. All rows stay."""
    names = df.columns
    added = added_spans(hold(scan(df, text, id_col)))
    own = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    t, i = f"c{names.index(text)}", f"c{names.index(id_col)}"
    joined = own.withColumn("__key", F.xxhash64(i, F.col(t).cast("string"))).join(added, (F.col("__key") == F.col("key")) & F.col(i).eqNullSafe(F.col("id")), "left")
    out = joined.withColumn(t, mask_udf()(F.col(t).cast("string"), F.col("added")))
    if length in names:
        out = out.withColumn(f"c{names.index(length)}", F.length(t).cast(df.schema[length].dataType))
    return out.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(names)])
