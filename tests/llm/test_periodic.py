"""Periodic runs against a search over all periods, and the contract's digests."""

import hashlib
import zlib

import numpy as np
import pytest
from civicflow.llm import periodic
from civicflow.llm.queries import op11_periodic_runs

from .helpers import awkward, empty, frame, words


def plain_runs(c, min_words=6, exponent=4):
    """(start, length, period) of all runs: for each period the stretches that keep it, unless a smaller one does."""
    out = set()
    for p in range(1, len(c) // exponent + 1):
        i = 0
        while i + p < len(c):
            j = i
            while j + p < len(c) and c[j] == c[j + p]:
                j += 1
            start, end = i, j + p
            if end - start >= max(min_words, exponent * p) and not any(all(c[x] == c[x + q] for x in range(start, end - q)) for q in range(1, p)):
                out.add((start, end - start, p))
            i = max(j, i + 1)
    return sorted(out)


def planted(doc_id, own):
    h, n = (zlib.crc32(str(doc_id).encode()), len(own)) if doc_id is not None else (1, 0)
    if h % 10 or not n:
        return own
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else own[a + (i - a) % p] for i, w in enumerate(own)]


def plain_row(doc_id, text):
    own = planted(doc_id, words(text))
    runs = plain_runs(own)
    keep = [w for i, w in enumerate(own) if not any(s + p <= i < s + n for s, n, p in runs)]
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest(), hashlib.sha256(" ".join(keep).encode()).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def sequences(rng, n):
    for _ in range(n):
        kind, size = rng.integers(0, 4), int(rng.integers(0, 70))
        if kind == 0:
            yield rng.integers(0, 2, size)
        elif kind == 1:
            yield np.tile(rng.integers(0, 3, max(1, size // 9)), 20)[:size]
        elif kind == 2:
            yield np.concatenate([rng.integers(0, 9, size // 3), np.tile(rng.integers(0, 3, 3), 9), np.tile(rng.integers(0, 2, 2), 6), rng.integers(0, 9, size // 3)])
        else:
            yield np.tile(np.concatenate([np.tile(rng.integers(0, 2, 2), 5), rng.integers(0, 3, 2)]), 6)


@pytest.mark.parametrize("min_words, exponent", [(6, 4), (2, 4), (9, 4), (5, 5), (3, 6)])
def test_runs_of_random_sequences(min_words, exponent):
    rng = np.random.default_rng(min_words)
    for _ in range(150):
        docs = list(sequences(rng, 4))
        at = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
        doc, start, length, period, _ = periodic.find_runs(np.concatenate(docs).astype(np.int64), at, min_words, exponent)
        got = [[] for _ in docs]
        for d, *run in zip(doc.tolist(), start.tolist(), length.tolist(), period.tolist()):
            got[d].append(tuple(run))
        assert got == [plain_runs(d.tolist(), min_words, exponent) for d in docs]


def test_mask_and_least_overlap():
    assert periodic.least_overlap() == 5 and periodic.least_overlap(2, 4) == 3
    own = np.array([1, 2, 3, 4, 5, 9, 1, 2, 3, 4, 5, 7, 1, 2, 3, 4])
    assert periodic.surviving(own, np.array([0, 12, 16]), 5).tolist() == [True] * 5 + [False] + [True] * 5 + [False] * 5


def test_long_runs_of_one_word():
    doc, start, length, period, _ = periodic.find_runs(np.zeros(60_000, np.int64), np.array([0, 60_000]))
    assert (doc.tolist(), start.tolist(), length.tolist(), period.tolist()) == ([0], [0], [60_000], [1])
    codes = np.tile(np.concatenate([np.arange(999), [3]]), 40)[:39_500]
    assert [x.tolist() for x in periodic.find_runs(codes, np.array([0, len(codes)]))[1:4]] == [[0], [39_500], [1000]]


def test_checksums_that_lie_are_found_out(monkeypatch):
    honest, attempts = periodic._segment_runs, []

    def segment_runs(*args):
        attempts.append(args[-1])
        if args[-1] < 2:  # the first two sets of checksums call everything the same
            with monkeypatch.context() as m:
                m.setattr(periodic.Equal, "same", lambda self, a, period, size: np.ones(len(a), bool))
                return honest(*args)
        return honest(*args)

    monkeypatch.setattr(periodic, "_segment_runs", segment_runs)
    codes = np.array(2 * [5, 1, 2, 1, 2, 1, 2, 1, 2, 3, 4, 6])  # all of it is in repeated 5-grams
    assert [x.tolist() for x in periodic.find_runs(codes, np.array([0, len(codes)]))[1:4]] == [[1, 13], [8, 8], [2, 2]]
    assert attempts == [0, 1, 2]


def test_awkward_rows(spark):
    extra = [(i, "a b " * 5 + "end " * i) for i in range(20, 60)] + [(None, "x " * 8), (70, "so so so so so so")]
    got = periodic.run_digests(periodic.periodic_runs(frame(spark, extra), repeated_tails=True)).select(*COLUMNS).collect()
    small = [r for r in awkward(extra) if r[0] != 6]
    assert sorted(map(repr, (tuple(r) for r in got if r["doc_id"] != 6))) == sorted(map(repr, (plain_row(r[0], r[1]) for r in small)))
    assert sum(r["doc_id"] == 6 for r in got) == 1
    assert periodic.periodic_runs(empty(spark)).count() == 0


def test_texts_and_spans(spark):
    rows = periodic.periodic_runs(frame(spark, [(50, "go\n" + "ha ho " * 4 + "stop")])).where("doc_id = 50").first()
    assert [tuple(r) for r in rows["runs"]] == [(1, 8, 2)] and rows["collapsed"] == "go ha ho stop"
    with pytest.raises(ValueError):
        periodic.periodic_runs(empty(spark), exponent=3)


def test_query(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    got = op11_periodic_runs(spark, sf_dir).select(*COLUMNS).collect()
    assert len(got) == len(docs)
    short = [r for r in got if len(words(docs[r["doc_id"]])) < 700]
    assert len(short) > 100 and any(r["n_runs"] for r in short)
    assert [tuple(r) for r in short] == [plain_row(r["doc_id"], docs[r["doc_id"]]) for r in short]
