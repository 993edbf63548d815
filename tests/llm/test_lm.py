import math
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from civicflow.llm import lm
from civicflow.llm.elias_fano import Children, EliasFano, NgramTrie, Quantised, mapped

from .helpers import empty, frame, lower, sf_rows, words


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=80), st.integers(0, 2000))
def test_elias_fano(values, more):
    values = np.array(sorted(values), np.int64)
    e = EliasFano.of(values, 5001 + more)
    assert e.get(np.arange(len(values))).tolist() == values.tolist()
    asked = np.arange(0, 5001, 7)
    assert e.successor(asked).tolist() == np.searchsorted(values, asked).tolist()
    assert set(np.unique(e.find(values)) >= 0) <= {True}
    lo, hi = len(values) // 3, 2 * len(values) // 3
    assert e.successor(asked, lo, hi).tolist() == [lo + int(np.searchsorted(values[lo:hi], x)) for x in asked]


def test_long_elias_fano():
    values = np.sort(np.random.default_rng(2).integers(0, 1 << 55, 200_000))
    e = EliasFano.of(values, 1 << 55)
    assert (e.get(np.arange(len(values))) == values).all() and (values[e.find(values)] == values).all()
    assert (e.find(values + 1) == np.where(np.isin(values + 1, values), np.searchsorted(values, values + 1), -1)).all()
    assert e.nbytes < 8 * len(values)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 300)), max_size=120))
def test_children_are_found_in_their_context_only(entries):
    entries = sorted(set(entries))
    parent, word = (np.array([e[i] for e in entries], np.int64) for i in (0, 1))
    level = Children(Children.arrays(parent, word, 10))
    place = {e: i for i, e in enumerate(entries)}
    p, w = (x.ravel() for x in np.meshgrid(np.arange(-1, 10), np.arange(0, 400, 3), indexing="ij"))
    assert level.find(p, w).tolist() == [place.get(e, -1) for e in zip(p.tolist(), w.tolist())]
    assert level.find(parent, word).tolist() == list(range(len(entries)))


def test_quantised_is_close():
    x = 10 ** -np.random.default_rng(0).uniform(0, 6, 5000)
    q = Quantised(Quantised.arrays(x))
    assert np.abs(np.log10(q.get(np.arange(5000), 1.0)) - np.log10(x)).max() < 6 / 255
    assert q.get(np.array([-1]), 0.5).tolist() == [0.5]


def test_trie_of_mapped_levels(tmp_path):
    rng = np.random.default_rng(3)
    stream = (rng.zipf(1.4, 30_000) % 500 + 1).astype(np.int64)
    pairs, n2 = np.unique(stream[:-2] << 32 | stream[1:-1], return_counts=True)
    key, n3 = np.unique(np.searchsorted(pairs, stream[:-2] << 32 | stream[1:-1]) << 32 | stream[2:], return_counts=True)
    n1 = np.bincount(stream[:-2], minlength=501)
    first = np.unique(pairs >> 32)
    arrays = NgramTrie.arrays(pairs, n2, n1[first], key >> 32, key & 0xFFFFFFFF, n3, 0.5)
    for folder in (str(tmp_path), None, "/no/such/folder"):
        trie = NgramTrie(mapped(arrays, folder))
        node = trie.pair(pairs >> 32, pairs & 0xFFFFFFFF)
        assert node.tolist() == list(range(len(pairs)))
        assert trie.triple(key >> 32, key & 0xFFFFFFFF).tolist() == list(range(len(key)))
        assert (trie.pair(pairs >> 32, (pairs & 0xFFFFFFFF) + 600) == -1).all()
        # a context's weights and what it leaves make one, but for 8 bits
        total = np.bincount(pairs >> 32, trie.weight2.get(node, 0.0), 501)[first] + 0.5 * np.bincount(pairs >> 32, minlength=501)[first] / n1[first]
        assert np.abs(total - 1).max() < 0.05
        total = np.bincount(key >> 32, trie.weight3.get(np.arange(len(key)), 0.0)) + trie.left3.get(node, 1.0)
        assert np.abs(total - 1).max() < 0.05
    assert not list(tmp_path.iterdir())  # the files go with the views


def test_scores_against_brute_force(spark):
    df = frame(spark, [(1000 + i, t) for i, t in sf_rows(spark)])
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    held = {i: i is None or zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows}
    counts = Counter()
    for i, t in rows:
        if not held[i]:
            counts.update([*words(lower(t or "")), None])
    n, v = sum(counts.values()), len(counts)
    want = []
    for i, t in rows:
        own = [*words(lower(t or "")), None]
        want.append((str(i), held[i], len(own), sum(counts[w] > 0 for w in own), n, round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own), 5)))
    got = lm.score_texts(df).collect()
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in got) == sorted(want)
    out = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)  # the model is better on held-out texts
    assert all(r["score"] <= 0 for r in got)
    assert lm.score_texts(empty(spark)).count() == 0


def brute_force_scores(rows, held):
    """Absolute discounting over all n-grams of the training texts, with plain counters."""
    grams, followers = Counter(), Counter()
    for i, t in rows:
        own = [*words(lower(t or "")), None]
        if not held[i]:
            grams.update(tuple(own[k : k + n]) for n in (1, 2, 3) for k in range(len(own) - n + 1))
    followers.update(g[:-1] for g in grams if len(g) > 1)
    n, v = sum(c for g, c in grams.items() if len(g) == 1), sum(len(g) == 1 for g in grams)
    out = []
    for i, t in rows:
        own, score = [*words(lower(t or "")), None], 0.0
        for k, w in enumerate(own):
            p = (grams[(w,)] + 0.1) / (n + 0.1 * (v + 1))
            for before in (tuple(own[k - m : k]) for m in (1, 2) if k >= m):
                if grams[before]:
                    p = p * 0.5 * followers[before] / grams[before] + max(0, grams[(*before, w)] - 0.5) / grams[before]
            score += math.log10(p)
        out.append((str(i), round(score, 5)))
    return sorted(out)


def test_all_ngrams_count(spark, monkeypatch):
    # Over some 60,000 tokens of 2,000 words and a tail of rare ones; small blocks, so that counts cross them.
    monkeypatch.setattr(lm, "BLOCK_BYTES", 20_000)
    rng = np.random.default_rng(5)
    many = [(i, " ".join(f"w{x}" for x in (rng.zipf(1.3, 150) % 2000).tolist()) + f" only{i} twice{i // 2}") for i in range(400)]
    rows = [(r["doc_id"], r["text"]) for r in frame(spark, [(1000 + i, t) for i, t in many]).collect()]
    held = {i: i is None or zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows}
    got = lm.score_texts(frame(spark, [(1000 + i, t) for i, t in many]).repartition(5)).collect()
    found, want = sorted((str(r["doc_id"]), r["score"]) for r in got), brute_force_scores(rows, held)
    assert [i for i, _ in found] == [i for i, _ in want]
    length = {str(i): len(words(lower(t or ""))) + 1 for i, t in rows}
    off = np.array([(x - y) / length[i] for (i, x), (_, y) in zip(found, want)])
    assert np.abs(off).max() < 0.01 and abs(off.mean()) < 0.002  # weights of 8 bits
    monkeypatch.setattr(lm, "local_folder", lambda spark: None)
    again = lm.score_texts(frame(spark, [(1000 + i, t) for i, t in many])).collect()
    assert np.allclose(sorted(r["score"] for r in again), sorted(x for _, x in found), rtol=0.01)
