import os

import numpy as np

from civicflow.llm import ann

#: The largest table there is.
TABLE = next(f"/root/testdata/{d}/embeddings.parquet" for d in ("check_s", "sf0.1") if os.path.exists(f"/root/testdata/{d}/embeddings.parquet"))
SCHEMA = "vec_id long, embedding array<float>, v string, list int"


def brute(rows, every=50, k=5):
    ok = {i: np.array(v, np.float64) for i, v in rows if i is not None and v is not None and len(v) == 16 and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)}
    ids = np.array(sorted(ok))
    x = np.stack([ok[i] for i in ids])
    out = {}
    for q in ids[ids % every == 0]:
        s = (x @ ok[q]) / (np.sqrt((x * x).sum(1)) * np.sqrt(ok[q] @ ok[q]))
        best = sorted((-s[j], ids[j]) for j in range(len(ids)) if ids[j] != q)[:k]
        out[int(q)] = [(int(i), -a) for a, i in best]
    return out


def fixture(n=1500):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16))
    x = (centres[rng.integers(0, 12, n)] + 0.4 * rng.normal(size=(n, 16))).astype(np.float32)
    x[300:420] = x[300]  # copies, more than any query may return
    rows = [(i, [float(c) for c in x[i]]) for i in range(n)]
    rows += [(5000, None), (5050, [0.0] * 16), (5100, [float("nan")] * 16), (5150, [1.0] * 15), (5151, [None] * 16), (None, [1.0] * 16), (5200, [float("inf")] + [0.0] * 15), rows[7]]
    return rows


def test_recall_scores_and_ties(spark):
    rows = fixture()
    got = {}
    for r in ann.nearest(spark.createDataFrame([(i, v, "clash", 1) for i, v in rows], SCHEMA)).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = brute(rows)
    assert set(got) == set(want)
    hits = 0
    for q, own in got.items():
        own.sort()
        assert [r for r, _, _ in own] == [1, 2, 3, 4, 5]
        assert all((a[2], -a[1]) > (b[2], -b[1]) for a, b in zip(own, own[1:]))
        hits += len({v for _, v, _ in own} & {v for v, _ in want[q]})
    assert hits / (5 * len(want)) >= 0.9
    assert [v for _, v, _ in got[300]] == [301, 302, 303, 304, 305]
    assert [v for _, v, _ in got[350]] == [300, 301, 302, 303, 304]


def recall(spark, rows):
    """Share of the true five nearest that are found, by cosine; copies of the fifth count as it does."""
    got = {}
    for r in ann.nearest(rows).collect():
        got.setdefault(r["query_id"], []).append(r["score"])
    table = rows.select("vec_id", "embedding").toPandas()
    x = np.stack(table["embedding"].to_numpy()).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = table["vec_id"].to_numpy()
    hits = n = 0
    for at in np.flatnonzero(ids % 50 == 0):
        s = x @ x[at]
        s[at] = -2
        fifth = np.sort(s)[-5]
        hits += sum(g >= fifth - 1e-9 for g in got[ids[at]])
        n += 5
    return hits / n


def test_recall_of_a_table(spark):
    assert recall(spark, spark.read.parquet(TABLE)) >= 0.95


def test_recall_of_lists_within_lists(spark, monkeypatch):
    # A few long lists, as tables of many millions of vectors have, each with lists of its own.
    monkeypatch.setattr(ann, "LIST_ROWS", 400)
    monkeypatch.setattr(ann, "LONG_LIST", 300)
    monkeypatch.setattr(ann, "LIST_SAMPLE", 500)
    monkeypatch.setattr(ann, "INNER_ROWS", 200)
    assert recall(spark, spark.read.parquet(TABLE)) >= 0.9


def test_repeated_ids(spark):
    rows = [(0, [1.0, 0.0], "", 0), (1, [0.0, 1.0], "", 0), (1, [1.0, 0.1], "", 0), (2, [-1.0, 0.0], "", 0)]
    got = [(r["query_id"], r["vec_id"], round(r["score"], 6)) for r in ann.nearest(spark.createDataFrame(rows, SCHEMA)).orderBy("rank").collect()]
    assert got == [(0, 1, 0.0), (0, 2, -1.0)]  # of the two vectors under 1 the lesser counts


def test_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], "", 0), (1, [1.0, 1.0], "", 0)], SCHEMA)
    assert [(r["query_id"], r["vec_id"]) for r in ann.nearest(df).collect()] == [(0, 1)]
    assert ann.nearest(df.limit(0)).count() == 0


def test_graph_search_finds_the_nearest():
    rng = np.random.default_rng(1)
    c = rng.normal(size=(700, 8))
    place, _ = ann.CentroidGraph(c).search(rng.normal(size=(90, 8)), 64)
    rng = np.random.default_rng(1)
    rng.normal(size=(700, 8))
    q = rng.normal(size=(90, 8))
    true = ((c[None] - q[:, None]) ** 2).sum(-1).argmin(1)
    assert (place[:, 0] == true).mean() > 0.97


def test_vectors_of_any_scale_are_near(spark):
    rows = [(0, [1.0, 2.0], 0)] + [(i, [1.0, 2.0 + i / 50], 0) for i in range(1, 12)] + [(20, [1e200, 2e200], 0), (21, [1e-200, 2e-200], 0), (22, [1e-310, 2e-310], 0)]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), k=3).where("query_id = 0").orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [20, 21, 22] and all(abs(r["score"] - 1) < 1e-12 for r in got)
