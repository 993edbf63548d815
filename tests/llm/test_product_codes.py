"""Product codes against plain loops over Python's integers, and the query against SQL."""

import hashlib
import math

import numpy as np
import pytest
from civicflow.llm import product_codes as C
from civicflow.llm.queries import op12_vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int, __v string, code string, error int"


def plain(rows, parts=8, entries=16, rounds=6, scale=4096):
    """rows: (id, vector, label); (codes and errors by row, checksum of codebooks)."""
    rows = [(i, v, x) for i, v, x in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[int(c) * scale if abs(c) > 2**52 else math.floor(c * scale) for c in v] for _, v, _ in rows]
    dim = len(whole[0])
    cuts = [k * (dim // parts) + min(k, dim % parts) for k in range(parts + 1)]
    books = [[v[cuts[k] : cuts[k + 1]] for v in whole[:entries]] for k in range(parts)]

    def nearest(v, k):
        own = v[cuts[k] : cuts[k + 1]]
        return min((sum((a - b) ** 2 for a, b in zip(own, e)), j) for j, e in enumerate(books[k]))

    for _ in range(rounds):
        new = []
        for k in range(parts):
            took = [nearest(v, k)[1] for v in whole]
            groups = [[v[cuts[k] : cuts[k + 1]] for v, j in zip(whole, took) if j == e] for e in range(len(books[k]))]
            new.append([[sum(c) // len(g) for c in zip(*g)] if g else books[k][e] for e, g in enumerate(groups)])
        books = new
    out = []
    for (i, _, x), v in zip(rows, whole):
        best = [nearest(v, k) for k in range(parts)]
        error = sum(b[0] for b in best)
        out.append((i, x, "".join(f"{b[1]:02x}" for b in best), error if error < 2**63 else None))
    return out, hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()


def frame(spark, rows):
    return spark.createDataFrame([(i, v, x, "clash", "clash", 0) for i, v, x in rows], SCHEMA)


def vectors(n, dim=16, seed=1, copies=0):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(c) for c in rng.normal(size=dim).round(3)], int(rng.integers(0, 3)) if i % 5 else None) for i in rng.permutation(n)]
    return rows + rows[:copies]


def check(spark, rows, **named):
    coded, books = C.product_codes(frame(spark, rows), **named)
    want, sha = plain(rows, **named)
    assert sorted(map(repr, map(tuple, coded.collect()))) == sorted(map(repr, want))
    assert books.sha256() == sha
    return coded, want


def test_codes_of_random_vectors(spark):
    coded, want = check(spark, vectors(300, copies=20))
    sums = {}
    for _, x, _, e in want:
        sums[x] = sums.get(x, 0) + e
    assert {r["label"]: r["label_error"] for r in C.with_label_errors(coded).collect()} == sums
    assert C.with_label_errors(coded).count() == 320


def test_awkward_vectors(spark):
    odd = [(None, [0.5] * 16, 1), (None, [0.25] * 16, None), (3, [0.1] * 16, 2), (3, [0.0] * 16, 2), (900, None, 1), (901, [None] + [0.0] * 15, 1), (902, [float("nan")] * 16, 1), (903, [float("inf")] + [1.0] * 15, 1)]
    check(spark, odd + vectors(40))
    check(spark, vectors(5))  # fewer than entries
    check(spark, vectors(60, dim=19))  # parts of unlike length


def test_large_components_are_exact(spark):
    rows = vectors(30) + [(100, [1e6] * 16, 1), (101, [-1e300] + [0.0] * 15, 1), (102, [1e12, -1e12] * 8, None)]
    check(spark, rows)


def test_other_lengths_take_no_part(spark):
    rows = vectors(40)
    coded, _ = C.product_codes(frame(spark, [*rows, (1000, [1.0] * 8, 7), (1001, [], 7)]))
    got = {r["vec_id"]: (r["code"], r["error"]) for r in coded.collect()}
    assert got.pop(1000) == got.pop(1001) == (None, None)
    assert got == {i: (c, e) for i, _, c, e in plain(rows)[0]}
    with pytest.raises(ValueError):
        C.product_codes(frame(spark, [(1, [1.0], 1)]))


def test_empty_tables(spark):
    coded, books = C.product_codes(frame(spark, []))
    assert C.with_label_errors(coded).count() == 0 and books.sha256() == hashlib.sha256(b"").hexdigest()
    assert C.product_codes(frame(spark, [(1, None, 1), (2, [None], 2)]))[0].count() == 0


def test_blocks_merge_in_any_order(spark):
    rows = vectors(500, dim=8)
    one, many = (C.product_codes(frame(spark, rows).repartition(n)) for n in (1, 13))
    assert one[1].sha256() == many[1].sha256()
    assert sorted(map(tuple, one[0].collect())) == sorted(map(tuple, many[0].collect()))


def test_query(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want, sha = plain(rows)
    got = op12_vector_codes(spark, sf_dir).collect()
    assert {(r["vec_id"], r["code"], r["error"]) for r in got} == {(i, c, e) for i, _, c, e in want} and len(got) == len(want)
    sums = {}
    for _, x, _, e in want:
        sums[x] = sums.get(x, 0) + e
    assert {(r["label"], r["label_error"], r["codebooks_sha256"]) for r in got} == {(x, e, sha) for x, e in sums.items()}
