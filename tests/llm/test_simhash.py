import random
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from civicflow.llm import simhash

from .helpers import chains, empty, frame, lower, sf_rows, similar_pairs, words


def print_of(text, n=3):
    w = words(lower(text or ""))
    own = [" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in own]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_components(spark):
    rng = random.Random(4)
    base = [f"w{rng.randrange(3000)}" for _ in range(300)]
    near = []
    for i in range(40):
        own = list(base)
        for _ in range(rng.randrange(1, 4)):
            own[rng.randrange(300)] = f"n{i}"
        near.append((200 + i, " ".join(own)))
    df = frame(spark, near + [(1000 + i, t) for i, t in sf_rows(spark)])
    rows = [(r["doc_id"], print_of(r["text"])) for r in df.collect()]
    prints = sorted({p for _, p in rows})
    x = np.array(prints, np.uint64)
    a, b = np.nonzero(np.triu(np.bitwise_count(x[:, None] ^ x[None, :]) <= 3, 1))
    joined = simhash.UnionFind(len(x))
    joined.join(a, b)
    root = dict(zip(prints, joined.roots(np.arange(len(x))).tolist()))
    least = {}
    for i, p in rows:
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    want = sorted((str(i), f"{p:016x}", str(least.get(root[p]))) for i, p in rows)
    got = simhash.near_duplicates(df).collect()
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in got) == want
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_large_buckets_are_split_without_loss(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PART", 20)
    rng = np.random.default_rng(9)
    fps = np.unique(np.uint64(0x0123456789ABCDEF) ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "f0 long").selectExpr("f0 as id", "f0")
    for n in (1, 1 << 21):
        found = simhash.links(df, 3, simhash.exact_masks(3, n)).collect()
        u, at = simhash.UnionFind(len(fps)), {int(v): i for i, v in enumerate(fps.view(np.int64))}
        u.join(np.array([at[r["a"]] for r in found]), np.array([at[r["b"]] for r in found]))
        v = simhash.UnionFind(len(fps))
        a, b = np.nonzero(np.triu(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3, 1))
        v.join(a, b)
        assert (u.roots(np.arange(len(fps))) == v.roots(np.arange(len(fps)))).all()
        assert len(found) < 4 * len(fps) * len(simhash.exact_masks(3, n))


def jaccard(a, b):
    def own(t):
        w = words(lower(t))
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    x, y = own(a), own(b)
    return len(x & y) / len(x | y) if x | y else 0


def test_stage_drops_similar_texts_only(spark):
    rng = random.Random(6)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    texts = [(300, " ".join(base))]
    for i in range(30):
        own = list(base)
        for at in range(rng.randrange(0, 12)):
            own[rng.randrange(200)] = f"n{i}_{at}"
        texts.append((301 + i, " ".join(own)))
    texts += [(400, texts[0][1].upper()), (401, texts[0][1])]
    df = frame(spark, texts + [(1000 + i, t) for i, t in sf_rows(spark)])
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    distinct = sorted({t for _, t in rows if t is not None})
    u = simhash.UnionFind(len(distinct))
    pairs = [(i, j) for i in range(len(distinct)) for j in range(i) if abs(len(distinct[i]) - len(distinct[j])) < 0.3 * len(distinct[i]) + 20 and jaccard(distinct[i], distinct[j]) >= 0.8]
    if pairs:
        u.join(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]))
    root = dict(zip(distinct, u.roots(np.arange(len(distinct))).tolist()))
    first = {}
    for i, t in rows:
        if t is not None:
            first[root[t]] = min((i is None, i or 0, t), first.get(root[t], (True, 1 << 60, "")))
    want = sorted([str(i) for i, t in rows if t is None] + [str(None if none else i) for none, i, _ in first.values()])
    out = simhash.drop_near_duplicates(df)
    assert out.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in out.collect()) == want
    assert simhash.drop_near_duplicates(empty(spark)).count() == 0


def test_bucket_links_chain_as_all_pairs_do():
    rng = np.random.default_rng(12)
    for radius, flips in ((3, 2), (40, 25)):
        centres = rng.integers(0, 1 << 63, (6, 2)).astype(np.uint64)
        fps = centres[np.sort(rng.integers(0, 6, 900))]
        for _ in range(flips):
            fps[np.arange(900), rng.integers(0, 2, 900)] ^= np.uint64(1) << rng.integers(0, 64, 900).astype(np.uint64)
        group = np.sort(rng.integers(0, 4, 900))
        a, b = simhash.bucket_links(simhash.group_ends(group), fps, radius)
        assert (group[a] == group[b]).all() and (np.bitwise_count(fps[a] ^ fps[b]).sum(axis=1) <= radius).all()
        close = np.bitwise_count(fps[:, None] ^ fps[None, :]).sum(axis=2) <= radius
        x, y = np.nonzero(np.triu(close & (group[:, None] == group[None, :]), 1))
        assert chains(900, list(zip(a, b))) == chains(900, list(zip(x, y)))
        assert len(a) < 10 * 900


def test_all_similar_pairs_of_a_table_are_found(spark):
    rows = sf_rows(spark, sf="/root/testdata/sf0.01")
    texts = sorted({t for _, t in rows if t is not None})
    pairs = similar_pairs(texts)
    assert len(pairs) > 3
    root = chains(len(texts), pairs)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    key = {r["key"]: r["doc_id"] for r in df.selectExpr("doc_id", "xxhash64(text) as key").collect()}
    got = list(range(len(texts)))
    groups = {}
    for r in simhash.similar_groups(df, "text", "doc_id").collect():
        groups.setdefault(r["group"], []).append(key[r["key"]])
    for own in groups.values():
        for i in own:
            got[i] = min(own)
    least = {}
    for i, r in enumerate(root):
        least.setdefault(r, i)
    assert got == [least[r] for r in root]


def test_a_long_chain_is_verified_in_parts(spark, monkeypatch):
    # Drifting copies: neighbours are similar, far ones are not, so the naming text reaches a part of the chain only.
    monkeypatch.setattr(simhash, "VERIFY_PART", 8)
    monkeypatch.setattr(simhash, "SET_PART", 8)
    rng = random.Random(3)
    now = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    texts = []
    for i in range(60):
        texts.append(" ".join(now))
        for k in range(rng.choice((1, 2, 4, 12))):
            now[rng.randrange(150)] = f"n{i}_{k}"
    root = chains(len(texts), similar_pairs(texts))
    assert 1 < len(set(root)) < 30
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = [r["doc_id"] for r in simhash.drop_near_duplicates(df.repartition(3)).collect()]
    assert sorted(kept) == sorted({min(i for i, r in enumerate(root) if r == x) for x in set(root)})


def test_repeats_do_not_hide_similar_texts(spark):
    rng = random.Random(8)
    body = " ".join(f"b{rng.randrange(10**6)}" for _ in range(104))
    passage = " ".join(f"p{rng.randrange(10**6)}" for _ in range(10))
    rows = [(i, " ".join([body] + [passage] * times)) for i, times in enumerate((1, 20, 40))]
    kept = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r["doc_id"] for r in kept] == [0]


def test_common_shingles_come_last():
    hashes, size = np.array([1, 5, 9, 2, 5, 7, 8, 9], np.uint64), np.array([3, 5])
    doc, first = simhash.leading(hashes, size, np.array([5, 9], np.uint64), np.array([2, 1]), 8)
    assert list(zip(doc.tolist(), first.tolist())) == [(0, 1), (1, 2), (1, 7)]


def test_no_pair_of_small_sets_is_lost(spark):
    """Pairs at a similarity of 0.8 exactly, or a little above: of 4 and 5 shingles, and of 8 to 60."""
    rng = random.Random(8)
    rows, want = [], {}
    for k in range(6000):
        size = 8 if k < 4000 else rng.randrange(12, 64)
        first = [f"w{rng.randrange(10**9)}" for _ in range(size)]
        more = max(1, (size - 4) // 4)  # that many shingles of its own has the longer one
        second = first + [f"w{rng.randrange(10**9)}" for _ in range(more)]
        rows += [(2 * k, " ".join(first)), (2 * k + 1, " ".join(second))]
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == {2 * k for k in range(6000)}


def exchanges(df):
    """The columns of what a query's plan shuffles, without what is held or checkpointed."""
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return [set(re.findall(r"(\w+)#\d+", m)) for m in re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", text)]


def test_shingles_meet_without_fingerprints(spark):
    df = frame(spark, sf_rows(spark)).selectExpr("text as t", "xxhash64(text) as key").where("t is not null")
    shuffled = exchanges(simhash.candidates(df, 5, 8))
    assert {"__k", "id"} in shuffled and not any({"__k", "f0"} <= x for x in shuffled)


def test_only_keys_of_two_texts_meet_and_same_texts_once():
    rows = sorted([(1, 7), (2, 7), (2, 7), (2, 8), (3, 7), (3, 8), (4, 7), (4, 8), (4, 9), (5, 9), (5, 9)])
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["__k", "id"])
    groups = {}
    for b in simhash.met(iter([batch.slice(0, 4), batch.slice(4)])):
        for r in b.to_pylist():
            groups.setdefault(r["__g"], []).append(r["id"])
    assert sorted(groups.values()) == [[7, 8], [7, 8, 9]]


def test_rows_are_parted_without_shuffling_them(spark, monkeypatch):
    rows = spark.createDataFrame([(None if i % 50 == 0 else i, i % 7, f"t{i}") for i in range(400)], "i int, k int, text string")
    every = rows.selectExpr("i as __i", "k as __k", "k + 1 as __o").distinct()
    table = every.where("coalesce(__i, 0) % 3 = 0 and __k < 5").persist()
    marks = [F.col("i"), F.col("k"), F.col("k") + 1]
    for blocks in (1 << 18, 1):  # with one block, the filter takes nearly all rows
        monkeypatch.setattr(simhash, "MAX_BLOCKS", blocks)
        for most in (None, 0):
            inside, outside = simhash.parted(rows, marks, table, every, most)
            assert inside.columns == outside.columns == rows.columns
            assert sorted(map(str, inside.collect())) == sorted(map(str, rows.where("coalesce(i, 0) % 3 = 0 and k < 5").collect()))
            assert inside.count() + outside.count() == 400
            assert not any("text" in x for x in exchanges(inside.unionByName(outside)))


def test_long_lists_of_texts_are_not_broadcast(spark, monkeypatch):
    df = frame(spark, sf_rows(spark))
    rows = df.unionByName(df.limit(40)).selectExpr("doc_id", "text")
    want = sorted(map(str, simhash.drop_near_duplicates(rows).collect()))
    monkeypatch.setattr(simhash, "BROADCAST_ROWS", 0)
    assert sorted(map(str, simhash.drop_near_duplicates(rows).collect())) == want
