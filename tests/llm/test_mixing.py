import math
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from civicflow.llm import mixing

from .helpers import empty, frame


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.text("abcdef", min_size=1, max_size=3), st.integers(1, 40), min_size=1, max_size=8))
def test_deviation_is_under_a_block(shares):
    period = mixing.pfair_period(shares)
    total = sum(shares.values())
    assert sorted(t for _, _, t in period) == list(range(total))
    done = Counter()
    for s, j, t in period:
        assert done[s] == j
        done[s] += 1
        for x, k in shares.items():
            assert abs(done[x] - (t + 1) * k / total) < 1


def test_shares_sum_to_the_period():
    assert mixing.integer_shares({"a": 1, "b": 2, "c": 1}, 8) == {"a": 2, "b": 4, "c": 2}
    assert mixing.integer_shares({"a": 1e9, "b": 1e-9}, 100)["b"] == 1


@pytest.mark.parametrize("targets", [None, {"a": 3, "b": 1}])
def test_mixture_keeps_all_rows_and_shares(spark, targets, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 100)
    rows = [(i, "a" if i % 3 else "b", "x", 1) for i in range(1200)] + [(7, "a", "x", 1), (None, None, "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, source string, __s string, c0 int")
    out = mixing.mix(df, targets, block_rows=8, period=40).collect()
    assert Counter((r["doc_id"], r["source"]) for r in out) == Counter((r[0], r[1]) for r in rows)
    by_slot = defaultdict(set)
    places = Counter()
    for r in out:
        by_slot[r["mix_slot"]].add(r["source"])
        places[(r["mix_slot"], r["mix_pos"])] += 1
    assert all(len(s) == 1 for s in by_slot.values()) and max(places.values()) == 1
    if targets:
        first = [next(iter(by_slot[t])) for t in sorted(by_slot)][:40]
        assert abs(first.count("b") - 10) <= 1
    ordered = mixing.mixed_order(df, targets)
    assert ordered.columns == df.columns and ordered.count() == len(rows)


def test_awkward_tables(spark):
    assert mixing.mix(frame(spark)).count() == frame(spark).count()
    assert mixing.mix(empty(spark)).count() == 0


@pytest.mark.parametrize("weights", [{"a": 1, "b": 2}, {"a": 223.6, "b": 173.2, "c": 100.0, "d": 70.7}, {"a": 0.0001, "b": 0.9999}])
def test_deviation_from_the_weights_over_many_periods(weights):
    total, slots = sum(weights.values()), 60_000
    names = sorted(weights)
    shares = [mixing.exact_shares(weights)[s] for s in names]
    blocks = [int(slots * weights[s] / total) for s in names]
    done, every = Counter(), list(mixing.walk(shares, blocks))
    for i, j, t in every:
        if t >= slots - 20_000 // min(blocks):
            break
        assert done[i] == j
        done[i] += 1
        for k, s in enumerate(names):
            assert done[k] == blocks[k] or abs(done[k] - (t + 1) * weights[s] / total) < 1 + 1e-6
    starts = list(mixing.ranges(shares, blocks, 7_000))
    assert every == [x for slot, held in starts for x, _ in zip(mixing.walk(shares, blocks, held, slot), range(7_000))]


def test_mixture_follows_the_weights(spark):
    # blocks of one row; a period of 2,000 slots in shares of 667 and 1,333 is off by a block after three periods
    df = spark.range(9_000).selectExpr("id doc_id", "if(id < 3000, 'a', 'b') source")
    slots = sorted((r["mix_slot"], r["source"]) for r in mixing.mix(df, {"a": 1, "b": 2}, block_rows=1).collect())
    assert [t for t, _ in slots] == list(range(9_000))
    done = 0
    for t, s in slots:
        done += s == "a"
        assert abs(done - (t + 1) / 3) < 1


def edf_by_slots(shares, blocks):
    """Earliest deadline first, looking at all sources in each slot."""
    done, out, t = [0] * len(shares), [], 0
    while any(d < b for d, b in zip(done, blocks)):
        ready = [(math.ceil((done[i] + 1) / w), i) for i, w in enumerate(shares) if done[i] < blocks[i] and math.floor(done[i] / w) <= t]
        if ready:
            _, i = min(ready)
            out.append((i, done[i], t))
            done[i] += 1
        t += 1
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 30), st.integers(0, 40)), min_size=1, max_size=6))
def test_schedule_against_all_slots(sources):
    shares = [Fraction(w, sum(x for x, _ in sources)) for w, _ in sources]
    blocks = [n for _, n in sources]
    assert list(mixing.walk(shares, blocks)) == edf_by_slots(shares, blocks)


def test_deviation_of_thirds_and_of_a_tiny_weight_over_a_million_slots():
    for weights in ({"a": 1, "b": 1, "c": 1}, {"a": 1e-4, "b": 0.3333, "c": 0.6666}):
        names = sorted(weights)
        shares = [mixing.exact_shares(weights)[s] for s in names]
        slots = 1_000_000
        done = [0] * len(names)
        for i, _, t in mixing.walk(shares, [slots] * len(names)):
            if t >= slots:
                break
            done[i] += 1
            if t % 97 == 0 or i == 0:
                assert all(abs(d - (t + 1) * w) < 1 for d, w in zip(done, shares))


def test_large_tables_have_larger_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_BLOCKS", 20)
    out = mixing.mix(spark.range(1000).selectExpr("id doc_id", "if(id % 4 = 0, 'a', 'b') source"), block_rows=4).collect()
    assert len(out) == 1000 and max(r["mix_pos"] for r in out) == 49


def test_rows_against_a_plain_mixture(spark):
    # Which of a source's rows fill a block is free; where the source's blocks stand is not.
    rows = [(i, "abc"[i % 7 % 3], "t") for i in range(997)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    weights = {"a": 5.0, "b": 2.0, "c": 1.0}
    names, size = sorted(weights), Counter(s for _, s, _ in rows)
    shares = [Fraction(weights[s]) / 8 for s in names]
    want = {(names[i], t): min(16, size[names[i]] - 16 * j) for i, j, t in edf_by_slots(shares, [-(-size[s] // 16) for s in names])}
    out = mixing.mix(df, weights).collect()
    assert Counter((r["source"], r["mix_slot"]) for r in out) == want
    assert sorted(r["doc_id"] for r in out) == list(range(997))


@pytest.mark.parametrize("weight", [0, -1, float("nan"), float("inf")])
def test_targets_are_positive(spark, weight):
    with pytest.raises(ValueError, match="positive"):
        mixing.mix(frame(spark), {"s0": 1, "s1": weight})


def test_rows_of_one_id_are_spread(spark, monkeypatch):
    """A third of all rows without an id: their bucket is cut, and every row keeps a place of its own."""
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 50)
    rows = [(None if i % 3 == 0 else i, "ab"[i % 5 == 0]) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    got = mixing.mix(df, {"a": 3, "b": 1}, block_rows=8).collect()
    assert sorted((str(r["doc_id"]), r["source"]) for r in got) == sorted((str(i), s) for i, s in rows)
    assert len({(r["mix_slot"], r["mix_pos"]) for r in got}) == 3000
    places = {}
    for r in got:
        places.setdefault(r["mix_slot"], []).append((r["mix_pos"], r["source"]))
    assert all(len({s for _, s in own}) == 1 and sorted(p for p, _ in own) == list(range(len(own))) for own in places.values())
    lots = mixing.without_hot_buckets(df.selectExpr("source as __s", "doc_id", "0 as __b"), df.groupBy("source").count().selectExpr("source as __s", "0 as __b", "count as __n"))[1].collect()
    assert max(r["__n"] for r in lots) < 120 and sum(r["__n"] for r in lots) == 3000
