"""Approximate joins against scoring all pairs, and how few pairs they score."""

import random

import pytest

from civicflow.queries import QUERIES
from civicflow.udfs import fuzzy

from plain import table


def texts(rng, n, letters="abcde ", longest=16):
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(0, longest))) for _ in range(n)]


def all_pairs(own, options, k, threshold, kind):
    out = []
    for t in own:
        scored = []
        for j, o in enumerate(options):
            scores = [fuzzy.SCORERS[kind](a, b) for a, b in zip(t, o) if a is not None and b is not None]
            score = sum(scores) / len(scores) if scores else 0.0
            if score >= threshold:
                scored.append((score, j))
        out.append(sorted(scored, reverse=True)[:k])
    return out


@pytest.mark.parametrize("kind", sorted(fuzzy.SCORERS))
@pytest.mark.parametrize("threshold", [0, 60, 85])
def test_the_best_are_those_of_all_pairs(kind, threshold):
    rng = random.Random(threshold)
    own = [(t,) for t in texts(rng, 70) + ["aaaaaaaaaaaaaa", "אבגד הוז"]]
    options = [(t,) for t in sorted(set(texts(rng, 60) + ["aaaaaaaa", "אבגד הוח"]))]
    for k in (1, 4):
        assert fuzzy.best_options(own, options, k, threshold, kind) == all_pairs(own, options, k, threshold, kind)


def test_several_fields():
    rng = random.Random(9)
    some = lambda x: x if rng.random() > 0.2 else None
    own = [(some(a), some(b)) for a, b in zip(texts(rng, 60), texts(rng, 60, "xyz", 6))]
    options = [(some(a), some(b)) for a, b in zip(texts(rng, 40), texts(rng, 40, "xyz", 6))]
    for threshold in (0, 55):
        assert fuzzy.best_options(own, options, 5, threshold, "weighted") == all_pairs(own, options, 5, threshold, "weighted")


def test_few_pairs_are_scored(monkeypatch):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 9))) for _ in range(900)]
    names = sorted({" ".join(rng.choice(words) for _ in range(3)) for _ in range(1500)})
    typos = [(t[:5] + t[6:] if i % 2 else t.replace("e", "i"),) for i, t in enumerate(names)]
    calls = []
    monkeypatch.setitem(fuzzy.SCORERS, "ratio", lambda a, b, real=fuzzy.ratio: calls.append(1) or real(a, b))
    found = fuzzy.best_options(typos, [(n,) for n in names], 1, 80, "ratio")
    assert sum(f[0][1] == i for i, f in enumerate(found) if f) > 0.98 * len(names)
    assert len(calls) < 0.01 * len(names) ** 2


def test_reversed_texts_are_hardly_scored(monkeypatch):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 9))) for _ in range(60)]
    names = sorted({" ".join(rng.choice(words) for _ in range(3)) for _ in range(400)} | {"e" * 300, "ab" * 40})
    own = [(t[::-1],) for t in names] + [("x" * 70,), ("",)]
    want = all_pairs(own, [(n,) for n in names], 3, 60, "ratio")
    calls = []
    monkeypatch.setitem(fuzzy.SCORERS, "ratio", lambda a, b, real=fuzzy.ratio: calls.append(1) or real(a, b))
    assert fuzzy.best_options(own, [(n,) for n in names], 3, 60, "ratio") == want
    assert len(calls) < 0.02 * len(names) ** 2


def test_lots_of_a_block(spark, monkeypatch):
    monkeypatch.setattr(fuzzy, "LOT_TEXTS", 15)
    monkeypatch.setattr(fuzzy, "LOT_OPTIONS", 10)
    rng = random.Random(2)
    own, options = texts(rng, 60), sorted(set(texts(rng, 45)))
    df = spark.createDataFrame([(i, "g", t) for i, t in enumerate(own)] + [(100, "h", "abc"), (101, None, "abc"), (102, "g", None)], "i int, b string, t string")
    given = spark.createDataFrame([("g", o) for o in options] + [(None, "abc"), ("g", None)], "b string, c string")
    got = {r["i"]: [(m["score"], m["c"]) for m in r["matches"]] for r in fuzzy.top_matches(df, given, [("t", "c")], 3, 40, "ratio", ["b"]).collect()}
    want = all_pairs([(t,) for t in own], [(o,) for o in options], 3, 40, "ratio")
    assert got == {i: [(s, options[j]) for s, j in w] for i, w in enumerate(want)} | {100: [], 101: [], 102: []}
    assert fuzzy.top_matches(df, given.limit(0), [("t", "c")], 3).where("size(matches) > 0").count() == 0
    whole = fuzzy.top_matches(df, given, [("t", "c")], 1, 90).where("i >= 100").collect()
    assert {r["i"]: [m["c"] for m in r["matches"]] for r in whole} == {100: ["abc"], 101: ["abc"], 102: []}


def test_close_names(spark, sf_dir):
    parts = table(spark, sf_dir, "part").collect()
    name = {r["p_partkey"]: f"{r['p_name']} {r['p_type']} {r['p_size']}" for r in parts}
    want, kinds = set(), set()
    for r in parts:
        n, k = name[r["p_partkey"]], r["p_partkey"] % 6
        typo = {0: n, 1: n[:3] + n[4:], 2: "".join("o" if c in "aeiou" else c for c in n), 3: n[::-1], 4: "zz " + n}.get(k)
        options = sorted({name[o["p_partkey"]] for o in parts if o["p_size"] > 10 and o["p_brand"] == r["p_brand"]})
        if typo is not None:
            for score, j in all_pairs([(typo,)], [(o,) for o in options], 3, 60, "ratio")[0]:
                want.add((r["p_partkey"], options[j], score))
                kinds.add(min(int(score) // 10, 10))
    assert {tuple(r) for r in QUERIES["q_close_names"](spark, sf_dir).collect()} == want and {7, 8, 9, 10} <= kinds


def test_best_criteria(spark, sf_dir):
    parts = table(spark, sf_dir, "part").collect()
    want = set()
    for r in parts:
        own = (r["p_name"], r["p_type"] if r["p_partkey"] % 7 else None)
        options = sorted({(o["p_name"][::-1], o["p_type"]) for o in parts if o["p_size"] > 40 and o["p_brand"] == r["p_brand"]})
        for place, (score, j) in enumerate(all_pairs([own], options, 5, 0, "weighted")[0]):
            want.add((r["p_partkey"], place, *options[j], score))
    assert {tuple(r) for r in QUERIES["q_best_criteria"](spark, sf_dir).collect()} == want


def test_groups_meet_in_tasks_of_their_own(spark):
    rng = random.Random(4)
    own = [(i % 12, t) for i, t in enumerate(texts(rng, 120))]
    df = spark.createDataFrame([(str(b), t) for b, t in own], "b string, t string")
    given = df.select("b", df["t"].alias("c"))
    found = fuzzy.top_matches(df, given, [("t", "c")], 1, 0, "ratio", ["b"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") >= 2 and "hashpartitioning(__b#" in plan
