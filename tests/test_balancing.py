"""Balanced groups against the plain greedy search, and planted groups among many lines."""

import itertools
import random

import pytest

from civicflow.plans import balancing, changes

LINES = "line long, kind string, idx long, leader long, amounts array<long>"


def first_groups(rows, sizes=range(2, 7)):
    """rows: (leader, amounts); groups of places, the first in order each time, small ones first."""
    left, out = list(range(len(rows))), []
    for size in sizes:
        found = True
        while found:
            found = next((c for c in itertools.combinations(left, size) if len({rows[k][0] for k in c}) == size and not any(map(sum, zip(*(rows[k][1] for k in c))))), None)
            if found:
                out.append(found)
                left = [k for k in left if k not in found]
    return {frozenset(g) for g in out}


def groups_of(found):
    out = {}
    for r in found.collect():
        out.setdefault(r["first"], set()).add(r["line"])
    assert all(min(g) == first for first, g in out.items())
    return set(map(frozenset, out.values()))


@pytest.mark.parametrize("table", [balancing.TABLE, 6])
def test_groups_are_those_of_the_plain_search(spark, table, monkeypatch):
    monkeypatch.setattr(balancing, "TABLE", table)  # the plan's lots follow it; so do the passes of tasks that fork with it
    rng, rows, want = random.Random(5), [], set()
    for kind in range(14):
        n, top, measures = rng.randrange(2, 15), rng.choice([2, 5, 30]), rng.choice([1, 2])
        own = [(rng.randrange(6), [rng.choice([-1, 1]) * rng.randrange(1, top) for _ in range(measures)] + [0] * (2 - measures)) for _ in range(n)]
        want |= {frozenset(100 * kind + k for k in g) for g in first_groups(own)}
        rows += [(100 * kind + k, str(kind), k, leader, amounts) for k, (leader, amounts) in enumerate(own)]
    rng.shuffle(rows)
    assert groups_of(balancing.balanced_groups(spark.createDataFrame(rows, LINES))) == want


def test_equal_lines_are_taken_in_order(spark):
    rows = [(k, "d", k, k % 3, [1 if k < 400 else -2]) for k in range(600)]
    got = groups_of(balancing.balanced_groups(spark.createDataFrame(rows, LINES)))
    left, want = list(range(600)), set()
    while True:  # the first free line with the first free partners, by trying them in order
        found = None
        ones, twos = [k for k in left if k < 400], [k for k in left if k >= 400]
        for i, j in itertools.combinations(ones, 2):
            if i % 3 != j % 3:
                k = next((k for k in twos if k % 3 not in (i % 3, j % 3)), None)
                if k is not None:
                    found = (i, j, k)
                    break
        if not found:
            break
        want.add(frozenset(found))
        left = [k for k in left if k not in found]
    assert {g for g in got if len(g) == 3} == want and len(want) > 100


def planted(n, seed, measures=5):
    """Lines of one kind: groups of two to six that balance, and others that do not, in random order."""
    rng, rows, groups = random.Random(seed), [], []
    while len(rows) < n:
        size = rng.choice([1, 2, 3, 4, 5, 6])
        own = [[1000 * rng.randrange(-(10**7), 10**7) for _ in range(measures)] for _ in range(size)]
        if size > 1:
            own[-1] = [-sum(x) for x in zip(*own[:-1])]
        leaders = rng.sample(range(80), size)
        groups.append([len(rows) + i for i in range(size)])
        rows += list(zip(leaders, own))
    order = list(range(len(rows)))
    rng.shuffle(order)
    place = {k: i for i, k in enumerate(order)}
    return [(place[k], "d", place[k], leader, amounts) for k, (leader, amounts) in enumerate(rows)], {frozenset(place[k] for k in g) for g in groups if len(g) > 1}


def test_planted_groups_of_one_kind(spark):
    rows, want = planted(500, 3)
    assert groups_of(balancing.balanced_groups(spark.createDataFrame(rows, LINES))) == want


def test_known_groups_that_share_codes(spark):
    rows = [(c, "d", "0047", 1 + i, 1.0) for i, c in enumerate("abcdef")]
    df = spark.createDataFrame(rows, "trcode string, date_kind string, budget_code string, leading_item int, net_expense_diff double")
    known = spark.createDataFrame([("d", 3, ["a", "b"]), ("d", 1, ["b", "c"]), ("d", 2, ["c", "d"]), ("d", 4, ["d", "e"]), ("d", 0, ["f", "gone"]), (None, 0, ["a"])], "date_kind string, serial long, trcodes array<string>")
    got = {r["trcode"]: r["group_id"] for r in changes.change_groups(df, ["net_expense_diff"], known).collect()}
    assert got == {"a": "a", "b": "b", "c": "b", "d": "d", "e": "d", "f": "f"}


def test_no_lines(spark):
    assert balancing.balanced_groups(spark.createDataFrame([], LINES)).count() == 0


def drawn(kinds, seed):
    """Lines of kinds of one to fourteen, in order, and the groups that the plain search finds among them."""
    rng, rows, want = random.Random(seed), [], set()
    for kind in range(kinds):
        top, measures = rng.choice([2, 5, 30]), rng.choice([1, 2])
        own = [(rng.randrange(6), [rng.choice([-1, 1]) * rng.randrange(0, top) for _ in range(measures)] + [0] * (2 - measures)) for _ in range(rng.randrange(1, 15))]
        moved = [k for k, x in enumerate(own) if any(x[1])]
        want |= {frozenset(100 * kind + moved[k] for k in g) for g in first_groups([own[k] for k in moved])}
        rows += [(100 * kind + k, str(kind), k, leader, amounts) for k, (leader, amounts) in enumerate(own)]
    return rows, want


def test_kinds_of_few_lines_are_searched_as_they_pass(spark, monkeypatch):
    monkeypatch.setattr(balancing, "PASS_LINES", 20)  # tasks get it with their function
    rows, want = drawn(60, 11)
    random.Random(1).shuffle(rows)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, "7")  # kinds come in several batches
    try:
        got = [[x["line"] for x in r["group"]] for r in balancing.groups_of_few(spark.createDataFrame(rows, LINES), ["idx"], ["line"]).collect()]
    finally:
        spark.conf.set(size, before)
    assert sorted(x for g in got for x in g) == sorted(r[0] for r in rows)
    assert {frozenset(g) for g in got if len(g) > 1} == want and all(g == sorted(g) for g in got)


def changes_of(spark, rows):
    """The changes that give rows as lines of the reserve; two codes have no such line."""
    lines = [(f"{line:05d}", None if kind == "0" else kind, code, leader, *(sign * a / 1000 for a in amounts)) for line, kind, _, leader, amounts in rows for code, sign in (("0047", 1), ("0020", -1))]
    lines += [("x", "1", "0020", 1, 5.0, 0.0), ("x", "2", "0030", 1, 5.0, 0.0), ("y", None, None, 1, 5.0, 0.0), ("z", "1", "0047", 47, 5.0, 0.0)]
    return spark.createDataFrame(lines, "trcode string, date_kind string, budget_code string, leading_item int, m double, n double")


def named(rows, groups):
    """code, group's code and size as change_groups gives them."""
    amounts = {f"{r[0]:05d}": -sum(r[4]) / 1000 for r in rows}
    groups = [sorted(f"{line:05d}" for line in g) for g in groups]
    alone = {(c, c, 1) for c in [*amounts, "x", "y"]} - {(c, c, 1) for g in groups for c in g}
    return alone | {(c, next((x for x in g if amounts[x] > 0), g[0]), len(g)) for g in groups for c in g}


def test_change_groups_of_few_lines_need_no_rounds(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("kinds of few lines came to the rounds of large ones")

    monkeypatch.setattr(balancing, "balanced_sets", refuse)
    rows, want = drawn(25, 12)
    got = changes.change_groups(changes_of(spark, rows), ["m", "n"]).collect()
    assert sorted(map(tuple, got)) == sorted(named(rows, want))


def test_change_groups_of_small_and_large_kinds(spark, monkeypatch):
    monkeypatch.setattr(balancing, "TABLE", 700)  # kinds of more than five lines are large
    assert balancing.few_lines() == 5
    rows, want = drawn(25, 13)
    got = changes.change_groups(changes_of(spark, rows), ["m", "n"]).collect()
    assert sorted(map(tuple, got)) == sorted(named(rows, want))
