"""Queries without SQL against plain loops over their whole tables."""

import itertools
from collections import defaultdict

import pytest

from civicflow.queries import QUERIES
from civicflow.udfs.fuzzy import partial_ratio
from civicflow.udfs.names import fingerprint

from plain import cluster_name, linked, table


def test_fingerprints(spark, sf_dir):
    names = {r[0] for t, c in (("customer", "c_name"), ("supplier", "s_name"), ("part", "p_name")) for r in table(spark, sf_dir, t).select(c).collect()}
    assert {(r["name"], r["fingerprint"]) for r in QUERIES["q_fingerprint"](spark, sf_dir).collect()} == {(n, fingerprint(n)) for n in names}


def test_similarities(spark, sf_dir):
    rows = table(spark, sf_dir, "part").collect()
    got = {r["p_partkey"]: r["score"] for r in QUERIES["q_similarity"](spark, sf_dir).collect()}
    assert got == {r["p_partkey"]: partial_ratio(r["p_name"], r["p_type"]) for r in rows}


def test_clusters(spark, sf_dir):
    sums = defaultdict(lambda: defaultdict(lambda: [0.0, 0]))
    for r in table(spark, sf_dir, "part").collect():
        own = sums[r["p_brand"]][r["p_type"]]
        own[0] += r["p_retailprice"]
        own[1] += 1
    want = set()
    for brand, titles in sums.items():
        names = sorted(titles)
        root = linked(len(names), [(i, j) for i in range(len(names)) for j in range(i) if partial_ratio(names[i], names[j]) >= 90])
        tags = defaultdict(lambda: [0.0, 0])
        for r in set(root):
            own = [n for n, x in zip(names, root) if x == r]
            tag = cluster_name(own) if len(own) > 1 else own[0]
            tags[tag][0] += sum(titles[n][0] for n in own)
            tags[tag][1] += sum(titles[n][1] for n in own)
        ranked = sorted(tags.items(), key=lambda x: (-x[1][0], x[0]))
        kept = ranked[:4] + ([("אחרים", [sum(v[0] for _, v in ranked[4:]), sum(v[1] for _, v in ranked[4:])])] if len(ranked) > 4 else [])
        want |= {(brand, t, round(v[0], 2), v[1]) for t, v in kept}
    assert {(r["p_brand"], r["tag"], r["amount"], r["count"]) for r in QUERIES["q_clusters"](spark, sf_dir).collect()} == want


def first_groups(rows):
    """Groups of two to six rows of different leaders that sum to zero: the first in order each time, small ones first."""
    left, out = list(range(len(rows))), []
    for size in range(2, 7):
        found = True
        while found:
            found = next((c for c in itertools.combinations(left, size) if sum(rows[k][2] for k in c) == 0 and len({rows[k][1] for k in c}) == size), None)
            if found:
                out.append(found)
                left = [k for k in left if k not in found]
    return out + [(k,) for k in left]


def test_change_groups(spark, sf_dir):
    lines = defaultdict(list)
    from civicflow.plans import changes

    caught = {}
    real = changes.change_groups
    try:
        changes.change_groups = lambda df, measures: caught.setdefault("df", df) and real(df, measures)
        got = {(r["trcode"], r["group_id"], r["size"]) for r in QUERIES["q_change_groups"](spark, sf_dir).collect()}
    finally:
        changes.change_groups = real
    total = defaultdict(float)
    for r in caught["df"].where("leading_item <> 47").collect():
        if r["budget_code"].startswith("0047"):
            if r["net_expense_diff"]:
                lines[r["date_kind"]].append((r["trcode"], r["leading_item"], round(r["net_expense_diff"] * 1000)))
        else:
            total[r["trcode"]] += r["net_expense_diff"] or 0.0
    if max(map(len, lines.values())) > 30:
        pytest.skip("too many lines of a kind for all combinations")
    want = set()
    for rows in lines.values():
        rows.sort(key=lambda x: (x[0], x[2]))
        for g in first_groups(rows):
            codes = sorted({rows[k][0] for k in g})
            name = next((c for c in codes if total.get(c, 0.0) > 0), codes[0])
            want |= {(c, name, len(codes)) for c in codes}
    assert {x for x in got if any(x[0] == y[0] for y in want)} == want and len(got) >= len(want)
