import random
import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from civicflow.llm import licenses

from .helpers import empty, frame, lower, sf_rows

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def base(text):
    w = WORD.findall(lower(text or ""))
    places, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_query_against_brute_force(spark):
    mit = licenses.TEMPLATES[1][1]
    extra = [(50, "MIT License mit-license; Apache  License x"), (51, "junk " * 30 + mit.replace("sublicense", "resell") + " tail" * 5), (52, "mit\u00e9 license général public license"), (53, mit[: len(mit) // 4])]
    df = frame(spark, extra + [(1000 + i, t) for i, t in sf_rows(spark)])
    got = licenses.scan_licenses(df).collect()
    columns = ("n_words", "n_base", "first_word", "last_word", "base_labels")
    assert sorted((str(r["doc_id"]), *map(str, (r[c] for c in columns))) for r in got) == sorted((str(r["doc_id"]), *map(str, base(r["text"]))) for r in df.collect())
    by_id = {r["doc_id"]: r for r in got}
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in got)
    assert "mit" in by_id[51]["labels"] and by_id[51]["spans"][0]["first"] == 30 and by_id[51]["score"] > 0.9
    assert by_id[53]["labels"] == ""
    assert licenses.scan_licenses(empty(spark)).count() == 0


@settings(max_examples=120, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=9), max_size=4), st.lists(st.integers(0, 4), max_size=14))
def test_automaton_gives_matching_statistics(templates, text):
    a = licenses.SuffixAutomaton(templates)
    found = list(a.stream(text))
    parts = {tuple(t[i:j]): None for t in templates for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    longest = [max((n for n in range(i + 1) if n == 0 or tuple(text[i - n : i]) in parts), default=0) for i in range(len(text) + 1)]
    want = [(i, n) for i, n in enumerate(longest) if n and (i == len(text) or longest[i + 1] != n + 1)]
    assert [(e, n) for e, n, _ in found] == want
    for end, n, state in found:
        run = text[end - n : end]
        assert a.ends[state] == sorted({(t, j) for t, s in enumerate(templates) for j in range(n, len(s) + 1) if s[j - n : j] == run})


def test_scan_of_nothing():
    assert licenses.Scanner().scan(pa.array([], pa.string())) == []


def test_each_copy_of_a_licence_is_a_span(spark):
    mit, apache = licenses.TEMPLATES[1][1], licenses.TEMPLATES[3][1]
    size = {x: len(licenses.template_words(x)) for x in (mit, apache)}
    some = [f"x{i}" for i in range(40)]
    parts = [*some, mit, *some, mit, mit, apache, *some, mit.rsplit(" ", 8)[0], *some, apache]
    want, at = [], 0
    for part in parts:
        n = len(licenses.template_words(part))
        if n > 1:
            want.append(("mit" if "hereby" in part else "apache", at, at + n, n / size[mit if "hereby" in part else apache]))
        at += n
    found = licenses.Scanner([("mit", mit), ("apache", apache)]).scan(pa.array([" ".join(parts), " ".join([mit] * 500), mit]))
    assert sorted(found[0]["spans"], key=lambda s: s[1]) == want
    assert [s[1:3] for s in found[1]["spans"]] == [(k * size[mit], (k + 1) * size[mit]) for k in range(500)]
    assert len(found[2]["spans"]) == 1


def edited(text, rng, every):
    """The text with a word in every so many replaced, dropped or doubled."""
    out = []
    for w in text.split():
        kind = rng.randrange(3 * every)
        out += ["changed"] if kind == 0 else [] if kind == 1 else [w, w] if kind == 2 else [w]
    return " ".join(out)


def test_whole_licences_with_edits_are_labelled(spark):
    rng = random.Random(7)
    whole = licenses.whole_licenses()
    rows, want = [], {}
    for i, (label, text) in enumerate(whole):
        lead = " ".join(f"x{k}" for k in range(20 + i))
        rows += [(i, lead + " " + edited(text, rng, 40) + " tail" * 9), (100 + i, lead + " " + " ".join(text.split()[: len(text.split()) // 4]))]
        want[i] = (label, 20 + i)
    got = {r["doc_id"]: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (label, first) in want.items():
        n = len(licenses.template_words(whole[i][1]))
        spans = [s for s in got[i]["spans"] if s["label"] == label and s["end"] - s["first"] > 0.8 * n]
        assert label in got[i]["labels"].split(",") and len(spans) == 1
        assert abs(spans[0]["first"] - first) < 12 and abs(spans[0]["end"] - first - n) < 0.03 * n + 12 and spans[0]["coverage"] > 0.85
        assert not [s for s in got[100 + i]["spans"] if s["end"] - s["first"] > 0.5 * n]  # a quarter is no licence


def chain_by_all_ways(found, gap):
    """The most template words that matches in order with short gaps cover, by trying each chain."""
    best = 0

    def grow(last, covered):
        nonlocal best
        best = max(best, covered)
        for d, s, n in found:
            pd, ps, pn = last
            lap = max(0, pd + pn - d, ps + pn - s)
            if pd < d and ps < s and lap < n and d - pd - pn <= gap and s - ps - pn <= gap:
                grow((d, s, n), covered + n - lap)

    for m in found:
        grow(m, m[2])
    return best


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30), st.integers(3, 8)), min_size=1, max_size=8, unique=True))
def test_best_chain_against_all_chains(found):
    most = chain_by_all_ways(found, licenses.MAX_GAP)
    got = licenses.Scanner._chains(sorted(found), 1)
    assert max(covered for _, _, covered in got) == most
    assert not licenses.Scanner._chains(sorted(found), most + 1)
    assert all(a[1] <= b[0] for a, b in zip(got, got[1:]))


def test_templates_inside_others_are_found(spark):
    inner = "c d e f g h i j k l m n"
    templates = [("outer", f"alpha beta {inner} omega psi chi"), ("inner", inner)]
    rows = [(30, f"alpha beta {inner} zz"), (31, f"alpha beta {inner} omega"), (32, f"alpha beta {inner} omega psi chi"), (33, f"x {inner} y"), (34, "c d e f g h")]
    got = {r["doc_id"]: r["labels"] for r in licenses.scan_licenses(frame(spark, rows), templates=templates).where("doc_id >= 30").collect()}
    assert got == {30: "inner,outer", 31: "inner,outer", 32: "inner,outer", 33: "inner", 34: ""}


def test_matches_against_all_places():
    rng = random.Random(3)
    for _ in range(200):
        sequences = [[rng.randrange(3) for _ in range(rng.randrange(1, 14))] for _ in range(3)]
        codes = [rng.randrange(3) for _ in range(rng.randrange(0, 30))]
        own = licenses.SuffixAutomaton(sequences)
        want = set()
        for t, seq in enumerate(sequences):
            for i in range(len(codes)):
                for j in range(len(seq)):
                    n = 0
                    while i + n < len(codes) and j + n < len(seq) and codes[i + n] == seq[j + n]:
                        n += 1
                    if n >= 2 and not (i and j and codes[i - 1] == seq[j - 1]):
                        want.add((t, i, j, n))
        assert set(own.matches(codes, 2, own.holders(2))) == want
