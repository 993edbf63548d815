from collections import Counter

from civicflow.llm import quality

from .helpers import empty, frame, sf_rows, words


def brute(text):
    text = text or ""
    w = words(text)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    inside = set()
    for i in range(len(w) - 2):
        if windows[tuple(w[i : i + 3])] > 1:
            inside |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    n = len(w)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(inside), n < 50 or 100 * len(inside) > 50 * n


def test_metrics_against_brute_force(spark):
    extra = [(50, "a b c a b c a b"), (51, "x\nx\n \n \nx y\nX\nx\r\nx\r"), (52, "é# ü|<> x$ " * 20), (53, "a a a a"), (54, "a b a")]
    df = frame(spark, extra + [(1000 + i, t) for i, t in sf_rows(spark)])
    got = quality.quality(df).collect()
    assert sorted((str(r["doc_id"]), *[r[m] for m in quality.METRICS], r["base_failed"]) for r in got) == sorted((str(r["doc_id"]), *brute(r["text"])) for r in df.collect())
    assert not any(r["base_failed"] and r["kept"] for r in got)
    kept = Counter(str(r["doc_id"]) for r in got if r["kept"])
    out = quality.keep_good(df)
    assert out.columns == df.columns
    assert Counter(str(r["doc_id"]) for r in out.collect()) == kept
    assert quality.quality(empty(spark)).count() == 0 and quality.keep_good(empty(spark)).count() == 0


def test_huge_vocabularies_count_alike():
    import pyarrow as pa

    from civicflow.llm import words as W

    text = "a b c d a b c x y z x y z q\nq"
    w = W.split_words(pa.array([text]))
    assert quality.huge(w) == tuple(int(v[0]) for v in quality.measure(pa.array([text])).values())


def test_bad_host_turns_soft_rules_against_its_failures(spark):
    clean = " ".join(f"word{i}" for i in range(100))
    noisy = " ".join(f"word{i}##" for i in range(100))
    rows = [(i, noisy if i % 10 else clean, "bad") for i in range(100)]
    rows += [(1000 + i, clean if i % 50 else noisy, f"good{i % 5}") for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality.quality(df).collect()}
    assert [kept[i] for i in range(0, 100, 10)] == [True] * 10  # clean documents stay even there
    assert not any(kept[i] for i in range(100) if i % 10)
    assert all(kept[1000 + i] for i in range(500))
