import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from civicflow.functions import codes, dates, ids, scores, text, values
from civicflow.sources import portal
from civicflow.udfs import fuzzy
from civicflow.udfs.names import fingerprint, fingerprint_udf, slug_udf, unescape_udf


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x"))).first()[0]


@pytest.mark.parametrize("a, b", [
    ("simple", "simple"), ("דניה סיבוס", "דניה סיבוס"), ("simple ", "simple"), (" simple ", "simple"), ("", "<empty>"), (" ", "<empty>"), (None, "<empty>"),
    ("רמת-גן", "גן רמת"), ("JERUSALEM", "jerusalem"), ("דניה סיבוס בעמ", "דניה סיבוס"), ('דניה סיבוס בע"מ', "דניה סיבוס"), ("דניה סיבוס בע'מ", "דניה סיבוס"),
    ("דניה סיבוס - בעמ", "דניה סיבוס"), ("מועצה אזורית מטה יהודה", "יהודה מטה"), ("מ.א. מטה יהודה", "יהודה מטה"), ('מוא"ז מטה יהודה', "יהודה מטה"),
    ("מועצה איזורית מטה יהודה", "יהודה מטה"), ("עיריית ירושלים", "ירושלים"), ("עירית ירושלים", "ירושלים"), ("334343", "334343"),
    ("מועדון חבר", "מועדון"), ("334343-334343", "334343 334343"),
])
def test_fingerprints(a, b):
    assert fingerprint(a) == b


def test_fingerprint_udf_equals_function(spark):
    names = ["דניה סיבוס בעמ", None, "JERUSALEM 12", "דניה סיבוס בעמ"]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(fingerprint_udf("n")).collect()]
    assert got == [fingerprint(n) for n in names]


def test_codes(spark):
    assert one(spark, codes.dotted, "0020670142") == "20.67.01.42"
    assert [one(spark, codes.public_code, x) for x in ("00", "000012", "C12", "0020")] == ["TOTAL", None, None, "20"]
    assert one(spark, codes.prefixes, "002067") == ["0020", "002067", "20", "20.67", "2067"]
    assert [one(spark, codes.normalise, x) for x in ("20-67-01-42", "20670142", "0670142", "20670142.0", "2067", None)] == ["0020670142", "0020670142", "0000670142", "0020670142", None, None]
    assert one(spark, lambda c: codes.pad_left(c, 4), "123456") == "123456"
    assert one(spark, codes.levels, "0020670142") == ["0020", "002067", "00206701", "0020670142"]


def test_ids(spark):
    def check(digits):
        total = 0
        for i, c in enumerate(reversed(digits)):
            d = int(c) * (1 + i % 2)
            total += d // 10 + d % 10
        return total % 10 == 0

    tried = ["123456782", "12345674", "512345678", "12345", "12345678a", None, "000000018", "0000018"]
    want = [x is not None and x.isdigit() and 7 <= len(x) <= 9 and not (len(x) == 9 and x[0] == "5") and check(x) for x in tried]
    assert [one(spark, ids.israeli_id, x) for x in tried] == want
    assert one(spark, lambda c: ids.publication_id(2, c, existing=F.lit(0)), "a") // 100_000_000 == 2
    assert one(spark, lambda c: ids.publication_id(2, c, existing=F.lit(77)), "a") == 77


def test_dates(spark):
    assert [one(spark, dates.loose_date, x) for x in ("1", "3/4/21", "2021-04-03 10:20:30", "3.4.2021", "", "soon", None, "31/2/2020")] == [dt.date(1900, 1, 2), dt.date(2021, 4, 3), dt.date(2021, 4, 3), dt.date(2021, 4, 3), None, None, None, None]
    assert one(spark, lambda c: dates.parse_any(c, ["dd/MM/yyyy", "MM/dd/yyyy"]), "03/04/2021") == dt.date(2021, 3, 4)
    df = spark.createDataFrame([(2020, 4), (2000, 1), (2020, 5)], "y int, q int")
    assert [tuple(r) for r in df.select(dates.period_date(F.col("y"), F.col("q")), dates.period_date(F.col("y"), F.col("q"), False)).collect()] == [(dt.date(2021, 2, 15), dt.date(2020, 12, 31)), (None, None), (None, None)]
    d = spark.createDataFrame([(dt.date(2020, 1, 31), dt.date(2020, 3, 1)), (dt.date(2020, 3, 1), dt.date(2020, 1, 1)), (None, None)], "a date, b date")
    assert [r[0] for r in d.select(dates.month_list(F.col("a"), F.col("b"))).collect()] == [["2020-01", "2020-02", "2020-03"], [], []]
    assert [r[0]["date_from"] for r in d.select(dates.date_range("date-range", F.col("a"), F.col("b"))).collect()] == ["2020-01-31", "2020-03-01", "1900-01-01"]
    assert one(spark, lambda c: dates.date_range("year", c), 2020, "int")["months"] == [f"2020-{m:02d}" for m in range(1, 13)]
    assert one(spark, dates.epoch_date, "/Date(86400000)/") == dt.datetime(1970, 1, 2)
    assert one(spark, lambda c: dates.contract_active(F.lit(None).cast("date"), F.array(c), F.lit(dt.date(2020, 6, 1))), dt.date(2020, 1, 1), "date") is True
    assert one(spark, lambda c: dates.claim_status(c, F.lit(dt.date(2020, 5, 20)), F.lit(dt.date(2020, 6, 1))), None, "date") == "open"


def test_templates(spark):
    df = spark.createDataFrame([("a", 7, [5, 6], dt.date(2020, 3, 1), 1234567.0, None)], "s string, n int, xs array<int>, d date, m double, z string")
    assert df.select(values.template("{s}/{n:02d}/{xs[1]}/{d:%Y-%m}/{m:,}/{z}/")).first()[0] == "a/07/6/2020-03/1,234,567/None/"


def test_values(spark):
    assert one(spark, lambda c: values.first_text(F.lit(""), c), "x") == "x"
    assert one(spark, lambda c: values.first_number(F.lit(0), c), 4, "int") == 4
    assert one(spark, values.loose_number, "NIS 1,234.50 approx") == Decimal("1234.500000")
    assert one(spark, lambda c: values.to_boolean(c, ["כן"], ["לא"]), "לא") is False


def test_text(spark):
    assert one(spark, text.squeeze, " a \n  b\t") == "a b"
    assert one(spark, text.hebrew_words, "שלום abc עולם") == "שלום_עולם"
    assert one(spark, text.split_trim, "a; b ;;c") == ["a", "b", "c"]
    assert one(spark, lambda c: text.cut_at(c, "ת.ז"), "שם ת.ז 123") == "שם  ()"
    assert [one(spark, text.blank_placeholders, x) for x in ("___", "--", "", "a_")] == [None, None, None, "a_"]
    assert [one(spark, text.statistical_value, x) for x in ("..", "-", "(x)", ".000", "1.2.3", "1.5")] == ["", "", "", "", "", "1.5"]
    assert one(spark, text.html_to_text, "<p>a &amp; b</p><p>c</p>") == "a & b\nc"
    assert one(spark, text.visible_text, "<style>p{}</style><b>x</b><script>1<2</script>") == "x"
    assert one(spark, text.sanitize_html, '<a href="u" onclick="x()" target=_b>t</a>') == '<a href="u" target=_b>t</a>'
    assert [one(spark, text.phone, x) for x in ("+972 2-123 4567", "0501234567", "12")] == ["02-123-4567", "050-123-4567", "12"]
    assert one(spark, lambda c: text.chunks(c, 4, 1), "abcdefgh") == ["abcd", "defg", "gh"]
    assert one(spark, text.chunks, "") == []
    assert one(spark, lambda c: text.semantic_tags(F.array(c), [["car", "auto"]]), "new car") == ["new auto", "new car"]
    assert one(spark, text.quarter_of_title, "רבעון שני 2020") == 2 and one(spark, text.year_of_title, "רבעון שני 2020") == 2020
    assert one(spark, text.strip_formulas, '="00123",="4"') == '"00123","4"'
    assert one(spark, slug_udf, "Héllo, Wörld! and more than thirty-two characters") == "hello-world-and-more-than-thirty"
    assert one(spark, unescape_udf, "&lt;a&gt; &#1488;") == "<a> א"


def test_scores(spark):
    assert one(spark, scores.amount_score, 5.0, "double") == 1.0 and one(spark, scores.amount_score, 5000.0, "double") == 5.0
    assert one(spark, lambda c: scores.budget_score(c, F.lit("0000"), F.lit(2020), 2020), 4000.0, "double") == 2.0
    assert one(spark, lambda c: scores.report_score(c, F.lit(3)), 0, "int") == 13
    assert one(spark, lambda c: scores.weighted_answers([(c, 2.0, 5.0), (F.lit(None).cast("double"), 1.0, 5.0)]), 5.0, "double") == 1.0


def test_fuzzy():
    assert fuzzy.partial_ratio("abc", "xxabcxx") == 100 and fuzzy.ratio("abc", "abd") == 67
    assert fuzzy.token_sort_ratio("b a", "a b") == 100 and fuzzy.partial_ratio("", "a") == 0


def test_best_match_meets_in_blocks_only(spark):
    df = spark.createDataFrame([(1, "g", "hello world"), (2, "h", "hello world"), (3, "g", "zzz")], "i int, b string, t string")
    c = spark.createDataFrame([("g", "hello wurld"), ("g", "other"), ("h", "nothing")], "b string, c string")
    out = fuzzy.best_match(df, c, "t", "c", ["b"], 80).orderBy("i").collect()
    assert [r["match"] for r in out] == ["hello wurld", None, None]
    with pytest.raises(ValueError):
        fuzzy.best_match(df, c, "t", "c", [], 80)


def test_best_match_of_a_large_block(spark, monkeypatch):
    monkeypatch.setattr(fuzzy, "LOT_TEXTS", 10)
    rng = random.Random(2)
    texts = sorted({"".join(rng.choice("abcd") for _ in range(rng.randrange(3, 9))) for _ in range(60)})
    options = sorted({"".join(rng.choice("abcd") for _ in range(rng.randrange(3, 9))) for _ in range(40)})
    df, c = spark.createDataFrame([("g", t) for t in texts], "b string, t string"), spark.createDataFrame([("g", t) for t in options], "b string, c string")
    got = {r["t"]: (r["match"], r["match_score"]) for r in fuzzy.best_match(df, c, "t", "c", ["b"], 75).collect()}
    best = {t: max((fuzzy.ratio(t, o), o) for o in options) for t in texts}
    assert got == {t: (o, s) if s >= 75 else (None, None) for t, (s, o) in best.items()}


def test_titles_are_mended(spark):
    assert one(spark, lambda c: text.without_prefixes(c, ["a - ", "b - "]), "a - b - x", "string") == "x"
    assert one(spark, lambda c: text.corrected(c, {"wrong": "right"}), "wrong", "string") == "right" and one(spark, lambda c: text.corrected(c, {"wrong": "right"}), "other", "string") == "other"
    assert one(spark, text.first_email, "write to me.x@y.org or z@z.z", "string") == "me.x@y.org"
    assert one(spark, lambda c: text.lone_budget_code(c, "fund"), "24-05-07,fund 1", "string") == "0020240507"
    assert one(spark, lambda c: text.lone_budget_code(c, "fund"), "240507,250608", "string") is None
    assert one(spark, text.anchor_text, 'see <a href="x">this page</a>', "string") == "this page"


def plain_repair(data, mark="5"):
    """The repair as a machine over single characters: white space waits for the character after it."""
    out, waiting, last = [], "", None
    for c in data:
        if c in "\r\n\t ":
            waiting += c
            continue
        if waiting:
            if c == mark:
                out.append("\n" if waiting[-1] in "\r\n" else " ")
            elif last != "," and c != ",":
                out.append(" ")
            waiting = ""
        last = c
        out.append(c)
    return [x for x in "".join(out).lstrip(" \n").split("\n") if x]


def test_csv_repair(spark, tmp_path):
    import random

    rng = random.Random(6)
    made = ["".join(rng.choice("5,ab \n\r\t") for _ in range(rng.randrange(0, 60))) for _ in range(300)] + ["51,foo\n bar,x\n52,a ,\n b\r\n5", "", "  \n 5"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(made)], "i int, t string")
    got = {r["i"]: r["l"] for r in df.select("i", portal.repaired_text(F.col("t")).alias("l")).collect()}
    assert {i: [x for x in t.split("\n") if x] for i, t in got.items()} == {i: plain_repair(t) for i, t in enumerate(made)}
    for i, t in enumerate(made[:12] + ["".join(f"{k},שדה{k % 7} \r\n ב ,\t5\n5" for k in range(4000))]):
        (tmp_path / f"{i}.csv").write_bytes(t.encode("cp1255"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # breaks stand across the ends of splits
    try:
        rows = portal.repaired_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    by_file = {}
    for r in sorted(rows, key=lambda r: r["record"]):
        by_file.setdefault(int(r["file"].rsplit("/", 1)[1][:-4]), []).append(r["line"])
    for f in tmp_path.iterdir():
        assert by_file.get(int(f.stem), []) == plain_repair(f.read_bytes().decode("cp1255")), f
