"""What a review found: whole jobs, and steps that hold little at any size."""

import contextlib
import datetime as dt
import io
import zipfile

from pyspark.sql import functions as F

import corpus_pipeline
from civicflow.llm import simhash
from civicflow.operators import chains, windows
from civicflow.plans import changes
from civicflow.queries import QUERIES
from civicflow.sources import archives, portal
from civicflow.state import versions
from civicflow.streaming import incremental

from plain import table


def test_split_requests_cover_all_days(spark, sf_dir):
    got = {r["day"]: r for r in QUERIES["q_split_requests"](spark, sf_dir).collect()}
    orders = table(spark, sf_dir, "orders")
    assert len(got) == orders.selectExpr("date(o_orderdate)").distinct().count() > 31
    assert sum(r["orders"] for r in got.values()) == orders.count() and {r["requests"] for r in got.values()} == {1, 2}


def test_stream_totals_have_open_windows_and_late_rows(spark, sf_dir, tmp_path):
    events = table(spark, sf_dir, "events")
    got = QUERIES["q_stream_totals"](spark, sf_dir).selectExpr("count(*)", "sum(n)").first()
    assert tuple(got) == (events.selectExpr("user_id", "date(ts)").distinct().count(), events.count())
    days = [dt.datetime(2024, 1, d) for d in (20, 1, 9)]  # a file a batch, the second one far behind the first
    for i, t in enumerate(days):
        spark.createDataFrame([("a", i + 1, t)], "k string, v long, t timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = incremental.read_files(spark, str(tmp_path / "in"), "k string, v long, t timestamp", per_trigger=1)
    totals = incremental.running_totals(stream, ["k"], "v", "t").select("k", "window.start", "n", "total")
    out = incremental.whole_totals(totals, str(tmp_path / "out"), str(tmp_path / "state"))
    assert sorted(map(tuple, out.collect())) == sorted(("a", t, 1, i + 1) for i, t in enumerate(days))


def test_sequences_follow_the_mixture(spark, sf_dir, tmp_path):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    firsts, ranks = {}, {}
    for name, key in (("up", "doc_id"), ("down", "-doc_id")):
        path = str(tmp_path / name)
        docs.orderBy(F.expr(key)).repartitionByRange(3, F.expr(key)).sortWithinPartitions(F.expr(key)).write.parquet(path)
        got = sorted((r["sequence_id"], r["offset"], r["doc_id"]) for r in corpus_pipeline.packing_stage(spark, spark.read.parquet(path), sf_dir).collect())
        firsts[name] = [d for _, offset, d in got if offset == 0]
        ranks[name] = [d if name == "up" else -d for d in firsts[name]]
    assert firsts["up"] != firsts["down"]
    for own in ranks.values():  # sequences begin in the order of the rows, up to a window
        half = len(own) // 2
        assert half > 2 and sum(own[:half]) / half < sum(own[half:]) / (len(own) - half) - 40
    assert corpus_pipeline.packing_stage(spark, spark.createDataFrame(docs.limit(5).collect(), docs.schema), sf_dir).count() >= 5


def test_ranges_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(windows, "MAX_RANGES", 3)
    df = spark.range(100).withColumn("k", F.expr("100 - id"))
    assert windows.in_ranges(df, ["k"], 5).select("__part").distinct().count() <= 3
    assert sorted((r["id"], r["index"]) for r in windows.numbered(df, ["k"], rows=5).collect()) == [(i, 99 - i) for i in range(100)]


def test_buckets_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "MAX_BUCKETS", 4)
    t = versions.VersionedTable(spark, str(tmp_path / "t"), ["k"], 10)
    for first in (0, 100):
        t.update(spark.range(first, first + 150).selectExpr("id as k", f"{first} as v"))
    assert t.snapshot().buckets == 4
    assert sorted(map(tuple, t.read().collect())) == [(k, 0 if k < 100 else 100) for k in range(250)]


def test_groups_that_come_in_known_order(spark):
    known = spark.createDataFrame([("d", 1, ["c", "b", "a"]), ("d", 2, ["c", "d"]), ("d", 3, ["d", "e"]), (None, 1, ["x", "y"]), ("d", 0, ["a", "gone"])], "date_kind string, serial long, trcodes array<string>")
    lines = spark.createDataFrame([("d", c) for c in "abcde"] + [(None, "x"), (None, "y")], "date_kind string, trcode string")
    found = changes.known_groups(lines, known)
    assert dict(found.dtypes)["key"] == "int"  # a number, not the group's codes
    groups = {}
    for r in found.collect():
        groups.setdefault((r["date_kind"], r["key"]), set()).add(r["trcode"])
    assert sorted(map(sorted, groups.values())) == [["a", "b", "c"], ["d", "e"], ["x", "y"]]


def test_repaired_lines_over_chunks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(portal, "CHUNK_BITS", 1)
    (tmp_path / "a.csv").write_text("".join(f"5{i},\nx\n\n y,z \n" for i in range(40)))
    got = portal.repaired_lines(spark, str(tmp_path), encoding="utf-8")
    assert "chunk" in got._jdf.queryExecution().optimizedPlan().toString()
    assert [r["line"] for r in got.orderBy("record").collect()] == [f"5{i},x y,z" for i in range(40)]


def test_large_directories_are_read_and_written_in_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "PIECE_BYTES", 100)
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        for i in range(70_000):  # more than plain fields count
            z.writestr(f"é{i}" if i % 2 else f"f{i}", "x" * (i % 9))
        infos = [(i.filename, i.header_offset, i.compress_size, i.file_size, i.compress_type, i.CRC) for i in z.infolist()]
    with archives.opened(str(tmp_path / "a.zip")) as f:
        assert list(archives.entries(f)) == infos
    made = archives.Archive(open(tmp_path / "b.zip", "wb"))
    for i in range(70_000):
        made.add(f"é{i}", b"y" * (i % 5))
    made.close()
    with zipfile.ZipFile(tmp_path / "b.zip") as z:
        assert len(z.namelist()) == 70_000 and z.read("é69999") == b"yyyy" and z.testzip() is None


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(True)
    return out.getvalue()


def test_stars_take_no_rounds_and_a_round_few_shuffles(spark, monkeypatch):
    edges = spark.createDataFrame([(i // 10 * 10, i) for i in range(100)] + [(0, 7), (3, 0)], "a long, b long")
    round_ = chains._small_star(chains._large_star(edges.toDF("m", "v"), 100, 10), 100, 10)
    assert plan_of(round_).rpartition("Physical Plan")[2].count("Exchange ") <= 3
    monkeypatch.setattr(chains, "_large_star", None)
    got = {r["node"]: r["root"] for r in chains.components(edges).collect()}
    assert got == {i: i // 10 * 10 for i in range(100)}


def test_verified_links_have_no_nested_plans(spark, monkeypatch):
    monkeypatch.setattr(simhash, "VERIFY_PART", 4)
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join([*base[:30], f"x{k}", *base[30:]] if k < 8 else [*base[: 60 - k], *(f"y{i}" for i in range(k))]) for k in range(16)]
    rows = spark.createDataFrame([(k, 0, t) for k, t in enumerate(texts)], "key long, chain long, t string")
    links = simhash.verified(rows, 5, 8, 16)
    assert plan_of(links).rpartition("Physical Plan")[2].count("InMemoryRelation") <= 4
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    similar = [(a, b) for a in range(16) for b in range(a) if len(sets[a] & sets[b]) * 10 >= 8 * len(sets[a] | sets[b])]
    group = list(range(16))
    for _ in group:
        for a, b in similar:
            group[a] = group[b] = min(group[a], group[b])
    got = {r["node"]: r["root"] for r in chains.components(links).collect()}
    assert got and [got.get(i, i) for i in range(16)] == group
