import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from civicflow.plans import indexer, spec
from civicflow.package import Package
from civicflow.sinks import writers
from civicflow.sources import paged, readers
from civicflow.state.history import as_of_day, history_updates
from civicflow.state import revisions, versions
from civicflow.state.revisions import changed_only, manage_revisions, revision_dates, row_hash
from civicflow.state.upsert import upsert, upsert_table
from civicflow.streaming import incremental

DAY1, DAY2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 11)


def test_revisions_over_two_runs(spark):
    first = spark.createDataFrame([("a", 1, True), ("b", 2, None)], "k string, v int, t boolean")
    run1 = manage_revisions(first, None, ["k"], DAY1)
    assert {r["k"]: (r["__is_new"], r["__is_stale"], r["__staleness"], r["__next_update_days"]) for r in run1.collect()} == {k: (True, True, 100000, 1) for k in "ab"}
    second = spark.createDataFrame([("a", 1, True), ("b", 9, None), ("c", 3, False)], "k string, v int, t boolean")
    run2 = {r["k"]: r for r in manage_revisions(second, run1, ["k"], DAY2).collect()}
    assert (run2["a"]["__is_new"], run2["a"]["__next_update_days"], run2["a"]["__last_modified_at"], run2["a"]["__created_at"]) == (False, 12, DAY1, DAY1)
    assert (run2["b"]["__next_update_days"], run2["b"]["__last_modified_at"], run2["b"]["__created_at"]) == (1, DAY2, DAY1)
    assert run2["a"]["__staleness"] == int(100000 + 100000 / 10) and run2["c"]["__is_new"]
    assert {r["k"] for r in changed_only(manage_revisions(second, run1, ["k"], DAY2)).collect()} == {"b", "c"}
    assert revision_dates(run1).first()["rev_created_at"] == DAY1.date()


def test_row_hash_is_md5_of_texts(spark):
    import hashlib

    df = spark.createDataFrame([(True, None, "x")], "b boolean, a int, c string")
    assert df.select(row_hash(df, ["c", "b", "a"])).first()[0] == hashlib.md5(b"None|True|x").hexdigest()
    assert df.select(row_hash(df, [])).first()[0] == ""


def test_history(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, None), ("c", 1, "z")], "k string, o int, v string")
    stored = spark.createDataFrame([("c", "z", dt.date(2023, 1, 1)), ("a", "x", dt.date(2023, 1, 1))], "k string, v string, __updated date")
    new = history_updates(df, stored, ["k"], ["v"], DAY1.date(), ["o"])
    assert [tuple(r) for r in new.collect()] == [("a", "y", DAY1.date())]
    assert {r["k"]: r["v"] for r in as_of_day(stored.unionByName(new), ["k"], ["v"], dt.date(2023, 6, 1)).collect()} == {"a": "x", "c": "z"}


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    new = spark.createDataFrame([(None, 3), ("b", 4)], "k string, v int")
    once = upsert(old, new, ["k"])
    assert sorted(map(tuple, once.collect()), key=repr) == sorted([("a", 1), (None, 3), ("b", 4)], key=repr)
    assert sorted(map(tuple, upsert(once, new, ["k"]).collect()), key=repr) == sorted(map(tuple, once.collect()), key=repr)
    upsert_table(old, "t_upsert", ["k"])
    upsert_table(new, "t_upsert", ["k"])
    assert spark.table("t_upsert").count() == 3
    spark.sql("drop table t_upsert")


def test_steps(spark):
    p = Package({"a": spark.createDataFrame([("1", "x"), ("2", None)], "id string, v string"), "b": spark.createDataFrame([("1", 5), ("1", 6)], "id string, n int")})
    steps = [
        {"run": "add_metadata", "parameters": {"title": "t"}},
        {"run": "join", "parameters": {"source": {"name": "b", "key": ["id"]}, "target": {"name": "a", "key": ["id"]}, "fields": {"n": {"aggregate": "sum"}}}},
        {"run": "add_computed_field", "parameters": {"fields": [{"target": "label", "operation": "format", "with": "{id}-{v}"}]}},
        {"run": "filter", "parameters": {"resources": "a", "out": [{"n": None}]}},
        {"run": "set_types", "parameters": {"types": {"id": "int"}}},
        {"run": "rename_resource", "parameters": {"source": "a", "target": "out"}},
    ]
    out = spec.run(p, steps)
    assert list(out.resources) == ["out"] and out.meta == {"title": "t"}
    assert [tuple(r) for r in out["out"].collect()] == [(1, "x", 11, "1-x")]
    assert spec.order({"b": {"dependencies": [{"pipeline": "a"}]}, "a": {}}) == ["a", "b"]
    grouped = spec.run(p, [{"run": "join", "parameters": {"source": {"name": "b", "key": ["id"], "delete": False}, "target": {"name": "c", "key": None}, "fields": {"id": None, "n": {"aggregate": "max"}}}}])
    assert list(grouped.resources) == ["a", "b", "c"] and tuple(grouped["c"].first()) == ("1", 6)
    text = "p:\n  pipeline:\n    - run: limit_rows\n      parameters: {stop_after_rows: 1}\n"
    assert spec.run_all(spec.load(text), lambda name: p)["p"]["a"].count() == 1


def test_dump_and_read_back(spark, tmp_path):
    df = spark.createDataFrame([("007", 1, [1, 2]), ("x,\"y\n", None, None)], "k string, n long, xs array<int>")
    writers.dump(Package({"r": df}, {"name": "p"}), str(tmp_path / "out"))
    back = readers.described(spark, str(tmp_path / "out"))
    assert back.meta["name"] == "p"
    assert sorted((r["k"], r["n"]) for r in back["r"].collect()) == [("007", 1), ('x,"y\n', None)]
    assert writers.descriptor(Package({"r": df}))["resources"][0]["schema"]["fields"][2]["type"] == "array"


def test_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('title line\nsomething\nkey,name\n="007",שם\n2,"b,c"\n'.encode("cp1255"))
    assert sorted(map(tuple, readers.messy_csv(spark, str(tmp_path / "a.csv"), ["key", "name"]).collect())) == [("007", "שם"), ("2", "b,c")]
    (tmp_path / "b.json").write_text(json.dumps({"result": {"records": [{"a": 1}, {"a": 2}]}}))
    assert readers.json_rows(spark, str(tmp_path / "b.json"), "result.records", "a int").count() == 2
    assert readers.json_rows(spark, str(tmp_path / "b.json"), "result.records").count() == 2
    (tmp_path / "c.json").write_text('[["x","1"],["y"]]')
    assert sorted(map(tuple, readers.json_pairs(spark, str(tmp_path / "c.json"), ["a", "b"]).collect())) == [("x", "1"), ("y", None)]
    (tmp_path / "d.md").write_text("# t\n## 0020\nbody\nmore\n## 0030\n\n")
    assert [tuple(r) for r in readers.markdown_sections(spark, str(tmp_path / "d.md")).where("code = '0020'").collect()] == [("0020", "body\nmore")]
    html = spark.createDataFrame([("<table><tr><th>h</th></tr><tr><td> a </td><td><b>1</b></td></tr></table>",)], "html string")
    assert [tuple(r) for r in readers.html_table(html, "html", ["x", "y"]).collect()] == [("a", "1")]
    form = spark.createDataFrame([('<span fieldalias="n">A</span><p fieldalias="n">B</p><i fieldalias="m">C</i>',)], "h string")
    assert form.select(readers.form_fields(F.col("h"))).first()[0] == {"n": ["A", "B"], "m": ["C"]}
    letter = spark.createDataFrame([("x\nהנדון: y\nz\nבברכה\nw",)], "t string")
    assert letter.select(readers.letter_body(F.col("t"))).first()[0] == "הנדון: y\nz"
    assert readers.table(spark, "no_such_table") is None


def test_archives(spark, tmp_path):
    import io
    import tarfile
    import zipfile

    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x.txt", "one")
    with tarfile.open(tmp_path / "b.tar.gz", "w:gz") as t:
        info = tarfile.TarInfo("y.txt")
        info.size = 3
        t.addfile(info, io.BytesIO(b"two"))
    got = readers.archive_members(readers.files(spark, str(tmp_path), "*.[zg]*")).collect()
    assert sorted(r["name"] for r in got) == ["x.txt", "y.txt"]


def test_paged_sources(spark):
    data = list(range(25))
    out = paged.paged(spark, lambda r: [{"v": x} for x in data[r["skip"] : r["skip"] + r["limit"]]], "v long", 25, 10)
    assert sorted(r["v"] for r in out.collect()) == data
    ranges = paged.split_ranges(dt.date(2020, 1, 1), dt.date(2020, 1, 31), lambda a, b: (b - a).days * 100, 1000)
    assert ranges[0][0] == dt.date(2020, 1, 1) and ranges[-1][1] == dt.date(2020, 1, 31)
    assert all((b - a).days < 10 for a, b in ranges) and all((y[0] - x[1]).days == 1 for x, y in zip(ranges, ranges[1:]))


def test_documents_and_sitemap(spark):
    df = spark.createDataFrame([(i, f"u?a&{i}", dt.date(2020, 1, 1)) for i in range(25)], "id long, url string, d date")
    out = writers.sitemap(df, "url", "d", ["id"], 10).orderBy("page").collect()
    assert [r["xml"].count("<url>") for r in out] == [10, 10, 5] and "u?a&amp;0</loc><lastmod>2021-01-01" in out[0]["xml"]
    assert writers.sitemap_index(writers.sitemap(df, "url", "d", ["id"], 10), "http://x/").first()["xml"].count("<sitemap>") == 3
    doc = writers.search_documents(spark.createDataFrame([(dt.datetime(2020, 1, 2, 3, 4, 5),)], "t timestamp")).first()[0]
    assert doc == "2020-01-02T03:04:05Z"
    kinds = writers.search_mapping(spark.createDataFrame([], "n decimal(10,2), s string, a array<long>"))["properties"]
    assert (kinds["n"]["type"], kinds["s"]["type"], kinds["a"]["type"]) == ("double", "text", "long")


def test_mapping_of_chunks_and_hebrew_titles(spark):
    df = spark.createDataFrame([], "doc_id string, title string, chunks array<struct<text:string,embeddings:array<float>>>")
    df = df.withMetadata("doc_id", {"es:keyword": True}).withMetadata("title", {"es:title": True})
    got = writers.search_mapping(df)["properties"]
    assert got["doc_id"] == {"type": "keyword"} and got["title"] == {"type": "text", "fields": {"hebrew": {"type": "text", "analyzer": "hebrew"}}}
    assert got["chunks"] == {"type": "nested", "properties": {"embeddings": {"type": "dense_vector", "dims": 1536, "index": True, "similarity": "cosine"}}}


def test_indexer_two_runs(spark):
    doc = indexer.DocType("thing", ["k"], "Title {k}", dates={"mode": "year", "first": "y"}, history=[["v"]], chunk="text")
    df = spark.createDataFrame([("a", 1, 2020, "t" * 3000), ("b", 2, 2021, None)], "k string, v int, y int, text string")
    first = indexer.index(df, doc, None, DAY1)
    pages = {r["doc_id"]: r for r in first.pages.collect()}
    assert set(pages) == {"thing/a", "thing/b"} and len(pages["thing/a"]["chunks"]) == 2 and pages["thing/b"]["__date_range_to"] == "2021-12-31"
    assert first.documents.count() == 4 and first.history[("v",)].count() == 2
    second = indexer.index(df.where("k = 'a'").withColumn("v", F.lit(1)), doc, first.mirror, DAY1 + dt.timedelta(days=1), {("v",): first.history[("v",)]})
    assert second.pages.count() in (0, 1) and second.history[("v",)].count() == 0


def test_stream_keeps_revisions(spark, tmp_path):
    src = tmp_path / "in"
    schema = "k long, v string, o long"
    spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], schema).coalesce(1).write.parquet(str(src / "1"))
    clock = lambda epoch: [DAY1, DAY2][epoch]

    table = versions.VersionedTable(spark, str(tmp_path / "t"), ["k"])

    def run():
        stream = incremental.read_files(spark, str(src) + "/*", schema)
        incremental.keep_revisions(stream, table.path, ["k"], ["o"], clock, str(tmp_path / "cp")).awaitTermination()

    run()
    assert {r["k"]: r["v"] for r in table.read().collect()} == {1: "b", 2: "c"}
    spark.createDataFrame([(2, "d", 2), (3, "e", 1)], schema).coalesce(1).write.parquet(str(src / "2"))
    run()
    rows = {r["k"]: r for r in table.read().collect()}
    assert {k: r["v"] for k, r in rows.items()} == {1: "b", 2: "d", 3: "e"} and rows[2]["__created_at"] == DAY1 and rows[3]["__is_new"]


def batches(spark):
    schema = "k long, v string, o long"
    return [spark.createDataFrame(x, schema) for x in ([(1, "a", 5), (2, "b", 5), (None, "n", 1)], [(1, "late", 4), (2, "c", 6), (3, "d", 1)], [(1, "e", 9), (3, "d", 1)])]


def test_a_batch_that_runs_twice_counts_once(spark, tmp_path, monkeypatch):
    def state(table):
        rows = table.read().collect()
        return sorted(map(tuple, rows), key=repr), sorted(map(tuple, revisions.changed_only(table.read()).collect()), key=repr)

    once, again = (versions.VersionedTable(spark, str(tmp_path / x), ["k"], 2) for x in ("once", "again"))
    commit = versions.VersionedTable._commit

    def broken(self, s):
        raise OSError("the writer dies before the commit")

    for n, df in enumerate(batches(spark)):
        now = DAY1 + dt.timedelta(days=n)
        incremental.apply_batch(df, str(n), once, ["o"], now)
        monkeypatch.setattr(versions.VersionedTable, "_commit", broken)
        with pytest.raises(OSError):
            incremental.apply_batch(df, str(n), again, ["o"], now)
        monkeypatch.setattr(versions.VersionedTable, "_commit", commit)
        assert (again.read() is None) if n == 0 else (again.snapshot().version == n - 1)
        for _ in range(2):  # the second finds its own version
            incremental.apply_batch(df, str(n), again, ["o"], now)
        assert state(again) == state(once)
    got = {r["k"]: r for r in once.read().collect()}
    assert {k: r["v"] for k, r in got.items()} == {1: "e", 2: "c", 3: "d", None: "n"}
    assert got[1]["__created_at"] == DAY1 and got[3]["__next_update_days"] == 3 and once.snapshot().version == 2


def test_keys_expire(spark, tmp_path):
    table = versions.VersionedTable(spark, str(tmp_path / "t"), ["k"])
    for n, days in enumerate((0, 3, 30)):
        incremental.apply_batch(batches(spark)[0], str(n), table, ["o"], DAY1 + dt.timedelta(days=days), expire_days=10)
        assert {r["__is_new"] for r in table.read().collect()} == {n != 1}


def test_versions_keep_columns_and_split_buckets(spark, tmp_path):
    table = versions.VersionedTable(spark, str(tmp_path / "t"), ["k"], 50)
    want = {}
    for n, (lo, hi) in enumerate([(0, 40), (20, 400), (0, 10), (300, 2000)]):
        rows = [(k, f"{n}/{k}") for k in range(lo, hi)]
        df = spark.createDataFrame(rows, "k int, v string") if n != 2 else spark.createDataFrame([(k, k * 0.5) for k, _ in rows], "k int, w double")
        want |= {k: (v, None) for k, v in rows} if n != 2 else {k: (None, k * 0.5) for k, _ in rows}
        s = table.update(df)
        assert {r["k"]: (r["v"], r["w"] if n > 1 else None) for r in table.read().collect()} == want
        assert s.rows == len(want) and max(x for _, x in s.where.values()) < 200 and s.buckets >= s.rows / 50
    assert table.read(0).count() == 40 and table.read(0).columns == ["k", "v"]
    untouched = table.update(spark.createDataFrame([(7, "x")], "k int, v string"))
    assert sum(a != s.where[b] for b, a in untouched.where.items()) == 1
    with pytest.raises(ValueError):
        table.update(spark.createDataFrame([("7", "x")], "k string, v string"))
    empty = versions.VersionedTable(spark, str(tmp_path / "e"), ["k"])
    assert empty.read() is None and empty.update(spark.createDataFrame([], "k int")).rows == 0 and empty.read().count() == 0


@pytest.mark.parametrize("before, after", [(1, 2), (1, 9), (3, 4), (5, 23), (8, 8)])
def test_only_split_buckets_lose_keys(spark, before, after):
    rows = spark.range(3000).select(versions.bucket_of(["id"], before).alias("a"), versions.bucket_of(["id"], after).alias("b")).collect()
    assert {r["b"] for r in rows} == set(range(after))
    moved = {r["a"] for r in rows if r["a"] != r["b"]}
    assert moved == versions.split_from(before, after)


def test_updates_bring_new_columns(spark):
    writers.save_table(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), "t_cols", "update", ["k"], 4)
    writers.save_table(spark.createDataFrame([(2, "c", 5), (3, "d", 6)], "k int, v string, w int"), "t_cols", "update", ["k"])
    assert {(r["k"], r["v"], r["w"]) for r in spark.table("t_cols").collect()} == {(1, "a", None), (2, "c", 5), (3, "d", 6)}
    spark.sql("drop table t_cols")


def test_table_modes(spark):
    df = spark.createDataFrame([(i, f"v{i}") for i in range(40)], "k int, v string")
    writers.save_table(df, "t_modes")
    writers.save_table(df.limit(3), "t_modes", "append")
    assert spark.table("t_modes").count() == 43
    with pytest.raises(ValueError):
        writers.save_table(df, "t_modes", "insert")
    spark.sql("drop table t_modes")


def test_updates_touch_their_buckets_only(spark):
    df = spark.createDataFrame([(i, f"v{i}") for i in range(40)], "k int, v string")
    writers.save_table(df, "t_upd", "update", ["k"], 8)
    before = {r[0] for r in spark.sql("select distinct input_file_name() from t_upd").collect()}
    writers.save_table(spark.createDataFrame([(7, "new"), (100, "more"), (None, "none")], "k int, v string"), "t_upd", "update", ["k"])
    writers.save_table(spark.createDataFrame([(None, "none again")], "k int, v string"), "t_upd", "update", ["k"])
    got = {r["k"]: r["v"] for r in spark.table("t_upd").collect()}
    assert got == {i: f"v{i}" for i in range(40)} | {7: "new", 100: "more", None: "none again"}
    after = {r[0] for r in spark.sql("select distinct input_file_name() from t_upd").collect()}
    assert len(before & after) >= len(before) - 3
    spark.sql("drop table t_upd")


def test_pages_until_one_is_empty(spark):
    rows = [{"id": i} for i in range(47)]
    out = paged.paged_until_empty(spark, lambda r: rows[r["skip"] : r["skip"] + r["limit"]], "id int", 5, 3)
    assert sorted(r["id"] for r in out.collect()) == list(range(47))
    day = dt.date(2020, 1, 5)

    def count(r):
        days = (r["to"] - r["from"]).days + 1
        busy = 3000 if r["from"] <= day <= r["to"] else 0
        return days + (busy if r["from_sum"] is None and r["to_sum"] is None else busy // 2)

    got = paged.split_requests(dt.date(2020, 1, 1), dt.date(2020, 1, 31), count)
    assert [r for r in got if r["from"] == r["to"] == day] == [{"from": day, "to": day, "from_sum": None, "to_sum": 49.93}, {"from": day, "to": day, "from_sum": 49.94, "to_sum": None}]
    assert sum((r["to"] - r["from"]).days + 1 for r in got) == 32  # that day twice


def test_json_schema_is_of_all_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"result": {"rows": [{"a": 1, "b": "x"}]}}))
    (tmp_path / "b.json").write_text(json.dumps({"result": {"rows": [{"a": 2.5, "c": True}, {"b": None}]}}))
    out = readers.json_rows(spark, str(tmp_path), "result.rows")
    assert sorted(out.columns) == ["a", "b", "c"] and out.count() == 3
    assert sorted(((r["a"], r["b"], r["c"]) for r in out.collect()), key=str) == sorted([(1.0, "x", None), (2.5, None, True), (None, None, None)], key=str)


def test_written_output_is_not_made_again(spark, tmp_path):
    df = spark.range(5)
    assert readers.unless_written(df, str(tmp_path / "none")).count() == 5
    (tmp_path / "data").mkdir()
    (tmp_path / "data" / "x.csv").write_bytes(b"a" * 200)
    assert readers.unless_written(df, str(tmp_path / "data"), 100).count() == 0 and readers.unless_written(df, str(tmp_path / "data"), 300).count() == 5


def test_a_query_over_jdbc(spark):
    """An embedded database of one JVM, as here, stands in for a server."""
    url = "jdbc:derby:memory:civicflow;create=true"
    spark.createDataFrame([(i, f"n{i}") for i in range(20)], "id int, name string").write.format("jdbc").option("url", url).option("dbtable", "things").mode("overwrite").save()
    got = readers.jdbc(spark, url, 'select "id", "name" from things where "id" > 16')
    assert sorted(map(tuple, got.collect())) == [(17, "n17"), (18, "n18"), (19, "n19")]
    parts = readers.jdbc(spark, url, "things", partition={"column": '"id"', "lowerBound": 0, "upperBound": 20, "numPartitions": 4})
    assert parts.count() == 20 and parts.rdd.getNumPartitions() == 4
