import datetime as dt

import pytest
from pyspark.sql import functions as F

from civicflow.operators import aggregates, arrays, chains, filters, joins, project, setops, windows
from civicflow.package import Package


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_package_selection(spark):
    a, b = spark.range(1), spark.range(2)
    p = Package({"report_1": a, "report_2": b, "x": a}, {"name": "p"})
    assert p.select("report_[0-9]+") == ["report_1", "report_2"] and p.select(-1) == ["x"] and p.select(None) == ["report_1", "report_2", "x"]
    assert p.select(["x", "report_2"]) == ["report_2", "x"]
    assert list(p.rename("x", "y").drop("report_.*").resources) == ["y"]
    assert list(p.duplicate("x", "z").resources)[-1] == "z" and p["x"] is a
    with pytest.raises(KeyError):
        p["report_.*"]


def test_lookup_join_keeps_rows_and_matches_null_keys(spark):
    target = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, k string")
    source = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), (None, 5, 3), ("z", 9, 4)], "key string, v int, o int")
    fields = {"v": {"aggregate": "sum"}, "vs": {"name": "v", "aggregate": "array"}, "last": {"name": "v", "aggregate": "last"}, "n": {"name": "v", "aggregate": "count"}}
    out = joins.lookup_join(target, source, ["key"], ["k"], fields, order_by=["o"])
    assert rows(out) == [(1, "a", 3, [1, 2], 2, 2), (2, None, 5, [5], 5, 1), (3, "c", None, None, None, None)]
    assert rows(joins.lookup_join(target, source, ["key"], ["k"], {"v": {"aggregate": "sum"}}, full=False, null_safe=False)) == [(1, "a", 3)]
    assert rows(joins.lookup_join(target, source, "{key}/x", "{k}/x", {"v": {"aggregate": "max"}})) == [(1, "a", 2), (2, None, 5), (3, "c", None)]


def test_order_dependent_aggregates_need_an_order(spark):
    with pytest.raises(ValueError):
        aggregates.group(spark.range(3), [], {"id": {"aggregate": "last"}})


def test_aggregates_skip_nulls(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 2, 2), ("a", None, 3), (None, 7, 1)], "k string, v int, o int")
    fields = {"s": {"name": "v", "aggregate": "set"}, "l": {"name": "v", "aggregate": "last"}, "f": {"name": "v", "aggregate": "first"}, "a": {"name": "v", "aggregate": "array"}, "c": {"name": "v", "aggregate": "counters"}, "m": {"name": "v", "aggregate": "upper_median"}}
    out = {r["k"]: r for r in aggregates.group(df, ["k"], fields, ["o"]).collect()}
    assert (out["a"]["s"], out["a"]["l"], out["a"]["f"], out["a"]["a"], out["a"]["m"]) == ([2], 2, 2, [2], 2)
    assert [tuple(x) for x in out["a"]["c"]] == [(2, 1)] and [tuple(x) for x in out[None]["c"]] == [(7, 1)]


def test_counters_order_and_arrays(spark):
    df = spark.createDataFrame([("k", ["x", "y"]), ("k", ["y"]), ("k", ["a"])], "k string, v array<string>")
    assert [tuple(x) for x in aggregates.counters(df, ["k"], "v", "c").first()["c"]] == [("y", 2), ("a", 1), ("x", 1)]


def test_integer_share_truncates(spark):
    df = spark.createDataFrame([(2, 3), (-2, 3), (1, 0)], "a long, b long")
    assert [r[0] for r in df.select(aggregates.integer_share(F.col("a"), F.col("b"))).collect()] == [66, -66, None]


def test_merge_maps_last_wins(spark):
    df = spark.createDataFrame([("k", {"a": "1", "b": "1"}, 1), ("k", {"a": "2"}, 2)], "k string, m map<string,string>, o int")
    assert aggregates.merge_maps(df, ["k"], "m", ["o"]).first()["m"] == {"a": "2", "b": "1"}


def test_filters(spark):
    df = spark.createDataFrame([(1, "a"), (0, "b"), (None, "c")], "v int, k string")
    assert [r["k"] for r in filters.filter_rows(df, out=[{"v": 0}, {"v": None}]).collect()] == ["a"]
    assert filters.filter_rows(df, out=[{"v": 0}, {"v": None}], legacy_any=True).count() == 3
    assert [r["k"] for r in filters.filled(df, "v").collect()] == ["a"]
    assert [r["t"] for r in filters.last_years(df.withColumn("y", F.lit(2020)), "y", "t", dt.date(2022, 6, 1), "v").collect()] == [1, 0, None]
    assert filters.last_years(df, "v", "t", dt.date(2022, 6, 1)).where("t").count() == 0


def test_reject_rows(spark):
    df = spark.createDataFrame([("total", "1"), ("x", "2"), (None, None)], "a string, b string")
    good, bad = filters.reject_rows(df, ["total"], ["a", "b"], least=1)
    assert rows(good) == [("x", "2")] and rows(bad) == [("empty", 1), ("total", 1)]


def test_concatenate(spark):
    a = spark.createDataFrame([(1, "x")], "id int, other string")
    b = spark.createDataFrame([(2, "n")], "key int, name string")
    out = setops.concatenate([a, b], {"id": ["key"], "name": [], "none": None})
    assert rows(out) == [(1, None, None), (2, "n", None)]


def test_set_types_nulls_what_does_not_fit(spark):
    df = spark.createDataFrame([("1,234.5", "31/12/2020", "007", "כן"), ("x", "2020-12-31", "-", "?")], "amount_a string, d string, code string, b string")
    out = project.set_types(df, {"amount.+": {"type": "decimal(38,6)", "group": ","}, "d": {"type": "date", "format": "dd/MM/yyyy"}, "code": {"type": "string", "missing": ["-"], "metadata": {"es:keyword": True}}})
    assert [str(x) if x is not None else None for x in out.first()] == ["1234.500000", "2020-12-31", "007", "כן"]
    assert list(out.collect()[1]) == [None, None, None, "?"]
    assert out.schema["code"].metadata == {"es:keyword": True}


def test_publish_filters_see_rewritten_fields(spark):
    df = spark.createDataFrame([(1, 5), (2, 50)], "a int, b int")
    out = project.publish(df, [{"name": "b", "transform": lambda d: d["b"] * 10}, {"name": "c", "default": F.col("b") + 1, "filter": lambda c: c > 100}])
    assert rows(out) == [(500, 501)]


def test_validate_modes(spark):
    df = spark.createDataFrame([("ab",), ("x",), (None,)], "k string")
    rules = {"k": {"required": True, "minLength": 2}}
    assert project.validate(df, rules, "drop").count() == 1
    assert [r["k"] for r in project.validate(df, rules, "clear").collect()] == ["ab", None, None]
    assert project.validate(df, rules, "ignore") is df
    with pytest.raises(Exception, match="breaks its constraints"):
        project.validate(df, rules).collect()


def test_names_and_keys(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`a\xa0b` int, `code title` int, `title code` int")
    assert project.clean_names(df).columns[0] == "a b"
    assert project.translate_names(df, {"title": "t", "code": "c", "a": "x", "b": ""}).columns[1:] == ["c_t", "t_c"]
    keyed = project.set_primary_key(project.clean_names(df), ["title code", "a b"])
    assert project.primary_key(keyed) == ["title code", "a b"] and project.primary_key(project.set_primary_key(keyed, [])) == []
    assert project.select_fields(df, ["code.*"]).columns == ["code title"] and project.delete_fields(df, "t.*").columns == ["a\xa0b", "code title"]


def test_unwind(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "id int, xs array<string>")
    assert rows(arrays.unwind(df, "xs", "x")) == [(1, "a"), (1, "b")]
    assert rows(arrays.unwind(df, "xs", "x", keep_empty=True)) == [(1, "a"), (1, "b"), (2, None), (3, None)]


def test_unwind_parallel_fills_short_arrays(spark):
    df = spark.createDataFrame([(1, {"a": ["x", "y"], "b": ["z"]}), (2, {})], "id int, t map<string,array<string>>")
    assert rows(arrays.unwind_parallel(df, "t", ["a", "b"])) == [(1, "x", "z"), (1, "y", "")]


def test_unwind_struct_and_levels(spark):
    df = spark.createDataFrame([(1, [("00", "all"), ("0020", "office")])], "id int, h array<struct<code:string,title:string>>")
    assert rows(arrays.unwind_struct(df, "h")) == [(1, "00", "all"), (1, "0020", "office")]
    assert tuple(arrays.level_columns(df, "h", [2, 4]).drop("h").first()) == (1, "00", "all", "0020", "office")


def test_compact_entity(spark):
    df = spark.createDataFrame([(5, "n", "x", None), (6, "", "y", "z"), (None, "m", "", "")], "num int, nm string, reg_a string, reg_b string")
    out = arrays.compact_entity(df, "company", "חברה", "num", "nm", "reg_").collect()
    assert [(r["id"], r["name"], r["details"]) for r in out] == [("5", "n", {"a": "x"})]


def test_tree_paths(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 1, "b"), (3, 2, "c"), (4, None, "d")], "id int, up int, t string")
    assert rows(arrays.tree_paths(df, "id", "up", "t")) == [(1, ["a"]), (2, ["a", "b"]), (3, ["a", "b", "c"]), (4, ["d"])]
    deep = spark.createDataFrame([(i, i - 1 if i else None, str(i)) for i in range(12)] + [(50, 51, "x"), (51, 50, "y")], "id int, up int, t string")
    assert {r["id"]: len(r["path"]) for r in arrays.tree_paths(deep, "id", "up", "t").collect()} == {i: i + 1 for i in range(12)}


def test_long_paths_take_few_rounds(spark, monkeypatch):
    import random

    calls = []
    monkeypatch.setattr(arrays, "cut", lambda df, real=arrays.cut: calls.append(1) or real(df))
    order = list(range(3000))
    random.Random(1).shuffle(order)
    df = spark.createDataFrame([(i, i - 1 if i else None, str(i)) for i in order], "id long, up long, t string")
    got = arrays.tree_paths(df, "id", "up", "t").selectExpr("id", "size(path) as n", "path[0] as a", "path[size(path) - 1] as b").collect()
    assert {(r["id"], r["n"], r["a"], r["b"]) for r in got} == {(i, i + 1, "0", str(i)) for i in range(3000)}
    assert len(calls) < 60


def test_circles_are_told(spark):
    edges = [(1, None), (2, 1), (3, 4), (4, 5), (5, 3), (6, 5), (7, 6), (8, 99), (9, 9)]
    df = spark.createDataFrame([(i, u, "t") for i, u in edges], "id int, up int, t string")
    assert {r["id"] for r in arrays.unrooted(df, "id", "up").collect()} == {3, 4, 5, 6, 7, 8, 9}
    assert {r["id"] for r in arrays.tree_paths(df, "id", "up", "t").collect()} == {1, 2}


def test_ties_are_spread_and_numbered(spark):
    df = spark.createDataFrame([("same", i) for i in range(1000)], "k string, i int").repartition(3)
    spread = windows.in_ranges(df, ["k"], 50)
    sizes = [r["count"] for r in spread.groupBy("__part").count().collect()]
    assert len(sizes) >= 15 and max(sizes) < 150
    assert sorted(r["index"] for r in windows.numbered(df, ["k"], rows=50).collect()) == list(range(1000))
    filled = windows.fill_forward_all(spark.createDataFrame([(1, i if i < 5 else None) for i in range(300)], "o int, v int").coalesce(1), ["v"], ["o"], rows=20)
    assert sorted(r["v"] for r in filled.collect()) == [0, 1, 2, 3] + [4] * 296


def test_the_input_of_ranges_runs_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(parts):
        for p in parts:
            seen.add(len(p))
            yield p

    df = spark.range(500).mapInPandas(count, "id long")
    assert windows.numbered(df, ["id"], rows=100).count() == 500 and seen.value == 500


def test_windows_do_not_depend_on_partitioning(spark):
    df = spark.createDataFrame([(i, i if i % 7 == 0 else None) for i in range(1, 200)], "i int, v int")
    want = [(i, i - i % 7 if i >= 7 else None) for i in range(1, 200)]
    for n in (1, 5):
        assert sorted(map(tuple, windows.fill_forward_all(df.repartition(n), ["v"], ["i"], rows=35).collect())) == want


def test_lookup_array_keeps_order_and_drops_misses(spark):
    df = spark.createDataFrame([(1, ["b", "z", "a", "b"]), (2, []), (3, None)], "id int, codes array<string>")
    t = spark.createDataFrame([("a", "A"), ("b", "B")], "k string, v string")
    assert rows(joins.lookup_array(df, "codes", t, "k", "v", "titles", ["id"]).select("id", "titles")) == [(1, ["B", "A", "B"]), (2, []), (3, [])]


def test_resolve_prefers_the_id(spark):
    known = spark.createDataFrame([("1", "one", "c", "fp1"), ("2", "two", "c", "fp2"), ("3", "three", "c", "fp2")], "id string, name string, kind string, fingerprint string")
    df = spark.createDataFrame([("1", "fp2"), (None, "fp2"), ("9", "fp1"), ("9", "none")], "i string, fp string")
    assert [r["entity_id"] for r in joins.resolve(df, known, "i", "fp").orderBy("i", "fp").collect()] == ["2", "1", "1", None]


def test_absent_from(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert rows(joins.absent_from(df, spark.createDataFrame([(1,), (1,)], "x int"), ["k"], ["x"])) == [(2,), (None,)]
    assert joins.absent_from(df, None, ["k"]).count() == 3
    fixes = spark.createDataFrame([(1, None), (2, 1), (3, None)], "id int, fix int")
    assert rows(joins.superseded(fixes, "id", "fix")) == [(2, 1), (3, None)]


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    df = spark.createDataFrame(chain + star + [(5, 5), (7, None)], "a long, b long")
    got = {r["node"]: r["root"] for r in chains.components(df).collect()}
    assert got == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(50)}
    assert chains.components(df.limit(0)).count() == 0


def test_components_with_heavy_nodes(spark, monkeypatch):
    monkeypatch.setattr(chains, "HEAVY_ROWS", 5)
    edges = [(0, i) for i in range(1, 80)] + [(i, 1000 + i) for i in range(1, 40)] + [(5000 + i, 5001 + i) for i in range(30)]
    got = {r["node"]: r["root"] for r in chains.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(80)} | {1000 + i: 0 for i in range(1, 40)} | {5000 + i: 5000 for i in range(31)}


def test_lookup_of_heavy_keys(spark, monkeypatch):
    monkeypatch.setattr(chains, "HEAVY_ROWS", 3)
    df = spark.createDataFrame([(i % 4 if i < 40 else None, i) for i in range(50)] + [(9, 99), (7, 77)], "k int, v int")
    table = spark.createDataFrame([(0, "a", 10), (1, "b", 10), (9, "c", 1)], "k int, t string, n int")
    assert rows(chains.looked_up(df, table, "k", "n", 52)) == rows(df.join(table.drop("n"), "k"))
    assert rows(chains.looked_up(df, table, "k", "n", 52, "left")) == rows(df.join(table.drop("n"), "k", "left"))


def test_ranges_by_rows(spark):
    df = spark.createDataFrame([(i * 37 % 101, i) for i in range(101)], "k int, v int")
    got = windows.numbered(df, ["k"], rows=20).collect()
    assert {r["k"]: r["index"] for r in got} == {k: k for k in range(101)}


def test_tapped_rows_are_counted(spark):
    df, seen = project.tapped(spark.range(7), "seven", most=F.max("id"))
    assert df.count() == 7 and seen.get == {"n": 7, "most": 6}
    df, seen = project.long_ids(spark.createDataFrame([("x" * 401,), ("y",)], "doc_id string"), "doc_id")
    df.count()
    assert seen.get["too_long"] == 1 and seen.get["example"] == "x" * 401
