import datetime as dt

from pyspark.sql import functions as F

from civicflow.plans import indexer, lookups, spec
from civicflow.sources import portal
from civicflow.state.cache import ask


def test_latest_titles(spark):
    df = spark.createDataFrame([("0020010101", 2019, "old", 5), ("0020010101", 2020, "new", 7), ("0020010101", 2021, "gone", 0), ("0020", 2021, "office", 9)], "code string, year int, title string, net_revised int")
    assert [tuple(r) for r in lookups.latest_titles(df).collect()] == [("0020010101", 2020, "new")]


def test_payments_are_a_distinct_union(spark):
    s = spark.createDataFrame([(2020, "m", 5.0, "1"), (2020, "m", 5.0, "1"), (2010, "m", 5.0, "1")], "year_paid int, supporting_ministry string, amount_paid double, entity_id string")
    c = spark.createDataFrame([(2020, "m", 5.0, "1"), (2020, "p", 1.0, "1"), (2020, "p", 1.0, "9")], "min_year int, publisher_name string, executed double, entity_id string")
    orgs = spark.createDataFrame([("1",)], "id string")
    paid = lookups.recent_payments(lookups.payments(s, c), orgs, dt.date(2022, 1, 1))
    assert {r["payer"]: r["amount"] for r in lookups.payer_totals(paid).collect()} == {"m": 5.0, "p": 1.0}


def test_district_report(spark):
    rows = [("sport", ["n"], True)] * 10 + [("art", ["n"], True)] + [("art", ["s"], True)] * 5 + [("art", ["s"], False)]
    df = spark.createDataFrame(rows, "association_field_of_activity string, association_activity_region_districts array<string>, association_status_active boolean")
    out = {r["district"]: (r["totals"], r["foas"][0]) for r in lookups.district_report(df, 2).collect()}
    assert out == {"n": (11, "sport"), "s": (5, "art")}
    assert lookups.distinct_members(df, "association_activity_region_districts").first()["x"] == 2


def test_procurement_totals(spark):
    t = spark.createDataFrame([("office", "p", dt.date(2020, 1, 1), None, None), ("office", "p", None, dt.date(2020, 5, 1), None), ("central", "q", None, None, dt.date(2019, 1, 1))], "tender_type string, publisher string, claim_date date, start_date date, last_update_date date")
    assert [tuple(r) for r in lookups.tender_counts(t, 2020).collect()] == [("office", 2, 1)]
    c = spark.createDataFrame([(5.0, dt.date(2020, 1, 1)), (7.0, dt.date(2019, 1, 1))], "volume double, order_date date")
    assert lookups.spending_of_year(c, 2020).first()["x"] == 5.0


def test_municipalities(spark):
    rows = [("old", 2018, "sym", "70"), ("new", 2020, "sym", "70"), ("new", 2019, "pop", "5"), ("new", 2020, "pop", "6.5"), ("other", 2020, "pop", "9"), ("stale", 2019, "pop", "1")]
    df = spark.createDataFrame(rows, "name string, year int, header string, value string")
    names = lookups.municipality_names(df, spark.createDataFrame([("70",)], "symbol string"), "sym").first()
    assert (names["names"], names["latest_year"]) == (["old", "new"], 2020)
    assert {r["header"]: r["value"] for r in lookups.latest_values(df, ["old", "new"]).collect()} == {"sym": "70", "pop": "6.5"}
    assert {r["name"]: r["number"] for r in lookups.comparison(df, "pop").collect()} == {"new": 6.5, "other": 9.0}


def test_subscriptions(spark):
    items = spark.createDataFrame([("t1", "u", "p", 1), ("t2", "u", "p", 1), ("t3", "u", "p", 2)], "title string, url string, properties string, list_id int")
    lists = spark.createDataFrame([(1, 10, "searches"), (2, 11, "searches"), (3, 10, "other")], "id int, user_id int, name string")
    users = spark.createDataFrame([(10, "a@x"), (11, "b@x")], "id int, email string")
    log = spark.createDataFrame([("b@x", dt.datetime(2024, 1, 9)), ("b@x", dt.datetime(2023, 1, 1))], "email string, send_time timestamp")
    out = {r["email"]: [i["title"] for i in r["items"]] for r in lookups.due_subscriptions(items, lists, users, log, dt.datetime(2024, 1, 10)).collect()}
    assert out == {"a@x": ["t1", "t2"]}


def test_other_lookups(spark):
    b = spark.createDataFrame([("0020010101", 2020, ['["1","f1","2","f2"]'], 5), ("0020010102", 2020, ['["1","f1","2","f2"]'], 6), ("0000010101", 2020, ['["1","f1","2","f2"]'], 9)], "code string, year int, func_cls_json array<string>, net_revised int")
    assert [tuple(r) for r in lookups.offices_by_function(b, 2020).collect()] == [("0020", "f1", 11)]
    assert lookups.budget_items(b, ["002001", "0099"], 2019, 2020).count() == 2
    spending = spark.createDataFrame([("1", 5.0), ("1", 2.0), ("2", 9.0)], "entity_id string, amount double")
    orgs = spark.createDataFrame([("1", "a", "f"), ("2", "b", "f")], "id string, name string, foa string")
    assert [(r["id"], r["rank"]) for r in lookups.income_list(spending, orgs, "foa").orderBy("rank").collect()] == [("2", 1), ("1", 2)]
    t = spark.createDataFrame([("x", None), ("y", "z")], "a string, b string")
    table = spark.createDataFrame([("x", None, "open")], "a string, b string, simple_decision string")
    assert [r["simple_decision"] for r in lookups.simple_decision(t, table, ["a", "b"], F.lit("unknown")).orderBy("a").collect()] == ["open", "unknown"]
    services = spark.createDataFrame([("o", [(2020, 5.0)]), ("o", [(2020, 6.0), (2021, 1.0)])], "office string, manualBudget array<struct<year:int,approved:double>>")
    assert sorted(map(tuple, lookups.service_totals(services, {"approved": "approved"}).collect())) == [("o", 2020, 2, 11.0), ("o", 2021, 1, 1.0)]


def test_answers_are_asked_once(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,), ("none",)], "t string")
    first = ask(df, "t", None, lambda qs: [None if x == "none" else {"n": len(x), "s": x.upper()} for x in qs], "n long, s string")
    assert sorted(r["s"] for r in first.collect()) == ["A", "B"]

    def refuse(qs):
        assert set(qs) <= {"c", "none"}, qs
        return [None if x == "none" else {"n": 9, "s": "C"} for x in qs]

    cached = spark.createDataFrame(first.collect(), first.schema)
    again = ask(df.union(spark.createDataFrame([("c",)], "t string")), "t", cached, refuse, "n long, s string")
    assert sorted(r["s"] for r in again.collect()) == ["A", "B", "C"]
    assert ask(df, "t", cached, refuse, "n long, s string", most=0).count() == 2


def test_portal(spark):
    rows = [("d", "1", "a", "u1", "CSV", "2020"), ("d", "2", "b", "u2", "XLSX", "2021"), ("e", "3", "a", "u3", "csv", "2022")]
    df = spark.createDataFrame(rows, "dataset string, resource_id string, name string, url string, format string, last_modified string")
    assert tuple(portal.resolve(df, "d", name="a").first()) == ("u1", "csv", False)
    assert tuple(portal.resolve(df, "d").first()) == ("u2", "xlsx", True) and portal.resolve(df, "d", ident="3").count() == 0
    text = spark.createDataFrame([('a,"b\n  c",d\n\ne,f  g\r\n',)], "t string")
    assert text.select(portal.mended_lines(F.col("t"))).first()[0] == ['a,"b c",d', "e,f g"]


def test_generated_pipelines():
    types = [indexer.DocType("a", ["k"], "t"), indexer.DocType("b", ["k"], "t")]
    made = indexer.pipelines(types, "/data", {"a": "upstream"}, limit=5)
    assert spec.order(made)[-1] == "sitemaps" and made["index_a"]["dependencies"] == [{"pipeline": "upstream"}]
    assert [s["run"] for s in made["index_b"]["pipeline"]] == ["load", "limit_rows", "index", "dump_to_path"]
