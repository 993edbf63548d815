import datetime as dt

from pyspark.sql import functions as F

from civicflow.functions.geo import LAT0, LON0, X0, Y0, grid_to_degrees
from civicflow.plans import activities, charts
from civicflow.sources import sheets


def test_grid_origin_and_distances(spark):
    df = spark.createDataFrame([(X0, Y0), (X0 + 1000.0, Y0), (X0, Y0 + 1000.0), (178000.0, 665000.0)], "x double, y double")
    (lat, lon), (_, lon_e), (lat_n, _), (ta_lat, ta_lon) = [tuple(r) for r in df.select(*grid_to_degrees(F.col("x"), F.col("y"))).collect()]
    assert abs(lat - LAT0) < 0.002 and abs(lon - LON0) < 0.002  # the datums are some hundred metres apart
    assert abs((lat_n - lat) * 110_880 - 1000) < 5 and abs((lon_e - lon) * 94_690 - 1000) < 15
    assert abs(ta_lat - 32.077) < 0.01 and abs(ta_lon - 34.766) < 0.01  # Tel Aviv


def test_sheet_headers_and_records(spark):
    lines = [("r1", 1, 1, ["title", None]), ("r1", 1, 2, [" order ", "code", "volume\xa0x", "a", "b"]), ("r1", 1, 3, ["7", "20", "5", "", None]), ("r1", 2, 1, ["x", "y"]), ("r2", 1, 1, ["order", "code", "q", "a", "b"])]
    df = spark.createDataFrame(lines, "report string, sheet int, n int, cells array<string>")
    found = sheets.headers(df, {"order": ["order"], "volume": ["volume x"]})
    got = {(r["report"], r["sheet"]): (r["header_line"], r["error"]) for r in found.collect()}
    assert got == {("r1", 1): (2, None), ("r1", 2): (None, "no header line"), ("r2", 1): (1, "no volume column")}
    rows = sheets.records(df, found, {"order_id": ["order"], "amount": ["volume", "volume x"], "a": []})
    assert [tuple(r)[2:] for r in rows.collect()] == [(3, "7", "5", None)]
    assert {r["report"]: (r["sheets"], r["rows"], r["load_error"]) for r in sheets.load_results(found, rows).collect()} == {"r1": (1, 1, "no header line"), "r2": (0, 0, "no volume column")}


def test_service_budgets_and_suppliers(spark):
    money = "array<struct<year:int,approved:double,executed:double>>"
    who = "array<struct<entity_id:string,entity_name:string,entity_kind:string,year_activity_start:int,year_activity_end:int,geo:array<string>>>"
    rows = [
        ("a", [(2023, 100.0, 80.0), (2024, 200.0, 50.0)], [("1", "<em>x</em>", "company", 2022, None, ["ארצי"]), ("2", "y", "association", None, 2021, None), ("1", "x", "company", 2024, None, None)]),
        ("b", [(2021, 10.0, None)], [("3", "z", "other", 2021, None, None)]),
        ("c", [], None),
    ]
    df = activities.suppliers(activities.budgets(spark.createDataFrame(rows, f"id string, manualBudget {money}, suppliers {who}"), 2024), 2024)
    out = {r["id"]: r for r in df.collect()}
    a = out["a"]
    assert (a["current_budget"], a["budget_utilization"], a["min_activity_year"], a["max_activity_year"], a["score"]) == (200.0, 25.0, 2023, 2024, 0.2)
    assert (a["supplier_count"], a["supplier_kinds"], a["geo_coverage"], a["supplier_count_category"]) == (1, activities.BUSINESS, activities.NATIONAL, "2-5")
    assert [s["activity_years"] for s in a["suppliers"]] == [[2023, 2024], [2024]] and a["suppliers"][0]["entity_name"] == "x"
    b = out["b"]
    assert not b["currently_active"] and b["suppliers"][0]["year_activity_end"] == 2021 and b["supplier_kinds"] == activities.OTHER
    assert (out["c"]["supplier_count"], out["c"]["supplier_count_category"], out["c"]["score"]) == (0, None, 1000)


def test_service_tenders(spark):
    rows = [("regular", None, "office", None, "2020-02-29", "2", None), (None, "פטור לפי ספק יחיד", "exemptions", "01/01/2020 to the 2024-06-30", None, None, None), (None, None, "exemptions", None, "2030-01-01", None, None)]
    df = spark.createDataFrame(rows, "sub_kind string, regulation string, tender_type string, date_range string, end_date string, option_duration string, active string")
    out = [(r["sub_kind_he"], r["end_date"], r["end_date_extended"], r["active"]) for r in activities.tenders(df, F.lit(dt.date(2025, 1, 1))).collect()]
    assert out == [("מכרז רגיל", "2020-02-29", "2022-02-28", None), ("ספק יחיד", "2024-06-30", None, "no"), ("אחר", "2030-01-01", None, "yes")]


def test_mapped_budget_and_spending(spark):
    mappings = spark.createDataFrame([("d", "0020", 2020, 50)], "doc_id string, code string, year int, part int")
    raw = spark.createDataFrame([("0020", 2020, "t", 10, 10, 4), ("0020", 2021, "t", 20, 20, None), ("0020", 2022, "other", 9, 9, 9), ("0020", 2019, "t", 9, 0, 9)], "code string, year int, title string, net_allocated int, net_revised int, net_executed int")
    assert {r["year"]: (r["net_revised"], r["net_executed"]) for r in activities.mapped_budget(mappings, raw).collect()} == {2020: (5.0, 2.0), 2021: (10.0, 0.0)}
    contracts = spark.createDataFrame([("0020", "e1", "s1", 5.0, 2.0, 2019, 2021, ['["1","office","x"]']), ("0020", "e1", "s2", 6.0, 1.0, 2020, 2022, None), ("0030", "e2", "s3", 9.0, 9.0, 2020, 2020, None)], "budget_code string, entity_item_id string, supplier string, volume double, executed double, min_year int, max_year int, tender_key array<string>")
    spending = activities.spending_of(mappings, contracts)
    s = activities.spending_suppliers(spending).collect()
    assert [(r["supplier"], r["volume"], r["years"], r["rank"]) for r in s] == [("s2", 11.0, "2019-2022", 1)]
    tenders = spark.createDataFrame([(1, "office", "x", "T")], "publication_id int, tender_type string, tender_id string, title string")
    assert [(r["title"], r["svc_volume"]) for r in activities.spending_tenders(spending, tenders).collect()] == [("T", 5.0)]


def test_questionnaire_and_beneficiaries(spark):
    df = spark.createDataFrame([(5.0, 2.0, ["x"], [(2030, 9), (2020, 7)]), (None, 5.0, [], None)], "q1 double, q2 double, skip array<string>, beneficiaries array<struct<year:int,num_beneficiaries:int>>")
    out = activities.beneficiaries(activities.questionnaire(df, {"p": [("q1", 0.8, 5.0, None), ("q2", 1.2, 5.0, "skip")]}), 2024).collect()
    assert [r["p"] for r in out] == [1.0, 0.6] and [r["current_beneficiaries"] for r in out] == [7, None]


def test_charts(spark):
    df = spark.createDataFrame([("k", [("a", 5.0), ("b", 7.0), ("c", 1.0), ("d", 0.0)], {2020: (1.0,), 2019: (2.0,)})], "k string, kids array<struct<t:string,v:double>>, h map<int,struct<net:double>>")
    flow = df.select(charts.flow_groups(F.col("kids"), "v", "t", 2, "rest")).first()[0]
    assert [tuple(x) for x in flow] == [("b", 7.0), ("a", 5.0), ("rest", 1.0)]
    trace = df.select(charts.traces(F.col("h"), {"net": "Net"})).first()[0][0]
    assert (trace["x"], trace["y"], trace["name"]) == (["2019", "2020"], [2.0, 1.0], "Net")
    made = df.select(charts.table(F.col("kids"), ["T", "V"], [lambda r: r["t"], lambda r: r["v"]])).first()[0]
    assert made["headers"] == ["T", "V"] and made["data"][0] == ["a", "5.0"]
    values = spark.createDataFrame([("a", 1.0, "g"), ("b", 3.0, "g")], "k string, v double, g string")
    assert {r["k"]: tuple(r["comparison"]) for r in charts.comparison(values, "k", "v", ["g"]).collect()} == {"a": (1.0, 2.0, 2, 2), "b": (3.0, 2.0, 1, 2)}
