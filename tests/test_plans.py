import datetime as dt
import itertools
import random
from decimal import Decimal

from pyspark.sql import functions as F

from civicflow.operators.chains import label_chains
from civicflow.plans import budget, changes, clusters, contracts, entities, facilities, reports, supports
from civicflow.udfs.fuzzy import partial_ratio

from plain import cluster_name

RAW = "year int, phase string, admin_cls_code_0 string, admin_cls_code_2 string, admin_cls_title_2 string, admin_cls_code_4 string, admin_cls_title_4 string, admin_cls_code_6 string, admin_cls_title_6 string, admin_cls_code_8 string, admin_cls_title_8 string, func_cls_code_1 string, func_cls_title_1 string, func_cls_code_2 string, func_cls_title_2 string, econ_cls_code_2 string, net decimal(38,6)"


def line(year, phase, code, net, econ="1"):
    c = [code[:2], code[:4], code[:6], code[:8]]
    return (year, phase, "1", c[0], "t2", c[1], "t4", c[2], "t6", c[3], "t8", "3", "f", "4", "g", econ, Decimal(net))


def test_hierarchy_sums_agree_by_level(spark):
    raw = spark.createDataFrame([line(2020, "מקורי", "20670142", 100), line(2020, "מקורי", "20670143", 50), line(2020, "ביצוע", "20670142", 70), line(2020, "מקורי", "00010101", 500), line(2020, "מקורי", "85010101", 9)], RAW)
    out = {r["code"]: r for r in budget.rolled_up(budget.hierarchy_rows(raw, ["net"], 2023), ["net"]).collect()}
    assert out["0020"]["net_allocated"] == out["002067"]["net_allocated"] == out["00206701"]["net_allocated"] == 150
    assert out["0020670142"]["net_executed"] == 70 and out["0020670142"]["depth"] == 4
    assert [h["code"] for h in out["0020670142"]["hierarchy"]] == ["00", "0020", "002067", "00206701"] and out["0020670142"]["parent"] == "00206701"
    assert out["00"]["net_allocated"] == 150 and out["00"]["depth"] == 0  # neither income nor loans
    assert out["C3"]["net_allocated"] == 650 and out["C304"]["title"] == "f / g" and out["C304"]["depth"] == -1
    assert "0085" in out and out["0000"]["hierarchy"] == []


def test_open_years_count_as_revised(spark):
    raw = spark.createDataFrame([line(2024, "מקורי", "20670142", 100)], RAW)
    out = {r["code"]: r for r in budget.rolled_up(budget.hierarchy_rows(raw, ["net"], 2023, {"net": 1000}), ["net"]).collect()}
    assert out["0020"]["net_allocated"] == out["0020"]["net_revised"] == 100_000


def test_fixes_apply_once(spark):
    raw = spark.createDataFrame([line(2020, "מאושר", "20670142", 100), line(2020, "מאושר", "20670143", 50)], RAW)
    fixes = spark.createDataFrame([(2020, "00206701", Decimal(7))], "year int, code string, net decimal(38,6)")
    out = {r["code"]: r for r in budget.rolled_up(budget.hierarchy_rows(raw, ["net"], 2023, fixes=fixes, order_by=["admin_cls_code_8"]), ["net"]).collect()}
    assert out["0020"]["net_revised"] == 157 and out["0020670142"]["net_revised"] == 100


def test_children_and_revised(spark):
    rows = spark.createDataFrame([(2020, "00", "s", None, 5, None), (2020, "0020", "b", "00", 3, 4), (2020, "0010", "a", "00", 2, None)], "year int, code string, title string, parent string, net_allocated int, net_revised int")
    kids = budget.with_children(rows).where("code = '00'").first()["children"]
    assert [tuple(k) for k in kids] == [("0010", "a", 2, 2), ("0020", "b", 3, 4)]
    assert {r["code"]: r["net_revised"] for r in budget.fill_revised(rows, ["net"]).collect()} == {"00": 5, "0020": 4, "0010": 2}


def test_connected_years(spark):
    rows = [(2020, "a", "schools", None, 1), (2021, "a", "schools north", None, 1), (2021, "b", "roads", None, 1), (2022, "a", "something else", None, 1), (2022, "c", "new home of roads", None, 1), (2022, "d", "x", None, 0)]
    df = spark.createDataFrame(rows, "year int, code string, title string, parent string, net_allocated int")
    curated = spark.createDataFrame([(2022, "c", "b")], "year int, code string, prev_code string")
    out = {(r["year"], r["code"]): r["chain_id"] for r in budget.connect_years(df, curated, ["net_allocated"]).collect()}
    assert out == {(2020, "a"): "2020/a", (2021, "a"): "2020/a", (2021, "b"): "2021/b", (2022, "a"): "2022/a", (2022, "c"): "2021/b", (2022, "d"): "2022/d"}
    history = budget.chain_history(df, budget.connect_years(df, curated, ["net_allocated"]), ["net_allocated"]).where("chain_id = '2020/a'").first()["history"]
    assert set(history) == {2020, 2021}


def test_change_groups_balance(spark):
    rows = [("t1", "d", 1, 5), ("t2", "d", 2, -5), ("t3", "d", 3, 4), ("t4", "d", 4, 3), ("t5", "d", 5, -7), ("t6", "d", 6, 1), ("t7", "e", 7, -1)]
    reserve = [(t, k, i, v, "0047010101") for t, k, i, v in rows]
    own = [(t, k, i, -v, "0020010101") for t, k, i, v in rows] + [("t8", "d", 8, 2, "0030010101"), ("t9", "d", 47, 2, "0047")]
    df = spark.createDataFrame(reserve + own, "trcode string, date_kind string, leading_item int, net int, budget_code string")
    out = {r["trcode"]: (r["group_id"], r["size"]) for r in changes.change_groups(df, ["net"]).collect()}
    assert out["t1"] == out["t2"] and out["t1"][1] == 2
    assert out["t3"] == out["t4"] == out["t5"] and out["t3"][1] == 3
    assert out["t6"] == ("t6", 1) and out["t7"] == ("t7", 1) and out["t8"] == ("t8", 1) and "t9" not in out


def test_code_rows_and_summaries(spark):
    df = spark.createDataFrame([("t", 2020, "0020010101", 5, 0, 0, 0), ("t", 2020, "0030010101", -5, 0, 0, 0), ("t", 2020, "0040010101", 0, 0, 0, 0)], "transaction_id string, year int, budget_code string, net_expense_diff int, gross_expense_diff int, allocated_income_diff int, commitment_limit_diff int")
    assert changes.code_rows(df).count() == 12
    titles = spark.createDataFrame([(2020, "0020", "office")], "year int, code string, title string")
    row = changes.summaries(df, titles).first()
    assert [x["code"] for x in row["from"]] == ["0030", "0040"] and [(x["code"], x["title"]) for x in row["to"]] == [("0020", "office"), ("0040", "0040")]


def test_spending_clusters(spark):
    rows = [("k", "road works north", 10.0), ("k", "road works south", 5.0), ("k", "school", 1.0), ("k", "road works north", 2.0), ("k", None, 9.0)]
    rows += [("k", w, v) for w, v in (("zebra", 0.5), ("quilt", 0.4), ("xylo", 0.3))]
    out = clusters.spending_clusters(spark.createDataFrame(rows, "p string, title string, amount double"), ["p"], most=3).collect()
    assert sum(r["amount"] for r in out) == 19.2 and sum(r["count"] for r in out) == 7 and len(out) == 4
    titles = ["repair of roads", "repair of roads in town", "other", "ab", "zz ab", "", "q"]
    named = {r["t"]: r["tag"] for r in clusters.similar_titles(spark.createDataFrame([("k", t) for t in titles], "k string, t string")).collect()}
    assert named["repair of roads"] == named["repair of roads in town"] == "repair of roads" and named["other"] == "other"
    assert named["ab"] == named["zz ab"] and named[""] == "" and named["q"] == "q"


def test_similar_titles_against_all_pairs(spark):
    rng = random.Random(11)
    letters = "abcde "
    titles = sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(1, 16))) for _ in range(90)} | {"".join(c if rng.random() > 0.05 else "x" for c in "works on the long road to the sea") for _ in range(20)})
    root = list(range(len(titles)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(titles):
        for j in range(i):
            if partial_ratio(a, titles[j]) >= 90:
                root[max(find(i), find(j))] = min(find(i), find(j))
    own = {}
    for i, t in enumerate(titles):
        own.setdefault(find(i), []).append(t)
    want = {t: cluster_name(x) if len(x) > 1 else t for x in own.values() for t in x}
    got = {r["t"]: r["tag"] for r in clusters.similar_titles(spark.createDataFrame([("k", t) for t in titles], "k string, t string")).collect()}
    assert got == want


def test_long_chains_of_programs_are_one(spark):
    pairs = [(i, i + d) for i in range(200) for d in (0, 1)]
    df = spark.createDataFrame(pairs + [(900, 901), (None, 3)], "a long, b long")
    got = label_chains(df, "a", "b").collect()
    assert len(got) == 401 and len({r["chain"] for r in got}) == 2


def test_program_keys_follow_codes_and_titles(spark):
    rows = [("0020010101", "תמיכה בספורט", 2019, 5), ("0020010101", "תמיכה בספורט נוער", 2020, 5), ("0020010199", "תמיכה בספורט נוער", 2021, 5), ("0030010101", "אחר", 2020, 5), ("0030010101", "אחר", 2020, 0)]
    df = spark.createDataFrame(rows, "budget_code string, support_title string, year_requested int, amount_approved int")
    out = [(r["year_requested"], r["program_key"]) for r in clusters.program_keys(df).collect()]
    keys = {y: k for y, k in out if k and k.startswith("0020")}
    assert len(set(keys.values())) == 1 and set(keys) == {2019, 2020, 2021}
    assert sum(k is not None and k.startswith("0030") for _, k in out) == 2


def plain_programs(rows):
    """Name of each (code, short, year), by going through them in order and comparing with all that were named."""
    titles = {}
    for code, title, year in rows:
        key = (year, code, title[:15])
        titles[key] = min(title, titles.get(key, title))
    named, out = [], {}
    for (year, code, short), title in sorted(titles.items()):
        best = None
        for o_year, o_code, o_short, program in named:
            points = (o_code == code) + (o_short == short)
            if o_year < year and points:
                best = min(best or (9,), (-points, program))
        if best is None:
            mates = sorted(m for m in titles if m[0] == year and m[2] == short and titles[m] == title and m[1][:4] == code[:4])
            program = out.get(mates[0]) or (year, f"{code}_{short}")
        else:
            program = best[1]
        named.append((year, code, short, program))
        out[year, code, short] = program
    return {(code, short, year): name for (year, code, short), (_, name) in out.items()}


def test_program_keys_against_plain_rounds(spark):
    rng = random.Random(4)
    for _ in range(3):
        rows = sorted({("00" + rng.choice("12") + "0" + rng.choice("123456"), "".join(rng.choice("אבג") for _ in range(2)) + rng.choice(["", "דדדדדדדדדדדדדדדד", "דדדדדדדדדדדדדדדה"]), 2000 + rng.randrange(5)) for _ in range(90)})
        df = spark.createDataFrame([(c, t, y, 1) for c, t, y in rows], "budget_code string, support_title string, year_requested int, amount_approved int")
        got = {(r["budget_code"], r["support_title"][:15], r["year_requested"]): r["program_key"] for r in clusters.program_keys(df).collect()}
        assert got == plain_programs(rows)


def test_program_keys_of_nothing(spark):
    rows = [(None, "א", 2000, 1), ("0010", "א", None, 1), ("0010", "א", 2000, 0), ("0010", None, 2000, 1), ("0010", "english", 2001, 1)]
    df = spark.createDataFrame(rows, "budget_code string, support_title string, year_requested int, amount_approved int")
    assert sorted((str(r["program_key"])) for r in clusters.program_keys(df).collect()) == ["0010_", "None", "None", "None", "None"]
    assert clusters.program_keys(df.limit(0)).count() == 0


def test_support_programs(spark):
    rows = [("p", "t1", 2019, "m", "r1", "e1", "n1", "company", 10.0, 5.0), ("p", "t2", 2020, "m", "r2", "e1", "n1", "company", 10.0, 10.0), ("p", "t2", 2020, "m", "r2", "e2", "n2", None, 0.0, 3.0)]
    df = spark.createDataFrame(rows, "program_key string, support_title string, year_requested int, supporting_ministry string, request_type string, entity_id string, entity_name string, entity_kind string, amount_approved double, amount_paid double")
    r = supports.analyse_programs(df).first()
    assert (r["title"], r["request_type"], r["total_approved"], r["total_paid"], r["total_entities"], r["year_range"], r["year_span"]) == ("t2", "r2", 20.0, 18.0, 2, "2019-2020", 2)
    assert r["recipients"][0]["id"] == "e1" and r["recipients"][0]["average_use"] == 0.75 and r["average_use"] == 0.75
    assert {k["kind"]: k["count"] for k in r["entity_kinds"]} == {"company": 2, "other": 1}


def test_consolidated_entities(spark):
    schema = "id string, name string, name_en string, kind string, kind_he string, details map<string,string>"
    a = spark.createDataFrame([("1", "a", None, "x", "X", {"p": "1"})], schema)
    b = spark.createDataFrame([("1", "b", "B", "y", "Y", {"p": "2", "q": "3"}), ("2", "c", None, "y", "Y", {})], schema)
    out = {r["id"]: r for r in entities.consolidate([a, b]).collect()}
    assert (out["1"]["name"], out["1"]["kind"], out["1"]["details"]) == ("b", "x", {"p": "2", "q": "3"}) and out["2"]["name"] == "c"


def test_awardees_and_timeline(spark):
    pay = "array<struct<timestamp:string,executed:double>>"
    contract_rows = [
        ("o1", "b", "p", ['["1", "office", "9"]'], dt.date(2020, 5, 1), "A", "e1", "company", ["x"], True, 100.0, 30.0, [("2020-1", 10.0), ("2020-3", 30.0)]),
        ("o2", "b", "p", ['["1", "office", "9"]'], None, None, None, None, ["s", "t"], False, 50.0, 5.0, [("2020-2", 5.0)]),
        ("o3", "b", "p", ['["1", "office", "9"]'], dt.date(2019, 1, 1), "C", "e3", None, [], True, 7.0, 7.0, []),
    ]
    c = spark.createDataFrame(contract_rows, f"order_id string, budget_code string, publisher_key string, tender_key array<string>, order_date date, entity_name string, entity_id string, entity_kind string, supplier_name array<string>, contract_is_active boolean, volume double, executed double, payments {pay}")
    t = spark.createDataFrame([(1, "office", "9", dt.date(2020, 1, 1), None, None, None, 10.0, dt.date(2020, 2, 1), dt.date(2020, 1, 1), None, "חדש", dt.date(2020, 3, 1), [("l", "d", "2020-06-01")])], "publication_id int, tender_type string, tender_id string, start_date date, entity_id string, entity_name string, entity_kind string, volume double, claim_date date, publication_date date, end_date date, decision string, last_update_date date, documents array<struct<link:string,description:string,update_time:string>>")
    out = contracts.awardees(t, c)
    row = out.first()
    assert (row["contract_volume"], row["contract_executed"]) == (150.0, 35.0)
    assert [(a["entity_name"], [tuple(p) for p in a["payments"]]) for a in row["awardees"]] == [("A", [("2020-1", 10.0), ("2020-2", 10.0), ("2020-3", 30.0)]), ("t", [("2020-1", 0.0), ("2020-2", 5.0), ("2020-3", 5.0)])]
    events = contracts.timeline(out).first()["timeline"]
    assert [e["timestamp"] for e in events] == sorted((e["timestamp"] for e in events), reverse=True)
    by_time = {e["timestamp"]: e for e in events}
    assert round(by_time["2020-09-30"]["percent"], 4) == round(100 * 35 / 150, 4) and by_time["2020-01-01"]["percent"] is None
    assert round(by_time["2020-06-01"]["percent"], 4) == round(100 * 10 / 150, 4)


def test_latest_contracts(spark):
    rows = [("o", "b", "p", 2020, 1, "u1", 5.0, 100.0, dt.date(2020, 1, 1), None, None), ("o", "b", "p", 2020, 3, "u2", 7.0, None, None, dt.date(2022, 1, 1), None)]
    df = spark.createDataFrame(rows, "order_id string, budget_code string, publisher_key string, report_year int, report_period int, report_url string, executed double, volume double, start_date date, end_date date, order_date date")
    r = contracts.latest_contracts(df).first()
    assert (r["executed"], r["volume"], r["min_year"], r["max_year"]) == (7.0, 100.0, 2020, 2022) and [tuple(p) for p in r["payments"]] == [("2020-1", 5.0), ("2020-3", 7.0)]


def test_facilities_come_together_by_evidence(spark):
    rows = [("101", {"name": "gan", "address": "main 1", "phone": "111"}), ("102", {"name": "other", "address": "main 1", "phone": "111"}), ("103", {"name": "gan", "address": "far 9"}), ("104", {"name": "x", "mol_symbol": "101"}), ("105", {"name": "gan"})]
    df = spark.createDataFrame([(i, r, None, "c", 1.0, 2.0) for i, r in rows], "_id string, record map<string,string>, formatted_address string, city string, lat double, lng double")
    for order in itertools.islice(itertools.permutations(range(5)), 0, 120, 60):
        shuffled = spark.createDataFrame([df.collect()[i] for i in order], df.schema)
        out = {r["_id"]: len(r["official"]) for r in facilities.deduplicate(shuffled).collect()}
        assert out == {"101": 3, "103": 1, "105": 1}


def test_reports(spark):
    ngos = spark.createDataFrame([("1", "f", ["n", "s"], 10.0, True), ("2", "f", ["n"], 30.0, True), ("3", "g", ["n"], 5.0, False)], "id string, foa string, districts array<string>, association_yearly_turnover double, association_status_active boolean")
    out = {r["districts"]: r for r in reports.activity_report(ngos, "districts", "foa").collect()}
    assert (out["n"]["count"], out["n"]["turnover"], out["n"]["median_turnover"]) == (2, 40.0, 20.0) and out["s"]["count"] == 1
    assert [(r["foa"], r["id"]) for r in reports.sole_in(ngos, ["foa"]).collect()] == [("g", "3")]
    spending = spark.createDataFrame([("1", 5.0, "a"), ("2", 7.0, "a"), ("1", 1.0, "b")], "entity_id string, amount double, kind string")
    got = reports.received_ranks(ngos, spending, {"all": F.lit(True), "a": F.col("kind") == "a"}, "foa", 1)
    assert sorted((r["kind"], r["id"]) for r in got.collect()) == [("a", "2"), ("all", "2")]
    links = reports.sankey(spending, "entity_id", "kind", "amount", 1, "rest").collect()
    assert sorted((r["source"], r["target"], r["value"]) for r in links) == [("1", "a", 5.0), ("1", "rest", 1.0), ("2", "a", 7.0)]
    ref = spark.createDataFrame([(2020, 2.0)], "year int, value double")
    series = reports.normalised_series(spark.createDataFrame([(2020, 4.0), (2021, 4.0)], "y int, v double"), "y", "v", {"gdp": ref})
    assert sorted((r["y"], r["v_gdp"]) for r in series.collect()) == [(2020, 2.0), (2021, None)]


def test_known_change_groups_are_taken_first(spark):
    rows = [(t, "d", "0047", 1 + i, a) for i, (t, a) in enumerate([("a", 5.0), ("b", -5.0), ("c", 5.0), ("e", -5.0), ("f", 1.0)])]
    df = spark.createDataFrame(rows, "trcode string, date_kind string, budget_code string, leading_item int, net_expense_diff double")
    found = changes.change_groups(df, ["net_expense_diff"])
    assert {r["trcode"]: r["group_id"] for r in found.collect()} == {"a": "a", "b": "a", "c": "c", "e": "c", "f": "f"}
    known = changes.group_cache(df, found)
    assert sorted(sorted(r["trcodes"]) for r in known.collect()) == [["a", "b"], ["c", "e"], ["f"]]
    other = spark.createDataFrame([("d", 1, ["a", "e"]), ("d", 2, ["b", "gone"])], "date_kind string, serial long, trcodes array<string>")
    again = {r["trcode"]: r["group_id"] for r in changes.change_groups(df, ["net_expense_diff"], other).collect()}
    assert again == {"a": "a", "e": "a", "b": "b", "c": "b", "f": "f"}
