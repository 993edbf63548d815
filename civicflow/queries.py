"""Registered queries of the library's operators over the star-schema tables, and the same in SQL."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import codes, dates, ids, scores, text, values
from .functions.geo import grid_to_degrees
from .operators import aggregates, arrays, filters, joins, project, setops, windows
from .operators.project import q
from .plans import activities, budget, changes, charts, clusters, contracts, entities, indexer, reports, supports
from .state.history import history_updates
from .state.revisions import manage_revisions, row_hash
from .state.upsert import upsert
from .udfs.fuzzy import similarity
from .udfs.names import fingerprint_udf

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: Today of all queries.
AS_OF = dt.date(1998, 12, 1)


class Tables:
    """Tables of a folder by name, each read with the columns that are used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._dir}/{name}.parquet")


def query(sql: str | None = None):
    def register(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def money(c, digits: int = 2):
    return F.round(c, digits)


# --- sources, projection, filters -------------------------------------------------------------------------------


@query("""
select c_custkey, c_name, coalesce(round(received, 2), 0) as received_amount, round(orders_part, 2) as received_orders,
  round(events_part, 2) as received_events, min_year, max_year, greatest(1.0, coalesce(received, 0) / 1000) as score
from customer left join (
  select k, sum(a) as received, sum(case when s = 'orders' then a end) as orders_part, sum(case when s = 'events' then a end) as events_part,
    min(y) as min_year, max(y) as max_year
  from (select o_custkey as k, sum(cast(round(l_extendedprice * 100) as bigint)) / 100.0 as a, 'orders' as s, min(year(o_orderdate)) as y
        from orders join lineitem on l_orderkey = o_orderkey group by 1, year(o_orderdate)
        union all
        select user_id, sum(cast(round(value * 100) as bigint)) / 100.0, 'events', year(ts) from events group by 1, year(ts))
  group by k) on k = c_custkey
""")
def q_received_by_entity(t: Tables) -> DataFrame:
    """What each customer received from orders and from events, with its years and score."""
    cents = lambda c: F.round(c * 100).cast("long")
    lines = t.lineitem.groupBy("l_orderkey").agg(F.sum(cents(F.col("l_extendedprice"))).alias("cents"))
    orders = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_custkey").alias("entity_id"), (F.col("cents") / 100).alias("amount"), F.year("o_orderdate").alias("year"))
    events = t.events.groupBy(F.col("user_id").alias("entity_id"), F.year("ts").alias("year")).agg((F.sum(cents(F.col("value"))) / 100).alias("amount"))
    out = entities.received(t.customer.select("c_custkey", "c_name"), {"orders": orders, "events": events}, "c_custkey")
    rounded = {f"received_{n}": money(F.col(f"received_{n}")) for n in ("orders", "events")}
    return out.withColumns(rounded).withColumn("received_amount", F.coalesce(money(F.col("received_amount")), F.lit(0.0))).select("c_custkey", "c_name", "received_amount", "received_orders", "received_events", "min_year", "max_year", "score")


@query("""
select c_name as name, c_acctbal as balance, 'customer' as kind from customer
union all select s_name, s_acctbal, 'supplier' from supplier
""")
def q_concat_rename_union(t: Tables) -> DataFrame:
    a = t.customer.withColumn("kind", F.lit("customer"))
    b = t.supplier.withColumn("kind", F.lit("supplier"))
    return setops.concatenate([a, b], {"name": ["c_name", "s_name"], "balance": ["c_acctbal", "s_acctbal"], "kind": []})


@query("select * from orders where o_orderstatus = 'F' and o_orderpriority <> '1-URGENT'")
def q_filter_in_out(t: Tables) -> DataFrame:
    return filters.filter_rows(t.orders, [{"o_orderstatus": "F"}], [{"o_orderpriority": "1-URGENT"}])


@query("""
select l_suppkey, round(sum(case when year(l_shipdate) >= 1995 then l_extendedprice else 0 end), 2) as recent_amount,
  count(case when year(l_shipdate) >= 1995 then 1 end) as recent_count
from lineitem group by 1
""")
def q_recent_amount(t: Tables) -> DataFrame:
    rows = t.lineitem.withColumn("y", F.year("l_shipdate"))
    rows = filters.last_years(rows, "y", "recent", AS_OF, "l_extendedprice")
    rows = filters.last_years(rows, "y", "is_recent", AS_OF)
    return rows.groupBy("l_suppkey").agg(money(F.sum("recent")).alias("recent_amount"), F.count(F.when(F.col("is_recent"), 1)).alias("recent_count"))


@query("select o_orderkey, o_custkey from orders where o_orderdate > timestamp '1998-07-01' and o_orderdate is not null and o_totalprice <> 0")
def q_seen_lately(t: Tables) -> DataFrame:
    rows = filters.filled(filters.not_null(t.orders, "o_orderdate"), "o_totalprice")
    return rows.where(F.col("o_orderdate") > F.lit("1998-07-01").cast("timestamp")).select("o_orderkey", "o_custkey")


@query("""
select cast(o_orderkey as varchar) as o_orderkey, try_cast(substr(o_orderpriority, 1, 1) as integer) as priority_number,
  cast(o_totalprice as decimal(38,6)) as o_totalprice, cast(o_orderdate as date) as o_orderdate
from orders
""")
def q_set_types(t: Tables) -> DataFrame:
    strings = t.orders.select(q("o_orderkey").cast("string"), F.substring("o_orderpriority", 1, 1).alias("priority_number"), q("o_totalprice").cast("string"), q("o_orderdate").cast("string"))
    return project.set_types(strings, {"priority_.*": "int", "o_total.+": {"type": "decimal(38,6)", "group": ","}, "o_orderdate": "date"})


@query("""
select p_partkey, p_brand || '/' || p_type || ' (' || case when p_size < 10 then '0' || p_size else cast(p_size as varchar) end || ')' as title,
  'fixed' as kind, p_size + p_partkey as total
from part
""")
def q_computed_fields(t: Tables) -> DataFrame:
    rows = project.add_computed(t.part, "title", "format", with_="{p_brand}/{p_type} ({p_size:02d})")
    rows = project.add_computed(rows, "kind", "constant", with_="fixed")
    return project.add_computed(rows, "total", "sum", ["p_size", "p_partkey"]).select("p_partkey", "title", "kind", "total")


@query("""
select c_custkey as customer, upper(c_mktsegment) as segment, c_acctbal / 100 as hundreds from customer
where upper(c_mktsegment) <> 'BUILDING' and c_acctbal / 100 > 0
""")
def q_publish_fields(t: Tables) -> DataFrame:
    """A published table: fields in order, filters on what earlier fields were rewritten to."""
    return project.publish(t.customer, [
        {"name": "customer", "default": q("c_custkey")},
        {"name": "segment", "transform": F.upper("c_mktsegment"), "filter": lambda c: c != "BUILDING"},
        {"name": "hundreds", "transform": q("c_acctbal") / 100, "filter": lambda c: c > 0, "description": "balance in hundreds"},
    ])


@query("select c_custkey, c_name from customer where c_acctbal >= 0 and c_mktsegment similar to '[A-Z]+' and length(c_name) >= 3")
def q_validate_drop(t: Tables) -> DataFrame:
    rules = {"c_acctbal": {"required": True, "minimum": 0}, "c_mktsegment": {"pattern": "[A-Z]+"}, "c_name": {"minLength": 3}}
    return project.validate(t.customer, rules, "drop").select("c_custkey", "c_name")


# --- joins ------------------------------------------------------------------------------------------------------


@query("""
select c_custkey, n_orders, total, last_status from customer left join (
  select o_custkey, count(*) as n_orders, round(sum(o_totalprice), 2) as total, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) as last_status
  from orders where o_orderpriority = '1-URGENT' group by 1) on o_custkey = c_custkey
""")
def q_join_half_outer_sum(t: Tables) -> DataFrame:
    urgent = t.orders.where("o_orderpriority = '1-URGENT'")
    fields = {"n_orders": {"name": "o_orderkey", "aggregate": "count"}, "total": {"name": "o_totalprice", "aggregate": "sum"}, "last_status": {"name": "o_orderstatus", "aggregate": "last"}}
    out = joins.lookup_join(t.customer.select("c_custkey"), urgent, ["o_custkey"], ["c_custkey"], fields, null_safe=False, order_by=["o_orderdate", "o_orderkey"])
    return out.withColumn("total", money(F.col("total")))


@query("""
select s_suppkey, n_name, r_name from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey where r_name <> 'ASIA'
""")
def q_join_inner(t: Tables) -> DataFrame:
    nations = joins.lookup_join(t.nation, t.region.where("r_name <> 'ASIA'"), ["r_regionkey"], ["n_regionkey"], {"r_name": None}, full=False)
    out = joins.lookup_join(t.supplier, nations, ["n_nationkey"], ["s_nationkey"], {"n_name": None, "r_name": None}, full=False)
    return out.select("s_suppkey", "n_name", "r_name")


@query("""
select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'F' and o_orderpriority = '1-URGENT')
""")
def q_anti_join_superseded(t: Tables) -> DataFrame:
    done = t.orders.where("o_orderstatus = 'F' and o_orderpriority = '1-URGENT'")
    return joins.absent_from(t.customer.select("c_custkey"), done, ["c_custkey"], ["o_custkey"])


@query("""
select coalesce(a.y, b.y) as year, n_orders, n_events from (select year(o_orderdate) as y, count(*) as n_orders from orders group by 1) a
full join (select year(ts) as y, count(*) as n_events from events group by 1) b on a.y = b.y
""")
def q_full_outer_years(t: Tables) -> DataFrame:
    a = t.orders.groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("n_orders"))
    b = t.events.groupBy(F.year("ts").alias("year")).agg(F.count(F.lit(1)).alias("n_events"))
    return joins.full_outer(a, b, ["year"])


@query("""
select o_orderkey, string_agg(p_brand, '|' order by l_linenumber, l_partkey) as brands from orders
join lineitem on l_orderkey = o_orderkey join part on p_partkey = l_partkey where p_size > 25 group by 1
""")
def q_lookup_array(t: Tables) -> DataFrame:
    lists = aggregates.group(t.lineitem, ["l_orderkey"], {"parts": {"name": "l_partkey", "aggregate": "array"}}, ["l_linenumber", "l_partkey"])
    found = joins.lookup_array(lists, "parts", t.part.where("p_size > 25"), "p_partkey", "p_brand", "brands", ["l_orderkey"])
    return found.where(F.size("brands") > 0).select(F.col("l_orderkey").alias("o_orderkey"), F.array_join("brands", "|").alias("brands"))


@query("""
select l_orderkey, l_linenumber, coalesce(p_name, 'part ' || l_partkey) as name from lineitem left join (select * from part where p_size < 20) on p_partkey = l_partkey
""")
def q_lookup_or_default(t: Tables) -> DataFrame:
    small = t.part.where("p_size < 20").withColumnRenamed("p_partkey", "l_partkey")
    out = joins.lookup_or(t.lineitem, small, ["l_partkey"], "p_name", F.concat(F.lit("part "), q("l_partkey").cast("string")), "name")
    return out.select("l_orderkey", "l_linenumber", "name")


@query("""
select o_orderkey, o_custkey, case when rn = 1 then c_acctbal end as fix from
(select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as rn from orders) left join customer on c_custkey = o_custkey
""")
def q_lookup_once(t: Tables) -> DataFrame:
    fixes = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_acctbal").alias("fix"))
    return joins.lookup_once(t.orders, fixes, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_orderkey", "o_custkey", "fix")


@query("""
with e as (select c_custkey as id, c_name as name from customer where c_acctbal > 0)
select o_orderkey, coalesce(a.id, b.id) as entity_id, coalesce(a.name, b.name) as entity_name from orders
left join e a on a.id = o_custkey left join (select min(id) as id, name from e group by name) b on b.name = 'Customer#' || lpad(cast(o_custkey + 1 as varchar), 9, '0')
""")
def q_resolve_entity(t: Tables) -> DataFrame:
    """By id, else by name: entities in credit are known."""
    known = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit("c").alias("kind"), F.col("c_name").alias("fingerprint"))
    rows = t.orders.withColumn("fp", F.concat(F.lit("Customer#"), codes.pad_left((q("o_custkey") + 1).cast("string"), 9)))
    return joins.resolve(rows, known, "o_custkey", "fp").select("o_orderkey", "entity_id", "entity_name")


@query("""
select o_orderkey, sum(l_quantity) as quantity, count(*) as lines from orders join lineitem on l_orderkey = o_orderkey and l_shipdate >= o_orderdate + interval 30 day group by 1
""")
def q_join_residual(t: Tables) -> DataFrame:
    """An equality join with a date condition beside it."""
    on = (q("l_orderkey") == q("o_orderkey")) & (q("l_shipdate") >= q("o_orderdate") + F.expr("interval 30 days"))
    return t.orders.join(t.lineitem, on).groupBy("o_orderkey").agg(F.sum("l_quantity").alias("quantity"), F.count(F.lit(1)).alias("lines"))


@query("""
select n_name, r_name as parent1, 'world' as parent2 from nation join region on n_regionkey = r_regionkey
union all select r_name, 'world', null from region union all select 'world', null, null
""")
def q_hierarchy_parents(t: Tables) -> DataFrame:
    nodes = setops.concatenate([
        t.nation.select(F.concat(F.lit("n"), "n_nationkey").alias("k"), F.concat(F.lit("r"), "n_regionkey").alias("p"), F.col("n_name").alias("v")),
        t.region.select(F.concat(F.lit("r"), "r_regionkey").alias("k"), F.lit("w").alias("p"), F.col("r_name").alias("v")),
        t.region.agg(F.count(F.lit(1)).alias("n")).select(F.lit("w").alias("k"), F.lit(None).cast("string").alias("p"), F.lit("world").alias("v")),
    ], {"k": None, "p": None, "v": None})
    return joins.parents(nodes, "k", "p", "v", 2).select(F.col("v").alias("n_name"), "parent1", "parent2")


@query("select o_orderkey, c_name, c_mktsegment from orders left join customer on c_custkey = o_custkey")
def q_enrich(t: Tables) -> DataFrame:
    table = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return joins.enrich(t.orders.select("o_orderkey", "o_custkey"), table, ["o_custkey"], "details").select("o_orderkey", "details.c_name", "details.c_mktsegment")


# --- aggregates -------------------------------------------------------------------------------------------------


@query("""
select l_suppkey, round(sum(l_extendedprice), 2) as total, min(l_shipdate) as first_ship, max(l_shipdate) as last_ship, max(l_returnflag) as flag, count(*) as n
from lineitem group by 1
""")
def q_group_self_sum_min_max(t: Tables) -> DataFrame:
    fields = {"total": {"name": "l_extendedprice", "aggregate": "sum"}, "first_ship": {"name": "l_shipdate", "aggregate": "min"}, "last_ship": {"name": "l_shipdate", "aggregate": "max"}, "flag": {"name": "l_returnflag", "aggregate": "max"}, "n": {"name": "l_tax", "aggregate": "count"}}
    return aggregates.group(t.lineitem, ["l_suppkey"], fields).withColumn("total", money(F.col("total")))


@query("""
select o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) as last_status, arg_min(o_orderstatus, (o_orderdate, o_orderkey)) as first_status from orders group by 1
""")
def q_last_by_order(t: Tables) -> DataFrame:
    fields = {"last_status": {"name": "o_orderstatus", "aggregate": "last"}, "first_status": {"name": "o_orderstatus", "aggregate": "first"}}
    return aggregates.group(t.orders, ["o_custkey"], fields, ["o_orderdate", "o_orderkey"])


@query("""
select l_orderkey, string_agg(distinct l_returnflag, ',' order by l_returnflag) as flags from lineitem group by 1
""")
def q_set_sorted(t: Tables) -> DataFrame:
    out = aggregates.group(t.lineitem, ["l_orderkey"], {"flags": {"name": "l_returnflag", "aggregate": "set"}})
    return out.withColumn("flags", F.array_join("flags", ","))


@query("""
select l_orderkey, string_agg(cast(l_partkey as varchar), ',' order by l_linenumber, l_partkey) as parts from lineitem group by 1
""")
def q_array_ordered(t: Tables) -> DataFrame:
    out = aggregates.group(t.lineitem, ["l_orderkey"], {"parts": {"name": "l_partkey", "aggregate": "array"}}, ["l_linenumber", "l_partkey"])
    return out.withColumn("parts", F.array_join(F.transform("parts", lambda x: x.cast("string")), ","))


@query("""
select user_id, string_agg(event_type || ':' || n, ',' order by n desc, event_type) as frequencies
from (select user_id, event_type, count(*) as n from events group by 1, 2) group by 1
""")
def q_counters(t: Tables) -> DataFrame:
    out = aggregates.group(t.events, ["user_id"], {"f": {"name": "event_type", "aggregate": "counters"}})
    return out.select("user_id", F.array_join(F.transform("f", lambda x: F.concat_ws(":", x["value"], x["count"].cast("string"))), ",").alias("frequencies"))


@query("select p_brand, median(p_retailprice) as median_price from part group by 1")
def q_median(t: Tables) -> DataFrame:
    return aggregates.group(t.part, ["p_brand"], {"median_price": {"name": "p_retailprice", "aggregate": "median"}})


@query("""
select p_brand, p_retailprice as upper_median from (select p_brand, p_retailprice, row_number() over (partition by p_brand order by p_retailprice) as r,
  count(*) over (partition by p_brand) as n from part) where r = n // 2 + 1
""")
def q_upper_median(t: Tables) -> DataFrame:
    return reports.upper_median(t.part, ["p_brand"], "p_retailprice", "upper_median")


@query("""
select r_name, count(*) as n, string_agg(n_nationkey || '=' || n_name, ';' order by n_nationkey) as children from nation join region on n_regionkey = r_regionkey group by 1
""")
def q_collate_children(t: Tables) -> DataFrame:
    rows = t.nation.join(t.region, q("n_regionkey") == q("r_regionkey")).select("r_name", "n_nationkey", "n_name")
    out = aggregates.collate(rows, ["r_name"], "children", ["n_nationkey"])
    return out.select("r_name", F.size("children").cast("long").alias("n"), F.array_join(F.transform("children", lambda x: F.concat_ws("=", x["n_nationkey"].cast("string"), x["n_name"])), ";").alias("children"))


@query("select l_partkey, min(l_suppkey) as l_suppkey from lineitem group by 1 having count(distinct l_suppkey) = 1")
def q_sole_partner(t: Tables) -> DataFrame:
    return aggregates.sole_member(t.lineitem, ["l_partkey"], "l_suppkey")


@query("""
select c_mktsegment, 100 * count(case when c_acctbal > 0 then 1 end) // count(*) as pct from customer group by 1
""")
def q_pct_int(t: Tables) -> DataFrame:
    return reports.approval_share(t.customer, ["c_mktsegment"], q("c_acctbal") > 0, "pct")


@query("select l_returnflag, round(sum(l_discount * l_quantity) / sum(l_quantity), 8) as mean_discount from lineitem group by 1")
def q_weighted_mean(t: Tables) -> DataFrame:
    out = aggregates.weighted_mean(t.lineitem, ["l_returnflag"], "l_discount", "l_quantity", "mean_discount")
    return out.withColumn("mean_discount", F.round("mean_discount", 8))


@query("""
select o_orderstatus, round(avg(s), 4) as mean_total from (select o_orderstatus, o_custkey, sum(o_totalprice) as s from orders group by 1, 2) group by 1
""")
def q_average_of_sums(t: Tables) -> DataFrame:
    out = aggregates.average_of_sums(t.orders, ["o_orderstatus"], ["o_custkey"], "o_totalprice", "mean_total")
    return out.withColumn("mean_total", F.round("mean_total", 4))


@query("""
select r_name, n_name, c_mktsegment, round(sum(c_acctbal), 2) as balance, count(*) as n,
  3 - grouping(r_name) - grouping(n_name) - grouping(c_mktsegment) as depth
from customer join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey group by rollup (r_name, n_name, c_mktsegment)
""")
def q_rollup_union(t: Tables) -> DataFrame:
    rows = t.customer.join(t.nation, q("n_nationkey") == q("c_nationkey")).join(t.region, q("r_regionkey") == q("n_regionkey"))
    out = aggregates.rollup_levels(rows, ["r_name", "n_name", "c_mktsegment"], {"balance": q("c_acctbal"), "n": F.lit(1)})
    return out.withColumn("balance", money(F.col("balance"))).withColumn("depth", F.col("depth").cast("long"))


@query("""
select l_suppkey, round(sum(case when l_returnflag = 'A' then l_extendedprice else 0 end), 2) as sum_a,
  round(sum(case when l_returnflag = 'N' then l_extendedprice else 0 end), 2) as sum_n, round(sum(case when l_returnflag = 'R' then l_extendedprice else 0 end), 2) as sum_r
from lineitem group by 1
""")
def q_pivot_sums(t: Tables) -> DataFrame:
    out = aggregates.sums_by_category(t.lineitem, ["l_suppkey"], "l_returnflag", "l_extendedprice", {"A": "sum_a", "N": "sum_n", "R": "sum_r"})
    return out.withColumns({c: money(F.col(c)) for c in ("sum_a", "sum_n", "sum_r")})


@query("""
with c as (select lpad(cast(n_regionkey as varchar), 2, '0') || lpad(cast(n_nationkey as varchar), 2, '0') as code, c_acctbal from customer join nation on n_nationkey = c_nationkey)
select 1 as depth, substr(code, 1, 2) as code, round(sum(c_acctbal), 2) as c_acctbal from c group by 2 union all select 2, code, round(sum(c_acctbal), 2) from c group by 2
""")
def q_hierarchy_rollup(t: Tables) -> DataFrame:
    code = F.concat(codes.pad_left(q("n_regionkey").cast("string"), 2), codes.pad_left(q("n_nationkey").cast("string"), 2))
    rows = t.customer.join(t.nation, q("n_nationkey") == q("c_nationkey")).withColumn("code", code)
    return aggregates.rollup_codes(rows, "code", ["c_acctbal"]).withColumn("c_acctbal", money(F.col("c_acctbal")))


@query("""
with c as (select c_mktsegment, n_name, count(*) as cnt from customer join nation on n_nationkey = c_nationkey group by 1, 2),
p as (select *, cnt / sum(cnt) over (partition by c_mktsegment) as pct from c),
m as (select n_name, sum(pct) / (select count(distinct c_mktsegment) from c) as mean_pct from p group by 1),
s as (select c_mktsegment, n_name, (pct - mean_pct) * log10(cnt) as score from p join m using (n_name))
select c_mktsegment, n_name, round(score, 8) as score, r as rank from (select *, rank() over (partition by c_mktsegment order by round(score, 10) desc) as r from s) where r <= 3
""")
def q_specialisation(t: Tables) -> DataFrame:
    rows = t.customer.join(t.nation, q("n_nationkey") == q("c_nationkey")).select("c_mktsegment", "n_name")
    out = aggregates.specialisation(rows, "c_mktsegment", "n_name")
    return out.select("c_mktsegment", "n_name", F.round("score", 8).alias("score"), F.col("rank").cast("long").alias("rank"))


@query("select count(distinct (o_orderstatus, o_orderpriority)) as pairs, count(distinct o_custkey) as customers from orders")
def q_count_distinct_pairs(t: Tables) -> DataFrame:
    return t.orders.agg(F.count_distinct(F.struct("o_orderstatus", "o_orderpriority")).alias("pairs"), F.count_distinct("o_custkey").alias("customers"))


@query("""
select user_id, event_type, value from (select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as r from events) where r = 1
""")
def q_collapse_duplicates(t: Tables) -> DataFrame:
    return aggregates.last_values(t.events.select("user_id", "event_type", "ts", "event_id", "value"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "value")


@query("select distinct o_orderstatus, o_orderpriority from orders")
def q_distinct_sets(t: Tables) -> DataFrame:
    return aggregates.distinct_rows(t.orders, ["o_orderstatus", "o_orderpriority"])


@query("""
select c_mktsegment, string_agg(k || '=' || v, ',' order by k) as merged from (
  select c_mktsegment, 'nation' || (c_nationkey % 3) as k, arg_max(c_name, c_custkey) as v from customer group by 1, 2) group by 1
""")
def q_merge_maps(t: Tables) -> DataFrame:
    rows = t.customer.withColumn("details", F.create_map(F.concat(F.lit("nation"), (q("c_nationkey") % 3).cast("string")), q("c_name")))
    out = aggregates.merge_maps(rows, ["c_mktsegment"], "details", ["c_custkey"])
    return out.select("c_mktsegment", F.array_join(F.transform(F.array_sort(F.map_entries("details")), lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias("merged"))


@query("""
select p_brand, count(*) filter (p_size <= 10) as small, count(*) filter (p_size > 10 and p_size <= 30) as medium, count(*) filter (p_size > 30) as large,
  round(sum(p_retailprice) filter (p_size > 30), 2) as large_price from part group by 1
""")
def q_subset_report(t: Tables) -> DataFrame:
    subsets = {"small": q("p_size") <= 10, "medium": q("p_size").between(11, 30), "large": q("p_size") > 30}
    out = reports.subset_report(t.part, ["p_brand"], subsets, {"price": q("p_retailprice")})
    n = lambda k: F.coalesce(F.try_element_at("report", F.lit(k))["count"], F.lit(0)).alias(k)
    return out.select("p_brand", n("small"), n("medium"), n("large"), money(F.try_element_at("report", F.lit("large"))["price"]).alias("large_price"))


# --- windows, sorts, limits -------------------------------------------------------------------------------------


@query("select s_suppkey, s_nationkey, r as rank from (select *, rank() over (partition by s_nationkey order by s_acctbal desc) as r from supplier where s_acctbal > 0) where r <= 3")
def q_rank_topk(t: Tables) -> DataFrame:
    out = reports.ranked(t.supplier, ["s_nationkey"], "s_acctbal", 3, "rank")
    return out.select("s_suppkey", "s_nationkey", F.col("rank").cast("long").alias("rank"))


@query("select o_custkey, o_orderkey from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as r from orders) where r = 1")
def q_latest_row(t: Tables) -> DataFrame:
    return windows.latest(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("""
select event_id, lead(event_id) over w as next_doc, lag(event_id) over w as prev_doc from events window w as (partition by event_type, user_id order by ts desc, event_id desc)
""")
def q_next_prev(t: Tables) -> DataFrame:
    return windows.link_neighbours(t.events, ["event_type", "user_id"], "event_id", [F.desc("ts"), F.desc("event_id")]).select("event_id", "next_doc", "prev_doc")


@query("""
select event_id, last_value(case when event_type = 'click' then value end ignore nulls) over (partition by user_id order by ts, event_id rows unbounded preceding) as known from events
""")
def q_forward_fill(t: Tables) -> DataFrame:
    rows = t.events.withColumn("known", F.when(F.col("event_type") == "click", F.col("value")))
    return windows.fill_forward(rows, ["known"], ["ts", "event_id"], ["user_id"]).select("event_id", "known")


@query("""
select event_id, last_value(case when event_type = 'purchase' then user_id end ignore nulls) over (order by ts, event_id rows unbounded preceding) as last_buyer from events
""")
def q_forward_fill_table(t: Tables) -> DataFrame:
    """Forward fill in the order of a whole table."""
    rows = t.events.select("event_id", "ts", F.when(F.col("event_type") == "purchase", F.col("user_id")).alias("last_buyer"))
    return windows.fill_forward_all(rows, ["last_buyer"], ["ts", "event_id"]).select("event_id", "last_buyer")


@query("""
with b as (select p_brand, round(sum(p_retailprice), 2) as total, count(*) as n from part group by 1), r as (select *, row_number() over (order by total desc, p_brand) as r from b)
select case when r <= 4 then p_brand else 'others' end as p_brand, round(sum(total), 2) as total, sum(n) as n from r group by 1
""")
def q_top4_others(t: Tables) -> DataFrame:
    sums = t.part.groupBy("p_brand").agg(money(F.sum("p_retailprice")).alias("total"), F.count(F.lit(1)).alias("n"))
    return windows.top_and_others(sums, [], "p_brand", ["total", "n"]).withColumn("total", money(F.col("total")))


@query("select event_id, row_number() over (partition by user_id, event_type order by ts, event_id) as occurrence from events")
def q_number_occurrences(t: Tables) -> DataFrame:
    out = windows.number_occurrences(t.events, ["user_id", "event_type"], ["ts", "event_id"])
    return out.select("event_id", F.col("occurrence").cast("long").alias("occurrence"))


@query("select c_custkey, (row_number() over (order by md5(cast(c_custkey as varchar))) - 1) // 100 as page from customer")
def q_pages(t: Tables) -> DataFrame:
    """Pages of rows by their hash, as sitemaps have them."""
    return windows.pages(t.customer.select("c_custkey", F.md5(q("c_custkey").cast("string")).alias("h")), ["h"], 100).select("c_custkey", "page")


@query("""
with l as (select l_suppkey as k, l_shipdate as d, l_returnflag as i, sum(cast(l_quantity as bigint)) as v from lineitem group by 1, 2, 3),
g as (select * from (select distinct k, d from l) join (select distinct k, i from l) using (k) left join l using (k, d, i))
select k, d, i, last_value(v ignore nulls) over (partition by k, i order by d rows unbounded preceding) as v from g
""")
def q_gaps_filled(t: Tables) -> DataFrame:
    """The last known value of each item at all times of its group."""
    rows = t.lineitem.groupBy(F.col("l_suppkey").alias("k"), F.col("l_shipdate").alias("d"), F.col("l_returnflag").alias("i")).agg(F.sum(F.col("l_quantity").cast("long")).alias("v"))
    return windows.gaps_filled(rows, ["k"], "d", "i", "v")


@query("select event_id from (select event_id, row_number() over (order by event_id) - 1 as i from events) where i <= 10 or i - cast(pow(10, floor(log10(greatest(i, 1)))) as bigint) <= 10")
def q_log_sample(t: Tables) -> DataFrame:
    return windows.log_sample(windows.numbered(t.events.select("event_id"), ["event_id"], "i"), "i").select("event_id")


# --- set operations, arrays, JSON -------------------------------------------------------------------------------


@query("select distinct n, b from (select c_nationkey as n, floor(c_acctbal / 1000) as b from customer union all select s_nationkey, floor(s_acctbal / 1000) from supplier)")
def q_union_distinct(t: Tables) -> DataFrame:
    pick = lambda df, p: df.select(q(f"{p}_nationkey").alias("n"), F.floor(q(f"{p}_acctbal") / 1000).cast("double").alias("b"))
    return setops.union_distinct(pick(t.customer, "c"), pick(t.supplier, "s"))


@query("select c_custkey, c_name from customer union all select c_custkey, 'old ' || c_name from customer")
def q_row_variants(t: Tables) -> DataFrame:
    return setops.with_variants(t.customer.select("c_custkey", "c_name"), [{"c_name": F.concat(F.lit("old "), "c_name")}])


@query("select distinct o_custkey as k from orders except select user_id from events")
def q_difference(t: Tables) -> DataFrame:
    return setops.difference(t.orders.select(F.col("o_custkey").alias("k")).distinct(), t.events.select(F.col("user_id").alias("k")), ["k"])


@query(r"""
select word, count(*) as n from (select unnest(regexp_extract_all(lower(text), '[a-z]+')) as word from documents) group by 1
""")
def q_unwind(t: Tables) -> DataFrame:
    """Words of all documents and how often they occur."""
    rows = t.documents.select(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]+)"), F.lit(1)).alias("words"))
    return arrays.unwind(rows, "words", "word").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("select cast(props ->> 'k' as bigint) as k, count(*) as n, round(sum(value), 4) as total from events group by 1")
def q_json_props(t: Tables) -> DataFrame:
    rows = t.events.withColumn("k", arrays.json_path(F.col("props"), "k").cast("long"))
    return rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("""
select o_orderkey, count(*) filter (l_returnflag = 'R') as returned_lines, count(distinct case when l_returnflag = 'N' then l_suppkey end) as n_suppliers,
  case when count(*) = 1 then '1' when count(*) <= 5 then '2-5' else '6+' end as size_class from orders join lineitem on l_orderkey = o_orderkey group by 1
""")
def q_array_counts(t: Tables) -> DataFrame:
    rows = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_returnflag", "l_suppkey")
    lists = aggregates.collate(rows, ["o_orderkey"], "lines", ["l_linenumber"])
    return lists.select("o_orderkey", F.size(F.filter("lines", lambda x: x["l_returnflag"] == "R")).cast("long").alias("returned_lines"), arrays.count_kinds(F.col("lines"), "l_returnflag", "N", "l_suppkey").cast("long").alias("n_suppliers"), arrays.bucket(F.size("lines")).alias("size_class"))


@query("""
select o_custkey, string_agg(cast(y as varchar), ',' order by y) as years from
(select o_custkey, unnest(generate_series(min(year(o_orderdate)), max(year(o_orderdate)))) as y from orders group by 1) group by 1
""")
def q_year_span(t: Tables) -> DataFrame:
    rows = t.orders.groupBy("o_custkey").agg(F.min(F.year("o_orderdate")).alias("a"), F.max(F.year("o_orderdate")).alias("b"))
    return rows.select("o_custkey", F.array_join(F.transform(arrays.year_span(F.col("a"), F.col("b")), lambda y: y.cast("string")), ",").alias("years"))


@query("""
select l_orderkey, string_agg(l_partkey || ':' || l_extendedprice, ',' order by l_extendedprice desc, l_partkey) as top from
(select *, row_number() over (partition by l_orderkey order by l_extendedprice desc, l_partkey) as r from lineitem) where r <= 2 group by 1
""")
def q_top_items(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_extendedprice")
    lists = aggregates.collate(rows, ["l_orderkey"], "lines", ["l_partkey"])
    top = arrays.top_items(F.col("lines"), "l_extendedprice", 2)
    return lists.select("l_orderkey", F.array_join(F.transform(top, lambda x: F.concat_ws(":", x["l_partkey"].cast("string"), x["l_extendedprice"].cast("string"))), ",").alias("top"))


# --- scalar functions -------------------------------------------------------------------------------------------


@query("""
select o_orderkey, substr(c, 3, 2) || '.' || substr(c, 5, 2) || '.' || substr(c, 7, 2) || '.' || substr(c, 9, 2) as dotted, substr(c, 1, 4) as office
from (select o_orderkey, '00' || lpad(cast(o_orderkey as varchar), 8, '0') as c from orders)
""")
def q_budget_code_dotted(t: Tables) -> DataFrame:
    c = F.concat(F.lit("00"), codes.pad_left(q("o_orderkey").cast("string"), 8))
    return t.orders.select("o_orderkey", codes.dotted(c).alias("dotted"), F.get(codes.levels(c), F.lit(0)).alias("office"))


@query("""
select c_custkey, string_agg(p, ' ' order by p) as prefixes from (select distinct c_custkey, unnest([substr(c, 1, 2), '00' || substr(c, 1, 2), substr(c, 1, 4), '00' || substr(c, 1, 4),
  substr(c, 1, 2) || '.' || substr(c, 3, 2)]) as p from (select c_custkey, lpad(cast(c_custkey % 10000 as varchar), 4, '0') as c from customer)) group by 1
""")
def q_prefixes(t: Tables) -> DataFrame:
    c = F.concat(F.lit("00"), codes.pad_left((q("c_custkey") % 10000).cast("string"), 4))
    return t.customer.select("c_custkey", F.array_join(codes.prefixes(c), " ").alias("prefixes"))


@query("select c_custkey, substr(md5('customer/' || c_custkey), 1, 12) as short_id, 'customer/' || c_custkey as doc_id from customer")
def q_short_doc_id(t: Tables) -> DataFrame:
    rows = t.customer.withColumn("doc_id", values.template("customer/{c_custkey}"))
    return rows.select("c_custkey", ids.short_id(F.col("doc_id")).alias("short_id"), "doc_id")


@query("select c_custkey, 300000000 + cast(('0x' || substr(md5(c_name || c_mktsegment), 1, 8)) as bigint) % 100000000 as publication_id from customer")
def q_publication_id(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", ids.publication_id(3, q("c_name"), q("c_mktsegment")).alias("publication_id"))


@query("""
with s as (select doc_id, text, unnest(range(0, 500)) as i from documents) select doc_id, count(*) as n_chunks, sum(length(substr(text, i * 1600 + 1, 2000))) as chars,
  min(length(substr(text, i * 1600 + 1, 2000))) as shortest from s where i * 1600 < length(text) group by 1
""")
def q_chunk_text(t: Tables) -> DataFrame:
    lengths = F.transform(text.chunks(F.col("text")), lambda x: F.length(x))
    return t.documents.select("doc_id", lengths.alias("l")).where(F.size("l") > 0).select("doc_id", F.size("l").cast("long").alias("n_chunks"), F.aggregate("l", F.lit(0).cast("long"), lambda a, x: a + x).alias("chars"), F.array_min("l").cast("long").alias("shortest"))


@query("""
select o_custkey, string_agg(strftime(m, '%Y-%m'), ',' order by m) as months from (select o_custkey, unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), interval 1 month)) as m
from orders where o_orderstatus = 'P' group by 1) group by 1
""")
def q_month_list(t: Tables) -> DataFrame:
    rows = t.orders.where("o_orderstatus = 'P'").groupBy("o_custkey").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    return rows.select("o_custkey", F.array_join(dates.month_list(F.col("a"), F.col("b")), ",").alias("months"))


@query("""
select distinct y + 10 as year, p as quarter, case p when 1 then make_date(y + 10, 5, 15) when 2 then make_date(y + 10, 8, 15) when 3 then make_date(y + 10, 11, 15) else make_date(y + 11, 2, 15) end as published,
  case p when 1 then make_date(y + 10, 3, 31) when 2 then make_date(y + 10, 6, 30) when 3 then make_date(y + 10, 9, 30) else make_date(y + 10, 12, 31) end as ended
from (select cast(year(o_orderdate) as integer) as y, cast(quarter(o_orderdate) as integer) as p from orders)
""")
def q_period_dates(t: Tables) -> DataFrame:
    rows = t.orders.select((F.year("o_orderdate") + 10).alias("year"), F.quarter("o_orderdate").alias("quarter")).distinct()
    return rows.select("year", "quarter", dates.period_date(F.col("year"), F.col("quarter")).alias("published"), dates.period_date(F.col("year"), F.col("quarter"), False).alias("ended"))


@query("""
select c_custkey, greatest(1.0, c_acctbal / 1000) as simple_score, round(greatest(1.0, c_acctbal / 1000) / pow(2, (greatest(1, 1998 - (1990 + c_custkey % 9)) - 1) / 3.0), 10) as budget_score,
  greatest(1.0, 30 - date_diff('day', date '1997-06-01', date '1998-12-01') / 365.0) as age_score from customer
""")
def q_scores(t: Tables) -> DataFrame:
    year = F.lit(1990) + q("c_custkey") % 9
    return t.customer.select("c_custkey", scores.amount_score(q("c_acctbal")).alias("simple_score"), F.round(scores.budget_score(q("c_acctbal"), F.lit("0020"), year, 1998), 10).alias("budget_score"), scores.age_score(F.lit("1997-06-01").cast("date"), F.lit(AS_OF)).alias("age_score"))


@query("""
with d as (select c_custkey, lpad(cast(c_custkey * 7919 % 1000000000 as varchar), 9, '0') as i from customer)
select c_custkey, i as id, substr(i, 1, 1) <> '5' and list_sum(list_transform(range(1, 10), lambda k: case when k % 2 = 1 then cast(substr(i, 10 - k, 1) as integer)
  else cast(substr(i, 10 - k, 1) as integer) * 2 // 10 + cast(substr(i, 10 - k, 1) as integer) * 2 % 10 end)) % 10 = 0 as valid from d
""")
def q_id_check_digit(t: Tables) -> DataFrame:
    ident = codes.pad_left((q("c_custkey") * 7919 % 1000000000).cast("string"), 9)
    return t.customer.select("c_custkey", ident.alias("id"), ids.israeli_id(ident).alias("valid"))


@query(r"""
select page_id, length(regexp_replace(html, '<[^>]*>', '', 'g')) as bare_chars, length(regexp_replace(regexp_replace(html, '<(script|style)\b[^>]*>.*?</(script|style)>|<!--.*?-->', '', 'gs'), '<[^>]*>', '', 'g')) as visible_chars from pages
""")
def q_html_text(t: Tables) -> DataFrame:
    """Characters outside tags, and outside scripts, styles and comments."""
    strip = lambda c: F.regexp_replace(c, "<[^>]*>", "")
    visible = F.regexp_replace("html", r"(?s)<(script|style)\b[^>]*>.*?</(script|style)>|<!--.*?-->", "")
    return t.pages.select("page_id", F.length(strip(F.col("html"))).cast("long").alias("bare_chars"), F.length(strip(visible)).cast("long").alias("visible_chars"))


@query("""
select event_id, strftime(ts, '%Y-%m-%d') as day, case when value < 1000 then printf('%,.2f', value) else printf('%,.0f', round(value)) end || ' ₪' as amount,
  substr(md5(event_type || '|' || user_id), 1, 8) as h8 from events
""")
def q_text_formats(t: Tables) -> DataFrame:
    return t.events.select("event_id", values.template("{ts:%Y-%m-%d}").alias("day"), text.format_money(F.col("value")).alias("amount"), ids.short_id(F.concat_ws("|", "event_type", F.col("user_id").cast("string")), 8).alias("h8"))


@query(r"""
select page_id, regexp_extract(url, '^[a-z]+://([^/]*)', 1) as host, coalesce(nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), ''), 'none') as page_no,
  nullif(split_part(regexp_extract(url, '^[a-z]+://[^/]*/?([^?#]*)', 1), '/', 1), '') as lang from pages
""")
def q_url_parts(t: Tables) -> DataFrame:
    u = F.col("url")
    return t.pages.select("page_id", F.regexp_extract(u, "^[a-z]+://([^/]*)", 1).alias("host"), F.coalesce(text.query_parameter(u, "page"), F.lit("none")).alias("page_no"), text.path_piece(u, 0).alias("lang"))


@query("""
select c_custkey, case when s = '' then null else s end as squeezed, list_extract(string_split('a:b:' || c_custkey, ':'), 1) as head, substr('a:b:' || c_custkey, 3) as tail,
  array_to_string(list_filter([c_mktsegment, '', c_name], lambda x: x <> ''), ' | ') as joined from (select *, regexp_replace(trim('  ' || c_name || '   x '), '\\s+', ' ', 'g') as s from customer)
""".replace("\\\\", "\\"))
def q_text_cleaning(t: Tables) -> DataFrame:
    head, tail = text.split_once(F.concat(F.lit("a:b:"), q("c_custkey").cast("string")))
    return t.customer.select("c_custkey", text.squeeze(F.concat(F.lit("  "), "c_name", F.lit("   x "))).alias("squeezed"), head.alias("head"), tail.alias("tail"), text.join_filled(" | ", q("c_mktsegment"), F.lit(""), q("c_name")).alias("joined"))


@query("""
select o_orderkey, cast(o_orderdate as date) as by_slashes, date '1900-01-01' + cast(o_orderkey % 40000 as integer) as by_serial, cast(null as date) as by_junk from orders
""")
def q_loose_dates(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", dates.loose_date(F.date_format("o_orderdate", "d/M/yyyy")).alias("by_slashes"), dates.loose_date((q("o_orderkey") % 40000).cast("string")).alias("by_serial"), dates.loose_date(F.lit("soon")).alias("by_junk"))


# --- state, domain plans, algorithms ----------------------------------------------------------------------------


@query("select c_custkey, md5(concat_ws('|', c_acctbal, c_mktsegment, c_name, c_nationkey)) as hash from (select c_custkey, cast(cast(round(c_acctbal) as bigint) as varchar) as c_acctbal, c_mktsegment, c_name, cast(c_nationkey as varchar) as c_nationkey from customer)")
def q_revisions_hash(t: Tables) -> DataFrame:
    rows = t.customer.withColumn("c_acctbal", F.round("c_acctbal").cast("long"))
    return rows.select("c_custkey", row_hash(rows, ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]).alias("hash"))


@query("""
select c_custkey, c_mktsegment = 'BUILDING' as is_new, c_mktsegment = 'BUILDING' or 10 > least(c_nationkey, 90) as is_stale,
  case when c_mktsegment = 'BUILDING' then 1 when c_mktsegment = 'MACHINERY' then 12 else 1 end as next_update_days,
  case when c_mktsegment = 'BUILDING' then 100000 else cast(floor(100000 + 100000.0 / (1 + greatest(1, 10 - c_nationkey))) as integer) end as staleness from customer
""")
def q_manage_revisions(t: Tables) -> DataFrame:
    """A second run, ten days on: a segment is new, one is the same, the rest changed."""
    now, before = dt.datetime(1998, 12, 11), dt.datetime(1998, 12, 1)
    rows = t.customer.select("c_custkey", "c_name")
    known = t.customer.where("c_mktsegment <> 'BUILDING'")
    old = known.select("c_custkey", F.when(q("c_mktsegment") == "MACHINERY", q("c_name")).otherwise("old").alias("c_name"))
    old = manage_revisions(old, None, ["c_custkey"], before).drop("__next_update_days").join(known.select("c_custkey", q("c_nationkey").alias("__next_update_days")), "c_custkey")
    out = manage_revisions(rows, old, ["c_custkey"], now)
    return out.select("c_custkey", F.col("__is_new").alias("is_new"), F.col("__is_stale").alias("is_stale"), F.col("__next_update_days").alias("next_update_days"), F.col("__staleness").alias("staleness"))


@query("""
select c_custkey, case when c_acctbal < 0 then 'DEBT' else c_mktsegment end as c_mktsegment from customer
""")
def q_upsert(t: Tables) -> DataFrame:
    old = t.customer.select("c_custkey", "c_mktsegment")
    return upsert(old, t.customer.where("c_acctbal < 0").select("c_custkey", F.lit("DEBT").alias("c_mktsegment")), ["c_custkey"])


@query("""
select o_custkey, s as o_orderstatus, date '1998-12-01' as __updated from (select o_custkey, arg_max(o_orderstatus, o_orderkey) as s from orders group by 1)
where s is distinct from (select 'F' from customer where c_custkey = o_custkey and c_acctbal > 0)
""")
def q_history_updates(t: Tables) -> DataFrame:
    stored = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), F.lit("F").alias("o_orderstatus"), F.lit(dt.date(1998, 1, 1)).alias("__updated"))
    return history_updates(t.orders, stored, ["o_custkey"], ["o_orderstatus"], AS_OF, ["o_orderkey"])


@query("""
with v as (select l_suppkey as k, cast(l_orderkey * 10 + l_linenumber as bigint) as i, cast(l_quantity as bigint) * (case when l_linenumber % 2 = 0 then 1 else -1 end) as a from lineitem),
r as (select *, row_number() over (partition by k, abs(a), a > 0 order by i) as n from v)
select x.k, x.i as credit, y.i as debit, x.a as size from r x join r y on x.k = y.k and x.a = -y.a and x.n = y.n and x.a > 0
""")
def q_zero_sum_pairs(t: Tables) -> DataFrame:
    rows = t.lineitem.select(F.col("l_suppkey").alias("k"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long").alias("i"), (F.col("l_quantity").cast("long") * F.when(F.col("l_linenumber") % 2 == 0, 1).otherwise(-1)).alias("a"))
    return changes.zero_sum_pairs(rows, ["k"], "i", "a").select("k", "credit", "debit", "size")


@query("""
with r as (select p_brand as a, p_type as b, p_size % 2 as y, cast(round(p_retailprice * 100) as bigint) as v from part)
select 1 as depth, a as code, null as parent, sum(case when y = 0 then v end) as planned, sum(case when y = 1 then v end) as actual from r group by a
union all select 2, b, a, sum(case when y = 0 then v end), sum(case when y = 1 then v end) from r group by a, b
""")
def q_municipal_rollup(t: Tables) -> DataFrame:
    """Two levels of a budget whose phases stand in columns."""
    raw = t.part.groupBy(F.col("p_brand").alias("a"), F.col("p_type").alias("b"), (F.col("p_size") % 2).alias("phase")).agg(F.sum(F.round(F.col("p_retailprice") * 100).cast("long")).alias("value"))
    out = budget.municipal_rollup(raw, [], [("a", "a"), ("b", "b")], {0: "planned", 1: "actual"})
    return out.select("depth", "code", "parent", "planned", "actual")


@query("""
select year, code, max(n) as n_children, max(net) as children_net from (select year(o_orderdate) as year, o_orderstatus as code, count(distinct o_orderpriority) as n, sum(cast(floor(o_totalprice) as bigint)) as net from orders group by 1, 2) group by 1, 2
""")
def q_budget_children(t: Tables) -> DataFrame:
    base = t.orders.select(F.year("o_orderdate").alias("year"), "o_orderstatus", "o_orderpriority", F.floor("o_totalprice").cast("long").alias("v"))
    leaves = base.groupBy("year", F.concat_ws("", "o_orderstatus", "o_orderpriority").alias("code"), F.col("o_orderstatus").alias("parent")).agg(F.sum("v").alias("net_allocated"))
    tops = base.groupBy("year", F.col("o_orderstatus").alias("code")).agg(F.sum("v").alias("net_allocated")).withColumn("parent", F.lit(None).cast("string"))
    rows = leaves.unionByName(tops).withColumn("title", F.col("code")).withColumn("net_revised", F.lit(None).cast("long"))
    out = budget.with_children(rows).where(F.size("children") > 0)
    return out.select("year", "code", F.size("children").cast("long").alias("n_children"), F.aggregate("children", F.lit(0).cast("long"), lambda a, c: a + c["net_revised"]).alias("children_net")).withColumn("year", F.col("year").cast("long"))


@query()
def q_fingerprint(t: Tables) -> DataFrame:
    names = setops.concatenate([t.customer.select(F.col("c_name").alias("name")), t.supplier.select(F.col("s_name").alias("name")), t.part.select(F.col("p_name").alias("name"))], {"name": None}).distinct()
    return names.withColumn("fingerprint", fingerprint_udf("name"))


@query()
def q_clusters(t: Tables) -> DataFrame:
    """Similar part types of each brand, by what they cost."""
    rows = t.part.select("p_brand", F.col("p_type").alias("title"), F.col("p_retailprice").alias("amount"))
    return clusters.spending_clusters(rows, ["p_brand"]).withColumn("amount", money(F.col("amount")))


@query()
def q_connections(t: Tables) -> DataFrame:
    """Items of successive years that continue each other."""
    rows = t.orders.groupBy(F.year("o_orderdate").alias("year"), F.concat_ws("", F.lit("00"), F.substring("o_orderpriority", 1, 1), "o_orderstatus").alias("code")).agg(F.min("o_orderpriority").alias("title"), F.sum("o_totalprice").alias("net_allocated"))
    return budget.connect_years(rows.withColumn("parent", F.lit(None).cast("string")), measures=["net_allocated"])


@query()
def q_change_groups(t: Tables) -> DataFrame:
    """Transfers of the reserve in a supplier's month that balance."""
    rows = t.lineitem.select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("trcode"), F.concat_ws("/", "l_suppkey", F.date_format("l_shipdate", "yyyy-MM")).alias("date_kind"), (q("l_partkey") % 40).alias("leading_item"), (F.col("l_quantity").cast("long") % 5 * F.when(F.col("l_linenumber") % 2 == 0, 1).otherwise(-1)).alias("net_expense_diff"))
    both = rows.withColumn("budget_code", F.explode(F.array(F.lit("0047010101"), F.lit("0020010101"))))
    return changes.change_groups(both, ["net_expense_diff"])


@query()
def q_similarity(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", "p_name", "p_type")
    return rows.withColumn("score", similarity("partial")("p_name", "p_type"))




# --- plans on the star schema -----------------------------------------------------------------------------------


@query("""
with r as (select o_orderpriority as p, o_custkey as e, year(o_orderdate) as y, cast(floor(o_totalprice) as bigint) as a, case when o_orderstatus = 'F' then cast(floor(o_totalprice) as bigint) else 0 end as d from orders),
ey as (select p, e, y, sum(a) as a, sum(d) as d from r group by 1, 2, 3), e as (select p, e, avg(d / nullif(a, 0)) as u from ey group by 1, 2)
select r.p as program_key, sum(a) as total_approved, sum(d) as total_paid, min(y) as min_year, max(y) as max_year, max(y) - min(y) + 1 as year_span,
  (select count(*) from e where e.p = r.p) as total_entities, round((select avg(u) from e where e.p = r.p), 8) as average_use from r group by 1
""")
def q_support_programs(t: Tables) -> DataFrame:
    """Programs with what was approved and paid, and how recipients used it."""
    v = F.floor("o_totalprice").cast("double")
    rows = t.orders.select(F.col("o_orderpriority").alias("program_key"), F.col("o_orderstatus").alias("support_title"), F.year("o_orderdate").alias("year_requested"), F.lit("m").alias("supporting_ministry"), F.lit("r").alias("request_type"), F.col("o_custkey").cast("string").alias("entity_id"), F.lit("n").alias("entity_name"), F.lit(None).cast("string").alias("entity_kind"), v.alias("amount_approved"), F.when(F.col("o_orderstatus") == "F", v).otherwise(0.0).alias("amount_paid"))
    out = supports.analyse_programs(rows)
    return out.select("program_key", "total_approved", "total_paid", F.col("min_year").cast("long").alias("min_year"), F.col("max_year").cast("long").alias("max_year"), F.col("year_span").cast("long").alias("year_span"), "total_entities", F.round("average_use", 8).alias("average_use"))


@query("""
select 'contract' as spending_type, o_custkey as entity, o_totalprice as amount, year(o_orderdate) as year from orders where o_totalprice <> 0
union all select 'support', user_id, value, year(ts) from events where value <> 0
""")
def q_united_spending(t: Tables) -> DataFrame:
    a = t.orders.select("o_custkey", "o_totalprice", F.year("o_orderdate").alias("order_year"))
    b = t.events.select("user_id", "value", F.year("ts").alias("event_year"))
    return contracts.united_spending(a, b, {"entity": ["o_custkey"], "amount": ["o_totalprice"], "year": ["order_year"]}, {"entity": ["user_id"], "amount": ["value"], "year": ["event_year"]}).select("spending_type", "entity", "amount", "year")


@query("""
with r as (select cast(c_custkey as varchar) as id, c_name as name, 'customer' as kind, 0 as p from customer where c_name is not null union all select cast(s_suppkey as varchar), s_name, 'supplier', 1 from supplier)
select id, max(name) as name, arg_min(kind, p) as kind, count(*) as registries from r group by 1
""")
def q_consolidate_entities(t: Tables) -> DataFrame:
    """Registries brought together: the first one's kind, the greatest name."""
    a = arrays.compact_entity(t.customer.select("c_custkey", "c_name", "c_mktsegment"), "customer", "לקוח", "c_custkey", "c_name", "c_")
    b = arrays.compact_entity(t.supplier.select("s_suppkey", "s_name", "s_acctbal"), "supplier", "ספק", "s_suppkey", "s_name", "s_")
    out = entities.consolidate([a, b])
    return out.select("id", "name", "kind", F.size("details").cast("long").alias("registries"))


@query("""
with k as (select o_orderkey as i, '00' || lpad(cast(o_orderkey % 100000000 as varchar), 8, '0') as c, cast(floor(o_totalprice) as bigint) as v from orders where o_orderkey % 100000000 >= 1000000 and o_orderkey % 100000000 < 84000000
  union all select o_orderkey, '0001' || lpad(cast(o_orderkey % 1000000 as varchar), 6, '0'), cast(floor(o_totalprice) as bigint) from orders where o_orderkey % 100000000 < 1000000)
select code, sum(v) as net_allocated, max(depth) as depth from (
  select substr(c, 1, 4) as code, v, 1 as depth from k union all select substr(c, 1, 6), v, 2 from k union all select substr(c, 1, 8), v, 3 from k union all select c, v, 4 from k
  union all select '00', v, 0 from k union all select 'C' || (i % 7 + 1), v, -2 from k union all select 'C' || (i % 7 + 1) || '0' || (i % 5), v, -1 from k) group by 1
""")
def q_budget_hierarchy(t: Tables) -> DataFrame:
    """Budget lines counted in each of their levels, the state and the functional categories."""
    n = F.when(F.col("o_orderkey") % 100000000 >= 1000000, codes.pad_left((F.col("o_orderkey") % 100000000).cast("string"), 8)).otherwise(F.concat(F.lit("01"), codes.pad_left((F.col("o_orderkey") % 1000000).cast("string"), 6)))
    raw = t.orders.select(F.lit(2020).alias("year"), F.lit("מקורי").alias("phase"), n.alias("c"), (F.col("o_orderkey") % 7 + 1).cast("string").alias("func_cls_code_1"), (F.col("o_orderkey") % 5).cast("string").alias("func_cls_code_2"), F.lit("f").alias("func_cls_title_1"), F.lit("g").alias("func_cls_title_2"), F.lit("1").alias("econ_cls_code_2"), F.floor("o_totalprice").cast("decimal(38,6)").alias("net"))
    raw = raw.where(F.col("c") < "84").select("*", *[x for i in (2, 4, 6, 8) for x in (F.substring("c", 1, i).alias(f"admin_cls_code_{i}"), F.lit("t").alias(f"admin_cls_title_{i}"))])
    out = budget.rolled_up(budget.hierarchy_rows(raw, ["net"], 2023), ["net"])
    return out.select("code", F.col("net_allocated").cast("long").alias("net_allocated"), F.col("depth").cast("long").alias("depth"))


@query("""
select n_name as source, case when r <= 3 then c_mktsegment else 'others' end as target, round(sum(v), 2) as value
from (select n_name, c_mktsegment, v, row_number() over (partition by n_name order by v desc, c_mktsegment) as r from (select n_name, c_mktsegment, sum(c_acctbal) as v from customer join nation on n_nationkey = c_nationkey group by 1, 2)) group by 1, 2
""")
def q_sankey(t: Tables) -> DataFrame:
    rows = t.customer.join(t.nation, q("n_nationkey") == q("c_nationkey")).select("n_name", "c_mktsegment", "c_acctbal")
    return reports.sankey(rows, "n_name", "c_mktsegment", "c_acctbal", 3, "others").withColumn("value", money(F.col("value")))


@query("""
select c_custkey, round(avg(c_acctbal) over (partition by c_mktsegment), 6) as mean, rank() over (partition by c_mktsegment order by c_acctbal desc) as rank, count(*) over (partition by c_mktsegment) as "of" from customer
""")
def q_comparison(t: Tables) -> DataFrame:
    out = charts.comparison(t.customer, "c_custkey", "c_acctbal", ["c_mktsegment"])
    return out.select("c_custkey", F.round("comparison.mean", 6).alias("mean"), F.col("comparison.rank").cast("long").alias("rank"), F.col("comparison.of").alias("of"))


@query("""
select coalesce(a.y, b.y, c.y) as year, n_orders, n_ships, n_events from (select year(o_orderdate) as y, count(*) as n_orders from orders group by 1) a
full join (select year(l_shipdate) as y, count(*) as n_ships from lineitem group by 1) b on a.y = b.y full join (select year(ts) as y, count(*) as n_events from events group by 1) c on c.y = coalesce(a.y, b.y)
""")
def q_service_report(t: Tables) -> DataFrame:
    """Three yearly tables side by side."""
    count = lambda df, day, name: df.groupBy(F.year(day).alias("year")).agg(F.count(F.lit(1)).alias(name))
    return reports.service_report(count(t.orders, "o_orderdate", "n_orders"), count(t.lineitem, "l_shipdate", "n_ships"), count(t.events, "ts", "n_events"), ["year"])


@query("""
with s as (select 'all' as kind, o_custkey, sum(o_totalprice) as amount from orders group by 2 union all select 'finished', o_custkey, sum(o_totalprice) from orders where o_orderstatus = 'F' group by 2)
select kind, c_mktsegment, c_custkey as id, round(amount, 2) as amount, r as rank from (select *, rank() over (partition by kind, c_mktsegment order by amount desc) as r from s join customer on c_custkey = o_custkey) where r <= 2
""")
def q_received_ranks(t: Tables) -> DataFrame:
    orgs = t.customer.select(F.col("c_custkey").alias("id"), "c_mktsegment")
    spending = t.orders.select(F.col("o_custkey").alias("entity_id"), F.col("o_totalprice").alias("amount"), "o_orderstatus")
    out = reports.received_ranks(orgs, spending, {"all": F.lit(True), "finished": F.col("o_orderstatus") == "F"}, "c_mktsegment", 2)
    return out.select("kind", "c_mktsegment", "id", money(F.col("amount")).alias("amount"), F.col("rank").cast("long").alias("rank"))


@query("""
select year, total, round(total / n, 6) as total_people from (select year(o_orderdate) as year, cast(sum(floor(o_totalprice)) as bigint) as total, count(distinct o_custkey) as n from orders group by 1)
""")
def q_normalised_series(t: Tables) -> DataFrame:
    """A yearly sum over a reference series."""
    totals = t.orders.groupBy(F.year("o_orderdate").alias("year")).agg(F.sum(F.floor("o_totalprice").cast("long")).alias("total"))
    people = t.orders.groupBy(F.year("o_orderdate").alias("year")).agg(F.count_distinct("o_custkey").alias("value"))
    return reports.normalised_series(totals, "year", "total", {"people": people}).withColumn("total_people", F.round("total_people", 6))


@query("""
with m as (select p_brand as doc_id, p_partkey as code, 1995 as year, p_size as part from part where p_size > 40), r as (select l_partkey as code, year(l_shipdate) as year, cast(sum(floor(l_extendedprice)) as bigint) as net from lineitem group by 1, 2)
select m.doc_id, r.year, round(sum(r.net * m.part / 100.0), 4) as net_revised from m join r t on t.code = m.code and t.year = m.year join r on r.code = m.code where r.net > 0 group by 1, 2
""")
def q_mapped_budget(t: Tables) -> DataFrame:
    """Each service's share of the budget items mapped to it, over all years of the items."""
    mappings = t.part.where("p_size > 40").select(F.col("p_brand").alias("doc_id"), F.col("p_partkey").alias("code"), F.lit(1995).alias("year"), F.col("p_size").alias("part"))
    raw = t.lineitem.groupBy(F.col("l_partkey").alias("code"), F.year("l_shipdate").alias("year")).agg(F.sum(F.floor("l_extendedprice").cast("long")).alias("net_revised")).withColumn("title", F.lit("t"))
    out = activities.mapped_budget(mappings, raw, ["net_revised"])
    return out.withColumn("net_revised", F.round("net_revised", 4))


@query("""
with s as (select s_suppkey, s_nationkey from supplier) select n_nationkey, min(s_suppkey) as s_suppkey from nation join s on s_nationkey = n_nationkey group by 1 having count(*) = 1
""")
def q_sole_in_region(t: Tables) -> DataFrame:
    rows = t.supplier.join(t.nation, q("n_nationkey") == q("s_nationkey")).select("n_nationkey", "s_suppkey")
    return reports.sole_in(rows, ["n_nationkey"], "s_suppkey")


@query("""
select l_suppkey, string_agg(cast(l_quantity as varchar) || '@' || strftime(d, '%Y-%m-%d'), ',' order by d) as payments from
(select l_suppkey, cast(sum(l_quantity) as bigint) as l_quantity, date_trunc('year', l_shipdate) as d from lineitem group by 1, 3) group by 1
""")
def q_collated_payments(t: Tables) -> DataFrame:
    rows = t.lineitem.groupBy("l_suppkey", F.trunc("l_shipdate", "year").alias("d")).agg(F.sum("l_quantity").cast("long").alias("n"))
    out = supports.payments(rows, ["l_suppkey"], ["d", "n"])
    return out.select("l_suppkey", F.array_join(F.transform("payments", lambda p: F.concat(p["n"].cast("string"), F.lit("@"), F.date_format(p["d"], "yyyy-MM-dd"))), ",").alias("payments"))


@query("""
select distinct o_custkey, year(o_orderdate) as year, y.latest from orders join (select o_custkey as k, max(year(o_orderdate)) as latest from orders group by 1) y on y.k = o_custkey
""")
def q_latest_with_history(t: Tables) -> DataFrame:
    """Each customer's years, by way of the history map of its latest row."""
    yearly = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(F.sum("o_totalprice").alias("total"))
    out = budget.with_history(yearly, ["o_custkey"], ["total"])
    return out.select("o_custkey", F.explode(F.map_keys("history")).alias("year"), F.col("year").alias("latest"))


@query("""
select 'customer/' || c_custkey as key, cast(7 as integer) as __revision, '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}' as value from customer
""")
def q_key_value_documents(t: Tables) -> DataFrame:
    return arrays.keyed_document(t.customer.select("c_custkey", "c_name"), values.template("customer/{c_custkey}"), 7)


@query("""
select c_custkey, regexp_replace(c_phone, '^(...)(...)(....)$', '\\1-\\2-\\3') as phone, c_custkey % 2 = 0 as flag from (select *, '05' || lpad(cast(c_custkey % 100000000 as varchar), 8, '0') as c_phone from customer)
""".replace("\\\\", "\\"))
def q_phones_and_flags(t: Tables) -> DataFrame:
    raw = F.concat(F.lit("+9725"), codes.pad_left((F.col("c_custkey") % 100000000).cast("string"), 8))
    word = F.when(F.col("c_custkey") % 2 == 0, "כן").otherwise("לא")
    return t.customer.select("c_custkey", text.phone(raw).alias("phone"), values.to_boolean(word, ["כן"], ["לא"]).alias("flag"))


@query("""
with p as (select *, 'parts/' || p_partkey as doc, md5(concat_ws('|', '-1057', p_brand, p_name, cast(p_retailprice as varchar), cast(p_size as varchar), p_type)) as h, '1998-12-01T00:00:00' as t from part)
select doc as key, '{"p_partkey":' || p_partkey || ',"p_name":"' || p_name || '","p_brand":"' || p_brand || '","p_type":"' || p_type || '","p_size":' || p_size || ',"p_retailprice":' || p_retailprice
  || ',"__revision":-1057,"__last_updated_at":"' || t || '","__last_modified_at":"' || t || '","__created_at":"' || t || '","__is_new":true,"__is_stale":true,"__staleness":100000,"__next_update_days":1,"__hash":"' || h
  || '","rev_last_updated_at":"1998-12-01","rev_last_modified_at":"1998-12-01","rev_created_at":"1998-12-01","doc_id":"' || doc || '","page_title":"' || p_name || ' (' || p_brand
  || ')","__date_range_from":"1900-01-01","__date_range_to":"2100-01-01","__date_range_months":[]}' as value, -1057 as __revision from p
union all select substr(md5(doc), 1, 12), '{"kind":"redirect","to":"' || doc || '"}', -1057 from p
""")
def q_index_documents(t: Tables) -> DataFrame:
    """A first run of the indexer over parts."""
    doc = indexer.DocType("parts", ["p_partkey"], "{p_name} ({p_brand})", chunk="p_type")
    return indexer.index(t.part, doc, None, dt.datetime(1998, 12, 1)).documents


@query("""
with n as (select c_custkey, md5(cast(c_custkey as varchar)) as h from customer), p as (select *, (row_number() over (order by h) - 1) // 500 as page from n)
select page, '<?xml version="1.0" encoding="UTF-8"?>' || chr(10) || '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">' || chr(10)
  || string_agg('<url><loc>https://example.org/customer/' || c_custkey || '</loc><lastmod>2021-01-01</lastmod></url>', chr(10) order by h) || chr(10) || '</urlset>' as xml from p group by 1
""")
def q_sitemap(t: Tables) -> DataFrame:
    from .sinks.writers import sitemap

    rows = t.customer.select(F.md5(q("c_custkey").cast("string")).alias("h"), values.template("https://example.org/customer/{c_custkey}").alias("url"), F.lit(AS_OF).alias("day"))
    return sitemap(rows, "url", "day", ["h"], 500)


def _grid_sql() -> str:
    """The inverse series and the shift of geo.grid_to_degrees, step by step."""
    from .functions import geo

    a, f = geo.A, geo.FLATTENING
    e2 = f * (2 - f)
    ep2, e1 = e2 / (1 - e2), (1 - (1 - e2) ** 0.5) / (1 + (1 - e2) ** 0.5)
    k0 = math.radians(geo.LAT0)
    m0 = a * ((1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * k0 - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * math.sin(2 * k0) + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * math.sin(4 * k0) - 35 * e2**3 / 3072 * math.sin(6 * k0))
    v = lambda x: f"cast('{x!r}' as double)"
    dx, dy, dz = geo.SHIFT
    return f"""
with g as (select c_custkey, 180000.0::double + c_custkey % 1000 * 10 as x, 650000.0::double + c_custkey % 777 * 10 as y from customer),
m as (select *, ({v(m0)} + (y - {v(geo.Y0)}) / {v(geo.SCALE)}) / {v(a * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256))} as mu from g),
p as (select *, mu + {v(3 * e1 / 2 - 27 * e1**3 / 32)} * sin(2 * mu) + {v(21 * e1**2 / 16 - 55 * e1**4 / 32)} * sin(4 * mu) + {v(151 * e1**3 / 96)} * sin(6 * mu) as p from m),
q as (select *, {v(ep2)} * cos(p) ^ 2 as c, tan(p) ^ 2 as t, {v(a)} / sqrt(1 - {v(e2)} * sin(p) ^ 2) as n, {v(a * (1 - e2))} / (1 - {v(e2)} * sin(p) ^ 2) ^ 1.5 as r from p),
d as (select *, (x - {v(geo.X0)}) / (n * {v(geo.SCALE)}) as d from q),
l as (select c_custkey, p - (n * tan(p) / r) * (d ^ 2 / 2 - (5 + 3 * t + 10 * c - 4 * c ^ 2 - {v(9 * ep2)}) * d ^ 4 / 24 + (61 + 90 * t + 298 * c + 45 * t ^ 2) * d ^ 6 / 720) as la,
  {v(math.radians(geo.LON0))} + (d - (1 + 2 * t + c) * d ^ 3 / 6 + (5 - 2 * c + 28 * t - 3 * c ^ 2 + {v(8 * ep2)} + 24 * t ^ 2) * d ^ 5 / 120) / cos(p) as lo from d),
s as (select *, {v(a)} / sqrt(1 - {v(e2)} * sin(la) ^ 2) as n from l),
w as (select c_custkey, n * cos(la) * cos(lo) + ({dx}) as x, n * cos(la) * sin(lo) + ({dy}) as y, n * {v(1 - e2)} * sin(la) + ({dz}) as z from s),
h as (select *, sqrt(x * x + y * y) as flat from w), u as (select *, atan2(z * {v(a)}, flat * {v(a * (1 - f))}) as theta from h)
select c_custkey, round(degrees(atan2(z + {v(ep2 * a * (1 - f))} * sin(theta) ^ 3, flat - {v(e2 * a)} * cos(theta) ^ 3)), 8) as lat, round(degrees(atan2(y, x)), 8) as lon from u
"""


@query(_grid_sql())
def q_grid_to_degrees(t: Tables) -> DataFrame:
    lat, lon = grid_to_degrees(F.lit(180000.0) + q("c_custkey") % 1000 * 10, F.lit(650000.0) + q("c_custkey") % 777 * 10)
    return t.customer.select("c_custkey", F.round(lat, 8).alias("lat"), F.round(lon, 8).alias("lon"))


#: Where DuckDB's types are wider than Spark's.
CASTS = {
    "q_received_by_entity": {"min_year": "integer", "max_year": "integer"},
    "q_full_outer_years": {"year": "integer"},
    "q_top4_others": {"n": "bigint"},
    "q_gaps_filled": {"v": "bigint"},
    "q_chunk_text": {"chars": "bigint"},
    "q_municipal_rollup": {"planned": "bigint", "actual": "bigint"},
    "q_budget_children": {"children_net": "bigint"},
    "q_support_programs": {"total_approved": "double", "total_paid": "double"},
    "q_united_spending": {"year": "integer"},
    "q_budget_hierarchy": {"net_allocated": "bigint", "depth": "bigint"},
    "q_service_report": {"year": "integer"},
    "q_normalised_series": {"year": "integer"},
    "q_mapped_budget": {"year": "integer"},
    "q_latest_with_history": {"year": "integer", "latest": "integer"},
}
for _name, _casts in CASTS.items():
    SQL[_name] = f"select * replace ({', '.join(f'cast({c} as {k}) as {c}' for c, k in _casts.items())}) from ({SQL[_name]})"

from . import more_queries  # noqa: E402,F401  (registers its queries beside these)
