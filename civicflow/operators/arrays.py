"""Array, map and JSON operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..state.lineage import cut
from .project import q


def unwind(df: DataFrame, array: str, name: str, keep_empty: bool = False) -> DataFrame:
    """A row for each item; rows without items go unless keep_empty; the array column goes."""
    items = (F.explode_outer if keep_empty else F.explode)(q(array)).alias("__item")
    rest = [q(c) for c in df.columns if c not in (array, name)]
    return df.select(*rest, items).withColumnRenamed("__item", name)


def unwind_struct(df: DataFrame, array: str, prefix: str = "") -> DataFrame:
    """unwind for structs, whose fields become columns, over columns of the same name."""
    fields = df.schema[array].dataType.elementType.names
    rest = [c for c in df.columns if c != array and c not in {prefix + f for f in fields}]
    items = df.select(*map(q, rest), F.explode(q(array)).alias("__item"))
    return items.select(*map(q, rest), *[F.col("__item")[f].alias(prefix + f) for f in fields])


def unwind_parallel(df: DataFrame, table: str, columns: Sequence[str], keep_empty: bool = False) -> DataFrame:
    """Arrays in a map as rows, item by item; shorter arrays give ''."""
    arrays = [F.coalesce(F.try_element_at(q(table), F.lit(c)), F.array().cast("array<string>")) for c in columns]
    longest = F.greatest(*map(F.size, arrays)) if len(arrays) > 1 else F.size(arrays[0])
    places = F.when(longest > 0, F.sequence(F.lit(0), longest - 1)).otherwise(F.array().cast("array<int>"))
    rows = F.transform(places, lambda i: F.struct(*[F.coalesce(F.get(a, i), F.lit("")).alias(c) for a, c in zip(arrays, columns)]))
    rest = [q(c) for c in df.columns if c != table]
    exploded = df.select(*rest, (F.explode_outer if keep_empty else F.explode)(rows).alias("__item"))
    return exploded.select(*[q(c) for c in df.columns if c != table], *[F.col("__item")[c].alias(c) for c in columns])


def nested(names: Sequence[str], df: DataFrame) -> Column:
    """A struct of columns as documents hold them: decimals as doubles, dates as ISO text."""
    kinds = dict(df.dtypes)

    def plain(c: str) -> Column:
        if kinds[c].startswith("decimal"):
            return q(c).cast("double").alias(c)
        if kinds[c] in ("date", "timestamp", "timestamp_ntz"):
            return F.date_format(q(c), "yyyy-MM-dd" if kinds[c] == "date" else "yyyy-MM-dd'T'HH:mm:ss").alias(c)
        return q(c)

    return F.struct(*map(plain, names))


def compact_entity(df: DataFrame, kind: str, kind_title: str, ident: str, name: str, prefix: str, name_en: str | None = None) -> DataFrame:
    """id, name, name_en, kind, kind_he and details: the other columns, without their prefix, as text; rows lacking id or name go."""
    rest = [c for c in df.columns if c not in (ident, name, name_en)]
    pairs = [x for c in rest for x in (F.lit(c.removeprefix(prefix)), q(c).cast("string"))]
    details = F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull()) if pairs else F.create_map().cast("map<string,string>")
    picked = df.select(q(ident).cast("string").alias("id"), q(name).alias("name"), (q(name_en) if name_en else F.lit(None)).cast("string").alias("name_en"), F.lit(kind).alias("kind"), F.lit(kind_title).alias("kind_he"), details.alias("details"))
    return picked.where(F.col("id").isNotNull() & (F.col("id") != "") & F.col("name").isNotNull() & (F.col("name") != ""))


def zip_rows(*arrays: tuple[str, Column]) -> Column:
    """Structs of items at the same place."""
    return F.arrays_zip(*[c.alias(n) for n, c in arrays])


def decode(codes: Column, names: Mapping[str, str]) -> Column:
    """Names of an array's codes; codes without one go."""
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.filter(F.transform(codes, lambda c: F.try_element_at(table, c)), lambda x: x.isNotNull())


def rename_keys(table: Column, names: Mapping[str, str]) -> Column:
    renamed = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.transform_keys(table, lambda k, v: F.coalesce(F.try_element_at(renamed, k), k))


def json_path(c: Column, path: str) -> Column:
    """Text at a dotted path with list places, a.0.b."""
    steps = "".join(f"[{p}]" if p.isdigit() else f".{p}" for p in path.split("."))
    return F.get_json_object(c, "$" + steps)


def level_columns(df: DataFrame, hierarchy: str, widths: Sequence[int] = (2, 4, 6, 8)) -> DataFrame:
    """code_levelN and title_levelN from a hierarchy of code and title."""
    for n in widths:
        at = F.get(_of_length(q(hierarchy), n), F.lit(0))
        df = df.withColumn(f"code_level{n}", at["code"]).withColumn(f"title_level{n}", at["title"])
    return df


def _of_length(hierarchy: Column, n: int) -> Column:
    return F.filter(hierarchy, lambda x: F.length(x["code"]) == n)


def first_where(array: Column, field: str, value) -> Column:
    return F.get(F.filter(array, lambda x: x[field] == value), F.lit(0))


def year_span(first: Column, last: Column) -> Column:
    return F.when(first <= last, F.sequence(first.cast("int"), last.cast("int"))).otherwise(F.array().cast("array<int>"))


def bucket(c: Column) -> Column:
    return F.when(c == 1, "1").when(c.between(2, 5), "2-5").when(c >= 6, "6+")


def count_kinds(array: Column, kind_field: str, kind: str, ident: str) -> Column:
    """How many different idents the items of a kind have."""
    return F.size(F.array_distinct(F.transform(F.filter(array, lambda x: x[kind_field] == kind), lambda x: x[ident])))


def top_items(array: Column, by: str, most: int = 10) -> Column:
    """The items of greatest field value, greatest first."""
    keyed = F.transform(array, lambda x: F.struct((-F.coalesce(x[by].cast("double"), F.lit(0.0))).alias("k"), x.alias("v")))
    return F.transform(F.slice(F.array_sort(keyed), 1, most), lambda x: x["v"])


def rooted(nodes: DataFrame) -> DataFrame:
    """nodes (id, up, ...) that a root, which has no up, stands above, roots among them.

    Each node points at the ancestor twice as far up in each round, so that the deepest are done after the logarithm of
    their depth. What still points at others after that of the number of nodes goes round in a circle, or hangs on one.
    """
    total = nodes.count()
    done = cut(nodes.where("up is null").select("id"))
    open_ = cut(nodes.where("up is not null").select("id", "up"))
    for _ in range(total.bit_length() + 1):
        if open_.isEmpty():
            break
        found = open_.join(done.withColumnRenamed("id", "up"), "up", "left_semi").select("id")
        rest = open_.join(done.withColumnRenamed("id", "up"), "up", "left_anti")
        done, open_ = cut(done.unionByName(found)), cut(rest.join(open_.select(F.col("id").alias("up"), F.col("up").alias("__next")), "up").select("id", F.col("__next").alias("up")))
    return nodes.join(done, "id", "left_semi")


def tree_paths(df: DataFrame, ident: str, parent: str, title: str) -> DataFrame:
    """ident and path of each node of a forest: the titles from its root.

    Paths double from round to round: what leads to a node from its ancestor is put behind what leads to that one.
    Nodes that no root reaches have no path; unrooted() tells which they are.
    """
    nodes = cut(rooted(df.select(q(ident).alias("id"), q(parent).alias("up"), q(title).alias("t"))))
    now = cut(nodes.select("id", "up", F.array("t").alias("path")))
    out = now.where("up is null").select("id", "path")
    open_ = now.where("up is not null")
    while not open_.isEmpty():
        above = now.select(F.col("id").alias("up"), F.col("up").alias("__next"), F.col("path").alias("__path"))
        now = cut(open_.join(above, "up").select("id", F.col("__next").alias("up"), F.concat("__path", "path").alias("path")).unionByName(now.where("up is null")))
        out, open_ = now.where("up is null").select("id", "path"), now.where("up is not null")
    return out.withColumnRenamed("id", ident)


def unrooted(df: DataFrame, ident: str, parent: str) -> DataFrame:
    """The rows that no root stands above: nodes of circles, those that hang on one, and those whose parent is not there."""
    nodes = cut(df.select(q(ident).alias("id"), q(parent).alias("up")))
    return df.join(rooted(nodes).select(F.col("id").alias(ident)), ident, "left_anti")


def keyed_document(df: DataFrame, key: Column, revision: int, drop: Sequence[str] = ("chunks",)) -> DataFrame:
    """key, value (the row as JSON) and __revision."""
    rest = [c for c in df.columns if c not in drop]
    return df.select(key.alias("key"), F.to_json(nested(rest, df)).alias("value"), F.lit(revision).alias("__revision"))
