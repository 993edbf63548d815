"""Writers."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.project import primary_key, q
from ..package import Package

_DECLARED = {"bigint": "integer", "int": "integer", "double": "number", "float": "number", "boolean": "boolean", "date": "date", "timestamp": "datetime", "timestamp_ntz": "datetime"}


def declared_type(kind: str) -> str:
    if kind.startswith("decimal"):
        return "number"
    if kind.startswith("array"):
        return "array"
    if kind.startswith(("struct", "map")):
        return "object"
    return _DECLARED.get(kind, "string")


def descriptor(package: Package) -> dict:
    """The package's metadata and its tables' fields and keys."""
    resources = []
    for name, df in package.resources.items():
        fields = [{"name": n, "type": declared_type(k), **{a: b for a, b in df.schema[n].metadata.items() if a != "primaryKey"}} for n, k in df.dtypes]
        schema = {"fields": fields} | ({"primaryKey": primary_key(df)} if primary_key(df) else {})
        resources.append({"name": name, "path": f"data/{name}", "schema": schema})
    return {**package.meta, "resources": resources}


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, so that text formats can hold them."""
    return df.select(*[F.to_json(q(c)).alias(c) if k.startswith(("array", "struct", "map")) else q(c) for c, k in df.dtypes])


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """One small text through Spark's file systems."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def dump(package: Package, folder: str, format: str = "csv", partition_by: Sequence[str] = ()) -> None:
    """Tables under data/, the descriptor beside them."""
    for name, df in package.resources.items():
        writer = (flat(df) if format == "csv" else df).write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if format == "csv":
            writer = writer.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        writer.format(format).save(f"{folder}/data/{name}")
        spark = df.sparkSession
    if package.resources:
        write_text(spark, json.dumps(descriptor(package), ensure_ascii=False, default=str), f"{folder}/datapackage.json")


def save_table(df: DataFrame, name: str, mode: str = "overwrite", keys: Sequence[str] = (), buckets: int = 0) -> None:
    """A catalogue table: overwritten, appended to, or updated, which replaces rows of the same key.

    Bucketing by the key lets later joins skip a shuffle; a table that is updated is partitioned by a hash of its key.
    """
    from ..state.upsert import upsert_table

    if mode == "update":
        upsert_table(df, name, keys, buckets=buckets or None)
        return
    if mode not in ("overwrite", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    writer = df.write.mode(mode)
    if buckets and keys:
        writer = writer.bucketBy(buckets, *keys).sortBy(*keys)
    writer.saveAsTable(name)


def search_documents(df: DataFrame) -> DataFrame:
    """Rows as a search index takes them: times in UTC ISO form, decimals as doubles."""
    out = []
    for c, k in df.dtypes:
        if k in ("timestamp", "timestamp_ntz"):
            out.append(F.date_format(q(c), df.schema[c].metadata.get("format", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias(c))
        elif k == "date":
            out.append(F.date_format(q(c), "yyyy-MM-dd").alias(c))
        elif k.startswith("decimal"):
            out.append(q(c).cast("double").alias(c))
        else:
            out.append(q(c))
    return df.select(*out)


#: Fixed value: components of the vectors that documents' chunks have.
VECTOR_SIZE = 1536


def vector_field(size: int) -> dict:
    return {"type": "dense_vector", "dims": size, "index": True, "similarity": "cosine"}


def search_mapping(df: DataFrame) -> dict:
    """Index mapping by types and es: hints in the columns' metadata. The column chunks is nested, each with its vector."""
    kinds = {"integer": "long", "number": "double", "boolean": "boolean", "date": "date", "datetime": "date", "object": "object"}
    properties = {}
    for f in df.schema.fields:
        hints, kind = {k[3:]: v for k, v in f.metadata.items() if k.startswith("es:")}, declared_type(f.dataType.simpleString())
        if hints.get("exclude"):
            continue
        if f.name == "chunks":
            properties[f.name] = {"type": "nested", "properties": {"embeddings": vector_field(hints.get("vector", VECTOR_SIZE))}}
            continue
        if kind == "array":
            inner = f.dataType.elementType.simpleString()
            kind = hints.get("itemType", declared_type(inner))
        if hints.get("vector"):
            properties[f.name] = vector_field(hints["vector"])
        elif kind in kinds:
            properties[f.name] = {"type": kinds[kind]}
        elif hints.get("keyword"):
            properties[f.name] = {"type": "keyword"}
        else:
            properties[f.name] = {"type": "text"} | ({"fields": {"hebrew": {"type": "text", "analyzer": "hebrew"}}} if hints.get("hebrew") or hints.get("title") else {}) | ({"boost": hints["boost"]} if "boost" in hints else {})
        if hints.get("index") is False:
            properties[f.name]["index"] = False
    return {"properties": properties}


def without_stale(stored: DataFrame, revision: int) -> DataFrame:
    """Documents that the run of this revision wrote or a later one did."""
    return stored.where(F.col("__revision") >= revision)


def rolling_json(df: DataFrame, path: str, rows_per_file: int) -> None:
    search_documents(df).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).json(path)


def json_lines(package: Package, folder: str) -> None:
    """Each table's rows as JSON lines under its name; of any size."""
    for name, df in package.resources.items():
        search_documents(df).write.mode("overwrite").json(f"{folder}/{name}")


def collated_documents(package: Package, order_by: dict[str, Sequence[str]], most: int = 100_000) -> DataFrame:
    """One document a table: its name and its rows in order as JSON.

    Each document is one value, so a table of over most rows raises; write it with json_lines instead.
    """
    out = None
    for name, df in package.resources.items():
        if df.limit(most + 1).count() > most:
            raise ValueError(f"{name} has over {most} rows")
        rows = F.array_sort(F.collect_list(F.struct(F.struct(*map(q, order_by[name])).alias("o"), F.to_json(F.struct(*map(q, df.columns))).alias("v"))))
        one = df.agg(F.transform(rows, lambda x: x["v"]).alias("rows")).select(F.lit(name).alias("key"), F.concat(F.lit("["), F.array_join("rows", ","), F.lit("]")).alias("value"))
        out = one if out is None else out.unionByName(one)
    return out


def sitemap(df: DataFrame, url: str, modified: str, order_by: Sequence[str], size: int = 10_000, floor: str = "2021-01-01") -> DataFrame:
    """page and xml of each sitemap page; dates before the floor are the floor."""
    from ..functions.text import escape_ampersand
    from ..operators.windows import pages

    numbered = pages(df, order_by, size)
    day = F.date_format(F.greatest(F.coalesce(q(modified).cast("date"), F.lit(floor).cast("date")), F.lit(floor).cast("date")), "yyyy-MM-dd")
    entry = F.concat(F.lit("<url><loc>"), escape_ampersand(q(url)), F.lit("</loc><lastmod>"), day, F.lit("</lastmod></url>"))
    listed = F.array_sort(F.collect_list(F.struct(F.struct(*map(q, order_by)).alias("o"), entry.alias("e"))))
    body = F.array_join(F.transform(listed, lambda x: x["e"]), "\n")
    return numbered.groupBy("page").agg(F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">\n'), body, F.lit("\n</urlset>")).alias("xml"))


def sitemap_index(pages: DataFrame, base: str) -> DataFrame:
    entries = F.array_sort(F.collect_list(F.concat(F.lit(f"<sitemap><loc>{base}"), F.format_string("%08d", F.col("page")), F.lit(".xml</loc></sitemap>"))))
    return pages.agg(F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">\n'), F.array_join(entries, "\n"), F.lit("\n</sitemapindex>")).alias("xml"))


def for_each_row(df: DataFrame, send: Callable[[dict], None]) -> None:
    """Hand rows to a service, one after another in each partition. A row may be sent again if a task fails."""
    df.foreachPartition(lambda rows: [send(r.asDict(True)) for r in rows] and None)


def for_each_batch(df: DataFrame, send: Callable[[list[dict]], None], most: int = 50) -> None:
    """Hand rows to a service, some at once. A batch may be sent again if a task fails, so the service goes by ids."""
    from itertools import batched

    df.foreachPartition(lambda rows: [send([r.asDict(True) for r in some]) for some in batched(rows, most)] and None)
