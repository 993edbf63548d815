"""File and table readers. Values are read as text and typed by declaration afterwards."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip_formulas
from ..operators.project import q, set_types
from ..package import Package

#: Declared types by name, as descriptors have them.
KINDS = {"string": "string", "integer": "long", "number": "decimal(38,6)", "boolean": "boolean", "date": "date", "datetime": "timestamp", "year": "int", "time": "string"}


#: Encodings that Spark's readers take themselves; others of one byte a character are read as Latin-1 and translated.
OWN_ENCODINGS = {"utf-8", "utf-16", "utf-16le", "utf-16be", "us-ascii", "iso-8859-1"}


def byte_table(encoding: str) -> tuple[str, str]:
    """Latin-1 characters and what the same bytes mean in a one-byte encoding; bytes that mean nothing stay."""
    pairs = [(bytes([b]).decode("latin-1"), bytes([b]).decode(encoding, "ignore")) for b in range(128, 256)]
    kept = [(a, c) for a, c in pairs if len(c) == 1 and a != c]
    return "".join(a for a, _ in kept), "".join(c for _, c in kept)


def readable(encoding: str) -> tuple[str, Callable[[Column], Column]]:
    """The encoding to read in, and what makes the text right after it."""
    if encoding.lower() in OWN_ENCODINGS:
        return encoding, lambda c: c
    old, new = byte_table(encoding)
    return "iso-8859-1", lambda c: F.translate(c, old, new)


def csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None, encoding: str = "utf-8", separator: str = ",", missing: str = "", multiline: bool = True) -> DataFrame:
    """Text columns of a CSV file with a header; fields may be of any length and hold line breaks.

    Where no field holds one, multiline=False lets many tasks read one file.
    """
    encoding, fix = readable(encoding)
    reader = spark.read.option("header", True).option("multiLine", multiline).option("maxCharsPerColumn", -1).option("escape", '"').option("encoding", encoding).option("sep", separator).option("nullValue", missing).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    df = reader.csv(path)
    return df.select(*[fix(q(c)).alias(c) for c in df.columns])


def messy_csv(spark: SparkSession, path: str, columns: Sequence[str], encoding: str = "windows-1255") -> DataFrame:
    """Rows of CSV files with title lines above a header line, spreadsheet formulas stripped; gzip by the file's ending.

    Files are read line by line, so that one large file is many tasks unless it is compressed. Lines up to the one
    whose first field is the first column's name are not rows; where a file has none, all its lines are.
    """
    encoding, fix = readable(encoding)
    lines = spark.read.option("encoding", encoding).option("sep", "\x01").option("quote", "").option("maxCharsPerColumn", -1).schema("line string").csv(path)
    kept = lines.select(strip_formulas(fix(F.regexp_replace("line", "\r$", ""))).alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")).withColumn("n", F.monotonically_increasing_id())
    parsed = kept.select("file", "block", "n", F.from_csv("line", ", ".join(f"`{c}` string" for c in columns), {"escape": '"', "maxCharsPerColumn": "-1"}).alias("r"))
    head = parsed.where(F.col("r")[columns[0]] == columns[0]).groupBy("file").agg(F.min(F.struct("block", "n")).alias("head"))
    rows = parsed.join(head, "file", "left").where(F.col("head").isNull() | (F.struct("block", "n") > F.col("head")))
    return rows.select("r.*")


def json_rows(spark: SparkSession, path: str, property: str | None = None, schema: str | None = None) -> DataFrame:
    """Objects of a JSON file: a list, lines, or a list under a dotted property."""
    reader = spark.read.option("multiLine", True)
    if property is None:
        return (reader.schema(schema) if schema else reader).json(path)
    whole = spark.read.text(path, wholetext=True)
    item = F.get_json_object("value", "$." + property)
    if schema is None:  # the fields of all files; numbers with fractions are doubles, mixed kinds text
        found = whole.agg(F.schema_of_variant_agg(F.try_parse_json(item))).first()[0]
        kind = re.sub(r"DECIMAL\(\d+,\d+\)", "DOUBLE", found.replace("OBJECT<", "STRUCT<"))
        kind = re.sub(r"\b(VOID|VARIANT)\b", "STRING", kind)
        return whole.select(F.explode(F.from_json(item, kind)).alias("r")).select("r.*")
    return whole.select(F.explode(F.from_json(item, f"array<struct<{schema}>>")).alias("r")).select("r.*")


def json_pairs(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """A JSON list of lists as rows of text."""
    whole = spark.read.text(path, wholetext=True)
    rows = whole.select(F.explode(F.from_json("value", "array<array<string>>")).alias("r"))
    return rows.select(*[F.get("r", F.lit(i)).alias(n) for i, n in enumerate(names)])


def xml_rows(spark: SparkSession, path: str, row_tag: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.format("xml").option("rowTag", row_tag)
    return (reader.schema(schema) if schema else reader).load(path)


def table(spark: SparkSession, name: str, columns: Sequence[str] | None = None, as_text: bool = False) -> DataFrame | None:
    """Columns of a catalogue table; None if there is none yet."""
    if not spark.catalog.tableExists(name):
        return None
    df = spark.table(name)
    df = df.select(*map(q, columns)) if columns else df
    return df.select(*[q(c).cast("string").alias(c) for c in df.columns]) if as_text else df


def jdbc(spark: SparkSession, url: str, source: str, fetch: int = 1000, partition: Mapping[str, object] | None = None, **options: str) -> DataFrame:
    """A database table or query, in parallel ranges if partition names column, lowerBound, upperBound, numPartitions."""
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", fetch).options(**options)
    reader = reader.option("dbtable", f"({source}) q" if source.lstrip().lower().startswith("select") else source)
    for k, v in (partition or {}).items():
        reader = reader.option("partitionColumn" if k == "column" else k, v)
    return reader.load()


def described(spark: SparkSession, folder: str, resource: int | str | None = None) -> Package:
    """Tables of a folder with a datapackage.json: CSV by their paths, typed by their fields; the descriptor by Spark's reader."""
    text = "\n".join(r["value"] for r in spark.read.text(f"{folder}/datapackage.json", wholetext=True).collect())
    descriptor = json.loads(text)
    tables = {}
    for i, res in enumerate(descriptor["resources"]):
        if resource is not None and resource not in (i, res["name"]):
            continue
        fields = res["schema"]["fields"]
        df = csv(spark, f"{folder}/{res['path']}", [f["name"] for f in fields])
        types = {}
        for f in fields:
            kind = f.get("type", "string")
            if kind in KINDS:
                spec = {"type": KINDS[kind], "metadata": {k: v for k, v in f.items() if k not in ("name", "type")}}
                if kind == "number" and "groupChar" in f:
                    spec["group"] = f["groupChar"]
                types[f["name"].replace(".", r"\.")] = spec
        tables[res["name"]] = set_types(df, types)
    return Package(tables, {k: v for k, v in descriptor.items() if k != "resources"})


def in_memory(spark: SparkSession, rows: Sequence[Mapping], schema: str | T.StructType) -> DataFrame:
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return spark.createDataFrame([tuple(r.get(f.name) for f in kind.fields) for r in rows], kind)


def markdown_sections(spark: SparkSession, path: str) -> DataFrame:
    """code and body of sections that begin with '## code'."""
    whole = spark.read.text(path, wholetext=True)
    parts = F.filter(F.split("value", r"(?m)^##\s+"), lambda x: F.length(F.trim(x)) > 0)
    section = whole.select(F.explode(parts).alias("s"))
    return section.select(F.trim(F.regexp_extract("s", r"^([^\n]*)", 1)).alias("code"), F.regexp_replace(F.regexp_replace("s", r"^[^\n]*\n?", ""), r"^\s+|\s+$", "").alias("body")).where(F.col("body") != "")


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, contents (base64) and length of files, e.g. letters or archives."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return df.select("path", F.base64("content").alias("contents"), "length")


def archive_members(df: DataFrame, contents: str = "contents") -> DataFrame:
    """name and contents (base64) of the members of zip or tar archives, one archive a step."""
    import base64

    def run(parts):
        import io
        import tarfile
        import zipfile

        import pandas as pd

        for pdf in parts:
            names, bodies = [], []
            for text in pdf[contents]:
                raw = io.BytesIO(base64.b64decode(text))
                if zipfile.is_zipfile(raw):
                    with zipfile.ZipFile(raw) as z:
                        members = [(i.filename, z.read(i)) for i in z.infolist() if not i.is_dir()]
                else:
                    raw.seek(0)
                    with tarfile.open(fileobj=raw) as t:
                        members = [(m.name, t.extractfile(m).read()) for m in t.getmembers() if m.isfile()]
                names += [n for n, _ in members]
                bodies += [base64.b64encode(b).decode() for _, b in members]
            yield pd.DataFrame({"name": names, "contents": bodies})

    return df.select(contents).mapInPandas(run, "name string, contents string")


def letter_body(text, first: str = "הנדון", last: tuple[str, ...] = ("בברכה", "בכבוד רב")):
    """Lines of a letter from the one with the subject up to the closing formula."""
    lines = F.split(text, "\n")
    places = F.transform(lines, lambda line, i: F.struct(i.alias("i"), line.contains(first).alias("a"), F.greatest(*[line.contains(x) for x in last]).alias("b")))
    start = F.get(F.filter(places, lambda x: x["a"]), F.lit(0))["i"]
    end = F.get(F.filter(places, lambda x: x["b"] & (x["i"] > F.coalesce(start, F.lit(0)))), F.lit(0))["i"]
    a = F.coalesce(start, F.lit(0))
    return F.array_join(F.slice(lines, a + 1, F.coalesce(end, F.size(lines)) - a), "\n")


def html_table(df: DataFrame, html: str, columns: Sequence[str]) -> DataFrame:
    """Rows of the first tables of pages; cells by place. Tags are cut by patterns, inside Spark."""
    rows = F.regexp_extract_all(q(html), F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))
    cells = lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<td\b[^>]*>(.*?)</td>"), F.lit(1)), lambda c: F.trim(F.regexp_replace(c, "<[^>]*>", "")))
    each = df.select(*[q(c) for c in df.columns if c != html], F.explode(F.transform(rows, cells)).alias("__cells")).where(F.size("__cells") > 0)
    return each.select(*[q(c) for c in df.columns if c != html], *[F.get("__cells", F.lit(i)).alias(c) for i, c in enumerate(columns)])


def form_fields(html):
    """map<field, array<value>> of a form whose elements carry a fieldalias."""
    pairs = F.regexp_extract_all(html, F.lit(r'(?is)(fieldalias="[^"]*"[^>]*>[^<]*)'), F.lit(1))
    items = F.transform(pairs, lambda p: F.struct(F.regexp_extract(p, r'(?i)fieldalias="([^"]*)"', 1).alias("k"), F.trim(F.regexp_extract(p, r">([^<]*)$", 1)).alias("v")))
    keys = F.array_distinct(F.transform(items, lambda x: x["k"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.transform(F.filter(items, lambda x: x["k"] == k), lambda x: x["v"])))


def unless_written(df: DataFrame, path: str, least: int = 100 * 1024) -> DataFrame:
    """df, or none of its rows if the files under the path hold more than least bytes already."""
    spark = df.sparkSession
    try:
        there = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).agg(F.sum("length")).first()[0]
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        there = 0
    return df.limit(0) if (there or 0) > least else df
