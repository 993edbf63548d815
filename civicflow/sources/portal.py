"""Open-data portals: picking a resource out of a dataset's listing, and mending the files that come."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.project import q
from .readers import readable


def resolve(listing: DataFrame, dataset: str, name: str | None = None, ident: str | None = None) -> DataFrame:
    """url, format and strings (whether to read it as text) of a dataset's resource by id, or by name, or its last one.

    listing: dataset, resource_id, name, url, format, last_modified.
    """
    own = listing.where(q("dataset") == dataset)
    if ident is not None:
        own = own.where(q("resource_id") == ident)
    elif name is not None:
        own = own.where(F.trim(q("name")) == name)
    last = own.groupBy("dataset").agg(F.max_by(F.struct("url", "format"), F.struct("last_modified", "resource_id")).alias("r"))
    return last.select("r.url", F.lower("r.format").alias("format"), F.lower("r.format").isin("xls", "xlsx").alias("strings"))


def mended_lines(text: Column) -> Column:
    """Lines of a whole CSV text whose fields were broken by stray line ends: a line end inside quotes is a blank."""
    parts = F.split(text, '"')
    mended = F.transform(parts, lambda p, i: F.when(i % 2 == 1, F.regexp_replace(p, r"\s*[\r\n]+\s*", " ")).otherwise(p))
    lines = F.split(F.array_join(mended, '"'), "\r?\n")
    return F.filter(F.transform(lines, lambda x: F.regexp_replace(x, "[ \t]+", " ")), lambda x: F.trim(x) != "")


def repaired_text(text: Column, mark: str = "5") -> Column:
    """A whole CSV text whose rows begin with a mark, with stray white space taken out; its lines are rows.

    White space that ends with a line end begins a row where the mark follows. Any other is one blank, or nothing beside
    a comma, but before the mark it is a blank there, too; at the end it is nothing.
    """
    space, row, blank = "[\\r\\n\\t ]", "\x01", "\x02"
    out = F.regexp_replace(text, f"{space}*[\\r\\n](?={mark})", row)
    out = F.regexp_replace(out, f"{space}+(?={mark})", blank)
    out = F.regexp_replace(out, f"{space}+\\z", "")
    out = F.regexp_replace(out, f"(?<=,){space}+|{space}+(?=,)", "")
    out = F.regexp_replace(out, f"{space}+", " ")
    return F.ltrim(F.translate(out, row + blank, "\n "), F.lit("\n "))


#: Bits of a line's number in its split below that of its chunk; the lines of a chunk are counted by one task.
CHUNK_BITS = 12


def repaired_lines(spark: SparkSession, path: str, mark: str = "5", encoding: str = "windows-1255") -> DataFrame:
    """file, record, line of CSV files in need of repair; records count up in a file.

    The state of the repair between two lines is only whether a row begins, which the second line tells by itself. So
    lines are read by many tasks, rows are counted by chunks of a split, and only the lines of one row come together.
    No task needs the lines of a split at once.
    """
    encoding, fix = readable(encoding)
    raw = spark.read.option("encoding", encoding).option("sep", "\x01").option("quote", "").option("maxCharsPerColumn", -1).schema("line string").csv(path)
    lines = raw.select(fix(q("line")).alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    lines = lines.withColumn("n", F.monotonically_increasing_id()).withColumn("begins", q("line").startswith(mark).cast("long"))
    lines = lines.withColumn("chunk", F.shiftright("n", CHUNK_BITS))
    chunk = ["file", "block", "chunk"]
    chunks = lines.groupBy(*chunk).agg(F.sum("begins").alias("rows"))
    before = F.sum("rows").over(Window.partitionBy("file").orderBy("block", "chunk")) - F.col("rows")
    own = F.sum("begins").over(Window.partitionBy(*chunk).orderBy("n"))
    numbered = lines.withColumn("own", own).join(chunks.select(*chunk, before.alias("before")), chunk)
    whole = numbered.groupBy("file", (F.col("before") + F.col("own")).alias("record")).agg(F.array_sort(F.collect_list(F.struct("block", "n", "line"))).alias("lines"))
    text = F.array_join(F.transform("lines", lambda x: x["line"]), "\n")
    return whole.select("file", "record", repaired_text(text, mark).alias("line")).where(F.col("line") != "")
