"""Tables in a folder as a series of snapshots.

Rows lie in buckets by a hash of their key. An update writes the buckets that it touches into a folder of its own, and
then a manifest: one small file that says, for all buckets of the new version, where they are. That file is the commit;
what a failed update has written is in no manifest, so nobody reads it. Buckets split one after the other as the table
grows (linear hashing): the first 2 * 2^k - n of n buckets still take all keys that two later ones will share.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.project import q
from .lineage import cut
from .upsert import upsert

BUCKET = "__bucket"
#: Rows that a bucket has in the mean before one of them is split.
BUCKET_ROWS = 1_000_000
#: Buckets at most, each of which is a folder, a file and a row of every manifest; those of larger tables have more rows instead.
MAX_BUCKETS = 512
MANIFEST = "version long, label string, columns string, buckets int, bucket int, folder string, rows long"


@dataclass
class Snapshot:
    """One version: its columns, and for each bucket with rows the folder that holds it and how many there are."""

    version: int
    label: str | None
    schema: T.StructType
    buckets: int
    where: dict[int, tuple[str, int]] = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(n for _, n in self.where.values())


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a key among so many: its hash modulo the power of two above, or below where that one is not there yet."""
    power = 1 << (buckets.bit_length() - 1)
    place = F.pmod(F.xxhash64(*[q(k).cast("string") for k in keys]), F.lit(2 * power))
    return F.when(place < buckets, place).otherwise(place - power).cast("int")


def split_from(before: int, after: int) -> set[int]:
    """Those of the first buckets whose keys go to other ones when there are more."""
    out = set()
    for b in range(before, after):
        while b >= before:
            b -= 1 << (b.bit_length() - 1)
        out.add(b)
    return out


class VersionedTable:
    """A table of one row a key below a path that all of the cluster shares; one writer at a time."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], bucket_rows: int = BUCKET_ROWS):
        self.spark, self.path, self.keys, self.bucket_rows = spark, path.rstrip("/"), list(keys), bucket_rows

    def _manifest(self) -> DataFrame:
        try:
            return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], MANIFEST)

    def snapshot(self, version: int | None = None, label: str | None = None) -> Snapshot | None:
        """The latest version, or that of a number or label; none if there is none. Its manifest has a row a bucket."""
        rows = self._manifest()
        if label is not None:
            rows = rows.where(F.col("label") == label)
        if version is None:
            version = rows.agg(F.max("version")).first()[0]
        found = rows.where(F.col("version") == version).collect() if version is not None else []
        if not found:
            return None
        one = found[0]
        return Snapshot(one["version"], one["label"], T.StructType.fromJson(json.loads(one["columns"])), one["buckets"], {r["bucket"]: (r["folder"], r["rows"]) for r in found if r["folder"] is not None})

    def _rows(self, s: Snapshot, buckets: Iterable[int]) -> DataFrame:
        paths = [f"{s.where[b][0]}/{BUCKET}={b}" for b in buckets if b in s.where]
        # files of before a column came have nulls in it
        return self.spark.read.schema(s.schema).parquet(*paths) if paths else self.spark.createDataFrame([], s.schema)

    def read(self, version: int | None = None) -> DataFrame | None:
        """All rows of the latest version, or of another."""
        s = self.snapshot(version)
        return None if s is None else self._rows(s, s.where)

    def beside(self, df: DataFrame) -> DataFrame | None:
        """The rows of the buckets that df's keys fall in; others cannot have one of them."""
        s = self.snapshot()
        return None if s is None else self._rows(s, self._touched(df, s.buckets))

    def _touched(self, df: DataFrame, buckets: int) -> set[int]:
        return {r[0] for r in df.select(bucket_of(self.keys, buckets)).distinct().collect()}  # at most one number a bucket

    def update(self, df: DataFrame, order_by: Sequence[str] = (), label: str | None = None) -> Snapshot:
        """A new version in which df's rows stand in for those of the same keys; of equal keys in df the last by order_by.

        Columns that only df has come to the table, with nulls in other rows; those that it lacks are null in its rows. A
        column keeps its type. An update whose label a version has already is that version, and nothing is written.
        """
        if label is not None and (done := self.snapshot(label=label)):
            return done
        new, s = cut(df), self.snapshot()
        if s is None:
            s = Snapshot(-1, None, T.StructType([]), 1)
        known = {f.name: f.dataType for f in s.schema.fields}
        for f in new.schema.fields:
            if known.get(f.name, f.dataType) != f.dataType:
                raise ValueError(f"{f.name} is {known[f.name].simpleString()} in the table and {f.dataType.simpleString()} in the update")
        schema = T.StructType([*s.schema.fields, *[T.StructField(f.name, f.dataType) for f in new.schema.fields if f.name not in known]])
        buckets = max(s.buckets, min(-(-(s.rows + new.count()) // self.bucket_rows), MAX_BUCKETS))
        touched = self._touched(new, s.buckets) | split_from(s.buckets, buckets)
        old = self._rows(Snapshot(s.version, s.label, schema, s.buckets, s.where), touched) if s.version >= 0 else None
        out = upsert(old, new, self.keys, order_by).select(*[q(f.name) for f in schema.fields]).withColumn(BUCKET, bucket_of(self.keys, buckets))
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        out.repartition(BUCKET).write.partitionBy(BUCKET).parquet(folder)
        sizes = self.spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(folder).groupBy(BUCKET).count().collect()
        where = {b: w for b, w in s.where.items() if b not in touched} | {r[0]: (folder, r[1]) for r in sizes}
        self._commit(Snapshot(s.version + 1, label, schema, buckets, where))
        return self.snapshot(s.version + 1)

    def _commit(self, s: Snapshot) -> None:
        fixed = (s.version, s.label, s.schema.json(), s.buckets)
        rows = [(*fixed, b, folder, n) for b, (folder, n) in sorted(s.where.items())] or [(*fixed, 0, None, 0)]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
