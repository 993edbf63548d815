"""Revisions and histories kept up to date by micro-batches of a stream."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.project import q
from ..state.lineage import cut
from ..state.revisions import manage_revisions
from ..state.versions import VersionedTable


def read_files(spark: SparkSession, path: str, schema, per_trigger: int = 100, format: str = "parquet", glob: str | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.format(format).load(path)


def apply_batch(df: DataFrame, label: str, table: VersionedTable, order_by: Sequence[str], now: dt.datetime, expire_days: int | None = None) -> None:
    """One batch of keep_revisions: a version of the table with this label, made from the versions before it.

    A batch that runs again finds either its label, and does nothing, or the table as it was, so what it writes is the
    same. A row that comes late, behind the stored one by order_by, is left out.
    """
    if table.snapshot(label=label):
        return
    keys = table.keys
    rest = [c for c in df.columns if c not in keys]
    last = df.groupBy(*map(q, keys)).agg(F.max_by(F.struct(*map(q, rest)), F.struct(*map(q, order_by))).alias("__r"))
    last = cut(last.select(*[q(c) if c in keys else F.col("__r")[c].alias(c) for c in df.columns]))
    stored = table.beside(last)
    if stored is not None and expire_days is not None:
        stored = stored.where(q("__last_updated_at") >= F.lit(now - dt.timedelta(days=expire_days)))
    if stored is not None:
        had = stored.select(*[q(k).alias(f"__k_{k}") for k in keys], F.struct(*map(q, order_by)).alias("__had"))
        same = F.lit(True)
        for k in keys:
            same = same & q(k).eqNullSafe(q(f"__k_{k}"))
        late = F.col("__had").isNotNull() & (F.struct(*map(q, order_by)) < F.col("__had"))
        last = last.join(had, same, "left").where(~late).select(*map(q, last.columns))
    table.update(manage_revisions(last, stored, keys, now), label=label)


def keep_revisions(stream: DataFrame, path: str, keys: Sequence[str], order_by: Sequence[str], clock: Callable[[int], dt.datetime], checkpoint: str, expire_days: int | None = None) -> StreamingQuery:
    """Below path, a versioned table holds the last row of each key with its revision status; a batch is a version.

    clock gives the time of a batch by its number, the same however often the batch runs. Each batch counts exactly
    once, wherever a run before it broke off: the state that it starts from is the version before its own. A key that no
    batch has had for over expire_days counts as new when it comes again.
    """

    def batch(df: DataFrame, epoch: int) -> None:
        apply_batch(df, f"{checkpoint}#{epoch}", VersionedTable(df.sparkSession, path, keys), order_by, clock(epoch), expire_days)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def running_totals(stream: DataFrame, keys: Sequence[str], value: str, time: str, window: str = "1 day", late: str = "1 day") -> DataFrame:
    """Count and sum by key and window of event time; a window is final once the watermark has passed it."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window).alias("window"), *map(q, keys)).agg(F.count(F.lit(1)).alias("n"), F.sum(q(value)).alias("total"))


def whole_totals(totals: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """All totals of what a stream has now, those of open windows too, however late their rows came.

    The state keeps every window, as nothing is final. A batch writes all totals into a folder of its own below path, over
    what a run before it left there; the last batch's are read.
    """
    totals.writeStream.outputMode("complete").foreachBatch(lambda df, epoch: df.write.mode("overwrite").parquet(f"{path}/batch={epoch}")).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    spark = totals.sparkSession
    try:
        written = spark.read.schema(T.StructType([*totals.schema.fields, T.StructField("batch", T.LongType())])).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], totals.schema)  # there were no files
    last = written.agg(F.max("batch")).first()[0]
    return written.where(F.col("batch") == last).drop("batch") if last is not None else spark.createDataFrame([], totals.schema)


def first_seen(stream: DataFrame, keys: Sequence[str], time: str, late: str = "1 day") -> DataFrame:
    """Rows whose key has not come before within the watermark."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys))
