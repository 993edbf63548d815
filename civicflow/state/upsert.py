"""Updates by key as new versions of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.project import q
from .lineage import cut


def upsert(old: DataFrame | None, new: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """new's rows, and old's of other keys. Null keys match null keys. Of rows of new with one key, the last by order_by."""
    if order_by:
        order = F.struct(*map(q, order_by))
        rest = [c for c in new.columns if c not in keys]
        one = new.groupBy(*map(q, keys)).agg(F.max_by(F.struct(*map(q, rest)), order).alias("__r"))
        new = one.select(*[q(c) if c in keys else F.col("__r")[c].alias(c) for c in new.columns])
    else:
        new = new.dropDuplicates(list(keys))
    if old is None:
        return new
    changed = new.select(*[q(k).alias(f"__k_{k}") for k in keys])
    on = F.lit(True)
    for k in keys:
        on = on & q(k).eqNullSafe(q(f"__k_{k}"))
    return old.join(changed, on, "left_anti").unionByName(new, allowMissingColumns=True)


#: Partitions of a table that is updated, unless the first update says otherwise, and the column they go by.
BUCKETS, BUCKET = 64, "__bucket"


def upsert_table(df: DataFrame, name: str, keys: Sequence[str], order_by: Sequence[str] = (), buckets: int | None = None) -> None:
    """Updates a catalogue table by key. It is partitioned by a hash of the key in the column __bucket.

    Only partitions with new rows are read and written, each replaced when all of it is there; what the update reads is
    checkpointed first, so a run that fails leaves the old partitions and can be repeated. The number of partitions is
    kept in the table's properties. Columns that only df has are added to the table, with nulls in other rows; those
    that it lacks are null in its rows. For tables that grow without bound there is versions.VersionedTable.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(name)
    if exists:
        kept = spark.sql(f"show tblproperties {name}").where("key = 'buckets'").first()
        if kept is None:
            raise ValueError(f"{name} is not a table that save_table made for updates")
        buckets = int(kept["value"])
    buckets = buckets or BUCKETS
    place = F.pmod(F.xxhash64(*[q(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")
    new = cut(df)
    if not exists:
        upsert(None, new, keys, order_by).withColumn(BUCKET, place).repartition(BUCKET).write.partitionBy(BUCKET).saveAsTable(name)
        spark.sql(f"alter table {name} set tblproperties ('buckets' = '{buckets}')")
        return
    touched = [r[0] for r in new.select(place).distinct().collect()]  # at most one number a bucket
    added = [f for f in new.schema.fields if f.name not in spark.table(name).columns]
    if added:
        spark.sql(f"alter table {name} add columns ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in added)})")
    stored = spark.table(name)
    old = cut(stored.where(F.col(BUCKET).isin(touched)).drop(BUCKET))
    out = upsert(old, new, keys, order_by).withColumn(BUCKET, place).select(*map(q, stored.columns)).repartition(BUCKET)
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")  # only partitions that out has rows of are replaced
    try:
        out.write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(mode, before)
    spark.catalog.refreshTable(name)
