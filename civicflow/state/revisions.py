"""What changed since the last run: hashes, staleness and revision stamps of keyed rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import py_str
from ..operators.project import q

STATUS = ["last_updated_at", "last_modified_at", "created_at", "is_new", "is_stale", "staleness", "next_update_days", "hash"]


def row_hash(df: DataFrame, names: Sequence[str]) -> Column:
    """md5 of the columns' texts in the order of their names; empty without columns."""
    if not names:
        return F.lit("")
    return F.md5(F.concat_ws("|", *[py_str(q(c), df.schema[c].dataType) for c in sorted(names)]))


def manage_revisions(df: DataFrame, stored: DataFrame | None, keys: Sequence[str], as_of: dt.datetime, hash_fields: Sequence[str] | None = None, prefix: str = "", max_staleness: int = 90) -> DataFrame:
    """df with eight <prefix>__ status columns, against the stored ones of the last run.

    A new key is new and stale. One whose hash stays waits two days longer than it has, one that changed is due again
    tomorrow; creation times survive. stored None means a first run.
    """
    names = {s: f"{prefix}__{s}" for s in STATUS}
    fields = hash_fields if hash_fields is not None else [c for c in df.columns if c not in keys and c not in names.values()]
    now = F.lit(as_of)
    fresh = df.select(*[q(c) for c in df.columns if c not in names.values()], row_hash(df, fields).alias("__h"))
    if stored is None:
        old = fresh.select(*[q(k).alias(f"__k_{k}") for k in keys]).where(F.lit(False))
        old = old.select("*", F.lit(None).cast("timestamp").alias("__u"), F.lit(None).cast("timestamp").alias("__m"), F.lit(None).cast("timestamp").alias("__c"), F.lit(None).cast("int").alias("__n"), F.lit(None).cast("string").alias("__oh"))
    else:
        old = stored.select(*[q(k).alias(f"__k_{k}") for k in keys], q(names["last_updated_at"]).alias("__u"), q(names["last_modified_at"]).alias("__m"), q(names["created_at"]).alias("__c"), q(names["next_update_days"]).alias("__n"), q(names["hash"]).alias("__oh"))
    on = F.lit(True)
    for k in keys:
        on = on & q(k).eqNullSafe(q(f"__k_{k}"))
    joined = fresh.join(old.withColumn("__hit", F.lit(True)), on, "left")
    hit = F.coalesce(F.col("__hit"), F.lit(False))
    days = F.greatest(F.lit(0), F.floor((F.unix_timestamp(now) - F.unix_timestamp("__u")) / 86400).cast("int"))
    planned = F.least(F.col("__n"), F.lit(max_staleness))
    same = F.col("__h") == F.col("__oh")
    overdue = F.greatest(F.lit(1), days - planned)
    status = {
        "last_updated_at": now,
        "last_modified_at": F.when(hit & same, F.col("__m")).otherwise(now),
        "created_at": F.when(hit, F.col("__c")).otherwise(now),
        "is_new": ~hit,
        "is_stale": F.when(hit, days > planned).otherwise(True),
        "staleness": F.when(hit, F.floor(100000 + 100000 / (1 + overdue))).otherwise(100000).cast("int"),
        "next_update_days": F.when(hit & same, days + 2).otherwise(1).cast("int"),
        "hash": F.col("__h"),
    }
    return joined.select(*[q(c) for c in fresh.columns if c != "__h"], *[c.alias(names[s]) for s, c in status.items()])


def set_revision(df: DataFrame, revision: int) -> DataFrame:
    return df.withColumn("__revision", F.lit(revision))


def revision_dates(df: DataFrame, prefix: str = "") -> DataFrame:
    """Status times as rev_ dates."""
    out = df
    for s in ("last_updated_at", "last_modified_at", "created_at"):
        if f"{prefix}__{s}" in df.columns:
            out = out.withColumn(f"rev_{s}", F.to_date(q(f"{prefix}__{s}")))
    return out


def changed_only(df: DataFrame, prefix: str = "") -> DataFrame:
    return df.where(q(f"{prefix}__next_update_days") == 1)


def resumable(df: DataFrame, done: DataFrame | None, key: str, revision: int) -> DataFrame:
    """Inputs that no earlier run at this revision has loaded or failed on."""
    if done is None:
        return df
    return df.join(done.where(F.col("revision") == revision).select(q(key)).distinct(), key, "left_anti")
