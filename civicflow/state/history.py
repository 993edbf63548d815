"""Slowly changing values: a row for each key and day on which a value differs from the one before."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.project import q


def history_updates(df: DataFrame, stored: DataFrame | None, keys: Sequence[str], fields: Sequence[str], as_of: dt.date, order_by: Sequence[str]) -> DataFrame:
    """keys, fields, __updated: the last row of each key, if all its fields are filled and some differ from the latest stored."""
    last = df.groupBy(*map(q, keys)).agg(F.max_by(F.struct(*map(q, fields)), F.struct(*map(q, order_by))).alias("__new"))
    for f in fields:
        last = last.where(F.col("__new")[f].isNotNull() & (F.col("__new")[f].cast("string") != ""))
    if stored is not None:
        latest = stored.groupBy(*map(q, keys)).agg(F.max_by(F.struct(*map(q, fields)), "__updated").alias("__old"))
        last = last.join(latest, list(keys), "left").where(~F.col("__new").eqNullSafe(F.col("__old")))
    return last.select(*map(q, keys), *[F.col("__new")[f].alias(f) for f in fields], F.lit(as_of).alias("__updated"))


def as_of_day(stored: DataFrame, keys: Sequence[str], fields: Sequence[str], day: dt.date) -> DataFrame:
    """The values that held on a day."""
    return stored.where(F.col("__updated") <= F.lit(day)).groupBy(*map(q, keys)).agg(*[F.max_by(q(f), "__updated").alias(f) for f in fields])
