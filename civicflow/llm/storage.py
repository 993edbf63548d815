"""Intermediates: held, written to the folder that the whole cluster shares, or broadcast after a count."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.chains import looked_up
from ..state.lineage import cut, shared_dir

__all__ = ["BROADCAST_ROWS", "cut", "hold", "local_folder", "looked_up", "released", "shared_dir", "small_side", "written"]

#: Narrow rows that may be broadcast; some tens of MB.
BROADCAST_ROWS = 500_000


def local_folder(spark: SparkSession) -> str | None:
    """The shared folder as tasks can open it themselves; none if it is in a store that only Spark reads."""
    path = shared_dir(spark)
    scheme, _, rest = path.partition(":/")
    return path if path.startswith("/") else "/" + rest.lstrip("/") if scheme == "file" else None


_HELD: list[DataFrame] = []


def hold(df: DataFrame) -> DataFrame:
    """An intermediate that is read more than once, kept on the executors' disks; what a lost one held is made again.

    released() lets it go.
    """
    _HELD.append(df.persist(StorageLevel.DISK_ONLY))
    return _HELD[-1]


@contextmanager
def released() -> Iterator[None]:
    """Lets go, at the end, of what the operators called inside have held: for blocks that write or collect results."""
    before = len(_HELD)
    try:
        yield
    finally:
        for df in _HELD[before:]:
            df.unpersist()
        del _HELD[before:]


def written(df: DataFrame, name: str) -> DataFrame:
    """Columnar checkpoint of a wide intermediate: Parquet in the shared folder, read back with pruning."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS, expected: int | None = None) -> DataFrame:
    """A narrow lookup table, held and counted: broadcast if it has few rows, else left to a shuffle join.

    Where it is broadcast, the wide rows that look things up stay where they are. With the rows expected, it is
    checkpointed instead, for what goes on from it.
    """
    held = hold(df) if expected is None else cut(df, expected)
    return F.broadcast(held) if held.limit(rows + 1).count() <= rows else held
