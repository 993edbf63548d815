"""Cutting the plans that loops would let grow."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Rows of a narrow checkpoint that share a file.
FILE_ROWS = 1_000


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; only a local session without one gets a temporary folder."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if path is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="civicflow-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def files(rows: int) -> int:
    """How many files a narrow checkpoint of so many rows needs."""
    return max(1, -(-rows // FILE_ROWS))


def cut(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Checkpoint of a loop's state, so that plans do not grow; with the rows expected, in as many files as those need."""
    shared_dir(df.sparkSession)
    return (df if rows is None else df.coalesce(files(rows))).checkpoint(eager=True)
