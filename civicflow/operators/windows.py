"""Window operators: ranks, latest rows, neighbours, forward fill, top rows and others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..state.lineage import cut
from .project import q


def over(keys: Sequence[str], order: Sequence[Column]):
    return Window.partitionBy(*map(q, keys)).orderBy(*order)


def top_ranked(df: DataFrame, keys: Sequence[str], measure: str, most: int, name: str = "rank", ascending: bool = False) -> DataFrame:
    """Rows of rank up to most in their key; equal measures share a rank and all stay."""
    order = q(measure).asc_nulls_last() if ascending else q(measure).desc_nulls_last()
    return df.withColumn(name, F.rank().over(over(keys, [order]))).where(F.col(name) <= most)


def latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The last row of each key."""
    return df.withColumn("__rn", F.row_number().over(over(keys, [q(o).desc_nulls_last() for o in order_by]))).where("__rn = 1").drop("__rn")


def link_neighbours(df: DataFrame, keys: Sequence[str], ident: str, order: Sequence[Column], next_name: str = "next_doc", prev_name: str = "prev_doc") -> DataFrame:
    w = over(keys, order)
    return df.withColumn(next_name, F.lead(q(ident)).over(w)).withColumn(prev_name, F.lag(q(ident)).over(w))


def fill_forward(df: DataFrame, columns: Sequence[str], order_by: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Nulls take the last value before them in their key."""
    if not keys:
        return fill_forward_all(df, columns, order_by)
    w = over(keys, [q(o) for o in order_by]).rowsBetween(Window.unboundedPreceding, 0)
    for c in columns:
        df = df.withColumn(c, F.last(q(c), ignorenulls=True).over(w))
    return df


#: Rows of a range that one task orders.
RANGE_ROWS = 1_000_000
#: Ranges at most, as the driver has a result of each task, a sample for each range and a row of each; those of larger tables
#: have more rows instead.
MAX_RANGES = 1_000


#: A row's place in the input, by which rows with the same order values are ordered.
PLACE = "__place"


def in_ranges(df: DataFrame, order_by: Sequence[str], rows: int = RANGE_ROWS) -> DataFrame:
    """df with __part, the number of a range of order_by and place that a row is in: as many as its rows need, up to
    MAX_RANGES.

    Rows with the same order values are split by their places, so that they do not gather in a range. The input's plan
    runs once: it is counted and sampled from where it was written, and the ranges are written as their numbers must
    hold for all uses.
    """
    held = cut(df.withColumn(PLACE, F.monotonically_increasing_id()))
    n = max(1, min(-(-held.count() // rows), MAX_RANGES))
    return cut(held.repartitionByRange(n, *map(q, order_by), q(PLACE)).withColumn("__part", F.spark_partition_id()))


def fill_forward_all(df: DataFrame, columns: Sequence[str], order_by: Sequence[str], rows: int = RANGE_ROWS) -> DataFrame:
    """Forward fill over a whole table in its order, without one task for all rows.

    Rows are range-partitioned; each partition fills within itself, and its start is filled from the last values of
    the partitions before it, of which there is one row each. Rows with the same order values keep their places.
    """
    spread = in_ranges(df, order_by, rows)
    by = [*map(q, order_by), q(PLACE)]
    w = Window.partitionBy("__part").orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
    order = F.struct(*by)
    ends = spread.groupBy("__part").agg(*[F.max_by(q(c), F.when(q(c).isNotNull(), order)).alias(c) for c in columns])
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select("__part", *[F.last(q(c), ignorenulls=True).over(before).alias(f"__s_{c}") for c in columns])
    filled = spread
    for c in columns:
        filled = filled.withColumn(c, F.last(q(c), ignorenulls=True).over(w))
    joined = filled.join(F.broadcast(starts), "__part", "left")  # one row a range
    return joined.select(*[F.coalesce(q(c), q(f"__s_{c}")).alias(c) if c in columns else q(c) for c in df.columns])


def number_occurrences(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], name: str = "occurrence") -> DataFrame:
    return df.withColumn(name, F.row_number().over(over(keys, [q(o) for o in order_by])))


def carry_known(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], value: str, name: str | None = None) -> DataFrame:
    """The last known value at each row, its own included."""
    w = over(keys, [q(o) for o in order_by]).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name or value, F.last(q(value), ignorenulls=True).over(w))


def top_and_others(df: DataFrame, keys: Sequence[str], label: str, amounts: Sequence[str], most: int = 4, others: str = "others") -> DataFrame:
    """The rows with the largest first amount, and one row with the sums of all others."""
    w = over(keys, [q(amounts[0]).desc_nulls_last(), q(label)]) if keys else Window.orderBy(q(amounts[0]).desc_nulls_last(), q(label))
    if keys:
        marked = df.withColumn(label, F.when(F.row_number().over(w) <= most, q(label)).otherwise(others))
    else:  # the few largest are found without sorting all rows in one task
        big = df.orderBy(q(amounts[0]).desc_nulls_last(), q(label)).limit(most).select(q(label).alias("__b")).withColumn("__top", F.lit(True))
        marked = df.join(F.broadcast(big), q(label).eqNullSafe(F.col("__b")), "left").withColumn(label, F.when(F.col("__top"), q(label)).otherwise(others))
    return marked.groupBy(*map(q, keys), q(label)).agg(*[F.sum(q(a)).alias(a) for a in amounts])


def gaps_filled(df: DataFrame, keys: Sequence[str], time: str, item: str, value: str) -> DataFrame:
    """For each key, item and time of the key, the item's last value by then; sums over items give running totals."""
    times = df.select(*map(q, keys), q(time)).distinct()
    items = df.select(*map(q, keys), q(item)).distinct()
    grid = times.join(items, list(keys)).join(df.select(*map(q, keys), q(time), q(item), q(value)), [*keys, time, item], "left")
    return carry_known(grid, [*keys, item], [time], value)


def numbered(df: DataFrame, order_by: Sequence[str], name: str = "index", rows: int = RANGE_ROWS) -> DataFrame:
    """Row numbers from 0 on in an order, without gaps: ranges are counted first, so that no task sorts all rows. Rows
    with the same order values are numbered by their places."""
    spread = in_ranges(df, order_by, rows)
    counts = spread.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = counts.select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    rn = F.row_number().over(Window.partitionBy("__part").orderBy(*map(q, order_by), q(PLACE))) + F.col("__before") - 1
    return spread.join(F.broadcast(before), "__part").withColumn(name, rn).drop("__part", "__before", PLACE)  # one row a range


def pages(df: DataFrame, order_by: Sequence[str], size: int = 10_000, name: str = "page") -> DataFrame:
    """Page numbers of rows in an order."""
    return numbered(df, order_by, "__at").withColumn(name, F.floor(F.col("__at") / size).cast("long")).drop("__at")


def log_sample(df: DataFrame, index: str) -> DataFrame:
    """Rows 0 to 10, then the eleven from each power of ten on."""
    power = F.pow(F.lit(10.0), F.floor(F.log10(F.greatest(q(index), F.lit(1))))).cast("long")
    return df.where((q(index) <= 10) | (q(index) - power <= 10))


