"""Services that hand out pages or ranges, as a Spark data source whose partitions are the requests."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Fetch = Callable[[Mapping[str, object]], Sequence[Mapping[str, object]]]


def fetch_requests(spark: SparkSession, requests: Sequence[Mapping[str, object]], fetch: Fetch, schema: str, slots: int | None = None) -> DataFrame:
    """Rows of all requests, each made by a task; a failed task makes its requests again. Rows keep no order."""
    import json

    names = T.StructType.fromDDL(schema).names
    kinds = spark.createDataFrame([(json.dumps(r, default=str),) for r in requests], "request string")
    spread = kinds.repartition(slots or max(1, len(requests)))

    def run(parts: Iterator) -> Iterator:
        import pandas as pd

        for pdf in parts:
            for text in pdf["request"]:
                rows = fetch(json.loads(text))
                yield pd.DataFrame([{n: r.get(n) for n in names} for r in rows], columns=names)

    return spread.mapInPandas(run, schema)


def paged(spark: SparkSession, fetch: Fetch, schema: str, total: int, size: int) -> DataFrame:
    """All pages of a service that takes skip and limit and tells its total."""
    return fetch_requests(spark, [{"skip": a, "limit": size} for a in range(0, total, size)], fetch, schema)


def paged_until_empty(spark: SparkSession, fetch: Fetch, schema: str, size: int, stripes: int = 8) -> DataFrame:
    """All pages of a service that takes skip and limit and tells no total: each of some tasks reads every stripes-th
    page until one is empty. A failed task reads its pages again; rows keep no order."""
    names = T.StructType.fromDDL(schema).names

    def run(parts: Iterator) -> Iterator:
        import pandas as pd

        for pdf in parts:
            for first in pdf["first"]:
                page = int(first)
                while rows := fetch({"skip": page * size, "limit": size}):
                    yield pd.DataFrame([{n: r.get(n) for n in names} for r in rows], columns=names)
                    page += stripes

    return spark.range(0, stripes, 1, stripes).withColumnRenamed("id", "first").mapInPandas(run, schema)


def split_ranges(first: dt.date, last: dt.date, count: Callable[[dt.date, dt.date], int], most: int = 1000) -> list[tuple[dt.date, dt.date]]:
    """Date ranges of fewer than most rows each, by halving; a single day may hold more."""
    out, todo = [], [(first, last)]
    while todo:
        a, b = todo.pop()
        if a < b and count(a, b) >= most:
            mid = a + (b - a) // 2
            todo += [(mid + dt.timedelta(days=1), b), (a, mid)]
        else:
            out.append((a, b))
    return out


#: Sums up to the first and from the second on make up all sums.
SMALL_SUM, LARGE_SUM = 49.93, 49.94


def split_requests(first: dt.date, last: dt.date, count: Callable[[Mapping[str, object]], int], most: int = 1000) -> list[dict]:
    """Requests from, to, from_sum, to_sum of fewer than most rows each: ranges are halved, and a single day that holds
    too many is asked for in small and in large sums."""
    whole = lambda a, b: count({"from": a, "to": b, "from_sum": None, "to_sum": None})
    out = []
    for a, b in split_ranges(first, last, whole, most):
        sums = [(None, None)] if a < b or whole(a, b) < most else [(None, SMALL_SUM), (LARGE_SUM, None)]
        out += [{"from": a, "to": b, "from_sum": x, "to_sum": y} for x, y in sums]
    return out


def first_page_per_key(df: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """Of rows that several pages repeat, the first."""
    return df.groupBy(*keys).agg(*[F.min_by(c, order_by).alias(c) for c in df.columns if c not in keys])
