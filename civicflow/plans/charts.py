"""Chart documents: nested structs that pages draw; pure projections and small arrays."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.project import q


def table(rows: Column, headers: Sequence[str], cells: Sequence) -> Column:
    """headers and data: a list of texts for each struct of an array."""
    data = F.transform(rows, lambda r: F.array(*[c(r).cast("string") for c in cells]))
    return F.struct(F.array(*map(F.lit, headers)).alias("headers"), data.alias("data"))


def traces(history: Column, names: Mapping[str, str]) -> Column:
    """A line for each measure of a history map, years in order."""
    entries = F.array_sort(F.map_entries(history))
    return F.array(*[_trace(entries, m, title) for m, title in names.items()])


def _trace(entries: Column, measure: str, title: str) -> Column:
    return F.struct(F.lit(title).alias("name"), F.lit("lines+markers").alias("mode"), F.transform(entries, lambda e: e["key"].cast("string")).alias("x"), F.transform(entries, lambda e: e["value"][measure].cast("double")).alias("y"))


def flow_groups(children: Column, amount: str, title: str, most: int = 10, others: str = "אחרים") -> Column:
    """Parts of a whole for a flow chart: the largest, and one for all others; without amounts none."""
    positive = F.filter(children, lambda c: c[amount] > 0)
    keyed = F.array_sort(F.transform(positive, lambda c: F.struct((-c[amount].cast("double")).alias("k"), c[title].alias("t"))))
    top = F.transform(F.slice(keyed, 1, most), lambda x: F.struct(x["t"].alias("label"), (-x["k"]).alias("size")))
    rest = F.slice(keyed, most + 1, 1_000_000)
    left = F.aggregate(rest, F.lit(0.0), lambda a, x: a - x["k"])
    return F.when(F.size(rest) > 0, F.concat(top, F.array(F.struct(F.lit(others).alias("label"), left.alias("size"))))).otherwise(top)


def comparison(df: DataFrame, key: str, value: str, groups: Sequence[str], name: str = "comparison") -> DataFrame:
    """Each row's value beside the mean and rank of its group."""
    from pyspark.sql.window import Window

    w = Window.partitionBy(*map(q, groups))
    ranked = F.rank().over(w.orderBy(q(value).desc_nulls_last()))
    return df.select(q(key), F.struct(q(value).alias("value"), F.avg(q(value)).over(w).alias("mean"), ranked.alias("rank"), F.count(F.lit(1)).over(w).alias("of")).alias(name))
