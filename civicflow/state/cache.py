"""Answers of outside services, kept by key, so that each question is asked once."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.project import q


def ask(df: DataFrame, question: str, cache: DataFrame | None, fetch: Callable[[list[str]], Sequence[dict | None]], schema: str, most: int | None = None) -> DataFrame:
    """key (sha256 of the question), question and the answer's columns, of all different questions with an answer.

    What the cache has is taken from there. fetch answers a list of questions in a task; None is no answer and is
    asked again next time. most is a service's quota: that many new questions are asked in this run, the rest next time.
    """
    asked = df.select(q(question).alias("question")).where("question is not null and question <> ''").distinct().withColumn("key", F.sha2("question", 256))
    names = [c for c in (cache.columns if cache is not None else [])]
    new = asked if cache is None else asked.join(cache.select("key"), "key", "left_anti")
    if most is not None:
        new = new.orderBy("key").limit(most)

    def run(parts: Iterator) -> Iterator:
        import pandas as pd

        for pdf in parts:
            answers = fetch(pdf["question"].tolist())
            rows = [{"key": k, "question": s, **a} for k, s, a in zip(pdf["key"], pdf["question"], answers) if a is not None]
            yield pd.DataFrame(rows, columns=columns)

    columns = ["key", "question", *[part.split()[0] for part in schema.split(", ")]]
    made = new.select("key", "question").mapInPandas(run, f"key string, question string, {schema}")
    if cache is None:
        return made
    return made.unionByName(asked.select("key").join(cache.select(*names), "key"))
