"""From a table to search documents: revisions, history, ids, titles, date ranges, chunks, redirects, documents."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_range
from ..functions.ids import short_id
from ..functions.text import chunks
from ..functions.values import template
from ..operators.arrays import keyed_document
from ..operators.project import q
from ..sinks.writers import search_documents
from ..state.history import history_updates
from ..state.revisions import changed_only, manage_revisions, revision_dates, set_revision


@dataclass(frozen=True)
class DocType:
    """How a kind of rows becomes documents."""

    name: str
    keys: Sequence[str]
    title: str
    key_pattern: str | None = None
    dates: Mapping[str, Any] = field(default_factory=lambda: {"mode": "no-date-range"})
    history: Sequence[Sequence[str]] = ()
    chunk: str | None = None
    revision: int = 0
    before_indexing: Sequence[Callable[[DataFrame], DataFrame]] = ()

    @property
    def pattern(self) -> str:
        return self.key_pattern or "/".join([self.name, *("{%s}" % k for k in self.keys)])


@dataclass(frozen=True)
class Indexed:
    mirror: DataFrame
    documents: DataFrame
    history: Mapping[tuple[str, ...], DataFrame]
    pages: DataFrame


def revision_number(base: int, today: dt.date, epoch: dt.date = dt.date(2019, 3, 1), bump: int = 0) -> int:
    """Weeks since the epoch on top of the base, so that all documents are written again each week."""
    return base + (today - epoch).days // 7 + bump


def embed(df: DataFrame, text: str, model: Callable[[list[str]], list[list[float]]], cache: DataFrame | None = None) -> DataFrame:
    """vector of each different text: from the cache by its sha256, else by the model, in Arrow batches."""
    keyed = df.select(q(text).alias("text")).where(q("text").isNotNull()).distinct().withColumn("sha", F.sha2("text", 256))
    known = keyed.join(cache, "sha") if cache is not None else None
    new = keyed.join(cache.select("sha"), "sha", "left_anti") if cache is not None else keyed

    def run(parts):
        for pdf in parts:
            yield pdf.assign(vector=model(pdf["text"].tolist()))

    made = new.select("sha", "text").mapInPandas(run, "sha string, text string, vector array<float>")
    return made if known is None else made.unionByName(known.select("sha", "text", "vector"))


def index(df: DataFrame, doc: DocType, mirror: DataFrame | None, as_of: dt.datetime, histories: Mapping[tuple[str, ...], DataFrame] | None = None) -> Indexed:
    """A run of the indexer for one kind. mirror is what the last run left, None at first.

    Everything is one plan until a sink asks: revisions against the mirror, then only what changed becomes documents.
    """
    revision = revision_number(doc.revision, as_of.date())
    managed = manage_revisions(set_revision(df, revision), mirror, doc.keys, as_of)
    changed = changed_only(revision_dates(managed))
    updates = {tuple(f): history_updates(changed, (histories or {}).get(tuple(f)), doc.keys, f, as_of.date(), list(f)) for f in doc.history}
    dates = {k: (q(v) if k in ("first", "last") else v) for k, v in doc.dates.items()}
    span: Column = date_range(**dates)
    pages = changed.withColumn("doc_id", template(doc.pattern)).withColumn("page_title", template(doc.title)).withColumn("__d", span)
    pages = pages.select("*", F.col("__d.date_from").alias("__date_range_from"), F.col("__d.date_to").alias("__date_range_to"), F.col("__d.months").alias("__date_range_months")).drop("__d")
    for f in doc.before_indexing:
        pages = f(pages)
    if doc.chunk:
        pages = pages.withColumn("chunks", chunks(q(doc.chunk)))
    documents = keyed_document(pages, F.col("doc_id"), revision)
    redirects = pages.select(short_id(F.col("doc_id")).alias("key"), F.to_json(F.struct(F.lit("redirect").alias("kind"), F.col("doc_id").alias("to"))).alias("value"), F.lit(revision).alias("__revision"))
    return Indexed(managed, documents.unionByName(redirects), updates, search_documents(pages))


def pipelines(types: Sequence[DocType], source: str, depends_on: Mapping[str, str], limit: int | None = None) -> dict[str, dict[str, Any]]:
    """Step lists that index each kind, and one for the sitemaps that depends on all of them."""
    out: dict[str, dict[str, Any]] = {}
    for t in types:
        steps: list[dict[str, Any]] = [{"run": "load", "parameters": {"path": f"{source}/{t.name}", "resource": t.name}}]
        if limit:
            steps.append({"run": "limit_rows", "parameters": {"resources": t.name, "stop_after_rows": limit}})
        steps += [{"run": "index", "parameters": {"resource": t.name}}, {"run": "dump_to_path", "parameters": {"path": f"documents/{t.name}"}}]
        out[f"index_{t.name}"] = {"dependencies": [{"pipeline": depends_on[t.name]}] if t.name in depends_on else [], "pipeline": steps}
    out["sitemaps"] = {"dependencies": [{"pipeline": n} for n in out], "pipeline": [{"run": "sitemap", "parameters": {"kinds": [t.name for t in types]}}]}
    return out
