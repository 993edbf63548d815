"""Pipelines as lists of named steps, and the order in which pipelines depend on each other."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from graphlib import TopologicalSorter
from typing import Any

from pyspark.sql import functions as F

from ..functions.values import template
from ..operators import aggregates, arrays, filters, joins, project, setops, windows
from ..package import Package
from ..sinks import writers

#: step(package, **parameters) -> package
Step = Callable[..., Package]
STEPS: dict[str, Step] = {}


def step(name: str) -> Callable[[Step], Step]:
    """Registers a step; another module may add its own under a new name."""

    def register(f: Step) -> Step:
        STEPS[name] = f
        return f

    return register


def on_tables(name: str, f: Callable) -> None:
    STEPS[name] = lambda package, resources=None, **p: package.map(lambda df: f(df, **p), resources)


on_tables("filter", lambda df, in_=(), out=(), **p: filters.filter_rows(df, in_ or p.get("in", ()), out))
on_tables("select_fields", lambda df, fields: project.select_fields(df, fields))
on_tables("delete_fields", lambda df, fields: project.delete_fields(df, fields))
on_tables("rename_fields", lambda df, fields: project.rename_fields(df, fields))
on_tables("set_types", lambda df, types: project.set_types(df, types))
on_tables("set_primary_key", lambda df, keys: project.set_primary_key(df, keys))
on_tables("validate", lambda df, checks, on_error="fail": project.validate(df, checks, on_error))
on_tables("sort", lambda df, by, reverse=False: df.orderBy(*[(F.col(c).desc_nulls_last() if reverse else F.col(c).asc_nulls_first()) for c in by]) if not isinstance(by, str) else df.orderBy(template(by).desc() if reverse else template(by)))
on_tables("limit_rows", lambda df, stop_after_rows: df.limit(stop_after_rows))
on_tables("drop_all_rows", project.empty_table)
on_tables("unwind_array", lambda df, array, name: arrays.unwind(df, array, name))
on_tables("clean_names", project.clean_names)
on_tables("add_doc_id", lambda df, pattern: df.withColumn("doc_id", template(pattern)))
on_tables("add_page_title", lambda df, pattern: df.withColumn("page_title", template(pattern)))
on_tables("group", lambda df, keys, fields, order_by=(): aggregates.group(df, keys, fields, order_by))
on_tables("collate", lambda df, keys, name, order_by=None: aggregates.collate(df, keys, name, order_by))
on_tables("dedup", lambda df, keys, order_by: windows.latest(df, keys, order_by))


@step("add_computed_field")
def _computed(package: Package, fields: Sequence[Mapping[str, Any]], resources=None) -> Package:
    for f in fields:
        package = package.map(lambda df, f=f: project.add_computed(df, f["target"], f["operation"], f.get("source", ()), f.get("with")), resources)
    return package


@step("add_metadata")
def _metadata(package: Package, **meta: Any) -> Package:
    return package.add_metadata(**meta)


@step("rename_resource")
def _rename(package: Package, source: str, target: str) -> Package:
    return package.rename(source, target)


@step("drop_resource")
def _drop(package: Package, resource) -> Package:
    return package.drop(resource)


@step("duplicate")
def _duplicate(package: Package, source: str, target: str) -> Package:
    return package.duplicate(source, target)


@step("concatenate")
def _concatenate(package: Package, target: str, fields, sources=None) -> Package:
    return setops.concatenate_resources(package, sources, target, fields)


@step("join")
def _join(package: Package, source: Mapping[str, Any], target: Mapping[str, Any], fields, full: bool = True, order_by=()) -> Package:
    """A lookup join, or a grouping of the source into a new table where the target has no key. The source goes unless delete is false."""
    table = package[source["name"]]
    if target.get("key") is None:
        keys = [source["key"]] if isinstance(source["key"], str) else list(source["key"])
        made = aggregates.group(table, keys, fields, order_by)
    else:
        made = joins.lookup_join(package[target["name"]], table, source["key"], target["key"], fields, full, order_by=order_by)
    package = package.drop(source["name"]) if source.get("delete", True) else package
    return package.put(target["name"], made)


@step("dump_to_path")
def _dump(package: Package, path: str, format: str = "csv") -> Package:
    writers.dump(package, path, format)
    return package


def run(package: Package, steps: Sequence[Mapping[str, Any]], registry: Mapping[str, Step] | None = None) -> Package:
    """Steps in order, each {run, parameters}. Only sinks make Spark work; what stands between them is one plan."""
    known = {**STEPS, **(registry or {})}
    for s in steps:
        if s["run"] not in known:
            raise KeyError(f"no step {s['run']}")
        package = known[s["run"]](package, **s.get("parameters", {}))
    return package


def order(pipelines: Mapping[str, Mapping[str, Any]]) -> list[str]:
    """Names so that each comes after those it depends on; a cycle raises."""
    graph = {n: [d["pipeline"] for d in p.get("dependencies", ()) if d["pipeline"] in pipelines] for n, p in pipelines.items()}
    return list(TopologicalSorter(graph).static_order())


def load(text: str) -> dict[str, dict]:
    """Pipelines of a YAML text."""
    import yaml

    return yaml.safe_load(text)


def run_all(pipelines: Mapping[str, Mapping[str, Any]], start: Callable[[str], Package], registry: Mapping[str, Step] | None = None) -> dict[str, Package]:
    done = {}
    for name in order(pipelines):
        done[name] = run(start(name), pipelines[name]["pipeline"], registry)
    return done
