"""Projection, typing and schema operators."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import template


def q(name: str) -> Column:
    return F.col(f"`{name}`")


def matching(df: DataFrame, names: Sequence[str] | str) -> list[str]:
    """Columns that one of the names or whole-name patterns picks, in table order."""
    wanted = [names] if isinstance(names, str) else list(names)
    return [c for c in df.columns if any(c == w or re.fullmatch(w, c) for w in wanted)]


def select_fields(df: DataFrame, names: Sequence[str] | str) -> DataFrame:
    return df.select(*map(q, matching(df, names)))


def delete_fields(df: DataFrame, names: Sequence[str] | str) -> DataFrame:
    gone = set(matching(df, names))
    return df.select(*[q(c) for c in df.columns if c not in gone])


def rename_fields(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def add_field(df: DataFrame, name: str, kind: str, value: Column | Any = None) -> DataFrame:
    return df.withColumn(name, (value if isinstance(value, Column) else F.lit(value)).cast(kind))


def add_computed(df: DataFrame, name: str, operation: str, source: Sequence[str] = (), with_: Any = None) -> DataFrame:
    """constant (with_), format (with_ is a template), sum, max, min, multiply or join (with_ is glue) of source columns; nulls are skipped."""
    columns = [q(c) for c in source]
    made = {
        "constant": lambda: F.lit(with_),
        "format": lambda: template(with_),
        "sum": lambda: sum((F.coalesce(c, F.lit(0)) for c in columns[1:]), F.coalesce(columns[0], F.lit(0))),
        "max": lambda: F.greatest(*columns) if len(columns) > 1 else columns[0],
        "min": lambda: F.least(*columns) if len(columns) > 1 else columns[0],
        "multiply": lambda: _product(columns),
        "join": lambda: F.concat_ws(with_ or "", *[c.cast("string") for c in columns]),
    }
    return df.withColumn(name, made[operation]())


def _product(columns: list[Column]) -> Column:
    out = F.coalesce(columns[0], F.lit(1))
    for c in columns[1:]:
        out = out * F.coalesce(c, F.lit(1))
    return out


def typed(c: Column, kind: str, format: str | None = None, group: str | None = None, missing: Sequence[str] = ("",), bare: bool = True) -> Column:
    """A text column as a declared type: null for missing marks and for what does not fit."""
    text = c.cast("string")
    text = F.when(~text.isin(*missing), text) if missing else text
    if kind in ("date", "timestamp"):
        at = F.try_to_timestamp(text, F.lit(format)) if format else F.try_to_timestamp(text)
        return at.cast(kind)
    if kind.startswith(("decimal", "double", "int", "long", "bigint")):
        if group:
            text = F.replace(text, F.lit(group), F.lit(""))
        if not bare:
            text = F.regexp_extract(text, r"(-?[0-9]+(?:\.[0-9]+)?)", 1)
        return F.trim(text).try_cast(kind)
    return text.try_cast(kind)


def set_types(df: DataFrame, types: Mapping[str, str | Mapping[str, Any]]) -> DataFrame:
    """Types by column name or pattern; a mapping may hold type, format, group, missing, bare, and metadata."""
    out: dict[str, Column] = {}
    metas: dict[str, dict] = {c: dict(df.schema[c].metadata) for c in df.columns}
    for pattern, spec in types.items():
        spec = {"type": spec} if isinstance(spec, str) else dict(spec)
        meta, kind = spec.pop("metadata", {}), spec.pop("type")
        for name in matching(df, pattern):
            out[name] = typed(q(name), kind, **spec)
            metas[name] |= meta
    return df.select(*[out.get(c, q(c)).alias(c, metadata=metas[c]) for c in df.columns])


def with_metadata(df: DataFrame, name: str, **meta: Any) -> DataFrame:
    return df.withMetadata(name, {**df.schema[name].metadata, **meta})


def set_primary_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Marks the key in the columns' metadata; none clears it."""
    for c in df.columns:
        meta = {k: v for k, v in df.schema[c].metadata.items() if k != "primaryKey"}
        if c in keys:
            meta["primaryKey"] = list(keys).index(c)
        if meta != df.schema[c].metadata:
            df = df.withMetadata(c, meta)
    return df


def primary_key(df: DataFrame) -> list[str]:
    keyed = [(f.metadata["primaryKey"], f.name) for f in df.schema.fields if "primaryKey" in f.metadata]
    return [name for _, name in sorted(keyed)]


def clean_names(df: DataFrame) -> DataFrame:
    """No-break spaces in column names as blanks."""
    return df.toDF(*[c.replace("\xa0", " ").strip() for c in df.columns])


def translate_names(df: DataFrame, words: Mapping[str, str]) -> DataFrame:
    """Names word by word through a dictionary, joined by underscores; words that map to nothing go, repeats are numbered."""
    seen: dict[str, int] = {}
    out = []
    for c in df.columns:
        parts = [words.get(w, w) for w in re.split(r"[\s_]+", c)]
        name = "_".join(p for p in parts if p) or "column"
        seen[name] = seen.get(name, 0) + 1
        out.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return df.toDF(*out)


def publish(df: DataFrame, fields: Sequence[Mapping[str, Any]]) -> DataFrame:
    """A published table from field specs, in order: name, then default or transform (Columns or functions of the table),
    filter, type and description. Each sees the fields before it as they were rewritten."""
    for f in fields:
        name, value = f["name"], f.get("transform", f.get("default"))
        if value is not None:
            value = value(df) if callable(value) and not isinstance(value, Column) else value
            df = df.withColumn(name, value if isinstance(value, Column) else F.lit(value))
        if "type" in f:
            df = df.withColumn(name, q(name).try_cast(f["type"]))
        if "filter" in f:
            keep = f["filter"]
            df = df.where(keep(q(name)) if callable(keep) and not isinstance(keep, Column) else keep)
    out = df.select(*[q(f["name"]) for f in fields])
    for f in fields:
        if "description" in f:
            out = with_metadata(out, f["name"], description=f["description"])
    return out


def validate(df: DataFrame, checks: Mapping[str, Mapping[str, Any]], on_error: str = "fail") -> DataFrame:
    """Constraints by column: required, minLength, pattern, enum, minimum, maximum.

    on_error: fail (a row that breaks one stops the job), drop it, clear the value, or ignore.
    """
    if on_error == "ignore":
        return df
    for name, rules in checks.items():
        c = q(name)
        bad = F.lit(False)
        if rules.get("required"):
            bad = bad | c.isNull()
        if "minLength" in rules:
            bad = bad | (F.length(c) < rules["minLength"])
        if "pattern" in rules:
            bad = bad | ~c.rlike(f"^(?:{rules['pattern']})$")
        if "enum" in rules:
            bad = bad | ~c.isin(*rules["enum"])
        if "minimum" in rules:
            bad = bad | (c < rules["minimum"])
        if "maximum" in rules:
            bad = bad | (c > rules["maximum"])
        bad = F.coalesce(bad, F.lit(False))
        if on_error == "drop":
            df = df.where(~bad)
        elif on_error == "clear":
            df = df.withColumn(name, F.when(~bad, c))
        else:
            df = df.withColumn(name, F.when(bad, F.raise_error(F.concat(F.lit(f"{name} breaks its constraints: "), F.coalesce(c.cast("string"), F.lit("null"))))).otherwise(c))
    return df


def type_conflicts(tables: Mapping[str, DataFrame]) -> dict[str, set[str]]:
    """Columns that tables to be merged declare with different types."""
    kinds: dict[str, set[str]] = {}
    for df in tables.values():
        for name, kind in df.dtypes:
            kinds.setdefault(name, set()).add(kind)
    return {n: k for n, k in kinds.items() if len(k) > 1}


def empty_table(df: DataFrame) -> DataFrame:
    """The schema without rows."""
    return df.where(F.lit(False))


def dummy_table(spark, column: str = "dummy") -> DataFrame:
    return spark.createDataFrame([], T.StructType([T.StructField(column, T.StringType())]))


Step = Callable[[DataFrame], DataFrame]


def flow(df: DataFrame, *steps: Step) -> DataFrame:
    """Steps one after another; nothing runs before a sink asks for rows."""
    for step in steps:
        df = step(df)
    return df


def tapped(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, Observation]:
    """df, and what passes through it once it has run: n rows and the measures given, at no extra pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in measures.items()]), seen


def long_ids(df: DataFrame, ident: str, most: int = 400) -> tuple[DataFrame, Observation]:
    """df, and how many of its ids are over so many bytes, as too_long, with one of them as example."""
    long_ = F.octet_length(q(ident)) > most
    return tapped(df, "long_ids", too_long=F.count(F.when(long_, 1)), example=F.max(F.when(long_, q(ident))))
