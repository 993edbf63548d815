"""Values as loosely typed rows treat them: truth, text forms, templates, fallbacks."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def py_str(c: Column, kind: T.DataType | None = None) -> Column:
    """Text of a value as hashes and templates have it: null as None, booleans capitalised."""
    if isinstance(kind, T.BooleanType):
        return F.when(c.isNull(), "None").when(c, "True").otherwise("False")
    return F.coalesce(c.cast("string"), F.lit("None"))


def truthy(c: Column, kind: T.DataType) -> Column:
    """Not null, zero, empty or false; never null itself."""
    if isinstance(kind, T.BooleanType):
        test = c
    elif isinstance(kind, T.StringType):
        test = c != ""
    elif isinstance(kind, (T.ArrayType, T.MapType)):
        test = F.size(c) > 0
    elif isinstance(kind, T.NumericType):
        test = c != 0
    else:
        test = F.lit(True)
    return c.isNotNull() & F.coalesce(test, F.lit(False))


def first_text(*columns: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def first_number(*columns: Column) -> Column:
    """The first that is neither null nor zero."""
    return F.coalesce(*[F.nullif(c, F.lit(0)) for c in columns])


_FIELD = re.compile(r"\{([A-Za-z_][\w-]*)(?:\[(\d+)\])?(?::([^}]*))?\}")
_DATES = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss"}


def _formatted(c: Column, spec: str) -> Column:
    if m := re.fullmatch(r"0(\d+)d", spec):
        text = c.cast("long").cast("string")
        return F.when(F.length(text) >= int(m[1]), text).otherwise(F.lpad(text, int(m[1]), "0"))
    if spec == ",":
        return F.regexp_replace(F.format_number(c.cast("double"), 6), r"\.?0+$", "")
    if m := re.fullmatch(r",\.(\d)f", spec):
        return F.format_number(c.cast("double"), int(m[1]))
    if m := re.fullmatch(r"\.(\d+)f", spec):
        return F.format_string(f"%.{m[1]}f", c.cast("double"))
    pattern = re.sub("[A-Za-z]+", lambda w: f"'{w[0]}'", re.sub("%[A-Za-z]", "\0", spec))
    for code in re.findall("%[A-Za-z]", spec):
        pattern = pattern.replace("\0", _DATES[code], 1)
    return F.date_format(c, pattern)


def template(text: str) -> Column:
    """A row template: {field}, {array[0]}, {number:02d}, {amount:,}, {date:%Y-%m}; null is written None."""
    parts, at = [], 0
    for m in _FIELD.finditer(text):
        parts.append(F.lit(text[at : m.start()]))
        c = F.col(f"`{m[1]}`")
        if m[2] is not None:
            c = F.get(c, F.lit(int(m[2])))
        parts.append(F.coalesce(_formatted(c, m[3]) if m[3] else c.cast("string"), F.lit("None")))
        at = m.end()
    parts.append(F.lit(text[at:]))
    return F.concat(*parts)


def loose_number(c: Column, group: str = ",") -> Column:
    """A number out of decorated text; null if none is there."""
    plain = F.regexp_replace(c.cast("string"), f"[{re.escape(group)}\\s]", "")
    return F.regexp_extract(plain, r"(-?[0-9]+(?:\.[0-9]+)?)", 1).try_cast("decimal(38,6)")


def to_boolean(c: Column, true: list[str], false: list[str]) -> Column:
    return F.when(c.isin(true), True).when(c.isin(false), False)
