"""Identifiers and check digits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import py_str


def short_id(doc_id: Column, length: int = 12) -> Column:
    return F.substring(F.md5(doc_id.cast("string")), 1, length)


def publication_id(factor: int, *columns: Column, existing: Column | None = None) -> Column:
    """A number from the md5 of the columns' texts, after factor; one that exists and is not zero stays."""
    head = F.conv(F.substring(F.md5(F.concat(*map(py_str, columns))), 1, 8), 16, 10).cast("long")
    made = F.lit(factor * 100_000_000).cast("long") + head % 100_000_000
    return made if existing is None else F.coalesce(F.nullif(existing.cast("long"), F.lit(0)), made)


def israeli_id(c: Column) -> Column:
    """Whether the check digit of an id of 7 to 9 digits is right; company numbers, nine digits from 5 on, are not ids."""
    text = c.cast("string")
    shape = text.rlike("^[0-9]{7,9}$") & ~text.rlike("^5[0-9]{8}$")
    digits = F.filter(F.split(F.reverse(text), ""), lambda d: d.rlike("^[0-9]$"))

    def value(d: Column, i: Column) -> Column:
        twice = d.cast("int") * 2
        return F.when(i % 2 == 0, d.cast("int")).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.coalesce(shape & (F.aggregate(F.transform(digits, value), F.lit(0), lambda a, x: a + x) % 10 == 0), F.lit(False))
