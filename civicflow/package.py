"""A package: named tables with metadata, and how steps pick some of them."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame

Selector = None | int | str | Sequence[str]


@dataclass(frozen=True)
class Package:
    """Ordered tables and descriptive metadata. Never changed in place: each step returns a new one."""

    resources: Mapping[str, DataFrame] = field(default_factory=dict)
    meta: Mapping[str, Any] = field(default_factory=dict)

    def select(self, selector: Selector = None) -> list[str]:
        """Names by exact name or whole-name pattern, list of those, place (negative from the end), or None for all."""
        names = list(self.resources)
        if selector is None:
            return names
        if isinstance(selector, int):
            return [names[selector]]
        if isinstance(selector, str):
            return [selector] if selector in self.resources else [n for n in names if re.fullmatch(selector, n)]
        wanted = {n for s in selector for n in self.select(s)}
        return [n for n in names if n in wanted]

    def __getitem__(self, selector: int | str) -> DataFrame:
        found = self.select(selector)
        if len(found) != 1:
            raise KeyError(f"{selector!r} picks {found or 'nothing'}")
        return self.resources[found[0]]

    def with_resources(self, resources: Mapping[str, DataFrame]) -> Package:
        return replace(self, resources=dict(resources))

    def put(self, name: str, df: DataFrame) -> Package:
        return self.with_resources({**self.resources, name: df})

    def drop(self, selector: Selector) -> Package:
        gone = set(self.select(selector))
        return self.with_resources({n: d for n, d in self.resources.items() if n not in gone})

    def rename(self, source: str, target: str) -> Package:
        return self.with_resources({target if n == source else n: d for n, d in self.resources.items()})

    def duplicate(self, source: str, target: str) -> Package:
        """The copy shares the plan; nothing is computed or stored twice."""
        return self.put(target, self[source])

    def map(self, f: Callable[[DataFrame], DataFrame], selector: Selector = None) -> Package:
        picked = set(self.select(selector))
        return self.with_resources({n: f(d) if n in picked else d for n, d in self.resources.items()})

    def add_metadata(self, **meta: Any) -> Package:
        return replace(self, meta={**self.meta, **meta})


def drain(package: Package) -> dict[str, int]:
    """Row counts of all tables."""
    return {n: d.count() for n, d in package.resources.items()}
