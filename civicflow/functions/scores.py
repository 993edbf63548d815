"""Scores of documents for search ranking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import first_number


def amount_score(amount: Column, divisor: float = 1000) -> Column:
    return F.greatest(F.lit(1.0), F.coalesce(amount.cast("double"), F.lit(0.0)) / divisor)


def budget_score(net: Column, code: Column, year: Column, this_year: int) -> Column:
    """Thousands, halved for each three years after the first, and halved for income and loan codes."""
    age = F.greatest(F.lit(1), F.lit(this_year) - year) - 1
    score = amount_score(net) / F.pow(F.lit(2.0), age / 3)
    return F.when(code.startswith("0000") | code.startswith("C8"), score / 2).otherwise(score)


def transaction_score(amounts: Sequence[Column], divisors: Sequence[float], year: Column, this_year: int) -> Column:
    total = sum((F.abs(F.coalesce(a.cast("double"), F.lit(0.0)) / d) for a, d in zip(amounts, divisors)), F.lit(0.0))
    return F.greatest(F.lit(1.0), total / F.pow(F.lit(2.0), F.abs(F.lit(this_year) - year)))


def boosted_score(amount: Column, boosts: Sequence[tuple[Column, Mapping[str, float]]], least: float = 1.0) -> Column:
    """amount times the booster of each category; 1 for categories without one."""
    out = F.greatest(F.lit(least), F.coalesce(amount.cast("double"), F.lit(0.0)) / 1000)
    for c, table in boosts:
        factor = F.lit(1.0)
        for value, x in table.items():
            factor = F.when(c == value, x).otherwise(factor)
        out = out * factor
    return out


def age_score(day: Column, as_of: Column) -> Column:
    return F.greatest(F.lit(1.0), 30 - F.datediff(as_of, day) / 365)


def report_score(total: Column, count: Column) -> Column:
    return 10 + F.coalesce(first_number(total, count), F.lit(0))


def program_score(approved: Column, span: Column) -> Column:
    return 1 + approved / 1000 / F.sqrt(span)


def safe_ratio(a: Column, b: Column) -> Column:
    return a / F.nullif(b, F.lit(0))


def weighted_answers(answers: Sequence[tuple[Column, float, float]]) -> Column:
    """Share of the best possible sum of (answer, weight, best answer); unanswered questions do not count."""
    got = sum((F.coalesce(a * w, F.lit(0.0)) for a, w, _ in answers), F.lit(0.0))
    best = sum((F.when(a.isNotNull(), w * m).otherwise(0.0) for a, w, m in answers), F.lit(0.0))
    return safe_ratio(got, best)


def muni_score(revised: Column, executed: Column, allocated: Column) -> Column:
    return F.abs(F.coalesce(first_number(revised, executed, allocated), F.lit(1000))) / 1000


def staleness(days: Column, planned: Column) -> Column:
    overdue = F.greatest(F.lit(1), days - planned)
    return (100000 + 100000 / (1 + overdue)).cast("int")


def scaled(c: Column, factor: int) -> Column:
    return c * factor


def normalise_series(value: Column, base: Column, percent: bool = False) -> Column:
    out = safe_ratio(value.cast("double"), base.cast("double"))
    return out * 100 if percent else out
