"""Dates from loose text, periods and ranges. Today is always an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_any(c: Column, formats: list[str], last_wins: bool = True) -> Column:
    """A date by the formats that fit; of several, the last (or first) of the list decides."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)).cast("date") for f in (reversed(formats) if last_wins else formats)])


def loose_date(c: Column) -> Column:
    """Day numbers count from 1900-01-01; d/m/y and y/m/d (with a time) of any separators; years under 100 are of 2000."""
    text = F.trim(c.cast("string"))
    parts = F.transform(F.regexp_extract_all(text, F.lit("([0-9]+)"), F.lit(1)), lambda x: x.try_cast("int"))
    full = lambda y: F.when(y < 100, y + 2000).otherwise(y)
    part = lambda i: F.get(parts, F.lit(i))
    made = lambda y, m, d: F.try_to_timestamp(F.format_string("%04d-%02d-%02d", full(y), m, d), F.lit("yyyy-MM-dd")).cast("date")
    serial = text.try_cast("double")
    # Day numbers beyond the calendar are no dates.
    return (
        F.when(serial.isNotNull(), F.when(serial.between(-693593, 2958463), F.date_add(F.lit("1900-01-01").cast("date"), serial.cast("int"))))
        .when(F.size(parts) == 3, made(part(2), part(1), part(0)))
        .when(F.size(parts) == 6, made(part(0), part(1), part(2)))
    )


def period_date(year: Column, quarter: Column, publication: bool = True) -> Column:
    """When a quarter's report is due, or the quarter ends; null for years up to 2000 and quarters out of 1 to 4."""
    ok = (year > 2000) & quarter.between(1, 4)
    ends = {1: (0, 3, 31), 2: (0, 6, 30), 3: (0, 9, 30), 4: (0, 12, 31)}
    due = {1: (0, 5, 15), 2: (0, 8, 15), 3: (0, 11, 15), 4: (1, 2, 15)}
    out = F.lit(None).cast("date")
    for q, (over, month, day) in (due if publication else ends).items():
        out = F.when(ok & (quarter == q), F.make_date((year + over).cast("int"), F.lit(month), F.lit(day))).otherwise(out)
    return out


def epoch_date(c: Column) -> Column:
    """/Date(milliseconds)/ as a timestamp."""
    return F.timestamp_millis(F.regexp_extract(c, r"/Date\((-?[0-9]+)\)/", 1).try_cast("long"))


def with_time(day: Column, time: Column) -> Column:
    """A day and a time of day, midnight if there is none."""
    text = F.coalesce(F.nullif(F.trim(time), F.lit("")), F.lit("00:00"))
    return F.coalesce(F.try_to_timestamp(F.concat_ws(" ", day.cast("string"), text), F.lit("yyyy-MM-dd H:mm[:ss]")), day.cast("timestamp"))


def month_list(first: Column, last: Column) -> Column:
    """yyyy-MM of each month from first to last; none if they are the wrong way round."""
    a, b = F.trunc(first, "MM"), F.trunc(last, "MM")
    months = F.transform(F.sequence(F.when(a <= b, a), b, F.expr("interval 1 month")), lambda d: F.date_format(d, "yyyy-MM"))
    return F.coalesce(months, F.array().cast("array<string>"))


def date_range(mode: str, first: Column | None = None, last: Column | None = None) -> Column:
    """struct(date_from, date_to, months) by mode: no-date-range, year, year-range (of years) or date-range (of dates)."""
    none = F.struct(F.lit("1900-01-01").alias("date_from"), F.lit("2100-01-01").alias("date_to"), F.array().cast("array<string>").alias("months"))
    if mode == "no-date-range":
        return none
    if mode in ("year", "year-range"):
        last = first if mode == "year" else last
        a, b = F.make_date(first.cast("int"), F.lit(1), F.lit(1)), F.make_date(last.cast("int"), F.lit(12), F.lit(31))
        return F.struct(F.date_format(a, "yyyy-MM-dd").alias("date_from"), F.date_format(b, "yyyy-MM-dd").alias("date_to"), month_list(a, b).alias("months"))
    a, b = F.coalesce(first, last), F.coalesce(last, first)
    some = F.struct(F.date_format(a, "yyyy-MM-dd").alias("date_from"), F.date_format(b, "yyyy-MM-dd").alias("date_to"), month_list(a, b).alias("months"))
    return F.when(a.isNull(), none).otherwise(some)


def min_max_year(*dates: Column) -> tuple[Column, Column]:
    years = [F.year(d) for d in dates]
    return (F.least(*years), F.greatest(*years)) if len(years) > 1 else (years[0], years[0])


def contract_active(end: Column, payments: Column, as_of: Column, days: int = 180) -> Column:
    """An end date after today; without one a payment of late; without any payments true."""
    latest = F.array_max(payments)
    return F.when(end.isNotNull(), end > as_of).when(latest.isNotNull(), F.datediff(as_of, latest) <= days).otherwise(True)


def claim_status(claim: Column, created: Column, as_of: Column, days: int = 30) -> Column:
    """open until the claim date, closed after it; without one open for some days from creation, else unknown."""
    return F.when(claim >= as_of, "open").when(claim < as_of, "closed").when(F.datediff(as_of, created) <= days, "open").otherwise("unknown")


def add_years(day: Column, years: Column) -> Column:
    return F.add_months(day, (years * 12).cast("int"))


def recent(day: Column, as_of: Column, days: int) -> Column:
    return F.coalesce(F.datediff(as_of, day) < days, F.lit(False))
