"""Calendar and clock expressions (pure Column functions)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(day: Column | str) -> Column:
    """20260925-style integer key of a date."""
    day = _col(day)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("long")


def is_weekend(day: Column | str) -> Column:
    """Saturday or Sunday; Spark's dayofweek counts Sunday as 1."""
    return F.dayofweek(_col(day)).isin(1, 7)


def day_name(day: Column | str) -> Column:
    return F.date_format(_col(day), "EEEE")


def month_name(day: Column | str) -> Column:
    return F.date_format(_col(day), "MMMM")


def _period_index(day: Column, unit: str) -> Column:
    if unit == "day":
        return F.unix_date(day)
    if unit == "month":
        return F.year(day) * 12 + F.month(day)
    if unit == "quarter":
        return F.year(day) * 4 + F.quarter(day)
    if unit == "year":
        return F.year(day)
    raise ValueError(f"unknown period unit: {unit}")


def periods_between(end: Column | str, start: Column | str, unit: str) -> Column:
    """Boundaries crossed from start to end: Jan 31 to Mar 1 is two months."""
    return (_period_index(_col(end), unit) - _period_index(_col(start), unit)).cast("long")


def period_start(day: Column | str, unit: str) -> Column:
    return F.trunc(_col(day), unit)


def zone_date(instant: Column | str, zone: str) -> Column:
    """Calendar date of a UTC instant in a time zone.

    The instant is rendered in the session zone and converted from there, so
    the answer does not depend on the session zone.
    """
    local = _col(instant).cast("timestamp").cast("timestamp_ntz")
    return F.to_date(F.convert_timezone(None, F.lit(zone), local))


def seconds_between(end: Column | str, start: Column | str) -> Column:
    return F.timestamp_diff("SECOND", _col(start), _col(end))


def hours_since(as_of: Column | str, loaded_at: Column | str) -> Column:
    """Hours between two instants with one decimal; NULL if never loaded."""
    seconds = F.unix_micros(_col(as_of).cast("timestamp")) - F.unix_micros(
        _col(loaded_at).cast("timestamp")
    )
    return F.round(seconds / F.lit(3600000000.0), 1)


def by_frequency(frequency: Column | str, cases: dict[str, Column], otherwise: Column | None = None) -> Column:
    """``CASE frequency WHEN ...``; an unlisted frequency gives ``otherwise`` or NULL."""
    frequency = _col(frequency)
    expr = None
    for name, value in cases.items():
        expr = F.when(frequency == name, value) if expr is None else expr.when(frequency == name, value)
    return expr.otherwise(otherwise) if otherwise is not None else expr
