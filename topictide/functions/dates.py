"""Date parsing, date parts and time slices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FREQUENCIES = ("daily", "weekly", "monthly")


def check_frequency(freq: str) -> str:
    if freq not in FREQUENCIES:
        raise ValueError(f"frequency must be one of {FREQUENCIES}, not {freq!r}")
    return freq


def parse_date(value: Column) -> Column:
    """Timestamp of an ISO string; anything unparseable becomes null."""
    return F.try_to_timestamp(value)


def year_month(published: Column) -> Column:
    return F.date_format(published, "yyyy-MM")


def slice_start(published: Column, freq: str) -> Column:
    """First instant of the slice; a weekly slice runs from Tuesday to Monday."""
    check_frequency(freq)
    if freq == "monthly":
        return F.date_trunc("month", published)
    if freq == "daily":
        return F.date_trunc("day", published)
    day = F.make_dt_interval(F.lit(1))
    return F.date_trunc("week", published - day) + day


def slice_label(start: Column, freq: str) -> Column:
    """``2024-01`` for months, ``2024-01-02`` otherwise."""
    return F.date_format(start, "yyyy-MM" if check_frequency(freq) == "monthly" else "yyyy-MM-dd")
