"""Fetch intervals: generating them, assigning documents, capping and resuming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topictide.functions.dates import check_frequency
from topictide.operators.ranking import top_n

BOUNDS = ("half_open", "closed")


def _step(freq: str) -> Column:
    check_frequency(freq)
    if freq == "monthly":
        return F.make_ym_interval(F.lit(0), F.lit(1))
    return F.make_dt_interval(F.lit(7 if freq == "weekly" else 1))


def _walk(years: DataFrame, freq: str) -> DataFrame:
    first = F.make_timestamp("first_year", F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    stop = F.make_timestamp(F.col("last_year") + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    step = _step(freq)
    starts = F.sequence(first, stop - F.make_dt_interval(F.lit(1)), step)
    return years.select(F.explode(starts).alias("start")).select(
        "start", (F.col("start") + step).alias("end")
    )


def time_ranges(spark: SparkSession, start_year: int, end_year: int, freq: str) -> DataFrame:
    """Half-open walk from 1 January of ``start_year`` through ``end_year``.

    Weeks are counted from 1 January, whatever its weekday; the last one may run past the
    end of the year.
    """
    years = spark.range(1).select(
        F.lit(start_year).alias("first_year"), F.lit(end_year).alias("last_year")
    )
    return _walk(years, freq)


def time_ranges_of(docs: DataFrame, freq: str, date_col: str = "published") -> DataFrame:
    """The same walk over the years a table covers."""
    years = docs.agg(
        F.min(F.year(date_col)).alias("first_year"), F.max(F.year(date_col)).alias("last_year")
    )
    return _walk(years, freq)


def assign_intervals(
    docs: DataFrame, intervals: DataFrame, bounds: str = "half_open", date_col: str = "published"
) -> DataFrame:
    """Documents with the interval(s) their date falls in.

    ``half_open`` puts a boundary document in one interval, ``closed`` in both. An interval
    is spread over the calendar days it touches, so that the range condition becomes an equi join on
    the day: a document meets only the intervals of its own day, never all of them. The
    day table is bounded by the calendar; Spark broadcasts it when its measured size allows.
    """
    if bounds not in BOUNDS:
        raise ValueError(f"bounds must be one of {BOUNDS}, not {bounds!r}")
    days = intervals.select(
        "start", "end", F.explode(F.sequence(F.to_date("start"), F.to_date("end"))).alias("_day")
    )
    date = F.col(date_col)
    upper = date <= F.col("end") if bounds == "closed" else date < F.col("end")
    return (
        docs.where(date.isNotNull())
        .withColumn("_day", F.to_date(date))
        .join(days, "_day")
        .where((date >= F.col("start")) & upper)
        .drop("_day")
    )


def cap_per_interval(
    assigned: DataFrame, n: int, date_col: str = "published", id_col: str = "doc_id"
) -> DataFrame:
    """The ``n`` newest documents of every interval; the smaller id breaks ties."""
    order = [F.col(date_col).desc(), F.col(id_col).asc()]
    return top_n(assigned, ["start", "end"], order, n, "_rank", [id_col]).drop("_rank")


def pending_intervals(intervals: DataFrame, done: DataFrame) -> DataFrame:
    """Intervals not yet materialised."""
    return intervals.join(done.select("start", "end").distinct(), ["start", "end"], "left_anti")


def empty_intervals(intervals: DataFrame, assigned: DataFrame) -> DataFrame:
    """Intervals without any document (they write no file)."""
    return pending_intervals(intervals, assigned)
