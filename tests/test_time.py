from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from topictide.functions.dates import parse_date, slice_start
from topictide.operators import intervals, slicing, staging


def walk(start_year, end_year, freq):
    at, stop = datetime(start_year, 1, 1), datetime(end_year + 1, 1, 1)
    while at < stop:
        if freq == "monthly":
            after = datetime(at.year + at.month // 12, at.month % 12 + 1, 1)
        else:
            after = at + timedelta(days=7 if freq == "weekly" else 1)
        yield at, after
        at = after


@pytest.mark.parametrize("freq,count", [("monthly", 192), ("weekly", 835), ("daily", 5844)])
def test_time_ranges(spark, freq, count):
    rows = [tuple(r) for r in intervals.time_ranges(spark, 2010, 2025, freq).orderBy("start").collect()]
    assert len(rows) == count and rows == list(walk(2010, 2025, freq))


def test_last_week_overruns_the_year(spark):
    last = intervals.time_ranges(spark, 2024, 2024, "weekly").orderBy(F.col("start").desc()).first()
    assert last["end"] > datetime(2025, 1, 1)


def docs(spark, *dates):
    return spark.createDataFrame([(i, d) for i, d in enumerate(dates)], "doc_id long, published timestamp")


def test_boundary_document(spark):
    ranges = intervals.time_ranges(spark, 2024, 2024, "monthly")
    found = docs(spark, datetime(2024, 2, 1), datetime(2024, 2, 1, 0, 1), None)
    assert intervals.assign_intervals(found, ranges, "closed").count() == 3
    assert intervals.assign_intervals(found, ranges).count() == 2
    with pytest.raises(ValueError):
        intervals.assign_intervals(found, ranges, "open")


def test_cap_keeps_the_newest(spark):
    ranges = intervals.time_ranges(spark, 2024, 2024, "monthly")
    found = docs(spark, *[datetime(2024, 1, d) for d in (3, 5, 5, 1)], datetime(2024, 2, 2))
    kept = intervals.cap_per_interval(intervals.assign_intervals(found, ranges), 2)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 4]


def test_large_cap_is_exact(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 977).alias("published"))
    assigned = rows.withColumn("start", F.lit(1)).withColumn("end", F.lit(2))
    got = {r["doc_id"] for r in intervals.cap_per_interval(assigned, 1500).collect()}
    want = sorted(((-(i % 977), i) for i in range(5000)))[:1500]
    assert got == {i for _, i in want}


def test_resume(spark):
    ranges = intervals.time_ranges(spark, 2024, 2024, "monthly")
    done = ranges.where(F.month("start") <= 3)
    assert intervals.pending_intervals(ranges, done).count() == 9
    assert intervals.pending_intervals(ranges, ranges).count() == 0


def test_weekly_slices_start_on_tuesday(spark):
    got = docs(spark, datetime(2024, 1, 1, 23, 59), datetime(2024, 1, 2), datetime(2024, 1, 8))
    starts = [r[0] for r in got.orderBy("doc_id").select(slice_start(F.col("published"), "weekly")).collect()]
    assert starts == [datetime(2023, 12, 26), datetime(2024, 1, 2), datetime(2024, 1, 2)]
    with pytest.raises(ValueError):
        slice_start(F.col("published"), "yearly")


def test_min_docs_and_undated(spark):
    found = docs(spark, datetime(2024, 1, 5), datetime(2024, 1, 6), datetime(2024, 2, 1), None)
    sliced = slicing.with_slice(found, "monthly")
    assert sliced.count() == 3
    assert slicing.slices_with_min_docs(sliced, 2).count() == 2


def test_dates(spark):
    values = ["2024-01-01T00:00:00Z", "not a date", "2023-12-31T23:59:59Z", None]
    df = spark.createDataFrame([(v,) for v in values], "v string").select(parse_date(F.col("v")).alias("d"))
    assert [r["d"] for r in df.collect()] == [datetime(2024, 1, 1), None, datetime(2023, 12, 31, 23, 59, 59), None]


def test_stage(spark):
    raw = spark.createDataFrame(
        [("1", "T", None, "2024-01-01T00:00:00Z"), ("2", "U", "s", "bad")], "` Id ` string, title string, `The Summary` string, Published string"
    )
    rows = staging.stage(raw).collect()
    assert [r["id"] for r in rows] == ["1"] and rows[0]["year_month"] == "2024-01" and "the_summary" in rows[0].asDict()


def test_dedupe_keeps_smallest_id(spark):
    rows = spark.createDataFrame([(3, "x"), (1, "x"), (2, "y")], "doc_id long, hash string")
    assert sorted(r["doc_id"] for r in staging.dedupe_documents(rows).collect()) == [1, 2]
