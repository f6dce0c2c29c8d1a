"""Streams: repeated and late rows, windows, restarts from the checkpoint."""
import datetime

import pytest
from pyspark.sql import functions as F

from tablewarden.operators.checks import Check
from tablewarden.streaming.dedup import dedup_results, dedup_stream
from tablewarden.streaming.quality import quality_stream, quality_windows

SCHEMA = "id long, at timestamp, kind string, value double"


def at(hour, minute=0):
    return datetime.datetime(2024, 5, 1) + datetime.timedelta(hours=hour, minutes=minute)


def arrive(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return spark.readStream.schema(SCHEMA).parquet(f"{folder}/in")


@pytest.mark.parametrize("salt", [1, 4])
def test_repeats_and_late_rows(spark, tmp_path, salt):
    folder = f"file://{tmp_path}"

    def run(rows):
        dedup_stream(arrive(spark, folder, rows), ["id"], "at", "1 hour", folder, salt).awaitTermination()
        found = dedup_results(spark, folder, SCHEMA).select("at", "id").collect()
        return sorted(map(tuple, found), key=lambda r: (r[0], str(r[1])))

    first = run([(1, at(0), "a", 1.0), (1, at(0), "a", 1.0), (2, at(1), "b", None), (None, at(1), "n", 0.0),
                 (None, at(1, 5), "n", 0.0)])
    assert [r[1] for r in first] == [1, 2, None]
    # The watermark stands at 0:05. A repeat within it is known; one with a new time is one too.
    second = run([(2, at(1), "b", None), (2, at(1, 20), "b", None), (3, at(0, 30), "c", 2.0),
                  (4, at(0, 4), "late", 1.0), (5, at(6), "d", 1.0)])
    assert [r[1] for r in second if r not in first] == [3, 5]
    # It stands at 5:00 now: what was told is forgotten, but would come late.
    third = run([(1, at(0), "a", 1.0), (3, at(0, 30), "c", 2.0), (6, at(5, 30), "e", 1.0),
                 (2, at(1), "b", None)])
    assert [r[1] for r in third if r not in second] == [6]
    assert run([]) == third


def test_stream_without_new_rows_writes_nothing(spark, tmp_path):
    folder = f"file://{tmp_path}"
    for _ in range(2):
        dedup_stream(arrive(spark, folder, []), ["id"], "at", "1 hour", folder).awaitTermination()
    assert dedup_results(spark, folder, SCHEMA).count() == 0


def test_windows_close_once_and_count_rows_in_time(spark, tmp_path):
    folder = f"file://{tmp_path}"
    allowed = spark.createDataFrame([("kind", "a"), ("kind", "b"), ("kind", "a")], "column_name string, value string")
    contract = [Check("value", "range", 0.0, 10.0), Check("value", "negatives"),
                Check("kind", "membership", allowed=allowed), Check("gone", "negatives")]

    def run(rows):
        stream = arrive(spark, folder, rows)
        quality_stream(stream, contract, "at", "1 hour", "30 minutes", folder).awaitTermination()
        found = quality_windows(spark, folder).filter("column_name in ('kind', 'value')")
        return sorted((r.window_start.hour, r.column_name, r.n_rows, r.missing, r.invalid)
                      for r in found.collect())

    assert run([(1, at(0, 5), "a", 1.0), (2, at(0, 10), "x", -1.0), (3, at(0, 50), None, float("nan")),
                (4, None, "a", 1.0)]) == []
    # Its hour is over, but not for 30 minutes: the row counts.
    assert run([(5, at(1, 10), "b", 11.0), (6, at(0, 59), "y", None)]) == []
    hour = [(0, "kind", 4, 1, 2), (0, "value", 4, 2, 1)]
    assert run([(7, at(1, 31), "a", 5.0)]) == hour
    # The window is closed: a row for it is dropped, the next window closes on its own.
    assert run([(8, at(0, 20), "z", -5.0), (9, at(3), "a", 1.0)]) == [
        *hour, (1, "kind", 2, 0, 0), (1, "value", 2, 0, 1)]


def test_hot_window_is_added_up_before_it_moves(spark, small):
    from tablewarden.streaming.quality import windowed_quality

    rows = spark.read.parquet(f"{small}/events.parquet").withColumn("at", F.col("ts").cast("timestamp"))
    plan = windowed_quality(rows, [], "at", "1 day", "1 hour")._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange"):]
    assert "partial_count" in before
