"""Repeated events of a stream, each let through once."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def first_arrivals(
    rows: DataFrame, keys: Iterable[str], event_time: str, delay: str, salt: int = 1
) -> DataFrame:
    """Rows of a stream without those whose key came before, as long as the watermark remembers it.

    The state holds one entry per key seen within ``delay`` of the latest event time. Rows with an
    event time at or before the watermark are late and dropped, and so are repeats of keys whose entry
    has left the state, if they repeat the event time too. Null keys equal each other. With ``salt`` above 1 a key
    is compared in that many places first, so that a key with a large share of all rows is not the work
    of one task; the result is the same.
    """
    keys = list(keys)
    marked = rows.withWatermark(event_time, delay)
    if salt > 1:
        place = _unused(rows, "place")
        marked = marked.withColumn(place, F.floor(F.rand() * salt))
        marked = marked.dropDuplicatesWithinWatermark([*keys, place]).drop(place)
    return marked.dropDuplicatesWithinWatermark(keys)


def _unused(rows: DataFrame, name: str) -> str:
    while name in rows.columns:
        name += "_"
    return name


def dedup_stream(
    rows: DataFrame, keys: Iterable[str], event_time: str, delay: str, folder: str, salt: int = 1,
    **trigger,
):
    """Start writing the first arrivals of a stream; returns the streaming query.

    Rows land in ``folder``/rows exactly once: a stream that is started again goes on from its
    checkpoint, with its state and watermark.
    """
    first = first_arrivals(rows, keys, event_time, delay, salt)
    writer = first.writeStream.format("parquet").outputMode("append").option(
        "checkpointLocation", f"{folder}/progress")
    return writer.trigger(**(trigger or {"availableNow": True})).start(f"{folder}/rows")


def dedup_results(spark: SparkSession, folder: str, schema) -> DataFrame:
    """What a :func:`dedup_stream` has written so far."""
    return spark.read.schema(schema).parquet(f"{folder}/rows")
