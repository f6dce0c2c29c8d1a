"""Checks on rows that arrive later, against a stored contract."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.checks import RESULT_SCHEMA, Check, applicable, run_checks


def check_stream(rows: DataFrame, contract: Iterable[Check], folder: str, **trigger):
    """Start checking a stream of rows; returns the streaming query.

    Each micro-batch adds its counts under its own number, so a batch that is
    repeated after a failure replaces its result instead of counting twice.
    """
    checks = applicable(rows, contract)

    def check_batch(batch: DataFrame, number: int) -> None:
        counts = run_checks(batch, checks)
        counts.coalesce(1).write.mode("overwrite").parquet(f"{folder}/results/batch={number}")

    writer = rows.writeStream.foreachBatch(check_batch)
    writer = writer.option("checkpointLocation", f"{folder}/progress")
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def stream_results(spark, folder: str) -> DataFrame:
    """Totals over all batches so far: column_name, check, checked, valid, invalid."""
    batches = spark.read.schema(RESULT_SCHEMA).parquet(f"{folder}/results/*")
    return batches.groupBy("column_name", "check").agg(
        *[F.sum(c).alias(c) for c in ("checked", "valid", "invalid")]
    )
