"""Missing and invalid values of a stream, counted per window of event time."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import literal, quoted
from ..operators.checks import Check, applicable
from ..operators.columns import columns_of, present

WINDOW_SCHEMA = (
    "window_start timestamp, window_end timestamp, column_name string, n_rows bigint,"
    " missing bigint, invalid bigint"
)


def windowed_quality(
    rows: DataFrame, contract: Iterable[Check], event_time: str, window: str, delay: str
) -> DataFrame:
    """Per window and column: rows, missing values, and values that break any check of the contract.

    A window is told once, when the watermark (the latest event time less ``delay``) has passed its
    end; rows that arrive for it later are dropped, earlier ones count however late they are. Rows
    without an event time belong to no window. Categories are looked up in their table, every other
    check is a condition; tasks add up before anything moves, so a window may hold any share of the
    rows. Nested columns are left out.
    """
    checks = applicable(rows, contract)
    names = [c for c in columns_of(rows, "text", "integer", "float", "boolean", "temporal")
             if c != event_time]
    broken: dict[str, list[str]] = {c: [] for c in names}
    marked = rows.withWatermark(event_time, delay)
    for i, check in enumerate(c for c in checks if c.column in broken):
        if check.check == "membership":
            listed = check.allowed.filter(F.col("column_name") == check.column).select(
                F.col("value").alias(f"__value{i}"), F.lit(True).alias(f"__known{i}")).distinct()
            same = F.expr(f"cast({quoted(check.column)} as string)") == F.col(f"__value{i}")
            marked = marked.join(listed, same, "left")
            broken[check.column].append(f"__known{i} is null")
        else:
            broken[check.column].append(check.invalid())
    counts = ["count(*) as n_rows"]
    for i, name in enumerate(names):
        value = present(rows, name)
        counts.append(f"count({value}) as n{i}")
        bad = " or ".join(broken[name]) or "false"
        counts.append(f"count_if({value} is not null and ({bad})) as bad{i}")
    grouped = marked.groupBy(F.window(event_time, window).alias("w")).agg(*map(F.expr, counts))
    told = ", ".join(
        f"struct({literal(c)} as column_name, n_rows, n_rows - n{i} as missing, bad{i} as invalid)"
        for i, c in enumerate(names))
    return grouped.selectExpr(
        "w.start as window_start", "w.end as window_end", f"inline(array({told}))")


def quality_stream(
    rows: DataFrame, contract: Iterable[Check], event_time: str, window: str, delay: str, folder: str,
    **trigger,
):
    """Start counting a stream; returns the streaming query. Closed windows land in ``folder``/windows
    exactly once, also when the stream is stopped and started again."""
    counted = windowed_quality(rows, contract, event_time, window, delay)
    writer = counted.writeStream.format("parquet").outputMode("append").option(
        "checkpointLocation", f"{folder}/progress")
    return writer.trigger(**(trigger or {"availableNow": True})).start(f"{folder}/windows")


def quality_windows(spark: SparkSession, folder: str) -> DataFrame:
    """The closed windows so far."""
    return spark.read.schema(WINDOW_SCHEMA).parquet(f"{folder}/windows")
