"""Where in a table values are missing: rows in order, in equal buckets."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import literal, quoted
from ..storage import stage
from .columns import local_rows, present

BUCKETS = 50


def missing_map(
    df: DataFrame, order: Iterable[str], buckets: int = BUCKETS, columns: Iterable[str] | None = None
) -> DataFrame:
    """bucket, column_name, n_rows, missing: rows stand by ``order`` and are cut into even buckets.

    Row i of n belongs to bucket i * buckets / n. Rows are dealt by ranges of the order and
    numbered within their task; a sum over the tasks' counts makes that their place in the table, so no
    task sees all rows. Rows that the order does not tell apart stand by what they miss, which makes
    the result the same for any layout. Only the order and one bit per column move, once.
    """
    names = list(columns) if columns is not None else df.columns
    order = list(order)
    gaps = ", ".join(f"{present(df, c)} is null" for c in names)
    keys = [f"k{i}" for i in range(len(order))]
    rows = df.selectExpr(
        *[f"{quoted(c)} as {k}" for c, k in zip(order, keys, strict=True)],
        f"transform(array({gaps}), g -> if(g, '1', '0')) as gaps")
    rows = rows.withColumn("gaps", F.array_join("gaps", ""))
    dealt = rows.repartitionByRange(*keys, "gaps").sortWithinPartitions(*keys, "gaps")
    # Task and place in the task; ranges may be cut differently when computed again, so they are written.
    placed = stage(dealt.select(
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("at"), "gaps"), "places")
    counts = {r["part"]: r["n"] for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect()}
    offsets, total = [], 0
    for part in sorted(counts):
        offsets.append((part, total))
        total += counts[part]
    # One row per task.
    starts = local_rows(df.sparkSession, "part int, start bigint", offsets)
    marks = [f"sum(if(substring(gaps, {i + 1}, 1) = '1', 1L, 0L)) as m{i}" for i in range(len(names))]
    counted = placed.join(F.broadcast(starts), "part").selectExpr(
        f"cast((start + at) * {buckets}L div {max(total, 1)}L as int) as bucket", "gaps",
    ).groupBy("bucket").agg(F.count("*").alias("n_rows"), *map(F.expr, marks))
    told = ", ".join(
        f"struct({literal(c)} as column_name, n_rows, m{i} as missing)" for i, c in enumerate(names))
    return counted.selectExpr("bucket", f"inline(array({told}))")
