"""Approximate answers by choice: quantile sketches that merge, and hash samples of values."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import strip
from .columns import cells, columns_of, numeric_columns
from .facts import TESTS
from .frequency import HEAD, first_per_column, head_of

#: Size parameter of a sketch: ranks are within 1.65 % of the true ones in 99 % of the answers.
SKETCH_SIZE = 200
RANK_ERROR = 0.0165
SKETCH_SCHEMA = "column_name string, n bigint, lo double, hi double, sketch binary"


def quantile_sketches(
    df: DataFrame, columns: Iterable[str] | None = None, size: int = SKETCH_SIZE
) -> DataFrame:
    """column_name, n, lo, hi, sketch of the numeric columns with values: one read, a row per column.

    The table has a few kilobytes per column, however many rows. Kept for every batch of rows, it
    answers for any union of batches by :func:`merge_sketches`, without reading them again.
    """
    names = list(columns) if columns is not None else numeric_columns(df)
    values = cells(df, names, "double").filter("value is not null")
    return values.groupBy("column_name").agg(
        F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"),
        F.kll_sketch_agg_double("value", size).alias("sketch"))


def merge_sketches(sketches: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """Sketches of several batches as those of all their rows."""
    return sketches.groupBy("column_name").agg(
        F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.kll_merge_agg_double("sketch", size).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, probabilities: Iterable[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """column_name, probability, value: a value whose rank is within ``RANK_ERROR`` of the wanted one."""
    def asked(p: float) -> str:
        value = {0.0: "lo", 1.0: "hi"}.get(p, f"kll_sketch_get_quantile_double(sketch, {p!r}D)")
        return f"struct({p!r}D as probability, {value} as value)"

    told = ", ".join(asked(float(p)) for p in probabilities)
    return sketches.selectExpr("column_name", f"inline(array({told}))")


def approximate_distribution(sketches: DataFrame) -> DataFrame:
    """min, max, median and quartiles from sketches, for columns where exact ones are not needed."""
    asked = sketch_quantiles(sketches).groupBy("column_name").pivot(
        "probability", [0.25, 0.5, 0.75]).agg(F.first("value"))
    named = asked.toDF("column_name", "q1", "median", "q3")
    return sketches.select("column_name", "lo", "hi").join(named, "column_name").selectExpr(
        "column_name", "lo as min", "hi as max", "median", "q1", "q3")


def value_sample(
    df: DataFrame, columns: Iterable[str] | None = None, count: int = fixed.SAMPLE_VALUES
) -> DataFrame:
    """column_name, value, n: of each text column the ``count`` values with the least SHA-256.

    A value is in the sample or not by its own hash and those of the others, so the sample is the same
    however rows are spread, and samples of batches merge to that of all rows. Copies collapse first;
    tasks pass on ``count`` values per column. Values travel by beginning and hash; of the long ones
    those in the sample are fetched whole.
    """
    names = list(columns) if columns is not None else columns_of(df, "text")
    value = F.col("value")
    marked = cells(df, names, "string").filter("value is not null").select(
        "column_name", "value", F.sha2(value, 256).alias("mark"))
    distinct = marked.groupBy(
        "column_name", "mark", head_of(value).alias("head"), (F.length(value) > HEAD).alias("long"),
    ).agg(F.count("*").alias("n"))
    picked = first_per_column(distinct, count, F.asc("mark"))
    short = picked.filter("not long").select("column_name", F.col("head").alias("value"), "n")
    # At most ``count`` rows per column.
    wanted = picked.filter("long").select("column_name", "mark", "n")
    whole = marked.filter(F.length(value) > HEAD).join(F.broadcast(wanted), ["column_name", "mark"])
    return short.union(whole.select("column_name", "value", "n").distinct())


def sampled_ratios(sample: DataFrame) -> DataFrame:
    """Share of each column's sampled values (weighted by n) that match each pattern."""
    trimmed = sample.selectExpr("*", f"{strip('value')} as text")
    names = ("email", "phone", "postcode", "person_name", "numeric_like")
    return trimmed.groupBy("column_name").agg(*[
        F.expr(f"round(sum(if({TESTS[f'n_{n}']}, n, 0L)) / sum(n), 4) as {n}") for n in names])
