"""CSV source: header row, missing-value tokens, and types taken from the data.

Every column is read as text first. One aggregation then counts how many values
of each column read as integer, decimal or truth value, and one projection casts
the columns whose values all do.
"""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed
from ..functions.text import literal, matches, null_if_na, one_of, quoted
from ..operators.columns import cells

_INTEGER = r"^[+-]?\d+$"
_TRUTH = ("True", "TRUE", "true", "False", "FALSE", "false")


def read_csv(
    spark: SparkSession, path, *, promote: bool = True, multiline: bool = False, **options
) -> DataFrame:
    """Read CSV files (a path, a glob or a list).

    A large file is read by many tasks. ``multiline`` keeps quoted line breaks; a file then cannot
    be split and is read by one task. Without it such a line break would tear its record in two, so
    the read fails and says so.
    """
    settings = {"header": True, "inferSchema": False, "escape": '"', "multiLine": multiline}
    settings.update(options)
    raw = spark.read.options(**settings).csv(path)
    df = mark_missing(raw)
    if not settings["multiLine"]:
        _refuse_torn(spark, path, settings)
    return promote_types(df) if promote else df


def _refuse_torn(spark: SparkSession, path, settings: dict) -> None:
    """Fail if a line ends within a quoted field. The parsed values do not show it, so the lines with
    quotes are read once more, as text."""
    if settings.get("quote", '"') != '"' or settings["escape"] != '"':
        return
    start = f"(^|{re.escape(settings.get('sep') or settings.get('delimiter') or ',')})\""
    # Doubled quotes belong to the text; whole quoted fields go, then an opening quote has no end.
    rest = (f"regexp_replace(replace(value, '\"\"', ''), {literal(start + '[^\"]*+\"')},"
            f" {literal('$1')})")
    torn = spark.read.text(path).filter("contains(value, '\"')").filter(
        f"{rest} rlike {literal(start)}").selectExpr("min(substring(value, 1, 80))").first()[0]
    if torn is not None:
        raise ValueError(
            f"a quoted field goes on behind the end of its line, read with multiline=True: {torn!r}")


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def mark_missing(df: DataFrame) -> DataFrame:
    """Replace the missing-value tokens of all text columns by NULL."""
    text = set(_text_columns(df))
    return df.selectExpr(
        *[
            f"{null_if_na(quoted(c)) if c in text else quoted(c)} as {quoted(c)}"
            for c in df.columns
        ]
    )


def _as_integer(value: str) -> str:
    return f"if({matches(value, _INTEGER)}, try_cast({value} as bigint), null)"


def _as_double(value: str) -> str:
    return f"if({matches(value, fixed.PLAIN_NUMBER)}, try_cast({value} as double), null)"


def promote_types(df: DataFrame) -> DataFrame:
    """Cast each text column to bigint, double or boolean if all its values allow it."""
    text = _text_columns(df)
    counts = {
        r["column_name"]: r
        for r in cells(df, text, "string")
        .groupBy("column_name")
        .agg(
            F.count("value").alias("present"),
            F.expr(f"count({_as_integer('value')}) as integers"),
            F.expr(f"count({_as_double('value')}) as doubles"),
            F.expr(f"count_if({one_of('value', _TRUTH)}) as truths"),
        )
        .collect()
    }

    def promoted(name: str) -> str:
        column, row = quoted(name), counts.get(name)
        if row is None or row["present"] == 0:
            return column
        if row["integers"] == row["present"]:
            return _as_integer(column)
        if row["doubles"] == row["present"]:
            return _as_double(column)
        if row["truths"] == row["present"]:
            return f"lower({column}) = 'true'"
        return column

    return df.selectExpr(*[f"{promoted(c)} as {quoted(c)}" for c in df.columns])


def write_csv(df: DataFrame, path: str) -> None:
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(header=True, escape='"', **kept).csv(path)
