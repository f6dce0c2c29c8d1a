"""Rule checks on a table: formats, ranges, signs and allowed values.

A check is a column and a condition that marks a value as invalid. Any number of
them runs as one aggregation over one read of the table; nothing is shuffled but
one row of counts per task.
"""
from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.numbers import double
from ..functions.text import literal, matches, quoted
from .columns import cells, kinds, local_rows, numeric_columns, present, stacked
from .frequency import text_frequencies

CHECK_PATTERNS = {
    "email": fixed.EMAIL,
    "phone": fixed.PHONE_STRICT,
    "postcode": fixed.POSTCODE,
}
RESULT_COLUMNS = ("column_name", "check", "checked", "valid", "invalid")
RESULT_SCHEMA = "column_name string, check string, checked bigint, valid bigint, invalid bigint"


@dataclass(frozen=True)
class Check:
    """``check`` is a format name, ``range``, ``negatives`` or ``membership``.

    ``allowed`` is the table (column_name, value) that a membership check looks values up in.
    """

    column: str
    check: str
    lower: float | None = None
    upper: float | None = None
    allowed: DataFrame | None = None

    def invalid(self) -> str:
        value = quoted(self.column)
        # Later rows may bring text where a number was: then it is invalid.
        number = f"try_cast({value} as double)"
        if self.check == "range":
            ends = f"{double(self.lower)} and {double(self.upper)}"
            return f"coalesce({number} not between {ends}, true)"
        if self.check == "negatives":
            return f"coalesce({number} < 0, true)"
        return f"not {matches(f'cast({value} as string)', CHECK_PATTERNS[self.check])}"


def run_checks(df: DataFrame, checks: Iterable[Check]) -> DataFrame:
    """column_name, check, checked, valid, invalid; missing values are not checked."""
    checks = list(checks)
    listed = [c for c in checks if c.check == "membership"]
    parts = [_count_checks(df, [c for c in checks if c.check != "membership"])]
    if listed:
        parts.append(_look_up(df, listed))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _look_up(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Membership: distinct values with their counts, joined to the allowed ones.

    Copies collapse before the join, and long values travel by their digest.
    """
    def keyed(table: DataFrame) -> DataFrame:
        counted = text_frequencies(table.filter("value is not null"))
        return counted.withColumn("digest", F.coalesce("digest", F.lit("")))

    names = [c.column for c in checks]
    known = keyed(checks[0].allowed).select("column_name", "head", "digest", F.lit(True).alias("known"))
    found = keyed(cells(df, names, "string")).join(known, ["column_name", "head", "digest"], "left")
    counts = found.groupBy("column_name").agg(
        F.sum("n").alias("checked"), F.sum(F.when(F.col("known"), F.col("n"))).alias("valid"))
    every = local_rows(df.sparkSession, "column_name string", [(c,) for c in names])
    return every.join(counts, "column_name", "left").selectExpr(
        "column_name", "'membership' as check", "coalesce(checked, 0L) as checked",
        "coalesce(valid, 0L) as valid", "coalesce(checked - coalesce(valid, 0L), 0L) as invalid")


def _count_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    if not checks:
        return local_rows(df.sparkSession, RESULT_SCHEMA, [])
    counts, rows = [], []
    for i, c in enumerate(checks):
        value = present(df, c.column)
        counts.append(f"count({value}) as n{i}")
        counts.append(f"count_if({value} is not null and {c.invalid()}) as bad{i}")
        rows.append((literal(c.column), literal(c.check), f"n{i}", f"n{i} - bad{i}", f"bad{i}"))
    return stacked(
        df.selectExpr(*counts), "column_name, check, checked, valid, invalid", rows
    )


def email_checks(df: DataFrame) -> list[Check]:
    """The columns whose name says email."""
    return [Check(c, "email") for c in df.columns if "email" in c.lower()]


def format_checks(df: DataFrame, profile: dict) -> list[Check]:
    """The columns whose values say email, phone or postcode."""
    return [
        Check(c, profile[c]["semantic_type"])
        for c in df.columns
        if profile.get(c, {}).get("semantic_type") in CHECK_PATTERNS
    ]


def numeric_bounds(df: DataFrame, columns: Iterable[str] | None = None) -> dict[str, tuple]:
    """column -> (min, max, values, negative values) of the numeric columns with
    values: one aggregation, one row."""
    names = list(columns) if columns is not None else numeric_columns(df)
    if not names:
        return {}
    ends = []
    for i, c in enumerate(names):
        value = f"cast({present(df, c)} as double)"
        ends += [
            f"min({value}) as lo{i}", f"max({value}) as hi{i}",
            f"count({value}) as n{i}", f"count_if({value} < 0) as neg{i}",
        ]
    row = df.selectExpr(*ends).first()
    return {
        c: (row[f"lo{i}"], row[f"hi{i}"], row[f"n{i}"], row[f"neg{i}"])
        for i, c in enumerate(names)
        if row[f"lo{i}"] is not None
    }


def range_checks(
    df: DataFrame, bounds: dict[str, tuple], own: dict[str, tuple] | None = None
) -> list[Check]:
    """Numeric columns against the bounds seen before cleaning. A column that was
    not numeric then is held to its own present range."""
    names = numeric_columns(df)
    if own is None:
        own = numeric_bounds(df, [c for c in names if c not in bounds])
    known = {**own, **bounds}
    return [Check(c, "range", known[c][0], known[c][1]) for c in names if c in known]


def negative_checks(
    df: DataFrame, own: dict[str, tuple] | None = None, share: float = fixed.NEGATIVE_MINORITY
) -> list[Check]:
    """Numeric columns where negatives are a small minority."""
    own = numeric_bounds(df) if own is None else own
    return [
        Check(c, "negatives")
        for c, (_, _, values, negatives) in own.items()
        if 0 < negatives <= share * values
    ]


def low_cardinality(profile: dict) -> list[str]:
    """Text columns that hold categories."""
    return [
        c for c, p in profile.items()
        if p["kind"] == "text"
        and p["inferred_type"] in ("categorical", "boolean")
        and p["n_unique"]
    ]


def allowed_values(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """column_name, value: the distinct values of low-cardinality columns."""
    return cells(df, columns, "string").filter("value is not null").distinct()


def membership_checks(allowed: DataFrame, columns: list[str] | None = None) -> list[Check]:
    """One check per column of an allowed-value table, which stays a table; ``columns`` are those it
    has, if known."""
    names = sorted(columns) if columns is not None else [r[0] for r in allowed.select("column_name").distinct().orderBy("column_name").collect()]
    return [Check(c, "membership", allowed=allowed) for c in names]


_CONTRACT = "column string, check string, lower double, upper double"


def contract_table(spark: SparkSession, checks: Iterable[Check]) -> DataFrame:
    """Checks as a table, to be stored and applied to later rows; allowed values are stored apart."""
    return local_rows(spark, _CONTRACT, [(c.column, c.check, c.lower, c.upper) for c in checks])


def allowed_of(spark: SparkSession, checks: Iterable[Check]) -> DataFrame:
    """The allowed-value table of the membership checks, empty without any."""
    tables = [c.allowed for c in checks if c.allowed is not None]
    return tables[0] if tables else local_rows(spark, "column_name string, value string", [])


def read_contract(table: DataFrame, allowed: DataFrame) -> list[Check]:
    return [
        Check(r["column"], r["check"], r["lower"], r["upper"],
              allowed if r["check"] == "membership" else None)
        for r in table.collect()
    ]


def applicable(df: DataFrame, checks: Iterable[Check]) -> list[Check]:
    """The checks whose column ``df`` has."""
    known = kinds(df)
    return [c for c in checks if c.column in known]
