"""Kinds of columns and the long form (one row per cell) of a table."""
from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.text import quoted

_NESTED = (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType)


def kind_of(data_type: T.DataType) -> str:
    """text | integer | float | boolean | temporal | nested"""
    if isinstance(data_type, T.BooleanType):
        return "boolean"
    if isinstance(data_type, T.IntegralType):
        return "integer"
    if isinstance(data_type, (T.FractionalType, T.DecimalType)):
        return "float"
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "temporal"
    if isinstance(data_type, _NESTED):
        return "nested"
    return "text"


def kinds(df: DataFrame) -> dict[str, str]:
    return {f.name: kind_of(f.dataType) for f in df.schema}


def columns_of(df: DataFrame, *wanted: str) -> list[str]:
    return [name for name, kind in kinds(df).items() if kind in wanted]


def numeric_columns(df: DataFrame) -> list[str]:
    return columns_of(df, "integer", "float")


def present(df: DataFrame, name: str) -> str:
    """The column (as SQL) with NaN turned into NULL: both mean 'missing'."""
    column = quoted(name)
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return f"if(isnan({column}), null, {column})"
    return column


def typed_groups(df: DataFrame, columns: Iterable[str]) -> dict[str, list[str]]:
    """Columns by the type their cells take in the long form.

    Few families, each in its own type: numbers are grouped as numbers, so they
    are neither printed nor parsed on the way.
    """
    families: dict[str, list[str]] = {}
    for name in columns:
        data_type = df.schema[name].dataType
        kind = kind_of(data_type)
        if kind == "nested":
            continue
        if kind == "integer":
            family = "bigint"
        elif isinstance(data_type, T.DecimalType):
            family = "decimal(38,%d)" % data_type.scale
        elif kind == "float":
            family = "double"
        elif isinstance(data_type, T.TimestampType):
            family = "timestamp"
        elif kind == "temporal":
            family = "timestamp_ntz"
        elif kind == "boolean":
            family = "boolean"
        else:
            family = "string"
        families.setdefault(family, []).append(name)
    return families


def cells(df: DataFrame, columns: Iterable[str], data_type: str) -> DataFrame:
    """Long form (column_name, value); reads only the named columns."""
    names = list(columns)
    if not names:
        return local_rows(df.sparkSession, f"column_name string, value {data_type}", [])
    typed = df.selectExpr(
        *[f"cast({present(df, c)} as {data_type}) as {quoted(c)}" for c in names]
    )
    return typed.unpivot([], [quoted(c) for c in names], "column_name", "value")


def typed_cells(df: DataFrame, families: dict[str, list[str]]) -> tuple[DataFrame, dict[str, str]]:
    """Long form of columns of several types from one read: column_name and a slot per family.

    A cell stands in its family's slot, all others are null. Returns the slots by family too.
    """
    slots = {family: f"slot{i}" for i, family in enumerate(families)}
    typed = [f"cast(null as {family}) as none{i}" for i, family in enumerate(families)]
    picks, place = [], 0
    for family, names in families.items():
        for name in names:
            typed.append(f"cast({present(df, name)} as {family}) as cell{place}")
            row = ", ".join(
                f"cell{place}" if f == family else f"none{i}" for i, f in enumerate(families))
            picks.append(f"({row}) as {quoted(name)}")
            place += 1
    long_form = df.sparkSession.sql(
        f"select * from {{typed}} unpivot include nulls (({', '.join(slots.values())})"
        f" for column_name in ({', '.join(picks)}))",
        typed=df.selectExpr(*typed))
    return long_form.select("column_name", *slots.values()), slots


def stacked(totals: DataFrame, fields: str, rows: Iterable[tuple[str, ...]]) -> DataFrame:
    """Turn a one-row aggregate into one row per column; rows are SQL expressions."""
    rows = list(rows)
    flat = ", ".join(e for row in rows for e in row)
    return totals.selectExpr(f"stack({len(rows)}, {flat}) as ({fields})")


def local_rows(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A driver-side relation of O(columns) rows."""
    struct = T.StructType.fromDDL(schema)
    data = [list(column) for column in zip(*rows)] if rows else [[] for _ in struct]
    arrow = to_arrow_schema(struct)
    table = pa.table([pa.array(d, f.type) for d, f in zip(data, arrow)], schema=arrow)
    return spark.createDataFrame(table, struct)


def column_frame(df: DataFrame) -> DataFrame:
    """One row per column, in order: position, column_name, kind, data_type."""
    return local_rows(
        df.sparkSession,
        "position int, column_name string, kind string, data_type string",
        [
            (i, f.name, kind_of(f.dataType), f.dataType.simpleString())
            for i, f in enumerate(df.schema)
        ],
    )
