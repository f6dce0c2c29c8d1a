"""Report sink and source: each report table is a folder of JSON lines."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_report(tables: dict[str, DataFrame], path: str) -> None:
    """Tables of one row per column or so; one file each."""
    for name, table in tables.items():
        table.coalesce(1).write.mode("overwrite").json(f"{path}/{name}")


def read_report(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(f"{path}/{name}")


def document(table: DataFrame) -> DataFrame:
    """A report table as one JSON text: an array of its rows, in column-name order."""
    row = F.struct(*[F.col(c) for c in table.columns])
    return table.agg(F.to_json(F.sort_array(F.collect_list(row))).alias("document"))
