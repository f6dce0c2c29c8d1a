"""Jobs: read a table, write reports and the cleaned table.

Each stage reads only what the stage before wrote, so stages can run in one
application or apart:

    <output>/profile/<table>      report tables, JSON lines
    <output>/cleaned              cleaned table, Parquet (or CSV)
    <output>/cleaning/<table>     logs and scores
    <output>/validation/<table>   check results, contract, anomalies, health
"""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..operators import metadata
from ..operators.checks import allowed_of, contract_table
from ..operators.measures import Measures
from ..sources.csv import read_csv, write_csv
from ..sources.reports import read_report, write_report
from ..storage import discard, stage
from .clean import clean_scores, clean_table, stage_cleaned
from .profile import build_report
from .validate import validate_table

COLUMNS_SCHEMA = (
    "position int, column_name string, kind string, inferred_type string, semantic_type string,"
    " expected_type string, date_formats array<string>, n_rows bigint, n_present bigint,"
    " n_unique bigint"
)
BOUNDS_SCHEMA = "column_name string, min double, max double"


def find_input(spark: SparkSession, path: str) -> tuple[str, str]:
    """(what to read, its format) of a file, a glob or a folder.

    A folder of part files is one table, as are the files of a glob; of other CSV files in a folder the
    first by name is taken.
    """
    if path.endswith((".csv", ".parquet")) and "*" not in path:
        return path, path.rpartition(".")[2]
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = list(fs.globStatus(place) or [])
    folder = len(found) == 1 and found[0].isDirectory()
    inside = [f.getPath() for f in (fs.listStatus(found[0].getPath()) if folder else found)]
    files = sorted((f.getName(), f.toString()) for f in inside if not f.getName().startswith(("_", ".")))
    texts = [(name, whole) for name, whole in files if re.search(r"\.csv(\.\w+)?$", name)]
    if not texts or any(name.endswith(".parquet") for name, _ in files):
        return path, "parquet"
    if folder and not all(name.startswith("part-") for name, _ in texts):
        return texts[0][1], "csv"
    return path, "csv"


def read_input(
    spark: SparkSession, path: str, kind: str | None = None, multiline: bool = False
) -> DataFrame:
    """A Parquet or CSV table, found by :func:`find_input` unless its ``kind`` is given.

    A CSV file is parsed once: later steps read the columns they need from the
    staged copy. ``multiline`` keeps quoted line breaks of a CSV file, see ``read_csv``.
    """
    if kind is None:
        path, kind = find_input(spark, path)
    if kind == "csv":
        return stage(read_csv(spark, path, multiline=multiline), "input")
    return spark.read.format(kind).load(path)


def profile_job(
    spark: SparkSession, path: str, output: str, kind: str | None = None, charts: bool = True,
    multiline: bool = False,
) -> None:
    _profile(read_input(spark, path, kind, multiline), path, output, charts)


def _profile(df: DataFrame, path: str, output: str, charts: bool) -> Measures:
    report = build_report(df, charts=charts, source=path)
    write_report(report.tables, f"{output}/profile")
    return report.known


def stored_profile(spark: SparkSession, output: str) -> dict[str, dict]:
    return metadata.as_profile(read_report(spark, f"{output}/profile", "columns", COLUMNS_SCHEMA))


def stored_bounds(spark: SparkSession, output: str) -> dict[str, tuple]:
    table = read_report(spark, f"{output}/profile", "numeric_distribution", BOUNDS_SCHEMA)
    return {r["column_name"]: (r["min"], r["max"]) for r in table.collect()}


def clean_job(
    spark: SparkSession, path: str, output: str, kind: str | None = None, as_csv: bool = False,
    multiline: bool = False,
) -> None:
    _clean(read_input(spark, path, kind, multiline), output, as_csv)


def _clean(df: DataFrame, output: str, as_csv: bool, raw: Measures | None = None) -> Measures:
    spark = df.sparkSession
    known = stored_profile(spark, output)
    cleaned = clean_table(df, known, raw)

    def write(table: DataFrame) -> DataFrame:
        table.write.mode("overwrite").parquet(f"{output}/cleaned")
        return spark.read.schema(table.schema).parquet(f"{output}/cleaned")

    stage_cleaned(cleaned, known, write)
    if as_csv:
        write_csv(cleaned.table, f"{output}/cleaned_csv")
    write_report(
        {
            "dedup": cleaned.dedup_log,
            "normalise": cleaned.normalise_log,
            "impute": cleaned.impute_log,
            "samples": cleaned.samples,
            "profile_flags": cleaned.flags,
            "scores": clean_scores(df, cleaned, known),
        },
        f"{output}/cleaning",
    )
    return cleaned.result


def validate_job(spark: SparkSession, output: str, known: Measures | None = None) -> None:
    """``known`` are the measures of the cleaned table, where the same application has written it."""
    cleaned = spark.read.parquet(f"{output}/cleaned")
    validation = validate_table(
        cleaned, stored_profile(spark, output), stored_bounds(spark, output), known)
    write_report(
        {
            "checks": validation.results,
            "contract": contract_table(spark, validation.contract),
            "allowed": allowed_of(spark, validation.contract),
            "anomalies": validation.anomalies,
            "health": validation.health,
        },
        f"{output}/validation",
    )


def gate_job(
    spark: SparkSession, path: str, output: str, kind: str | None = None, as_csv: bool = False,
    charts: bool = True, multiline: bool = False,
) -> None:
    """All three stages on one input, which is read into the application once. Staged copies go when it
    ends, also when it fails."""
    try:
        df = read_input(spark, path, kind, multiline)
        raw = _profile(df, path, output, charts)
        validate_job(spark, output, _clean(df, output, as_csv, raw))
    finally:
        discard(spark)
