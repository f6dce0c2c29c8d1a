"""spark-submit entry: ``python -m tablewarden INPUT OUTPUT [--kind csv] [--multiline] [--csv]``"""
from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans.jobs import gate_job


def main() -> None:
    parser = argparse.ArgumentParser(prog="tablewarden", description="Profile, clean and validate a table.")
    parser.add_argument("input")
    parser.add_argument("output")
    parser.add_argument("--kind", help="input format; from the file name if left out")
    parser.add_argument(
        "--multiline", action="store_true",
        help="keep line breaks in quoted fields of a CSV input; one task then reads a file")
    parser.add_argument("--csv", action="store_true", help="also write the cleaned table as CSV")
    parser.add_argument("--no-figures", action="store_true", help="leave the chart tables out")
    arguments = parser.parse_args()
    spark = SparkSession.builder.appName("tablewarden").getOrCreate()
    gate_job(
        spark, arguments.input, arguments.output, arguments.kind, arguments.csv,
        charts=not arguments.no_figures, multiline=arguments.multiline,
    )


if __name__ == "__main__":
    main()
