"""The whole gate in one application: profile, clean, validate, summary."""
from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.columns import local_rows
from ..operators.facts import collect_facts
from ..operators.metadata import profile_of
from .clean import Cleaned, clean_scores, clean_table, stage_cleaned
from .validate import Validation, validate_table


def gate_summary(df: DataFrame) -> DataFrame:
    """One row: rows, duplicates, missing cells, quality and health."""
    profile = profile_of(collect_facts(df))
    cleaned = clean_table(df, profile)
    # Read by every later step; the steps up to here are projections on one read.
    stage_cleaned(cleaned, profile)
    validation = validate_table(cleaned.table, profile, cleaned.raw.bounds, cleaned.result)
    return summarise(df, cleaned, validation, profile)


def summarise(df: DataFrame, cleaned: Cleaned, validation: Validation, profile: dict) -> DataFrame:
    spark = df.sparkSession
    before = local_rows(spark, "missing_before bigint", [(sum(cleaned.raw.gaps.values()),)])
    after = local_rows(spark, "missing_after bigint", [(sum(cleaned.result.gaps.values()),)])
    scores = clean_scores(df, cleaned, profile)
    health = validation.health
    # Five relations of exactly one row each.
    parts = [cleaned.dedup_log, before, after, scores, health]
    names = [
        "rows_before", "rows_after", "exact_duplicates_removed", "missing_before", "missing_after",
        "quality_before", "quality_after", "quality_delta",
        "pass_rate", "anomaly_free_rate", "health_score",
    ]
    stacked = None
    for part in parts:
        wide = part.select(*[c for c in names if c in part.columns])
        stacked = wide if stacked is None else stacked.unionByName(wide, allowMissingColumns=True)
    return stacked.selectExpr(*[f"max({c}) as {c}" for c in names])
