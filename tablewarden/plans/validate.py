"""The validation stage: checks, anomalies, health."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..functions.text import quoted
from ..operators import checks
from ..operators.anomalies import anomaly_counts, detect_anomalies
from ..operators.columns import local_rows, numeric_columns
from ..operators.health import health_score
from ..operators.measures import Measures


@dataclass
class Validation:
    results: DataFrame
    contract: list[checks.Check]
    anomalies: DataFrame
    health: DataFrame


def build_contract(
    cleaned: DataFrame, profile: dict, bounds: dict, known: Measures | None = None
) -> list[checks.Check]:
    """All checks that apply: formats and categories by the raw profile, ranges by
    the raw bounds, signs by the cleaned data (``known`` saves reading it)."""
    own = known.bounds if known else checks.numeric_bounds(cleaned)
    text = [f.name for f in cleaned.schema if f.dataType.typeName() == "string"]
    listed = [c for c in checks.low_cardinality(profile) if c in text]
    filled = [c for c in listed if known.present[c]] if known else None
    return [
        *checks.format_checks(cleaned, profile),
        *checks.range_checks(cleaned, bounds, own),
        *checks.negative_checks(cleaned, own),
        *checks.membership_checks(checks.allowed_values(cleaned, listed), filled),
    ]


def validate_table(
    cleaned: DataFrame, profile: dict, bounds: dict, known: Measures | None = None
) -> Validation:
    contract = build_contract(cleaned, profile, bounds, known)
    # One row per check: held, as reports and health both read it.
    results = checks.run_checks(cleaned, contract)
    results = local_rows(
        cleaned.sparkSession, checks.RESULT_SCHEMA,
        [tuple(r) for r in results.select(*checks.RESULT_COLUMNS).collect()])
    counts, free = anomaly_summary(cleaned, known.extra.get("complete") if known else None)
    return Validation(results, contract, counts, health_score(results, free))


def anomaly_summary(
    df: DataFrame, complete: int | None = None
) -> tuple[DataFrame, float | None]:
    """Anomaly counts and the share of scored rows without one. Reads and writes
    the numeric columns only; ``complete`` is the number of rows with all of them."""
    flagged, _ = detect_anomalies(
        df.select(*[quoted(c) for c in numeric_columns(df)]), rows_known=complete)
    counts = anomaly_counts(flagged)
    row = counts.first()
    held = local_rows(df.sparkSession, counts.schema.simpleString()[len("struct<"):-1], [tuple(row)])
    return held, 1.0 - row["anomalies"] / row["rows_scored"] if row["rows_scored"] else None
