"""Overall health: share of checks passed and share of rows without anomaly."""
from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import fixed
from ..functions.numbers import half_up


def health_score(results: DataFrame, anomaly_free_rate: float | None) -> DataFrame:
    """pass_rate, anomaly_free_rate, health_score (0-100) from check results.

    The pass rate pools all checked values. Without checks or scored rows the
    respective rate is 1.
    """
    rules, anomalies = fixed.HEALTH_WEIGHTS
    free = 1.0 if anomaly_free_rate is None else anomaly_free_rate
    return results.selectExpr(
        "1 - coalesce(try_divide(sum(invalid), sum(checked)), 0D) as pass_rate"
    ).selectExpr(
        "round(pass_rate, 6) as pass_rate",
        f"round({free!r}D, 6) as anomaly_free_rate",
        f"{half_up(f'100D * ({rules}D * pass_rate + {anomalies}D * {free!r}D)', 2)} as health_score",
    )
