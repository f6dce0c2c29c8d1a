"""The cleaning stage: duplicates, formats, missing values, scores."""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators.columns import local_rows, numeric_columns, present
from ..operators.impute import impute
from ..operators.measures import Measures, measure, watch
from ..operators.normalise import (
    Change, apply_changes, change_log, change_samples, change_tests, changes_of,
)
from ..operators.quality import dedup_log, drop_duplicates, quality_score, score_tests
from ..storage import stage


@dataclass
class Cleaned:
    """The cleaned table and its logs; ``raw`` and ``distinct`` measure the input and its distinct
    rows, ``result`` the cleaned table once it is staged."""

    table: DataFrame
    unique: DataFrame
    dedup_log: DataFrame
    normalise_log: DataFrame
    impute_log: DataFrame
    changes: list[Change]
    flags: DataFrame
    raw: Measures
    distinct: Measures
    result: Measures | None = None

    @property
    def samples(self) -> DataFrame:
        """Changed values before and after; read when asked for."""
        return change_samples(self.unique, self.changes)


def clean_table(df: DataFrame, profile: dict, raw: Measures | None = None) -> Cleaned:
    """Deduplicate, normalise, impute, as the profile of ``df`` says.

    The rows without duplicates are written once, and counted as they are: the statistics of the later
    steps and the result all read them. The later steps only add projections. ``raw`` are the measures
    of ``df`` with its score tests, if it has been measured.
    """
    raw = raw or measure(df, moments=False, extra=score_tests(df, profile))
    writing = watch(drop_duplicates(df), change_tests(df, profile))
    unique = stage(writing.table, "deduplicated")
    distinct = writing.seen()
    changes = changes_of(unique, profile, distinct)
    # A flag or a spelling never empties a cell; a number or a date that cannot be read does.
    emptied = [c.column for c in changes if c.action in ("number_from_text", "date_from_text")]
    filled, impute_log = impute(
        apply_changes(unique, changes), profile, known=distinct, changed=emptied)
    return Cleaned(
        filled, unique, dedup_log(df, counts=(raw.rows, distinct.rows)), change_log(unique, changes),
        impute_log, changes, profile_flags(df, profile), raw, distinct)


def stage_cleaned(
    cleaned: Cleaned, profile: dict, write: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """Write the cleaned table (``write`` returns it read back) and count it on the way."""
    numbers = numeric_columns(cleaned.table)
    whole = " and ".join(f"{present(cleaned.table, c)} is not null" for c in numbers) or "false"
    writing = watch(
        cleaned.table, {**score_tests(cleaned.table, profile), "complete": f"count_if({whole})"})
    cleaned.table = (write or (lambda df: stage(df, "cleaned")))(writing.table)
    cleaned.result = writing.seen()


def profile_flags(df: DataFrame, profile: dict) -> DataFrame:
    """What the profile said of each column that cleaning went by."""
    return local_rows(
        df.sparkSession,
        "column_name string, inferred_type string, semantic_type string, date_formats string",
        [(c, p.get("inferred_type"), p.get("semantic_type"),
          "|".join(p.get("date_formats") or ())) for c, p in profile.items()])


def clean_scores(df: DataFrame, cleaned: Cleaned, profile: dict) -> DataFrame:
    """quality_before, quality_after, quality_delta; both use the raw profile.

    Normalising may make rows equal, so the cleaned table is compared anew.
    """
    before = quality_score(df, profile, cleaned.distinct.rows, cleaned.raw).selectExpr(
        "score as before", "cast(null as double) as after")
    after = quality_score(cleaned.table, profile).selectExpr("cast(null as double)", "score")
    return before.union(after).selectExpr(
        "max(before) as quality_before",
        "max(after) as quality_after",
        "round(max(after) - max(before), 2) as quality_delta",
    )
