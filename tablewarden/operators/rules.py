"""Rules that flag columns: personal data, broken formats, suspicious content."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import matches, one_of, quoted, strip
from .columns import cells, local_rows
from .frequency import digest_of, first_values, head_of
from .metadata import classify

PROFILE_PATTERNS = {
    "email": fixed.EMAIL,
    "phone": fixed.PHONE_LOOSE,
    "postcode": fixed.POSTCODE,
}


def pii_columns(facts: DataFrame) -> DataFrame:
    """Columns that likely hold personal data, and why."""
    return classify(facts).filter(one_of("expected_type", fixed.PII_TYPES)).selectExpr(
        "column_name",
        "expected_type as semantic_type",
        "concat('values or name suggest ', replace(expected_type, '_', ' ')) as reason",
    )


def invalid_formats(facts: DataFrame) -> DataFrame:
    """Email, phone and postcode columns with values that break the pattern."""
    cases = " ".join(f"when '{t}' then n_{t}" for t in PROFILE_PATTERNS)
    return (
        classify(facts)
        .filter(one_of("expected_type", PROFILE_PATTERNS))
        .selectExpr("*", f"n_present - case expected_type {cases} end as invalid_count")
        .filter("invalid_count > 0")
        .selectExpr(
            "column_name",
            "expected_type as expected_format",
            "invalid_count",
            "round(100D * invalid_count / n_present, 2) as invalid_pct",
        )
    )


def date_shapes(facts: DataFrame) -> DataFrame:
    """Date columns written in more than one known shape."""
    return (
        classify(facts)
        .filter("expected_type = 'date' and size(date_formats) > 1")
        .selectExpr("column_name", "array_join(date_formats, '|') as formats_found")
    )


def suspicious_columns(facts: DataFrame) -> DataFrame:
    """Columns that are constant, mostly missing, mixed or nearly unique."""
    reasons = f"""array_compact(array(
        if(n_unique <= 1, 'constant', null),
        if(100D * (n_rows - n_present) > {fixed.HIGH_MISSING_PCT}D * n_rows, 'mostly_missing', null),
        if(is_mixed, 'mixed_types', null),
        if(n_unique > 1 and n_unique > {fixed.HIGH_CARDINALITY}D * n_rows, 'high_cardinality', null)
    ))"""
    return (
        classify(facts)
        .selectExpr("column_name", f"{reasons} as reasons")
        .filter("size(reasons) > 0")
        .selectExpr("column_name", "array_join(reasons, '|') as reasons")
    )


def format_columns(facts: DataFrame) -> dict[str, str]:
    """column -> email | phone | postcode, for the columns expected to be one."""
    rows = classify(facts).filter(one_of("expected_type", PROFILE_PATTERNS))
    return {r[0]: r[1] for r in rows.select("column_name", "expected_type").collect()}


def _broken(value: str, meaning: str) -> str:
    return f"(not {matches(strip(value), PROFILE_PATTERNS[meaning])})"


def invalid_rows(df: DataFrame, formats: dict[str, str]) -> DataFrame:
    """The rows with at least one value that breaks its column's format."""
    if not formats:
        return df.filter("false")
    broken = [f"coalesce({_broken(f'cast({quoted(c)} as string)', m)}, false)" for c, m in formats.items()]
    return df.filter(" or ".join(broken))


def invalid_examples(
    df: DataFrame, formats: dict[str, str], count: int = fixed.MAX_EXAMPLES
) -> DataFrame:
    """Up to ``count`` distinct invalid values per column, smallest first."""
    parts = []
    for meaning in PROFILE_PATTERNS:
        names = [c for c, m in formats.items() if m == meaning]
        if names:
            broken = cells(df, names, "string").filter(_broken("value", meaning))
            parts.append(broken.selectExpr("column_name", f"{strip('value')} as value"))
    if not parts:
        return local_rows(df.sparkSession, "column_name string, rank int, example string", [])
    invalid = reduce(DataFrame.unionByName, parts)
    value = F.col("value")
    distinct = invalid.select(
        "column_name", head_of(value).alias("head"), digest_of(value).alias("digest")
    ).distinct()
    picked = first_values(distinct, invalid, count)
    return picked.selectExpr("column_name", "rank", "value as example")
