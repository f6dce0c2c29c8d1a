"""The profiling report: every profile table of one input."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import metadata, profile, rules, visual
from ..operators.facts import collect_facts
from ..operators.frequency import top_values
from ..operators.measures import Measures, measure
from ..operators.quality import score_tests


@dataclass
class Report:
    """Report tables by name, and what the later stages take: column profile and measures."""

    tables: dict[str, DataFrame]
    columns: dict[str, dict]
    facts: DataFrame
    known: Measures


def build_report(
    df: DataFrame, *, charts: bool = True, source: str | None = None, known: Measures | None = None
) -> Report:
    """Column facts, measures, quartiles, box plots and density curves are computed once, here; the
    tables derived from them are driver-side rows. The other tables run when they are written
    or shown. ``known`` are measures with moments, if the table has been measured."""
    facts = collect_facts(df)
    columns = metadata.profile_of(facts)
    known = known or measure(df, extra=score_tests(df, columns))
    numbers = profile.numbers_of(df, known=known)
    tables = {
        "dataset": profile.dataset_summary(df, source, known).selectExpr("*", "current_timestamp() as generated_at"),
        "columns": metadata.column_profile(facts),
        "metadata": metadata.column_metadata(facts),
        "mixed_types": metadata.mixed_types(df, facts),
        "missing_per_column": profile.missing_per_column(df, known),
        "missing_overall": profile.missing_overall(df, known),
        "type_consistency": profile.type_consistency(facts),
        "cardinality": profile.cardinality(facts),
        "correlations": profile.correlation_matrix(df, moments=numbers.moments),
        "numeric_distribution": profile.numeric_distribution(df, known=numbers),
        "top_values": top_values(df),
        "potential_pii": rules.pii_columns(facts),
        "invalid_formats": rules.invalid_formats(facts),
        "invalid_examples": rules.invalid_examples(df, rules.format_columns(facts)),
        "date_shapes": rules.date_shapes(facts),
        "suspicious_columns": rules.suspicious_columns(facts),
    }
    if charts:
        tables["missing_patterns"] = visual.missing_patterns(df, known)
        tables["histogram"] = visual.histogram(df, known=numbers)
        tables["boxplot_stats"], tables["density_curve"] = visual.number_charts(df, numbers)
    return Report(tables, columns, facts, known)


def report_digest(facts: DataFrame, inferences: int = 4) -> DataFrame:
    """The short version: section, column_name, detail."""
    first = metadata.classify(facts).filter(f"position < {inferences}")
    parts = [
        rules.pii_columns(facts).selectExpr("'pii' as section", "column_name", "semantic_type as detail"),
        rules.suspicious_columns(facts).selectExpr("'suspicious'", "column_name", "reasons"),
        rules.invalid_formats(facts).selectExpr("'format'", "column_name", "expected_format"),
        rules.date_shapes(facts).selectExpr("'format'", "column_name", "'date'"),
        first.selectExpr("'inference'", "column_name", "concat(inferred_type, ' (', semantic_type, ')')"),
    ]
    digest = parts[0]
    for part in parts[1:]:
        digest = digest.union(part)
    return digest
