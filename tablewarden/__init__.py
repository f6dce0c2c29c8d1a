"""A data-quality gate for tables on Spark: profile, clean, validate, score."""
from .operators.facts import collect_facts, column_facts
from .operators.metadata import profile_of
from .operators.quality import drop_duplicates, quality_score
from .plans.clean import clean_scores, clean_table
from .plans.gate import gate_summary
from .plans.profile import build_report, report_digest
from .plans.validate import build_contract, validate_table
from .sources.csv import read_csv, write_csv

__all__ = [
    "build_contract", "build_report", "clean_scores", "clean_table", "collect_facts",
    "column_facts", "drop_duplicates", "gate_summary", "profile_of", "quality_score", "read_csv",
    "report_digest", "validate_table", "write_csv",
]
