"""Format normalisation, driven by the column profile."""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..functions import fixed
from ..functions.dates import clean_date
from ..functions.text import literal, matches, one_of, quoted, strip_if_word, to_number, unify_yes_no
from .columns import cells, kinds, local_rows, present
from .facts import LONGEST_WORD, only_words, word_bits
from .frequency import first_values, text_frequencies
from .measures import Measures, measure

LOG_SCHEMA = "column_name string, action string, affected bigint"


def numbers_from_text(value: str) -> str:
    return to_number(value, fixed.CURRENCY)


def invalid_phone(value: str) -> str:
    return f"(not {matches(value, fixed.PHONE_STRICT)})"


def flag_invalid_phone(value: str) -> str:
    return f"if({invalid_phone(value)}, {literal(fixed.INVALID_PHONE_LABEL)}, {value})"


@dataclass(frozen=True)
class Change:
    """A rule that applies to a column; ``rule`` turns SQL of a value into SQL of the new one."""

    column: str
    action: str
    affected: int
    rule: Callable[[str], str]


def normalise(df: DataFrame, profile: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """(normalised table, log of column_name, action, affected)."""
    changes = changes_of(df, profile)
    return apply_changes(df, changes), change_log(df, changes)


def apply_changes(df: DataFrame, changes: list[Change]) -> DataFrame:
    new = {c.column: c.rule(quoted(c.column)) for c in changes}
    return df.selectExpr(*[f"{new.get(c, quoted(c))} as {quoted(c)}" for c in df.columns])


def change_log(df: DataFrame, changes: list[Change]) -> DataFrame:
    rows = [(c.column, c.action, c.affected) for c in changes]
    return local_rows(df.sparkSession, LOG_SCHEMA, rows)


def change_samples(df: DataFrame, changes: list[Change], count: int = fixed.TOP_VALUES) -> DataFrame:
    """column_name, rank, before, after: the smallest values of the changed columns, both ways."""
    if not changes:
        return local_rows(
            df.sparkSession, "column_name string, rank int, before string, after string", [])
    values = cells(df, [c.column for c in changes], "string").filter("value is not null")
    picked = first_values(text_frequencies(values).drop("n"), values, count)
    cases = " ".join(
        f"when column_name = {literal(c.column)} then cast({c.rule('value')} as string)"
        for c in changes)
    return picked.selectExpr("column_name", "rank", "value as before", f"case {cases} end as after")


def _text_columns(df: DataFrame) -> list[str]:
    return [c for c, k in kinds(df).items() if k == "text"]


def _phones(df: DataFrame, profile: dict) -> list[str]:
    return [c for c in _text_columns(df) if profile.get(c, {}).get("semantic_type") == "phone"]


def change_tests(df: DataFrame, profile: dict | None = None) -> dict[str, str]:
    """The aggregates that tell which changes apply, by name; for any pass over the table."""
    tests, phones = {}, _phones(df, profile or {})
    for c in _text_columns(df):
        value = f"cast({present(df, c)} as string)"
        word = word_bits(strip_if_word(value, LONGEST_WORD))
        tests[f"words {c}"] = f"bit_or({word})"
        tests[f"respelt {c}"] = (
            f"count_if(octet_length({strip_if_word(value, LONGEST_WORD)}) <= {LONGEST_WORD}"
            f" and {unify_yes_no(value)} != {value})")
        if c in phones:  # only these are tested against the phone pattern
            tests[f"phones {c}"] = f"count_if({invalid_phone(value)})"
    return tests


def changes_of(
    df: DataFrame, profile: dict | None = None, known: Measures | None = None
) -> list[Change]:
    """Per column the first rule that applies: currency text to number, mixed dates
    to timestamps, yes/no spellings to one label, invalid phones flagged. One
    aggregation finds what applies, unless the table is ``known`` with its :func:`change_tests`.
    """
    profile = profile or {}
    text = _text_columns(df)
    if not text:
        return []
    phones = _phones(df, profile)
    if known is None:
        known = measure(df.select(*[quoted(c) for c in text]), moments=False,
                        extra=change_tests(df, profile))
    yes_no = only_words("words", fixed.YES_SPELLINGS + fixed.NO_SPELLINGS)
    spelt = local_rows(
        df.sparkSession, "column_name string, words bigint",
        [(c, known.extra[f"words {c}"]) for c in text]).filter(yes_no)
    spelt_yes_no = {r["column_name"] for r in spelt.collect()}

    changes = []
    for name in text:
        column, n = profile.get(name, {}), known.present[name]
        if column.get("inferred_type") == "numeric_as_text" and column.get("semantic_type") == "numeric":
            changes.append(Change(name, "number_from_text", n, numbers_from_text))
        elif column.get("expected_type") == "date" and len(column.get("date_formats") or ()) > 1:
            changes.append(Change(name, "date_from_text", n, clean_date))
        elif name in spelt_yes_no:
            changes.append(
                Change(name, "yes_no_spelling", known.extra[f"respelt {name}"], unify_yes_no))
        elif name in phones and known.extra[f"phones {name}"]:
            changes.append(Change(
                name, "invalid_phone_flag", known.extra[f"phones {name}"], flag_invalid_phone))
    return changes
