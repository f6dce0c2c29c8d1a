"""What each column is: type, meaning, mixture. All derived from column facts."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import literal, matches, quoted, strip
from .columns import stacked
from .facts import only_words


def _mostly(count: str) -> str:
    return f"coalesce(try_divide({count}, n_present) >= {fixed.MATCH_THRESHOLD}D, false)"


_FEW_WORDS = (
    f"{only_words('words', fixed.BOOLEAN_SPELLINGS)}"
    f" and bit_count(words) <= {fixed.MAX_BOOLEAN_SPELLINGS}"
)
_CATEGORIES = f"greatest({fixed.CATEGORICAL_MIN}D, n_present * {fixed.CATEGORICAL_SHARE}D)"

_INFERRED_TYPE = f"""case
    when n_present = 0 then 'empty'
    when kind = 'nested' then 'nested'
    when {_FEW_WORDS} then 'boolean'
    when kind in ('integer', 'float') then kind
    when kind = 'temporal' then 'datetime'
    when {_mostly('n_numeric_like')} then 'numeric_as_text'
    when {_mostly('n_date')} then 'datetime'
    when n_unique <= {_CATEGORIES} then 'categorical'
    else 'text' end"""

_SEMANTIC_TYPE = f"""case
    when inferred_type in ('empty', 'nested') then 'unknown'
    when {_mostly('n_email')} then 'email'
    when {_mostly('n_phone')} then 'phone'
    when {_mostly('n_postcode')} then 'postcode'
    when (contains(name, 'id') or endswith(name, '_no') or name = 'code')
        and n_unique / greatest(n_present, 1) > {fixed.IDENTIFIER_UNIQUENESS}D then 'identifier'
    when {_mostly('n_person_name')}
        and not contains(name, 'user') and not contains(name, 'file') then 'person_name'
    when inferred_type = 'datetime' then 'date'
    when inferred_type in ('integer', 'float', 'numeric_as_text') then 'numeric'
    when inferred_type in ('categorical', 'boolean') then 'categorical'
    else 'text' end"""

# The type the column name alone suggests, NULL if none.
_HINTED_TYPE = (
    "case "
    + " ".join(
        "when " + " or ".join(f"contains(name, {literal(h)})" for h in hints) + f" then '{meaning}'"
        for meaning, hints in fixed.NAME_HINTS.items()
    )
    + " end"
)

# Kinds of value present: number and/or string. Native numbers are never mixed.
_NATIVE = "kind in ('integer', 'float', 'boolean')"
_VALUE_KINDS = f"""array_compact(array(
    if(n_present > 0 and ({_NATIVE} or n_plain_number > 0), 'number', null),
    if(n_present > n_plain_number and not {_NATIVE}, 'string', null)))"""

_SHAPE_COUNTS = ("n_slash_date", "n_month_year", "n_iso_date")
_DATE_FORMATS = (
    "array_compact(array("
    + ", ".join(f"if({n} > 0, '{s}', null)" for s, n in zip(fixed.DATE_SHAPES, _SHAPE_COUNTS))
    + "))"
)


def classify(facts: DataFrame) -> DataFrame:
    """Column facts plus inferred_type, semantic_type, hinted_type,
    expected_type, value_kinds, is_mixed and date_formats."""
    return (
        facts.selectExpr("*", "lower(column_name) as name", f"{_INFERRED_TYPE} as inferred_type")
        .selectExpr(
            "*",
            f"{_SEMANTIC_TYPE} as semantic_type",
            f"{_HINTED_TYPE} as hinted_type",
            f"{_VALUE_KINDS} as value_kinds",
            f"{_DATE_FORMATS} as date_formats",
        )
        .selectExpr(
            "*",
            "coalesce(hinted_type, semantic_type) as expected_type",
            "size(value_kinds) > 1 as is_mixed",
        )
    )


def column_profile(facts: DataFrame) -> DataFrame:
    """What the cleaning and checking steps need to know of each column."""
    return classify(facts).select(
        "position", "column_name", "kind", "inferred_type", "semantic_type", "expected_type",
        "date_formats", "n_rows", "n_present", "n_unique",
    )


def as_profile(table: DataFrame) -> dict[str, dict]:
    """A column profile table, just made or read back, as column -> its row."""
    rows = sorted(table.collect(), key=lambda r: r["position"])
    return {r["column_name"]: r.asDict() for r in rows}


def profile_of(facts: DataFrame) -> dict[str, dict]:
    return as_profile(column_profile(facts))


def match_ratios(facts: DataFrame) -> DataFrame:
    """Share of a column's values matching each pattern (0 without values)."""
    names = ("email", "phone", "postcode", "person_name", "numeric_like")
    return facts.selectExpr(
        "column_name",
        *[f"round(coalesce(try_divide(n_{n}, n_present), 0D), 4) as {n}" for n in names],
    )


def infer_types(facts: DataFrame) -> DataFrame:
    return classify(facts).select("column_name", "inferred_type")


def semantic_types(facts: DataFrame) -> DataFrame:
    return classify(facts).select("column_name", "semantic_type")


def expected_types(facts: DataFrame) -> DataFrame:
    return classify(facts).select("column_name", "expected_type")


def column_metadata(facts: DataFrame) -> DataFrame:
    return classify(facts).select(
        "column_name", "data_type", "inferred_type", "semantic_type", "is_mixed"
    )


def mixed_types(df: DataFrame, facts: DataFrame) -> DataFrame:
    """is_mixed, kinds, and for mixed columns the smallest value of each kind.

    Give it collected facts: they also tell which columns to search.
    """
    rows = classify(facts).selectExpr(
        "column_name", "is_mixed", "array_join(value_kinds, '|') as kinds"
    )
    mixed = [r["column_name"] for r in rows.filter("is_mixed").collect()]
    if not mixed:
        return rows.selectExpr(
            "*", "cast(null as string) as example_number", "cast(null as string) as example_string"
        )
    return rows.join(F.broadcast(kind_examples(df, mixed)), "column_name", "left").selectExpr(
        "column_name", "is_mixed", "kinds",
        "number as example_number", "string as example_string",
    )


def kind_examples(df: DataFrame, columns: list[str]) -> DataFrame:
    """column_name, number, string: the smallest value of each kind.

    A plain aggregation over the columns: without grouping keys a minimum of
    texts needs neither a sort nor a shuffle of values.
    """
    aggregates = []
    for i, name in enumerate(columns):
        column, text = quoted(name), strip(quoted(name))
        number = (
            f"({matches(text, fixed.NUMERIC_LIKE)} and not {matches(text, fixed.DECORATED)})"
        )
        aggregates.append(f"min(if({number}, {column}, null)) as n{i}")
        aggregates.append(f"min(if({number}, null, {column})) as s{i}")
    return stacked(
        df.selectExpr(*aggregates),
        "column_name, number, string",
        [(literal(name), f"n{i}", f"s{i}") for i, name in enumerate(columns)],
    )
