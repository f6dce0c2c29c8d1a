"""Column facts: one row of counts per column, the input of every profile rule.

The table is read once for all columns (wide ones in parts of their columns). Cells are grouped by
value, which gives exact distinct counts, and text patterns
are tested once per distinct value. What leaves the first shuffle is one row per
distinct value; the second shuffle carries one row per task and column.
"""
from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.dates import is_date
from ..functions.text import literal, matches, strip, to_number
from .columns import column_frame, local_rows, present, stacked, typed_cells, typed_groups
from .frequency import HEAD, digest_of, head_of

# Cheap conditions every match meets; they keep most values away from the
# regular expressions, which have to decode the text first.
_LETTER_FIRST = "ascii(text) >= 65"
_NUMBER_FIRST = "not ascii(text) between 58 and 127"
_DIGIT_LAST = "substring(text, -1, 1) between '0' and '9'"

# Tests on a trimmed text value, and the count each one feeds.
TESTS = {
    "n_email": f"contains(text, '@') and {matches('text', fixed.EMAIL)}",
    "n_phone": f"(startswith(text, '0') or startswith(text, '+44'))"
    f" and {matches('text', fixed.PHONE_LOOSE)}",
    "n_postcode": f"{_LETTER_FIRST} and substring(text, -3, 1) between '0' and '9'"
    f" and {matches('text', fixed.POSTCODE)}",
    "n_person_name": f"{_LETTER_FIRST} and {matches('text', fixed.PERSON_NAME)}",
    "n_numeric_like": f"{_NUMBER_FIRST} and {matches('text', fixed.NUMERIC_LIKE)}",
    "n_plain_number": f"{_NUMBER_FIRST} and not {matches('text', fixed.DECORATED)}"
    f" and {matches('text', fixed.NUMERIC_LIKE)}",
    "n_iso_date": f"octet_length(text) = 10 and contains(text, '-')"
    f" and {matches('text', fixed.ISO_DATE)}",
    "n_slash_date": f"octet_length(text) <= 10 and contains(text, '/')"
    f" and {matches('text', fixed.SLASH_DATE)}",
    "n_month_year": f"{_LETTER_FIRST} and {_DIGIT_LAST} and {matches('text', fixed.MONTH_YEAR)}",
    "n_date": f"octet_length(text) between 6 and 26 and {_DIGIT_LAST} and {is_date('text')}",
    "n_number": f"{_NUMBER_FIRST}"
    f" and {to_number('text', fixed.CURRENCY_AND_PERCENT)} is not null",
}

# Spelling bits: one per boolean word, then one for any other value.
_WORDS = fixed.BOOLEAN_SPELLINGS
_OTHER_WORD = 1 << len(_WORDS)
LONGEST_WORD = max(map(len, _WORDS))

# The tests a long trimmed value can pass, and what the first characters of a
# value must look like for that: one word, letters digits and spaces, or number
# characters.
_LONG_TESTS = (
    "n_email", "n_postcode", "n_person_name", "n_numeric_like", "n_plain_number",
    "n_month_year", "n_number",
)
_POSSIBLE = (
    r"(?s)^(?:[WS].*|[^WS]++[WS]*+|[A-Za-z\dWS]++|[\d+\-.,£$€%eEWS]++)$"
)


def _bit(word: str) -> int:
    return 1 << _WORDS.index(word)


def word_bits(text: str) -> str:
    """The spelling bit of a trimmed text value, 0 for NULL."""
    cases = " ".join(f"when {literal(w)} then {_bit(w)}L" for w in _WORDS)
    return (
        f"case when {text} is null then 0L"
        f" when octet_length({text}) > {LONGEST_WORD} then {_OTHER_WORD}L"
        f" else case lower({text}) {cases} else {_OTHER_WORD}L end end"
    )


def only_words(bits: str, words: Iterable[str]) -> str:
    """Whether all values seen are spellings from ``words`` (and there are some)."""
    others = (1 << 62) - 1 - sum(_bit(w) for w in words)
    return f"({bits} > 0 and {bits} & {others}L = 0)"


_COLUMNS_PER_READ = 48


def _facts(df: DataFrame, families: dict[str, list[str]]) -> DataFrame:
    """Facts of columns of all types from one read: cells are grouped by value, then by column."""
    long_form, slots = typed_cells(df, families)
    natives = [slots[f] for f in families if f != "string"]
    keys = ["column_name", *natives]
    is_present = [f"{s} is not null" for s in natives]
    counts, words = [], ["case"]
    for family, names in families.items():
        slot = slots[family]
        if family == "bigint":
            words.append(f"when {slot} = 0 then {_bit('0')}L when {slot} = 1 then {_bit('1')}L")
        elif family == "boolean":
            words.append(f"when {slot} then {_bit('true')}L when not {slot} then {_bit('false')}L")
        if family != "string":
            words.append(f"when {slot} is not null then {_OTHER_WORD}L")
    if "string" in families:
        # Long values do not pass the first shuffle whole, so they are tested before
        # it; short ones after it, once per distinct value. Most long values fail all
        # tests by their beginning; only the others are read in full. One that is
        # short once trimmed goes along as ``padded``.
        possible = matches(f"substring(value, 1, {HEAD})", _POSSIBLE)
        bits = [f"if({TESTS[t]}, {1 << i}, 0)" for i, t in enumerate(_LONG_TESTS)]
        value = F.col("value")
        distinct = long_form.withColumnRenamed(slots["string"], "value").selectExpr(
            "*", f"if(length(value) > {HEAD} and {possible}, {strip('value')}, null) as text"
        ).groupBy(
            *keys, head_of(value).alias("head"), digest_of(value).alias("digest"),
            F.expr(f"if(length(text) <= {HEAD}, text, null) as padded"),
            F.expr(f"if(length(text) > {HEAD}, {' | '.join(bits)}, 0) as passed"),
        ).agg(F.expr("count(*) as n")).selectExpr(
            *keys, "head", "n", "passed", f"if(digest is null, {strip('head')}, padded) as text")
        is_present.append("head is not null")
        words.append(f"when text is not null then {word_bits('text')}"
                     f" when head is not null then {_OTHER_WORD}L")
        # Each test stands in its own aggregate, which Spark compiles separately.
        for name, test in TESTS.items():
            if name in _LONG_TESTS:
                test = f"passed & {1 << _LONG_TESTS.index(name)} != 0 or {test}"
            counts.append(f"sum(if({test}, n, 0L)) as {name}")
    else:
        distinct = long_form.groupBy(*keys).agg(F.expr("count(*) as n"))
    here = " or ".join(is_present)
    return distinct.groupBy("column_name").agg(*map(F.expr, [
        "sum(n) as n_rows", f"sum(if({here}, n, 0L)) as n_present", f"count_if({here}) as n_unique",
        f"bit_or({' '.join(words)} else 0L end) as words", *counts]))


def present_counts(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """column_name, n_rows, n_present. One map-side aggregation, no value shuffle."""
    names = list(columns) if columns is not None else df.columns
    counted = [f"count({present(df, c)}) as c{i}" for i, c in enumerate(names)]
    totals = df.selectExpr("count(*) as n_rows", *counted)
    return stacked(
        totals,
        "column_name, n_rows, n_present",
        [(literal(c), "n_rows", f"c{i}") for i, c in enumerate(names)],
    )


def _chunks(families: dict[str, list[str]]) -> Iterable[dict[str, list[str]]]:
    """The families' columns in parts of a number that one generated class can hold."""
    every = [(family, name) for family, names in families.items() for name in names]
    for start in range(0, len(every), _COLUMNS_PER_READ):
        part: dict[str, list[str]] = {}
        for family, name in every[start:start + _COLUMNS_PER_READ]:
            part.setdefault(family, []).append(name)
        yield part


def column_facts(df: DataFrame) -> DataFrame:
    """One row per column: position, column_name, kind, data_type, n_rows,
    n_present, n_unique (NULL for nested columns), words (spelling bits) and the
    count of values passing each text test."""
    grouped = typed_groups(df, df.columns)
    parts = [_facts(df, part) for part in _chunks(grouped)]
    flat = {c for names in grouped.values() for c in names}
    nested = [c for c in df.columns if c not in flat]
    if nested:
        parts.append(present_counts(df, nested))
    if not parts:
        parts.append(present_counts(df, []))
    facts = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    # At most one row per column on both sides.
    joined = column_frame(df).join(F.broadcast(facts), "column_name", "left")

    def known(name: str) -> str:
        return f"coalesce({name}, 0L)" if name in facts.columns else "0L"

    return joined.selectExpr(
        "position", "column_name", "kind", "data_type",
        f"{known('n_rows')} as n_rows",
        f"{known('n_present')} as n_present",
        f"if(kind = 'nested', null, {known('n_unique')}) as n_unique",
        f"{known('words')} as words",
        *[f"{known(name)} as {name}" for name in TESTS],
    )


def collect_facts(df: DataFrame) -> DataFrame:
    """Column facts computed now and held as O(columns) driver-side rows, for
    callers that derive several reports from them."""
    facts = column_facts(df)
    rows = [tuple(r) for r in facts.collect()]
    return local_rows(df.sparkSession, facts.schema.simpleString()[len("struct<"):-1], rows)
