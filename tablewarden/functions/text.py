"""SQL expressions on text: trimming, pattern tests and guarded parsing.

The functions take and return SQL expression text, which keeps large
expressions cheap to build. All run inside the JVM and none can raise on bad
input.
"""
from __future__ import annotations

from collections.abc import Iterable

from . import fixed


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quoted(name: str) -> str:
    """Column name that survives dots and backticks."""
    return "`" + name.replace("`", "``") + "`"


def one_of(value: str, words: Iterable[str]) -> str:
    return f"({value} in ({', '.join(literal(w) for w in words)}))"


def matches(value: str, pattern: str) -> str:
    # (?d): '$' may be followed by a newline, and by no other line separator.
    def test(spaces: str) -> str:
        return f"{value} rlike {literal('(?d)' + pattern.replace('WS', spaces))}"

    if "WS" not in pattern:
        return f"({test('')})"
    # Classes with characters beyond ASCII are several times slower to test, and
    # pure ASCII texts cannot contain any.
    return (
        f"if(octet_length({value}) = length({value}), {test(fixed.ASCII_WHITESPACE_CLASS)},"
        f" {test(fixed.WHITESPACE_CLASS)})"
    )


def strip(value: str) -> str:
    return f"btrim({value}, {literal(fixed.WHITESPACE)})"


def strip_if_word(value: str, longest: int) -> str:
    """Trimmed where that may leave at most ``longest`` characters, else as it is.

    Only the beginning is looked at, so long texts cost nothing.
    """
    maybe = matches(f"substring({value}, 1, 64)", rf"(?s)^(?:[WS].*|[^WS]{{1,{longest}}}[WS]*)$")
    return f"if({maybe}, {strip(value)}, {value})"


def to_number(value: str, removed: str) -> str:
    """Text without the ``removed`` characters and whitespace, as a double.

    The pattern keeps out forms only Spark's cast would accept, such as ``1d``.
    A first test ends at the first character no number has, so long texts are
    not rewritten in vain.
    """
    possible = matches(value, rf"^[\d.eE+\-WS{removed}]+$")
    bare = f"translate({value}, {literal(removed + fixed.WHITESPACE)}, '')"
    return (
        f"if({possible} and {matches(bare, fixed.PLAIN_NUMBER)},"
        f" try_cast({bare} as double), null)"
    )


def unify_yes_no(value: str) -> str:
    word = f"lower({strip(value)})"
    return (
        f"case when {one_of(word, fixed.YES_SPELLINGS)} then {literal(fixed.YES_LABEL)}"
        f" when {one_of(word, fixed.NO_SPELLINGS)} then {literal(fixed.NO_LABEL)}"
        f" else {value} end"
    )


def null_if_na(value: str) -> str:
    return f"if({one_of(value, fixed.NA_TOKENS)}, null, {value})"
