"""Date texts: which day a value names. SQL expression text, as in ``text``."""
from __future__ import annotations

from . import fixed
from .text import matches, strip

# Formats beyond the three report shapes, day first: (shape, parse format).
# '-' and '.' between digits are read as '/'.
OTHER_FORMATS = (
    (r"^\d{1,2}[-.]\d{1,2}[-.]\d{4}$", "d/M/yyyy"),
    (r"^\d{4}[/.]\d{1,2}[/.]\d{1,2}$", "yyyy/M/d"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
    (r"^\d{1,2} [A-Za-z]{4,9} \d{4}$", "d MMMM yyyy"),
)
ISO_TIME = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?$"
FULL_MONTH_YEAR = r"^[A-Za-z]{4,9} \d{4}$"


def _day(text: str, fmt: str) -> str:
    return f"cast(try_to_date({text}, '{fmt}') as timestamp_ntz)"


def _parsed(text: str) -> str:
    """The day a trimmed text names. Each shape is read by its own format only, so
    a slash date is always day first and an ISO date never is."""
    slashed = f"translate({text}, '-.', '//')"
    branches = [
        (fixed.ISO_DATE, _day(text, "yyyy-MM-dd")),
        (fixed.SLASH_DATE, _day(text, "d/M/yyyy")),
        (fixed.MONTH_YEAR_STRICT, _day(text, "MMM yyyy")),
        (ISO_TIME, f"try_cast({text} as timestamp_ntz)"),
        *[(shape, _day(slashed, fmt)) for shape, fmt in OTHER_FORMATS],
    ]
    cases = " ".join(f"when {matches(text, shape)} then {day}" for shape, day in branches)
    return f"case {cases} end"


def clean_date(value: str) -> str:
    """The day a date text names, NULL where it names none."""
    return _parsed(strip(value))


def is_date(text: str) -> str:
    """Whether any known format reads the trimmed text; full month names count here."""
    full = f"if({matches(text, FULL_MONTH_YEAR)}, {_day(text, 'MMMM yyyy')}, null)"
    return f"(coalesce({_parsed(text)}, {full}) is not null)"
