"""Filling missing values: median for numbers, most frequent value otherwise."""
from __future__ import annotations

from collections.abc import Iterable
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import DataFrame

from ..functions.text import literal, quoted
from .columns import kinds, local_rows, present
from .facts import present_counts
from .frequency import modes
from .measures import Measures
from .quantiles import exact_quantiles

LOG_SCHEMA = "column_name string, missing bigint, action string, fill_value string"


def _shown(value) -> str:
    if isinstance(value, (float, Decimal)):
        return str(Decimal(str(value)).quantize(Decimal("0.0001"), ROUND_HALF_UP))
    return str(value).lower() if isinstance(value, bool) else str(value)


def impute(
    df: DataFrame, profile: dict | None = None, skip_semantic: tuple[str, ...] = (),
    known: Measures | None = None, changed: Iterable[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """(filled table, log of column_name, missing, action, fill_value).

    The profile's inferred type decides, the column's own type without one.
    Dates stay missing. A filled numeric column becomes double, as its median
    need not be whole. ``skip_semantic`` leaves columns of those meanings alone:
    the most frequent value of a nearly unique column is rarely a good fill.
    ``known`` are measures of the table before its ``changed`` columns were changed; only those are
    counted again.
    """
    profile = profile or {}
    own = kinds(df)
    changed = set(changed)
    again = [c for c in df.columns if known is None or c in changed]
    gaps = {c: n for c, n in known.gaps.items() if c not in changed} if known else {}
    gaps |= {
        r["column_name"]: r["n_rows"] - r["n_present"]
        for r in (present_counts(df, again).collect() if again else ())
        if r["n_present"] < r["n_rows"]
    }
    inferred = {c: profile.get(c, {}).get("inferred_type") for c in gaps}
    dates = [c for c in gaps if inferred[c] == "datetime" or own[c] == "temporal"]
    left = [
        c for c in gaps
        if c not in dates
        and (own[c] == "nested" or profile.get(c, {}).get("semantic_type") in skip_semantic)
    ]
    rest = [c for c in gaps if c not in dates and c not in left]
    by_median = [
        c for c in rest
        if own[c] in ("integer", "float") and inferred[c] in ("integer", "float", None)
    ]
    by_mode = [c for c in rest if c not in by_median]

    extents = known.extents if known and not changed.intersection(by_median) else None
    medians = exact_quantiles(df, by_median, (0.5,), extents) if by_median else {}
    frequent = modes(df, by_mode) if by_mode else {}

    log, fills = [], {}
    for name in df.columns:
        if name not in gaps:
            continue
        if name in dates:
            log.append((name, gaps[name], "skipped_datetime", None))
        elif name in medians:
            value = medians[name][0]
            fills[name] = f"coalesce(cast({present(df, name)} as double), {value!r}D)"
            log.append((name, gaps[name], "median", _shown(value)))
        elif name in frequent:
            value = frequent[name][0]
            fill = f"cast({literal(str(value))} as {df.schema[name].dataType.simpleString()})"
            fills[name] = f"coalesce({present(df, name)}, {fill})"
            log.append((name, gaps[name], "mode", _shown(value)))
        elif name in left and own[name] != "nested":
            log.append((name, gaps[name], "skipped_meaning", None))
        else:
            log.append((name, gaps[name], "skipped_no_value", None))
    filled = df.selectExpr(*[f"{fills.get(c, quoted(c))} as {quoted(c)}" for c in df.columns])
    return filled, local_rows(df.sparkSession, LOG_SCHEMA, log)
