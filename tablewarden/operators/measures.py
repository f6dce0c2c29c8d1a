"""What one pass over a table counts: rows, gaps, bounds, signs and moments of every column.

The pass is an aggregation of its own (:func:`measure`), or none at all: a table that is being written
is observed on its way (:func:`watch`). Only what a write gets last may be observed. Counts of
tasks before a shuffle are added again when a lost executor's tasks run again; those of the last
stage count once.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .columns import local_rows, numeric_columns, present

_CHUNK = 12  # columns per aggregation, to stay inside generated code


@dataclass(frozen=True)
class Measures:
    """``moments`` has n, lo, hi, negatives, mean, std and skew of the numeric columns with values."""

    rows: int
    present: dict[str, int]
    moments: dict[str, dict]
    extra: dict

    @property
    def gaps(self) -> dict[str, int]:
        """Missing values of the columns that have some."""
        return {c: self.rows - n for c, n in self.present.items() if n < self.rows}

    @property
    def bounds(self) -> dict[str, tuple]:
        """column -> (min, max, values, negative values) of the numeric columns with values."""
        return {c: (m["lo"], m["hi"], m["n"], m["negatives"]) for c, m in self.moments.items()}

    @property
    def extents(self) -> dict[str, tuple]:
        return {c: (m["n"], m["lo"], m["hi"]) for c, m in self.moments.items()}

    def counts(self, df: DataFrame) -> DataFrame:
        """column_name, n_rows, n_present, in the order of the columns."""
        return local_rows(
            df.sparkSession, "column_name string, n_rows bigint, n_present bigint",
            [(c, self.rows, n) for c, n in self.present.items()])


def _metrics(df: DataFrame, columns: list[str], moments: bool) -> list[str]:
    numeric = set(numeric_columns(df))
    out = ["count(*) as n_rows"]
    for c in columns:
        i = df.columns.index(c)
        value = present(df, c)
        out.append(f"count({value}) as n{i}")
        if c in numeric:
            v = f"cast({value} as double)"
            out += [f"min({v}) as lo{i}", f"max({v}) as hi{i}", f"count_if({v} < 0) as neg{i}"]
            if moments:
                out += [f"avg({v}) as mean{i}", f"stddev_samp({v}) as std{i}", f"skewness({v}) as skew{i}"]
    return out


def _measures(df: DataFrame, found: dict, extra: dict, columns: list[str] | None = None) -> Measures:
    names = df.columns if columns is None else columns
    moments = {}
    for c in numeric_columns(df):
        if c not in names:
            continue
        i = df.columns.index(c)
        if found[f"n{i}"]:
            moments[c] = {
                "column_name": c, "n": found[f"n{i}"], "lo": found[f"lo{i}"], "hi": found[f"hi{i}"],
                "negatives": found[f"neg{i}"], "mean": found.get(f"mean{i}"),
                "std": found.get(f"std{i}"), "skew": found.get(f"skew{i}")}
    rows = found["n_rows"]
    return Measures(rows, {c: found[f"n{df.columns.index(c)}"] for c in names}, moments, extra)


def measure(
    df: DataFrame, moments: bool = True, extra: dict[str, str] | None = None
) -> Measures:
    """Counts of a table by aggregation, with further aggregates by name: each read takes a dozen of
    its columns."""
    extra = dict(extra or {})
    named = [f"{sql} as x{i}" for i, sql in enumerate(extra.values())]
    found: dict = {}
    width = max(len(df.columns), -(-len(named) // 3), 1)
    for start in range(0, width, _CHUNK):
        parts = _metrics(df, df.columns[start:start + _CHUNK], moments)
        parts += named[3 * start:3 * (start + _CHUNK)]
        found |= df.selectExpr(*parts).first().asDict()
    return _measures(df, found, {n: found[f"x{i}"] for i, n in enumerate(extra)})


class Watch:
    """A table to be written, and what was counted on the way once it is."""

    def __init__(
        self, df: DataFrame, extra: dict[str, str] | None = None, columns: list[str] | None = None
    ) -> None:
        self._df, self._extra = df, dict(extra or {})
        self._columns = df.columns if columns is None else columns
        self._found = Observation()
        more = [f"{sql} as x{i}" for i, sql in enumerate(self._extra.values())]
        self.table = df.observe(
            self._found, *map(F.expr, [*_metrics(df, self._columns, moments=False), *more]))

    def seen(self) -> Measures:
        """Call it after the write; it waits for the counts otherwise."""
        found = self._found.get
        extra = {n: found[f"x{i}"] for i, n in enumerate(self._extra)}
        return _measures(self._df, found, extra, self._columns)


def watch(
    df: DataFrame, extra: dict[str, str] | None = None, columns: list[str] | None = None
) -> Watch:
    """Count ``columns`` (all) while ``watch(df).table`` is written as it is, with further aggregates by
    name.

    Moments are left to :func:`measure`: they need as many additions as a read of their own.
    """
    return Watch(df, extra, columns)
