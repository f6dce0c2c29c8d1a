"""Exact quantiles by repeated counting.

A built-in exact percentile gathers every distinct value of a column in one
task. Here each pass splits the value range that holds a wanted rank into a
fixed number of bins and counts them; copies and bins collapse on the map side,
so a pass shuffles a bounded number of rows per task. The range then shrinks to
the one bin with the rank, down to a single value. Memory use does not depend on
the number of rows or distinct values, and no pass sorts the data.
"""
from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .columns import cells, local_rows, present

BINS = 1024
_LARGEST = 1.7976931348623157e308
_CHUNK = 12   # columns per read, to stay inside generated code


@dataclass(frozen=True)
class _Range:
    """Values lo..hi of a column, ``below`` of them smaller than lo."""

    column: str
    lo: float
    hi: float
    below: int
    log: bool = False

    def bin_of(self, v: str) -> str:
        """Bin 0..BINS-1 of a value in the range, rising with the value.

        Even in the value, or in its magnitude where the values are spread over
        many of those. The ends always get the first and the last bin.
        """
        start, end = _magnitude(self.lo), _magnitude(self.hi)
        place = f"if({v} = 0, 0D, signum({v}) * (ln(abs({v})) + 746D))"
        if not math.isinf(self.hi - self.lo) and not (self.log and end - start > 1e-9):
            start, end, place = self.lo, self.hi, v
        scaled = f"floor(({place} - {start!r}D) / {end - start!r}D * {BINS})"
        return f"least(greatest({scaled}, 0L), {BINS - 1}L)"


def _magnitude(x: float) -> float:
    return math.copysign(math.log(abs(x)) + 746.0, x) if x else 0.0


def _finite(value: str) -> str:
    return f"greatest(least({value}, {_LARGEST}D), -{_LARGEST}D)"


def numeric_cells(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Long form (column_name, v double) of the values present."""
    long_form = cells(df, columns, "double").filter("value is not null")
    return long_form.selectExpr("column_name", f"{_finite('value')} as v")


def exact_quantiles(
    df: DataFrame,
    columns: Iterable[str],
    probabilities: Iterable[float],
    extent: dict[str, tuple[int, float, float]] | None = None,
) -> dict[str, list[float]]:
    """column -> quantiles, interpolated linearly between neighbouring ranks.

    ``extent`` (count, min, max per column) saves the first pass when known.
    Columns without values are absent from the result. Infinite values keep their ranks; beside one,
    the largest finite double counts as infinite too.
    """
    columns, probabilities = list(columns), list(probabilities)
    if extent is None:
        ends = cells(df, columns, "double").filter("value is not null")
        ends = ends.withColumnRenamed("value", "v").groupBy("column_name")
        rows = ends.agg(F.count("v"), F.min("v"), F.max("v")).collect()
        extent = {r[0]: (r[1], r[2], r[3]) for r in rows}
    extent = {c: extent[c] for c in columns if c in extent and extent[c][0]}

    ranks = {
        (c, edge(p * (n - 1)))
        for c, (n, _, _) in extent.items()
        for p in probabilities
        for edge in (math.floor, math.ceil)
    }
    found = _select(df, extent, ranks)

    def ranked(column: str, rank: int) -> float:
        v, (_, lo, hi) = found[column, rank], extent[column]
        if abs(v) == _LARGEST:
            return hi if v > 0 and math.isinf(hi) else lo if v < 0 and math.isinf(lo) else v
        return v

    def at(column: str, p: float) -> float:
        place = p * (extent[column][0] - 1)
        low, high = (ranked(column, r) for r in (math.floor(place), math.ceil(place)))
        share = place - math.floor(place)
        return low if low == high or not share else low + (high - low) * share

    return {c: [at(c, p) for p in probabilities] for c in extent}


def _select(df: DataFrame, extent, ranks) -> dict[tuple[str, int], float]:
    """(column, 0-based rank) -> value at that rank."""
    def clamp(x: float) -> float:
        return max(-_LARGEST, min(_LARGEST, float(x)))

    sought = {(c, r): _Range(c, clamp(extent[c][1]), clamp(extent[c][2]), 0) for c, r in ranks}
    found: dict[tuple[str, int], float] = {}
    while True:
        for key, part in list(sought.items()):
            if part.lo == part.hi:
                found[key] = sought.pop(key).lo
        if not sought:
            return found
        names = list(dict.fromkeys(c for c, _ in sought))
        for start in range(0, len(names), _CHUNK):
            chunk = names[start:start + _CHUNK]
            sought.update(_narrow(df, {k: p for k, p in sought.items() if k[0] in chunk}))


def _narrow(df: DataFrame, sought: dict[tuple[str, int], _Range]) -> dict:
    """One read: for each sought rank, the bin of its range that holds it."""
    parts = sorted(set(sought.values()), key=lambda p: (p.column, p.lo))
    names = list(dict.fromkeys(p.column for p in parts))
    values = df.selectExpr(
        *[f"{_finite(f'cast({present(df, c)} as double)')} as v{i}" for i, c in enumerate(names)]
    )
    # Ranges of one column do not overlap; range and bin make one number.
    codes = []
    for i, name in enumerate(names):
        cases = " ".join(
            f"when v{i} between {p.lo!r}D and {p.hi!r}D then {k * BINS}L + {p.bin_of(f'v{i}')}"
            for k, p in enumerate(parts) if p.column == name
        )
        codes.append(f"case {cases} end as code{i}")
    pairs = ", ".join(f"(code{i}, v{i})" for i in range(len(names)))
    counted = (
        df.sparkSession.sql(
            f"select * from {{coded}} unpivot ((code, v) for name in ({pairs}))",
            coded=values.selectExpr("*", *codes),
        )
        .filter("code is not null")
        .groupBy("code")
        .agg(F.expr("count(*) as n"), F.expr("min(v) as lo"), F.expr("max(v) as hi"))
        .selectExpr(f"cast(code div {BINS} as int) as part", "code", "n", "lo", "hi")
    )
    # At most BINS rows per range from here on.
    before = local_rows(
        df.sparkSession, "part int, before bigint", [(k, p.below) for k, p in enumerate(parts)]
    )
    upto = W.partitionBy("part").orderBy("code").rowsBetween(W.unboundedPreceding, 0)
    stacked = counted.join(F.broadcast(before), "part").select(
        "part", "n", "lo", "hi",
        (F.col("before") + F.sum("n").over(upto) - F.col("n")).alias("below"),
        F.sum("n").over(W.partitionBy("part")).alias("total"),
    )
    index = {part: k for k, part in enumerate(parts)}
    wanted = {key: index[part] for key, part in sought.items()}
    targets = local_rows(
        df.sparkSession, "part int, rank bigint",
        sorted({(part, rank) for (_, rank), part in wanted.items()}),
    )
    rows = (
        stacked.join(F.broadcast(targets), "part")
        .filter("rank >= below and rank < below + n")
        .collect()
    )
    held = {(r["part"], r["rank"]): r for r in rows}
    narrowed = {}
    for (column, rank), part in wanted.items():
        r = held[part, rank]
        # A bin that kept a large share means an uneven spread: switch scale.
        log = parts[part].log != (r["n"] * 16 > r["total"])
        narrowed[column, rank] = _Range(column, r["lo"], r["hi"], r["below"], log)
    return narrowed
