"""The numbers behind the profile's charts, as tables."""
from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.numbers import double
from ..functions.text import literal, quoted
from .columns import cells, local_rows, numeric_columns, present, stacked
from .facts import present_counts
from .measures import Measures
from .profile import Numbers, numbers_of, numeric_moments
from .quantiles import exact_quantiles

def missing_patterns(df: DataFrame, known: Measures | None = None) -> DataFrame:
    """How many rows share each pattern of missing columns (1 = missing).

    Empty when nothing is missing.
    """
    if known:
        gaps = len(known.gaps)
        if not gaps:
            return local_rows(df.sparkSession, "pattern string, n bigint", [])
    else:
        gaps = present_counts(df).filter("n_present < n_rows").limit(1).count()
    marks = ", ".join(f"if({present(df, c)} is null, '1', '0')" for c in df.columns)
    patterns = df.selectExpr(f"concat({marks}) as pattern")
    if not gaps:
        patterns = patterns.filter("false")
    return patterns.groupBy("pattern").agg(F.expr("count(*) as n"))


def _wanted(df: DataFrame, columns: Iterable[str] | None) -> list[str]:
    return list(columns) if columns is not None else numeric_columns(df)


def _finite(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The named columns as doubles, infinite values as missing."""
    return df.selectExpr(*[
        f"if(abs({v}) = double('Infinity'), null, {v}) as {quoted(c)}"
        for c in columns for v in [f"cast({present(df, c)} as double)"]
    ])


def bin_count(n: int, lo: float, hi: float, q1: float, q3: float) -> int:
    """Number of bins: the narrower of Freedman-Diaconis and Sturges widths."""
    if lo == hi:
        return 1
    width = (hi - lo) / (math.log2(n) + 1.0)
    by_spread = 2.0 * (q3 - q1) * n ** (-1.0 / 3.0)
    if by_spread > 0:
        width = min(width, by_spread)
    return max(1, math.ceil((hi - lo) / width))


def _finite_numbers(df: DataFrame, names: list[str], known: Numbers | None) -> Numbers:
    """Moments and quartiles of the finite values; what is known of columns without others is kept."""
    kept = known.moments if known else {}
    kept = {c: m for c, m in kept.items() if math.isfinite(m["lo"]) and math.isfinite(m["hi"])}
    rest = [c for c in names if c not in kept]
    more = numbers_of(_finite(df, rest)) if rest else Numbers({}, {})
    quartiles = {c: known.quartiles[c] for c in kept} if known else {}
    return Numbers(
        {c: m for c, m in (kept | more.moments).items() if c in names},
        {c: q for c, q in (quartiles | more.quartiles).items() if c in names})


def histogram(
    df: DataFrame, columns: Iterable[str] | None = None, known: Numbers | None = None
) -> DataFrame:
    """Equal-width histogram of numeric columns: bin, lo, hi, n (empty bins left out).

    The bins span the finite values. Infinite values have bins of their own, -1 and one past the
    last, so that the counts still add up to the values present.
    """
    names = _wanted(df, columns)
    finite = _finite_numbers(df, names, known)
    extent = {c: (m["n"], m["lo"], m["hi"]) for c, m in finite.moments.items()}
    layout = []
    for name in names:
        if name not in extent:  # infinite values alone
            layout.append((name, 0.0, 0.0, 0))
            continue
        n, lo, hi = extent[name]
        q1, _, q3 = finite.quartiles[name]
        bins = bin_count(n, lo, hi, q1, q3)
        if lo == hi:
            lo, hi = lo - 0.5, hi + 0.5
        layout.append((name, lo, (hi - lo) / bins, bins))
    # One row per column.
    ranges = local_rows(
        df.sparkSession, "column_name string, first double, width double, bins bigint", layout
    )
    beyond = "abs(value) = double('Infinity')"
    return (
        cells(df, names, "double").filter("value is not null")
        .join(F.broadcast(ranges), "column_name")
        .selectExpr(
            "column_name", "first", "width",
            f"case when {beyond} then if(value > 0, bins, -1L)"
            " else least(floor(try_divide(value - first, width)), bins - 1) end as bin",
            f"if({beyond}, value, null) as edge",
        )
        .groupBy("column_name", "first", "width", "bin", "edge")
        .agg(F.expr("count(*) as n"))
        .selectExpr(
            "column_name", "bin", "coalesce(edge, first + bin * width) as lo",
            "coalesce(edge, first + (bin + 1) * width) as hi", "n"
        )
    )


# Power sums per bin, and bins per bandwidth. A value is at most 1/64 bandwidth from its bin's middle,
# so what the series leaves out is below (|t| / 64)^10 / 10! of a value's share, t bandwidths away.
_POWERS = 10
_BINS_PER_WIDTH = 32


def _hermite() -> list[list[float]]:
    """Coefficients of the Hermite polynomials: exp(-(t - u)^2 / 2) = exp(-t^2 / 2) sum He_k(t) u^k / k!"""
    rows = [[1.0], [0.0, 1.0]]
    for k in range(1, _POWERS - 1):
        shifted = [0.0, *rows[k]]
        rows.append([a - k * b for a, b in zip(shifted, [*rows[k - 1], 0.0, 0.0], strict=True)])
    return rows


def _grids(df: DataFrame, names: list[str], known: Numbers | None, points: int) -> list[tuple]:
    """(column, values, bandwidth, least value, first x, step) of the columns that vary."""
    if known:
        moments = _finite_numbers(df, names, known).moments.values()
    else:
        moments = numeric_moments(_finite(df, names), names)
    grids = []
    for m in moments:
        if m["n"] > 1 and m["std"]:
            width = m["std"] * m["n"] ** -0.2
            start = m["lo"] - 3 * width
            step = (m["hi"] + 3 * width - start) / (points - 1)
            grids.append((m["column_name"], m["n"], width, m["lo"], start, step))
    return grids


def _on_grid(
    df: DataFrame, names: list[str], grids: list[tuple], points: int, fences: dict[str, tuple]
) -> DataFrame:
    """column_name, point, mass, lo, hi, outliers from one read; the last three at point -1 alone.

    Values are counted in bins with their power sums around the bin's middle, one row per bin that is
    not empty; these rows meet the grid, not the values.
    """
    spark = df.sparkSession
    layout = {g[0]: g for g in grids}
    nothing = (None, None, None, None, None)
    ranges = local_rows(
        spark, "column_name string, width double, origin double, start double, step double,"
        " lower double, upper double",
        [(c, *layout.get(c, (c, 0, *nothing[:4]))[2:], *fences.get(c, nothing)[3:5]) for c in names])
    size = f"width / {_BINS_PER_WIDTH}"
    sums = ["count(*) as s0"]
    sums += [f"sum({' * '.join(['u'] * k)}) as s{k}" for k in range(1, _POWERS)]
    inside = "value between lower and upper"
    binned = (
        cells(df, names, "double").filter("value is not null")
        .join(F.broadcast(ranges), "column_name")
        .selectExpr("*", f"if(abs(value) = double('Infinity'), null, floor((value - origin) / ({size})))"
                    " as bin")
        .selectExpr("*", f"(value - origin) / width - (bin + 0.5D) / {_BINS_PER_WIDTH} as u")
        .groupBy("column_name", "bin", "width", "origin", "start", "step")
        .agg(*map(F.expr, sums), F.expr(f"min(if({inside}, value, null)) as lo"),
             F.expr(f"max(if({inside}, value, null)) as hi"),
             F.expr(f"count_if(not ({inside})) as outliers"))
    )
    terms: list[list[str]] = [[] for _ in range(_POWERS)]
    for k, row in enumerate(_hermite()):
        for power, factor in enumerate(row):
            if factor:
                terms[power].append(f"{factor / math.factorial(k)!r}D * s{k}")
    series = f"c{_POWERS - 1}"
    for power in range(_POWERS - 2, -1, -1):
        series = f"(c{power} + t * {series})"
    met = binned.selectExpr(
        "*", *[f"{' + '.join(t)} as c{i}" for i, t in enumerate(terms)],
        f"explode(if(bin is null, array(-1), sequence(-1, {points - 1}))) as point"
    ).selectExpr(
        "*", f"(start + point * step - origin) / width - (bin + 0.5D) / {_BINS_PER_WIDTH} as t")
    return met.groupBy("column_name", "point").agg(
        F.expr(f"sum(if(point < 0, 0D, exp(-0.5D * t * t) * {series})) as mass"),
        *[F.expr(f"{f}(if(point < 0, {c}, null)) as {c}")
          for f, c in (("min", "lo"), ("max", "hi"), ("sum", "outliers"))])


def density_curve(
    df: DataFrame, columns: Iterable[str] | None = None, points: int = 200,
    known: Numbers | None = None,
) -> DataFrame:
    """Gaussian density estimate of the finite values on an even grid: x, density.

    Scott's bandwidth, three bandwidths beyond the data on each side. One read for all columns, in
    bins with power sums; what that leaves out is far below the last digit (see ``_POWERS``).
    """
    grids = _grids(df, _wanted(df, columns), known, points)
    met = _on_grid(df, [g[0] for g in grids], grids, points, {})
    return _densities(met, grids)


def _densities(met: DataFrame, grids: list[tuple]) -> DataFrame:
    spark = met.sparkSession
    if not grids:
        return local_rows(spark, "column_name string, x double, density double", [])
    layout = local_rows(
        spark, "column_name string, total bigint, width double, start double, step double",
        [(c, n, width, start, step) for c, n, width, _, start, step in grids])
    return met.filter("point >= 0").join(F.broadcast(layout), "column_name").selectExpr(
        "column_name", "start + point * step as x",
        f"mass / (total * width * {math.sqrt(2 * math.pi)!r}D) as density")


def number_charts(
    df: DataFrame, known: Numbers, points: int = 200
) -> tuple[DataFrame, DataFrame]:
    """(box plot, density curve) of all numeric columns from one read, made now.

    What is held are ``points`` numbers per column.
    """
    names = list(known.moments)
    grids, fences = _grids(df, names, known, points), _fences(df, names, known)
    met = _on_grid(df, names, grids, points, fences)
    schema = "column_name string, point int, mass double, lo double, hi double, outliers bigint"
    held = local_rows(df.sparkSession, schema, [tuple(r) for r in met.collect()])
    quartiles = local_rows(
        df.sparkSession, "column_name string, q1 double, median double, q3 double",
        [(c, *f[:3]) for c, f in fences.items()])
    boxes = quartiles.join(F.broadcast(held.filter("point < 0")), "column_name").selectExpr(
        "column_name", "q1", "median", "q3", "lo as whisker_lo", "hi as whisker_hi", "outliers")
    return boxes, _densities(held, grids)


def _fences(
    df: DataFrame, columns: Iterable[str] | None, known: Numbers | None = None
) -> dict[str, tuple[float, ...]]:
    """column -> q1, median, q3, lower fence, upper fence"""
    names = _wanted(df, columns)
    quartiles = known.quartiles if known else exact_quantiles(df, names, (0.25, 0.5, 0.75))
    return {
        c: (q1, q2, q3, q1 - fixed.WHISKER * (q3 - q1), q3 + fixed.WHISKER * (q3 - q1))
        for c, (q1, q2, q3) in quartiles.items()
    }


def boxplot_stats(
    df: DataFrame, columns: Iterable[str] | None = None, known: Numbers | None = None
) -> DataFrame:
    """Quartiles, whiskers (furthest values inside the fences) and outlier count."""
    fences = _fences(df, columns, known)
    if not fences:
        return local_rows(
            df.sparkSession,
            "column_name string, q1 double, median double, q3 double, whisker_lo double,"
            " whisker_hi double, outliers bigint", [],
        )
    aggregates, rows = [], []
    for i, (name, (q1, q2, q3, lower, upper)) in enumerate(fences.items()):
        v = f"cast({present(df, name)} as double)"
        inside = f"{v} between {double(lower)} and {double(upper)}"
        aggregates += [
            f"min(if({inside}, {v}, null)) as lo{i}",
            f"max(if({inside}, {v}, null)) as hi{i}",
            f"count_if(not ({inside})) as out{i}",
        ]
        rows.append(
            (literal(name), double(q1), double(q2), double(q3), f"lo{i}", f"hi{i}", f"out{i}")
        )
    return stacked(
        df.selectExpr(*aggregates),
        "column_name, q1, median, q3, whisker_lo, whisker_hi, outliers", rows,
    )


def outliers_iqr(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Fences at 1.5 interquartile ranges and the number of values beyond them."""
    fences = _fences(df, columns)
    if not fences:
        return local_rows(
            df.sparkSession, "column_name string, lower double, upper double, outliers bigint", []
        )
    counts, rows = [], []
    for i, (name, (_, _, _, lower, upper)) in enumerate(fences.items()):
        v = f"cast({present(df, name)} as double)"
        counts.append(f"count_if({v} < {double(lower)} or {v} > {double(upper)}) as out{i}")
        rows.append((literal(name), double(lower), double(upper), f"out{i}"))
    return stacked(df.selectExpr(*counts), "column_name, lower, upper, outliers", rows)


def rows_within_fences(df: DataFrame, columns: Iterable[str] | None = None) -> float | None:
    """Share of rows with no numeric value beyond its column's fences."""
    fences = _fences(df, columns)
    if not fences:
        return None
    beyond = " or ".join(
        f"coalesce(cast({present(df, c)} as double) not between {double(lower)} and {double(upper)}, false)"
        for c, (_, _, _, lower, upper) in fences.items()
    )
    return df.selectExpr(f"1 - count_if({beyond}) / count(*)").first()[0]
