"""Profile statistics: missing values, consistency, cardinality, correlation and
distribution."""
from __future__ import annotations

import math
import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame

from ..functions import fixed
from ..functions.text import literal, quoted
from .columns import local_rows, numeric_columns, present, stacked
from .facts import present_counts
from .measures import Measures, measure
from .metadata import classify
from .quantiles import exact_quantiles

# Executors need not have this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def dataset_summary(
    df: DataFrame, source: str | None = None, known: Measures | None = None
) -> DataFrame:
    """Shape of the table; ``source`` says where it came from. Reads nothing if it is ``known``."""
    one = local_rows(df.sparkSession, "one int", [(1,)]) if known else df
    return one.selectExpr(
        f"{literal(source) if source else 'cast(null as string)'} as source",
        f"{known.rows}L as rows" if known else "count(*) as rows",
        f"{len(df.columns)}L as columns",
        f"{literal('|'.join(df.columns))} as column_names",
    )


def _present(df: DataFrame, known: Measures | None) -> DataFrame:
    return known.counts(df) if known else present_counts(df)


def missing_per_column(df: DataFrame, known: Measures | None = None) -> DataFrame:
    return _present(df, known).selectExpr(
        "column_name",
        "n_rows - n_present as missing",
        "round(try_divide(100D * (n_rows - n_present), n_rows), 2) as missing_pct",
    )


def missing_overall(df: DataFrame, known: Measures | None = None) -> DataFrame:
    def names(condition: str) -> str:
        return f"array_join(sort_array(collect_list(if({condition}, column_name, null))), '|')"

    return _present(df, known).selectExpr(
        "sum(n_rows - n_present) as total_missing_cells",
        "sum(n_rows) as total_cells",
        "round(try_divide(100D * sum(n_rows - n_present), sum(n_rows)), 2) as missing_pct",
        f"{names('n_present = n_rows')} as complete_columns",
        f"{names('n_present = 0')} as empty_columns",
    )


def type_consistency(facts: DataFrame) -> DataFrame:
    """Share of a column's values that read as its inferred type."""
    conforming = """case
        when inferred_type = 'numeric_as_text' then n_number
        when inferred_type = 'datetime' and kind = 'text' then n_date
        else n_present end"""
    return classify(facts).selectExpr("*", f"{conforming} as conforming").selectExpr(
        "column_name",
        "inferred_type",
        "round(try_divide(100D * conforming, n_present), 2) as consistency_pct",
        "n_present - conforming as nonconforming",
    )


def cardinality(facts: DataFrame) -> DataFrame:
    """Distinct values; the ratio is to all rows, missing ones included."""
    return facts.selectExpr(
        "column_name",
        "n_unique as unique_values",
        "round(coalesce(try_divide(n_unique, n_rows), 0D), 4) as cardinality_ratio",
        "n_unique <= 1 as is_constant",
        "round(coalesce(try_divide(n_unique, n_rows), 0D), 4)"
        f" > {fixed.HIGH_CARDINALITY}D as is_high_cardinality",
    )


def cardinality_approx(df: DataFrame, rsd: float = 0.02) -> DataFrame:
    """Distinct counts from sketches: one pass, no shuffle of values."""
    names = [c for c in df.columns if df.schema[c].dataType.typeName() not in ("map", "variant")]
    counted = [
        f"approx_count_distinct({present(df, c)}, {rsd}D) as c{i}" for i, c in enumerate(names)
    ]
    return stacked(
        df.selectExpr("count(*) as n_rows", *counted),
        "column_name, unique_values, n_rows",
        [(literal(c), f"c{i}", "n_rows") for i, c in enumerate(names)],
    ).selectExpr(
        "column_name", "unique_values",
        "round(coalesce(try_divide(unique_values, n_rows), 0D), 4) as cardinality_ratio",
    )


def numeric_moments(df: DataFrame, columns: Iterable[str] | None = None) -> list[dict]:
    """One row (column_name, n, lo, hi, mean, std, skew) per column with values.

    One aggregation per group of columns; no shuffle beyond one row per task.
    """
    names = list(columns) if columns is not None else numeric_columns(df)
    moments = measure(df.select(*[quoted(c) for c in names])).moments if names else {}
    return [moments[c] for c in names if c in moments]


@dataclass(frozen=True)
class Numbers:
    """Moments and quartiles of numeric columns, worked out once for all tables that need them."""

    moments: dict
    quartiles: dict[str, list[float]]


def numbers_of(
    df: DataFrame, columns: Iterable[str] | None = None, known: Measures | None = None
) -> Numbers:
    if known:
        moments = dict(known.moments)
    else:
        moments = {m["column_name"]: m for m in numeric_moments(df, columns)}
    extent = {c: (m["n"], m["lo"], m["hi"]) for c, m in moments.items()}
    return Numbers(moments, exact_quantiles(df, list(moments), (0.25, 0.5, 0.75), extent))


def numeric_distribution(
    df: DataFrame, columns: Iterable[str] | None = None, known: Numbers | None = None
) -> DataFrame:
    """min, max, mean, median, std, quartiles and bias-adjusted skew."""
    known = known or numbers_of(df, columns)
    moments, quartiles = known.moments.values(), known.quartiles

    def skew(m) -> float | None:
        n = m["n"]
        if n < 3:
            return None
        if m["lo"] == m["hi"] or m["skew"] is None:
            return 0.0
        return m["skew"] * math.sqrt(n * (n - 1.0)) / (n - 2.0)

    rows = []
    for m in moments:
        q1, median, q3 = quartiles[m["column_name"]]
        rows.append((m["column_name"], m["lo"], m["hi"], m["mean"], median, m["std"], q1, q3, skew(m)))
    return local_rows(
        df.sparkSession,
        "column_name string, min double, max double, mean double, median double, std double,"
        " q1 double, q3 double, skew double",
        rows,
    ).selectExpr(
        "column_name", "min", "max", "round(mean, 3) as mean", "median", "round(std, 3) as std",
        "q1", "q3", "round(skew, 3) as skew",
    )


#: Columns of a tile: a task holds ten sums of a tile's pairs with another, 21 MB, however wide the table.
TILE = 512
#: Values that a task turns into products at once, and bytes of a tile pair's rows for one task.
_CHUNK_VALUES, _UNIT_BYTES = 1_000_000, 128_000_000


def correlation_matrix(
    df: DataFrame, columns: Iterable[str] | None = None, moments: dict | None = None,
    tile: int = TILE,
) -> DataFrame:
    """Pearson correlation of each ordered pair of numeric columns, over the rows
    where both are present; NULL where either does not vary there or is infinite.

    Values are centred on the column mean first, so plain sums are accurate. One read. Up to ``tile``
    columns every task adds up products of the whole column block, and passes on one row per column.
    Wider tables are cut into column tiles, and the rows of each pair of tiles meet in tasks of their
    own: sums of all pairs would be larger than the rows they come from.
    """
    names = list(columns) if columns is not None else numeric_columns(df)
    schema = "column_name string, column_y string, corr double"
    if len(names) < 2:
        return local_rows(df.sparkSession, schema, [])
    known = moments or {m["column_name"]: m for m in numeric_moments(df, names)}
    used = [c for c in names if c in known and math.isfinite(known[c]["mean"])
            and math.isfinite(known[c]["lo"]) and math.isfinite(known[c]["hi"])]
    means = [known[c]["mean"] for c in used]
    if len(used) > tile:
        rows = max(known[c]["n"] for c in used)
        found = _tiled(df, used, means, tile, max(1, math.ceil(rows * 16 * tile / _UNIT_BYTES)))
        def listed(some: list[str]) -> str:
            return f"array({', '.join(map(literal, some))})"

        turned = ("inline(array(struct(x as column_name, y as column_y, corr),"
                  " struct(y as column_name, x as column_y, corr)))")
        result = found.selectExpr(
            f"{listed(used)}[x] as x", f"{listed(used)}[y] as y", "corr").selectExpr(turned)
        rest = [(c, c, 1.0 if known[c]["lo"] < known[c]["hi"] else None) for c in used]
        result = result.unionByName(local_rows(df.sparkSession, schema, rest))
        spare = [c for c in names if c not in set(used)]  # nothing correlates with these
        if spare:
            here = df.sparkSession.range(len(spare)).selectExpr(
                f"{listed(spare)}[cast(id as int)] as x", "cast(null as double) as corr")
            result = result.union(
                here.selectExpr("*", f"explode({listed(used)}) as y").selectExpr(turned)
            ).union(here.selectExpr("x", f"explode({listed(spare)}) as y", "corr"))
    else:
        pairs = _pairwise(df, used, means) if used else {}
        rows = []
        for x in names:
            for y in names:
                if x == y:
                    varies = x in used and known[x]["lo"] < known[x]["hi"]
                    rows.append((x, y, 1.0 if varies else None))
                else:
                    rows.append((x, y, pairs.get((x, y), pairs.get((y, x)))))
        result = local_rows(df.sparkSession, schema, rows)
    return result.selectExpr("column_name", "column_y", "round(corr, 3) as corr")


class Products:
    """For each pair of a column of one block and one of another, over the rows where both are present:
    n, sx, sy, sxx, syy, sxy and the bounds lox, hix, loy, hiy."""

    def __init__(self, left: int, right: int):
        self.sums = np.zeros((6, left, right))
        self.bounds = np.full((4, left, right), np.inf)  # maxima are kept negated

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        """Rows of both blocks, centred, NaN where missing."""
        own, other = ~np.isnan(x), ~np.isnan(y)
        self._bound(self.bounds[:2], x, other)
        self._bound(self.bounds[2:].transpose(0, 2, 1), y, own)
        x, y = np.where(own, x, 0.0), np.where(other, y, 0.0)
        own, other = own.astype(float), other.astype(float)
        for i, (a, b) in enumerate((
                (own, other), (x, other), (own, y), (x * x, other), (own, y * y), (x, y))):
            self.sums[i] += a.T @ b

    @staticmethod
    def _bound(bounds: np.ndarray, x: np.ndarray, other: np.ndarray) -> None:
        """Bounds of the columns of ``x`` where the other columns are present: those without a gap
        share them, the others take a pass each."""
        low, high = np.where(np.isnan(x), np.inf, x), np.where(np.isnan(x), np.inf, -x)
        gaps = ~other.all(axis=0)
        for at, values in enumerate((low, high)):
            whole = values.min(axis=0, initial=np.inf)[:, None]
            bounds[at][:, ~gaps] = np.minimum(bounds[at][:, ~gaps], whole)
            for j in np.flatnonzero(gaps).tolist():
                some = values[other[:, j]].min(axis=0, initial=np.inf)
                bounds[at][:, j] = np.minimum(bounds[at][:, j], some)

    def rows(self) -> list[np.ndarray]:
        """Per column of the left block all ten numbers, flat."""
        both = np.concatenate([self.sums, self.bounds])
        return list(both.transpose(1, 0, 2).reshape(self.sums.shape[1], -1))


def _merged(parts: Iterator[np.ndarray]) -> np.ndarray:
    whole = None
    for row in parts:
        row = row.reshape(10, -1)
        if whole is None:
            whole = row.copy()
        else:
            whole[:6] += row[:6]
            whole[6:] = np.minimum(whole[6:], row[6:])
    return whole


def _coefficients(sums: np.ndarray) -> list[float | None]:
    n, sx, sy, sxx, syy, sxy, lox, hix, loy, hiy = sums
    with np.errstate(all="ignore"):
        spread = (sxx - sx * sx / n) * (syy - sy * sy / n)
        value = np.clip((sxy - sx * sy / n) / np.sqrt(spread), -1.0, 1.0)
        there = (n > 0) & (lox < -hix) & (loy < -hiy) & (spread > 0)
    return [v if ok else None for v, ok in zip(value.tolist(), there.tolist(), strict=True)]


def _values(df: DataFrame, names: list[str]) -> DataFrame:
    return df.selectExpr(
        *[f"cast({present(df, c)} as double) as v{i}" for i, c in enumerate(names)])


def _chunks(batches: Iterator[pa.RecordBatch], means: list[float]) -> Iterator[np.ndarray]:
    """Centred rows, a bounded number of values at a time."""
    step = max(1, _CHUNK_VALUES // len(means))
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            some = batch.slice(start, step)
            yield np.column_stack([
                c.to_numpy(zero_copy_only=False).astype(float) for c in some.columns]) - means


def _pairwise(df: DataFrame, names: list[str], means: list[float]) -> dict:
    """(x, y) -> correlation over the rows where both are present, of one block of columns."""
    k = len(names)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products = Products(k, k)
        for x in _chunks(batches, means):
            products.add(x, x)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(k), pa.int32()), pa.array(products.rows(), pa.list_(pa.float64()))],
            ["x", "sums"])

    def total(key: tuple, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = _merged(row for part in parts for row in part["sums"])
        yield pd.DataFrame({"x": [key[0]], "sums": [whole.ravel()]})

    added = _values(df, names).mapInArrow(add, "x int, sums array<double>").groupBy(
        "x").applyInPandas(total, "x int, sums array<double>")
    # One row of numbers per column, as the result has one number per pair.
    held = {r["x"]: _coefficients(np.array(r["sums"]).reshape(10, k)) for r in added.collect()}
    return {(names[i], names[j]): held[i][j] for i, j in combinations(range(k), 2) if i in held}


def _tiled(
    df: DataFrame, names: list[str], means: list[float], tile: int, slots: int,
) -> DataFrame:
    """(x, y, corr) for all x < y, as places in ``names``.

    Every chunk of rows goes to each pair of tiles, in ``slots`` parts; their sums meet by column.
    """
    k = len(names)
    ends = [(a, min(k, a + tile)) for a in range(0, k, tile)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId()
        for x in _chunks(batches, means):
            blocks = [np.ascontiguousarray(x[:, a:b]).tobytes() for a, b in ends]
            for i, own in enumerate(blocks):
                for j in range(i, len(blocks)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([i], pa.int32()), pa.array([j], pa.int32()),
                         pa.array([at % slots], pa.int32()), pa.array([own], pa.binary()),
                         pa.array([blocks[j] if i != j else b""], pa.binary())],
                        ["a", "b", "slot", "xs", "ys"])
            at += 1

    def add(key: tuple, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        i, j = int(key[0]), int(key[1])
        widths = [b - a for a, b in (ends[i], ends[j])]
        products = Products(*widths)
        for part in parts:
            for xs, ys in zip(part["xs"], part["ys"], strict=True):
                x = np.frombuffer(xs).reshape(-1, widths[0])
                products.add(x, np.frombuffer(ys).reshape(-1, widths[1]) if i != j else x)
        for at, row in enumerate(products.rows()):
            yield pd.DataFrame({"x": [ends[i][0] + at], "b": [j], "sums": [row]})

    def total(key: tuple, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        x, first = int(key[0]), ends[int(key[1])][0]
        found = _coefficients(_merged(row for part in parts for row in part["sums"]))
        pairs = [(x, first + j, c) for j, c in enumerate(found) if x < first + j]
        out = pd.DataFrame(pairs, columns=["x", "y", "corr"])
        yield out.astype({"x": "int32", "y": "int32", "corr": "float64"})

    rows = _values(df, names).mapInArrow(cut, "a int, b int, slot int, xs binary, ys binary")
    sums = rows.groupBy("a", "b", "slot").applyInPandas(add, "x int, b int, sums array<double>")
    found = sums.groupBy("x", "b").applyInPandas(total, "x int, y int, corr double")
    return found.selectExpr("x", "y", "nanvl(corr, null) as corr")
