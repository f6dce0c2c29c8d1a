"""Isolation forest (Liu, Ting, Zhou 2008) on the numeric columns.

Trees grow from small random samples, one task group per tree; a tree never sees
more than ``sample`` rows. The finished trees, a model of fixed size, go to every
task, where each batch of rows is scored at once. The flagging threshold is an
exact quantile of all scores.
"""
from __future__ import annotations

import sys
from collections.abc import Iterable
from typing import Any

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import fixed
from ..storage import stage
from .columns import numeric_columns, present
from .measures import watch
from .quantiles import exact_quantiles

# Executors need not have this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCORE = "anomaly_score"
_NODES = "tree int, node int, feature int, cut double, left int, right int, depth double"
_NODE_NAMES = ["tree", "node", "feature", "cut", "left", "right", "depth"]


def _average_path(n: float) -> float:
    """Mean depth of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (np.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def _grow(points: np.ndarray, limit: int, rng: np.random.Generator) -> list[tuple]:
    """Nodes (node, feature, cut, left, right, depth); leaves have feature -1 and
    point to themselves, with the expected depth of their points."""
    nodes: list[tuple] = []
    pending = [(points, 0, None)]
    while pending:
        rows, depth, parent = pending.pop()
        here = len(nodes)
        if parent is not None:
            at, side = parent
            nodes[at] = nodes[at][: 3 + side] + (here,) + nodes[at][4 + side:]
        low, high = rows.min(axis=0), rows.max(axis=0)
        varying = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or not len(varying):
            nodes.append((here, -1, 0.0, here, here, depth + _average_path(len(rows))))
            continue
        feature = int(rng.choice(varying))
        cut = float(rng.uniform(low[feature], high[feature]))
        under = rows[:, feature] <= cut
        nodes.append((here, feature, cut, -1, -1, 0.0))
        pending.append((rows[~under], depth + 1, (here, 1)))
        pending.append((rows[under], depth + 1, (here, 0)))
    return nodes


_BUCKET_BITS = 21


def _possible(data: DataFrame, gap: Column, seed: int) -> DataFrame:
    """The rows that can be drawn: those whose gap is below a bound on the number of their copies.

    The bound is the number of rows in the tuple's hash bucket, rounded up to a power of two: one byte
    for each of 2^21 buckets, however large the table. Both depend on the values alone, so a tuple stays
    with all its copies or goes, before anything is shuffled.
    """
    spark, values = data.sparkSession, data.columns
    bucket = F.pmod(F.xxhash64(*values, F.lit(seed + 7)), F.lit(1 << _BUCKET_BITS)).cast("int")
    counts = data.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n")).select(
        "bucket", F.ceil(F.log2("n")).cast("byte").alias("power")).toArrow()
    powers = np.zeros(1 << _BUCKET_BITS, np.int8)
    powers[counts["bucket"].to_numpy()] = counts["power"].to_numpy()
    shared = spark.sparkContext.broadcast(powers)

    def below(gaps: pd.Series, buckets: pd.Series) -> pd.Series:
        return gaps < np.left_shift(1, shared.value[buckets.to_numpy()].astype(np.int64))

    return data.filter(F.pandas_udf(below, "boolean")(gap, bucket))


def _gap(values: list[str], share: float, seed: int) -> Column:
    """Copies of a tuple passed over before the first one kept: geometric, from the values' hash."""
    key = F.xxhash64(*values, F.lit(seed))
    return F.floor(F.log1p(-F.shiftrightunsigned(key, 11) / F.lit(2.0**53))
                   / F.lit(float(np.log1p(-share))))


def _copies(data: DataFrame, share: float, seed: int) -> DataFrame:
    """Each row of ``data`` with probability ``share``, as the values and ``copy``, which numbers
    equal rows.

    Equal rows are counted, and the number of copies kept is a binomial draw from the hash of
    the values: the gap before the first copy kept is geometric, what follows it is drawn in Python.
    Rows that cannot be drawn stay where they are, so about the rows of the result move.
    """
    values = data.columns
    # As grouping has it: no negative zero.
    data = data.selectExpr(*[f"{v} + 0D as {v}" for v in values])
    if share < 1:
        gap = _gap(values, share, seed)
        data = _possible(data, gap, seed)
    tuples = data.groupBy(*values).agg(F.count("*").alias("n_equal"))
    if share < 1:

        def draw(rest: pd.Series, keys: pd.Series) -> pd.Series:
            return pd.Series([
                1 + int(np.random.default_rng([seed, k & (2**64 - 1)]).binomial(r, share)) if r else 1
                for r, k in zip(rest.tolist(), keys.tolist(), strict=True)], dtype="int64")

        tuples = tuples.withColumns({
            "rest": F.col("n_equal") - 1 - gap, "key": F.xxhash64(*values, F.lit(seed))})
        tuples = tuples.filter(F.col("rest") >= 0).withColumn(
            "n_equal", F.pandas_udf(draw, "long")("rest", "key"))
    return tuples.select(
        *values, F.explode(F.sequence(F.lit(0), F.col("n_equal") - 1)).alias("copy"))


def _samples(data: DataFrame, n: int, trees: int, sample: int, seed: int) -> DataFrame:
    """``sample`` random rows per tree (all rows if there are fewer), with ``tree``.

    The lowest hashes of a tree, ties by value. Equal rows are picked one by one.
    """
    # Picks are hashes of the values and of a number among equal rows, so they do not depend on how
    # the rows are spread. Thin first: only a pool of fixed expected size is copied per tree.
    values = data.columns
    wanted = 8.0 * trees * sample
    pool = _copies(data, min(1.0, wanted / n), seed)
    # A frequent value's copies leave the task that counted them.
    parts = int(data.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pool = pool.repartition(parts, *values, "copy")
    copies = pool.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    copies = copies.withColumn("pick", F.xxhash64(*values, "copy", "tree", F.lit(seed + 1)))
    share = min(1.0, 8.0 * sample / min(n, int(wanted)))
    order = F.shiftrightunsigned("pick", 11)
    copies = copies.filter(order < int(share * 2.0**53))
    first = W.partitionBy("tree").orderBy(order, *values, "copy")
    return (
        copies.withColumn("place", F.row_number().over(first))
        .filter(F.col("place") <= sample)
        .drop("place", "copy")
    )


def complete_rows(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.filter(" and ".join(f"{present(df, c)} is not null" for c in columns))


def fit_forest(
    df: DataFrame,
    columns: list[str],
    trees: int = fixed.FOREST_TREES,
    sample: int = fixed.FOREST_SAMPLE,
    seed: int = fixed.FOREST_SEED,
    rows_known: int | None = None,
) -> dict[str, np.ndarray] | None:
    """The forest as arrays of shape (trees, nodes); None without rows."""
    data = complete_rows(df, columns).selectExpr(
        *[f"cast({present(df, c)} as double) as v{i}" for i, c in enumerate(columns)]
    )
    n = data.count() if rows_known is None else rows_known
    if not n:
        return None
    values = [f"v{i}" for i in range(len(columns))]
    size = min(sample, n)
    limit = int(np.ceil(np.log2(max(size, 2))))

    def grow_tree(key: tuple[Any, ...], pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(key[0])
        points = pdf.sort_values(["pick", *values])[values].to_numpy()
        nodes = _grow(points, limit, np.random.default_rng([seed, tree]))
        return pd.DataFrame([(tree, *node) for node in nodes], columns=_NODE_NAMES)

    grown = _samples(data, n, trees, sample, seed).groupBy("tree").applyInPandas(grow_tree, _NODES)
    # At most trees * 2 * sample rows: the size of the model, not of the data.
    nodes = grown.toPandas()
    width = int(nodes["node"].max()) + 1
    forest = {}
    for name, kind in (("feature", np.int64), ("cut", float), ("left", np.int64),
                       ("right", np.int64), ("depth", float)):
        array = np.zeros((trees, width), dtype=kind)
        array[nodes["tree"], nodes["node"]] = nodes[name]
        forest[name] = array
    # Children of node i at 2 i and 2 i + 1; leaves lead to themselves.
    forest["child"] = np.stack([forest.pop("left"), forest.pop("right")], axis=2).reshape(trees, -1)
    forest["feature"] = np.maximum(forest["feature"], 0)
    forest["limit"] = limit
    forest["rows"] = n
    forest["norm"] = max(_average_path(size), 1e-12)
    return forest


def score_rows(df: DataFrame, columns: list[str], forest: dict) -> DataFrame:
    """``df`` with an anomaly score per row, near 1 for isolated rows."""
    shared = df.sparkSession.sparkContext.broadcast(forest)

    def score(*series: pd.Series) -> pd.Series:
        model = shared.value
        points = np.column_stack([s.to_numpy(dtype=float) for s in series])
        flat, row_start = points.ravel(), np.arange(len(points)) * len(columns)
        depth = np.zeros(len(points))
        for tree in range(len(model["cut"])):
            feature, cut, child = model["feature"][tree], model["cut"][tree], model["child"][tree]
            node = np.zeros(len(points), dtype=np.int64)
            for _ in range(model["limit"]):
                over = flat.take(row_start + feature.take(node)) > cut.take(node)
                node = child.take(2 * node + over)
            depth += model["depth"][tree].take(node)
        return pd.Series(2.0 ** (-depth / len(model["cut"]) / model["norm"]))

    scored = F.pandas_udf(score, "double")
    inputs = [F.expr(f"cast({present(df, c)} as double)") for c in columns]
    return df.withColumn(SCORE, scored(*inputs))


def detect_anomalies(
    df: DataFrame,
    columns: list[str] | None = None,
    contamination: float = fixed.CONTAMINATION,
    partitions: int | None = None,
    **forest_options,
) -> tuple[DataFrame, float | None]:
    """(complete rows with anomaly_score and is_anomaly, threshold).

    Rows with a missing number are left out, as they cannot be scored. ``partitions`` spreads the
    rows before scoring, for a table that is one file. Rows are scored once and staged with their
    score, which the threshold and the result read. ``rows_known`` is the number of complete rows.
    """
    columns = columns if columns is not None else numeric_columns(df)
    forest = fit_forest(df, columns, **forest_options) if columns else None
    if forest is None:
        empty = df.filter("false").withColumn(SCORE, F.lit(None).cast("double"))
        return empty.withColumn("is_anomaly", F.lit(None).cast("boolean")), None
    rows = complete_rows(df, columns)
    if partitions:
        rows = rows.repartition(partitions)
    writing = watch(score_rows(rows, columns, forest), columns=[SCORE])
    scored = stage(writing.table, "scored")
    threshold = exact_quantiles(
        scored, [SCORE], (1.0 - contamination,), writing.seen().extents)[SCORE][0]
    return scored.withColumn("is_anomaly", F.col(SCORE) > F.lit(threshold)), threshold


def anomaly_counts(flagged: DataFrame) -> DataFrame:
    return flagged.selectExpr(
        "count(*) as rows_scored",
        "count_if(is_anomaly) as anomalies",
        "round(try_divide(100D * count_if(is_anomaly), count(*)), 2) as anomaly_pct",
    )
