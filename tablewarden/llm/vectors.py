"""Embedding near-duplicates by a pivot-permutation index.

A vector is described by its nearest reference points ("pivots"), in order. Similar vectors have nearly
the same list, so inverted lists from pivots to vectors bring them together: two vectors that share
enough pivots are candidates, and every candidate is verified by its exact cosine. Equal vectors are
indexed once. A list that is too long for one task is cut into blocks, and each pair of blocks is one
unit of work, so a list may hold any share of all vectors.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from .common import components, hash64, lookup, root, staged, union, with_row

COSINE = 0.98
#: Pivots grow with the square root of the vectors, up to a bound that keeps their broadcast small.
PIVOTS_MOST = 4096
#: Length of a vector's pivot list, and how many pivots two candidates share at least.
LIST, SHARED = 8, 2
#: Vectors of one inverted list that a task compares with another block, and rows of one task.
BLOCK, TASK_ROWS = 1024, 50_000
#: Pivots closer than this would compete for the same places of a list.
_APART = 0.9


def unit_rows(raw: list[bytes], kind: str) -> np.ndarray:
    """Vectors of equal length as rows of unit length, in double precision."""
    rows = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _usable(batch_vectors: list, kind: str) -> list[bytes | None]:
    out = []
    for vector in batch_vectors:
        if vector is None or len(vector) == 0 or None in vector:
            out.append(None)
            continue
        x = np.asarray(vector, kind)
        out.append(x.tobytes() if np.isfinite(x).all() and x.any() else None)
    return out


def _packed(
    df: DataFrame, id_col: str, vector_col: str, label_col: str, kind: str,
) -> DataFrame:
    """(row, vec_id, key, label, vec): one row per vector; key and vec are null where unusable."""

    def run(batches):
        for batch in batches:
            labels = batch.column("label")
            packed = _usable(batch.column("vector").to_pylist(), kind)
            valid = labels.is_valid().to_pylist()
            packed = [p if ok else None for p, ok in zip(packed, valid, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("vec_id"), labels,
                 pa.array(packed, pa.binary())], ["row", "vec_id", "label", "vec"])

    rows = with_row(df.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<float>" if kind == "<f4" else "array<double>")
        .alias("vector")))
    packed = rows.mapInArrow(run, "row long, vec_id long, label string, vec binary")
    text = F.concat(F.length("label").cast("string"), F.lit(":"), "label")
    return packed.withColumn(
        "key", F.when(F.col("vec").isNotNull(),
                      F.unhex(F.sha2(F.concat(text.cast("binary"), "vec"), 256))))


def choose_pivots(sample: list[bytes], wanted: int, kind: str) -> dict[int, np.ndarray]:
    """Up to ``wanted`` pivots for each vector length (in bytes), none close to another."""
    by_size: dict[int, list[bytes]] = {}
    for raw in sample:
        by_size.setdefault(len(raw), []).append(raw)
    pivots = {}
    for size, raw in by_size.items():
        rows = unit_rows(raw, kind)
        chosen = np.empty((min(wanted, len(rows)), rows.shape[1]))
        n = 0
        for row in rows:
            if n == len(chosen):
                break
            if n == 0 or (chosen[:n] @ row).max() < _APART:
                chosen[n] = row
                n += 1
        pivots[size] = chosen[:n]
    return pivots


def nearest_pivots(rows: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """Numbers of the nearest pivots of each row, the nearest first."""
    length = min(length, len(pivots))
    cosine = rows @ pivots.T
    near = np.argpartition(-cosine, length - 1, axis=1)[:, :length]
    order = np.argsort(-np.take_along_axis(cosine, near, axis=1), axis=1, kind="stable")
    return np.take_along_axis(near, order, axis=1)


def _verify(rows, vectors, lists, pivot, left, right, cosine, shared):
    """Linked pairs (i, j) of one unit: positions ``left`` against ``right`` of its vectors.

    A pair is met in every list that it shares; only the list of its smallest shared pivot keeps it.
    """
    most = int(lists.max()) + 1
    marks = np.zeros((len(rows), most), np.float32)
    np.put_along_axis(marks, lists, 1, axis=1)
    wanted = min(shared, lists.shape[1])
    counts = marks[left] @ marks[right].T
    i, j = np.nonzero(counts >= wanted)
    i, j = left[i], right[j]
    once = rows[i] < rows[j] if left is right else rows[i] != rows[j]
    i, j = i[once], j[once]
    found_i, found_j = [], []
    for at in range(0, len(i), 1 << 16):
        a, b = i[at:at + (1 << 16)], j[at:at + (1 << 16)]
        close = np.einsum("ij,ij->i", vectors[a], vectors[b]) >= cosine
        a, b = a[close], b[close]
        common = (lists[a][:, :, None] == lists[b][:, None, :]).any(axis=2)
        first = np.where(common, lists[a], most).min(axis=1) == pivot
        found_i.append(a[first])
        found_j.append(b[first])
    none = np.empty(0, np.int64)
    return np.concatenate([none, *found_i]), np.concatenate([none, *found_j])


def _links(postings: DataFrame, cosine: float, shared: int, kind: str) -> DataFrame:
    """(a, b, n): n more links of row a; b is a row of its component, or null."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.column("rep").to_numpy()
        weight = table.column("w").to_numpy()
        block = table.column("block").to_numpy()
        units: dict[tuple, list[int]] = {}
        names = zip(*(table.column(c).to_pylist() for c in ("label", "size", "pivot", "i", "j")),
                    strict=True)
        for at, name in enumerate(names):
            units.setdefault(name, []).append(at)
        raw, lists = table.column("vec"), table.column("list")
        links, parent = {}, {}
        for (_, _, pivot, i, j), members in units.items():
            at = np.array(members)
            if len(at) < 2:
                continue
            take = pa.array(at)
            vectors = unit_rows(raw.take(take).to_pylist(), kind)
            own = np.array(lists.take(take).to_pylist())
            here = np.arange(len(at))
            left = here[block[at] == i]
            right = left if i == j else here[block[at] == j]
            if len(left) and len(right):
                a, b = _verify(rows[at], vectors, own, pivot, left, right, cosine, shared)
                for x, y in ((a, b), (b, a)):
                    nodes, place = np.unique(rows[at][x], return_inverse=True)
                    more = np.bincount(place, weights=weight[at][y], minlength=len(nodes))
                    for node, n in zip(nodes.tolist(), more.tolist(), strict=True):
                        links[node] = links.get(node, 0) + int(n)
                for x, y in zip(rows[at][a].tolist(), rows[at][b].tolist(), strict=True):
                    union(parent, x, y)
        nodes = list(links)
        return pa.table({
            "a": pa.array(nodes, pa.int64()),
            "b": pa.array([root(parent, x) for x in nodes], pa.int64()),
            "n": pa.array([links[x] for x in nodes], pa.int64())})

    return postings.groupBy("bucket").applyInArrow(run, "a long, b long, n long")


def near_vectors(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    label_col: str = "label", cosine: float = COSINE, length: int = LIST, shared: int = SHARED,
    block: int = BLOCK, pivots: int | None = None,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Rows of the same label whose vectors have a cosine of at least ``cosine`` and are met in the
    index are linked; no other rows are. ``component_id`` is the smallest vec_id reachable, and a
    row is kept where that is its own. A vector that is null, empty, zero, or holds a null or
    non-finite number, and a vector with a null label, links with nothing. Vectors of different
    lengths never link. Repeated rows are rows of their own and link with each other; a null vec_id
    is never a component's smallest and never kept. An empty table gives no rows.
    """
    single = df.schema[vector_col].dataType == ArrayType(FloatType())
    kind = "<f4" if single else "<f8"  # single precision travels as it is, and is widened to compare
    rows = staged(_packed(df, id_col, vector_col, label_col, kind), "vectors")
    usable = rows.filter(F.col("key").isNotNull())
    reps = staged(
        usable.groupBy("key").agg(
            F.min("row").alias("rep"), F.count("*").alias("w"), F.first("label").alias("label"),
            F.first("vec").alias("vec")), "distinct")
    n = reps.count()
    wanted = pivots or min(PIVOTS_MOST, max(16, math.ceil(2 * math.sqrt(n))))
    # The sample for pivots is at most four times their number: a bounded collect and broadcast.
    sample = reps.select("vec").orderBy(hash64("vec"), "vec").limit(4 * wanted).collect()
    spark = df.sparkSession
    chosen = spark.sparkContext.broadcast(choose_pivots([bytes(r.vec) for r in sample], wanted, kind))

    def post(batches):
        for batch in batches:
            raw = batch.column("vec").to_pylist()
            near: list = [None] * len(raw)
            by_size: dict[int, list[int]] = {}
            for at, vec in enumerate(raw):
                by_size.setdefault(len(vec), []).append(at)
            for size, at in by_size.items():
                if size not in chosen.value:
                    lists = np.zeros((len(at), 1), np.int64)
                else:
                    unit = unit_rows([raw[x] for x in at], kind)
                    lists = nearest_pivots(unit, chosen.value[size], length)
                for x, own in zip(at, lists.tolist(), strict=True):
                    near[x] = own
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("w"), batch.column("label"),
                 batch.column("vec"), pa.array(near, pa.list_(pa.int32()))],
                ["rep", "w", "label", "vec", "list"])

    described = staged(
        reps.select("rep", "w", "label", "vec").mapInArrow(
            post, "rep long, w long, label string, vec binary, list array<int>"), "pivots")
    described = described.withColumn("size", F.length("vec"))
    places = described.select("rep", "label", "size", F.explode("list").alias("pivot"))
    lengths = places.groupBy("label", "size", "pivot").agg(
        F.ceil(F.count("*") / block).cast("int").alias("blocks"), F.count("*").alias("held"))
    lengths = staged(lengths.filter("held > 1"), "lengths")
    posted = described.select("*", F.explode("list").alias("pivot")).join(
        lengths, ["label", "size", "pivot"])
    posted = posted.withColumn("block", F.pmod(hash64("rep"), "blocks").cast("int"))
    posted = posted.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    posted = posted.withColumns({
        "i": F.least("block", "other"), "j": F.greatest("block", "other")})
    # A row of a list goes to as many pairs of blocks as the list has blocks.
    copies = lengths.agg(F.sum(F.col("held") * F.col("blocks"))).first()[0] or 0
    buckets = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(copies / TASK_ROWS))
    posted = posted.withColumn(
        "bucket", F.pmod(hash64("label", "size", "pivot", "i", "j"), F.lit(buckets)))
    found = staged(
        _links(posted.select("bucket", "label", "size", "pivot", "i", "j", "block", "rep", "w",
                             "vec", "list"), cosine, shared, kind), "links")
    counts = found.groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    stars = components(found.select("a", "b"))
    by_key = (
        reps.select("key", "rep", "w").join(counts, "rep", "left")
        .join(stars.withColumnRenamed("node", "rep"), "rep", "left")
        .select("key", F.coalesce("component", "rep").alias("top"),
                (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links")))
    members = staged(lookup(usable.select("vec_id", "key"), by_key, "key"), "members")
    lowest = members.groupBy("top").agg(F.min("vec_id").alias("component_id"))
    linked = lookup(members, lowest, "top")
    alone = rows.filter(F.col("key").isNull()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.select("vec_id", "n_links", "component_id").unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
