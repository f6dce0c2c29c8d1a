"""Shared pieces of the training-data operators: staged tables, row keys, lookups, components."""
from __future__ import annotations

import ctypes
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Text bytes that a task turns into numpy arrays at once; bounds its memory, changes no result.
SLICE_BYTES = 2_000_000


@cache
def _own_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="tablewarden-llm-")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only for a local master without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _own_folder()


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later steps reread instead of recompute.

    Lost executors then cost a reread. :func:`release` deletes the folder, :func:`owning` tells which.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _STAGED[-1].append((path, None))
    return spark.read.schema(df.schema).parquet(path)


def staged_buckets(df: DataFrame, label: str, key: str, buckets: int) -> DataFrame:
    """As :func:`staged`, in buckets of a key: a later grouping by the key needs no exchange."""
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/llm/{name}"
    df.write.option("compression", "zstd").option("path", path).bucketBy(
        buckets, key).saveAsTable(name)
    _STAGED[-1].append((path, name))
    return spark.table(name)


#: Lists of (path, table name) of what is staged; the innermost owner's is last.
_STAGED: list[list[tuple[str, str | None]]] = [[]]


@contextmanager
def owning() -> Iterator[list[tuple[str, str | None]]]:
    """What is staged inside belongs to the list this gives, and to no one else."""
    owned: list[tuple[str, str | None]] = []
    _STAGED.append(owned)
    try:
        yield owned
    finally:
        _STAGED.pop()


def release(spark: SparkSession, owned: list[tuple[str, str | None]] | None = None) -> None:
    """Delete staged tables, those of an owner or those without one; call it once the results built on
    them are written."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    owned = _STAGED[0] if owned is None else owned
    while owned:
        place, name = owned.pop()
        if name:
            spark.sql(f"drop table if exists `{name}`")
        path = jvm.org.apache.hadoop.fs.Path(place)
        path.getFileSystem(conf).delete(path, True)


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, with as many underscores as it takes to be none of the columns, in any case."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def with_row(df: DataFrame) -> DataFrame:
    """``df`` with a unique ``row`` number. Stage the result before using the number twice: a second
    read may be split otherwise."""
    return df.withColumn("row", F.monotonically_increasing_id())


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What operators read, as (doc_id, text_key, text); a null text counts as empty.

    ``text_key`` hashes the text and tells rows of one doc_id apart. Other columns are left behind,
    so their names cannot clash with working columns.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"), hash64(text).alias("text_key"),
        text.alias("text"))


def looked_up(
    df: DataFrame, keys: DataFrame, id_col: str, text_col: str, names: tuple[str, str],
) -> tuple[DataFrame, DataFrame]:
    """(rows that may be among the keys (doc_id, text_key), rows that surely are not).

    Both have the columns of ``df``, the first also its keys under ``names``. A filter of bounded size
    decides, where the rows are; more keys only let more rows pass.
    """
    place = hash64("doc_id", "text_key").alias("place")
    bits = df.sparkSession.sparkContext.broadcast(key_filter(keys.select(place), "place"))
    maybe = F.arrow_udf(lambda places: pa.array(may_hold(bits.value, places.to_numpy())), "boolean")
    (mark,) = unused([*df.columns, *names], "maybe")
    rows = df.withColumns({
        names[0]: F.col(id_col).cast("long"),
        names[1]: hash64(F.coalesce(F.col(text_col), F.lit("")))})
    rows = rows.withColumn(mark, maybe(hash64(*names)))
    return rows.filter(F.col(mark)).drop(mark), rows.filter(~F.col(mark)).select(*map(quoted, df.columns))


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def keep_rows(
    df: DataFrame, marked: DataFrame, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The rows of ``df`` that ``marked`` (doc_id, text_key, kept) keeps, with all their columns.

    ``marked`` has one row per document. Rows that repeat both id and text are one document: of them
    the one stays whose whole row, as JSON, has the least hash. Only rows that a filter of bounded
    size takes for dropped or repeated ones move to be looked up exactly; all others stay where they
    are. Every task passes on one row of a document.
    """
    marked = staged(marked.select("doc_id", "text_key", "kept"), "marked")
    unsure = marked.groupBy("doc_id", "text_key").agg(
        F.min("kept").alias("kept"), F.count("*").alias("n")).filter("not kept or n > 1")
    row_id, row_key, kept_id, kept_key, whole, nth = unused(
        df.columns, "row_id", "row_key", "kept_id", "kept_key", "whole", "nth")
    rows, sure = looked_up(df, unsure, id_col, text_col, (row_id, row_key))
    keys = marked.filter("kept").select(
        F.col("doc_id").alias(kept_id), F.col("text_key").alias(kept_key)).distinct()
    same = F.col(row_id).eqNullSafe(F.col(kept_id)) & (F.col(row_key) == F.col(kept_key))
    own = list(map(quoted, df.columns))
    as_json = F.to_json(F.struct(*own))
    found = rows.join(keys, same, "left_semi").withColumn(whole, hash64(as_json))
    first = F.row_number().over(Window.partitionBy(row_id, row_key).orderBy(whole))
    found = found.withColumn(nth, first).filter(F.col(nth) == 1)
    return sure.union(found.select(*own))


def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of a task; at its end the worker, which lives on, gives back what it no longer needs."""
    yield from batches
    give_back()


def give_back() -> None:
    """Free memory of this process goes back to the system."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def arrow_map(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with a function from one batch to one batch (or None)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out = fn(part)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(lambda batches: trimmed(run(batches)), schema)


def slices(
    batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES,
) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about ``limit`` bytes of a column; a longer text stands alone."""
    ends = np.cumsum(text_lengths(batch.column(column)))
    start = 0
    while start < len(ends):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_lengths(column: pa.Array) -> np.ndarray:
    """Bytes of each text of a column without nulls."""
    return np.diff(_offsets(column))


def _offsets(column: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    raw = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    return raw[column.offset:column.offset + len(column) + 1].astype(np.int64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets into them) of a column without nulls, without copying texts."""
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = _offsets(column)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def hash64(*columns: Column | str) -> Column:
    return F.xxhash64(*columns)


def lookup(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Inner join of many ``left`` rows to the one ``right`` row of their key.

    Kept a plain shuffled join without a grouping on top, so that adaptive execution can split the
    partition of a key that holds any share of the rows.
    """
    return left.join(right, on)


def forest(edges: DataFrame) -> DataFrame:
    """Edges (a, b) reduced within each partition to a spanning forest of the same components.

    Memory is bounded: the forest is passed on whenever it holds 200,000 nodes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def out():
            pairs = [(x, root(parent, x)) for x in parent]
            pairs = [(x, r) for x, r in pairs if x != r]
            return pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in pairs], pa.int64()),
                 pa.array([r for _, r in pairs], pa.int64())], ["a", "b"])

        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                union(parent, x, y)
            if len(parent) > 200_000:
                yield out()
                parent.clear()
        if parent:
            yield out()

    return edges.select("a", "b").mapInArrow(run, "a long, b long")


def root(parent: dict[int, int], x: int) -> int:
    top = x
    while parent.setdefault(top, top) != top:
        top = parent[top]
    while parent[x] != top:
        parent[x], x = top, parent[x]
    return top


def union(parent: dict[int, int], x: int, y: int) -> None:
    x, y = root(parent, x), root(parent, y)
    if x != y:
        parent[max(x, y)] = min(x, y)


def components(edges: DataFrame, label: str = "edges") -> DataFrame:
    """(node, component): the smallest node reachable over edges (a, b), for nodes with an edge.

    Edges lead from the larger to the smaller node. A round moves every edge on to the smallest
    neighbour of its end and then ties all ends of a node to the smallest of them, until the edges
    are stars around minima. A minimum with very many edges is met only by aggregates and by a join
    that adaptive execution can split; the ends of one node are few, as tasks reduce their edges to
    forests first. Every round is written to the shared folder; the driver sees one row a round.
    """
    edges = forest(edges.filter("a != b and a is not null and b is not null"))
    edges = staged(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        label)
    while not _are_stars(edges):
        parents = edges.groupBy(F.col("a").alias("b")).agg(F.min("b").alias("parent"))
        moved = edges.join(parents, "b", "left").select("a", F.coalesce("parent", "b").alias("b"))
        lowest = F.min("b").over(Window.partitionBy("a"))
        tied = moved.withColumn("m", lowest).select(F.inline(F.array(
            F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")))))
        edges = staged(tied.filter("a != b").distinct(), label)
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = edges.select("b").distinct()
    return stars.union(centres.select("b", "b"))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour or is a centre, not both."""
    ends = edges.select(F.inline(F.array(
        F.struct(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.filter("up + down > 1").isEmpty()


#: Bits of a key filter: 16 MB, however many keys; more keys only let more rows pass.
_FILTER_BITS = 27
_PIECE = 1 << 18


def key_filter(keys: DataFrame, column: str) -> np.ndarray:
    """A Bloom filter of 64-bit keys as bytes: each task fills one, pieces are merged apart."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << _FILTER_BITS >> 3, np.uint8)
        for batch in batches:
            spots = _spots(batch.column(0).to_numpy())
            np.bitwise_or.at(bits, spots >> 3, np.left_shift(1, spots & 7).astype(np.uint8))
        parts = [(i, bits[at:at + _PIECE]) for i, at in enumerate(range(0, len(bits), _PIECE))]
        parts = [(i, zlib.compress(p.tobytes(), 1)) for i, p in parts if p.any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in parts], pa.int32()),
             pa.array([p for _, p in parts], pa.binary())], ["piece", "bits"])

    def merge(key: tuple, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.zeros(_PIECE, np.uint8)
        for part in parts:
            for packed in part["bits"]:
                bits |= np.frombuffer(zlib.decompress(packed), np.uint8)
        yield pd.DataFrame({"piece": [key[0]], "bits": [zlib.compress(bits.tobytes(), 1)]})

    filled = keys.select(column).mapInArrow(fill, "piece int, bits binary")
    merged = filled.groupBy("piece").applyInPandas(merge, "piece int, bits binary").collect()
    out = np.zeros(1 << _FILTER_BITS >> 3, np.uint8)
    for piece, packed in merged:
        out[piece * _PIECE:(piece + 1) * _PIECE] = np.frombuffer(zlib.decompress(packed), np.uint8)
    return out


def _spots(keys: np.ndarray) -> np.ndarray:
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)


def may_hold(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """False for keys that are surely not in a key filter."""
    spots = _spots(keys)
    return ((bits[spots >> 3] >> (spots & 7).astype(np.uint8)) & 1).astype(bool)
