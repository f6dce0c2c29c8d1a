"""Exact duplicates by content-defined chunk recipes.

A text is cut where its own bytes say so, each chunk gets an identifier, and texts are compared by
their ordered identifier lists ("recipes"). Long documents move once, as chunks; copies of a chunk
collapse before that shuffle. Afterwards only recipes move, under one hundredth of the text.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, documents, keep_rows, lookup, staged, text_bytes, with_row

CHUNK_LEAST, CHUNK_MOST, CHUNK_BITS = 512, 16_384, 11
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SPACES = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
_WINDOW = 1 << 20


def normalise(raw: bytes) -> bytes:
    """Every run of ASCII white space becomes one space."""
    raw = raw.translate(_SPACES)
    while b"  " in raw:
        raw = raw.replace(b"  ", b" ")
    return raw


def cuts(raw: bytes) -> list[int]:
    """Ends of the chunks: where the hash of the 8 bytes before is small, between two bounds."""
    n = len(raw)
    if n <= CHUNK_LEAST:
        return [n]
    ends, last = [], 0
    for at in range(0, n - 7, _WINDOW):
        eight = np.ndarray(min(_WINDOW, n - 7 - at), "<u8", raw, at, (1,))
        marks = np.flatnonzero((eight * _MIX) >> np.uint64(64 - CHUNK_BITS) == 0) + (at + 8)
        for mark in marks.tolist():
            while mark - last > CHUNK_MOST:
                last += CHUNK_MOST
                ends.append(last)
            if mark - last >= CHUNK_LEAST:
                ends.append(mark)
                last = mark
    while n - last > CHUNK_MOST:
        last += CHUNK_MOST
        ends.append(last)
    if last < n:
        ends.append(n)
    return ends


def _chunks(raw: bytes, size: int):
    start = 0
    for end in cuts(raw):
        part = raw[start:end]
        yield hashlib.blake2b(part, digest_size=size).digest(), part
        start = end


def recipes(docs: DataFrame, digest_bytes: int = 16) -> DataFrame:
    """(row, doc_id, text_key, text_sha256, recipe): one row per document, long texts left behind."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = text_bytes(batch.column("text"))
        data, sha, recipe = data.tobytes(), [], []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            raw = normalise(data[a:b])
            sha.append(hashlib.sha256(raw).hexdigest())
            recipe.append([digest for digest, _ in _chunks(raw, digest_bytes)])
        return pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("doc_id"), batch.column("text_key"),
             pa.array(sha, pa.string()), pa.array(recipe, pa.list_(pa.binary()))],
            ["row", "doc_id", "text_key", "text_sha256", "recipe"])

    return arrow_map(
        with_row(docs), run,
        "row long, doc_id long, text_key long, text_sha256 string, recipe array<binary>")


def chunks(docs: DataFrame, digest_bytes: int = 16) -> DataFrame:
    """(digest, bytes): the different chunks of all texts."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = text_bytes(batch.column("text"))
        data, found = data.tobytes(), {}
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            for digest, part in _chunks(normalise(data[a:b]), digest_bytes):
                found[digest, part] = None
        return pa.RecordBatch.from_arrays(
            [pa.array([d for d, _ in found], pa.binary()),
             pa.array([p for _, p in found], pa.binary())], ["digest", "bytes"])

    return arrow_map(docs.select("text"), run, "digest binary, bytes binary").distinct()


def verified_recipes(docs: DataFrame, digest_bytes: int = 16) -> DataFrame:
    """Recipes whose identifiers are verified: no two different chunks share one.

    The bytes of all chunks are compared under their digest. Should two differ, all digests are
    made longer and verified again.
    """
    while True:
        versions = chunks(docs, digest_bytes).groupBy("digest").count()
        if versions.filter("count > 1").isEmpty():
            return staged(recipes(docs, digest_bytes), "recipes")
        if digest_bytes >= 64:
            raise RuntimeError("different chunks share a 64-byte digest")
        digest_bytes = min(64, 2 * digest_bytes)


def exact_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_bytes: int = 16,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, text_key.

    Texts are equal when identical after :func:`normalise`; null counts as empty, and empty texts
    equal each other. Of equal texts the smallest doc_id stays; a null doc_id comes last, and of
    rows that repeat a doc_id exactly one stays. An empty table gives no rows.
    """
    rows = verified_recipes(documents(df, id_col, text_col), digest_bytes)
    groups = rows.groupBy("recipe").agg(
        F.count("*").alias("group_size"),
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("keep"))
    joined = lookup(rows, groups, "recipe")
    return joined.select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"), "text_sha256", "text_key")


def drop_exact_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``df`` with one row for each different text, all its columns as they are."""
    return keep_rows(df, exact_duplicates(df, id_col, text_col), id_col, text_col)
