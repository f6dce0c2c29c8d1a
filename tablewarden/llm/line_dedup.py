"""Line deduplication: two Bloom filters pick suspects, only suspects are counted exactly.

Filter one holds the hashes of lines seen in a document, filter two those seen in a second one. Each
task fills its own pair; the pairs are merged bit by bit, and only lines of the merged second filter
go on to an exact count by their whole text. A filter has a fixed number of bits, so what is
broadcast does not grow with the data: with too many lines it fills up and lets more lines through
to the exact count, and the result stays the same.
"""
from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, lookup, slices, staged, text_bytes, with_row

#: 2 ** 27 bits are 16 MB a filter: few false suspects up to some ten million different lines.
FILTER_BITS = 27
_HASHES = 2
#: The filters travel and are merged in pieces of so many bytes.
_PIECE = 1 << 18
#: Lines to drop are broadcast as 32-byte digests up to so many of them, joined beyond.
BROADCAST_KEYS = 500_000
_WHITE = b" \t\n\x0b\x0c\r"
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def line_key(line: bytes) -> bytes:
    """A line without ASCII white space at both ends, A-Z in lower case."""
    return line.strip(_WHITE).translate(_LOWER)


def _code_points(key: bytes) -> int:
    return len(key) - sum(0x80 <= b < 0xC0 for b in key)


def digest(key: bytes) -> bytes:
    """SHA-256, which Spark's ``sha2`` gives as well."""
    return hashlib.sha256(key).digest()


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (least <= 1 or _code_points(key) >= least)


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    data, offsets = text_bytes(batch.column("text"))
    data = data.tobytes()
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield data[a:b]


def _keys(text: bytes, least: int) -> set[bytes]:
    """The different keys of a text; stripping and lower-casing once per different line."""
    return {k for k in map(line_key, set(text.split(b"\n"))) if _long_enough(k, least)}


def _positions(digests: list[bytes], bits: int) -> np.ndarray:
    """Bit positions, one row per hash function."""
    words = np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 4).T
    return (words[:_HASHES] & np.uint64((1 << bits) - 1)).astype(np.int64)


def bloom_pair(docs: DataFrame, least: int, bits: int = FILTER_BITS) -> DataFrame:
    """(piece, once, twice): the merged filters of all documents, piece by piece."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = np.zeros(1 << bits >> 3, np.uint8)
        twice = np.zeros(1 << bits >> 3, np.uint8)
        for batch in batches:
            for part in slices(batch):
                digests = [digest(k) for text in _texts(part) for k in _keys(text, least)]
                if digests:
                    _add(once, twice, _positions(digests, bits))
        pieces = range(0, len(once), _PIECE)
        packed = [(i, a[p:p + _PIECE]) for a in (once, twice) for i, p in enumerate(pieces)]
        n = len(packed) // 2
        rows = [(i, a, b) for (i, a), (_, b) in zip(packed[:n], packed[n:], strict=True)
                if a.any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _, _ in rows], pa.int32()),
             pa.array([zlib.compress(a.tobytes(), 1) for _, a, _ in rows], pa.binary()),
             pa.array([zlib.compress(b.tobytes(), 1) for _, _, b in rows], pa.binary())],
            ["piece", "once", "twice"])

    def merge(key: tuple, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        once = twice = None
        for part in parts:
            for a, b in zip(part["once"], part["twice"], strict=True):
                a = np.frombuffer(zlib.decompress(a), np.uint8)
                b = np.frombuffer(zlib.decompress(b), np.uint8)
                if once is None:
                    once, twice = a.copy(), b.copy()
                else:
                    twice |= b | (once & a)
                    once |= a
        yield pd.DataFrame({"piece": [key[0]], "twice": [zlib.compress(twice.tobytes(), 1)]})

    filled = docs.select("text").mapInArrow(fill, "piece int, once binary, twice binary")
    return filled.groupBy("piece").applyInPandas(merge, "piece int, twice binary")


def _add(once: np.ndarray, twice: np.ndarray, positions: np.ndarray) -> None:
    """Set the bits of the given hashes; a bit that is set again goes to the second filter."""
    for row in positions:
        spots, counts = np.unique(row, return_counts=True)
        byte, bit = spots >> 3, np.left_shift(1, spots & 7).astype(np.uint8)
        again = (once[byte] & bit).astype(bool) | (counts > 1)
        np.bitwise_or.at(twice, byte[again], bit[again])
        np.bitwise_or.at(once, byte, bit)


def _suspected(twice: np.ndarray, digests: list[bytes], bits: int) -> np.ndarray:
    spots = _positions(digests, bits)
    return ((twice[spots >> 3] >> (spots & 7).astype(np.uint8)) & 1).all(axis=0)


def repeated_lines(docs: DataFrame, least: int, bits: int = FILTER_BITS) -> DataFrame:
    """(key, n_docs, first_doc): lines found in two documents or more, counted by their whole text.

    Each task counts its suspects before they move, so a line that stands in a third of all
    documents moves as one row per task.
    """
    spark = docs.sparkSession
    twice = np.zeros(1 << bits >> 3, np.uint8)
    for piece, data in bloom_pair(docs, least, bits).collect():
        part = np.frombuffer(zlib.decompress(data), np.uint8)
        twice[piece * _PIECE:piece * _PIECE + len(part)] = part
    shared = spark.sparkContext.broadcast(twice)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, list] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([k.decode() for k in seen], pa.string()),
                 pa.array([n for n, _ in seen.values()], pa.int64()),
                 pa.array([d for _, d in seen.values()], pa.int64())],
                ["key", "n_docs", "first_doc"])

        held = 0
        for batch in batches:
            for part in slices(batch):
                ids = part.column("doc_id").to_pylist()
                for doc, text in zip(ids, _texts(part), strict=True):
                    keys = list(_keys(text, least))
                    if not keys:
                        continue
                    hit = _suspected(shared.value, [digest(k) for k in keys], bits)
                    for key in (k for k, h in zip(keys, hit.tolist(), strict=True) if h):
                        if key in seen:
                            entry = seen[key]
                            entry[0] += 1
                            if doc is not None and (entry[1] is None or doc < entry[1]):
                                entry[1] = doc
                        else:
                            seen[key] = [1, doc]
                            held += len(key) + 200
                if held > 64_000_000:
                    yield out()
                    seen.clear()
                    held = 0
        if seen:
            yield out()

    counted = docs.select("doc_id", "text").mapInArrow(
        count, "key string, n_docs long, first_doc long")
    return (
        counted.groupBy("key")
        .agg(F.sum("n_docs").alias("n_docs"), F.min("first_doc").alias("first_doc"))
        .filter("n_docs > 1"))


def drop_repeated_lines(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10,
    min_chars: int = 1, keep_first: bool = False, bits: int = FILTER_BITS,
    broadcast_keys: int = BROADCAST_KEYS,
) -> DataFrame:
    """One row per document: doc_id, text (what stays), n_lines (before), n_dropped.

    Texts are split at \\n; null or empty is one empty line. Lines whose key (see :func:`line_key`)
    has at least ``min_chars`` code points and stands in at least ``min_docs`` rows lose all their
    places, with ``keep_first`` all but the first one in the row with the smallest doc_id. Every
    row counts as a document, also with a null or repeated doc_id; rows with a null doc_id are
    never first. An empty table gives no rows.
    """
    docs = documents(df, id_col, text_col)
    bad = staged(
        repeated_lines(docs, min_chars, bits).filter(F.col("n_docs") >= min_docs)
        .select(F.unhex(F.sha2("key", 256)).alias("mark"), "n_docs", "first_doc"), "lines")
    n = bad.count()
    if n <= broadcast_keys:
        found = bad.select("mark", "first_doc").collect()
        shared = docs.sparkSession.sparkContext.broadcast(
            {bytes(mark): first for mark, first in found})
        return docs.mapInArrow(
            lambda batches: _cut(batches, keep_first, lambda _: shared.value), _CUT)
    return _by_join(docs, bad, min_chars, keep_first)


_CUT = "doc_id long, text string, n_lines long, n_dropped long"


def _cut(batches, keep_first: bool, bad_of) -> Iterator[pa.RecordBatch]:
    """Texts without their bad lines; ``bad_of(i)`` maps digests to first documents for row i."""
    for batch in batches:
        for part in slices(batch):
            out, totals, drops = [], [], []
            ids = part.column("doc_id").to_pylist()
            extra = part.column("bad").to_pylist() if "bad" in part.schema.names else None
            for i, (doc, text) in enumerate(zip(ids, _texts(part), strict=True)):
                bad = bad_of(extra[i] if extra else None)
                lines, kept, used = text.split(b"\n"), [], set()
                for line in lines:
                    key = line_key(line)
                    mark = digest(key)
                    if mark in bad:
                        first = bad[mark]
                        if not (keep_first and doc is not None and doc == first
                                and mark not in used):
                            continue
                        used.add(mark)
                    kept.append(line)
                out.append(b"\n".join(kept).decode())
                totals.append(len(lines))
                drops.append(len(lines) - len(kept))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(out, pa.string()), pa.array(totals, pa.int64()),
                 pa.array(drops, pa.int64())], ["doc_id", "text", "n_lines", "n_dropped"])


def _by_join(docs: DataFrame, bad: DataFrame, least: int, keep_first: bool) -> DataFrame:
    """The same when the bad lines are too many for a broadcast: each row is joined to its own."""
    rows = staged(with_row(docs), "rows")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                ids = part.column("row").to_pylist()
                found = [(r, digest(k))
                         for r, text in zip(ids, _texts(part), strict=True)
                         for k in _keys(text, least)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r for r, _ in found], pa.int64()),
                     pa.array([m for _, m in found], pa.binary())], ["row", "mark"])

    places = staged(rows.select("row", "text").mapInArrow(keys, "row long, mark binary"), "places")
    own = lookup(places, bad, "mark").groupBy("row").agg(
        F.collect_list(F.struct("mark", "first_doc")).alias("bad"))
    joined = rows.join(own, "row", "left").select(
        "doc_id", "text",
        F.coalesce("bad", F.array().cast("array<struct<mark:binary,first_doc:bigint>>")).alias("bad"))
    return joined.mapInArrow(
        lambda batches: _cut(
            batches, keep_first,
            lambda bad: {x["mark"]: x["first_doc"] for x in bad}), _CUT)
