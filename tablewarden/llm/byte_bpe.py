"""Byte-level BPE: distinct words are merged by Spark's higher-order functions, texts look them up.

1. Texts are split by the pattern; each batch of texts becomes one packed row: the numbers of its
   words, and its distinct words by hash range.
2. Per hash range, distinct words of the whole corpus are merged once: a fold over the word's bytes that
   joins the leftmost pair of lowest rank, with the ranks as one literal of nested maps.
3. The ids travel back to their batches, packed, and every text reads its words' ids.

Texts are split once and move once, as word numbers; a word that a third of all texts hold is merged
once and moves once per batch.
"""
from __future__ import annotations

import json
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, give_back, slices, staged_buckets, text_bytes, trimmed
from .token_counts import load_ranks

#: Text bytes of a batch, and of texts per range of word hashes.
BATCH_BYTES, RANGE_BYTES = 8_000_000, 16_000_000
#: The fold takes time with the square of a word's length; longer words are merged with a heap.
FOLD_BYTES = 128
#: Chunks of text whose words a batch keeps.
CHUNKS = 100_000
#: The literal's outer array; about one word in each place.
_PLACES = 1 << 16


class Splitter:
    """Matches of the pattern, by the standard module where plain Latin text makes both agree."""

    _LATIN = re.compile(
        r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?[0-9]+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
    _RAGGED = re.compile(r" (?:\s|\Z)")

    def __init__(self, pattern: str, latin: bool):
        self.pattern, self.latin = regex.compile(pattern), latin

    def _plain(self, raw: np.ndarray) -> bool:
        return self.latin and (len(raw) == 0 or not (
            raw.max() >= 0xC9 or (raw == 0xC2).any() or ((raw >= 0x1C) & (raw <= 0x1F)).any()))

    def words(self, text: str, raw: np.ndarray) -> list[str]:
        return (self._LATIN if self._plain(raw) else self.pattern).findall(text)

    def chunks(self, text: str, raw: np.ndarray) -> list[str] | None:
        """What stands between the spaces of a text, or None.

        A space before a character other than white space begins a match, whatever is around it. So
        where all spaces are such, the words are those of the first chunk, and of each other one with
        a space before it (:meth:`chunk_words`).
        """
        if not self._plain(raw) or self._RAGGED.search(text):
            return None
        return text.split(" ")

    def chunk_words(self, chunk: str) -> list[str]:
        return self._LATIN.findall(chunk)


#: The pattern that :class:`Splitter` knows to equal its own one on plain Latin text.
GPT2_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def _shrink(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _grow(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers compressed byte by byte: the high bytes of word numbers are mostly zero."""
    flat = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return _shrink(flat.tobytes())


def _numbers(packed: bytes) -> np.ndarray:
    flat = np.frombuffer(_grow(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(flat.T).view("<u4").ravel()


class _Numbers(dict):
    """Numbers of words in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


class _Chunks(dict):
    """The numbers of the words of chunks that have a space before them, as bytes."""

    def __init__(self, splitter: Splitter, known: _Numbers):
        self.splitter, self.known = splitter, known

    def __missing__(self, chunk: str) -> bytes:
        found = self[chunk] = self.numbers(" " + chunk)
        return found

    def numbers(self, chunk: str) -> bytes:
        known = self.known
        return b"".join([known[w].to_bytes(4, "little") for w in self.splitter.chunk_words(chunk)])


class Batch:
    """Texts as numbers of distinct words."""

    def __init__(self, splitter: Splitter):
        self.splitter = splitter
        self.known = _Numbers()
        self.chunks = _Chunks(splitter, self.known)
        self.ids: list = []
        self.texts: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id, text: str, raw: np.ndarray) -> None:
        chunks = self.splitter.chunks(text, raw)
        if chunks is None:
            words = self.splitter.words(text, raw)
            numbers = np.fromiter(map(self.known.__getitem__, words), np.uint32, len(words))
        else:
            if len(self.chunks) > CHUNKS:
                self.chunks.clear()
            first = self.chunks.numbers(chunks[0])
            numbers = np.frombuffer(
                first + b"".join(map(self.chunks.__getitem__, chunks[1:])), "<u4")
        self.ids.append(doc_id)
        self.texts.append(numbers)
        self.size += len(raw)

    def row(self, number: int, ranges: int) -> dict:
        words = [w.encode() for w in self.known]
        where = np.array([zlib.crc32(w) % ranges for w in words], np.int64)
        order = np.argsort(where, kind="stable")
        renumbered = np.empty(len(words), np.uint32)
        renumbered[order] = np.arange(len(words), dtype=np.uint32)
        found, start = np.unique(where[order], return_index=True)
        ends = np.append(start[1:], len(words))
        blocks = []
        for place, a, b in zip(found.tolist(), start.tolist(), ends.tolist(), strict=True):
            own = [words[i] for i in order[a:b].tolist()]
            blocks.append({"range": place, "lengths": _planes(np.array([len(w) for w in own])),
                           "words": _shrink(b"".join(own))})
        numbers = np.concatenate([np.empty(0, np.uint32), *self.texts])
        return {"batch": number, "doc_ids": self.ids, "sizes": [len(t) for t in self.texts],
                "numbers": _planes(renumbered[numbers] if len(words) else numbers),
                "blocks": blocks}


_BLOCKS = "array<struct<range:long,lengths:binary,words:binary>>"
_BATCH_TYPE = pa.schema([
    ("batch", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
    ("numbers", pa.binary()),
    ("blocks", pa.list_(pa.struct([("range", pa.int64()), ("lengths", pa.binary()),
                                   ("words", pa.binary())])))])


def batches_of(docs: DataFrame, pattern: str, ranges: int, size: int = BATCH_BYTES) -> DataFrame:
    """(batch, doc_ids, sizes, numbers, blocks): packed texts, one row per batch."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(pattern, pattern == GPT2_PATTERN)
        number, own = TaskContext.get().partitionId() << 32, Batch(splitter)
        for batch in parts:
            for part in slices(batch):
                data, offsets = text_bytes(part.column("text"))
                texts = part.column("text").to_pylist()
                for i, doc_id in enumerate(part.column("doc_id").to_pylist()):
                    own.add(doc_id, texts[i], data[offsets[i]:offsets[i + 1]])
                    if own.size >= size:
                        yield pa.RecordBatch.from_pylist([own.row(number, ranges)], _BATCH_TYPE)
                        number, own = number + 1, Batch(splitter)
        if own.ids:
            yield pa.RecordBatch.from_pylist([own.row(number, ranges)], _BATCH_TYPE)

    return docs.select("doc_id", "text").mapInArrow(
        lambda parts: trimmed(run(parts)), "batch long, doc_ids array<long>, sizes array<long>, numbers binary,"
        f" blocks {_BLOCKS}")


def rank_literal(ranks: dict[bytes, int]) -> Column:
    """The ranks as a literal: an array of maps, a word in the map at the place of its CRC-32.

    Words are strings of one character per byte. The literal is written once in an expression and
    folded to a constant before tasks start. Its places are a power of two.
    """
    places: list = [None] * _PLACES
    for word, rank in ranks.items():
        text = word.decode("latin-1")
        place = zlib.crc32(text.encode()) % _PLACES
        places[place] = (places[place] or {}) | {text: rank}
    return F.from_json(F.lit(json.dumps(places)), "array<map<string,int>>")


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def single_literal(ranks: dict[bytes, int]) -> Column:
    """The ranks of the 256 bytes as a literal."""
    return F.from_json(F.lit(json.dumps([ranks.get(bytes([b])) for b in range(256)])), "array<int>")


#: A piece of a word as a long: the rank of its pair with the next piece, its start, its end, its id.
_RANK, _START, _END = 40, 32, 24
_NO_RANK = 1 << 62
_BYTE = 0xFF


def merge_words(word: Column, ranks: Column, singles: Column) -> Column:
    """Ids of a word (one character per byte): ranked merges folded over its bytes.

    A word in the vocabulary is its own id. Else the state is the array of the word's pieces as longs,
    the rank of their pair in front: the least of them is the leftmost pair of the lowest rank. Each
    step joins it, its rank is the new piece's id, and looks up the two new pairs.
    """

    def wide(value: int) -> Column:
        return F.lit(value).cast("long")

    def start_of(piece: Column) -> Column:
        return F.shiftright(piece, _START).bitwiseAND(wide(_BYTE)).cast("int")

    def end_of(piece: Column) -> Column:
        return F.shiftright(piece, _END).bitwiseAND(wide(_BYTE)).cast("int")

    def ranked(rank: Column) -> Column:
        return F.coalesce(F.shiftleft(rank.cast("long"), _RANK), wide(_NO_RANK))

    def ids(known: Column) -> Column:
        size = F.char_length(word)

        def rank(start: Column, end: Column) -> Column:
            key = F.substring(word, start + 1, end - start)
            place = F.crc32(key.cast("binary")).bitwiseAND(wide(_PLACES - 1)).cast("int")
            return F.element_at(F.get(known, place), key)

        def first(i: Column) -> Column:
            pair = F.when(i < size - 1, rank(i, i + 2))
            byte = F.ascii(F.substring(word, i + 1, F.lit(1)))
            return (ranked(pair).bitwiseOR(F.shiftleft(i.cast("long"), _START))
                    .bitwiseOR(F.shiftleft((i + 1).cast("long"), _END))
                    .bitwiseOR(F.get(singles, byte).cast("long")))

        def joined(state: Column, least: Column) -> Column:
            def at(p: Column) -> Column:
                before, right, behind = F.get(state, p - 2), F.get(state, p), F.get(state, p + 1)
                new = (ranked(rank(start_of(least), end_of(behind)))
                       .bitwiseOR(least.bitwiseAND(wide(_BYTE << _START)))
                       .bitwiseOR(right.bitwiseAND(wide(_BYTE << _END)))
                       .bitwiseOR(F.shiftright(least, _RANK)))
                changed = ranked(rank(start_of(before), end_of(right))).bitwiseOR(
                    before.bitwiseAND(wide((1 << _RANK) - 1)))
                rest = F.slice(state, p + 2, size)
                return F.flatten(F.when(p == 1, F.array(F.array(new), rest)).otherwise(
                    F.array(F.slice(state, F.lit(1), p - 2), F.array(changed, new), rest)))

            return _let(F.array_position(state, least).cast("int"), at)

        def step(state: Column, _: Column) -> Column:
            return _let(F.array_min(state), lambda least: F.when(
                least >= wide(_NO_RANK), state).otherwise(joined(state, least)))

        start = F.transform(F.sequence(F.lit(0), size - 1), first)
        merged = F.aggregate(
            F.sequence(F.lit(1), size), start, step,
            lambda state: F.transform(state, lambda piece: piece.bitwiseAND(
                wide((1 << _END) - 1)).cast("int")))
        return _let(rank(F.lit(0), size), lambda whole: F.when(
            whole.isNotNull(), F.array(whole)).otherwise(merged))

    return _let(ranks, ids)


def _gather(start: np.ndarray, size: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """The stretches flat[start[i]:start[i] + size[i]] one behind the other."""
    shift = np.repeat(start - (np.cumsum(size) - size), size)
    return flat[np.arange(len(shift)) + shift]


def word_ids(batches: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """(batch, range, sizes, ids): the ids of each batch's words, in the order of its blocks."""
    whole = batches.sparkSession.sparkContext.broadcast(ranks)  # the vocabulary, nothing of the data

    def distinct(table: pa.Table) -> pa.Table:
        give_back()  # what the range before left
        known: dict[bytes, int] = {}
        refs = []
        for lengths, words in zip(table.column("lengths").to_pylist(),
                                  table.column("words").to_pylist(), strict=True):
            ends = np.cumsum(_numbers(lengths).astype(np.int64)).tolist()
            data, at, own = _grow(words), 0, []
            for end in ends:
                own.append(known.setdefault(data[at:end], len(known)))
                at = end
            refs.append(_planes(np.array(own, np.uint32)))
        long = [w for w in known if len(w) > FOLD_BYTES]
        merged = {}
        if long:
            encoding = tiktoken.Encoding(
                "long", pat_str=GPT2_PATTERN, mergeable_ranks=whole.value, special_tokens={})
            merged = {w: encoding._encode_single_piece(w) for w in long}
        n, m = len(known), len(refs)
        return pa.table({
            "batch": pa.array([None] * n + table.column("batch").to_pylist(), pa.int64()),
            "range": pa.array([table.column("range")[0].as_py()] * (n + m), pa.int64()),
            "word": pa.array([None if w in merged else w.decode("latin-1") for w in known]
                             + [None] * m, pa.string()),
            "heap_ids": pa.array([merged.get(w) for w in known] + [None] * m,
                                 pa.list_(pa.int32())),
            "refs": pa.array([None] * n + refs, pa.binary())})

    blocks = batches.select("batch", F.inline("blocks"))
    rows = blocks.groupBy("range").applyInArrow(
        distinct, "batch long, range long, word string, heap_ids array<int>, refs binary")
    # A range's words come first, then its blocks, in one task and in this order.
    ids = F.when(F.col("word").isNotNull(), merge_words(
        F.col("word"), rank_literal(ranks), single_literal(ranks)))
    rows = rows.select("batch", "range", F.coalesce("heap_ids", ids).alias("ids"), "refs")

    def answer(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: list[tuple[np.ndarray, np.ndarray]] = []
        start = size = flat = None
        for part in parts:
            batch = part.column("batch")
            is_word = batch.is_null().to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.diff(is_word.astype(np.int8))) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(is_word)], strict=True):
                some = part.slice(a, b - a)
                if a == b:
                    continue
                if is_word[a]:
                    if start is not None:  # the next range begins
                        words, start = [], None
                    lists = some.column("ids")
                    words.append((lists.value_lengths().to_numpy(zero_copy_only=False),
                                  lists.flatten().to_numpy(zero_copy_only=False)))
                    continue
                if start is None:
                    size = np.concatenate([x for x, _ in words]).astype(np.int64)
                    flat = np.concatenate([x for _, x in words]).astype("<u4")
                    start = np.cumsum(size) - size
                sizes, ids = [], []
                for refs in some.column("refs").to_pylist():
                    own = _numbers(refs)
                    sizes.append(_planes(size[own]))
                    ids.append(_planes(_gather(start[own], size[own], flat)))
                yield pa.RecordBatch.from_arrays(
                    [some.column("batch"), some.column("range"), pa.array(sizes, pa.binary()),
                     pa.array(ids, pa.binary())], ["batch", "range", "sizes", "ids"])

    return rows.mapInArrow(lambda parts: trimmed(answer(parts)), "batch long, range long, sizes binary, ids binary")


def encode(
    df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
    batch_bytes: int = BATCH_BYTES, decoded: bool = False,
) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids (little-endian unsigned 32-bit numbers), and with
    ``decoded`` also the bytes that :func:`decode` gives for them, from the same task.

    Ids are those of the rank file at ``path``, each match of ``pattern`` merged separately, without
    special tokens. Null texts count as empty and have no ids; every row is a document, also with a
    null or repeated doc_id; an empty table gives no rows.
    """
    spark = df.sparkSession
    docs = documents(df, id_col, text_col)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(parts, math.ceil(size / RANGE_BYTES))
    ranks = load_ranks(path)
    # Bucketed, so that the texts meet their ids without moving again.
    batches = staged_buckets(
        batches_of(docs, pattern, ranges, batch_bytes), "batches", "batch", parts)
    answers = word_ids(batches, ranks)
    pieces = spark.sparkContext.broadcast(_pieces(ranks)) if decoded else None

    def look_up(texts: pa.Table, words: pa.Table) -> pa.Table:
        give_back()  # what the batch before left
        order = np.argsort(words.column("range").to_numpy())
        sizes, ids = (words.column(c).to_pylist() for c in ("sizes", "ids"))
        none = np.empty(0, np.uint32)
        size = np.concatenate([none, *(_numbers(sizes[i]) for i in order)]).astype(np.int64)
        flat = np.concatenate([none, *(_numbers(ids[i]) for i in order)]).astype("<u4")
        start = np.cumsum(size) - size
        doc_ids, counts, out, plain = [], [], [], []
        for row in texts.select(["doc_ids", "sizes", "numbers"]).to_pylist():
            numbers, at = _numbers(row["numbers"]), 0
            for doc_id, n in zip(row["doc_ids"], row["sizes"], strict=True):
                own = numbers[at:at + n]
                at += n
                found = _gather(start[own], size[own], flat)
                doc_ids.append(doc_id)
                counts.append(len(found))
                out.append(found.tobytes())
                if pieces:
                    plain.append(_join(pieces.value, found))
        columns = {"doc_id": pa.array(doc_ids, pa.int64()),
                   "n_tokens": pa.array(counts, pa.int64()), "ids": pa.array(out, pa.binary())}
        return pa.table(columns | ({"decoded": pa.array(plain, pa.binary())} if pieces else {}))

    texts = batches.select("batch", "doc_ids", "sizes", "numbers")
    return texts.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        look_up, "doc_id long, n_tokens long, ids binary" + ", decoded binary" * decoded)


def _pieces(ranks: dict[bytes, int]) -> list[bytes]:
    pieces = [b""] * (max(ranks.values()) + 1)
    for word, rank in ranks.items():
        pieces[rank] = word
    return pieces


def _join(pieces: list[bytes], ids: np.ndarray) -> bytes:
    return b"".join(map(pieces.__getitem__, ids.tolist()))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (doc_id, n_tokens, ids) with ``decoded``: the pieces of its ids, concatenated."""
    shared = encoded.sparkSession.sparkContext.broadcast(_pieces(load_ranks(path)))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for part in slices(batch, "ids"):
                data, offsets = text_bytes(part.column("ids"))
                numbers = np.frombuffer(data.tobytes(), "<u4")
                out = [_join(shared.value, numbers[a // 4:b // 4]) for a, b in zip(
                    offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("doc_id", "n_tokens", "ids")),
                     pa.array(out, pa.binary())], ["doc_id", "n_tokens", "ids", "decoded"])

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(
        lambda parts: trimmed(run(parts)), "doc_id long, n_tokens long, ids binary, decoded binary")
