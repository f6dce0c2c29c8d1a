"""Lexical retrieval packing: windows of documents that share rare words.

Documents are tokenised once. What exceeds whole windows, the tail of each document, goes to a shard
of lexically close tails; every shard has a BM25 inverted index, and each window starts from a seed
tail and takes the best unused neighbours until it is full. The last neighbour is cut, its rest stays
in the shard, so windows are full but for the last one of a task.
"""
from __future__ import annotations

import json
import math
import re
import sys
import zlib
from collections.abc import Callable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, slices, staged, text_bytes, text_lengths, trimmed, with_row

WINDOW = 2048
END = 1
#: Tails in one inverted index: bounds the memory of a task, not the number of tails.
SHARD_DOCS = 2048
#: Bytes of ids that one task packs, shard after shard.
TASK_BYTES = 16_000_000
#: A seed is looked up by so many of its heaviest terms, and so many of the best are tried in turn.
QUERY_TERMS = 32
TRIED = 64
_K1, _B = 1.2, 0.75
_VOCABULARY = 1 << 16
#: Chunks that a Python worker keeps, from task to task; beyond, only those of the last texts stay.
_CACHE = 200_000
#: Bytes of text whose chunks are numbered together, and of a word that is merged with the others.
_ENCODER_BYTES = 8_000_000
_LONG = 64
_NAMES = ["doc_id", "row", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write a byte as one printable character: those that are printable in
    Latin-1 as themselves, the others in order from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(0x100) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + n) for n, b in enumerate(hidden)}


class Merges:
    """Byte-pair merges of many words at once, by the ranks of a tokenizer's model: a step joins in
    every word the leftmost pair of its least rank, until no word has a pair with a rank."""

    _NONE = np.iinfo(np.int32).max

    def __init__(self, model: dict):
        vocab, letters = model["vocab"], _byte_letters()
        closing = model.get("end_of_word_suffix") or ""
        self.inner = np.array([vocab[letters[b]] for b in range(256)], np.uint32)
        self.last = np.array([vocab[letters[b] + closing] for b in range(256)], np.uint32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.made = np.array([vocab[a + b] for a, b in pairs], np.uint32)
        key = np.array([vocab[a] << 16 | vocab[b] for a, b in pairs], np.uint32)
        order = np.argsort(key, kind="stable")
        self.key, self.rank = np.append(key[order], np.uint32(0xFFFFFFFF)), np.append(
            order.astype(np.int32), np.int32(self._NONE))

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << np.uint32(16) | right
        at = np.searchsorted(self.key, key)
        return np.where(self.key[at] == key, self.rank[at], self._NONE)

    def ids(self, data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each word) of the words data[first[i]:first[i + 1]], none empty."""
        ids, last = self.inner[data], first[1:] - 1
        ids[last] = self.last[data[last]]
        rank = np.full(len(ids), self._NONE, np.int32)
        rank[:-1] = self._ranks(ids[:-1], ids[1:])
        rank[last] = self._NONE
        word, length = np.arange(len(last)), np.diff(first)
        done, sizes, words = [], [], []
        while len(word):
            start = np.cumsum(length) - length
            best = np.minimum.reduceat(rank, start)
            more = best < self._NONE
            if not more.all():
                inside = np.repeat(more, length)
                done.append(ids[~inside].astype("<u2"))
                sizes.append(length[~more])
                words.append(word[~more])
                ids, rank, word, length, best = (
                    ids[inside], rank[inside], word[more], length[more], best[more])
                start = np.cumsum(length) - length
            owner = np.repeat(np.arange(len(word)), length)
            at = np.flatnonzero(rank == best[owner])
            at = at[np.flatnonzero(np.diff(owner[at], prepend=-1))]
            ids[at] = self.made[best]
            left, right = at[at > start], at[at + 2 < start + length]
            rank[at] = self._NONE
            rank[right] = self._ranks(ids[right], ids[right + 2])
            rank[left - 1] = self._ranks(ids[left - 1], ids[left])
            stay = np.ones(len(ids), bool)
            stay[at + 1] = False
            ids, rank, length = ids[stay], rank[stay], length - 1
        none = np.empty(0, np.int64)
        size, place = np.concatenate([none, *sizes]), np.argsort(np.concatenate([none, *words]))
        flat, _ = _gathered(np.concatenate([np.empty(0, "<u2"), *done]), size, place)
        return flat, size[place]


class Encoder:
    """Ids of texts by a lower-casing word tokenizer whose words never cross white space.

    Plain Latin texts are encoded many at once: what stands between white space is numbered, and only
    the words, numbers and signs in chunks that are not known are merged, all of them together; very
    long ones by the tokenizer's model. Any text with other characters, separators or marks of special
    tokens is left to the tokenizer as a whole.
    """

    _PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|[0-9]|(?:[^\s\w]|_)+|\n")
    _LETTERS = _byte_letters()

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.merges = Merges(json.loads(self.tokenizer.to_str())["model"])
        self.known = _Known(self)

    def _plain(self, raw: np.ndarray, text: str) -> bool:
        return len(raw) == 0 or not (
            raw.max() >= 0xC9 or (raw == 0xC2).any() or ((raw >= 0x1C) & (raw <= 0x1F)).any()
            or "<|" in text)

    def learn(self, chunk: str) -> bytes:
        """Ids of a chunk that is not known yet."""
        return self.learn_all([chunk])[0]

    def learn_all(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks, each different word in them encoded once."""
        if not chunks:
            return []
        parts = pa.array(self._PARTS.findall("\n".join([*chunks, ""]))).dictionary_encode()
        words, place = parts.dictionary, parts.indices.to_numpy()
        line_end = words.index("\n").as_py()
        lengths = text_lengths(words)
        known, size = [], np.zeros(len(words), np.int64)
        short = (lengths <= _LONG) & (np.arange(len(words)) != line_end)
        order = [np.flatnonzero(short)]
        flat, size[order[0]] = self.merges.ids(*_some(words, short))
        known.append(flat)
        for n in np.flatnonzero(lengths > _LONG).tolist():
            shown = words[n].as_py().encode().decode("latin-1").translate(self._LETTERS)
            known.append(np.array([t.id for t in self.merge(shown)], "<u2"))
            size[n] = len(known[-1])
            order.append(np.array([n]))
        order = np.concatenate(order)
        spot = np.empty(len(words), np.int64)  # of the line's end, any: it has no ids
        spot[order], spot[line_end] = np.arange(len(order)), 0
        real = place != line_end
        ids, end = _gathered(np.concatenate(known), size[order], spot[place[real]])
        end = np.append(0, 2 * end)[np.cumsum(real)[~real]].tolist()
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *end[:-1]], end, strict=True)]

    def ids(self, text: str, raw: np.ndarray) -> bytes:
        """Little-endian 16-bit ids."""
        return self.many([text], raw, np.array([0, len(raw)]), b"")[0].tobytes()

    def many(
        self, texts: list[str], data: np.ndarray, offsets: np.ndarray, end: bytes,
    ) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with ``end`` behind it, and the places where texts end)."""
        bounds = zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
        plain = [self._plain(data[a:b], t) for t, (a, b) in zip(texts, bounds, strict=True)]
        split = pc.ascii_split_whitespace(pa.array(
            [t.lower() if p else "" for t, p in zip(texts, plain, strict=True)], pa.string()))
        coded = split.flatten().dictionary_encode()
        chunks = _strings(coded.dictionary)
        known = list(map(self.known.get, chunks))
        new = [c for c, i in zip(chunks, known, strict=True) if i is None]
        learnt = iter(self.learn_all(new))
        known = [next(learnt) if i is None else i for i in known]
        if len(self.known) + len(new) > _CACHE:
            self.known.clear()
        self.known.update(zip(chunks, known, strict=True))
        # Behind the chunks of a text: its ids as a whole where it is not plain, then the end.
        known.append(end)
        more, codes = [], []
        for n, (text, p) in enumerate(zip(texts, plain, strict=True)):
            if not p:
                found = self.tokenizer.encode(text, add_special_tokens=False).ids
                more.append(n)
                codes.append(len(known))
                known.append(np.array(found, "<u2").tobytes())
            more.append(n)
            codes.append(len(chunks))
        stop = split.offsets.to_numpy()[1:].astype(np.int64)
        place = np.insert(coded.indices.to_numpy(), stop[more], codes)
        inserted = np.cumsum(np.bincount(more, minlength=len(texts)))
        size = np.fromiter(map(len, known), np.int64, len(known)) // 2
        flat, after = _gathered(np.frombuffer(b"".join(known), "<u2"), size, place)
        return flat, after[stop + inserted - 1]


def _some(words: pa.Array, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return text_bytes(words.filter(pa.array(chosen)))


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def _gathered(
    flat: np.ndarray, size: np.ndarray, place: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of ``flat``, of the given sizes, in the order of ``place``; and where each ends."""
    count = size[place]
    after = np.cumsum(count)
    shift = (np.cumsum(size) - size)[place] - (after - count)
    at = np.repeat(shift.astype(np.int32), count)
    at += np.arange(len(at), dtype=np.int32)
    return flat[at], after


class _Known(dict):
    """Ids of chunks; what is asked for by itself and missing is learnt."""

    def __init__(self, encoder: Encoder):
        self.encoder = encoder

    def __missing__(self, chunk: str) -> bytes:
        ids = self[chunk] = self.encoder.learn(chunk)
        return ids


def _encoder(path: str) -> Encoder:
    """The worker's encoder of a tokenizer file: its cache outlives the task that filled it.

    Functions come to a worker anew with every task, so it is kept in a module of its own.
    """
    kept = sys.modules.setdefault("tablewarden_kept", ModuleType("tablewarden_kept"))
    encoders = kept.__dict__.setdefault("encoders", {})
    if path not in encoders:
        encoders[path] = Encoder(path)
    return encoders[path]


def tokenised(docs: DataFrame, path: str) -> DataFrame:
    """(row, doc_id, tokens): 16-bit ids with the end id, staged once for all later steps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        end = np.array([END], "<u2").tobytes()
        for batch in batches:
            for part in slices(batch, limit=_ENCODER_BYTES):
                ids, stop = encoder.many(
                    _strings(part.column("text")), *text_bytes(part.column("text")), end)
                places = np.concatenate([[0], 2 * stop]).astype(np.int32)
                tokens = pa.Array.from_buffers(
                    pa.binary(), len(stop), [None, pa.py_buffer(places), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("doc_id"), tokens],
                    ["row", "doc_id", "tokens"])

    rows = with_row(docs.select("doc_id", "text"))
    ids = rows.mapInArrow(lambda b: trimmed(run(b)), "row long, doc_id long, tokens binary")
    return staged(ids, "tokens")


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_bytes(column)
    return np.frombuffer(data.tobytes(), "<u2"), offsets // 2


def _terms(ids: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, count) of stretches of ids that stand one behind the other, in this order."""
    kind = np.uint32 if len(length) <= _VOCABULARY else np.int64  # the narrow ones sort faster
    keys = np.repeat(np.arange(len(length), dtype=kind), length) * kind(_VOCABULARY) + ids
    keys.sort()
    start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
    keys, count = keys[start].astype(np.int64), np.diff(start, append=len(keys))
    return keys // _VOCABULARY, keys % _VOCABULARY, count


def document_frequency(tokens: DataFrame) -> DataFrame:
    """(token, n): the number of documents that hold each token, of the whole corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_VOCABULARY, np.int64)
        for batch in batches:
            for part in slices(batch, "tokens"):
                ids, offsets = _ids(part.column("tokens"))
                total += np.bincount(_terms(ids, np.diff(offsets))[1], minlength=_VOCABULARY)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["token", "n"])

    counted = tokens.select("tokens").mapInArrow(run, "token long, n long")
    return counted.groupBy("token").agg(F.sum("n").alias("n"))


def bm25(tf: np.ndarray, idf: np.ndarray, length: np.ndarray, mean: float) -> np.ndarray:
    return idf * tf * (_K1 + 1) / (tf + _K1 * (1 - _B + _B * length / mean))


def _heaviest(
    ids: np.ndarray, length: np.ndarray, idf: np.ndarray, mean: float,
) -> tuple[np.ndarray, np.ndarray]:
    """The two heaviest terms of each of many tails, ties by term; 0 where there are fewer."""
    doc, term, count = _terms(ids, length)
    weight = bm25(count, idf[term], length[doc], mean)
    start = np.flatnonzero(np.diff(doc, prepend=-1))
    out = []
    for _ in range(2):
        best = np.zeros(len(length), np.int64)
        if len(doc):
            most = np.zeros(len(length))
            most[doc[start]] = np.maximum.reduceat(weight, start)
            at = np.flatnonzero((weight == most[doc]) & (weight > -np.inf))
            at = at[np.flatnonzero(np.diff(doc[at], prepend=-1))]
            best[doc[at]] = term[at]
            weight[at] = -np.inf
        out.append(best)
    return out[0], out[1]


def _tails(tokens: DataFrame, shared: Broadcast, mean: float, window: int) -> DataFrame:
    """Per document: checksums of its whole windows, its tail, and the tail's heaviest terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf = shared.value
        for batch in batches:
            for part in slices(batch, "tokens"):
                ids, offsets = _ids(part.column("tokens"))
                whole, tail = [], []
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                    full = (b - a) // window
                    whole.append([zlib.crc32(ids[a + i * window:a + (i + 1) * window]
                                             .astype("<u4").tobytes()) for i in range(full)])
                    tail.append(ids[a + full * window:b].tobytes())
                length = np.diff(offsets) % window
                first, second = _heaviest(
                    np.frombuffer(b"".join(tail), "<u2"), length, idf, mean)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("doc_id"),
                     pa.array(np.diff(offsets), pa.int64()),
                     pa.array(whole, pa.list_(pa.int64())), pa.array(tail, pa.binary()),
                     pa.array(first, pa.int32()), pa.array(second, pa.int32())],
                    ["row", "doc_id", "doc_tokens", "whole", "tail", "term1", "term2"])

    return tokens.mapInArrow(
        lambda b: trimmed(run(b)), "row long, doc_id long, doc_tokens long, whole array<long>, tail binary, term1 int,"
        " term2 int")


class Shard:
    """A BM25 inverted index over some tails."""

    def __init__(self, tails: list[np.ndarray], idf: np.ndarray, mean: float):
        length = np.array([len(t) for t in tails])
        doc = np.repeat(np.arange(len(tails)), length)
        keys, tf = np.unique(doc * _VOCABULARY + np.concatenate(tails), return_counts=True)
        doc, term = keys // _VOCABULARY, keys % _VOCABULARY
        weight = bm25(tf, idf[term], length[doc], mean)
        self.doc_start = np.searchsorted(doc, np.arange(len(tails) + 1))
        self.term, self.weight = term, weight
        order = np.argsort(term, kind="stable")
        self.posting_doc, self.posting_weight = doc[order], weight[order]
        self.terms, start = np.unique(term[order], return_index=True)
        self.posting_start = np.append(start, len(order))
        self.size = len(tails)

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused tails by falling score against the seed's heaviest terms, ties by place."""
        a, b = self.doc_start[seed], self.doc_start[seed + 1]
        heavy = np.argsort(-self.weight[a:b], kind="stable")[:QUERY_TERMS]
        scores = np.zeros(self.size)
        for at in np.searchsorted(self.terms, self.term[a:b][heavy]).tolist():
            span = slice(self.posting_start[at], self.posting_start[at + 1])
            scores[self.posting_doc[span]] += self.posting_weight[span]
        scores[~unused] = 0
        n = min(TRIED, self.size)
        best = np.sort(np.argpartition(scores, self.size - n)[-n:])
        best = best[np.argsort(-scores[best], kind="stable")]
        return best[scores[best] > 0]


class Packer:
    """Fills windows from one shard after the other; an open window is carried along."""

    def __init__(self, window: int, first_id: int, put: Callable):
        self.window, self.next_id, self.put = window, first_id, put
        self.open: list[tuple] = []
        self.filled = 0

    def place(self, piece: tuple, length: int) -> None:
        """``piece`` is (document, start in it, ids)."""
        self.open.append((*piece, self.filled))
        self.filled += length
        if self.filled == self.window:
            self.close()

    def close(self) -> None:
        for doc, start, ids, offset in self.open:
            self.put(doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()),
                     self.next_id, offset)
        self.next_id += bool(self.open)
        self.open, self.filled = [], 0

    def shard(self, docs: list[tuple], tails: list[np.ndarray], idf, mean) -> None:
        """Pack whole documents of a shard; docs[i] is (row data, start of the tail)."""
        if not tails:
            return
        index = Shard(tails, idf, mean)
        done = np.zeros(len(tails), np.int64)
        unused = np.ones(len(tails), bool)
        left = np.array([len(t) for t in tails])
        following = 0

        def take(i: int, n: int) -> None:
            doc, start = docs[i]
            at = int(done[i])
            done[i] += n
            left[i] -= n
            unused[i] = left[i] > 0
            self.place((doc, start + at, tails[i][at:at + n]), n)

        while following < len(tails):
            if not unused[following]:
                following += 1
                continue
            seed = following
            take(seed, int(min(left[seed], self.window - self.filled)))
            if not self.filled:
                continue
            ranked = index.neighbours(seed, unused).tolist()
            for i in ranked:
                if self.filled and unused[i] and left[i] <= self.window - self.filled:
                    take(i, int(left[i]))
                if not self.filled:
                    break
            if self.filled:
                cut = next((i for i in ranked if unused[i]), None)
                if cut is not None:
                    take(cut, self.window - self.filled)

    def finish(self) -> None:
        """The open rest becomes sequences whose lengths are powers of two, without padding."""
        pieces, left = self.open, self.filled
        self.open, self.filled = [], 0
        room = 0
        for doc, start, ids, _ in pieces:
            while len(ids):
                if not room:
                    room = size = 1 << (left.bit_length() - 1)
                    left -= size
                n = min(room, len(ids))
                self.open.append((doc, start, ids[:n], size - room))
                start, ids, room = start + n, ids[n:], room - n
                if not room:
                    self.close()


def pack(
    df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
    window: int = WINDOW, shard_docs: int = SHARD_DOCS,
) -> DataFrame:
    """One row per piece: doc_id, row, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every row of ``df`` is a document: its ids by the tokenizer file, then the end id; a null or
    empty text is the end id alone. ``row`` tells documents apart where doc_id is null or repeats.
    Sequences are gapless and have ``window`` ids, but for the rest of a task, which is cut into
    sequences of power-of-two lengths. An empty table gives no rows.
    """
    spark = df.sparkSession
    tokens = tokenised(documents(df, id_col, text_col), tokenizer)
    frequency = document_frequency(tokens).collect()  # at most one row per entry of the vocabulary
    n, size = tokens.agg(F.count("*"), F.sum(F.length("tokens"))).first()
    df_of = np.zeros(_VOCABULARY)
    for token, count in frequency:
        df_of[token] = count
    idf = np.log(1 + ((n or 0) - df_of + 0.5) / (df_of + 0.5))
    mean = max(1.0, min(window, (size or 0) / 2 / max(1, n or 0)))
    shared = spark.sparkContext.broadcast(idf)
    # Written, as dealing by ranges reads it twice.
    tails = staged(_tails(tokens, shared, mean, window), "tails")
    # By the size of the corpus alone: a small one is one shard, whatever the session's settings.
    parts = max(1, math.ceil((size or 0) / TASK_BYTES))
    near = tails.repartitionByRange(parts, "term1", "term2", "row")
    near = near.sortWithinPartitions("term1", "term2", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        packer = Packer(
            window, TaskContext.get().partitionId() << 40,
            lambda doc, start, length, crc, sequence, offset: out.append(
                (doc[0], doc[1], start, length, crc, doc[2], sequence, offset)))
        whole_id = TaskContext.get().partitionId() << 40 | 1 << 39  # windows of a single document
        docs: list[tuple] = []
        texts: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            types = [pa.int64()] * 8
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                _NAMES)
            out.clear()
            return batch

        for batch in batches:
            columns = [batch.column(c).to_pylist()
                       for c in ("doc_id", "row", "doc_tokens", "whole", "tail")]
            for doc_id, row, total, whole, tail in zip(*columns, strict=True):
                doc = (doc_id, row, total)
                for i, crc in enumerate(whole):
                    out.append((doc_id, row, i * window, window, crc, total, whole_id, 0))
                    whole_id += 1
                if tail:
                    docs.append((doc, len(whole) * window))
                    texts.append(np.frombuffer(tail, "<u2"))
                if len(docs) == shard_docs:
                    packer.shard(docs, texts, shared.value, mean)
                    docs, texts = [], []
            if out:
                yield flush()
        packer.shard(docs, texts, shared.value, mean)
        packer.finish()
        if out:
            yield flush()

    return near.mapInArrow(lambda b: trimmed(run(b)), ", ".join(f"{c} long" for c in _NAMES))
