"""Quality classifier: nearest labelled neighbours in a latent semantic space vote.

Terms are words and character trigrams, hashed into a fixed number of columns, and beside them pairs
of neighbouring character classes and repeated words. Truncated SVDs of both kinds over a bounded
sample of labelled documents give the latent space; its vectors are broadcast, every document is
projected and compared with all of them in blocks of exact cosine products, and the nearest ones
vote with their similarity as weight. Scoring is one pass over the texts without a shuffle.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, give_back, hash64, slices, text_bytes
from .words import mix, word_hashes

#: Labelled rows that the space is fitted on, at most, per label: the lowest hashes of all of them.
SAMPLE_PER_LABEL = 2_000
LATENT = 48
NEIGHBOURS = 25
SHARPNESS = 8
THRESHOLD = 0.3

_CLASSES = 32
_WINDOW = 1 << 22
TERMS = _CLASSES * _CLASSES + 2
#: Columns that words and character trigrams are hashed into.
WORD_COLUMNS, GRAM_COLUMNS = 1 << 14, 1 << 13
LEXICAL = WORD_COLUMNS + GRAM_COLUMNS
#: Lengths of the lexical part of a latent vector to choose from; the shape terms' part has length 1.
LEXICAL_WEIGHTS = (0.125, 0.25, 0.5, 1.0, 2.0)


def _class_table() -> np.ndarray:
    """Class of each byte: letters, digits, white space, and one class per frequent sign."""
    table = np.full(256, 6, np.uint8)
    table[128:] = 0
    for byte in range(256):
        char = chr(byte)
        if "a" <= char <= "z":
            table[byte] = 0
        elif "A" <= char <= "Z":
            table[byte] = 1
        elif "0" <= char <= "9":
            table[byte] = 2
        elif char == " ":
            table[byte] = 3
        elif char in "\n\r":
            table[byte] = 4
        elif byte < 32:
            table[byte] = 5
    for n, char in enumerate(".,!?|#$%&*-'\"()/:;<>=_@+{"):
        table[ord(char)] = 7 + n
    return table


_TABLE = _class_table()


def term_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Term counts of the texts data[offsets[i]:offsets[i + 1]], one row each, TERMS columns."""
    n = len(offsets) - 1
    if n == 1 and len(data) > _WINDOW:  # a very long text in bounded memory
        parts = [data[max(0, at - 1):at + _WINDOW] for at in range(0, len(data), _WINDOW)]
        return sum(term_counts(part, np.array([0, len(part)])) for part in parts)
    counts = np.zeros((n, TERMS), np.float32)
    if len(data) == 0:
        return counts
    classes = _TABLE[data].astype(np.int32)
    pairs = classes[:-1] * _CLASSES + classes[1:]
    text = np.repeat(np.arange(n, dtype=np.int32), np.diff(offsets))
    inside = text[:-1] == text[1:]
    cell = text[:-1][inside].astype(np.int64) * (_CLASSES * _CLASSES) + pairs[inside]
    counts[:, :-2] = np.bincount(cell, minlength=n * _CLASSES * _CLASSES).reshape(n, -1)
    hashes, start = word_hashes(data, offsets)
    owner = np.searchsorted(offsets, start, side="right") - 1
    again = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    counts[:, -2] = np.bincount(owner[1:][again], minlength=n)
    counts[:, -1] = np.bincount(owner, minlength=n)
    return counts


def _weighted(counts: np.ndarray) -> np.ndarray:
    """Square roots of the shares of terms, so that text length does not matter."""
    pairs = counts[:, :-2].sum(axis=1, keepdims=True)
    words = counts[:, -1:]
    out = np.empty_like(counts)
    out[:, :-2] = np.sqrt(counts[:, :-2] / np.maximum(pairs, 1))
    out[:, -2:] = np.sqrt(counts[:, -2:] / np.maximum(words, 1))
    out[:, -1] *= 0.5
    return out


def _letters() -> np.ndarray:
    """A-Z in lower case; all that is no letter, digit or part of a longer character is a space."""
    table = np.full(256, 32, np.uint8)
    for byte in range(128):
        if chr(byte).isalnum():
            table[byte] = ord(chr(byte).lower())
    table[128:] = np.arange(128, 256)
    return table


_LETTERS = _letters()


def lexical_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, column, weight): text i has the terms first[i]:first[i + 1], by column.

    Weights are square roots of the shares of a text's words, and of its trigrams.
    """
    n = len(offsets) - 1
    if n == 1 and len(data) > _WINDOW:  # a very long text in bounded memory; words end at a cut
        cells = sum(_lexical_cells(part, np.array([0, len(part)]))
                    for part in (data[max(0, at - 2):at + _WINDOW]
                                 for at in range(0, len(data), _WINDOW)))
        at = np.flatnonzero(cells)
        found, count = at, cells[at]
    else:
        found, count = np.unique(_lexical_places(data, offsets), return_counts=True)
    owner, column = np.divmod(found, LEXICAL)
    part = 2 * owner + (column >= WORD_COLUMNS)
    total = np.bincount(part, count, minlength=2 * n)
    first = np.searchsorted(owner, np.arange(n + 1))
    return first, column, np.sqrt(count / total[part]).astype(np.float16)


def _lexical_cells(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.bincount(_lexical_places(data, offsets), minlength=LEXICAL)


def _lexical_places(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """text * LEXICAL + column of every word and every trigram."""
    letters = _LETTERS[data]
    hashes, start = word_hashes(letters, offsets)
    owner = np.searchsorted(offsets, start, side="right") - 1
    words = owner * LEXICAL + (hashes % np.uint64(WORD_COLUMNS)).astype(np.int64)
    if len(data) < 3:
        return words
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    wide = letters.astype(np.uint32)
    gram = wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]
    blank = (letters[:-2] == 32) & (letters[1:-1] == 32) | (letters[1:-1] == 32) & (letters[2:] == 32)
    inside = (text[:-2] == text[2:]) & ~blank
    columns = (mix(gram[inside].astype(np.uint64)) % np.uint64(GRAM_COLUMNS)).astype(np.int64)
    return np.concatenate([words, text[:-2][inside] * LEXICAL + WORD_COLUMNS + columns])


def _times(
    first, column, weight, right: np.ndarray, block: int = 1 << 18, held: int = 1 << 14,
) -> np.ndarray:
    """Sparse rows times a matrix, of a block's rows as many at once as hold some ``held`` terms."""
    out = np.zeros((len(first) - 1, right.shape[1]), np.float32)
    owner = np.repeat(np.arange(len(out), dtype=np.int32), np.diff(first))
    for at in range(0, len(column), block):
        rows, begin = np.unique(owner[at:at + block], return_index=True)
        begin = np.append(begin, len(owner[at:at + block]))
        i = 0
        while i < len(rows):
            j = max(i + 1, int(np.searchsorted(begin, begin[i] + held, side="right")) - 1)
            some = slice(at + begin[i], at + begin[j])
            out[rows[i:j]] += np.add.reduceat(
                right[column[some]] * weight[some, None].astype(np.float32),
                begin[i:j] - begin[i], axis=0)
            i = j
    return out


def _transposed(first, column, weight, n_columns: int):
    order = np.argsort(column, kind="stable").astype(np.int32)
    owner = np.repeat(np.arange(len(first) - 1, dtype=np.int32), np.diff(first))
    return np.searchsorted(column[order], np.arange(n_columns + 1)), owner[order], weight[order]


def _unit(latent: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(latent, axis=1, keepdims=True)
    return np.divide(latent, norm, out=np.zeros_like(latent), where=norm > 1e-9)


@dataclass
class Terms:
    """Terms of some texts: dense counts of shape terms, sparse weights of lexical terms."""

    counts: np.ndarray
    first: np.ndarray
    column: np.ndarray
    weight: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray) -> Terms:
        return cls(term_counts(data, offsets), *lexical_terms(data, offsets))


@dataclass
class Space:
    """The latent space and its labelled vectors; some 7 MB at most, whatever the corpus."""

    weights: np.ndarray
    axes: np.ndarray
    word_axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    lexical: float = 1.0

    def parts(self, terms: Terms) -> tuple[np.ndarray, np.ndarray]:
        shape = _unit((_weighted(terms.counts) * self.weights) @ self.axes)
        return shape, _unit(_times(terms.first, terms.column, terms.weight, self.word_axes))

    def project(self, terms: Terms) -> np.ndarray:
        return self.joined(*self.parts(terms))

    def joined(self, shape: np.ndarray, words: np.ndarray) -> np.ndarray:
        return _unit(np.concatenate([shape, self.lexical * words], axis=1))

    def choose(self, terms: Terms) -> None:
        """Labelled vectors with the lexical length whose votes of the others fit the labels best."""
        best, parts = np.inf, self.parts(terms)
        for lexical in LEXICAL_WEIGHTS:
            trial = Space(**(vars(self) | {"lexical": lexical}))
            trial.vectors = trial.joined(*parts)
            error = float(np.mean((trial.votes(trial.vectors, alone=True) - self.labels) ** 2))
            if error < best:
                best, self.lexical, self.vectors = error, lexical, trial.vectors

    def scores(self, terms: Terms) -> np.ndarray:
        return self.votes(self.project(terms))

    def votes(self, latent: np.ndarray, alone: bool = False, block: int = 512) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest labelled vectors; ``alone``: the
        vectors are the labelled ones, and none votes for itself."""
        n, k = len(latent), min(NEIGHBOURS, len(self.labels))
        if k == 0:
            return np.full(n, 0.5)
        prior = float(self.labels.mean())
        out = np.empty(n)
        for at in range(0, n, block):
            cosine = latent[at:at + block] @ self.vectors.T
            if alone:
                cosine[np.arange(len(cosine)), np.arange(at, at + len(cosine))] = -1
            near = np.argpartition(cosine, len(self.labels) - k, axis=1)[:, -k:]
            weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(float)
            weight **= SHARPNESS
            total = weight.sum(axis=1)
            votes = (weight * self.labels[near]).sum(axis=1)
            out[at:at + block] = np.divide(
                votes, total, out=np.full(len(total), prior), where=total > 1e-12)
        return np.clip(out, 0, 1)


def _word_axes(terms: Terms, latent: int) -> np.ndarray:
    """Axes of the lexical terms, times their inverse document frequency; a randomized SVD."""
    first, column, weight = terms.first, terms.column, terms.weight
    n = len(first) - 1
    seen = np.bincount(column, minlength=LEXICAL)
    idf = (np.log((1 + n) / (1 + seen)) + 1).astype(np.float32)[:, None]
    back = _transposed(first, column, weight, LEXICAL)
    k = min(latent, n)
    basis = np.random.default_rng(0).standard_normal((LEXICAL, min(k + 12, n))).astype(np.float32)
    for _ in range(4):
        rows, _ = np.linalg.qr(_times(first, column, weight, idf * basis))
        basis = idf * _times(*back, rows)
        basis, _ = np.linalg.qr(basis)
    _, _, turn = np.linalg.svd(_times(first, column, weight, idf * basis), full_matrices=False)
    return (idf * (basis @ turn[:k].T)).astype(np.float32)


def fit_space(terms: Terms, labels: np.ndarray, latent: int = LATENT) -> Space:
    """Latent semantic analysis of both kinds of terms: inverse document frequency, then SVD."""
    counts = terms.counts
    if len(counts) == 0:
        return Space(np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32),
                     np.zeros((LEXICAL, 1), np.float32), np.zeros((0, 2), np.float32), np.zeros(0))
    seen = (counts > 0).sum(axis=0)
    weights = (np.log((1 + len(counts)) / (1 + seen)) + 1).astype(np.float32)
    dense = (_weighted(counts) * weights).astype(np.float64)
    values, axes = np.linalg.eigh(dense.T @ dense)
    del dense
    top = np.argsort(values)[::-1][:min(latent, len(counts))]
    space = Space(weights, axes[:, top].astype(np.float32), _word_axes(terms, latent),
                  np.zeros((0, 1), np.float32), labels)
    space.choose(terms)
    return space


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the ids that is never learnt from; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL,
) -> Space:
    """The space of at most ``per_label`` labelled rows of each label, held-out ids left out.

    Only their terms come to the driver: 2 * per_label rows of TERMS counts and at most LEXICAL
    columns and weights of two bytes. Labels other than 0 and 1 and null ids are passed over; of rows
    that repeat an id one is used.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                          F.col("quality").cast("int").alias("label"))
    known = known.filter(
        F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    order = [hash64("doc_id"), F.col("doc_id")]
    picked = None
    for label in (0, 1):
        part = known.filter(F.col("label") == label).orderBy(*order).limit(per_label)
        picked = part if picked is None else picked.union(part)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                terms = Terms.of(*text_bytes(part.column("text")))
                cuts = zip(terms.first[:-1], terms.first[1:], strict=True)
                lexical = [terms.column[a:b].astype(np.uint16).tobytes()
                           + terms.weight[a:b].tobytes() for a, b in cuts]
                packed = [row.tobytes() + x
                          for row, x in zip(terms.counts, lexical, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("label"), pa.array(packed, pa.binary())],
                    ["doc_id", "label", "terms"])

    # The picked ids are at most 2 * per_label rows: a bounded broadcast.
    sample = docs.join(F.broadcast(picked), "doc_id").select("doc_id", "label", "text")
    found = (
        sample.mapInArrow(count, "doc_id long, label int, terms binary")
        .groupBy("doc_id").agg(F.min("label").alias("label"), F.min("terms").alias("terms"))
        .orderBy("doc_id").collect())
    counts = [np.frombuffer(r.terms, np.float32, TERMS) for r in found]
    lexical = [np.frombuffer(r.terms, np.uint16, offset=4 * TERMS).reshape(2, -1) for r in found]
    first = np.cumsum([0, *(x.shape[1] for x in lexical)])
    column, weight = np.concatenate([np.empty((2, 0), np.uint16), *lexical], axis=1)
    terms = Terms(np.array(counts, np.float32).reshape(-1, TERMS), first, column.astype(np.int32),
                  weight.view(np.float16))
    known_labels = np.array([r.label for r in found], float)
    # The driver holds the sample once while it fits, and gives back what the fit needed.
    del found, counts, lexical, column, weight
    space = fit_space(terms, known_labels)
    del terms
    give_back()
    return space


def scorer(space: Space, spark: SparkSession) -> Callable[[Column], Column]:
    """A function from a text column without nulls to its scores; no row moves for it."""
    shared = spark.sparkContext.broadcast(vars(space))

    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Space(**shared.value)
        for texts in batches:
            parts = slices(pa.RecordBatch.from_arrays([texts], ["text"]))
            terms = (Terms.of(*text_bytes(part.column("text"))) for part in parts)
            yield pa.array(np.concatenate([np.empty(0), *map(own.scores, terms)]), pa.float64())

    return F.arrow_udf(scores, "double")


def score_quality(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    threshold: float = THRESHOLD, per_label: int = SAMPLE_PER_LABEL,
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, text_key.

    Scores depend on the text alone. A text without any term (null, empty, one character) is like
    no labelled one and gets the share of label 1 among the sample; without any labels every score
    is 0.5. An empty table gives no rows.
    """
    docs = documents(df, id_col, text_col)
    score = scorer(train(docs, labels, per_label), df.sparkSession)
    scored = docs.select("doc_id", "text_key", score("text").alias("score"))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), "text_key")


def keep_quality(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    threshold: float = THRESHOLD, per_label: int = SAMPLE_PER_LABEL,
) -> DataFrame:
    """The rows of ``df`` that score at least ``threshold``, with all their columns."""
    score = scorer(train(documents(df, id_col, text_col), labels, per_label), df.sparkSession)
    return df.filter(score(F.coalesce(F.col(text_col), F.lit(""))) >= threshold)
