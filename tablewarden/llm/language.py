"""Language of texts: a bidirectional gated recurrent network over bytes, trained here with numpy.

The network reads the bytes of a word in both directions (long words in pieces of 32 bytes) and gives
every position a probability of each language; a document's probabilities are the mean over all its
positions. A word's positions depend on the word alone, so a task runs the network once per distinct
word and adds up what it kept.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import hash64, slices

#: Bounds of what the network learns from: documents per language, word pieces per document and in all.
DOCS_PER_LANGUAGE = 400
PIECES_PER_DOC = 64
PIECES = 1 << 17
LANGUAGES = 512

#: Bytes read in a row; longer words are read in pieces.
PIECE = 32
_HIDDEN = 8
_EPOCHS = 5
_BATCH = 256
_RATE = 0.01
_ROWS = 1024  # pieces that run at once
_KEPT = 400_000  # distinct words, and their bytes, that a task keeps
_KEPT_BYTES = 8_000_000


def _sigmoid(x: np.ndarray) -> None:
    """In place; very negative numbers overflow to an exact 0."""
    np.negative(x, out=x)
    with np.errstate(over="ignore"):
        np.exp(x, out=x)
    x += 1
    np.reciprocal(x, out=x)


class ByteGru:
    """A gated recurrent network in each direction and a softmax at every position."""

    def __init__(self, classes: int, hidden: int = _HIDDEN, seed: int = 12) -> None:
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.weights = {
            "read0": rng.normal(0, 0.3, (256, 3 * hidden)), "read1": rng.normal(0, 0.3, (256, 3 * hidden)),
            "turn0": rng.normal(0, hidden ** -0.5, (hidden, 3 * hidden)),
            "turn1": rng.normal(0, hidden ** -0.5, (hidden, 3 * hidden)),
            "out": rng.normal(0, 0.3, (2 * hidden, classes)), "bias": np.zeros(classes),
        }

    def _states(self, x: np.ndarray, way: int, trace: list | None = None) -> np.ndarray:
        """(rows, positions, hidden): the state after reading each byte in one direction."""
        n, length = x.shape
        k = self.hidden
        read, turn = self.weights[f"read{way}"], self.weights[f"turn{way}"]
        read_gates, read_fresh = read[:, :2 * k].copy(), read[:, 2 * k:].copy()
        out = np.empty((length, n, k))
        state = np.zeros((n, k))
        for t in range(length) if way == 0 else range(length - 1, -1, -1):
            own = state @ turn
            gates, fresh = read_gates.take(x[:, t], axis=0), read_fresh.take(x[:, t], axis=0)
            gates += own[:, :2 * k]
            _sigmoid(gates)
            update, reset = gates[:, :k], gates[:, k:]
            fresh += reset * own[:, 2 * k:]
            fresh *= 2  # tanh(x) = 2 sigmoid(2 x) - 1
            _sigmoid(fresh)
            fresh *= 2
            fresh -= 1
            if trace is not None:
                trace.append((t, state, update, reset, fresh, own[:, 2 * k:]))
            mixed = np.subtract(state, fresh, out=out[t])
            mixed *= update
            mixed += fresh
            state = mixed
        return out.transpose(1, 0, 2)

    def label(self, x: np.ndarray) -> np.ndarray:
        """(rows, positions, classes): probabilities at every byte of rows of equal length."""
        return self._softmax(np.concatenate([self._states(x, 0), self._states(x, 1)], axis=2))

    def _softmax(self, states: np.ndarray) -> np.ndarray:
        scores = states @ self.weights["out"] + self.weights["bias"]
        scores -= scores.max(axis=2, keepdims=True)
        np.exp(scores, out=scores)
        return scores / scores.sum(axis=2, keepdims=True)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy over all positions and its gradients, by backpropagation through time."""
        k, total = self.hidden, x.size
        traces: tuple[list, list] = ([], [])
        states = np.concatenate([self._states(x, w, traces[w]) for w in (0, 1)], axis=2)
        scores = self._softmax(states)
        loss = -np.log(scores[np.arange(len(x)), :, y] + 1e-300).sum() / total
        scores[np.arange(len(x)), :, y] -= 1
        scores /= total
        flat = scores.reshape(total, -1)
        grads = {"out": states.reshape(total, -1).T @ flat, "bias": flat.sum(axis=0)}
        above = scores @ self.weights["out"].T
        for way in (0, 1):
            turn = self.weights[f"turn{way}"]
            d_read = np.zeros((256, 3 * k))
            d_turn = np.zeros_like(turn)
            later = np.zeros((len(x), k))
            for t, before, update, reset, fresh, own in reversed(traces[way]):
                d_state = above[:, t, way * k:(way + 1) * k] + later
                d_fresh = d_state * (1 - update) * (1 - fresh * fresh)
                d_update = d_state * (before - fresh) * update * (1 - update)
                d_reset = d_fresh * own * reset * (1 - reset)
                d_seen = np.concatenate([d_update, d_reset, d_fresh], axis=1)
                d_own = np.concatenate([d_update, d_reset, d_fresh * reset], axis=1)
                np.add.at(d_read, x[:, t], d_seen)
                d_turn += before.T @ d_own
                later = d_state * update + d_own @ turn.T
            grads[f"read{way}"], grads[f"turn{way}"] = d_read, d_turn
        return float(loss), grads

    def train(self, pieces: list[bytes], labels: np.ndarray, epochs: int = _EPOCHS, seed: int = 3) -> None:
        """Adam over batches of pieces of one length, in an order that the seed alone decides."""
        rng = np.random.default_rng(seed)
        sizes = np.array([len(p) for p in pieces])
        tables = {}
        for size in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == size)
            raw = np.frombuffer(b"".join(pieces[i] for i in at), np.uint8).reshape(len(at), size)
            tables[size] = raw, labels[at]
        first = {n: np.zeros_like(w) for n, w in self.weights.items()}
        second = {n: np.zeros_like(w) for n, w in self.weights.items()}
        step = 0
        for epoch in range(epochs):
            batches = []
            for size, (raw, _) in tables.items():
                order = rng.permutation(len(raw))
                batches += [(size, order[i:i + _BATCH]) for i in range(0, len(raw), _BATCH)]
            rate = _RATE * (1 - epoch / epochs)
            for b in rng.permutation(len(batches)).tolist():
                size, rows = batches[b]
                raw, own = tables[size]
                _, grads = self.gradients(raw[rows], own[rows])
                step += 1
                for name, grad in grads.items():
                    first[name] += 0.1 * (grad - first[name])
                    second[name] += 0.001 * (grad * grad - second[name])
                    self.weights[name] -= rate * (first[name] / (1 - 0.9 ** step)) / (
                        np.sqrt(second[name] / (1 - 0.999 ** step)) + 1e-8)

    def sums(self, words: list[bytes]) -> np.ndarray:
        """(words, classes + 1): probabilities of a word summed over its positions, and their number."""
        classes = len(self.weights["bias"])
        out = np.zeros((len(words), classes + 1))
        by_size: dict[int, tuple[list[int], list[bytes]]] = {}
        for i, word in enumerate(words):
            for at in range(0, len(word), PIECE):
                piece = word[at:at + PIECE]
                rows, texts = by_size.setdefault(len(piece), ([], []))
                rows.append(i)
                texts.append(piece)
        for size, (rows, texts) in by_size.items():
            for a in range(0, len(texts), _ROWS):
                raw = np.frombuffer(b"".join(texts[a:a + _ROWS]), np.uint8).reshape(-1, size)
                np.add.at(out[:, :classes], rows[a:a + _ROWS], self.label(raw).sum(axis=1))
        out[:, classes] = [len(w) for w in words]
        return out


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from training: its id's remainder is 1. A null id counts as empty."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 3 == 1


def train_network(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> tuple[ByteGru | None, list[str]]:
    """(network, languages) learnt from the documents that are not held out and have a language.

    It learns from a bounded sample: of each language up to 400 documents by a hash of id and text, of
    each of these up to 64 words at even distances, and 131,072 pieces at most. All languages stand in
    it. Without a labelled word there is no network.
    """
    known = df.filter(~held_out(id_col) & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = known.groupBy("lang").count().limit(LANGUAGES + 1).collect()
    languages = sorted(r["lang"] for r in found)
    if len(languages) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} different languages")
    if not languages:
        return None, []
    docs = max(1, min(DOCS_PER_LANGUAGE, PIECES // (PIECES_PER_DOC * len(languages))))
    # First a share of each language's rows by hash that holds enough of them, so that few move.
    shares = F.create_map(*[F.lit(x) for r in found for x in (r["lang"], 2.0 * docs / r["count"])])
    key = hash64("doc_id", "text")
    drawn = known.filter(key / 2.0 ** 64 + 0.5 < shares[F.col("lang")])
    place = F.row_number().over(Window.partitionBy("lang").orderBy(key, "doc_id", hash64("text")))
    sample = drawn.withColumn("place", place).filter(F.col("place") <= docs)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, pieces = [], []
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                words = text.as_py().encode().split()
                step = max(1, len(words) / PIECES_PER_DOC)
                chosen = [words[int(i * step)][:PIECE] for i in range(min(len(words), PIECES_PER_DOC))]
                langs += [lang.as_py()] * len(chosen)
                pieces += chosen
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(pieces, pa.binary())], ["lang", "piece"])

    rows = sorted(
        (r["lang"], bytes(r["piece"]))
        for r in sample.select("lang", "text").mapInArrow(pick, "lang string, piece binary").collect())
    if not rows:
        return None, []
    network = ByteGru(len(languages))
    number = {lang: i for i, lang in enumerate(languages)}
    network.train([p for _, p in rows], np.array([number[lang] for lang, _ in rows]))
    return network, languages


def detect_language(
    df: DataFrame, network: ByteGru | None, languages: list[str],
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): the likeliest language of every document.

    ``score`` is its mean probability over all bytes of all words. Null texts and those without a letter
    are ``und`` with score 0, as all are without a network. Equal probabilities go to the language that
    sorts first; probabilities are rounded to six digits, so that the order of rows cannot matter. Rows
    that repeat each get their answer. Other columns are left behind.
    """
    rows = df.select(
        F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"),
        F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("letters"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if network is None:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"),
                           F.lit(0.0).alias("score"))
    model = df.sparkSession.sparkContext.broadcast((network, languages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gru, names = model.value
        kept = _Kept(gru)
        for batch in batches:
            for part in slices(batch):
                ids, held, letters, texts = part.columns
                means = kept.means([t.as_py().encode().split() for t in texts])
                best = means.argmax(axis=1)
                told = letters.to_numpy(zero_copy_only=False).astype(bool)
                lang = [names[b] if t else "und" for b, t in zip(best.tolist(), told, strict=True)]
                score = np.where(told, means[np.arange(len(best)), best], 0.0)
                yield pa.RecordBatch.from_arrays(
                    [ids, held, pa.array(lang, pa.string()), pa.array(score)],
                    ["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


class _Kept:
    """What a task keeps: the summed probabilities of distinct words, up to a bound."""

    def __init__(self, network: ByteGru) -> None:
        self.network = network
        self._clear()

    def _clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.sums = np.zeros((0, len(self.network.weights["bias"]) + 1))
        self.bytes = 0

    def means(self, docs: list[list[bytes]]) -> np.ndarray:
        """(documents, classes): mean probabilities over all positions; zeros without any."""
        if len(self.place) > _KEPT or self.bytes > _KEPT_BYTES:
            self._clear()
        new = sorted({w for words in docs for w in words}.difference(self.place))
        if new:
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)), strict=True))
            self.sums = np.concatenate([self.sums, self.network.sums(new)])
            self.bytes += sum(map(len, new))
        out = np.zeros((len(docs), self.sums.shape[1]))
        for i, words in enumerate(docs):
            if words:
                at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
                out[i] = self.sums[at].sum(axis=0)
        return np.round(out[:, :-1] / np.maximum(out[:, -1:], 1), 6)
