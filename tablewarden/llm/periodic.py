"""Periodic runs of words: maximal repetitions by suffix-tree extension of Lyndon roots.

Every run has a Lyndon root: the longest Lyndon word from some position on, for the order of symbols or
for its reverse (ends of texts are least in both). So the next smaller suffix of each position gives a
candidate period, and two longest common extensions, forwards and backwards, give the run. Extensions
take constant time: a suffix tree (Ukkonen) of the words and one of the reversed words, each toured once
(Euler), and range minima over the depths between the leaves of the tour.

Trees are built over the parts of a document that can hold a run at all. A run of period q and at
least 4 q words repeats its word triples at distance q, over at least 3 q - 2 words in a row; stretches
that are shorter than their distances call for cannot belong to one. This leaves out no run.
"""
from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_map, documents

MIN_LENGTH = 6
MIN_PERIODS = 4

_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


class SuffixTree:
    """The suffix tree of symbols 1, 2, ... with an end mark 0, toured for constant-time extensions."""

    def __init__(self, symbols: list[int]) -> None:
        self.text = [*symbols, 0]
        self.width = max(self.text) + 1
        self._build()
        self.rank, depths = self.tour()
        self.minima = _range_minima(depths)

    def _build(self) -> None:
        """Ukkonen's construction: one symbol after the other, along suffix links."""
        text, width, n = self.text, self.width, len(self.text)
        start, end, link, child = [0], [0], [0], {}
        leaves = []
        node = edge = length = pending = 0
        for i, symbol in enumerate(text):
            pending += 1
            split = 0
            while pending:
                if not length:
                    edge = i
                key = node * width + text[edge]
                below = child.get(key)
                if below is None:
                    child[key] = len(start)
                    leaves.append(len(start))
                    start.append(i)
                    end.append(n)
                    link.append(0)
                    if split:
                        link[split] = node
                        split = 0
                else:
                    at = start[below]
                    size = end[below] - at
                    if length >= size:
                        edge += size
                        length -= size
                        node = below
                        continue
                    if text[at + length] == symbol:
                        length += 1
                        if split:
                            link[split] = node
                        break
                    inner = len(start)
                    child[key] = inner
                    child[inner * width + symbol] = inner + 1
                    child[inner * width + text[at + length]] = below
                    start += (at, i)
                    end += (at + length, n)
                    link += (0, 0)
                    leaves.append(inner + 1)
                    start[below] = at + length
                    if split:
                        link[split] = inner
                    split = inner
                pending -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - pending + 1
        self.start, self.end, self.leaves = start, end, leaves
        self.edges = np.fromiter(child.keys(), np.int64, len(child))
        self.below = np.fromiter(child.values(), np.int64, len(child))

    def tour(self, reverse: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(place of every suffix among the leaves, least depth between a leaf and the one before).

        Children are visited in the order of their symbols or in the reverse one, the end mark first.
        """
        upper, symbol = np.divmod(self.edges, self.width)
        if reverse:
            symbol = np.where(symbol > 0, self.width - symbol, 0)
        order = np.lexsort((-symbol, upper))
        below = self.below[order].tolist()
        cuts = np.searchsorted(upper[order], np.arange(len(self.start) + 1)).tolist()
        size = (np.array(self.end) - np.array(self.start)).tolist()
        places, depths = [], []
        stack, held = below[cuts[0]:cuts[1]], [0] * (cuts[1] - cuts[0])
        least = 0
        while stack:
            node, above = stack.pop(), held.pop()
            # A sibling that is not the first comes after leaves that part from it above.
            if above < least:
                least = above
            a, b = cuts[node], cuts[node + 1]
            if a == b:
                places.append(node)
                depths.append(least)
                least = 1 << 60
            else:
                depth = above + size[node]
                stack += below[a:b]
                held += [depth] * (b - a)
        at = np.empty(len(self.start), np.int64)
        at[places] = np.arange(len(places))
        return at[self.leaves], np.array(depths, np.int32)

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common beginning of the suffixes at i and at j, i != j."""
        a, b = self.rank[i], self.rank[j]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b)
        level = np.frexp((high - low + 1).astype(float))[1] - 1
        return np.minimum(
            self.minima[level, low], self.minima[level, high - (1 << level) + 1]).astype(np.int64)


def _range_minima(values: np.ndarray) -> np.ndarray:
    """Minima of all ranges whose length is a power of two: one row per power."""
    rows = [values]
    span = 1
    while 2 * span <= len(values):
        row = rows[-1].copy()
        row[:-span] = np.minimum(row[:-span], row[span:])
        rows.append(row)
        span *= 2
    return np.stack(rows)


def _next_smaller(rank: list[int]) -> list[int]:
    """Of every suffix the next one that is less; the end mark is less than all."""
    out, stack = [0] * len(rank), []
    for i in range(len(rank) - 1, -1, -1):
        own = rank[i]
        while stack and rank[stack[-1]] > own:
            stack.pop()
        out[i] = stack[-1] if stack else i
        stack.append(i)
    return out[:-1]


def runs_of(
    symbols: list[int], min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS,
) -> set[tuple[int, int, int]]:
    """All (start, length, period) of maximal repetitions of symbols 1, 2, ... that are long enough."""
    n = len(symbols)
    tree, back = SuffixTree(symbols), None
    found: set[tuple[int, int, int]] = set()
    for reverse in (False, True):
        rank = tree.tour(True)[0] if reverse else tree.rank
        at = np.arange(n)
        period = np.array(_next_smaller(rank.tolist()), np.int64) - at
        fits = np.maximum(min_length, min_periods * period) <= n
        at, period = at[fits], period[fits]
        right = tree.extension(at, at + period)
        # A root in the first period of a run is followed by all but two periods of it.
        fits = right + 2 * period > np.maximum(min_length, min_periods * period)
        at, period, right = at[fits], period[fits], right[fits]
        if not len(at):
            continue
        back = back or SuffixTree(symbols[::-1])
        left = back.extension(n - at, n - at - period)
        start, length = at - left, left + period + right
        fits = length >= np.maximum(min_length, min_periods * period)
        found |= set(zip(
            start[fits].tolist(), length[fits].tolist(), period[fits].tolist(), strict=True))
    return found


def windows(
    hashes: np.ndarray, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS,
) -> list[tuple[int, int]]:
    """Ranges of words that hold all runs, each with at least a word beside it (or the text's end).

    A run repeats its triples over at least max(min_length, min_periods * q) - q - 2 words.
    """
    n = len(hashes)
    if n < min_length:
        return []
    if min_length < 5:  # a run may then repeat no triple
        return [(0, n)]
    a, b, c = _FACTORS
    triples = hashes[:-2] * a + hashes[1:-1] * b + hashes[2:] * c
    order = np.argsort(triples, kind="stable")
    ranked = triples[order]
    same = np.flatnonzero(ranked[1:] == ranked[:-1])
    if not len(same):
        return []
    # Words back to the last equal triple; too far where there is none.
    gap = np.full(n - 2, n, np.int64)
    gap[order[same + 1]] = order[same + 1] - order[same]
    here = gap < n
    while True:
        edges = np.flatnonzero(np.diff(here, prepend=False, append=False))
        starts, ends = edges[::2], edges[1::2]
        if not len(starts):
            return []
        longest = _longest_period(ends - starts, min_length, min_periods)
        fits = here.copy()
        fits[here] = gap[here] <= np.repeat(longest, ends - starts)
        if fits.sum() == here.sum():
            break
        here = fits
    out: list[tuple[int, int]] = []
    for start, end, period in zip(starts.tolist(), ends.tolist(), longest.tolist(), strict=True):
        low, high = max(0, start - period - 1), min(n, end + 3)
        while out and low <= out[-1][1]:
            before = out.pop()
            low, high = min(low, before[0]), max(high, before[1])
        out.append((low, high))
    return out


def _longest_period(repeated: np.ndarray, min_length: int, min_periods: int) -> np.ndarray:
    """The longest period whose runs repeat no more triples than these; 0 if there is none."""
    period = (repeated + 2) // (min_periods - 1)
    return np.where(period >= min_length - 2 - repeated, period, 0)


def find_runs(
    words: list[bytes], min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS,
) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of words, by start, then period."""
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    found: set[tuple[int, int, int]] = set()
    for low, high in windows(hashes, min_length, min_periods):
        number: dict[bytes, int] = {}
        symbols = [number.setdefault(w, len(number) + 1) for w in words[low:high]]
        found |= {(low + s, n, q) for s, n, q in runs_of(symbols, min_length, min_periods)}
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse_runs(
    df: DataFrame, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS,
    prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """(doc_id, runs, text) of every document: its runs, and its words with each run cut to one period.

    Words are what stands between ASCII white space; they are joined by one space. A run is a stretch of
    words whose smallest period q occurs at least ``min_periods`` (2 or more) times and that has
    ``min_length`` (3 or more) words or more; it is as long as can be. Runs may overlap: a word goes if it
    stands in any run after that run's first period. Null and empty texts have no runs and an empty
    text; rows that repeat are worked out each. Other columns are left behind. ``prepare`` may replace
    a document's words first. A task holds one batch of documents and the trees of one of them.
    """
    if min_periods < 2 or min_length < 3:
        raise ValueError("a run has two periods and three words at least")
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, runs, texts = batch.column(0).to_pylist(), [], []
        for doc_id, text in zip(ids, batch.column(1), strict=True):
            words = text.as_py().encode().split()
            if prepare:
                words = prepare(doc_id, words)
            found = find_runs(words, min_length, min_periods)
            if found:
                kept = np.ones(len(words), bool)
                for start, length, period in found:
                    kept[start + period:start + length] = False
                words = [words[i] for i in np.flatnonzero(kept)]
            runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
            texts.append(b" ".join(words).decode())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(runs, pa.list_(run_type)), pa.array(texts, pa.string())],
            ["doc_id", "runs", "text"])

    return arrow_map(
        documents(df).select("doc_id", "text"), cut,
        "doc_id long, runs array<struct<start:bigint,length:bigint,period:bigint>>, text string")

