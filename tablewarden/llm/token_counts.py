"""Edit-aware token counts: a tree of pre-token counts per document, updated where an edit falls.

A text's pre-tokens are grouped into leaves of some dozens each; a leaf holds its length and its number
of tokens, and a segment tree above the leaves holds sums. An edit takes the leaves that it touches,
plus the context before it that may change the split, encodes them anew until the split meets an old
leaf boundary again, and updates the sums above. The rest of the text is never encoded again.
"""
from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash64, slices, staged, with_row

#: Characters of a leaf, at least; leaves end at pre-token boundaries.
LEAF_CHARS = 512
#: Code points before an edit whose pre-tokens may change: one look-ahead and one character back.
_CONTEXT = 2


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


class Counter:
    """Splits and counts by a byte-pair vocabulary and its splitting pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.split = regex.compile(pattern)
        self.encoding = tiktoken.Encoding(
            "counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def count(self, text: str) -> int:
        return len(self.encoding.encode_ordinary(text))

    def next_boundary(self, text: str, start: int, least: int) -> int:
        """The first pre-token boundary at or after ``least``, splitting from boundary ``start``.

        Not behind white space: how a run of it splits depends on what follows.
        """
        for match in self.split.finditer(text, start):
            end = match.end()
            if end >= least and not text[end - 1].isspace():
                return end
        return len(text)

    def leaves(self, text: str, start: int = 0) -> list[tuple[int, int]]:
        """(length, tokens) of the leaves of ``text`` from a boundary to the end."""
        out = []
        while start < len(text):
            end = self.next_boundary(text, start, min(len(text), start + LEAF_CHARS))
            out.append((end - start, self.count(text[start:end])))
            start = end
        return out


class Tree:
    """Sums of (length, tokens) over leaves, as a binary tree of lists, lowest level first."""

    def __init__(self, leaves: list[tuple[int, int]]):
        self.levels = [list(leaves)]
        while len(self.levels[-1]) > 1:
            self.levels.append(self._above(self.levels[-1]))

    @staticmethod
    def _above(level):
        return [
            (level[i][0] + level[i + 1][0], level[i][1] + level[i + 1][1])
            if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]

    @property
    def total(self) -> tuple[int, int]:
        return self.levels[-1][0] if self.levels[-1] else (0, 0)

    def leaf_at(self, position: int) -> tuple[int, int]:
        """(number, start) of the leaf that holds a code point, by descent from the root."""
        if not self.levels[0]:
            return 0, 0
        at, start = 0, 0
        for level in reversed(self.levels[:-1]):
            at *= 2
            if position >= start + level[at][0] and at + 1 < len(level):
                start += level[at][0]
                at += 1
        return at, start

    def replace(self, first: int, last: int, leaves: list[tuple[int, int]]) -> None:
        """Put ``leaves`` in the place of leaves first..last - 1.

        With as many as before only the sums above them change; otherwise sums from there on.
        """
        same = len(leaves) == last - first
        self.levels[0][first:last] = leaves
        if same:
            lo, hi = first, last
            for below, level in zip(self.levels, self.levels[1:], strict=False):
                lo, hi = lo // 2, (hi + 1) // 2
                level[lo:hi] = self._above(below[2 * lo:2 * hi])
        else:
            lo = first
            levels = [self.levels[0]]
            while len(levels[-1]) > 1:
                lo //= 2
                old = self.levels[len(levels)] if len(levels) < len(self.levels) else []
                levels.append(old[:lo] + self._above(levels[-1][2 * lo:]))
            self.levels = levels


def apply_edit(
    counter: Counter, tree: Tree, text: str, start: int, end: int, new: str,
) -> tuple[str, int]:
    """(text after the edit, code points encoded): text[start:end] becomes ``new``.

    Positions are clipped to the text. The tree is changed in place.
    """
    start = max(0, min(start, len(text)))
    end = max(start, min(end, len(text)))
    after = text[:start] + new + text[end:]
    first, begin = tree.leaf_at(max(0, start - _CONTEXT))
    leaves = tree.levels[0]
    # Old leaf boundaries at or after the edit, as positions in the new text.
    shift = len(new) - (end - start)
    last, boundary = first, begin
    while last < len(leaves) and boundary < end:
        boundary += leaves[last][0]
        last += 1
    made, at = [], begin
    while True:
        goal = boundary + shift
        if at == goal and at >= start + len(new):
            break
        if at >= len(after):
            last = len(leaves)
            break
        stop = counter.next_boundary(after, at, min(len(after), at + LEAF_CHARS, max(goal, at + 1)))
        made.append((stop - at, counter.count(after[at:stop])))
        at = stop
        while last < len(leaves) and boundary + shift < at:
            boundary += leaves[last][0]
            last += 1
    tree.replace(first, last, made)
    return after, at - begin


def build_trees(
    df: DataFrame, counter: Callable[[], Counter], id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(row, doc_id, text, lengths, tokens): every text with the leaves of its tree.

    Null texts count as empty and have no leaves.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter()
        for batch in batches:
            for part in slices(batch):
                leaves = [own.leaves(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("doc_id"), part.column("text"),
                     pa.array([[n for n, _ in x] for x in leaves], pa.list_(pa.int32())),
                     pa.array([[k for _, k in x] for x in leaves], pa.list_(pa.int32()))],
                    ["row", "doc_id", "text", "lengths", "tokens"])

    rows = with_row(df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text")))
    return rows.mapInArrow(
        run, "row long, doc_id long, text string, lengths array<int>, tokens array<int>")


def update_counts(trees: DataFrame, edits: Column, counter: Callable[[], Counter]) -> DataFrame:
    """(doc_id, text, lengths, tokens, n_before, n_after, encoded, n_chars): trees after their edits.

    ``edits`` is a column expression on ``trees``: array<struct<start:int, end:int, new:string>>,
    applied in order, positions in code points of the text as it then is; null means none.
    ``encoded`` counts the code points that had to be encoded again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter()
        for batch in batches:
            for part in slices(batch):
                out = []
                columns = (part.column(c).to_pylist()
                           for c in ("text", "lengths", "tokens", "edits"))
                for text, lengths, tokens, changes in zip(*columns, strict=True):
                    tree = Tree(list(zip(lengths, tokens, strict=True)))
                    before, encoded = tree.total[1], 0
                    for change in changes or ():
                        text, n = apply_edit(own, tree, text, change["start"], change["end"],
                                             change["new"] or "")
                        encoded += n
                    out.append((text, [n for n, _ in tree.levels[0]],
                                [k for _, k in tree.levels[0]], before, tree.total[1], encoded,
                                len(text)))
                kinds = [pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), *[pa.int64()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c, k) for c, k in zip(
                        zip(*out, strict=True), kinds, strict=True))],
                    ["doc_id", "text", "lengths", "tokens", "n_before", "n_after", "encoded",
                     "n_chars"])

    return trees.select("doc_id", "text", "lengths", "tokens", edits.alias("edits")).mapInArrow(
        run, "doc_id long, text string, lengths array<int>, tokens array<int>, n_before long,"
        " n_after long, encoded long, n_chars long")


def sample_edits(text: str = "text", key: str = "doc_id") -> Column:
    """Three edits of every document, given by hashes of its id: a cut, a change and an insertion."""
    n = F.char_length(F.col(text))
    out = []
    for i, (cut, new) in enumerate(((24, ""), (8, " edited words"), (0, "né 12\n"))):
        at = F.pmod(hash64(F.col(key), F.lit(i)), F.greatest(n, F.lit(1))).cast("int")
        out.append(F.struct(at.alias("start"), (at + cut).alias("end"), F.lit(new).alias("new")))
    return F.array(*out)


def edited_counts(
    df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Trees of all texts, the edits of :func:`sample_edits` applied, and counts before and after.

    An empty table gives no rows; every row is a document.
    """
    def counter() -> Counter:
        return Counter(load_ranks(path), pattern)

    trees = staged(build_trees(df, counter, id_col, text_col), "trees")
    return update_counts(trees, sample_edits(), counter)
