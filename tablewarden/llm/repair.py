"""Conversation structure repair: the cheapest edits that make turns alternate, by a Viterbi search.

The search walks over the rows of a conversation and keeps one survivor (cheapest path, least audit) for
each of four states. Survivors share a backpointer tree whose nodes count their references: a path that
no survivor uses any more is freed, and as soon as all survivors share an ancestor, the edits up to it
are final and leave memory. Equally cheap paths are compared over their whole unresolved parts, from
the last common node on; a run of one edit is one node.

Rows are dealt by ranges of (conversation, turn, role, text), so that a conversation of any length
spreads over tasks. One that lies within a task and fits a piece is repaired there at once. The others
are cut into pieces: each piece tells the cost of the best path from every state to every state and
the order of their audits, a second search of the same kind runs over these small rows, and every piece
is then repaired between the two states found for it.
"""
from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

#: Rows and characters of a piece: what a task holds of a conversation at a time. They change no result.
PIECE_ROWS = 4096
PIECE_CHARS = 1_000_000

# Costs of edits, and what keeping a truncated turn adds.
_REROLE, _DELETE, _INSERT, _TRUNCATED = 1, 2, 5, 5

# States of the role initials read so far: nothing, s, ...u, ...a. The first and the last may end.
_START, _SYSTEM, _USER, _ANSWER = range(4)
_STATES = (_START, _SYSTEM, _USER, _ANSWER)
_ENDS = (_START, _ANSWER)
_KEEP = {
    "s": ((_START, _SYSTEM),),
    "u": ((_START, _USER), (_SYSTEM, _USER), (_ANSWER, _USER)),
    "a": ((_USER, _ANSWER),),
}
_TO_TURN = _KEEP["u"] + _KEEP["a"]
_NAME = {_USER: "user", _ANSWER: "assistant"}
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
_SPACE = " \t\n\x0b\x0c\r"


class _Node:
    """An edit (repeated ``run`` times) of a path; ``length`` counts the edits from the first one on."""

    __slots__ = ("parent", "edit", "run", "length", "kids", "held")

    def __init__(self, parent: _Node | None, edit, run: int) -> None:
        self.parent, self.edit, self.run = parent, edit, run
        self.length = run + (parent.length if parent else 0)
        self.kids: list[_Node] = []
        self.held = 0


class Survivors:
    """The cheapest path to every state, as a tree; edits that all paths share go to ``emit``."""

    def __init__(self, start: int, emit: Callable[[object, int], None] | None = None) -> None:
        self.root = _Node(None, None, 0)
        self.ends = {start: self.root}
        self.cost = {start: 0}
        self.emit = emit
        self.root.held = 1
        self.size, self.limit = 1, 256

    def step(self, moves: list[tuple], run: int = 1) -> None:
        """Every survivor takes one of the moves (from, to, edit, cost); the best per state stay."""
        best: dict[int, tuple] = {}
        for source, target, edit, cost in moves:
            if source not in self.ends:
                continue
            cost += self.cost[source]
            held = best.get(target)
            if held is None or cost < held[0] or (
                    cost == held[0]
                    and self._less(self.ends[source], edit, self.ends[held[1]], held[2])):
                best[target] = (cost, source, edit)
        old, self.ends, self.cost = self.ends, {}, {}
        for target, (cost, source, edit) in best.items():
            self._hold(target, self._child(old[source], edit, run), cost)
        for node in old.values():
            self._let_go(node)
        self._settle()

    def insert(self, source: int, target: int, edit: object, cost: int) -> None:
        """One more edit on the way from a state to another, where that is better."""
        if source not in self.ends:
            return
        cost += self.cost[source]
        node = self.ends[source]
        if target in self.ends:
            other = self.ends[target]
            if cost > self.cost[target] or (
                    cost == self.cost[target] and not self._less(node, edit, other, None)):
                return
            self._hold(target, self._child(node, edit, 1), cost)
            self._let_go(other)
        else:
            self._hold(target, self._child(node, edit, 1), cost)

    def drop(self, state: int) -> None:
        self.cost.pop(state)
        self._let_go(self.ends.pop(state))

    def keep(self, states: tuple) -> None:
        """Only the best of these states' paths stays, and all its edits are final."""
        best = None
        for state in states:
            if state in self.ends and (
                    best is None or self.cost[state] < self.cost[best]
                    or (self.cost[state] == self.cost[best]
                        and self._less(self.ends[state], None, self.ends[best], None))):
                best = state
        for state in list(self.ends):
            if state != best:
                self.drop(state)
        self._settle()

    def order(self) -> dict[int, int]:
        """state -> place of its path among all paths, by their edits."""
        paths = {s: self._unresolved(node) for s, node in self.ends.items()}
        return {s: i for i, s in enumerate(sorted(paths, key=paths.__getitem__))}

    def _unresolved(self, node: _Node) -> str:
        parts = []
        while node is not self.root:
            parts.append(node.edit * node.run)
            node = node.parent
        return "".join(reversed(parts))

    def _less(self, a: _Node, after_a, b: _Node, after_b) -> bool:
        """Whether path a, then its edit, is less than path b with its edit.

        Paths of equal cost over equal rows never begin one another: the longer one would hold
        further inserts, and cost more. So they part somewhere, at different edits.
        """
        x, y = after_a, after_b
        while a is not b:
            if a.length >= b.length:
                x, a = a.edit, a.parent
            else:
                y, b = b.edit, b.parent
        return x < y

    def _child(self, node: _Node, edit, run: int) -> _Node:
        child = _Node(node, edit, run)
        node.kids.append(child)
        self.size += 1
        return child

    def _hold(self, state: int, node: _Node, cost: int) -> None:
        node.held += 1
        self.ends[state], self.cost[state] = node, cost

    def _let_go(self, node: _Node) -> None:
        """One reference less; nodes without any are freed."""
        node.held -= 1
        while not node.held and not node.kids and node is not self.root:
            parent = node.parent
            parent.kids.remove(node)
            self.size -= 1
            node = parent

    def _settle(self) -> None:
        """Emit what all survivors share; join runs of an edit when the tree has doubled."""
        root = self.root
        while not root.held and len(root.kids) == 1:
            root = root.kids[0]
            root.parent = None
            self.size -= 1
            if self.emit:
                self.emit(root.edit, root.run)
        self.root = root
        if self.size > self.limit:
            for node in self.ends.values():
                self._join_runs(node)
            self.limit = max(256, 2 * self.size)

    def _join_runs(self, node: _Node) -> None:
        while node is not self.root:
            above = node.parent
            while (above is not self.root and not above.held and len(above.kids) == 1
                   and above.edit == node.edit):
                node.run += above.run
                node.parent = above.parent
                node.parent.kids[node.parent.kids.index(above)] = node
                self.size -= 1
                above = node.parent
            node = above


class _Turns:
    """The judged rows of a piece: (initial, role, text, fault, further copies), and what they count."""

    def __init__(self, rows: list[tuple], known: set[bytes]) -> None:
        self.rows = []
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        seen: set[tuple] = set()
        before = None
        for _, role, text, copies in rows:
            initial = role[:1]
            said = text.rstrip(_SPACE)
            if not said:
                fault, self.blank = "blank", self.blank + copies
            elif (role, text) in seen or (known and digest(role, text) in known):
                fault, self.duplicate = "duplicate", self.duplicate + copies
            else:
                seen.add((role, text))
                self.duplicate += copies - 1
                fault = "" if said[-1] in ".!?" else "truncated"
                self.truncated += bool(fault)
            self.illegal += copies - 1
            self.illegal += before is not None and (before, initial) not in _LEGAL
            before = initial
            self.rows.append((initial, role, text, fault, copies - 1))
        turns = [t for t, *_ in rows if t is not None]
        self.first_turn, self.last_turn = (turns[0], turns[-1]) if turns else (None, None)
        self.n_turns = len(set(turns))
        self.first, self.last = (rows[0][1][:1], rows[-1][1][:1]) if rows else ("", "")


def digest(role: str, text: str) -> bytes:
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")).digest()


class _Writer:
    """Turns final edits into the audit and the repaired turns."""

    def __init__(self, turns: _Turns, state: int) -> None:
        self.queue = iter(turns.rows)
        self.state, self.extra = state, 0
        self.audit: list[str] = []
        self.turns: list[str] = []

    def edit(self, edit: str, run: int) -> None:
        self.audit.append(edit * run)
        while run:
            if edit == "I":
                self._next_state("u" if self.state != _USER else "a")
                self.turns.append(f"{_NAME[self.state]}:")
                run -= 1
            elif self.extra:
                done = min(run, self.extra)
                self.extra -= done
                run -= done
            else:
                initial, role, text, _, self.extra = next(self.queue)
                if edit == "K":
                    self._next_state(initial)
                    self.turns.append(f"{role}:{text}")
                elif edit == "R":
                    self._next_state("u" if self.state != _USER else "a")
                    self.turns.append(f"{_NAME[self.state]}:{text}")
                run -= 1

    def _next_state(self, initial: str) -> None:
        self.state = dict(_KEEP[initial])[self.state]


def _moves(initial: str, fault: str) -> list[tuple]:
    moves = [(s, s, "D", _DELETE) for s in _STATES]
    if fault in ("blank", "duplicate"):
        return moves
    more = _TRUNCATED if fault else 0
    kept = _KEEP.get(initial, ())
    moves += [(s, t, "K", more) for s, t in kept]
    return moves + [(s, t, "R", more + _REROLE) for s, t in _TO_TURN if (s, t) not in kept]


_MOVES = {(i, f): _moves(i, f) for i in ("s", "u", "a", "")
          for f in ("", "blank", "duplicate", "truncated")}


def _inserts(paths: Survivors) -> None:
    for source in (_START, _SYSTEM, _ANSWER):
        paths.insert(source, _USER, "I", _INSERT)
    paths.insert(_USER, _ANSWER, "I", _INSERT)


def _walk(paths: Survivors, turns: _Turns) -> None:
    """Take all rows, each with inserts before it."""
    for initial, _, _, fault, extra in turns.rows:
        _inserts(paths)
        paths.step(_MOVES[initial if initial in _KEEP else "", fault])
        if extra:  # further copies of the row are duplicates (or blank) all
            paths.step([(s, s, "D", _DELETE * extra) for s in _STATES], extra)
        # What a path from the start, or from after s, can still gain on one that may end.
        if _ANSWER in paths.cost:
            limit = paths.cost[_ANSWER]
            if paths.cost.get(_START, 0) > limit + _DELETE:
                paths.drop(_START)
            if paths.cost.get(_SYSTEM, 0) > limit:
                paths.drop(_SYSTEM)


def _repair(turns: _Turns, start: int = _START, end: int | None = None, tail: int = 0) -> tuple:
    """(cost, audit, repaired turns) of a whole conversation, or of a piece from state to state."""
    out = _Writer(turns, start)
    paths = Survivors(start, out.edit)
    _walk(paths, turns)
    if end is None:
        _inserts(paths)
        paths.keep(_ENDS)
    else:
        paths.keep((end,))
    cost = next(iter(paths.cost.values()))
    for _ in range(tail):
        cost += _INSERT
        out.edit("I", 1)
    return cost, "".join(out.audit), "\n".join(out.turns)


_COUNTS = ("first_turn", "last_turn", "n_turns", "first", "last", "blank", "duplicate", "truncated",
           "illegal")
_PIECE = (
    "conv_id long, place long, whole boolean, first_turn long, last_turn long, n_turns long,"
    " first string, last string, blank long, duplicate long, truncated long, illegal long,"
    " cost long, audit string, repaired string")
_RAW = "turns array<bigint>, roles array<string>, texts array<string>, copies array<bigint>"


def _batches(rows: Iterator[tuple], schema: pa.Schema, weigh: Callable[[tuple], int]) -> Iterator:
    """Tuples as batches of about a piece's size."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += weigh(row)
        if weight > PIECE_CHARS:
            yield _batch(held, schema)
            held, weight = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
        schema=schema)


_LONG, _TEXT = pa.int64(), pa.string()
_PIECE_ARROW = pa.schema(
    [("conv_id", _LONG), ("place", _LONG), ("whole", pa.bool_()), ("first_turn", _LONG),
     ("last_turn", _LONG), ("n_turns", _LONG), ("first", _TEXT), ("last", _TEXT),
     ("blank", _LONG), ("duplicate", _LONG), ("truncated", _LONG), ("illegal", _LONG),
     ("cost", _LONG), ("audit", _TEXT), ("repaired", _TEXT)])
_RAW_ARROW = pa.schema(
    [("turns", pa.list_(_LONG)), ("roles", pa.list_(_TEXT)), ("texts", pa.list_(_TEXT)),
     ("copies", pa.list_(_LONG))])


def _piece_row(conv, place: int, whole: bool, turns: _Turns, done: tuple) -> tuple:
    return (conv, place, whole, *[getattr(turns, c) for c in _COUNTS], *done)


def _tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def _cut(df: DataFrame, piece_rows: int, piece_chars: int) -> DataFrame:
    """Rows dealt by ranges: whole conversations repaired, the others as pieces in order of ``place``."""
    # Copies of a row collapse before they move. Beginnings of texts order as the texts do.
    rows = df.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    dealt = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64))
    dealt = dealt.sortWithinPartitions("conv_id", "turn", "role", "text")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        place = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        conv, first, whole, chars = None, True, False, 0

        def raw() -> tuple:
            nothing = (None,) * (len(_PIECE_ARROW) - 3)
            return (conv, place, False, *nothing, *zip(*held, strict=True))

        for row in _tuples(batches):
            if held and row[0] != conv:
                # Between its first and last conversation a task sees whole ones only.
                if whole:
                    turns = _Turns(held, set())
                    yield (*_piece_row(conv, place, True, turns, _repair(turns)), *(None,) * 4)
                else:
                    yield raw()
                held, chars, place, first, whole = [], 0, place + 1, False, True
            elif len(held) >= piece_rows or chars >= piece_chars:
                yield raw()
                held, chars, place, whole = [], 0, place + 1, False
            conv = row[0]
            held.append(row[1:])
            chars += len(row[3])
        if held:
            yield raw()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([*_PIECE_ARROW, *_RAW_ARROW])
        yield from _batches(pieces(batches), schema, lambda r: (
            len(r[14]) if r[2] else sum(map(len, r[17]))) + 200)

    return staged(dealt.mapInArrow(run, f"{_PIECE}, {_RAW}"), "pieces")


def _with_known(pieces: DataFrame) -> DataFrame:
    """Pieces with the digests of turns that an earlier piece of the same conversation holds."""
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for conv, place, roles, texts in _tuples([batch]):
                marks = list({digest(r, t) for r, t in zip(roles, texts, strict=True)})
                yield pa.RecordBatch.from_arrays(
                    [pa.array([conv] * len(marks), _LONG), pa.array([place] * len(marks), _LONG),
                     pa.array(marks, pa.binary())], ["conv_id", "place", "mark"])

    marks = pieces.select("conv_id", "place", "roles", "texts").mapInArrow(
        digests, "conv_id long, place long, mark binary")
    marks = staged(marks, "marks")
    firsts = marks.groupBy(F.col("conv_id").alias("c"), F.col("mark").alias("m")).agg(
        F.min("place").alias("first"), F.max("place").alias("last")).filter("first < last")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("mark") == F.col("m"))
    later = marks.join(firsts, same).filter("place > first")
    known = later.groupBy("place").agg(F.collect_list("mark").alias("known"))
    return staged(pieces.join(known, "place", "left").select(
        "conv_id", "place", *[c.split()[0] for c in _RAW.split(", ")], "known"), "known")


def _read_piece(row: tuple) -> _Turns:
    turns, roles, texts, copies, known = row
    return _Turns(list(zip(turns, roles, texts, copies, strict=True)), set(known or ()))


def _crossings(pieces: DataFrame) -> DataFrame:
    """(conv_id, place, costs, ranks) of the best paths through a piece, for 4 x 4 states."""
    schema = pa.schema([("conv_id", _LONG), ("place", _LONG), ("costs", pa.list_(_LONG)),
                        ("ranks", pa.list_(_LONG))])

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for conv, place, *row in _tuples(batches):
            turns = _read_piece(row)
            costs, ranks = [], []
            for start in _STATES:
                paths = Survivors(start)
                _walk(paths, turns)
                order = paths.order()
                costs += [paths.cost.get(s, -1) for s in _STATES]
                ranks += [order.get(s, -1) for s in _STATES]
            yield conv, place, costs, ranks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(cross(batches), schema, lambda r: 300)

    return pieces.mapInArrow(
        run, "conv_id long, place long, costs array<bigint>, ranks array<bigint>")


def _stitched(crossings: DataFrame) -> DataFrame:
    """(place, start, end, tail): the states between which each piece is repaired, inserts after it."""
    ordered = crossings.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    schema = pa.schema([(c, _LONG) for c in ("place", "start", "end", "tail")])

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        done: list[list] = []  # final labels; the last one waits for inserts after it
        paths, conv = None, None

        def emit(label, run: int) -> None:
            if label == "I":
                done[-1][3] += run
            else:
                done.append([*label[1:], 0])

        def finish() -> None:
            _inserts(paths)
            paths.keep(_ENDS)

        for now, place, costs, ranks in _tuples(batches):
            if paths is None or now != conv:
                if paths:
                    finish()
                    yield from map(tuple, done)
                    done.clear()
                paths, conv = Survivors(_START, emit), now
            paths.step([
                (s, e, (ranks[4 * s + e], place, s, e), costs[4 * s + e])
                for s in _STATES for e in _STATES if costs[4 * s + e] >= 0])
            yield from map(tuple, done[:-1])
            del done[:-1]
        if paths:
            finish()
            yield from map(tuple, done)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(stitch(batches), schema, lambda r: 100)

    return ordered.mapInArrow(run, "place long, start long, end long, tail long")


def _between(pieces: DataFrame, states: DataFrame) -> DataFrame:
    """Pieces repaired between the states found for them."""
    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for conv, place, start, end, tail, *row in _tuples(batches):
            turns = _read_piece(row)
            yield _piece_row(conv, place, False, turns, _repair(turns, start, end, tail))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(repaired(batches), _PIECE_ARROW, lambda r: len(r[14]) + 200)

    return pieces.join(states, "place").select(
        "conv_id", "place", "start", "end", "tail", "turns", "roles", "texts", "copies", "known",
    ).mapInArrow(run, _PIECE)


def repair_pieces(
    rows: DataFrame, piece_rows: int = PIECE_ROWS, piece_chars: int = PIECE_CHARS,
) -> DataFrame:
    """Repaired conversations of (conv_id, turn, role, text), in pieces ordered by ``place``.

    Rows of a conversation stand by turn (null first), then role and text. ``repaired`` has the turns
    as ``role:text`` lines ('' where none is left), ``audit`` the edits (D, I, K, R); of all cheapest
    edits the least in ASCII order. ``whole`` says that a conversation is one piece. A null role or text
    is one space; null conv_ids form one conversation. Rows that repeat each other are duplicates. An
    empty role has no initial, so such a turn can be given a new role or deleted, not kept. No rows,
    no pieces. Other columns are left behind.
    """
    rows = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    cut = _cut(rows, piece_rows, piece_chars)
    names = _PIECE_ARROW.names
    pieces = _with_known(cut.filter("not whole"))
    return cut.filter("whole").select(*names).union(
        _between(pieces, _stitched(_crossings(pieces))))


def repair_report(pieces: DataFrame) -> DataFrame:
    """One row per conversation: faults, cost, audit and the hash of all repaired turns.

    Conversations of one piece are worked out where they stand. Pieces of the others are read in order
    by one task per conversation, which holds the audit and one piece: a hash of a whole has no other
    way.
    """
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("n_turns"), F.lit(0))
    single = pieces.filter("whole").withColumn("gaps", gaps.cast("long")).select(
        "conv_id", *counts, "audit", F.sha2("repaired", 256).alias("repaired_sha256"))
    schema = pa.schema([("conv_id", _LONG), *[(c, _LONG) for c in counts], ("audit", _TEXT),
                        ("repaired_sha256", _TEXT)])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        total: dict | None = None

        def result() -> tuple:
            seen = 0 if total["low"] is None else total["high"] - total["low"] + 1 - total["turns"]
            return (total["conv"], seen, *[total[c] for c in counts[1:]], "".join(total["audit"]),
                    total["hash"].hexdigest())

        for row in _tuples(batches):
            now = dict(zip(_PIECE_ARROW.names, row, strict=True))
            if total is None or total["conv"] != now["conv_id"]:
                if total:
                    yield result()
                total = dict.fromkeys(counts, 0) | {
                    "conv": now["conv_id"], "low": None, "high": None, "turns": 0, "last": None,
                    "audit": [], "hash": hashlib.sha256(), "empty": True}
            for c in counts[1:]:
                total[c] += now[c]
            if total["last"] is not None:
                total["illegal"] += (total["last"], now["first"]) not in _LEGAL
            total["last"] = now["last"]
            if now["first_turn"] is not None:
                total["turns"] += now["n_turns"] - (now["first_turn"] == total["high"])
                if total["low"] is None:
                    total["low"] = now["first_turn"]
                total["high"] = now["last_turn"]
            total["audit"].append(now["audit"])
            if now["repaired"]:
                text = now["repaired"] if total["empty"] else "\n" + now["repaired"]
                total["hash"].update(text.encode())
                total["empty"] = False
        if total:
            yield result()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(join(batches), schema, lambda r: len(r[7]) + 200)

    many = pieces.filter("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return single.union(many.mapInArrow(
        run, "conv_id long, " + ", ".join(f"{c} long" for c in counts)
        + ", audit string, repaired_sha256 string"))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with faults planted by a hash of conversation and turn.

    Of twenty remainders 0 drops the row, 1 empties the text, 2 removes its full stops, 3 repeats the
    row, 4 makes it a user's. Nulls count as one space, in the hashed key too.
    """
    space = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space),
                      F.coalesce(F.col("turn").cast("string"), space))
    text = F.coalesce("text", space)
    fault = F.col("fault")
    marked = rows.withColumn("fault", F.crc32(key) % 20).filter(fault != 0)
    times = F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return marked.select(
        "conv_id", "turn",
        F.when(fault == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text).alias("text"),
        F.explode(times).alias("copy"),
    ).drop("copy")


def repair_damaged(rows: DataFrame, **sizes: int) -> DataFrame:
    """The report of conversations damaged by :func:`damaged`, with those that lost all rows."""
    own = rows.select("conv_id", "turn", "role", "text")
    report = repair_report(repair_pieces(damaged(own), **sizes))
    every = own.select(F.col("conv_id").cast("long").alias("c")).distinct()
    joined = every.join(report, F.col("c").eqNullSafe(F.col("conv_id")), "left")
    nothing = hashlib.sha256(b"").hexdigest()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(
        F.col("c").alias("conv_id"), *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
