"""Conversation repair against exhaustive search, whole and cut into pieces, on odd rows."""
import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from tablewarden.llm import repair
from tablewarden.llm.queries import QUERIES
from tablewarden.llm.repair import Survivors, _moves, _Turns, _walk

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def faults_of(rows):
    """(blank | duplicate | truncated | '') of rows in order."""
    seen, out = set(), []
    for _, role, text in rows:
        letters = re.findall(r"[^\x20\x09-\x0D]", text)
        if not letters:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if letters[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """All edit sequences, cut only by cost: (cost, audit, repaired)."""
    best = [2 * len(rows), "D" * len(rows), []]

    def go(i, roles, cost, audit, out):
        if cost > best[0]:
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            if [cost, audit] < best[:2]:
                best[:] = [cost, audit, out]
        if not re.fullmatch("s?(ua)*u?", roles):
            return
        for role in ("user", "assistant"):
            if not roles.endswith(role[0]):
                go(i, roles + role[0], cost + 5, audit + "I", [*out, f"{role}:"])
        if i == len(rows):
            return
        _, role, text = rows[i]
        go(i + 1, roles, cost + 2, audit + "D", out)
        if faults[i] not in ("blank", "duplicate"):
            more = 5 if faults[i] else 0
            if role:
                go(i + 1, roles + role[0], cost + more, audit + "K", [*out, f"{role}:{text}"])
            for new in ("user", "assistant"):
                go(i + 1, roles + new[0], cost + 1 + more, audit + "R", [*out, f"{new}:{text}"])

    go(0, "", 0, "", [])
    return best


def by_table(rows, faults):
    """The same by a table of the best (cost, audit) per state; for longer conversations."""
    best = {0: (0, "")}

    def better(state, option):
        if state not in best or option < best[state]:
            best[state] = option

    def inserts():
        for s in (0, 1, 3):
            if s in best:
                better(2, (best[s][0] + 5, best[s][1] + "I"))
        if 2 in best:
            better(3, (best[2][0] + 5, best[2][1] + "I"))

    for (_, role, _), fault in zip(rows, faults):
        inserts()
        old, best = best, {}
        for s, t, edit, cost in _moves(role[:1], fault):
            if s in old:
                better(t, (old[s][0] + cost, old[s][1] + edit))
    inserts()
    return min(best[s] for s in (0, 3) if s in best)


def naive(rows, search=cheapest):
    """The report of one conversation, rows as (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1].encode(), r[2].encode()))
    faults = faults_of(rows)
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    cost, audit, *out = search(rows, faults)
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost, audit, *[hashlib.sha256("\n".join(o).encode()).hexdigest() for o in out])


def damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        out[conv] += []
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out[conv] += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def random_rows(rng, n):
    roles = ["user", "assistant", "user", "assistant", "system", "", "tool", "usher"]
    texts = ["Well.", "Why?", "So", "", " \t", "Yes!", "Well. ", "No.\n", "A.", "B.", "C.", "D"]
    return [(rng.choice([None, *range(n)]) if rng.random() < 0.2 else i, rng.choice(roles),
             rng.choice(texts) if rng.random() < 0.6 else f"{i}.") for i in range(n)]


@pytest.mark.parametrize("sizes", [{}, {"piece_rows": 3}, {"piece_rows": 1}])
def test_repair_equals_exhaustive_search(spark, sizes):
    rng = random.Random(7)
    convs = {i: random_rows(rng, rng.randint(1, 5)) for i in range(200)}
    rows = [(i, *r) for i, c in convs.items() for r in c]
    pieces = repair.repair_pieces(spark.createDataFrame(rows, SCHEMA), **sizes)
    found = {r["conv_id"]: tuple(r[c] for c in COLUMNS)
             for r in repair.repair_report(pieces).collect()}
    assert found == {i: naive(c) for i, c in convs.items()}


def test_long_conversations_over_tasks(spark):
    """Cut over tasks and pieces, with blank runs that leave the first edit open to the end."""
    rng = random.Random(3)
    convs = {1: random_rows(rng, 3000), 2: [(0, "user", "Hi.")] + [(i, "user", "") for i in range(900)],
             None: [(None, "user", "Same.")] * 700 + [(i, "assistant", f"{i}.") for i in range(300)]}
    rows = [(i, *r) for i, c in convs.items() for r in c]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = {i: naive(c, by_table) for i, c in convs.items()}
    for size in (64, 5000):
        pieces = repair.repair_pieces(df, piece_rows=size)
        found = {r["conv_id"]: tuple(r[c] for c in COLUMNS)
                 for r in repair.repair_report(pieces).collect()}
        assert {i: r[:7] for i, r in found.items()} == want
        hashes = {r.conv_id: r.repaired_sha256 for r in repair.repair_report(pieces).collect()}
        if size == 64:
            first = hashes
    assert hashes == first
    whole = {}
    for r in sorted(pieces.collect(), key=lambda r: (r.conv_id or 0, r.place)):
        whole.setdefault(r.conv_id, []).extend([r.repaired] if r.repaired else [])
    for conv, texts in whole.items():
        text = "\n".join(texts)
        initials = "".join(re.findall("(?m)^([sua])[a-z]+:", text))
        assert re.fullmatch("(s?(ua)+)?", initials)
        assert hashes[conv] == hashlib.sha256(text.encode()).hexdigest()


def test_survivors_free_what_is_decided():
    edits = []
    paths = Survivors(0, lambda e, n: edits.append((e, n)))
    _walk(paths, _Turns([(i, ("user", "assistant")[i % 2], f"{i}.", 1) for i in range(4000)], set()))
    assert paths.size < 10 and sum(n for _, n in edits) > 3990
    paths = Survivors(0)  # nothing is decided, but runs of an edit are one node
    _walk(paths, _Turns([(i, "user", "" if i else "Hi.", 1) for i in range(4000)], set()))
    assert paths.size < 600


def test_query_equals_brute_force(spark, small):
    table = spark.read.parquet(f"{small}/conversations.parquet")
    odd = [(-1, None, None, None), (-1, 0, "user", None), (-2, 5, "", "x."), (None, 1, "user", "a."),
           (None, 2, "assistant", "b"), (-3, 1, "user", "long " * 300_000), (-3, 1, "user", "Ok."),
           (-3, 1, "user", "Ok."), (-4, 3, "system", "Be kind."), (-4, 3, "user", "ß日本?")]
    rows = [tuple(r) for r in table.collect()] + odd
    want = {c: naive(r) for c, r in damage(rows).items()}
    df = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 as place", "'x' as audit", "true as whole", "'u' as first", "3 as copies", "0 as fault")
    found = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in repair.repair_damaged(df).collect()}
    assert found == want
    base = {c for (c, *_) in odd}
    query = {r["conv_id"]: tuple(r[c] for c in COLUMNS)
             for r in QUERIES["op11_repair"](spark, small).collect()}
    assert query == {c: r for c, r in want.items() if c not in base}
    assert repair.repair_damaged(df.limit(0)).count() == 0
