"""Runs of words against their definition, tried for every period."""
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tablewarden.llm import periodic
from tablewarden.llm.queries import QUERIES


def naive(words, min_length=6, min_periods=4):
    """All maximal stretches of every period, left out where a shorter period explains them."""
    n, found = len(words), []
    for q in range(1, n // min_periods + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(min_length, min_periods * q) and not any(
                    words[i:j + q - p] == words[i + p:j + q] for p in range(1, q)):
                found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    words = planted(doc_id, words)
    runs = naive(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (len(runs), *((top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else [None] * 4),
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def texts_of_runs(rng):
    for _ in range(400):
        n, kinds = rng.randint(0, 60), rng.randint(1, 4)
        yield [rng.randrange(kinds) for _ in range(n)]
    for _ in range(200):
        out = []
        for _ in range(rng.randint(1, 5)):
            root = [rng.randrange(3) for _ in range(rng.randint(1, 6))]
            out += root * rng.randint(1, 9) + root[:rng.randint(0, len(root))]
        yield out
    word = [0], [0, 1]
    for _ in range(9):
        word = word[1], word[1] + word[0]
    yield word[1]


@pytest.mark.parametrize("limits", [(6, 4), (3, 2), (5, 3), (9, 2)])
def test_runs_equal_their_definition(limits):
    for symbols in texts_of_runs(random.Random(5)):
        words = [b"w%d" % s for s in symbols]
        assert periodic.find_runs(words, *limits) == naive(symbols, *limits)
        if symbols:
            whole = periodic.runs_of([s + 1 for s in symbols], *limits)
            assert sorted(whole, key=lambda r: (r[0], r[2])) == naive(symbols, *limits)


def test_windows_hold_all_runs_and_skip_prose():
    rng = np.random.default_rng(2)
    prose = rng.integers(0, 1 << 40, 3000).astype(np.uint64)
    assert periodic.windows(prose) == []
    prose[1000:1400] = np.tile(prose[1000:1080], 5)
    prose[2000:2007] = 9
    parts = periodic.windows(prose)
    assert any(a < 1000 and b > 1400 for a, b in parts)
    assert any(a < 2000 and b > 2007 for a, b in parts)
    assert sum(b - a for a, b in parts) < 900


def test_extensions_of_suffixes():
    rng = random.Random(1)
    symbols = [rng.randint(1, 2) for _ in range(300)]
    tree = periodic.SuffixTree(symbols)
    i = np.array([rng.randrange(300) for _ in range(500)])
    j = (i + np.array([rng.randint(1, 299) for _ in range(500)])) % 300
    for a, b, n in zip(i.tolist(), j.tolist(), tree.extension(i, j).tolist()):
        want = 0
        while max(a, b) + want < 300 and symbols[a + want] == symbols[b + want]:
            want += 1
        assert n == want
    ranks = sorted(range(301), key=lambda k: [*symbols[k:], 0])
    assert tree.rank.tolist() == [ranks.index(k) for k in range(301)]


def test_query_equals_definition(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select(
        "doc_id", "text").collect()]
    found = {r["doc_id"]: tuple(r[c] for c in COLUMNS)
             for r in QUERIES["op13_periodic"](spark, small).collect()}
    short = [(i, t) for i, t in rows if len((t or "").split()) < 1500]
    assert len(found) == len(rows) and len(short) > 150
    for i, t in short:
        assert found[i] == expected(i, t)
    assert sum(r[0] > 0 for r in found.values()) > 5


def test_odd_rows(spark):
    texts = [None, "", " \n\t ", "a " * 9, "x y " * 30_000 + "z", "ß\x0bß\x0cß ß ß\rß\x85 ß", "a b\xa0a b"]
    rows = [(i if i else None, t, [1], "r", 7) for i, t in enumerate(texts)] * 2
    df = spark.createDataFrame(
        rows, "doc_id long, text string, runs array<int>, words string, start int")
    found = {r.doc_id: r for r in periodic.collapse_runs(df).collect()}
    assert periodic.collapse_runs(df).count() == len(rows)
    assert found[None].text == found[1].text == found[2].text == ""
    assert [tuple(r) for r in found[3].runs] == [(0, 9, 1)] and found[3].text == "a"
    assert [tuple(r) for r in found[4].runs] == [(0, 60_000, 2)] and found[4].text == "x y z"
    assert found[5].runs == [] and found[6].text == "a b\xa0a b"
    assert periodic.collapse_runs(df.limit(0)).count() == 0
