"""First values of columns with long texts that begin alike, against sorting them all."""
from collections import Counter

import pytest

from tablewarden.operators import frequency

LONG = "The same beginning of every single text, longer than a head is. " * 3


def texts():
    out = [LONG + f"{i % 97:03d}" for i in range(400)]
    out += [LONG[:64], LONG[:64] + "!", LONG, None, "", "a", "a", "b" * 64, "b" * 65, "b" * 64 + "a"]
    out += [LONG * 40 + end for end in ("z", "y", "x", "x")] + ["ß日" * 60 + "é", "ß日" * 60 + "e"]
    return out + [LONG + "000"] * 3


def brute(values, count, by_count):
    counts = Counter(v for v in values if v is not None)
    order = sorted(counts, key=lambda v: (-counts[v] if by_count else 0, v.encode()))
    return [(i + 1, v, counts[v]) for i, v in enumerate(order[:count])]


@pytest.mark.parametrize("by_count", [True, False])
@pytest.mark.parametrize("count", [1, 7, 1000])
def test_first_values_equal_a_sort(spark, by_count, count):
    columns = {"plain": texts(), "tail": [LONG * 30 + f"{i:04d}" for i in range(300)],
               "one": [LONG] * 50, "none": [None] * 3}
    cells = spark.createDataFrame(
        [(c, v) for c, values in columns.items() for v in values if v is not None],
        "column_name string, value string").repartition(6)
    counted = frequency.text_frequencies(cells)
    found = frequency.first_values(counted if by_count else counted.drop("n"), cells, count, by_count)
    rows = {}
    for r in found.collect():
        rows.setdefault(r["column_name"], []).append((r["rank"], r["value"], *([r["n"]] if by_count else [])))
    want = {c: brute(v, count, by_count) for c, v in columns.items()}
    want = {c: [r if by_count else r[:2] for r in v] for c, v in want.items() if v}
    assert {c: sorted(v) for c, v in rows.items()} == want


def test_tied_texts_neither_gather_nor_travel_whole(spark, monkeypatch):
    """Every round moves parts and digests; windows are cut in each task before the shuffle."""
    cells = spark.range(5000).selectExpr(
        "'c' as column_name", f"concat('{LONG * 20}', lpad(id, 6, '0')) as value").repartition(4)
    seen = []
    own = type(cells).collect

    def collect(df):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return own(df)

    monkeypatch.setattr(type(cells), "collect", collect)
    found = frequency.first_values(frequency.text_frequencies(cells), cells, 3, by_count=True)
    rounds = [p for p in seen if "prefix" in p]
    assert 3 <= len(rounds) <= 16  # 20 beginnings of 192 characters, found in growing steps
    for plan in rounds:
        assert "row_number()" in plan and "Partial" in plan
        for line in plan.split("\n"):
            if "HashAggregate(keys=" in line:
                assert " value#" not in line.replace("[value#", "[ value#")
    monkeypatch.undo()
    assert [r.value[-6:] for r in found.orderBy("rank").collect()] == ["000000", "000001", "000002"]
