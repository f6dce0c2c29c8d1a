import random

import numpy as np
import pandas as pd
import pytest

from tablewarden.operators import frequency, profile, quantiles, rules, visual
from tablewarden.operators.facts import column_facts
from tablewarden.plans.profile import build_report


def test_missing_counts(frame):
    df = frame({"a": [1.0, None, 3.0, float("nan")]}, "a double")
    row = profile.missing_per_column(df).first()
    assert (row["missing"], row["missing_pct"]) == (2, 50.0)


def test_missing_overall(frame):
    df = frame({"a": [1, None], "b": [None, None], "c": ["x", "y"]}, "a int, b string, c string")
    row = profile.missing_overall(df).first()
    assert (row["total_missing_cells"], row["total_cells"], row["missing_pct"]) == (3, 6, 50.0)
    assert (row["complete_columns"], row["empty_columns"]) == ("c", "b")


def test_empty_table_has_null_percentages(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert [r["missing_pct"] for r in profile.missing_per_column(df).collect()] == [None, None]
    assert profile.missing_overall(df).first()["missing_pct"] is None
    assert profile.numeric_distribution(df).count() == 0
    assert visual.histogram(df).count() == 0


def test_constant_and_cardinality(frame):
    df = frame({"c": ["X"] * 4, "d": ["a", "b", None, "a"]}, "c string, d string")
    rows = {r["column_name"]: r for r in profile.cardinality(column_facts(df)).collect()}
    assert rows["c"]["is_constant"] and not rows["d"]["is_constant"]
    assert (rows["d"]["unique_values"], rows["d"]["cardinality_ratio"]) == (2, 0.5)


def test_signed_zero_is_one_value(frame):
    df = frame({"a": [0.0, -0.0, float("nan"), None]}, "a double")
    row = column_facts(df).first()
    assert (row["n_rows"], row["n_present"], row["n_unique"]) == (4, 2, 1)


def test_report_has_all_sections(frame):
    df = frame({"size": [2, 9, 4], "cost": [7, 1, 8], "email": ["q@r.se", "wrong", None]},
               "size int, cost int, email string")
    report = build_report(df)
    assert {"dataset", "metadata", "missing_per_column", "type_consistency", "cardinality",
            "correlations", "numeric_distribution", "potential_pii", "invalid_formats",
            "suspicious_columns", "histogram"} <= set(report.tables)
    for name, table in report.tables.items():
        table.collect()
    assert report.tables["dataset"].first()["rows"] == 3


@pytest.mark.parametrize("kind", ["uniform", "heavy", "copies", "two", "one"])
def test_quantiles_equal_sorting(frame, kind):
    rng = random.Random(kind)
    values = {
        "uniform": [rng.uniform(-5, 5) for _ in range(4001)],
        "heavy": [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(2000)]
        + [5e-324, 0.0, 1.7e308, -1.7e308],
        "copies": [7.0] * 3000 + [rng.gauss(0, 1) for _ in range(1500)],
        "two": [3.0, 3.0000000000000004],
        "one": [42.0],
    }[kind]
    probabilities = [0, 0.01, 0.25, 0.5, 0.75, 0.999, 1]
    got = quantiles.exact_quantiles(frame({"a": values}, "a double"), ["a"], probabilities)["a"]
    assert np.allclose(got, np.quantile(values, probabilities), rtol=1e-14, atol=0)


def test_distribution_matches_pandas(frame):
    rng = random.Random(5)
    values = [round(rng.lognormvariate(0, 1), 4) for _ in range(500)] + [None] * 20
    row = profile.numeric_distribution(frame({"a": values}, "a double")).first()
    s = pd.Series(values, dtype=float)
    want = [s.min(), s.max(), s.mean(), s.median(), s.std(), s.quantile(0.25), s.quantile(0.75), s.skew()]
    assert np.allclose(row[1:], want, atol=6e-4)


def test_distribution_of_few_values(frame):
    df = frame({"a": [2.0, 4.0, None], "b": [5.0, 5.0, 5.0]}, "a double, b double")
    rows = {r["column_name"]: r for r in profile.numeric_distribution(df).collect()}
    assert rows["a"]["skew"] is None and rows["a"]["median"] == 3.0
    assert rows["b"]["skew"] == 0.0 and rows["b"]["std"] == 0.0


def test_correlation_matches_pandas(frame):
    rng = random.Random(6)
    a = [rng.gauss(1e6, 1) for _ in range(400)]
    data = {
        "a": [x if i % 5 else None for i, x in enumerate(a)],
        "b": [x + rng.gauss(0, 1) if i % 3 else None for i, x in enumerate(a)],
        "c": [1.0] * 400,
        "d": [float(i) if i % 5 == 0 else None for i in range(400)],
    }
    df = frame(data, "a double, b double, c double, d double")
    want = pd.DataFrame(data).corr().round(3)
    for row in profile.correlation_matrix(df).collect():
        expected = want.loc[row["column_name"], row["column_y"]]
        if np.isnan(expected):
            assert row["corr"] is None
        else:
            assert row["corr"] == pytest.approx(expected, abs=1.1e-3)


@pytest.mark.parametrize("tile", [1, 3, 4])
def test_correlation_in_tiles_equals_one_block(frame, tile, monkeypatch):
    rng = random.Random(7)
    base = [rng.gauss(0, 1) for _ in range(300)]
    data = {f"c{i}": [x * i + rng.gauss(0, 2) if (n + i) % (i + 2) else None
                      for n, x in enumerate(base)] for i in range(5)}
    data |= {"whole": base, "still": [4.0] * 300, "none": [None] * 300,
             "inf": [float("inf"), *base[1:]], "it's": [-x for x in base]}
    df = frame(data, ", ".join(f"`{c}` double" for c in data)).repartition(3)
    want = {(r[0], r[1]): r[2] for r in profile.correlation_matrix(df).collect()}
    assert len(want) == len(data) ** 2 and want["whole", "it's"] == -1.0
    monkeypatch.setattr(profile, "_CHUNK_VALUES", 200)  # some chunks in each task
    monkeypatch.setattr(profile, "_UNIT_BYTES", 1000)  # some slots for each pair of tiles
    got = [tuple(r) for r in profile.correlation_matrix(df, tile=tile).collect()]
    assert len(got) == len(want)
    for x, y, corr in got:
        assert corr == (pytest.approx(want[x, y], abs=1.1e-3) if want[x, y] is not None else None)


def test_correlation_of_a_wide_table_keeps_to_tiles(spark):
    """More columns than a tile: each task holds one pair of tiles."""
    df = spark.range(60).selectExpr(*[f"cast(hash(id, {i % 40}) as double) as c{i}" for i in range(90)])
    got = profile.correlation_matrix(df, tile=32)
    assert got.count() == 90 * 90
    same = got.filter("cast(substring(column_name, 2) as int) % 40"
                      " = cast(substring(column_y, 2) as int) % 40")
    assert {r["corr"] for r in same.collect()} == {1.0}


def test_correlation_needs_two_columns(frame):
    assert profile.correlation_matrix(frame({"a": [1, 2]}, "a int")).count() == 0


def test_top_values_of_long_texts(frame):
    start = "same beginning " * 10
    values = [start + "b"] * 3 + [start + "a"] * 2 + ["short"] * 2 + [start, None]
    rows = frequency.top_values(frame({"t": values}, "t string"), count=3).orderBy("rank").collect()
    assert [(r["rank"], r["n"]) for r in rows] == [(1, 3), (2, 2), (3, 2)]
    assert rows[0]["value"] == start + "b" and rows[1]["value"] == start + "a"
    assert rows[2]["value"] == "short"


def test_mode_of_long_texts_is_smallest(frame):
    start = "x" * 64
    values = [start + c for c in "zyxw" for _ in range(2)] + ["zz"] + [None]
    assert frequency.modes(frame({"t": values}, "t string"), ["t"])["t"] == (start + "w", 2)


def test_modes_by_type(frame):
    df = frame({"a": [1, 1, 2, 2, 3], "b": [2.5, 2.5, None, 1.0, 1.0], "c": [None] * 5},
               "a int, b double, c string")
    assert frequency.modes(df, ["a", "b", "c"]) == {"a": (1, 2), "b": (1.0, 2)}


def test_histogram_counts_every_value(frame):
    rng = random.Random(8)
    values = [rng.gauss(0, 1) for _ in range(1000)]
    rows = visual.histogram(frame({"a": values, "k": [3] * 1000}, "a double, k int")).collect()
    counts, edges = np.histogram(values, bins="auto")
    mine = {r["bin"]: r["n"] for r in rows if r["column_name"] == "a"}
    assert [mine.get(i, 0) for i in range(len(counts))] == counts.tolist()
    constant = [r for r in rows if r["column_name"] == "k"]
    assert [(r["lo"], r["hi"], r["n"]) for r in constant] == [(2.5, 3.5, 1000)]


def test_boxplot_whiskers(frame):
    row = visual.boxplot_stats(frame({"a": [1, 2, 3, 4, 100]}, "a int")).first()
    assert tuple(row)[1:] == (2.0, 3.0, 4.0, 1.0, 4.0, 1)


def test_missing_patterns(frame):
    df = frame({"a": [1, None, None], "b": ["x", "y", None]}, "a int, b string")
    got = {r["pattern"]: r["n"] for r in visual.missing_patterns(df).collect()}
    assert got == {"00": 1, "10": 1, "11": 1}
    assert visual.missing_patterns(df.na.drop()).count() == 0


def test_dirty_email_is_pii_by_name(frame):
    df = frame({"email": ["a@x.com", "bad", "c@y.com", "nope", "e@z.com"]}, "email string")
    assert rules.pii_columns(column_facts(df)).first()["reason"] == (
        "values or name suggest email")
    examples = rules.invalid_examples(df, rules.format_columns(column_facts(df))).collect()
    assert sorted(r["example"] for r in examples) == ["bad", "nope"]


def test_reason_names_the_type_in_words(frame):
    names = ["Ann Lee", "Bo Diaz", "Cy Young", "Di Marsh", "Ed Stone", "Flo Kay"]
    df = frame({"who": names, "born": ["2001-02-03"] * 6}, "who string, born string")
    found = [tuple(r) for r in rules.pii_columns(column_facts(df)).collect()]
    assert found == [("who", "person_name", "values or name suggest person name")]


def test_constant_column_is_suspicious(frame):
    df = frame({"flag": ["Y"] * 3}, "flag string")
    assert rules.suspicious_columns(column_facts(df)).first()["reasons"] == "constant"


def test_profile_phone_pattern_is_the_loose_one(frame):
    df = frame({"phone": ["0712345678", "07123456789", "071234567"]}, "phone string")
    assert rules.invalid_formats(column_facts(df)).first()["invalid_count"] == 1


def test_infinite_values(frame):
    inf = float("inf")
    df = frame({"v": [1.0, 2.0, 3.0, inf, -inf, None], "w": [1.0, 2.0, 4.0, 7.0, 11.0, 16.0]},
               "v double, w double")
    found = {r["column_name"]: r for r in profile.numeric_distribution(df).collect()}
    assert (found["v"]["q1"], found["v"]["median"], found["v"]["q3"]) == (1.0, 2.0, 3.0)
    assert (found["v"]["min"], found["v"]["max"]) == (-inf, inf)
    corr = {(r[0], r[1]): r[2] for r in profile.correlation_matrix(df).collect()}
    assert corr["w", "w"] == 1.0 and corr["v", "w"] is None
    bins = [r for r in visual.histogram(df).collect() if r["column_name"] == "v"]
    assert sum(r["n"] for r in bins) == 5 and {r["lo"] for r in bins} >= {inf, -inf}
    assert {r["column_name"] for r in visual.boxplot_stats(df).collect()} == {"v", "w"}
    assert {r["column_name"] for r in visual.density_curve(df).collect()} == {"v", "w"}


def test_every_numeric_column_has_fences(frame):
    names = [f"c{i:02}" for i in range(14)]
    df = frame({c: [1.0, 2.0, 3.0, 2.0] * 5 + ([900.0] if c == "c13" else [2.0]) for c in names},
               ", ".join(f"{c} double" for c in names))
    out = {r["column_name"]: r["outliers"] for r in visual.outliers_iqr(df).collect()}
    assert set(out) == set(names) and out["c13"] == 1
    assert visual.rows_within_fences(df) < 1


def test_long_values_rank_by_their_whole_text(frame):
    texts = ["z" * 70 + f"{i:03}" for i in (17, 3, 9, 0, 12, 5, 8)] + ["b"]
    found = frequency.top_values(frame({"t": texts}, "t string")).orderBy("rank").collect()
    assert [r["value"] for r in found] == sorted(texts)[:5]
    shown = rules.invalid_examples(frame({"t": texts}, "t string"), {"t": "email"})
    assert [r["example"] for r in shown.orderBy("rank").collect()] == sorted(texts)[:5]
