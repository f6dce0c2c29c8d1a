import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tablewarden.operators import anomalies, checks
from tablewarden.operators.anomalies import anomaly_counts, detect_anomalies
from tablewarden.operators.facts import column_facts
from tablewarden.operators.health import health_score
from tablewarden.operators.metadata import profile_of
from tablewarden.plans.gate import gate_summary
from tablewarden.plans.validate import anomaly_summary, build_contract, validate_table


def results(df, wanted):
    return {(r["column_name"], r["check"]): tuple(r)[2:] for r in checks.run_checks(df, wanted).collect()}


def test_email_check_by_name(frame):
    df = frame({"Work_Email": ["a@b.com", "bad", " a@b.com", None]}, "Work_Email string")
    assert results(df, checks.email_checks(df)) == {("Work_Email", "email"): (3, 1, 2)}


def test_formats_by_meaning(frame):
    df = frame({"c": ["OX1 2AB", "ABCDE", None], "d": ["07123456789", "0712345678", "x"]},
               "c string, d string")
    known = {"c": {"semantic_type": "postcode"}, "d": {"semantic_type": "phone"}}
    assert results(df, checks.format_checks(df, known)) == {
        ("c", "postcode"): (2, 1, 1), ("d", "phone"): (3, 1, 2),
    }


def test_range_uses_raw_bounds_and_falls_back(frame):
    raw = frame({"a": [1, 5], "t": ["1", "2"]}, "a int, t string")
    cleaned = frame({"a": [0, 3, 9, None], "t": [1.0, 2.0, 50.0, None]}, "a int, t double")
    found = results(cleaned, checks.range_checks(cleaned, checks.numeric_bounds(raw)))
    assert found == {("a", "range"): (3, 1, 2), ("t", "range"): (3, 3, 0)}


def test_negatives_only_when_a_minority(frame):
    few = [-1] + [1] * 19
    many = [-1] * 2 + [1] * 18
    df = frame({"few": few, "many": many, "none": [1] * 20}, "few int, many int, none int")
    assert results(df, checks.negative_checks(df)) == {("few", "negatives"): (20, 19, 1)}


def test_membership(frame):
    old = frame({"c": ["a", "b", None] * 10, "d": [str(i) for i in range(30)]}, "c string, d string")
    known = profile_of(column_facts(old))
    assert checks.low_cardinality(known) == ["c"]
    allowed = checks.allowed_values(old, ["c"])
    new = frame({"c": ["a", "z", None, "O'Neil \\ x"]}, "c string")
    assert results(new, checks.membership_checks(allowed)) == {("c", "membership"): (3, 1, 2)}


def test_membership_with_many_categories(frame):
    old = frame({"c": [f"v{i}" for i in range(40)] * 30}, "c string")
    assert checks.low_cardinality(profile_of(column_facts(old))) == ["c"]
    allowed = checks.allowed_values(old, ["c"])
    new = frame({"c": ["v1", "v39", "v40", "long " * 40]}, "c string")
    assert results(new, checks.membership_checks(allowed)) == {("c", "membership"): (4, 2, 2)}


def test_infinite_values_are_checked(frame):
    df = frame({"v": [1.0, float("inf"), -float("inf"), None]}, "v double")
    bounds = checks.numeric_bounds(df)
    assert results(df, checks.range_checks(df, bounds)) == {("v", "range"): (3, 3, 0)}


def test_contract_survives_storage(spark, dirty, tmp_path):
    known = profile_of(column_facts(dirty))
    contract = build_contract(dirty, known, checks.numeric_bounds(dirty))
    path = str(tmp_path / "contract")
    checks.contract_table(spark, contract).write.parquet(path)
    allowed = checks.allowed_of(spark, contract)
    again = checks.read_contract(spark.read.parquet(path), allowed)
    plain = lambda c: (c.column, c.check, c.lower, c.upper, c.allowed is None)
    assert sorted(map(plain, again)) == sorted(map(plain, contract))


def test_health_score(frame):
    table = frame({"invalid": [30, 0], "checked": [100, 100]}, "invalid bigint, checked bigint")
    row = health_score(table, 0.95).first()
    assert (row["pass_rate"], row["health_score"]) == (0.85, 88.0)
    assert health_score(table.filter("false"), None).first()["health_score"] == 100.0


def test_scores_round_half_up_on_ties(frame):
    table = frame({"invalid": [7], "checked": [400]}, "invalid bigint, checked bigint")
    assert health_score(table, 0.96).first()["health_score"] == 97.58


@pytest.fixture(scope="module")
def planted(spark):
    normal = spark.range(2000).select(
        F.randn(1).alias("x"), F.randn(2).alias("y"), F.col("id").cast("string").alias("label")
    )
    far = spark.createDataFrame([(40.0, -35.0, "far"), (-50.0, 60.0, "far")], "x double, y double, label string")
    return normal.union(far).coalesce(1)


def test_far_points_score_highest(planted):
    flagged, threshold = detect_anomalies(planted)
    rows = flagged.orderBy(F.desc("anomaly_score")).limit(2).collect()
    assert {r["label"] for r in rows} == {"far"}
    counts = anomaly_counts(flagged).first()
    assert counts["rows_scored"] == 2002 and abs(counts["anomaly_pct"] - 5) < 0.1
    assert 0 < threshold < 1


def test_forest_does_not_depend_on_layout(planted):
    layouts = [planted, planted, planted.repartition(7), planted.orderBy("x").coalesce(2)]
    results = [
        sorted(map(tuple, detect_anomalies(df)[0].select("x", "y", "anomaly_score", "is_anomaly")
                   .collect()))
        for df in layouts
    ]
    assert all(r == results[0] for r in results)


def test_forest_code_needs_no_package_on_executors(tmp_path):
    code = cloudpickle.dumps(anomalies._grow)
    (tmp_path / "grow.pkl").write_bytes(code)
    check = (
        "import sys, numpy as np; from pyspark import cloudpickle;"
        "grow = cloudpickle.loads(open('grow.pkl', 'rb').read());"
        "print(len(grow(np.arange(8.0).reshape(4, 2), 3, np.random.default_rng(0))));"
        "assert 'tablewarden' not in sys.modules"
    )
    done = subprocess.run([sys.executable, "-c", check], cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) == 7


def test_forest_skips_incomplete_rows_and_tables(frame):
    df = frame({"x": [1.0, None, 2.0], "y": [1, 2, 3]}, "x double, y int")
    assert anomaly_counts(detect_anomalies(df)[0]).first()["rows_scored"] == 2
    none = frame({"t": ["a"]}, "t string")
    assert anomaly_counts(detect_anomalies(none)[0]).first()["rows_scored"] == 0
    assert anomaly_summary(none)[1] is None


def test_validate_table(demo_customers):
    known = profile_of(column_facts(demo_customers))
    validation = validate_table(demo_customers, known, checks.numeric_bounds(demo_customers))
    found = {(r["column_name"], r["check"]): r["invalid"] for r in validation.results.collect()}
    assert found[("email", "email")] == 2 and found[("postcode", "postcode")] == 2
    assert validation.health.first()["health_score"] <= 100


def test_gate_summary(dirty):
    row = gate_summary(dirty).first()
    assert row["rows_before"] - row["rows_after"] == row["exact_duplicates_removed"] > 0
    assert 0 < row["health_score"] <= 100


def test_forest_samples_rows_not_distinct_values(spark):
    ties = spark.range(100_000).selectExpr("cast(id % 11 as double) as v0")
    forest = anomalies.fit_forest(ties, ["v0"])
    grown = forest["child"].any(axis=1)
    assert grown.all()
    picked = anomalies._samples(ties, 100_000, 100, 256, 7).groupBy("tree", "v0").count().collect()
    assert len({r["tree"] for r in picked}) == 100
    assert sum(r["count"] for r in picked) == 100 * 256
    share = sum(r["count"] for r in picked if r["v0"] == 3) / 25_600
    assert abs(share - 1 / 11) < 0.02

    hot = spark.range(300_000).selectExpr("if(id % 3 = 0, -1D, cast(id as double)) as v0")
    picked = anomalies._samples(hot, 300_000, 100, 256, 7)
    assert abs(picked.filter("v0 = -1").count() / 25_600 - 1 / 3) < 0.03
    spread = anomalies._samples(hot.repartition(7), 300_000, 100, 256, 7)
    assert picked.exceptAll(spread).isEmpty() and picked.count() == spread.count() == 25_600
