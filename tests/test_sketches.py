"""Sketches, samples, the missing map and the forest's draws, on any layout of the rows."""
import hashlib
import random

import numpy as np
import pytest

from tablewarden.operators import anomalies, missing_map, sketches


def test_sketches_of_batches_merge_within_the_bound(spark, tmp_path):
    rng = np.random.default_rng(4)
    batches = [rng.normal(0, 1, 4000), rng.exponential(5, 3000), np.full(2000, 3.0)]
    for i, values in enumerate(batches):
        rows = spark.createDataFrame([(float(v), None) for v in values] + [(None, None)], "v double, w double")
        sketches.quantile_sketches(rows).write.parquet(f"file://{tmp_path}/sketches/batch={i}")
    kept = spark.read.schema(sketches.SKETCH_SCHEMA).parquet(f"file://{tmp_path}/sketches")
    merged = sketches.merge_sketches(kept.drop("batch"))
    every = np.sort(np.concatenate(batches))
    probabilities = [0.0, 0.001, 0.1, 0.3, 0.5, 0.77, 0.95, 1.0]
    asked = sketches.sketch_quantiles(merged, probabilities).collect()
    assert len(asked) == len(probabilities) and {r.column_name for r in asked} == {"v"}
    for r in asked:
        below, upto = (np.searchsorted(every, r.value, s) / len(every) for s in ("left", "right"))
        assert below - sketches.RANK_ERROR <= r.probability <= upto + sketches.RANK_ERROR
    row = sketches.approximate_distribution(merged).first()
    assert (row.min, row.max) == (every[0], every[-1]) and row.q1 <= row["median"] <= row.q3
    assert sketches.quantile_sketches(spark.range(0)).count() == 0


def test_value_sample_is_the_least_hashes_of_any_layout(spark):
    rng = random.Random(2)
    values = [f"v{rng.randrange(900)}" for _ in range(3000)] + ["long " * 40 + str(i) for i in range(300)]
    values += ["hot@mail.org"] * 2000 + [None] * 50 + [""]
    counts = {v: values.count(v) for v in {v for v in values if v is not None}}
    first = sorted(counts, key=lambda v: hashlib.sha256(v.encode()).hexdigest())[:500]
    df = spark.createDataFrame([(v, 1) for v in values], "a string, b int")
    for parts in (1, 7):
        found = sketches.value_sample(df.repartition(parts)).collect()
        assert sorted(map(tuple, found)) == sorted(("a", v, counts[v]) for v in first)
    assert sketches.value_sample(df.limit(0)).count() == 0
    ratios = sketches.sampled_ratios(sketches.value_sample(df.filter("a like 'hot%' or a like 'v1%'"), count=5000))
    share = 2000 / sum(n for v, n in counts.items() if v.startswith(("hot", "v1")))
    assert ratios.first()["email"] == round(share, 4)


@pytest.mark.parametrize("parts", [1, 6])
def test_missing_map_numbers_rows_over_tasks(spark, parts):
    rng = random.Random(9)
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, 1]), rng.choice([None, "x"]),
             rng.choice([float("nan"), 2.0])) for _ in range(997)]
    df = spark.createDataFrame(rows, "k int, bucket int, gaps string, v double").repartition(parts)
    found = sorted(map(tuple, missing_map.missing_map(df, ["k"], 10).collect()))
    marks = sorted(
        ((k is not None, k, tuple("01"[g] for g in (k is None, b is None, s is None, v != v)))
         for k, b, s, v in rows), key=lambda r: (r[0], r[1] or 0, r[2]))
    want = []
    for bucket in range(10):
        part = [m for i, (_, _, m) in enumerate(marks) if i * 10 // len(marks) == bucket]
        want += [(bucket, c, len(part), sum(m[j] == "1" for m in part))
                 for j, c in enumerate(("k", "bucket", "gaps", "v"))]
    assert found == sorted(want)
    assert missing_map.missing_map(df.limit(0), ["k"]).count() == 0


def test_thinning_before_the_shuffle_changes_no_draw(spark, monkeypatch):
    data = spark.range(40000).selectExpr(
        "if(id % 3 = 0, -0D, double(id % 9973)) as v0", "if(id % 3 = 0, 1D, rand(1)) as v1")
    data = data.union(spark.sql("select 0D, 1D from range(500)"))
    monkeypatch.setattr(anomalies, "_BUCKET_BITS", 14)
    share = 0.01
    thinned = anomalies._copies(data, share, 5)
    shuffled = anomalies._possible(
        data.selectExpr("v0 + 0D as v0", "v1 + 0D as v1"), anomalies._gap(["v0", "v1"], share, 5), 5)
    assert shuffled.filter("v1 < 1").count() < 0.15 * 40000
    monkeypatch.setattr(anomalies, "_possible", lambda rows, gap, seed: rows)
    whole = anomalies._copies(data, share, 5)
    drawn = sorted(map(tuple, whole.collect()))
    assert sorted(map(tuple, thinned.collect())) == drawn
    hot = sum(r[1] == 1 for r in drawn)
    assert 80 < hot < 200 and 200 < len(drawn) - hot < 340
