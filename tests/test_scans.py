"""How often tables are read, by the event log of a session of its own."""
import json
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tablewarden.operators import visual
from tablewarden.operators.measures import measure, watch
from tablewarden.operators.profile import numbers_of


def test_scans_stay_within_their_budget(small, tmp_path):
    done = subprocess.run(
        [sys.executable, str(Path(__file__).with_name("scans.py")), small, str(tmp_path)],
        capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    counts = json.loads(done.stdout.strip().rpartition("\n")[2])
    assert counts["report"] <= 8
    assert counts["gate_summary"] <= 17  # staged copies and small files included
    assert counts["gate_job"] <= 27


def test_watching_a_write_counts_what_measuring_counts(spark, dirty, tmp_path):
    extra = {"long names": "count_if(length(full_name) > 8)"}
    writing = watch(dirty.repartition(5), extra)
    writing.table.write.parquet(f"file://{tmp_path}/t")
    seen, measured = writing.seen(), measure(dirty, moments=False, extra=extra)
    assert seen == measured and seen.rows == dirty.count() and seen.gaps and seen.extra["long names"]
    empty = watch(dirty.limit(0))
    empty.table.write.parquet(f"file://{tmp_path}/e")
    assert empty.seen().rows == 0 and not empty.seen().moments


def test_measures_of_wide_tables_take_columns_in_parts(spark):
    wide = spark.range(50).selectExpr(*[f"if(id = {i}, null, id * {i}) as c{i}" for i in range(40)])
    known = measure(wide, extra={f"x{i}": f"sum(c{i})" for i in range(90 - 50)})
    assert known.rows == 50 and known.gaps == dict.fromkeys(wide.columns, 1)
    assert known.extra["x3"] == sum(3 * k for k in range(50) if k != 3)
    assert known.moments["c2"]["hi"] == 98 and measure(spark.range(3).select()).rows == 3


def naive_density(values, x, width):
    import math
    return sum(math.exp(-0.5 * ((x - v) / width) ** 2) for v in values) / (
        len(values) * width * math.sqrt(2 * math.pi))


@pytest.mark.parametrize("shape", ["even", "far", "copies"])
def test_binned_density_equals_the_sum_over_all_values(spark, shape):
    rows = spark.range(3000).selectExpr(
        {"even": "rand(5) * 10", "far": "if(id % 500 = 0, 1e5, randn(3))",
         "copies": "double(id % 3)"}[shape] + " as v")
    rows = rows.unionByName(spark.sql("select * from values (null), (double('Infinity')) t(v)"))
    values = [r.v for r in rows.collect() if r.v is not None and abs(r.v) < 1e300]
    known = numbers_of(rows.filter("abs(v) < 1e300")).moments["v"]
    width = known["std"] * known["n"] ** -0.2
    curve = visual.density_curve(rows).collect()
    peak = max(r.density for r in curve)
    assert len(curve) == 200
    for r in curve[::7]:
        want = naive_density(values, r.x, width)
        assert abs(r.density - want) <= 1e-12 * want + 1e-30 * peak


def test_charts_of_one_read_equal_their_own(spark, dirty, small):
    for df in (dirty, spark.read.parquet(f"{small}/lineitem.parquet").select(
            "l_tax", "l_quantity", F.lit(3.0).alias("same"))):
        numbers = numbers_of(df)
        boxes, curve = visual.number_charts(df, numbers)
        assert sorted(boxes.collect()) == sorted(visual.boxplot_stats(df).collect())
        assert sorted((r.column_name, r.x) for r in curve.collect()) == sorted(
            (r.column_name, r.x) for r in visual.density_curve(df).collect())
    nothing = spark.range(0).selectExpr("double(id) as v")
    assert [t.count() for t in visual.number_charts(nothing, numbers_of(nothing))] == [0, 0]
