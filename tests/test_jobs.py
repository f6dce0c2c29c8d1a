import sys

import pytest

from tablewarden import __main__ as command
from tablewarden.plans.jobs import (
    clean_job, find_input, gate_job, profile_job, read_input, stored_profile,
)
from tablewarden.sources.csv import write_csv


def rows(spark, path):
    return spark.read.json(path).collect()


def test_gate_job_on_csv(spark, dirty, tmp_path):
    source, output = str(tmp_path / "in.csv"), str(tmp_path / "out")
    write_csv(dirty, source)
    gate_job(spark, source, output, as_csv=True)
    assert stored_profile(spark, output)["email"]["semantic_type"] == "email"
    dedup = rows(spark, f"{output}/cleaning/dedup")[0]
    cleaned = spark.read.parquet(f"{output}/cleaned")
    assert dedup["rows_after"] == cleaned.count() and dedup["exact_duplicates_removed"] > 0
    assert spark.read.csv(f"{output}/cleaned_csv", header=True).count() == cleaned.count()
    scores = rows(spark, f"{output}/cleaning/scores")[0]
    assert scores["quality_after"] >= scores["quality_before"]
    health = rows(spark, f"{output}/validation/health")[0]
    assert 0 < health["health_score"] <= 100
    checks = {(r["column_name"], r["check"]) for r in rows(spark, f"{output}/validation/checks")}
    assert {("email", "email"), ("nps_score", "range"), ("tenure_months", "negatives")} <= checks


@pytest.mark.parametrize("way", ["gate", "apart", "command"])
def test_jobs_keep_quoted_line_breaks(spark, tmp_path, monkeypatch, way):
    source, output = str(tmp_path / "in.csv"), str(tmp_path / "out")
    with open(source, "w") as f:
        f.write("id,note\n" + "".join(f'{i},"first {i}\nsecond, {i}"\n' for i in range(30)))
    if way == "gate":
        gate_job(spark, source, output, as_csv=True, charts=False, multiline=True)
    elif way == "apart":
        profile_job(spark, source, output, charts=False, multiline=True)
        clean_job(spark, source, output, as_csv=True, multiline=True)
    else:
        monkeypatch.setattr(
            sys, "argv", ["tablewarden", source, output, "--multiline", "--csv", "--no-figures"])
        command.main()
    cleaned = spark.read.parquet(f"{output}/cleaned")
    want = {(i, f"first {i}\nsecond, {i}") for i in range(30)}
    assert set(map(tuple, cleaned.select("id", "note").collect())) == want
    again = read_input(spark, f"{output}/cleaned_csv", "csv", multiline=True)
    assert set(map(tuple, again.select("id", "note").collect())) == want


def test_inputs_are_found(spark, tmp_path):
    for name, row in (("b.csv", "2,two"), ("a.csv", "1,one"), ("notes.txt", "no table")):
        (tmp_path / "raw").mkdir(exist_ok=True)
        (tmp_path / "raw" / name).write_text(f"id,word\n{row}\n")
    table = spark.createDataFrame([(3, "three"), (4, "four")], "id long, word string").repartition(2)
    write_csv(table, str(tmp_path / "parts"))
    table.write.parquet(str(tmp_path / "stored"))
    table.write.partitionBy("id").parquet(str(tmp_path / "by_id"))

    def ids(path):
        return sorted(r["id"] for r in read_input(spark, str(tmp_path / path)).collect())

    assert ids("raw") == [1] and ids("raw/b.csv") == [2] and ids("raw/*.csv") == [1, 2]
    assert ids("parts") == [3, 4] and ids("stored") == [3, 4] and ids("by_id") == [3, 4]
    assert find_input(spark, str(tmp_path / "nothing")) == (str(tmp_path / "nothing"), "parquet")
