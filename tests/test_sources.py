import json

import pytest
from pyspark.sql import functions as F

from tablewarden import storage
from tablewarden.operators.facts import column_facts
from tablewarden.operators.metadata import column_metadata
from tablewarden.sources.csv import read_csv, write_csv
from tablewarden.sources.reports import document, read_report, write_report
from tablewarden.sources.synthetic import SHARES, inject_issues, synthetic_customers


def test_csv_types_and_missing_tokens(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(
        'i,f,b,s,mixed,lead,"quo,ted",none\n'
        '1,1.5,True,x,1,01,"a ""b""\nc",NA\n'
        ",nan,false,,£2,02,N/A,null\n"
        "-3,2e3,True,n/a,3,03,z,\n"
    )
    df = read_csv(spark, str(path), multiline=True)
    assert dict(df.dtypes) == {
        "i": "bigint", "f": "double", "b": "boolean", "s": "string", "mixed": "string",
        "lead": "bigint", "quo,ted": "string", "none": "string",
    }
    assert [tuple(r) for r in df.collect()] == [
        (1, 1.5, True, "x", "1", 1, 'a "b"\nc', None),
        (None, None, False, None, "£2", 2, None, None),
        (-3, 2000.0, True, None, "3", 3, "z", None),
    ]


@pytest.mark.parametrize("line", ['1,"first', '"first', '"a ""b"",c', '1,"x,y","', '1,"'])
def test_torn_records_are_refused(spark, tmp_path, line):
    path = tmp_path / "torn.csv"
    path.write_text(f'a,b,c\n5,6,7\n{line}\nsecond",4\n')
    with pytest.raises(ValueError, match="multiline=True"):
        read_csv(spark, str(path))
    assert read_csv(spark, str(path), multiline=True).count() == 2


def test_quotes_within_lines_are_no_torn_records(spark, tmp_path):
    path = tmp_path / "whole.csv"
    path.write_text('a,b\n"""said""",5" pipe\n"x, ""y""",""\n"","z"\n"""","p"\n')
    assert [tuple(r) for r in read_csv(spark, str(path)).collect()] == [
        ('"said"', '5" pipe'), ('x, "y"', None), (None, "z"), ('"', "p")]
    (tmp_path / "semi.csv").write_text('a;b\n"""q"";"""; 1,"\n')
    assert read_csv(spark, str(tmp_path / "semi.csv"), sep=";").count() == 1


def test_csv_roundtrip(spark, dirty, tmp_path):
    path = str(tmp_path / "out")
    write_csv(dirty, path)
    back = read_csv(spark, path)
    assert back.count() == dirty.count()
    assert sorted(r[0] for r in back.select("region").collect()) == sorted(
        r[0] for r in dirty.select("region").collect()
    )


def test_report_roundtrip(spark, dirty, tmp_path):
    table = column_metadata(column_facts(dirty))
    write_report({"metadata": table}, str(tmp_path))
    schema = ", ".join(f"{c} {t}" for c, t in table.dtypes)
    back = read_report(spark, str(tmp_path), "metadata", schema)
    assert sorted(back.collect()) == sorted(table.collect())
    assert len(json.loads(document(table).first()[0])) == len(dirty.columns)


def test_synthetic_customers_do_not_depend_on_layout(spark):
    keys = spark.range(5000)
    a = inject_issues(synthetic_customers(keys, "id"))
    b = inject_issues(synthetic_customers(keys.repartition(7), "id"))
    assert a.exceptAll(b).count() == 0 and len(a.columns) == 16


def test_planted_shares(spark):
    n = 20000
    df = inject_issues(synthetic_customers(spark.range(n), "id"))
    unique = df.dropDuplicates()
    assert abs(df.count() / n - 1 - SHARES["duplicate"]) < 0.01
    row = unique.select(
        F.avg(F.col("email").isNull().cast("int")),
        F.avg(F.col("monthly_charges").startswith("£").cast("int")),
        F.avg((F.col("nps_score") > 10).cast("int")),
        F.avg((~F.col("install_date").rlike(r"^\d{4}-")).cast("int")),
    ).first()
    wanted = (SHARES["null_email"] * (1 - SHARES["bad_email"]), SHARES["currency"],
              SHARES["bad_score"], SHARES["date_shape"])
    assert all(abs(a - b) < 0.01 for a, b in zip(row, wanted))


def test_stage_writes_to_the_shared_folder(spark, frame, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "shared_folder", lambda spark: str(tmp_path))
    df = frame({"a": [1, 2], "b c": ["x", None]}, "a int, `b c` string")
    again = storage.stage(df, "probe")
    assert sorted(map(str, again.collect())) == sorted(map(str, df.collect()))
    assert any((tmp_path / "tablewarden").iterdir())


def test_staged_copies_are_discarded(spark, frame, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "shared_folder", lambda spark: str(tmp_path))
    storage.stage(frame({"a": [1]}, "a int"), "probe")
    storage.discard(spark)
    assert not any((tmp_path / "tablewarden").iterdir())


def test_large_csv_is_read_by_many_tasks(spark, tmp_path):
    path = str(tmp_path / "large")
    write_csv(spark.range(200_000).selectExpr("id", "id * 7 as n").coalesce(1), path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        df = read_csv(spark, path)
        assert df.rdd.getNumPartitions() > 4 and df.count() == 200_000
        assert read_csv(spark, path, multiline=True).rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
