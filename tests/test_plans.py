"""What the physical plans must and must not contain."""
from pyspark.sql import functions as F

from tablewarden.operators import checks, columns, frequency, profile, quality
from tablewarden.operators.facts import column_facts, present_counts
from tablewarden.sources.tables import read_table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_counts_need_no_value_shuffle(spark, small):
    lineitem = read_table(spark, small, "lineitem")
    for df in (
        present_counts(lineitem),
        profile.missing_overall(lineitem),
        checks.run_checks(lineitem, [checks.Check("l_tax", "range", 0.0, 0.05)]),
    ):
        text = plan(df)
        assert "hashpartitioning" not in text and "CartesianProduct" not in text


def test_checks_read_only_their_columns(spark, small):
    lineitem = read_table(spark, small, "lineitem")
    text = plan(checks.run_checks(lineitem, [checks.Check("l_tax", "negatives")]))
    assert "ReadSchema: struct<l_tax:double>" in text


def test_top_values_are_cut_before_the_shuffle(spark, small):
    cells = columns.cells(read_table(spark, small, "orders"), ["o_orderstatus"], "string")
    counted = frequency.text_frequencies(cells)
    text = plan(frequency.first_per_column(counted, 5, F.desc("n"), F.asc("head")))
    assert "row_number(), 5, Partial" in text


def test_no_python_and_no_cross_join_in_profiles(spark, small):
    documents = read_table(spark, small, "documents")
    for df in (column_facts(documents), frequency.top_values(documents), quality.dedup_log(documents)):
        text = plan(df)
        assert "ArrowEvalPython" not in text and "BatchEvalPython" not in text
        assert "CartesianProduct" not in text and "NestedLoop" not in text
        assert "SortAggregate" not in text


def test_long_texts_stay_out_of_the_shuffle(spark, small):
    documents = read_table(spark, small, "documents").select("text")
    grouped = frequency.text_frequencies(
        documents.select(F.lit("text").alias("column_name"), F.col("text").alias("value"))
    )
    rows = grouped.select(F.max(F.length("head")), F.max(F.length("digest"))).first()
    assert tuple(rows) == (64, 64)
