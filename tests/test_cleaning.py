import datetime

import pytest
from pyspark.sql import functions as F

from tablewarden.functions import fixed
from tablewarden.functions.dates import clean_date
from tablewarden.functions.text import matches, unify_yes_no
from tablewarden.operators.facts import column_facts
from tablewarden.operators.impute import impute
from tablewarden.operators.metadata import profile_of
from tablewarden.operators.normalise import (
    change_samples, changes_of, normalise, numbers_from_text,
)
from tablewarden.operators.quality import (
    dedup_log, drop_duplicates, drop_duplicates_in_place, quality_score,
)
from tablewarden.plans.clean import clean_scores, clean_table


def values(df, expression):
    return [r[0] for r in df.selectExpr(expression).collect()]


def test_clean_table_scores_100(frame):
    df = frame({"a": [8, 6, 4, 2], "b": ["k", "l", "m", "n"]}, "a int, b string")
    assert quality_score(df).first()["score"] == 100.0
    assert quality_score(df, {}).first()["score"] == 100.0


def test_profile_lowers_score(frame):
    df = frame({"email": ["q@r.org", "q.r.org", "s@t.org", "u@v.org"]}, "email string")
    scored = quality_score(df, {"email": {"semantic_type": "email"}}).first()
    assert scored["score"] == 92.5
    assert quality_score(df).first()["score"] == 100.0


def test_missing_and_duplicates_lower_score(frame):
    df = frame({"a": [7, 7, None, 3], "b": ["u", "u", "w", "v"]}, "a int, b string")
    row = quality_score(df).first()
    assert row["score"] == pytest.approx(100 * (0.7 * 7 / 8 + 0.3 * 3 / 4), abs=0.01)


def test_score_of_empty_table_is_null(spark):
    assert quality_score(spark.createDataFrame([], "a int, b string")).first()["score"] is None


def test_exact_duplicates(frame):
    long = "x" * 500
    df = frame({"a": [1.0, 1.0, float("nan"), None, 2.0], "b": ["x", "x", None, None, long]},
               "a double, b string")
    assert drop_duplicates(df).count() == 3
    assert tuple(dedup_log(df).first()) == (2, 5, 3)
    once = drop_duplicates(df)
    assert tuple(dedup_log(once).first()) == (0, 3, 3)


def test_duplicates_in_place_equal_the_plain_ones(frame):
    nan, long = float("nan"), "y" * 3000
    df = frame({"digest": [1.5, 1.5, nan, None, -0.0, 0.0, 7.0, 8.0, 8.0, 8.0],
                "text": ["p", "p", None, None, "z", "z", long, long, long, ""],
                "list": [[1], [1], None, None, [2], [2], [3], [], [], [None]]},
               "digest double, text string, list array<int>").repartition(3)

    def rows(table):
        return sorted((tuple(r) for r in table.collect()), key=repr)

    want = rows(drop_duplicates(df))
    for most in (0, 3, 1000):
        found = drop_duplicates_in_place(df, most)
        assert found.columns == df.columns and len(want) == 6
        assert [str(r).replace("-0.0", "0.0") for r in rows(found)] == [
            str(r).replace("-0.0", "0.0") for r in want]
    assert drop_duplicates_in_place(df.limit(0)).count() == 0


def test_rows_without_an_equal_stay_in_place(spark):
    """A third of the rows are one row; of 2,001 others none moves."""
    df = spark.range(3000).selectExpr("if(id % 3 = 0, -1, id) as id", "repeat('w', 100) as w")
    found = drop_duplicates_in_place(df)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    alone, others = plan.index("LeftAnti"), plan.index("LeftSemi")
    assert plan.count("Aggregate") == 1 and alone < plan.index("Aggregate") < others
    assert found.count() == 2001 and found.filter("id = -1").count() == 1


def test_rows_that_differ_only_in_where_nulls_are(frame):
    df = frame({"a": [None, "x"], "b": ["x", None]}, "a string, b string")
    assert tuple(dedup_log(df).first()) == (0, 2, 2)


def test_long_texts_differing_at_the_end(frame):
    df = frame({"a": ["x" * 1000 + "1", "x" * 1000 + "2"]}, "a string")
    assert tuple(dedup_log(df).first()) == (0, 2, 2)


def test_currency(frame):
    df = frame({"c": ["£3.05", "71.2", "€2,318.40", " $ 8 ", "15%", "2d", "3_0", "w", None]}, "c string")
    assert values(df, numbers_from_text("c")) == [3.05, 71.2, 2318.4, 8.0, None, None, None, None, None]


def test_yes_no(frame):
    df = frame({"c": ["y", "YES", " 1 ", "true", "n", "NO", "False", "0", "perhaps", None]}, "c string")
    assert values(df, unify_yes_no("c")) == ["Yes"] * 4 + ["No"] * 4 + ["perhaps", None]


def test_dates(frame):
    texts = ["2024-12-05", "03/04/2023", "25/12/2023", "Nov 2023", "nov 2023", "November 2023",
             "31/02/2023", "5-6-2024", "2024/6/5", "5 June 2024", " 2024-12-05 ", "2024-12-05 10:30:15",
             "June 5", "", None]
    day = datetime.datetime
    assert values(frame({"c": texts}, "c string"), clean_date("c")) == [
        day(2024, 12, 5), day(2023, 4, 3), day(2023, 12, 25), day(2023, 11, 1), day(2023, 11, 1),
        None, None, day(2024, 6, 5), day(2024, 6, 5), day(2024, 6, 5), day(2024, 12, 5),
        day(2024, 12, 5, 10, 30, 15), None, None, None,
    ]


def test_strict_phone_pattern(frame):
    df = frame({"c": ["0790011223", "07900112233", "+447900112233"]}, "c string")
    assert values(df, matches("c", fixed.PHONE_STRICT)) == [False, True, True]


def test_phone_is_flagged_not_converted(frame):
    df = frame({"phone": ["07900112233", "0790", "07555666777", None]}, "phone string")
    result, log = normalise(
        df, {"phone": {"inferred_type": "numeric_as_text", "semantic_type": "phone"}}
    )
    assert [r[0] for r in result.collect()] == ["07900112233", "INVALID_PHONE", "07555666777", None]
    assert tuple(log.first()) == ("phone", "invalid_phone_flag", 1)


def test_samples_show_values_before_and_after(frame):
    df = frame({"c": ["n", "yes", "n", None, "Y"], "d": ["a", "b", "c", "d", "e"]}, "c string, d string")
    rows = change_samples(df, changes_of(df)).orderBy("rank").collect()
    assert [tuple(r) for r in rows] == [
        ("c", 1, "Y", "Yes"), ("c", 2, "n", "No"), ("c", 3, "yes", "Yes")]


def test_one_side_of_yes_no_is_enough(frame):
    result, log = normalise(frame({"c": ["y", "Yes", None]}, "c string"))
    assert [r[0] for r in result.collect()] == ["Yes", "Yes", None]
    assert tuple(log.first()) == ("c", "yes_no_spelling", 1)


def test_normalise_leaves_the_rest_alone(frame):
    df = frame({"region": ["WILTSHIRE", " Wiltshire "], "n": [1, 2]}, "region string, n int")
    result, log = normalise(df, profile_of(column_facts(df)))
    assert result.collect() == df.collect() and log.count() == 0


def test_impute_by_type(frame):
    df = frame({"a": [1.0, None, 3.0], "b": ["x", None, "x"]}, "a double, b string")
    filled, log = impute(df)
    assert [tuple(r) for r in filled.collect()] == [(1.0, "x"), (2.0, "x"), (3.0, "x")]
    assert [tuple(r) for r in log.collect()] == [
        ("a", 1, "median", "2.0000"), ("b", 1, "mode", "x"),
    ]


def test_impute_by_profile(frame):
    df = frame(
        {"flag": [1, 1, 0, None], "day": ["2024-01-01", None, None, None],
         "none": [None] * 4, "n": [1, 2, None, None]},
        "flag int, day string, none string, n int",
    )
    filled, log = impute(df, profile_of(column_facts(df)))
    assert {r["column_name"]: (r["action"], r["fill_value"]) for r in log.collect()} == {
        "flag": ("mode", "1"), "day": ("skipped_datetime", None),
        "none": ("skipped_no_value", None), "n": ("median", "1.5000"),
    }
    assert filled.filter("flag is null or n is null").count() == 0
    assert filled.filter("n = 1.5").count() == 2


def test_impute_can_skip_meanings(frame):
    df = frame({"email": ["a@b.com", "a@b", None]}, "email string")
    known = {"email": {"inferred_type": "text", "semantic_type": "email"}}
    assert impute(df, known)[0].filter("email is null").count() == 0
    assert impute(df, known, skip_semantic=("email",))[0].filter("email is null").count() == 1


def test_pipeline(dirty):
    known = profile_of(column_facts(dirty))
    cleaned = clean_table(dirty, known)
    assert cleaned.table.count() == cleaned.dedup_log.first()["rows_after"]
    assert dict(cleaned.table.dtypes)["monthly_charges"] == "double"
    assert dict(cleaned.table.dtypes)["install_date"] == "timestamp_ntz"
    assert {r[0] for r in cleaned.table.select("churn").distinct().collect()} == {"Yes", "No"}
    row = clean_scores(dirty, cleaned, known).first()
    assert row["quality_before"] <= row["quality_after"] <= 100


def test_pipeline_does_not_depend_on_layout(dirty):
    known = profile_of(column_facts(dirty))
    order = ["customer_id", "email"]
    want = clean_table(dirty, known).table.orderBy(*order).collect()
    other = dirty.repartition(5, F.rand(3))
    assert clean_table(other, known).table.orderBy(*order).collect() == want
