import pytest

from tablewarden.operators import metadata, rules
from tablewarden.operators.facts import column_facts


def classified(df):
    return {r["column_name"]: r for r in metadata.classify(column_facts(df)).collect()}


def of(frame, values, schema="c string"):
    return classified(frame({"c": values}, schema))[schema.split()[0]]


@pytest.mark.parametrize(
    "values, schema, expected",
    [
        ([None, None, None], "c string", "empty"),
        (["£6.10", "£17.85", "£240.00"], "c string", "numeric_as_text"),
        ([1, 0, 1], "c int", "boolean"),
        ([1, 2, 0], "c int", "integer"),
        ([1.0, 0.0], "c double", "float"),
        ([float("nan")] * 2, "c double", "empty"),
        ([True, False], "c boolean", "boolean"),
        (["Yes", "no", "Y"], "c string", "boolean"),
        (["Yes", "no", "Y", "N"], "c string", "categorical"),
        (["2024-12-05", "03/04/2023", "Nov 2023"], "c string", "datetime"),
        (["2024-12-05 10:30", "5 December 2024", "December 2024"], "c string", "datetime"),
        (["31/02/2023", "99/99/2023"], "c string", "categorical"),
        ([f"word {i} x" for i in range(21)], "c string", "text"),
        ([f"word {i % 20} x" for i in range(21)], "c string", "categorical"),
        ([[1], [2]], "c array<int>", "nested"),
    ],
)
def test_inferred_type(frame, values, schema, expected):
    assert of(frame, values, schema)["inferred_type"] == expected


def test_threshold_is_inclusive(frame):
    four_of_five = ["a@x.com"] * 4 + ["bad"]
    assert of(frame, four_of_five)["semantic_type"] == "email"
    assert of(frame, ["a@x.com"] * 3 + ["bad", "bad"])["semantic_type"] == "categorical"


@pytest.mark.parametrize(
    "name, values, expected",
    [
        ("contact", [f"k.{i}x@post.net" for i in range(7, 19)], "email"),
        ("c", ["07123456789", "+447123456789", "0712345678"], "phone"),
        ("c", ["ox1 2ab", "SN25 4DQ", "CB1 3AA"], "postcode"),
        ("c", ["Direct Debit", "Credit Card"], "person_name"),
        ("user_c", ["Direct Debit", "Credit Card"], "categorical"),
        ("code", ["x1", "x2", "x3"], "identifier"),
        ("paid", ["x1", "x2", "x3"], "identifier"),
        ("member_no", ["x1", "x1", "x3"], "categorical"),
        ("c", [None], "unknown"),
    ],
)
def test_semantic_type(frame, name, values, expected):
    assert of(frame, values, f"{name} string")["semantic_type"] == expected


def test_unicode_spaces_are_spaces(frame):
    # A no-break space inside an address makes it invalid; around it, it is trimmed.
    assert of(frame, ["a b@x.com"])["n_email"] == 0
    assert of(frame, [" a@x.com "])["n_email"] == 1


def test_long_values_are_tested_whole(frame):
    name = " ".join(["word"] * 20000)
    email = "a" * 5000 + "@x.com"
    row = of(frame, [name, name + " 1", email, email + " "])
    assert (row["n_person_name"], row["n_email"], row["n_unique"]) == (1, 2, 4)


def test_mixed_types(frame):
    df = frame({"c": ["16.10", "£17.85", "84.00"], "n": [1, 2, 3]}, "c string, n int")
    rows = {r["column_name"]: r for r in metadata.mixed_types(df, column_facts(df)).collect()}
    assert rows["c"]["is_mixed"] and rows["c"]["kinds"] == "number|string"
    assert (rows["c"]["example_number"], rows["c"]["example_string"]) == ("16.10", "£17.85")
    assert not rows["n"]["is_mixed"] and rows["n"]["kinds"] == "number"


def test_demo_customers(demo_customers):
    rows = classified(demo_customers)
    got = {c: (r["inferred_type"], r["semantic_type"], r["is_mixed"]) for c, r in rows.items()}
    assert got == {
        "customer_id": ("integer", "identifier", False),
        "email": ("categorical", "email", False),
        "postcode": ("categorical", "postcode", True),
        "monthly_charges": ("numeric_as_text", "numeric", True),
        "nps_score": ("integer", "numeric", False),
        "churn": ("categorical", "categorical", True),
    }
    facts = column_facts(demo_customers)
    pii = {r["column_name"] for r in rules.pii_columns(facts).collect()}
    assert pii == {"customer_id", "email", "postcode"}
    suspicious = {r["column_name"]: r["reasons"] for r in rules.suspicious_columns(facts).collect()}
    assert suspicious == {
        "customer_id": "high_cardinality",
        "email": "high_cardinality",
        "postcode": "mixed_types|high_cardinality",
        "monthly_charges": "mixed_types",
        "churn": "mixed_types",
    }
    invalid = {
        r["column_name"]: (r["invalid_count"], r["invalid_pct"])
        for r in rules.invalid_formats(facts).collect()
    }
    assert invalid == {"email": (2, 20.0), "postcode": (2, 20.0)}


def test_demo_sales(demo_sales):
    rows = classified(demo_sales)
    got = {c: (r["inferred_type"], r["semantic_type"]) for c, r in rows.items()}
    assert got == {
        "order_id": ("categorical", "identifier"),
        "product": ("categorical", "categorical"),
        "quantity": ("integer", "numeric"),
        "unit_price": ("float", "numeric"),
        "order_date": ("datetime", "date"),
    }
    suspicious = {
        r["column_name"] for r in rules.suspicious_columns(column_facts(demo_sales)).collect()
    }
    assert suspicious == {"order_id", "quantity", "order_date"}


def test_result_does_not_depend_on_layout(dirty):
    want = sorted(map(str, classified(dirty).values()))
    for other in (dirty.repartition(7), dirty.orderBy("email"), dirty.coalesce(1)):
        assert sorted(map(str, classified(other).values())) == want


def test_awkward_column_names(frame):
    df = frame({"a": ["x"], "b": [1]}, "a string, b int").toDF("we.ird `name'", "b c")
    assert set(classified(df)) == {"we.ird `name'", "b c"}


def test_empty_table(spark):
    df = spark.createDataFrame([], "a string, b int, c array<int>")
    assert {r["inferred_type"] for r in classified(df).values()} == {"empty"}
