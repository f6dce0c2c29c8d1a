import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oracle_check import session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return session(4)


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def frame(spark):
    """frame({"a": [1, None]}, "a int") -> DataFrame"""
    def make(data: dict, schema: str):
        rows = list(zip(*data.values()))
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture(scope="session")
def dirty(spark):
    from tablewarden.sources.dirty import dirty_customers

    return dirty_customers(spark, SMALL)


@pytest.fixture(scope="session")
def demo_customers(frame):
    return frame(
        {
            "customer_id": [71, 72, 75, 78, 80, 83, 84, 88, 90, 97],
            "email": ["ruth@post.net", "missing.sign.net", "k.lund@firm.org", "ola@firm.org",
                      "pia @gap.net", "sam@post.net", "tove@lake.fi", "uma@lake.fi", "v@post.net",
                      "wim@dike.nl"],
            "postcode": ["LS2 9JT", "90210", "EH8 9YL", "M13 9PL", "none", "B15 2TT", "NE1 7RU",
                         "S10 2TN", "G12 8QQ", "CF10 3AT"],
            "monthly_charges": ["12.50", "£7.25", "19.00", "12.50", "31.75", "7.25", "19.00",
                                "£31.75", "8.40", "8.40"],
            "nps_score": [3, 5, 12, 4, None, 9, 1, 8, 7, 5],
            "churn": ["No", "yes", "N", "Yes", "Y", "No", "Yes", "0", "Yes", "1"],
        },
        "customer_id bigint, email string, postcode string, monthly_charges string,"
        " nps_score bigint, churn string",
    )


@pytest.fixture(scope="session")
def demo_sales(frame):
    return frame(
        {
            "order_id": [f"S/{i}" for i in (104, 107, 111, 120, 133)],
            "product": ["lamp", "rug", "lamp", "vase", "rug"],
            "quantity": [6, 2, 9, 1, 7],
            "unit_price": [18.2, 74.0, 18.2, 33.35, 74.0],
            "order_date": [f"2025-03-1{i}" for i in (1, 2, 4, 7, 8)],
        },
        "order_id string, product string, quantity bigint, unit_price double, order_date string",
    )
