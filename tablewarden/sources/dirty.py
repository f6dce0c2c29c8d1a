"""A customer table with planted faults, derived from the ``customer`` table.

Faults follow from the customer key by arithmetic, so the table grows with its
source and any engine can derive the same rows.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .tables import read_table


def _pick(index: str, *values: str) -> str:
    return f"element_at(array({', '.join(repr(v) for v in values)}), cast({index} as int) + 1)"


def _two(number: str) -> str:
    return f"lpad(cast({number} as string), 2, '0')"


_K = "c_custkey"
_YEAR = f"cast(20 + {_K} % 6 as string)"
_MONTH, _DAY = _two(f"1 + {_K} % 12"), _two(f"1 + {_K} % 28")
_MONTH_NAME = f"case 1 + {_K} % 12 when 3 then 'Mar' when 7 then 'Jul' when 11 then 'Nov' else 'Jan' end"
_CHARGE = f"concat(cast(29 + {_K} % 36 as string), '.', {_two(f'{_K} % 100')})"
_POSTCODE = (
    f"concat({_pick(f'{_K} % 4', 'OX', 'GL', 'SN', 'RG')}, 1 + {_K} % 49, ' ', 1 + {_K} % 9, 'AB')"
)

_FAULTY = {
    "customer_id": f"{_K} + 10000",
    "full_name": f"concat({_pick(f'{_K} % 5', 'James', 'Olivia', 'Harry', 'Isla', 'Noah')}, ' ',"
    f" {_pick(f'{_K} % 3', 'Smith', 'Patel', 'Hall')})",
    "email": f"case when {_K} % 17 = 3 then null"
    f" when {_K} % 25 = 4 then {_pick(f'{_K} % 3', 'john.smith', 'no-at-sign.com', 'a@b')}"
    f" else concat('user', {_K}, '@example.com') end",
    "phone": f"case when {_K} % 33 = 5 then {_pick(f'{_K} % 2', '123', '07xx')}"
    f" else concat('07', lpad(cast(({_K} * 7919) % 1000000000 as string), 9, '0')) end",
    "postcode": f"case when {_K} % 20 = 7 then null"
    f" when {_K} % 33 = 9 then {_pick(f'{_K} % 2', '12345', 'ABCDE')} else {_POSTCODE} end",
    "region": f"case {_K} % 20 when 3 then 'wiltshire' when 4 then '  Wiltshire '"
    " when 5 then 'HAMPSHIRE' else"
    f" {_pick(f'{_K} % 4', 'Oxfordshire', 'Wiltshire', 'Hampshire', 'Berkshire')} end",
    "payment_method": _pick(f"{_K} % 3", "Direct Debit", "Credit Card", "Bank Transfer"),
    "monthly_charges": f"case when {_K} % 50 = 7 then '-10.00'"
    f" when {_K} % 33 = 8 then concat('£', {_CHARGE}) else {_CHARGE} end",
    "tenure_months": f"case when {_K} % 33 = 9 then null when {_K} % 50 = 11 then -5L"
    f" else 1 + {_K} % 72 end",
    "nps_score": f"case when {_K} % 25 = 6 then null when {_K} % 50 = 13 then 99L"
    f" else {_K} % 11 end",
    "install_date": f"case when {_K} % 20 = 1 then concat({_DAY}, '/', {_MONTH}, '/20', {_YEAR})"
    f" when {_K} % 40 = 2 then concat({_MONTH_NAME}, ' 20', {_YEAR})"
    f" else concat('20', {_YEAR}, '-', {_MONTH}, '-', {_DAY}) end",
    "churn": f"case {_K} % 60 when 0 then 'yes' when 10 then 'Y' when 20 then '1' when 30 then 'no'"
    f" when 40 then 'N' when 50 then '0' else if({_K} % 4 = 3, 'Yes', 'No') end",
    "country": "'GB'",
    "empty_col": "cast(null as string)",
}


def dirty_customers(spark: SparkSession, folder: str) -> DataFrame:
    return plant_faults(read_table(spark, folder, "customer"))


def plant_faults(customers: DataFrame) -> DataFrame:
    """14 columns and, for some customers, a second copy of the row."""
    return customers.selectExpr(
        *[f"{expression} as {name}" for name, expression in _FAULTY.items()],
        f"explode(sequence(1, if({_K} % 37 = 1, 2, 1))) as copy",
    ).drop("copy")
