"""DuckDB SQL for the catalogue's queries, written independently of the Spark code.

Facts are taken column by column from a long table made with UNION ALL; cleaning
and checks are spelled out for the customer table with planted faults.
"""
from __future__ import annotations


# Fixed values, spelled out here so that an error in the engine's own ones shows.
CURRENCY = "£$€,"
CURRENCY_AND_PERCENT = "£$€,%"
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
EMAIL = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
PHONE = r"^(0|\+44)\d{9,10}$"
PHONE_STRICT = r"^(0|\+44)\d{10}$"
POSTCODE = r"(?i)^[A-Z]{1,2}\d{1,2}[A-Z]?\s*\d[A-Z]{2}$"
NUMERIC = r"^[£$€]?\s*-?[\d,]+(\.\d+)?\s*%?$"
PERSON = r"^[A-Za-z]+(\s[A-Za-z]+)+$"
PLAIN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def rx(value: str, pattern: str) -> str:
    return f"regexp_matches({value}, '{pattern}')"


def half_up(value: str, places: int) -> str:
    """Rounded half up on the decimal value; no negative zero."""
    return f"cast(round(cast({value} as decimal(30, 12)), {places}) as double)"


def trimmed(value: str) -> str:
    return f"trim({value}, '{WHITESPACE}')"


DIRTY = r"""
faulty as (
  select c_custkey + 10000 as customer_id,
    case c_custkey % 5 when 0 then 'James' when 1 then 'Olivia' when 2 then 'Harry'
      when 3 then 'Isla' else 'Noah' end || ' ' ||
      case c_custkey % 3 when 0 then 'Smith' when 1 then 'Patel' else 'Hall' end as full_name,
    case when c_custkey % 17 = 3 then null
      when c_custkey % 25 = 4 then case c_custkey % 3 when 0 then 'john.smith'
        when 1 then 'no-at-sign.com' else 'a@b' end
      else 'user' || c_custkey || '@example.com' end as email,
    case when c_custkey % 33 = 5 then case c_custkey % 2 when 0 then '123' else '07xx' end
      else '07' || lpad(cast((c_custkey * 7919) % 1000000000 as varchar), 9, '0') end as phone,
    case when c_custkey % 20 = 7 then null
      when c_custkey % 33 = 9 then case c_custkey % 2 when 0 then '12345' else 'ABCDE' end
      else case c_custkey % 4 when 0 then 'OX' when 1 then 'GL' when 2 then 'SN' else 'RG' end
        || (1 + c_custkey % 49) || ' ' || (1 + c_custkey % 9) || 'AB' end as postcode,
    case c_custkey % 20 when 3 then 'wiltshire' when 4 then '  Wiltshire ' when 5 then 'HAMPSHIRE'
      else case c_custkey % 4 when 0 then 'Oxfordshire' when 1 then 'Wiltshire'
        when 2 then 'Hampshire' else 'Berkshire' end end as region,
    case c_custkey % 3 when 0 then 'Direct Debit' when 1 then 'Credit Card'
      else 'Bank Transfer' end as payment_method,
    case when c_custkey % 50 = 7 then '-10.00' else
      case when c_custkey % 33 = 8 then '£' else '' end || (29 + c_custkey % 36) || '.' ||
      lpad(cast(c_custkey % 100 as varchar), 2, '0') end as monthly_charges,
    case when c_custkey % 33 = 9 then null when c_custkey % 50 = 11 then -5
      else 1 + c_custkey % 72 end as tenure_months,
    case when c_custkey % 25 = 6 then null when c_custkey % 50 = 13 then 99
      else c_custkey % 11 end as nps_score,
    case when c_custkey % 20 = 1 then lpad(cast(1 + c_custkey % 28 as varchar), 2, '0') || '/' ||
        lpad(cast(1 + c_custkey % 12 as varchar), 2, '0') || '/20' || (20 + c_custkey % 6)
      when c_custkey % 40 = 2 then case 1 + c_custkey % 12 when 3 then 'Mar' when 7 then 'Jul'
        when 11 then 'Nov' else 'Jan' end || ' 20' || (20 + c_custkey % 6)
      else '20' || (20 + c_custkey % 6) || '-' || lpad(cast(1 + c_custkey % 12 as varchar), 2, '0')
        || '-' || lpad(cast(1 + c_custkey % 28 as varchar), 2, '0') end as install_date,
    case c_custkey % 60 when 0 then 'yes' when 10 then 'Y' when 20 then '1' when 30 then 'no'
      when 40 then 'N' when 50 then '0'
      else case c_custkey % 4 when 3 then 'Yes' else 'No' end end as churn,
    'GB' as country,
    cast(null as varchar) as empty_col
  from customer),
dirty as (
  select * from faulty
  union all select * from faulty where (customer_id - 10000) % 37 = 1)"""

# Columns of each table: (name, kind, type as Spark names it).
COLUMNS = {
    "dirty": [
        ("customer_id", "integer", "bigint"), ("full_name", "text", "string"),
        ("email", "text", "string"), ("phone", "text", "string"), ("postcode", "text", "string"),
        ("region", "text", "string"), ("payment_method", "text", "string"),
        ("monthly_charges", "text", "string"), ("tenure_months", "integer", "bigint"),
        ("nps_score", "integer", "bigint"), ("install_date", "text", "string"),
        ("churn", "text", "string"), ("country", "text", "string"), ("empty_col", "text", "string"),
    ],
    "lineitem": [
        ("l_orderkey", "integer", "bigint"), ("l_partkey", "integer", "bigint"),
        ("l_suppkey", "integer", "bigint"), ("l_linenumber", "integer", "int"),
        ("l_quantity", "float", "double"), ("l_extendedprice", "float", "double"),
        ("l_discount", "float", "double"), ("l_tax", "float", "double"),
        ("l_returnflag", "text", "string"), ("l_linestatus", "text", "string"),
        ("l_shipdate", "temporal", "timestamp_ntz"),
    ],
    "customer": [
        ("c_custkey", "integer", "bigint"), ("c_name", "text", "string"),
        ("c_nationkey", "integer", "int"), ("c_acctbal", "float", "double"),
        ("c_mktsegment", "text", "string"),
    ],
    "orders": [
        ("o_orderkey", "integer", "bigint"), ("o_custkey", "integer", "bigint"),
        ("o_orderstatus", "text", "string"), ("o_totalprice", "float", "double"),
        ("o_orderdate", "temporal", "timestamp_ntz"), ("o_orderpriority", "text", "string"),
    ],
    "part": [
        ("p_partkey", "integer", "bigint"), ("p_name", "text", "string"),
        ("p_brand", "text", "string"), ("p_type", "text", "string"), ("p_size", "integer", "int"),
        ("p_retailprice", "float", "double"),
    ],
    "events": [
        ("event_id", "integer", "bigint"), ("ts", "temporal", "timestamp_ntz"),
        ("user_id", "integer", "bigint"), ("event_type", "text", "string"),
        ("value", "float", "double"), ("props", "text", "string"),
    ],
    "documents": [
        ("doc_id", "integer", "bigint"), ("text", "text", "string"), ("lang", "text", "string"),
        ("source", "text", "string"), ("n_chars", "integer", "bigint"),
    ],
    "labels": [
        ("doc_id", "integer", "bigint"), ("quality", "integer", "int"), ("toxic", "integer", "int"),
    ],
    "embeddings": [
        ("vec_id", "integer", "bigint"), ("embedding", "nested", "array<float>"),
        ("label", "integer", "int"),
    ],
}
DIRTY_COLUMNS = [name for name, _, _ in COLUMNS["dirty"]]
DIRTY_NUMERIC = ["customer_id", "tenure_months", "nps_score"]
LINEITEM_NUMERIC = [n for n, k, _ in COLUMNS["lineitem"] if k in ("integer", "float")]


def ctes(table: str, *more: str) -> str:
    parts = ([DIRTY] if table == "dirty" else []) + [m.strip() for m in more if m]
    return "with " + ",\n".join(p.strip() for p in parts) + "\n" if parts else ""


def union(selects) -> str:
    return "\nunion all\n".join(selects)


def long_form(table: str) -> str:
    return "cells as (\n" + union(
        f"select {i} as position, '{c}' as column_name, '{k}' as kind, '{t}' as data_type,"
        f" cast({c} as varchar) as v from {table}"
        for i, (c, k, t) in enumerate(COLUMNS[table])
    ) + ")"


def day(text: str) -> str:
    """The day a trimmed text names, by its shape."""
    return f"""case
      when {rx(text, r'^\d{4}-\d{2}-\d{2}$')} then try_strptime({text}, '%Y-%m-%d')
      when {rx(text, r'^\d{1,2}/\d{1,2}/\d{4}$')} then try_strptime({text}, '%d/%m/%Y')
      when {rx(text, r'^[A-Za-z]{3} \d{4}$')} then try_strptime({text}, '%b %Y') end"""


def number(text: str, removed: str) -> str:
    bare = f"translate({text}, '{removed}{WHITESPACE}', '')"
    return f"case when {rx(bare, PLAIN)} then try_cast({bare} as double) end"


def facts(table: str) -> str:
    def n(condition: str, name: str) -> str:
        return f"cast(count(*) filter (where kind = 'text' and {condition}) as bigint) as {name}"

    words = "('true', 'false', 'yes', 'no', 'y', 'n', '0', '1')"
    return long_form(table) + f""",
trimmed as (select *, {trimmed('v')} as t from cells),
counted as (
  select position, column_name, kind, data_type, lower(column_name) as name,
    count(*) as n, count(v) as p, count(distinct v) as u,
    count(distinct lower(t)) as words,
    count(*) filter (where lower(t) not in {words}) as other_words,
    {n(rx('t', EMAIL), 'email')}, {n(rx('t', PHONE), 'phone')},
    {n(rx('t', POSTCODE), 'postcode')}, {n(rx('t', PERSON), 'person')},
    {n(rx('t', NUMERIC), 'numeric_like')},
    {n(rx('t', NUMERIC) + " and not " + rx('t', '[£$€%,]'), 'plain_number')},
    {n(rx('t', r'^\d{4}-\d{2}-\d{2}$'), 'iso')},
    {n(rx('t', r'^\d{1,2}/\d{1,2}/\d{4}$'), 'slash')},
    {n(rx('t', r'^[A-Za-z]{3,}\s+\d{4}$'), 'month_year')},
    {n(f"({day('t')}) is not null", 'dates')},
    {n(f"({number('t', CURRENCY_AND_PERCENT)}) is not null", 'numbers')}
  from trimmed group by all),
inferred as (
  select *, case when p = 0 then 'empty'
    when kind = 'nested' then 'nested'
    when kind in ('text', 'integer') and other_words = 0 and words <= 3 then 'boolean'
    when kind in ('integer', 'float') then kind
    when kind = 'temporal' then 'datetime'
    when numeric_like >= 8e-1 * p then 'numeric_as_text'
    when dates >= 8e-1 * p then 'datetime'
    when u <= 20 or u <= 5e-2 * p then 'categorical'
    else 'text' end as inferred_type
  from counted),
meant as (
  select *, case when inferred_type in ('empty', 'nested') then 'unknown'
    when email >= 8e-1 * p then 'email'
    when phone >= 8e-1 * p then 'phone'
    when postcode >= 8e-1 * p then 'postcode'
    when (name like '%id%' or name like '%\\_no' escape '\\' or name = 'code') and u > 9e-1 * p
      then 'identifier'
    when person >= 8e-1 * p and name not like '%user%' and name not like '%file%'
      then 'person_name'
    when inferred_type = 'datetime' then 'date'
    when inferred_type in ('integer', 'float', 'numeric_as_text') then 'numeric'
    when inferred_type in ('categorical', 'boolean') then 'categorical'
    else 'text' end as semantic_type,
    case when {rx('name', 'email|e-mail|mail')} then 'email'
      when {rx('name', 'phone|mobile|tel|contact_number|contact_no')} then 'phone'
      when {rx('name', 'postcode|post_code|postal|zip')} then 'postcode'
      when {rx('name', 'date|_at|_on|timestamp|dob|birth')} then 'date' end as hint,
    kind = 'text' and plain_number between 1 and p - 1 as is_mixed
  from inferred),
facts as (select *, coalesce(hint, semantic_type) as expected_type from meant)"""


def from_facts(table: str, select: str) -> str:
    return ctes(table, facts(table)) + select


METADATA = "select column_name, data_type, inferred_type, semantic_type, is_mixed from facts"
CARDINALITY = f"""select column_name, case when kind <> 'nested' then u end as unique_values,
  {half_up('u / cast(n as double)', 4)} as cardinality_ratio, u <= 1 as is_constant,
  {half_up('u / cast(n as double)', 4)} > 9e-1 as is_high_cardinality from facts"""


def top_values(table: str) -> str:
    return ctes(table, long_form(table)) + """
select column_name, rank, value, n from (
  select column_name, v as value, n, row_number() over (
    partition by column_name order by n desc, v) as rank
  from (select column_name, v, count(*) as n from cells
        where kind in ('text', 'temporal') and v is not null group by all))
where rank <= 5"""


def top_texts(table: str, columns: list[str]) -> str:
    return "select column_name, value, n, rank from (" + union(
        f"select '{c}' as column_name, {c} as value, count(*) as n, row_number() over"
        f" (order by count(*) desc, {c}) as rank from {table} where {c} is not null group by {c}"
        for c in columns
    ) + ") where rank <= 5"


INFINITE = f"""
with t as (select case when l_linenumber = 7 then 'infinity'::double else l_quantity end as q, l_tax
  from lineitem),
n as (select count(*) as n, count(*) filter (where q = 'infinity') as far from t),
finite as (select row_number() over (order by q) - 1 as place, q from t),
spot as (select p, (n - 1) * p as place from n, (values (25e-2), (5e-1), (75e-2)) as ps(p)),
found as (select p, spot.place, l.q as low, h.q as high from spot
  join finite l on l.place = floor(spot.place) join finite h on h.place = ceil(spot.place)),
quartiles as (select p, case when low = high then low else low + (high - low) * (place - floor(place))
  end as v from found)
select 'l_quantity' as column_name, min(q) as min, 'infinity'::double as max,
  'infinity'::double as mean, (select v from quartiles where p = 5e-1) as median,
  'nan'::double as std, (select v from quartiles where p = 25e-2) as q1,
  (select v from quartiles where p = 75e-2) as q3, 'nan'::double as skew from t
union all
select 'l_tax', min(l_tax), max(l_tax), {half_up('avg(l_tax)', 3)}, quantile_cont(l_tax, 0.5),
  {half_up('stddev_samp(l_tax)', 3)}, quantile_cont(l_tax, 0.25), quantile_cont(l_tax, 0.75),
  {half_up('skewness(l_tax)', 3)} from t"""


def missing_per_column(table: str) -> str:
    return ctes(table) + union(
        f"select '{c}' as column_name, count(*) - count({c}) as missing,"
        f" {half_up(f'100e0 * (count(*) - count({c})) / count(*)', 2)} as missing_pct from {table}"
        for c, _, _ in COLUMNS[table]
    )


def correlations(table: str, columns: list[str]) -> str:
    def one(x: str, y: str) -> str:
        value = f"corr({x}, {y})" if x != y else f"case when min({x}) < max({x}) then 1e0 end"
        return (
            f"select '{x}' as column_name, '{y}' as column_y,"
            f" {half_up(f'case when not isnan({value}) then {value} end', 3)} as corr from {table}"
        )

    return ctes(table) + union(one(x, y) for x in columns for y in columns)


def distribution(table: str, columns: list[str]) -> str:
    return ctes(table) + union(
        f"select '{c}' as column_name, cast(min({c}) as double) as min,"
        f" cast(max({c}) as double) as max, {half_up(f'avg({c})', 3)} as mean,"
        f" cast(quantile_cont({c}, 0.5) as double) as median, {half_up(f'stddev_samp({c})', 3)} as std,"
        f" cast(quantile_cont({c}, 0.25) as double) as q1,"
        f" cast(quantile_cont({c}, 0.75) as double) as q3,"
        f" {half_up(f'skewness({c})', 3)} as skew from {table}"
        for c in columns
    )


def quartiles(table: str, columns: list[str]) -> str:
    return "quartiles as (" + union(
        f"select '{c}' as column_name, cast(quantile_cont({c}, 0.25) as double) as q1,"
        f" cast(quantile_cont({c}, 0.5) as double) as median,"
        f" cast(quantile_cont({c}, 0.75) as double) as q3, cast(min({c}) as double) as lo,"
        f" cast(max({c}) as double) as hi, count({c}) as n from {table}"
        for c in columns
    ) + "),\nvals as (" + union(
        f"select '{c}' as column_name, cast({c} as double) as v from {table} where {c} is not null"
        for c in columns
    ) + """),
fences as (select *, q1 - 15e-1 * (q3 - q1) as lower, q3 + 15e-1 * (q3 - q1) as upper
  from quartiles)"""


def boxplot(table: str, columns: list[str]) -> str:
    return ctes(table, quartiles(table, columns)) + """
select column_name, any_value(q1) as q1, any_value(median) as median, any_value(q3) as q3,
  min(v) filter (where v between lower and upper) as whisker_lo,
  max(v) filter (where v between lower and upper) as whisker_hi,
  count(*) filter (where v < lower or v > upper) as outliers
from vals join fences using (column_name) group by column_name"""


def outliers(table: str, columns: list[str]) -> str:
    return ctes(table, quartiles(table, columns)) + """
select column_name, any_value(lower) as lower, any_value(upper) as upper,
  count(*) filter (where v < lower or v > upper) as outliers
from vals join fences using (column_name) group by column_name"""


def histogram(table: str, columns: list[str]) -> str:
    return ctes(table, quartiles(table, columns), """
layout as (select column_name, lo,
    greatest(1, ceil((hi - lo) / least((hi - lo) / (log2(n) + 1),
      case when q3 > q1 then 2e0 * (q3 - q1) * pow(n, -1e0 / 3e0) else 'infinity'::double end)))
      as bins, hi from quartiles),
sized as (select column_name, lo, (hi - lo) / bins as width, bins from layout)""") + """
select column_name, cast(bin as bigint) as bin, lo + bin * width as lo,
  lo + (bin + 1) * width as hi, n from (
  select column_name, lo, width, least(floor((v - lo) / width), bins - 1) as bin, count(*) as n
  from vals join sized using (column_name) group by all)"""


def density(table: str, columns: list[str]) -> str:
    """Values are summed once per distinct value, as the sum is the same."""
    return union(f"""(
with vals as (select cast({c} as double) as v, count(*) as m from {table} group by all),
shape as (select count(*) as total, min({c}) as lo, max({c}) as hi,
    stddev_samp({c}) * pow(count(*), -2e-1) as width from {table}),
layout as (select *, lo - 3 * width as start,
    (hi + 3 * width - (lo - 3 * width)) / 199 as step from shape),
grid as (select i, start + i * step as x, width, total from layout, range(200) as r(i))
select '{c}' as column_name, cast(x as float) as x,
  cast(sum(m * exp(-5e-1 * pow((x - v) / width, 2)))
    / (any_value(total) * any_value(width) * sqrt(2 * pi())) as float) as density
from grid, vals group by i, x)""" for c in columns)


def row_quality(table: str, columns: list[str]) -> str:
    gaps = " + ".join(f"(case when {c} is null then 1 else 0 end)" for c in columns)
    return f"""
sizes as (select count(*) as n, sum({gaps}) as gaps,
    (select count(*) from (select distinct {', '.join(columns)} from {table})) as kept
  from {table}),
rates as (select 1 - gaps / cast(n * {len(columns)} as double) as c,
    1 - (n - kept) / cast(n as double) as u from sizes)"""


BASE_SCORE = f"""select {half_up('c', 6)} as completeness, {half_up('u', 6)} as uniqueness,
  {half_up('100e0 * (7e-1 * c + 3e-1 * u)', 2)} as score from rates"""


def validity(table: str) -> str:
    def share(column: str, pattern: str) -> str:
        test = f"case when {rx(column, pattern)} then 1e0 else 0 end"
        return f"avg({test}) filter (where {column} is not null)"

    return f"select ({share('email', EMAIL)} + {share('phone', PHONE_STRICT)}) / 2 as v from {table}"


# The cleaning steps on the dirty table, spelled out.
NUMBER_CHARGES = f"{number('monthly_charges', CURRENCY)} as monthly_charges"
CLEAN_DATE = f"{day(trimmed('install_date'))} as install_date"
YES_NO = """case when lower(trim(churn)) in ('yes', 'y', '1', 'true') then 'Yes'
  when lower(trim(churn)) in ('no', 'n', '0', 'false') then 'No' else churn end as churn"""
FLAG_PHONE = (
    f"case when not {rx('phone', PHONE_STRICT)} then 'INVALID_PHONE' else phone end as phone"
)


def with_columns(changes: dict[str, str]) -> str:
    return ", ".join(changes.get(c, c) for c in DIRTY_COLUMNS)


NORMALISED = with_columns({
    "monthly_charges": NUMBER_CHARGES, "install_date": CLEAN_DATE, "churn": YES_NO,
    "phone": FLAG_PHONE,
})


def median_fill(column: str, table: str) -> str:
    return (
        f"coalesce(cast({column} as double),"
        f" (select quantile_cont({column}, 0.5) from {table})) as {column}"
    )


def mode_of(column: str, table: str) -> str:
    return (
        f"(select {column} from {table} where {column} is not null group by {column}"
        f" order by count(*) desc, {column} limit 1)"
    )


def mode_fill(column: str, table: str) -> str:
    return f"coalesce({column}, {mode_of(column, table)}) as {column}"


def imputed(table: str) -> str:
    return with_columns({
        "email": mode_fill("email", table), "postcode": mode_fill("postcode", table),
        "tenure_months": median_fill("tenure_months", table),
        "nps_score": median_fill("nps_score", table),
    })


UNIQUE = "uniq as (select distinct * from dirty)"
UNIFORM = f"uniform as (select {NORMALISED} from uniq)"
CLEANED = f"cleaned as (select {imputed('uniform')} from uniform)"
CLEANING = (UNIQUE, UNIFORM, CLEANED)


def result(column: str, check: str, invalid: str, table: str) -> str:
    return (
        f"select '{column}' as column_name, '{check}' as \"check\", count({column}) as checked,"
        f" count({column}) - count(*) filter (where {invalid}) as valid,"
        f" count(*) filter (where {invalid}) as invalid from {table}"
    )


def format_results(table: str) -> list[str]:
    return [
        result("email", "email", f"not {rx('email', EMAIL)}", table),
        result("phone", "phone", f"not {rx('phone', PHONE_STRICT)}", table),
        result("postcode", "postcode", f"not {rx('postcode', POSTCODE)}", table),
    ]


def range_results() -> list[str]:
    raw = [
        result(c, "range", f"{c} < (select min({c}) from dirty) or {c} > (select max({c}) from dirty)",
               "cleaned")
        for c in DIRTY_NUMERIC
    ]
    # Not numeric before cleaning: held to its own range.
    own = result(
        "monthly_charges", "range",
        "monthly_charges < (select min(monthly_charges) from cleaned)"
        " or monthly_charges > (select max(monthly_charges) from cleaned)", "cleaned",
    )
    return [*raw, own]


def negative_results() -> list[str]:
    return [
        "select * from (" + result(c, "negatives", f"{c} < 0", "cleaned")
        + ") where invalid > 0 and invalid <= 5e-2 * checked"
        for c in [*DIRTY_NUMERIC, "monthly_charges"]
    ]


LISTED = ["full_name", "region", "payment_method", "churn", "country"]


def membership_results(table: str) -> list[str]:
    return [
        result(c, "membership",
               f"{c} is not null and {c} not in (select {c} from cleaned where {c} is not null)", table)
        for c in LISTED
    ]


def all_results() -> str:
    return union([
        *format_results("cleaned"), *range_results(), *negative_results(),
        *membership_results("cleaned"),
    ])


def stream_results() -> str:
    numeric = [
        result(c, "range", f"{c} < (select min({c}) from dirty) or {c} > (select max({c}) from dirty)",
               "dirty")
        for c in DIRTY_NUMERIC
    ]
    tenure = result("tenure_months", "negatives", "tenure_months < 0", "dirty")
    # Charges arrive as text: what does not read as a number is invalid.
    number = "try_cast(monthly_charges as double)"
    charges = [
        result("monthly_charges", "range",
               f"monthly_charges is not null and coalesce({number} < (select min(monthly_charges)"
               f" from cleaned) or {number} > (select max(monthly_charges) from cleaned), true)",
               "dirty"),
        result("monthly_charges", "negatives",
               f"monthly_charges is not null and coalesce({number} < 0, true)", "dirty"),
    ]
    return union(
        [*format_results("dirty"), *numeric, tenure, *charges, *membership_results("dirty")])


BEYOND = " or ".join(
    f"{c} < (select lower from fences where column_name = '{c}')"
    f" or {c} > (select upper from fences where column_name = '{c}')"
    for c in [*DIRTY_NUMERIC, "monthly_charges"]
)

NA_LIST = ", ".join(f"'{t}'" for t in NA_TOKENS)
TOKENS = f"""
with raw as (select cast(o_orderkey as varchar) as order_key,
    case o_custkey % 11 when 0 then 'NA' when 1 then 'null' when 2 then '' when 3 then 'n/a'
      else o_orderstatus end as status,
    case when o_custkey % 7 = 0 then '#N/A' else cast(o_custkey as varchar) end as customer,
    case when o_orderkey % 5 = 0 then 'nan' when o_orderkey % 2 = 0 then '0.5' else '2' end as share,
    case when o_orderkey % 3 = 0 then 'True' else 'False' end as flag from orders)
select cast(order_key as bigint) as order_key,
  case when status not in ({NA_LIST}) then status end as status,
  cast(case when customer not in ({NA_LIST}) then customer end as bigint) as customer,
  cast(case when share not in ({NA_LIST}) then share end as double) as share,
  flag = 'True' as flag from raw"""

ACTIONS = f"""
select 'phone' as column_name, 'invalid_phone_flag' as action,
  count(*) filter (where not {rx('phone', PHONE_STRICT)}) as affected from dirty
union all select 'monthly_charges', 'number_from_text', count(monthly_charges) from dirty
union all select 'install_date', 'date_from_text', count(install_date) from dirty
union all select 'churn', 'yes_no_spelling', count(*) filter (where churn not in ('Yes', 'No'))
  from dirty"""


def impute_log(table: str) -> str:
    def gap(c: str) -> str:
        return f"count(*) - count({c})"

    median = "cast(cast(quantile_cont({0}, 0.5) as decimal(38, 4)) as varchar)"
    return union([
        f"select 'email' as column_name, {gap('email')} as missing, 'mode' as action,"
        f" {mode_of('email', table)} as fill_value from {table}",
        f"select 'postcode', {gap('postcode')}, 'mode', {mode_of('postcode', table)} from {table}",
        f"select 'tenure_months', {gap('tenure_months')}, 'median',"
        f" {median.format('tenure_months')} from {table}",
        f"select 'nps_score', {gap('nps_score')}, 'median', {median.format('nps_score')} from {table}",
        f"select 'empty_col', {gap('empty_col')}, 'skipped_no_value', null from {table}",
    ])


def scored(cleaned: str, name: str) -> str:
    """CTEs giving the three-part score of a table as ``name``."""
    rates = row_quality(cleaned, DIRTY_COLUMNS)
    rates = rates.replace("sizes", f"{name}_sizes").replace("rates", f"{name}_rates")
    return rates + f""",
{name}_validity as ({validity(cleaned)}),
{name} as (select {half_up('c', 6)} as completeness, {half_up('u', 6)} as uniqueness,
  {half_up('v', 6)} as validity, {half_up('100e0 * (5e-1 * c + 2e-1 * u + 3e-1 * v)', 2)} as score
  from {name}_rates, {name}_validity)"""


PATTERN = " || ".join(f"(case when {c} is null then '1' else '0' end)" for c in DIRTY_COLUMNS)
BROKEN = {
    "email": f"not {rx(trimmed('email'), EMAIL)}",
    "phone": f"not {rx(trimmed('phone'), PHONE)}",
    "postcode": f"not {rx(trimmed('postcode'), POSTCODE)}",
}
SUSPICIOUS = """
select column_name, concat_ws('|',
  case when u <= 1 then 'constant' end,
  case when 100e0 * (n - p) > 50 * n then 'mostly_missing' end,
  case when is_mixed then 'mixed_types' end,
  case when u > 1 and u > 9e-1 * n then 'high_cardinality' end) as reasons
from facts where u <= 1 or 100e0 * (n - p) > 50 * n or is_mixed or (u > 1 and u > 9e-1 * n)"""
SHAPES = """select column_name, concat_ws('|',
  case when slash > 0 then 'DD/MM/YYYY' end, case when month_year > 0 then 'Mon YYYY' end,
  case when iso > 0 then 'YYYY-MM-DD' end) as formats_found
from facts where expected_type = 'date'
  and (case when slash > 0 then 1 else 0 end) + (case when month_year > 0 then 1 else 0 end)
    + (case when iso > 0 then 1 else 0 end) > 1"""
INVALID = f"""select column_name, expected_type as expected_format, p - matching as invalid_count,
  {half_up('100e0 * (p - matching) / p', 2)} as invalid_pct
from (select *, case expected_type when 'email' then email when 'phone' then phone
    when 'postcode' then postcode end as matching from facts)
where p > matching"""
PII = """select column_name, expected_type as semantic_type,
  'values or name suggest ' || replace(coalesce(hint, semantic_type), '_', ' ') as reason from facts
where expected_type in ('email', 'phone', 'postcode', 'person_name', 'identifier')"""
RATIO = ", ".join(
    half_up(f"case when p > 0 then {c} / cast(p as double) else 0 end", 4) + f" as {a}"
    for c, a in (("email", "email"), ("phone", "phone"), ("postcode", "postcode"),
                 ("person", "person_name"), ("numeric_like", "numeric_like"))
)
IS_NUMBER = f"({rx('t', NUMERIC)} and not {rx('t', '[£$€%,]')})"

ORACLES: dict[str, str] = {
    "dirty_view": ctes("dirty") + "select * from dirty",
    "na_tokens": TOKENS,
    "csv_scan": TOKENS,
    "report_roundtrip": from_facts("dirty", METADATA),
    "dataset_summary": ctes("dirty") + "select 'customer' as source, count(*) as rows, 14 as columns, "
    f"'{'|'.join(DIRTY_COLUMNS)}' as column_names from dirty",
    "dataset_summary_lineitem": "select cast(null as varchar) as source, count(*) as rows, 11 as columns, "
    f"'{'|'.join(c for c, _, _ in COLUMNS['lineitem'])}' as column_names from lineitem",
    "match_ratios": from_facts("dirty", f"select column_name, {RATIO} from facts"),
    "infer_types": from_facts("dirty", "select column_name, inferred_type from facts"),
    "semantic_types": from_facts("dirty", "select column_name, semantic_type from facts"),
    "expected_types": from_facts("dirty", "select column_name, expected_type from facts"),
    "mixed_types": from_facts("dirty", f"""
select column_name, any_value(is_mixed) as is_mixed,
  any_value(case when p = 0 then '' when facts.kind <> 'text' then 'number'
    when plain_number = 0 then 'string' when plain_number = p then 'number'
    else 'number|string' end) as kinds,
  min(v) filter (where is_mixed and {IS_NUMBER}) as example_number,
  min(v) filter (where is_mixed and not {IS_NUMBER}) as example_string
from facts join trimmed using (column_name) group by column_name"""),
    **{
        "column_metadata" + ("" if t == "dirty" else f"_{t}"): from_facts(t, METADATA)
        for t in COLUMNS
    },
    "missing_per_column": missing_per_column("dirty"),
    "missing_overall": f"""{ctes("dirty", "per as (" + union(
        f"select '{c}' as column_name, count(*) as n, count(*) - count({c}) as missing from dirty"
        for c in DIRTY_COLUMNS) + ")")}
select cast(sum(missing) as bigint) as total_missing_cells, cast(sum(n) as bigint) as total_cells,
  {half_up('100e0 * sum(missing) / sum(n)', 2)} as missing_pct,
  string_agg(column_name, '|' order by column_name) filter (where missing = 0) as complete_columns,
  string_agg(column_name, '|' order by column_name) filter (where missing = n) as empty_columns
from per""",
    "type_consistency": from_facts("dirty", f"""
select column_name, inferred_type, case when p > 0 then {half_up('100e0 * ok / p', 2)} end as consistency_pct,
  p - ok as nonconforming
from (select *, case when inferred_type = 'numeric_as_text' then numbers
    when inferred_type = 'datetime' and kind = 'text' then dates else p end as ok from facts)"""),
    "cardinality": from_facts("dirty", CARDINALITY),
    "cardinality_lineitem": from_facts("lineitem", CARDINALITY),
    "cardinality_documents": from_facts("documents", CARDINALITY),
    "correlation_matrix": correlations("lineitem", LINEITEM_NUMERIC),
    "correlation_matrix_dirty": correlations("dirty", DIRTY_NUMERIC),
    "correlation_tiled": correlations("lineitem", LINEITEM_NUMERIC),
    "numeric_distribution": distribution("lineitem", LINEITEM_NUMERIC),
    "numeric_distribution_dirty": distribution("dirty", DIRTY_NUMERIC),
    "numeric_distribution_events": distribution("events", ["event_id", "user_id", "value"]),
    "top_values": top_values("dirty"),
    "top_values_lineitem": top_values("lineitem"),
    "top_values_documents": top_values("documents"),
    "pii_columns": from_facts("dirty", PII),
    "pii_columns_part": from_facts("part", PII),
    "invalid_formats": from_facts("dirty", INVALID),
    "invalid_examples": ctes("dirty") + "select column_name, rank, value as example from ("
    "select column_name, value, row_number() over (partition by column_name order by value) as rank"
    " from (" + union(
        f"select distinct '{c}' as column_name, {trimmed(c)} as value from dirty where {test}"
        for c, test in BROKEN.items()
    ) + ")) where rank <= 5",
    "invalid_rows": ctes("dirty") + "select * from dirty where "
    + " or ".join(f"coalesce({test}, false)" for test in BROKEN.values()),
    "date_shapes": from_facts("dirty", SHAPES),
    "suspicious_columns": from_facts("dirty", SUSPICIOUS),
    "report_digest": from_facts("dirty", f"""
select 'pii' as section, column_name, semantic_type as detail from ({PII})
union all select 'suspicious', column_name, reasons from ({SUSPICIOUS})
union all select 'format', column_name, expected_format from ({INVALID})
union all select 'format', column_name, 'date' from ({SHAPES})
union all select 'inference', column_name, inferred_type || ' (' || semantic_type || ')'
  from facts where position < 4"""),
    "missing_patterns": ctes("dirty")
    + f"select {PATTERN} as pattern, count(*) as n from dirty group by 1",
    "histogram": histogram("lineitem", LINEITEM_NUMERIC),
    "boxplot_stats": boxplot("lineitem", LINEITEM_NUMERIC),
    "boxplot_stats_dirty": boxplot("dirty", DIRTY_NUMERIC),
    "outliers_iqr": outliers("dirty", DIRTY_NUMERIC),
    "density_curve_lineitem": density("lineitem", LINEITEM_NUMERIC),
    "dataset_summary_supplier": "select 'supplier' as source, count(*) as rows, 4 as columns,"
    " 's_suppkey|s_name|s_nationkey|s_acctbal' as column_names from supplier",
    "top_values_pages": top_texts("pages", ["url", "html"]),
    "top_values_conversations": top_texts("conversations", ["role", "text"]),
    "top_values_nation": top_texts("nation", ["n_name"]),
    "top_values_region": top_texts("region", ["r_name"]),
    "column_metadata_customer": from_facts("customer", METADATA),
    "numeric_distribution_infinite": INFINITE,
    "outliers_iqr_wide": "with wide as (select " + ", ".join(
        f"l_quantity + {i} as c{i}" for i in range(13)
    ) + ", case when l_orderkey % 500 = 0 then 1e6 else l_tax end as c13 from lineitem)" + union(
        f"""(select 'c{i}' as column_name, any_value(lower) as lower, any_value(upper) as upper,
count(*) filter (where c{i} < lower or c{i} > upper) as outliers from wide, (
select q1 - 15e-1 * (q3 - q1) as lower, q3 + 15e-1 * (q3 - q1) as upper from (
select quantile_cont(c{i}, 0.25) as q1, quantile_cont(c{i}, 0.75) as q3 from wide)))"""
        for i in range(14)
    ),
    "invalid_examples_long": """select 'contact' as column_name, rank, value as example from (
select value, row_number() over (order by value) as rank from (select distinct
  repeat('long address ', 6) || lpad(cast(c_custkey * 7919 % 100003 as varchar), 6, '0') as value
  from customer)) where rank <= 5""",
    "cardinality_approx_bounded": union(
        f"select '{c}' as column_name, true as within" for c, _, _ in COLUMNS["lineitem"]
    ),
    "density_curve": density("customer", ["c_custkey", "c_nationkey", "c_acctbal"]),
    "quality_score": ctes("dirty", row_quality("dirty", DIRTY_COLUMNS)) + BASE_SCORE,
    "quality_score_documents": ctes(
        "documents", row_quality("documents", ["text", "lang", "source"])) + BASE_SCORE,
    "quality_score_validity": ctes("dirty", scored("dirty", "total")) + "select * from total",
    "dedup_exact": ctes("dirty") + "select distinct * from dirty",
    "dedup_documents": "select distinct text, lang, source from documents",
    "dedup_in_place": ctes("dirty") + "select distinct * from dirty",
    "dedup_in_place_documents": "select distinct text, lang, source from documents",
    "dedup_log": ctes("dirty", UNIQUE) + """
select (select count(*) from dirty) - (select count(*) from uniq) as exact_duplicates_removed,
  (select count(*) from dirty) as rows_before, (select count(*) from uniq) as rows_after""",
    "dedup_log_documents": """
with uniq as (select distinct text, lang, source from documents)
select (select count(*) from documents) - (select count(*) from uniq) as exact_duplicates_removed,
  (select count(*) from documents) as rows_before, (select count(*) from uniq) as rows_after""",
    "fix_numeric_text": ctes("dirty") + f"select customer_id, {NUMBER_CHARGES} from dirty",
    "fix_dates": ctes("dirty") + f"select customer_id, {CLEAN_DATE} from dirty",
    "fix_yes_no": ctes("dirty") + f"select customer_id, {YES_NO} from dirty",
    "flag_phone": ctes("dirty") + f"select customer_id, {FLAG_PHONE} from dirty",
    "normalise": ctes("dirty") + f"select {NORMALISED} from dirty",
    "normalise_log": ctes("dirty") + ACTIONS,
    "impute": ctes("dirty") + f"select {imputed('dirty')} from dirty",
    "impute_by_type": ctes("dirty") + f"select {imputed('dirty')} from dirty",
    "impute_log": ctes("dirty") + impute_log("dirty"),
    "clean_pipeline": ctes("dirty", *CLEANING) + "select * from cleaned",
    "clean_scores": ctes("dirty", *CLEANING, scored("dirty", "raw"), scored("cleaned", "done")) + """
select raw.score as quality_before, done.score as quality_after,
  cast(cast(done.score as decimal(9, 2)) - cast(raw.score as decimal(9, 2)) as double) as quality_delta from raw, done""",
    "check_email": ctes("dirty") + result("email", "email", f"not {rx('email', EMAIL)}", "dirty"),
    "check_formats": ctes("dirty", *CLEANING) + union(format_results("cleaned")),
    "check_range": ctes("dirty", *CLEANING) + union(range_results()),
    "check_negatives": ctes("dirty", *CLEANING) + union(negative_results()),
    "allowed_values": ctes("dirty") + union(
        f"select distinct '{c}' as column_name, {c} as value from dirty where {c} is not null"
        for c in LISTED
    ),
    "check_membership": ctes("dirty", *CLEANING) + union(membership_results("dirty")),
    "validate_pipeline": ctes("dirty", *CLEANING) + all_results(),
    "health_score": ctes(
        "dirty", *CLEANING, quartiles("cleaned", [*DIRTY_NUMERIC, "monthly_charges"]),
        f"results as ({all_results()})",
        f"free as (select 1 - count(*) filter (where {BEYOND}) / cast(count(*) as double) as f"
        " from cleaned)",
        "passed as (select 1 - sum(invalid) / cast(sum(checked) as double) as r from results)",
    ) + f"""select {half_up('r', 6)} as pass_rate, {half_up('f', 6)} as anomaly_free_rate,
  {half_up('100e0 * (7e-1 * r + 3e-1 * f)', 2)} as health_score from passed, free""",
    "stream_gate": ctes("dirty", *CLEANING) + stream_results(),
}

ORACLES["synthetic_customer_ids"] = (
    "select c_custkey + 10000 as customer_id, true as score_in_range from customer"
)
ORACLES["anomalies_planted"] = (
    "select count(*) + 3 as rows_scored, 3 as planted_flagged, true as within_share from lineitem"
)
ORACLES["gate_counts"] = f"""
select rows_before, rows_after, exact_duplicates_removed, missing_before, missing_after,
  quality_before, quality_after, quality_delta, pass_rate
from ({ORACLES["dedup_log"]}), ({ORACLES["clean_scores"]}),
  (select pass_rate from ({ORACLES["health_score"]})),
  (select total_missing_cells as missing_before from ({ORACLES["missing_overall"]})),
  ({ctes("dirty", *CLEANING)} select sum({" + ".join(
      f"case when {c} is null then 1 else 0 end" for c in DIRTY_COLUMNS)}) as missing_after
   from cleaned)"""

# Deliveries of the events, and the watermark (whole milliseconds, less an hour) before each of them.
ARRIVALS = """
with bounds as (
  select min(epoch_us(ts)) as low, max(epoch_us(ts)) - min(epoch_us(ts)) + 1 as span from events),
quarters as (
  select event_id, ts, user_id, case when event_id % 19 = 0 then 'unknown' else event_type end
           as event_type,
         case when event_id % 13 = 0 then null when event_id % 17 = 0 then -value else value end
           as value,
         4 * (epoch_us(ts) - low) // span as own
  from events, bounds),
arrivals as (
  select *, case when event_id % 10 = 3 then least(own + 2, 3) else own end as delivery from quarters
  union all select *, least(own + 1, 3) from quarters where event_id % 5 = 0
  union all select *, own from quarters where event_id % 20 = 1),
marks as (
  select number, max(epoch_us(ts) // 1000 * 1000) - 3600000000 as mark
  from range(0, 5) n(number) left join arrivals on delivery < number group by number)
"""
ORACLES["stream_dedup"] = ARRIVALS + """
select distinct event_id, user_id, event_type, value
from arrivals join marks on number = delivery where mark is null or epoch_us(ts) > mark"""
_BROKEN_EVENTS = {
    "event_id": "false", "user_id": "false",
    "event_type": "event_type not in (select event_type from events where event_type is not null)",
    "value": "value < 0 or value not between (select min(value) from events)"
    " and (select max(value) from events)",
}
ORACLES["stream_quality"] = ARRIVALS + """,
days as (
  select *, date_trunc('day', ts) as day, epoch_us(date_trunc('day', ts)) + 86400000000 as day_end
  from arrivals),
told as (
  select days.* from days join marks on number = delivery
  where (mark is null or day_end > mark) and day_end <= (select mark from marks where number = 4))
""" + " union all ".join(
    f"select strftime(day, '%Y-%m-%d') as day, '{c}' as column_name, count(*) as n_rows,"
    f" count(*) - count({c}) as missing, count(*) filter ({c} is not null and ({test})) as invalid"
    f" from told group by day" for c, test in _BROKEN_EVENTS.items())


def sampled(table: str, columns: list[str]) -> str:
    patterns = {"email": EMAIL, "phone": PHONE, "postcode": POSTCODE, "person_name": PERSON,
                "numeric_like": NUMERIC}
    shares = ", ".join(
        f"round(coalesce(sum(n) filter ({rx('t', p)}), 0) / sum(n), 4) as {c}"
        for c, p in patterns.items())
    every = union(f"select '{c}' as column_name, {c} as v from {table}" for c in columns)
    counted = ctes(table, f"""cells as ({every}),
values_of as (select column_name, v, count(*) as n, sha256(v) as mark from cells
  where v is not null group by column_name, v),
sample as (select *, {trimmed('v')} as t from values_of
  qualify row_number() over (partition by column_name order by mark) <= 500)""")
    return counted + f"select column_name, {shares} from sample group by column_name"


ORACLES["sampled_ratios"] = sampled("dirty", [c for c, k, _ in COLUMNS["dirty"] if k == "text"])
ORACLES["sampled_ratios_documents"] = sampled("documents", ["text", "lang", "source"])
ORACLES["sketched_quantiles_bounded"] = (
    "select column_name, probability::double as probability, true as within from (values "
    + ", ".join(f"('{c}')" for c in LINEITEM_NUMERIC)
    + ") c(column_name), (values (0.01), (0.25), (0.5), (0.75), (0.99)) p(probability)")
_GAPS = {
    "l_orderkey": "false", "l_linenumber": "false", "l_quantity": "l_quantity > 45",
    "l_returnflag": "l_orderkey % 7 = 0", "l_tax": "l_linenumber = 3",
}
ORACLES["missing_map"] = """
with placed as (
  select *, (row_number() over (order by l_orderkey, l_linenumber, l_quantity > 45) - 1) * 50
            // count(*) over () as bucket
  from lineitem)
""" + union(
    f"select bucket::int as bucket, '{c}' as column_name, count(*) as n_rows,"
    f" count(*) filter ({gap}) as missing from placed group by bucket" for c, gap in _GAPS.items())
