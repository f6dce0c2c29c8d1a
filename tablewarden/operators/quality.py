"""Quality score and exact duplicates, both from one grouping of equal rows."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.functions import broadcast

from ..functions import fixed
from ..functions.numbers import half_up
from ..functions.text import matches, quoted
from ..storage import stage
from .columns import kinds, local_rows, present
from .frequency import HEAD
from .measures import Measures

SCORED_PATTERNS = {"email": fixed.EMAIL, "phone": fixed.PHONE_STRICT}


def nan_to_null(df: DataFrame) -> DataFrame:
    return df.selectExpr(*[f"{present(df, c)} as {quoted(c)}" for c in df.columns])


def _null_cells(df: DataFrame) -> str:
    return " + ".join(f"if({present(df, c)} is null, 1, 0)" for c in df.columns)


def _row_groups(df: DataFrame, extra: list[str]) -> DataFrame:
    """One row per distinct row: null_cells, the ``extra`` expressions, n.

    Texts are compared by beginning and digest, so the shuffle row stays small;
    copies collapse before the shuffle, however many there are of one row.
    """
    keys = []
    for i, (name, kind) in enumerate(kinds(df).items()):
        value = present(df, name)
        if kind == "text":
            value = f"cast({value} as string)"
            keys.append(f"substring({value}, 1, {HEAD}) as k{i}")
            keys.append(f"if(length({value}) > {HEAD}, sha2({value}, 256), null) as d{i}")
        else:
            keys.append(f"{value} as k{i}")
    keyed = df.selectExpr(*keys, f"{_null_cells(df)} as null_cells", *extra)
    return keyed.groupBy(*keyed.columns).count().withColumnRenamed("count", "n")


def _scored(df: DataFrame, profile: dict | None) -> dict[str, str]:
    """Column -> pattern test, for the columns whose format counts."""
    scored = {}
    for name, column in (profile or {}).items():
        pattern = SCORED_PATTERNS.get(column["semantic_type"])
        if pattern and name in df.columns:
            scored[name] = matches(f"cast({quoted(name)} as string)", pattern)
    return scored


def score_tests(df: DataFrame, profile: dict | None) -> dict[str, str]:
    """The aggregates that a score needs beside the gaps, by name; for any pass over the table."""
    tests = {}
    for name, test in _scored(df, profile).items():
        tests[f"fits {name}"] = f"count_if({test})"
        tests[f"tested {name}"] = f"count({test})"
    return tests


def quality_score(
    df: DataFrame, profile: dict | None = None, distinct_rows: int | None = None,
    known: Measures | None = None,
) -> DataFrame:
    """0-100 score of completeness and uniqueness and, given the column profile,
    of format validity of the email and phone columns.

    With the number of distinct rows known, nothing is grouped or shuffled; with the table ``known``
    by its measures and :func:`score_tests` too, nothing is read.
    """
    scored = list(_scored(df, profile).items())
    if known is not None and distinct_rows is not None:
        row = (known.rows, sum(known.gaps.values()), distinct_rows,
               *[known.extra[f"{k} {c}"] for c, _ in scored for k in ("fits", "tested")])
        fields = "".join(f", f{i} bigint, t{i} bigint" for i in range(len(scored)))
        sums = local_rows(
            df.sparkSession, f"n bigint, nulls bigint, distinct_n bigint{fields}", [row])
    else:
        tests = [f"{test} as m{i}" for i, (_, test) in enumerate(scored)]
        if distinct_rows is None:
            groups, distinct = _row_groups(df, tests), "count(*)"
        else:
            groups = df.selectExpr(f"{_null_cells(df)} as null_cells", *tests, "1L as n")
            distinct = f"{distinct_rows}L"
        sums = groups.selectExpr(
            "sum(n) as n", "sum(null_cells * n) as nulls", f"{distinct} as distinct_n",
            *[e for i in range(len(scored)) for e in (
                f"sum(if(m{i}, n, 0L)) as f{i}", f"sum(if(m{i} is null, 0L, n)) as t{i}")])
    shares = [f"try_divide(f{i}, t{i})" for i in range(len(scored))]
    total = sums.selectExpr(
        f"1 - try_divide(nulls, n * {len(df.columns)}) as completeness",
        "1 - try_divide(n - distinct_n, n) as uniqueness",
        f"array_compact(array({', '.join(shares)})) as shares" if shares
        else "cast(array() as array<double>) as shares",
    ).selectExpr(
        "completeness", "uniqueness",
        "coalesce(try_divide(aggregate(shares, 0D, (a, x) -> a + x), size(shares)), 1D) as validity",
    )
    rounded = ["round(completeness, 6) as completeness", "round(uniqueness, 6) as uniqueness"]
    if profile is None:
        complete, unique = fixed.BASE_WEIGHTS
        score = f"100D * ({complete}D * completeness + {unique}D * uniqueness)"
        return total.selectExpr(
            *rounded,
            f"{half_up(score, 2)} as score",
        )
    complete, unique, valid = fixed.PROFILE_WEIGHTS
    score = f"100D * ({complete}D * completeness + {unique}D * uniqueness + {valid}D * validity)"
    return total.selectExpr(
        *rounded,
        "round(validity, 6) as validity",
        f"{half_up(score, 2)} as score",
    )


def drop_duplicates(df: DataFrame) -> DataFrame:
    """One of each group of equal rows; missing values equal each other."""
    return nan_to_null(df).dropDuplicates()


#: Repeated digests that are broadcast, some 24 MB; beyond it most of the table moves anyway.
DIGESTS_MOST = 1_000_000


def drop_duplicates_in_place(df: DataFrame, digests_most: int = DIGESTS_MOST) -> DataFrame:
    """As :func:`drop_duplicates`, but only rows that may have an equal move.

    A 64-bit digest of every row is counted first. Rows whose digest stands alone have no equal and stay
    where they are; the others are compared exactly, so a collision moves two rows and loses none. The
    table is read three times instead of being shuffled once: worth it for wide rows with few copies.
    With more than ``digests_most`` repeated digests, or a map in a row, all rows move.
    """
    rows = nan_to_null(df)
    if not df.columns or "map<" in df.schema.simpleString():
        return rows.dropDuplicates()
    digest = "digest"
    while digest.lower() in {c.lower() for c in df.columns}:
        digest += "_"
    columns = ", ".join(map(quoted, df.columns))
    marked = rows.selectExpr("*", f"xxhash64({columns}) as {digest}")
    repeated = stage(
        marked.groupBy(digest).count().filter("count > 1").select(digest), "repeated")
    if repeated.count() > digests_most:
        return rows.dropDuplicates()
    own = list(map(quoted, df.columns))
    alone = marked.join(broadcast(repeated), digest, "left_anti").select(*own)
    others = marked.join(broadcast(repeated), digest, "left_semi").select(*own)
    return alone.union(others.dropDuplicates())


def dedup_log(
    df: DataFrame, unique: DataFrame | None = None, counts: tuple[int, int] | None = None
) -> DataFrame:
    """Removed, before and after; only counts where the distinct rows are at hand, and nothing where
    ``counts`` (before, after) are."""
    if counts is not None:
        return local_rows(
            df.sparkSession, "exact_duplicates_removed bigint, rows_before bigint, rows_after bigint",
            [(counts[0] - counts[1], *counts)])
    if unique is not None:
        before = df.selectExpr("count(*) as before", "0L as after")
        after = unique.selectExpr("0L", "count(*)")
        return before.union(after).selectExpr(
            "sum(before) - sum(after) as exact_duplicates_removed",
            "sum(before) as rows_before",
            "sum(after) as rows_after",
        )
    return _row_groups(df, []).selectExpr(
        "coalesce(sum(n - 1), 0L) as exact_duplicates_removed",
        "coalesce(sum(n), 0L) as rows_before",
        "count(*) as rows_after",
    )
