"""Frequency tables: how often each value of each column occurs.

A text value travels as its first characters (``head``) and, when it is longer
than that, a SHA-256 of the whole value (``digest``). A row of the shuffle thus
has a fixed upper size however long the texts are, and values are still told
apart over their whole length. Copies collapse before the shuffle.
"""
from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import fixed
from .columns import cells, columns_of, local_rows, typed_groups

HEAD = 64


def head_of(value: Column) -> Column:
    return F.substring(value, 1, HEAD)


def digest_of(value: Column) -> Column:
    return F.when(F.length(value) > HEAD, F.sha2(value, 256))


def text_frequencies(text_cells: DataFrame, *extra: Column) -> DataFrame:
    """(column_name, head, digest, *extra, n); ``extra`` must depend on the value only."""
    value = F.col("value")
    return text_cells.groupBy(
        "column_name", head_of(value).alias("head"), digest_of(value).alias("digest"), *extra
    ).agg(F.expr("count(*) as n"))


def first_per_column(rows: DataFrame, count: int, *order: Column) -> DataFrame:
    """The first rows of each column, with ``rank``.

    Spark trims each partition to ``count`` rows per column before the shuffle,
    so a column with many distinct values does not gather in one task.
    """
    window = W.partitionBy("column_name").orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= count)


@dataclass(frozen=True)
class _Tied:
    """Long values of a column alike in their first ``at`` characters, whose hash is ``prefix``.

    The next ``step`` characters are looked at; ``wanted`` of the ``size`` values are.
    """

    column: str
    head: str
    n: int | None
    size: int
    wanted: int
    digest: str
    at: int = HEAD
    prefix: str = ""
    step: int = HEAD
    grows: bool = True


def first_values(
    frequencies: DataFrame, text_cells: DataFrame, count: int, by_count: bool = False
) -> DataFrame:
    """The first ``count`` values of each column: column_name, rank, value, n (if ``by_count``).

    They are ordered by n, most frequent first, if ``by_count``, and then by the whole value. Values
    with a common beginning are told apart by their next characters, a part at a time: what moves of
    a value is that part and two digests, and tasks pass on the wanted number of parts. Only values that are
    in the result are fetched whole, afterwards. While all go on alike, the part looked at gets longer,
    so that a common beginning of any length takes few rounds.
    """
    spark = frequencies.sparkSession
    order = [F.desc("n")] if by_count else []
    keys = ["column_name", *(["n"] if by_count else []), "head"]
    alike = frequencies.groupBy(*keys).agg(
        F.count("*").alias("size"), F.count("digest").alias("longer"), F.max("digest").alias("digest"))
    # At most ``count`` rows per column.
    firsts: dict[str, list] = {}
    for r in first_per_column(alike, count, *order, F.asc("head")).orderBy("rank").collect():
        picks = firsts.setdefault(r["column_name"], [])
        room, n = count - _places(picks), r["n"] if by_count else None
        if room > 0 and r["longer"] < r["size"]:
            picks.append((r["head"], n))
            room -= 1
        if room > 0 and r["longer"]:
            picks.append(_Tied(r["column_name"], r["head"], n, r["longer"], min(room, r["longer"]),
                               r["digest"]))
    while any(isinstance(p, _Tied) and p.size > 1 for picks in firsts.values() for p in picks):
        open_ = [p for picks in firsts.values() for p in picks if isinstance(p, _Tied) and p.size > 1]
        parts = iter(_refined(text_cells, open_))
        for column, picks in firsts.items():
            firsts[column] = [
                q for p in picks for q in (
                    next(parts) if isinstance(p, _Tied) and p.size > 1 else [p])]

    short, long = [], []
    for column, picks in firsts.items():
        for rank, p in enumerate(picks, 1):
            if isinstance(p, _Tied):
                long.append((column, rank, p.head, p.digest, p.n))
            else:
                short.append((column, rank, *p))
    out = local_rows(spark, "column_name string, rank int, value string, n bigint", short)
    if long:
        wanted = local_rows(
            spark, "column_name string, rank int, head string, digest string, n bigint", long)
        value = F.col("value")
        # At most ``count`` digests per column.
        found = text_cells.filter(F.length(value) > HEAD).withColumn("head", head_of(value)).join(
            F.broadcast(wanted), ["column_name", "head"]).filter(digest_of(value) == F.col("digest"))
        out = out.unionByName(found.select("column_name", "rank", "value", "n").distinct())
    return out if by_count else out.drop("n")


def _places(picks: list) -> int:
    return sum(p.wanted if isinstance(p, _Tied) else 1 for p in picks)


def _refined(text_cells: DataFrame, tied: list[_Tied]) -> list[list[_Tied]]:
    """Each group parted by its next characters: the parts that hold the wanted values, in order."""
    groups = local_rows(
        text_cells.sparkSession,
        "g int, column_name string, head string, wanted_n bigint, wanted int, at int, prefix string,"
        " step int",
        [(g, t.column, t.head, t.n, t.wanted, t.at, t.prefix, t.step) for g, t in enumerate(tied)])
    value = F.col("value")
    cells_of = text_cells.filter(F.length(value) > HEAD).select(
        "column_name", head_of(value).alias("head"), "value")
    members = cells_of.join(F.broadcast(groups), ["column_name", "head"]).filter(
        f"at = {HEAD} or sha2(substring(value, 1, at), 256) = prefix")
    counted = members.groupBy(
        "g", "wanted_n", "wanted", digest_of(value).alias("digest"),
        F.expr(f"if(step = {HEAD}, substring(value, at + 1, step), null) as part"),
        F.expr("sha2(substring(value, 1, at + step), 256) as prefix"),
    ).agg(F.count("*").alias("n")).filter("wanted_n is null or n = wanted_n")
    parts = counted.groupBy("g", "wanted", "part", "prefix").agg(
        F.count("*").alias("size"), F.max("digest").alias("digest"))
    window = W.partitionBy("g").orderBy("part", "prefix")
    # A fixed limit is what Spark applies in every task before the shuffle.
    most = max(2, *(t.wanted for t in tied))
    first = parts.withColumn("place", F.row_number().over(window)).filter(
        F.col("place") <= most).filter("place <= greatest(wanted, 2)")
    out: list[list[_Tied]] = [[] for _ in tied]
    for r in first.orderBy("g", "place").collect():
        out[r["g"]].append(r)
    return [_parted(t, rows) for t, rows in zip(tied, out, strict=True)]


def _parted(t: _Tied, rows: list) -> list[_Tied]:
    if len(rows) == 1:  # all go on alike
        step = 4 * t.step if t.grows else t.step
        return [replace(t, at=t.at + t.step, prefix=rows[0]["prefix"], step=step)]
    if t.step > HEAD:  # they part somewhere in it: look closer
        return [replace(t, step=t.step // 4, grows=False)]
    parts, room = [], t.wanted
    for r in rows:
        if room > 0:
            parts.append(replace(
                t, size=r["size"], wanted=min(room, r["size"]), digest=r["digest"], at=t.at + t.step,
                prefix=r["prefix"], grows=True))
            room -= parts[-1].wanted
    return parts


def top_values(
    df: DataFrame, columns: Iterable[str] | None = None, count: int = fixed.TOP_VALUES
) -> DataFrame:
    """Most frequent values of the non-numeric columns: rank, value, n; equal counts by value."""
    names = list(columns) if columns is not None else columns_of(df, "text", "boolean", "temporal")
    text_cells = cells(df, names, "string").filter(F.col("value").isNotNull())
    return first_values(text_frequencies(text_cells), text_cells, count, by_count=True)


def modes(df: DataFrame, columns: Iterable[str]) -> dict[str, tuple]:
    """column -> (most frequent value, count); the smallest value wins a tie.

    Driver-side result of one row per column. Columns without values are absent.
    """
    found: dict[str, tuple] = {}
    for family, names in typed_groups(df, columns).items():
        long_form = cells(df, names, family).filter(F.col("value").isNotNull())
        if family == "string":
            best = first_values(text_frequencies(long_form), long_form, 1, by_count=True)
        else:
            counted = long_form.groupBy("column_name", "value").agg(F.count("*").alias("n"))
            best = first_per_column(counted, 1, F.desc("n"), F.asc("value"))
        found.update({r["column_name"]: (r["value"], r["n"]) for r in best.collect()})
    return found
