"""Secret scan with corpus-wide ownership frequency.

Patterns give candidate spans. Who holds a candidate decides what it is: a value copied by many owners
is an example from some manual, a value that only one or two owners have looks live. Candidates are
counted by their hash over distinct repositories and owners of the whole corpus.
"""
from __future__ import annotations

import hashlib
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, hash64, looked_up, lookup, quoted, staged, unused, with_row

#: Values held by so many owners are examples.
EXAMPLE_OWNERS = 3
#: Kinds in the order of equal starts. The first three are always reported; the others are reported
#: only where the corpus says that they look live.
KINDS = ("assign", "access", "hex", "github", "jwt", "pem", "bare")
_BASE = 3

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE)
_ASSIGN_HINTS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_GITHUB = re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}")
_JWT = re.compile(r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}")
_PEM = re.compile(r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----")
_PEM_END = re.compile(r"-----END [A-Z ]{0,40}PRIVATE KEY-----")
# What follows a header without an end line: fields and an empty line, then lines of base64. A line
# break may be written as an escape, and a line may be indented, quoted or follow on the same line.
_BREAK = r"""[ \t"',]*+(?:\\r)?(?:\\n|\r?\n|\r)[ \t>#*|"']*+"""
_PEM_REST = re.compile(
    rf"(?:(?:{_BREAK}[A-Za-z][A-Za-z0-9-]*+:[^\r\n\\]*+)++{_BREAK}(?={_BREAK}))?"
    rf"(?:{_BREAK}[A-Za-z0-9+/]++=*+(?=[ \t\"',;)]*+(?:[\\\r\n]|\Z))|[ \t]++[A-Za-z0-9+/]{{32,}}+=*+)*+")
_NOT_KEY = re.compile(r"\\[rnt]|[^A-Za-z0-9+/=]")
_BARE = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
_DIGIT = re.compile(r"[0-9]")


def _pem_blocks(text: str) -> list[tuple[int, int, int, str]]:
    """Private keys from BEGIN to END, without END to the last base64 line; the value is the key
    without its line breaks. A header without a key is none."""
    found = []
    for m in _PEM.finditer(text):
        start = m.end()
        after = text.find("-----BEGIN ", start)
        closing = _PEM_END.search(text, start, after if after >= 0 else len(text))
        end = closing.end() if closing else _PEM_REST.match(text, start).end()
        value = _NOT_KEY.sub("", text[start:closing.start() if closing else end])
        if value:
            found.append((m.start(), 5, end, value))
    return found


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, value) by start and kind; offsets in code points, end exclusive."""
    found = []
    lowered = text.lower()
    if any(hint in lowered for hint in _ASSIGN_HINTS):
        for m in _ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 12:
                found.append((m.start(), 0, m.end(), m[2]))
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    if _DIGIT.search(text) or len(text) >= 16:
        found += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    for kind, hint, pattern in ((3, "gh", _GITHUB), (4, "eyJ", _JWT)):
        if hint in text:
            found += [(m.start(), kind, m.end(), m[0]) for m in pattern.finditer(text)]
    if "PRIVATE KEY" in text:
        found += _pem_blocks(text)
    if _DIGIT.search(text):
        taken = sorted((s, e) for s, _, e, _ in found)
        at = 0
        for m in _BARE.finditer(text):
            if not _DIGIT.search(m[0]):
                continue
            while at < len(taken) and taken[at][1] <= m.start():
                at += 1
            if at == len(taken) or taken[at][0] >= m.end():
                found.append((m.start(), 6, m.end(), m[0]))
    found.sort()
    return found


def joined(spans) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end, _ in spans)


def _digest(value: str) -> bytes:
    return hashlib.blake2b(value.encode(), digest_size=16).digest()


_SPANS = "array<struct<start:long,kind:int,end:long,hash:binary>>"


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: its key, base counts and digest, and all candidate spans."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [candidates(t) for t in batch.column("text").to_pylist()]
        base = [[s for s in spans if s[1] < _BASE] for spans in found]
        kind = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()),
                          ("hash", pa.binary())])
        spans = [[{"start": s, "kind": k, "end": e, "hash": _digest(v)} for s, k, e, v in row]
                 for row in found]
        counts = [pa.array([sum(s[1] == k for s in row) for row in base], pa.int64())
                  for k in range(_BASE)]
        texts = [joined(row) for row in base]
        sha = [hashlib.sha256(t.encode()).hexdigest() for t in texts]
        keys = ["row", "doc_id", "text_key", "repo", "owner"]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(k) for k in keys), *counts, pa.array(sha, pa.string()),
             pa.array(texts, pa.string()), pa.array(spans, pa.list_(kind))],
            [*keys, "n_assign", "n_access", "n_hex", "base_sha256", "base_spans", "found"])

    return arrow_map(
        with_row(docs), run,
        "row long, doc_id long, text_key long, repo string, owner string, n_assign long,"
        f" n_access long, n_hex long, base_sha256 string, base_spans string, found {_SPANS}")


def ownership(spans: DataFrame) -> DataFrame:
    """(hash, n, named, n_repos, n_owners) of every candidate; ``named``: places of base kinds.

    Places collapse to one row per hash, repository and owner before they move, so a value that
    stands in a third of all rows moves as a few rows per task.
    """
    places = spans.groupBy("hash", "repo", "owner").agg(
        F.count("*").alias("n"), F.sum((F.col("kind") < _BASE).cast("long")).alias("named"))
    return places.groupBy("hash").agg(
        F.sum("n").alias("n"), F.sum("named").alias("named"),
        F.count_distinct("repo").alias("n_repos"), F.count_distinct("owner").alias("n_owners"))


def find_secrets(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    repo: Column | None = None, owner: Column | None = None,
    example_owners: int = EXAMPLE_OWNERS,
) -> DataFrame:
    """One row per document: doc_id, text_key, n_assign, n_access, n_hex, base_sha256, spans (text),
    secrets (array of start, end of the spans that look live), n_live, n_example.

    Spans are code points, end exclusive. A value looks live if fewer than ``example_owners``
    owners hold it. Base kinds are always among the spans; further kinds only if live, and a bare
    value only if it stands elsewhere as a live base value. Null texts count as empty and have no
    spans; a null repository or owner counts as one of its own; every row is a document, also with
    a repeated doc_id; an empty table gives no rows.
    """
    owner = F.col("source") if owner is None else owner
    repo = owner if repo is None else repo
    docs = df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.coalesce(repo.cast("string"), F.lit("")).alias("repo"),
        F.coalesce(owner.cast("string"), F.lit("")).alias("owner"))
    docs = docs.withColumn("text_key", hash64("text"))
    rows = staged(scan(docs), "spans")
    spans = staged(
        rows.select("row", "repo", "owner", F.inline("found")), "places")
    judged = lookup(spans.select("row", "start", "kind", "end", "hash"), ownership(spans), "hash")
    judged = staged(judged, "judged")
    live = F.col("n_owners") < example_owners
    told = (F.col("kind") < _BASE) | (live & ((F.col("kind") < len(KINDS) - 1)
                                              | (F.col("named") > 0)))
    place = F.struct("start", "kind", "end")
    per_row = judged.filter(told).groupBy("row").agg(
        F.array_sort(F.collect_list(place)).alias("told"),
        F.array_sort(F.collect_list(F.when(live, F.struct("start", "end")))).alias("secrets"),
        F.count_if(~live).alias("n_example"))
    kinds = F.array(*(F.lit(k) for k in KINDS))
    text = F.array_join(
        F.transform("told", lambda s: F.concat_ws(
            ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"),
            s["end"].cast("string"))), ",")
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return rows.join(per_row, "row", "left").select(
        "doc_id", "text_key", "n_assign", "n_access", "n_hex", "base_sha256",
        F.coalesce(text, F.lit("")).alias("spans"), F.coalesce("secrets", none).alias("secrets"),
        F.coalesce(F.size("secrets"), F.lit(0)).cast("long").alias("n_live"),
        F.coalesce("n_example", F.lit(0)).alias("n_example"))


def redact(text: str, spans) -> str:
    """``text`` with each (start, end) replaced by a mark; overlapping spans become one."""
    out, at = [], 0
    for start, end in sorted(spans):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], "[REDACTED]"]
        at = end
    return "".join([*out, text[at:]])


def redact_secrets(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    repo: Column | None = None, owner: Column | None = None,
    example_owners: int = EXAMPLE_OWNERS,
) -> DataFrame:
    """``df`` with the live-looking secrets of its texts replaced; same rows and columns.

    Examples stay, and so does a null text. Rows that share id and text share their spans. Only rows
    that a filter of bounded size takes for those with spans move.
    """
    row_id, row_key, span_id, span_key, cuts = unused(
        df.columns, "row_id", "row_key", "span_id", "span_key", "cuts")
    found = find_secrets(df, id_col, text_col, repo, owner, example_owners)
    found = staged(found.filter("n_live > 0").select(
        "doc_id", "text_key", F.transform("secrets", lambda s: F.array(s["start"], s["end"])).alias("cuts"),
    ).dropDuplicates(["doc_id", "text_key"]), "cuts")
    rows, sure = looked_up(df, found, id_col, text_col, (row_id, row_key))
    spans = found.toDF(span_id, span_key, cuts)
    same = F.col(row_id).eqNullSafe(F.col(span_id)) & (F.col(row_key) == F.col(span_key))
    cut = F.pandas_udf(_redact_all, "string")
    hit = rows.join(spans, same, "left")
    text = F.when(F.col(cuts).isNull(), F.col(text_col)).otherwise(
        cut(F.when(F.col(cuts).isNotNull(), F.col(text_col)), cuts))
    return sure.union(hit.withColumn(text_col, text).select(*map(quoted, df.columns)))


def _redact_all(texts: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([
        text if text is None or span is None else redact(text, [tuple(x) for x in span])
        for text, span in zip(texts, spans, strict=True)], dtype=object)
