"""From raw documents to packed training sequences: five stages, each over all that the one before kept.

quality -> exact duplicates -> near-duplicates -> secrets -> packing. Every stage's result is written
as Parquet and read again by the next one, so a lost executor costs a reread.
"""
from __future__ import annotations

import functools
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from public_tokenizers import path as tokenizer_path  # noqa: E402

from tablewarden.llm.common import owning, release, staged  # noqa: E402
from tablewarden.llm.exact_dedup import drop_exact_duplicates  # noqa: E402
from tablewarden.llm.near_dup import drop_near_duplicates  # noqa: E402
from tablewarden.llm.packing import pack  # noqa: E402
from tablewarden.llm.quality import keep_quality  # noqa: E402
from tablewarden.llm.secrets import redact_secrets  # noqa: E402


#: What stages called one by one have staged and is not deleted yet, but for the last stage's.
_LEFT: list[list] = []


def _stage(function):
    """A stage called on its own first deletes what the stage before it had staged: its documents are
    that stage's result, written. Nobody knows when the last stage's result is, so its copies stay."""
    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if function.__name__ != STAGES[0][0]:
            while _LEFT:
                release(spark, _LEFT.pop())
        if function.__name__ == STAGES[-1][0]:
            return function(spark, docs, sf_dir)
        with owning() as owned:
            out = function(spark, docs, sf_dir)
        _LEFT.append(owned)
        return out

    return run_stage


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; learnt from the labelled ones among them."""
    return keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@_stage
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each different text."""
    return drop_exact_duplicates(docs)


@_stage
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return drop_near_duplicates(docs)


@_stage
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with credentials that look live replaced by a mark; n_chars follows."""
    out = redact_secrets(docs, owner=F.col("source"), repo=F.concat_ws("/", "source", "lang"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))


@_stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return pack(docs, tokenizer_path("word_bpe_49k.json")).drop("row")


STAGES = [
    ("quality", quality), ("exact", exact), ("near", near), ("secrets", secrets),
    ("packing", packing),
]

#: Classifier, Jaccard components and packing have no SQL; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in a row. A run owns what it stages and deletes it as soon as the stage's result is
    written; what the returned rows are read from stays."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES[:-1]:
        with owning() as inner:
            out = stage.__wrapped__(spark, docs, sf_dir)
            with owning() as written:
                docs = staged(out, name)
        release(spark, inner)
        release(spark, before)
        before = written
    packed = STAGES[-1][1].__wrapped__(spark, docs, sf_dir)
    release(spark, before)  # its tokens are staged
    return packed
