"""Corpus pipeline over ``documents``: clean, de-duplicate, mix and encode.

STAGES lists (name, function) in order. A function takes (spark, docs, sf_dir) and returns a DataFrame, which
is written as Parquet into the shared folder and read again as the next one's docs, so a lost
executor costs at most one stage's tasks. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arbiter.llm.common import read_table, stage
from arbiter.llm.line_dedup import deduplicate_lines
from arbiter.llm.mixing import mix
from arbiter.llm.quality_rules import clean
from arbiter.llm.sentence_pieces import encode
from arbiter.llm.simhash_dedup import one_of_each
from arbiter.session import apply_session_conf


def _with_length(docs: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like``, with n_chars (if there) counted anew from the text."""
    if "n_chars" in like.columns:
        docs = docs.withColumn("n_chars", F.length("text").cast(like.schema["n_chars"].dataType))
    return docs.select(*like.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops rejected documents; the others lose the lines that failed."""
    return _with_length(clean(docs), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, without the lines that a smaller id owns."""
    return _with_length(deduplicate_lines(docs), docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest id."""
    return one_of_each(docs, words=4, max_bits=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mix(docs)


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of every document of the mix."""
    return encode(docs)


def _stage(fn: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage under the library's session settings."""
    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        apply_session_conf(spark)
        return fn(spark, docs, sf_dir)
    return run_stage


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", _stage(quality_rules)),
    ("line_dedup", _stage(line_dedup)),
    ("simhash_dedup", _stage(simhash_dedup)),
    ("mix_sources", _stage(mix_sources)),
    ("sentence_pieces", _stage(sentence_pieces)),
]

# Fingerprint components, the budget fit and the lattice aren't expressed in SQL; tests hold a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, fn in STAGES:
        docs = stage(fn(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
