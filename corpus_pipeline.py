"""The corpus pipeline: from raw documents to packed token files, one written table after another.

Every stage is a function of (spark, docs, sf_dir) and gets what its predecessor kept. All but the
last return the columns of the documents they got.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from contest_analytics.llm import decontamination, jaccard_join, mixing, queries, token_output, toxicity
from contest_analytics.session import cut_lineage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on the labels that are not held out, rejects go."""
    model = toxicity.train(docs, queries.table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked shingle sets stays."""
    return jaccard_join.drop_near_copies(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.drop_leaks(docs, queries.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents drawn to the weights of their sources; one drawn twice is two rows."""
    return mixing.mix(docs).select(*docs.columns)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token files; where each document's ids lie in them."""
    return token_output.token_digests(docs, queries.tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]

# The stages score with a trained network, draw by hashes that DuckDB lacks and run a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each result is written and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
