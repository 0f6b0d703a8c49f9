"""The queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contest_analytics.llm import decontamination, fingerprints, fuzzy_lines, jaccard_join, licenses, mixing, oracle, resampling, secrets, suffix_dedup, token_output, toxicity, url_filters, whitening

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, by patterns and by novelty."""
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"] != "novel")
    return secrets.find_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *(secrets.count_kind(spans, kind).alias(f"n_{kind}") for kind in secrets.KINDS),
        F.sha2(secrets.joined_spans(base), 256).alias("base_sha256"),
        secrets.joined_spans(spans).alias("spans"),
    )


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mixture to the weights 3, 1, 2, ... takes of each document, and into which shards."""
    rows = mixing.allocate(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return rows.select(
        "doc_id", "size", "source_size", "target", mixing.taken_words(F.col("draws")).alias("taken"), "draws"
    )


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))
    paired = fingerprints.with_next(docs, {"fingerprint": fingerprints.fingerprint})
    edited = paired.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        "fingerprint",
        "next_fingerprint",
        fingerprints.edited_text(F.col("text"), F.col("next_text")).alias("edited"),
    )
    hashed = edited.select("*", fingerprints.fingerprint(F.col("edited")).alias("edited_fingerprint"))
    return hashed.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        fingerprints.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        fingerprints.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document, learnt from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    score = F.col("score")
    return toxicity.score_documents(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        score,
        F.when(score >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"),
        "windows",
        "worst_word",
    )


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under links of 5-word shingle sets."""
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


# The rules of the query's contract.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule and verdict of every page's url."""
    return url_filters.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op7_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps when one occurrence of each group of like lines stays."""
    kept = fuzzy_lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op8_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents."""
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses as repeated passages, and the hash of what stays."""
    spans = F.col("spans")
    removed = F.aggregate(spans, F.lit(0).cast("bigint"), lambda total, s: total + s["hi"] - s["lo"])
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size(spans).cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each document's token ids lie in the packed files, and their checksum."""
    return token_output.token_digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the leading eigenvectors of their covariance."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weight of every document under the benchmark's words, and its rank in a draw of a tenth."""
    drawn = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices of every document."""
    return licenses.find_licenses(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of the corpus pipeline, one after another."""
    from corpus_pipeline import run  # it imports this module

    return run(spark, sf_dir)


def queries() -> dict[str, Query]:
    named = [op1_fingerprints, op2_toxicity, op3_jaccard_join, op4_url_filters, op5_secret_scan, op6_mix_sources, op7_fuzzy_lines, op8_benchmark_leaks, op9_suffix_dedup, op10_token_files, op11_whitening, op12_resampling, op13_licenses, pipeline]
    return {query.__name__: query for query in named}


def oracle_sql() -> dict[str, str]:
    return oracle.statements(URL_RULES)
