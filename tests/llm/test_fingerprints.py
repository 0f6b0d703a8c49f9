"""Fingerprints against a plain Python version of the same definition."""

import hashlib
import re

import pytest
import xxhash
from conftest import SMALL
from hard_cases import hard_docs, no_docs  # noqa: F401
from pyspark.sql import functions as F

from contest_analytics.llm import fingerprints, queries


def xx(values, seed=42):
    for value in values:
        data = value.encode() if isinstance(value, str) else value.to_bytes(8, "little", signed=value < 0)
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed


def xx_int(value, seed):
    return xxhash.xxh64_intdigest(value.to_bytes(4, "little", signed=True), seed)


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return [words[i : i + 5] for i in range(max(len(words) - 4, 1))] if words else []


def plain_fingerprint(text):
    found = [xx(s) for s in shingles(text)]
    if not found:
        return ""
    bins = {}
    for h in found:
        no = (h >> 56) ^ 128  # bins are numbered in the order of signed integers
        bins[no] = min(bins.get(no, 1 << 64), h & ((1 << 56) - 1))
    out = []
    for i in range(256):
        value = bins.get(i)
        for attempt in range(fingerprints.PROBES):
            if value is not None:
                break
            h = xx_int(attempt, xx_int(i, 42))
            value = bins.get((h - (1 << 64) if h >= 1 << 63 else h) % 256)
        if value is None:
            order = {}
            for no, v in bins.items():
                h = xx_int(fingerprints.PROBES, xx_int(no, xx_int(i, 42)))
                order[h - (1 << 64) if h >= 1 << 63 else h] = v
            value = order[min(order)]
        out.append("0123456789abcdef"[xx_int(i, xx([value])) & 15])
    return "".join(out)


def jaccard(a, b):
    a, b = {tuple(s) for s in shingles(a)}, {tuple(s) for s in shingles(b)}
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.fixture(scope="module")
def small(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    return docs.toPandas().set_index("doc_id")["text"], queries.op1_fingerprints(spark, SMALL).toPandas().set_index("doc_id")


def test_equal_to_plain_version(small):
    texts, found = small
    order = sorted(texts.index, reverse=True)
    for place, doc_id in enumerate(order):
        text, following = texts[doc_id], texts[order[(place + 1) % len(order)]]
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        row = found.loc[doc_id]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        if place % 5 == 0 or len(text) < 200:
            assert row.fingerprint == plain_fingerprint(text)
            assert row.edited_fingerprint == plain_fingerprint(edited)


def test_likeness_estimates_jaccard(small):
    texts, found = small
    order = sorted(texts.index, reverse=True)
    errors = []
    for place, doc_id in enumerate(order):
        text, following = texts[doc_id], texts[order[(place + 1) % len(order)]]
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        errors.append(abs(found.loc[doc_id].near_edited - jaccard(text, edited)))
        assert abs(found.loc[doc_id].near_next - jaccard(text, following)) < 0.2
    assert sum(errors) / len(errors) < 0.05


def test_likeness_of_short_texts(spark, tmp_path):
    """Texts of 1 to 8 words that share nothing are unlike; equal ones are alike."""
    texts = [(i, " ".join(f"d{i}w{j}" for j in range(1 + i // 25))) for i in range(200)]
    spark.createDataFrame(texts, "doc_id bigint, text string").write.parquet(f"{tmp_path}/apart/documents.parquet")
    apart = queries.op1_fingerprints(spark, f"{tmp_path}/apart").collect()
    assert len(apart) == 200 and max(r.near_next for r in apart) < 0.15
    same = [(i, texts[25 * (i // 2) + 7][1]) for i in range(16)]
    spark.createDataFrame(same, "doc_id bigint, text string").write.parquet(f"{tmp_path}/same/documents.parquet")
    found = {r.doc_id: r.near_next for r in queries.op1_fingerprints(spark, f"{tmp_path}/same").collect()}
    assert all(found[i] == 1.0 if i % 2 else found[i] < 0.15 for i in range(16))


def test_short_texts_have_fingerprints_of_their_own(spark):
    texts = spark.createDataFrame([(f"one{i} two{i}",) for i in range(200)], "text string")
    found = texts.select(fingerprints.fingerprint(F.col("text")).alias("f"))
    assert found.distinct().count() == 200


def nexts(df, **options):
    made = {"size": lambda text: F.length(text)}
    rows = fingerprints.with_next(df, made, **options).collect()
    assert all(r.size == len(r.text) and r.next_size == len(r.next_text) for r in rows)
    return sorted((str(r.doc_id), r.text, r.next_text) for r in rows)


@pytest.mark.parametrize("rows_of_range", [1, 17, 5000])
def test_ranges_do_not_change_the_neighbours(spark, monkeypatch, rows_of_range):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = [tuple(r) for r in docs.orderBy(F.desc("doc_id")).collect()]
    want = sorted((str(i), t, rows[(at + 1) % len(rows)][1]) for at, (i, t) in enumerate(rows))
    monkeypatch.setattr(fingerprints, "NEIGHBOUR_ROWS", rows_of_range)
    assert nexts(docs.repartition(5)) == want


@pytest.mark.parametrize("rows_of_range", [1, 3, 5000])
def test_neighbours_of_null_and_repeated_ids(spark, monkeypatch, rows_of_range):
    """A third of the rows have no id, and some ids repeat with the same and other texts."""
    rows = [(i % 20, f"text {i % 27}") for i in range(60)] + [(None, f"none {i % 23}") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("h", F.xxhash64("text"))
    order = sorted(((r.doc_id is None, -(r.doc_id or 0), r.h, r.doc_id, r.text) for r in df.collect()), key=lambda r: r[:3])
    want = sorted((str(r[3]), r[4], order[(at + 1) % len(order)][4]) for at, r in enumerate(order))
    monkeypatch.setattr(fingerprints, "NEIGHBOUR_ROWS", rows_of_range)
    assert nexts(df.drop("h").repartition(4)) == want


def test_hard_rows(hard_docs, no_docs):
    marked = hard_docs.select("doc_id", "text", fingerprints.fingerprint(F.col("text")).alias("f")).collect()
    assert len(marked) == hard_docs.count()
    by_text = {}
    for row in marked:
        assert by_text.setdefault(row.text, row.f) == row.f
    assert by_text[None] == by_text[""] == by_text["   \n\t "] == "" and len(by_text["one"]) == 256
    texts = hard_docs.withColumn("text", F.coalesce("text", F.lit("")))
    assert fingerprints.with_next(texts, {}).count() == len(marked)
    assert fingerprints.with_next(no_docs, {"f": fingerprints.fingerprint}).count() == 0
    both = hard_docs.sparkSession.range(1).select(
        fingerprints.likeness(F.lit(""), F.lit("")).alias("a"), fingerprints.likeness(F.lit(""), F.lit("0" * 256)).alias("b")
    )
    assert tuple(both.first()) == (1.0, 0.0)
