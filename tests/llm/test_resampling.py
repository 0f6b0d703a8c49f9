"""Importance resampling against a plain version, its table against a dict, and ranks without one task."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from conftest import SMALL
from hard_cases import DOCS, hard_docs, no_docs  # noqa: F401
from pyspark.sql import functions as F

from contest_analytics.llm import queries, resampling as R


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def features_of(text, grams=1):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered(text))
    return [" ".join(words[i : i + k]) for k in range(1, grams + 1) for i in range(len(words) - k + 1)], len(words)


def plain(docs, target, grams=1, buckets=10_000, least=20, share=(10, 100), seed=2024):
    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets

    s = Counter(bucket(f) for _, text in docs for f in features_of(text, grams)[0])
    t = Counter(bucket(f) for text in target for f in features_of(text, grams)[0])
    s_all, t_all = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all))) for b in s}
    rows = []
    for doc_id, text in docs:
        own, words = features_of(text, grams)
        weight = sum(gain[bucket(f)] for f in own)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, words, len(own), weight, score, None])
    enough = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for rank, row in enumerate(enough[: len(enough) * share[0] // share[1]], 1):
        row[5] = rank
    return rows


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is None, v or 0) for v in r))


def test_query_against_the_plain_version(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    want = [(r[0], r[2], r[3], r[4], r[5]) for r in plain(docs, items)]
    found = queries.op12_resampling(spark, SMALL)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert ordered(found.collect()) == ordered(want)


@pytest.mark.parametrize("grams", [1, 3])
def test_hard_rows(spark, hard_docs, no_docs, monkeypatch, grams):
    monkeypatch.setattr(R, "CHUNK_BYTES", 3000)  # the long text goes in pieces
    rows = [(r.doc_id, r.text) for r in hard_docs.collect()]
    target = [(1, "Word1 word2 WORD3 über", None, None, None), (2, None, None, None, None)]
    found = R.resample(hard_docs, spark.createDataFrame(target, DOCS), grams, 50, 2, (1, 2), 7)
    assert set(hard_docs.columns) < set(found.columns)
    got = found.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()
    want = plain(rows, [t[1] for t in target], grams, 50, 2, (1, 2), 7)
    # Equal rows may change places.
    assert ordered(r[:5] for r in got) == ordered(r[:5] for r in want)
    assert sorted(r.rank for r in got if r.rank) == sorted(r[5] for r in want if r[5])
    none = R.resample(no_docs, hard_docs)
    assert none.count() == 0 and "rank" in none.columns
    alone = R.resample(hard_docs.select("doc_id", "text"), no_docs).select("doc_id", "n_words", "n_features", "weight").collect()
    assert ordered(alone) == ordered(r[:4] for r in plain(rows, []))


def test_reruns_and_other_layouts_agree(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    one, two = (ordered(R.resample(d, items, keep=["doc_id"]).collect()) for d in (docs, docs.repartition(7)))
    assert one == two


@pytest.mark.parametrize("parts", ["1", "7"])
def test_ranks(spark, parts):
    rng = random.Random(3)
    rows = [(i, rng.randrange(50)) for i in range(3000)] + [(i + 3000, 7) for i in range(1500)]  # a third ties
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.createDataFrame(rows, "id int, v int").repartition(5)
        got = [(r.id, r.v) for r in R.ranked(df, [F.col("v").desc(), F.col("id")]).orderBy("rank").collect()]
        ranks = [r["rank"] for r in R.ranked(df, [F.col("v").desc(), F.col("id")]).orderBy("rank").collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == sorted(rows, key=lambda r: (-r[1], r[0])) and ranks == list(range(1, 4501))


def random_texts(seed):
    rng = random.Random(seed)
    words = lambda: " ".join("".join(rng.choices("abcXYZé9漢", k=rng.randint(1, 45))) for _ in range(rng.randint(0, 60)))
    return [None, b"", b"A b, C!", b"--"] + [words().encode() for _ in range(120)]


@pytest.mark.parametrize("grams", [1, 2, 4])
@pytest.mark.parametrize("most", [40, 1000, 10**6])
def test_features_and_table(grams, most):
    texts, found, counts = random_texts(grams), Counter(), np.zeros(97, np.int64)
    for pieces in R.batches_of(texts, grams, most):
        features = R.Features(pieces, grams)
        hashes = R.hashes_of(features.data, features.start, features.end)
        own = [features.bytes_of(i) for i in range(len(features.start))]
        assert hashes.tolist() == [xxhash.xxh64_intdigest(b) for b in own]
        found.update(zip(features.row.tolist(), own))
        for used in (hashes, hashes & np.uint64(7), np.zeros_like(hashes)):  # colliding keys need the bytes
            table = R.GramTable(features, 97, used)
            assert [features.bytes_of(i) for i in table.occurrence[table.slot].tolist()] == own
            by_bytes = {features.bytes_of(table.occurrence[s]): int(table.count[s]) for s in table.used.tolist()}
            assert by_bytes == Counter(own) and len(table.used) == len(by_bytes)
        counts += table.by_bucket(97)
    want = Counter((i, f.encode()) for i, t in enumerate(texts) for f in features_of((t or b"").decode(), grams)[0])
    assert found == want
    assert counts.tolist() == [sum(n for (_, f), n in want.items() if zlib.crc32(f) % 97 == b) for b in range(97)]
