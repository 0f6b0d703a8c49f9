"""Leaks against a plain search over all windows, and the Hamming index against all pairs."""

import random
import re
from collections import Counter

from conftest import SMALL
from hard_cases import hard_docs, no_docs  # noqa: F401
from pyspark.sql import functions as F

from contest_analytics.llm import decontamination as D
from contest_analytics.llm import queries, simhash


def shingles(text):
    words = re.sub(r"[^\w\s]+|_", "", (text or "").lower()).split()
    return [tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))] if words else []


def plain(docs, items):
    out = {}
    for item_id, item in items:
        own = shingles(item)
        for doc_id, text in docs:
            all_, n = shingles(text), len(own)
            if not own or not set(own) & set(all_):
                continue
            n, best = min(n, len(all_)), 0
            for start in range(len(all_) - n + 1):
                shared = sum((Counter(all_[start : start + n]) & Counter(own)).values())
                best = max(best, shared / (n + len(own) - shared))
            if best >= 0.75:
                out[doc_id, item_id] = round(best, 6)
    return out


def test_query_against_all_windows(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    got = {(r.doc_id, r.item_id): r.similarity for r in queries.op8_benchmark_leaks(spark, SMALL).collect()}
    want = plain(docs, items)
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-6 for k in got)


def test_planted_leaks(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(30, 80)))) for i in range(20)]
    docs = []
    for i in range(60):
        inner = items[i % 20][1].split()
        for _ in range(i // 20):  # no, one or two words changed
            inner[rng.randrange(len(inner))] = "changed"
        around = [rng.choice(words) for _ in range(50)]
        cut = rng.randrange(50)
        docs.append((i, " ".join(around[:cut] + inner + around[cut:]).upper() + "!"))
    docs += [(100 + i, " ".join(rng.choice(words) for _ in range(100))) for i in range(20)]
    got = D.find_leaks(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    )
    found = {(r.doc_id, r.item_id): r.similarity for r in got.collect()}
    want = plain(docs, items)
    assert set(found) == set(want) and len(want) >= 40
    assert all(abs(found[k] - want[k]) < 1e-6 for k in want)
    clean = D.drop_leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_reordered_passages_against_all_windows(spark):
    """Halves swapped, thirds turned round, words put in or left out, in the middle and at either end."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(36, 90)))) for i in range(24)]
    docs = []
    for i in range(96):
        inner = items[i % 24][1].split()
        half, third = len(inner) // 2, len(inner) // 3
        if i // 24 == 0:
            inner = inner[half:] + inner[:half]
        elif i // 24 == 1:
            inner = inner[2 * third :] + inner[third : 2 * third] + inner[:third]
        elif i // 24 == 2:
            inner[half:half] = ["new", "words"]
        else:
            del inner[half]
        before, after = (rng.choice([0, 1, 30]) for _ in range(2))
        docs.append((i, " ".join([rng.choice(words) for _ in range(before)] + inner + [rng.choice(words) for _ in range(after)])))
    got = D.find_leaks(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    )
    found = {(r.doc_id, r.item_id): r.similarity for r in got.collect()}
    want = plain(docs, items)
    assert set(found) == set(want) and all(abs(found[k] - want[k]) < 1e-6 for k in want)
    assert sum(d < 24 for d, _ in want) >= 12  # of the swapped halves


def test_hamming_index_misses_nothing(spark):
    rng = random.Random(2)
    items = [(i, rng.getrandbits(64) - (1 << 63)) for i in range(6)]
    near = []
    for w in range(60):
        f = items[w % 6][1] & ((1 << 64) - 1)
        for bit in rng.sample(range(64), rng.randint(0, 22)):
            f ^= 1 << bit
        near.append((w, f - (1 << 64) if f >= 1 << 63 else f))
    got = D.hamming_pairs(
        spark.createDataFrame(near, "w bigint, f bigint"), spark.createDataFrame(items, "item_id bigint, f bigint"), 19
    )
    want = {(w, i) for w, f in near for i, g in items if ((f ^ g) & ((1 << 64) - 1)).bit_count() <= 19}
    assert {(r.w, r.item_id) for r in got.collect()} == want


def test_simhash(spark):
    values = [random.Random(3).getrandbits(64) - (1 << 63) for _ in range(37)]
    want = 0
    for bit in range(64):
        if 2 * sum((v >> bit) & 1 for v in values) > len(values):
            want |= 1 << bit
    got = spark.createDataFrame([(values,)], "v array<bigint>").select(simhash.simhash(F.col("v")).alias("f")).first().f
    assert got & ((1 << 64) - 1) == want


def test_hard_rows(spark, hard_docs, no_docs):
    base = " ".join(f"Word{i}" for i in range(60))
    rows = [(1, base), (1, base), (2, None), (3, ""), (4, "one"), (5, "not there at all in any text"), (None, base)]
    items = spark.createDataFrame(rows, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in D.find_leaks(hard_docs, items).collect()}
    want = set(plain([(r.doc_id, r.text) for r in hard_docs.collect()], [r for r in rows if r[1] and r[0] is not None]))
    assert got == want and (9, 4) in got
    assert D.find_leaks(no_docs, items).count() == 0
    assert D.find_leaks(hard_docs, items.limit(0)).count() == 0
    assert D.drop_leaks(hard_docs, items.limit(0)).count() == hard_docs.count()
