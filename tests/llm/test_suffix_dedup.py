"""Suffix arrays against sorting, and removed passages against a search over all strings."""

import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from hard_cases import hard_docs, no_docs  # noqa: F401

from contest_analytics.llm import queries, suffix_dedup as S
from contest_analytics.llm.lyndon import suffix_arrays


@pytest.mark.parametrize("seed", range(40))
def test_suffix_arrays(seed):
    rng = random.Random(seed)
    letters = rng.choice([1, 2, 3, 20, 255])
    texts = [bytes(rng.randint(1, letters) for _ in range(rng.randrange(40))) * rng.randint(1, 3) for _ in range(rng.randint(1, 6))]
    bounds = np.cumsum([0] + [len(t) for t in texts])
    got = suffix_arrays(np.frombuffer(b"".join(texts), np.uint8).astype(np.int64), bounds)
    want = [int(at) + i for at, t in zip(bounds, texts) for i in sorted(range(len(t)), key=lambda i: t[i:])]
    assert got.tolist() == want


def plain(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + 400] for d in data for i in range(len(d) - 399))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - 399):
            if seen[d[i : i + 400]] > 1:
                gone[i : i + 400] = True
        kept = bytes(b for b, g in zip(d, gone) if not g)
        edges = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
        out.append((len(d), int(gone.sum()), edges, hashlib.sha256(kept).hexdigest()))
    return out


def digests(df):
    out = []
    for r in df.collect():
        out.append((r.doc_id, (r.n_bytes, sum(s.hi - s.lo for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest())))
    return out


def test_query_against_all_strings(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").toPandas()
    want = dict(zip(docs.doc_id, plain(docs.text)))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op9_suffix_dedup(spark, SMALL).collect()}
    assert got == want


def hard_texts(seed):
    rng = random.Random(seed)
    some = lambda n: "".join(rng.choice("abcdé fgh\n") for _ in range(n))
    passage = some(500)
    texts = [some(rng.randint(0, 300)) + passage + some(rng.randint(0, 300)) for _ in range(15)]
    base = some(2500)
    for _ in range(15):  # near copies
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = "Z"
        texts.append("".join(copy))
    texts += [base, base, "a" * 1500, "ab" * 400, "abc" * 500, some(399), some(400), "x" * 400, "", passage[:430], None]
    inner = some(700)
    texts.append(inner + some(100) + inner)  # repeats itself
    return texts


@pytest.mark.parametrize(("seed", "bin_bytes"), [(1, 32_768), (2, 2_000), (3, 0)])
def test_planted_repeats(spark, monkeypatch, seed, bin_bytes):
    monkeypatch.setattr(S, "BIN_BYTES", bin_bytes)  # small: the windows of most minimizers are counted by hash
    monkeypatch.setattr(S, "BATCH_BYTES", 20_000)
    texts = hard_texts(seed)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    assert [d for _, d in sorted(digests(S.remove_repeats(df)))] == plain(texts)


def test_pieces_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(S, "PIECE_BYTES", 700)
    texts = hard_texts(4)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(2)
    assert [d for _, d in sorted(digests(S.remove_repeats(df)))] == plain(texts)


def test_hard_rows(hard_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in hard_docs.collect()]
    want = sorted(zip([str(d) for d, _ in rows], plain([t for _, t in rows])))
    assert sorted((str(d), x) for d, x in digests(S.remove_repeats(hard_docs))) == want
    assert S.remove_repeats(no_docs).count() == 0


def test_memory_of_a_task_is_bounded():
    """Suffix arrays of 2 MB of bins take less than 70 MB at a time, and all bins are solved."""
    rng = random.Random(5)
    bins = []
    for m in range(1500):
        shared = rng.randbytes(500)
        bins.append((m, [(bytes([i]), rng.randbytes(89) + bytes([i]) + shared + bytes([i]) + rng.randbytes(89)) for i in range(2)]))
    tracemalloc.start()
    try:
        found = list(S.solve_bins(bins))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sorted(found) == [(m, bytes([i]), 90, 191) for m in range(1500) for i in range(2)]
    assert peak < 70 << 20


def test_kept_texts_leave_in_batches_of_bounded_size():
    texts = [f"{i}".zfill(7) * 100_000 for i in range(30)]
    kind = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
    spans = pa.array([[{"lo": 0, "hi": 7}] if i % 2 else None for i in range(30)], kind)
    batch = pa.RecordBatch.from_arrays([pa.array(range(30)), pa.array(texts), spans], ["doc_id", "text", "spans"])
    out = list(S.cut_spans([batch]))
    assert max(b.nbytes for b in out) < 6 << 20
    kept = [k for b in out for k in b.column("kept").to_pylist()]
    assert kept == [t[7 if i % 2 else 0 :].encode() for i, t in enumerate(texts)]
