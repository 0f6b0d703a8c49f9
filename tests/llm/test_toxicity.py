"""The network's gradients, its fast scoring path, its windows and its held-out accuracy."""

import zlib

import numpy as np
import pytest
from conftest import SMALL
from hard_cases import hard_docs, no_docs  # noqa: F401

from contest_analytics.llm import queries, toxicity as X


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 47, 48, 49, 200])
def test_windows_cover_and_overlap(n):
    starts = list(X.window_starts(n))
    assert starts[0] == 0 and starts[-1] + X.WINDOW >= n and all(b - a == X.STRIDE for a, b in zip(starts, starts[1:]))
    assert n <= X.WINDOW or starts[-1] + X.STRIDE < n  # no window that adds nothing


def test_gradients():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in X.initial(5).items()}
    x = rng.standard_normal((6, 3, 2 * X.HALF))
    mask = np.arange(6)[:, None] < np.array([6, 4, 1])
    target = rng.standard_normal(3)
    _, kept = X.forward(p, x, mask, keep=True)
    g, d_x = X.gradients(p, x, mask, target, kept)
    for name in ("Wf", "Wb", "Uf", "Ub", "bf", "bb", "A", "a", "v", "u", "c"):
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in p[name].shape)
            ends = []
            for step in (1e-3, -1e-3):
                q = dict(p)
                q[name] = p[name].copy()
                q[name][at] += step
                ends.append((X.forward(q, x, mask)[0] * target).sum())
            assert g[name][at] == pytest.approx((ends[0] - ends[1]) / 2e-3, rel=0.05, abs=2e-3)
    ends = []
    for step in (1e-3, -1e-3):
        moved = x.copy()
        moved[1, 1, 3] += step
        ends.append((X.forward(p, moved, mask)[0] * target).sum())
    assert d_x[1, 1, 3] == pytest.approx((ends[0] - ends[1]) / 2e-3, rel=0.05, abs=2e-3)


def test_scoring_path_equals_training_path():
    texts = [[f"w{i * j % 17}" for i in range(n)] for j, n in enumerate((0, 1, 5, 32, 33, 100), 1)]
    model = X.Model(X.initial(3), {"w1": 0, "w2": 1, "w3": 2})
    logits, owner, start = model.window_logits(texts)
    for logit, i, s in zip(logits, owner, start):
        own = texts[i][s : s + X.WINDOW]
        x = np.zeros((X.WINDOW, 1, 2 * X.HALF), np.float32)
        x[: len(own), 0] = model.vectors(own)
        assert logit == pytest.approx(X.forward(model.params, x, np.arange(X.WINDOW)[:, None] < len(own))[0][0], abs=1e-4)
    score, windows, worst = model.score(texts)
    assert windows.tolist() == [1, 1, 1, 1, 2, 6] and ((score > 0) & (score < 1)).all()
    assert model.score([])[0].size == 0


def test_learns_planted_words():
    rng = np.random.default_rng(4)
    texts, labels = [], []
    for i in range(400):
        words = [f"w{k}" for k in rng.integers(0, 300, rng.integers(5, 200))]
        if i % 4 == 0:
            for place in rng.integers(0, len(words), 2):
                words[place] = f"bad{rng.integers(0, 4)}"
        texts.append(" ".join(words)), labels.append(int(i % 4 == 0))
    model = X.fit(texts[:300], labels[:300])
    score = model.score([X.tokens(t) for t in texts[300:]])[0]
    right = (score >= X.THRESHOLD) == np.array(labels[300:])
    assert right.mean() > 0.95
    again = X.fit(texts[:300], labels[:300]).score([X.tokens(t) for t in texts[300:]])[0]
    assert np.allclose(score, again)


def test_query(spark):
    rows = queries.op2_toxicity(spark, SMALL).toPandas()
    assert sorted(rows.doc_id) == list(range(200)) and rows.score.between(0, 1).all()
    assert rows.held_out.tolist() == [zlib.crc32(str(i).encode()) % 4 == 2 for i in rows.doc_id]
    assert rows.predicted.tolist() == [int(s >= 0.3) for s in rows.score]


def test_hard_rows(spark, hard_docs, no_docs):
    model = X.fit(["bad words here", "good words here"] * 10, [1, 0] * 10)
    rows = X.score_documents(hard_docs, model, hard_docs.columns).toPandas()
    assert len(rows) == hard_docs.count() and set(hard_docs.columns) < set(rows.columns)
    same = rows[rows.text.isna() | (rows.text == "")]
    assert same.score.nunique() == 1 and len(same) == 2
    assert X.score_documents(no_docs, model).count() == 0
    labels = spark.createDataFrame([(1, None), (None, 1), (3, 1), (3, 0), (77, 1)], "doc_id bigint, toxic int")
    assert X.train(hard_docs, labels).constant is not None
    assert X.drop_toxic(hard_docs, X.train(no_docs, labels), 2.0).columns == hard_docs.columns
    assert X.train(no_docs, labels.limit(0)).constant == 0.5


def test_large_ids_beside_nulls(spark):
    """Ids above 2^53 come back whole, also with a null in their batch."""
    ids = [2**60 + 1, None, 2**60 + 3, -5]
    docs = spark.createDataFrame([(i, f"text {i}", [i]) for i in ids], "doc_id bigint, text string, more array<bigint>")
    model = X.fit(["bad words here", "good words here"] * 10, [1, 0] * 10)
    rows = X.score_documents(docs.coalesce(1), model, docs.columns).collect()
    assert [(r.doc_id, r.more) for r in rows] == [(i, [i]) for i in ids]


def test_held_out_labels(spark):
    """Held-out documents of a whole table, against their labels."""
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in queries.op2_toxicity(spark, folder).collect() if r.held_out and labels.get(r.doc_id) is not None]
    toxic, clean = ([r for r in rows if labels[r.doc_id] == k] for k in (1, 0))
    assert len(toxic) >= 100 and len(clean) >= 500
    assert sum(r.predicted for r in toxic) / len(toxic) >= 0.8
    assert sum(r.predicted for r in clean) / len(clean) <= 0.03
