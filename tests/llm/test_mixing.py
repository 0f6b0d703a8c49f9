"""The mixture keeps its quotas and targets."""

import numpy as np
import pytest
from conftest import SMALL
from hard_cases import hard_docs, no_docs  # noqa: F401
from pyspark.sql import functions as F

from contest_analytics.llm import mixing, queries


def test_fill_targets():
    assert mixing.fill_targets([100, 100], [1, 1], 300, 2) == [150, 150]
    assert mixing.fill_targets([10, 100, 100], [3, 1, 2], 315, 2) == pytest.approx([20, 295 / 3, 590 / 3])
    assert mixing.fill_targets([100, 0], [1, 1], 150, 2) == [150, 0]
    assert mixing.fill_targets([], [], 0, 2) == []


def test_leaves_keep_all_quotas():
    quotas = np.array([5, 0, 91, 17])
    parts = [mixing.split_quotas(i, 7, quotas, 3) for i in range(7)]
    assert (sum(q for q, _ in parts) == quotas).all()
    assert [int(q.sum()) for q, _ in parts] in ([16] * 6 + [17], [int(q.sum()) for q, _ in parts])
    assert max(q.sum() for q, _ in parts) - min(q.sum() for q, _ in parts) <= 2
    start = np.zeros(4, int)
    for q, before in parts:
        assert (before == start).all()
        start += q


def test_query_against_plain_targets(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").toPandas()
    found = queries.op6_mix_sources(spark, SMALL).toPandas().set_index("doc_id")
    docs["size"] = [len(t.encode().split()) for t in docs.text]
    assert (found["size"].sort_index().to_numpy() == docs.sort_values("doc_id")["size"].to_numpy()).all()
    names = sorted(docs.source.unique())
    sizes = docs.groupby("source")["size"].sum()
    want = mixing.fill_targets([int(sizes[n]) for n in names], [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5 * docs["size"].sum(), 2)
    assert sum(want) == pytest.approx(1.5 * docs["size"].sum())
    joined = docs[["doc_id", "source"]].join(found, on="doc_id")
    for name, target in zip(names, want):
        own = joined[joined.source == name]
        assert own.target.iloc[0] == pytest.approx(target) and own.source_size.iloc[0] == sizes[name]
        assert abs(own.taken.sum() - target) <= 1
    assert (found.taken <= 2 * found["size"]).all()
    again = queries.op6_mix_sources(spark, SMALL).toPandas().set_index("doc_id")
    assert (again.taken.sort_index() == found.taken.sort_index()).all()


def test_mix_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("shard", F.lit("mine"))
    for cut in (False, True):
        options = {"block_docs": 3, "shard_blocks": 4, "cut": cut}
        rows = mixing.mix(docs, **options).toPandas()
        taken = mixing.allocate(docs, keep=["doc_id"], block_docs=3, cut=cut).toPandas()
        want = {r.doc_id: sum(d.words for d in r.draws) for r in taken.itertuples()}
        have = rows.groupby("doc_id").words.sum().to_dict()
        assert have == {k: v for k, v in want.items() if v}
        assert [len(t.encode().split()) for t in rows.text] == rows.words.tolist()
        for _, shard in rows.groupby("shard"):
            assert sorted(shard.position) == list(range(len(shard)))
        assert rows["shard"].nunique() > 3


def test_hard_rows(hard_docs, no_docs):
    rows = mixing.allocate(hard_docs).toPandas()
    assert len(rows) == hard_docs.count() and set(hard_docs.columns) <= set(rows.columns)
    for _, own in rows.groupby(rows.source.fillna("-")):
        assert abs(sum(d.words for draws in own.draws for d in draws) - own.target.iloc[0]) <= 1
    assert mixing.allocate(no_docs).count() == 0 and mixing.mix(no_docs).count() == 0
