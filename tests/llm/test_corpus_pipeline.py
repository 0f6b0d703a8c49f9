"""The pipeline's stages one by one, each against its own input."""

import pytest
from conftest import SMALL
from hard_cases import hard_docs, no_docs  # noqa: F401
from test_jaccard_join import plain as plain_components

import corpus_pipeline
from contest_analytics.llm import mixing, toxicity
from contest_analytics.session import cut_lineage


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        result = cut_lineage(stage(spark, docs, SMALL))
        out.append((name, docs.toPandas(), result.toPandas()))
        docs = result
    return {name: (before, after) for name, before, after in out}


def test_names_and_columns(stages):
    assert list(stages) == ["toxicity", "near_copies", "decontamination", "mixing", "tokens"]
    for name in list(stages)[:-1]:
        before, after = stages[name]
        assert list(before.columns) == list(after.columns)


def test_toxicity(spark, stages):
    before, after = stages["toxicity"]
    docs = spark.createDataFrame(before)
    model = toxicity.train(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    scores = toxicity.score_documents(docs, model).toPandas()
    assert set(after.doc_id) == set(scores[scores.score < toxicity.THRESHOLD].doc_id)


def test_near_copies(stages):
    before, after = stages["near_copies"]
    want = {d for d, n, c in plain_components(list(zip(before.doc_id, before.text))) if d == c or n == 0}
    assert set(after.doc_id) == want and len(after) == len(want)


def test_decontamination_only_drops(stages):
    before, after = stages["decontamination"]
    assert set(after.doc_id) <= set(before.doc_id) and len(after) > 0.8 * len(before)


def test_mixing(stages):
    before, after = stages["mixing"]
    size = {d: len(t.encode().split()) for d, t in zip(before.doc_id, before.text)}
    taken = after.doc_id.map(size).groupby(after.doc_id).sum()
    assert all(n <= 2 * size[d] for d, n in taken.items())
    by_source = before.assign(size=before.doc_id.map(size)).groupby("source")["size"]
    sums, largest = by_source.sum(), by_source.max()
    names = sorted(sums.index)
    targets = mixing.fill_targets([int(sums[n]) for n in names], [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5 * sums.sum(), 2)
    got = after.assign(size=after.doc_id.map(size)).groupby("source")["size"].sum()
    for name, target in zip(names, targets):
        assert abs(got[name] - target) <= largest[name]


def test_tokens(stages):
    before, after = stages["tokens"]
    assert sorted(after.doc_id) == sorted(before.doc_id)
    ordered = after.sort_values("start")
    assert (ordered.start.to_numpy()[1:] == (ordered.start + ordered.n_tokens).to_numpy()[:-1]).all()


def test_hard_rows(spark, hard_docs, no_docs):
    for docs in (hard_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            result = stage(spark, docs, SMALL)
            assert name == "tokens" or result.columns == docs.columns
            result.count()
