"""Components of linked shingle sets against all pairs in plain Python."""

import random
import re
from itertools import combinations

import pytest
from conftest import SMALL
from hard_cases import DOCS, hard_docs, no_docs  # noqa: F401

from contest_analytics.llm import jaccard_join, queries
from contest_analytics.llm.graph import components


def shingles(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def plain(rows):
    sets = [(doc_id, shingles(text)) for doc_id, text in rows]
    root = {i: i for i in range(len(sets))}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(sets)), 2):
        a, b = sets[i][1], sets[j][1]
        if a and b and 100 * len(a & b) >= 75 * len(a | b):
            root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(sets):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted((d, len(s), least.get(find(i))) for i, (d, s) in enumerate(sets) if d is not None)


def found(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect() if r.doc_id is not None)


def test_query_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert found(queries.op3_jaccard_join(spark, SMALL)) == plain([tuple(r) for r in docs])


@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies_chains_and_shared_passages(spark, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [rng.choice(words) for _ in range(70)]
    texts = []
    for _ in range(6):  # groups of near copies, some just above and some below the threshold
        base = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 20)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(copy)
    chain = [rng.choice(words) for _ in range(60)]
    for step in range(12):  # each links to the next only
        texts.append(list(chain))
        chain = chain[2:] + [rng.choice(words), rng.choice(words)]
    texts += [passage + [rng.choice(words) for _ in range(rng.randint(5, 150))] for _ in range(40)]
    texts += [[rng.choice(words) for _ in range(n)] for n in (1, 2, 3, 4, 5, 6, 7)] * 2
    rng.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert found(jaccard_join.jaccard_components(df)) == plain(rows)


def test_hard_rows(hard_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in hard_docs.collect()]
    result = jaccard_join.jaccard_components(hard_docs)
    assert result.count() == len(rows) and found(result) == plain(rows)
    assert jaccard_join.jaccard_components(no_docs).count() == 0
    kept = jaccard_join.drop_near_copies(hard_docs)
    assert kept.columns == hard_docs.columns
    want = sorted({d for d, n, c in plain(rows) if d == c and n} | {d for d, n, c in plain(rows) if not n})
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == want
    assert jaccard_join.drop_near_copies(no_docs).count() == 0


def test_near_copies_of_null_and_repeated_ids(spark):
    text, other, third = (" ".join(f"{w}{i}" for i in range(40)) for w in "abc")
    near = text.replace("a7 ", "x ")
    rows = [
        (1, text), (2, near), (2, other), (None, text), (None, near), (None, third), (None, third), (5, ""), (5, ""),
        (None, None), (7, other), (7, other), (2**60 + 1, third + " more"), (8, " \n"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    kept = [(r.doc_id, r.text) for r in jaccard_join.drop_near_copies(df).collect()]
    want = [(1, text), (2, other), (2**60 + 1, third + " more"), (5, ""), (5, ""), (None, None), (8, " \n")]
    assert sorted(kept, key=str) == sorted(want, key=str)
    only_null = spark.createDataFrame([(None, third), (None, third), (None, third + " y")], "doc_id bigint, text string")
    assert jaccard_join.drop_near_copies(only_null).count() == 1


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (200, 200), (61, 60)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.node: r.component for r in components(df).collect()}
    want = {i: 0 for i in range(51)} | {i: 100 for i in range(100, 140)} | {200: 200, 60: 60, 61: 60}
    assert got == want
