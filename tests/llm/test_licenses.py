"""Licence notices against a plain search of all blocks."""

import random
import re

import pytest
from conftest import SMALL
from hard_cases import DOCS, hard_docs, no_docs  # noqa: F401
from pyspark.sql import functions as F

from contest_analytics.llm import licenses as L, queries


def words_of(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles_of(text):
    w = words_of(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def plain(text, phrases, templates, per_cent=75):
    words = words_of(text)
    places = [(i, label) for p, label in phrases.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    labels, score = {label for _, label in places}, 0.0
    for block in re.split("\n[\x20\x09\x0d]*\n", text or ""):
        own = shingles_of(block)
        for label, body in templates:
            sought = shingles_of(body)
            if label and sought and 100 * len(own & sought) >= per_cent * len(sought):
                labels.add(label)
                score = max(score, len(own & sought) / len(sought))
    at = [i for i, _ in places]
    return (
        len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})),
        ",".join(sorted(labels)), 1.0 if places else score,
    )


def found(df):
    rows = df.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ","), F.array_join("labels", ","), "score")
    return sorted((tuple(r) for r in rows.collect()), key=str)


def compare(df, phrases=L.PHRASES, templates=tuple(L.TEMPLATES), per_cent=75):
    want = [(r.doc_id, *plain(r.text, phrases, templates, per_cent)) for r in df.collect()]
    assert found(L.find_licenses(df, phrases, templates, per_cent)) == sorted(want, key=str)
    return want


def test_query_against_the_plain_version(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = sorted(((r.doc_id, *plain(r.text, L.PHRASES, L.TEMPLATES)) for r in docs), key=str)
    got = queries.op13_licenses(spark, SMALL)
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == want


@pytest.mark.parametrize("per_cent", [40, 75, 100])
def test_changed_notices(spark, per_cent):
    """Notices with words changed, dropped, repeated and wrapped, near and across the threshold."""
    rng, rows = random.Random(per_cent), []
    for i in range(150):
        parts = []
        for _ in range(rng.randint(1, 4)):
            body = rng.choice(L.TEMPLATES)[1].split()
            for _ in range(rng.randint(0, 3)):
                body[rng.randrange(len(body))] = rng.choice(["other", "", "License", "the the"])
            joined = rng.choice([" ", "\n", "  ", "\n # "]).join(body)
            parts.append(joined.upper() if rng.random() < 0.2 else joined)
        rows.append((i, rng.choice(["\n\n", "\n", "\n \t\n", " "]).join(parts)))
    want = compare(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), per_cent=per_cent)
    assert len({w[6] for w in want}) > 10


def test_places_of_phrases(spark):
    texts = [
        "cc by", "CC-BY cc by", "acc by", "cc bys", "cc  by-nc; cc by\ncc by", "x all rights reserved all rights reserved y",
        "All Rights", "gnu general public license", "cc é by", "é cc by", "cc", "by cc by", "cc_by", "cc\x00by", "GENERAL PUBLIC LICENSE.",
    ]
    compare(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))


def test_hard_rows(spark, hard_docs, no_docs):
    compare(hard_docs)
    assert L.find_licenses(no_docs).count() == 0
    body = L.TEMPLATES[5][1]
    clash = spark.createDataFrame([(1, body, 3, "x"), (1, body, 4, None), (None, body, 5, "y")], "doc_id bigint, text string, k int, labels string")
    rows = L.find_licenses(clash).collect()
    assert [r.labels for r in rows] == [["mit"]] * 3 and sorted(str(r.doc_id) for r in rows) == ["1", "1", "None"]


def test_other_phrases_and_templates(spark, hard_docs):
    compare(hard_docs, {}, [])
    compare(hard_docs, {"word1 word2": "pair"}, [])
    compare(hard_docs, {}, [("a", ""), ("", "one two"), ("b", "one"), ("c", "a b c d"), ("d", "Word1 word2 word3 word4 word5 word6")])


def test_telling_words_leave_too_few_tokens():
    for per_cent in (40, 75, 100):
        chosen = set(L.telling_words(L.TEMPLATES, per_cent))
        for _, body in L.TEMPLATES:
            tokens = shingles_of(body)
            assert sum(chosen.isdisjoint(t) for t in tokens) * 100 < len(tokens) * per_cent
