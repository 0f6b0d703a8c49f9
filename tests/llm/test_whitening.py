"""Whitening against a plain eigendecomposition, and the spectrum slicing by itself."""

import math
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL

from contest_analytics.llm import queries, spectrum as S, whitening as W

VECTORS = "vec_id bigint, embedding array<float>, label int"


def plain(vectors, components=32):
    """(vec_id, component) -> (deviation, |whitened|), n and explained, straight from the definition."""
    rows = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in vectors if v and all(c is not None and math.isfinite(c) for c in v)]
    n = len(rows)
    x = np.array([v for _, v in rows], dtype=object)
    sums = x.sum(0)
    centred = np.array([[float(Decimal(int(n * a - s)) / n) for a, s in zip(row, sums)] for row in x])
    values, vecs = np.linalg.eigh(centred.T @ centred / n)
    values, vecs = values[::-1][:components], vecs[:, ::-1][:, :components]
    white = centred @ vecs / np.sqrt(values)
    explained = values / (centred**2).mean(0).sum()
    out = {}
    for (i, _), row, w in zip(rows, x, white):
        deviation = int(sum((n * a - s) ** 2 for a, s in zip(row, sums)))
        out |= {(i, k + 1): (deviation, w[k]) for k in range(len(values))}
    return out, n, explained


def check(rows, vectors, components=32):
    want, n, explained = plain(vectors, components)
    assert {(r.vec_id, r.component) for r in rows} == set(want) and len(rows) == len(want)
    signs: dict[int, float] = {}
    for r in rows:
        deviation, w = want[r.vec_id, r.component]
        assert r.n == n and r.deviation == deviation and abs(r.identity_error) <= 1e-4
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        if abs(w) > 1e-6:
            sign = signs.setdefault(r.component, math.copysign(1, w * r.whitened))  # one sign for all rows
            assert r.whitened == pytest.approx(sign * w, rel=1e-6, abs=1e-8)
    return rows


def test_query_against_a_plain_decomposition(spark):
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    check(queries.op11_whitening(spark, SMALL).collect(), vectors)


@pytest.mark.parametrize("dim", [1, 3, 17])
def test_awkward_vectors(spark, dim):
    rng = np.random.default_rng(dim)
    sound = [(i, [float(v) for v in rng.normal(0, 3, dim)]) for i in range(60)]
    repeated = sound[:5]
    unsound = [(100, None), (101, [None] * dim), (102, [float("nan")] * dim), (103, [float("inf")] * dim), (104, [])]
    rows = [(i, v, 1) for i, v in [*sound, *unsound, *repeated]]
    found = W.whiten(spark.createDataFrame(rows, VECTORS).repartition(4), 8).collect()
    assert len(found) == 65 * min(8, dim)
    n = 65
    values = np.array([[math.floor(64 * np.float32(c)) for c in v] for _, v in [*sound, *repeated]])
    for r in found:
        own = next(np.array([math.floor(64 * np.float32(c)) for c in v]) for i, v in sound if i == r.vec_id)
        assert r.n == n and r.deviation == int(((n * own - values.sum(0)) ** 2).sum()) and r.identity_error < 1e-8
    other = [(200, [1.0] * (dim + 1), 0)]  # a vector of another dimension is left out
    more = spark.createDataFrame(rows + other, VECTORS)
    assert {r.vec_id for r in W.whiten(more, 8).collect()} == {i for i, _ in sound}


def test_no_direction_no_rows(spark):
    schema = W.whiten(spark.createDataFrame([], VECTORS)).columns
    assert schema == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, [0.5, 0.25], 0)], [(1, [0.5, 0.25], 0)] * 9, [(1, None, 0)]):
        assert W.whiten(spark.createDataFrame(rows, VECTORS)).count() == 0


def test_a_flat_dimension_gives_no_component(spark):
    rows = [(i, [float(i % 7), 2.0, float(i % 5)], 0) for i in range(50)]
    found = W.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    assert {r.component for r in found} == {1, 2} and all(r.identity_error < 1e-9 for r in found)
    assert sum({r.component: r.explained for r in found}.values()) == pytest.approx(1.0)


def test_ids_and_clashing_columns(spark):
    rows = [(2**60 + 1, [1.0, 2.0], 5), (None, [3.0, 1.0], 5), (-4, [0.0, 0.5], 5)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, n int").coalesce(1)
    found = W.whiten(df).collect()
    assert {r.vec_id for r in found} == {2**60 + 1, None, -4} and all(r.n == 3 for r in found)


def test_exact_products():
    rng = np.random.default_rng(1)
    for scale in (10, 2**20, 2**31, 2**53):
        y = rng.integers(-scale, scale, (40, 3))
        want = [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j])) for j in range(3)] for i in range(3)]
        assert W.exact_product(y).tolist() == want


def test_large_entries_stay_exact():
    model = W.Whitening(3, [3 * 2**50, 0], [[3 * 2**100, 5], [5, 7]], 0)
    assert model.deviations(np.array([[2**50, 1]])) == [9]
    assert model.deviations(np.array([[2**53, 1]])) == [None]  # beyond a long


def test_whole_numbers_of_all_shapes():
    lists = pa.array([[0.5, 1.0], None, [], [float("nan"), 0.0], [1.0], [-0.001, 2.0]], pa.list_(pa.float32()))
    found = W.whole_numbers(lists)
    assert found[2][0].tolist() == [0, 5] and found[2][1].tolist() == [[32, 64], [-1, 128]] and found[1][0].tolist() == [4]


@pytest.mark.parametrize("dim", [1, 2, 6, 40])
@pytest.mark.parametrize("kind", ["random", "repeated", "steep", "equal", "indefinite"])
def test_spectrum(dim, kind):
    rng = np.random.default_rng(dim)
    q = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    values = {
        "random": rng.random(dim) * 10, "repeated": np.round(rng.random(dim) * 3), "steep": 10.0 ** -np.arange(dim),
        "equal": np.full(dim, 2.0), "indefinite": rng.standard_normal(dim),
    }[kind]
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    known = np.linalg.eigvalsh(a)
    for shift in rng.standard_normal(8):
        assert S.count_above(a, shift) == (known > shift).sum()
    found, vectors = S.leading(a, 12)
    want = known[::-1][: len(found)]
    assert len(found) == min(12, (known > S.ZERO * np.abs(a).sum(0).max()).sum())
    assert np.allclose(found, want, atol=1e-13 * max(1, abs(known).max()))
    assert np.abs(a @ vectors - vectors * found).max(initial=0) < 1e-12 * max(1, abs(known).max())
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max(initial=0) < 1e-10
    assert len(S.leading(np.zeros((dim, dim)), 5)[0]) == 0
