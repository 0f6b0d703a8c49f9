"""Whiten embeddings: project them on the leading eigenvectors of their covariance, scaled to variance 1.

Entries c become whole numbers, floor(64 c) + 1,000,000, so the sums and sums of products of a task are
exact and merge in any order; Spark adds them up as decimals by matrix entry. The covariance follows from
them in whole numbers, that is as if centred before multiplying, and is rounded once. Only these sums,
whose number depends on the dimension alone, reach the driver, which slices the spectrum (module
``spectrum``). A second pass whitens every row; each task ends with the sums of its whitened rows, from
which the covariance of what was really returned is measured.

Rows whose vector is null or empty, or holds null or non-finite entries, are dropped, as are those of
another dimension than most vectors have (of equally frequent ones the larger). Whole numbers beyond
2^53 are taken as 2^53. Repeated rows count and return as rows of their own, a null id stays null. There
are no more components than eigenvalues that rounding can tell from zero, so one vector, or equal ones
only, give none. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contest_analytics.llm.spectrum import leading
from contest_analytics.session import cut_lineage

COMPONENTS, SCALE, SHIFT = 32, 64, 1_000_000
LIMIT = 1 << 53
SLICE_ROWS, EXACT = 8192, 1 << 62
MOMENTS = "dim int, i int, j int, value decimal(38,0)"


def whole_numbers(lists: pa.Array) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """For each dimension the places of the sound vectors and their floor(64 c), as rows of a matrix."""
    lists = lists.cast(pa.list_(pa.float64()))
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().fill_null(float("nan")).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    found = {}
    for dim in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == dim)
        matrix = flat[(ends[rows] - dim)[:, None] + np.arange(dim)]
        sound = np.isfinite(matrix).all(1)
        with np.errstate(over="ignore"):
            whole = np.clip(np.floor(matrix[sound] * SCALE), -LIMIT, LIMIT).astype(np.int64)
        found[dim] = rows[sound], whole
    return found


def exact_product(y: np.ndarray) -> np.ndarray:
    """yᵀ y without rounding; beyond what doubles or 64-bit numbers hold exactly, in Python's whole numbers."""
    largest = float(np.abs(y).max()) if y.size else 0.0
    if largest**2 * len(y) < LIMIT:
        return (y.T.astype(float) @ y.astype(float)).astype(np.int64).astype(object)
    if largest**2 * len(y) < EXACT:
        return (y.T @ y).astype(object)
    return y.T.astype(object) @ y.astype(object)


def moments(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Sums over all sound vectors by dimension and entry: (i, j) of yᵀ y for i <= j, (i, -1) of y, (-1, -1) of 1."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for dim, (_, y) in whole_numbers(batch.column(0)).items():
                total = held.setdefault(dim, [0, np.zeros(dim, object), np.zeros((dim, dim), object)])
                for at in range(0, len(y), SLICE_ROWS):
                    part = y[at : at + SLICE_ROWS]
                    total[0] += len(part)
                    total[1] = total[1] + (part.sum(0) if np.abs(part).max() < 1 << 40 else part.astype(object).sum(0))
                    total[2] = total[2] + exact_product(part)
        for dim, (n, s, p) in held.items():
            i, j = np.triu_indices(dim)
            first = np.concatenate([[-1], np.arange(dim), i]).astype(np.int32)
            second = np.concatenate([[-1], np.full(dim, -1), j]).astype(np.int32)
            values = [n, *s.tolist(), *p[i, j].tolist()]
            columns = [pa.array(np.full(len(first), dim, np.int32)), pa.array(first), pa.array(second)]
            columns.append(pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0)))
            yield pa.RecordBatch.from_arrays(columns, ["dim", "i", "j", "value"])

    return vectors.select(column).mapInArrow(add, MOMENTS).groupBy("dim", "i", "j").agg(F.sum("value").alias("value"))


class Whitening:
    """Number of vectors, sums, covariance and leading eigenpairs of a fit."""

    def __init__(self, n: int, sums: list[int], products: list[list[int]], components: int) -> None:
        self.n, self.sums = n, sums
        dim = len(sums)
        # Exact whole numbers up to the one division: equal to centring before multiplying.
        self.covariance = np.array(
            [[(n * products[i][j] - sums[i] * sums[j]) / n**2 for j in range(dim)] for i in range(dim)]
        ).reshape(dim, dim)
        self.values, self.vectors = leading(self.covariance, components)
        self.explained = self.values / self.covariance.trace() if len(self.values) else self.values

    def deviations(self, y: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2 for each row, exact; null where a long does not hold it."""
        reach = self.n * max(1, int(np.abs(y).max(initial=0))) + max(map(abs, self.sums))
        if reach**2 * y.shape[1] < EXACT:
            return ((self.n * y - np.array(self.sums, np.int64)) ** 2).sum(1).tolist()
        exact = ((self.n * y.astype(object) - np.array(self.sums, object)) ** 2).sum(1).tolist()
        return [v if v < 1 << 63 else None for v in exact]

    def whiten(self, y: np.ndarray) -> np.ndarray:
        mean = np.array([s / self.n for s in self.sums])
        return (y - mean) @ (self.vectors / np.sqrt(self.values))


def fit(vectors: DataFrame, components: int = COMPONENTS, column: str = "embedding") -> Whitening | None:
    """Fit on all sound vectors; None without any. The driver gets a number for each pair of dimensions."""
    found: dict[int, dict] = {}
    # A dimension other than the main one brings its own matrix; only one of most vectors is collected.
    sums = cut_lineage(moments(vectors, column))
    main = sums.where("i = -1").orderBy(F.desc("value"), F.desc("dim")).limit(1).collect()
    if not main:
        return None
    dim, n = main[0].dim, int(main[0].value)
    found = {(r.i, r.j): int(r.value) for r in sums.where(F.col("dim") == dim).collect()}
    products = [[found[min(i, j), max(i, j)] for j in range(dim)] for i in range(dim)]
    return Whitening(n, [found[i, -1] for i in range(dim)], products, components)


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, key: str = "vec_id", column: str = "embedding"
) -> DataFrame:
    """A row per sound vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``."""
    spark = vectors.sparkSession
    kind = vectors.schema[key].dataType.simpleString()
    model = fit(vectors, components, column)
    k = 0 if model is None else len(model.values)
    if k == 0:
        return spark.createDataFrame(
            [], f"{key} {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
        )
    dim = len(model.sums)
    model.covariance = None  # the tasks do not need it

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, key_type = ["id", "deviation", "whitened", "sums"], None
        doubles = pa.list_(pa.float64())
        total = np.zeros((k + 1, k))
        for batch in batches:
            key_type = batch.column(0).type
            rows, y = whole_numbers(batch.column(1)).get(dim, (np.zeros(0, np.int64), np.zeros((0, dim), np.int64)))
            w = model.whiten(y)
            total[:k] += w.T @ w
            total[k] += w.sum(0)
            ends = pa.array(np.arange(0, w.size + 1, k, dtype=np.int32))
            columns = [
                batch.column(0).take(pa.array(rows)), pa.array(model.deviations(y), pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(w.reshape(-1))), pa.nulls(len(rows), doubles),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)
        if key_type is not None:  # the last row of a task holds its sums
            last = [pa.nulls(1, key_type), pa.nulls(1, pa.int64()), pa.nulls(1, doubles), pa.array([total.reshape(-1).tolist()])]
            yield pa.RecordBatch.from_arrays(last, names)

    schema = f"id {kind}, deviation bigint, whitened array<double>, sums array<double>"
    rows = cut_lineage(vectors.select(key, column).mapInArrow(project, schema))
    sums = rows.where("sums IS NOT NULL").select(F.posexplode("sums").alias("at", "value"))
    sums = {r.at: r.value for r in sums.groupBy("at").agg(F.sum("value").alias("value")).collect()}  # k (k + 1) rows
    total = np.array([sums[i] for i in range(k * (k + 1))]).reshape(k + 1, k) / model.n
    error = float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())
    explained = F.array(*(F.lit(float(e)) for e in model.explained))
    return rows.where("sums IS NULL").select(F.col("id").alias(key), "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        key,
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
