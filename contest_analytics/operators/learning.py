"""Splitting, scaling, fitting and scoring of feature tables with Spark ML."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contest_analytics.operators import metrics
from contest_analytics.session import use_checkpoints
from contest_analytics.sources.tables import literal_table

# A tree's rows keep their node from level to level, and what boosting has added up so far is written to
# the checkpoint folder every few rounds: a lost executor then replays those rounds, not all of them.
RESUMABLE = {"cacheNodeIds": True, "checkpointInterval": 5}

# A tree fit holds up to a kilobyte for each training row, and reads a part's rows in one task.
ROWS_A_PART = 400_000

# The training parameters of both profiles.
TRAIN_SHARE = 0.8
SEED = 42
CLASSIFIERS: Mapping[str, Callable[[], Estimator]] = {
    "logistic_regression": lambda: LogisticRegression(maxIter=100, regParam=0.01),
    "random_forest": lambda: RandomForestClassifier(numTrees=50, maxDepth=10, seed=SEED, **RESUMABLE),
    "gradient_boosting": lambda: GBTClassifier(maxIter=30, maxDepth=8, seed=SEED, **RESUMABLE),
}
REGRESSORS: Mapping[str, Callable[[], Estimator]] = {
    "linear_regression": lambda: LinearRegression(maxIter=100, regParam=0.01),
    "random_forest": lambda: RandomForestRegressor(numTrees=50, maxDepth=10, seed=SEED, **RESUMABLE),
    "gradient_boosting": lambda: GBTRegressor(maxIter=30, maxDepth=8, seed=SEED, **RESUMABLE),
}
LIGHT_CLASSIFIERS: Mapping[str, Callable[[], Estimator]] = {
    "random_forest": lambda: RandomForestClassifier(
        numTrees=30, maxDepth=8, impurity="gini", maxBins=32, seed=SEED, **RESUMABLE
    ),
    "gradient_boosting": lambda: GBTClassifier(maxIter=20, maxDepth=6, stepSize=0.1, seed=SEED, **RESUMABLE),
}
LIGHT_REGRESSORS: Mapping[str, Callable[[], Estimator]] = {
    "random_forest": lambda: RandomForestRegressor(
        numTrees=30, maxDepth=8, impurity="variance", maxBins=32, seed=SEED, **RESUMABLE
    ),
    "gradient_boosting": lambda: GBTRegressor(maxIter=20, maxDepth=6, stepSize=0.1, seed=SEED, **RESUMABLE),
}


def in_train(key: str, share: float = TRAIN_SHARE) -> Column:
    """Whether a key belongs to the training part.

    Decided by a hash of the key, so it stays the same for any partitioning, retry or run.
    """
    if not 0 <= share <= 1:
        raise ValueError("a share is from 0 to 1")
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") < F.lit(int(share * 2**32))


def hash_split(df: DataFrame, key: str, share: float = TRAIN_SHARE) -> tuple[DataFrame, DataFrame]:
    """Disjoint training and test part."""
    chosen = in_train(key, share)
    return df.where(chosen), df.where(~chosen)


def standardize(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Scale columns to mean 0 and sample deviation 1; statistics come from ``fit_on``.

    A constant column becomes 0.
    """
    source = df if fit_on is None else fit_on
    stats = source.agg(
        F.struct(
            *[F.avg(c).alias(f"mean_{c}") for c in columns],
            *[F.stddev_samp(c).alias(f"std_{c}") for c in columns],
        ).alias("stats")
    ).scalar()

    def scaled(c: str) -> Column:
        std = stats.getField(f"std_{c}")
        return F.when(std > 0, (F.col(c) - stats.getField(f"mean_{c}")) / std).otherwise(F.lit(0.0))

    return df.withColumns({c: scaled(c) for c in columns})


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """Collect columns into one vector column."""
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(df)


@dataclass(frozen=True)
class Prepared:
    """Training and test rows with a scaled ``features`` vector."""

    train: DataFrame
    test: DataFrame
    columns: tuple[str, ...]
    label: str

    def release(self) -> None:
        self.train.unpersist()


def fit_parts(rows: int, cores: int) -> int:
    """Parts that training rows are dealt to: as many for each core, of ``ROWS_A_PART`` rows on average at most."""
    return cores * max(1, math.ceil(rows / (ROWS_A_PART * cores)))


def prepare(table: DataFrame, columns: Sequence[str], label: str, key: str) -> Prepared:
    """Split, assemble and scale. The scaler sees training rows only; they stay on disk for the fits.

    The training rows are dealt by key to parts of bounded size, since the files they come from are read in
    parts that grow with the table. Within a part they are in order of the label: rows of like labels
    are in like nodes, so that a fit finds the statistics of a row's nodes where it left them.
    """
    train, test = hash_split(table.select(key, label, *columns), key)
    train_raw = assemble(train, columns, "raw_features").select(key, label, "raw_features")
    test_raw = assemble(test, columns, "raw_features").select(key, label, "raw_features")
    scaler = StandardScaler(
        inputCol="raw_features", outputCol="features", withMean=True, withStd=True
    ).fit(train_raw)
    parts = fit_parts(train.count(), table.sparkSession.sparkContext.defaultParallelism)
    dealt = assemble(train.repartition(parts, key).sortWithinPartitions(label, *columns), columns, "raw_features")
    train_ready = scaler.transform(dealt).select(key, label, "features")
    test_ready = scaler.transform(test_raw).select(key, label, "features")
    # The fits keep a form of their own in memory and read these rows a few times only.
    return Prepared(train_ready.persist(StorageLevel.DISK_ONLY), test_ready, tuple(columns), label)


def fit(data: Prepared, estimator: Estimator) -> Model:
    """Train on the cached rows. What the trees checkpoint meanwhile is gone afterwards."""
    use_checkpoints(data.train.sparkSession)
    return estimator.copy(
        {estimator.getParam("labelCol"): data.label, estimator.getParam("featuresCol"): "features"}
    ).fit(data.train)


def score(data: Prepared, model: Model) -> DataFrame:
    """Test rows with their prediction."""
    return model.transform(data.test)


def classifier_metrics(predictions: DataFrame, label: str, model: str) -> DataFrame:
    """One row: model, AUC, accuracy."""
    rows = predictions.select(
        label, "prediction", vector_to_array("rawPrediction").getItem(1).alias("score")
    )
    return metrics.classification_metrics(rows, "score", "prediction", label).select(
        F.lit(model).alias("model"), "auc", "accuracy"
    )


def regressor_metrics(predictions: DataFrame, label: str, model: str) -> DataFrame:
    """One row: model, RMSE, R²."""
    return metrics.regression_metrics(predictions, "prediction", label).select(
        F.lit(model).alias("model"), "rmse", "r2"
    )


def feature_importance(model: Model, columns: Sequence[str], k: int | None = None) -> DataFrame:
    """Features by importance, all or the ``k`` first; the frame has one row per feature."""
    spark = SparkSession.getActiveSession()
    rows = list(zip(columns, map(float, model.featureImportances.toArray())))
    weights = literal_table(spark, rows, {"feature": "string", "importance": "double"})
    ranked = weights.orderBy(F.desc("importance"), "feature")
    return ranked if k is None else ranked.limit(k)
