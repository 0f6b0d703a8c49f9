import hashlib
import math
import os
import statistics
import threading

import pytest
from conftest import SMALL, as_dicts
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from contest_analytics.operators import features, learning
from contest_analytics.plans import catalog, models
from contest_analytics.session import use_checkpoints


def test_split_is_disjoint_complete_and_independent_of_layout(spark):
    keys = spark.range(5000).withColumnRenamed("id", "match_id").union(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    train, test = learning.hash_split(keys, "match_id")
    in_train = {r.match_id for r in train.collect()}
    in_test = {r.match_id for r in test.collect()}
    assert not in_train & in_test and len(in_train | in_test) == 5001
    assert 0.77 < len(in_train) / 5001 < 0.83
    again, _ = learning.hash_split(keys.repartition(7), "match_id")
    assert {r.match_id for r in again.collect()} == in_train


def test_split_follows_the_digest_of_the_key(spark):
    keys = spark.range(2000).withColumnRenamed("id", "match_id")
    train, _ = learning.hash_split(keys, "match_id")
    expected = {k for k in range(2000) if hashlib.md5(str(k).encode()).hexdigest()[:8] < "cccccccc"}
    assert {r.match_id for r in train.collect()} == expected


def test_standardize_uses_the_statistics_of_the_fit_rows(rows):
    df = rows("k int, x double, c double", (1, 1.0, 4.0), (2, 3.0, 4.0), (3, 11.0, 4.0))
    got = as_dicts(learning.standardize(df, ["x", "c"], fit_on=df.where("k < 3")), "k")
    spread = statistics.stdev([1.0, 3.0])
    assert [r["x"] for r in got] == pytest.approx([(v - 2.0) / spread for v in (1.0, 3.0, 11.0)])
    assert [r["c"] for r in got] == [0.0, 0.0, 0.0]
    own = as_dicts(learning.standardize(df, ["x"]), "k")
    assert sum(r["x"] for r in own) == pytest.approx(0.0)


def test_prepare_scales_with_training_rows_only(spark):
    table = spark.range(400).selectExpr("id AS match_id", "CAST(id AS DOUBLE) AS x", "id % 2 AS y")
    data = learning.prepare(table, ["x"], "y", "match_id")
    try:
        values = [r[0] for r in data.train.select(vector_to_array("features")[0]).collect()]
        assert statistics.mean(values) == pytest.approx(0.0, abs=1e-9)
        assert statistics.stdev(values) == pytest.approx(1.0)
        assert data.train.count() + data.test.count() == 400
    finally:
        data.release()


def test_training_rows_come_in_parts_of_bounded_size(spark, monkeypatch):
    """Ten times the rows are ten times the parts, however few files hold them; rows lie by label."""
    monkeypatch.setattr(learning, "ROWS_A_PART", 100)
    for rows, parts in ((400, 4), (4000, 32)):
        table = spark.range(0, rows, 1, 1).selectExpr("id AS match_id", "CAST(id % 7 AS DOUBLE) AS x", "id * 31 % 50 AS y")
        data = learning.prepare(table, ["x"], "y", "match_id")
        try:
            found = data.train.rdd.glom().map(lambda part: [r.y for r in part]).collect()
        finally:
            data.release()
        assert len(found) == parts and max(map(len, found)) < 200
        assert all(labels == sorted(labels) for labels in found)
        assert sum(map(len, found)) == learning.hash_split(table, "match_id")[0].count()


def test_parameters_of_both_profiles():
    def shape(make):
        estimator = make()
        return tuple(
            estimator.getOrDefault(p)
            for p in ("numTrees", "maxIter", "maxDepth", "seed", "regParam", "stepSize", "impurity", "maxBins")
            if estimator.hasParam(p) and (estimator.isSet(p) or p == "maxBins")
        )

    assert shape(learning.CLASSIFIERS["logistic_regression"]) == (100, 0.01)
    assert shape(learning.CLASSIFIERS["random_forest"]) == (50, 10, 42, 32)
    assert shape(learning.CLASSIFIERS["gradient_boosting"]) == (30, 8, 42, 32)
    assert shape(learning.REGRESSORS["linear_regression"]) == (100, 0.01)
    assert shape(learning.REGRESSORS["random_forest"]) == (50, 10, 42, 32)
    assert shape(learning.REGRESSORS["gradient_boosting"]) == (30, 8, 42, 32)
    assert shape(learning.LIGHT_CLASSIFIERS["random_forest"]) == (30, 8, 42, "gini", 32)
    assert shape(learning.LIGHT_CLASSIFIERS["gradient_boosting"]) == (20, 6, 42, 0.1, 32)
    assert shape(learning.LIGHT_REGRESSORS["random_forest"]) == (30, 8, 42, "variance", 32)
    assert shape(learning.LIGHT_REGRESSORS["gradient_boosting"]) == (20, 6, 42, 0.1, 32)


def test_models_find_a_signal_that_is_there(spark):
    """The label depends on a feature, unlike the random outcomes of the test tables."""
    table = catalog._outcome(spark, SMALL)
    middle = table.approxQuantile("total_kills", [0.5], 0.0)[0]
    table = table.withColumn("side_a_win", (F.col("total_kills") > middle).cast("int"))
    quality, weights = models.train_classifiers(
        table,
        features.OUTCOME_FEATURES,
        features.OUTCOME_LABEL,
        {
            "logistic_regression": learning.CLASSIFIERS["logistic_regression"],
            "random_forest": learning.LIGHT_CLASSIFIERS["random_forest"],
        },
    )
    got = {r["model"]: r for r in as_dicts(quality)}
    assert set(got) == {"logistic_regression", "random_forest"}
    for row in got.values():
        assert row["auc"] > 0.9 and row["accuracy"] > 0.8
    ranked = weights.collect()
    assert len(ranked) == 10 and ranked[0].feature == "total_kills"  # of the forest; the regression has none
    assert [r.importance for r in ranked] == sorted((r.importance for r in ranked), reverse=True)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_regression_end_to_end(spark):
    table = catalog._duration(spark, SMALL).withColumn("duration", F.col("total_score") * 30 + F.col("score_a"))
    quality, weights = models.train_regressors(
        table,
        features.DURATION_FEATURES,
        features.DURATION_LABEL,
        {"linear_regression": learning.REGRESSORS["linear_regression"]},
    )
    row = quality.first()
    assert row.model == "linear_regression" and row.r2 > 0.99 and math.isfinite(row.rmse)
    assert weights.count() == 0


def test_importances_sum_to_one(spark):
    table = catalog._duration(spark, SMALL)
    data = learning.prepare(table, features.DURATION_FEATURES, "duration", "match_id")
    try:
        model = learning.fit(data, learning.LIGHT_REGRESSORS["random_forest"]())
    finally:
        data.release()
    ranked = learning.feature_importance(model, data.columns, None).collect()
    assert len(ranked) == 26
    assert sum(r.importance for r in ranked) == pytest.approx(1.0)
    assert [r.importance for r in ranked] == sorted((r.importance for r in ranked), reverse=True)


def test_split_shares_at_the_ends(spark):
    df = spark.range(1000)
    for share, low, high in ((0, 0, 0), (0.999, 980, 1000), (1, 1000, 1000)):
        train, test = learning.hash_split(df, "id", share)
        assert low <= train.count() <= high and train.count() + test.count() == 1000
    with pytest.raises(ValueError):
        learning.in_train("id", 1.5)


def _files_below(folder):
    return [os.path.join(at, name) for at, _, names in os.walk(folder) for name in names]


def test_boosting_checkpoints_and_cleans_up(spark, monkeypatch):
    """The rounds' state is written to the checkpoint folder during the fit and gone after it."""
    use_checkpoints(spark)
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    table = spark.range(400).selectExpr("id AS match_id", "CAST(id % 37 AS DOUBLE) AS x", "CAST(id % 5 > 2 AS INT) AS y")
    for estimators in (learning.CLASSIFIERS, learning.LIGHT_CLASSIFIERS):
        for name in ("random_forest", "gradient_boosting"):
            made = estimators[name]()
            assert made.getCacheNodeIds() and made.getCheckpointInterval() == 5
    seen, done = [], threading.Event()

    def watch():
        while not done.wait(0.02):
            seen.append(len(_files_below(folder)))

    before = len(_files_below(folder))
    watcher = threading.Thread(target=watch)
    watcher.start()
    data = learning.prepare(table, ["x"], "y", "match_id")
    try:
        learning.fit(data, learning.LIGHT_CLASSIFIERS["gradient_boosting"]())
    finally:
        data.release()
        done.set()
        watcher.join()
    assert max(seen) > before and len(_files_below(folder)) == before
