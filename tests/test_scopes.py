import os

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from contest_analytics import session
from contest_analytics.plans import catalog
from contest_analytics.session import cut_lineage, scoped, scratch_scope


@pytest.fixture
def scratch(spark, tmp_path, monkeypatch):
    """An empty scratch folder of the test's own."""
    monkeypatch.setattr(session, "scratch_dir", lambda _: f"file://{tmp_path}")
    return tmp_path


def test_staged_tables_go_with_their_scope(spark, scratch):
    with scratch_scope(spark) as scope:
        one = cut_lineage(spark.range(5))
        kept = scope.keep(cut_lineage(one.withColumn("x", F.col("id") * 2)))
        assert len(os.listdir(scratch)) == 3
    assert len(os.listdir(scratch)) == 1 and kept.count() == 5


def test_also_after_an_error_and_a_failed_write(spark, scratch):
    with pytest.raises(Exception, match="broken"), scratch_scope(spark):
        cut_lineage(spark.range(5))
        cut_lineage(spark.range(5).select(F.raise_error(F.lit("broken")).cast("int").alias("x")))
    assert os.listdir(scratch) == []


def test_scopes_nest_and_drop_early(spark, scratch):
    with scratch_scope(spark) as outer:
        first = cut_lineage(spark.range(3))
        with scratch_scope(spark) as inner:
            second = inner.keep(cut_lineage(first))
        assert len(os.listdir(scratch)) == 2 and second.count() == 3
        outer.drop(first)
        assert len(os.listdir(scratch)) == 1
    assert os.listdir(scratch) == []


def test_cached_rows_are_released(spark, scratch):
    with scratch_scope(spark) as scope:
        rows = scope.cache(spark.range(7))
        assert rows.count() == 7 and rows.is_cached
    assert not rows.is_cached


def test_outside_a_scope_tables_stay(spark, scratch):
    cut_lineage(spark.range(2))
    assert len(os.listdir(scratch)) == 1


def test_scoped_functions_leave_their_result_only(spark, scratch):
    @scoped
    def query(spark, n):
        return cut_lineage(cut_lineage(spark.range(n)).where("id > 1"))

    assert query(spark, 5).count() == 3 and len(os.listdir(scratch)) == 1


@pytest.mark.parametrize(
    "name", ["topk_series", "auc_metric", "model_leaderboard", "cached_reports", "moments_incremental", "fitted_metrics"]
)
def test_queries_leave_one_table(spark, scratch, name):
    result = catalog.queries()[name](spark, SMALL)
    left = [entry for entry in os.listdir(scratch) if entry != "checkpoints"]
    assert len(left) == 1 and result.count() > 0


def test_the_trend_behind_a_series_is_computed_once(spark, scratch, monkeypatch):
    plans = []
    staged = session._staged
    monkeypatch.setattr(session, "_staged", lambda df, owner: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), staged(df, owner))[1])
    catalog.topk_series(spark, SMALL).collect()
    assert sum(plan.count("l_orderkey") > 0 for plan in plans) == 1
