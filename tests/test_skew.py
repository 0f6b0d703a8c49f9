"""Hot keys: a third of all rows belongs to one match."""

import pytest
from pyspark.sql import functions as F

from contest_analytics.operators import keyed, trends, winrates
from contest_analytics.operators.enrich import enrich

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def small_partitions(spark):
    old = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in old.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture
def hot(spark):
    """60,000 draft rows, 20,000 of them of match 7; every match has one parent row."""
    drafts = spark.range(0, 60_000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 997).cast("bigint").alias("match_id"),
        (F.col("id") % 50).alias("entity_id"),
        (F.col("id") % 2).cast("int").alias("side"),
        (F.col("id") % 5 != 0).cast("int").alias("is_pick"),
    )
    matches = spark.range(0, 997, 1, 4).select(
        F.col("id").alias("match_id"),
        (F.col("id") % 4 + 2020).cast("int").alias("yr"),
        (F.col("id") * 4).cast("int").alias("duration"),
        (F.col("id") % 2 == 0).alias("side_a_win"),
    )
    return drafts, matches


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["left", "inner"])
def test_enrichment_splits_the_hot_match(small_partitions, hot, how):
    drafts, matches = hot
    trend = trends.rate_trend(enrich(drafts, matches, "match_id", ["yr"], how))
    assert "SortMergeJoin(skew=true)" in final_plan(trend)
    assert trend.agg(F.sum("total_appearances")).first()[0] == 60_000


def test_phase_win_rate_splits_the_hot_match(small_partitions, hot):
    rates = winrates.phase_win_rate(*hot, min_count=0)
    assert "SortMergeJoin(skew=true)" in final_plan(rates)
    assert rates.agg(F.sum("games")).first()[0] == 48_000


def test_per_match_statistics_combine_before_the_shuffle(small_partitions, hot):
    """A task sends at most one row per group, however many rows the hot match has."""
    drafts, _ = hot
    profile = keyed.pick_profile(drafts)
    plan = final_plan(profile)
    assert plan.index("partial_count") > 0
    row = profile.where("match_id = 7").first()
    hot_rows = drafts.where("match_id = 7 AND is_pick = 1")
    assert row.side_a_picks + row.side_b_picks == hot_rows.count()
    assert row.unique_entities == hot_rows.select("entity_id").distinct().count()
