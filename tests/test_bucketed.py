import pytest
from conftest import SMALL, as_dicts
from pyspark.sql import functions as F

from contest_analytics.operators import features
from contest_analytics.plans import catalog
from contest_analytics.sources import bucketed, files, standins
from contest_analytics.sources.layouts import ContestTables


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    folder = f"{tmp_path_factory.mktemp('layout')}/tables"
    bucketed.write_layout(standins.load(spark, SMALL), folder, buckets=4)
    yield folder
    bucketed.detach_layout(spark, folder)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("build", [features.outcome_table, features.duration_table])
def test_feature_tables_need_no_shuffle(spark, layout, no_broadcast, build):
    table = build(bucketed.load_layout(spark, layout), catalog.KINDS)
    plan = plan_of(table)
    assert plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin") >= 6 and "Exchange" not in plan
    plain = build(standins.load(spark, SMALL), catalog.KINDS)
    assert "Exchange" in plan_of(plain)
    rounded = [F.round(c, 4).alias(c) if t == "double" else F.col(c) for c, t in plain.dtypes]
    assert as_dicts(table.select(rounded), "match_id") == as_dicts(plain.select(rounded), "match_id")


def test_another_session_attaches_the_layout(spark, layout):
    bucketed.load_layout(spark, layout)
    bucketed.detach_layout(spark, layout)
    loaded = bucketed.load_layout(spark, layout)
    expected = {name: df.count() for name, df in standins.load(spark, SMALL).named().items()}
    assert {name: df.count() for name, df in loaded.named().items()} == expected


def test_a_hot_match_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("match_id"), F.col("id").cast("int").alias("time_taken")
    )
    bucketed.write_layout(ContestTables(draft_turns=rows), f"{tmp_path}/hot", buckets=2, spread=4)
    loaded = bucketed.load_layout(spark, f"{tmp_path}/hot").draft_turns
    assert loaded.where("match_id = 5").select(F.input_file_name()).distinct().count() > 1
    counts = loaded.groupBy("match_id").count()
    assert "Exchange" not in plan_of(counts) and counts.count() == rows.select("match_id").distinct().count()
    assert counts.where("match_id = 5").first()["count"] == 3001  # 3,000 and the match's own row
    bucketed.detach_layout(spark, f"{tmp_path}/hot")


def test_a_layout_without_its_last_file_is_none(spark, layout, tmp_path):
    assert bucketed.is_layout(spark, layout) and not bucketed.is_layout(spark, f"{tmp_path}/none")
    with pytest.raises(FileNotFoundError):
        bucketed.load_layout(spark, f"{tmp_path}/none")
    with pytest.raises(FileExistsError):
        bucketed.write_layout(standins.load(spark, SMALL), layout)
    assert files.read_json(spark, f"{layout}/{bucketed.LAYOUT_FILE}")["buckets"] == 4
