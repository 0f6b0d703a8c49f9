import pytest
from conftest import SMALL, as_dicts
from pyspark.sql import functions as F

from contest_analytics.operators import features
from contest_analytics.plans import catalog
from contest_analytics.sources import standins
from contest_analytics.sources.layouts import ContestTables


@pytest.fixture
def tables(rows):
    return ContestTables(
        matches=rows(
            "match_id bigint, yr int, mo int, duration int, side_a_win boolean, score_a int, score_b int, "
            "league_id int, first_claim_time int",
            (1, 2020, 1, 1500, True, 10, 30, 7, 60), (2, 2020, 1, 2500, False, None, 5, None, None),
            (3, 2020, 1, 599, None, 1, 1, 1, 1), (4, 2020, 1, None, True, 1, 1, 1, 1),
            (1, 2020, 1, 1500, True, 10, 30, 7, 60), (5, 2020, 1, 7201, False, 1, 1, 1, 1),
        ),
        selections=rows("match_id bigint, entity_id int, side int, is_pick int", (1, 3, 0, 1), (1, 4, 0, 1), (1, 4, 1, 0)),
        participants=rows(
            "match_id bigint, side_a_win boolean, first_claim double, gold_rate double, xp_rate double, damage double, "
            "tower_damage double, kills double, deaths double, assists double",
            (1, True, 1.0, 100.0, 200.0, 5.0, 6.0, 8.0, 2.0, 1.0), (1, False, 0.0, 300.0, 200.0, 7.0, 6.0, 2.0, 2.0, 1.0),
            (9, None, 0.0, 300.0, 200.0, 7.0, 6.0, 2.0, 2.0, 1.0),
        ),
        objectives=rows("match_id bigint, time_s double, kind string", (1, 5.0, "x_tower"), (1, 700.0, "y_barracks")),
        gold_advantage=rows("match_id bigint, minute_no double, gold double", (1, 5.0, 50.0), (1, 1.0, -50.0)),
        xp_advantage=rows("match_id bigint, minute_no double, xp double", (1, 5.0, 70.0)),
        clashes=rows("match_id bigint, start_s double, deaths double", (1, 5.0, 2.0), (1, 900.0, 4.0)),
        draft_turns=rows("match_id bigint, time_taken double", (1, 12.0), (1, 14.0)),
    )


def test_outcome_table(tables):
    got = {r["match_id"]: r for r in as_dicts(features.outcome_table(tables))}
    assert set(got) == {1, 2, 4, 5}
    full = got[1]
    assert full["side_a_win"] == 1 and full["kill_death_ratio"] == 2.5
    assert (full["early_towers"], full["early_objectives"], full["gold_volatility"]) == (1, 1, 0.0)
    assert (full["side_a_picks"], full["side_a_entities"], full["side_b_picks"]) == (2, 2, 5)
    empty = got[2]
    assert empty["side_a_win"] == 0
    assert {c: empty[c] for c in features.OUTCOME_DEFAULTS} == features.OUTCOME_DEFAULTS
    assert empty["kill_death_ratio"] == 0.0


def test_outcome_labels(tables):
    zero = {r["match_id"]: r["side_a_win"] for r in as_dicts(features.outcome_table(tables, null_label="zero"))}
    assert zero == {1: 1, 2: 0, 3: 0, 4: 1, 5: 0}
    from_rows = features.outcome_base(tables.participants, "zero")
    assert {r.match_id: r.side_a_win for r in from_rows.collect()} == {1: 1, 9: 0}


def test_duration_table(tables):
    got = {r["match_id"]: r for r in as_dicts(features.duration_table(tables))}
    assert set(got) == {1, 2}
    full = got[1]
    assert (full["score_difference"], full["total_score"], full["unique_entities"]) == (20, 40, 2)
    assert (full["total_clashes"], full["avg_deaths_per_clash"], full["total_barracks"]) == (2, 3.0, 1)
    assert full["gold_swing_std"] == pytest.approx(70.710678)
    empty = got[2]
    assert {c: empty[c] for c in features.DURATION_DEFAULTS if c != "score_b"} == {
        c: v for c, v in features.DURATION_DEFAULTS.items() if c != "score_b"
    }
    assert (empty["score_difference"], empty["total_score"]) == (5, 5)


def test_compact_tables_are_column_subsets(tables):
    for wide, compact in (
        (features.outcome_table, features.outcome_table_compact),
        (features.duration_table, features.duration_table_compact),
    ):
        small = compact(tables)
        same = wide(tables).select(small.columns)
        assert as_dicts(small, "match_id") == as_dicts(same, "match_id")
    assert len(features.OUTCOME_FEATURES) == 25 and len(features.OUTCOME_FEATURES_COMPACT) == 17
    assert len(features.DURATION_FEATURES) == 26 and len(features.DURATION_FEATURES_COMPACT) == 21


def test_one_row_per_match_and_no_nulls(spark):
    for table in (catalog.feature_table_outcome(spark, SMALL), catalog.feature_table_duration(spark, SMALL)):
        n, keys = table.agg(F.count(F.lit(1)), F.count_distinct("match_id")).first()
        assert n == keys
        assert table.dropna().count() == n
    valid = features.valid_duration(standins.matches(spark, SMALL)).count()
    assert n == valid


def test_joins_of_aggregated_sides_add_no_shuffle(spark):
    """Without broadcasts: one shuffle per grouping, none for the joins themselves."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = standins.load(spark, SMALL)
        plan = features.outcome_table(tables, catalog.KINDS)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # Base and six sides, one more for distinct entities, two for the part lookup.
    assert plan.count("Exchange hashpartitioning") == 1 + 7 + 1 + 2
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>" in plan
