import statistics

import pytest
from conftest import SMALL, as_dicts
from pyspark.sql import functions as F

from contest_analytics.operators import keyed
from contest_analytics.sources import standins


def only(df):
    found = as_dicts(df)
    assert len(found) == 1
    return found[0]


def test_objective_counts(rows):
    df = rows(
        "match_id bigint, time_s double, kind string",
        (1, 10.0, "CHAT_MESSAGE_FIRSTBLOOD"), (1, 600.0, "npc_tower_1"), (1, 600.5, "npc_tower_2"),
        (1, 20.0, "CHAT_MESSAGE_COURIER_LOST"), (1, 30.0, "chat_courier"), (1, 40.0, "NPC_TOWER"), (1, 50.0, None),
        (1, None, "npc_tower_3"), (1, 900.0, "npc_barracks"),
    )
    assert only(keyed.objective_counts_early(df)) == {
        "match_id": 1, "first_claim_count": 1, "early_towers": 1, "early_couriers": 1, "early_objectives": 5,
    }
    assert only(keyed.objective_counts_early(df, ignore_case=True))["early_towers"] == 2
    assert only(keyed.objective_counts_early(df, count_unknown=True))["early_objectives"] == 6
    assert only(keyed.objective_counts_all(df)) == {
        "match_id": 1, "total_objectives": 9, "total_towers": 3, "total_barracks": 1,
    }


def test_advantage_window_is_inclusive(rows):
    df = rows(
        "match_id bigint, minute_no int, gold bigint, xp bigint",
        (1, 4, 1000, 1), (1, 5, 10, 2), (1, 10, 30, 4), (1, 11, -5, 9), (2, 7, 8, None), (3, 1, 1, 1),
    )
    gold = as_dicts(keyed.gold_window(df), "match_id")
    assert [r["match_id"] for r in gold] == [1, 2]
    assert (gold[0]["avg_gold_window"], gold[0]["max_gold_window"], gold[0]["min_gold_window"]) == (20.0, 30, 10)
    assert gold[0]["gold_volatility"] == pytest.approx(statistics.stdev([10, 30]))
    assert gold[1]["gold_volatility"] is None
    xp = as_dicts(keyed.xp_window(df), "match_id")
    assert [(r["avg_xp_window"], r["max_xp_window"]) for r in xp] == [(3.0, 4), (None, None)]
    swing = as_dicts(keyed.gold_swing(df), "match_id")
    assert (swing[0]["max_gold_lead"], swing[0]["min_gold_lead"]) == (1000, -5)


def test_pick_profile_keeps_missing_sides_null(rows):
    df = rows(
        "match_id bigint, entity_id int, side int, is_pick int",
        (1, 5, 0, 1), (1, 5, 0, 1), (1, 6, 0, 1), (1, 7, 0, 0), (2, 5, 0, 1), (2, 5, 1, 1), (2, None, 1, 1),
        (3, None, 1, 1), (4, 9, 0, 0), (5, 9, 3, 1),
    )
    got = {r["match_id"]: tuple(r.values())[1:] for r in as_dicts(keyed.pick_profile(df))}
    assert got == {
        1: (3, 2, None, None, 2),
        2: (1, 1, 1, 1, 1),
        3: (None, None, 0, 0, 0),
        5: (None, None, None, None, 1),
    }
    assert {r.match_id for r in keyed.side_pick_counts(df).collect()} == {1, 2, 3}


def test_pick_profile_agrees_with_the_separate_aggregates(spark):
    picks = standins.selections(spark, SMALL).where("is_pick = 1")
    a, b = (
        picks.where(F.col("side") == side)
        .groupBy("match_id")
        .agg(F.count("entity_id").alias(f"n{side}"), F.count_distinct("entity_id").alias(f"d{side}"))
        for side in (0, 1)
    )
    unique = keyed.unique_entities(standins.selections(spark, SMALL))
    expected = unique.join(a, "match_id", "left").join(b, "match_id", "left")
    expected = {tuple(r) for r in expected.select("match_id", "n0", "d0", "n1", "d1", "unique_entities").collect()}
    assert {tuple(r) for r in keyed.pick_profile(standins.selections(spark, SMALL)).collect()} == expected


def test_participants_ignore_nulls(rows):
    df = rows(
        "match_id bigint, first_claim int, gold_rate double, xp_rate double, damage double, tower_damage double, "
        "kills double, deaths double, assists double",
        (1, 1, 400.0, None, 10.0, 1.0, 2.0, 0.0, None), (1, None, None, 300.0, 90.0, 2.0, 3.0, 0.0, None),
        (1, 2, 200.0, 100.0, None, None, None, 0.0, None),
    )
    assert only(keyed.participant_totals(df)) == {
        "match_id": 1, "first_claim_total": 2, "avg_gold_rate_all": 300.0, "avg_xp_rate_all": 200.0,
        "max_damage": 90.0, "total_kills": 5.0, "total_deaths": 0.0, "total_assists": None,
    }
    averages = only(keyed.participant_averages(df))
    assert (averages["avg_kills"], averages["avg_damage"], averages["total_tower_damage"]) == (2.5, 50.0, 3.0)


def test_draft_and_clash_stats(rows):
    turns = rows("match_id bigint, time_taken double", (1, 10.0), (1, 30.0), (1, None))
    assert only(keyed.draft_stats(turns)) == {
        "match_id": 1, "avg_draft_time": 20.0, "max_draft_time": 30.0, "total_draft_time": 40.0,
    }
    clashes = rows("match_id bigint, start_s double, deaths double", (1, 600.0, 4.0), (1, 601.0, 8.0), (1, 1.0, None))
    assert only(keyed.clash_stats_early(clashes)) == {"match_id": 1, "early_clashes": 2, "avg_clash_deaths": 4.0}
    assert only(keyed.clash_stats_all(clashes)) == {
        "match_id": 1, "total_clashes": 3, "avg_deaths_per_clash": 6.0, "total_clash_deaths": 12.0,
    }


def test_dedupe_is_independent_of_layout(rows):
    df = rows("match_id bigint, label int, other int", (1, 0, 9), (1, 1, 2), (1, 1, 1), (2, None, 3), (3, 0, None))
    for parts in (1, 3):
        shuffled = df.repartition(parts)
        labels = {r.match_id: r.label for r in keyed.dedupe_labels(shuffled.select("match_id", "label"), "label").collect()}
        assert labels == {1: 1, 2: None, 3: 0}
        whole = {r.match_id: (r.label, r.other) for r in keyed.dedupe_rows(shuffled).collect()}
        assert whole == {1: (1, 2), 2: (None, 3), 3: (0, None)}
