import math
import statistics

import pytest
from conftest import SMALL, as_dicts
from pyspark.sql import functions as F

from contest_analytics.functions import expressions as E
from contest_analytics.operators import trends, winrates
from contest_analytics.operators.enrich import enrich, keep_members
from contest_analytics.plans import analytics
from contest_analytics.sources import standins


@pytest.fixture
def drafts(rows):
    return rows(
        "match_id bigint, entity_id int, side int, is_pick int",
        (1, 10, 0, 1), (1, 11, 1, 1), (1, 12, 0, 0), (2, 10, 1, 1), (3, 10, 0, 0), (9, 10, 0, 1), (None, 11, 0, 1),
    )


@pytest.fixture
def games(rows):
    return rows(
        "match_id bigint, yr int, mo int, duration int, side_a_win boolean",
        (1, 2020, 1, 1000, True), (2, 2021, 2, 2000, False), (3, 2021, 2, None, None), (4, None, None, 2800, True),
    )


def test_left_enrich_keeps_unmatched_rows_in_a_null_period(drafts, games):
    trend = trends.rate_trend(enrich(drafts, games, "match_id", ["yr"]))
    got = {(r["yr"], r["entity_id"]): r for r in as_dicts(trend)}
    assert got[None, 10]["picks"] == 1 and got[None, 11]["picks"] == 1
    assert got[2021, 10] == {
        "yr": 2021, "entity_id": 10, "picks": 1, "bans": 1, "total_appearances": 2, "pick_rate": 50.0, "ban_rate": 50.0,
    }
    assert got[2020, 12]["ban_rate"] == 100.0


def test_inner_enrich_and_dropped_periods(drafts, games):
    trend = trends.rate_trend(enrich(drafts, games, "match_id", ["yr"], "inner"), drop_null_period=True)
    assert {(r.yr, r.entity_id) for r in trend.collect()} == {(2020, 10), (2020, 11), (2020, 12), (2021, 10)}


def test_picks_and_bans_add_up(spark):
    trend = analytics.entity_trends(standins.load(spark, SMALL))
    assert trend.where(F.col("picks") + F.col("bans") != F.col("total_appearances")).count() == 0
    total = trend.agg(F.sum("total_appearances")).first()[0]
    assert total == standins.selections(spark, SMALL).count()


def test_volatility_of_one_period_is_null_or_zero(rows):
    trend = rows("entity_id int, pick_rate double, ban_rate double", (1, 10.0, 1.0), (1, 20.0, 2.0), (2, 5.0, 3.0))
    sample = {r.entity_id: r for r in trends.rate_volatility(trend).collect()}
    assert sample[1].pick_rate_volatility == pytest.approx(statistics.stdev([10, 20]))
    assert sample[2].pick_rate_volatility is None
    population = {r.entity_id: r for r in trends.rate_volatility(trend, population=True).collect()}
    assert population[1].pick_rate_volatility == pytest.approx(5.0)
    assert population[2].pick_rate_volatility == 0.0


def test_top_entities_order_and_ties(rows):
    volatility = rows(
        "entity_id int, avg_pick_rate double, pick_rate_volatility double",
        (5, 9.0, None), (3, 1.0, 2.0), (2, 5.0, 2.0), (7, 2.0, 8.0),
    )
    assert [r.entity_id for r in trends.top_entities(volatility, 3).collect()] == [7, 2, 3]
    assert [r.entity_id for r in trends.top_entities(volatility, 2, by="avg_pick_rate").collect()] == [5, 2]


def test_top_series_keeps_all_rows_of_the_leaders(rows):
    trend = rows(
        "yr int, entity_id int, pick_rate double, ban_rate double",
        (1, 1, 0.0, 0.0), (2, 1, 90.0, 0.0), (1, 2, 10.0, 0.0), (2, 2, 11.0, 0.0), (1, 3, 50.0, 0.0), (2, 3, 80.0, 0.0),
    )
    assert sorted((r.yr, r.entity_id) for r in trends.top_series(trend, 2).collect()) == [(1, 1), (1, 3), (2, 1), (2, 3)]


def test_members_keep_the_null_key(spark, rows):
    left = rows("id int, v int", (1, 1), (None, 2), (3, 3), (None, 4))
    assert sorted(r.v for r in keep_members(left, rows("id int", (None,), (3,)), "id").collect()) == [2, 3, 4]
    assert [r.v for r in keep_members(left, rows("id int", (1,)), "id").collect()] == [1]


def test_top_series_of_a_null_entity(rows):
    trend = rows(
        "yr int, entity_id int, pick_rate double, ban_rate double",
        (1, None, 0.0, 0.0), (2, None, 90.0, 0.0), (1, 2, 10.0, 0.0), (2, 2, 11.0, 0.0),
    )
    assert [r.entity_id for r in trends.top_series(trend, 1).collect()] == [None, None]


def test_period_stats(games):
    got = as_dicts(trends.period_stats(games))
    assert [(r["yr"], r["mo"]) for r in got] == [(None, None), (2020, 1), (2021, 2)]
    last = got[2]
    assert (last["total_matches"], last["avg_duration_sec"], last["shortest"], last["longest"]) == (2, 2000.0, 2000, 2000)
    assert last["avg_duration_min"] == 33.33 and last["std_dev"] is None
    assert trends.period_stats(games, drop_null_period=True).count() == 2
    assert trends.period_stats(games, population=True).where("std_dev = 0").count() == 3


def test_moments_merge_to_the_same_figures(rows):
    df = rows("yr int, mo int, duration int", (1, 1, 10), (1, 1, 20), (1, 2, 60), (1, 2, None), (2, 1, None))
    merged = trends.merge_moments(trends.moments(df, ["yr", "mo"], "duration"), ["yr"])
    got = as_dicts(trends.finish_moments(merged), "yr")
    assert (got[0]["n"], got[0]["total"], got[0]["lowest"], got[0]["highest"]) == (3, 90, 10, 60)
    assert got[0]["squared_dev"] == pytest.approx(1400.0)
    assert got[0]["mean"] == 30.0
    assert got[0]["std_pop"] == pytest.approx(statistics.pstdev([10, 20, 60]))
    assert (got[1]["n"], got[1]["mean"], got[1]["std_pop"]) == (0, None, None)


def test_phase_win_rate_rules(drafts, games):
    everything = as_dicts(winrates.phase_win_rate(drafts, games, min_count=0), "entity_id", "phase")
    early, mid, _ = E.PHASE_LABELS
    assert [(r["entity_id"], r["phase"], r["games"], r["wins"], r["win_rate"]) for r in everything] == [
        (10, early, 1, 1, 100.0),
        (10, mid, 1, 1, 100.0),
        (11, early, 1, 0, 0.0),
    ]
    assert winrates.phase_win_rate(drafts, games, min_count=2).count() == 0


def test_null_duration_counts_as_late_unless_dropped(rows, games):
    drafts = rows("match_id bigint, entity_id int, side int, is_pick int", (3, 1, 0, 1))
    kept = as_dicts(winrates.phase_win_rate(drafts, games, min_count=0))
    assert [(r["phase"], r["games"], r["wins"]) for r in kept] == [(E.PHASE_LABELS[-1], 1, 0)]
    assert winrates.phase_win_rate(drafts, games, 0, "drop").count() == 0


def test_bucket_win_rate_and_share(games):
    got = as_dicts(winrates.bucket_win_rate(games), "bucket_no")
    assert [(r["bucket"], r["total_matches"], r["side_a_wins"], r["win_rate"]) for r in got] == [
        ("0-20min", 1, 1, 100.0),
        ("30-40min", 1, 0, 0.0),
        ("40-50min", 1, 1, 100.0),
        ("50min+", 1, 0, 0.0),
    ]
    dropped = winrates.bucket_win_rate(games, "drop")
    assert dropped.count() == 3
    shares = as_dicts(winrates.share_of_total(dropped, "total_matches"))
    assert math.isclose(sum(r["share"] for r in shares), 99.99)


def test_bucket_totals_cover_all_matches(spark):
    matches = standins.matches(spark, SMALL)
    total = winrates.bucket_win_rate(matches).agg(F.sum("total_matches")).first()[0]
    assert total == matches.count()
    rates = winrates.phase_win_rate(standins.selections(spark, SMALL), matches, min_count=0)
    assert rates.where("wins > games").count() == 0


@pytest.mark.parametrize("null_bucket", ["last", "drop"])
def test_cube_gives_the_same_reports(spark, drafts, games, null_bucket):
    literal = (drafts, games)
    tables = (standins.selections(spark, SMALL), standins.matches(spark, SMALL).where("yr >= 1996"))
    for selections, matches in (literal, tables):
        cube = winrates.draft_cube(selections, matches, null_bucket)
        pairs = [
            (winrates.trend_of_cube(cube), trends.rate_trend(enrich(selections, matches, "match_id", ["yr"]))),
            (winrates.phases_of_cube(cube, 0), winrates.phase_win_rate(selections, matches, 0, null_bucket)),
            (winrates.phases_of_cube(cube, 2), winrates.phase_win_rate(selections, matches, 2, null_bucket)),
        ]
        for got, expected in pairs:
            assert sorted(map(str, got.collect())) == sorted(map(str, expected.select(got.columns).collect()))


def test_moments_of_large_values(rows):
    values = [1_000_000_000 + v for v in (0, 1, 2, 3, 10, 11)]
    df = rows("yr int, mo int, duration bigint", *((1, i % 3, v) for i, v in enumerate(values)))
    merged = trends.merge_moments(trends.moments(df, ["yr", "mo"], "duration"), ["yr"])
    assert trends.finish_moments(merged).first().std_pop == pytest.approx(statistics.pstdev(values), rel=1e-9)
