import pytest
from pyspark.sql import functions as F

from contest_analytics.functions import expressions as E


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_phase_edges_belong_to_the_upper_bucket(rows):
    df = rows("d int", (0,), (1799,), (1800,), (2699,), (2700,), (None,))
    got = values(
        df,
        E.bucketize(F.col("d"), E.PHASE_EDGES, E.PHASE_LABELS),
        E.bucketize(F.col("d"), E.PHASE_EDGES, E.PHASE_LABELS, "drop"),
    )
    early, mid, late = E.PHASE_LABELS
    assert got == [(early, early), (early, early), (mid, mid), (mid, mid), (late, late), (late, None)]


def test_duration_buckets_and_their_numbers(rows):
    df = rows("d int", (1199,), (1200,), (1800,), (2400,), (3000,), (None,))
    got = values(
        df,
        E.bucketize(F.col("d"), E.DURATION_EDGES, E.DURATION_LABELS),
        E.bucket_number(F.col("d"), E.DURATION_EDGES),
        E.bucket_number(F.col("d"), E.DURATION_EDGES, "drop"),
    )
    assert got == [(E.DURATION_LABELS[i], i + 1, i + 1) for i in range(5)] + [("50min+", 5, None)]


def test_bucketize_checks_its_arguments():
    with pytest.raises(ValueError):
        E.bucketize(F.lit(1), (1, 2), ("a", "b"))
    with pytest.raises(ValueError):
        E.bucketize(F.lit(1), (1,), ("a", "b"), "first")


def test_side_win(rows):
    df = rows(
        "side int, won boolean",
        (0, True), (0, False), (1, True), (1, False), (0, None), (1, None), (None, True), (2, False),
    )
    assert values(df, E.side_win(F.col("side"), F.col("won"))) == [(1,), (0,), (0,), (1,), (0,), (0,), (0,), (0,)]


def test_percent_rate_rounds_half_up_and_guards_zero(rows):
    df = rows("n int, d int", (1, 3), (5, 160), (0, 0), (2, 2))
    assert values(df, E.percent_rate(F.col("n"), F.col("d"))) == [(33.33,), (3.13,), (0.0,), (100.0,)]


def test_guarded_ratio(rows):
    df = rows("n bigint, d bigint", (6, 4), (6, 0), (0, 0), (6, None))
    assert values(df, E.guarded_ratio(F.col("n"), F.col("d"))) == [(1.5,), (6.0,), (0.0,), (6.0,)]


def test_patterns_follow_case_only_when_asked(rows):
    df = rows("t string", ("a_TOWER_b",), ("tower",), (None,))
    got = values(
        df,
        E.matches_pattern(F.col("t"), "%tower%"),
        E.matches_pattern(F.col("t"), "%tower%", ignore_case=True),
    )
    assert got == [(False, True), (True, True), (None, None)]


def test_small_expressions(rows):
    df = rows("f int, s double", (1, 125.0), (0, 100.0))
    assert values(df, E.complement(F.col("f")), E.to_minutes(F.col("s"))) == [(0, 2.08), (1, 1.67)]
