"""Win rates over phases and duration buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contest_analytics.functions import expressions as E
from contest_analytics.operators.enrich import enrich
from contest_analytics.operators.trends import rate_counts, with_rates


def win_rate(
    df: DataFrame, keys: Sequence[str], win: str, games: str = "games", wins: str = "wins", min_count: int = 0
) -> DataFrame:
    """Games, wins and win rate per group; groups below ``min_count`` games are left out."""
    stats = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(games), F.sum(win).alias(wins))
    return with_win_rate(stats, games, wins, min_count)


def with_win_rate(
    stats: DataFrame, games: str = "games", wins: str = "wins", min_count: int = 0
) -> DataFrame:
    if min_count > 0:
        stats = stats.where(F.col(games) >= min_count)
    return stats.withColumn("win_rate", E.percent_rate(F.col(wins), F.col(games)))


def played_phases(selections: DataFrame, matches: DataFrame, null_bucket: str = "last") -> DataFrame:
    """One row per pick with its phase and whether its side won."""
    picks = selections.where(F.col("is_pick") == 1).select("match_id", "entity_id", "side")
    rows = enrich(picks, matches, "match_id", ["duration", "side_a_win"], how="inner")
    phase = E.bucketize(F.col("duration"), E.PHASE_EDGES, E.PHASE_LABELS, null_bucket)
    rows = rows.select(
        "entity_id", phase.alias("phase"), E.side_win(F.col("side"), F.col("side_a_win")).alias("win")
    )
    return rows.dropna(subset=["phase"]) if null_bucket == "drop" else rows


def phase_win_rate(
    selections: DataFrame, matches: DataFrame, min_count: int = 50, null_bucket: str = "last"
) -> DataFrame:
    """Win rate of every entity in every phase."""
    return win_rate(
        played_phases(selections, matches, null_bucket), ["entity_id", "phase"], "win", min_count=min_count
    )


def draft_cube(selections: DataFrame, matches: DataFrame, null_bucket: str = "last") -> DataFrame:
    """Draft and win counts per (yr, entity_id, phase) from one join.

    The rate trend and the phase win rates are sums over it, so a run that needs both
    shuffles the selections once. Draft rows without a match have neither year nor phase.
    """
    parents = matches.select("match_id", "yr", "duration", "side_a_win", F.lit(True).alias("matched"))
    rows = enrich(selections, parents, "match_id", parents.columns[1:])
    phase = E.bucketize(F.col("duration"), E.PHASE_EDGES, E.PHASE_LABELS, null_bucket)
    played = F.col("matched") & (F.col("is_pick") == 1)
    won = F.when(played, E.side_win(F.col("side"), F.col("side_a_win"))).otherwise(0)
    return (
        rows.withColumn("phase", F.when(F.col("matched"), phase))
        .groupBy("yr", "entity_id", "phase")
        .agg(*rate_counts(), E.count_where(played).alias("games"), F.sum(won).alias("wins"))
    )


def trend_of_cube(cube: DataFrame) -> DataFrame:
    """The rate trend per (yr, entity_id)."""
    names = ("picks", "bans", "total_appearances")
    return with_rates(cube.groupBy("yr", "entity_id").agg(*[F.sum(c).alias(c) for c in names]))


def phases_of_cube(cube: DataFrame, min_count: int = 50) -> DataFrame:
    """The win rate per (entity_id, phase)."""
    stats = (
        cube.where(F.col("phase").isNotNull() & (F.col("games") > 0))
        .groupBy("entity_id", "phase")
        .agg(F.sum("games").alias("games"), F.sum("wins").alias("wins"))
    )
    return with_win_rate(stats, min_count=min_count)


def bucket_win_rate(matches: DataFrame, null_bucket: str = "last") -> DataFrame:
    """How often the first side wins, per duration bucket; ``bucket_no`` gives their order."""
    duration = F.col("duration")
    rows = matches.select(
        E.bucket_number(duration, E.DURATION_EDGES, null_bucket).alias("bucket_no"),
        E.bucketize(duration, E.DURATION_EDGES, E.DURATION_LABELS, null_bucket).alias("bucket"),
        F.when(F.col("side_a_win"), 1).otherwise(0).alias("win"),
    )
    if null_bucket == "drop":
        rows = rows.dropna(subset=["bucket"])
    return win_rate(rows, ["bucket_no", "bucket"], "win", games="total_matches", wins="side_a_wins")


def share_of_total(counts: DataFrame, value: str, name: str = "share") -> DataFrame:
    """Percentage of the overall sum that each row holds.

    The sum enters as a scalar subquery, so the rows stay where they are.
    """
    whole = counts.agg(F.sum(value).alias("whole")).scalar()
    return counts.withColumn(name, E.percent_rate(F.col(value), whole))
