"""Reports that grow with new matches: each run adds one folder's matches to what is kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contest_analytics.functions import expressions as E
from contest_analytics.operators import trends
from contest_analytics.operators.incremental import KeptState, merged_moments, merged_sums
from contest_analytics.plans import analytics
from contest_analytics.session import scratch_scope
from contest_analytics.sources import bucketed, sinks

ENTITY_KEYS, PERIOD_KEYS = ["yr", "entity_id"], ["yr", "mo"]


def states(spark: SparkSession, folder: str) -> tuple[KeptState, KeptState]:
    """The kept draft counts and the kept moments of the match durations."""
    return (
        KeptState(spark, f"{folder}/entity_counts", merged_sums(ENTITY_KEYS)),
        KeptState(spark, f"{folder}/duration_moments", merged_moments(PERIOD_KEYS)),
    )


def period_stats_of(moments: DataFrame) -> DataFrame:
    """The statistics per period of ``trends.period_stats`` for known durations, from kept moments."""
    n = F.col("n")
    known = moments.where("n > 0")
    return known.select(
        *PERIOD_KEYS,
        (F.col("total") / n).alias("avg_duration_sec"),
        n.alias("total_matches"),
        F.col("lowest").alias("shortest"),
        F.col("highest").alias("longest"),
        F.sqrt(F.col("squared_dev") / F.when(n > 1, n - 1)).alias("std_dev"),
        E.to_minutes(F.col("total") / n).alias("avg_duration_min"),
    ).orderBy(*PERIOD_KEYS)


def run(
    spark: SparkSession, folder: str, state: str, part: str, output: str, fmt: str = "csv", mode: str = "overwrite"
) -> dict[str, int]:
    """Add the matches of a folder under the name ``part`` and write the reports over all parts so far.

    The folders of different parts hold different matches. A part that is in the state already adds
    nothing, so a run that failed half-way is repeated as it was.
    """
    counts, moments = states(spark, state)
    with scratch_scope(spark):
        loaded = bucketed.load_tables(spark, folder, analytics.NEEDED)
        rows = analytics.enriched_selections(loaded)
        counts.add(rows.groupBy(*ENTITY_KEYS).agg(*trends.rate_counts()), part)
        moments.add(trends.moments(loaded.matches, PERIOD_KEYS, "duration"), part)
        trend = trends.with_rates(counts.read())
        results = {
            "entity": {
                "trends": trend,
                "top_volatile": trends.top_entities(trends.rate_volatility(trend)),
                "top_series": trends.top_series(trend),
            },
            "duration": {"trends": period_stats_of(moments.read())},
        }
        return sinks.commit_results(results, output, fmt, mode)
