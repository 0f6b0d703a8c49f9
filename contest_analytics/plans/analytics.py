"""The four analytic reports over canonical tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from contest_analytics.operators import trends, winrates
from contest_analytics.operators.enrich import enrich, keep_members
from contest_analytics.session import cut_lineage, scratch_scope
from contest_analytics.sources import bucketed, sinks
from contest_analytics.sources.layouts import ContestTables

# The tables and columns the reports read; a folder need not hold more.
NEEDED = {
    "matches": ("match_id", "duration", "side_a_win"),
    "selections": ("match_id", "entity_id", "side", "is_pick"),
}


def enriched_selections(tables: ContestTables, how: str = "left") -> DataFrame:
    """Draft rows with the period and outcome of their match."""
    return enrich(tables.selections, tables.matches, "match_id", ["yr", "mo", "side_a_win"], how)


def entity_trends(tables: ContestTables, how: str = "left", drop_null_period: bool = False) -> DataFrame:
    return trends.rate_trend(enriched_selections(tables, how), drop_null_period=drop_null_period)


def reports(
    tables: ContestTables,
    min_count: int = 50,
    how: str = "left",
    drop_null_period: bool = False,
    null_bucket: str | None = None,
) -> dict[str, dict[str, DataFrame]]:
    """The four reports by category and name; the rankings follow from the entity trends.

    ``how="inner"`` leaves out draft rows without a match, ``drop_null_period`` those without a
    period, ``null_bucket="drop"`` matches of unknown length.

    Both entity reports come from one staged cube, so the join behind them runs once.
    """
    selections = tables.selections
    if how == "inner":
        selections = keep_members(selections, tables.matches.where("match_id IS NOT NULL"), "match_id")
    bucket = {} if null_bucket is None else {"null_bucket": null_bucket}
    cube = cut_lineage(winrates.draft_cube(selections, tables.matches, **bucket))
    of_known = cube.dropna(subset=["yr"]) if drop_null_period else cube
    return {
        "entity": {
            "trends": winrates.trend_of_cube(of_known),
            "by_phase": winrates.phases_of_cube(cube, min_count),
        },
        "duration": {
            "trends": trends.period_stats(
                tables.matches, drop_null_period=drop_null_period, known_only=null_bucket == "drop"
            ),
            "buckets": winrates.bucket_win_rate(tables.matches, **bucket).orderBy("bucket_no"),
        },
    }


def run(
    spark: SparkSession, folder: str, output: str, fmt: str = "csv", mode: str = "errorifexists", **options
) -> dict[str, int]:
    """Load a folder of match files, or a layout of them, and write every report as one set; returns their record counts.

    ``options`` are those of ``reports``.
    """
    with scratch_scope(spark):
        named = reports(bucketed.load_tables(spark, folder, NEEDED), **options)
        # The rankings follow from the staged cube.
        trend = named["entity"]["trends"]
        ranking = {
            "top_volatile": trends.top_entities(trends.rate_volatility(trend)),
            "top_series": trends.top_series(trend),
        }
        return sinks.commit_results(named | {"entity": named["entity"] | ranking}, output, fmt, mode)
