"""Rates per period and entity, their volatility, and statistics per period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contest_analytics.functions import expressions as E
from contest_analytics.operators.enrich import keep_members
from contest_analytics.session import cut_lineage, scratch_scope


def rate_trend(
    df: DataFrame,
    period: str = "yr",
    entity: str = "entity_id",
    flag: str = "is_pick",
    drop_null_period: bool = False,
) -> DataFrame:
    """Picks, bans and their rates for every (period, entity)."""
    if drop_null_period:
        df = df.dropna(subset=[period])
    return with_rates(df.groupBy(period, entity).agg(*rate_counts(flag)))


def rate_counts(flag: str = "is_pick") -> list[Column]:
    """Aggregates behind the rates; they can be added up over further keys."""
    chosen, known = E.count_where(F.col(flag) == 1), F.count(flag)
    # The names of the counts. What is known and not a pick is a ban.
    return [chosen.alias("picks"), (known - chosen).alias("bans"), F.count(F.lit(1)).alias("total_appearances")]


def with_rates(counts: DataFrame) -> DataFrame:
    whole = F.col("total_appearances")
    return counts.withColumns(
        {
            "pick_rate": E.percent_rate(F.col("picks"), whole),
            "ban_rate": E.percent_rate(F.col("bans"), whole),
        }
    )


def rate_volatility(trend: DataFrame, entity: str = "entity_id", population: bool = False) -> DataFrame:
    """Average rates of an entity over the periods, and the spread of its pick rate."""
    spread = F.stddev_pop if population else F.stddev_samp
    return trend.groupBy(entity).agg(
        F.avg("pick_rate").alias("avg_pick_rate"),
        spread("pick_rate").alias("pick_rate_volatility"),
        F.avg("ban_rate").alias("avg_ban_rate"),
    )


def top_entities(
    volatility: DataFrame, k: int = 10, by: str = "pick_rate_volatility", entity: str = "entity_id"
) -> DataFrame:
    """The k entities with the highest value; ties go to the smaller key."""
    return volatility.orderBy(F.desc_nulls_last(by), F.asc(entity)).limit(k)


def top_series(
    trend: DataFrame, k: int = 5, by: str = "pick_rate_volatility", entity: str = "entity_id"
) -> DataFrame:
    """Trend rows of the k top entities.

    The trend is computed once: it is written, ranked and filtered from there. It has one row per
    (period, entity), however many rows are behind it.
    """
    with scratch_scope(trend.sparkSession) as scope:
        rows = cut_lineage(trend)
        leaders = top_entities(rate_volatility(rows, entity), k, by, entity)
        return scope.keep(keep_members(rows, leaders, entity))


def period_stats(
    df: DataFrame,
    keys: Sequence[str] = ("yr", "mo"),
    measure: str = "duration",
    drop_null_period: bool = False,
    population: bool = False,
    known_only: bool = False,
) -> DataFrame:
    """Average, count, extremes and spread of a measure per period, in period order.

    ``known_only`` leaves out rows without the measure, also from the count.
    """
    if known_only:
        df = df.dropna(subset=[measure])
    if drop_null_period:
        df = df.dropna(subset=list(keys))
    spread = F.stddev_pop if population else F.stddev_samp
    stats = df.groupBy(*keys).agg(
        F.avg(measure).alias(f"avg_{measure}_sec"),
        F.count(F.lit(1)).alias("total_matches"),
        F.min(measure).alias("shortest"),
        F.max(measure).alias("longest"),
        spread(measure).alias("std_dev"),
    )
    minutes = E.to_minutes(F.col(f"avg_{measure}_sec"))
    return stats.withColumn(f"avg_{measure}_min", minutes).orderBy(*keys)


def moments(df: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Count, sum, squared deviations from the mean and extremes: partial results that can be merged."""
    value = F.col(measure)
    return df.groupBy(*keys).agg(
        F.count(value).alias("n"),
        F.sum(value).alias("total"),
        (F.var_pop(value) * F.count(value)).alias("squared_dev"),
        F.min(value).alias("lowest"),
        F.max(value).alias("highest"),
    )


def merge_moments(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge moments of disjoint parts, e.g. daily ones to a month.

    The deviations of the parts' means are taken from a value close to the common mean, so
    nothing large cancels out.
    """
    mean = F.col("total") / F.when(F.col("n") > 0, F.col("n"))
    near = F.avg(mean).over(Window.partitionBy(*keys))
    off = F.coalesce(mean - near, F.lit(0.0))
    rows = parts.withColumns({"off": F.col("n") * off, "off_sq": F.col("n") * off * off})
    n = F.sum("n")
    between = F.sum("off_sq") - F.coalesce(F.sum("off") * F.sum("off") / F.when(n > 0, n), F.lit(0.0))
    return rows.groupBy(*keys).agg(
        n.alias("n"),
        F.sum("total").alias("total"),
        (F.sum("squared_dev") + between).alias("squared_dev"),
        F.min("lowest").alias("lowest"),
        F.max("highest").alias("highest"),
    )


def finish_moments(parts: DataFrame) -> DataFrame:
    """Mean and population spread from moments; null for groups without a value."""
    n = F.when(F.col("n") > 0, F.col("n"))
    mean = F.col("total") / n
    variance = F.col("squared_dev") / n
    return parts.withColumns(
        {"mean": mean, "std_pop": F.when(n.isNotNull(), F.sqrt(variance))}
    )
