"""Every operator as a named query over the test tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contest_analytics.functions import cleaning
from contest_analytics.functions import expressions as E
from contest_analytics.operators import features, incremental, keyed, learning, metrics, trends, winrates
from contest_analytics.operators.enrich import enrich
from contest_analytics.operators.keyed import KEY, ObjectiveKinds
from contest_analytics.plans import analytics, models
from contest_analytics.session import cut_lineage, scoped, scratch_path, scratch_scope
from contest_analytics.sources import bucketed, sinks, standins, tables

Query = Callable[[SparkSession, str], DataFrame]

# What the test tables call the kinds of objectives.
KINDS = ObjectiveKinds(first_claim="PROMO", tower="%AL%", courier="%ECON%", barracks="%MED%")


def _dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Match keys with damaged text columns, for the cleaning steps."""
    kind = F.col(KEY) % 7
    seconds = F.col("duration").cast("string")
    stamp = F.date_format("start_time", "yyyy-MM-dd HH:mm:ss")
    return standins.matches(spark, sf_dir).select(
        KEY,
        F.when(kind == 0, "n/a").when(kind == 2, F.concat(seconds, F.lit(".0"))).when(kind == 3, "99999999999")
        .when(kind == 4, "x").when(kind > 4, seconds).alias("duration_text"),
        F.concat(F.lit("90000000000000"), F.lpad(F.col(KEY).cast("string"), 5, "0"), F.when(kind == 2, ".0").otherwise(""))
        .alias("long_key_text"),
        F.when(kind == 0, "true").when(kind == 1, " YES ").when(kind == 2, "0").when(kind == 3, "x")
        .when(kind == 5, "F").when(kind == 6, "True").alias("flag_text"),
        F.when(kind == 0, "zz").when(kind > 1, stamp).alias("start_text"),
        F.when(kind != 3, F.col(KEY)).alias("key_or_null"),
    )


def _csv_copy(spark: SparkSession, df: DataFrame) -> str:
    path = scratch_path(spark, "csv")
    df.write.option("header", True).csv(path)
    return path


# --- scans, typing, sinks -------------------------------------------------------------


def csv_scan_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = standins.matches(spark, sf_dir).select(
        KEY, "duration", "side_a_win", F.date_format("start_time", "yyyy-MM-dd HH:mm:ss").alias("start_time")
    )
    return tables.scan_csv_strings(spark, _csv_copy(spark, source))


_TYPES = {KEY: "bigint", "duration": "int", "side_a_win": "boolean", "score_a": "int", "score_b": "int"}


def csv_scan_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = standins.matches(spark, sf_dir)
    written = F.concat(F.col("duration").cast("string"), F.when(F.col(KEY) % 3 == 0, ".0").otherwise(""))
    path = _csv_copy(spark, rows.withColumn("duration", written))
    return tables.scan_csv_typed(spark, path, _TYPES)


def csv_scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _csv_copy(spark, standins.matches(spark, sf_dir).select(*_TYPES))
    return tables.scan_csv_inferred(spark, path)


def _dirty_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    keep = ("duration_text", "long_key_text", "flag_text", "start_text")
    clean = standins.matches(spark, sf_dir).select(
        KEY,
        F.col("score_a").cast("string").alias("score_text"),
        F.concat(F.lit(" "), F.col("score_b").cast("string"), F.lit(".5")).alias("half_text"),
        F.col("side_a_win").cast("string").alias("won_text"),
        F.date_format("start_time", "yyyy-MM-dd HH:mm:ss").alias("clock_text"),
        F.lit("").alias("empty_text"),
    )
    return _dirty(spark, sf_dir).select(KEY, *keep).join(clean, KEY).drop(KEY)


@scoped
def csv_type_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types, missing and malformed values of damaged columns, a third of which may be malformed."""
    _, profile = tables.scan_csv_profiled(spark, _csv_copy(spark, _dirty_texts(spark, sf_dir)), max_malformed=0.34)
    return profile


def csv_scan_profiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _csv_copy(spark, standins.matches(spark, sf_dir).select(*_TYPES))
    return tables.scan_csv_profiled(spark, path)[0]


def coerce_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("duration_text")
    raw = _dirty(spark, sf_dir).select(
        KEY, text.alias("duration_s"), text.alias("duration_x"), F.col("long_key_text").alias("long_key")
    )
    return cleaning.coerce(raw, {"duration_s": "int", "duration_x": "double", "long_key": "bigint"})


def time_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _dirty(spark, sf_dir).select(KEY, F.col("start_text").alias("start_time_utc"))
    return cleaning.time_parts(raw).drop("start_time_utc")


def time_parts_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.time_parts(standins.matches(spark, sf_dir).select(KEY))


def bool_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dirty(spark, sf_dir).select(
        KEY,
        cleaning.bool_normalize("flag_text").alias("wide"),
        cleaning.bool_normalize(
            "flag_text", cleaning.NARROW_TRUE, cleaning.NARROW_FALSE, fold=False
        ).alias("narrow"),
        cleaning.flag_normalize("flag_text").alias("flag"),
    )


def drop_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _dirty(spark, sf_dir).select("key_or_null", "duration_text")
    return cleaning.drop_null_keys(rows, ["key_or_null", "duration_text"])


def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = standins.load(spark, sf_dir).named()
    loaded["advantage"] = loaded.pop("gold_advantage")
    del loaded["xp_advantage"]
    return tables.table_counts(loaded)


def result_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "result")
    sinks.write_table(rate_trend(spark, sf_dir), path)
    return spark.read.parquet(path)


def result_sink_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = analytics.reports(standins.load(spark, sf_dir))
    return sinks.manifest(spark, sinks.save_results(named, scratch_path(spark, "results"), "csv"))


def committed_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports written as one set, once more over themselves, and counted from the commit file and the files."""
    base = scratch_path(spark, "results")
    with scratch_scope(spark):
        named = analytics.reports(standins.load(spark, sf_dir))
        sinks.commit_results(named, base)
        sinks.commit_results(named, base, mode="overwrite")
    counts = sinks.committed(spark, base)
    read = {name: spark.read.parquet(f"{base}/{name}") for name in counts}
    found = tables.table_counts(read).select(F.col("table_name").alias("result"), F.col("n_rows").alias("n_read"))
    return sinks.manifest(spark, counts).join(found, "result")


@scoped
def cached_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two reports from one enriched table that the executors keep while both are made."""
    loaded = standins.load(spark, sf_dir)
    with scratch_scope(spark) as scope:
        rows = scope.cache(analytics.enriched_selections(loaded))
        by_year = rows.groupBy("yr").agg(F.count("*").alias("n"))
        by_side = rows.groupBy("side").agg(F.count("*").alias("n"))
        years = by_year.select(F.lit("yr").alias("report"), F.col("yr").alias("value"), "n")
        return scope.keep(years.unionByName(by_side.select(F.lit("side").alias("report"), F.col("side").alias("value"), "n")))


def single_file_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "report")
    report = bucket_win_rate(spark, sf_dir)
    sinks.write_summary(report, path)
    return spark.read.schema(report.schema).json(path)


# --- projections, filters, expressions ------------------------------------------------


def compact_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = standins.matches(spark, sf_dir).select("duration", "side_a_win", "yr", "mo")
    return rows.withColumnRenamed("side_a_win", "first_side_won")


def pick_ban_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("is_pick")
    return standins.selections(spark, sf_dir).select(KEY, "entity_id", flag, E.complement(flag).alias("is_ban"))


def side_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = (F.col("is_pick") == 1) & (F.col("side") == 0)
    return standins.selections(spark, sf_dir).where(picked).select(KEY, "entity_id", "side")


def early_window_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standins.clashes(spark, sf_dir).where(keyed.is_early("start_s"))


def minute_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standins.advantage(spark, sf_dir).where(keyed.in_window())


def valid_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.valid_duration(standins.matches(spark, sf_dir).select(KEY, "duration"))


def not_null_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_null_keys(standins.matches(spark, sf_dir).select(KEY, "side_a_win"), "side_a_win")


def phase_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    duration = F.when(F.col(KEY) % 11 != 0, F.col("duration"))
    return standins.matches(spark, sf_dir).select(
        KEY,
        E.bucketize(duration, E.PHASE_EDGES, E.PHASE_LABELS).alias("phase"),
        E.bucketize(duration, E.PHASE_EDGES, E.PHASE_LABELS, "drop").alias("phase_or_null"),
    )


def duration_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    duration = F.col("duration")
    return standins.matches(spark, sf_dir).select(
        KEY,
        "duration",
        E.bucketize(duration, E.DURATION_EDGES, E.DURATION_LABELS).alias("bucket"),
        E.bucket_number(duration, E.DURATION_EDGES).alias("bucket_no"),
    )


def side_win_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = enrich(standins.selections(spark, sf_dir), standins.matches(spark, sf_dir), KEY, ["side_a_win"])
    win = E.side_win(F.col("side"), F.col("side_a_win"))
    return rows.select(KEY, "entity_id", "side", win.alias("win"))


def percent_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = F.col("is_pick") == 1
    counts = keyed.key_stats(
        standins.selections(spark, sf_dir),
        {"side_a": E.count_where(picked & (F.col("side") == 0)), "both": E.count_where(picked)},
    )
    return counts.select(KEY, E.percent_rate(F.col("side_a"), F.col("both")).alias("side_a_share"))


def pattern_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("kind")

    def known(test: Column) -> Column:
        return F.coalesce(test, F.lit(False))

    return standins.objectives(spark, sf_dir).select(
        KEY,
        "time_s",
        known(kind == KINDS.first_claim).alias("exact"),
        known(E.matches_pattern(kind, KINDS.tower)).alias("sensitive"),
        known(E.matches_pattern(kind, KINDS.tower.lower())).alias("lower_only"),
        known(E.matches_pattern(kind, KINDS.tower.lower(), ignore_case=True)).alias("insensitive"),
    )


def fill_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = keyed.draft_stats(standins.draft_turns(spark, sf_dir))
    rows = standins.matches(spark, sf_dir).select(KEY).join(stats, KEY, "left")
    names = ("avg_draft_time", "max_draft_time", "total_draft_time")
    return cleaning.fill_defaults(rows, {c: features.OUTCOME_DEFAULTS[c] for c in names})


def guarded_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = keyed.key_stats(
        standins.participants(spark, sf_dir), {"kills": F.sum("kills"), "deaths": F.sum("deaths")}
    )
    return totals.select(KEY, E.guarded_ratio(F.col("kills"), F.col("deaths")).alias("kill_death_ratio"))


def score_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = F.col("score_a"), F.col("score_b")
    return standins.matches(spark, sf_dir).select(
        KEY, F.abs(a - b).alias("score_difference"), (a + b).alias("total_score")
    )


# --- joins ------------------------------------------------------------------------------


def _renumbered_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All matches, those before 1996 under other keys: their draft rows find no match."""
    number = F.when(F.col("yr") < 1996, -1 - F.col(KEY)).otherwise(F.col(KEY))
    return standins.matches(spark, sf_dir).withColumn(KEY, number)


def _enriched(spark: SparkSession, sf_dir: str, how: str) -> DataFrame:
    parents = _renumbered_matches(spark, sf_dir)
    return enrich(standins.selections(spark, sf_dir), parents, KEY, ["yr", "mo", "side_a_win"], how)


def enrich_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir, "left")


def enrich_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir, "inner")


def feature_table_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = features.outcome_table(standins.load(spark, sf_dir), KINDS)
    return table.withColumn("gold_volatility", F.round("gold_volatility", 4))


def feature_table_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = features.duration_table(standins.load(spark, sf_dir), KINDS)
    return table.withColumn("gold_swing_std", F.round("gold_swing_std", 4))


def feature_table_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.outcome_table_compact(standins.load(spark, sf_dir), KINDS)


def feature_table_duration_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.duration_table_compact(standins.load(spark, sf_dir), KINDS)


def _bucketed(spark: SparkSession, sf_dir: str, build: Callable[[standins.ContestTables], DataFrame]) -> DataFrame:
    """A result over the bucketed layout, which is written for it and deleted afterwards."""
    with scratch_scope(spark) as scope:
        folder = scope.own(scratch_path(spark, "layout"))
        bucketed.write_layout(standins.load(spark, sf_dir), folder)
        try:
            return scope.keep(build(bucketed.load_layout(spark, folder)))
        finally:
            bucketed.detach_layout(spark, folder)


def feature_table_outcome_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _bucketed(spark, sf_dir, lambda loaded: features.outcome_table(loaded, KINDS))
    return table.withColumn("gold_volatility", F.round("gold_volatility", 4))


def feature_table_duration_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _bucketed(spark, sf_dir, lambda loaded: features.duration_table(loaded, KINDS))
    return table.withColumn("gold_swing_std", F.round("gold_swing_std", 4))


# --- trends, win rates, periods -----------------------------------------------------------


def rate_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.entity_trends(standins.load(spark, sf_dir))


def rate_trend_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only draft rows with a match, and only known periods."""
    rows = _enriched(spark, sf_dir, "inner")
    return trends.rate_trend(rows, drop_null_period=True)


def rate_trend_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draft rows without a match form a group of their own."""
    return trends.rate_trend(_enriched(spark, sf_dir, "left"))


def _rounded_volatility(df: DataFrame) -> DataFrame:
    names = ("avg_pick_rate", "pick_rate_volatility", "avg_ban_rate")
    return df.withColumns({c: F.round(c, 6) for c in names})


def rate_volatility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_volatility(trends.rate_volatility(rate_trend(spark, sf_dir)))


def top_volatile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_volatility(trends.top_entities(trends.rate_volatility(rate_trend(spark, sf_dir))))


def top_by_pick_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    volatility = trends.rate_volatility(rate_trend(spark, sf_dir), population=True)
    return _rounded_volatility(trends.top_entities(volatility, by="avg_pick_rate"))


def topk_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The series of the leaders, one of which has no id."""
    with scratch_scope(spark) as scope:
        trend = cut_lineage(rate_trend(spark, sf_dir))
        leader = trends.top_entities(trends.rate_volatility(trend), 1).select(F.col("entity_id").alias("leader"))
        rows = trend.join(leader, F.col("entity_id") == F.col("leader"), "left")
        unnamed = rows.withColumn("entity_id", F.when(F.col("leader").isNull(), F.col("entity_id"))).drop("leader")
        return scope.keep(trends.top_series(unnamed).select("yr", "entity_id", "pick_rate", "ban_rate"))


def phase_win_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winrates.phase_win_rate(standins.selections(spark, sf_dir), standins.matches(spark, sf_dir))


def phase_win_rate_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of any size; matches of unknown length left out."""
    return winrates.phase_win_rate(
        standins.selections(spark, sf_dir), _some_unknown_durations(spark, sf_dir), min_count=0, null_bucket="drop"
    )


def trend_of_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rate trend by way of the shared cube."""
    cube = winrates.draft_cube(standins.selections(spark, sf_dir), _renumbered_matches(spark, sf_dir))
    return winrates.trend_of_cube(cube)


def phases_of_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phase win rates by way of the shared cube."""
    cube = winrates.draft_cube(standins.selections(spark, sf_dir), _some_unknown_durations(spark, sf_dir), "drop")
    return winrates.phases_of_cube(cube, min_count=0)


def _some_unknown_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.when(F.col(KEY) % 11 != 0, F.col("duration"))
    return standins.matches(spark, sf_dir).withColumn("duration", known)


def period_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = trends.period_stats(standins.matches(spark, sf_dir))
    return stats.withColumn("std_dev", F.round("std_dev", 4))


def period_stats_yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = trends.period_stats(standins.matches(spark, sf_dir), ["yr"])
    return stats.withColumn("std_dev", F.round("std_dev", 4))


def bucket_win_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winrates.bucket_win_rate(standins.matches(spark, sf_dir))


def bucket_win_rate_nulls_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winrates.bucket_win_rate(_some_unknown_durations(spark, sf_dir))


def bucket_win_rate_nulls_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winrates.bucket_win_rate(_some_unknown_durations(spark, sf_dir), "drop")


def bucket_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bucket_win_rate(spark, sf_dir).orderBy("bucket_no").select("bucket_no", "bucket", "win_rate")


def bucket_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = bucket_win_rate(spark, sf_dir).select("bucket", "total_matches")
    return winrates.share_of_total(counts, "total_matches")


def moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = trends.moments(standins.matches(spark, sf_dir), ["yr", "mo"], "duration")
    return trends.finish_moments(parts).withColumn("std_pop", F.round("std_pop", 4)).drop("squared_dev")


def moments_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly moments added up from monthly ones."""
    parts = trends.moments(standins.matches(spark, sf_dir), ["yr", "mo"], "duration")
    finished = trends.finish_moments(trends.merge_moments(parts, ["yr"]))
    return finished.withColumn("std_pop", F.round("std_pop", 4)).drop("squared_dev")


@scoped
def moments_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly moments kept in a state that three runs add to, one of them twice."""
    matches, keys = standins.matches(spark, sf_dir), ["yr", "mo"]
    with scratch_scope(spark) as scope:
        state = incremental.KeptState(spark, scope.own(scratch_path(spark, "state")), incremental.merged_moments(keys))
        for name in (0, 1, 1, 2):
            state.add(trends.moments(matches.where(F.col(KEY) % 3 == name), keys, "duration"), f"part {name}")
        finished = trends.finish_moments(state.read())
        return scope.keep(finished.withColumn("std_pop", F.round("std_pop", 4)).drop("squared_dev"))


@scoped
def rate_trend_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rate trend from counts kept between runs over disjoint matches."""
    rows, keys = analytics.enriched_selections(standins.load(spark, sf_dir)), ["yr", "entity_id"]
    with scratch_scope(spark) as scope:
        state = incremental.KeptState(spark, scope.own(scratch_path(spark, "state")), incremental.merged_sums(keys))
        for name in range(3):
            part = rows.where(F.col(KEY) % 3 == name).groupBy(*keys).agg(*trends.rate_counts())
            state.add(part, f"part {name}")
            state.tidy(1)
        return scope.keep(trends.with_rates(state.read()))


def period_stats_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only matches of known length count."""
    stats = trends.period_stats(_some_unknown_durations(spark, sf_dir), known_only=True)
    return stats.withColumn("std_dev", F.round("std_dev", 4))


# --- per-match statistics -----------------------------------------------------------------


def objective_counts_early(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.objective_counts_early(standins.objectives(spark, sf_dir), KINDS)


def objective_counts_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.objective_counts_all(standins.objectives(spark, sf_dir), KINDS)


def advantage_stats_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = keyed.gold_window(standins.advantage(spark, sf_dir))
    return stats.withColumn("gold_volatility", F.round("gold_volatility", 4))


def advantage_stats_xp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.xp_window(standins.advantage(spark, sf_dir))


def advantage_swing(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = keyed.gold_swing(standins.advantage(spark, sf_dir))
    return stats.withColumn("gold_swing_std", F.round("gold_swing_std", 4))


def side_pick_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.side_pick_counts(standins.selections(spark, sf_dir))


def unique_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.unique_entities(standins.selections(spark, sf_dir))


def participant_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.participant_totals(standins.participants(spark, sf_dir))


def participant_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.participant_averages(standins.participants(spark, sf_dir))


def participant_averages_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing figures count as 0."""
    return keyed.participant_averages(standins.participants(spark, sf_dir), missing_as_zero=True)


def draft_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.draft_stats(standins.draft_turns(spark, sf_dir))


def clash_stats_early(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.clash_stats_early(standins.clashes(spark, sf_dir))


def clash_stats_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.clash_stats_all(standins.clashes(spark, sf_dir))


def dedupe_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels that repeat, and contradict each other, within a match."""
    label = F.when(F.col("side") == 0, 1).otherwise(0)
    rows = standins.selections(spark, sf_dir).select(KEY, label.alias("side_a_win"))
    return keyed.dedupe_labels(rows, "side_a_win")


# --- learning -------------------------------------------------------------------------------


def _outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.outcome_table(standins.load(spark, sf_dir), KINDS)


def _duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.duration_table(standins.load(spark, sf_dir), KINDS)


def assemble_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _outcome(spark, sf_dir).withColumn("gold_volatility", F.round("gold_volatility", 4))
    values = vector_to_array("features")
    total = F.aggregate(values, F.lit(0.0), lambda so_far, value: so_far + value)
    return learning.assemble(table, features.OUTCOME_FEATURES).select(
        KEY,
        F.size(values).alias("n_features"),
        F.floor(total * 1000).alias("feature_sum_thousandths"),
    )


def standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = standins.matches(spark, sf_dir).select(KEY, "duration", "score_a")
    train, _ = learning.hash_split(rows, KEY)
    scaled = learning.standardize(rows, ["duration", "score_a"], fit_on=train)
    return scaled.withColumns({"duration": F.round("duration", 6), "score_a": F.round("score_a", 6)})


def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.when(learning.in_train(KEY), "train").otherwise("test")
    return standins.matches(spark, sf_dir).select(KEY, part.alias("part"))


# Labels that follow from the features, so that a fit has something to find in the test tables.
KILLS_TO_WIN, GUESS_MARGIN = 100, 0.8


def _outcome_signal(table: DataFrame) -> DataFrame:
    won = F.col("total_kills") > KILLS_TO_WIN
    return table.withColumn(features.OUTCOME_LABEL, won.cast("int"))


def _duration_signal(table: DataFrame) -> DataFrame:
    mixed = F.col("score_a") * 40 + F.col("score_b") * 20 + 600
    return table.withColumn(features.DURATION_LABEL, mixed.cast("int"))


def _report(table: DataFrame, quality: DataFrame, error: Column, guess: Column) -> DataFrame:
    """Rows trained and tested, and whether the error is below ``GUESS_MARGIN`` of a constant's."""
    chosen = learning.in_train(KEY)
    parts = table.agg(
        E.count_where(chosen).alias("trained"),
        E.count_where(~chosen).alias("tested"),
        guess.alias("guess_error"),
    )
    row = parts.first()
    better = error < row.guess_error * GUESS_MARGIN
    return quality.select(
        "model", F.lit(row.trained).cast("bigint").alias("trained"), F.lit(row.tested).cast("bigint").alias("tested"), better.alias("beats_guess")
    )


def _outcome_report(table: DataFrame, columns: Sequence[str], estimators: Mapping[str, Callable[[], Estimator]]) -> DataFrame:
    table = cut_lineage(_outcome_signal(table).select(KEY, features.OUTCOME_LABEL, *columns))
    quality, _ = models.train_classifiers(table, columns, features.OUTCOME_LABEL, estimators)
    share = F.avg(F.when(~learning.in_train(KEY), F.col(features.OUTCOME_LABEL)))
    return _report(table, quality, 1 - F.col("accuracy"), F.least(share, 1 - share))


def _duration_report(table: DataFrame, columns: Sequence[str], estimators: Mapping[str, Callable[[], Estimator]]) -> DataFrame:
    table = cut_lineage(_duration_signal(table).select(KEY, features.DURATION_LABEL, *columns))
    quality, _ = models.train_regressors(table, columns, features.DURATION_LABEL, estimators)
    spread = F.stddev_pop(F.when(~learning.in_train(KEY), F.col(features.DURATION_LABEL)))
    return _report(table, quality, F.col("rmse"), spread)


def _train(one: str, estimators: Mapping[str, Callable[[], Estimator]], task: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        chosen, loaded = {one: estimators[one]}, standins.load(spark, sf_dir)
        if task == "outcome":
            table = features.outcome_table(loaded, KINDS, null_label="zero")
            return _outcome_report(table, features.OUTCOME_FEATURES, chosen)
        return _duration_report(features.duration_table(loaded, KINDS), features.DURATION_FEATURES, chosen)

    return scoped(query)


@scoped
def train_light_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The compact tables with the light tree parameters, both tasks."""
    loaded = standins.load(spark, sf_dir)
    outcome = _outcome_report(
        features.outcome_table_compact(loaded, KINDS, null_label="zero"),
        features.OUTCOME_FEATURES_COMPACT,
        learning.LIGHT_CLASSIFIERS,
    )
    duration = _duration_report(
        features.duration_table_compact(loaded, KINDS), features.DURATION_FEATURES_COMPACT, learning.LIGHT_REGRESSORS
    )
    return outcome.withColumn("task", F.lit("outcome")).unionByName(duration.withColumn("task", F.lit("duration")))


@scoped
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leading feature of a forest, and what all importances sum to."""
    _, weights = models.train_regressors(
        _duration_signal(_duration(spark, sf_dir)),
        features.DURATION_FEATURES,
        features.DURATION_LABEL,
        {"random_forest": learning.LIGHT_REGRESSORS["random_forest"]},
        top=None,
    )
    ranked = F.max_by("feature", F.struct("importance", "feature"))
    return weights.groupBy("model").agg(
        F.count("*").alias("n_features"), ranked.alias("leading"), F.round(F.sum("importance"), 6).alias("total")
    )


def outcome_labels_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels from detail rows, an unknown outcome as 0, of every match."""
    rows = enrich(standins.participants(spark, sf_dir), standins.matches(spark, sf_dir), KEY, ["side_a_win"])
    return features.outcome_base(rows, null_label="zero")


def objective_counts_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patterns in any case, and objectives of unknown kind counted."""
    lower = replace(KINDS, tower=KINDS.tower.lower())
    return keyed.objective_counts_early(standins.objectives(spark, sf_dir), lower, ignore_case=True, count_unknown=True)


def period_stats_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population spread, and no group for matches without a period."""
    known = F.when(F.col(KEY) % 13 != 0, F.col("yr"))
    rows = standins.matches(spark, sf_dir).withColumn("yr", known)
    stats = trends.period_stats(rows, drop_null_period=True, population=True)
    return stats.withColumn("std_dev", F.round("std_dev", 4))


@scoped
def score_test_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every match of the test part, and only those, gets a prediction."""
    table = cut_lineage(_duration(spark, sf_dir))
    data = learning.prepare(table, features.DURATION_FEATURES, features.DURATION_LABEL, KEY)
    try:
        model = learning.fit(data, learning.REGRESSORS["linear_regression"]())
    finally:
        data.release()
    known = F.col("prediction").isNotNull() & ~F.isnan("prediction")
    return learning.score(data, model).select(KEY, features.DURATION_LABEL, known.alias("is_scored"))


# --- metrics ----------------------------------------------------------------------------------


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches of known outcome with simple scores: participant figures."""
    loaded = standins.load(spark, sf_dir)
    table = features.feature_table(
        features.outcome_base(loaded.matches),
        [keyed.participant_totals(loaded.participants)],
        features.OUTCOME_DEFAULTS,
        {},
    )
    return table.select(
        KEY,
        "side_a_win",
        F.col("avg_gold_rate_all").alias("score"),
        F.col("total_kills").alias("kill_score"),
        F.col("first_claim_total").alias("claim_score"),
    )


def auc_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    area = metrics.auc(_scored(spark, sf_dir), "score", "side_a_win")
    return area.select(F.round("auc", 8).alias("auc"))


def accuracy_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    guess = F.when(F.col("kill_score") > 100, 1).otherwise(0)
    return metrics.accuracy(_scored(spark, sf_dir).withColumn("guess", guess), "guess", "side_a_win")


def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    guess = (F.col("score_a") + F.col("score_b")) * 40
    rows = standins.matches(spark, sf_dir).select("duration", guess.alias("guess"))
    return metrics.regression_metrics(rows, "guess", "duration").select(
        F.round("rmse", 6).alias("rmse"), F.round("r2", 6).alias("r2")
    )


_PLAIN = ("score_a", "score_b", "first_claim_time")


def _one_feature_fits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error on the test part of a linear regression on each of some columns, and of a model without one."""
    table = cut_lineage(_duration_signal(features.duration_base(standins.matches(spark, sf_dir))))
    boards = [spark.range(1).select(F.lit("aborted").alias("model"), F.lit(None).cast("double").alias("rmse"))]
    for column in _PLAIN:
        data = learning.prepare(table, [column], features.DURATION_LABEL, KEY)
        try:
            model = learning.fit(data, LinearRegression(regParam=0.0))
            found = learning.regressor_metrics(learning.score(data, model), features.DURATION_LABEL, column)
            boards.append(cut_lineage(found.select("model", "rmse")))
        finally:
            data.release()
    return reduce(DataFrame.unionByName, boards)


@scoped
def fitted_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_feature_fits(spark, sf_dir).withColumn("rmse", F.round("rmse", 6))


@scoped
def fitted_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best of fitted models; one without a metric is skipped."""
    best = metrics.leaderboard(_one_feature_fits(spark, sf_dir), "rmse", largest=False)
    return best.withColumn("best_value", F.round("best_value", 6))


@scoped
def fitted_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of two scaled columns in a linear regression of the real durations."""
    table = features.duration_base(standins.matches(spark, sf_dir))
    data = learning.prepare(cut_lineage(table), _PLAIN[:2], features.DURATION_LABEL, KEY)
    try:
        model = learning.fit(data, LinearRegression(regParam=0.0))
    finally:
        data.release()
    rows = [(name, round(float(w), 6)) for name, w in zip([*_PLAIN[:2], "intercept"], [*model.coefficients, model.intercept])]
    return tables.literal_table(spark, rows, {"feature": "string", "weight": "double"})


@scoped
def model_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = cut_lineage(_scored(spark, sf_dir))
    scores = {"claims": "claim_score", "gold": "score", "kills": "kill_score"}
    rows = [
        metrics.auc(scored, column, "side_a_win").select(F.lit(model).alias("model"), "auc")
        for model, column in scores.items()
    ]
    board = rows[0].unionByName(rows[1]).unionByName(rows[2])
    return metrics.leaderboard(board, "auc").withColumn("best_value", F.round("best_value", 8))


def queries() -> dict[str, Query]:
    named = [
        csv_scan_strings, csv_scan_typed, csv_scan_inferred, coerce_types, time_parts, time_parts_absent,
        bool_normalize, drop_null_keys, table_counts, result_sink_roundtrip, result_sink_counts,
        single_file_sink,
        compact_projection, pick_ban_flags, side_picks, early_window_filter, minute_range_filter,
        valid_duration, not_null_filter, phase_bucket, duration_bucket, side_win_flag, percent_rate,
        pattern_flags, fill_defaults, guarded_ratio, score_derived,
        enrich_left, enrich_inner, feature_table_outcome, feature_table_duration, feature_table_compact,
        feature_table_duration_compact, topk_series,
        rate_trend, rate_trend_matched, rate_trend_unmatched, rate_volatility, top_volatile, top_by_pick_rate, phase_win_rate, phase_win_rate_all, trend_of_cube,
        phases_of_cube, period_stats,
        period_stats_yearly, bucket_win_rate, bucket_win_rate_nulls_last, bucket_win_rate_nulls_dropped,
        bucket_ordered, bucket_share, moments, moments_merged,
        objective_counts_early, objective_counts_all, advantage_stats_window, advantage_stats_xp,
        advantage_swing, side_pick_counts, unique_entities, participant_totals, participant_averages,
        draft_stats, clash_stats_early, clash_stats_all, dedupe_by_key,
        assemble_features, standardize, hash_split,
        auc_metric, accuracy_metric, regression_metrics, model_leaderboard,
        train_light_profile, feature_importance, score_test_part,
        outcome_labels_zero, objective_counts_options, period_stats_options,
        csv_type_profile, csv_scan_profiled, committed_results, cached_reports,
        feature_table_outcome_bucketed, feature_table_duration_bucketed, moments_incremental,
        rate_trend_incremental, period_stats_known, participant_averages_zero, fitted_metrics,
        fitted_leaderboard, fitted_coefficients,
    ]
    catalog = {query.__name__: query for query in named}
    catalog |= {
        "train_logistic": _train("logistic_regression", learning.CLASSIFIERS, "outcome"),
        "train_rf_classifier": _train("random_forest", learning.CLASSIFIERS, "outcome"),
        "train_gbt_classifier": _train("gradient_boosting", learning.CLASSIFIERS, "outcome"),
        "train_linear": _train("linear_regression", learning.REGRESSORS, "duration"),
        "train_rf_regressor": _train("random_forest", learning.REGRESSORS, "duration"),
        "train_gbt_regressor": _train("gradient_boosting", learning.REGRESSORS, "duration"),
    }
    return catalog
