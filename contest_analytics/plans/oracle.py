"""The catalog's queries once more, as plain SQL for the correctness check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from contest_analytics.operators import features

# The canonical tables over the test tables.
VIEWS = {
    "matches": """
        SELECT o_orderkey AS match_id, o_orderdate AS start_time,
               CAST(floor(o_totalprice / 100) AS INTEGER) AS duration,
               CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS side_a_win,
               CAST(o_custkey % 60 AS INTEGER) AS score_a,
               CAST(o_orderkey % 60 AS INTEGER) AS score_b,
               CAST(o_custkey % 25 AS INTEGER) AS league_id,
               CAST(substring(o_orderpriority, 1, 1) AS INTEGER) * 60 AS first_claim_time,
               CAST(year(o_orderdate) AS INTEGER) AS yr,
               CAST(month(o_orderdate) AS INTEGER) AS mo
        FROM orders""",
    "selections": """
        SELECT l_orderkey AS match_id, l_suppkey AS entity_id,
               CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END AS side,
               CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END AS is_pick
        FROM lineitem""",
    "participants": """
        SELECT l_orderkey AS match_id,
               CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS first_claim,
               CAST(floor(l_extendedprice / 100) AS BIGINT) AS gold_rate,
               CAST(l_partkey % 1000 AS BIGINT) AS xp_rate,
               CAST(floor(l_extendedprice) AS BIGINT) AS damage,
               l_suppkey AS tower_damage,
               CAST(floor(l_quantity) AS BIGINT) AS kills,
               CAST(l_linenumber - 1 AS BIGINT) AS deaths,
               CASE WHEN l_returnflag <> 'N' THEN CAST(floor(l_tax * 100) AS BIGINT) END AS assists
        FROM lineitem""",
    "objectives": """
        SELECT l_orderkey AS match_id, l_linenumber * 100 AS time_s,
               CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL ELSE p_type END AS kind
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "advantage": """
        SELECT l_orderkey AS match_id, l_linenumber + 3 AS minute_no,
               CAST(floor(CASE WHEN l_linestatus = 'F' THEN l_extendedprice ELSE -l_extendedprice END) AS BIGINT) AS gold,
               CAST(floor(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE -l_quantity END) AS BIGINT) AS xp
        FROM lineitem""",
    "clashes": """
        SELECT l_orderkey AS match_id, l_linenumber * 120 AS start_s,
               CAST(l_partkey % 7 AS BIGINT) AS deaths
        FROM lineitem""",
    "draft_turns": """
        SELECT l_orderkey AS match_id, CAST(floor(l_discount * 100) AS BIGINT) + 20 AS time_taken
        FROM lineitem""",
}



def _half_up(value: str) -> str:
    """Two decimals of a double as it prints, halves away from zero, as Spark rounds."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 20)), 2) AS DOUBLE)"


PHASE = """CASE WHEN duration < 1800 THEN 'Early (<30min)' WHEN duration < 2700 THEN 'Mid (30-45min)'
           ELSE 'Late (>45min)' END"""
BUCKET = """CASE WHEN duration < 1200 THEN '0-20min' WHEN duration < 1800 THEN '20-30min'
            WHEN duration < 2400 THEN '30-40min' WHEN duration < 3000 THEN '40-50min' ELSE '50min+' END"""
BUCKET_NO = """CASE WHEN duration < 1200 THEN 1 WHEN duration < 1800 THEN 2
               WHEN duration < 2400 THEN 3 WHEN duration < 3000 THEN 4 ELSE 5 END"""
SIDE_WIN = "CASE WHEN (side = 0 AND side_a_win) OR (side = 1 AND NOT side_a_win) THEN 1 ELSE 0 END"

TREND = f"""
    SELECT yr, entity_id,
           CAST(sum(is_pick) AS BIGINT) AS picks,
           CAST(sum(1 - is_pick) AS BIGINT) AS bans,
           count(*) AS total_appearances,
           {_half_up("CAST(sum(is_pick) AS DOUBLE) / count(*) * 100")} AS pick_rate,
           {_half_up("CAST(sum(1 - is_pick) AS DOUBLE) / count(*) * 100")} AS ban_rate
    FROM selections LEFT JOIN matches USING (match_id)
    GROUP BY yr, entity_id"""
VOLATILITY = """
    SELECT entity_id, avg(pick_rate) AS avg_pick_rate, stddev_samp(pick_rate) AS pick_rate_volatility,
           avg(ban_rate) AS avg_ban_rate
    FROM trend GROUP BY entity_id"""
BUCKETS = f"""
    SELECT {BUCKET_NO} AS bucket_no, {BUCKET} AS bucket, count(*) AS total_matches,
           CAST(sum(CASE WHEN side_a_win THEN 1 ELSE 0 END) AS BIGINT) AS side_a_wins
    FROM matches GROUP BY 1, 2"""

RENUMBERED = "SELECT * REPLACE (CASE WHEN yr < 1996 THEN -1 - match_id ELSE match_id END AS match_id) FROM matches"
SOME_UNKNOWN = "SELECT * REPLACE (CASE WHEN match_id % 11 <> 0 THEN duration END AS duration) FROM matches"

# Dirty text derived from the match keys, for the cleaning steps.
DIRTY = """
    SELECT match_id,
           CASE match_id % 7 WHEN 0 THEN 'n/a' WHEN 1 THEN NULL WHEN 2 THEN CAST(duration AS VARCHAR) || '.0'
                WHEN 3 THEN '99999999999' WHEN 4 THEN 'x' ELSE CAST(duration AS VARCHAR) END AS duration_text,
           '90000000000000' || lpad(CAST(match_id AS VARCHAR), 5, '0')
               || CASE match_id % 7 WHEN 2 THEN '.0' ELSE '' END AS long_key_text,
           CASE match_id % 7 WHEN 0 THEN 'true' WHEN 1 THEN ' YES ' WHEN 2 THEN '0' WHEN 3 THEN 'x'
                WHEN 4 THEN NULL WHEN 5 THEN 'F' ELSE 'True' END AS flag_text,
           CASE match_id % 7 WHEN 0 THEN 'zz' WHEN 1 THEN NULL
                ELSE strftime(start_time, '%Y-%m-%d %H:%M:%S') END AS start_text,
           CASE WHEN match_id % 7 <> 3 THEN match_id END AS key_or_null
    FROM matches"""

EARLY_OBJECTIVES = """
    SELECT match_id,
           count(CASE WHEN kind = 'PROMO' THEN 1 END) AS first_claim_count,
           count(CASE WHEN kind LIKE '%AL%' THEN 1 END) AS early_towers,
           count(CASE WHEN kind LIKE '%ECON%' THEN 1 END) AS early_couriers,
           count(kind) AS early_objectives
    FROM objectives WHERE time_s <= 600 GROUP BY match_id"""
ALL_OBJECTIVES = """
    SELECT match_id, count(*) AS total_objectives,
           count(CASE WHEN kind LIKE '%AL%' THEN 1 END) AS total_towers,
           count(CASE WHEN kind LIKE '%MED%' THEN 1 END) AS total_barracks
    FROM objectives GROUP BY match_id"""
GOLD_WINDOW = """
    SELECT match_id, avg(gold) AS avg_gold_window, max(gold) AS max_gold_window,
           min(gold) AS min_gold_window, round(stddev_samp(gold), 4) AS gold_volatility
    FROM advantage WHERE minute_no BETWEEN 5 AND 10 GROUP BY match_id"""
XP_WINDOW = """
    SELECT match_id, avg(xp) AS avg_xp_window, max(xp) AS max_xp_window
    FROM advantage WHERE minute_no BETWEEN 5 AND 10 GROUP BY match_id"""
SWING = """
    SELECT match_id, max(gold) AS max_gold_lead, min(gold) AS min_gold_lead,
           round(stddev_samp(gold), 4) AS gold_swing_std
    FROM advantage GROUP BY match_id"""
SIDE_PICKS = """
    SELECT match_id, a.side_a_picks, a.side_a_entities, b.side_b_picks, b.side_b_entities
    FROM (SELECT match_id, count(entity_id) AS side_a_picks, count(DISTINCT entity_id) AS side_a_entities
          FROM selections WHERE is_pick = 1 AND side = 0 GROUP BY match_id) a
    FULL JOIN (SELECT match_id, count(entity_id) AS side_b_picks, count(DISTINCT entity_id) AS side_b_entities
               FROM selections WHERE is_pick = 1 AND side = 1 GROUP BY match_id) b USING (match_id)"""
UNIQUE = """
    SELECT match_id, count(DISTINCT entity_id) AS unique_entities
    FROM selections WHERE is_pick = 1 GROUP BY match_id"""
TOTALS = """
    SELECT match_id, CAST(sum(CASE WHEN first_claim > 0 THEN 1 ELSE 0 END) AS BIGINT) AS first_claim_total,
           avg(gold_rate) AS avg_gold_rate_all, avg(xp_rate) AS avg_xp_rate_all, max(damage) AS max_damage,
           CAST(sum(kills) AS BIGINT) AS total_kills, CAST(sum(deaths) AS BIGINT) AS total_deaths,
           CAST(sum(assists) AS BIGINT) AS total_assists
    FROM participants GROUP BY match_id"""
AVERAGES = """
    SELECT match_id, avg(kills) AS avg_kills, avg(deaths) AS avg_deaths, avg(assists) AS avg_assists,
           avg(gold_rate) AS avg_gold_rate, avg(xp_rate) AS avg_xp_rate, avg(damage) AS avg_damage,
           CAST(sum(tower_damage) AS BIGINT) AS total_tower_damage
    FROM participants GROUP BY match_id"""
DRAFT = """
    SELECT match_id, avg(time_taken) AS avg_draft_time, max(time_taken) AS max_draft_time,
           CAST(sum(time_taken) AS BIGINT) AS total_draft_time
    FROM draft_turns GROUP BY match_id"""
CLASH_EARLY = """
    SELECT match_id, count(*) AS early_clashes, avg(deaths) AS avg_clash_deaths
    FROM clashes WHERE start_s <= 600 GROUP BY match_id"""
CLASH_ALL = """
    SELECT match_id, count(*) AS total_clashes, avg(deaths) AS avg_deaths_per_clash,
           CAST(sum(deaths) AS BIGINT) AS total_clash_deaths
    FROM clashes GROUP BY match_id"""
RATIO = """CASE WHEN coalesce(total_deaths, 0) > 0
                THEN CAST(coalesce(total_kills, 0) AS DOUBLE) / total_deaths
                ELSE CAST(coalesce(total_kills, 0) AS DOUBLE) END"""
OUTCOME_BASE = """
    SELECT match_id, max(CAST(side_a_win AS INTEGER)) AS side_a_win FROM matches
    GROUP BY match_id HAVING max(CAST(side_a_win AS INTEGER)) IS NOT NULL"""
DURATION_BASE = """
    SELECT match_id, duration, league_id, score_a, score_b, first_claim_time
    FROM matches WHERE duration BETWEEN 600 AND 7200"""


def _with(views: str, body: str, **steps: str) -> str:
    """Query text with the canonical tables it names, then its own steps, as CTEs."""
    parts = [f"{name} AS ({VIEWS[name]})" for name in views.split()]
    parts += [f"{name} AS ({text})" for name, text in steps.items()]
    return f"WITH {', '.join(parts)} {body}"


DERIVED = {
    "kill_death_ratio": RATIO,
    "score_difference": "abs(coalesce(score_a, 0) - coalesce(score_b, 0))",
    "total_score": "coalesce(score_a, 0) + coalesce(score_b, 0)",
}


def _columns(label: str, names: Sequence[str], defaults: Mapping[str, float]) -> str:
    """The columns of a feature table, by the declaration of its figures."""
    values = (DERIVED.get(name) or f"coalesce({name}, {defaults[name]:g})" for name in names)
    return ", ".join(["match_id", label, *(f"{value} AS {name}" for name, value in zip(names, values))])


def _all_columns(label: str, task: features.Task) -> str:
    return _columns(label, [*task.defaults(), *(d.name for d in task.derived)], task.defaults())


OUTCOME_COLUMNS = _all_columns("side_a_win", features.OUTCOME)
OUTCOME_COLUMNS_COMPACT = _columns("side_a_win", features.OUTCOME_FEATURES_COMPACT, features.OUTCOME_DEFAULTS)
DURATION_COLUMNS = _all_columns("duration", features.DURATION)
DURATION_COLUMNS_COMPACT = _columns("duration", features.DURATION_FEATURES_COMPACT, features.DURATION_DEFAULTS)

OUTCOME_STEPS = {
    "base": OUTCOME_BASE,
    "s1": EARLY_OBJECTIVES,
    "s2": GOLD_WINDOW,
    "s3": XP_WINDOW,
    "s4": TOTALS,
    "s5": SIDE_PICKS,
    "s6": DRAFT,
    "s7": CLASH_EARLY,
}
DURATION_STEPS = {
    "base": DURATION_BASE,
    "s1": ALL_OBJECTIVES,
    "s2": CLASH_ALL,
    "s3": SWING,
    "s4": AVERAGES,
    "s5": SIDE_PICKS,
    "s6": UNIQUE,
    "s7": DRAFT,
}


def _feature_sql(columns: str, steps: dict[str, str], sides: int, views: str) -> str:
    used = dict(list(steps.items())[: sides + 1])
    joins = " ".join(f"LEFT JOIN s{i} USING (match_id)" for i in range(1, sides + 1))
    return _with(views, f"SELECT {columns} FROM base {joins}", **used)


_ALL = "matches selections participants objectives advantage clashes draft_turns"
_FOUR_OUTCOME = "matches participants objectives advantage"
_FOUR_DURATION = "matches participants objectives advantage clashes"
OUTCOME_SQL = _feature_sql(OUTCOME_COLUMNS, OUTCOME_STEPS, 7, _ALL)
DURATION_SQL = _feature_sql(DURATION_COLUMNS, DURATION_STEPS, 7, _ALL)

SPLIT = "substring(md5(CAST(match_id AS VARCHAR)), 1, 8) < 'cccccccc'"
# A score for every match of known outcome: its average gold rate.
SCORED = """
    SELECT match_id, side_a_win, coalesce(avg_gold_rate_all, 400) AS score, coalesce(total_kills, 0) AS kill_score,
           coalesce(first_claim_total, 0) AS claim_score
    FROM base LEFT JOIN totals USING (match_id)"""


def _auc_sql(score: str) -> str:
    return f"""
        SELECT sum(pos * (coalesce(below, 0) + neg / 2.0)) / (sum(pos) * sum(neg)) AS auc
        FROM (SELECT pos, neg, sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS below
              FROM (SELECT {score} AS s, CAST(sum(side_a_win) AS DOUBLE) AS pos,
                           CAST(sum(1 - side_a_win) AS DOUBLE) AS neg FROM scored GROUP BY 1))"""


def _trained(model: str, task: str) -> str:
    """What is certain of a fit: the rows of both parts, and that it finds a label made of its features."""
    rows = "matches" if task == "outcome" else "matches WHERE duration BETWEEN 600 AND 7200"
    return f"""SELECT '{model}' AS model, count(*) FILTER ({SPLIT}) AS trained,
                      count(*) FILTER (NOT ({SPLIT})) AS tested, TRUE AS beats_guess FROM {rows}"""


_PLAIN = ("score_a", "score_b", "first_claim_time")
SIGNAL_BASE = f"""SELECT match_id, CAST(score_a * 40 + score_b * 20 + 600 AS DOUBLE) AS y, score_a, score_b, first_claim_time
                  FROM ({DURATION_BASE})"""


def _one_feature(column: str) -> str:
    """The error on the test part of the least-squares line through the training part."""
    return f"""SELECT '{column}' AS model, round(sqrt(avg(power(y - slope * {column} - start, 2))), 6) AS rmse
               FROM base, (SELECT regr_slope(y, {column}) AS slope, regr_intercept(y, {column}) AS start
                           FROM base WHERE {SPLIT}) WHERE NOT ({SPLIT})"""


def _type_profile() -> str:
    """Which values a type reads, by pattern; the first type that reads two thirds counts."""
    texts = {
        "duration_text": "duration_text", "long_key_text": "long_key_text", "flag_text": "flag_text",
        "start_text": "start_text", "score_text": "CAST(score_a AS VARCHAR)",
        "half_text": "' ' || CAST(score_b AS VARCHAR) || '.5'", "won_text": "CAST(side_a_win AS VARCHAR)",
        "clock_text": "strftime(start_time, '%Y-%m-%d %H:%M:%S')", "empty_text": "''",
    }
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, nullif(trim({text}), '') AS v FROM matches JOIN dirty USING (match_id)"
        for name, text in texts.items()
    )
    return _with(
        "matches",
        """SELECT column_name, type, n_values, n_missing,
                  n_values - CASE type WHEN 'bigint' THEN whole WHEN 'double' THEN number WHEN 'boolean' THEN flag
                             WHEN 'timestamp' THEN clock ELSE n_values END AS n_malformed
           FROM (SELECT *, CASE WHEN n_values = 0 THEN 'string' WHEN whole >= enough THEN 'bigint' WHEN number >= enough THEN 'double'
                                WHEN flag >= enough THEN 'boolean' WHEN clock >= enough THEN 'timestamp' ELSE 'string' END AS type
                 FROM (SELECT column_name, count(v) AS n_values, count(*) - count(v) AS n_missing, count(v) * 0.66 AS enough,
                              count(*) FILTER (regexp_full_match(v, '[0-9]{1,19}')) AS whole,
                              count(*) FILTER (regexp_full_match(v, '[0-9]+([.][0-9]+)?')) AS number,
                              count(*) FILTER (lower(v) IN ('t', 'true', 'y', 'yes', '1', 'f', 'false', 'n', 'no', '0')) AS flag,
                              count(*) FILTER (regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}')) AS clock
                       FROM texts GROUP BY column_name))""",
        dirty=DIRTY,
        texts=rows,
    )


def statements() -> dict[str, str]:
    """SQL by query name."""
    found = _statements()
    # The cube is another way to results that have their SQL already.
    learned = {
        "train_logistic": ("logistic_regression", "outcome"),
        "train_rf_classifier": ("random_forest", "outcome"),
        "train_gbt_classifier": ("gradient_boosting", "outcome"),
        "train_linear": ("linear_regression", "duration"),
        "train_rf_regressor": ("random_forest", "duration"),
        "train_gbt_regressor": ("gradient_boosting", "duration"),
    }
    found |= {name: _with("matches", _trained(model, task)) for name, (model, task) in learned.items()}
    light = [
        f"SELECT *, '{task}' AS task FROM ({_trained(model, task)})"
        for task in ("outcome", "duration")
        for model in ("random_forest", "gradient_boosting")
    ]
    return found | {
        "train_light_profile": _with("matches", " UNION ALL ".join(light)),
        "trend_of_cube": found["rate_trend_unmatched"],
        "phases_of_cube": found["phase_win_rate_all"],
        "rate_trend_incremental": found["rate_trend"],
        "moments_incremental": found["moments"],
        "feature_table_outcome_bucketed": found["feature_table_outcome"],
        "feature_table_duration_bucketed": found["feature_table_duration"],
    }


def _statements() -> dict[str, str]:
    trend_steps = {"trend": TREND, "volatility": VOLATILITY}
    bucket_rate = f"{_half_up('CAST(side_a_wins AS DOUBLE) / total_matches * 100')} AS win_rate"
    period = f"""
        SELECT yr, mo, avg(duration) AS avg_duration_sec, count(*) AS total_matches, min(duration) AS shortest,
               max(duration) AS longest, round(stddev_samp(duration), 4) AS std_dev,
               {_half_up("avg(duration) / 60")} AS avg_duration_min
        FROM matches GROUP BY yr, mo"""
    moments = """
        SELECT yr, mo, count(duration) AS n, CAST(sum(duration) AS BIGINT) AS total,
               min(duration) AS lowest,
               max(duration) AS highest, avg(duration) AS mean, round(stddev_pop(duration), 4) AS std_pop
        FROM matches GROUP BY yr, mo"""
    outcome_sum = " + ".join(features.OUTCOME_FEATURES)
    return {
        "csv_scan_strings": _with(
            "matches",
            """SELECT CAST(match_id AS VARCHAR) AS match_id, CAST(duration AS VARCHAR) AS duration,
                      CAST(side_a_win AS VARCHAR) AS side_a_win,
                      strftime(start_time, '%Y-%m-%d %H:%M:%S') AS start_time FROM matches""",
        ),
        "csv_scan_typed": _with("matches", "SELECT match_id, duration, side_a_win, score_a, score_b FROM matches"),
        "csv_scan_profiled": _with(
            "matches",
            """SELECT match_id, CAST(duration AS BIGINT) AS duration, side_a_win, CAST(score_a AS BIGINT) AS score_a,
                      CAST(score_b AS BIGINT) AS score_b FROM matches""",
        ),
        "csv_type_profile": _type_profile(),
        "cached_reports": _with(
            "selections matches",
            """SELECT 'yr' AS report, yr AS value, count(*) AS n FROM selections LEFT JOIN matches USING (match_id) GROUP BY yr
               UNION ALL SELECT 'side', side, count(*) FROM selections GROUP BY side""",
        ),
        "period_stats_known": _with(
            "matches",
            period.replace("FROM matches", "FROM known WHERE duration IS NOT NULL"),
            known="SELECT * REPLACE (CASE WHEN match_id % 11 <> 0 THEN duration END AS duration) FROM matches",
        ),
        "participant_averages_zero": _with(
            "participants", AVERAGES.replace("avg(assists)", "avg(coalesce(assists, 0))")
        ),
        "fitted_metrics": _with(
            "matches",
            " UNION ALL ".join(["SELECT 'aborted' AS model, CAST(NULL AS DOUBLE) AS rmse", *map(_one_feature, _PLAIN)]),
            base=SIGNAL_BASE,
        ),
        "fitted_leaderboard": _with(
            "matches",
            f"""SELECT model AS best_model, rmse AS best_value
                FROM ({" UNION ALL ".join(map(_one_feature, _PLAIN))}) ORDER BY rmse, model LIMIT 1""",
            base=SIGNAL_BASE,
        ),
        "fitted_coefficients": _with(
            "matches",
            """SELECT unnest(['score_a', 'score_b', 'intercept']) AS feature, unnest([
                      round((ay * bb - by_ * ab) / (aa * bb - ab * ab) * a_s, 6),
                      round((by_ * aa - ay * ab) / (aa * bb - ab * ab) * b_s, 6), round(y, 6)]) AS weight FROM sums""",
            base=DURATION_BASE,
            sums=f"""SELECT covar_samp(score_a, duration) AS ay, covar_samp(score_b, duration) AS by_,
                           covar_samp(score_a, score_b) AS ab, var_samp(score_a) AS aa, var_samp(score_b) AS bb,
                           stddev_samp(score_a) AS a_s, stddev_samp(score_b) AS b_s, avg(duration) AS y
                    FROM base WHERE {SPLIT}""",
        ),
        "csv_scan_inferred": _with(
            "matches",
            "SELECT CAST(match_id AS INTEGER) AS match_id, duration, side_a_win, score_a, score_b FROM matches",
        ),
        "coerce_types": _with(
            "matches",
            """SELECT match_id, TRY_CAST(trunc(TRY_CAST(duration_text AS DECIMAL(38, 10))) AS INTEGER) AS duration_s,
                      TRY_CAST(duration_text AS DOUBLE) AS duration_x,
                      CAST(trunc(TRY_CAST(long_key_text AS DECIMAL(38, 10))) AS BIGINT) AS long_key
               FROM dirty""",
            dirty=DIRTY,
        ),
        "time_parts": _with(
            "matches",
            """SELECT match_id, CAST(year(t) AS INTEGER) AS yr, CAST(month(t) AS INTEGER) AS mo
               FROM (SELECT match_id, try_cast(start_text AS TIMESTAMP) AS t FROM dirty)""",
            dirty=DIRTY,
        ),
        "time_parts_absent": _with(
            "matches", "SELECT match_id, CAST(NULL AS INTEGER) AS yr, CAST(NULL AS INTEGER) AS mo FROM matches"
        ),
        "bool_normalize": _with(
            "matches",
            """SELECT match_id,
                      CASE WHEN lower(trim(flag_text)) IN ('1', 'true', 't', 'yes', 'y') THEN TRUE
                           WHEN lower(trim(flag_text)) IN ('0', 'false', 'f', 'no', 'n') THEN FALSE END AS wide,
                      CASE WHEN flag_text IN ('1', 'true', 'True') THEN TRUE
                           WHEN flag_text IN ('0', 'false', 'False') THEN FALSE END AS narrow,
                      CASE WHEN lower(trim(flag_text)) IN ('1', 'true', 't', 'yes', 'y') THEN 1 ELSE 0 END AS flag
               FROM dirty""",
            dirty=DIRTY,
        ),
        "drop_null_keys": _with(
            "matches",
            "SELECT key_or_null, duration_text FROM dirty WHERE key_or_null IS NOT NULL AND duration_text IS NOT NULL",
            dirty=DIRTY,
        ),
        "table_counts": _with(
            _ALL,
            " UNION ALL ".join(f"SELECT '{v}' AS table_name, count(*) AS n_rows FROM {v}" for v in _ALL.split()),
        ),
        "result_sink_roundtrip": _with("selections matches", TREND),
        "result_sink_counts": _with(
            "selections matches",
            """SELECT 'entity_trends' AS result, count(*) AS n_records FROM trend
               UNION ALL SELECT 'entity_by_phase', count(*) FROM phases
               UNION ALL SELECT 'duration_trends', count(*) FROM (SELECT DISTINCT yr, mo FROM matches)
               UNION ALL SELECT 'duration_buckets', count(*) FROM buckets""",
            trend=TREND,
            buckets=BUCKETS,
            phases=f"""SELECT entity_id, {PHASE} AS phase FROM selections JOIN matches USING (match_id)
                       WHERE is_pick = 1 GROUP BY 1, 2 HAVING count(*) >= 50""",
        ),
        "committed_results": _with(
            "selections matches",
            """SELECT 'entity_trends' AS result, count(*) AS n_records, count(*) AS n_read FROM trend
               UNION ALL SELECT 'entity_by_phase', count(*), count(*) FROM phases
               UNION ALL SELECT 'duration_trends', count(*), count(*) FROM (SELECT DISTINCT yr, mo FROM matches)
               UNION ALL SELECT 'duration_buckets', count(*), count(*) FROM buckets""",
            trend=TREND,
            buckets=BUCKETS,
            phases=f"""SELECT entity_id, {PHASE} AS phase FROM selections JOIN matches USING (match_id)
                       WHERE is_pick = 1 GROUP BY 1, 2 HAVING count(*) >= 50""",
        ),
        "single_file_sink": _with("matches", f"SELECT *, {bucket_rate} FROM buckets", buckets=BUCKETS),
        "compact_projection": _with("matches", "SELECT duration, side_a_win AS first_side_won, yr, mo FROM matches"),
        "pick_ban_flags": _with(
            "selections", "SELECT match_id, entity_id, is_pick, 1 - is_pick AS is_ban FROM selections"
        ),
        "side_picks": _with(
            "selections", "SELECT match_id, entity_id, side FROM selections WHERE is_pick = 1 AND side = 0"
        ),
        "early_window_filter": _with(
            "clashes", "SELECT match_id, start_s, deaths FROM clashes WHERE start_s <= 600"
        ),
        "minute_range_filter": _with(
            "advantage", "SELECT match_id, minute_no, gold, xp FROM advantage WHERE minute_no BETWEEN 5 AND 10"
        ),
        "valid_duration": _with(
            "matches", "SELECT match_id, duration FROM matches WHERE duration BETWEEN 600 AND 7200"
        ),
        "not_null_filter": _with("matches", "SELECT match_id, side_a_win FROM matches WHERE side_a_win IS NOT NULL"),
        "phase_bucket": _with(
            "matches",
            f"""SELECT match_id, {PHASE} AS phase, CASE WHEN duration IS NOT NULL THEN {PHASE} END AS phase_or_null
                FROM (SELECT match_id, CASE WHEN match_id % 11 <> 0 THEN duration END AS duration FROM matches)""",
        ),
        "duration_bucket": _with(
            "matches", f"SELECT match_id, duration, {BUCKET} AS bucket, {BUCKET_NO} AS bucket_no FROM matches"
        ),
        "side_win_flag": _with(
            "selections matches",
            f"""SELECT match_id, entity_id, side, {SIDE_WIN} AS win
                FROM selections LEFT JOIN matches USING (match_id)""",
        ),
        "percent_rate": _with(
            "selections",
            f"""SELECT match_id,
                       CASE WHEN picks > 0 THEN {_half_up("CAST(picks_a AS DOUBLE) / picks * 100")} ELSE 0.0 END
                           AS side_a_share
                FROM (SELECT match_id, sum(is_pick) AS picks,
                             sum(CASE WHEN side = 0 THEN is_pick ELSE 0 END) AS picks_a
                      FROM selections GROUP BY match_id)""",
        ),
        "pattern_flags": _with(
            "objectives",
            """SELECT match_id, time_s, coalesce(kind = 'PROMO', FALSE) AS exact,
                      coalesce(kind LIKE '%AL%', FALSE) AS sensitive, coalesce(kind LIKE '%al%', FALSE) AS lower_only,
                      coalesce(kind ILIKE '%al%', FALSE) AS insensitive
               FROM objectives""",
        ),
        "fill_defaults": _with(
            "matches draft_turns",
            """SELECT match_id, coalesce(avg_draft_time, 30) AS avg_draft_time,
                      coalesce(max_draft_time, 30) AS max_draft_time,
                      coalesce(total_draft_time, 300) AS total_draft_time
               FROM matches LEFT JOIN draft USING (match_id)""",
            draft=DRAFT,
        ),
        "guarded_ratio": _with(
            "participants",
            """SELECT match_id, CASE WHEN d > 0 THEN CAST(k AS DOUBLE) / d ELSE CAST(k AS DOUBLE) END AS kill_death_ratio
               FROM (SELECT match_id, sum(kills) AS k, sum(deaths) AS d FROM participants GROUP BY match_id)""",
        ),
        "score_derived": _with(
            "matches",
            """SELECT match_id, abs(score_a - score_b) AS score_difference, score_a + score_b AS total_score
               FROM matches""",
        ),
        "enrich_left": _with(
            "selections matches",
            """SELECT match_id, entity_id, side, is_pick, m.yr, m.mo, m.side_a_win
               FROM selections LEFT JOIN renumbered m USING (match_id)""",
            renumbered=RENUMBERED,
        ),
        "enrich_inner": _with(
            "selections matches",
            """SELECT match_id, entity_id, side, is_pick, m.yr, m.mo, m.side_a_win
               FROM selections JOIN renumbered m USING (match_id)""",
            renumbered=RENUMBERED,
        ),
        "feature_table_outcome": OUTCOME_SQL,
        "feature_table_duration": DURATION_SQL,
        "feature_table_compact": _feature_sql(OUTCOME_COLUMNS_COMPACT, OUTCOME_STEPS, 4, _FOUR_OUTCOME),
        "feature_table_duration_compact": _feature_sql(
            DURATION_COLUMNS_COMPACT, DURATION_STEPS, 4, _FOUR_DURATION
        ),
        "topk_series": _with(
            "selections matches",
            """SELECT yr, entity_id, pick_rate, ban_rate FROM trend2
               WHERE EXISTS (SELECT 1 FROM leaders WHERE leaders.entity_id IS NOT DISTINCT FROM trend2.entity_id)""",
            **trend_steps,
            leader="SELECT entity_id FROM volatility ORDER BY pick_rate_volatility DESC NULLS LAST, entity_id LIMIT 1",
            unnamed="""SELECT * REPLACE (CASE WHEN entity_id <> (SELECT entity_id FROM leader) THEN entity_id END
                                         AS entity_id) FROM selections""",
            trend2=TREND.replace("FROM selections", "FROM unnamed").strip(),
            volatility2=VOLATILITY.replace("FROM trend", "FROM trend2").strip(),
            leaders="""SELECT entity_id FROM volatility2
                       ORDER BY pick_rate_volatility DESC NULLS LAST, entity_id NULLS FIRST LIMIT 5""",
        ),
        "rate_trend": _with("selections matches", TREND),
        "rate_trend_matched": _with(
            "selections matches", TREND.replace("LEFT JOIN matches", "JOIN renumbered").strip(), renumbered=RENUMBERED
        ),
        "rate_trend_unmatched": _with(
            "selections matches", TREND.replace("LEFT JOIN matches", "LEFT JOIN renumbered").strip(), renumbered=RENUMBERED
        ),
        "rate_volatility": _with(
            "selections matches",
            """SELECT entity_id, round(avg_pick_rate, 6) AS avg_pick_rate,
                      round(pick_rate_volatility, 6) AS pick_rate_volatility, round(avg_ban_rate, 6) AS avg_ban_rate
               FROM volatility""",
            **trend_steps,
        ),
        "top_volatile": _with(
            "selections matches",
            """SELECT entity_id, round(avg_pick_rate, 6) AS avg_pick_rate,
                      round(pick_rate_volatility, 6) AS pick_rate_volatility, round(avg_ban_rate, 6) AS avg_ban_rate
               FROM volatility ORDER BY volatility.pick_rate_volatility DESC NULLS LAST, entity_id LIMIT 10""",
            **trend_steps,
        ),
        "top_by_pick_rate": _with(
            "selections matches",
            """SELECT entity_id, round(avg_pick_rate, 6) AS avg_pick_rate,
                      round(pick_rate_volatility, 6) AS pick_rate_volatility, round(avg_ban_rate, 6) AS avg_ban_rate
               FROM volatility ORDER BY volatility.avg_pick_rate DESC NULLS LAST, entity_id LIMIT 10""",
            trend=TREND,
            volatility=VOLATILITY.replace("stddev_samp", "stddev_pop"),
        ),
        "phase_win_rate": _with(
            "selections matches",
            f"""SELECT entity_id, phase, count(*) AS games, CAST(sum(win) AS BIGINT) AS wins,
                       {_half_up("CAST(sum(win) AS DOUBLE) / count(*) * 100")} AS win_rate
                FROM (SELECT entity_id, {PHASE} AS phase, {SIDE_WIN} AS win
                      FROM selections JOIN matches USING (match_id) WHERE is_pick = 1)
                GROUP BY entity_id, phase HAVING count(*) >= 50""",
        ),
        "phase_win_rate_all": _with(
            "selections matches",
            f"""SELECT entity_id, phase, count(*) AS games, CAST(sum(win) AS BIGINT) AS wins,
                       {_half_up("CAST(sum(win) AS DOUBLE) / count(*) * 100")} AS win_rate
                FROM (SELECT entity_id, {PHASE} AS phase, {SIDE_WIN} AS win
                      FROM selections JOIN some_unknown USING (match_id)
                      WHERE is_pick = 1 AND duration IS NOT NULL)
                GROUP BY entity_id, phase""",
            some_unknown=SOME_UNKNOWN,
        ),
        "period_stats": _with("matches", period),
        "period_stats_yearly": _with(
            "matches", period.replace("yr, mo,", "yr,").replace("GROUP BY yr, mo", "GROUP BY yr")
        ),
        "bucket_win_rate": _with("matches", f"SELECT *, {bucket_rate} FROM buckets", buckets=BUCKETS),
        "bucket_win_rate_nulls_last": _with(
            "matches",
            f"SELECT *, {bucket_rate} FROM buckets",
            some_unknown=SOME_UNKNOWN,
            buckets=BUCKETS.replace("FROM matches", "FROM some_unknown"),
        ),
        "bucket_win_rate_nulls_dropped": _with(
            "matches",
            f"SELECT *, {bucket_rate} FROM buckets",
            some_unknown=SOME_UNKNOWN,
            buckets=BUCKETS.replace("FROM matches", "FROM some_unknown WHERE duration IS NOT NULL"),
        ),
        "bucket_ordered": _with(
            "matches", f"SELECT bucket_no, bucket, {bucket_rate} FROM buckets ORDER BY bucket_no", buckets=BUCKETS
        ),
        "bucket_share": _with(
            "matches",
            f"""SELECT bucket, total_matches,
                      {_half_up("CAST(total_matches AS DOUBLE) / (SELECT sum(total_matches) FROM buckets) * 100")} AS share
               FROM buckets""",
            buckets=BUCKETS,
        ),
        "objective_counts_early": _with("objectives", EARLY_OBJECTIVES),
        "objective_counts_all": _with("objectives", ALL_OBJECTIVES),
        "advantage_stats_window": _with("advantage", GOLD_WINDOW),
        "advantage_stats_xp": _with("advantage", XP_WINDOW),
        "advantage_swing": _with("advantage", SWING),
        "side_pick_counts": _with("selections", SIDE_PICKS),
        "unique_entities": _with("selections", UNIQUE),
        "participant_totals": _with("participants", TOTALS),
        "participant_averages": _with("participants", AVERAGES),
        "draft_stats": _with("draft_turns", DRAFT),
        "clash_stats_early": _with("clashes", CLASH_EARLY),
        "clash_stats_all": _with("clashes", CLASH_ALL),
        "dedupe_by_key": _with(
            "selections",
            """SELECT match_id, max(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS side_a_win
               FROM selections GROUP BY match_id""",
        ),
        "moments": _with("matches", moments),
        "moments_merged": _with(
            "matches", moments.replace("yr, mo,", "yr,").replace("GROUP BY yr, mo", "GROUP BY yr")
        ),
        "assemble_features": _with(
            _ALL,
            f"""SELECT match_id, 25 AS n_features, CAST(floor(({outcome_sum}) * 1000) AS BIGINT) AS feature_sum_thousandths
                FROM (SELECT {OUTCOME_COLUMNS} FROM base
                      {' '.join(f'LEFT JOIN s{i} USING (match_id)' for i in range(1, 8))})""",
            **OUTCOME_STEPS,
        ),
        "feature_importance": """SELECT 'random_forest' AS model, CAST(26 AS BIGINT) AS n_features,
            'total_score' AS leading, CAST(1 AS DOUBLE) AS total""",
        "outcome_labels_zero": _with(
            "participants matches",
            """SELECT match_id, max(coalesce(CAST(side_a_win AS INTEGER), 0)) AS side_a_win
               FROM participants LEFT JOIN matches USING (match_id) GROUP BY match_id""",
        ),
        "objective_counts_options": _with(
            "objectives",
            EARLY_OBJECTIVES.replace("LIKE '%AL%'", "ILIKE '%al%'").replace("count(kind)", "count(*)"),
        ),
        "period_stats_options": _with(
            "matches",
            period.replace("stddev_samp", "stddev_pop").replace("FROM matches", "FROM known WHERE yr IS NOT NULL"),
            known="SELECT * REPLACE (CASE WHEN match_id % 13 <> 0 THEN yr END AS yr) FROM matches",
        ),
        "standardize": _with(
            "matches",
            f"""SELECT match_id, round((duration - duration_m) / duration_s, 6) AS duration,
                      round((score_a - score_m) / score_s, 6) AS score_a
               FROM matches, (SELECT avg(duration) AS duration_m, stddev_samp(duration) AS duration_s,
                                     avg(score_a) AS score_m, stddev_samp(score_a) AS score_s
                              FROM matches WHERE {SPLIT})""",
        ),
        "hash_split": _with("matches", f"SELECT match_id, CASE WHEN {SPLIT} THEN 'train' ELSE 'test' END AS part FROM matches"),
        "score_test_part": _with(
            "matches", f"SELECT match_id, duration, TRUE AS is_scored FROM base WHERE NOT ({SPLIT})", base=DURATION_BASE
        ),
        "auc_metric": _with(
            "matches participants",
            f"SELECT round(auc, 8) AS auc FROM ({_auc_sql('score')})",
            base=OUTCOME_BASE,
            totals=TOTALS,
            scored=SCORED,
        ),
        "accuracy_metric": _with(
            "matches participants",
            """SELECT avg(CASE WHEN (CASE WHEN kill_score > 100 THEN 1 ELSE 0 END) = side_a_win
                               THEN 1.0 ELSE 0.0 END) AS accuracy FROM scored""",
            base=OUTCOME_BASE,
            totals=TOTALS,
            scored=SCORED,
        ),
        "regression_metrics": _with(
            "matches",
            """SELECT round(sqrt(avg(e * e)), 6) AS rmse, round(1 - avg(e * e) / var_pop(duration), 6) AS r2
               FROM (SELECT duration, CAST(40 * (score_a + score_b) AS DOUBLE) - duration AS e FROM matches)""",
        ),
        "model_leaderboard": _with(
            "matches participants",
            f"""SELECT model AS best_model, round(auc, 8) AS best_value
                FROM (SELECT 'claims' AS model, auc FROM ({_auc_sql('claim_score')})
                      UNION ALL SELECT 'gold', auc FROM ({_auc_sql('score')})
                      UNION ALL SELECT 'kills', auc FROM ({_auc_sql('kill_score')}))
                ORDER BY auc DESC, model LIMIT 1""",
            base=OUTCOME_BASE,
            totals=TOTALS,
            scored=SCORED,
        ),
    }
