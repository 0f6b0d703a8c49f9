"""Canonical tables, and how to load them from a folder of match CSV files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contest_analytics.functions import cleaning
from contest_analytics.sources.tables import scan_csv_strings


@dataclass(frozen=True)
class ContestTables:
    """One frame per input table, with canonical column names; None for tables not loaded.

    ``matches``        match_id, yr, mo, duration, side_a_win, score_a, score_b, league_id, first_claim_time
    ``selections``     match_id, entity_id, side (0/1), is_pick (0/1)
    ``participants``   match_id, [side_a_win,] first_claim, gold_rate, xp_rate, damage, tower_damage,
                       kills, deaths, assists
    ``objectives``     match_id, time_s, kind
    ``gold_advantage`` match_id, minute_no, gold
    ``xp_advantage``   match_id, minute_no, xp
    ``clashes``        match_id, start_s, deaths
    ``draft_turns``    match_id, time_taken
    """

    matches: DataFrame | None = None
    selections: DataFrame | None = None
    participants: DataFrame | None = None
    objectives: DataFrame | None = None
    gold_advantage: DataFrame | None = None
    xp_advantage: DataFrame | None = None
    clashes: DataFrame | None = None
    draft_turns: DataFrame | None = None

    def named(self) -> dict[str, DataFrame]:
        """The loaded tables."""
        found = {f.name: getattr(self, f.name) for f in fields(self)}
        return {name: df for name, df in found.items() if df is not None}


# File names, and per canonical column the column of the file and its type.
MATCH_FILES = {
    "matches": (
        "main_metadata.csv",
        {
            "match_id": ("match_id", "bigint"),
            "duration": ("duration", "int"),
            "side_a_win": ("radiant_win", "flag"),
            "score_a": ("radiant_score", "int"),
            "score_b": ("dire_score", "int"),
            "league_id": ("leagueid", "int"),
            "first_claim_time": ("first_blood_time", "int"),
        },
    ),
    "selections": (
        "picks_bans.csv",
        {
            "match_id": ("match_id", "bigint"),
            "entity_id": ("hero_id", "int"),
            "side": ("team", "int"),
            "is_pick": ("is_pick", "flag01"),
        },
    ),
    "participants": (
        "players.csv",
        {
            "match_id": ("match_id", "bigint"),
            "side_a_win": ("radiant_win", "flag"),
            "first_claim": ("firstblood_claimed", "double"),
            "gold_rate": ("gold_per_min", "double"),
            "xp_rate": ("xp_per_min", "double"),
            "damage": ("hero_damage", "double"),
            "tower_damage": ("tower_damage", "double"),
            "kills": ("kills", "double"),
            "deaths": ("deaths", "double"),
            "assists": ("assists", "double"),
        },
    ),
    "objectives": (
        "objectives.csv",
        {
            "match_id": ("match_id", "bigint"),
            "time_s": ("time", "double"),
            "kind": ("type", "string"),
        },
    ),
    "gold_advantage": (
        "radiant_gold_adv.csv",
        {
            "match_id": ("match_id", "bigint"),
            "minute_no": ("minute", "double"),
            "gold": ("gold", "double"),
        },
    ),
    "xp_advantage": (
        "radiant_exp_adv.csv",
        {
            "match_id": ("match_id", "bigint"),
            "minute_no": ("minute", "double"),
            "xp": ("exp", "double"),
        },
    ),
    "clashes": (
        "teamfights.csv",
        {
            "match_id": ("match_id", "bigint"),
            "start_s": ("start", "double"),
            "deaths": ("deaths", "double"),
        },
    ),
    "draft_turns": (
        "draft_timings.csv",
        {
            "match_id": ("match_id", "bigint"),
            "time_taken": ("total_time_taken", "double"),
        },
    ),
}


def load_match_files(
    spark: SparkSession,
    folder: str,
    names: Sequence[str] = tuple(MATCH_FILES),
    reject_null_keys: bool = False,
    only: Mapping[str, Sequence[str]] | None = None,
) -> ContestTables:
    """The named canonical tables from one folder of CSV files.

    ``only`` restricts a table to some of its columns, for files that lack the others.
    """
    chosen = only or {}
    return ContestTables(
        **{n: load_match_file(spark, folder, n, reject_null_keys, chosen.get(n)) for n in names}
    )


def load_match_file(
    spark: SparkSession,
    folder: str,
    name: str,
    reject_null_keys: bool = False,
    only: Sequence[str] | None = None,
) -> DataFrame:
    """One canonical table from its CSV file, typed leniently in the same projection.

    ``reject_null_keys`` drops rows without a match key, and selections without an entity.
    """
    file_name, columns = MATCH_FILES[name]
    raw = scan_csv_strings(spark, f"{folder.rstrip('/')}/{file_name}")
    extra = []
    if name == "matches":
        raw = cleaning.time_parts(raw)
        extra = ["yr", "mo"]
    wanted = columns if only is None else {c: columns[c] for c in only}
    typed = raw.select(*[_typed(source, kind).alias(c) for c, (source, kind) in wanted.items()], *extra)
    if reject_null_keys:
        keys = [c for c in ("match_id", "entity_id") if c in typed.columns]
        typed = cleaning.drop_null_keys(typed, keys)
    return typed


def _typed(source: str, kind: str) -> Column:
    if kind == "flag":
        return cleaning.bool_normalize(source)
    if kind == "flag01":
        return cleaning.flag_normalize(source)
    return cleaning.lenient_cast(source, kind)
