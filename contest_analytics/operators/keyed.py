"""One row per match out of many: the building blocks of the feature tables.

Every statistic here has a partial form, so Spark combines before the shuffle and a match
that holds a large share of the rows arrives as one row per task.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass
from enum import IntEnum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contest_analytics.functions import expressions as E

KEY = "match_id"

# End of the early game in seconds, and the minutes of the advantage window.
EARLY_SECONDS = 600
ADVANTAGE_MINUTES = (5, 10)


@dataclass(frozen=True)
class ObjectiveKinds:
    """What the objective kinds are called in the data. The defaults."""

    first_claim: str = "CHAT_MESSAGE_FIRSTBLOOD"
    tower: str = "%tower%"
    courier: str = "%COURIER%"
    barracks: str = "%barracks%"


def is_early(seconds: str, until: int = EARLY_SECONDS) -> Column:
    """Whether a time in seconds lies in the early game."""
    return F.col(seconds) <= until


def in_window(minutes: tuple[int, int] = ADVANTAGE_MINUTES) -> Column:
    """Whether a minute lies in the advantage window."""
    return F.col("minute_no").between(*minutes)


def key_stats(df: DataFrame, stats: Mapping[str, Column], where: Column | None = None, key: str = KEY) -> DataFrame:
    """Named aggregates per key over the rows that pass ``where``."""
    rows = df if where is None else df.where(where)
    return rows.groupBy(key).agg(*[stat.alias(name) for name, stat in stats.items()])


def dedupe_labels(df: DataFrame, label: str, key: str = KEY) -> DataFrame:
    """One (key, label) row; of conflicting labels the larger one stays, whatever the layout."""
    return key_stats(df, {label: F.max(label)}, key=key)


def dedupe_rows(df: DataFrame, key: str = KEY) -> DataFrame:
    """One whole row per key: the largest by column order, whatever the layout."""
    rest = [c for c in df.columns if c != key]
    kept = df.groupBy(key).agg(F.max(F.struct(*rest)).alias("kept"))
    return kept.select(key, "kept.*")


class Level(IntEnum):
    """How far a figure goes: into the feature table, the full model, the compact model too."""

    TABLE = 1
    FULL = 2
    COMPACT = 3


@dataclass(frozen=True)
class Figure:
    """One figure of a match: its aggregate, what an absent one counts as, and its use by task.

    A task that is not named does not have the figure in its table.
    """

    name: str
    value: Callable[..., Column]
    absent: float = 0
    outcome: Level | None = None
    duration: Level | None = None

    def level(self, task: str) -> Level | None:
        return getattr(self, task)


@dataclass(frozen=True)
class Source:
    """A detail table and all that is made of it, as one aggregate per match.

    ``rows`` says which rows count; ``prepare`` comes before the aggregate.
    """

    figures: tuple[Figure, ...]
    rows: Callable[..., Column] | None = None
    prepare: Callable[[DataFrame], DataFrame] | None = None

    def reduce(self, df: DataFrame, *options, names: Collection[str] | None = None, rows: Column | None = None) -> DataFrame:
        """All figures, or those named; ``options`` go to the aggregates."""
        wanted = [f for f in self.figures if names is None or f.name in names]
        kept = rows if rows is not None else self.rows() if self.rows else None
        prepared = df if self.prepare is None else self.prepare(df)
        return key_stats(prepared, {f.name: f.value(*options) for f in wanted}, where=kept)

    def of(self, task: str) -> list[str]:
        return [f.name for f in self.figures if f.level(task)]


def _per_entity(selections: DataFrame) -> DataFrame:
    """Picks of both sides per (match, entity).

    Grouping by entity first makes distinct entities countable as rows and spreads a hot match
    over its entities.
    """
    return selections.where(F.col("is_pick") == 1).groupBy(KEY, "entity_id").agg(
        E.count_where(F.col("side") == 0).alias("rows_a"), E.count_where(F.col("side") == 1).alias("rows_b")
    )


def _picks(rows: str) -> Column:
    """Picks of a side; null, not 0, for a side without one, so that a default can fill it."""
    n = F.col(rows)
    return F.sum(F.when(n > 0, F.when(F.col("entity_id").isNotNull(), n).otherwise(0)))


def _entities(rows: str) -> Column:
    return F.sum(F.when(F.col(rows) > 0, F.col("entity_id").isNotNull().cast("int")))


def _kind_count(pattern: Callable[[ObjectiveKinds], str], folds: bool = True) -> Callable[..., Column]:
    """Objectives whose kind fits a pattern; ``folds``: case may be ignored on request."""

    def count(kinds: ObjectiveKinds, ignore_case: bool = False, count_unknown: bool = False) -> Column:
        return E.count_where(E.matches_pattern(F.col("kind"), pattern(kinds), ignore_case and folds))

    return count


def _any_kind(kinds: ObjectiveKinds, ignore_case: bool = False, count_unknown: bool = False) -> Column:
    return F.count(F.lit(1) if count_unknown else F.col("kind"))


# Every source once: its figures with aggregate, default and use. The defaults, and
# which figures the full and the compact models take.
OBJECTIVES_EARLY = Source(
    (
        Figure("first_claim_count", lambda kinds, *_: E.count_where(F.col("kind") == kinds.first_claim), outcome=Level.COMPACT),
        Figure("early_towers", _kind_count(lambda kinds: kinds.tower), outcome=Level.COMPACT),
        Figure("early_couriers", _kind_count(lambda kinds: kinds.courier, folds=False), outcome=Level.COMPACT),
        Figure("early_objectives", _any_kind, outcome=Level.COMPACT),
    ),
    rows=lambda: is_early("time_s"),
)
OBJECTIVES_ALL = Source(
    (
        Figure("total_objectives", lambda *_: F.count(F.lit(1)), duration=Level.COMPACT),
        Figure("total_towers", _kind_count(lambda kinds: kinds.tower), duration=Level.COMPACT),
        Figure("total_barracks", _kind_count(lambda kinds: kinds.barracks), duration=Level.COMPACT),
    )
)
GOLD_EARLY = Source(
    (
        Figure("avg_gold_window", lambda: F.avg("gold"), outcome=Level.COMPACT),
        Figure("max_gold_window", lambda: F.max("gold"), outcome=Level.COMPACT),
        Figure("min_gold_window", lambda: F.min("gold"), outcome=Level.COMPACT),
        Figure("gold_volatility", lambda: F.stddev_samp("gold"), outcome=Level.FULL),
    ),
    rows=lambda: in_window(),
)
XP_EARLY = Source(
    (
        Figure("avg_xp_window", lambda: F.avg("xp"), outcome=Level.COMPACT),
        Figure("max_xp_window", lambda: F.max("xp"), outcome=Level.COMPACT),
    ),
    rows=lambda: in_window(),
)
GOLD_ALL = Source(
    (
        Figure("max_gold_lead", lambda: F.max("gold"), duration=Level.COMPACT),
        Figure("min_gold_lead", lambda: F.min("gold"), duration=Level.COMPACT),
        Figure("gold_swing_std", lambda: F.stddev_samp("gold"), duration=Level.FULL),
    )
)
PICKS = Source(
    (
        Figure("side_a_picks", lambda: _picks("rows_a"), 5, outcome=Level.FULL, duration=Level.FULL),
        Figure("side_a_entities", lambda: _entities("rows_a"), 5, outcome=Level.TABLE),
        Figure("side_b_picks", lambda: _picks("rows_b"), 5, outcome=Level.FULL, duration=Level.FULL),
        Figure("side_b_entities", lambda: _entities("rows_b"), 5, outcome=Level.TABLE),
        Figure("unique_entities", lambda: F.count("entity_id"), 10, duration=Level.FULL),
    ),
    prepare=_per_entity,
)
PLAYERS_TOTAL = Source(
    (
        Figure("first_claim_total", lambda: F.sum(F.when(F.col("first_claim") > 0, 1).otherwise(0)), outcome=Level.COMPACT),
        Figure("avg_gold_rate_all", lambda: F.avg("gold_rate"), 400, outcome=Level.COMPACT),
        Figure("avg_xp_rate_all", lambda: F.avg("xp_rate"), 500, outcome=Level.COMPACT),
        Figure("max_damage", lambda: F.max("damage"), outcome=Level.COMPACT),
        Figure("total_kills", lambda: F.sum("kills"), outcome=Level.COMPACT),
        Figure("total_deaths", lambda: F.sum("deaths"), outcome=Level.COMPACT),
        Figure("total_assists", lambda: F.sum("assists"), outcome=Level.COMPACT),
    )
)
PLAYERS_AVERAGE = Source(
    (
        Figure("avg_kills", lambda: F.avg("kills"), duration=Level.COMPACT),
        Figure("avg_deaths", lambda: F.avg("deaths"), duration=Level.COMPACT),
        Figure("avg_assists", lambda: F.avg("assists"), duration=Level.COMPACT),
        Figure("avg_gold_rate", lambda: F.avg("gold_rate"), 400, duration=Level.COMPACT),
        Figure("avg_xp_rate", lambda: F.avg("xp_rate"), 500, duration=Level.COMPACT),
        Figure("avg_damage", lambda: F.avg("damage"), duration=Level.COMPACT),
        Figure("total_tower_damage", lambda: F.sum("tower_damage"), duration=Level.COMPACT),
    )
)
DRAFT_TIMES = Source(
    (
        Figure("avg_draft_time", lambda: F.avg("time_taken"), 30, outcome=Level.FULL, duration=Level.FULL),
        Figure("max_draft_time", lambda: F.max("time_taken"), 30, outcome=Level.FULL),
        Figure("total_draft_time", lambda: F.sum("time_taken"), 300, outcome=Level.FULL),
    )
)
CLASHES_EARLY = Source(
    (
        Figure("early_clashes", lambda: F.count(F.lit(1)), outcome=Level.FULL),
        Figure("avg_clash_deaths", lambda: F.avg("deaths"), outcome=Level.FULL),
    ),
    rows=lambda: is_early("start_s"),
)
CLASHES_ALL = Source(
    (
        Figure("total_clashes", lambda: F.count(F.lit(1)), duration=Level.COMPACT),
        Figure("avg_deaths_per_clash", lambda: F.avg("deaths"), duration=Level.COMPACT),
        Figure("total_clash_deaths", lambda: F.sum("deaths"), duration=Level.COMPACT),
    )
)


def objective_counts_early(
    objectives: DataFrame,
    kinds: ObjectiveKinds = ObjectiveKinds(),
    until: int = EARLY_SECONDS,
    ignore_case: bool = False,
    count_unknown: bool = False,
) -> DataFrame:
    """Objectives of the early game; those of unknown kind count on request only."""
    return OBJECTIVES_EARLY.reduce(objectives, kinds, ignore_case, count_unknown, rows=is_early("time_s", until))


def objective_counts_all(
    objectives: DataFrame, kinds: ObjectiveKinds = ObjectiveKinds(), ignore_case: bool = False
) -> DataFrame:
    return OBJECTIVES_ALL.reduce(objectives, kinds, ignore_case)


def gold_window(advantage: DataFrame, minutes: tuple[int, int] = ADVANTAGE_MINUTES) -> DataFrame:
    return GOLD_EARLY.reduce(advantage, rows=in_window(minutes))


def xp_window(advantage: DataFrame, minutes: tuple[int, int] = ADVANTAGE_MINUTES) -> DataFrame:
    return XP_EARLY.reduce(advantage, rows=in_window(minutes))


def gold_swing(advantage: DataFrame) -> DataFrame:
    return GOLD_ALL.reduce(advantage)


def pick_profile(selections: DataFrame) -> DataFrame:
    """Picks and distinct entities of both sides and of the match, in one scan."""
    return PICKS.reduce(selections)


def side_pick_counts(selections: DataFrame) -> DataFrame:
    return pick_profile(selections.where(F.col("side").isin(0, 1))).drop("unique_entities")


def unique_entities(selections: DataFrame) -> DataFrame:
    return PICKS.reduce(selections, names=["unique_entities"])


def participant_totals(participants: DataFrame) -> DataFrame:
    return PLAYERS_TOTAL.reduce(participants)


def participant_averages(participants: DataFrame, missing_as_zero: bool = False) -> DataFrame:
    """Averages of the players' figures; a missing one is left out, or counts as 0 on request."""
    if missing_as_zero:
        participants = participants.fillna(0, subset=[c for c in participants.columns if c != KEY])
    return PLAYERS_AVERAGE.reduce(participants)


def draft_stats(draft_turns: DataFrame) -> DataFrame:
    return DRAFT_TIMES.reduce(draft_turns)


def clash_stats_early(clashes: DataFrame, until: int = EARLY_SECONDS) -> DataFrame:
    return CLASHES_EARLY.reduce(clashes, rows=is_early("start_s", until))


def clash_stats_all(clashes: DataFrame) -> DataFrame:
    return CLASHES_ALL.reduce(clashes)
