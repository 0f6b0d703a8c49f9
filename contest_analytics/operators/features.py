"""Wide feature tables: one row per match, a left join per source, defaults, derived columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contest_analytics.functions import expressions as E
from contest_analytics.functions.cleaning import fill_defaults
from contest_analytics.operators import keyed
from contest_analytics.operators.enrich import join_sides
from contest_analytics.operators.keyed import KEY, Figure, Level, ObjectiveKinds, Source
from contest_analytics.sources.layouts import ContestTables

OUTCOME_LABEL = "side_a_win"
DURATION_LABEL = "duration"

VALID_DURATION = (600, 7200)


@dataclass(frozen=True)
class Derived:
    """A model input made of the columns of a filled feature table."""

    name: str
    value: Callable[[], Column]


@dataclass(frozen=True)
class Task:
    """What a model predicts and from what: base columns, sources by table, derived columns."""

    name: str
    base: tuple[str, ...]
    sources: tuple[tuple[str, Source], ...]
    derived: tuple[Derived, ...]

    def _figures(self, least: Level) -> list[Figure]:
        return [f for _, source in self.sources for f in source.figures if (f.level(self.name) or 0) >= least]

    def defaults(self) -> dict[str, float]:
        """What an absent value counts as, by column."""
        return dict.fromkeys(self.base, 0) | {f.name: f.absent for f in self._figures(Level.TABLE)}

    def inputs(self, compact: bool = False) -> tuple[str, ...]:
        """Columns of the model's vector."""
        figures = self._figures(Level.COMPACT if compact else Level.FULL)
        return (*self.base, *(f.name for f in figures), *(d.name for d in self.derived))

    def sides(self, tables: ContestTables, kinds: ObjectiveKinds, compact: bool = False) -> list[DataFrame]:
        """One row per match of each source that the model needs."""
        least, out = Level.COMPACT if compact else Level.TABLE, []
        for table, source in self.sources:
            if any((f.level(self.name) or 0) >= least for f in source.figures):
                options = (kinds,) if table == "objectives" else ()
                out.append(source.reduce(getattr(tables, table), *options, names=source.of(self.name)))
        return out


OUTCOME = Task(
    "outcome",
    base=(),
    sources=(
        ("objectives", keyed.OBJECTIVES_EARLY),
        ("gold_advantage", keyed.GOLD_EARLY),
        ("xp_advantage", keyed.XP_EARLY),
        ("selections", keyed.PICKS),
        ("participants", keyed.PLAYERS_TOTAL),
        ("draft_turns", keyed.DRAFT_TIMES),
        ("clashes", keyed.CLASHES_EARLY),
    ),
    derived=(Derived("kill_death_ratio", lambda: E.guarded_ratio(F.col("total_kills"), F.col("total_deaths"))),),
)
DURATION = Task(
    "duration",
    base=("league_id", "score_a", "score_b", "first_claim_time"),
    sources=(
        ("selections", keyed.PICKS),
        ("draft_turns", keyed.DRAFT_TIMES),
        ("objectives", keyed.OBJECTIVES_ALL),
        ("clashes", keyed.CLASHES_ALL),
        ("gold_advantage", keyed.GOLD_ALL),
        ("participants", keyed.PLAYERS_AVERAGE),
    ),
    derived=(
        Derived("score_difference", lambda: F.abs(F.col("score_a") - F.col("score_b"))),
        Derived("total_score", lambda: F.col("score_a") + F.col("score_b")),
    ),
)
OUTCOME_DEFAULTS, DURATION_DEFAULTS = OUTCOME.defaults(), DURATION.defaults()
OUTCOME_FEATURES, OUTCOME_FEATURES_COMPACT = OUTCOME.inputs(), OUTCOME.inputs(compact=True)
DURATION_FEATURES, DURATION_FEATURES_COMPACT = DURATION.inputs(), DURATION.inputs(compact=True)


def feature_table(
    base: DataFrame,
    sides: Sequence[DataFrame],
    defaults: Mapping[str, float],
    derived: Mapping[str, Column],
    key: str = KEY,
) -> DataFrame:
    """Base rows with the figures of all sides; ``base`` and the sides hold one row per key."""
    present = {c: v for c, v in defaults.items() if c in _columns(base, *sides)}
    return fill_defaults(join_sides(base, sides, key), present).withColumns(dict(derived))


def outcome_base(rows: DataFrame, null_label: str = "drop") -> DataFrame:
    """One row per match with the 0/1 outcome.

    Matches of unknown outcome are dropped, or count as 0 under ``null_label='zero'``.
    """
    flag = F.col(OUTCOME_LABEL).cast("int")
    if null_label == "zero":
        flag = F.coalesce(flag, F.lit(0))
    labels = keyed.dedupe_labels(rows.select(KEY, flag.alias(OUTCOME_LABEL)), OUTCOME_LABEL)
    return labels.dropna(subset=[OUTCOME_LABEL]) if null_label == "drop" else labels


def outcome_table(
    tables: ContestTables,
    kinds: ObjectiveKinds = ObjectiveKinds(),
    null_label: str = "drop",
    label_rows: DataFrame | None = None,
) -> DataFrame:
    """All figures known to the outcome model. Labels come from the match table by default."""
    base = outcome_base(tables.matches if label_rows is None else label_rows, null_label)
    return _table(OUTCOME, base, tables, kinds)


def outcome_table_compact(
    tables: ContestTables,
    kinds: ObjectiveKinds = ObjectiveKinds(),
    null_label: str = "drop",
    label_rows: DataFrame | None = None,
) -> DataFrame:
    """The smaller outcome table: four sources, 17 features."""
    base = outcome_base(tables.matches if label_rows is None else label_rows, null_label)
    return _table(OUTCOME, base, tables, kinds, compact=True).select(KEY, OUTCOME_LABEL, *OUTCOME_FEATURES_COMPACT)


def duration_base(matches: DataFrame) -> DataFrame:
    """One row per match of plausible length."""
    rows = matches.select(KEY, DURATION_LABEL, *DURATION.base)
    return keyed.dedupe_rows(valid_duration(rows))


def valid_duration(matches: DataFrame) -> DataFrame:
    """Rows whose duration is known and plausible."""
    return matches.where(F.col(DURATION_LABEL).between(*VALID_DURATION))


def duration_table(tables: ContestTables, kinds: ObjectiveKinds = ObjectiveKinds()) -> DataFrame:
    """All figures known to the duration model."""
    return _table(DURATION, duration_base(tables.matches), tables, kinds)


def duration_table_compact(tables: ContestTables, kinds: ObjectiveKinds = ObjectiveKinds()) -> DataFrame:
    """The smaller duration table: four sources, 21 features."""
    table = _table(DURATION, duration_base(tables.matches), tables, kinds, compact=True)
    return table.select(KEY, DURATION_LABEL, *DURATION_FEATURES_COMPACT)


def _table(task: Task, base: DataFrame, tables: ContestTables, kinds: ObjectiveKinds, compact: bool = False) -> DataFrame:
    derived = {d.name: d.value() for d in task.derived}
    return feature_table(base, task.sides(tables, kinds, compact), task.defaults(), derived)


def _columns(*frames: DataFrame) -> set[str]:
    return {c for frame in frames for c in frame.columns}
