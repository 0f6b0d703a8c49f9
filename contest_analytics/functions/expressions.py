"""Derived-column expressions; all are compositions of built-ins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket edges in seconds, and the labels reports show for them.
PHASE_EDGES = (1800, 2700)
PHASE_LABELS = ("Early (<30min)", "Mid (30-45min)", "Late (>45min)")
DURATION_EDGES = (1200, 1800, 2400, 3000)
DURATION_LABELS = ("0-20min", "20-30min", "30-40min", "40-50min", "50min+")


def bucketize(value: Column, edges: Sequence[float], labels: Sequence, null_bucket: str = "last") -> Column:
    """Label of the half-open bucket ``value`` falls in.

    A null value goes to the last bucket, or stays null under ``null_bucket='drop'`` so
    that the caller can remove it.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("one label more than edges is needed")
    if null_bucket not in ("last", "drop"):
        raise ValueError("null_bucket is 'last' or 'drop'")
    last = F.lit(labels[-1])
    if null_bucket == "drop":
        last = F.when(value.isNotNull(), last)
    steps = reversed(list(zip(edges, labels)))
    return reduce(lambda rest, step: F.when(value < step[0], F.lit(step[1])).otherwise(rest), steps, last)


def bucket_number(value: Column, edges: Sequence[float], null_bucket: str = "last") -> Column:
    """Position of the bucket from 1 up; sorts buckets where labels would sort wrongly."""
    return bucketize(value, edges, range(1, len(edges) + 2), null_bucket)


def complement(flag: Column) -> Column:
    return F.lit(1) - flag


def side_win(side: Column, first_side_won: Column) -> Column:
    """1 when the row's side (0 or 1) won; an unknown outcome counts as no win."""
    won = ((side == 0) & first_side_won) | ((side == 1) & ~first_side_won)
    return F.when(won, 1).otherwise(0)


def percent_rate(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` in percent of ``whole``, 0 for an empty whole."""
    return F.when(whole > 0, F.round(part / whole * 100, digits)).otherwise(F.lit(0.0))


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, or the numerator itself when the denominator is not positive."""
    top = numerator.cast("double")
    return F.when(denominator > 0, top / denominator).otherwise(top)


def to_minutes(seconds: Column, digits: int = 2) -> Column:
    return F.round(seconds / 60, digits)


def matches_pattern(text: Column, pattern: str, ignore_case: bool = False) -> Column:
    return text.ilike(pattern) if ignore_case else text.like(pattern)


def count_where(condition: Column) -> Column:
    """Number of rows for which the condition holds; unknown does not count."""
    return F.count(F.when(condition, 1))
