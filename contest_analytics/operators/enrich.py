"""Joins of detail rows with their parent records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich(detail: DataFrame, parent: DataFrame, key: str, columns: Sequence[str], how: str = "left") -> DataFrame:
    """Add parent columns to detail rows; the parent has one row per key.

    A key that holds a large share of the detail rows is split at run time by the
    adaptive skew join: the detail side is the one it may split under both 'left' and 'inner'.
    """
    return detail.join(parent.select(key, *columns), key, how)


def join_sides(base: DataFrame, sides: Sequence[DataFrame], key: str) -> DataFrame:
    """Left-join sides that hold one row per key.

    Each side comes from a grouping on the key, so it is already distributed by the key
    and no join adds a shuffle.
    """
    table = base
    for side in sides:
        table = table.join(side, key, "left")
    return table


def keep_members(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in ``members``; a null key is a key like others."""
    keys = members.select(F.col(key).alias("_member"))
    return df.join(keys, F.col(key).eqNullSafe(F.col("_member")), "left_semi")
