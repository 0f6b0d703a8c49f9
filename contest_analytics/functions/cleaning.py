"""Typing, normalizing and null handling of raw columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted spellings of flags and the names a time column may have.
TRUE_WORDS = ("1", "true", "t", "yes", "y")
FALSE_WORDS = ("0", "false", "f", "no", "n")
TIME_COLUMNS = ("start_date_time", "start_time", "start_time_utc", "match_start_time")

INTEGERS = ("tinyint", "smallint", "int", "integer", "bigint", "long")
# The spellings of one source that takes fewer.
NARROW_TRUE, NARROW_FALSE = ("1", "true", "True"), ("0", "false", "False")

_WHITESPACE = " \t\n\r\f\v"


def coerce(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns in one projection; text that does not parse becomes null."""
    return df.select(*[lenient_cast(c, types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def lenient_cast(column: Column | str, kind: str) -> Column:
    """The value as ``kind``, or null. Whole numbers may be written with a decimal point.

    A decimal keeps the digits of a 64-bit key; what follows the point is cut off.
    """
    value = _as_column(column)
    plain = value.try_cast(kind)
    if kind not in INTEGERS:
        return plain
    return F.coalesce(plain, value.cast("string").try_cast("decimal(38,10)").try_cast(kind))


def bool_normalize(
    column: Column | str,
    true_words: Sequence[str] = TRUE_WORDS,
    false_words: Sequence[str] = FALSE_WORDS,
    otherwise: bool | None = None,
    fold: bool = True,
) -> Column:
    """Map spellings to true/false, anything else to ``otherwise``.

    ``fold`` trims white space and ignores case; without it the spellings must match exactly.
    """
    text = _as_column(column).cast("string")
    if fold:
        text = F.lower(F.btrim(text, F.lit(_WHITESPACE)))
    return (
        F.when(text.isin(*true_words), F.lit(True))
        .when(text.isin(*false_words), F.lit(False))
        .otherwise(F.lit(otherwise).cast("boolean"))
    )


def flag_normalize(column: Column | str, true_words: Sequence[str] = TRUE_WORDS, fold: bool = True) -> Column:
    """1 for a true spelling, 0 for everything else, null included."""
    return bool_normalize(column, true_words, (), otherwise=False, fold=fold).cast("int")


def time_parts(
    df: DataFrame,
    candidates: Sequence[str] = TIME_COLUMNS,
    year_name: str = "yr",
    month_name: str = "mo",
) -> DataFrame:
    """Add year and month of the first candidate column that exists; nulls when none does."""
    present = next((c for c in candidates if c in df.columns), None)
    if present is None:
        missing = F.lit(None).cast("int")
        return df.withColumns({year_name: missing, month_name: missing})
    moment = F.try_to_timestamp(F.col(present)) if dict(df.dtypes)[present] == "string" else F.col(present)
    return df.withColumns({year_name: F.year(moment), month_name: F.month(moment)})


def drop_null_keys(df: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Remove rows in which any of the keys is null."""
    return df.dropna(subset=[keys] if isinstance(keys, str) else list(keys))


def fill_defaults(df: DataFrame, defaults: Mapping[str, float]) -> DataFrame:
    """Replace nulls per column."""
    return df.fillna(dict(defaults))


def _as_column(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column
