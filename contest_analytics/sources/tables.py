"""Table scans and row counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contest_analytics.functions.cleaning import lenient_cast
from contest_analytics.session import scratch_scope


def scan_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header row and one record per line; every column is text.

    No inference pass: Spark reads the header only, and the files stay splittable.
    """
    return spark.read.option("header", True).option("multiLine", False).csv(path)


def scan_csv_typed(spark: SparkSession, path: str, types: Mapping[str, str]) -> DataFrame:
    """The named columns of a CSV, typed.

    A reader schema would bind columns by position, so the columns are picked by header
    name and cast; the parser then reads those columns only, in one pass.
    """
    raw = scan_csv_strings(spark, path)
    return raw.select(*[lenient_cast(c, t).alias(c) for c, t in types.items()])


# From narrow to wide: a column gets the first type that fits its values.
TYPE_LADDER = ("bigint", "double", "boolean", "timestamp")

# A cast that fails costs an exception, a pattern far less. A text outside the form of a type is never
# read as it, so it is not tried; what has the form is left to the cast.
_AROUND = r"[^0-9A-Za-z.]*"  # signs, blanks and control characters
_NUMBER = r"([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[dDfF]?"
_FORMS = {
    "bigint": rf"^{_AROUND}[0-9]+{_AROUND}$",
    "double": rf"^{_AROUND}({_NUMBER}|0[xX].*|(?i:inf|infinity|nan)){_AROUND}$",
    "boolean": rf"^{_AROUND}(?i:t|true|y|yes|1|f|false|n|no|0){_AROUND}$",
}


def _read(value: Column, kind: str) -> Column:
    """The text as a type; null where it is not of it."""
    tried = value.try_cast(kind)
    return F.when(value.rlike(_FORMS[kind]), tried) if kind in _FORMS else tried


def type_profile(texts: DataFrame, max_malformed: float = 0.0, ladder: Sequence[str] = TYPE_LADDER) -> DataFrame:
    """One row per text column: its type, and how many values it has, lacks and cannot be read as it.

    One aggregate tries all types on all columns in a single pass. The type is the first of the ladder
    that reads all values but a share of ``max_malformed``, or string; a column without values is a
    string. Blanks around a value do not count, and a blank text is no value.
    """
    columns = texts.columns
    value = {c: F.nullif(F.trim(F.col(f"`{c}`")), F.lit("")) for c in columns}
    tried = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(value[c]).alias("n_values"),
            F.count_if(value[c].isNull()).alias("n_missing"),
            F.array(*(F.count(_read(value[c], t)) for t in ladder)).alias("read"),
        )
        for c in columns
    ]
    rows = texts.agg(F.array(*tried).alias("columns")).select(F.inline("columns"))
    enough = F.col("n_values") * (1 - max_malformed)
    fits = [(F.col("n_values") > 0) & (F.get("read", F.lit(i)) >= enough) for i in range(len(ladder))]
    chosen = F.coalesce(*(F.when(fit, F.lit(t)) for fit, t in zip(fits, ladder)), F.lit("string"))
    read = F.coalesce(*(F.when(fit, F.get("read", F.lit(i))) for i, fit in enumerate(fits)), F.col("n_values"))
    return rows.select(
        "column_name", chosen.alias("type"), "n_values", "n_missing", (F.col("n_values") - read).alias("n_malformed")
    )


def typed_by_profile(texts: DataFrame, profile: DataFrame) -> DataFrame:
    """The text columns cast to the types of their profile, in one projection; malformed values become null."""
    types = {row.column_name: row.type for row in profile.collect()}  # a row per column

    def cast(c: str) -> Column:
        text = F.col(f"`{c}`")
        return text if types[c] == "string" else _read(F.nullif(F.trim(text), F.lit("")), types[c])

    return texts.select(*(cast(c).alias(c) for c in texts.columns))


def scan_csv_profiled(spark: SparkSession, path: str, max_malformed: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """CSV with types found in the data, and the profile behind them.

    The profile is one aggregate over the files; the typed rows are one scan with a projection.
    """
    texts = scan_csv_strings(spark, path)
    with scratch_scope(spark) as scope:
        profile = scope.keep(type_profile(texts, max_malformed))
    return typed_by_profile(texts, profile), profile


def scan_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with types guessed by the reader, which costs one more pass over the files."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def literal_table(spark: SparkSession, rows: Sequence[tuple], types: Mapping[str, str]) -> DataFrame:
    """A few driver-side values as a table; it stays in the JVM, without Python workers."""
    structs = [
        F.struct(*[F.lit(v).cast(t).alias(name) for v, (name, t) in zip(row, types.items())]) for row in rows
    ]
    if not structs:
        return spark.range(0).select(*[F.lit(None).cast(t).alias(name) for name, t in types.items()])
    return spark.range(1).select(F.inline(F.array(*structs)))
