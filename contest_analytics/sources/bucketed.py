"""A layout of the canonical tables for repeated runs: bucketed and sorted by match key.

Feature tables group every source by the match and join the results by it. Over plain files each run
shuffles all detail rows for that; here they are written once in buckets of the key, and a run reads
bucket by bucket without a shuffle. The layout lives in one folder: a sub-folder per table and, written
last, a file that names tables, columns and buckets. A later session attaches it from there, so no
metastore has to keep it.

A bucket holds all rows of its matches. Rows are dealt to the writing tasks by key and a salt, so a match
with a large share of the rows is written by ``spread`` tasks as several files of its bucket. It is read
by one task, which adds its rows up as they pass and holds one row per match.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from contest_analytics.operators.keyed import KEY
from contest_analytics.sources import files
from contest_analytics.sources.layouts import ContestTables, load_match_files

LAYOUT_FILE = "_layout.json"


def write_layout(tables: ContestTables, folder: str, buckets: int | None = None, spread: int = 4) -> None:
    """Write the loaded tables to a new folder; without its last file a folder is no layout.

    ``buckets`` defaults to the session's shuffle partitions. Choose it for the largest table, so that a
    bucket of it is as large as a shuffle partition should be: all tables get the same number.
    """
    named = tables.named()
    spark = next(iter(named.values())).sparkSession
    if files.exists(spark, f"{folder}/{LAYOUT_FILE}"):
        raise FileExistsError(folder)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = {}
    for name, df in named.items():
        salt = F.pmod(F.xxhash64(*(F.col(c) for c in df.columns)), F.lit(spread))
        dealt = df.withColumn("_bucket", F.pmod(F.hash(KEY), F.lit(buckets))).withColumn("_salt", salt)
        dealt = dealt.repartition(buckets * spread, "_bucket", "_salt").drop("_bucket", "_salt")
        alias = _alias(uuid.uuid4().hex)
        writer = dealt.write.format("parquet").bucketBy(buckets, KEY).sortBy(KEY)
        try:
            writer.option("path", f"{folder}/{name}").saveAsTable(alias)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {alias}")  # the files stay: the table is external
        known[name] = df.schema.json()
    files.write_json(spark, f"{folder}/{LAYOUT_FILE}", {"buckets": buckets, "key": KEY, "tables": known})


def is_layout(spark: SparkSession, folder: str) -> bool:
    return files.exists(spark, f"{folder}/{LAYOUT_FILE}")


def load_layout(spark: SparkSession, folder: str) -> ContestTables:
    """The tables of a written layout, read by bucket."""
    layout = files.read_json(spark, f"{folder}/{LAYOUT_FILE}")
    if layout is None:
        raise FileNotFoundError(f"no layout in {folder}")
    names = {f.name for f in fields(ContestTables)} & set(layout["tables"])
    return ContestTables(**{n: _attach(spark, folder, n, layout) for n in sorted(names)})


def load_tables(spark: SparkSession, folder: str, needed: Mapping[str, Sequence[str]] | Sequence[str]) -> ContestTables:
    """The needed tables of a folder, which holds a layout or the match files.

    ``needed`` names tables, or tables with the columns that files have to hold.
    """
    if not is_layout(spark, folder):
        only = needed if isinstance(needed, Mapping) else None
        return load_match_files(spark, folder, tuple(needed), only=only)
    found = load_layout(spark, folder).named()
    if missing := set(needed) - set(found):
        raise FileNotFoundError(f"the layout in {folder} lacks {', '.join(sorted(missing))}")
    return ContestTables(**{name: found[name] for name in needed})


def detach_layout(spark: SparkSession, folder: str) -> None:
    """Take a layout's tables out of the session's catalog; the files stay."""
    for field in fields(ContestTables):
        spark.sql(f"DROP TABLE IF EXISTS {_alias(_place(folder, field.name))}")


def _place(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}"


def _attach(spark: SparkSession, folder: str, name: str, layout: dict) -> DataFrame:
    """The catalog needs a table to know the buckets; it holds no data of its own."""
    path = _place(folder, name)
    alias = _alias(path)
    schema = StructType.fromJson(json.loads(layout["tables"][name]))
    if not spark.catalog.tableExists(alias):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        by = f"CLUSTERED BY ({layout['key']}) SORTED BY ({layout['key']}) INTO {layout['buckets']} BUCKETS"
        spark.sql(f"CREATE TABLE {alias} ({columns}) USING parquet {by} LOCATION '{path}'")
    return spark.table(alias)


def _alias(path: str) -> str:
    return f"contest_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"
