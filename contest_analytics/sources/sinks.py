"""Result writers. All go through the Hadoop file system layer, so any URI works."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructType

from contest_analytics.session import cut_lineage
from contest_analytics.sources import files
from contest_analytics.sources.tables import literal_table

COMMIT_FILE = "_results.json"


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> int:
    """Write one result and return the number of records written, whatever was there before.

    The rows are staged first: their number then comes from column footers, also for text formats,
    and the query behind them runs once.
    """
    rows = cut_lineage(df)
    rows.write.mode(mode).format(fmt).options(**_options(fmt)).save(path)
    return rows.count()


def read_result(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """A written result; its known schema saves the inference pass.

    A CSV with a text column is read as records that may span lines, which a file's reader does
    in one task; results of numbers stay splittable.
    """
    options = _options(fmt)
    if fmt == "csv" and any(isinstance(f.dataType, StringType) for f in schema.fields):
        options["multiLine"] = "true"
    return spark.read.schema(schema).format(fmt).options(**options).load(path)


def _options(fmt: str) -> dict[str, str]:
    return {"header": "true", "escape": '"'} if fmt == "csv" else {}


def save_results(
    results: Mapping[str, Mapping[str, DataFrame]],
    base_path: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
) -> dict[str, int]:
    """Write every result below ``{base_path}/{category}_{name}``; returns the counts."""
    return {
        f"{category}_{name}": write_table(df, f"{base_path}/{category}_{name}", fmt, mode)
        for category, named in results.items()
        for name, df in named.items()
    }


def commit_results(
    results: Mapping[str, Mapping[str, DataFrame]],
    base_path: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    summaries: Mapping[str, DataFrame] | None = None,
) -> dict[str, int]:
    """Write a set of results that is complete or absent; returns the counts of the records.

    All results are written below a draft folder first, so a query that fails leaves an earlier set as it
    was. Then they get their names, ``{base_path}/{category}_{name}``, and a file that lists them is
    written last: it is taken away before and stands for a complete set. ``summaries`` are one-file
    results (see ``write_summary``). ``mode`` is 'errorifexists' or 'overwrite'; results that only an
    earlier set had are deleted with it.
    """
    first = next(iter([*(df for named in results.values() for df in named.values()), *(summaries or {}).values()]))
    spark = first.sparkSession
    names = [f"{category}_{name}" for category, named in results.items() for name in named] + list(summaries or {})
    earlier = files.read_json(spark, f"{base_path}/{COMMIT_FILE}") or {"counts": {}, "summaries": []}
    old = [n for n in {*names, *earlier["counts"], *earlier["summaries"]} if files.exists(spark, f"{base_path}/{n}")]
    if mode == "errorifexists" and old:
        raise FileExistsError(f"already exists in {base_path}: {', '.join(sorted(old))}")
    if mode not in ("errorifexists", "overwrite"):
        raise ValueError("a set is written new or as a whole")
    draft = f"{base_path}/.draft-{uuid.uuid4().hex}"
    try:
        counts = save_results(results, draft, fmt)
        for name, df in (summaries or {}).items():
            write_summary(df, f"{draft}/{name}")
        files.delete(spark, f"{base_path}/{COMMIT_FILE}")
        for name in old:
            files.delete(spark, f"{base_path}/{name}")
        for name in names:
            files.rename(spark, f"{draft}/{name}", f"{base_path}/{name}")
        written = {"counts": counts, "summaries": list(summaries or {}), "format": fmt}
        files.write_json(spark, f"{base_path}/{COMMIT_FILE}", written)
    finally:
        files.delete(spark, draft)
    return counts


def committed(spark: SparkSession, base_path: str) -> dict[str, int]:
    """The results of a complete set with their counts; an error where no set was completed."""
    found = files.read_json(spark, f"{base_path}/{COMMIT_FILE}")
    if found is None:
        raise FileNotFoundError(f"no complete set of results in {base_path}")
    return found["counts"]


def manifest(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    """The counts of a set of results as a table."""
    return literal_table(spark, list(counts.items()), {"result": "string", "n_records": "bigint"})


def write_summary(df: DataFrame, path: str, fmt: str = "json", mode: str = "errorifexists") -> None:
    """Write a global aggregate, or one row for each of a fixed set of groups, as one part file.

    Only for results that are this small by how they are made; all others go through
    ``write_table``. The rows are shuffled to the writing task, so the work before keeps its
    parallelism.
    """
    df.repartition(1).write.mode(mode).format(fmt).options(**_options(fmt)).save(path)
