"""Kept partial results: a run adds its part to what earlier runs left, without reading their rows.

The state is a table of mergeable aggregates (counts, sums, moments), one row per group. Every version has
a folder of its own and becomes the state by a commit file with the next number, which only one writer
can create; a run that fails before leaves the state as it was. The commit names the parts that the
version holds, so a part that is added again after a failure is not counted twice.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from contest_analytics.operators import trends
from contest_analytics.sources import files

Merge = Callable[[DataFrame], DataFrame]


def merged_moments(keys: Sequence[str]) -> Merge:
    """How the partial results of ``trends.moments`` are added up."""
    return lambda parts: trends.merge_moments(parts, keys)


def merged_sums(keys: Sequence[str]) -> Merge:
    """How counts and sums are added up."""
    return lambda parts: parts.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in parts.columns if c not in keys))


@dataclass(frozen=True)
class KeptState:
    """A state in a folder, and how two of its tables become one."""

    spark: SparkSession
    folder: str
    merge: Merge

    def version(self) -> int:
        """The number of the last commit; 0 before the first."""
        found = [int(n[:-5]) for n in files.names(self.spark, f"{self.folder}/commits") if n[0].isdigit()]
        return max(found, default=0)

    def _commit(self, version: int) -> dict | None:
        return files.read_json(self.spark, f"{self.folder}/commits/{version:09d}.json")

    def parts(self) -> list[str]:
        """Names of the parts that the state holds."""
        commit = self._commit(self.version())
        return [] if commit is None else commit["parts"]

    def read(self, version: int | None = None) -> DataFrame | None:
        """The state, or an earlier version of it that ``tidy`` left; None before the first commit."""
        commit = self._commit(self.version() if version is None else version)
        if commit is None:
            return None
        return self.spark.read.schema(StructType.fromJson(commit["schema"])).parquet(commit["path"])

    def add(self, part: DataFrame, name: str) -> bool:
        """Merge a part and commit; False, and nothing done, if a part of this name is in the state.

        Of two runs that add at the same time one fails, and may be repeated.
        """
        version = self.version()
        before = self._commit(version)
        if before is not None and name in before["parts"]:
            return False
        kept = self.read(version)
        # A first part is merged with nothing, so that every version has the merged types.
        rows = self.merge(part if kept is None else kept.unionByName(part.select(*kept.columns)))
        path = f"{self.folder}/versions/{version + 1:09d}-{uuid.uuid4().hex}"
        rows.write.parquet(path)
        known = [] if before is None else before["parts"]
        commit = {"path": path, "parts": [*known, name], "schema": rows.schema.jsonValue()}
        try:
            files.write_json(self.spark, f"{self.folder}/commits/{version + 1:09d}.json", commit)
        except FileExistsError:
            files.delete(self.spark, path)
            raise
        return True

    def tidy(self, keep: int = 2) -> None:
        """Delete all but the last versions, and what failed runs left; not while another run adds."""
        last = self.version()
        live = {self._commit(v)["path"].rsplit("/", 1)[1] for v in range(max(1, last - keep + 1), last + 1)}
        for name in files.names(self.spark, f"{self.folder}/versions"):
            if name not in live:
                files.delete(self.spark, f"{self.folder}/versions/{name}")
        for version in range(1, last - keep + 1):
            files.delete(self.spark, f"{self.folder}/commits/{version:09d}.json")
