"""Session helpers: a local session for tests, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps
from weakref import WeakKeyDictionary

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCAL_SCRATCH: dict[str, str] = {}


def local_session(cores: int | str = 8, memory: str = "12g", app: str = "contest_analytics") -> SparkSession:
    """Single-JVM session for tests and the benchmark; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    A session that has none but was given a checkpoint directory by hand uses that. Only a
    local-mode session without either gets a temporary folder: on a cluster that would be
    machine-local, so the missing setting is an error there.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        app = context.applicationId
        if app not in _LOCAL_SCRATCH:
            _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="contest-analytics-")
        folder = _LOCAL_SCRATCH[app]
    return re.sub("^file:/(?!/)", "file:///", folder).rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the scratch folder that nothing else uses."""
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def use_checkpoints(spark: SparkSession) -> None:
    """Point Spark's checkpoints to the scratch folder, unless the session has a place for them."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(f"{scratch_dir(spark)}/checkpoints")


class Scope:
    """Owner of what is staged or cached inside a ``with scratch_scope(spark)`` block."""

    def __init__(self, spark: SparkSession, parent: Scope | None) -> None:
        self.spark, self.parent = spark, parent
        self.paths: list[str] = []
        self.cached: list[DataFrame] = []

    def cache(self, df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
        """The rows kept by the executors until the block ends."""
        self.cached.append(df.persist(level))
        return df

    def keep(self, df: DataFrame) -> DataFrame:
        """The rows written as a table that outlives the block; the scope around it owns them, if any."""
        return _staged(df, self.parent)

    def own(self, path: str) -> str:
        """A folder that goes when the block ends."""
        self.paths.append(path)
        return path

    def drop(self, df: DataFrame) -> None:
        """Delete a table staged here before the block ends; no later step may read it."""
        path = _PATHS.get(df)
        if path in self.paths:
            self.paths.remove(path)
            _delete(self.spark, path)

    def close(self) -> None:
        for df in self.cached:
            df.unpersist()
        for path in self.paths:
            _delete(self.spark, path)
        self.cached, self.paths = [], []


_SCOPE: ContextVar[Scope | None] = ContextVar("scratch_scope", default=None)
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[Scope]:
    """Owns every table that ``cut_lineage`` stages inside the block and deletes it at the end.

    That holds for calls further down, and after an error. A frame that reads such a table is of no
    use after the block: pass results through ``keep``. Scopes nest.
    """
    scope = Scope(spark, _SCOPE.get())
    token = _SCOPE.set(scope)
    try:
        yield scope
    finally:
        _SCOPE.reset(token)
        scope.close()


def scoped(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A function of (spark, ...) whose result is written before what it staged is deleted."""

    @wraps(query)
    def run(spark: SparkSession, *args, **options) -> DataFrame:
        with scratch_scope(spark) as scope:
            return scope.keep(query(spark, *args, **options))

    return run


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and continue from there.

    Lost executors then re-read files instead of redoing the input plan, and later readers
    fetch only the columns they need. Nothing reads the shuffles behind the rows afterwards, so
    their files go when the write ends. The innermost ``scratch_scope`` owns the table.
    """
    return _staged(df, _SCOPE.get())


def _staged(df: DataFrame, owner: Scope | None) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, "stage")
    if owner is not None:
        owner.paths.append(path)  # before the write, which may fail half-way
    before = spark.conf.get(CLEAN_SHUFFLES, None)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEAN_SHUFFLES) if before is None else spark.conf.set(CLEAN_SHUFFLES, before)
    staged = spark.read.schema(df.schema).parquet(path)
    _PATHS[staged] = path
    return staged


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
