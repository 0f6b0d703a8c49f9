"""Small files and folders on any file system that Hadoop knows, for commit points."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """The file system of a path, and the path, as Java objects."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    store, place = _at(spark, path)
    return store.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder; what is missing is no error."""
    store, place = _at(spark, path)
    store.delete(place, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Give a file or folder a new name, which must be free."""
    store, place = _at(spark, path)
    _, target = _at(spark, to)
    if store.exists(target):
        raise FileExistsError(to)
    store.mkdirs(target.getParent())
    if not store.rename(place, target):
        raise OSError(f"could not rename {path} to {to}")


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of a folder's entries in order; none for a missing folder."""
    store, place = _at(spark, folder)
    return sorted(s.getPath().getName() for s in store.listStatus(place)) if store.exists(place) else []


def read_json(spark: SparkSession, path: str) -> dict | None:
    """What a file written by ``write_json`` holds, or None without such a file."""
    store, place = _at(spark, path)
    if not store.exists(place):
        return None
    stream = store.open(place)  # not by Spark's reader, which skips names with an underscore
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_json(spark: SparkSession, path: str, value: dict, replace: bool = False) -> None:
    """Write a file whole or not at all; an existing one is an error unless ``replace``.

    The file gets its name when it is complete. Where two writers want one name, the second fails.
    """
    store, place = _at(spark, path)
    draft = f"{place.getParent()}/.{place.getName()}-{uuid.uuid4().hex}"
    _, draft_place = _at(spark, draft)
    out = store.create(draft_place, False)
    try:
        out.write(bytearray(json.dumps(value, sort_keys=True).encode()))
    finally:
        out.close()
    try:
        if replace:
            store.delete(place, False)
        rename(spark, draft, path)
    except (FileExistsError, OSError, Py4JJavaError):
        store.delete(draft_place, False)
        raise
