"""Small files and folders of our own, on whatever file system the path names."""

from __future__ import annotations

import json
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from lettings.model import PipelineError


def _place(spark: SparkSession, path: str) -> tuple[Any, Any]:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if it is absent."""
    place, system = _place(spark, folder)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place))


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that must not exist yet; of several writers one gets True.

    The file system decides who creates it, atomically on HDFS and on stores with conditional writes.
    """
    place, system = _place(spark, path)
    try:
        stream = system.create(place, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


def last_manifest(spark: SparkSession, folder: str) -> tuple[int, dict[str, Any] | None]:
    """The highest number of the manifests ``<number>.json`` in a folder and its content.

    A manifest is created and filled in two steps; one that can't be read yet counts as a commit under
    way, and its content is None. Of no manifest the number is 0.
    """
    numbers = [int(name.removesuffix(".json")) for name in names(spark, folder) if name.endswith(".json")]
    if not numbers:
        return 0, {}
    return max(numbers), read_manifest(spark, folder, max(numbers))


def read_manifest(spark: SparkSession, folder: str, number: int) -> dict[str, Any] | None:
    rows = spark.read.text(manifest_path(folder, number), wholetext=True).collect()
    try:
        return json.loads(rows[0].value) if rows else None
    except ValueError:
        return None


def manifest_path(folder: str, number: int) -> str:
    return f"{folder}/{number:012d}.json"


def commit(spark: SparkSession, folder: str, number: int, content: dict[str, Any], what: str) -> None:
    """Create manifest ``number``; an error if another writer has."""
    if not create(spark, manifest_path(folder, number), json.dumps(content)):
        raise PipelineError(f"Another load has made {what} {number}; load again")
