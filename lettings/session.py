"""Session settings the plans rely on, and where intermediate tables may be written."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from lettings.model import PipelineError

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot parents (one property or agreement with a third of all children) are split at run
    # time; forcing keeps the split even where it costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def build(master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName("lettings")
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that all executors share.

    A session on one machine that names none gets a temporary one; on a cluster that is an error,
    since each executor would write to its own disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise PipelineError("Set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="lettings-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of our own, wherever it lies; an absent one is no error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a job go when it ends, not when the driver happens to collect its garbage.

    For work in several writes: the disk then holds the shuffles of the running ones only. A frame that
    runs twice inside would shuffle twice.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame once to the shared folder and read it back: lineage ends there.

    The folder goes when the application ends, if nobody has removed it before.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(frame.schema).parquet(path)


Result = TypeVar("Result")


def together(
    spark: SparkSession, work: Mapping[str, Callable[[], Result]], most: int | None = None
) -> dict[str, Result]:
    """Run jobs that do not depend on each other at the same time, so that small ones fill the gaps.

    All are waited for; the first failure in the given order is raised. ``most`` bounds how many run at
    once: each holds its broadcast tables on every executor.
    """
    with ThreadPoolExecutor(max(1, min(len(work), most or len(work)))) as pool:
        started = {name: pool.submit(inheritable_thread_target(spark)(call)) for name, call in work.items()}
    return {name: future.result() for name, future in started.items()}
