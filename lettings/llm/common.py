"""Shared work folder, stored intermediate tables, row numbers and small helpers of the operators."""

from __future__ import annotations

import tempfile
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch; texts of 100 kB then stay below some 25 MB.
BATCH_ROWS = 256
#: Row numbers that are broadcast at most (some 30 MB); more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
_own_folder: dict[str, str] = {}


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches, so that a run of very long texts does not fill a task's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; a temporary one only in local mode without it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith(("local[", "local")) or (
            spark.sparkContext.master.startswith("local-cluster")
        ):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _own_folder.setdefault("base", tempfile.mkdtemp(prefix="lettings-llm-"))
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame once to the shared folder and read it back: lineage ends there.

    Results read these folders whenever they are asked for, so they go when the application ends.
    """
    spark = frame.sparkSession
    path = work_folder(spark, name)
    frame.write.option("compression", "zstd").parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(frame.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def placed(documents: DataFrame, name: str, *columns: Column) -> DataFrame:
    """Some columns and, as ``name``, the row's place (``file``, ``row``) in the stored files.

    A place stays the same however often and in which tasks the files are read; the file is known
    by a 64-bit hash of its path. Rows that do not come straight from files are stored first. A column
    of the documents that is called ``_metadata`` does not hide the files' own.
    """

    def place(rows: DataFrame) -> DataFrame:
        of_file = rows.metadataColumn("_metadata")
        parts = F.xxhash64(of_file["file_path"]).alias("file"), of_file["row_index"].alias("row")
        return rows.select(F.struct(*parts).alias(name), *columns)

    try:
        return place(documents)
    except AnalysisException:
        return place(stored(documents, "rows"))


def numbered(documents: DataFrame) -> tuple[DataFrame, str]:
    """The rows with their place in a new column, and that column's name."""
    name = "row_number"
    while name in {column.lower() for column in documents.columns}:
        name = f"_{name}"
    return placed(documents, name, *[F.col(f"`{column}`") for column in documents.columns]), name


def without(rows: DataFrame, number: str, dropped: DataFrame) -> DataFrame:
    """The rows whose number is not among the dropped ones; the number goes.

    Few dropped rows are broadcast, after a check of their count, so that texts are not shuffled.
    """
    dropped = stored(dropped.select(number), "dropped")
    if dropped.count() <= BROADCAST_ROWS:
        dropped = F.broadcast(dropped)
    return rows.join(dropped, number, "left_anti").drop(number)


def row_numbers() -> Iterator[int]:
    """Numbers that are unique over all tasks; stable once the rows are stored."""
    number = TaskContext.get().partitionId() << 36
    while True:
        yield number
        number += 1


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text is a multiple of five (null counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def is_held_out(doc_id: object) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 0


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """A string column as Python strings, null as empty."""
    return [x or "" for x in batch.column(name).to_pylist()]


def share_of(total: int, bound: int) -> float:
    """The share of rows to sample so that about ``bound`` of them are kept."""
    return min(1.0, bound / max(total, 1))


def in_sample(key: Column, share: float | Column, seed: str) -> Column:
    """A repeatable sample by the hash of a key; it does not depend on partitions."""
    spread = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1_000_003))
    if isinstance(share, Column):
        return spread < F.floor(share * 1_000_003)
    return spread < int(share * 1_000_003) if share < 1 else F.lit(True)


def batches(rows: Iterable[dict], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)
