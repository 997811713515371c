"""Raw extracts: five CSV files and one JSON Lines file, every column text.

``source_row`` numbers the records of an extract from 1 in file order. The number of a record is
the number of records in earlier splits plus its place in its own split, so no global sort and no
single task over the data is needed: only one row per file split passes through a window. Landed
extracts are read by ``source_order`` (``read_ordered``), which the records carry themselves; the
number is looked up for the records that need one.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lettings import session
from lettings.model import ENTITIES, ORDER, ROW, Entity, Extract, PipelineError
from lettings.operators.rules import MALFORMED
from lettings.sources import cutting


def extract_path(folder: str, entity: Entity) -> str:
    return f"{folder.rstrip('/')}/{entity.name}.{entity.extract}"


SPLIT = ["_file", "_block"]


def stamped(frame: DataFrame) -> DataFrame:
    """Mark each record of a text scan with its split and an ascending number inside it."""
    return frame.select(
        *[name for name in frame.columns if name != "_metadata"],
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
    )


def split_shifts(records: DataFrame) -> DataFrame:
    """What to add to ``_id`` to get ``source_row``, one row per split."""
    torn = F.count_if(_open_quote()) if MALFORMED in records.columns else F.lit(0).cast("long")
    splits = records.groupBy(*SPLIT).agg(
        F.min("_id").alias("_start"), F.count(F.lit(1)).alias("_size"), torn.alias("_torn")
    )
    earlier = Window.orderBy(*SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_size").over(earlier), F.lit(0))
    return splits.select(*SPLIT, (before - F.col("_start") + 1).alias("_shift"), "_torn")


def _open_quote() -> Column:
    """The text of an unreadable record holds a quote that is not closed: a line break has torn it."""
    return F.length(F.regexp_replace(MALFORMED, '[^"]', "")) % 2 == 1


def with_source_rows(records: DataFrame, shifts: DataFrame) -> DataFrame:
    # One row per split: broadcast, since a shuffle by split would give each split to one task.
    return (
        records.join(F.broadcast(shifts.drop("_torn")), SPLIT)
        .withColumn(ROW, F.col("_id") + F.col("_shift"))
        .drop(*SPLIT, "_id", "_shift")
    )


def numbered_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table with its row position as ``source_row``; row groups carry the index.

    The row offsets, one per file, are broadcast: a shuffle by file gives one task a whole file, and
    AQE does not turn that join round by itself, since nearly all partitions of both sides are empty.
    """
    frame = spark.read.parquet(path)
    sizes = frame.groupBy(F.col("_metadata.file_path").alias("_file")).agg(
        F.count(F.lit(1)).alias("_size")
    )
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_file", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_shift"))
    return (
        frame.select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.row_index").alias("_index"),
        )
        .join(F.broadcast(offsets), "_file")
        .withColumn(ROW, F.col("_index") + F.col("_shift") + 1)
        .drop("_file", "_index", "_shift")
    )


def _read(spark: SparkSession, path: str, entity: Entity, multiline: bool) -> DataFrame:
    """The text columns of an extract, and ``MALFORMED`` with the text of unreadable records."""
    schema = T.StructType([*entity.raw_schema, T.StructField(MALFORMED, T.StringType())])
    if entity.extract != "csv":
        return (
            spark.read.schema(schema)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", MALFORMED)
            .json(path)
        )
    # Columns are found by name: the schema follows the header, extra columns are left out and
    # absent ones are null. Files of one extract must have one header; another one is an error.
    header = spark.read.option("header", True).option("escape", '"').csv(path).columns
    names = [*header, MALFORMED]
    frame = (
        spark.read.schema(T.StructType([T.StructField(name, T.StringType()) for name in names]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", MALFORMED)
        .csv(path)
    )
    wanted = [
        F.col(f"`{name}`") if name in header else F.lit(None).cast("string").alias(name)
        for name in entity.raw
    ]
    return frame.select(*wanted, MALFORMED, "_metadata")


def _read_cut(spark: SparkSession, path: str, entity: Entity) -> DataFrame:
    """A CSV extract with line breaks inside quotes, as ``_read`` and ``stamped`` give it."""
    reader = spark.read.option("header", True).option("escape", '"')
    names = reader.csv(path).columns
    line = spark.read.text(path).filter(F.col("_metadata.file_block_start") == 0).first().value
    schema = T.StructType([T.StructField(name, T.StringType()) for name in (*names, MALFORMED)])
    frame = cutting.parsed(cutting.records(spark, path, line.removeprefix("\ufeff")), schema, MALFORMED)
    wanted = [
        F.col(f"`{name}`") if name in names else F.lit(None).cast("string").alias(name)
        for name in entity.raw
    ]
    return frame.select(*wanted, MALFORMED, *SPLIT, "_id")


def read_extract(
    spark: SparkSession, path: str, entity: Entity | str, *, multiline: bool = False
) -> DataFrame:
    """One extract as text columns plus ``source_row``.

    CSV files with line breaks inside quotes are cut into records by many tasks; ``multiline`` has
    each file read by one task instead.
    """
    spec = ENTITIES[entity] if isinstance(entity, str) else entity
    try:
        records = stamped(_read(spark, path, spec, multiline))
        if spec.extract == "csv":
            # With all columns: Spark refuses a scan for the unreadable text alone.
            if not multiline and records.filter(_open_quote()).head(1):
                records = _read_cut(spark, path, spec)
            records = records.drop(MALFORMED)
        return with_source_rows(records, split_shifts(records))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise PipelineError(f"Required source file does not exist: {path}") from error
        raise


def read_bronze(spark: SparkSession, folder: str, *, multiline: bool = False) -> dict[str, DataFrame]:
    """All six extracts of a folder; a missing one is an error."""
    return {
        name: read_extract(spark, extract_path(folder, spec), spec, multiline=multiline)
        for name, spec in ENTITIES.items()
    }


def _landing(bronze: str, batch_id: str, name: str) -> tuple[str, str]:
    root = bronze.rstrip("/")
    return f"{root}/{name}/batch_id={batch_id}", f"{root}/splits/{name}/batch_id={batch_id}"


def ingest(
    spark: SparkSession, source: str, bronze: str, batch_id: str, *, multiline: bool = False
) -> dict[str, DataFrame]:
    """Land the extracts unchanged in Bronze: the text columns, each parsed once.

    Row numbers are settled from the landed split columns, so the text is not read again, and
    every later step and every re-run task sees the same numbers.
    """
    session.together(
        spark,
        {
            name: partial(_land, spark, spec, extract_path(source, spec), *_landing(bronze, batch_id, name), multiline)
            for name, spec in ENTITIES.items()
        },
    )
    return read_landed(spark, bronze, batch_id)


def _land(
    spark: SparkSession, spec: Entity, extract: str, path: str, splits: str, multiline: bool
) -> None:
    try:
        records = stamped(_read(spark, extract, spec, multiline))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise PipelineError(f"Required source file does not exist: {extract}") from error
        raise
    records.write.mode("overwrite").parquet(path)
    columns = [*SPLIT, "_id", *([MALFORMED] if spec.extract == "csv" and not multiline else [])]
    shifts = split_shifts(spark.read.parquet(path).select(*columns))
    shifts.write.mode("overwrite").parquet(splits)
    if MALFORMED in columns and not spark.read.parquet(splits).filter("_torn > 0").isEmpty():
        _read_cut(spark, extract, spec).write.mode("overwrite").parquet(path)
        shifts = split_shifts(spark.read.parquet(path).select(*SPLIT, "_id"))
        shifts.write.mode("overwrite").parquet(splits)


def read_ordered(spark: SparkSession, bronze: str, batch_id: str) -> dict[str, Extract]:
    """Landed extracts by ``source_order``, with the split sizes beside them: nothing is joined."""
    landed: dict[str, Extract] = {}
    for name in ENTITIES:
        path, splits = _landing(bronze, batch_id, name)
        try:
            records, shifts = spark.read.parquet(path), spark.read.parquet(splits)
        except AnalysisException as error:
            raise PipelineError(f"Required Bronze data does not exist: {path}") from error
        if ENTITIES[name].extract == "csv":  # short records lack fields, which the rules report
            records = records.drop(MALFORMED)
        order = F.struct(F.col("_file").alias("file"), F.col("_block").alias("block"), F.col("_id").alias("id"))
        landed[name] = Extract(records.withColumn(ORDER, order).drop(*SPLIT, "_id"), shifts)
    return landed


def read_landed(spark: SparkSession, bronze: str, batch_id: str) -> dict[str, DataFrame]:
    """Landed extracts with ``source_row``; the shifts are joined by their measured size."""
    return {
        name: extract.numbered(extract.records).drop(ORDER)
        for name, extract in read_ordered(spark, bronze, batch_id).items()
    }


def require_well_formed(batch: Mapping[str, DataFrame]) -> None:
    """Fail a landed batch on unreadable JSON, for callers that do not want it quarantined."""
    for name, frame in batch.items():
        if MALFORMED in frame.columns and not frame.filter(F.col(MALFORMED).isNotNull()).isEmpty():
            raise PipelineError(f"Invalid JSON in source entity {name}")
