"""Silver, quarantine and summary tables written by a batch.

Silver of an entity is its record table (valid and invalid records apart) and the narrow table of
late rejects; readers take the valid records without the late ones.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettings.model import ENTITIES, QUARANTINE, Extract, PipelineError
from lettings.operators import quality
from lettings.operators.quality import LATE, Assessed

#: Batch id and processing time of a batch's Silver, one row.
STAMP = "batch_id string, processed_at timestamp"


class Lake:
    """Folder layout below one root; all paths belong to one batch except ``quarantine``."""

    def __init__(self, root: str) -> None:
        self.root = root.rstrip("/")

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def state(self) -> str:
        return f"{self.root}/state"

    @property
    def history(self) -> str:
        return f"{self.root}/history"

    def silver(self, batch_id: str) -> str:
        return f"{self.root}/silver/batch_id={batch_id}"

    def summary(self, batch_id: str) -> str:
        return f"{self.root}/quality/{batch_id}"


def read_assessed(spark: SparkSession, lake: Lake, batch_id: str) -> dict[str, Assessed]:
    """The written tables of a batch; their raw texts are not at hand."""
    folder = lake.silver(batch_id)
    found: dict[str, Assessed] = {}
    for name, spec in ENTITIES.items():
        try:
            records = spark.read.schema(quality.record_schema(spec)).parquet(f"{folder}/{name}")
            late = spark.read.schema(LATE).parquet(f"{folder}/late/{name}")
            stamp = spark.read.schema(STAMP).parquet(f"{folder}/stamp")
        except AnalysisException as error:
            raise PipelineError(f"Required Silver dataset does not exist: {folder}/{name}") from error
        moment = stamp.select("processed_at").scalar()
        found[name] = Assessed(spec, records, late, Extract(records), batch_id, moment)
    return found


def write_stamp(spark: SparkSession, lake: Lake, batch_id: str, processed_at: object) -> None:
    stamp = spark.range(1).select(F.lit(batch_id).alias("batch_id"), processed_at.alias("processed_at"))
    stamp.coalesce(1).write.mode("overwrite").parquet(f"{lake.silver(batch_id)}/stamp")


def read_silver(spark: SparkSession, lake: Lake, batch_id: str, entity: str) -> DataFrame:
    """Accepted records; the partition filter keeps the files of invalid ones unread."""
    return read_assessed(spark, lake, batch_id)[entity].accepted


def read_silver_batch(spark: SparkSession, lake: Lake, batch_id: str) -> dict[str, DataFrame]:
    return {name: part.accepted for name, part in read_assessed(spark, lake, batch_id).items()}


def write_quarantine(lake: Lake, assessed: Mapping[str, Assessed]) -> None:
    """Gather the rejected records of all entities under their batch partition."""
    quality.all_rejected(assessed).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("batch_id").parquet(lake.quarantine)


def read_quarantine(spark: SparkSession, lake: Lake, batch_id: str) -> DataFrame:
    """Rejected records of a batch; empty when the batch rejected nothing."""
    try:
        frame = spark.read.schema(QUARANTINE).parquet(lake.quarantine)
    except AnalysisException:
        return spark.createDataFrame([], QUARANTINE)
    return frame.filter(F.col("batch_id") == batch_id).select(*QUARANTINE.names)


def write_summary(lake: Lake, batch_id: str, summary: DataFrame) -> None:
    summary.withColumn("batch_id", F.lit(batch_id)).coalesce(1).write.mode("overwrite").json(
        lake.summary(batch_id)
    )
