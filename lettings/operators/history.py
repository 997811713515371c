"""Slowly changing property history: a new version whenever a watched column changes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lettings.model import ENTITIES

WATCHED = (
    "location_id",
    "owner_id",
    "property_type",
    "bedrooms",
    "size_sqm",
    "monthly_rent",
    "currency",
)
KEY = "property_id"
COLUMNS = (KEY, *WATCHED, "source_timestamp", "processed_at")
_KINDS = {field.name: field.dataType for field in ENTITIES["properties"].silver}
SCHEMA = T.StructType(
    [
        *[T.StructField(name, _KINDS[name]) for name in COLUMNS],
        T.StructField("valid_from", T.TimestampType()),
        T.StructField("valid_to", T.TimestampType()),
        T.StructField("version_id", T.StringType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)


def _version(run_at: Column) -> Column:
    return F.md5(F.concat_ws("|", F.col(KEY), F.unix_micros(run_at).cast("string")))


def _opened(current: DataFrame, run_at: Column) -> DataFrame:
    return current.select(
        *COLUMNS,
        run_at.alias("valid_from"),
        F.lit(None).cast(T.TimestampType()).alias("valid_to"),
        _version(run_at).alias("version_id"),
        run_at.alias("updated_at"),
    )


def first_snapshot(current: DataFrame, run_at: Column) -> DataFrame:
    return _opened(current, run_at)


KEPT, ENDED, BEGUN = "kept", "ended", "begun"


def changes(opened: DataFrame, current: DataFrame, run_at: Column) -> DataFrame:
    """What one snapshot run makes of the open versions: each row is kept, ended or begun (``kind``).

    Open versions meet the current records in one full outer join on the key, which is unique
    on both sides. A changed or vanished key ends its open version (only its end changes), a
    changed or new (or returning) key begins one.
    """
    columns = [*COLUMNS, "valid_from", "valid_to", "version_id", "updated_at"]
    old = opened.select(KEY, F.struct(*columns).alias("_old"))
    new = current.select(KEY, F.struct(*COLUMNS).alias("_new"))
    same = reduce(
        lambda left, right: left & right,
        [F.col(f"_old.{name}").eqNullSafe(F.col(f"_new.{name}")) for name in WATCHED],
    )
    met = old.join(new, KEY, "full_outer").select("_old", "_new", same.alias("_same"))
    untouched = F.col("_old").isNotNull() & F.col("_new").isNotNull() & F.col("_same")
    ended = F.col("_old").isNotNull() & ~untouched
    begun = F.col("_new").isNotNull() & ~untouched
    old_row = F.struct(
        *[F.col(f"_old.{name}").alias(name) for name in (*COLUMNS, "valid_from")],
        F.when(ended, run_at).otherwise(F.col("_old.valid_to")).alias("valid_to"),
        F.col("_old.version_id").alias("version_id"),
        F.col("_old.updated_at").alias("updated_at"),
        F.when(ended, ENDED).otherwise(KEPT).alias("kind"),
    )
    new_row = F.struct(
        *[F.col(f"_new.{name}").alias(name) for name in COLUMNS],
        run_at.alias("valid_from"),
        F.lit(None).cast(T.TimestampType()).alias("valid_to"),
        F.md5(
            F.concat_ws("|", F.col(f"_new.{KEY}"), F.unix_micros(run_at).cast("string"))
        ).alias("version_id"),
        run_at.alias("updated_at"),
        F.lit(BEGUN).alias("kind"),
    )
    versions = F.array_compact(
        F.array(F.when(F.col("_old").isNotNull(), old_row), F.when(begun, new_row))
    )
    return met.select(F.explode(versions).alias("_row")).select("_row.*")


def snapshot(history: DataFrame, current: DataFrame, run_at: Column) -> DataFrame:
    """The whole history after one snapshot run; closed versions pass through."""
    closed = history.filter(F.col("valid_to").isNotNull())
    opened = history.filter(F.col("valid_to").isNull())
    return closed.unionByName(changes(opened, current, run_at).drop("kind"))
