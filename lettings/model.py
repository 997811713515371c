"""The six rental entities: columns, types, keys and parents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
AREA = T.DecimalType(10, 2)

ROW = "source_row"
"""Position of a record in its extract (1-based); defines "first" for duplicates."""

ORDER = "source_order"
"""Stand-in for ``source_row`` on its way through a batch: it orders the records of an extract and tells
them apart, but needs no look at other file splits."""

ORDER_TYPE = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("id", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Extract:
    """Raw records of one entity, by ``source_row`` or by ``source_order``.

    With the latter, ``shifts`` has for each file split (``_file``, ``_block``) what to add to
    ``id`` to get the row number.
    """

    records: DataFrame
    shifts: DataFrame | None = None

    def numbered(self, frame: DataFrame) -> DataFrame:
        """Rows that carry the order key, with ``source_row``; meant for the few rejected ones."""
        if self.shifts is None:
            return frame.withColumn(ROW, F.col(f"{ORDER}.id"))
        split = self.shifts.select("_file", "_block", "_shift")
        found = frame.withColumns({"_file": F.col(f"{ORDER}.file"), "_block": F.col(f"{ORDER}.block")})
        return (
            found.join(F.broadcast(split), ["_file", "_block"])
            .withColumn(ROW, F.col(f"{ORDER}.id") + F.col("_shift"))
            .drop("_file", "_block", "_shift")
        )


@dataclass(frozen=True)
class Entity:
    name: str
    columns: tuple[tuple[str, T.DataType], ...]
    extract: str

    @property
    def business(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def key(self) -> str:
        return self.columns[0][0]

    @property
    def raw(self) -> list[str]:
        """Every source column is required, so this is also the required-field order."""
        return [*self.business, "source_timestamp"]

    @property
    def silver(self) -> T.StructType:
        fields = [T.StructField(name, kind, False) for name, kind in self.columns]
        return T.StructType(
            [
                *fields,
                T.StructField("source_timestamp", T.TimestampType(), False),
                T.StructField("batch_id", T.StringType(), False),
                T.StructField("record_fingerprint", T.StringType(), False),
                T.StructField("processed_at", T.TimestampType(), False),
            ]
        )

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, T.StringType()) for name in self.raw])


def _text(*names: str) -> tuple[tuple[str, T.DataType], ...]:
    return tuple((name, T.StringType()) for name in names)


_SPECS = (
    Entity("locations", _text("location_id", "city", "region", "country_code"), "csv"),
    Entity("owners", _text("owner_id", "full_name", "email"), "csv"),
    Entity("tenants", _text("tenant_id", "full_name", "email"), "csv"),
    Entity(
        "properties",
        (
            *_text("property_id", "location_id", "owner_id", "property_type"),
            ("bedrooms", T.IntegerType()),
            ("size_sqm", AREA),
            ("monthly_rent", MONEY),
            *_text("currency"),
        ),
        "csv",
    ),
    Entity(
        "rental_agreements",
        (
            *_text("agreement_id", "property_id", "tenant_id"),
            ("start_date", T.DateType()),
            ("end_date", T.DateType()),
            ("monthly_rent", MONEY),
            *_text("status"),
        ),
        "csv",
    ),
    Entity(
        "payments",
        (
            *_text("payment_id", "agreement_id"),
            ("due_date", T.DateType()),
            ("payment_date", T.DateType()),
            ("amount", MONEY),
            *_text("status"),
        ),
        "jsonl",
    ),
)

ENTITIES: dict[str, Entity] = {spec.name: spec for spec in _SPECS}
"""Parents come before children; every pass over the entities follows this order."""

QUARANTINE = T.StructType(
    [
        T.StructField("record_type", T.StringType(), False),
        T.StructField("source_identifier", T.StringType(), False),
        T.StructField("batch_id", T.StringType(), False),
        T.StructField("reason_code", T.StringType(), False),
        T.StructField("explanation", T.StringType(), False),
        T.StructField("processed_at", T.TimestampType(), False),
        T.StructField("raw_record", T.StringType(), False),
        T.StructField(ROW, T.LongType(), False),
    ]
)


class PipelineError(RuntimeError):
    """An expected failure of a batch: missing input, unknown run, broken constraint."""


class BatchRejected(PipelineError):
    """A strict batch with invalid records: their number and the first few, one to a line."""

    def __init__(self, total: int, first: list[str]) -> None:
        super().__init__("\n".join([f"{total} invalid record(s), of which the first are:", *first]))
        self.total, self.first = total, first
