"""Record fingerprints and surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def canonical_json(columns: Sequence[tuple[str, T.DataType]]) -> Column:
    """Compact JSON with sorted keys; decimals and dates as text, so formatting is fixed."""
    fields = [
        (F.col(name).cast("string") if isinstance(kind, T.DecimalType | T.DateType) else F.col(name)).alias(name)
        for name, kind in sorted(columns)
    ]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def fingerprint(columns: Sequence[tuple[str, T.DataType]]) -> Column:
    """SHA-256 over business columns only, so a replay with new metadata is unchanged."""
    return F.sha2(canonical_json(columns), 256)


def surrogate_key(identifier: Column) -> Column:
    return F.md5(identifier)
