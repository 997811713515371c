"""Evaluate expressions once."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluated(frame: DataFrame, columns: Mapping[str, Column], *keep: str | Column) -> DataFrame:
    """``keep`` plus the named columns, each computed once per row.

    Catalyst pushes filters through projections by repeating their expressions, which for
    stacked text parsing multiplies the work. It does not push through a generator, so the
    columns come out of a one-element ``inline``.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return frame.select(*keep, F.inline(F.array(row)))
