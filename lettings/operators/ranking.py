"""Ranks and running totals inside groups that may hold a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettings.session import shared_folder

#: Rows of a group that one task may order.
SMALL = 100_000
_STEP = 32


def bucketed(
    frame: DataFrame, group: Sequence[str], order: str, *, buckets: int = 1024, small: int = SMALL
) -> DataFrame:
    """Add ``_bucket``: ascending with ``order`` inside a group, about equally many rows in each.

    Groups of up to ``small`` rows are one bucket. Others are cut at approximate quantiles of their
    own, so a few outlying or clustered values do not crowd a bucket. The cuts are one row for each large group
    and are stored, so that every use and every task repeated later sees the same ones.
    """
    shared_folder(frame.sparkSession)
    sizes = frame.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > small)
    shares = [i / buckets for i in range(1, buckets)]
    cuts = (
        frame.join(sizes.select(*group), list(group), "left_semi")
        .groupBy(*group)
        .agg(F.percentile_approx(order, shares, 10 * buckets).alias("_cuts"))
        .withColumn("_coarse", F.expr(f"filter(_cuts, (x, i) -> i % {_STEP} = {_STEP - 1})"))
        .checkpoint()
    )
    # Two short searches instead of a long one: among every 32nd cut, then in that stretch.
    passed = F.size(F.filter("_coarse", lambda cut: cut < F.col(order)))
    inside = F.size(
        F.filter(F.slice("_cuts", F.col("_passed") * _STEP + 1, _STEP), lambda cut: cut < F.col(order))
    )
    found = frame.join(cuts, list(group), "left").withColumn("_passed", passed)
    bucket = F.when(F.col("_cuts").isNull(), 0).otherwise(F.col("_passed") * _STEP + inside)
    return found.withColumn("_bucket", bucket).drop("_cuts", "_coarse", "_passed")


def earlier_total(
    frame: DataFrame,
    group: Sequence[str],
    order: str,
    value: Column,
    name: str,
    *,
    buckets: int = 1024,
    small: int = SMALL,
) -> DataFrame:
    """Add the sum of ``value`` over the rows of the group with a smaller ``order``.

    ``order`` is a number, unique inside a group. A plain window would put a whole group into
    one task, so large groups are cut into buckets: totals per bucket are combined before their
    shuffle and accumulated over at most ``buckets`` rows per group, and the window over rows only
    sees one bucket of one group.
    """
    cut = bucketed(frame, group, order, buckets=buckets, small=small).withColumn("_value", value)
    keys = [*group, "_bucket"]
    by_bucket = Window.partitionBy(*group).orderBy("_bucket")
    before = by_bucket.rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*keys)
        .agg(F.sum("_value").alias("_total"))
        .select(*keys, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        cut.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
        .join(offsets, keys)
        .withColumn(name, F.col("_offset") + F.col("_inside"))
        .drop("_bucket", "_value", "_inside", "_offset")
    )


def position(
    frame: DataFrame,
    group: Sequence[str],
    order: str,
    name: str,
    *,
    buckets: int = 1024,
    small: int = SMALL,
) -> DataFrame:
    """Zero-based position of each row in its group."""
    one = F.lit(1).cast("long")
    return earlier_total(frame, group, order, one, name, buckets=buckets, small=small)
