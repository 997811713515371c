"""Report measures, each valid at any grouping: ratios of sums, never means of ratios."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ratio(above: Column, below: Column) -> Column:
    return F.try_divide(above.cast("double"), below.cast("double"))


MEASURES: dict[str, Callable[[], Column]] = {
    "occupancy_rate": lambda: _ratio(
        F.sum("occupied_property_days"), F.sum("available_property_days")
    ),
    "rental_revenue": lambda: F.sum("rental_revenue"),
    "rent_per_sqm": lambda: _ratio(
        F.sum(F.col("average_rent_per_sqm") * F.col("property_count")), F.sum("property_count")
    ),
    "overdue_rate": lambda: _ratio(F.count_if("is_overdue"), F.count(F.lit(1))),
    "expiring_agreements": lambda: F.count(F.lit(1)),
}


def measure(
    frame: DataFrame, name: str, *, by: Sequence[str] = (), where: Column | None = None
) -> DataFrame:
    """One aggregate query on a mart; ``by`` may be empty for the grand total."""
    if name == "rent_trend":
        return rent_trend(frame, by=by, where=where)
    scope = frame if where is None else frame.filter(where)
    return scope.groupBy(*by).agg(MEASURES[name]().alias(name))


def rent_trend(
    trends: DataFrame, *, by: Sequence[str] = (), where: Column | None = None, month: Column | None = None
) -> DataFrame:
    """Mean rent of the latest visible month minus that of the month before it.

    The month before is the last earlier one of the whole model, whatever the groups and filters
    are; a group without rent in it counts with zero there, and so does the model's first month.
    ``where`` filters city or region, ``month`` which months are visible. Means are unweighted over
    locations. Monthly means come first: what follows is bounded by groups times months.
    """
    scope = trends if where is None else trends.filter(where)
    visible = F.lit(True) if month is None else month
    groups = [name for name in by if name != "agreement_month"]
    means = scope.groupBy(*groups, "agreement_month").agg(
        (F.sum("average_monthly_rent").cast("double") / F.count("average_monthly_rent")).alias("_mean")
    )
    seen = means.filter(visible)
    if "agreement_month" not in by:
        seen = seen.groupBy(*groups).agg(
            F.max_by("_mean", "agreement_month").alias("_mean"),
            F.max("agreement_month").alias("agreement_month"),
        )
    # One row per month of the calendar.
    months = trends.select("agreement_month").distinct()
    in_order = Window.orderBy("agreement_month")
    before = months.select(
        F.col("agreement_month").alias("_month"), F.lag("agreement_month").over(in_order).alias("_before")
    )
    earlier = means.select(
        *[F.col(name).alias(f"_{name}") for name in groups],
        F.col("agreement_month").alias("_earlier"),
        F.col("_mean").alias("_previous"),
    )
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in groups]
    matched = reduce(lambda x, y: x & y, same, F.col("_before") == F.col("_earlier"))
    return (
        seen.join(before, F.col("agreement_month") == F.col("_month"), "left")
        .join(earlier, matched, "left")
        .select(*by, (F.col("_mean") - F.coalesce("_previous", F.lit(0.0))).alias("rent_trend"))
    )
