"""Reporting marts.

Each mart aggregates on surrogate keys before it fetches location attributes, so the attribute
join sees one row per group. Currencies are not converted: amounts are summed as they stand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettings.functions.dates import days_in_month, each_month, month_start
from lettings.functions.hashing import surrogate_key
from lettings.plans import star
from lettings.plans.star import State

EXACT = "decimal(24,12)"
"""Money widened before averaging: the mean keeps 16 decimals and is rounded once, at the end."""


def _places(state: State) -> DataFrame:
    return star.dim_location(state).select("location_key", "city", "region")


def mart_monthly_rental_revenue(state: State) -> DataFrame:
    paid = star.fact_payment(state).filter(F.col("status") == "PAID")
    monthly = paid.groupBy(
        "location_key", month_start(F.col("payment_date")).alias("revenue_month")
    ).agg(F.count(F.lit(1)).alias("paid_payment_count"), F.sum("amount").alias("rental_revenue"))
    return monthly.join(_places(state), "location_key").select(
        "location_key", "city", "region", "revenue_month", "paid_payment_count", "rental_revenue"
    )


def mart_overdue_payments(state: State) -> DataFrame:
    late = star.fact_payment(state).filter("is_overdue")
    return late.join(_places(state), "location_key").select(
        "payment_key",
        "payment_id",
        "rental_agreement_key",
        "property_key",
        "location_key",
        "city",
        "due_date",
        "payment_date",
        "amount",
        "days_overdue",
        "status",
    )


def mart_average_rent_per_sqm(state: State) -> DataFrame:
    rate = F.col("monthly_rent") / F.nullif(F.col("size_sqm"), F.lit(0))
    per_place = star.dim_property(state).groupBy("location_key").agg(
        F.count(F.lit(1)).alias("property_count"),
        F.round(F.avg(rate), 2).alias("average_rent_per_sqm"),
    )
    return per_place.join(_places(state), "location_key").select(
        "location_key", "city", "region", "property_count", "average_rent_per_sqm"
    )


def mart_agreements_expiring_soon(state: State, as_of: Column, days: int = 30) -> DataFrame:
    """Agreements of any status that end within ``days`` of the reference date."""
    soon = star.fact_rental_agreement(state).filter(
        F.col("end_date").between(as_of, F.date_add(as_of, days))
    )
    return soon.join(_places(state), "location_key").select(
        "rental_agreement_key",
        "agreement_id",
        "property_key",
        "tenant_key",
        "city",
        "end_date",
        F.datediff(F.col("end_date"), as_of).alias("days_until_expiration"),
        "monthly_rent",
    )


def mart_rental_trends_by_location(state: State) -> DataFrame:
    """Monthly mean rent and its change from the previous month that has agreements.

    The window runs over monthly means: at most one row per location and calendar month.
    """
    monthly = (
        star.fact_rental_agreement(state)
        .groupBy("location_key", month_start(F.col("start_date")).alias("agreement_month"))
        .agg(
            F.count(F.lit(1)).alias("agreement_count"),
            F.avg(F.col("monthly_rent").cast(EXACT)).alias("_mean"),
        )
    )
    by_month = Window.partitionBy("location_key").orderBy("agreement_month")
    change = F.col("_mean") - F.lag("_mean").over(by_month)
    return (
        monthly.withColumn("_change", change)
        .join(_places(state), "location_key")
        .select(
            "location_key",
            "city",
            "region",
            "agreement_month",
            "agreement_count",
            F.round("_mean", 2).alias("average_monthly_rent"),
            F.round("_change", 2).alias("rent_change_from_previous_month"),
        )
    )


def occupied_days_by_month(state: State) -> DataFrame:
    """Occupied days per location and month without one row per day.

    An agreement contributes one row per month it touches, with the days it covers there. The
    sums equal those over ``fact_occupancy``; there are about thirty times fewer rows.
    """
    month = F.col("month_start_date")
    return (
        star.fact_rental_agreement(state)
        .select(
            "location_key",
            "start_date",
            "end_date",
            F.explode(each_month(F.col("start_date"), F.col("end_date"))).alias("month_start_date"),
        )
        .groupBy("location_key", "month_start_date")
        .agg(
            F.sum(days_in_month(month, F.col("start_date"), F.col("end_date"))).alias(
                "occupied_property_days"
            )
        )
    )


def mart_occupancy(state: State) -> DataFrame:
    """Every location in every calendar month, with zero for months without agreements.

    The calendar comes as two scalars that expand each inventory row, so nothing is cross joined;
    first and last month count only the days inside the calendar.
    """
    bounds = star.calendar_bounds(state)
    first = bounds.select("first_day").scalar()
    last = bounds.select("last_day").scalar()
    month = F.col("month_start_date")
    inventory = (
        star.dim_property(state)
        .groupBy("location_key")
        .agg(F.count(F.lit(1)).alias("property_count"))
        .join(_places(state), "location_key")
        .withColumns({"_first": first, "_last": last})
        .withColumn("month_start_date", F.explode(each_month(F.col("_first"), F.col("_last"))))
        .withColumn(
            "available_property_days",
            F.col("property_count") * days_in_month(month, F.col("_first"), F.col("_last")),
        )
    )
    occupied = F.coalesce(F.col("occupied_property_days"), F.lit(0))
    exact = "decimal(20,0)"
    rate = occupied.cast(exact) / F.nullif(F.col("available_property_days").cast(exact), F.lit(0))
    return inventory.join(
        occupied_days_by_month(state), ["location_key", "month_start_date"], "left"
    ).select(
        "location_key",
        "city",
        "region",
        "month_start_date",
        occupied.alias("occupied_property_days"),
        "available_property_days",
        F.round(rate, 4).alias("occupancy_rate"),
    )


def payments_for_agreement(state: State, agreement_id: str) -> DataFrame:
    """Drill-through: the payments of one agreement by due date; the filter reaches the scan."""
    return (
        state["payments"]
        .filter(F.col("agreement_id") == agreement_id)
        .select("payment_id", "due_date", "payment_date", "amount", "status")
        .orderBy("due_date")
    )


def payments_extract(state: State) -> DataFrame:
    """Payments with their city, the one reporting extract that needs a join."""
    facts = star.fact_payment(state).select(
        "location_key", "due_date", "payment_date", "amount", "status", "is_overdue"
    )
    places = star.dim_location(state).select("location_key", "city")
    return facts.join(places, "location_key").select(
        "city", "due_date", "payment_date", "amount", "status", "is_overdue"
    )


EXTRACTS: dict[str, tuple[str, ...]] = {
    "mart_occupancy": (
        "city",
        "region",
        "month_start_date",
        "occupied_property_days",
        "available_property_days",
    ),
    "mart_monthly_rental_revenue": ("city", "region", "revenue_month", "rental_revenue"),
    "mart_average_rent_per_sqm": ("city", "region", "property_count", "average_rent_per_sqm"),
    "mart_agreements_expiring_soon": (
        "agreement_id",
        "city",
        "end_date",
        "days_until_expiration",
    ),
    "mart_rental_trends_by_location": ("city", "region", "agreement_month", "average_monthly_rent"),
}
"""Columns of the reporting extracts that are plain projections of a mart."""


def extract(mart: DataFrame, name: str) -> DataFrame:
    return mart.select(*EXTRACTS[name])


def property_key(identifier: str) -> Column:
    return surrogate_key(F.lit(identifier))
