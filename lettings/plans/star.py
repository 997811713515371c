"""Dimensions, facts and enriched intermediates over the accepted state.

No join carries a broadcast hint: Catalyst and AQE broadcast a dimension only when its measured
size is below the session threshold, and split skewed keys otherwise. Surrogate keys are hashes of
the natural key, so facts compute them locally and join only to test existence or to fetch
another entity's key.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettings.functions.dates import date_key, days_between, each_month, month_start
from lettings.functions.hashing import surrogate_key

State = Mapping[str, DataFrame]


def int_agreements_enriched(state: State) -> DataFrame:
    people = {
        "owner": state["owners"].select("owner_id", F.col("full_name").alias("owner_name")),
        "tenant": state["tenants"].select("tenant_id", F.col("full_name").alias("tenant_name")),
    }
    homes = state["properties"].select(
        "property_id", "owner_id", "location_id", "property_type", "bedrooms", "size_sqm", "currency"
    )
    places = state["locations"].select("location_id", "city", "region")
    # Parent-only joins first: the property side is enriched once, not once per agreement.
    homes = homes.join(places, "location_id").join(people["owner"], "owner_id")
    return (
        state["rental_agreements"]
        .join(homes, "property_id")
        .join(people["tenant"], "tenant_id")
        .select(
            "agreement_id",
            "property_id",
            "tenant_id",
            "owner_id",
            "location_id",
            "start_date",
            "end_date",
            "monthly_rent",
            "status",
            "property_type",
            "bedrooms",
            "size_sqm",
            "currency",
            "city",
            "region",
            "owner_name",
            "tenant_name",
        )
    )


def int_payments_enriched(state: State) -> DataFrame:
    agreements = int_agreements_enriched(state).select(
        "agreement_id",
        "property_id",
        "tenant_id",
        "owner_id",
        "location_id",
        "city",
        "region",
        "size_sqm",
        "monthly_rent",
    )
    payments = state["payments"].select(
        "payment_id", "agreement_id", "due_date", "payment_date", "amount", "status"
    )
    return payments.join(agreements, "agreement_id").select(
        "payment_id",
        "agreement_id",
        "property_id",
        "tenant_id",
        "owner_id",
        "location_id",
        "due_date",
        "payment_date",
        "amount",
        "status",
        "city",
        "region",
        "size_sqm",
        "monthly_rent",
    )


def calendar_bounds(state: State) -> DataFrame:
    """One row: the first and last day of any agreement."""
    return state["rental_agreements"].agg(
        F.least(F.min("start_date"), F.min("end_date")).alias("first_day"),
        F.greatest(F.max("start_date"), F.max("end_date")).alias("last_day"),
    )


def dim_date(state: State) -> DataFrame:
    """One row per calendar day; its length depends on the period, not on the data volume."""
    day = F.col("date_day")
    iso_weekday = F.weekday(day) + 1
    return (
        calendar_bounds(state)
        .select(F.explode(F.sequence("first_day", "last_day")).alias("date_day"))
        .select(
            date_key(day).alias("date_key"),
            "date_day",
            F.year(day).alias("year_number"),
            F.quarter(day).alias("quarter_number"),
            F.month(day).alias("month_number"),
            F.date_format(day, "MMMM").alias("month_name"),
            iso_weekday.alias("iso_weekday_number"),
            F.date_format(day, "EEEE").alias("weekday_name"),
            (iso_weekday >= 6).alias("is_weekend"),
            month_start(day).alias("month_start_date"),
        )
    )


def dim_location(state: State) -> DataFrame:
    return state["locations"].select(
        surrogate_key(F.col("location_id")).alias("location_key"),
        "location_id",
        "city",
        "region",
        "country_code",
    )


def _dim_person(frame: DataFrame, role: str) -> DataFrame:
    identifier = f"{role}_id"
    return frame.select(
        surrogate_key(F.col(identifier)).alias(f"{role}_key"), identifier, "full_name", "email"
    )


def dim_owner(state: State) -> DataFrame:
    return _dim_person(state["owners"], "owner")


def dim_tenant(state: State) -> DataFrame:
    return _dim_person(state["tenants"], "tenant")


def dim_property(state: State) -> DataFrame:
    places = dim_location(state).select("location_id", "location_key")
    owners = dim_owner(state).select("owner_id", "owner_key")
    return (
        state["properties"]
        .join(places, "location_id")
        .join(owners, "owner_id")
        .select(
            surrogate_key(F.col("property_id")).alias("property_key"),
            "property_id",
            "location_key",
            "owner_key",
            "property_type",
            "bedrooms",
            "size_sqm",
            "monthly_rent",
            "currency",
        )
    )


def fact_rental_agreement(state: State) -> DataFrame:
    homes = dim_property(state).select("property_id", "property_key", "location_key", "owner_key")
    tenants = dim_tenant(state).select("tenant_id", "tenant_key")
    return (
        state["rental_agreements"]
        .join(homes, "property_id")
        .join(tenants, "tenant_id")
        .select(
            surrogate_key(F.col("agreement_id")).alias("rental_agreement_key"),
            "agreement_id",
            "property_key",
            "location_key",
            "owner_key",
            "tenant_key",
            date_key(F.col("start_date")).alias("start_date_key"),
            date_key(F.col("end_date")).alias("end_date_key"),
            "start_date",
            "end_date",
            "monthly_rent",
            "status",
            days_between(F.col("start_date"), F.col("end_date")).alias("agreement_days"),
        )
    )


def _is_overdue() -> Column:
    return (F.col("payment_date") > F.col("due_date")) | (F.col("status") == "OVERDUE")


def fact_payment(state: State) -> DataFrame:
    """Payments meet agreements that already carry their property and tenant keys.

    The wide payment side is shuffled once, by agreement; the star is resolved on the smaller
    agreement side.
    """
    contracts = fact_rental_agreement(state).select(
        "agreement_id", "rental_agreement_key", "property_key", "location_key", "tenant_key"
    )
    late = F.datediff("payment_date", "due_date")
    return (
        state["payments"]
        .join(contracts, "agreement_id")
        .select(
            surrogate_key(F.col("payment_id")).alias("payment_key"),
            "payment_id",
            "rental_agreement_key",
            "property_key",
            "location_key",
            "tenant_key",
            date_key(F.col("due_date")).alias("due_date_key"),
            date_key(F.col("payment_date")).alias("payment_date_key"),
            "due_date",
            "payment_date",
            "amount",
            "status",
            F.greatest(late, F.lit(0)).alias("days_overdue"),
            _is_overdue().alias("is_overdue"),
        )
    )


DAYS_PER_TASK = 1_000_000
"""Rows of the day fact that a task may have to keep in memory."""


def day_partitions(state: State) -> int:
    """How many partitions give each task of the day fact ``DAYS_PER_TASK`` rows; one pass over two columns."""
    days = days_between(F.col("start_date"), F.col("end_date")).cast("long")
    total = state["rental_agreements"].agg(F.sum(days).alias("n")).first().n or 0
    return total // DAYS_PER_TASK + 1


OCCUPANCY_KEYS = ("rental_agreement_key", "property_key", "location_key", "tenant_key")


def _months(agreement_id: Column, start: Column, end: Column) -> Column:
    """The months an agreement touches, with what their days share: it is found once a month, not once a day."""
    first_day, last_day = F.least(start, end), F.greatest(start, end)

    def described(month: Column) -> Column:
        text = month.cast("string")
        return F.struct(
            month.alias("start"),
            F.dayofmonth(F.greatest(first_day, month)).alias("first"),
            F.dayofmonth(F.least(last_day, F.last_day(month))).alias("last"),
            date_key(month).alias("date_key"),
            F.concat(agreement_id, F.lit(":"), F.left(text, F.length(text) - 2)).alias("text"),
        )

    return F.transform(each_month(first_day, last_day), described)


def _day_columns(month: Column, day: Column) -> dict[str, Column]:
    """What the day fact says of one day of the month, besides the keys of its agreement."""
    digits = F.element_at(F.array(*[F.lit(f"{n:02d}") for n in range(1, 32)]), day)
    return {
        "occupancy_key": F.md5(F.concat(month["text"], digits)),
        "date_key": month["date_key"] + day - 1,
        "date_day": F.date_add(month["start"], day - 1),
        "occupied_day": F.lit(1),
    }


def fact_occupancy(state: State, partitions: int | None = None, by_agreement: bool = False) -> DataFrame:
    """One row per agreement day, or one per agreement with its days in arrays.

    Every day of an agreement lies inside the calendar by definition of its bounds, so the range
    join with the calendar is a plain expansion of each agreement. An agreement becomes hundreds
    of rows, so the narrow input is first spread over all shuffle partitions (an explicit number
    keeps AQE from merging them by their size before the expansion), or over ``partitions``. All days
    of an agreement stay in one partition by its key, so grouping by it shuffles no day. With
    ``by_agreement`` the columns of a day are arrays and the keys of a row are unique: days that are to be
    grouped by agreement need not be sorted or hashed to be put together again.
    """
    start, end = F.col("start_date"), F.col("end_date")
    agreements = fact_rental_agreement(state).filter(start.isNotNull() & end.isNotNull())
    partitions = partitions or int(agreements.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = agreements.select("agreement_id", *OCCUPANCY_KEYS, "start_date", "end_date").repartition(
        partitions, "rental_agreement_key"
    )
    months, month, day = _months(F.col("agreement_id"), start, end), F.col("_month"), F.col("_day")
    if by_agreement:
        grouped = spread.groupBy(*OCCUPANCY_KEYS).agg(F.flatten(F.collect_list(months)).alias("_months"))

        def listed(name: str) -> Column:
            return F.flatten(
                F.transform(
                    "_months",
                    lambda m: F.transform(F.sequence(m["first"], m["last"]), lambda d: _day_columns(m, d)[name]),
                )
            ).alias(name)

        return grouped.select(*OCCUPANCY_KEYS, *[listed(name) for name in _day_columns(month, day)])
    days = spread.select(*OCCUPANCY_KEYS, F.explode(months).alias("_month")).withColumn(
        "_day", F.explode(F.sequence("_month.first", "_month.last"))
    )
    columns = {name: column.alias(name) for name, column in _day_columns(month, day).items()}
    key = columns.pop("occupancy_key")
    return days.select(key, *OCCUPANCY_KEYS, *columns.values())


MODELS = {
    "int_agreements_enriched": int_agreements_enriched,
    "int_payments_enriched": int_payments_enriched,
    "dim_date": dim_date,
    "dim_location": dim_location,
    "dim_owner": dim_owner,
    "dim_tenant": dim_tenant,
    "dim_property": dim_property,
    "fact_rental_agreement": fact_rental_agreement,
    "fact_payment": fact_payment,
    "fact_occupancy": fact_occupancy,
}
