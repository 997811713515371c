"""Rent adjustments and assignment rules as batch transforms.

Every transform returns the whole adjusted table with an ``action`` column that says what happened
to a row (NULL: nothing). Prices are ``decimal(12,2)`` and are not truncated to integers. "Today"
is always the ``as_of`` argument.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettings import session
from lettings.functions.dates import add_months_sticky
from lettings.operators.intervals import (
    conflict_counts,
    first_fitting,
    free_gaps,
    granted_chain,
)
from lettings.operators.ranking import SMALL, earlier_total, position

MONEY = "decimal(12,2)"

# The terms every agreement is clamped to.
MIN_DAYS, MAX_DAYS, MIN_RENT, EXTRA_DAYS = 30, 1095, 1000, 30


def _adjust(frame: DataFrame, column: str, when: Column, new: Column, action: str) -> DataFrame:
    hit = F.coalesce(when, F.lit(False))
    return frame.withColumns(
        {
            column: F.when(hit, new.cast(MONEY)).otherwise(F.col(column).cast(MONEY)),
            "action": F.when(hit, F.lit(action)),
        }
    )


def raise_rents_in_range(
    agreements: DataFrame,
    houses: DataFrame,
    *,
    start_from: Column,
    start_to: Column,
    percent: int,
    upkeep_below: int,
    as_of: Column,
) -> DataFrame:
    """Raise rents of agreements started in the range, still open, in houses cheap to keep."""
    upkeep = houses.select("house_id", F.col("upkeep").alias("_upkeep"))
    hit = (
        F.col("start_date").between(start_from, start_to)
        & (F.col("end_date") > as_of)
        & (F.col("_upkeep") < upkeep_below)
    )
    rent = F.col("rent") + F.col("rent") * percent / 100
    return _adjust(
        agreements.join(upkeep, "house_id", "left"), "rent", hit, rent, "RENT_RAISED"
    ).select(*agreements.columns, "action")


def _people(persons: DataFrame, role: DataFrame, first: str, last: str, name: str) -> DataFrame:
    named = persons.filter((F.col("first_name") == first) & (F.col("last_name") == last))
    return named.join(role, "person_no", "left_semi").select(F.col("person_no").alias(name))


def bonus_owner(
    houses: DataFrame,
    spaces: DataFrame,
    persons: DataFrame,
    owners: DataFrame,
    *,
    first_name: str,
    last_name: str,
) -> DataFrame:
    """Market price of the person's houses up by 2 %, if the person is an owner."""
    people = _people(persons, owners, first_name, last_name, "owner_no")
    theirs = spaces.join(people, "owner_no", "left_semi").select(
        "space_id", F.lit(True).alias("_hit")
    )
    return _adjust(
        houses.join(theirs, "space_id", "left"),
        "market_price",
        F.col("_hit"),
        F.col("market_price") * F.lit("1.02").cast("decimal(3,2)"),
        "OWNER_BONUS",
    ).select(*houses.columns, "action")


def bonus_tenant(
    agreements: DataFrame,
    persons: DataFrame,
    tenants: DataFrame,
    *,
    first_name: str,
    last_name: str,
) -> DataFrame:
    """Rents of the person's agreements down by 10 %, if the person is a tenant."""
    people = _people(persons, tenants, first_name, last_name, "tenant_no")
    return _adjust(
        agreements.join(people.withColumn("_hit", F.lit(True)), "tenant_no", "left"),
        "rent",
        F.col("_hit"),
        F.col("rent") * F.lit("0.90").cast("decimal(3,2)"),
        "TENANT_BONUS",
    ).select(*agreements.columns, "action")


def city_price_correction(
    agreements: DataFrame, houses: DataFrame, spaces: DataFrame, *, city: str | None = None
) -> DataFrame:
    """Lift rents in cities whose mean lies well below the overall mean.

    Below 75 % of it by a fifth, below 85 % by a tenth, both strict. All cities at once, or one.
    """
    homes = houses.select("house_id", "space_id").join(
        spaces.select("space_id", "city"), "space_id"
    )
    placed = agreements.join(homes.select("house_id", "city"), "house_id", "left")
    exact = F.col("rent").cast("decimal(24,12)")
    overall = agreements.agg(F.avg(exact).alias("m")).scalar()
    mean = F.col("_mean")
    factor = F.when(mean < overall * F.lit("0.75").cast("decimal(3,2)"), F.lit("1.20")).when(
        mean < overall * F.lit("0.85").cast("decimal(3,2)"), F.lit("1.10")
    )
    local = (
        placed.filter(F.col("city").isNotNull() if city is None else F.col("city") == city)
        .groupBy("city")
        .agg(F.avg(exact).alias("_mean"))
        .select("city", factor.cast("decimal(3,2)").alias("_factor"))
    )
    raised = F.col("_factor")
    return _adjust(
        placed.join(local, "city", "left"),
        "rent",
        raised.isNotNull(),
        F.col("rent") * raised,
        "CITY_CORRECTION",
    ).select(*agreements.columns, "action")


def extend_agent_agreements(
    agreements: DataFrame, *, agent_no: int, months: int, amount: int, min_months: int = 4
) -> DataFrame:
    """Extend an agent's agreements that last long enough and add an amount to the rent."""
    mine = F.coalesce(F.col("agent_no") == agent_no, F.lit(False))
    long_enough = F.months_between("end_date", "start_date") >= min_months
    hit = mine & long_enough
    return agreements.withColumns(
        {
            "rent": F.when(hit, (F.col("rent") + amount).cast(MONEY)).otherwise(
                F.col("rent").cast(MONEY)
            ),
            "end_date": F.when(hit, add_months_sticky(F.col("end_date"), months)).otherwise(
                F.col("end_date")
            ),
            "action": F.when(hit, F.lit("EXTENDED")).when(mine, F.lit("TOO_SHORT")),
        }
    )


def upkeep_shock(
    agreements: DataFrame, before: DataFrame, after: DataFrame, *, limit: int = 1000
) -> DataFrame:
    """Raise rents by 5 % in houses whose upkeep changed and now exceeds the limit."""
    changed = (
        after.select("house_id", F.col("upkeep").alias("_new"))
        .join(before.select("house_id", F.col("upkeep").alias("_old")), "house_id")
        .filter((F.col("_new") > limit) & (F.col("_new") != F.col("_old")))
        .select("house_id", F.lit(True).alias("_hit"))
    )
    return _adjust(
        agreements.join(changed, "house_id", "left"),
        "rent",
        F.col("_hit"),
        F.col("rent") * F.lit("1.05").cast("decimal(3,2)"),
        "UPKEEP_SHOCK",
    ).select(*agreements.columns, "action")


def reassign_agent(
    agreements: DataFrame,
    agents: DataFrame,
    released: DataFrame,
    *,
    as_of: Column,
    buckets: int = 1024,
    small: int = SMALL,
) -> DataFrame:
    """Give agents left without an active agreement one from a colleague of the same firm.

    ``released`` has the ``agent_no`` of deleted or updated agreements. A colleague gives while
    more than one active agreement remains. Per firm the needy agents (by number) meet the
    agreements on offer (by colleague, then agreement) at equal positions, so nothing is given
    twice. Positions come from bucketed running totals; one firm or one agent may hold a large
    share of all rows.
    """
    active = agreements.filter((F.col("end_date") > as_of) & F.col("agent_no").isNotNull())
    load = active.groupBy("agent_no").agg(F.count(F.lit(1)).alias("_load"))
    firms = agents.select(F.col("person_no").alias("agent_no"), "firm")
    needy = (
        released.filter(F.col("agent_no").isNotNull())
        .select("agent_no")
        .distinct()
        .join(load, "agent_no", "left_anti")
        .join(firms, "agent_no")
    )
    donors = (
        load.filter("_load > 1")
        .join(firms, "agent_no")
        .join(needy.select("firm").distinct(), "firm", "left_semi")
        .select("agent_no", "firm", (F.col("_load") - 1).alias("_spare"))
    )
    offered = earlier_total(
        donors, ["firm"], "agent_no", F.col("_spare"), "_before", buckets=buckets, small=small
    )
    listed = position(
        active.select("agent_no", "agreement_id").join(
            donors.select("agent_no"), "agent_no", "left_semi"
        ),
        ["agent_no"],
        "agreement_id",
        "_mine",
        buckets=buckets,
        small=small,
    )
    on_offer = (
        listed.join(offered, "agent_no")
        .filter(F.col("_mine") < F.col("_spare"))
        .select("firm", (F.col("_before") + F.col("_mine")).alias("_place"), "agreement_id")
    )
    waiting = position(
        needy, ["firm"], "agent_no", "_place", buckets=buckets, small=small
    ).select("firm", "_place", F.col("agent_no").alias("_taker"))
    moves = on_offer.join(waiting, ["firm", "_place"]).select("agreement_id", "_taker")
    return agreements.join(moves, "agreement_id", "left").select(
        *[
            F.coalesce("_taker", "agent_no").alias(name) if name == "agent_no" else F.col(name)
            for name in agreements.columns
        ],
        F.when(F.col("_taker").isNotNull(), F.lit("REASSIGNED")).alias("action"),
    )


def clamp_agreement_terms(
    agreements: DataFrame, houses: DataFrame, spaces: DataFrame, *, favoured_city: str
) -> DataFrame:
    """Term at least 30 and at most 1095 days, rent at least 1000, 30 days more in one city."""
    homes = houses.select("house_id", "space_id").join(
        spaces.select("space_id", F.col("city").alias("_city")), "space_id"
    )
    latest = F.date_add("start_date", MAX_DAYS)
    term = F.least(F.greatest("end_date", F.date_add("start_date", MIN_DAYS)), latest)
    favoured = F.coalesce(F.col("_city") == favoured_city, F.lit(False))
    end = F.when(favoured, F.least(F.date_add(term, EXTRA_DAYS), latest)).otherwise(term)
    rent = F.greatest(F.col("rent").cast(MONEY), F.lit(MIN_RENT).cast(MONEY))
    changes = F.array_compact(
        F.array(
            F.when(end != F.col("end_date"), F.lit("END_DATE")),
            F.when(rent != F.col("rent"), F.lit("RENT")),
        )
    )
    placed = agreements.join(homes.select("house_id", "_city"), "house_id", "left")
    return placed.select(
        *[
            {"end_date": end.alias("end_date"), "rent": rent.alias("rent")}.get(name, F.col(name))
            for name in agreements.columns
        ],
        F.nullif(F.array_join(changes, "+"), F.lit("")).alias("action"),
    )


def _closed(agreements: DataFrame, as_of: Column) -> DataFrame:
    """An open end counts as tomorrow."""
    return agreements.withColumn("end_date", F.coalesce("end_date", F.date_add(as_of, 1)))


def overlapping_agreements(agreements: DataFrame, *, as_of: Column) -> DataFrame:
    """Agreements that share a day with another agreement of the same house, with the count."""
    bounded = _closed(agreements, as_of).select(
        "agreement_id", "house_id", "start_date", "end_date"
    )
    counted = conflict_counts(bounded, bounded, "house_id")
    return counted.withColumn("conflicts", F.col("conflicts") - 1).filter("conflicts > 0")


def free_house_assignment(
    requests: DataFrame, stored: DataFrame, houses: DataFrame, *, as_of: Column
) -> DataFrame:
    """Judge requested agreements against stored ones and each other; all get a verdict.

    ``placement`` is KEPT (own house), MOVED (to the first free house of the same space) or REJECTED
    (no house of the space is free). In a wave every open request asks for its own house if that is
    free and for the first free one of its space otherwise, and each house serves those that ask by
    start and then id. Whoever overlaps a granted request asks again in the next wave, when that house
    is taken; so waves are bounded by the houses of a space, however many requests fight for one.
    A wave looks at the spaces with open requests only, and there at bookings that do not end before
    the first of these requests starts. What a wave hands on is written to the shared folder.
    """
    homes = houses.select("house_id", "space_id")
    booked = _closed(stored, as_of).select("house_id", "start_date", "end_date")
    waiting = session.stored(requests.select("agreement_id", "house_id", "start_date", "end_date"), "requests")
    settled: list[DataFrame] = []
    while True:
        # Only spaces that still have open requests matter, and they become fewer.
        spaces = (
            waiting.groupBy("house_id")
            .agg(F.min("start_date").alias("_from"))
            .join(homes, "house_id")
            .groupBy("space_id")
            .agg(F.min("_from").alias("_from"))
        )
        open_homes = session.stored(homes.join(spaces, "space_id").select("house_id", "space_id", "_from"), "homes")
        near = (booked["house_id"] == open_homes["house_id"]) & (booked["end_date"] >= open_homes["_from"])
        homes = open_homes.select("house_id", "space_id")
        booked = session.stored(booked.join(open_homes, near, "left_semi"), "booked")
        judged = session.stored(_wave(waiting, booked, homes, first=not settled), "judged")
        settled.append(judged.filter("placement is not null"))
        again = judged.filter("placement is null")
        if again.isEmpty():
            return reduce(DataFrame.unionByName, settled)
        granted = judged.filter("placement in ('KEPT', 'MOVED')").select(*booked.columns)
        booked = booked.unionByName(granted)
        waiting = again.select(
            "agreement_id", F.col("requested_house").alias("house_id"), "start_date", "end_date"
        )


def _wave(waiting: DataFrame, booked: DataFrame, houses: DataFrame, *, first: bool) -> DataFrame:
    """One wave of requests; ``placement`` is NULL for those that have to ask again.

    Conflicts are counted in the first wave only. Who asks again has lost the own house, to a booking or to
    the request granted before it; a house that is not listed has no bookings to count.
    """
    space = houses.select("house_id", "space_id")
    if first:
        counted = session.stored(conflict_counts(waiting, booked, "house_id"), "counted")
        taken, untaken = counted.filter("conflicts > 0"), counted.filter("conflicts = 0")
    else:
        taken, untaken = waiting, waiting.join(space.select("house_id"), "house_id", "left_anti")
    days = {"day_from": F.unix_date("start_date"), "day_to": F.unix_date("end_date")}
    blocked = taken.join(space, "house_id").withColumns(days)
    gaps = free_gaps(space.select("house_id"), booked, "house_id").join(space, "house_id")
    found = first_fitting(
        blocked,
        gaps.withColumnRenamed("house_id", "_free"),
        "space_id",
        "_free",
        horizon=taken.select(*[day.alias(name) for name, day in days.items()]),
    )
    columns = waiting.columns
    moved = blocked.join(found, ["space_id", "day_from", "day_to"], "left").select(*columns, "_free")
    kept = untaken.select(*columns, F.col("house_id").alias("_free"))
    asked = session.stored(moved.unionByName(kept), "asked")
    wanted = asked.filter(F.col("_free").isNotNull()).select(
        F.col("_free").alias("_house"), "agreement_id", "start_date", "end_date"
    )
    granted = granted_chain(wanted, "_house", "agreement_id").withColumn("_granted", F.lit(True))
    free = F.col("_free")
    return asked.join(granted, "agreement_id", "left").select(
        "agreement_id",
        F.col("house_id").alias("requested_house"),
        F.when(F.col("_granted"), free).alias("house_id"),
        "start_date",
        "end_date",
        F.when(free.isNull(), F.lit("REJECTED"))
        .when(F.col("_granted") & (free == F.col("house_id")), F.lit("KEPT"))
        .when(F.col("_granted"), F.lit("MOVED"))
        .alias("placement"),
    )
