"""The thirteen analytical questions over the older relational schema.

Tables: person(person_no, first_name, last_name), owner(person_no, years),
tenant(person_no, reason), agent(person_no, firm), space(space_id, area, city, owner_no),
house(house_id, space_id, area, floors, garage, upkeep, market_price),
agreement(agreement_id, rent, start_date, end_date, tenant_no, agent_no, house_id).

Means are exact (no integer truncation). Thresholds and names are parameters. Comparisons with a
global figure use scalar subqueries.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Tables = Mapping[str, DataFrame]


def _mean(column: str) -> Column:
    return F.avg(F.col(column).cast("decimal(24,12)"))


def _owned_spaces(tables: Tables) -> DataFrame:
    return tables["owner"].join(
        tables["space"].withColumnRenamed("owner_no", "person_no"), "person_no"
    )


def _agreement_places(tables: Tables) -> DataFrame:
    """Agreements with the space, city and owner of their house."""
    homes = tables["house"].select("house_id", "space_id").join(
        tables["space"].select("space_id", "city", "owner_no", F.col("area").alias("space_area")),
        "space_id",
    )
    return tables["agreement"].join(homes, "house_id")


def _named_tenants(tables: Tables) -> DataFrame:
    return tables["tenant"].select("person_no").join(tables["person"], "person_no")


def _tenant_agreements(tables: Tables) -> DataFrame:
    return _named_tenants(tables).join(
        tables["agreement"].withColumnRenamed("tenant_no", "person_no"), "person_no"
    )


def owners_of_large_spaces(tables: Tables, area: int = 100) -> DataFrame:
    """One row per space, not per owner."""
    large = _owned_spaces(tables).filter(F.col("area") > area)
    return large.join(tables["person"], "person_no").select("first_name", "last_name", "years")


def spaces_of_experienced_owners(tables: Tables, years: int = 10) -> DataFrame:
    return _owned_spaces(tables).filter(F.col("years") > years).select("space_id", "city")


def surnames_with_one_space(tables: Tables) -> DataFrame:
    """Grouped by surname, so namesakes count together."""
    return (
        _owned_spaces(tables)
        .join(tables["person"], "person_no")
        .groupBy("last_name")
        .agg(F.count("space_id").alias("spaces"))
        .filter("spaces = 1")
        .select("last_name")
    )


def busy_firms(tables: Tables, agreements: int = 5) -> DataFrame:
    per_agent = tables["agreement"].groupBy(F.col("agent_no").alias("person_no")).agg(
        F.count("agreement_id").alias("n")
    )
    return (
        tables["agent"]
        .join(per_agent, "person_no")
        .groupBy("firm")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") > agreements)
        .select("firm")
    )


def tenants_busier_than_suffix(
    tables: Tables, suffix: str = "56789", mean_rent: int = 2000
) -> DataFrame:
    peers = tables["tenant"].filter(F.col("person_no").cast("string").endswith(suffix))
    theirs = tables["agreement"].join(
        peers.select(F.col("person_no").alias("tenant_no")), "tenant_no", "left_semi"
    )
    limit = theirs.agg(F.count("agreement_id").alias("n")).scalar()
    return (
        _tenant_agreements(tables)
        .groupBy("person_no", "first_name", "last_name")
        .agg(F.count("agreement_id").alias("n"), _mean("rent").alias("mean_rent"))
        .filter((F.col("n") > limit) & (F.col("mean_rent") > mean_rent))
        .select("first_name", "last_name")
    )


def spaces_above_mean_rent(tables: Tables) -> DataFrame:
    """One row per agreement above the overall mean."""
    mean = tables["agreement"].agg(_mean("rent").alias("m")).scalar()
    dear = tables["agreement"].filter(F.col("rent") > mean).select("house_id")
    homes = tables["house"].select("house_id", "space_id")
    return (
        dear.join(homes, "house_id")
        .join(tables["space"], "space_id")
        .select("space_id", "area", "city", "owner_no")
    )


def agreements_above_city_mean(tables: Tables, city: str = "Warszawa") -> DataFrame:
    local = _agreement_places(tables).filter(F.col("city") == city)
    mean = local.agg(_mean("rent").alias("m")).scalar()
    homes = tables["house"].select("house_id", "space_id").join(
        tables["space"].select("space_id"), "space_id", "left_semi"
    )
    return (
        tables["agreement"]
        .filter(F.col("rent") > mean)
        .join(homes.select("house_id"), "house_id", "left_semi")
    )


def tenants_who_own_nothing(tables: Tables) -> DataFrame:
    return (
        _named_tenants(tables)
        .join(tables["owner"], "person_no", "left_anti")
        .select("first_name", "last_name")
    )


def owners_above_mean_area(tables: Tables) -> DataFrame:
    mean = tables["space"].agg(_mean("area").alias("m")).scalar()
    return (
        _owned_spaces(tables)
        .join(tables["person"], "person_no")
        .groupBy("first_name", "last_name")
        .agg(F.max("area").alias("largest"))
        .filter(F.col("largest") > mean)
        .select("first_name", "last_name")
    )


def tenants_above_mean_rent(tables: Tables) -> DataFrame:
    mean = tables["agreement"].agg(_mean("rent").alias("m")).scalar()
    return (
        _tenant_agreements(tables)
        .groupBy("first_name", "last_name")
        .agg(_mean("rent").alias("mean_rent"))
        .filter(F.col("mean_rent") > mean)
        .select("first_name", "last_name")
    )


def dearest_agreements_per_owner(tables: Tables) -> DataFrame:
    """Aggregate and join back rather than a window: a large owner stays splittable."""
    placed = _agreement_places(tables)
    dearest = placed.groupBy("owner_no").agg(F.max("rent").alias("rent"))
    return placed.join(dearest, ["owner_no", "rent"], "left_semi").select(
        *tables["agreement"].columns
    )


def houses_above_surname(tables: Tables, last_name: str = "Nowak") -> DataFrame:
    """No house of that surname means no rows."""
    named = tables["person"].filter(F.col("last_name") == last_name)
    owners = tables["owner"].join(named, "person_no", "left_semi").select(
        F.col("person_no").alias("owner_no")
    )
    spaces = tables["space"].join(owners, "owner_no", "left_semi").select("space_id")
    limit = tables["house"].join(spaces, "space_id", "left_semi").agg(
        F.max("market_price").alias("m")
    )
    placed = tables["house"].join(tables["space"].select("space_id"), "space_id", "left_semi")
    return placed.filter(F.col("market_price") > limit.scalar()).select(*tables["house"].columns)


def tenants_busier_than_large_owners(tables: Tables, area: int = 300) -> DataFrame:
    per_owner = (
        _agreement_places(tables)
        .filter(F.col("space_area") > area)
        .withColumnRenamed("owner_no", "person_no")
        .join(tables["owner"].select("person_no"), "person_no")
        .groupBy("person_no")
        .agg(F.count("agreement_id").alias("n"))
    )
    limit = per_owner.agg(_mean("n").alias("m")).scalar()
    return (
        _tenant_agreements(tables)
        .groupBy("first_name", "last_name")
        .agg(F.count("agreement_id").alias("n"))
        .filter(F.col("n") > limit)
        .select("first_name", "last_name")
    )
