"""The thirteen questions and the adjustments on the nine-person seed."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from lettings.plans import adjustments, legacy

# The seed rows of the older schema.
PERSONS = [
    (12345678901, "Jan", "Kowalski"),
    (23456789012, "Anna", "Nowak"),
    (34567890123, "Piotr", "Wiśniewski"),
    (45678901234, "Kasia", "Zielińska"),
    (56789012345, "Marek", "Więckowski"),
    (67890123456, "Adam", "Nowak"),
    (78901234567, "Ewa", "Kowalska"),
    (89012345678, "Tomasz", "Lewandowski"),
    (90123456789, "Barbara", "Wiśniewska"),
]
OWNERS = [(12345678901, 10), (23456789012, 5), (67890123456, 8), (78901234567, 12)]
TENANTS = [(34567890123, "Praca"), (45678901234, "Studia"), (89012345678, "Rodzina"), (90123456789, "Biznes")]
AGENTS = [(56789012345, "Best Estates")]
SPACES = [
    (1, 1000, "Warszawa", 12345678901),
    (2, 750, "Kraków", 12345678901),
    (3, 500, "Poznań", 23456789012),
    (4, 800, "Gdańsk", 67890123456),
    (5, 600, "Łódź", 78901234567),
]
HOUSES = [
    (1, 1, 200, 2, "Y", 500, 1000000),
    (2, 2, 150, 1, "N", 300, 750000),
    (3, 4, 300, 3, "Y", 400, 1200000),
    (4, 5, 250, 2, "N", 350, 800000),
]
AGREEMENTS = [
    (1, 2500, date(2024, 1, 1), date(2024, 12, 31), 34567890123, None, 1),
    (2, 2000, date(2023, 6, 1), date(2023, 12, 31), 45678901234, 56789012345, 2),
    (3, 3000, date(2024, 2, 1), date(2024, 12, 31), 89012345678, 56789012345, 3),
    (4, 2800, date(2023, 3, 1), date(2024, 3, 31), 90123456789, 56789012345, 4),
]
SCHEMAS = {
    "person": "person_no long, first_name string, last_name string",
    "owner": "person_no long, years int",
    "tenant": "person_no long, reason string",
    "agent": "person_no long, firm string",
    "space": "space_id long, area int, city string, owner_no long",
    "house": "house_id long, space_id long, area int, floors int, garage string, upkeep int, market_price int",
    "agreement": "agreement_id long, rent int, start_date date, end_date date, tenant_no long, agent_no long, house_id long",
}


@pytest.fixture(scope="module")
def tables(spark):
    rows = (PERSONS, OWNERS, TENANTS, AGENTS, SPACES, HOUSES, AGREEMENTS)
    return {name: spark.createDataFrame(data, SCHEMAS[name]) for name, data in zip(SCHEMAS, rows, strict=True)}


def found(frame):
    return sorted(tuple(row) for row in frame.collect())


def test_questions(tables):
    jan = ("Jan", "Kowalski", 10)
    assert found(legacy.owners_of_large_spaces(tables)) == sorted(
        [jan, jan, ("Anna", "Nowak", 5), ("Adam", "Nowak", 8), ("Ewa", "Kowalska", 12)]
    )
    assert found(legacy.spaces_of_experienced_owners(tables)) == [(5, "Łódź")]
    assert found(legacy.surnames_with_one_space(tables)) == [("Kowalska",)]
    assert found(legacy.busy_firms(tables)) == []
    assert found(legacy.busy_firms(tables, 2)) == [("Best Estates",)]
    assert found(legacy.tenants_busier_than_suffix(tables)) == []
    assert [row[0] for row in found(legacy.spaces_above_mean_rent(tables))] == [4, 5]
    assert [row[0] for row in found(legacy.agreements_above_city_mean(tables))] == [3, 4]
    assert len(found(legacy.tenants_who_own_nothing(tables))) == 4
    assert found(legacy.owners_above_mean_area(tables)) == [("Adam", "Nowak"), ("Jan", "Kowalski")]
    assert found(legacy.tenants_above_mean_rent(tables)) == [
        ("Barbara", "Wiśniewska"), ("Tomasz", "Lewandowski"),
    ]
    assert [row[0] for row in found(legacy.dearest_agreements_per_owner(tables))] == [1, 3, 4]
    assert found(legacy.houses_above_surname(tables)) == []
    assert found(legacy.tenants_busier_than_large_owners(tables)) == []


def rents(frame):
    return {row.agreement_id: (float(row.rent), row.action) for row in frame.collect()}


def test_adjustments(tables):
    agreements, houses, spaces = tables["agreement"], tables["house"], tables["space"]
    raised = adjustments.raise_rents_in_range(
        agreements, houses, start_from=F.lit(date(2024, 1, 1)), start_to=F.lit(date(2024, 12, 31)),
        percent=10, upkeep_below=450, as_of=F.lit(date(2024, 6, 1)),
    )
    assert rents(raised)[3] == (3300.0, "RENT_RAISED")
    assert rents(raised)[1] == (2500.0, None)
    bonus = adjustments.bonus_owner(
        houses, spaces, tables["person"], tables["owner"], first_name="Jan", last_name="Kowalski"
    )
    assert {r.house_id: float(r.market_price) for r in bonus.filter("action is not null").collect()} == {
        1: 1020000.0, 2: 765000.0,
    }
    cheaper = adjustments.bonus_tenant(
        agreements, tables["person"], tables["tenant"], first_name="Kasia", last_name="Zielińska"
    )
    assert rents(cheaper)[2] == (1800.0, "TENANT_BONUS")
    corrected = rents(adjustments.city_price_correction(agreements, houses, spaces))
    assert corrected[2] == (2200.0, "CITY_CORRECTION")
    assert corrected[1] == (2500.0, None)
    only = rents(adjustments.city_price_correction(agreements, houses, spaces, city="Gdańsk"))
    assert all(action is None for _, action in only.values())
    extended = adjustments.extend_agent_agreements(
        agreements, agent_no=56789012345, months=2, amount=100
    )
    ends = {row.agreement_id: (row.end_date, float(row.rent), row.action) for row in extended.collect()}
    assert ends[4] == (date(2024, 5, 31), 2900.0, "EXTENDED")
    assert ends[2] == (date(2024, 2, 29), 2100.0, "EXTENDED")
    assert ends[1][2] is None
    after = houses.withColumn("upkeep", F.when(F.col("house_id") == 1, 1200).otherwise(F.col("upkeep")))
    assert rents(adjustments.upkeep_shock(agreements, houses, after))[1] == (2625.0, "UPKEEP_SHOCK")
    requests = agreements.withColumn("end_date", F.date_add("start_date", 10)).withColumn("rent", F.lit(500))
    clamped = adjustments.clamp_agreement_terms(requests, houses, spaces, favoured_city="Warszawa")
    terms = {row.agreement_id: ((row.end_date - row.start_date).days, float(row.rent)) for row in clamped.collect()}
    assert terms == {1: (60, 1000.0), 2: (30, 1000.0), 3: (30, 1000.0), 4: (30, 1000.0)}
