"""A cross-section of the registered queries against their SQL twins; the rest: check_catalog."""

from __future__ import annotations

import check_catalog
import pytest

import __spark_entry__ as contract
from lettings.catalog import oracle, queries

FOLDER = "/root/testdata/sf0.001"
SAMPLE = (
    "norm_locations",
    "norm_properties",
    "dedup_first_wins",
    "quarantine_rows",
    "fingerprint_properties",
    "apply_upsert",
    "scd2_property_history",
    "dim_property",
    "mart_occupancy",
    "mart_rental_trends_by_location",
    "measure_rent_trend_by_city",
    "free_house_assignment",
    "check_payment_financials",
    "legacy_q11",
    "overlapping_agreements",
)


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_sql(spark, name):
    good, note = check_catalog.compare(check_catalog.connect(FOLDER), spark, FOLDER, name)
    assert good, note


def test_every_query_has_a_twin():
    assert queries.registered().keys() == oracle.SQL.keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", ["fact_occupancy", "orphan_payments", "overlapping_agreements", "mart_occupancy"])
def test_no_pairwise_joins(spark, name):
    plan = contract.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan
    assert "Cartesian" not in plan
