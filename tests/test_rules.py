from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import extracts
import pytest
from pyspark.sql import functions as F

from lettings.functions import casts, text
from lettings.model import BatchRejected
from lettings.operators import quality, rules


def one(spark, value, build):
    return spark.createDataFrame([(value,)], "v string").select(build(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(
    ("value", "expected"),
    [("  a b\t", "a b"), (" x　", "x"), ("plain", "plain"), (" \n", ""), ("", ""), ("ż ", "ż")],
)
def test_strip(spark, value, expected):
    assert one(spark, value, text.strip) == expected


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ("WARSAW", "Warsaw"),
        ("o'neil-smith", "O'Neil-Smith"),
        ("łódź 2nd ulica", "Łódź 2Nd Ulica"),
        ("lesser poland", "Lesser Poland"),
    ],
)
def test_title_case_equals_python(spark, value, expected):
    assert value.title() == expected
    assert one(spark, value, text.title_case) == expected


@pytest.mark.parametrize(
    ("value", "expected"),
    [("3", 3), ("+3", 3), ("-2", -2), ("1_000", 1000), ("3.0", None), ("x", None), ("99999999999", None)],
)
def test_integers(spark, value, expected):
    assert one(spark, value, casts.to_integer) == expected
    assert one(spark, value, casts.integer_shaped) == (value not in ("3.0", "x"))


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ("2.345", "2.34"),
        ("2.355", "2.36"),
        ("1e3", "1000.00"),
        (".5", "0.50"),
        ("-100.00", "-100.00"),
        ("NaN", None),
        ("Infinity", None),
        ("abc", None),
        ("123456789012345678901234.5", "123456789012345678901234.50"),
    ],
)
def test_decimals_round_half_even(spark, value, expected):
    assert one(spark, value, casts.to_cents) == (Decimal(expected) if expected else None)


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ("2024-02-29", date(2024, 2, 29)),
        ("20240229", date(2024, 2, 29)),
        ("2024-02-30", None),
        ("2024", None),
        ("2024-1-5", None),
        ("2024-01-05T10:00", None),
        ("not-a-date", None),
    ],
)
def test_dates(spark, value, expected):
    assert one(spark, value, casts.to_date) == expected


@pytest.mark.parametrize(
    ("value", "seconds"),
    [
        ("2024-01-01T00:00:00Z", 1704067200),
        ("2024-01-01T02:00:00+02:00", 1704067200),
        ("2024-01-01T02:00+0200", 1704067200),
        ("2024-01-01 00:00:00.5-01:00", 1704070800),
        ("2024-01-01T00:00:00", None),
        ("yesterday", None),
    ],
)
def test_instants_need_an_offset(spark, value, seconds):
    assert one(spark, value, lambda v: F.unix_seconds(casts.to_instant(v))) == seconds


RULES = [
    ("properties", "property_id", "", "MISSING_REQUIRED_FIELD"),
    ("properties", "size_sqm", "-3.5", "INVALID_PROPERTY_SIZE"),
    ("properties", "size_sqm", "1000.01", "INVALID_PROPERTY_SIZE"),
    ("properties", "size_sqm", "big", "INVALID_DECIMAL"),
    ("properties", "monthly_rent", "-0.01", "INVALID_RENT"),
    ("properties", "bedrooms", "2.5", "INVALID_INTEGER"),
    ("properties", "bedrooms", "99999999999", "INVALID_BEDROOM_COUNT"),
    ("properties", "property_type", "castle", "INVALID_PROPERTY_TYPE"),
    ("properties", "currency", "GBP", "INVALID_CURRENCY"),
    ("properties", "owner_id", "NOBODY", "ORPHAN_OWNER"),
    ("properties", "location_id", "NOWHERE", "ORPHAN_LOCATION"),
    ("locations", "country_code", "POL", "INVALID_COUNTRY_CODE"),
    ("owners", "email", "nobody", "INVALID_EMAIL"),
    ("tenants", "source_timestamp", "2024-01-01T00:00:00", "INVALID_SOURCE_TIMESTAMP"),
    ("rental_agreements", "end_date", "2022-12-31", "INVALID_AGREEMENT_RANGE"),
    ("rental_agreements", "start_date", "soon", "INVALID_DATE"),
    ("rental_agreements", "status", "paused", "INVALID_AGREEMENT_STATUS"),
    ("rental_agreements", "tenant_id", "NOBODY", "ORPHAN_TENANT"),
    ("payments", "payment_date", "31.12.2023", "INVALID_DATE"),
    ("payments", "amount", "1000000.01", "INVALID_PAYMENT_AMOUNT"),
    ("payments", "status", "maybe", "INVALID_PAYMENT_STATUS"),
    ("payments", "agreement_id", "NONE", "ORPHAN_AGREEMENT"),
    ("payments", "due_date", "2031-11-11", "PAYMENT_DUE_OUTSIDE_AGREEMENT"),
]


def test_each_rule_gives_its_reason(spark):
    """One batch breaks every rule, each in its own copy of the second record of an entity."""
    data = extracts.rows(6)
    for number, (entity, field, value, _) in enumerate(RULES):
        bad = dict(data[entity][1])
        bad[list(bad)[0]] = f"X{number}"
        bad[field] = value
        data[entity].append(bad)
    batch = extracts.frames(spark, data)
    parts = quality.assess(batch, batch_id="b", processed_at=F.current_timestamp())
    found = {
        (row.record_type, row.source_identifier): row.reason_code
        for row in quality.all_rejected(parts).collect()
    }
    for number, (entity, field, _, code) in enumerate(RULES):
        name = f"X{number}"
        if field == list(data[entity][0])[0]:
            name = f"row-{len(data[entity]) - sum(1 for e, *_ in RULES[number + 1:] if e == entity)}"
        assert found.pop((entity, name)) == code
    assert not found


def test_missing_fields_are_all_named(spark):
    data = extracts.rows(1)
    data["tenants"][0].update(full_name=" ", email=None)
    judged = rules.judge("tenants", extracts.frames(spark, data)["tenants"]).first()
    assert judged.reason.explanation == "required value(s) missing: full_name, email"


def test_strict_mode_lists_five_issues_and_does_not_cascade(spark):
    data = extracts.rows(8)
    for record in data["properties"][:6]:
        record["owner_id"] = "NOBODY"
    with pytest.raises(BatchRejected) as caught:
        quality.require_valid(extracts.frames(spark, data))
    assert caught.value.total == 6
    assert str(caught.value).count("ORPHAN_OWNER") == 5
    assert str(caught.value).startswith("6 invalid")
    clean = quality.require_valid(extracts.frames(spark, extracts.rows(2)))
    assert clean["payments"].count() == 6


def test_strict_mode_reports_an_absent_entity(spark):
    batch = extracts.frames(spark, extracts.rows(1))
    del batch["owners"]
    codes = {row.code for row in quality.strict_issues(batch).collect()}
    assert codes == {"MISSING_ENTITY", "ORPHAN_OWNER"}


def test_first_copy_keeps_its_identifier_even_as_an_orphan(spark):
    data = extracts.rows(2)
    data["properties"].insert(0, {**data["properties"][0], "owner_id": "NOBODY"})
    data["properties"].append({**data["properties"][2], "size_sqm": "bad"})
    parts = quality.assess(
        extracts.frames(spark, data), batch_id="b", processed_at=F.lit(datetime(2024, 1, 1))
    )
    reasons = sorted(
        (row.source_row, row.reason_code) for row in parts["properties"].rejected.collect()
    )
    assert reasons == [(1, "ORPHAN_OWNER"), (2, "DUPLICATE_IDENTIFIER"), (4, "INVALID_DECIMAL")]
    assert [row.property_id for row in parts["properties"].accepted.collect()] == ["PRP-1"]
    assert parts["payments"].accepted.count() == 3


INSTANTS = [
    ("2024-01-01T00:00:00.1234567Z", "2024-01-01 00:00:00.123456"),
    ("2024-01-01T00:00:00.123456789+00:00", "2024-01-01 00:00:00.123456"),
    ("20240101T000000Z", "2024-01-01 00:00:00"),
    ("2024-01-01T05Z", "2024-01-01 05:00:00"),
    ("2024-01-01T05:30+0530", "2024-01-01 00:00:00"),
    ("2024-01-01 05:30:07,5-01", "2024-01-01 06:30:07.5"),
    ("2024-01-01T00:00:00+23:59", "2023-12-31 00:01:00"),
    ("2024-01-01T00:00:00", None),
    ("2024-13-01T00:00:00Z", None),
    ("2024-01-01T25:00:00Z", None),
    ("2024-0101T00:00:00Z", None),
    ("0000-01-01T00:00:00Z", None),
]


def test_timestamps_of_every_iso_form(spark):
    frame = spark.createDataFrame([(text,) for text, _ in INSTANTS], "text string")
    found = frame.select("text", casts.to_instant(F.col("text")).cast("string").alias("t")).collect()
    assert [(r.text, r.t) for r in found] == INSTANTS


def test_cents_are_rounded_from_the_whole_text(spark):
    given = {
        "0.00500000000000000000001": "0.01", "0.005": "0.00", "0.015": "0.02", "-0.02500000000000000000000": "-0.02",
        "-0.0250000000000000000000000009": "-0.03", "1_000.5": "1000.50", "12.344999999999999999999999": "12.34",
    }
    frame = spark.createDataFrame([(text,) for text in given], "text string")
    found = {r.text: str(r.c) for r in frame.select("text", casts.to_cents(F.col("text")).alias("c")).collect()}
    assert found == given


def test_a_bad_stamp_without_offset_is_not_told_to_add_one(spark):
    data = extracts.rows(2)
    data["tenants"][0]["source_timestamp"] = "2024-13-01T00:00:00"
    data["tenants"][1]["source_timestamp"] = "2024-12-01T00:00:00"
    judged = rules.judge("tenants", extracts.frames(spark, data)["tenants"]).orderBy("source_row").collect()
    assert ["offset" in r.reason.explanation for r in judged] == [False, True]
