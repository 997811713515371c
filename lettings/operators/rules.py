"""Record rules: normalised columns and the ordered list of rule violations per entity.

A record has at most one reason, the first rule it breaks. An entity is judged without a shuffle:
the text is stripped once, typed once, and the rules are one CASE over the typed columns.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettings.functions import casts, text
from lettings.functions.binding import evaluated
from lettings.model import ENTITIES, ORDER, ROW, Entity

# Accepted codes and numeric limits of the source rules.
PROPERTY_TYPES = ("apartment", "house", "studio")
CURRENCIES = ("PLN", "EUR", "USD")
AGREEMENT_STATUSES = ("ACTIVE", "EXPIRED", "TERMINATED")
PAYMENT_STATUSES = ("PAID", "PENDING", "OVERDUE")
MAX_SIZE, MAX_RENT, MAX_BEDROOMS, MAX_AMOUNT = 1000, 100000, 20, 1000000

MALFORMED = "_corrupt_record"
RAW = "raw"
"""Struct column with the untouched source text."""


@dataclass(frozen=True)
class Rule:
    broken: Column
    code: str
    explanation: str | Column

    @property
    def reason(self) -> Column:
        return reason(self.code, self.explanation)


def reason(code: str, explanation: str | Column) -> Column:
    words = F.lit(explanation) if isinstance(explanation, str) else explanation
    return F.struct(F.lit(code).alias("code"), words.alias("explanation"))


def first_reason(rules: list[Rule]) -> Column:
    """The first broken rule, or NULL."""
    chain = F.when(rules[0].broken, rules[0].reason)
    for rule in rules[1:]:
        chain = chain.when(rule.broken, rule.reason)
    return chain


def missing_fields(entity: Entity) -> Column:
    """Names of the blank required fields in declared order, NULL when there are none."""
    blank = {name: text.is_blank(F.col(name)) for name in entity.raw}
    names = F.array_compact(F.array(*[F.when(b, F.lit(name)) for name, b in blank.items()]))
    return F.when(reduce(Column.__or__, blank.values()), F.array_join(names, ", "))


def _decimal(name: str) -> Rule:
    return Rule(F.col(name).isNull(), "INVALID_DECIMAL", f"{name} must be a finite decimal number")


def _date(name: str) -> Rule:
    return Rule(
        F.col(name).isNull(), "INVALID_DATE", f"{name} must use ISO date format YYYY-MM-DD"
    )


def _rent() -> Rule:
    return Rule(
        ~F.col("monthly_rent").between(0, MAX_RENT),
        "INVALID_RENT",
        "monthly_rent must be non-negative and at most 100000",
    )


def _one_of(name: str, allowed: tuple[str, ...], code: str, words: str) -> Rule:
    return Rule(~F.col(name).isin(*allowed), code, words)


def _timestamp() -> Rule:
    return Rule(
        F.col("source_timestamp").isNull(),
        "INVALID_SOURCE_TIMESTAMP",
        F.when(F.col("_unzoned"), F.lit("source_timestamp must include a UTC offset")).otherwise(
            F.lit("source_timestamp must use ISO-8601 format")
        ),
    )


def _location_rules() -> list[Rule]:
    return [
        Rule(
            ~F.col("country_code").rlike(r"^\p{L}{2}$"),
            "INVALID_COUNTRY_CODE",
            "country_code must contain two letters",
        )
    ]


def _person_rules() -> list[Rule]:
    return [Rule(~F.col("email").contains("@"), "INVALID_EMAIL", "email must contain an @ sign")]


def _property_rules() -> list[Rule]:
    size = F.col("size_sqm")
    return [
        _decimal("size_sqm"),
        _decimal("monthly_rent"),
        Rule(~F.col("_integer"), "INVALID_INTEGER", "bedrooms must be an integer"),
        Rule(
            ~((size > 0) & (size <= MAX_SIZE)),
            "INVALID_PROPERTY_SIZE",
            "size_sqm must be positive and at most 1000",
        ),
        _rent(),
        Rule(
            ~F.coalesce(F.col("bedrooms").between(0, MAX_BEDROOMS), F.lit(False)),
            "INVALID_BEDROOM_COUNT",
            "bedrooms must be between 0 and 20",
        ),
        _one_of(
            "property_type",
            PROPERTY_TYPES,
            "INVALID_PROPERTY_TYPE",
            "property_type is not supported",
        ),
        _one_of("currency", CURRENCIES, "INVALID_CURRENCY", "currency is not supported"),
    ]


def _agreement_rules() -> list[Rule]:
    return [
        _date("start_date"),
        _date("end_date"),
        _decimal("monthly_rent"),
        Rule(
            F.col("end_date") < F.col("start_date"),
            "INVALID_AGREEMENT_RANGE",
            "end_date must not be before start_date",
        ),
        _rent(),
        _one_of(
            "status",
            AGREEMENT_STATUSES,
            "INVALID_AGREEMENT_STATUS",
            "agreement status is not supported",
        ),
    ]


def _payment_rules() -> list[Rule]:
    return [
        _decimal("amount"),
        Rule(
            ~F.col("amount").between(0, MAX_AMOUNT),
            "INVALID_PAYMENT_AMOUNT",
            "amount must be between 0 and 1000000",
        ),
        _one_of(
            "status",
            PAYMENT_STATUSES,
            "INVALID_PAYMENT_STATUS",
            "payment status is not supported",
        ),
        _date("due_date"),
        _date("payment_date"),
    ]


_RULES: dict[str, Callable[[], list[Rule]]] = {
    "locations": _location_rules,
    "owners": _person_rules,
    "tenants": _person_rules,
    "properties": _property_rules,
    "rental_agreements": _agreement_rules,
    "payments": _payment_rules,
}


def record_rules(entity: Entity) -> list[Rule]:
    """In evaluation order, over the columns of ``typed``."""
    missing = F.col("_missing")
    return [
        Rule(
            missing.isNotNull(),
            "MISSING_REQUIRED_FIELD",
            F.concat(F.lit("required value(s) missing: "), missing),
        ),
        *_RULES[entity.name](),
        _timestamp(),
    ]


_CLEAN: dict[str, Callable[[Column], Column]] = {
    "city": text.title_case,
    "region": text.title_case,
    "full_name": text.single_spaced,
    "email": F.lower,
    "property_type": F.lower,
    "country_code": F.upper,
    "currency": F.upper,
    "status": F.upper,
}
_PARSE: dict[str, Callable[[Column], Column]] = {
    "decimal": casts.to_cents,
    "date": casts.to_date,
    "integer": casts.to_integer,
}


def typed(entity: Entity | str, raw: DataFrame) -> DataFrame:
    """Normalised columns next to the raw text; a value that cannot be parsed is NULL.

    Decimals stay wide here so that range rules see the value; ``normalised`` narrows them.
    """
    spec = ENTITIES[entity] if isinstance(entity, str) else entity
    extra = [name for name in (ROW, ORDER, MALFORMED) if name in raw.columns]
    stripped = evaluated(
        raw,
        {name: text.strip(F.col(name)) for name in spec.raw},
        F.struct(*spec.raw).alias(RAW),
        *extra,
    )
    columns: dict[str, Column] = {}
    for name, kind in spec.columns:
        parse = _PARSE.get(kind.typeName()) or _CLEAN.get(name) or (lambda value: value)
        columns[name] = parse(F.col(name))
    stamp = F.col("source_timestamp")
    columns["source_timestamp"] = casts.to_instant(stamp)
    columns["_missing"] = missing_fields(spec)
    valid_but_offset = casts.to_instant(F.concat(stamp, F.lit("Z"))).isNotNull()
    columns["_unzoned"] = casts.to_instant(stamp).isNull() & (
        valid_but_offset | casts.to_date(stamp).isNotNull()
    )
    if spec.name == "properties":
        columns["_integer"] = casts.integer_shaped(F.col("bedrooms"))
    return evaluated(stripped, columns, RAW, *extra)


def judge(entity: Entity | str, raw: DataFrame) -> DataFrame:
    """Normalised columns, ``source_row`` or ``source_order``, ``raw`` and ``reason`` (NULL: all kept)."""
    spec = ENTITIES[entity] if isinstance(entity, str) else entity
    rules = record_rules(spec)
    extra = [name for name in (ROW, ORDER, MALFORMED) if name in raw.columns]
    if MALFORMED in raw.columns:
        rules = [
            Rule(F.col(MALFORMED).isNotNull(), "MALFORMED_RECORD", "record is not valid JSON"),
            *rules,
        ]
    return typed(spec, raw).select(
        *extra, RAW, *spec.raw, first_reason(rules).alias("reason")
    )


def normalised(entity: Entity) -> list[Column]:
    """Business columns in their stored types, and the source timestamp, of valid records."""
    return [
        *[
            (F.col(name).cast(kind) if kind.typeName() == "decimal" else F.col(name)).alias(name)
            for name, kind in entity.columns
        ],
        F.col("source_timestamp"),
    ]
