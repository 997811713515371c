"""SQL twins of the registered queries, for an independent engine on the same tables.

Written from the meaning of each query, not from its DataFrame form: duplicates by a window,
overlaps by pairwise EXISTS, means as integer arithmetic on cents.
"""

from __future__ import annotations

from lettings.catalog.queries import DRILL_THROUGH
from lettings.catalog.tables import AS_OF, STAMP
from lettings.model import ENTITIES
from lettings.operators import checks

_STRIP = "' ' || chr(9)"


def _stripped(column: str) -> str:
    return f"trim({column}, {_STRIP})"


def _title(column: str) -> str:
    return (
        rf"array_to_string(list_transform(regexp_extract_all({_stripped(column)}, '\p{{L}}+|\P{{L}}+'), "
        "lambda w: upper(w[1:1]) || lower(w[2:])), '')"
    )


def _missing(*columns: str) -> str:
    tests = ", ".join(
        f"CASE WHEN {c} IS NULL OR {_stripped(c)} = '' THEN '{c}' END" for c in columns
    )
    return f"concat_ws(', ', {tests})"


def _json(*columns: str) -> str:
    fields = ", ".join(f"'{c}': {c}" for c in sorted(columns))
    return f"CAST(to_json({{{fields}}}) AS VARCHAR)"


_ALL = {name: tuple(spec.raw) for name, spec in ENTITIES.items()}

_RAW = f"""
raw_locations AS (
  SELECT n.rn AS source_row,
    CASE WHEN n_nationkey % 7 = 3 THEN ' LOC-' || n_nationkey || chr(9) ELSE 'LOC-' || n_nationkey END AS location_id,
    CASE WHEN n_nationkey % 5 = 0 THEN '  ' || upper(n_name) || ' ' ELSE lower(n_name) END AS city,
    lower(r_name) AS region,
    CASE WHEN n_nationkey = 24 THEN 'P1' ELSE ['pl', 'DE', ' fr '][n_nationkey % 3 + 1] END AS country_code,
    CASE WHEN n_nationkey = 23 THEN '2024-01-01T00:00:00'
      ELSE ['2024-01-01T00:00:00Z', '2024-01-01T02:00:00+02:00'][n_nationkey % 2 + 1] END AS source_timestamp
  FROM (SELECT *, row_number() OVER () AS rn FROM nation) n JOIN region ON n_regionkey = r_regionkey),
raw_owners AS (
  SELECT rn AS source_row, 'OWN-' || s_suppkey AS owner_id,
    CASE WHEN s_suppkey % 59 = 11 THEN '' ELSE ' ' || replace(s_name, '#', '   ') END AS full_name,
    CASE WHEN s_suppkey % 53 = 7 THEN 'owner' || s_suppkey ELSE ' Owner' || s_suppkey || '@Example.com' END AS email,
    '{STAMP}' AS source_timestamp
  FROM (SELECT *, row_number() OVER () AS rn FROM supplier)),
raw_tenants AS (
  SELECT rn AS source_row,
    CASE WHEN c_custkey % 211 = 17 THEN '   ' ELSE 'TEN-' || c_custkey END AS tenant_id,
    CASE WHEN c_custkey % 199 <> 4 THEN c_name END AS full_name,
    CASE WHEN c_custkey % 199 = 4 THEN '' ELSE 'TENANT' || c_custkey || '@example.com' END AS email,
    '{STAMP}' AS source_timestamp
  FROM (SELECT *, row_number() OVER () AS rn FROM customer)),
raw_properties AS (
  SELECT rn AS source_row,
    'PRP-' || CASE WHEN p_partkey % 101 = 50 THEN p_partkey - 1 ELSE p_partkey END AS property_id,
    'LOC-' || (p_partkey % 26) AS location_id,
    'OWN-' || (p_partkey % ((SELECT count(*) FROM supplier) + 1)) AS owner_id,
    CASE WHEN p_partkey % 89 = 3 THEN '' WHEN p_partkey % 149 = 9 THEN 'castle'
      ELSE ['Apartment', 'HOUSE', ' studio '][p_partkey % 3 + 1] END AS property_type,
    CASE WHEN p_partkey % 163 = 20 THEN '2.5' WHEN p_partkey % 167 = 21 THEN '21'
      WHEN p_partkey % 13 = 1 THEN ' +' || (p_size % 6) ELSE CAST(p_size % 6 AS VARCHAR) END AS bedrooms,
    CASE WHEN p_partkey % 97 = 5 THEN '-5.00' WHEN p_partkey % 83 = 6 THEN 'abc'
      WHEN p_partkey % 4 = 1 THEN p_size || '.125' ELSE p_size || '.00' END AS size_sqm,
    CASE WHEN p_partkey % 103 = 8 THEN '-100.00' ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) END AS monthly_rent,
    CASE WHEN p_partkey % 107 = 10 THEN 'GBP' ELSE [' pln', 'EUR', 'usd'][p_partkey % 3 + 1] END AS currency,
    CASE WHEN p_partkey % 109 = 12 THEN 'yesterday' ELSE '{STAMP}' END AS source_timestamp
  FROM (SELECT *, row_number() OVER () AS rn FROM part)),
raw_rental_agreements AS (
  SELECT rn AS source_row, 'AGR-' || o_orderkey AS agreement_id,
    'PRP-' || (o_orderkey % (SELECT count(*) FROM part)) AS property_id,
    'TEN-' || o_custkey AS tenant_id,
    CASE WHEN o_orderkey % 127 = 3 THEN '2024-02-30' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS start_date,
    CAST(CAST(o_orderdate AS DATE) + CASE WHEN o_orderkey % 131 = 4 THEN -1
      ELSE 30 + CAST(o_orderkey % 336 AS INTEGER) END AS VARCHAR) AS end_date,
    CASE WHEN o_orderkey % 137 = 5 THEN '-1' WHEN o_orderkey % 139 = 6 THEN 'n/a'
      ELSE CAST(CAST(CAST(floor(o_totalprice) AS DECIMAL(10,0)) * 0.01 AS DECIMAL(12,2)) AS VARCHAR) END AS monthly_rent,
    CASE WHEN o_orderkey % 151 = 7 THEN 'paused' WHEN o_orderstatus = 'O' THEN 'active'
      WHEN o_orderstatus = 'F' THEN 'Expired' ELSE ' TERMINATED ' END AS status,
    '{STAMP}' AS source_timestamp
  FROM (SELECT *, row_number() OVER () AS rn FROM orders)),
raw_payments AS (
  SELECT l.rn AS source_row, 'PAY-' || l_orderkey || '-' || l_linenumber AS payment_id,
    CASE WHEN l_partkey % 157 = 8 THEN 'AGR-X' ELSE 'AGR-' END || l_orderkey AS agreement_id,
    CAST(CAST(o_orderdate AS DATE) + 30 * (l_linenumber - 1) AS VARCHAR) AS due_date,
    CASE WHEN l_suppkey % 61 = 9 THEN 'not-a-date' ELSE
      CAST(CAST(o_orderdate AS DATE) + 30 * (l_linenumber - 1) + CAST(l_suppkey % 7 AS INTEGER) - 2 AS VARCHAR) END AS payment_date,
    CASE WHEN l_partkey % 163 = 9 THEN '1000000.01' WHEN l_partkey % 167 = 10 THEN 'NaN'
      ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) END AS amount,
    CASE WHEN l_partkey % 173 = 11 THEN 'unknown' WHEN l_returnflag = 'R' THEN 'overdue'
      WHEN l_returnflag = 'A' THEN 'paid' ELSE 'Pending' END AS status,
    '{STAMP}' AS source_timestamp
  FROM (SELECT *, row_number() OVER () AS rn FROM lineitem) l JOIN orders ON l_orderkey = o_orderkey)
"""

_EPOCH = "CAST(epoch(CAST(source_timestamp AS TIMESTAMPTZ)) AS BIGINT)"
_ZONED = r"regexp_full_match(source_timestamp, '.*(Z|[+-][0-9]{2}:[0-9]{2})')"
_BAD_STAMP = f"WHEN NOT {_ZONED} THEN 'INVALID_SOURCE_TIMESTAMP'"


def _judged(entity: str, typed: str, rules: str) -> str:
    """Typed columns and first reason code; NULL where the record is rejected."""
    return f"""
judged_{entity} AS (
  SELECT *, CASE WHEN missing <> '' THEN 'MISSING_REQUIRED_FIELD' {rules} {_BAD_STAMP} END AS reason_code
  FROM (SELECT source_row, source_timestamp, {typed}, {_missing(*_ALL[entity])} AS missing,
    {_json(*_ALL[entity])} AS raw_record FROM raw_{entity}))"""


_RENT = "WHEN monthly_rent NOT BETWEEN 0 AND 100000 THEN 'INVALID_RENT'"


def _cents(column: str) -> str:
    even = f"CAST(round_even(TRY_CAST({_stripped(column)} AS DOUBLE), 2) AS DECIMAL(18,2))"
    finite = f"TRY_CAST({_stripped(column)} AS DECIMAL(18,4)) IS NOT NULL"
    return f"CASE WHEN {finite} THEN {even} END AS {column}"


_JUDGED = ",".join(
    [
        _judged(
            "locations",
            f"{_stripped('location_id')} AS location_id, {_title('city')} AS city, {_title('region')} AS region, "
            f"upper({_stripped('country_code')}) AS country_code",
            "WHEN NOT regexp_full_match(country_code, '[A-Z]{2}') THEN 'INVALID_COUNTRY_CODE'",
        ),
        *[
            _judged(
                entity,
                f"{_stripped(key)} AS {key}, regexp_replace({_stripped('full_name')}, ' +', ' ', 'g') AS full_name, "
                f"lower({_stripped('email')}) AS email",
                "WHEN NOT contains(email, '@') THEN 'INVALID_EMAIL'",
            )
            for entity, key in (("owners", "owner_id"), ("tenants", "tenant_id"))
        ],
        _judged(
            "properties",
            "property_id, location_id, owner_id, "
            f"lower({_stripped('property_type')}) AS property_type, "
            f"CASE WHEN regexp_full_match({_stripped('bedrooms')}, '[+-]?[0-9]+') THEN CAST({_stripped('bedrooms')} AS INTEGER) END AS bedrooms, "
            f"{_cents('size_sqm')}, {_cents('monthly_rent')}, upper({_stripped('currency')}) AS currency",
            "WHEN size_sqm IS NULL OR monthly_rent IS NULL THEN 'INVALID_DECIMAL' "
            "WHEN bedrooms IS NULL THEN 'INVALID_INTEGER' "
            "WHEN NOT (size_sqm > 0 AND size_sqm <= 1000) THEN 'INVALID_PROPERTY_SIZE' "
            f"{_RENT} WHEN bedrooms NOT BETWEEN 0 AND 20 THEN 'INVALID_BEDROOM_COUNT' "
            "WHEN property_type NOT IN ('apartment', 'house', 'studio') THEN 'INVALID_PROPERTY_TYPE' "
            "WHEN currency NOT IN ('PLN', 'EUR', 'USD') THEN 'INVALID_CURRENCY'",
        ),
        _judged(
            "rental_agreements",
            "agreement_id, property_id, tenant_id, TRY_CAST(start_date AS DATE) AS start_date, "
            f"TRY_CAST(end_date AS DATE) AS end_date, {_cents('monthly_rent')}, upper({_stripped('status')}) AS status",
            "WHEN start_date IS NULL OR end_date IS NULL THEN 'INVALID_DATE' "
            "WHEN monthly_rent IS NULL THEN 'INVALID_DECIMAL' "
            "WHEN end_date < start_date THEN 'INVALID_AGREEMENT_RANGE' "
            f"{_RENT} WHEN status NOT IN ('ACTIVE', 'EXPIRED', 'TERMINATED') THEN 'INVALID_AGREEMENT_STATUS'",
        ),
        _judged(
            "payments",
            "payment_id, agreement_id, TRY_CAST(due_date AS DATE) AS due_date, "
            f"TRY_CAST(payment_date AS DATE) AS payment_date, {_cents('amount')}, upper({_stripped('status')}) AS status",
            "WHEN amount IS NULL THEN 'INVALID_DECIMAL' "
            "WHEN amount NOT BETWEEN 0 AND 1000000 THEN 'INVALID_PAYMENT_AMOUNT' "
            "WHEN status NOT IN ('PAID', 'PENDING', 'OVERDUE') THEN 'INVALID_PAYMENT_STATUS' "
            "WHEN due_date IS NULL OR payment_date IS NULL THEN 'INVALID_DATE'",
        ),
    ]
)

_KEYS = {name: columns[0] for name, columns in _ALL.items()}


def _checked(entity: str, joins: str, rules: str) -> str:
    key = _KEYS[entity]
    return f"""
first_{entity} AS (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY source_row) AS copy_no
  FROM judged_{entity} WHERE reason_code IS NULL),
checked_{entity} AS (
  SELECT c.* EXCLUDE (reason_code),
    CASE WHEN c.copy_no > 1 THEN 'DUPLICATE_IDENTIFIER' {rules} END AS reason_code
  FROM first_{entity} c {joins}),
{entity} AS (SELECT * FROM checked_{entity} WHERE reason_code IS NULL)"""


_CHECKED = ",".join(
    [
        _checked("locations", "", ""),
        _checked("owners", "", ""),
        _checked("tenants", "", ""),
        _checked(
            "properties",
            "LEFT JOIN locations pl ON c.location_id = pl.location_id LEFT JOIN owners po ON c.owner_id = po.owner_id",
            "WHEN pl.location_id IS NULL THEN 'ORPHAN_LOCATION' WHEN po.owner_id IS NULL THEN 'ORPHAN_OWNER'",
        ),
        _checked(
            "rental_agreements",
            "LEFT JOIN properties pp ON c.property_id = pp.property_id LEFT JOIN tenants pt ON c.tenant_id = pt.tenant_id",
            "WHEN pp.property_id IS NULL THEN 'ORPHAN_PROPERTY' WHEN pt.tenant_id IS NULL THEN 'ORPHAN_TENANT'",
        ),
        _checked(
            "payments",
            "LEFT JOIN rental_agreements pa ON c.agreement_id = pa.agreement_id",
            "WHEN pa.agreement_id IS NULL THEN 'ORPHAN_AGREEMENT' "
            "WHEN c.due_date NOT BETWEEN pa.start_date AND pa.end_date THEN 'PAYMENT_DUE_OUTSIDE_AGREEMENT'",
        ),
    ]
)


def _explanations() -> str:
    fixed = {
        "INVALID_COUNTRY_CODE": "country_code must contain two letters",
        "INVALID_EMAIL": "email must contain an @ sign",
        "INVALID_INTEGER": "bedrooms must be an integer",
        "INVALID_PROPERTY_SIZE": "size_sqm must be positive and at most 1000",
        "INVALID_RENT": "monthly_rent must be non-negative and at most 100000",
        "INVALID_BEDROOM_COUNT": "bedrooms must be between 0 and 20",
        "INVALID_PROPERTY_TYPE": "property_type is not supported",
        "INVALID_CURRENCY": "currency is not supported",
        "INVALID_AGREEMENT_RANGE": "end_date must not be before start_date",
        "INVALID_AGREEMENT_STATUS": "agreement status is not supported",
        "INVALID_PAYMENT_AMOUNT": "amount must be between 0 and 1000000",
        "INVALID_PAYMENT_STATUS": "payment status is not supported",
        "ORPHAN_LOCATION": "location_id is not present",
        "ORPHAN_OWNER": "owner_id is not present",
        "ORPHAN_PROPERTY": "property_id is not present",
        "ORPHAN_TENANT": "tenant_id is not present",
        "ORPHAN_AGREEMENT": "agreement_id is not present",
        "PAYMENT_DUE_OUTSIDE_AGREEMENT": "due_date must fall within the rental agreement",
    }
    return " ".join(f"WHEN '{code}' THEN '{words}'" for code, words in fixed.items())


def _refused(entity: str) -> str:
    key = _KEYS[entity]
    number = {
        "properties": "CASE WHEN size_sqm IS NULL THEN 'size_sqm' ELSE 'monthly_rent' END",
        "rental_agreements": "'monthly_rent'",
        "payments": "'amount'",
    }.get(entity, "''")
    day = {
        "rental_agreements": "CASE WHEN start_date IS NULL THEN 'start_date' ELSE 'end_date' END",
        "payments": "CASE WHEN due_date IS NULL THEN 'due_date' ELSE 'payment_date' END",
    }.get(entity, "''")
    parts = []
    for frame in (f"judged_{entity}", f"checked_{entity}"):
        parts.append(
            f"""SELECT '{entity}' AS record_type,
    CASE WHEN {key} IS NULL OR {key} = '' THEN 'row-' || source_row ELSE {key} END AS source_identifier,
    reason_code,
    CASE reason_code {_explanations()}
      WHEN 'MISSING_REQUIRED_FIELD' THEN 'required value(s) missing: ' || missing
      WHEN 'DUPLICATE_IDENTIFIER' THEN '{key} ''' || {key} || ''' occurs more than once'
      WHEN 'INVALID_DECIMAL' THEN {number} || ' must be a finite decimal number'
      WHEN 'INVALID_DATE' THEN {day} || ' must use ISO date format YYYY-MM-DD'
      WHEN 'INVALID_SOURCE_TIMESTAMP' THEN CASE WHEN source_timestamp LIKE '2024%'
        THEN 'source_timestamp must include a UTC offset' ELSE 'source_timestamp must use ISO-8601 format' END
    END AS explanation, raw_record, source_row
  FROM {frame} WHERE reason_code IS NOT NULL"""
        )
    return " UNION ALL ".join(parts)


_REFUSED = "refused AS (" + " UNION ALL ".join(_refused(entity) for entity in _ALL) + ")"

_FINGERPRINT = (
    "'{\"bedrooms\":' || bedrooms || ',\"currency\":\"' || currency || '\",\"location_id\":\"' || location_id || "
    "'\",\"monthly_rent\":\"' || CAST(CAST(monthly_rent AS DECIMAL(12,2)) AS VARCHAR) || '\",\"owner_id\":\"' || owner_id || "
    "'\",\"property_id\":\"' || property_id || '\",\"property_type\":\"' || property_type || "
    "'\",\"size_sqm\":\"' || CAST(CAST(size_sqm AS DECIMAL(10,2)) AS VARCHAR) || '\"}'"
)
_PAYMENT_FINGERPRINT = (
    "'{\"agreement_id\":\"' || agreement_id || '\",\"amount\":\"' || CAST(CAST(amount AS DECIMAL(12,2)) AS VARCHAR) || "
    "'\",\"due_date\":\"' || due_date || '\",\"payment_date\":\"' || payment_date || '\",\"payment_id\":\"' || payment_id || "
    "'\",\"status\":\"' || status || '\"}'"
)

_BATCH = f"WITH {_RAW}, {_JUDGED}, {_CHECKED}, {_REFUSED}"

_STAR = """,
dim_location AS (SELECT md5(location_id) AS location_key, location_id, city, region, country_code FROM locations),
dim_owner AS (SELECT md5(owner_id) AS owner_key, owner_id, full_name, email FROM owners),
dim_tenant AS (SELECT md5(tenant_id) AS tenant_key, tenant_id, full_name, email FROM tenants),
dim_property AS (
  SELECT md5(property_id) AS property_key, property_id, location_key, owner_key, property_type, bedrooms,
    CAST(size_sqm AS DOUBLE) AS size_sqm, CAST(monthly_rent AS DOUBLE) AS monthly_rent, currency
  FROM properties JOIN dim_location USING (location_id) JOIN dim_owner USING (owner_id)),
bounds AS (SELECT least(min(start_date), min(end_date)) AS lo, greatest(max(start_date), max(end_date)) AS hi FROM rental_agreements),
days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date_day FROM bounds),
dim_date AS (
  SELECT CAST(strftime(date_day, '%Y%m%d') AS INTEGER) AS date_key, date_day, CAST(year(date_day) AS INTEGER) AS year_number,
    CAST(quarter(date_day) AS INTEGER) AS quarter_number, CAST(month(date_day) AS INTEGER) AS month_number,
    monthname(date_day) AS month_name, CAST(isodow(date_day) AS INTEGER) AS iso_weekday_number, dayname(date_day) AS weekday_name,
    isodow(date_day) IN (6, 7) AS is_weekend, CAST(date_trunc('month', date_day) AS DATE) AS month_start_date FROM days),
fact_rental_agreement AS (
  SELECT md5(agreement_id) AS rental_agreement_key, agreement_id, property_key, location_key, owner_key, tenant_key,
    CAST(strftime(start_date, '%Y%m%d') AS INTEGER) AS start_date_key, CAST(strftime(end_date, '%Y%m%d') AS INTEGER) AS end_date_key,
    start_date, end_date, a.monthly_rent, status, CAST(end_date - start_date + 1 AS INTEGER) AS agreement_days
  FROM rental_agreements a JOIN dim_property USING (property_id) JOIN dim_tenant USING (tenant_id)),
fact_payment AS (
  SELECT md5(payment_id) AS payment_key, payment_id, md5(p.agreement_id) AS rental_agreement_key, property_key, location_key, tenant_key,
    CAST(strftime(due_date, '%Y%m%d') AS INTEGER) AS due_date_key, CAST(strftime(payment_date, '%Y%m%d') AS INTEGER) AS payment_date_key,
    due_date, payment_date, amount, p.status, CAST(greatest(payment_date - due_date, 0) AS INTEGER) AS days_overdue,
    (payment_date > due_date OR p.status = 'OVERDUE') AS is_overdue
  FROM payments p JOIN rental_agreements a ON p.agreement_id = a.agreement_id
    JOIN dim_property USING (property_id) JOIN dim_tenant USING (tenant_id)),
fact_occupancy AS (
  SELECT md5(agreement_id || ':' || CAST(date_day AS VARCHAR)) AS occupancy_key, rental_agreement_key, property_key, location_key,
    tenant_key, date_key, date_day, 1 AS occupied_day
  FROM fact_rental_agreement JOIN dim_date ON date_day BETWEEN start_date AND end_date),
mart_occupancy AS (
  SELECT l.location_key, city, region, m.month_start_date, CAST(coalesce(occ, 0) AS BIGINT) AS occupied_property_days,
    CAST(n * cal AS BIGINT) AS available_property_days,
    ((2 * 10000 * CAST(coalesce(occ, 0) AS HUGEINT) + n * cal) // (2 * n * cal)) / 10000.0 AS occupancy_rate
  FROM (SELECT location_key, count(*) AS n FROM dim_property GROUP BY 1) i JOIN dim_location l USING (location_key)
  CROSS JOIN (SELECT month_start_date, count(*) AS cal FROM dim_date GROUP BY 1) m
  LEFT JOIN (SELECT location_key, CAST(date_trunc('month', date_day) AS DATE) AS month_start_date, sum(occupied_day) AS occ
    FROM fact_occupancy GROUP BY 1, 2) o ON o.location_key = l.location_key AND o.month_start_date = m.month_start_date),
mart_monthly_rental_revenue AS (
  SELECT location_key, city, region, CAST(date_trunc('month', payment_date) AS DATE) AS revenue_month,
    count(*) AS paid_payment_count, CAST(sum(amount) AS DOUBLE) AS rental_revenue
  FROM fact_payment JOIN dim_location USING (location_key) WHERE status = 'PAID' GROUP BY 1, 2, 3, 4),
mart_average_rent_per_sqm AS (
  SELECT location_key, city, region, count(*) AS property_count,
    round(avg(monthly_rent / size_sqm), 2) AS average_rent_per_sqm
  FROM dim_property JOIN dim_location USING (location_key) GROUP BY 1, 2, 3),
mart_expiring AS (
  SELECT rental_agreement_key, agreement_id, property_key, tenant_key, city, end_date,
    CAST(end_date - DATE 'AS_OF' AS INTEGER) AS days_until_expiration, CAST(monthly_rent AS DOUBLE) AS monthly_rent
  FROM fact_rental_agreement JOIN dim_location USING (location_key)
  WHERE end_date BETWEEN DATE 'AS_OF' AND DATE 'AS_OF' + 30),
monthly AS (
  SELECT location_key, city, region, CAST(date_trunc('month', start_date) AS DATE) AS agreement_month, count(*) AS n,
    CAST(sum(monthly_rent * 100) AS HUGEINT) AS cents
  FROM fact_rental_agreement JOIN dim_location USING (location_key) GROUP BY 1, 2, 3, 4),
lagged AS (
  SELECT *, lag(cents) OVER w AS cents0, lag(n) OVER w AS n0 FROM monthly
  WINDOW w AS (PARTITION BY location_key ORDER BY agreement_month)),
mart_rental_trends AS (
  SELECT location_key, city, region, agreement_month, n AS agreement_count,
    ((2 * cents + n) // (2 * n)) / 100.0 AS average_monthly_rent,
    sign(cents * n0 - cents0 * n) * ((2 * abs(cents * n0 - cents0 * n) + n * n0) // (2 * n * n0)) / 100.0
      AS rent_change_from_previous_month
  FROM lagged)
""".replace("AS_OF", AS_OF)

_LEGACY = """WITH
owner AS (SELECT s_suppkey + 10000000000 AS person_no, CAST(s_suppkey % 15 AS INTEGER) AS years FROM supplier),
tenant_of AS (SELECT c_custkey, CASE WHEN c_custkey % 40 = 0 THEN 10000000000 + c_custkey // 40
  ELSE 20000000000 + c_custkey END AS person_no, lower(c_mktsegment) AS reason FROM customer),
tenant AS (SELECT person_no, reason FROM tenant_of),
agent AS (SELECT c_custkey + 30000000000 AS person_no, 'Firm' || c_nationkey AS firm FROM customer),
person AS (
  SELECT s_suppkey + 10000000000 AS person_no, 'Given' || (s_suppkey % 20) AS first_name,
    CASE WHEN s_suppkey % 50 = 7 THEN 'Nowak' ELSE 'Owner' || CASE WHEN s_suppkey % 5 = 0 THEN s_suppkey // 10 ELSE s_suppkey END END AS last_name FROM supplier
  UNION ALL SELECT person_no, 'Given' || (c_custkey % 20), 'Tenant' || c_custkey FROM tenant_of WHERE person_no >= 20000000000
  UNION ALL SELECT c_custkey + 30000000000, 'Given' || (c_custkey % 20), 'Agent' || c_custkey FROM customer),
space AS (
  SELECT space_id, area, n_name AS city, (space_id % 1000003) * (space_id % 1000003) % 1000003 * 104729 % 1000003 % (SELECT count(*) FROM supplier) + 10000000000 AS owner_no
  FROM (SELECT p_partkey // 4 AS space_id, CAST(sum(p_size) AS BIGINT) AS area FROM part GROUP BY 1)
    JOIN nation ON n_nationkey = space_id % 25),
house AS (
  SELECT p_partkey AS house_id, p_partkey // 4 AS space_id, p_size AS area, p_size % 3 + 1 AS floors,
    CASE WHEN p_partkey % 2 = 0 THEN 'Y' ELSE 'N' END AS garage, p_partkey * 37 % 1500 + 100 AS upkeep,
    CAST(floor(p_retailprice * 10) AS BIGINT) AS market_price FROM part),
agreement AS (
  SELECT o_orderkey AS agreement_id, CAST(CAST(floor(o_totalprice) AS DECIMAL(10,0)) * 0.01 AS DECIMAL(12,2)) AS rent,
    CAST(o_orderdate AS DATE) AS start_date, CAST(o_orderdate AS DATE) + 30 + CAST(o_orderkey % 336 AS INTEGER) AS end_date,
    person_no AS tenant_no,
    CASE WHEN o_orderkey % 4 <> 3 THEN o_orderkey * 7 % (SELECT count(*) FROM customer) + 30000000000 END AS agent_no,
    o_orderkey % (SELECT count(*) FROM part) AS house_id
  FROM orders JOIN tenant_of ON CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END = c_custkey),
placed AS (
  SELECT a.*, s.space_id, s.city, s.owner_no, s.area AS space_area
  FROM agreement a JOIN house h USING (house_id) JOIN space s ON h.space_id = s.space_id)
"""

_A = "agreement_id, CAST(rent AS DOUBLE) AS rent, start_date, end_date, tenant_no, agent_no, house_id"
_H = "house_id, space_id, area, floors, garage, upkeep"


def _batch(select: str) -> str:
    return f"{_BATCH} {select}"


def _star(select: str) -> str:
    return f"{_BATCH}{_STAR} {select}"


def _legacy(select: str) -> str:
    return f"{_LEGACY} {select}"


def _normal(entity: str) -> str:
    columns = []
    for name in _ALL[entity]:
        value = f"CAST({name} AS DOUBLE)" if name in ("size_sqm", "monthly_rent", "amount") else name
        value = _EPOCH if name == "source_timestamp" else value
        columns.append(f"CASE WHEN reason_code IS NULL THEN {value} END AS {name}")
    return _batch(f"SELECT source_row, {', '.join(columns)}, reason_code FROM judged_{entity}")


def _rounded(expression: str) -> str:
    """Half-up to cents of an exact decimal with four places."""
    return f"CAST(CAST({expression} AS DECIMAL(18,2)) AS DOUBLE)"


_PAIR = f"""WITH two AS (
  SELECT p_partkey, 'LOC-' || (p_partkey % 23) AS location_id, 'OWN-' || (p_partkey % 7) AS owner_id,
    ['apartment', 'house', 'studio'][p_partkey % 3 + 1] AS property_type, p_size % 6 AS bedrooms,
    CAST(p_size AS DECIMAL(10,2)) AS size_sqm, CAST(p_retailprice AS DECIMAL(12,2)) AS price, 'PLN' AS currency FROM part),
stored0 AS (SELECT 'PRP-' || p_partkey AS property_id, * EXCLUDE (p_partkey, price), price AS monthly_rent FROM two),
incoming0 AS (
  SELECT 'PRP-' || CASE WHEN p_partkey % 10 = 0 THEN p_partkey + (SELECT count(*) FROM part) ELSE p_partkey END AS property_id,
    * EXCLUDE (p_partkey, price), price + CASE WHEN p_partkey % 5 = 2 THEN 250 ELSE 0 END AS monthly_rent FROM two),
stored AS (SELECT *, sha256({_FINGERPRINT}) AS fp FROM stored0),
incoming AS (SELECT *, sha256({_FINGERPRINT}) AS fp FROM incoming0),
actions AS (SELECT i.property_id, CASE WHEN s.property_id IS NULL THEN 'insert' WHEN s.fp <> i.fp THEN 'update' ELSE 'skip' END AS action
  FROM incoming i LEFT JOIN stored s USING (property_id))
"""

_P = (
    "property_id, location_id, owner_id, property_type, bedrooms, CAST(size_sqm AS DOUBLE) AS size_sqm, "
    "CAST(monthly_rent AS DOUBLE) AS monthly_rent, currency, 1704067200 AS source_timestamp"
)
_ANCIENT, _RECENT = 1704067200, 1704153600


def _version(alias: str, run: int) -> str:
    return f"md5({alias}.property_id || '|' || '{run}000000') AS version_id"


_HISTORY = f""" SELECT {_P.replace('property_id, ', 's.property_id, ', 1)}, {_ANCIENT} AS processed_at, {_ANCIENT} AS valid_from,
    CASE WHEN a.action = 'skip' THEN NULL ELSE {_RECENT} END AS valid_to, {_version('s', _ANCIENT)},
    {_ANCIENT} AS updated_at
  FROM stored s LEFT JOIN actions a USING (property_id)
UNION ALL SELECT {_P.replace('property_id, ', 'i.property_id, ', 1)}, {_RECENT}, {_RECENT}, NULL, {_version('i', _RECENT)}, {_RECENT}
  FROM incoming i JOIN actions a USING (property_id) WHERE a.action <> 'skip'"""


def _overlap(one: str, two: str) -> str:
    return f"{one}.start_date <= {two}.end_date AND {two}.start_date <= {one}.end_date"


#: More waves than the houses of any space of the small tables need; requests left over would show.
_WAVES = 14


def _placement() -> str:
    """Wave after wave: open requests ask, houses serve by start and id, the others ask again."""
    parts = [
        f""",
open0 AS (SELECT agreement_id, house_id AS requested_house, start_date, end_date FROM agreement WHERE start_date > DATE '{AS_OF}'),
booked0 AS (SELECT house_id, start_date, end_date FROM agreement WHERE start_date <= DATE '{AS_OF}')"""
    ]
    for n in range(1, _WAVES + 1):
        free = "NOT EXISTS (SELECT 1 FROM booked{} b WHERE b.house_id = {} AND {})"
        overlap = _overlap("b", "r")
        parts.append(
            f"""
wish{n} AS MATERIALIZED (
  SELECT r.*, CASE WHEN {free.format(n - 1, "r.requested_house", overlap)} THEN r.requested_house
    ELSE (SELECT min(h.house_id) FROM house h JOIN house own ON own.house_id = r.requested_house AND h.space_id = own.space_id
      WHERE {free.format(n - 1, "h.house_id", overlap)}) END AS target
  FROM open{n - 1} r),
chain{n} AS (
  SELECT target, list_reduce(
    list_prepend({{'s': NULL::DATE, 'e': DATE '0001-01-01', 'ids': []::BIGINT[]}},
      list({{'s': start_date, 'e': end_date, 'ids': [agreement_id::BIGINT]}} ORDER BY start_date, agreement_id)),
    lambda a, x: CASE WHEN x.s > a.e THEN {{'s': x.s, 'e': x.e, 'ids': list_concat(a.ids, x.ids)}} ELSE a END).ids AS ids
  FROM wish{n} WHERE target IS NOT NULL GROUP BY target),
granted{n} AS MATERIALIZED (SELECT unnest(ids) AS agreement_id FROM chain{n}),
booked{n} AS MATERIALIZED (SELECT * FROM booked{n - 1} UNION ALL
  SELECT target, start_date, end_date FROM wish{n} SEMI JOIN granted{n} USING (agreement_id)),
open{n} AS MATERIALIZED (SELECT agreement_id, requested_house, start_date, end_date FROM wish{n}
  ANTI JOIN granted{n} USING (agreement_id) WHERE target IS NOT NULL)"""
        )
    verdicts = " UNION ALL ".join(
        f"""SELECT agreement_id, requested_house, target AS house_id, start_date, end_date,
  CASE WHEN target IS NULL THEN 'REJECTED' WHEN target = requested_house THEN 'KEPT' ELSE 'MOVED' END AS placement
FROM wish{n} ANTI JOIN open{n} USING (agreement_id)"""
        for n in range(1, _WAVES + 1)
    )
    left = f"SELECT agreement_id, requested_house, NULL, start_date, end_date, 'OPEN' FROM open{_WAVES}"
    return ",".join(parts) + f"\n{verdicts} UNION ALL {left}"


def _trend(*by: str) -> str:
    """Latest month of a group against the month before it in the whole mart."""
    names = "".join(f"{name}, " for name in by)
    same = "".join(f" AND p.{name} IS NOT DISTINCT FROM c.{name}" for name in by)
    return _star(
        f""", means AS (SELECT {names}agreement_month, CAST(sum(CAST(average_monthly_rent AS DECIMAL(18,2))) AS DOUBLE) / count(average_monthly_rent) AS m
  FROM mart_rental_trends GROUP BY {names}agreement_month),
before AS (SELECT agreement_month, lag(agreement_month) OVER (ORDER BY agreement_month) AS earlier
  FROM (SELECT DISTINCT agreement_month FROM mart_rental_trends)),
latest AS (SELECT {names}max(agreement_month) AS agreement_month FROM means{" GROUP BY " + names[:-2] if by else ""})
SELECT {"".join(f"c.{name}, " for name in by)}c.m - coalesce(p.m, 0) AS rent_trend FROM latest l
  JOIN means c ON c.agreement_month = l.agreement_month{"".join(f" AND c.{n} IS NOT DISTINCT FROM l.{n}" for n in by)}
  JOIN before b ON b.agreement_month = c.agreement_month LEFT JOIN means p ON p.agreement_month = b.earlier{same}"""
    )


_REASSIGN = f""",
active AS (SELECT * FROM agreement WHERE end_date > DATE '{AS_OF}'),
load AS (SELECT agent_no, count(*) AS n FROM active WHERE agent_no IS NOT NULL GROUP BY 1),
needy AS (SELECT agent_no, firm, row_number() OVER (PARTITION BY firm ORDER BY agent_no) AS place
  FROM (SELECT DISTINCT agent_no FROM agreement WHERE end_date <= DATE '{AS_OF}' AND agent_no IS NOT NULL) d
    JOIN agent ON person_no = agent_no WHERE agent_no NOT IN (SELECT agent_no FROM load)),
offer AS (
  SELECT agreement_id, firm, row_number() OVER (PARTITION BY firm ORDER BY agent_no, agreement_id) AS place
  FROM (SELECT a.agent_no, agreement_id, firm, n, row_number() OVER (PARTITION BY a.agent_no ORDER BY agreement_id) AS k
    FROM active a JOIN load USING (agent_no) JOIN agent ON person_no = a.agent_no) WHERE k < n),
moves AS (SELECT agreement_id, needy.agent_no AS taker FROM offer JOIN needy USING (firm, place))
SELECT a.agreement_id, CAST(rent AS DOUBLE) AS rent, start_date, end_date, tenant_no, coalesce(taker, agent_no) AS agent_no, house_id,
  CASE WHEN taker IS NOT NULL THEN 'REASSIGNED' END AS action
FROM active a LEFT JOIN moves m ON a.agreement_id = m.agreement_id"""

_SHIFT = "CAST(end_date + INTERVAL 3 MONTH AS DATE)"
_LONG = (
    "(year(end_date) - year(start_date)) * 12 + month(end_date) - month(start_date) + CASE WHEN day(start_date) = day(end_date) "
    "OR (start_date = last_day(start_date) AND end_date = last_day(end_date)) THEN 0 "
    "ELSE (day(end_date) - day(start_date)) / 31.0 END >= 4"
)


def _constraints() -> str:
    parts = []
    loose = {name: f"(SELECT * FROM judged_{name} WHERE reason_code IS NULL)" for name in _ALL}
    for name, key in _KEYS.items():
        parts.append(
            f"SELECT '{name}' AS entity, 'primary_key' AS \"constraint\", count(*) AS violations FROM "
            f"(SELECT {key} FROM {loose[name]} GROUP BY 1 HAVING count(*) > 1)"
        )
    for child, column, parent in (
        ("properties", "location_id", "locations"),
        ("properties", "owner_id", "owners"),
        ("rental_agreements", "property_id", "properties"),
        ("rental_agreements", "tenant_id", "tenants"),
        ("payments", "agreement_id", "rental_agreements"),
    ):
        parts.append(
            f"SELECT '{child}', 'foreign_key_{column}', count(*) FROM {loose[child]} c WHERE NOT EXISTS "
            f"(SELECT 1 FROM {loose[parent]} p WHERE p.{column} = c.{column})"
        )
    for name, constraint, broken in (
        ("properties", "bedrooms_not_negative", "bedrooms < 0"),
        ("properties", "size_positive", "size_sqm <= 0"),
        ("properties", "rent_not_negative", "monthly_rent < 0"),
        ("rental_agreements", "rent_not_negative", "monthly_rent < 0"),
        ("rental_agreements", "date_order", "end_date < start_date"),
        ("payments", "amount_not_negative", "amount < 0"),
    ):
        parts.append(f"SELECT '{name}', '{constraint}', count(*) FROM {loose[name]} WHERE {broken}")
    return " UNION ALL ".join(parts)


def _digest(columns: tuple[str, ...], relation: str) -> str:
    row = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), 'null')" for c in sorted(columns))
    return (
        f"SELECT date_key // 100 AS month_key, count(*) AS row_count, "
        f"CAST(sum(CAST('0x' || substr(md5({row}), 1, 15) AS BIGINT)) AS VARCHAR) AS checksum FROM {relation} GROUP BY 1"
    )


_NUMBERS = ("date_key", "occupancy_rate", "rental_revenue", "average_rent_per_sqm", "amount", "agreement_days", "days_overdue")
_AS_THEY_ARE = ("date_day", "valid_from", "start_date", "end_date", "is_overdue")


def _loosened(model: str, columns: list[str], extra: tuple[str, ...]) -> str:
    """Rows twice, without values, and with other values, by the first digit of the key's hash."""
    key = " || '|' || ".join(f"CAST({c} AS VARCHAR)" for c in checks.key_of(model))
    names = [*columns, *extra]

    def other(column: str) -> str:
        if column in _AS_THEY_ARE:
            return column
        return f"-{column}" if column in _NUMBERS else f"{column} || 'x'"

    digit = f"md5({key})[1]"
    return (
        f"loose_{model} AS (SELECT {', '.join(names)} FROM {model} UNION ALL "
        f"SELECT {', '.join(names)} FROM {model} WHERE {digit} = '0' UNION ALL "
        f"SELECT {', '.join('NULL' for _ in names)} FROM {model} WHERE {digit} = '1' UNION ALL "
        f"SELECT {', '.join(other(c) for c in names)} FROM {model} WHERE {digit} = '2')"
    )


def _data_tests() -> str:
    extra = {
        "fact_rental_agreement": ("start_date", "end_date", "agreement_days"),
        "fact_payment": ("amount", "days_overdue", "is_overdue"),
    }
    views = [_loosened(m, columns, extra.get(m, ())) for m, columns in checks.MODELS.items()]
    keyed = {
        "int_agreements_enriched": "SELECT agreement_id FROM rental_agreements",
        "int_payments_enriched": "SELECT payment_id FROM payments",
    }
    stages = [f"{name} AS ({select})" for name, select in keyed.items()]
    stages += [
        f"{n} AS (SELECT * REPLACE (CAST(size_sqm AS DECIMAL(10,2)) AS size_sqm) , sha256({_FINGERPRINT}) AS record_fingerprint FROM properties)"
        for n in ("fingerprinted",)
    ]
    parts = []

    def add(test: str, model: str, column: str, count: str) -> None:
        parts.append(f"SELECT '{test}' AS test, '{model}' AS model, '{column}' AS column_name, ({count}) AS violations")

    for m, c in checks.UNIQUE_KEYS:
        add("unique", m, c, f"SELECT count(*) FROM (SELECT {c} FROM loose_{m} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
    for m, c in checks.NOT_NULL:
        add("not_null", m, c, f"SELECT count(*) FROM loose_{m} WHERE {c} IS NULL")
    for m, c, values in checks.ACCEPTED_VALUES:
        listed = ", ".join(f"'{v}'" for v in values)
        add("accepted_values", m, c, f"SELECT count(*) FROM loose_{m} WHERE {c} NOT IN ({listed})")
    for m, c, parent, field in checks.RELATIONSHIPS:
        add("relationships", m, c, f"SELECT count(*) FROM loose_{m} WHERE {c} NOT IN (SELECT {field} FROM loose_{parent} WHERE {field} IS NOT NULL)")
    add("agreement_dates", "fact_rental_agreement", "*", "SELECT count(*) FROM loose_fact_rental_agreement WHERE end_date < start_date OR agreement_days <= 0")
    add("occupancy_bounds", "mart_occupancy", "*", "SELECT count(*) FROM loose_mart_occupancy WHERE occupancy_rate < 0 OR occupancy_rate > 1")
    add("payment_financials", "fact_payment", "*", "SELECT count(*) FROM loose_fact_payment WHERE amount < 0 OR days_overdue < 0 OR (NOT is_overdue AND days_overdue <> 0)")
    loose = ", ".join(views).replace("FROM properties", "FROM fingerprinted")
    history = f"property_history AS (SELECT property_id, valid_from FROM ({_HISTORY}) h(property_id, a1, a2, a3, a4, a5, a6, a7, a8, a9, valid_from, a11, a12, a13))"
    pair = _PAIR.removeprefix("WITH ")
    return _star(f", {', '.join(stages)}, {pair}, {history}, {loose} {' UNION ALL '.join(parts)}")


def _strict() -> str:
    """No cascade: parents are all first copies of valid records."""
    parts = [f"SELECT '{n}' AS entity, reason_code AS code FROM judged_{n} WHERE reason_code IS NOT NULL" for n in _ALL]
    parts += [f"SELECT '{n}', 'DUPLICATE_IDENTIFIER' FROM first_{n} WHERE copy_no > 1" for n in _ALL]
    only = {n: f"(SELECT * FROM first_{n} WHERE copy_no = 1)" for n in _ALL}
    parts.append(
        f"""SELECT 'properties', CASE WHEN l.location_id IS NULL THEN 'ORPHAN_LOCATION' ELSE 'ORPHAN_OWNER' END
  FROM {only['properties']} c LEFT JOIN {only['locations']} l USING (location_id) LEFT JOIN {only['owners']} o USING (owner_id)
  WHERE l.location_id IS NULL OR o.owner_id IS NULL"""
    )
    parts.append(
        f"""SELECT 'rental_agreements', CASE WHEN p.property_id IS NULL THEN 'ORPHAN_PROPERTY' ELSE 'ORPHAN_TENANT' END
  FROM {only['rental_agreements']} c LEFT JOIN {only['properties']} p USING (property_id) LEFT JOIN {only['tenants']} t USING (tenant_id)
  WHERE p.property_id IS NULL OR t.tenant_id IS NULL"""
    )
    parts.append(
        f"""SELECT 'payments', CASE WHEN a.agreement_id IS NULL THEN 'ORPHAN_AGREEMENT' ELSE 'PAYMENT_DUE_OUTSIDE_AGREEMENT' END
  FROM {only['payments']} c LEFT JOIN {only['rental_agreements']} a USING (agreement_id)
  WHERE a.agreement_id IS NULL OR due_date NOT BETWEEN a.start_date AND a.end_date"""
    )
    return f"SELECT entity, code, count(*) AS issues FROM ({' UNION ALL '.join(parts)}) GROUP BY 1, 2"


def _counts(relation: str, column: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS entity, count(*) AS {column} FROM {relation.format(n=n)}" for n in _ALL
    )


def _adjusted(select: str, join: str, hit: str, rent: str, action: str) -> str:
    return (
        f"SELECT a.agreement_id, CASE WHEN {hit} THEN {_rounded(rent)} ELSE CAST(a.rent AS DOUBLE) END AS rent, "
        f"a.start_date, a.end_date, a.tenant_no, a.agent_no, a.house_id, CASE WHEN {hit} THEN '{action}' END AS action "
        f"FROM {select} a {join}"
    )


def _late(entity: str, *codes: str) -> str:
    names = ", ".join(f"'{c}'" for c in codes)
    return _batch(
        f"SELECT {_KEYS[entity]}, source_row, reason_code FROM checked_{entity} WHERE reason_code IN ({names})"
    )


_RATE = "CAST(sum({}) AS DOUBLE) / CAST(sum({}) AS DOUBLE)"

SQL: dict[str, str] = {
    "norm_locations": _normal("locations"),
    "norm_people": _batch(
        " UNION ALL ".join(
            f"SELECT '{e}' AS entity, source_row, CASE WHEN reason_code IS NULL THEN {_KEYS[e]} END AS person_id, "
            "CASE WHEN reason_code IS NULL THEN full_name END AS full_name, "
            f"CASE WHEN reason_code IS NULL THEN email END AS email, reason_code FROM judged_{e}"
            for e in ("owners", "tenants")
        )
    ),
    "norm_properties": _normal("properties"),
    "norm_agreements": _normal("rental_agreements"),
    "norm_payments": _normal("payments"),
    "missing_required": _batch(
        " UNION ALL ".join(
            f"SELECT '{e}' AS entity, source_row, 'required value(s) missing: ' || missing AS explanation "
            f"FROM judged_{e} WHERE missing <> ''"
            for e in _ALL
        )
    ),
    "cast_kernels": _batch(
        "SELECT source_row, bedrooms, CAST(size_sqm AS DOUBLE) AS size_sqm, CAST(monthly_rent AS DOUBLE) AS monthly_rent, "
        f"CASE WHEN {_ZONED} THEN CAST(epoch(TRY_CAST(source_timestamp AS TIMESTAMPTZ)) AS BIGINT) END AS source_timestamp "
        "FROM judged_properties"
    ),
    "dedup_first_wins": _batch("SELECT payment_id, source_row, copy_no = 1 AS kept FROM first_payments"),
    "orphan_properties": _late("properties", "ORPHAN_LOCATION", "ORPHAN_OWNER"),
    "orphan_agreements": _late("rental_agreements", "ORPHAN_PROPERTY", "ORPHAN_TENANT"),
    "orphan_payments": _late("payments", "ORPHAN_AGREEMENT"),
    "payment_outside_agreement": _late("payments", "PAYMENT_DUE_OUTSIDE_AGREEMENT"),
    "cascade_rejects": _batch(
        "SELECT entity, reason_code, count(*) AS rejected_rows FROM ("
        + " UNION ALL ".join(
            f"SELECT '{e}' AS entity, reason_code FROM checked_{e} WHERE reason_code IS NOT NULL"
            for e in ("properties", "rental_agreements", "payments")
        )
        + ") GROUP BY 1, 2"
    ),
    "quarantine_rows": _batch(
        "SELECT record_type, source_identifier, 'batch-0001' AS batch_id, reason_code, explanation, "
        f"{_ANCIENT} AS processed_at, raw_record, source_row FROM refused"
    ),
    "reason_counts": _batch("SELECT reason_code, count(*) AS rejected_rows FROM refused GROUP BY 1"),
    "rejection_stats": _batch(
        "SELECT count(*) AS rejected_rows, count(DISTINCT reason_code) AS reason_codes FROM refused"
    ),
    "quality_summary": _batch(
        f"SELECT (SELECT CAST(sum(n) AS BIGINT) FROM ({_counts('raw_{n}', 'n')})) AS input_count, "
        f"(SELECT CAST(sum(n) AS BIGINT) FROM ({_counts('{n}', 'n')})) AS accepted_count, "
        "CAST(sum(n) AS BIGINT) AS rejected_count, "
        "'{' || string_agg('\"' || reason_code || '\":' || n, ',' ORDER BY reason_code) || '}' AS reason_counts "
        "FROM (SELECT reason_code, count(*) AS n FROM refused GROUP BY 1)"
    ),
    "reconcile": _batch(
        f"SELECT entity, input_count, accepted_count, rejected_count, input_count = accepted_count + rejected_count AS balanced "
        f"FROM ({_counts('raw_{n}', 'input_count')}) JOIN ({_counts('{n}', 'accepted_count')}) USING (entity) "
        "JOIN (SELECT record_type AS entity, count(*) AS rejected_count FROM refused GROUP BY 1) USING (entity)"
    ),
    "strict_issues": _batch(_strict()),
    "silver_payments": _batch(
        "SELECT payment_id, agreement_id, due_date, payment_date, CAST(amount AS DOUBLE) AS amount, status, "
        f"{_EPOCH} AS source_timestamp, 'batch-0001' AS batch_id, sha256({_PAYMENT_FINGERPRINT}) AS record_fingerprint, "
        f"{_ANCIENT} AS processed_at FROM payments"
    ),
    "staging_counts": _batch(_counts("{n}", "stored_rows")),
    "fingerprint_properties": _batch(
        f"SELECT property_id, {_FINGERPRINT} AS canonical, sha256({_FINGERPRINT}) AS record_fingerprint FROM properties"
    ),
    "classify_upsert": _PAIR + "SELECT * FROM actions",
    "apply_upsert": _PAIR
    + f"""SELECT {_P.replace('property_id, ', 'i.property_id, ', 1)}, 'batch-0002' AS batch_id, i.fp AS record_fingerprint, {_RECENT} AS processed_at
  FROM incoming i JOIN actions a USING (property_id) WHERE action <> 'skip'
UNION ALL SELECT {_P.replace('property_id, ', 's.property_id, ', 1)}, 'batch-0001', s.fp, {_ANCIENT}
  FROM stored s LEFT JOIN actions a USING (property_id) WHERE action IS NULL OR action = 'skip'""",
    "load_metrics": _PAIR
    + "SELECT 'properties' AS entity, count(*) FILTER (action = 'insert') AS inserted_count, "
    "count(*) FILTER (action = 'update') AS updated_count, count(*) FILTER (action = 'skip') AS skipped_count FROM actions",
    "full_refresh": _PAIR
    + "SELECT 'properties' AS entity, count(*) AS inserted_count, CAST(0 AS BIGINT) AS updated_count, "
    "CAST(0 AS BIGINT) AS skipped_count FROM incoming",
    "upsert_rejections": _batch(
        "SELECT record_type, source_identifier, 'batch-0001' AS batch_id, reason_code, "
        "CASE WHEN reason_code = 'DUPLICATE_IDENTIFIER' THEN 'replayed: ' ELSE '' END || explanation AS explanation, source_row "
        "FROM (SELECT *, row_number() OVER (PARTITION BY source_identifier, reason_code ORDER BY source_row DESC) AS k "
        "FROM refused WHERE record_type = 'payments') WHERE k = 1"
    ),
    "constraint_checks": _batch(_constraints()),
    "scd2_property_history": _PAIR + _HISTORY,
    "int_agreements_enriched": _batch(
        "SELECT agreement_id, a.property_id, a.tenant_id, p.owner_id, p.location_id, start_date, end_date, "
        "CAST(a.monthly_rent AS DOUBLE) AS monthly_rent, a.status, property_type, bedrooms, CAST(size_sqm AS DOUBLE) AS size_sqm, "
        "currency, city, region, o.full_name AS owner_name, t.full_name AS tenant_name FROM rental_agreements a "
        "JOIN properties p USING (property_id) JOIN locations l ON p.location_id = l.location_id "
        "JOIN owners o ON p.owner_id = o.owner_id JOIN tenants t USING (tenant_id)"
    ),
    "int_payments_enriched": _batch(
        "SELECT payment_id, y.agreement_id, a.property_id, tenant_id, owner_id, p.location_id, due_date, payment_date, "
        "CAST(amount AS DOUBLE) AS amount, y.status, city, region, CAST(size_sqm AS DOUBLE) AS size_sqm, "
        "CAST(a.monthly_rent AS DOUBLE) AS monthly_rent FROM payments y JOIN rental_agreements a USING (agreement_id) "
        "JOIN properties p ON a.property_id = p.property_id JOIN locations l ON p.location_id = l.location_id"
    ),
    **{name: _star(f"SELECT * FROM {name}") for name in ("dim_date", "dim_location", "dim_owner", "dim_tenant", "dim_property", "mart_occupancy", "mart_monthly_rental_revenue", "mart_average_rent_per_sqm")},
    "fact_occupancy": _star(
        "SELECT rental_agreement_key, property_key, location_key, tenant_key, CAST(sum(occupied_day) AS BIGINT) AS occupied_days, "
        "count(DISTINCT occupancy_key) AS occupancy_keys, min(occupancy_key) AS lowest_key, max(occupancy_key) AS highest_key, "
        "min(date_key) AS first_date_key, max(date_day) AS last_day FROM fact_occupancy GROUP BY 1, 2, 3, 4"
    ),
    "fact_occupancy_digest": _star(
        _digest(
            ("occupancy_key", "rental_agreement_key", "property_key", "location_key", "tenant_key", "date_key", "date_day", "occupied_day"),
            "fact_occupancy",
        )
    ),
    "data_test_report": _data_tests(),
    "load_all_entities": _batch(
        " UNION ALL ".join(
            f"SELECT '{n}' AS entity, count(*) FILTER (right({k}, 1) = '7') AS inserted_count, "
            f"count(*) FILTER (right({k}, 1) = '3') AS updated_count, count(*) FILTER (right({k}, 1) NOT IN ('3', '7')) AS skipped_count, "
            f"count(*) + count(*) FILTER (right({k}, 1) = '7') AS state_rows, "
            f"count(*) + count(*) FILTER (right({k}, 1) = '7') AS batch_rows FROM {n}"
            for n, k in _KEYS.items()
        )
    ),
    "refresh_all_entities": _batch(
        " UNION ALL ".join(
            f"SELECT '{n}' AS entity, count(*) AS inserted_count, CAST(0 AS BIGINT) AS updated_count, "
            f"CAST(0 AS BIGINT) AS skipped_count FROM {n}"
            for n in _ALL
        )
    ),
    "fact_rental_agreement": _star(
        "SELECT * REPLACE (CAST(monthly_rent AS DOUBLE) AS monthly_rent) FROM fact_rental_agreement"
    ),
    "fact_payment": _star("SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM fact_payment"),
    "mart_overdue_payments": _star(
        "SELECT payment_key, payment_id, rental_agreement_key, property_key, location_key, city, due_date, payment_date, "
        "CAST(amount AS DOUBLE) AS amount, days_overdue, status FROM fact_payment JOIN dim_location USING (location_key) WHERE is_overdue"
    ),
    "mart_agreements_expiring_soon": _star("SELECT * FROM mart_expiring"),
    "mart_rental_trends_by_location": _star("SELECT * FROM mart_rental_trends"),
    "bi_payments_extract": _star(
        "SELECT city, due_date, payment_date, CAST(amount AS DOUBLE) AS amount, status, is_overdue "
        "FROM fact_payment JOIN dim_location USING (location_key)"
    ),
    "payments_for_agreement": _batch(
        "SELECT payment_id, due_date, payment_date, CAST(amount AS DOUBLE) AS amount, status FROM payments "
        f"WHERE agreement_id = '{DRILL_THROUGH}' ORDER BY due_date"
    ),
    "check_unique": _batch(
        "SELECT payment_id, count(*) AS occurrences FROM judged_payments WHERE payment_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1"
    ),
    "check_not_null": _batch("SELECT property_id, source_row FROM judged_properties WHERE size_sqm IS NULL"),
    "check_accepted_values": _batch(
        "SELECT country_code, count(*) AS occurrences FROM locations WHERE country_code NOT IN ('PL', 'DE', 'CZ', 'SK') GROUP BY 1"
    ),
    "check_relationships": _batch(
        "SELECT property_id, owner_id, source_row FROM judged_properties p WHERE owner_id IS NOT NULL AND NOT EXISTS "
        "(SELECT 1 FROM judged_owners o WHERE o.owner_id = p.owner_id)"
    ),
    "check_agreement_dates": _batch(
        "SELECT agreement_id FROM judged_rental_agreements WHERE end_date < start_date OR end_date - start_date + 1 <= 0"
    ),
    "check_occupancy_bounds": _star(
        "SELECT location_key, month_start_date, CAST(occupancy_rate AS DOUBLE) * 2 AS occupancy_rate FROM mart_occupancy "
        "WHERE CAST(occupancy_rate AS DOUBLE) * 2 NOT BETWEEN 0 AND 1"
    ),
    "check_payment_financials": _star(
        "SELECT payment_id FROM fact_payment WHERE amount < 0 OR days_overdue - 1 < 0 OR (NOT is_overdue AND days_overdue - 1 <> 0)"
    ),
    "measure_occupancy_rate": _star(
        f"SELECT region, {_RATE.format('occupied_property_days', 'available_property_days')} AS occupancy_rate FROM mart_occupancy GROUP BY 1"
    ),
    "measure_revenue": _star(
        "SELECT region, CAST(sum(CAST(rental_revenue AS DECIMAL(18,2))) AS DOUBLE) AS rental_revenue FROM mart_monthly_rental_revenue GROUP BY 1"
    ),
    "measure_rent_per_sqm": _star(
        "SELECT region, CAST(sum(CAST(average_rent_per_sqm AS DECIMAL(12,2)) * property_count) AS DOUBLE) "
        "/ CAST(sum(property_count) AS DOUBLE) AS rent_per_sqm FROM mart_average_rent_per_sqm GROUP BY 1"
    ),
    "measure_overdue_rate": _star(
        "SELECT city, CAST(count(*) FILTER (is_overdue) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS overdue_rate "
        "FROM fact_payment JOIN dim_location USING (location_key) GROUP BY 1"
    ),
    "measure_expiring": _star("SELECT city, count(*) AS expiring_agreements FROM mart_expiring GROUP BY 1"),
    "measure_overdue_rate_by_due_date": _star(
        "SELECT due_date, CAST(count(*) FILTER (is_overdue) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS overdue_rate "
        "FROM fact_payment JOIN dim_location USING (location_key) GROUP BY 1"
    ),
    "measure_overdue_rate_total": _star(
        "SELECT CAST(count(*) FILTER (is_overdue) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS overdue_rate "
        "FROM fact_payment JOIN dim_location USING (location_key)"
    ),
    "measure_expiring_by_end_date": _star(
        "SELECT end_date, count(*) AS expiring_agreements FROM mart_expiring GROUP BY 1"
    ),
    "measure_expiring_total": _star("SELECT count(*) AS expiring_agreements FROM mart_expiring"),
    "measure_occupancy_rate_total": _star(
        f"SELECT {_RATE.format('occupied_property_days', 'available_property_days')} AS occupancy_rate FROM mart_occupancy"
    ),
    "measure_revenue_by_month": _star(
        "SELECT revenue_month, CAST(sum(CAST(rental_revenue AS DECIMAL(18,2))) AS DOUBLE) AS rental_revenue FROM mart_monthly_rental_revenue GROUP BY 1"
    ),
    "measure_rent_per_sqm_total": _star(
        "SELECT CAST(sum(CAST(average_rent_per_sqm AS DECIMAL(12,2)) * property_count) AS DOUBLE) "
        "/ CAST(sum(property_count) AS DOUBLE) AS rent_per_sqm FROM mart_average_rent_per_sqm"
    ),
    **{
        name: _star(f"SELECT {columns} FROM {mart}")
        for name, mart, columns in (
            ("bi_occupancy_extract", "mart_occupancy", "city, region, month_start_date, occupied_property_days, available_property_days"),
            ("bi_revenue_extract", "mart_monthly_rental_revenue", "city, region, revenue_month, rental_revenue"),
            ("bi_rent_per_sqm_extract", "mart_average_rent_per_sqm", "city, region, property_count, average_rent_per_sqm"),
            ("bi_expiring_extract", "mart_expiring", "agreement_id, city, end_date, days_until_expiration"),
            ("bi_trends_extract", "mart_rental_trends", "city, region, agreement_month, average_monthly_rent"),
        )
    },
    "measure_rent_trend": _trend("region"),
    "measure_rent_trend_by_city": _trend("city"),
    "measure_rent_trend_total": _trend(),
    "legacy_q01": _legacy(
        "SELECT first_name, last_name, years FROM person JOIN owner USING (person_no) JOIN space ON owner_no = person_no WHERE area > 100"
    ),
    "legacy_q02": _legacy(
        "SELECT space_id, city FROM space JOIN owner ON owner_no = person_no WHERE years > 10"
    ),
    "legacy_q03": _legacy(
        "SELECT last_name FROM person JOIN owner USING (person_no) JOIN space ON owner_no = person_no GROUP BY 1 HAVING count(space_id) = 1"
    ),
    "legacy_q04": _legacy(
        "SELECT firm FROM agent JOIN agreement ON agent_no = person_no GROUP BY 1 HAVING count(agreement_id) > 5"
    ),
    "legacy_q05": _legacy(
        "SELECT first_name, last_name FROM tenant JOIN person USING (person_no) JOIN agreement ON tenant_no = person_no "
        "GROUP BY person_no, first_name, last_name HAVING count(agreement_id) > (SELECT count(*) FROM agreement "
        "JOIN tenant t2 ON tenant_no = t2.person_no WHERE CAST(t2.person_no AS VARCHAR) LIKE '%0013') AND avg(rent) > 2000"
    ),
    "legacy_q06": _legacy(
        "SELECT space.* FROM space JOIN house USING (space_id) JOIN agreement USING (house_id) WHERE rent > (SELECT avg(rent) FROM agreement)"
    ),
    "legacy_q07": _legacy(
        f"SELECT {_A} FROM placed WHERE rent > (SELECT avg(rent) FROM placed WHERE city = 'NATION_3')"
    ),
    "legacy_q08": _legacy(
        "SELECT first_name, last_name FROM tenant JOIN person USING (person_no) WHERE person_no NOT IN (SELECT person_no FROM owner)"
    ),
    "legacy_q09": _legacy(
        "SELECT first_name, last_name FROM owner JOIN person USING (person_no) JOIN space ON owner_no = person_no "
        "GROUP BY 1, 2 HAVING max(space.area) > (SELECT avg(area) FROM space)"
    ),
    "legacy_q10": _legacy(
        "SELECT first_name, last_name FROM tenant JOIN person USING (person_no) JOIN agreement ON tenant_no = person_no "
        "GROUP BY 1, 2 HAVING avg(rent) > (SELECT avg(rent) FROM agreement)"
    ),
    "legacy_q11": _legacy(
        f"SELECT {_A} FROM placed p WHERE rent = (SELECT max(rent) FROM placed q WHERE q.owner_no = p.owner_no)"
    ),
    "legacy_q12": _legacy(
        f"SELECT {_H}, market_price FROM house WHERE market_price > (SELECT max(market_price) FROM house "
        "JOIN space USING (space_id) JOIN person ON owner_no = person_no WHERE last_name = 'Nowak')"
    ),
    "legacy_q13": _legacy(
        "SELECT first_name, last_name FROM tenant JOIN person USING (person_no) JOIN agreement ON tenant_no = person_no "
        "GROUP BY 1, 2 HAVING count(agreement_id) > (SELECT avg(n) FROM (SELECT count(*) AS n FROM placed WHERE space_area > 100 GROUP BY owner_no))"
    ),
    "raise_rents_in_range": _legacy(
        _adjusted(
            "agreement",
            "LEFT JOIN house USING (house_id)",
            f"a.start_date BETWEEN DATE '1999-07-01' AND DATE '2000-06-01' AND a.end_date > DATE '{AS_OF}' AND upkeep < 900",
            "CAST(a.rent AS DECIMAL(14,2)) * 1.07",
            "RENT_RAISED",
        )
    ),
    "bonus_owner": _legacy(
        f"SELECT {_H}, CASE WHEN hit THEN {_rounded('CAST(market_price AS DECIMAL(12,0)) * 1.02')} "
        "ELSE CAST(market_price AS DOUBLE) END AS market_price, CASE WHEN hit THEN 'OWNER_BONUS' END AS action "
        "FROM (SELECT house.*, owner_no IN (SELECT person_no FROM person JOIN owner USING (person_no) "
        "WHERE first_name = 'Given7' AND last_name = 'Nowak') AS hit FROM house JOIN space USING (space_id))"
    ),
    "bonus_tenant": _legacy(
        _adjusted(
            "agreement",
            "",
            "a.tenant_no IN (SELECT person_no FROM person JOIN tenant USING (person_no) WHERE first_name = 'Given7' AND last_name = 'Tenant27')",
            "CAST(a.rent AS DECIMAL(14,2)) * 0.90",
            "TENANT_BONUS",
        )
    ),
    "city_price_correction": _legacy(
        """, scaled AS (SELECT * REPLACE (CAST(CAST(rent * 100 AS BIGINT) * (100 - (house_id // 4) % 25 * 2) AS HUGEINT) AS rent) FROM agreement),
cents AS (SELECT s.* REPLACE ((s.rent + 50) // 100 AS rent), city FROM scaled s JOIN placed p USING (agreement_id)),
means AS (SELECT city, sum(rent) AS local_sum, count(*) AS local_n FROM cents GROUP BY 1),
ladder AS (SELECT city, CASE WHEN 100 * local_sum * all_n < 75 * all_sum * local_n THEN 120
    WHEN 100 * local_sum * all_n < 85 * all_sum * local_n THEN 110 END AS factor
  FROM means, (SELECT sum(rent) AS all_sum, count(*) AS all_n FROM cents))
SELECT agreement_id, CASE WHEN factor IS NULL THEN rent ELSE (rent * factor + 50) // 100 END / 100.0 AS rent, start_date, end_date,
  tenant_no, agent_no, house_id, CASE WHEN factor IS NOT NULL THEN 'CITY_CORRECTION' END AS action FROM cents JOIN ladder USING (city)"""
    ),
    "extend_agent_agreements": _legacy(
        f"SELECT agreement_id, CAST(CASE WHEN mine AND {_LONG} THEN rent + 150 ELSE rent END AS DOUBLE) AS rent, start_date, "
        f"CASE WHEN NOT (mine AND {_LONG}) THEN end_date WHEN end_date = last_day(end_date) THEN last_day({_SHIFT}) ELSE {_SHIFT} END AS end_date, "
        f"tenant_no, agent_no, house_id, CASE WHEN mine AND {_LONG} THEN 'EXTENDED' WHEN mine THEN 'TOO_SHORT' END AS action "
        "FROM (SELECT *, coalesce(agent_no = 30000000007, false) AS mine FROM agreement)"
    ),
    "upkeep_shock": _legacy(
        _adjusted(
            "agreement",
            "JOIN house USING (house_id)",
            "garage = 'Y' AND upkeep * 11 // 10 > 1000 AND upkeep * 11 // 10 <> upkeep",
            "CAST(a.rent AS DECIMAL(14,2)) * 1.05",
            "UPKEEP_SHOCK",
        )
    ),
    "reassign_agent": _legacy(_REASSIGN),
    "clamp_agreement_terms": _legacy(
        """, stretched AS (SELECT * REPLACE (start_date + CAST((end_date - start_date) * 5 - 155 AS INTEGER) AS end_date), end_date AS original FROM placed),
clamped AS (SELECT *, CASE WHEN city = 'NATION_3' THEN least(term + 30, start_date + 1095) ELSE term END AS new_end
  FROM (SELECT *, least(greatest(end_date, start_date + 30), start_date + 1095) AS term FROM stretched))
SELECT agreement_id, CAST(greatest(rent, 1000) AS DOUBLE) AS rent, start_date, new_end AS end_date, tenant_no, agent_no, house_id,
  nullif(concat_ws('+', CASE WHEN new_end <> end_date THEN 'END_DATE' END, CASE WHEN rent < 1000 THEN 'RENT' END), '') AS action FROM clamped"""
    ),
    "overlapping_agreements": _legacy(
        f"SELECT a.agreement_id, a.house_id, a.start_date, a.end_date, count(*) AS conflicts FROM agreement a JOIN agreement b "
        f"ON a.house_id = b.house_id AND a.agreement_id <> b.agreement_id AND {_overlap('a', 'b')} GROUP BY ALL"
    ),
    "free_house_assignment": _legacy(_placement()),
}
