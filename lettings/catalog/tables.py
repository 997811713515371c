"""Rental extracts derived from the shared TPC-H-like tables.

Every extract column is text and some records are deliberately broken, so the registered queries
go through the same validation, duplicate and relationship steps as a real batch. The SQL twin of
this mapping is in ``oracle.py``; constants below appear in both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lettings.model import ROW
from lettings.operators.quality import Assessed, assess
from lettings.sources.bronze import numbered_parquet

BATCH = "batch-0001"
AS_OF = "2000-06-30"
STAMP = "2024-01-01T00:00:00+00:00"


def as_of() -> Column:
    return F.to_date(F.lit(AS_OF))


def processed_at() -> Column:
    return F.timestamp_seconds(F.lit(1704067200))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _numbered(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return numbered_parquet(spark, f"{folder}/{name}.parquet")


def _pick(number: Column, *values: str) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (number % len(values)).cast("int") + 1)


def _id(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def _every(number: Column, step: int, rest: int) -> Column:
    return number % step == rest


def size_of(spark: SparkSession, folder: str, name: str) -> Column:
    return table(spark, folder, name).agg(F.count(F.lit(1)).alias("n")).scalar()


def raw_locations(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("n_nationkey")
    regions = table(spark, folder, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return _numbered(spark, folder, "nation").join(regions, "n_regionkey").select(
        ROW,
        F.when(_every(k, 7, 3), F.concat(F.lit(" LOC-"), k.cast("string"), F.lit("\t")))
        .otherwise(_id("LOC-", k))
        .alias("location_id"),
        F.when(_every(k, 5, 0), F.concat(F.lit("  "), F.upper("n_name"), F.lit(" ")))
        .otherwise(F.lower("n_name"))
        .alias("city"),
        F.lower("r_name").alias("region"),
        F.when(k == 24, "P1").otherwise(_pick(k, "pl", "DE", " fr ")).alias("country_code"),
        F.when(k == 23, "2024-01-01T00:00:00")
        .otherwise(_pick(k, "2024-01-01T00:00:00Z", "2024-01-01T02:00:00+02:00"))
        .alias("source_timestamp"),
    )


def raw_owners(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("s_suppkey")
    return _numbered(spark, folder, "supplier").select(
        ROW,
        _id("OWN-", k).alias("owner_id"),
        F.when(_every(k, 59, 11), "")
        .otherwise(F.concat(F.lit(" "), F.replace("s_name", F.lit("#"), F.lit("   "))))
        .alias("full_name"),
        F.when(_every(k, 53, 7), _id("owner", k))
        .otherwise(F.concat(F.lit(" Owner"), k.cast("string"), F.lit("@Example.com")))
        .alias("email"),
        F.lit(STAMP).alias("source_timestamp"),
    )


def raw_tenants(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("c_custkey")
    return _numbered(spark, folder, "customer").select(
        ROW,
        F.when(_every(k, 211, 17), "   ").otherwise(_id("TEN-", k)).alias("tenant_id"),
        F.when(~_every(k, 199, 4), F.col("c_name")).alias("full_name"),
        F.when(_every(k, 199, 4), "")
        .otherwise(F.concat(F.lit("TENANT"), k.cast("string"), F.lit("@example.com")))
        .alias("email"),
        F.lit(STAMP).alias("source_timestamp"),
    )


def raw_properties(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("p_partkey")
    size = F.col("p_size").cast("string")
    owners = size_of(spark, folder, "supplier") + 1
    return _numbered(spark, folder, "part").select(
        ROW,
        _id("PRP-", F.when(_every(k, 101, 50), k - 1).otherwise(k)).alias("property_id"),
        _id("LOC-", k % 26).alias("location_id"),
        _id("OWN-", k % owners).alias("owner_id"),
        F.when(_every(k, 89, 3), "")
        .when(_every(k, 149, 9), "castle")
        .otherwise(_pick(k, "Apartment", "HOUSE", " studio "))
        .alias("property_type"),
        F.when(_every(k, 163, 20), "2.5")
        .when(_every(k, 167, 21), "21")
        .when(_every(k, 13, 1), F.concat(F.lit(" +"), (F.col("p_size") % 6).cast("string")))
        .otherwise((F.col("p_size") % 6).cast("string"))
        .alias("bedrooms"),
        F.when(_every(k, 97, 5), "-5.00")
        .when(_every(k, 83, 6), "abc")
        .when(_every(k, 4, 1), F.concat(size, F.lit(".125")))
        .otherwise(F.concat(size, F.lit(".00")))
        .alias("size_sqm"),
        F.when(_every(k, 103, 8), "-100.00")
        .otherwise(F.col("p_retailprice").cast("decimal(12,2)").cast("string"))
        .alias("monthly_rent"),
        F.when(_every(k, 107, 10), "GBP").otherwise(_pick(k, " pln", "EUR", "usd")).alias("currency"),
        F.when(_every(k, 109, 12), "yesterday").otherwise(STAMP).alias("source_timestamp"),
    )


def order_start() -> Column:
    return F.col("o_orderdate").cast("date")


def order_end() -> Column:
    return F.date_add(order_start(), (F.lit(30) + F.col("o_orderkey") % 336).cast("int"))


def order_rent() -> Column:
    return (F.floor("o_totalprice").cast("decimal(10,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(
        "decimal(12,2)"
    )


def raw_agreements(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("o_orderkey")
    end = F.when(_every(k, 131, 4), F.date_sub(order_start(), 1)).otherwise(order_end())
    return _numbered(spark, folder, "orders").select(
        ROW,
        _id("AGR-", k).alias("agreement_id"),
        _id("PRP-", k % size_of(spark, folder, "part")).alias("property_id"),
        _id("TEN-", F.col("o_custkey")).alias("tenant_id"),
        F.when(_every(k, 127, 3), "2024-02-30")
        .otherwise(order_start().cast("string"))
        .alias("start_date"),
        end.cast("string").alias("end_date"),
        F.when(_every(k, 137, 5), "-1")
        .when(_every(k, 139, 6), "n/a")
        .otherwise(order_rent().cast("string"))
        .alias("monthly_rent"),
        F.when(_every(k, 151, 7), "paused")
        .when(F.col("o_orderstatus") == "O", "active")
        .when(F.col("o_orderstatus") == "F", "Expired")
        .otherwise(" TERMINATED ")
        .alias("status"),
        F.lit(STAMP).alias("source_timestamp"),
    )


def raw_payments(spark: SparkSession, folder: str) -> DataFrame:
    part, supplier = F.col("l_partkey"), F.col("l_suppkey")
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"
    )
    due = F.date_add(order_start(), 30 * (F.col("l_linenumber") - 1))
    paid = F.date_add(due, (supplier % 7 - 2).cast("int"))
    order = F.col("l_orderkey").cast("string")
    return _numbered(spark, folder, "lineitem").join(orders, "l_orderkey").select(
        ROW,
        F.concat(F.lit("PAY-"), order, F.lit("-"), F.col("l_linenumber").cast("string")).alias(
            "payment_id"
        ),
        F.concat(F.when(_every(part, 157, 8), "AGR-X").otherwise("AGR-"), order).alias(
            "agreement_id"
        ),
        due.cast("string").alias("due_date"),
        F.when(_every(supplier, 61, 9), "not-a-date")
        .otherwise(paid.cast("string"))
        .alias("payment_date"),
        F.when(_every(part, 163, 9), "1000000.01")
        .when(_every(part, 167, 10), "NaN")
        .otherwise(F.col("l_extendedprice").cast("decimal(12,2)").cast("string"))
        .alias("amount"),
        F.when(_every(part, 173, 11), "unknown")
        .when(F.col("l_returnflag") == "R", "overdue")
        .when(F.col("l_returnflag") == "A", "paid")
        .otherwise("Pending")
        .alias("status"),
        F.lit(STAMP).alias("source_timestamp"),
    )


RAW = {
    "locations": raw_locations,
    "owners": raw_owners,
    "tenants": raw_tenants,
    "properties": raw_properties,
    "rental_agreements": raw_agreements,
    "payments": raw_payments,
}


def raw_batch(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: build(spark, folder) for name, build in RAW.items()}


def assessed_batch(spark: SparkSession, folder: str) -> dict[str, Assessed]:
    return assess(raw_batch(spark, folder), batch_id=BATCH, processed_at=processed_at())


def accepted_state(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Current state after the first batch: exactly its accepted records."""
    return {name: part.accepted for name, part in assessed_batch(spark, folder).items()}


def property_states(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Two raw property extracts over the whole part table: stored, then incoming.

    Every tenth incoming key is new (so its old key is absent) and every fifth rent is higher.
    """
    k = F.col("p_partkey")
    parts = _numbered(spark, folder, "part")
    total = size_of(spark, folder, "part")

    def extract(key: Column, rent: Column) -> DataFrame:
        return parts.select(
            ROW,
            _id("PRP-", key).alias("property_id"),
            _id("LOC-", k % 23).alias("location_id"),
            _id("OWN-", k % 7).alias("owner_id"),
            _pick(k, "apartment", "house", "studio").alias("property_type"),
            (F.col("p_size") % 6).cast("string").alias("bedrooms"),
            F.concat(F.col("p_size").cast("string"), F.lit(".00")).alias("size_sqm"),
            rent.cast("decimal(12,2)").cast("string").alias("monthly_rent"),
            F.lit("PLN").alias("currency"),
            F.lit(STAMP).alias("source_timestamp"),
        )

    price = F.col("p_retailprice").cast("decimal(12,2)")
    later = F.when(_every(k, 5, 2), price + 250).otherwise(price)
    return (
        extract(k, price),
        extract(F.when(_every(k, 10, 0), k + total).otherwise(k), later),
    )


OWNER_BASE, TENANT_BASE, AGENT_BASE = 10_000_000_000, 20_000_000_000, 30_000_000_000


def legacy_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The older relational schema: four parts make a space, each part is a house.

    One tenant holds a third of all agreements, so the queries run on a skewed key.
    """
    s, c, p, o = (F.col(n) for n in ("s_suppkey", "c_custkey", "p_partkey", "o_orderkey"))
    suppliers, customers = table(spark, folder, "supplier"), table(spark, folder, "customer")
    parts, orders = table(spark, folder, "part"), table(spark, folder, "orders")
    n_suppliers = size_of(spark, folder, "supplier")
    n_customers = size_of(spark, folder, "customer")
    n_parts = size_of(spark, folder, "part")

    def tenant_no(key: Column) -> Column:
        both = F.lit(OWNER_BASE) + F.expr("custkey div 40")
        return F.when(key % 40 == 0, both).otherwise(key + TENANT_BASE)

    shared = F.expr("CASE WHEN s_suppkey % 5 = 0 THEN s_suppkey div 10 ELSE s_suppkey END")
    surname = F.when(_every(s, 50, 7), "Nowak").otherwise(_id("Owner", shared))
    owners = suppliers.select(
        (s + OWNER_BASE).alias("person_no"),
        _id("Given", s % 20).alias("first_name"),
        surname.alias("last_name"),
        (s % 15).cast("int").alias("years"),
    )
    tenants = customers.withColumn("custkey", c).select(
        "c_custkey", tenant_no(c).alias("person_no"), F.lower("c_mktsegment").alias("reason")
    )
    agents = customers.select(
        (c + AGENT_BASE).alias("person_no"), _id("Firm", F.col("c_nationkey")).alias("firm")
    )
    persons = (
        owners.select("person_no", "first_name", "last_name")
        .unionByName(
            tenants.filter(F.col("person_no") >= TENANT_BASE).select(
                "person_no",
                _id("Given", c % 20).alias("first_name"),
                _id("Tenant", c).alias("last_name"),
            )
        )
        .unionByName(
            customers.select(
                (c + AGENT_BASE).alias("person_no"),
                _id("Given", c % 20).alias("first_name"),
                _id("Agent", c).alias("last_name"),
            )
        )
    )
    space_id = F.expr("p_partkey div 4")
    cities = table(spark, folder, "nation").select(
        F.col("n_nationkey").cast("long").alias("_city"), F.col("n_name").alias("city")
    )
    # Irregular on purpose: owners hold from one to many spaces.
    scattered = F.expr(
        "(space_id % 1000003) * (space_id % 1000003) % 1000003 * 104729 % 1000003"
    )
    spaces = (
        parts.groupBy(space_id.alias("space_id"))
        .agg(F.sum("p_size").alias("area"))
        .withColumn("_city", F.col("space_id") % 25)
        .join(cities, "_city")
        .select(
            "space_id",
            "area",
            "city",
            (scattered % n_suppliers + OWNER_BASE).alias("owner_no"),
        )
    )
    houses = parts.select(
        p.alias("house_id"),
        space_id.alias("space_id"),
        F.col("p_size").alias("area"),
        (F.col("p_size") % 3 + 1).alias("floors"),
        F.when(p % 2 == 0, "Y").otherwise("N").alias("garage"),
        (p * 37 % 1500 + 100).alias("upkeep"),
        F.floor(F.col("p_retailprice") * 10).alias("market_price"),
    )
    customer = F.when(o % 3 == 0, F.lit(1).cast("long")).otherwise(F.col("o_custkey"))
    agreements = orders.withColumn("custkey", customer).select(
        o.alias("agreement_id"),
        order_rent().alias("rent"),
        order_start().alias("start_date"),
        order_end().alias("end_date"),
        tenant_no(F.col("custkey")).alias("tenant_no"),
        F.when(o % 4 != 3, o * 7 % n_customers + AGENT_BASE).alias("agent_no"),
        (o % n_parts).alias("house_id"),
    )
    return {
        "person": persons,
        "owner": owners.select("person_no", "years"),
        "tenant": tenants.select("person_no", "reason"),
        "agent": agents,
        "space": spaces,
        "house": houses,
        "agreement": agreements,
    }
