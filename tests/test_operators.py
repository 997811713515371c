from __future__ import annotations

import hashlib
import random
import threading
import time
from datetime import date, datetime, timedelta
from functools import partial
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from lettings import session
from lettings.catalog import queries
from lettings.functions.dates import add_months_sticky
from lettings.model import ENTITIES, PipelineError
from lettings.operators import checks, history, intervals, measures, quality, ranking, upsert
from lettings.plans import adjustments, star

DAY0 = date(2024, 1, 1)


def day(n: int) -> date:
    return DAY0 + timedelta(days=n)


def random_intervals(seed: int, count: int, keys: int, span: int = 120):
    """A third of all rows share one key."""
    rng = random.Random(seed)
    result = []
    for i in range(count):
        key = 0 if i % 3 == 0 else rng.randrange(keys)
        start = rng.randrange(span)
        result.append((i, key, day(start), day(start + rng.randrange(9))))
    return result


def overlap(a, b) -> bool:
    return a[2] <= b[3] and b[2] <= a[3]


def test_running_totals_equal_a_plain_window_on_a_hot_group(spark):
    rng = random.Random(5)
    rows = [(("hot" if i % 3 == 0 else f"g{i % 7}"), i * i, rng.randrange(9)) for i in range(300)]
    frame = spark.createDataFrame(rows, "g string, o long, v long")
    found = ranking.earlier_total(frame, ["g"], "o", F.col("v"), "t", buckets=8).collect()
    assert len(found) == 300
    for row in found:
        assert row.t == sum(v for g, o, v in rows if g == row.g and o < row.o)
    places = ranking.position(frame, ["g"], "o", "p", buckets=5).filter("g = 'hot'").collect()
    assert sorted(row.p for row in places) == list(range(100))


def test_running_totals_in_cut_groups_equal_a_plain_window(spark):
    rng = random.Random(6)
    rows = [(("hot" if i % 3 == 0 else f"g{i % 7}"), i * i, rng.randrange(9)) for i in range(300)]
    frame = spark.createDataFrame(rows, "g string, o long, v long")
    for buckets in (5, 70):
        found = ranking.earlier_total(frame, ["g"], "o", F.col("v"), "t", buckets=buckets, small=20).collect()
        assert len(found) == 300
        for row in found:
            assert row.t == sum(v for g, o, v in rows if g == row.g and o < row.o)


def test_buckets_follow_the_content(spark):
    """Clustered numbers and one outlier: equal widths would put all but one row into one bucket."""
    frame = spark.range(6000).select(
        F.lit("hot").alias("g"), F.when(F.col("id") == 5999, 10**15).otherwise(F.col("id")).alias("o")
    )
    cut = ranking.bucketed(frame, ["g"], "o", buckets=64, small=100)
    sizes = cut.groupBy("_bucket").agg(F.count("o").alias("n"), F.min("o").alias("lo"), F.max("o").alias("hi"))
    rows = sizes.orderBy("_bucket").collect()
    assert sum(r.n for r in rows) == 6000 and max(r.n for r in rows) < 600
    assert all(a.hi < b.lo for a, b in zip(rows, rows[1:], strict=False))


def test_digest_sees_one_swapped_day(spark):
    rows = [(i, f"k{i}", day(i)) for i in range(20)]
    frame = spark.createDataFrame(rows, "id long, k string, d date")
    swapped = spark.createDataFrame([*rows[:-2], (18, "k18", day(19)), (19, "k19", day(18))], "id long, k string, d date")
    again = checks.digest(frame.repartition(3).orderBy(F.desc("id"))).first()
    assert checks.digest(frame).first() == again
    assert checks.digest(swapped).first().checksum != again.checksum


def test_every_kind_of_data_test_finds_loosened_rows(spark):
    frame = spark.range(400).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.lit("a").alias("v"), F.lit(5).alias("n"))
    loose = checks.loosened(frame, "k")
    assert checks.unique(loose, "k").count() > 0
    assert checks.not_null(loose, "v").count() > 0
    assert checks.accepted_values(loose, "v", ("a",)).count() == 1
    assert checks.relationships(loose, "k", frame, "k").count() > 0
    assert loose.filter("n < 0").count() > 0
    assert checks.not_null(frame, "v").count() == 0


def test_conflict_counts_against_brute_force(spark):
    booked, asked = random_intervals(1, 120, 6), random_intervals(2, 60, 6)
    ddl = "id long, house long, start_date date, end_date date"
    counted = intervals.conflict_counts(
        spark.createDataFrame(asked, ddl), spark.createDataFrame(booked, ddl), "house"
    ).collect()
    assert len(counted) == len(asked)
    for row in counted:
        assert row.conflicts == sum(
            b[1] == row.house and overlap(b, (0, 0, row.start_date, row.end_date)) for b in booked
        )


def place(asked, booked, houses):
    """Waves of requests, each house serving by start and id; plain loops over all pairs."""
    space, taken = dict(houses), [(h, s, e) for _, h, s, e in booked]
    result, waiting = {}, sorted(asked, key=lambda r: (r[2], r[0]))

    def free(house, r):
        return not any(h == house and s <= r[3] and r[2] <= e for h, s, e in taken)

    while waiting:
        wishes = [
            (r, r[1] if free(r[1], r) else min((h for h in space if space[h] == space[r[1]] and free(h, r)), default=None))
            for r in waiting
        ]
        waiting, granted = [], []
        for r, house in wishes:
            if house is None:
                result[r[0]] = ("REJECTED", None)
            elif any(h == house and s <= r[3] and r[2] <= e for h, s, e in granted):
                waiting.append(r)
            else:
                granted.append((house, r[2], r[3]))
                result[r[0]] = ("KEPT" if house == r[1] else "MOVED", house)
        taken += granted
    return result


def test_free_house_assignment_against_brute_force(spark):
    houses = [(h, h // 4) for h in range(12)]
    booked, asked = random_intervals(3, 120, 10), random_intervals(4, 140, 12)
    ddl = "agreement_id long, house_id long, start_date date, end_date date"
    rows = adjustments.free_house_assignment(
        spark.createDataFrame(asked, ddl),
        spark.createDataFrame(booked, ddl),
        spark.createDataFrame(houses, "house_id long, space_id long"),
        as_of=F.lit(day(0)),
    ).collect()
    expected = place(asked, booked, houses)
    assert len(rows) == len(asked)
    assert {row.agreement_id: (row.placement, row.house_id) for row in rows} == expected
    assert {state for state, _ in expected.values()} == {"KEPT", "MOVED", "REJECTED"}


def test_sticky_month_end(spark):
    frame = spark.createDataFrame(
        [(date(2019, 2, 28),), (date(2024, 2, 28),), (date(2024, 1, 31),), (date(2024, 5, 15),)], "d date"
    )
    found = [r.m for r in frame.select("d", add_months_sticky(F.col("d"), 1).alias("m")).collect()]
    assert found == [date(2019, 3, 31), date(2024, 3, 28), date(2024, 2, 29), date(2024, 6, 15)]


def test_latest_per_key_prunes_before_the_shuffle(spark):
    frame = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 7)], "k long, v long")
    latest = upsert.latest_per_key(frame, ["k"], F.desc("v"))
    assert sorted(tuple(row) for row in latest.collect()) == [(1, 49), (2, 7)]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


PROPERTY = (
    "property_id string, location_id string, owner_id string, property_type string, bedrooms int, "
    "size_sqm decimal(10,2), monthly_rent decimal(12,2), currency string, "
    "source_timestamp timestamp, processed_at timestamp"
)


def test_history_closes_opens_and_returns(spark):
    def current(**rents):
        stamp = datetime(2024, 1, 1)
        rows = [(k, "L", "O", "house", 1, "50.00", str(v), "PLN", stamp, stamp) for k, v in rents.items()]
        base = spark.createDataFrame(
            rows, PROPERTY.replace("decimal(10,2)", "string").replace("decimal(12,2)", "string")
        )
        return base.withColumn("size_sqm", F.col("size_sqm").cast("decimal(10,2)")).withColumn(
            "monthly_rent", F.col("monthly_rent").cast("decimal(12,2)")
        )

    def at(n):
        return F.lit(datetime(2024, 2, n)).cast("timestamp")

    taken = history.first_snapshot(current(a=1, b=2, c=3), at(1))
    taken = history.snapshot(taken, current(a=1, b=5), at(2))
    taken = history.snapshot(taken, current(a=1, b=5, c=3), at(3))
    rows = sorted(
        (r.property_id, r.valid_from.day, r.valid_to.day if r.valid_to else None)
        for r in taken.select("property_id", "valid_from", "valid_to").collect()
    )
    assert rows == [("a", 1, None), ("b", 1, 2), ("b", 2, None), ("c", 1, 2), ("c", 3, None)]
    assert taken.select("version_id").distinct().count() == 5


def test_measures_at_any_grouping(spark):
    mart = spark.createDataFrame(
        [("x", 1, 2), ("x", 1, 8), ("y", 0, 0)],
        "city string, occupied_property_days long, available_property_days long",
    )
    total = measures.measure(mart, "occupancy_rate").first()
    assert total.occupancy_rate == 0.2
    by_city = measures.measure(mart, "occupancy_rate", by=["city"]).collect()
    assert {r.city: r.occupancy_rate for r in by_city} == {"x": 0.2, "y": None}
    only = measures.measure(mart, "occupancy_rate", where=F.col("city") == "x").first()
    assert only.occupancy_rate == 0.2


def test_rent_trend_finds_the_previous_month_outside_the_filter(spark):
    rows = [("a", 1, 10.0), ("a", 3, 16.0), ("b", 1, 20.0), ("b", 3, 40.0), ("b", 4, 70.0)]
    trends = spark.createDataFrame(
        [(c, date(2024, m, 1), v) for c, m, v in rows],
        "city string, agreement_month date, average_monthly_rent double",
    )
    assert measures.rent_trend(trends).first().rent_trend == 70.0 - 28.0
    march = F.col("agreement_month") == date(2024, 3, 1)
    assert measures.rent_trend(trends, month=march).first().rent_trend == 28.0 - 15.0
    # The month before April is March for every city; before January there is none.
    by_city = {r.city: r.rent_trend for r in measures.rent_trend(trends, by=["city"]).collect()}
    assert by_city == {"a": 6.0, "b": 30.0}
    by_month = measures.rent_trend(trends, by=["agreement_month"]).collect()
    assert {r.agreement_month.month: r.rent_trend for r in by_month} == {1: 15.0, 3: 13.0, 4: 42.0}


def test_rent_trend_takes_the_previous_month_from_the_whole_model(spark):
    rows = [("a", 1, 10.0), ("a", 4, 16.0), ("b", 3, 5.0), ("b", 4, 9.0), (None, 1, 3.0), (None, 3, 2.0)]
    trends = spark.createDataFrame(
        [(c, date(2024, m, 1), v) for c, m, v in rows],
        "city string, agreement_month date, average_monthly_rent double",
    )
    by_city = {r.city: r.rent_trend for r in measures.rent_trend(trends, by=["city"]).collect()}
    assert by_city == {"a": 16.0, "b": 4.0, None: -1.0}
    only = measures.rent_trend(trends, where=F.col("city") == "a").collect()
    assert [r.rent_trend for r in only] == [16.0]


def test_checks_find_violations(spark):
    frame = spark.createDataFrame([(1, "a"), (1, None), (2, "z"), (None, "a")], "k long, v string")
    parent = spark.createDataFrame([("a",)], "id string")
    assert [tuple(r) for r in checks.unique(frame, "k").collect()] == [(1, 2)]
    assert checks.not_null(frame, "k").count() == 1
    assert checks.accepted_values(frame, "v", ("a",)).first().v == "z"
    assert checks.relationships(frame, "v", parent, "id").first().v == "z"
    assert checks.agreement_dates(
        spark.createDataFrame([(1, day(5), day(1), -3)], "agreement_id long, start_date date, end_date date, agreement_days int")
    ).count() == 1
    assert checks.payment_financials(
        spark.createDataFrame(
            [(1, 5.0, 0, False), (2, -1.0, 0, False), (3, 5.0, 2, False)],
            "payment_id long, amount double, days_overdue int, is_overdue boolean",
        )
    ).count() == 2


@pytest.mark.parametrize("firm_size", [1, 3])
def test_agents_receive_from_colleagues_of_their_firm(spark, firm_size):
    agents = spark.createDataFrame([(1, "F"), (2, "F"), (3, "F"), (9, "G")], "person_no long, firm string")
    rows = [(i, 3, day(100)) for i in range(1, 1 + firm_size)] + [(50, 9, day(100)), (51, None, day(100))]
    agreements = spark.createDataFrame(rows, "agreement_id long, agent_no long, end_date date")
    released = spark.createDataFrame([(1,), (1,), (2,), (None,)], "agent_no long")
    found = adjustments.reassign_agent(agreements, agents, released, as_of=F.lit(day(0)), buckets=4, small=1)
    moved = {r.agreement_id: r.agent_no for r in found.filter("action is not null").collect()}
    assert moved == ({1: 1, 2: 2} if firm_size == 3 else {})
    assert found.count() == len(rows)


def test_occupancy_groups_days_where_they_are_made(spark):
    """Grouping the day fact by agreement must not shuffle its days, however many there are."""
    state = {
        "locations": spark.sql("select 'L' location_id, 'c' city, 'r' region, 'PL' country_code"),
        "owners": spark.sql("select 'O' owner_id, 'o' full_name, 'o@x' email"),
        "tenants": spark.sql("select 'T' tenant_id, 't' full_name, 't@x' email"),
        "properties": spark.sql(
            """select 'P' property_id, 'L' location_id, 'O' owner_id, 'house' property_type, 1 bedrooms,
            1.0 size_sqm, 1.0 monthly_rent, 'PLN' currency"""
        ),
        "rental_agreements": spark.sql(
            """select 'A' || id agreement_id, 'P' property_id, 'T' tenant_id, date'2024-01-01' start_date,
            date_add(date'2024-01-01', int(id)) end_date, 1.0 monthly_rent, 'ACTIVE' status from range(30)"""
        ),
    }
    assert star.day_partitions(state) == 1
    counted = star.fact_occupancy(state, 3).groupBy("rental_agreement_key", "property_key").agg(
        F.countDistinct("occupancy_key").alias("days")
    )
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Exchange" in line and "occupancy_key" in line]
    assert [row.days for row in counted.orderBy("days").collect()] == list(range(1, 31))


def test_loosened_reads_its_table_once(spark, tmp_path):
    """One branch per kind of broken row would compute a model four times, with all its broadcasts."""
    spark.range(50).selectExpr("string(id) as k", "id as n").write.parquet(f"{tmp_path}/t")
    loose = checks.loosened(spark.read.parquet(f"{tmp_path}/t"), "k")
    plan = loose._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_together_bounds_how_many_run(spark):
    lock, running, seen = threading.Lock(), set(), []

    def work(name):
        with lock:
            running.add(name)
            seen.append(len(running))
        time.sleep(0.05)
        with lock:
            running.discard(name)
        return name

    names = [str(n) for n in range(8)]
    found = session.together(spark, {n: partial(work, n) for n in names}, 2)
    assert found == {n: n for n in names} and max(seen) <= 2


def test_records_with_unique_keys_are_not_shuffled_again(spark):
    """The repeated keys are known before the records look at them; without any, nothing is shuffled."""
    records = spark.range(100).selectExpr("string(id) as k", "struct('' as file, 0L as block, id) as source_order")
    marked = quality.mark_repeats(records, "k")
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan
    assert marked.filter("reason is null").count() == 100
    twice = quality.mark_repeats(records.unionByName(records.filter("k = '7'")).drop("source_order").selectExpr(
        "k", "struct('' as file, 0L as block, monotonically_increasing_id() as id) as source_order"
    ), "k")
    assert [row.k for row in twice.filter("reason is not null").collect()] == ["7"]


def test_record_tables_are_packed_and_keep_fingerprints(spark, tmp_path):
    raw = spark.sql(
        """select 1L as source_row, 'L1' location_id, 'a' city, 'b' region, 'PL' country_code,
        '2024-01-01T00:00:00Z' source_timestamp"""
    )
    spec = ENTITIES["locations"]
    records = quality.write_records(spec, raw, f"{tmp_path}/records")
    assert all(".zstd." in path for path in records.inputFiles())
    none = spark.createDataFrame([], quality.LATE)
    kept = quality.accepted(spec, records, none, "b", F.timestamp_seconds(F.lit(0)))
    assert kept.join(records, "record_fingerprint").count() == 1


def test_placement_counts_conflicts_once_and_drops_past_bookings(spark, monkeypatch):
    """Who asks again has lost the own house, and a booking that ended before all requests of its space is of no use."""
    counted, waves = [], []

    def counts(*args, **options):
        counted.append(1)
        return intervals.conflict_counts(*args, **options)

    def wave(waiting, booked, *args, **options):
        waves.append(booked.count())
        return placed(waiting, booked, *args, **options)

    placed = adjustments._wave
    monkeypatch.setattr(adjustments, "conflict_counts", counts)
    monkeypatch.setattr(adjustments, "_wave", wave)
    houses = [(h, h // 4) for h in range(8)]
    past = [(1000 + i, i % 8, day(i), day(i + 1)) for i in range(40)]
    booked = [(2000, 0, day(90), day(110)), (2001, 1, day(60), day(101)), (2002, 2, day(99), day(100))]
    asked = [(i, i % 3, day(100 + i % 7), day(104 + i % 11)) for i in range(30)]
    ddl = "agreement_id long, house_id long, start_date date, end_date date"
    rows = adjustments.free_house_assignment(
        spark.createDataFrame(asked, ddl),
        spark.createDataFrame(past + booked, ddl),
        spark.createDataFrame(houses, "house_id long, space_id long"),
        as_of=F.lit(day(0)),
    ).collect()
    assert {row.agreement_id: (row.placement, row.house_id) for row in rows} == place(asked, past + booked, houses)
    assert len(waves) > 1 and len(counted) == 1 and waves[0] == len(booked)


def test_requests_for_unlisted_houses_and_no_requests(spark):
    ddl = "agreement_id long, house_id long, start_date date, end_date date"
    houses = spark.createDataFrame([(1, 1)], "house_id long, space_id long")
    booked = spark.createDataFrame([(9, 77, day(0), day(50)), (8, 1, day(0), day(2))], ddl)
    asked = [(1, 77, day(1), day(9)), (2, 77, day(2), day(9)), (3, 77, day(2), day(5)), (4, 1, day(2), day(3))]
    rows = adjustments.free_house_assignment(
        spark.createDataFrame(asked, ddl), booked, houses, as_of=F.lit(day(0))
    ).collect()
    assert {row.agreement_id: row.placement for row in rows} == {1: "KEPT", 2: "KEPT", 3: "KEPT", 4: "REJECTED"}
    none = adjustments.free_house_assignment(spark.createDataFrame([], ddl), booked, houses, as_of=F.lit(day(0)))
    assert none.count() == 0


def test_first_fitting_against_brute_force(spark):
    rng = random.Random(11)
    gaps = [(rng.randrange(3), rng.randrange(12), a, a + rng.randrange(60)) for a in rng.choices(range(-5, 90), k=150)]
    asked = [(rng.randrange(4), a, a + rng.randrange(40)) for a in rng.choices(range(90), k=120)] + [(0, 5, None), (None, 1, 2)]
    found = intervals.first_fitting(
        spark.createDataFrame(asked, "g int, day_from int, day_to int"),
        spark.createDataFrame([*gaps, (None, 1, 0, 9)], "g int, c int, gap_from int, gap_to int"),
        "g",
        "c",
    )
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" not in plan and "Join" not in plan
    expected = {}
    for g, start, end in asked:
        fits = [c for group, c, a, b in gaps if None not in (g, end) and group == g and a <= start and b >= end]
        if fits:
            expected[g, start, end] = min(fits)
    assert {(r.g, r.day_from, r.day_to): r.c for r in found.collect()} == expected


def test_upsert_moves_only_the_columns_that_are_used(spark):
    ddl = "k string, wide string, n int, record_fingerprint string"
    stored = spark.createDataFrame([("a", "x", 1, "f"), ("b", "x", 2, "g"), ("c", "x", 3, None), (None, "x", 4, "h")], ddl)
    incoming = spark.createDataFrame([("a", "y", 5, "f"), ("b", "y", 6, "z"), ("c", "y", 7, "i"), ("d", None, 8, "j"), (None, "y", 9, "h")], ddl)
    after = upsert.apply_upsert(incoming, stored, "k")
    assert after.columns == stored.columns and after.dtypes == stored.dtypes
    assert sorted(tuple(row) for row in after.collect() if row.k) == [
        ("a", "x", 1, "f"), ("b", "y", 6, "z"), ("c", "x", 3, None), ("d", None, 8, "j")
    ]
    assert sorted(tuple(row)[1:] for row in after.collect() if row.k is None) == [("x", 4, "h"), ("y", 9, "h")]
    plan = after.groupBy("n").count()._jdf.queryExecution().optimizedPlan().toString()
    above = plan.splitlines()[: next(i for i, line in enumerate(plan.splitlines()) if "LogicalRDD" in line)]
    assert not [line for line in above if "wide" in line]


def one_home(spark):
    """A state of 30 agreements, day 1 to day 30 of them, on one property."""
    return {
        "locations": spark.sql("select 'L' location_id, 'c' city, 'r' region, 'PL' country_code"),
        "owners": spark.sql("select 'O' owner_id, 'o' full_name, 'o@x' email"),
        "tenants": spark.sql("select 'T' tenant_id, 't' full_name, 't@x' email"),
        "properties": spark.sql(
            """select 'P' property_id, 'L' location_id, 'O' owner_id, 'house' property_type, 1 bedrooms,
            1.0 size_sqm, 1.0 monthly_rent, 'PLN' currency"""
        ),
        "rental_agreements": spark.sql(
            """select 'A' || id agreement_id, 'P' property_id, 'T' tenant_id, date'2024-01-01' start_date,
            date_add(date'2024-01-01', int(id)) end_date, 1.0 monthly_rent, 'ACTIVE' status from range(30)"""
        ),
    }


def test_day_fact_is_tested_in_one_pass_without_a_shuffle_of_days(spark):
    state = one_home(spark)
    home = "rental_agreement_key"
    facts = star.fact_occupancy(state, 3).select("occupancy_key", "date_key", home)
    loose = checks.loosened(facts, "occupancy_key", home=home)
    dates = star.dim_date(state).filter("date_day <> date'2024-01-03'")
    models = {"fact_occupancy": loose, "dim_date": dates.unionByName(dates)}
    once = checks.reports(models, at_home=("fact_occupancy",))["fact_occupancy"]
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Exchange" in line and "occupancy_key" in line]
    assert plan.count("md5(cast(concat(") == 1
    apart = checks.reports(models)["fact_occupancy"]
    found = {row.test: row.violations for row in once.collect()}
    assert found == {row.test: row.violations for row in apart.collect()}
    assert found["relationships"] >= 28 and found["unique"] > 0 and found["not_null"] > 0
    none = checks.reports({**models, "fact_occupancy": loose.limit(0)}, at_home=("fact_occupancy",))["fact_occupancy"]
    assert [row.violations for row in none.collect()] == [0, 0, 0]
    with pytest.raises(PipelineError):
        checks.reports({"fact_payment": facts}, at_home=("fact_payment",))


def test_stored_models_keep_the_columns_that_tests_read(spark):
    assert checks.read_by("fact_occupancy") == ("occupancy_key", "date_key")
    assert set(checks.read_by("rental_agreements")) == {"agreement_id", "property_id", "tenant_id", "status"}
    for model in checks.MODELS:
        assert {*checks.key_of(model), *checks.MODELS[model]} <= set(checks.read_by(model))
    for _, _, parent, field in checks.RELATIONSHIPS:
        assert field in checks.read_by(parent)


def test_loosened_copies_hold_the_values_of_their_row(spark):
    frame = spark.range(200).selectExpr("string(id) k", "if(id % 3 = 0, null, id) n", "date'2024-01-01' d", "id % 2 = 0 b")
    rows = checks.loosened(frame, "k", home="k").collect()
    expected = []
    for k, n, d, b in frame.collect():
        digit = hashlib.md5(k.encode()).hexdigest()[0]
        expected += [(k, n, d, b, k)] * (2 if digit == "0" else 1)
        expected += [(None, None, None, None, k)] * (digit == "1")
        expected += [(f"{k}x", None if n is None else -n, d, b, k)] * (digit == "2")
    assert sorted(map(tuple, rows), key=str) == sorted(expected, key=str)


def test_tidy_drops_the_shuffles_of_a_write_when_it_ends(spark, tmp_path):
    disk = spark._jsc.sc().env().blockManager().diskBlockManager()

    def shuffles():
        files = disk.getAllFiles()
        names = [files.apply(i).getName() for i in range(files.size())]
        return {name for name in names if name.startswith("shuffle_")}

    before = shuffles()
    kept = spark.conf.get(session.CLEANUP, None)
    with session.tidy(spark):
        spark.range(100).groupBy((F.col("id") % 7).alias("k")).count().write.parquet(f"{tmp_path}/t")
    assert spark.conf.get(session.CLEANUP, None) == kept
    assert not shuffles() - before


def agreed(spark, *rows):
    """The state of ``one_home`` with these agreements: id, first day, last day."""
    ddl = "agreement_id string, start_date date, end_date date"
    terms = spark.createDataFrame(rows, ddl).selectExpr(
        "agreement_id", "'P' property_id", "'T' tenant_id", "start_date", "end_date", "1.0 monthly_rent", "'ACTIVE' status"
    )
    return {**one_home(spark), "rental_agreements": terms}


ODD_TERMS = [
    ("leap", date(2023, 12, 30), date(2024, 3, 2)),
    ("one day", date(2024, 2, 29), date(2024, 2, 29)),
    ("two years", date(1999, 1, 31), date(2000, 12, 31)),
    ("reversed", date(2024, 2, 3), date(2024, 1, 30)),
    ("open", date(2024, 2, 3), None),
    ("never", None, date(2024, 2, 3)),
    ("early", date(90, 12, 30), date(91, 1, 2)),
    ("late", date(9999, 12, 30), date(9999, 12, 31)),
    ("twice", date(2024, 1, 1), date(2024, 1, 3)),
    ("twice", date(2024, 1, 3), date(2024, 1, 4)),
    (None, date(2024, 1, 1), date(2024, 1, 2)),
]


def days_of(start, end):
    if start is None or end is None:
        return []
    first, last = min(start, end), max(start, end)
    return [first + timedelta(days=n) for n in range((last - first).days + 1)]


def test_days_of_the_fact_against_plain_loops(spark):
    expected = []
    for name, start, end in ODD_TERMS:
        for d in days_of(start, end):
            key = name and hashlib.md5(f"{name}:{d.isoformat()}".encode()).hexdigest()
            expected.append((key, d.year * 10000 + d.month * 100 + d.day, d, 1))
    facts = star.fact_occupancy(agreed(spark, *ODD_TERMS), 3)
    assert facts.columns == [
        "occupancy_key", "rental_agreement_key", "property_key", "location_key", "tenant_key", "date_key", "date_day", "occupied_day"
    ]
    got = facts.select("occupancy_key", "date_key", "date_day", "occupied_day").collect()
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    plan = facts._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Generate")]
    assert "date_day#" in above and "as string)" not in above  # no date is formatted for each day


def test_digest_is_the_sum_of_sixty_bits_of_each_row(spark):
    rows = [(i % 3, None if i % 5 == 0 else f"t{i}", day(i)) for i in range(300)]
    frame = spark.createDataFrame(rows, "k int, t string, d date")
    found = checks.digest(frame, F.col("k").alias("g"))
    expected = {}
    for k, t, d in rows:
        text = "|".join(["null" if v is None else str(v) for v in (d, k, t)])
        count, total = expected.get(k, (0, 0))
        expected[k] = count + 1, total + int(hashlib.md5(text.encode()).hexdigest()[:15], 16)
    assert {r.g: (r.row_count, int(r.checksum)) for r in found.collect()} == expected
    assert "decimal(20,0)" not in found._jdf.queryExecution().optimizedPlan().toString().lower()
    assert [tuple(r) for r in checks.digest(frame.limit(0)).collect()] == [(0, None)]


def test_days_by_agreement_are_those_of_the_fact_and_are_not_sorted(spark):
    state = agreed(spark, *ODD_TERMS)
    keys = ["rental_agreement_key", "property_key", "location_key", "tenant_key"]
    columns = ["occupancy_key", "date_key", "date_day", "occupied_day"]
    grouped = star.fact_occupancy(state, 3, by_agreement=True)
    assert grouped.columns == [*keys, *columns]
    plan = grouped._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if ("Sort" in line or "Exchange" in line) and "occupancy_key" in line]
    assert plan.count("Generate") == 0
    rows = grouped.collect()
    assert len({row[:4] for row in rows}) == len(rows) == 8
    listed = [(*row[:4], *one) for row in rows for one in zip(*row[4:], strict=True)]
    flat = star.fact_occupancy(state, 3).select(*keys, *columns).collect()
    assert sorted(listed, key=str) == sorted(map(tuple, flat), key=str)


def test_fact_occupancy_reports_agreements_as_a_grouping_of_days_would(spark, monkeypatch):
    state = agreed(spark, *ODD_TERMS)
    monkeypatch.setattr(queries, "state", lambda spark, folder: state)
    got = queries.fact_occupancy(spark, "")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "count(distinct" not in plan and "SortAggregate" not in plan
    expected = star.fact_occupancy(state).groupBy(*star.OCCUPANCY_KEYS).agg(
        F.sum("occupied_day").alias("occupied_days"),
        F.countDistinct("occupancy_key").alias("occupancy_keys"),
        F.min("occupancy_key").alias("lowest_key"),
        F.max("occupancy_key").alias("highest_key"),
        F.min("date_key").alias("first_date_key"),
        F.max("date_day").alias("last_day"),
    )
    assert got.dtypes == expected.dtypes
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)


def test_load_of_all_entities_counts_slices_that_add_up(spark, monkeypatch):
    """Counts are stored join by join; the frame that comes back joins no records any more."""
    state = {}
    for name, spec in ENTITIES.items():
        keys = "if(id = 50, null, 'K' || id)"
        state[name] = spark.range(60).selectExpr(
            f"{keys} as {spec.key}", "sha2(string(id), 256) record_fingerprint", "'batch-0001' batch_id"
        )
    monkeypatch.setattr(queries, "state", lambda spark, folder: state)
    found = []
    for slices in (1, 5):
        monkeypatch.setattr(queries, "_slices", lambda spark, folder, name, n=slices: n)
        got = queries.load_all_entities(spark, "")
        assert "record_fingerprint" not in got._jdf.queryExecution().optimizedPlan().toString()
        assert got.columns == ["entity", "inserted_count", "updated_count", "skipped_count", "state_rows", "batch_rows"]
        found.append(sorted(map(tuple, got.collect())))
    # Six keys end in 7 and six in 3; the record without a key meets no stored one.
    assert found[0] == sorted((name, 7, 6, 47, 67, 67) for name in ENTITIES)
    assert found[1] == found[0]


def test_slices_of_a_load_hold_so_many_records(spark, monkeypatch):
    records = SimpleNamespace(valid=spark.range(10))
    monkeypatch.setattr(queries, "assessed", lambda spark, folder: {"payments": records})
    assert queries._slices(spark, "", "payments") == 1
    monkeypatch.setattr(queries, "RECORDS_AT_ONCE", 4)
    assert queries._slices(spark, "", "payments") == 3
