from __future__ import annotations

import json
import os
from datetime import UTC, datetime, timedelta

import extracts
import pytest
from pyspark.sql import functions as F

from lettings.model import ENTITIES, PipelineError
from lettings.operators import quality
from lettings.plans import pipeline, state
from lettings.plans.state import StateStore
from lettings.sources import bronze, files, lake
from lettings.sources.lake import Lake

NAMES = (
    "input_count",
    "accepted_count",
    "rejected_count",
    "inserted_count",
    "updated_count",
    "skipped_count",
)


def run(spark, tmp_path, name, **options):
    source = extracts.write(f"{tmp_path}/{name}", extracts.rows(**options))
    return pipeline.run_batch(spark, source, f"{tmp_path}/lake", batch_id=name)


def test_five_batches(spark, tmp_path):
    """The reference scenario: full, identical, one more property, a changed rent, defects."""
    root = f"{tmp_path}/lake"
    states = StateStore(spark, Lake(root).state)
    moment = datetime(2024, 6, 1, tzinfo=UTC)

    full = run(spark, tmp_path, "full", n=12)
    assert tuple(full.counts[n] for n in NAMES) == (81, 81, 0, 81, 0, 0)
    assert states.counts() == {
        "locations": 5, "owners": 4, "tenants": 12, "properties": 12,
        "rental_agreements": 12, "payments": 36,
    }
    pipeline.snapshot_properties(spark, root, moment)
    kept = states.read()["payments"].select("payment_id", "batch_id", "processed_at").collect()

    same = run(spark, tmp_path, "same", n=12)
    assert tuple(same.counts[n] for n in NAMES) == (81, 81, 0, 0, 0, 81)
    again = states.read()["payments"].select("payment_id", "batch_id", "processed_at").collect()
    assert sorted(again) == sorted(kept)

    more = run(spark, tmp_path, "more", n=13)
    assert tuple(more.counts[n] for n in NAMES) == (88, 88, 0, 7, 0, 81)

    changed = run(spark, tmp_path, "changed", n=13, raise_first=250)
    assert tuple(changed.counts[n] for n in NAMES) == (88, 88, 0, 0, 5, 83)
    history = pipeline.snapshot_properties(spark, root, moment + timedelta(days=1))
    assert history.count() == 14
    first = history.filter("property_id = 'PRP-0'").orderBy("valid_from").collect()
    assert [row.valid_to is None for row in first] == [False, True]

    bad = run(spark, tmp_path, "bad", n=13, raise_first=250, defects=True)
    assert tuple(bad.counts[n] for n in NAMES) == (96, 88, 8, 0, 0, 88)
    assert dict(bad.reasons) == {
        "DUPLICATE_IDENTIFIER": 2, "MISSING_REQUIRED_FIELD": 1, "INVALID_DATE": 1,
        "INVALID_AGREEMENT_RANGE": 1, "INVALID_PROPERTY_SIZE": 1, "INVALID_RENT": 1,
        "ORPHAN_OWNER": 1,
    }
    assert states.rejections().count() == 8
    assert states.read()["locations"].filter("city = 'Kiel'").count() == 1

    again = pipeline.load_batch(spark, root, "bad")
    assert tuple(again[n] for n in NAMES) == (96, 88, 8, 0, 0, 88)
    assert states.rejections().count() == 8
    assert states.runs().count() == 5
    assert states.run("bad").final_status == "SUCCESS"
    assert states.latest_run().first().batch_id == "bad"
    with pytest.raises(PipelineError):
        states.run("unknown")

    models = pipeline.warehouse(states.read(), F.lit("2024-12-31").cast("date"))
    built = pipeline.materialise(spark, {**models, "property_history": history}, f"{tmp_path}/gold")
    tests = pipeline.check_warehouse(built).collect()
    assert len(tests) == 70
    assert sum(row.violations for row in tests) == 0

    counts = states.full_refresh(lake.read_silver_batch(spark, Lake(root), "full"), "refresh")
    assert counts == {"inserted_count": 81, "updated_count": 0, "skipped_count": 0}
    assert states.counts()["properties"] == 12


def test_failed_load_is_audited_and_recovers(spark, tmp_path, monkeypatch):
    root = f"{tmp_path}/lake"
    source = extracts.write(f"{tmp_path}/in", extracts.rows(3, defects=True))
    clean = extracts.write(f"{tmp_path}/clean", extracts.rows(2))

    def broken(self, *args, **kwargs):
        raise PipelineError("x" * 3000)

    with monkeypatch.context() as patch:
        patch.setattr(StateStore, "_commit", broken)
        with pytest.raises(PipelineError):
            pipeline.run_batch(spark, source, root, batch_id="b1")
    states = StateStore(spark, Lake(root).state)
    failed = states.run("b1")
    assert failed.final_status == "FAILED"
    assert len(failed.failure_message) == 2000
    assert sum(states.counts().values()) == 0
    pipeline.run_batch(spark, clean, root, batch_id="b2")
    assert states.rejections().count() == 0
    recovered = pipeline.load_batch(spark, root, "b1")
    assert recovered["inserted_count"] + recovered["skipped_count"] == recovered["accepted_count"]
    assert recovered["inserted_count"] > 0 and recovered["skipped_count"] > 0
    assert states.rejections().count() == recovered["rejected_count"] == 8
    assert states.run("b1").final_status == "SUCCESS"
    assert states.runs().count() == 2


def test_validation_only_writes_no_silver(spark, tmp_path):
    root = f"{tmp_path}/lake"
    source = extracts.write(f"{tmp_path}/in", extracts.rows(12, defects=True))
    bronze.ingest(spark, source, Lake(root).bronze, "b1")
    counts = pipeline.validate_batch(spark, root, "b1")
    assert counts == {"input_count": 89, "accepted_count": 81, "rejected_count": 8}
    assert lake.read_quarantine(spark, Lake(root), "b1").count() == 8
    assert lake.read_quarantine(spark, Lake(root), "other").count() == 0
    assert not os.path.exists(f"{root}/silver")
    with pytest.raises(PipelineError):
        pipeline.load_batch(spark, root, "b1")


def test_readers(spark, tmp_path):
    data = extracts.rows(3)
    data["owners"][0]["full_name"] = 'Anna "Ania" Nowak, Jr'
    folder = extracts.write(f"{tmp_path}/in", data)
    with open(f"{folder}/payments.jsonl", "a", encoding="utf-8") as stream:
        stream.write('\n{"payment_id": broken\n{"payment_id": "P", "amount": 1.50}\n')
    batch = bronze.read_bronze(spark, folder)
    owner = batch["owners"].orderBy("source_row").first()
    assert (owner.source_row, owner.full_name) == (1, 'Anna "Ania" Nowak, Jr')
    payments = batch["payments"].orderBy("source_row").collect()
    assert [row.source_row for row in payments] == list(range(1, 12))
    assert payments[10].amount == "1.50"
    with pytest.raises(PipelineError):
        bronze.require_well_formed(bronze.ingest(spark, folder, f"{tmp_path}/bronze", "b"))
    parts = pipeline.quality.assess(batch, batch_id="b", processed_at=F.current_timestamp())
    bad = {row.source_row: row for row in parts["payments"].rejected.collect()}
    assert bad[10].reason_code == "MALFORMED_RECORD"
    assert bad[10].raw_record == '{"payment_id": broken'
    assert bad[11].reason_code == "MISSING_REQUIRED_FIELD"
    os.remove(f"{folder}/owners.csv")
    with pytest.raises(PipelineError, match="owners.csv"):
        bronze.read_bronze(spark, folder)


def test_rows_are_numbered_in_file_order_over_many_splits(spark, tmp_path):
    data = extracts.rows(400)
    folder = extracts.write(f"{tmp_path}/in", data)
    before = {name: spark.conf.get(name, None) for name in ("spark.sql.files.maxPartitionBytes",)}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        landed = bronze.ingest(spark, folder, f"{tmp_path}/bronze", "b")
        for name in ("tenants", "payments"):
            key = ENTITIES[name].key
            rows = landed[name].select("source_row", key).orderBy("source_row").collect()
            assert [row.source_row for row in rows] == list(range(1, len(rows) + 1))
            assert [row[key] for row in rows] == [record[key] for record in data[name]]
        assert spark.read.parquet(f"{tmp_path}/bronze/splits/payments").count() > 8
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_fingerprint_ignores_metadata(spark, tmp_path):
    first = extracts.frames(spark, extracts.rows(2))
    later = extracts.rows(2)
    for record in later["payments"]:
        record["source_timestamp"] = "2025-05-05T00:00:00Z"
    second = extracts.frames(spark, later)

    def prints(batch, name):
        parts = pipeline.quality.assess(batch, batch_id=name, processed_at=F.current_timestamp())
        return sorted(row.record_fingerprint for row in parts["payments"].accepted.collect())

    assert prints(first, "a") == prints(second, "b")


def test_csv_columns_are_found_by_name(spark, tmp_path):
    data = extracts.rows(2)
    owners = [{"email": r["email"], "note": "x", "full_name": r["full_name"], "owner_id": r["owner_id"]} for r in data["owners"]]
    folder = extracts.write(f"{tmp_path}/in", {**data, "owners": owners})
    batch = bronze.read_bronze(spark, folder)
    assert [(r.owner_id, r.full_name, r.source_timestamp) for r in batch["owners"].collect()] == [("OWN-0", "Own No 0", None)]
    landed = bronze.ingest(spark, folder, f"{tmp_path}/bronze", "b")
    assert landed["owners"].columns == batch["owners"].columns
    parts = pipeline.quality.assess(landed, batch_id="b", processed_at=F.current_timestamp())
    assert [r.reason_code for r in parts["owners"].rejected.collect()] == ["MISSING_REQUIRED_FIELD"]


def test_line_breaks_in_quotes_are_read_by_many_tasks(spark, tmp_path):
    """Small splits cut inside quoted fields; every record is as a one-task read gives it."""
    data = extracts.rows(120)
    for i, record in enumerate(data["tenants"]):
        record["full_name"] = ["Ann\nB", "plain", 'say ""\n""hi', "a,b", "x\n" * 400, "\n"][i % 6] + str(i)
    data["owners"][0]["full_name"] = "Ann\nB"
    folder = extracts.write(f"{tmp_path}/in", data)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name, None) for name in names}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "700")
    try:
        texts = bronze.read_extract(spark, f"{folder}/tenants.csv", "tenants")
        rows = texts.orderBy("source_row").collect()
        landed = bronze.ingest(spark, folder, f"{tmp_path}/bronze", "b")["tenants"].orderBy("source_row").collect()
        splits = spark.read.parquet(f"{tmp_path}/bronze/splits/tenants").count()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    one = bronze.read_extract(spark, f"{folder}/tenants.csv", "tenants", multiline=True)
    want = [r.asDict() for r in one.orderBy("source_row").collect()]
    assert [r.asDict() for r in rows] == want
    assert [r.asDict() for r in landed] == want
    assert [r.full_name for r in rows] == [r["full_name"] for r in data["tenants"]]
    assert splits > 4
    done = pipeline.run_batch(spark, folder, f"{tmp_path}/lake", batch_id="whole")
    assert done.counts["input_count"] == sum(map(len, data.values()))


def test_a_quote_that_never_closes_is_refused(spark, tmp_path):
    folder = extracts.write(f"{tmp_path}/in", extracts.rows(2))
    with open(f"{folder}/owners.csv", "a", encoding="utf-8") as stream:
        stream.write('OWN-9,"open,x@y.test,2023-05-04T12:00:00Z\n')
    with pytest.raises(PipelineError, match="never closed"):
        bronze.read_extract(spark, f"{folder}/owners.csv", "owners")


def test_a_load_that_breaks_constraints_makes_no_version(spark, tmp_path):
    root = f"{tmp_path}/lake"
    pipeline.run_batch(spark, extracts.write(f"{tmp_path}/in", extracts.rows(2)), root, batch_id="b1")
    states = StateStore(spark, Lake(root).state)
    good = lake.read_silver_batch(spark, Lake(root), "b1")
    orphans = good["payments"].withColumn("agreement_id", F.lit("NONE")).withColumn("record_fingerprint", F.lit("x"))
    rejected = lake.read_quarantine(spark, Lake(root), "b1")
    before = states.manifest()
    with pytest.raises(PipelineError, match="foreign_key_agreement_id"):
        states.load({**good, "payments": orphans}, rejected, "b2")
    assert states.manifest() == before


def test_of_two_loads_from_one_version_one_commits(spark, tmp_path):
    root = f"{tmp_path}/lake"
    pipeline.run_batch(spark, extracts.write(f"{tmp_path}/in", extracts.rows(2)), root, batch_id="b1")
    states = StateStore(spark, Lake(root).state)
    version, held = states.manifest()
    states._commit(version + 1, held, "one", 5)
    # A lower attempt number that arrives later does not win either.
    for attempt in (6, 4):
        with pytest.raises(PipelineError, match="Another load"):
            states._commit(version + 1, held, "two", attempt)
    assert states.manifest() == (version + 1, held)


def test_a_commit_under_way_is_not_read_and_not_overtaken(spark, tmp_path):
    root = f"{tmp_path}/lake"
    pipeline.run_batch(spark, extracts.write(f"{tmp_path}/in", extracts.rows(2)), root, batch_id="b1")
    states = StateStore(spark, Lake(root).state)
    before = states.manifest()
    assert files.create(spark, files.manifest_path(states._versions, before[0] + 1), "")
    assert states.manifest() == before
    with pytest.raises(PipelineError, match="being committed"):
        states.load(lake.read_silver_batch(spark, Lake(root), "b1"), lake.read_quarantine(spark, Lake(root), "b1"), "b2")


def written(root):
    return {
        os.path.join(folder, name): os.stat(os.path.join(folder, name)).st_mtime_ns
        for folder, _, names in os.walk(root)
        for name in names
        if name.endswith(".parquet")
    }


def test_one_changed_record_writes_one_bucket(spark, tmp_path):
    root = f"{tmp_path}/lake"
    pipeline.run_batch(spark, extracts.write(f"{tmp_path}/in", extracts.rows(40)), root, batch_id="b1")
    states = StateStore(spark, Lake(root).state)
    good = lake.read_silver_batch(spark, Lake(root), "b1")
    none = lake.read_quarantine(spark, Lake(root), "b1").limit(0)
    before, total = written(f"{root}/state/data"), states.counts()
    changed = good["payments"].withColumn(
        "record_fingerprint",
        F.when(F.col("payment_id") == "PAY-3b", "new").otherwise(F.col("record_fingerprint")),
    )
    counts = states.load({**good, "payments": changed}, none, "b2")
    assert counts == {"inserted_count": 0, "updated_count": 1, "skipped_count": sum(total.values()) - 1}
    new = set(written(f"{root}/state/data")) - set(before)
    assert len({os.path.dirname(path) for path in new}) == 1 and "/payments/" in new.pop()
    assert states.counts() == total
    assert states.read()["payments"].filter("record_fingerprint = 'new'").count() == 1
    # A replay writes nothing at all; superseded buckets and those of failed loads can be removed.
    after = written(f"{root}/state/data")
    assert states.load({**good, "payments": changed}, none, "b3")["updated_count"] == 0
    assert written(f"{root}/state/data") == after
    assert states.clean() == 1 and states.counts() == total
    assert states.clean() == 0


def test_an_entity_that_outgrows_its_buckets_is_dealt_anew(spark, tmp_path, monkeypatch):
    root = f"{tmp_path}/lake"
    monkeypatch.setattr(state, "BUCKET_ROWS", 4)
    monkeypatch.setattr(state, "LEAST_BUCKETS", 2)
    for name, n in (("b1", 3), ("b2", 20)):
        pipeline.run_batch(spark, extracts.write(f"{tmp_path}/{name}", extracts.rows(n)), root, batch_id=name)
    states = StateStore(spark, Lake(root).state)
    held = states.manifest()[1]["payments"]
    assert held.rows == 60 and held.buckets == 16 and len(set(held.attempts.values())) == 1
    rows = states.read()["payments"]
    assert rows.count() == rows.select("payment_id").distinct().count() == 60


def test_a_point_lookup_skips_most_files(spark, tmp_path):
    root = f"{tmp_path}/lake"
    pipeline.run_batch(spark, extracts.write(f"{tmp_path}/in", extracts.rows(60)), root, batch_id="b1")
    payments = StateStore(spark, Lake(root).state).read()["payments"]
    found = payments.filter("agreement_id = 'AGR-7'").select("payment_id", "agreement_id")
    assert len(found.collect()) == 3
    leaves = found._jdf.queryExecution().executedPlan().collectLeaves()
    (scan,) = spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(leaves)
    rows = scan.metrics().apply("numOutputRows").value()
    assert 0 < rows <= 90  # of 180, in at most three of eight buckets


def test_a_snapshot_without_changes_writes_nothing(spark, tmp_path):
    root = f"{tmp_path}/lake"
    moment = datetime(2024, 6, 1, tzinfo=UTC)
    for name, raised in (("b1", 0), ("b2", 250)):
        pipeline.run_batch(spark, extracts.write(f"{tmp_path}/{name}", extracts.rows(5, raise_first=raised)), root, batch_id=name)
        pipeline.snapshot_properties(spark, root, moment)
        moment += timedelta(days=1)
    assert pipeline.read_history(spark, root).count() == 6
    before = written(f"{root}/history")
    again = pipeline.snapshot_properties(spark, root, moment)
    assert again.count() == 6 and again.filter("valid_to is null").count() == 5
    assert written(f"{root}/history") == before
    # A changed property ends one version in a folder of its own; older closed ones stay as they are.
    current = StateStore(spark, Lake(root).state).read()["properties"]
    pipeline.snapshot_properties(spark, root, moment, current.withColumn("bedrooms", F.lit(9)))
    assert pipeline.read_history(spark, root).count() == 11
    assert before.items() <= written(f"{root}/history").items()


def plan_of(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_rules_run_once_and_row_numbers_are_looked_up_for_rejects_only(spark, tmp_path):
    source = extracts.write(f"{tmp_path}/in", extracts.rows(4, defects=True))
    bronze.ingest(spark, source, f"{tmp_path}/bronze", "b")
    raw = bronze.read_ordered(spark, f"{tmp_path}/bronze", "b")
    for name, spec in ENTITIES.items():
        judged = plan_of(quality.checked_records(spec, raw[name].records))
        assert "Join" not in judged and judged.count("Relation [") == 1
        assert judged.count("MISSING_REQUIRED_FIELD") == 1
    parts = quality.assess(raw, batch_id="b", processed_at=F.current_timestamp())
    counts = quality.all_counts(parts)
    for frame in (
        quality.all_rejected(parts), quality.summarise(counts), quality.reason_counts(counts),
        quality.reconcile(quality.count_rows({n: x.records for n, x in raw.items()}, "input_count"), counts),
        *[part.accepted for part in parts.values()],
    ):
        assert "MISSING_REQUIRED_FIELD" not in plan_of(frame)
    assert "_shift" not in plan_of(parts["payments"].accepted)
    assert plan_of(quality.summarise(counts)).count("Relation [") == 2 * len(ENTITIES)
    rejected = {(r.record_type, r.source_row) for r in quality.all_rejected(parts).collect()}
    assert ("payments", 13) in rejected and ("tenants", 5) in rejected and len(rejected) == 8


def test_row_numbers_leave_a_file_to_many_tasks(spark, tmp_path):
    """One file of many row groups: numbering must not bring all its records to one task."""
    path = f"{tmp_path}/one.parquet"
    spark.range(20000).selectExpr("id", "md5(string(id)) as text").coalesce(1).write.option(
        "parquet.block.size", 65536
    ).option("parquet.page.size", 8192).parquet(path)
    settings = {
        "spark.sql.files.maxPartitionBytes": "128k",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.autoBroadcastJoinThreshold": "1k",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        numbered = bronze.numbered_parquet(spark, path)
        tasks = numbered.groupBy(F.spark_partition_id().alias("task")).count().collect()
        assert len(tasks) > 1
        assert numbered.filter("source_row <> id + 1").isEmpty()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_rejected_texts_become_json_after_their_join(spark):
    """All raw texts cross the join to the late rejects; as JSON each would carry its field names."""
    parts = quality.assess(extracts.frames(spark, extracts.rows(4, defects=True)), batch_id="b", processed_at=F.current_timestamp())
    rejected = parts["payments"].rejected
    lines = plan_of(rejected).splitlines()
    joined = next(i for i, line in enumerate(lines) if "Join" in line)
    made = [i for i, line in enumerate(lines) if "structstojson" in line.lower()]
    assert made and max(made) < joined
    for row in rejected.collect():
        assert list(json.loads(row.raw_record)) == sorted(ENTITIES["payments"].raw)
