"""Versioned current state: incremental load, audit, rejection history, replay.

An entity's state is dealt to hash buckets of its key. A load finds the records that differ from the
state, reading keys and fingerprints only, writes the buckets that they fall in anew, checks the
constraints of these records, and commits by creating the next version's manifest, a file that
must not exist yet: of two loads from one version one gets to create it and the other fails. Readers follow
the last manifest, which names for every entity the folders of its buckets, so a load is all or
nothing and nothing is overwritten while it is read. Cost follows the touched buckets; a replay
of the same batch writes no data at all.

Inside a bucket records are sorted by the column they are looked up by, which has Bloom filters, so
a point lookup skips most files. Buckets hold ``BUCKET_ROWS`` records or so; an entity that outgrows them twofold is
dealt anew, which adds a share of the writes that stays constant as it grows.
"""

from __future__ import annotations

import time
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import UTC, datetime
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lettings import session
from lettings.model import ENTITIES, QUARANTINE, Entity, PipelineError
from lettings.operators import upsert
from lettings.sources import files

BUCKET_ROWS = 1_000_000
LEAST_BUCKETS = 8
LOOKED_UP = {"payments": "agreement_id", "rental_agreements": "property_id", "properties": "location_id"}
MAX_FAILURE_TEXT = 2000
COUNTS = (
    "input_count",
    "accepted_count",
    "rejected_count",
    "inserted_count",
    "updated_count",
    "skipped_count",
)
RUNS = T.StructType(
    [
        T.StructField("batch_id", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        *[T.StructField(name, T.LongType()) for name in COUNTS],
        T.StructField("final_status", T.StringType()),
        T.StructField("failure_message", T.StringType()),
        T.StructField("event_no", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Held:
    """State of one entity: how many buckets, how many records, and which attempt wrote each bucket."""

    buckets: int
    rows: int
    attempts: Mapping[int, int]


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def bucket_count(rows: int) -> int:
    """A power of two, so that buckets keep together as their number grows."""
    return max(LEAST_BUCKETS, 1 << max(0, -(-rows // BUCKET_ROWS) - 1).bit_length())


class StateStore:
    """Current state of the six entities below one folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    # --- reading -------------------------------------------------------------------------------

    def _table(self, name: str, schema: T.StructType | str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    @property
    def _versions(self) -> str:
        return f"{self.root}/versions"

    def manifest(self) -> tuple[int, dict[str, Held]]:
        """The last committed version and where its entities are."""
        version, content = files.last_manifest(self.spark, self._versions)
        if content is None:  # created by a commit under way
            version -= 1
            content = files.read_manifest(self.spark, self._versions, version) if version else {}
        return version, self._held(content or {})

    @staticmethod
    def _held(content: Mapping[str, object]) -> dict[str, Held]:
        return {
            name: Held(part["buckets"], part["rows"], {int(b): a for b, a in part["attempts"].items()})
            for name, part in content.get("entities", {}).items()
        }

    def read(self) -> dict[str, DataFrame]:
        _, held = self.manifest()
        return {name: self._entity(name, held.get(name)) for name in ENTITIES}

    def _entity(self, name: str, held: Held | None, buckets: Iterable[int] | None = None) -> DataFrame:
        """The records of an entity, or of some of its buckets."""
        spec = ENTITIES[name]
        wanted = {} if held is None else held.attempts
        if buckets is not None:
            wanted = {b: wanted[b] for b in buckets if b in wanted}
        if not wanted:
            return self.spark.createDataFrame([], spec.silver)
        base = f"{self.root}/data/{name}"
        paths = [f"{base}/attempt={attempt}/bucket={bucket}" for bucket, attempt in wanted.items()]
        frame = self.spark.read.schema(spec.silver).option("basePath", base).parquet(*paths)
        return frame.select(*spec.silver.names)

    def counts(self) -> dict[str, int]:
        return {name: frame.count() for name, frame in self.read().items()}

    def rejections(self) -> DataFrame:
        """Rejection history: one record per batch, type, identifier and reason; last load wins.

        Only attempts that were committed count, so a failed load leaves nothing behind.
        """
        schema = T.StructType([*QUARANTINE, T.StructField("attempt", T.LongType())])
        kept = self._table("rejections", schema)
        if not files.names(self.spark, self._versions):
            return kept.drop("attempt").limit(0)
        committed = self.spark.read.schema("version long, attempt long").json(self._versions)
        return upsert.latest_per_key(
            kept.join(committed, "attempt"), upsert.REJECTION_KEY, F.desc("version"), F.desc("source_row")
        ).select(*QUARANTINE.names)

    # --- loading -------------------------------------------------------------------------------

    def load(
        self, accepted: Mapping[str, DataFrame], rejected: DataFrame, batch_id: str
    ) -> dict[str, int]:
        """Merge a batch into the state; returns inserted, updated and skipped counts."""
        version, held = self._base()
        return self._merge(accepted, rejected, batch_id, version, held)

    def full_refresh(self, accepted: Mapping[str, DataFrame], batch_id: str) -> dict[str, int]:
        """Replace the state by one batch; readers see the old state until the commit."""
        version, _ = self._base()
        nothing = self.spark.createDataFrame([], QUARANTINE)
        return self._merge(accepted, nothing, batch_id, version, {})

    def _base(self) -> tuple[int, dict[str, Held]]:
        """The version a load starts from; no load starts while another one commits."""
        version, content = files.last_manifest(self.spark, self._versions)
        if content is None:
            raise PipelineError(
                f"Version {version} is being committed; load again, or remove its manifest "
                "if its writer is gone"
            )
        return version, self._held(content)

    def _merge(
        self,
        accepted: Mapping[str, DataFrame],
        rejected: DataFrame,
        batch_id: str,
        version: int,
        held: Mapping[str, Held],
    ) -> dict[str, int]:
        attempt = time.time_ns()
        work = f"{self.root}/work/{attempt}"
        total = dict.fromkeys(("inserted_count", "updated_count", "skipped_count"), 0)
        following, changed = dict(held), {}
        try:
            merged = session.together(
                self.spark,
                {
                    name: partial(self._merged, spec, accepted[name], held.get(name), attempt, work)
                    for name, spec in ENTITIES.items()
                },
            )
            for name, (records, metrics, part) in merged.items():
                changed[name] = records
                for column, n in metrics.items():
                    total[column] += n
                if part is not None:
                    following[name] = part
            upsert.latest_per_key(rejected, upsert.REJECTION_KEY, F.desc("source_row")).withColumn(
                "attempt", F.lit(attempt).cast("long")
            ).write.mode("append").partitionBy("batch_id").parquet(f"{self.root}/rejections")
            if following != dict(held):
                self._require_constraints(changed, following)
            self._commit(version + 1, following, batch_id, attempt)
        finally:
            session.remove(self.spark, work)
        return total

    def _merged(
        self, spec: Entity, incoming: DataFrame, held: Held | None, attempt: int, work: str
    ) -> tuple[DataFrame, dict[str, int], Held | None]:
        """Changed records, counts, and the new state of an entity if there is one."""
        records, metrics = self._changes(spec.name, incoming, held, work)
        if not (metrics["inserted_count"] or metrics["updated_count"]):
            return records, metrics, held
        return records, metrics, self._write(spec, attempt, records, held, metrics["inserted_count"])

    def _changes(
        self, name: str, incoming: DataFrame, held: Held | None, work: str
    ) -> tuple[DataFrame, dict[str, int]]:
        """Records that are new or differ, written to the work folder, and the counts of a load."""
        spec = ENTITIES[name]
        stored = self._entity(name, held)
        seen = Observation()
        compared = upsert.compared(incoming.select(*spec.silver.names), stored, spec.key).observe(
            seen, *[F.count_if(F.col("action") == action).alias(action) for action in upsert.ACTIONS]
        )
        compared.filter(F.col("action") != upsert.SKIP).write.parquet(f"{work}/{name}")
        schema = T.StructType([*spec.silver, T.StructField("action", T.StringType())])
        counts = dict(zip(("inserted_count", "updated_count", "skipped_count"), (seen.get[a] for a in upsert.ACTIONS), strict=True))
        return self.spark.read.schema(schema).parquet(f"{work}/{name}").drop("action"), counts

    def _write(self, spec: Entity, attempt: int, changed: DataFrame, held: Held | None, inserted: int) -> Held:
        """Write the touched buckets: their stored records without the changed ones, and these."""
        rows = (held.rows if held else 0) + inserted
        outgrown = held is None or rows > 2 * BUCKET_ROWS * held.buckets
        buckets = bucket_count(rows) if outgrown else held.buckets
        bucket = bucket_of(spec.key, buckets)
        touched = [] if outgrown else [r.b for r in changed.select(bucket.alias("b")).distinct().collect()]
        stored = self._entity(spec.name, held, None if outgrown else touched)
        untouched = stored.join(changed.select(spec.key), spec.key, "left_anti")
        column = LOOKED_UP.get(spec.name, spec.key)
        path = f"{self.root}/data/{spec.name}/attempt={attempt}"
        (
            untouched.select(*spec.silver.names)
            .unionByName(changed.select(*spec.silver.names))
            .withColumn("bucket", bucket)
            .repartition(len(touched) or buckets, "bucket")
            .sortWithinPartitions("bucket", column, spec.key)
            .write.option(f"parquet.bloom.filter.enabled#{column}", "true")
            .partitionBy("bucket")
            .parquet(path)
        )
        written = [name for name in files.names(self.spark, path) if name.startswith("bucket=")]
        own = {int(name.removeprefix("bucket=")): attempt for name in written}
        return Held(buckets, rows, own if outgrown else {**held.attempts, **own})

    def _require_constraints(self, changed: Mapping[str, DataFrame], following: Mapping[str, Held]) -> None:
        """Keys, parents and checks of the records that a load adds or replaces.

        Others kept theirs in an earlier load, and a load removes no parent. A violation leaves the
        old state current.
        """
        state = {name: self._entity(name, following.get(name)) for name in ENTITIES}
        broken = upsert.constraint_violations(changed, state).filter("violations > 0").collect()
        if broken:
            named = ", ".join(f"{row.entity}.{row.constraint} ({row.violations})" for row in broken)
            raise PipelineError(f"The load breaks constraints: {named}")

    def _commit(self, version: int, held: Mapping[str, Held], batch_id: str, attempt: int) -> None:
        entities = {
            name: {"buckets": part.buckets, "rows": part.rows, "attempts": dict(part.attempts)}
            for name, part in held.items()
        }
        content = {"version": version, "attempt": attempt, "batch_id": batch_id, "entities": entities}
        files.commit(self.spark, self._versions, version, content, "version")

    def clean(self, keep: int = 1) -> int:
        """Remove buckets that none of the last ``keep`` versions names; returns how many.

        Attempts younger than the current version may still commit and are left alone; older ones can't,
        since their version exists. Readers of versions before the kept ones lose their files.
        """
        version, content = files.last_manifest(self.spark, self._versions)
        if not version or content is None:
            return 0
        recent = [content] + [
            files.read_manifest(self.spark, self._versions, n) or {} for n in range(max(1, version - keep + 1), version)
        ]
        removed = 0
        for name in ENTITIES:
            used = {
                (attempt, bucket)
                for one in recent
                for bucket, attempt in (self._held(one)[name].attempts.items() if name in self._held(one) else ())
            }
            base = f"{self.root}/data/{name}"
            for folder in files.names(self.spark, base):
                attempt = int(folder.removeprefix("attempt="))
                if attempt > content["attempt"]:
                    continue
                kept = False
                for part in files.names(self.spark, f"{base}/{folder}"):
                    if part.startswith("bucket=") and (attempt, int(part.removeprefix("bucket="))) not in used:
                        session.remove(self.spark, f"{base}/{folder}/{part}")
                        removed += 1
                    else:
                        kept = kept or part.startswith("bucket=")
                if not kept:
                    session.remove(self.spark, f"{base}/{folder}")
        return removed

    # --- audit ---------------------------------------------------------------------------------

    def _log(self, **values: object) -> None:
        row = Row(*RUNS.names)(*[values.get(name) for name in RUNS.names])
        self.spark.createDataFrame([row], RUNS).coalesce(1).write.mode("append").parquet(
            f"{self.root}/runs"
        )

    def start_run(self, batch_id: str, started_at: datetime | None = None) -> datetime:
        """Open the audit row of a batch; a reused batch id starts over."""
        began = started_at or datetime.now(UTC)
        self._log(
            batch_id=batch_id,
            started_at=began,
            final_status="RUNNING",
            event_no=time.time_ns(),
            **dict.fromkeys(COUNTS, 0),
        )
        return began

    def finish_run(
        self,
        batch_id: str,
        started_at: datetime,
        status: str,
        counts: Mapping[str, int] | None = None,
        failure: str | None = None,
    ) -> None:
        given = counts or {}
        self._log(
            batch_id=batch_id,
            started_at=started_at,
            finished_at=datetime.now(UTC),
            final_status=status,
            failure_message=failure[:MAX_FAILURE_TEXT] if failure else None,
            event_no=time.time_ns(),
            **{name: int(given.get(name, 0)) for name in COUNTS},
        )

    def runs(self) -> DataFrame:
        """One audit row per batch id: its last event."""
        events = self._table("runs", RUNS)
        return upsert.latest_per_key(events, ["batch_id"], F.desc("event_no")).drop("event_no")

    def run(self, batch_id: str) -> Row:
        rows = self.runs().filter(F.col("batch_id") == batch_id).collect()
        if not rows:
            raise PipelineError(f"Pipeline run does not exist: {batch_id}")
        return rows[0]

    def latest_run(self) -> DataFrame:
        return self.runs().orderBy(F.desc("started_at")).limit(1)
