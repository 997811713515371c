"""Batch assessment: record rules, first-wins duplicates, relationships with cascade.

The rules of an entity run once: its records are written as a table, valid and invalid ones apart,
with a short-lived order key instead of a row number. What makes a valid record fail later, a
repeated key or an absent parent, is found on a few narrow columns of that table and written as a
second, narrow table of late rejects. Accepted records are the valid ones without the late
rejects; nothing is parsed or written twice, and every count is a sum over both tables.

Repeated keys are found by an aggregation that combines before its shuffle; the join that marks
their later copies has one row per key on one side, so AQE may split the copies of a hot key over
many tasks. Row numbers, which need the sizes of earlier file splits, and raw texts are looked up
for rejected records only.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lettings import session
from lettings.functions import text
from lettings.functions.hashing import fingerprint
from lettings.model import (
    ENTITIES,
    ORDER,
    ORDER_TYPE,
    QUARANTINE,
    ROW,
    BatchRejected,
    Entity,
    Extract,
    PipelineError,
)
from lettings.operators import rules
from lettings.operators.rules import MALFORMED, RAW, Rule, first_reason, judge

VALID, INVALID = "valid", "invalid"
COMPRESSION = "zstd"
"""Of record tables: it halves the hex digits of fingerprints, which are most of a payment."""
LATE = T.StructType(
    [
        T.StructField(ORDER, ORDER_TYPE),
        T.StructField("reason_code", T.StringType()),
        T.StructField("explanation", T.StringType()),
    ]
)


def record_schema(entity: Entity) -> T.StructType:
    """Columns of the record table: valid records have the first ones, invalid ones the others."""
    stored = [f for f in entity.silver if f.name not in ("batch_id", "processed_at")]
    refused = [f for f in QUARANTINE if f.name in ("source_identifier", "reason_code", "explanation", "raw_record")]
    fields = [T.StructField(f.name, f.dataType) for f in (*stored, *refused)]
    return T.StructType(
        [T.StructField(ORDER, ORDER_TYPE), *fields, T.StructField("outcome", T.StringType())]
    )


def order_key(frame: DataFrame) -> Column:
    """Where a record stands in its extract, comparable and unique."""
    if ORDER in frame.columns:
        return F.col(ORDER)
    return F.struct(
        F.lit("").alias("file"), F.lit(0).cast("long").alias("block"), F.col(ROW).cast("long").alias("id")
    )


def _raw_record(entity: Entity, frame: DataFrame, at: str = RAW) -> Column:
    raw = F.to_json(
        F.struct(*[F.col(f"{at}.{name}").alias(name) for name in sorted(entity.raw)]),
        {"ignoreNullFields": "false"},
    )
    return F.coalesce(F.col(MALFORMED), raw) if MALFORMED in frame.columns else raw


def checked_records(entity: Entity, raw: DataFrame) -> DataFrame:
    """Every record once, judged by its own rules; the only place where the rules are evaluated."""
    judged = judge(entity, raw).withColumn("_valid", F.col("reason").isNull())
    valid, key = F.col("_valid"), F.col(entity.key)
    kinds = {f.name: f.dataType for f in entity.silver}
    columns = {
        ORDER: order_key(judged),
        **{name: F.when(valid, F.col(name).cast(kinds[name])) for name in entity.raw},
        "source_identifier": F.when(~valid & ~text.is_blank(key), key),
        "reason_code": F.col("reason.code"),
        "explanation": F.col("reason.explanation"),
        "raw_record": F.when(~valid, _raw_record(entity, judged)),
        "outcome": F.when(valid, VALID).otherwise(INVALID),
    }
    named = judged.select(*[column.alias(name) for name, column in columns.items()])
    hashed = F.when(F.col("outcome") == VALID, fingerprint(entity.columns))
    return named.withColumn("record_fingerprint", hashed).select(*record_schema(entity).names)


@dataclass(frozen=True)
class Assessed:
    """One entity of a batch: its record table, its late rejects, and where its raw text is."""

    entity: Entity
    records: DataFrame
    late: DataFrame
    raw: Extract
    batch_id: str
    processed_at: Column

    @property
    def valid(self) -> DataFrame:
        """Records that pass their own rules."""
        return self.records.filter(F.col("outcome") == VALID)

    @property
    def accepted(self) -> DataFrame:
        return accepted(self.entity, self.records, self.late, self.batch_id, self.processed_at)

    @property
    def late_rejects(self) -> DataFrame:
        """Valid records that are rejected later, with ``source_row`` and ``reason_code``."""
        refused = self.late.select(ORDER, "reason_code", "explanation")
        found = self.valid.drop("reason_code", "explanation").join(refused, ORDER)
        return self.raw.numbered(found)

    @property
    def rejected(self) -> DataFrame:
        invalid = self.raw.numbered(self.records.filter(F.col("outcome") == INVALID))
        texts = self.raw.records
        torn = [MALFORMED] if MALFORMED in texts.columns else []
        texts = texts.select(order_key(texts).alias(ORDER), F.struct(*self.entity.raw).alias(RAW), *torn)
        late = self.late_rejects.select(
            ORDER, ROW, F.col(self.entity.key).alias("source_identifier"), "reason_code", "explanation"
        ).join(texts, ORDER)
        # JSON is made after the join: all texts cross it, and field names are most of a short record.
        late = late.withColumn("raw_record", _raw_record(self.entity, late))
        return self._quarantine(invalid).unionByName(self._quarantine(late))

    def _quarantine(self, frame: DataFrame) -> DataFrame:
        name = F.col("source_identifier")
        columns = {
            "record_type": F.lit(self.entity.name),
            "source_identifier": F.coalesce(name, F.concat(F.lit("row-"), F.col(ROW).cast("string"))),
            "batch_id": F.lit(self.batch_id),
            "processed_at": self.processed_at,
        }
        return frame.select(*[columns.get(f.name, F.col(f.name)).alias(f.name) for f in QUARANTINE])

    @property
    def counts(self) -> DataFrame:
        """Entity, outcome, reason code and number of records; one pass over narrow columns."""
        own = self.records.groupBy("outcome", "reason_code").agg(F.count(F.lit(1)).alias("n"))
        late = self.late.groupBy("reason_code").agg(F.count(F.lit(1)).alias("n"))
        return own.select(F.lit(self.entity.name).alias("entity"), "outcome", "reason_code", "n").unionByName(
            late.select(F.lit(self.entity.name).alias("entity"), F.lit(LATER).alias("outcome"), "reason_code", "n")
        )


LATER = "late"


def accepted(
    entity: Entity, records: DataFrame, late: DataFrame, batch_id: str, processed_at: Column
) -> DataFrame:
    """Valid records that no later step rejects, in the columns of Silver.

    A fingerprint crosses the anti-join as bytes: hex digits are twice as long and compress badly.
    """
    short = F.unhex("record_fingerprint").alias("_fingerprint")
    valid = records.filter(F.col("outcome") == VALID).select("*", short).drop("record_fingerprint")
    kept = valid.join(late.select(ORDER), ORDER, "left_anti")
    stamped = kept.withColumns(
        {
            "record_fingerprint": F.lower(F.hex("_fingerprint")),
            "batch_id": F.lit(batch_id),
            "processed_at": processed_at,
        }
    )
    return stamped.select(*entity.silver.names)


def mark_repeats(valid: DataFrame, key: str, order: str = ORDER) -> DataFrame:
    """Give every copy of a key but the first in source order a ``DUPLICATE_IDENTIFIER`` reason.

    Only keys that occur more than once reach the join; the aggregation keeps one number per
    key and combines before its shuffle. They are written first, so that their size is known: the
    records are shuffled again only if many keys are repeated.
    """
    repeated = session.stored(
        valid.groupBy(key)
        .agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_copies"))
        .filter("_copies > 1")
        .select(key, "_first"),
        "repeated",
    )
    words = F.concat(F.lit(f"{key} '"), F.col(key), F.lit("' occurs more than once"))
    later = F.col(order) > F.col("_first")
    return (
        valid.join(repeated, key, "left")
        .withColumn("reason", F.when(later, rules.reason("DUPLICATE_IDENTIFIER", words)))
        .drop("_first")
    )


@dataclass(frozen=True)
class Parent:
    """A foreign key: the child's column, the parent entity, the reason when it is absent."""

    column: str
    entity: str
    code: str

    def join(self, child: DataFrame, parents: DataFrame) -> DataFrame:
        key = ENTITIES[self.entity].key
        extra = [c for c in ("start_date", "end_date") if self.entity == "rental_agreements"]
        side = parents.select(
            F.col(key).alias(self.column),
            *[F.col(c).alias(f"_{c}") for c in extra],
            F.lit(True).alias(f"_has_{self.entity}"),
        )
        return child.join(side, self.column, "left")

    @property
    def rule(self) -> Rule:
        absent = F.col(f"_has_{self.entity}").isNull()
        return Rule(absent, self.code, f"{self.column} is not present")


PARENTS: dict[str, tuple[Parent, ...]] = {
    "properties": (
        Parent("location_id", "locations", "ORPHAN_LOCATION"),
        Parent("owner_id", "owners", "ORPHAN_OWNER"),
    ),
    "rental_agreements": (
        Parent("property_id", "properties", "ORPHAN_PROPERTY"),
        Parent("tenant_id", "tenants", "ORPHAN_TENANT"),
    ),
    "payments": (Parent("agreement_id", "rental_agreements", "ORPHAN_AGREEMENT"),),
}


def check_parents(
    entity: Entity, checked: DataFrame, parents: Mapping[str, DataFrame]
) -> DataFrame:
    """Add orphan reasons; a duplicate keeps its reason, and still holds its identifier."""
    links = PARENTS.get(entity.name, ())
    if not links:
        return checked
    columns = checked.columns
    for link in links:
        checked = link.join(checked, parents[link.entity])
    broken = [link.rule for link in links]
    if entity.name == "payments":
        due = F.col("due_date")
        broken.append(
            Rule(
                ~due.between(F.col("_start_date"), F.col("_end_date")),
                "PAYMENT_DUE_OUTSIDE_AGREEMENT",
                "due_date must fall within the rental agreement",
            )
        )
    return checked.withColumn(
        "reason", F.coalesce(F.col("reason"), first_reason(broken))
    ).select(*columns)


def late_rejects(entity: Entity, valid: DataFrame, parents: Mapping[str, DataFrame]) -> DataFrame:
    """Order key and reason of valid records that repeat a key or lack a parent: narrow columns only."""
    links = [link.column for link in PARENTS.get(entity.name, ())]
    dates = ["due_date"] if entity.name == "payments" else []
    narrow = valid.select(*dict.fromkeys([ORDER, entity.key, *links, *dates]))
    checked = check_parents(entity, mark_repeats(narrow, entity.key), parents)
    return checked.filter(F.col("reason").isNotNull()).select(
        ORDER, F.col("reason.code").alias("reason_code"), F.col("reason.explanation").alias("explanation")
    )


def write_records(entity: Entity, raw: DataFrame, path: str) -> DataFrame:
    """Judge an extract and write its record table; valid and invalid records are folders of their own."""
    spark = raw.sparkSession
    checked_records(entity, raw).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).option("compression", COMPRESSION).partitionBy("outcome").parquet(path)
    return spark.read.schema(record_schema(entity)).parquet(path)


def assess(
    batch: Mapping[str, DataFrame | Extract],
    *,
    batch_id: str,
    processed_at: Column,
    folder: str | None = None,
) -> dict[str, Assessed]:
    """Assess a whole batch; children see only the parents that survived.

    Writes ``<folder>/<entity>``, for all entities at once, and then, parents first,
    ``<folder>/late/<entity>``, so a record table without late rejects is never taken for a whole one.
    Without a folder the tables go below the shared one of the session.
    """
    extracts: dict[str, Extract] = {}
    for name in ENTITIES:
        if name not in batch:
            raise PipelineError(f"{name}: source entity is absent")
        extracts[name] = batch[name] if isinstance(batch[name], Extract) else Extract(batch[name])
    spark = next(iter(extracts.values())).records.sparkSession
    if folder is None:
        folder = f"{session.shared_folder(spark)}/assessed-{uuid.uuid4().hex}"
    session.remove(spark, f"{folder}/late")
    with session.tidy(spark):
        records = session.together(
            spark,
            {
                name: partial(write_records, spec, extracts[name].records, f"{folder}/{name}")
                for name, spec in ENTITIES.items()
            },
        )
        result: dict[str, Assessed] = {}
        kept: dict[str, DataFrame] = {}
        for name, spec in ENTITIES.items():
            valid = records[name].filter(F.col("outcome") == VALID)
            late_rejects(spec, valid, kept).write.option("compression", COMPRESSION).parquet(f"{folder}/late/{name}")
            late = spark.read.schema(LATE).parquet(f"{folder}/late/{name}")
            result[name] = Assessed(spec, records[name], late, extracts[name], batch_id, processed_at)
            kept[name] = result[name].accepted
    return result


def all_rejected(assessed: Mapping[str, Assessed]) -> DataFrame:
    return reduce(DataFrame.unionByName, [part.rejected for part in assessed.values()])


def reason_counts(counts: DataFrame) -> DataFrame:
    refused = counts.filter(_refused())
    return refused.groupBy("reason_code").agg(F.sum("n").alias("rejected_rows"))


def rejection_stats(counts: DataFrame) -> DataFrame:
    """Rejected records and how many different reasons they have."""
    return reason_counts(counts).agg(
        F.coalesce(F.sum("rejected_rows"), F.lit(0)).alias("rejected_rows"),
        F.count(F.lit(1)).alias("reason_codes"),
    )


def count_rows(frames: Mapping[str, DataFrame], column: str) -> DataFrame:
    """One row per entity, in a frame that never leaves the cluster."""
    parts = [
        frame.agg(F.count(F.lit(1)).alias(column)).select(F.lit(name).alias("entity"), column)
        for name, frame in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def all_counts(assessed: Mapping[str, Assessed]) -> DataFrame:
    """Counts of all entities by outcome and reason, gathered once; at most a row per reason."""
    return reduce(DataFrame.unionByName, [part.counts for part in assessed.values()])


def _taken() -> Column:
    return F.col("outcome") != LATER


def _refused() -> Column:
    return F.col("outcome") != VALID


def _sum_if(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long")


def _figures() -> list[Column]:
    """Input, accepted and rejected records as sums over the counts.

    A late reject is counted as a valid record and again as a late one.
    """
    return [
        _sum_if(_taken()).alias("input_count"),
        (_sum_if(F.col("outcome") == VALID) - _sum_if(~_taken())).alias("accepted_count"),
        _sum_if(_refused()).alias("rejected_count"),
    ]


def summarise(counts: DataFrame) -> DataFrame:
    """One row per batch: input, accepted and rejected counts and a map of reason counts.

    The map has one entry per reason code, a fixed list, so gathering it is bounded.
    """
    by_reason = counts.withColumn("reason_code", F.when(_refused(), F.col("reason_code")))
    by_reason = by_reason.groupBy("reason_code").agg(
        _sum_if(_taken()).alias("taken"),
        _sum_if(~_refused()).alias("valid"),
        _sum_if(~_taken()).alias("late"),
        _sum_if(_refused()).alias("refused"),
    )
    named = F.col("reason_code").isNotNull()
    entry = F.when(named, F.struct("reason_code", F.col("refused").alias("rejected_rows")))
    return by_reason.agg(
        F.coalesce(F.sum("taken"), F.lit(0)).alias("input_count"),
        F.coalesce(F.sum("valid") - F.sum("late"), F.lit(0)).alias("accepted_count"),
        F.coalesce(F.sum("refused"), F.lit(0)).alias("rejected_count"),
        F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("reason_counts"),
    )


def reconcile(inputs: DataFrame, counts: DataFrame) -> DataFrame:
    """Per entity: the records of the source (entity, input_count) must equal accepted plus rejected."""
    outcome = counts.groupBy("entity").agg(*_figures()[1:])
    total = F.col("accepted_count") + F.col("rejected_count")
    return inputs.join(outcome, "entity", "left").withColumn(
        "balanced", F.coalesce(F.col("input_count") == total, F.lit(False))
    )


def strict_issues(batch: Mapping[str, DataFrame]) -> DataFrame:
    """Every issue of a strict batch.

    Unlike ``assess`` there is no cascade: a child is compared with all parents that passed
    their own record rules, even those that are orphans themselves. An absent entity is an
    issue too.
    """
    parts: list[DataFrame] = []
    unpruned: dict[str, DataFrame] = {}
    spark = next(iter(batch.values())).sparkSession
    folder = f"{session.shared_folder(spark)}/strict-{uuid.uuid4().hex}"

    def issue(frame: DataFrame, spec: Entity, stage: int) -> DataFrame:
        return frame.select(
            F.lit(stage).alias("stage"),
            F.lit(list(ENTITIES).index(spec.name)).alias("position"),
            F.lit(spec.name).alias("entity"),
            F.col(f"{ORDER}.id").alias("row_number"),
            F.col("reason_code").alias("code"),
            F.col("explanation").alias("message"),
        )

    present = {name: spec for name, spec in ENTITIES.items() if name in batch}
    records = session.together(
        spark,
        {name: partial(write_records, spec, batch[name], f"{folder}/{name}") for name, spec in present.items()},
    )
    for name, spec in ENTITIES.items():
        if name not in batch:
            absent = spark.range(1).select(
                F.struct(F.lit(0).cast("long").alias("id")).alias(ORDER),
                F.lit("MISSING_ENTITY").alias("reason_code"),
                F.lit("source entity is absent").alias("explanation"),
            )
            parts.append(issue(absent, spec, 0))
            unpruned[name] = spark.createDataFrame([], spec.silver)
            continue
        valid = records[name].filter(F.col("outcome") == VALID)
        late_rejects(spec, valid, unpruned).write.option("compression", COMPRESSION).parquet(f"{folder}/late/{name}")
        late = spark.read.schema(LATE).parquet(f"{folder}/late/{name}")
        repeated = F.col("reason_code") == "DUPLICATE_IDENTIFIER"
        parts.append(issue(records[name].filter(F.col("outcome") == INVALID), spec, 0))
        parts.append(issue(late.filter(repeated), spec, 0))
        parts.append(issue(late.filter(~repeated), spec, 1))
        unpruned[name] = valid.join(late.filter(repeated).select(ORDER), ORDER, "left_anti")
    return reduce(DataFrame.unionByName, parts)


def require_valid(batch: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Strict mode: normalised entities, or ``BatchRejected`` naming the first five issues."""
    issues = strict_issues(batch)
    total = issues.count()
    if total:
        first = issues.orderBy("stage", "position", "row_number").limit(5).collect()
        preview = [f"{r.entity}[row={r.row_number}] {r.code}: {r.message}" for r in first]
        raise BatchRejected(total, preview)
    return {
        name: judge(spec, batch[name]).select(*rules.normalised(spec))
        for name, spec in ENTITIES.items()
    }
