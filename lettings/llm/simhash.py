"""SimHash fingerprints and their near copies by deletion-variant signatures.

A fingerprint of 64 bits is cut into two segments. Two fingerprints that differ in at most two bits
differ by at most one bit in one of the segments, so they share a variant of that segment with one
bit wildcarded. Variants are the index: an equality on (segment, wildcard, rest) finds candidates,
which are verified on all 64 bits. The work is done once per distinct fingerprint; copies share one.

A variant that more than ``BUCKET`` fingerprints share is not compared pairwise. Its members are
indexed at the points one flipped bit away instead (and at themselves): two fingerprints at distance
one or two share such a point, two that share one are at most two bits apart, and no point has more
than 65 members. So no group grows with the data and no link is lost.

Null, empty and blank texts have fingerprint zero and are linked like any other. Repeated rows are
returned as often as they come; a null id takes part but never names a component unless all ids of
it are null. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lettings.llm import common, graph

SEED = 42
SHINGLE = 3
SEGMENTS = 2
SEGMENT_BITS = 32
BUCKET = 48
#: Shared variants (16 bytes each) that are broadcast at most; more are joined by a shuffle.
BROADCAST_ROWS = 500_000
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """64 bits, each set where more than half of the shingles' hashes have it set."""
    words = _WORD.findall((text or "").encode().lower())
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) < width:
        return digest(joined, SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    bounds = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in bounds), np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        block = hashes[at : at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.flatnonzero(2 * counts > len(hashes)).tolist()
    return sum(1 << bit for bit in bits)


def fingerprints(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The id and the fingerprint (as a signed long) of every row."""
    rows = documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def map_texts(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = np.array([fingerprint(x) for x in common.texts(part)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), pa.array(found.view(np.int64))], ["key", "print"]
            )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(map_texts, f"key {kind}, print long")


def _variants(prints: DataFrame) -> DataFrame:
    """One row per wildcard of every segment: the index of the fingerprints."""
    number = F.explode(F.sequence(F.lit(0), F.lit(64 - 1))).alias("number")
    at = F.col("number")
    low, high = F.col("print").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("print", 32)
    part = F.when(at < SEGMENT_BITS, low).otherwise(high)
    bit = (at % SEGMENT_BITS).cast("int")
    kept = part.bitwiseAND(F.bitwise_not(F.expr("shiftleft(1L, number % 32)")))
    return prints.select("print", number).select(
        "print",
        kept.bitwiseOR(F.shiftleft(bit.cast("long"), 32))
        .bitwiseOR(F.when(at < SEGMENT_BITS, F.lit(0)).otherwise(F.lit(1 << 40)))
        .alias("variant"),
    )


def _apart(one: Column, other: Column) -> Column:
    return F.bit_count(one.bitwiseXOR(other))


def links(prints: DataFrame, distance: int = 2, bucket: int = BUCKET) -> DataFrame:
    """Links between distinct fingerprints that join everything at most two bits apart.

    Within small variants every verified pair is a link; members of large ones are linked through
    their common points. Both give the same components as all pairs would.
    """
    if distance != 2:
        raise ValueError("two segments with one wildcard serve a distance of two bits")
    # One row becomes 64, so the few bytes of the fingerprints are dealt out first (not by key: a
    # second shuffle by the key of the first would be left out and its partitions joined again).
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = _variants(prints.repartition(parts))
    shared = (
        index.groupBy("variant")
        .agg(
            F.count(F.lit(1)).alias("members"),
            F.min("print").alias("a"),
            F.max("print").alias("b"),
        )
        .filter("members > 1")
    )
    shared = common.stored(shared, "variants")
    near = _apart(F.col("a"), F.col("b")) <= distance
    pairs = shared.filter("members = 2").filter(near).select("a", "b")
    more = shared.filter("members > 2").select("variant", "members")
    more = F.broadcast(more) if more.count() <= BROADCAST_ROWS else more
    several = common.stored(index.join(more, "variant"), "members")
    small = several.filter(F.col("members") <= bucket)
    one = small.select("variant", F.col("print").alias("a"))
    other = small.select("variant", F.col("print").alias("b"))
    verified = one.join(other, "variant").filter(F.col("a") < F.col("b")).filter(near)
    large = several.filter(F.col("members") > bucket).select("print").distinct()
    return pairs.unionByName(verified.select("a", "b")).unionByName(_common_points(large)).distinct()


def _common_points(prints: DataFrame) -> DataFrame:
    flips = F.expr("transform(sequence(0, 63), i -> print ^ shiftleft(1L, i))")
    points = prints.select("print", F.explode(F.concat(F.array("print"), flips)).alias("point"))
    least = F.min("print").over(Window.partitionBy("point"))
    return (
        points.withColumn("least", least)
        .filter("print != least")
        .select(F.col("least").alias("a"), F.col("print").alias("b"))
    )


def roots(rows: DataFrame) -> DataFrame:
    """``print`` and ``root`` (the smallest fingerprint of its component) of every fingerprint."""
    prints = rows.select("print").distinct()
    joined = graph.components(links(prints))
    return prints.join(joined, prints["print"] == joined["node"], "left").select(
        "print", F.coalesce("root", "print").alias("root")
    )


def clusters(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, fingerprint as sixteen hex digits, and the smallest id reachable, for every row."""
    common.prepare(documents.sparkSession)
    rows = common.stored(fingerprints(documents, key, text), "prints")
    parts = roots(rows).join(rows.groupBy("print").agg(F.min("key").alias("least")), "print")
    named = parts.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = parts.join(named, "root").select("print", "component_id")
    digits = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return rows.join(labels, "print").select(
        F.col("key").alias(key), digits.alias("fingerprint"), "component_id"
    )


def first_of_each(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of one row of each group of near copies: that of the smallest id.

    Rows without an id come after all others; among rows of the same id any one stays.
    """
    common.prepare(documents.sparkSession)
    numbered, number = common.numbered(documents)
    both = F.struct(F.col(key).alias("id"), F.col(number).alias("row"))
    prints = fingerprints(numbered.select(both.alias("both"), F.col(text).alias("text")), "both")
    rows = common.stored(prints, "prints")
    order = F.struct(F.col("key.id").isNull(), F.col("key.id"), F.col("key.row").alias("row"))
    best = rows.groupBy("print").agg(F.min(order).alias("best")).join(roots(rows), "print")
    kept = best.groupBy("root").agg(F.min("best").alias("kept"))
    labels = best.select("print", "root").join(kept.select("root", "kept.row"), "root")
    dropped = rows.join(labels, "print").filter(F.col("key.row") != F.col("row"))
    return common.without(numbered, number, dropped.select(F.col("key.row").alias(number)))
