"""Documents drawn towards a target distribution: importance weights of hashed features, exact top k.

A document's weight is the mean log ratio of its features' frequencies in the target and in the
corpus, looked up in one array over hash buckets; Gumbel noise by the document's id turns the
highest scores into a draw without replacement. The draw needs only the key of its last winner, so
nothing is sorted but the winners: every chunk of the stored keys names its median, the median of
these medians, weighted by how many keys each chunk has left, is ranked against all remaining keys,
and the side that can't hold the cutoff goes. At least about a quarter of what remains is on either
side of such a pivot, whatever the order of the rows, so rounds grow with the logarithm of the
table. Chunks have at most ``CHUNK`` keys, and more than ``PARTS`` medians are reduced by medians of
their own before any reach the driver.

Keys are score (high first), id (low first, null last) and row number, so that ties and repeated rows have
one order. A null text has no features, weight 0 and, if ``least_words`` is positive, is never drawn; so
has an empty one. Texts of any length are cut into words in pieces of ``PIECE`` bytes at blanks. A null id
is hashed as an empty one. An empty corpus gives an empty result; an empty target is all smoothing.
Other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettings.llm import common

BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
#: Keys of one median, and medians that reach the driver at once (about twice as many at most).
CHUNK = 65_536
PARTS = 4_096
#: Keys left when one small sort finds the cutoff.
FINISH = 1_024
PIECE = 1 << 20

#: Bytes as words see them: A-Z in lower case, all other ASCII but digits and letters blank.
_AS_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, piece by piece; no word is cut."""
    text = text.translate(_AS_WORDS)
    at = 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            blank = text.rfind(b" ", at, end)
            end = blank if blank > at else text.find(b" ", end)
            end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def _features(text: bytes | None, longest: int, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Number of words and the buckets of all runs of up to ``longest`` words, piece by piece."""
    before: list[bytes] = []
    for words in _pieces(text or b""):
        found = [np.fromiter(map(zlib.crc32, words), np.int64, len(words))]
        joined = before + words
        for width in range(2, longest + 1):
            # Runs that end in this piece; ``before`` holds the words just before it.
            first = max(0, len(before) - width + 1)
            runs = [b" ".join(joined[i : i + width]) for i in range(first, len(joined) - width + 1)]
            found.append(np.fromiter(map(zlib.crc32, runs), np.int64, len(runs)))
        before = joined[-(longest - 1) :] if longest > 1 else []
        yield len(words), np.concatenate(found) % buckets


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def bucket_counts(texts: DataFrame, longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Features of a whole table by bucket: one array a task, summed by Spark; ``buckets`` numbers return."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in _texts(batch):
                for _, found in _features(text, longest, buckets):
                    total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    rows = texts.select("text").mapInArrow(count, "bucket long, n long")
    summed = rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(buckets, np.int64)
    for row in summed:
        counts[row.bucket] = row.n
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of smoothed frequencies by bucket, in thousandths, rounded down."""
    width = len(corpus)
    s_all, t_all = float(corpus.sum() + width), float(target.sum() + width)
    return np.array(
        [
            math.floor(1000 * math.log((float(t) + 1) * s_all / ((float(s) + 1) * t_all)))
            for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def _weighed(gain: np.ndarray, longest: int):
    buckets = len(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in _texts(batch):
                words = features = total = 0
                for number, found in _features(text, longest, buckets):
                    words += number
                    features += len(found)
                    total += int(gain[found].sum())
                rows.append((words, features, total // features if features else 0))
            columns = np.array(rows, np.int64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("noise"), *[pa.array(column) for column in columns]],
                ["key", "noise", "n_words", "n_features", "weight"],
            )

    return weigh


def gumbel(key: Column, seed: int) -> Column:
    """Gumbel noise in thousandths from the first 32 bits of the key's SHA-256, rounded down."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    share = (drawn.cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(share))).cast("long")


class Pivot(NamedTuple):
    score: int
    key: object
    row: int


_ORDER = [("score", "descending"), ("key", "ascending"), ("row", "ascending")]


def in_order() -> list[Column]:
    return [F.desc("score"), F.asc_nulls_last("key"), F.asc("row")]


def _after(pivot: Pivot) -> Column:
    """Whether a key comes after the pivot."""
    score, key, row = F.col("score"), F.col("key"), F.col("row")
    if pivot.key is None:
        later, same = F.lit(False), key.isNull()
    else:
        later = key.isNull() | (key > F.lit(pivot.key))
        same = key.eqNullSafe(F.lit(pivot.key))
    return (score < pivot.score) | ((score == pivot.score) & (later | (same & (row > pivot.row))))


def _median(rows: pa.Table) -> pa.Table:
    """The row at which half of the weight is reached, with all of the weight."""
    rows = rows.take(pc.sort_indices(rows, sort_keys=_ORDER, null_placement="at_end"))
    reached = np.cumsum(rows.column("left").to_numpy())
    at = int(np.searchsorted(reached, (reached[-1] + 1) // 2))
    chosen = rows.slice(at, 1)
    return chosen.set_column(chosen.column_names.index("left"), "left", pa.array([int(reached[-1])]))


def _medians(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            part = batch.slice(at, CHUNK)
            if size + part.num_rows > CHUNK:
                yield from _median(pa.Table.from_batches(held)).to_batches()
                held, size = [], 0
            held.append(part)
            size += part.num_rows
    if size:
        yield from _median(pa.Table.from_batches(held)).to_batches()


def _pivot(keys: DataFrame) -> Pivot:
    """The weighted median of the medians of all chunks."""
    level = keys.select("score", "key", "row", F.lit(1).cast("long").alias("left"))
    schema = level.schema
    medians = level.mapInArrow(_medians, schema)
    parts = keys.rdd.getNumPartitions()
    if parts > PARTS:
        medians = common.stored(medians, "medians")
        while (count := medians.count()) > PARTS:
            medians = common.stored(
                medians.repartition(-(-count // PARTS)).mapInArrow(_medians, schema), "medians"
            )
    chosen = _median(medians.toArrow()).to_pylist()[0]
    return Pivot(chosen["score"], chosen["key"], chosen["row"])


def cutoff(keys: DataFrame, drawn: int) -> Pivot | None:
    """The key of the last of ``drawn`` winners among stored keys (score, key, row); none for none."""
    if drawn < 1:
        return None
    left, size, wanted = keys, keys.count(), drawn
    if wanted > size:
        raise ValueError(f"{drawn} winners asked of {size} keys")
    while size > FINISH:
        pivot = _pivot(left)
        behind = _after(pivot)
        rank = size - left.filter(behind).count()
        if rank == wanted:
            return pivot
        if rank > wanted:
            at_pivot = (F.col("score") == pivot.score) & (F.col("row") == pivot.row)
            left, size = left.filter(~behind & ~at_pivot), rank - 1
        else:
            left, size, wanted = left.filter(behind), size - rank, wanted - rank
    last = left.orderBy(*in_order()).offset(wanted - 1).limit(1).first()
    return Pivot(last["score"], last["key"], last["row"])


def ranked(winners: DataFrame) -> DataFrame:
    """Winners with ``rank`` 1, 2, ...: a range sort, and one row a partition for what comes before it."""
    ordered = common.stored(
        winners.orderBy(*in_order()).select(
            "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")
        ),
        "winners",
    )
    sizes = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("start")).collect()
    shift, before = [], 0
    for size in sorted(sizes, key=lambda x: x.part):
        shift.append((size.part, before + 1 - size.start))
        before += size.n
    spark = winners.sparkSession
    shifts = spark.createDataFrame(shift, "part int, shift long")
    return (
        ordered.join(F.broadcast(shifts), "part")  # one row for each partition of a sort
        .withColumn("rank", F.col("at") + F.col("shift"))
        .drop("part", "at", "shift")
    )


def drawn(
    documents: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    longest: int = 1,
    buckets: int = BUCKETS,
    seed: int = SEED,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """Id, features, weight, score and rank (null if not drawn) of every document.

    Of the documents with at least ``least_words`` words, ``percent`` in a hundred are drawn, rounded down.
    """
    given = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    gain = gains(
        bucket_counts(given, longest, buckets),
        bucket_counts(target.select(F.col(target_text).alias("text")), longest, buckets),
    )
    kind = given.schema["key"].dataType.simpleString()
    weighed = given.select("key", "text", gumbel(F.col("key"), seed).alias("noise")).mapInArrow(
        _weighed(gain, longest), f"key {kind}, noise long, n_words long, n_features long, weight long"
    )
    scored = common.stored(
        weighed.select(
            "key",
            "n_words",
            "n_features",
            "weight",
            (F.col("weight") + F.col("noise")).alias("score"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "scored",
    )
    enough = F.col("n_words") >= least_words
    keys = scored.filter(enough).select("score", "key", "row")
    last = cutoff(keys, percent * keys.count() // 100)
    columns = ["key", "n_features", "weight", "score"]
    if last is None:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    behind = _after(last) | ~enough
    others = scored.filter(behind).select(*columns, F.lit(None).cast("long").alias("rank"))
    winners = ranked(scored.filter(~behind).select(*columns, "row"))
    return winners.select(*columns, "rank").unionByName(others)


def digest(documents: DataFrame, target: DataFrame, key: str = "doc_id", **options: object) -> DataFrame:
    """The query's columns."""
    found = drawn(documents, target, key, **options)
    return found.withColumnRenamed("key", key)
