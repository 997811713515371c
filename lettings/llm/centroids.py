"""k-means in whole numbers through a vector approximation file.

Vectors become integers and are written once, each with its approximation: the number of a cell, a
few bits, for every component. Cell bounds come from a bounded sample; outer cells are open. For
every round, small tables say for each component, cell and centroid how near and how far a value of
that cell can be; summed over a vector's cells they bound its distance to every centroid from below and
above. Only centroids whose interval reaches down to the least upper bound can be nearest. Where
one is left it is the nearest; only where intervals overlap is the full vector decoded and compared,
and with the overlapping centroids alone. Results do not depend on the cells: a poor approximation costs time only.

Every round is one scan of the file without a shuffle of vectors: tasks add up their vectors by
cluster, and Spark sums one row for each cluster and task. The driver sees the centroids, the
clusters' sums and a sample of ``SAMPLE`` vectors.

Vectors that are null, that have another number of components, or that hold null or non-finite ones,
are left out. Equal vectors and repeated ids are rows of their own; rows of equal id, which have equal
hashes, start in the order of their vectors' bytes. A null id is hashed as an empty one. With fewer
vectors than centroids each is a centroid. Components beyond ``LARGEST`` after scaling count as that, so that
distances fit a long. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettings.llm import common

COMPONENTS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
SEED = 1
#: Bits of a cell, and cells beyond the sample's middle on each side.
BITS = 6
OUTER = 8
SAMPLE = 16_384
LARGEST = 1 << 27
#: Vectors compared at a time, so that distances take some 32 MB.
BLOCK = 8_192


def _whole(vectors: pa.Array, components: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors are kept, and their integers."""
    sizes = vectors.value_lengths()
    kept = np.asarray(sizes.fill_null(-1)) == components
    values = vectors.filter(pa.array(kept)).flatten()
    whole = np.asarray(values.is_valid()).reshape(-1, components)
    numbers = np.asarray(values.fill_null(0), np.float64).reshape(-1, components)
    fine = (whole & np.isfinite(numbers)).all(1)
    kept[np.flatnonzero(kept)[~fine]] = False
    with np.errstate(over="ignore"):
        scaled = np.floor(scale * numbers[fine])
    return kept, np.clip(scaled, -LARGEST, LARGEST).astype("<i4")


def _rows(matrix: np.ndarray) -> pa.Array:
    """A matrix as one binary value a row."""
    width = matrix.shape[1] * matrix.itemsize
    data = pa.py_buffer(np.ascontiguousarray(matrix).tobytes())
    return pa.Array.from_buffers(pa.binary(width), len(matrix), [None, data]).cast(pa.binary())


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _integers(components: int, scale: int):
    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, whole = _whole(batch.column("vector"), components, scale)
            keys = batch.column("key").filter(pa.array(kept))
            yield pa.RecordBatch.from_arrays([keys, _rows(whole)], ["key", "full"])

    return convert


def cell_bounds(sample: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The least integer of every cell but the first, by component.

    Cells are of equal width in the middle of the sample, where nearly all components lie, and of another
    equal width on both sides of it; repeated bounds make empty cells.
    """
    outer = min(OUTER, (1 << bits) // 4)
    inner = (1 << bits) - 2 * outer
    low, high = np.quantile(sample, [0.005, 0.995], axis=0, method="nearest")
    ends = sample.min(0), sample.max(0) + 1
    parts = [
        np.linspace(ends[0], low, outer, endpoint=False),
        np.linspace(low, np.maximum(high + 1, low + inner), inner, endpoint=False),
        np.linspace(np.maximum(high + 1, low + inner), np.maximum(ends[1], low + inner), outer, endpoint=False),
    ]
    return np.ceil(np.concatenate(parts)[1:]).astype(np.int64).T


def cells_of(whole: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    columns = [np.searchsorted(bounds[i], whole[:, i], side="right") for i in range(whole.shape[1])]
    return np.stack(columns, 1).astype(np.uint8) if columns else np.zeros(whole.shape, np.uint8)


def lookup(bounds: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest squared difference by component, cell and centroid; outer cells are open."""
    components, last = bounds.shape
    low = np.concatenate([np.full((components, 1), -np.inf), bounds], 1)[:, :, None]
    high = np.concatenate([bounds - 1, np.full((components, 1), np.inf)], 1)[:, :, None]
    at = centroids.T[:, None, :].astype(np.float64)
    nearest = np.maximum(0, np.maximum(low - at, at - high)) ** 2
    farthest = np.maximum(np.abs(low - at), np.abs(high - at)) ** 2
    empty = np.broadcast_to(high < low, nearest.shape)
    return np.where(empty, 0, nearest), np.where(empty, 0, farthest)


def packed(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Cells of ``bits`` bits each, packed into bytes."""
    width = np.unpackbits(cells[:, :, None], axis=2)[:, :, 8 - bits :]
    return np.packbits(width.reshape(len(cells), -1), axis=1)


def unpacked(approximation: np.ndarray, components: int, bits: int = BITS) -> np.ndarray:
    flat = np.unpackbits(approximation, axis=1)[:, : components * bits].reshape(-1, components, bits)
    weights = (1 << np.arange(bits - 1, -1, -1)).astype(np.uint8)
    return (flat * weights).sum(2, dtype=np.uint8)


def candidates(cells: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Which centroids may be nearest, from the cells alone."""
    low = np.zeros((len(cells), tables[0].shape[2]))
    high = np.zeros_like(low)
    for i in range(cells.shape[1]):
        low += tables[0][i][cells[:, i]]
        high += tables[1][i][cells[:, i]]
    # Sums beyond 2^53 are rounded; the slack keeps the bound on the safe side.
    return low * (1 - 1e-12) <= high.min(1)[:, None] * (1 + 1e-12)


def nearest(possible: np.ndarray, whole: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The nearest possible centroid, of equal ones the first; one vector is read for each overlap."""
    found = possible.argmax(1)
    open_rows = np.flatnonzero(possible.sum(1) > 1)
    for at in range(0, len(open_rows), BLOCK):
        rows = open_rows[at : at + BLOCK]
        distance = np.full((len(rows), len(centroids)), np.iinfo(np.int64).max)
        full = whole[rows].astype(np.int64)
        for c, centroid in enumerate(centroids):
            asked = possible[rows, c]
            distance[asked, c] = ((full[asked] - centroid) ** 2).sum(1)
        found[rows] = distance.argmin(1)
    return found


def _scan(bounds: np.ndarray, centroids: np.ndarray, bits: int):
    """Assign the rows of a batch: cells first, full vectors where several centroids are left."""
    tables = lookup(bounds, centroids)
    components = len(bounds)

    def assign(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        whole = _matrix(batch.column("full"), "<i4")
        approximation = _matrix(batch.column("cells"), np.uint8)
        parts = [np.zeros(0, np.int64)]
        for at in range(0, len(whole), BLOCK):
            part = slice(at, at + BLOCK)
            possible = candidates(unpacked(approximation[part], components, bits), tables)
            parts.append(nearest(possible, whole[part], centroids))
        return whole, np.concatenate(parts)

    return assign


def _approximated(bounds: np.ndarray, bits: int):
    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cells = packed(cells_of(_matrix(batch.column("full"), "<i4"), bounds), bits)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), _rows(cells), batch.column("full")], ["key", "cells", "full"]
            )

    return convert


def _summed(bounds: np.ndarray, centroids: np.ndarray, bits: int):
    """One row for each cluster of a task: its vectors and their sum."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign = _scan(bounds, centroids, bits)
        sums = np.zeros(centroids.shape, np.int64)
        sizes = np.zeros(len(centroids), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            whole, cluster = assign(batch)
            order = np.argsort(cluster, kind="stable")
            kinds, starts = np.unique(cluster[order], return_index=True)
            sums[kinds] += np.add.reduceat(whole[order].astype(np.int64), starts, axis=0)
            sizes += np.bincount(cluster, minlength=len(centroids))
        some = np.flatnonzero(sizes)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(some, pa.int32()),
                pa.array(sizes[some]),
                pa.array(sums[some].tolist(), pa.list_(pa.int64())),
            ],
            ["cluster", "n", "sums"],
        )

    return add


def _measured(bounds: np.ndarray, centroids: np.ndarray, bits: int):
    """Cluster and exact squared distance of every vector."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign = _scan(bounds, centroids, bits)
        for batch in batches:
            if not batch.num_rows:
                continue
            whole, cluster = assign(batch)
            apart = whole.astype(np.int64) - centroids[cluster]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(cluster, pa.int32()), pa.array((apart**2).sum(1))],
                ["key", "cluster", "distance"],
            )

    return measure


def _first(file: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors with the smallest hashes of their ids, in that order."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit("")))
    hashed = file.select(F.sha2(text.cast("binary"), 256).alias("hash"), "full")
    chosen = hashed.orderBy("hash", "full").limit(clusters).collect()
    return np.array([np.frombuffer(bytes(row.full), "<i4") for row in chosen], np.int64)


def clustered(
    embeddings: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: int = SEED,
    bits: int = BITS,
) -> tuple[DataFrame, np.ndarray]:
    """Key, cluster and squared distance of every kept vector, and the final centroids."""
    given = embeddings.select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    kind = given.schema["key"].dataType.simpleString()
    whole = common.stored(
        given.mapInArrow(_integers(components, scale), f"key {kind}, full binary"), "integers"
    )
    size = whole.count()
    schema = f"key {kind}, cluster int, distance long"
    if not size:
        return embeddings.sparkSession.createDataFrame([], schema), np.zeros((0, components), np.int64)
    centroids = _first(whole, clusters, seed)
    share = common.share_of(size, SAMPLE)
    taken = whole.filter(common.in_sample(F.struct("key", "full"), share, "va"))
    # Copies of one vector and id share a hash; the limit holds the bound for them too.
    sample = [bytes(row.full) for row in taken.select("full").limit(2 * SAMPLE).collect()]
    fitted = np.array([np.frombuffer(x, "<i4") for x in sample], np.int64) if sample else centroids
    bounds = cell_bounds(fitted, bits)
    file = common.stored(
        whole.mapInArrow(_approximated(bounds, bits), f"key {kind}, cells binary, full binary"), "cells"
    )
    for _ in range(rounds):
        sums = file.select("cells", "full").mapInArrow(
            _summed(bounds, centroids, bits), "cluster int, n long, sums array<long>"
        )
        totals = sums.groupBy("cluster").agg(
            F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(components)]).alias("sums")
        )
        centroids = centroids.copy()
        for row in totals.collect():
            centroids[row.cluster] = [x // row.n for x in row.sums]
    return file.mapInArrow(_measured(bounds, centroids, bits), schema), centroids


def named(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def digest(embeddings: DataFrame, key: str = "vec_id", **options: object) -> DataFrame:
    """The query's columns."""
    found, centroids = clustered(embeddings, key, **options)
    spark = embeddings.sparkSession
    found = common.stored(found, "clusters")
    inertia = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()
    total = sum(row.cluster_inertia for row in inertia)
    facts = [(row.cluster, row.cluster_inertia, total, named(centroids[row.cluster])) for row in inertia]
    clusters = spark.createDataFrame(
        facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    # One row a cluster.
    return found.join(F.broadcast(clusters), "cluster").select(
        F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
