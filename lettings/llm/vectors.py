"""Near copies among embeddings: spherical k-means cells and blocked cosine products within cells.

Equal vectors with equal labels are one vector with a weight. A label with over ``CELL`` different
vectors has cells of its own: centroids are fitted on a bounded sample of its vectors, each label in
its own task. Every vector is then assigned to its nearest cell, its home, and visits the other cells
of its label whose centroid is nearly as close; vectors are dealt to tasks in parts of bounded size,
each with its label's centroids, so neither a hot label nor many labels fill a task or the driver.
Within a cell, the blocks of home vectors are multiplied with each other and with the blocks of
visitors. Visitors are never compared among themselves, and a pair that both vectors' cells find is
counted in the cell of lower number only. Each product adds up the links of its vectors and reduces
its pairs to a spanning forest, stripe by stripe, so pairs are counted exactly but never sent on.

Cells have some ``CELL`` vectors as long as their number may grow; larger ones have more blocks, and
none of them is larger than ``BLOCK``. A vector x of home h visits the cell of centroid c if
``x.c >= x.h - sqrt((1 - threshold) / 2) * |h - c|``. That loses no link: for x and y at the threshold, of
homes h and c, what x falls short by in c and y in h adds up to ``(x - y).(h - c)``, which is at most
``sqrt(2 - 2 * threshold) * |h - c|``, so one of both falls short by half of it at most and visits.

Vectors that are null, empty or zero, that hold null or non-finite components, that have another
number of components than the one compared with, or that have no label, link with nothing. Rows without an
id take part but name a component only if all its ids are null. Repeated rows are rows of their own.
Ties between cells go to the lower number. An empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettings.llm import common, graph

THRESHOLD = 0.93
#: Vectors in a cell, and the greatest number of cells of a label.
CELL = 2000
CELLS = 1024
#: Sample of the fit: vectors for each cell.
SAMPLE = 24
#: Added to the square of a visit's bound, for rounding.
ROUNDING = 1e-12
BLOCK = 2048
#: Rows of a block that are multiplied at once.
STRIPE = 256
#: Cosines with centroids that one task computes at once, and the fewest vectors it takes.
ASSIGNED, LEAST_ASSIGNED = 262_144, 256
ROUNDS = 12


def fit(sample: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means: unit centroids that maximise the cosines of their members."""
    random = np.random.default_rng(7)
    cells = max(1, min(cells, len(sample)))
    centroids = sample[random.permutation(len(sample))[:cells]].copy()
    for _ in range(rounds):
        nearest = np.concatenate(
            [(sample[a : a + 4096] @ centroids.T).argmax(1) for a in range(0, len(sample), 4096)]
        )
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        norms = np.linalg.norm(sums, axis=1)
        moved = np.where(norms[:, None] > 0, sums / np.maximum(norms, 1e-300)[:, None], centroids)
        if np.abs(moved - centroids).max() < 1e-9:
            break
        centroids = moved
    return centroids


def unit(values: list | None) -> np.ndarray | None:
    """The direction of a vector in double precision; none if it has none."""
    if not values or any(x is None for x in values):
        return None
    vector = np.array(values, np.float64)
    if not np.isfinite(vector).all():
        return None
    largest = np.abs(vector).max()
    if largest == 0:
        return None
    vector = vector / largest  # so that squares neither vanish nor overflow
    return vector / np.linalg.norm(vector)


def _directions(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        found = [
            None if label is None else unit(values)
            for label, values in zip(
                part.column("label").to_pylist(), part.column("vector").to_pylist(), strict=True
            )
        ]
        yield pa.RecordBatch.from_arrays(
            [
                part.column("key"),
                part.column("label"),
                pa.array([None if x is None else x.astype("<f8").tobytes() for x in found], pa.binary()),
            ],
            ["key", "label", "unit"],
        )


def _matrix(units: pd.Series | list) -> np.ndarray:
    return np.frombuffer(b"".join(units), "<f8").reshape(len(units), -1)


def _fitted(rows: pd.DataFrame) -> pd.DataFrame:
    """The centroids of one label and width, from its sample."""
    sample = _matrix(sorted(rows["unit"].tolist()))
    found = rows[["label", "width"]].iloc[:1].copy()
    found["centroids"] = [fit(sample, int(rows["cells"].iloc[0])).astype("<f8").tobytes()]
    return found


_PLACES = ["node", "label", "weight", "unit", "width", "cell", "home", "visits"]


def _assigned(threshold: float):
    """A row for the home of each vector and one for each cell that it visits."""
    slack = np.sqrt(max(0.0, (1 - threshold) / 2) + ROUNDING)

    def assign(rows: pd.DataFrame, fitted: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({name: [] for name in _PLACES})
        units = _matrix(rows["unit"].tolist())
        if len(fitted):
            centroids = np.frombuffer(fitted["centroids"].iloc[0], "<f8").reshape(-1, units.shape[1])
        else:
            centroids = np.zeros((1, units.shape[1]))
        cosines = units @ centroids.T
        home = cosines.argmax(1)
        squares = (centroids * centroids).sum(1)
        apart = squares[home][:, None] + squares - 2 * centroids[home] @ centroids.T
        margins = slack * np.sqrt(np.maximum(apart, 0) + ROUNDING)
        row, cell = np.nonzero(cosines >= cosines[np.arange(len(units)), home][:, None] - margins)
        visits = np.split(cell.astype(np.int32), np.flatnonzero(np.diff(row)) + 1)
        found = rows[["node", "label", "weight", "unit", "width"]].iloc[row].reset_index(drop=True)
        found["cell"] = cell.astype(np.int32)
        found["home"] = home[row].astype(np.int32)
        found["visits"] = [visits[r] for r in row]
        return found

    return assign


def _placed(nodes: DataFrame, cell: int, threshold: float) -> DataFrame:
    """Every vector at home and in each cell it visits; small labels are one cell."""
    group = ["label", "width"]
    sizes = (
        nodes.groupBy(*group)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > cell)
        .withColumn("cells", F.least(F.lit(CELLS), F.ceil(F.col("n") / cell)).cast("int"))
        .withColumn("parts", F.ceil(F.col("n") / F.greatest(F.lit(LEAST_ASSIGNED), F.lit(ASSIGNED) / F.col("cells"))).cast("int"))
    )
    kinds = ", ".join(f"{name} {nodes.schema[name].dataType.simpleString()}" for name in _PLACES[:5])
    small = nodes.join(sizes, group, "left_anti").select(
        *_PLACES[:5], F.lit(0).alias("cell"), F.lit(0).alias("home"), F.array(F.lit(0)).alias("visits")
    )
    large = nodes.join(sizes, group)
    share = F.least(F.lit(1.0), SAMPLE * F.greatest(F.col("cells"), F.lit(64)) / F.col("n"))
    sample = large.filter(common.in_sample(F.col("unit"), share, "cells")).select(*group, "unit", "cells")
    key_kinds = ", ".join(f"{name} {nodes.schema[name].dataType.simpleString()}" for name in group)
    centroids = sample.groupBy(*group).applyInPandas(_fitted, f"{key_kinds}, centroids binary")
    spread = centroids.join(sizes, group).select(
        *group, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "centroids"
    )
    dealt = large.select(*_PLACES[:5], F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"))
    key = [*group, "part"]
    found = dealt.groupBy(*key).cogroup(spread.groupBy(*key)).applyInPandas(
        _assigned(threshold), f"{kinds}, cell int, home int, visits array<int>"
    )
    return small.unionByName(found)


def _forest(root: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The root of every row after joining the linked ones, given the roots before."""
    while True:
        least = np.minimum(root[one], root[other])
        before = root.copy()
        np.minimum.at(root, root[one], least)
        np.minimum.at(root, root[other], least)
        root = root[root]
        if (root == before).all() and (root[one] == root[other]).all():
            return root


def _visit(visits: list, one: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """Whether the cell is among those that the vector visits, pair by pair."""
    widest = max(map(len, visits))
    table = np.full((len(visits), widest), -1, np.int32)
    for at, own in enumerate(visits):
        table[at, : len(own)] = own
    found = np.zeros(len(one), bool)
    for at in range(0, len(one), 100_000):
        part = slice(at, at + 100_000)
        found[part] = (table[one[part]] == cells[part, None]).any(1)
    return found


def _product(threshold: float):
    """Links of every row of a block pair, and the row that stands for its part of the graph."""

    def multiply(rows: pd.DataFrame) -> pd.DataFrame:
        left = rows["left"].to_numpy()
        a = np.flatnonzero(left)
        same = bool(rows["same"].iloc[0])
        b = a if same else np.flatnonzero(~left)
        links = np.zeros(len(rows), np.int64)
        root = np.arange(len(rows))
        if len(a) and len(b):
            cell = int(rows["cell"].iloc[0])
            units = _matrix(rows["unit"].tolist())
            weight = rows["weight"].to_numpy()
            homes = rows["home"].to_numpy()
            others = units[b].T
            for at in range(0, len(a), STRIPE):
                own = a[at : at + STRIPE]
                pairs = np.argwhere(units[own] @ others >= threshold)
                one, other = own[pairs[:, 0]], b[pairs[:, 1]]
                if same:
                    kept = one < other
                else:
                    # The other cell finds the pair too if the home vector visits it.
                    visited = _visit(rows["visits"].iloc[own].tolist(), pairs[:, 0], homes[other])
                    kept = (homes[other] == cell) | ~visited | (homes[other] > cell)
                one, other = one[kept], other[kept]
                if len(one):
                    np.add.at(links, one, weight[other])
                    np.add.at(links, other, weight[one])
                    root = _forest(root, one, other)
        nodes = rows["node"].to_numpy()
        found = pd.DataFrame({"node": nodes, "links": links, "root": nodes[root]})
        return found[links > 0]

    return multiply


def linked(
    embeddings: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    block: int = BLOCK,
    cell: int = CELL,
) -> DataFrame:
    """Id, number of other vectors linked directly, and the smallest id reachable, for every row."""
    common.prepare(embeddings.sparkSession)
    given = embeddings.select(
        F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).alias("vector")
    )
    kinds = {name: given.schema[name].dataType.simpleString() for name in ("key", "label")}
    rows = common.stored(
        given.mapInArrow(_directions, f"key {kinds['key']}, label {kinds['label']}, unit binary"), "units"
    )
    valid = rows.filter(F.col("unit").isNotNull())
    nodes = common.stored(
        valid.groupBy("label", "unit")
        .agg(F.count(F.lit(1)).alias("weight"), F.min("key").alias("least"))
        .withColumn("width", (F.length("unit") / 8).cast("int"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    assigned = common.stored(_placed(nodes, cell, threshold), "cells")
    products = _blocks(assigned, block).groupBy("width", "cell", "label", "i", "j")
    found = common.stored(products.applyInPandas(_product(threshold), "node long, links long, root long"), "links")
    parts = graph.components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = (
        nodes.select("node", "label", "unit", "weight", "least")
        .join(counts, "node", "left")
        .join(parts, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    named = joined.groupBy("root").agg(F.min("least").alias("component"))
    known = joined.join(named, "root").select(
        "label", "unit", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"), "component"
    )
    return rows.join(known, ["label", "unit"], "left").select(
        "key",
        F.coalesce("links", F.lit(0)).cast("long").alias("links"),
        F.when(F.col("links").isNull(), F.col("key")).otherwise(F.col("component")).alias("component"),
    )


def _blocks(assigned: DataFrame, block: int) -> DataFrame:
    """Rows dealt to the block pairs of their cell: ``left`` ones are multiplied with the others."""
    at_home = F.col("cell") == F.col("home")
    group = ["width", "cell", "label"]
    sizes = assigned.groupBy(*group).agg(
        F.ceil(F.count_if(at_home) / block).cast("int").alias("homes"),
        F.ceil(F.count_if(~at_home) / block).cast("int").alias("guests"),
    )
    dealt = assigned.join(sizes, group).filter("homes > 0")
    own = F.pmod(F.xxhash64("node"), F.when(at_home, F.col("homes")).otherwise(F.col("guests"))).cast("int")
    dealt = dealt.withColumn("own", own)
    homes, guests = "sequence(0, homes - 1)", "if(guests > 0, sequence(0, guests - 1), array())"
    pair = "named_struct('i', cast({i} as int), 'j', cast({j} as int), 'left', {left}, 'same', {same})"
    as_home = (
        f"concat(transform({homes}, x -> "
        + pair.format(i="least(own, x)", j="greatest(own, x)", left="own <= x", same="own = x")
        + f"), transform({guests}, x -> "
        + pair.format(i="own", j="homes + x", left="true", same="false")
        + "))"
    )
    as_guest = f"transform({homes}, x -> " + pair.format(i="x", j="homes + own", left="false", same="false") + ")"
    places = F.when(at_home, F.expr(as_home)).otherwise(F.expr(as_guest))
    return dealt.withColumn("place", F.explode(places)).select(
        *group, "place.*", "node", "weight", "unit", "home", "visits"
    )


def kept_and_linked(embeddings: DataFrame, key: str = "vec_id", **names: object) -> DataFrame:
    """The query's columns; the representative of each component is kept."""
    found = linked(embeddings, key, **names)
    return found.select(
        F.col("key").alias(key),
        F.col("links").alias("n_links"),
        F.col("component").alias("component_id"),
        F.coalesce(F.col("key") == F.col("component"), F.lit(False)).alias("kept"),
    )
