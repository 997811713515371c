"""Quality scores: ridge regression on random Fourier features of document statistics.

Every text is reduced to a few statistics of its letters, words and lines, computed over the whole
text. Cosines of random projections approximate a Gaussian kernel over them. Each partition of the
labelled rows sums its part of the normal equations; the sums meet in a few tasks and the solution,
whose size is fixed, on the driver. An isotonic step, fitted on other labelled rows, turns ridge
scores into probabilities.

Labels are learnt only from rows that are not held out, from about ``FIT_ROWS`` of them at most
(chosen by hash). Only the text enters a score. A row whose document has no label, or a null one, is
not learnt from; a document with several labels counts with their mean. Without any labelled row all
scores are 0.5. Null and empty texts have statistics of zero and are scored like any other; rows
without an id count as held out; repeated rows are scored each; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettings.llm import common

FIT_ROWS = 200_000
FEATURES = 384
#: Width of the Gaussian kernel over standardised statistics.
WIDTH = 8.0
PARTS = 8
THRESHOLD = 0.3
#: Steps of the ridge score that isotonic blocks are made of.
STEP = 0.002
LOWEST, HIGHEST = -0.5, 1.5
_MARKS = b"!?.,:;|#$%&*<>{}=/_-\"'()@"

NAMES = (
    "log_bytes", "log_words", "word_length", "word_spread", "upper", "digits", "beyond_ascii",
    "marks", "exclaimed", "bars", "symbols", "stops", "commas", "entropy", "distinct_words",
    "top_word", "echoed", "distinct_pairs", "line_length", "distinct_lines", "compressed",
    "capitalised", "long_words", "marked_words",
)


def statistics(text: str) -> list[float]:
    data = text.encode()
    size = len(data)
    if not size:
        return [0.0] * len(NAMES)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = text.split()
    many = max(len(words), 1)
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    shares = counts[counts > 0] / size
    marks = sum(int(counts[b]) for b in _MARKS)
    lines = [line for line in text.split("\n") if line.strip()]
    upper, lower = int(counts[65:91].sum()), int(counts[97:123].sum())
    top = Counter(words).most_common(1)[0][1] if words else 0
    pairs = list(zip(words, words[1:], strict=False))
    echoed = sum(a == b for a, b in pairs)
    return [
        math.log1p(size),
        math.log1p(len(words)),
        float(min(lengths.mean(), 40)),
        float(min(lengths.std(), 40)),
        upper / max(upper + lower, 1),
        int(counts[48:58].sum()) / size,
        int(counts[128:].sum()) / size,
        marks / size,
        int(counts[33]) / many,
        int(counts[124]) / many,
        sum(int(counts[b]) for b in b"#$%&*<>{}=/_@") / many,
        int(counts[46]) / many,
        int(counts[44]) / many,
        float(-(shares * np.log2(shares)).sum()),
        len(set(words)) / many,
        top / many,
        echoed / many,
        len(set(pairs)) / max(len(pairs), 1),
        math.log1p(size / max(len(lines), 1)),
        len(set(lines)) / max(len(lines), 1),
        len(zlib.compress(data, 1)) / (size + 32),
        sum(w[0].isupper() for w in words) / many,
        float((lengths > 12).mean()),
        sum(not w[-1].isalnum() for w in words) / many,
    ]


@dataclass
class Model:
    """What scoring needs; its size does not depend on the data."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    edges: np.ndarray
    values: np.ndarray

    def raw(self, table: np.ndarray) -> np.ndarray:
        return spread(table, self.mean, self.scale) @ self.weights

    def scores(self, table: np.ndarray) -> np.ndarray:
        raw = self.raw(table)
        # A sliver of the raw score keeps the order within a block of equal probability.
        order = (np.clip(raw, LOWEST, HIGHEST) - LOWEST) / (HIGHEST - LOWEST)
        return 0.995 * np.interp(raw, self.edges, self.values) + 0.005 * order


def _projection(count: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(11)
    directions = random.normal(0, 1 / WIDTH, (count, FEATURES))
    return directions, random.uniform(0, 2 * math.pi, FEATURES)


def spread(table: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features of standardised statistics, and a constant."""
    standard = np.clip((table - mean) / scale, -6, 6)
    directions, shifts = _projection(table.shape[1])
    waves = np.cos(standard @ directions + shifts) * math.sqrt(2 / FEATURES)
    return np.hstack([waves, np.ones((len(table), 1))])


def measured(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the statistics of every row's whole text, stored once."""
    rows = documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def measure(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [statistics(x) for x in common.texts(part)]
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), pa.array(found, pa.list_(pa.float64()))], ["key", "stats"]
            )

    kind = rows.schema["key"].dataType.simpleString()
    return common.stored(rows.mapInArrow(measure, f"key {kind}, stats array<double>"), "statistics")


def _matrix(column: pa.Array | pd.Series) -> np.ndarray:
    return np.array(column.to_pylist() if isinstance(column, pa.Array) else column.tolist(), np.float64)


def pool(counts: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Isotonic means by pooling adjacent violators."""
    blocks: list[list[float]] = []
    for n, s in zip(counts.tolist(), sums.tolist(), strict=True):
        blocks.append([n, s, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            n, s, k = blocks.pop()
            blocks[-1] = [blocks[-1][0] + n, blocks[-1][1] + s, blocks[-1][2] + k]
    return np.concatenate([np.full(int(k), s / n) for n, s, k in blocks]) if blocks else np.zeros(0)


def fit(stats: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Fit on labelled rows that are not held out; ``labels`` has ``doc_id`` and ``quality``."""
    marks = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").alias("key"))
        .agg(F.avg(F.col("quality").cast("double")).alias("y"))
    )
    learnt = stats.filter(F.col("key").isNotNull() & ~common.held_out(F.col("key"))).join(marks, "key")
    share = common.share_of(marks.count(), fit_rows)
    learnt = learnt.filter(common.in_sample(F.col("key"), share, "quality"))
    part = F.pmod(F.xxhash64("key", F.lit("part")), F.lit(10))
    learnt = common.stored(learnt.select("stats", "y", part.alias("part")), "labelled")
    size = len(NAMES)
    moments = [f(F.col("stats")[i]).alias(f"{n}{i}") for i in range(size) for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    found = learnt.agg(F.count(F.lit(1)).alias("n"), *moments).first()
    if not found["n"]:
        flat = np.array([0.5, 0.5])
        return Model(np.zeros(size), np.ones(size), np.zeros(FEATURES + 1), np.array([0.0, 1.0]), flat)
    mean = np.array([found[f"m{i}"] for i in range(size)])
    scale = np.maximum(np.array([found[f"s{i}"] for i in range(size)]), 1e-9)
    weights = _solve(learnt, mean, scale)
    edges, values = _calibrate(learnt, mean, scale, weights)
    return Model(mean, scale, weights, edges, values)


def _solve(learnt: DataFrame, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Ridge weights from normal equations that partitions sum up."""
    width = FEATURES + 1

    def partly(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, sums, rows = np.zeros((width, width)), np.zeros(width), 0
        for part in parts:
            if part.num_rows:
                table = spread(_matrix(part.column("stats")), mean, scale)
                products += table.T @ table
                sums += table.T @ part.column("y").to_numpy()
                rows += len(table)
        if rows:
            whole = np.concatenate([products.ravel(), sums, [rows]]).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([whole], pa.binary())], ["sums"])

    # Eight of ten hash parts; the others calibrate. Few partitions, so few partial sums.
    used = learnt.filter("part < 8").repartition(PARTS)
    total = np.zeros(width * width + width + 1)
    for row in used.mapInArrow(partly, "sums binary").toLocalIterator():
        total += np.frombuffer(bytes(row["sums"]))
    rows = max(total[-1], 1.0)
    ridge = np.eye(width) * max(0.02, 2e-5 * rows)
    ridge[-1, -1] = 1e-9
    return np.linalg.solve(total[: width * width].reshape(width, width) + ridge, total[width * width : -1])


def _calibrate(
    learnt: DataFrame, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic steps over the rows left out of the ridge fit, gathered as counts per score step."""

    def step(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                raw = spread(_matrix(part.column("stats")), mean, scale) @ weights
                steps = np.floor(np.clip(raw, LOWEST, HIGHEST) / STEP).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(steps), part.column("y")], ["step", "y"])

    scored = learnt.filter("part >= 8").mapInArrow(step, "step long, y double")
    rows = scored.groupBy("step").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y")).collect()
    rows = sorted((x["step"], x["n"], x["y"]) for x in rows)
    if not rows:
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    steps, counts, sums = (np.array(x, np.float64) for x in zip(*rows, strict=True))
    values = pool(counts, sums)
    values = np.clip((values * counts.sum() + 0.5) / (counts.sum() + 1), 0, 1)
    return (steps + 0.5) * STEP, values


def scored(
    documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key``, whether it is held out, score and prediction of every row."""
    common.prepare(documents.sparkSession)
    stats = measured(documents, key, text)
    model = fit(stats, labels)
    kind = stats.schema["key"].dataType.simpleString()
    found = stats.mapInArrow(_scoring(model), f"key {kind}, score double")
    return found.select(
        F.col("key").alias(key),
        common.held_out(F.col("key")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def _scoring(model: Model):
    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                found = model.scores(_matrix(part.column("stats")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(np.clip(found, 0, 1))], ["key", "score"]
                )

    return score


def accepted(
    documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """All columns of the documents whose score reaches the threshold."""
    common.prepare(documents.sparkSession)
    rows, number = common.numbered(documents)
    both = F.struct(F.col(key).alias("id"), F.col(number).alias("row"))
    stats = measured(rows.select(both.alias("both"), F.col(text).alias("text")), "both")
    model = fit(stats.select(F.col("key.id").alias("key"), "stats"), labels)
    scores = stats.select(F.col("key.row").alias("key"), "stats").mapInArrow(
        _scoring(model), f"key {rows.schema[number].dataType.simpleString()}, score double"
    )
    rejected = scores.filter(F.col("score") < THRESHOLD)
    return common.without(rows, number, rejected.select(F.col("key").alias(number)))
