"""Language identification: averaged embeddings of hashed subwords and a linear softmax.

A text is lower-cased, everything but letters becomes a blank, and the two to four byte strings
that do not run over a blank are its subwords. Their embeddings, found by hash, are averaged over
the whole text and a linear softmax gives the languages. Both are trained by stochastic gradient
descent in numpy on a bounded sample: about ``PER_LANGUAGE`` rows of each language, and of all
languages together about ``SAMPLE_ROWS``, chosen by hash among those that are not held out. Every language
with such a row is learnt, however many there are. Of a learnt text's subwords, counted over the whole
text, the ``SUBWORDS`` most frequent kinds take part (of equally frequent ones those of lower number), so the driver holds
``SAMPLE_ROWS * SUBWORDS`` pairs of eight bytes at most (where there are over 800 languages, ``LEAST_STEPS`` rows of each). A temperature fitted on a fifth of each language's rows that is left out of the descent (none of
less than five) calibrates the scores, and the score that all but ``REJECTED`` of the right answers there exceed is the bound
below which a text is marked as rejected.

For scoring, up to ``DIMENSIONS`` languages have the product of embeddings and softmax weights as one
table; more are scored from the averaged embeddings, so the table is never wider than those. Text
that is null or has no letter is ``und`` with score 0. Rows without a language are not learnt from;
without any row to learn from every text is ``und``. Rows without an id count as held out, repeated
rows are answered each, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettings.llm import common

PER_LANGUAGE = 350
#: Rows of the sample in all languages together, and kinds of subwords of each of them.
SAMPLE_ROWS, SUBWORDS = 20_000, 4096
BITS = 15
LENGTHS = (2, 3, 4)
DIMENSIONS = 12
EPOCHS = 8
#: Steps of each language in an epoch at least.
LEAST_STEPS = 24
RATE = 1.0
REJECTED = 0.01
UNKNOWN = "und"
#: ASCII letters and all bytes beyond ASCII stay, the rest is blank.
_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_BUCKETS = len(LENGTHS) << BITS
#: Bytes of text that are looked up at once.
_BLOCK = 1_000_000


def subwords(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text number of every subword."""
    parts = [b"  " + x.lower().encode().translate(_LETTERS) + b"   " for x in texts]
    data = np.frombuffer(b"".join(parts), np.uint8)
    owner = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
    blank = data == 32
    buckets, owners = [], []
    value = data.astype(np.uint64)
    inner = np.zeros(len(data), bool)
    for order, length in enumerate(LENGTHS):
        # A blank may only be the first or the last byte.
        size = len(data) - length + 1
        if size <= 0:
            continue
        value = np.zeros(size, np.uint64)
        inner = np.zeros(size, bool)
        for at in range(length):
            value = (value << np.uint64(8)) | data[at : at + size]
            if 0 < at < length - 1:
                inner |= blank[at : at + size]
        if length == 2:
            inner = blank[:size] & blank[1 : size + 1]
        hashed = (value * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - BITS)
        kept = np.flatnonzero(~inner)
        buckets.append(hashed[kept].astype(np.int32) + (order << BITS))
        owners.append(owner[kept])
    if not buckets:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    return np.concatenate(buckets), np.concatenate(owners)


def shares_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent kinds of subwords of a whole text, in order, and their shares of it."""
    buckets, counts = np.unique(subwords([text])[0], return_counts=True)
    shares = counts / max(counts.sum(), 1)
    if len(buckets) > SUBWORDS:
        often = np.sort(np.argsort(-counts, kind="stable")[:SUBWORDS])
        buckets, shares = buckets[often], shares[often]
    return buckets, shares


def rows_of_each(languages: int) -> int:
    """Sampled rows of a language when there are so many languages; enough that none is missed."""
    return max(LEAST_STEPS, min(PER_LANGUAGE, SAMPLE_ROWS // max(languages, 1)))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


@dataclass
class Model:
    """One row per bucket, ready to be averaged: logits, or embeddings if ``weights`` turn them into logits."""

    languages: list[str]
    table: np.ndarray
    weights: np.ndarray | None
    bias: np.ndarray
    temperature: float
    least: float

    def logits(self, texts: list[str]) -> np.ndarray:
        total = np.zeros((len(texts), self.table.shape[1]))
        first = 0
        while first < len(texts):
            last, size = first, 0
            while last < len(texts) and (last == first or size + len(texts[last]) < _BLOCK):
                size += len(texts[last])
                last += 1
            buckets, owners = subwords(texts[first:last])
            for column in range(self.table.shape[1]):
                total[first:last, column] = np.bincount(owners, self.table[buckets, column], last - first)
            counts = np.maximum(np.bincount(owners, minlength=last - first), 1)
            total[first:last] /= counts[:, None]
            first = last
        return (total if self.weights is None else total @ self.weights) + self.bias

    def probabilities(self, texts: list[str]) -> np.ndarray:
        return softmax(self.logits(texts) / self.temperature)


def softmax(logits: np.ndarray) -> np.ndarray:
    shifted = np.exp(logits - logits.max(-1, keepdims=True))
    return shifted / shifted.sum(-1, keepdims=True)


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], languages: list[str]) -> Model:
    """``rows``: language, distinct buckets and their shares of the text, in a fixed order."""
    random = np.random.default_rng(3)
    number = {language: at for at, language in enumerate(languages)}
    order = random.permutation(len(rows))
    # A fifth of each language is left out of the descent: of less than five rows none.
    spare = {language: n // 5 for language, n in Counter(x[0] for x in rows).items()}
    aside = set()
    for i in order.tolist():
        if spare[rows[i][0]]:
            spare[rows[i][0]] -= 1
            aside.add(i)
    learnt = [rows[i] for i in order.tolist() if i not in aside]
    # Rows of rare languages take part several times, or the steps against them outweigh their own.
    often = Counter(x[0] for x in learnt)
    learnt = [x for x in learnt for _ in range(-(-LEAST_STEPS // often[x[0]]))]
    checked = [rows[i] for i in sorted(aside)] or rows
    embeddings = random.normal(0, 0.1, (_BUCKETS, DIMENSIONS))
    weights = random.normal(0, 0.1, (DIMENSIONS, len(languages)))
    bias = np.zeros(len(languages))
    steps, step = EPOCHS * len(learnt), 0
    for _ in range(EPOCHS):
        for at in random.permutation(len(learnt)).tolist():
            language, buckets, shares = learnt[at]
            rate = RATE * (1 - step / steps)
            step += 1
            mean = shares @ embeddings[buckets]
            error = softmax(mean @ weights + bias)
            error[number[language]] -= 1
            back = weights @ error
            weights -= rate * np.outer(mean, error)
            bias -= 0.1 * rate * error
            # Shares of single subwords are small; their steps are scaled up by a fixed factor.
            embeddings[buckets] -= (rate * 20 * shares)[:, None] * back
    if len(languages) <= DIMENSIONS:
        table, weights = embeddings @ weights, None
    else:
        table = embeddings
    logits = np.array([shares @ table[buckets] for _, buckets, shares in checked])
    logits = (logits if weights is None else logits @ weights) + bias
    right = np.array([number[language] for language, _, _ in checked])
    temperature, least = calibrate(logits, right)
    return Model(languages, table.astype(np.float32), weights, bias, temperature, least)


def calibrate(logits: np.ndarray, right: np.ndarray) -> tuple[float, float]:
    """The temperature of the least loss, and the score that nearly all right answers exceed."""
    best = (np.inf, 1.0)
    for temperature in np.geomspace(0.25, 8, 41).tolist():
        chances = softmax(logits / temperature)[np.arange(len(right)), right]
        best = min(best, (float(-np.log(np.maximum(chances, 1e-12)).mean()), temperature))
    found = softmax(logits / best[1])
    correct = found.max(1)[found.argmax(1) == right]
    return best[1], float(np.quantile(correct, REJECTED)) if len(correct) else 0.0


def fit(
    documents: DataFrame, key: str = "doc_id", text: str = "text", language: str = "lang"
) -> Model | None:
    """Train on a bounded sample; none if there is nothing to learn from."""
    known = documents.select(
        F.col(key).alias("key"), F.col(text).cast("string").alias("text"), F.col(language).alias("language")
    ).filter(F.col("key").isNotNull() & F.col("language").isNotNull() & F.col("text").isNotNull())
    known = known.filter(~common.held_out(F.col("key")))
    # One row a language. Those of few rows are taken whole; each frequent one has a share of its own.
    counts = known.groupBy("language").agg(F.count(F.lit(1)).alias("n")).collect()
    each = rows_of_each(len(counts))
    chosen = F.lit(True)
    frequent = [x for x in counts if x["n"] > each]
    if frequent:
        pairs = [(F.lit(x["language"]), F.lit(common.share_of(x["n"], each))) for x in frequent]
        own = F.create_map(*[x for pair in pairs for x in pair])[F.col("language")]
        chosen = common.in_sample(F.col("key"), F.coalesce(own, F.lit(1.0)), "language")

    def measure(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = []
            for name, whole in zip(
                part.column("language").to_pylist(), part.column("text").to_pylist(), strict=True
            ):
                buckets, shares = shares_of(whole)
                if len(buckets) and has_letter(whole):
                    found.append((name, buckets.tolist(), shares.tolist()))
            if found:
                kinds = [pa.string(), pa.list_(pa.int32()), pa.list_(pa.float32())]
                columns = [pa.array(x, k) for x, k in zip(zip(*found, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["language", "buckets", "shares"])

    sample = known.filter(chosen).select("language", "text").mapInArrow(
        measure, "language string, buckets array<int>, shares array<float>"
    )
    rows = [
        (x["language"], np.array(x["buckets"], np.int32), np.array(x["shares"], np.float32))
        for x in sample.toLocalIterator()
    ]
    rows.sort(key=lambda x: (x[0], len(x[1]), x[1].tobytes(), x[2].tobytes()))
    languages = sorted({x[0] for x in rows})
    return train(rows, languages) if rows else None


def identified(
    documents: DataFrame, key: str = "doc_id", text: str = "text", language: str = "lang"
) -> DataFrame:
    """``key``, whether it is held out, language, score and rejection of every row."""
    common.prepare(documents.sparkSession)
    model = fit(documents, key, text, language)
    rows = documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def answer(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            whole = common.texts(part)
            names, scores, rejected = [], [], []
            chances = model.probabilities(whole) if model and whole else None
            for at, own in enumerate(whole):
                if chances is None or not has_letter(own):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    rejected.append(True)
                else:
                    best = int(chances[at].argmax())
                    names.append(model.languages[best])
                    scores.append(float(chances[at, best]))
                    rejected.append(scores[-1] < model.least)
            columns = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), *columns], ["key", "lang_pred", "score", "rejected"]
            )

    kind = rows.schema["key"].dataType.simpleString()
    found = rows.mapInArrow(answer, f"key {kind}, lang_pred string, score double, rejected boolean")
    return found.select(
        F.col("key").alias(key),
        common.held_out(F.col("key")).alias("held_out"),
        "lang_pred",
        "score",
        "rejected",
    )
