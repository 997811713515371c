"""Removal of repeated passages by a depth-limited radix sort of suffixes.

A byte goes if a string of ``DEPTH`` bytes that covers it starts anywhere else, in the same text or
in another. Suffixes are ordered by their first ``DEPTH`` bytes only, in passes from the most
significant digit on; a suffix that is alone in its group after a pass is dropped, and what is still
equal after the last pass is exactly a repeated window.

Not every suffix is shuffled for that:

1. The first digit of a suffix is the smallest hash of ``GRAM`` bytes within its window. Equal
   windows have equal first digits, and neighbouring windows mostly share theirs, so a run of
   windows is one narrow row instead of a hundred suffixes.
2. A first digit that occurs once is unique: no window in that run repeats. Runs of equal bytes
   (64-bit digit and 64-bit digest) repeat as a whole. Only runs that share a first digit and
   differ send their bytes on, once for each kind.
3. Those are grouped by first digit and their windows sorted by the remaining digits, ``DIGIT``
   bytes each. Windows that stay equal are compared byte by byte.
4. A first digit with more than ``KINDS`` kinds of runs is not sorted in one task: its windows are
   dealt out by a 128-bit digest of their bytes and counted, combined before the shuffle.

A text that many rows share is a group of equal runs: it is counted before the shuffle and never
gathered. Null and empty texts have no bytes; texts shorter than a window lose nothing. Rows without
an id and repeated rows are rows like any other. An empty table gives an empty result; columns other
than the id and the text are not read. Texts of any length are
read whole; equal strings are counted wherever they start, so ties need no order.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettings.llm import common

DEPTH = 200
GRAM = 32
#: Longest run of windows that one row stands for.
RUN = 192
#: Bytes of a digit after the first.
DIGIT = 50
#: Kinds of runs under one first digit that one task sorts.
KINDS = 20_000
_ODD = 0x9E3779B97F4A7C15


def _mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers; distinct ones stay distinct."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return values ^ (values >> np.uint64(33))


_LETTERS = _mixed(np.arange(1, 257, dtype=np.uint64))
_cached: list[np.ndarray] = []


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    if not _cached or len(_cached[0]) <= count:
        up = np.full(2 * count + 65_536, _ODD, np.uint64)
        down = np.full(len(up), pow(_ODD, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _cached[:] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _cached[0], _cached[1]


class Grams:
    """Hashes of all strings of some lengths in a byte array, by prefix sums modulo 2**64."""

    def __init__(self, data: np.ndarray):
        size = len(data)
        self.up, down = _powers(size)
        self.sums = np.zeros(size + 1, np.uint64)
        np.cumsum(_LETTERS[data] * down[:size], out=self.sums[1:])

    def all(self, length: int) -> np.ndarray:
        count = len(self.sums) - length
        return _mixed((self.sums[length:] - self.sums[:count]) * self.up[:count])

    def at(self, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
        return _mixed((self.sums[starts + lengths] - self.sums[starts]) * self.up[starts])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, in linear time."""
    count = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def runs_of(data: bytes, depth: int = DEPTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """First digit, start, number of windows, digest, and whether the digit's bytes come twice."""
    if len(data) < depth:
        return tuple(np.zeros(0, k) for k in (np.uint64, np.int64, np.int64, np.uint64, bool))
    hashes = Grams(np.frombuffer(data, np.uint8)).all(gram)
    digits = sliding_least(hashes, depth - gram + 1)
    edges = np.flatnonzero(digits[1:] != digits[:-1]) + 1
    starts = np.concatenate(([0], edges))
    counts = np.diff(np.concatenate((starts, [len(digits)])))
    if counts.max() > RUN:
        parts = -(-counts // RUN)
        within = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        total = np.repeat(counts, parts)
        starts = np.repeat(starts, parts) + within * RUN
        counts = np.minimum(RUN, total - within * RUN)
    digits = digits[starts]
    reach = counts + depth - gram
    firsts = np.cumsum(reach) - reach
    at = np.arange(reach.sum()) - np.repeat(firsts - starts, reach)
    twice = np.add.reduceat(hashes[at] == np.repeat(digits, reach), firsts, dtype=np.int64) > 1
    digest = xxhash.xxh3_64_intdigest
    ends = (starts + counts + depth - 1).tolist()
    own = [digest(data[a:b]) for a, b in zip(starts.tolist(), ends, strict=True)]
    return digits, starts, counts, np.array(own, np.uint64), twice


def repeated_windows(
    runs: list[bytes], groups: np.ndarray, depth: int = DEPTH, digit: int = DIGIT
) -> list[np.ndarray]:
    """For each run of bytes, which of its windows occur again within the same group.

    Radix passes from the first digit to the last; groups of one are dropped after every pass. The
    survivors' bytes are compared with those of the first of their group.
    """
    sizes = np.array([len(x) for x in runs], np.int64)
    offsets = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(runs), np.uint8)
    counts = np.maximum(sizes - depth + 1, 0)
    firsts = np.cumsum(counts) - counts
    within = np.arange(counts.sum()) - np.repeat(firsts, counts)
    starts = np.repeat(offsets, counts) + within
    group = np.repeat(groups, counts).astype(np.uint64)
    found = np.zeros(len(starts), bool)
    alive = np.arange(len(starts))
    grams = Grams(data)
    for at in range(0, depth, digit):
        width = min(digit, depth - at)
        group = _mixed(group * np.uint64(_ODD) + grams.at(starts[alive] + at, width))
        order = np.argsort(group)
        ranked = group[order]
        same = np.zeros(len(ranked) + 1, bool)
        same[1:-1] = ranked[1:] == ranked[:-1]
        kept = order[same[1:] | same[:-1]]
        alive, group = alive[kept], group[kept]
        if not len(alive):
            break
    if len(alive):
        edges = np.flatnonzero(group[1:] != group[:-1]) + 1
        heads = np.concatenate(([0], edges))
        sizes = np.diff(np.concatenate((heads, [len(alive)])))
        same = _same_bytes(data, starts[alive], starts[np.repeat(alive[heads], sizes)], depth)
        whole = np.logical_and.reduceat(same, heads)
        found[alive[np.repeat(whole, sizes)]] = True
        for at in np.flatnonzero(~whole).tolist():  # different bytes under one hash
            members = alive[heads[at] : heads[at] + sizes[at]]
            found[members] = _counted_twice(data, starts[members], depth)
    return [found[a : a + n] for a, n in zip(firsts.tolist(), counts.tolist(), strict=True)]


def _same_bytes(data: np.ndarray, one: np.ndarray, other: np.ndarray, depth: int) -> np.ndarray:
    """Whether the strings of ``depth`` bytes at these places are equal, eight bytes at a time."""
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    same = np.ones(len(one), bool)
    for at in [*range(0, depth - 8, 8), depth - 8]:
        same &= words[one + at] == words[other + at]
    return same


def _counted_twice(data: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    windows = [data[s : s + depth].tobytes() for s in starts.tolist()]
    counts = Counter(windows)
    return np.array([counts[window] > 1 for window in windows])


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


def _find_runs(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        held: list[tuple] = []
        many = 0
        for file, row, text in zip(
            *(part.column(c).to_pylist() for c in ("file", "row", "text")), strict=True
        ):
            found = runs_of((text or "").encode())
            size = len(found[0])
            held.append((np.full(size, file), np.full(size, row), *found))
            many += size
            if many > 50_000:
                yield _run_batch(held)
                held, many = [], 0
        if held:
            yield _run_batch(held)


def _run_batch(held: list[tuple]) -> pa.RecordBatch:
    file, row, digits, starts, counts, digests, twice = map(np.concatenate, zip(*held, strict=True))
    columns = [
        pa.array(file.astype(np.int64)),
        pa.array(row.astype(np.int64)),
        _signed(digits),
        pa.array(starts.astype(np.int32)),
        pa.array(counts.astype(np.int32)),
        _signed(digests),
        pa.array(twice),
    ]
    names = ["file", "row", "digit", "start", "windows", "digest", "twice"]
    return pa.RecordBatch.from_arrays(columns, names)


def _cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted runs of each text."""
    for part in parts:
        for text, wanted in zip(
            part.column("text").to_pylist(), part.column("wanted").to_pylist(), strict=True
        ):
            data = (text or "").encode()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x["digit"] for x in wanted], pa.int64()),
                    pa.array([x["digest"] for x in wanted], pa.int64()),
                    pa.array(
                        [data[x["start"] : x["start"] + x["windows"] + DEPTH - 1] for x in wanted],
                        pa.binary(),
                    ),
                ],
                ["digit", "digest", "bytes"],
            )


def _stretches(flags: np.ndarray) -> list[int]:
    """Bounds of the runs of true values: start, end, start, end and so on."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return edges.tolist()


def _sort_groups(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows that repeat within a group of runs; a partition's rows come sorted by group."""
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def judged() -> pa.RecordBatch:
        groups = np.array([x[0] for x in held], np.int64).view(np.uint64)
        flags = repeated_windows([x[2] for x in held], groups)
        found = [(x[0], x[1], _stretches(f)) for x, f in zip(held, flags, strict=True) if f.any()]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([x[0] for x in found], pa.int64()),
                pa.array([x[1] for x in found], pa.int64()),
                pa.array([x[2] for x in found], pa.list_(pa.int32())),
            ],
            ["digit", "digest", "stretches"],
        )

    for part in parts:
        rows = zip(*(part.column(c).to_pylist() for c in ("digit", "digest", "bytes")), strict=True)
        for digit, digest, data in rows:
            if size > 4_000_000 and held and held[-1][0] != digit:
                yield judged()
                held, size = [], 0
            held.append((digit, digest, data))
            size += len(data)
    if held:
        yield judged()


def _deal_windows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of the runs with a 128-bit digest of its bytes."""
    for part in parts:
        for digit, digest, data in zip(
            *(part.column(c).to_pylist() for c in ("digit", "digest", "bytes")), strict=True
        ):
            count = len(data) - DEPTH + 1
            found = [xxhash.xxh3_128_digest(data[a : a + DEPTH]) for a in range(count)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([digit] * count, pa.int64()),
                    pa.array([digest] * count, pa.int64()),
                    pa.array(range(count), pa.int32()),
                    pa.array(found, pa.binary()),
                ],
                ["digit", "digest", "at", "window"],
            )


def _remove(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cover the repeated windows of each text and describe what is left."""
    names = ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
    for part in parts:
        held: list[tuple] = []
        for key, text, known in zip(
            *(part.column(c).to_pylist() for c in ("key", "text", "known")), strict=True
        ):
            data = (text or "").encode()
            covered = np.zeros(len(data) + 1, np.int64)
            for x in known or ():
                bounds = x["stretches"] if x["stretches"] is not None else [0, x["windows"]]
                for a, b in zip(bounds[::2], bounds[1::2], strict=True):
                    covered[x["start"] + a] += 1
                    covered[x["start"] + b - 1 + DEPTH] -= 1
            bounds = _stretches(np.cumsum(covered[:-1]) > 0)
            kept = hashlib.sha256()
            before = 0
            for a, b in zip(bounds[::2], bounds[1::2], strict=True):
                kept.update(data[before:a])
                before = b
            kept.update(data[before:])
            removed = sum(bounds[1::2]) - sum(bounds[::2])
            held.append((key, len(data), removed, len(bounds) // 2, kept.hexdigest(), bounds))
        if held:
            kinds = [part.schema.field("key").type, *[pa.int64()] * 3, pa.string(), pa.list_(pa.int32())]
            columns = [pa.array(x, k) for x, k in zip(zip(*held, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names)


def repeats(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Bytes, bytes removed, removed runs, digest of the rest and the runs' bounds, for every row."""
    common.prepare(documents.sparkSession)
    wanted = (F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    rows = common.placed(documents, "place", *wanted).select("place.*", "key", "text")
    runs = common.stored(
        rows.select("file", "row", "text").mapInArrow(
            _find_runs,
            "file long, row long, digit long, start int, windows int, digest long, twice boolean",
        ),
        "runs",
    )
    mixed = (F.min("digest") != F.max("digest")) | F.max("twice")
    shared = runs.groupBy("digit").agg(F.count(F.lit(1)).alias("total"), mixed.alias("mixed"))
    # Stored, so that the join with it has no other work on the digit and hot digits can be split.
    shared = common.stored(shared.filter("total > 1 or mixed").select("digit", "mixed"), "digits")
    runs = common.stored(runs.join(shared, "digit"), "shared")
    place = F.struct("file", "row", "start", "windows")
    kinds = runs.groupBy("digit", "digest", "mixed").agg(
        F.count(F.lit(1)).alias("n"), F.min(place).alias("one")
    )
    kinds = common.stored(kinds, "kinds")
    known = kinds.filter("n > 1").select(
        "digit", "digest", F.lit(None).cast("array<int>").alias("stretches")
    )
    unequal = kinds.filter("mixed")
    many = unequal.groupBy("digit").count().filter(F.col("count") > KINDS).select("digit")
    many = common.stored(many, "many")
    single = kinds.filter("mixed and n = 1").select("digit", "digest")
    known = known.unionByName(
        _bytes_of(rows, unequal.join(many, "digit", "left_anti"))
        .repartition("digit")
        .sortWithinPartitions("digit")
        .mapInArrow(_sort_groups, "digit long, digest long, stretches array<int>")
        .join(single, ["digit", "digest"], "left_semi")
    )
    if not many.isEmpty():
        windows = _bytes_of(rows, unequal.join(many, "digit", "left_semi")).mapInArrow(
            _deal_windows, "digit long, digest long, at int, window binary"
        )
        again = windows.groupBy("window").count().filter("count > 1").select("window")
        found = windows.join(again, "window").groupBy("digit", "digest")
        places = F.flatten(F.transform(F.collect_list("at"), lambda x: F.array(x, x + 1)))
        found = found.agg(places.alias("stretches"))
        known = known.unionByName(found.join(single, ["digit", "digest"], "left_semi"))
    by_row = (
        runs.select("file", "row", "digit", "digest", "start", "windows")
        .join(known, ["digit", "digest"])
        .groupBy("file", "row")
        .agg(F.collect_list(F.struct("start", "windows", "stretches")).alias("known"))
    )
    kind = rows.schema["key"].dataType.simpleString()
    return (
        rows.join(by_row, ["file", "row"], "left")
        .select("key", "text", "known")
        .mapInArrow(
            _remove,
            f"key {kind}, n_bytes long, n_removed long, n_spans long, "
            "kept_sha256 string, spans array<int>",
        )
    )


def _bytes_of(rows: DataFrame, kinds: DataFrame) -> DataFrame:
    """The bytes of one run of each kind, cut from the text in which it lies."""
    run = F.struct("digit", "digest", F.col("one.start").alias("start"), F.col("one.windows").alias("windows"))
    wanted = kinds.groupBy(F.col("one.file").alias("file"), F.col("one.row").alias("row")).agg(
        F.collect_list(run).alias("wanted")
    )
    texts = rows.select("file", "row", "text").join(wanted, ["file", "row"])
    return texts.select("text", "wanted").mapInArrow(_cut, "digit long, digest long, bytes binary")


def digest(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    found = repeats(documents, key, text)
    return found.select(F.col("key").alias(key), "n_bytes", "n_removed", "n_spans", "kept_sha256")
