"""Verdicts on addresses by lists of hosts and paths, held as cascades of Bloom filters.

A rule (host, path) fits its host and all subdomains if the address's path starts with the rule's. So an
address asks for few keys: the ends of its host with as many labels as some rule has, each with as much
of its path as some rule has. All keys that the table asks for, together with the listed ones, are the
universe. For each list a first filter holds the listed keys, the next one those other keys of the
universe that the first lets through by mistake, the next one the listed keys that the second lets
through, and so on until none is left. Membership is then exact for every key of the universe, so
addresses are judged in one scan, without a join.

The first filter's share of mistakes is chosen by the sizes of list and universe, later ones have one half,
which keeps a cascade near log2(universe / list) + 3 bits a listed key. A list is dealt to as many parts
by the keys' hashes as keep a cascade's filters below ``FILTER_BITS``; parts are built and asked one
after the other, so neither driver nor task holds more than one of them. Filters are built by Spark
as bitmap rows; the universe and the shrinking sets of mistakes are stored tables of distinct keys, so a host
with a third of all pages is one key.

Of several fitting rules the longest (host and path together) wins, of equally long ones that with the longer host,
and a key that is both blocked and allowed is blocked. An address that no rule fits is blocked if its host or a
parent of it, with a path that it starts with, is among the ``listed`` keys, and allowed otherwise. Null addresses and those without ``://`` have an
empty host and path and are allowed unless the empty key is listed. Addresses of any length ask for as
many keys as there are pairs of label count and path length in the lists. Repeated rows are judged each.
An empty table or an empty list needs no filter. Other columns are not read; A-Z is lowered in hosts only.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lettings.llm import common

#: Kinds of listed keys: rules that allow or block, and keys blocked where no rule fits.
ALLOW, BLOCK, LISTED = "allow", "block", "listed"
KINDS = (ALLOW, BLOCK, LISTED)
#: Bits of the first filter of a part (32 MB); later ones of the part are smaller.
FILTER_BITS = 1 << 28
#: Bits of one row of Spark's bitmap functions.
ROW_BITS = 32_768
#: More filters than any universe needs: each but the first halves what is left.
MOST_LEVELS = 200

Entry = tuple[str, str, str]

RULES: tuple[Entry, ...] = (
    ("net", "/", BLOCK),
    ("example.net", "/en/", ALLOW),
    ("example.com", "/de/", BLOCK),
    ("org", "/fr/", ALLOW),
)
#: Names of advertising, gambling and junk sites, blocked under each of the three domains.
JUNK = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
JUNK_HOSTS: tuple[Entry, ...] = tuple(
    (f"{name}.example.{top}", "", LISTED) for name in JUNK for top in ("com", "net", "org")
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z) and path, both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(host) + 1, F.length(url)), "^[^?#]*", 0)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


# --- one filter ----------------------------------------------------------------------------------


def _mixed(code: np.ndarray, salt: int) -> np.ndarray:
    """A further 64-bit hash of a 64-bit hash."""
    x = code.astype(np.uint64) ^ np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Shape:
    """Size and hash functions of one filter."""

    bits: int
    hashes: int
    salt: int

    def places(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The bits of each key, one column a hash function."""
        first, step = _mixed(a, self.salt), _mixed(b, self.salt) | np.uint64(1)
        turns = np.arange(self.hashes, dtype=np.uint64)
        with np.errstate(over="ignore"):
            return ((first[:, None] + turns * step[:, None]) % np.uint64(self.bits)).astype(np.int64)


@dataclass(frozen=True)
class Level:
    shape: Shape
    bitmap: np.ndarray

    def hit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        found = np.ones(len(a), bool)
        for at in range(0, len(a), 65_536):
            place = self.shape.places(a[at : at + 65_536], b[at : at + 65_536])
            found[at : at + 65_536] = (self.bitmap[place >> 3] >> (place & 7).astype(np.uint8) & 1).all(1)
        return found


def contains(levels: Sequence[Level], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Membership of keys of the universe; the first level to let go of a key decides."""
    answer = np.zeros(len(a), bool)
    left = np.arange(len(a))
    for number, level in enumerate(levels):
        hit = level.hit(a[left], b[left])
        answer[left[~hit]] = number % 2 == 1
        left = left[hit]
    answer[left] = len(levels) % 2 == 1
    return answer


def _codes(part: pa.RecordBatch, name: str) -> np.ndarray:
    return part.column(name).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _shape(count: int, mistakes: float, salt: int) -> Shape:
    bits = max(64, math.ceil(count * math.log(1 / mistakes) / math.log(2) ** 2))
    return Shape(bits, max(1, round(math.log2(1 / mistakes))), salt)


def _bitmaps(left: DataFrame, shapes: dict[str, Shape], number: int) -> dict[str, Level]:
    """The filters of one level, put together from bitmap rows of 4 kB that Spark aggregates."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, still = _codes(batch, "a"), _codes(batch, "b"), batch.column("open").to_numpy()
            for kind, shape in shapes.items():
                own = _encoded(batch, still, kind, number)
                places = shape.places(a[own], b[own]).ravel()
                kinds = pa.array(np.full(len(places), KINDS.index(kind), np.int32))
                yield pa.RecordBatch.from_arrays([kinds, pa.array(places)], ["kind", "place"])

    # Spark's bitmap functions count from 1.
    at = F.col("place") + 1
    rows = (
        left.mapInArrow(place, "kind int, place long")
        .groupBy("kind", F.bitmap_bucket_number(at).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bitmap"))
        .collect()
    )
    found = {
        kind: Level(shape, np.zeros(-(-shape.bits // ROW_BITS) * (ROW_BITS // 8), np.uint8))
        for kind, shape in shapes.items()
    }
    for row in rows:
        start = (row.bucket - 1) * (ROW_BITS // 8)
        bitmap = found[KINDS[row.kind]].bitmap
        bitmap[start : start + ROW_BITS // 8] = np.frombuffer(bytes(row.bitmap), np.uint8)
    return found


def _encoded(batch: pa.RecordBatch, still: np.ndarray, kind: str, number: int) -> np.ndarray:
    """Keys that the filter of this level holds: listed ones at even levels, other ones at odd ones."""
    listed = batch.column(kind).to_numpy(zero_copy_only=False).astype(bool)
    return ((still >> KINDS.index(kind) & 1) == 1) & (listed == (number % 2 == 0))


def _survivors(left: DataFrame, filters: dict[str, Level]) -> DataFrame:
    """Keys that pass the filters of this level, and the kinds for which they do."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, still = _codes(batch, "a"), _codes(batch, "b"), batch.column("open").to_numpy()
            after = np.zeros_like(still)
            for kind, level in filters.items():
                bit = KINDS.index(kind)
                own = np.flatnonzero(still >> bit & 1)
                after[own] |= level.hit(a[own], b[own]).astype(still.dtype) << bit
            columns = [pa.array(after) if n == "open" else batch.column(n) for n in batch.schema.names]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names).filter(pa.array(after != 0))

    return common.stored(left.mapInArrow(pick, left.schema), "survivors")


def cascades(universe: DataFrame) -> dict[str, list[Level]]:
    """Filters that tell the listed keys of each kind from all others, exactly.

    ``universe`` has distinct keys by their hashes ``a``, ``b``, and a flag for each kind. Level by level the
    kinds share three passes over what is left: counts, bitmaps, survivors.
    """
    levels: dict[str, list[Level]] = {kind: [] for kind in KINDS}
    left = universe.withColumn("open", F.lit((1 << len(KINDS)) - 1))
    for number in range(MOST_LEVELS):
        still = {kind: F.col("open").bitwiseAND(1 << i) != 0 for i, kind in enumerate(KINDS)}
        counts = left.agg(
            *[F.count_if(still[kind] & F.col(kind)).alias(kind) for kind in KINDS],
            *[F.count_if(still[kind] & ~F.col(kind)).alias(f"not_{kind}") for kind in KINDS],
        ).first()
        shapes = {}
        for kind in KINDS:
            held, others = counts[kind], counts[f"not_{kind}"]
            if number % 2:
                held, others = others, held
            if held and len(levels[kind]) == number:
                first = min(0.5, held / (math.sqrt(2) * others)) if others else 0.5
                shapes[kind] = _shape(held, 0.5 if number else first, number)
        if not shapes:
            return {kind: own for kind, own in levels.items() if own}
        filters = _bitmaps(left, shapes, number)
        for kind, level in filters.items():
            levels[kind].append(level)
        left = _survivors(left, filters)
    raise RuntimeError("a listed and another key share both hashes")


# --- addresses -----------------------------------------------------------------------------------


def _asked(shapes: Iterable[tuple[int, int]]) -> Column:
    """The keys that an address asks for, those that win first."""
    keys = []
    labels = F.length("host") - F.length(F.replace(F.col("host"), F.lit("."), F.lit(""))) + 1
    for count, width in sorted(shapes):
        end = F.substring_index(F.col("host"), ".", -count)
        fits = (labels >= count) & (F.length("path") >= width)
        entry = F.struct(
            (-F.length(end) - width).alias("order"),
            (-F.length(end)).alias("host_order"),
            F.concat(end, F.left("path", F.lit(width))).alias("key"),
        )
        keys.append(F.when(fits, entry))
    return F.transform(F.array_sort(F.array_compact(F.array(*keys))), lambda x: x["key"])


def _hash(key: Column, name: str) -> Column:
    return F.xxhash64(key, F.lit(name))


def _answered(filters: dict[str, list[Level]], part: int, parts: int):
    """Add the kinds of each asked key that belongs to this part, as bits by the order of ``KINDS``."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("kinds").flatten().to_numpy(zero_copy_only=False).astype(np.int32)
            a, b = (
                batch.column(x).flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                for x in ("a", "b")
            )
            own = np.flatnonzero(b.view(np.int64) % parts == part)
            for kind, levels in filters.items():
                found[own] |= contains(levels, a[own], b[own]).astype(np.int32) << KINDS.index(kind)
            asked = batch.column("kinds")
            sizes = asked.value_lengths().to_numpy(zero_copy_only=False)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            kinds = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found))
            columns = [kinds if name == "kinds" else batch.column(name) for name in batch.schema.names]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return answer


def entries(spark: SparkSession, rows: Iterable[Entry]) -> DataFrame:
    return spark.createDataFrame(list(rows), "host string, path string, kind string")


def judged(
    pages: DataFrame,
    rules: DataFrame,
    key: str = "page_id",
    url: str = "url",
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """Key, host, path, rule (host and path together, or null) and verdict of every page.

    ``rules`` has the columns host, path and kind, ``allow``, ``block`` or ``listed``; rows with nulls
    or other kinds list nothing.
    """
    host, path = host_and_path(F.col(url))
    given = pages.select(F.col(key).alias("page"), host.alias("host"), path.alias("path"))
    rules = rules.filter(F.col("kind").isin(*KINDS) & F.col("host").isNotNull() & F.col("path").isNotNull())
    lists = common.stored(
        rules.select(
            F.concat("host", "path").alias("key"),
            F.regexp_count("host", F.lit(r"\.")).alias("dots"),
            F.length("path").alias("width"),
            *[(F.col("kind") == kind).alias(kind) for kind in KINDS],
        ),
        "rules",
    )
    # At most labels of a host times lengths of a path.
    shapes = [(row.dots + 1, row.width) for row in lists.select("dots", "width").distinct().collect()]
    asked = _asked(shapes) if shapes else F.array().cast("array<string>")
    rows = given.withColumn("keys", asked)
    nothing = [F.lit(False).alias(kind) for kind in KINDS]
    universe = common.stored(
        rows.select(F.explode("keys").alias("key"), *nothing)
        .unionByName(lists.drop("dots", "width"))
        .groupBy("key")
        .agg(*[F.max(kind).alias(kind) for kind in KINDS])
        .select(*[_hash(F.col("key"), name).alias(name) for name in ("a", "b")], *KINDS),
        "universe",
    )
    sizes = universe.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(kind)).alias(kind) for kind in KINDS]
    ).first()
    most = max(sizes[kind] for kind in KINDS)
    width = 1.44 * max(1.0, math.log2(1.5 * sizes.n / most)) if most else 0
    parts = max(1, math.ceil(most * width / filter_bits))
    rows = rows.select(
        "*",
        F.transform("keys", lambda x: _hash(x, "a")).alias("a"),
        F.transform("keys", lambda x: _hash(x, "b")).alias("b"),
        F.transform("keys", lambda x: F.lit(0)).alias("kinds"),
    )
    for part in range(parts if most else 0):
        own = universe.filter(F.pmod(F.col("b"), F.lit(parts)) == part)
        filters = cascades(own)
        rows = rows.mapInArrow(_answered(filters, part, parts), rows.schema)
        if parts > 1:  # ends the use of this part's filters
            rows = common.stored(rows, "answers")
    bit = {kind: 1 << number for number, kind in enumerate(KINDS)}
    of_rule = bit[ALLOW] | bit[BLOCK]
    pairs = F.arrays_zip("keys", "kinds")
    first = F.filter(pairs, lambda x: x["kinds"].bitwiseAND(of_rule) != 0)
    hit = F.exists("kinds", lambda x: x.bitwiseAND(bit[LISTED]) != 0)
    fitting = F.get(first, 0)
    return rows.select(
        F.col("page").alias(key),
        "host",
        "path",
        fitting["keys"].alias("rule"),
        F.when(fitting["kinds"].bitwiseAND(bit[BLOCK]) != 0, BLOCK)
        .when(fitting.isNull() & hit, BLOCK)
        .otherwise(ALLOW)
        .alias("verdict"),
    )


def digest(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """The query's rows: the four rules, and the junk hosts where none of them fits."""
    return judged(pages, entries(pages.sparkSession, RULES + JUNK_HOSTS), key)
