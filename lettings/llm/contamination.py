"""Benchmark passages in documents, found with a distributed positional inverted index.

The documents are indexed in segments, one row per run of documents in a task: the segment's terms,
how many postings each has, and the postings' positions, sorted by term. The index is written once
and serves any test set. Test items are cut into windows of thirteen words (shorter items are one
window). For each segment, the postings of a window's rarest term give candidate starts; the other
terms' lists, shifted by their offsets, are intersected with them from the rarest on. Rarity is
counted over all documents. What is left are exact phrase matches; proximity matches ask for a
window's rarest terms within a span instead, in any order.

The test set is a stated query set that is held against all segments in blocks of bounded size.
What a block finds is written at once, one row for each document with a match, and the block is let go; a
larger test set takes more passes over the index, never a larger broadcast or a longer plan. Found rows
are added up by document and joined with the index's list of documents once.

Null, empty and wordless texts have no words and no hits. Items without words have no window; items
with the same id are one item, and items without an id are one item named ``null``. Empty tables
give no hits or no rows. Repeated documents are judged each for itself. Other columns are not read. Texts of any length are
indexed whole; a segment ends with the text that fills it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettings.llm import common

WINDOW = 13
#: Words of test items in one block.
BLOCK_WORDS = 200_000
#: Bytes of text in one segment.
SEGMENT = 2_000_000
CANDIDATES = 1_000_000
#: A proximity match has so many of a window's rarest terms within so many words; shorter windows have all of theirs.
NEAR_TERMS = 4
NEAR_SPAN = 39
#: Letters of words stay (A-Z as a-z), digits and all beyond ASCII as well; the rest are gaps.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
FOUND = "row long, stretches array<int>, items array<string>, near array<string>"
_INDEX = (
    "row array<long>, first array<int>, n_words array<int>, terms binary, counts binary, postings binary"
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORD_BYTES).split()


class _Numbered(dict):
    """Numbers words in the order of their coming."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _segment(rows: list, texts: list[list[bytes]]) -> tuple:
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    numbered = _Numbered()
    look_up = numbered.__getitem__
    terms = np.fromiter((look_up(w) for text in texts for w in text), np.int32, int(sizes.sum()))
    # Documents lie a place apart, so that no phrase runs over the gap.
    ends = np.cumsum(sizes + 1)
    first = ends - sizes - 1
    places = np.arange(len(terms)) + np.repeat(np.arange(len(texts)), sizes)
    order = np.argsort(terms, kind="stable")
    counts = np.bincount(terms, minlength=len(numbered))
    return (
        rows,
        first.tolist(),
        sizes.tolist(),
        b" ".join(numbered),
        counts.astype("<i4").tobytes(),
        places[order].astype("<i4").tobytes(),
    )


def _segments(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    numbers = common.row_numbers()
    kinds = [pa.list_(pa.int64()), *[pa.list_(pa.int32())] * 2, *[pa.binary()] * 3]
    names = ["row", "first", "n_words", "terms", "counts", "postings"]

    def batch(rows: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        columns = [pa.array([x], k) for x, k in zip(_segment(rows, texts), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([keys_of(rows), *columns], ["keys", *names])

    def keys_of(rows: list) -> pa.Array:
        return pa.array([[held[r] for r in rows]], pa.list_(key_kind))

    rows, texts, size, held = [], [], 0, {}
    key_kind = pa.int64()
    for part in parts:
        key_kind = part.schema.field("key").type
        for key, text in zip(part.column("key").to_pylist(), part.column("text").to_pylist(), strict=True):
            number = next(numbers)
            held[number] = key
            rows.append(number)
            texts.append(words_of(text))
            size += len(text or "")
            if size >= SEGMENT:
                yield batch(rows, texts)
                rows, texts, size, held = [], [], 0, {}
    if rows:
        yield batch(rows, texts)


def index(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored index: one row per segment."""
    rows = documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return common.stored(rows.mapInArrow(_segments, f"keys array<{kind}>, {_INDEX}"), "index")


def _chunks(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Test items in chunks that overlap by a window less a word: no window is lost or made."""
    step = BLOCK_WORDS // 4
    for part in parts:
        held = []
        for item, text in zip(part.column("item").to_pylist(), part.column("text").to_pylist(), strict=True):
            words = words_of(text)
            for at in range(0, max(1, len(words) - WINDOW + 1), step):
                own = words[at : at + step + WINDOW - 1]
                if own:
                    held.append(("null" if item is None else item, b" ".join(own), len(own)))
        if held:
            item, text, size = zip(*held, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.string()), pa.array(text, pa.binary()), pa.array(size, pa.int64())],
                ["item", "words", "size"],
            )


class Windows:
    """The distinct windows of a block of test items, and their terms by rarity."""

    def __init__(self, chunks: list[tuple[str, bytes]]):
        found: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in chunks:
            words = text.split()
            for at in range(max(1, len(words) - WINDOW + 1)):
                found.setdefault(tuple(words[at : at + WINDOW]), set()).add(item)
        self.terms = sorted({word for window in found for word in window})
        number = {term: at for at, term in enumerate(self.terms)}
        self.classes: list[tuple[int, np.ndarray, np.ndarray, list[list[str]]]] = []
        for width in sorted({len(window) for window in found}):
            windows = [window for window in found if len(window) == width]
            table = np.array([[number[w] for w in window] for window in windows], np.int32)
            items = [sorted(found[window]) for window in windows]
            offsets = np.tile(np.arange(width, dtype=np.int32), (len(windows), 1))
            self.classes.append((width, table, offsets, items))

    def order(self, frequency: dict[bytes, int]) -> None:
        """Put the columns of every window from the rarest term to the most frequent."""
        counts = np.array([frequency.get(term, 0) for term in self.terms], np.int64)
        ordered = []
        for width, table, offsets, items in self.classes:
            by = np.argsort(counts[table], axis=1, kind="stable")
            ordered.append(
                (width, np.take_along_axis(table, by, 1), np.take_along_axis(offsets, by, 1), items)
            )
        self.classes = ordered


class Segment:
    """Posting lists of one segment for the terms of a block."""

    def __init__(self, row: dict, terms: list[bytes]):
        own = {term: at for at, term in enumerate(row["terms"].split(b" "))}
        self.local = np.array([own.get(term, -1) for term in terms], np.int64)
        self.counts = np.frombuffer(row["counts"], "<i4").astype(np.int64)
        self.starts = np.cumsum(self.counts) - self.counts
        self.postings = np.frombuffer(row["postings"], "<i4").astype(np.int64)
        self.first = np.array(row["first"], np.int64)
        self.sizes = np.array(row["n_words"], np.int64)
        self.span = int(self.first[-1] + self.sizes[-1] + 1) if len(self.first) else 1
        owner = np.repeat(np.arange(len(self.counts)), self.counts)
        self.places = owner * self.span + self.postings

    def has(self, terms: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Whether these terms' lists hold these places."""
        inside = (places >= 0) & (places < self.span)
        wanted = terms * self.span + np.where(inside, places, 0)
        at = np.minimum(np.searchsorted(self.places, wanted), len(self.places) - 1)
        return inside & (self.places[at] == wanted)

    def document(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, places, side="right") - 1

    def candidates(self, table: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Windows and starts by the postings of the rarest term, in blocks of bounded size."""
        rarest = table[:, 0]
        sizes = self.counts[rarest]
        for low in range(0, int(sizes.sum()), CANDIDATES):
            numbers = np.arange(low, min(low + CANDIDATES, int(sizes.sum())))
            ends = np.cumsum(sizes)
            window = np.searchsorted(ends, numbers, side="right")
            within = numbers - (ends - sizes)[window]
            yield window, self.postings[self.starts[rarest[window]] + within] - offsets[window, 0]

    def phrases(self, table: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window and start of every exact match."""
        local = self.local[table]
        alive = np.flatnonzero((local >= 0).all(axis=1))
        local, offsets = local[alive], offsets[alive]
        windows, starts = [], []
        for window, start in self.candidates(local, offsets) if len(alive) else ():
            for column in range(1, local.shape[1]):
                kept = self.has(local[window, column], start + offsets[window, column])
                window, start = window[kept], start[kept]
                if not len(start):
                    break
            windows.append(alive[window])
            starts.append(start)
        if not windows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(windows), np.concatenate(starts)

    def near(self, table: np.ndarray, terms: int, span: int) -> tuple[np.ndarray, np.ndarray]:
        """Window and document where the rarest terms lie within ``span`` words all told, in any order."""
        local = self.local[table[:, :terms]]
        alive = np.flatnonzero((local >= 0).all(axis=1))
        local = local[alive]
        pairs = []
        none = np.zeros((len(alive), 1), np.int64)
        for window, place in self.candidates(local, none) if len(alive) else ():
            document = self.document(place)
            low = np.maximum(place - span + 1, self.first[document])
            high = np.minimum(place + span, self.first[document] + self.sizes[document]) - 1
            for column in range(1, local.shape[1]):
                term = local[window, column] * self.span
                at = np.minimum(np.searchsorted(self.places, term + low), len(self.places) - 1)
                kept = (self.places[at] >= term + low) & (self.places[at] <= term + high)
                window, place, low, high = window[kept], place[kept], low[kept], high[kept]
                if not len(window):
                    break
            # Each term lies around the rarest one; now a stretch of ``span`` words has to hold them all.
            for back in range(span):
                if not len(window):
                    break
                start = place - back
                within = start >= low
                for column in range(1, local.shape[1]):
                    term = local[window, column] * self.span
                    at = np.minimum(np.searchsorted(self.places, term + start), len(self.places) - 1)
                    last = term + np.minimum(start + span - 1, high)
                    within &= (self.places[at] >= term + start) & (self.places[at] <= last)
                pairs.append(np.stack([alive[window[within]], self.document(place[within])], 1))
                kept = ~within
                window, place, low, high = window[kept], place[kept], low[kept], high[kept]
        if not pairs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        both = np.unique(np.concatenate(pairs), axis=0)
        return both[:, 0], both[:, 1]


def _frequencies(segments: DataFrame, windows: Windows) -> dict[bytes, int]:
    """How often each term of a block occurs in all documents; a block has few terms."""
    terms = windows.terms

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(terms) + 1, np.int64)
        for part in parts:
            for own, counts in zip(part.column("terms").to_pylist(), part.column("counts").to_pylist(), strict=True):
                known = dict(zip(own.split(b" "), np.frombuffer(counts, "<i4").tolist(), strict=False))
                total[:-1] += np.array([known.get(term, 0) for term in terms], np.int64)
        at = np.flatnonzero(total)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["term", "n"])

    counted = segments.select("terms", "counts").mapInArrow(count, "term long, n long")
    return {terms[x["term"]]: x["n"] for x in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}


def _search(segments: DataFrame, windows: Windows, proximity: bool) -> DataFrame:
    """Per document with any: hit stretches of words, items with phrase matches, items near."""

    def search(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            kinds = [pa.int64(), pa.list_(pa.int32()), *[pa.list_(pa.string())] * 2]
            for row in part.to_pylist():
                found = _matches(Segment(row, windows.terms), windows, proximity)
                hit = [at for at, (x, _, z) in enumerate(zip(*found, strict=True)) if x or z]
                columns = [[x[at] for at in hit] for x in (row["row"], *found)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)],
                    ["row", "stretches", "items", "near"],
                )

    return segments.mapInArrow(search, FOUND)


def _matches(segment: Segment, windows: Windows, proximity: bool) -> tuple[list, list, list]:
    count = len(segment.first)
    items: list[set] = [set() for _ in range(count)]
    near: list[set] = [set() for _ in range(count)]
    covered = np.zeros(segment.span + 1, np.int64)
    for width, table, offsets, names in windows.classes:
        window, start = segment.phrases(table, offsets)
        np.add.at(covered, start, 1)
        np.add.at(covered, start + width, -1)
        for w, d in {*zip(window.tolist(), segment.document(start).tolist(), strict=True)}:
            items[d].update(names[w])
        if proximity:
            window, document = segment.near(table, NEAR_TERMS, NEAR_SPAN)
            for w, d in zip(window.tolist(), document.tolist(), strict=True):
                near[d].update(names[w])
    flags = np.concatenate(([0], (np.cumsum(covered[:-1]) > 0).astype(np.int8), [0]))
    edges = np.flatnonzero(np.diff(flags))
    stretches: list[list[int]] = [[] for _ in range(count)]
    documents = segment.document(edges[::2]) if len(edges) else []
    for d, a, b in zip(documents, edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        # Matches never reach the gap after a document, so a stretch lies in one.
        stretches[d] += [a - int(segment.first[d]), b - int(segment.first[d])]
    return stretches, [sorted(x) for x in items], [sorted(x) for x in near]


def _blocks(benchmark: DataFrame, key: str, text: str) -> Iterator[Windows]:
    rows = benchmark.select(F.col(key).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    # Copies add no window, and all of them would come to one block.
    chunks = rows.mapInArrow(_chunks, "item string, words binary, size long").distinct()
    chunks = common.stored(chunks, "items")
    total = chunks.agg(F.sum("size")).first()[0] or 0
    parts = max(1, -(-2 * total // BLOCK_WORDS))
    part = F.pmod(F.xxhash64("item", "words"), F.lit(parts))
    for number in range(parts):
        own = chunks.filter(part == number).select("item", "words").collect()
        if own:
            yield Windows([(x["item"], bytes(x["words"])) for x in own])


def _found(
    segments: DataFrame, benchmark: DataFrame, item_key: str, item_text: str, proximity: bool
) -> DataFrame:
    """One row for each document with a match, over all blocks."""
    spark = segments.sparkSession
    path = common.work_folder(spark, "found")
    some = False
    for windows in _blocks(benchmark, item_key, item_text):
        windows.order(_frequencies(segments, windows))
        _search(segments, windows, proximity).write.mode("append").parquet(path)
        some = True
    if not some:
        return spark.createDataFrame([], FOUND)
    both = {x: F.flatten(F.collect_list(x)).alias(x) for x in ("stretches", "items", "near")}
    once = spark.read.schema(FOUND).parquet(path).groupBy("row").agg(*both.values())
    return once.select(
        "row", "stretches", F.array_distinct("items").alias("items"), F.array_distinct("near").alias("near")
    )


def _listed(segments: DataFrame) -> DataFrame:
    """Key, number and words of every document in the index."""
    rows = segments.select(F.explode(F.arrays_zip("keys", "row", "n_words")).alias("d"))
    return rows.select(
        F.col("d.keys").alias("key"), F.col("d.row").alias("row"), F.col("d.n_words").cast("long").alias("n_words")
    )


def matches(
    documents: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    proximity: bool = True,
) -> DataFrame:
    """For every document: words, hit stretches (start and end by turns), items matched and near.

    Near items (``proximity``) have a window whose rarest terms lie around a place in any order.
    """
    common.prepare(documents.sparkSession)
    segments = index(documents, key, text)
    found = _found(segments, benchmark, item_key, item_text, proximity)
    none = {"stretches": "array<int>", "items": "array<string>", "near": "array<string>"}
    return _listed(segments).join(found, "row", "left").select(
        "key", "row", "n_words", *[F.coalesce(x, F.array().cast(kind)).alias(x) for x, kind in none.items()]
    )


def _described(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and digests; stretches of several blocks may overlap."""
    for part in parts:
        hits, digests, counts, near_counts, near_digests = [], [], [], [], []
        for stretches, items, near in zip(
            *[part.column(x).to_pylist() for x in ("stretches", "items", "near")], strict=True
        ):
            total, reached = 0, 0
            for a, b in sorted(zip(stretches[::2], stretches[1::2], strict=True)):
                total += max(0, b - max(a, reached))
                reached = max(reached, b)
            hits.append(total)
            counts.append(len(items))
            digests.append(hashlib.sha256(",".join(sorted(items)).encode()).hexdigest())
            near_counts.append(len(near))
            near_digests.append(hashlib.sha256(",".join(sorted(near)).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [
                part.column("row"),
                pa.array(hits, pa.int64()),
                pa.array(counts, pa.int64()),
                pa.array(digests, pa.string()),
                pa.array(near_counts, pa.int64()),
                pa.array(near_digests, pa.string()),
            ],
            ["row", "n_hit", "n_items", "items_sha256", "n_near", "near_sha256"],
        )


def judged(
    documents: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    proximity: bool = True,
) -> DataFrame:
    """Counts per document; contaminated from a twentieth of its words on.

    With ``proximity`` come ``n_near`` and ``near_sha256``, the items near; they don't contaminate.
    """
    common.prepare(documents.sparkSession)
    segments = index(documents, key, text)
    counted = _found(segments, benchmark, item_key, item_text, proximity).mapInArrow(
        _described,
        "row long, n_hit long, n_items long, items_sha256 string, n_near long, near_sha256 string",
    )
    zero, nothing = F.lit(0).cast("long"), F.lit(hashlib.sha256(b"").hexdigest())
    columns = {"n_hit": zero, "n_items": zero, "items_sha256": nothing, "n_near": zero, "near_sha256": nothing}
    joined = _listed(segments).join(counted, "row", "left").withColumns(
        {name: F.coalesce(F.col(name), absent) for name, absent in columns.items()}
    )
    rule = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    return joined.select(
        F.col("key").alias(key),
        "n_words",
        "n_hit",
        "n_items",
        "items_sha256",
        rule.alias("contaminated"),
        *(["n_near", "near_sha256"] if proximity else []),
    )


def clean(
    documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **names: str
) -> DataFrame:
    """All columns of the documents that are not contaminated."""
    common.prepare(documents.sparkSession)
    rows, number = common.numbered(documents)
    found = judged(rows.select(number, text), benchmark, number, text, proximity=False, **names)
    return common.without(rows, number, found.filter("contaminated"))
