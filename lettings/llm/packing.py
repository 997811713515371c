"""Packing of tokenised documents into sequences of bounded length by sums of squares.

A document is its token ids and an end id. Documents longer than a sequence are cut into full pieces
and a rest; nothing else is cut. Pieces are dealt out evenly to groups of about ``GROUP`` and
each group is packed by itself: a piece goes where the sum of the squared counts of open bins per
residual gap becomes smallest (of equal places, the tightest). Long pieces come first. What a group
leaves open meets the open bins of other groups in the next round, as pieces of their own, until one
group holds them all or a round no longer makes them fit into fewer groups (bins that are all more than half
full can't be merged, for one); open bins of different groups then stay apart. No task sees more than a
group. On sizes without small pieces to fill gaps the rule itself needs more sequences than best fit
does (uniform sizes: 10,417 against 10,043).

Texts are tokenised some 4 MB at a time, each different word of them once; ids are kept per worker in
a cache of bounded size. Null and empty texts are the end id alone. Texts of any length are
tokenised word by word. Pieces of equal size go in the order of their numbers.
Rows without an id and repeated rows are packed like any other; an empty table gives an empty
result. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import functools
import itertools
import os
import unicodedata
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettings.llm import common
from lettings.llm.token_counts import byte_letters

VOCABULARY = "word_bpe_49k.json"
LENGTH = 4096
END = 1
GROUP = 40_000
#: Units whose ids a worker keeps.
CACHE = 300_000
LONGEST_CACHED = 48
#: Marks at the end of a word; they never join with its letters.
MARKS = ".,;:!?|$%&*#"
#: Words of letters that have one normal form and one small letter each, and marks.
LATIN = rf"^(?P<core>[A-Za-z\x{{c0}}-\x{{d6}}\x{{d8}}-\x{{f6}}\x{{f8}}-\x{{ff}}]+)(?P<marks>[{MARKS}]*)$"
#: Bytes of texts that are tokenised together, besides the longest of them.
TOGETHER = 4_000_000


class Words:
    """Token ids of texts, word by word; this vocabulary never joins over blanks.

    Texts are cut into words and equal words found in whole columns. A word is one or two units: its
    letters, in the normal form and lower case that the library would give them, and the marks after
    them. Units of letters that are new go to the library's model at once; any other word goes
    through the library as a whole and is a unit itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.letters = byte_letters()
        self._forget()

    def _forget(self) -> None:
        """Unit 0 has no ids; the ids of unit n are ``pool[ends[n - 1]:ends[n]]``."""
        self.units: dict[str, int] = {"": 0}
        self.pool = array("I")
        self.ends = array("q", [0])

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each text has."""
        if len(self.units) > CACHE or len(self.pool) > 8 * CACHE:
            self._forget()
        split = pc.ascii_split_whitespace(texts)
        coded = split.values.dictionary_encode()
        units = self._units_of(coded.dictionary)
        pool, ends = np.array(self.pool, "<u4"), np.array(self.ends)
        # Ids of the different words first, then of the words as they stand in the texts.
        pool, ends = _gathered(pool, ends, units.ravel())
        ends = np.concatenate([[0], ends[1::2]])
        pool, ends = _gathered(pool, ends, coded.indices.to_numpy() + 1)
        ends = np.concatenate([[0], ends])[split.offsets.to_numpy()]
        return pool, np.diff(ends)

    def _units_of(self, words: pa.Array) -> np.ndarray:
        """Two units of every word."""
        found = pc.extract_regex(words, LATIN)
        cores, marks = found.field("core"), found.field("marks")
        usual = pc.fill_null(pc.less_equal(pc.utf8_length(cores), LONGEST_CACHED), False)
        usual = pc.and_(found.is_valid(), usual)
        at = usual.to_numpy(zero_copy_only=False)
        units = np.zeros((len(words), 2), np.int64)
        for column, names in enumerate((pc.utf8_lower(cores), marks)):
            coded = names.filter(usual).dictionary_encode()
            numbers = self._numbers(coded.dictionary, self._whole if column else self._letters)
            units[at, column] = numbers[coded.indices.to_numpy()]
        units[~at, 0] = self._numbers(words.filter(pc.invert(usual)), self._word)
        return units

    def _numbers(self, names: pa.Array, make: Callable[[str], list[int]]) -> np.ndarray:
        """The units of different names; ``make`` gives the ids of new ones."""
        names = names.to_numpy(zero_copy_only=False).tolist()
        numbers = list(map(self.units.get, names))
        for at in [at for at, number in enumerate(numbers) if number is None]:
            numbers[at] = len(self.ends)
            self.pool.extend(make(names[at]))
            self.ends.append(len(self.pool))
            if len(names[at]) <= LONGEST_CACHED:
                self.units[names[at]] = numbers[at]
        return np.array(numbers, np.int64)

    def _letters(self, core: str) -> list[int]:
        """Ids of letters in normal form and lower case."""
        shown = core if core.isascii() else "".join([self.letters[b] for b in core.encode()])
        return [x.id for x in self.model.tokenize(shown)]

    def _word(self, word: str) -> list[int]:
        core = word.rstrip(MARKS)
        if not core.isalpha() or len(core) > LONGEST_CACHED:
            return self._whole(word)
        if not core.isascii() and ("\u03a3" in core or not unicodedata.is_normalized("NFC", core)):
            return self._whole(word)
        core, marks = core.lower(), word[len(core) :]
        if not core.isalpha():  # a capital whose small form is a letter and a mark
            return self._whole(word)
        return self._letters(core) + (self._whole(marks) if marks else [])

    def _whole(self, word: str) -> list[int]:
        return self.library.encode(word, add_special_tokens=False).ids


def _gathered(pool: np.ndarray, ends: np.ndarray, taken: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``pool[ends[n - 1]:ends[n]]`` of all numbers in a row, and the end of each; run 0 is empty."""
    sizes = np.diff(ends, prepend=0)[taken]
    new_ends = np.cumsum(sizes)
    places = np.repeat(ends[taken] - new_ends, sizes)
    places += np.arange(len(places))
    return pool[places], new_ends


@functools.lru_cache(maxsize=2)
def words(path: str) -> Words:
    return Words(path)


def _together(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of ``TOGETHER`` bytes of text at most besides their longest text; null is empty."""
    held: list[pa.RecordBatch] = []
    size = 0
    for part in parts:
        whole = pc.fill_null(part.column("text"), "")
        part = part.set_column(1, "text", whole)
        before = np.cumsum(pc.binary_length(whole).to_numpy()) // TOGETHER
        cuts = [0, *(np.flatnonzero(np.diff(before)) + 1).tolist(), len(part)]
        for at, to in itertools.pairwise(cuts):
            own = part.slice(at, to - at)
            more = pc.sum(pc.binary_length(own.column("text"))).as_py() or 0
            if held and size + more > TOGETHER:
                yield pa.concat_batches(held)
                held, size = [], 0
            if at < to:
                held.append(own)
                size += more
    if held:
        yield pa.concat_batches(held)


def pieces(
    documents: DataFrame,
    path: str | None = None,
    length: int = LENGTH,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: id, number, start, length and crc32 of the piece's ids."""
    path = path or public_tokenizers.path(VOCABULARY)
    rows = documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    end = np.array([END], "<u4").tobytes()

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = words(path)
        numbers = common.row_numbers()
        for part in _together(parts):
            keys = part.column("key").to_pylist()
            held: list[tuple] = []
            ids, sizes = library.ids(part.column("text"))
            for name, own_ids in zip(keys, np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
                whole = own_ids.tobytes() + end
                for piece, at in enumerate(range(0, len(whole), 4 * length)):
                    own = whole[at : at + 4 * length]
                    held.append((name, piece, at // 4, len(own) // 4, zlib.crc32(own), next(numbers)))
            if held:
                kinds = [part.schema.field("key").type, pa.int32(), *[pa.int64()] * 4]
                columns = [pa.array(x, k) for x, k in zip(zip(*held, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    columns, ["key", "piece", "start", "length", "ids_crc32", "item"]
                )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(
        cut, f"key {kind}, piece int, start long, length long, ids_crc32 long, item long"
    )


def sum_of_squares(sizes: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every piece, given from the longest to the shortest.

    ``open_bins[g]`` counts bins with a residual gap ``g``. Putting a piece of size ``s`` into gap
    ``g`` changes the sum of squares by ``2 (n[g - s] - n[g]) + 2``, a fit without rest by
    ``1 - 2 n[g]``, and a new bin by ``2 n[length - s] + 1``; the least change wins.
    """
    open_bins = np.zeros(length + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(length + 1)]
    bins = np.empty(len(sizes), np.int64)
    offsets = np.empty(len(sizes), np.int64)
    used = 0
    for at, size in enumerate(sizes.tolist()):
        if size >= length:
            bins[at], offsets[at] = used, 0
            used += 1
            continue
        present = open_bins[size:length]
        gaps = np.flatnonzero(present)
        new = 2 * int(open_bins[length - size]) + 1
        best = 0
        if len(gaps):
            change = 2 * (open_bins[gaps] - present[gaps]) + 2
            if gaps[0] == 0:
                change[0] = 1 - 2 * present[0]
            at_best = int(change.argmin())
            if change[at_best] <= new:
                best = int(gaps[at_best]) + size
        if best:
            chosen = stacks[best].pop()
            open_bins[best] -= 1
        else:
            chosen, best = used, length
            used += 1
        bins[at], offsets[at] = chosen, length - best
        if best > size:
            stacks[best - size].append(chosen)
            open_bins[best - size] += 1
    return bins, offsets


def _pack_groups(items: DataFrame, groups: int, length: int) -> DataFrame:
    """``item``, ``bin`` and ``offset`` of every item; ``items`` has ``item`` and ``size``."""

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "item"], ascending=[False, True], ignore_index=True)
        bins, offsets = sum_of_squares(rows["size"].to_numpy(), length)
        number = int(rows["part"].iloc[0])
        return pd.DataFrame(
            {"item": rows["item"], "size": rows["size"], "bin": number << 32 | bins, "offset": offsets}
        )

    dealt = items.select("item", "size", F.pmod(F.xxhash64("item"), F.lit(groups)).alias("part"))
    # A number of its own keeps AQE from merging groups, which are small as rows but long to pack.
    dealt = dealt.repartition(groups, "part")
    return dealt.groupBy("part").applyInPandas(pack, "item long, size long, bin long, offset long")


def packed(
    documents: DataFrame,
    path: str | None = None,
    length: int = LENGTH,
    group: int = GROUP,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Every piece with its sequence and its place there."""
    common.prepare(documents.sparkSession)
    all_pieces = common.stored(pieces(documents, path, length, key, text), "pieces")
    return placed(all_pieces, length, group).select(
        F.col("key").alias(key), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def placed(all_pieces: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    items = all_pieces.select("item", F.col("length").alias("size")).filter(F.col("size") < length)
    groups = max(1, -(-items.count() // group))
    places = common.stored(_pack_groups(items, groups, length), "bins")
    while groups > 1:
        # Bins that are not full meet those of other groups, as items of the size they hold.
        held = places.groupBy("bin").agg(F.sum("size").alias("size")).filter(F.col("size") < length)
        left = common.stored(held.select(F.col("bin").alias("item"), "size"), "open")
        before, groups = groups, -(-left.count() // group)
        if not 0 < groups < before:
            break
        merged = _pack_groups(left, groups, length).select(
            F.col("item").alias("bin"),
            F.col("bin").alias("new_bin"),
            F.col("offset").alias("shift"),
        )
        # Rounds have bins of their own, so that kept and merged bins never share a number.
        before_all = places.join(common.stored(merged, "merged"), "bin", "left")
        places = common.stored(
            before_all.select(
                "item",
                "size",
                F.when(F.col("new_bin").isNull(), F.col("bin") * 2)
                .otherwise(F.col("new_bin") * 2 + 1)
                .alias("bin"),
                (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
            ),
            "bins",
        )
    full = all_pieces.filter(F.col("length") >= length).select(
        "*", (-F.col("item") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    shorter = all_pieces.filter(F.col("length") < length).join(
        places.select("item", F.col("bin").alias("sequence_id"), "offset"), "item"
    )
    return shorter.unionByName(full)
