"""Token counts by byte-pair merging with a heap and a linked list.

The adjacent pair of lowest rank is merged again and again; a piece of text has as many tokens as
it had symbols, less the merges. No identifiers are made. Words repeat, so the counts of short
units are kept per worker in a cache of bounded size; a unit of any length is merged in
O(n log n).

Null and empty texts have no tokens. Rows stay as they are: repeated rows give repeated rows, an
empty table gives none; columns other than the id and the text are neither read nor returned.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettings.llm import common

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
#: Fixed value: the characters that Unicode calls white space.
SPACE = "\t\n\x0b\x0c\r \x85\xa0" + "".join(
    map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
)
#: Fixed value: the public pattern that splits text before the merges, with white space spelt out.
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
#: Words with the blank before them; no piece crosses the bounds of such a unit.
UNITS = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
CACHE = 600_000
LONGEST_CACHED = 48


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else the next free one above 255."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(free)) for b in range(256)]


class Merger:
    """Ranks of a byte-pair vocabulary and the counting of tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        ids = stated["model"]["vocab"]
        self.symbols = [ids[letter] for letter in byte_letters()]
        self.ranks: dict[int, tuple[int, int]] = {}
        for rank, (left, right) in enumerate(stated["model"]["merges"]):
            self.ranks[ids[left] << 32 | ids[right]] = (rank, ids[left + right])
        specials = [x["content"] for x in stated["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, specials))) if specials else None
        self.pieces = regex.compile(PIECES)
        self.counts: dict[str, int] = {}

    def merges(self, symbols: list[int]) -> int:
        """How many merges a piece allows, always the lowest rank first and then the leftmost."""
        ranks = self.ranks
        size = len(symbols)
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        heap = []
        for at in range(size - 1):
            found = ranks.get(symbols[at] << 32 | symbols[at + 1])
            if found:
                heap.append((found[0], at, found[1]))
        heapq.heapify(heap)
        done = 0
        while heap:
            rank, at, merged = heapq.heappop(heap)
            right = after[at]
            if symbols[at] < 0 or right >= size:
                continue
            now = ranks.get(symbols[at] << 32 | symbols[right])
            if not now or now[0] != rank:
                continue
            symbols[at], symbols[right] = merged, -1
            done += 1
            beyond = after[at] = after[right]
            if beyond < size:
                before[beyond] = at
                found = ranks.get(merged << 32 | symbols[beyond])
                if found:
                    heapq.heappush(heap, (found[0], at, found[1]))
            previous = before[at]
            if previous >= 0:
                found = ranks.get(symbols[previous] << 32 | merged)
                if found:
                    heapq.heappush(heap, (found[0], previous, found[1]))
        return done

    def unit(self, text: str) -> int:
        total = 0
        for piece in self.pieces.findall(text):
            symbols = [self.symbols[b] for b in piece.encode()]
            total += len(symbols) - (self.merges(symbols) if len(symbols) > 1 else 0)
        return total

    def count(self, text: str) -> int:
        if not text:
            return 0
        total = 0
        for number, part in enumerate(self.special.split(text) if self.special else [text]):
            total += (number > 0) + self._plain(part)
        return total

    def _plain(self, text: str) -> int:
        counts = self.counts
        total = 0
        for unit in UNITS.findall(text):
            known = counts.get(unit)
            if known is None:
                known = self.unit(unit)
                if len(unit) <= LONGEST_CACHED:
                    if len(counts) >= CACHE:
                        counts.clear()
                    counts[unit] = known
            total += known
        return total


@functools.lru_cache(maxsize=2)
def merger(path: str) -> Merger:
    return Merger(path)


def counted(
    documents: DataFrame,
    path: str | None = None,
    limit: int = LIMIT,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Bytes, tokens and whether the tokens exceed ``limit``, for every row."""
    path = path or public_tokenizers.path(VOCABULARY)
    rows = documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = merger(path)
        for part in parts:
            whole = common.texts(part)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("key"),
                    pa.array([len(x.encode()) for x in whole], pa.int64()),
                    pa.array([bpe.count(x) for x in whole], pa.int64()),
                ],
                ["key", "n_bytes", "n_tokens"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    found = rows.mapInArrow(count, f"key {kind}, n_bytes long, n_tokens long")
    over: Column = F.col("n_tokens") > limit
    return found.select(
        F.col("key").alias(key), "n_bytes", "n_tokens", over.alias("over_limit")
    )
