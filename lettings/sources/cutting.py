"""Records of CSV files with line breaks inside quotes, cut by many tasks a file.

A line break ends a record if the quotes before it in its file are even in number. One pass adds up
the quotes of every file split; their running parity, one row a split, says whether a split starts
inside quotes. A second pass then joins the lines of each split to records, all splits at once. A record
that a split boundary cuts leaves a fragment on either side; fragments, two a split at most, are put
together by a window and an aggregation over them alone.

Quotes are taken to stand around fields only, doubled inside them. A file with an odd number of them
is refused. Lines end with a line feed, with or without a carriage return before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lettings.model import PipelineError

WHOLE, OPENS, CONTINUES, CLOSES = 0, 1, 2, 3
CUT = "value string, _file string, _block long, _id long, part int"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    frame = spark.read.option("lineSep", "\n").text(path)
    return frame.select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")
    )


def _inside(lines: DataFrame) -> dict[str, set[int]]:
    """Splits that start inside quotes, by file; one number each, and few unless most text is quoted."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    splits = lines.groupBy("_file", "_block").agg((F.sum(quotes) % 2).alias("_odd"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    until = Window.partitionBy("_file").orderBy("_block")
    rows = (
        splits.withColumns(
            {
                "_starts": F.coalesce(F.sum("_odd").over(earlier), F.lit(0)) % 2,
                "_ends": F.sum("_odd").over(until) % 2,
                "_last": F.lead("_block").over(until).isNull(),
            }
        )
        .filter((F.col("_starts") == 1) | (F.col("_last") & (F.col("_ends") == 1)))
        .collect()
    )
    found: dict[str, set[int]] = {}
    for row in rows:
        if row["_last"] and row["_ends"] == 1:
            raise PipelineError(f"An open quote is never closed in {row['_file']}")
        found.setdefault(row["_file"], set()).add(row["_block"])
    return found


class _Split:
    """Cuts the lines of one split, batch by batch."""

    def __init__(self, file: str, block: int, inside: bool, header: str) -> None:
        self.file, self.block, self.header = file, block, header
        self.odd = int(inside)
        self.held: list[str] = []
        self.part = CLOSES if inside else WHOLE
        self.number = 0
        self.first = block == 0

    def _row(self, text: str, part: int) -> dict[str, object]:
        row = {"value": text, "_file": self.file, "_block": self.block, "_id": self.number, "part": part}
        if part in (WHOLE, OPENS):  # a record counts where it starts
            self.number += 1
        return row

    def add(self, lines: pa.Array) -> Iterator[dict[str, object]]:
        quotes = np.asarray(pc.count_substring(lines, '"'))
        after = (self.odd + np.cumsum(quotes)) % 2
        for line, odd in zip(lines.to_pylist(), after.tolist(), strict=True):
            if not odd and not self.held and self.part == WHOLE:
                text = line.removesuffix("\r")
            else:
                self.held.append(line)
                if odd:
                    continue
                text = "\n".join(self.held).removesuffix("\r")
            part, self.held, self.part = self.part, [], WHOLE
            if self.first:
                self.first = False
                if text.removeprefix("﻿") != self.header:
                    raise ValueError(f"The header of {self.file} differs from the others: {text[:200]}")
            elif part != WHOLE or text.strip():
                yield self._row(text, part)
        self.odd = int(after[-1]) if len(after) else self.odd

    def end(self) -> Iterator[dict[str, object]]:
        """What is left open goes on in the next split."""
        if self.held:
            yield self._row("\n".join(self.held), OPENS if self.part == WHOLE else CONTINUES)


def _cutter(inside: dict[str, set[int]], header: str):
    schema = pa.schema(
        [("value", pa.string()), ("_file", pa.string()), ("_block", pa.int64()), ("_id", pa.int64()), ("part", pa.int32())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split: _Split | None = None
        for batch in batches:
            files, blocks = batch.column("_file").to_pylist(), batch.column("_block").to_pylist()
            rows: list[dict[str, object]] = []
            at = 0
            while at < batch.num_rows:
                end = at
                while end < batch.num_rows and blocks[end] == blocks[at] and files[end] == files[at]:
                    end += 1
                if split is None or (split.file, split.block) != (files[at], blocks[at]):
                    if split is not None:
                        rows.extend(split.end())
                    split = _Split(files[at], blocks[at], blocks[at] in inside.get(files[at], ()), header)
                rows.extend(split.add(batch.column("value").slice(at, end - at)))
                at = end
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
        if split is not None and (rows := list(split.end())):
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return cut


def records(spark: SparkSession, path: str, header: str) -> DataFrame:
    """One row per record but the headers: its text, file, split and number inside the split."""
    lines = _lines(spark, path)
    cut = lines.mapInArrow(_cutter(_inside(lines), header), CUT)
    opened = F.sum(F.when(F.col("part") == OPENS, 1).otherwise(0))
    # In a split the end of an earlier record comes before the start of the next one.
    turn = F.when(F.col("part") == OPENS, 1).otherwise(0)
    order = Window.partitionBy("_file").orderBy("_block", turn)
    pieces = cut.filter(F.col("part") != WHOLE).withColumn("_record", opened.over(order))
    whole = pieces.groupBy("_file", "_record").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("_block", turn.alias("turn"), "value"))), lambda x: x["value"]),
            "\n",
        ).alias("value"),
        F.min(F.when(F.col("part") == OPENS, F.struct("_block", "_id"))).alias("_start"),
    )
    stitched = whole.select(
        F.regexp_replace("value", "\r$", "").alias("value"),
        "_file",
        F.col("_start._block").alias("_block"),
        F.col("_start._id").alias("_id"),
    )
    return cut.filter(F.col("part") == WHOLE).drop("part").unionByName(stitched)


def parsed(texts: DataFrame, schema: T.StructType, corrupt: str) -> DataFrame:
    """The columns of record texts, by the rules of Spark's CSV reader, next to file, split and number."""
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt, "multiLine": "true"}
    columns = ", ".join("`{}` string".format(name.replace("`", "``")) for name in schema.names)
    row = F.from_csv("value", columns, options)
    return texts.select(row.alias("_row"), "_file", "_block", "_id").select("_row.*", "_file", "_block", "_id")
