"""From raw documents to packed training sequences, one stored stage after the other.

Each stage takes what its predecessor kept, whole, and writes it to the shared folder; a lost
executor repeats part of one stage at most. Empty tables, null texts and extra columns pass through
every stage: only ``doc_id`` and ``text`` are used, and ``n_chars`` follows the text where it is
there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettings.llm import common, contamination, packing, pii, quality, simhash

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.accepted(docs, common.table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays.

    Near copies have SimHash fingerprints of 3-word shingles, as in ``op7_simhash``, that differ in
    two bits at most. That is no bound on the similarity of 5-word shingles: in trials one changed
    word in 300 moved 2.8 bits on average, so half of such copies both stay, and six changed words
    moved 6.9.
    """
    return simhash.first_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are contaminated by the benchmark go."""
    return contamination.clean(docs, common.table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; all documents stay."""
    found = pii.redacted(docs)
    if "n_chars" in found.columns:
        kind = found.schema["n_chars"].dataType
        found = found.withColumn("n_chars", F.length("text").cast(kind))
    return found


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences."""
    return packing.packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("near_copies", without_near_copies),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

#: Trained models and tokenizers can't be said in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; the result is the stored last one."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return docs
