"""Documents to packed training sequences: each stage's result is written and read again by the next.

All stages keep columns of any names, read whole texts, and give no rows for an empty table. Rows that are alike in every column
are rows like any other: a stage that keeps one of a group keeps one of them. Results don't depend on how rows are partitioned.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quire.llm import exact, mixing, packing, quality, simhash
from quire.llm.common import documents, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the outlier test reject go. Null and empty texts fail the base rules; a null lang or
    source is a group of its own; repeated rows are judged alike."""
    return quality.kept_documents(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of equal texts stays, white space apart: the row with the smallest doc_id, nulls last; of rows with one doc_id, that
    with the least hash of its other columns. Null and empty texts are equal to each other."""
    return exact.kept_documents(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of near-duplicates stays: the row with the smallest doc_id, nulls last, at ties that with the least key.
    Texts without words have fingerprint zero and are one group, with whatever is near it."""
    return simhash.kept_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, up to three times. A null source is a source of its own. Texts without words have
    size 0 and stay about once. At ties copies go by a hash of the whole row."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences. A null or empty text is its closing id alone; a long one is cut; a
    row that comes several times is packed as often."""
    return packing.packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", simhash_near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack),
]

#: Outliers, SimHash links, entropy balancing and packing can't be said in SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
