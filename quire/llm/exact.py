"""Exact deduplication by Golomb-coded fingerprint exchange.

1. Every row's normalised text gets its SHA-256; the first 8 bytes are its fingerprint. This small
   table is written.
2. It is read again in lists of LIST rows, whatever partitions made them. A list's distinct fingerprints are sorted, cut by owner (a
   range of fingerprints) and sent as Golomb-coded gaps. An owner merges the lists that it receives and answers each with a bitmap:
   which of the list's fingerprints it also got from elsewhere.
3. Rows whose fingerprint was marked (or is repeated within its list) are suspects. Only their
   texts are normalised again and move: they are grouped by hash and bytes with partial aggregation, so that a text with
   very many copies leaves each partition once. A group whose hash has two different texts fails
   the job, rather than joining them.

Defined results. Null text counts as empty; empty texts are equal to each other. A null doc_id is
larger than any other. Of rows with equal text and doc_id, the one with the least hash of its other columns stays. An empty table gives no rows.
Texts of any length are hashed whole. Extra columns are ignored by ``groups`` and kept by ``kept_documents``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import DOCUMENT_KEY, checked_broadcast, documents, key_columns, kept_of, text_of, written

#: Rows for each owner of fingerprints, about.
OWNER_ROWS = 2_000_000


def normalised(docs: DataFrame) -> Column:
    return F.regexp_replace(text_of(docs), r"[\x20\x09-\x0D]+", " ")


def golomb(sorted_values: np.ndarray) -> tuple[int, bytes]:
    """(bits of the remainder, code) for distinct ascending uint64 numbers: each gap's quotient in
    unary, all remainders in binary (Golomb's code with a power of two as its parameter)."""
    n = len(sorted_values)
    gaps = np.diff(sorted_values, prepend=np.uint64(0))
    mean = max(int(sorted_values[-1]) // n, 1) if n else 1
    k = max(int(mean * 0.69).bit_length() - 1, 0)
    high = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(high + 1) - 1
    unary = np.ones(int(ends[-1]) + 1 if n else 0, np.uint8)
    unary[ends] = 0
    low = (gaps & np.uint64((1 << k) - 1))[:, None] >> np.arange(k - 1, -1, -1, dtype=np.uint64)[None, :] if k else np.zeros((n, 0), np.uint64)
    body = np.packbits(np.concatenate([unary, (low & np.uint64(1)).astype(np.uint8).ravel()]))
    return k, len(unary).to_bytes(8, "little") + body.tobytes()


def ungolomb(n: int, k: int, code: bytes) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint64)
    m = int.from_bytes(code[:8], "little")
    bits = np.unpackbits(np.frombuffer(code, np.uint8, offset=8), count=m + n * k)
    high = np.diff(np.flatnonzero(bits[:m] == 0), prepend=-1) - 1
    gaps = high.astype(np.uint64) << np.uint64(k)
    if k:
        low = bits[m:].reshape(n, k).astype(np.uint64)
        gaps |= low @ (np.uint64(1) << np.arange(k - 1, -1, -1, dtype=np.uint64))
    return np.cumsum(gaps, dtype=np.uint64)


#: Fingerprints in the lists that a task codes at a time: bounds a sender's memory.
LIST = 500_000


def _send(owners: int):
    """Sorted compressed lists, one for each owner."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held: list[np.ndarray]) -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held).view(np.uint64), return_counts=True)
            owner = (values >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)
            cut = np.flatnonzero(np.diff(owner)) + 1
            made = []
            for vs, cs, os in zip(np.split(values, cut), np.split(counts, cut), np.split(owner, cut), strict=True):
                k, code = golomb(vs)
                made.append((int(os[0]), len(vs), k, code, np.packbits(cs > 1).tobytes()))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)], ["owner", "n", "k", "code", "twice"])

        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch.column("fp").to_numpy(zero_copy_only=False))
                size += batch.num_rows
            if size >= LIST:
                yield out(held)
                held, size = [], 0
        if held:
            yield out(held)

    return send


def _own(key, table):  # without types: Spark reads them
    """Answers an owner's lists with bitmaps of what is there more than once, and names the marked
    fingerprints, each once."""
    n, k, codes, twice = (table.column(c).to_pylist() for c in ("n", "k", "code", "twice"))
    lists = [ungolomb(a, b, c) for a, b, c in zip(n, k, codes, strict=True)]
    values, where, counts = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    again = counts > 1
    cut = np.cumsum(n)[:-1]
    for own, bits in zip(np.split(where, cut), twice, strict=True):  # repeated within its sender
        again[own[np.unpackbits(np.frombuffer(bits, np.uint8), count=len(own)).astype(bool)]] = True
    maps = [np.packbits(x).tobytes() for x in np.split(again[where], cut)]
    return pa.table({"n": table["n"], "k": table["k"], "code": table["code"], "bitmap": pa.array(maps, pa.binary())})


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sender reads its bitmaps: the fingerprints of its lists that are marked."""
    for batch in batches:
        for n, k, code, bits in zip(*[batch.column(c).to_pylist() for c in ("n", "k", "code", "bitmap")], strict=True):
            chosen = np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)
            if chosen.any():
                yield pa.RecordBatch.from_arrays([pa.array(ungolomb(n, k, code)[chosen].view(np.int64))], ["fp"])


def groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, and the row's key."""
    sha = F.sha2(F.encode(normalised(docs), "UTF-8"), 256)
    rows = docs.select(docs["doc_id"].alias("doc_id"), sha.alias("text_sha256"), *key_columns(docs))
    fp = F.conv(F.substring("text_sha256", 1, 1), 16, 10).cast("long") % 8 * F.lit(1 << 60) + F.conv(F.substring("text_sha256", 2, 15), 16, 10).cast("long")
    rows = written(rows.withColumns({"fp": fp, "row": F.monotonically_increasing_id()}), "exact-rows")
    owners = max(16, -(-rows.count() // OWNER_ROWS))
    listed = rows.select("fp").mapInArrow(_send(owners), "owner long, n long, k int, code binary, twice binary")
    answers = listed.groupBy("owner").applyInArrow(_own, "n long, k int, code binary, bitmap binary")
    marked = written(answers.mapInArrow(_marked, "fp long").distinct(), "exact-marked")

    # byte verification of the suspects, which are found by the hash and length of their raw texts
    named = list(DOCUMENT_KEY[1:3])
    raw = written(rows.join(checked_broadcast(marked), "fp", "left_semi").select(*named).distinct(), "exact-suspects")
    suspects = docs.select(docs["doc_id"].alias("doc_id"), text_of(docs).alias("text"), *key_columns(docs)[1:3]).join(checked_broadcast(raw), named, "left_semi")
    suspects = suspects.select("doc_id", normalised(suspects).alias("norm"))
    suspects = suspects.withColumn("text_sha256", F.sha2(F.encode("norm", "UTF-8"), 256))
    texts = suspects.groupBy("text_sha256", "norm").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # of the texts only one number leaves; two texts of one hash end the job
    classes = texts.select("text_sha256", "keep_id", "group_size").groupBy("text_sha256").agg(F.count(F.lit(1)).alias("texts"), F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    classes = classes.select("text_sha256", "keep_id", F.when(F.col("texts") == 1, F.col("group_size")).otherwise(F.raise_error(F.lit("two texts have one SHA-256"))).alias("group_size"))
    classes = written(classes.where("group_size > 1"), "exact-classes")

    out = rows.join(checked_broadcast(classes.withColumn("grouped", F.lit(True))), "text_sha256", "left")
    out = out.withColumns({"keep_id": F.when(F.col("grouped"), F.col("keep_id")).otherwise(F.col("doc_id")), "group_size": F.coalesce("group_size", F.lit(1).cast("long"))})
    # of a group's rows with the kept id, one stays
    first = out.where("grouped and doc_id <=> keep_id").groupBy("text_sha256").agg(F.min(F.struct(DOCUMENT_KEY[3], "row")).getField("row").alias("first"))
    first = checked_broadcast(written(first, "exact-first"))
    out = out.join(first, "text_sha256", "left")
    kept = F.when(F.col("grouped"), F.col("row") == F.col("first")).otherwise(F.lit(True))
    return out.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256", *DOCUMENT_KEY)


def kept_documents(docs: DataFrame) -> DataFrame:
    """docs with one row of each group of equal texts; all their columns, whatever their names."""
    keys = groups(docs).groupBy(*DOCUMENT_KEY).agg(F.count(F.lit(1)).alias("n"), F.max("kept").alias("kept"))
    return kept_of(docs, written(keys.where("n > 1 or not kept"), "exact-kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(documents(spark, sf_dir)).drop(*DOCUMENT_KEY)


#: DuckDB: the whole result; chr(11) and chr(12) stand for \x0B and \x0C.
ORACLE = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), g AS (
  SELECT doc_id, sha256(norm) AS text_sha256, min(doc_id) OVER (PARTITION BY norm) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size,
         row_number() OVER (PARTITION BY norm ORDER BY doc_id) = 1 AS kept
  FROM n
)
SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM g
"""
