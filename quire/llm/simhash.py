"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprints that differ in at most RADIUS = 3 bits are linked. Half of 3 is no whole number, so the
64 bits are dealt into three blocks and each projection leaves one block out: unless they are equal,
two linked fingerprints differ inside some block, and without it in at most 2 bits. In that projection
each fingerprint emits itself and all variants with one bit changed (half the remaining radius); the
balls of linked fingerprints meet in a variant. Only distinct fingerprints emit, 131 or so rows of 16
bytes each. A variant's rows are shuffled together, and collisions are verified on all 64 bits.

In a bucket no pairs are listed: a tree over its linked members is enough for the components, and
joins the same vertices as all its pairs would. A bucket holds distinct fingerprints only, and those
within one bit of the variant outside the left-out block, so copies of one text never fill it; its search takes memory linear in
these, and time at most their square. Components are then found over these edges. Of the classes, only those of several rows meet
the rows again, so a fingerprint that very many rows share is broadcast, not gathered.

Defined results. Null text counts as empty; a text without words has fingerprint zero and is linked
like any other. Fewer than three words: one shingle of them all. Repeated rows are linked. A null
doc_id is never the least id of a component that has another; if all are null, the component is null. An empty table
gives no rows. Texts of any length are read whole, in pieces of ``_CHUNK`` shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import DOCUMENT_KEY, checked_broadcast, documents, kept_of, key_columns, text_of, written
from quire.llm.components import components

RADIUS = 3
SHINGLE = 3
#: First and last bit of the blocks that the projections leave out.
BLOCKS = ((0, 21), (21, 42), (42, 64))
_CHUNK = 50_000
_ONES = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)


def fingerprint(text: str) -> int:
    """Majority of the XXH64 bits of all word shingles."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    hashed = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        return hashed(b" ".join(words), 42)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - SHINGLE + 1].tolist()
    ends = ends[SHINGLE - 1 :].tolist()
    n, total = len(starts), np.zeros(64, np.int64)
    for k in range(0, n, _CHUNK):
        h = np.array([hashed(joined[a:b], 42) for a, b in zip(starts[k : k + _CHUNK], ends[k : k + _CHUNK], strict=True)], np.uint64)
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = [fingerprint(t) for t in batch.column("t").to_pylist()]
        rest = [batch.column(c) for c in ("doc_id", *DOCUMENT_KEY)]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(np.array(fps, np.uint64).view(np.int64))], ["doc_id", *DOCUMENT_KEY, "fp"])


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(projection, variant, fp) of each fingerprint's balls of radius 1, a few thousand at a time."""
    for batch in batches:
        every = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        for k in range(0, len(every), 2000):
            fp = every[k : k + 2000]
            for number, (first, last) in enumerate(BLOCKS):
                mask = np.uint64(((1 << 64) - 1) ^ ((1 << last) - (1 << first)))
                flips = np.array([0, *[1 << b for b in range(64) if not first <= b < last]], np.uint64)
                variants = ((fp & mask)[:, None] ^ flips[None, :]).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(variants), number, np.int8)), pa.array(variants.view(np.int64)), pa.array(np.repeat(fp, len(flips)).view(np.int64))], ["projection", "variant", "fp"])


def _far(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a ^ b
    return sum(_ONES[(x >> np.uint64(s) & np.uint64(0xFFFF)).astype(np.uint16)] for s in (0, 16, 32, 48))


def tree(fps: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a forest over all pairs within RADIUS, by breadth-first search: each reached
    fingerprint is compared once with those not yet reached, in memory linear in their number."""
    out, left = [], fps
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            a = queue.pop()
            near = _far(left, a) <= RADIUS
            if near.any():
                found = left[near]
                out += [(int(a), int(b)) for b in found]
                queue += list(found)
                left = left[~near]
    return out


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (projection, variant); a bucket may go on in the next batch."""
    held: list[np.ndarray] = []
    at = None

    def edges(buckets) -> pa.RecordBatch:
        found = [e for b in buckets for e in tree(np.unique(b))]
        pairs = np.array(sorted(set(found)), np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        p, v, f = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("projection", "variant", "fp"))
        f = f.view(np.uint64)
        cut = np.flatnonzero((np.diff(p) != 0) | (np.diff(v) != 0)) + 1
        starts, ends = np.concatenate([[0], cut]), np.concatenate([cut, [len(f)]])
        done = []
        if at == (p[0], v[0]):
            held.append(f[: ends[0]])
        else:
            done += [np.concatenate(held)] if held else []
            held = [f[: ends[0]]]
        if len(starts) > 1:
            done.append(np.concatenate(held))
            held = [f[starts[-1] :]]
            several = np.flatnonzero(ends - starts > 1)
            done += [f[starts[i] : ends[i]] for i in several if 0 < i < len(starts) - 1]
        at = (p[-1], v[-1])
        yield edges(done)
    if held:
        yield edges([np.concatenate(held)])


def linked(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fp (its fingerprint as a signed long), component_id, root (the least
    fingerprint of its component, which no other component has, as ids may be null or repeated) and the row's key."""
    rows = docs.select(docs["doc_id"].alias("doc_id"), *key_columns(docs), text_of(docs).alias("t"))
    schema = rows.select("doc_id", *DOCUMENT_KEY).schema.add("fp", "long")
    rows = written(rows.mapInArrow(_fingerprints, schema), "simhash-rows")
    distinct = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "simhash-distinct")
    balls = distinct.select("fp").mapInArrow(_variants, "projection byte, variant long, fp long")
    balls = balls.repartition("projection", "variant").sortWithinPartitions("projection", "variant")
    roots = written(components(balls.mapInArrow(_verified, "a long, b long")), "simhash-roots")
    classes = distinct.join(roots, distinct.fp == roots.vertex, "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root"))
    of_root = classes.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("n").alias("rows")).where("rows > 1")
    several = written(classes.join(of_root, "root").select("fp", "root", "component_id"), "simhash-classes")
    out = rows.join(checked_broadcast(several.withColumn("found", F.lit(True))), "fp", "left")
    return out.withColumns({"root": F.coalesce("root", "fp"), "component_id": F.when(F.col("found"), F.col("component_id")).otherwise(F.col("doc_id"))}).drop("found")


def kept_documents(docs: DataFrame) -> DataFrame:
    """docs with one row of each component, that of the least doc_id; all their columns, whatever their names."""
    rows = written(linked(docs).select("root", "component_id", *DOCUMENT_KEY), "simhash-linked")
    # with the least id repeated in one component, the least key stays
    key = F.struct(*DOCUMENT_KEY)
    best = rows.groupBy("root").agg(F.min(F.when(F.col("component_id").eqNullSafe(F.col(DOCUMENT_KEY[0])), key)).alias("k"), F.count(F.lit(1)).alias("rows"))
    best = checked_broadcast(written(best.where("rows > 1").select("root", "k"), "simhash-best"))
    keys = rows.join(best, "root").groupBy(*DOCUMENT_KEY).agg(F.count(F.lit(1)).alias("n"), F.max(key.eqNullSafe(F.col("k"))).alias("kept"))
    return kept_of(docs, written(keys, "simhash-kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linked(documents(spark, sf_dir))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
