"""Packing documents into sequences by minimum bin slack.

Only lengths matter, and there are at most ``size`` of them: the plan is made from the counts of pieces by length,
whose size has nothing to do with the number of documents. For each sequence, dynamic programming over a bitset of
reachable sums finds the fullest combination of available lengths that holds the longest one left; the
combination is taken as often as its counts allow, and removed. Every take uses up a length or leaves less
than another take of it, so a few thousand combinations pack any number of documents.

Then pieces are dealt to the plan: the r-th piece of a length (ranks are counted in slices, so that a very
common length is not sorted in one task) goes to the place for that rank. The plan, sorted arrays of
at most some ten thousand places, travels with the function.

Defined results. Null or empty text: the closing id alone, length 1. A longer document is cut into pieces of
``size``, of which the first may be shorter. Repeated rows are packed each. An empty table gives no
rows. Extra columns are ignored, a null doc_id stays null.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.llm.bpe import default_path, encoder
from quire.llm.common import documents, text_of, written

SIZE = 2048
SLICES = 64
_PIECE = "piece integer, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, path: str | None = None, size: int = SIZE, closing: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 for each piece of each document."""
    path = path or default_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = encoder(path)
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column("t").to_pylist()):
                ids = np.append(one.ids(text), np.uint32(closing)).astype("<u4")
                n = len(ids)
                first = n % size or size
                for k, a in enumerate([0, *range(first, n, size)]):
                    b = min(first + k * size, n)
                    row.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[a:b].tobytes()))
            columns = [pa.array(piece, pa.int32()), *[pa.array(x, pa.int64()) for x in (start, length, crc)]]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row, pa.int64())), *columns], ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(docs["doc_id"].alias("doc_id"), text_of(docs).alias("t"))
    schema = rows.select("doc_id").schema
    for f in _PIECE.split(", "):
        schema = schema.add(*f.split())
    return rows.mapInArrow(cut, schema)


def fullest(lengths: list[int], counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """[(length, how many)] of the fullest combination of at most room, by bitset subset sums.
    Lengths in descending order; longer ones are tried first and preferred."""
    whole = (1 << room + 1) - 1
    sums, trail = 1, []
    for length in lengths:
        if length > room:
            continue
        left, unit = min(counts[length], room // length), 1
        while left:  # copies in powers of two
            take = min(unit, left)
            trail.append((length, take, sums))
            sums |= sums << length * take & whole
            left, unit = left - take, unit * 2
        if sums >> room & 1:
            break
    at, used = sums.bit_length() - 1, {}
    for length, take, before in reversed(trail):
        if not before >> at & 1:
            used[length] = used.get(length, 0) + take
            at -= length * take
    return sorted(used.items(), reverse=True)


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, list[tuple[int, int]]]]:
    """[(times, [(length, how many)])]: sequences that hold every piece exactly once."""
    counts, out = dict(counts), []
    lengths = sorted((n for n in counts if counts[n]), reverse=True)
    while lengths:
        top = lengths[0]
        counts[top] -= 1
        used = dict(fullest(lengths, counts, size - top))
        counts[top] += 1
        used[top] = used.get(top, 0) + 1
        times = min(counts[n] // k for n, k in used.items())
        for n, k in used.items():
            counts[n] -= times * k
        out.append((times, sorted(used.items(), reverse=True)))
        lengths = [n for n in lengths if counts[n]]
    return out


def _places(combinations: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Length -> (first ranks, first sequences, offsets) of its places: rank r, in a place that begins at
    rank a, goes to sequence s + (r - a)."""
    used: dict[int, int] = {}
    found: dict[int, list[tuple[int, int, int]]] = {}
    sequence = 0
    for times, parts in combinations:
        offset = 0
        for length, many in parts:
            for _ in range(many):
                found.setdefault(length, []).append((used.get(length, 0), sequence, offset))
                used[length] = used.get(length, 0) + times
                offset += length
        sequence += times
    return {n: tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) for n, rows in found.items()}


def packed(docs: DataFrame, path: str | None = None, size: int = SIZE, closing: int = 0) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    rows = pieces(docs, path, size, closing)
    rows = written(rows.withColumns({"row": F.monotonically_increasing_id(), "slice": F.pmod(F.xxhash64("row"), F.lit(SLICES)).cast("int")}), "pieces")
    slices = rows.groupBy("length", "slice").agg(F.count(F.lit(1)).alias("n"))
    counts = [(r["length"], r["slice"], r["n"]) for r in slices.collect()]  # at most size times SLICES rows
    total: dict[int, int] = {}
    base: dict[tuple[int, int], int] = {}
    for length, part, n in sorted(counts):
        base[length, part] = total.get(length, 0)
        total[length] = total.get(length, 0) + n
    places = _places(plan(total, size))
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("length", "slice").orderBy("row")))
    first = np.zeros((size + 1, SLICES), np.int64)
    for (length, part), n in base.items():
        first[length, part] = n

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, part, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "slice", "rank"))
            at = first[length, part] + rank - 1
            sequence, offset = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
            for n in np.unique(length):
                i = np.flatnonzero(length == n)
                ranks, sequences, offsets = places[n]
                k = np.searchsorted(ranks, at[i], "right") - 1
                sequence[i], offset[i] = sequences[k] + at[i] - ranks[k], offsets[k]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    schema = rows.select("doc_id", "piece", "start", "length", "ids_crc32").schema.add("sequence_id", "long").add("offset", "long")
    return rows.mapInArrow(deal, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir))
