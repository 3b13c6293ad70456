"""Approximate nearest neighbours by cosine: an inverted file with product-quantised codes.

Centres of cells and code books are fitted on a bounded sample of the vectors, on the driver; every vector is then given its cell and a code
of a byte for each part. Codes are dealt out evenly over tasks of about SHARD, and queries go to them in blocks. A query looks into the cells
nearest to it and scores their codes, cell by cell, as products with what the codes stand for; a task keeps its best candidates only, whatever
number of cells they are from. A query's best candidates of all tasks are scored exactly from their vectors. ``index.nearest`` is the exact search.

Defined results. Vectors that are null, empty, of another length than the sample's most frequent, of length zero, or hold nulls or
non-finite entries are in no cell, and queries like them find nothing. Ties go by point. No points or no queries: no rows. Each point is
found at most once a query; repeated ids of points are candidates of their own and repeated in the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quire.operators.flat import PAIRS, Best, grouped, rows_of
from quire.operators.index import cosine
from quire.sources.storage import written

#: Vectors that centres and code books are fitted on, at most; cells at most; entries of a code book; vectors of a task, about.
SAMPLE, CELLS, BOOK, SHARD = 20_000, 1024, 256, 65_536
#: The most queries that go to the tasks at once.
BLOCK = 4096
#: Dimensions of a part, about; share of cells that a query looks into; candidates scored exactly, for each result wanted.
PART, PROBED, WIDER = 4, 0.65, 20


@dataclass(frozen=True)
class Quantizer:
    centres: np.ndarray  # cells, dimensions
    books: np.ndarray  # parts, entries, dimensions of a part, padded by zeros

    @property
    def size(self) -> int:
        return self.centres.shape[1]

    def parts(self, x: np.ndarray) -> np.ndarray:
        """Vectors as their parts."""
        m, _, d = self.books.shape
        return np.pad(x, ((0, 0), (0, m * d - self.size))).reshape(len(x), m, d)

    def encoded(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cells and codes of unit vectors."""
        cell = nearest(x, self.centres)
        rest = self.parts(x - self.centres[cell])
        return cell, np.stack([nearest(rest[:, j], book) for j, book in enumerate(self.books)], axis=1).astype(np.uint8)

    def decoded(self, cell: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The vectors that codes stand for."""
        rest = np.concatenate([book[code[:, j]] for j, book in enumerate(self.books)], axis=1)
        return (self.centres[cell] + rest[:, : self.size]).astype(np.float32)


def nearest(x: np.ndarray, centres: np.ndarray, block: int = 8192) -> np.ndarray:
    half = (centres**2).sum(axis=1) / 2
    return np.concatenate([np.zeros(0, np.int64), *((x[i : i + block] @ centres.T - half).argmax(axis=1) for i in range(0, len(x), block))])


def means(x: np.ndarray, k: int, rounds: int = 12, seed: int = 0) -> np.ndarray:
    """k centres of x by Lloyd's rounds; a centre that nothing is near stays."""
    centres = x[np.random.default_rng(seed).permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        at = nearest(x, centres)
        order = np.argsort(at, kind="stable")
        first = np.flatnonzero(np.diff(at[order], prepend=-1))
        counts = np.diff([*first, len(x)])
        centres[at[order[first]]] = np.add.reduceat(x[order], first, axis=0) / counts[:, None]
    return centres


def unit(column: pa.Array, size: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Usable vectors at length 1, and their rows. size: of a vector; none: the most frequent one."""
    found = {n: r for n, r in rows_of(column).items() if n}
    if size is None:
        size = max(found, key=lambda n: (len(found[n][0]), -n), default=0)
    rows, x = found.get(size, (np.zeros(0, np.int64), np.zeros((0, size))))
    norm = np.sqrt((x**2).sum(axis=1))
    ok = np.isfinite(norm) & (norm > 0)
    return (x[ok] / norm[ok, None]).astype(np.float32), rows[ok]


def fitted(points: DataFrame, cells: int | None = None, sample: int = SAMPLE) -> Quantizer | None:
    """Centres and code books; none if no vector is usable. The sample is the least by a hash of the point. cells: about the root of the number
    of vectors if not given, at most a sixteenth of the sample."""
    n = points.count()
    rows = points.orderBy(F.xxhash64("point"), "point").limit(sample).select("v").toArrow()
    x, _ = unit(rows.column("v").combine_chunks())
    if not len(x):
        return None
    centres = means(x, max(1, min(cells or int(n**0.5), CELLS, len(x) // 16)))
    rest, d = x - centres[nearest(x, centres)], min(PART, x.shape[1])
    m = -(-x.shape[1] // d)
    parts = np.pad(rest, ((0, 0), (0, m * d - x.shape[1]))).reshape(len(x), m, d)
    return Quantizer(centres, np.stack([means(parts[:, j], min(BOOK, len(x)), seed=j) for j in range(m)]))


def encoded(points: DataFrame, of: Quantizer, keys: list[str] | None = None) -> DataFrame:
    """points (point, v, keys) -> a written table (point, keys, cell, code)."""
    keep = ["point", *(keys or [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, rows = unit(batch.column("v"), of.size)
            cell, code = of.encoded(x)
            others = batch.select(keep).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*others.columns, pa.array(cell.astype(np.int32)), pa.array([c.tobytes() for c in code], pa.binary())], [*keep, "cell", "code"])

    schema = T.StructType([*points.select(*keep).schema, T.StructField("cell", T.IntegerType()), T.StructField("code", T.BinaryType())])
    return written(points.select(*keep, "v").mapInArrow(run, schema), "codes")


def nearest_approximately(queries: DataFrame, points: DataFrame, k: int, keys: list[str] | None = None, probed: float = PROBED, wider: int = WIDER, of: Quantizer | None = None) -> DataFrame:
    """queries (query_id, q) and points (point, v), equal in keys if any are given -> (query_id, point, score, rank, scanned): scores are exact,
    scanned is how many codes the query read."""
    keys = keys or []
    of = of or fitted(points)
    if of is None:
        plain = (T.StructField("score", T.DoubleType()), T.StructField("rank", T.IntegerType()), T.StructField("scanned", T.LongType()))
        return queries.sparkSession.createDataFrame([], T.StructType([*queries.select("query_id").schema, *points.select("point").schema, *plain]))
    codes = encoded(points, of, keys)
    probes, best = max(1, round(probed * len(of.centres))), k * wider
    n = codes.count()
    parts = max(-(-n // SHARD), min(queries.sparkSession.sparkContext.defaultParallelism, -(-16 * n // SHARD)), 1)
    queries = written(queries.select("query_id", *keys, "q"), "queries")
    blocks = max(1, -(-queries.count() // BLOCK))
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    found = None
    for i in range(blocks):
        some = written(_candidates(queries.where(block == i), codes.select("point", *keys, "cell", "code").repartition(parts), best, probes, keys, of), "candidates")
        found = some if found is None else found.unionByName(some)
    scanned = found.where("read is not null").groupBy("query_id").agg(F.sum("read").alias("scanned"))
    order = Window.partitionBy("query_id").orderBy(F.desc("near"), "point")
    near = found.where("read is null").withColumn("r", F.row_number().over(order)).where(F.col("r") <= best).select("query_id", "point")
    exact = near.join(points.select("point", "v"), "point").join(queries.select("query_id", "q"), "query_id").select("query_id", "point", cosine(F.col("q"), F.col("v")).alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "point")).cast("int")
    return exact.withColumn("rank", rank).where(F.col("rank") <= k).join(scanned, "query_id")


def _candidates(queries: DataFrame, codes: DataFrame, k: int, probes: int, keys: list[str], of: Quantizer) -> DataFrame:
    """(query_id, point, near, read): a task's best k candidates of each query, and a row without a point for how many codes the query read."""
    asked = queries.toArrow()
    ids, column = asked.column("query_id").combine_chunks(), asked.column("q").combine_chunks()
    shape = T.StructType([queries.schema["query_id"], codes.schema["point"], T.StructField("near", T.DoubleType()), T.StructField("read", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)  # about SHARD codes
        held = pa.Table.from_batches(batches).combine_chunks() if batches else None
        q, rows = unit(column, of.size)
        if held is None or not len(held) or not len(q):
            return
        near = np.concatenate([np.argpartition(-(q[a : a + 256] @ of.centres.T), probes - 1, axis=1)[:, :probes] for a in range(0, len(q), 256)])
        looks = np.zeros((len(q), len(of.centres)), bool)
        np.put_along_axis(looks, near, True, axis=1)
        code = np.frombuffer(b"".join(held.column("code").to_pylist()), np.uint8).reshape(len(held), -1)
        cell, points = held.column("cell").to_numpy(), held.column("point").combine_chunks()
        kept, read = Best(len(q), k, points.type), np.zeros(len(q), np.int64)
        by_key = grouped(asked.take(pa.array(rows)), keys)
        for key, own in grouped(held, keys).items():
            if key not in by_key:
                continue
            own = own[np.argsort(cell[own], kind="stable")]
            for some in np.split(own, np.flatnonzero(np.diff(cell[own])) + 1):
                there = by_key[key][looks[by_key[key], cell[some[0]]]]
                read[there] += len(some)
                step = max(1, PAIRS // max(len(there), 1))
                for a in range(0, len(some) if len(there) else 0, step):
                    part = some[a : a + step]
                    score = q[there] @ of.decoded(cell[part], code[part]).T
                    floor = np.nextafter(kept.floor[there], np.inf)  # of codes as near as the last that is kept, none has to be
                    if len(part) > k and (kept.floor[there] == -np.inf).any():
                        floor = np.maximum(floor, np.partition(score, len(part) - k, axis=1)[:, len(part) - k])
                    i, j = np.nonzero(score >= floor[:, None])
                    kept.add(there[i], score[i, j].astype(np.float64), np.ones(len(i), bool), points, part[j])
        kept.settle()
        names, seen = [f.name for f in shape], np.flatnonzero(read)
        hits = kept.rows
        hits = pa.table([ids.take(pa.array(rows[hits.column("query").to_numpy()])), hits.column("point"), pa.array(-hits.column("minus").to_numpy()), pa.nulls(len(hits), pa.int64())], names)
        counts = pa.table([ids.take(pa.array(rows[seen])), pa.nulls(len(seen), points.type), pa.nulls(len(seen), pa.float64()), pa.array(read[seen])], names)
        yield from pa.concat_tables([hits, counts]).to_batches(10_000)

    return codes.mapInArrow(run, shape)
