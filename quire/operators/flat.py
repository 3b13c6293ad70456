"""Exact nearest neighbours by cosine: every query against every point.

Queries go to the points' partitions in blocks of a bounded number of entries. A partition goes through its points batch by batch: a product of
single-precision matrices, with a bound of its error, tells which pairs may be among a query's best, and those are scored in double
precision, summed in order of the entries, as the SQL does. Each partition sends its best k of each query on.

Defined results. A score is null where a vector is null, holds nulls or is of another length than the other, or where a length is zero; NaN where an
entry is. NaN comes first, nulls last, ties go by point. Of points with the same vector only the least k can be among the best.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quire.sources.storage import written

#: Entries of the queries that go to the partitions at once; of the points that are held at once; pairs that are looked at once.
QUERIES, POINTS, PAIRS = 1 << 22, 1 << 20, 1 << 21
#: Lengths that products are made for; vectors of others are scored one by one.
SHORT, LONG = 1e-100, 1e100


def rows_of(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: the rows of vectors without nulls, and these vectors in double precision."""
    if not len(column):
        return {}
    sizes = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    ok = sizes >= 0
    if flat.null_count:
        ok[pc.list_parent_indices(column).to_numpy()[flat.is_null().to_numpy(zero_copy_only=False)]] = False
    entries = flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    ends = np.cumsum(np.maximum(sizes, 0))
    out = {}
    for size in np.unique(sizes[ok]).tolist():
        rows = np.flatnonzero(ok & (sizes == size))
        at = (ends[rows] - size)[:, None] + np.arange(size)
        out[size] = rows, entries.reshape(len(column), size) if len(rows) == len(column) else entries[at]
    return out


def in_order(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sums of products of rows, in order of the entries."""
    total = np.zeros(len(x))
    for j in range(x.shape[1]):
        total += x[:, j] * y[:, j]
    return total


class Vectors:
    """Vectors of one length: x, their norms, and unit, in single precision, where usual says that it can be made."""

    def __init__(self, x: np.ndarray) -> None:
        with np.errstate(all="ignore"):
            self.x, self.norm = x, np.sqrt(in_order(x, x))
            self.nan = np.isnan(x).any(axis=1)
            self.usual = (self.norm > SHORT) & (self.norm < LONG)
            self.unit = np.where(self.usual[:, None], x / self.norm[:, None], 0).astype(np.float32)


def least(points: pa.Array, rows: np.ndarray, k: int) -> np.ndarray:
    """The k rows with the least points."""
    return rows[pc.sort_indices(points.take(pa.array(rows)), null_placement="at_start").to_numpy()[:k]] if len(rows) > k else rows


def without_copies(points: pa.Array, rows: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    """Places in rows of all but those that k rows with the same vector and lesser points are before."""
    x = np.where(np.isnan(x).any(axis=1)[:, None], np.nan, x) + 0.0
    if not x.shape[1]:
        return np.arange(len(rows))[:k]
    _, same, n = np.unique(np.ascontiguousarray(x).view(np.dtype((np.void, x.shape[1] * 8))).ravel(), return_inverse=True, return_counts=True)
    if n.max() <= k:
        return np.arange(len(rows))
    rank = np.empty(len(rows), np.int64)
    rank[pc.sort_indices(points.take(pa.array(rows)), null_placement="at_start").to_numpy()] = np.arange(len(rows))
    order = np.lexsort((rank, same))
    place = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
    return np.sort(order[place < k])


class Best:
    """The best k of each of n queries so far."""

    def __init__(self, n: int, k: int, kind: pa.DataType) -> None:
        self.k = k
        self.rows = pa.table({"query": pa.array([], pa.int64()), "class": pa.array([], pa.int8()), "minus": pa.array([], pa.float64()), "point": pa.array([], kind)})
        self.new: list[pa.Table] = []
        self.floor = np.full(n, -np.inf)  # a score under it is not among them

    def add(self, query: np.ndarray, score: np.ndarray, known: np.ndarray, points: pa.Array, row: np.ndarray) -> None:
        """score: null where not known."""
        if not len(query):
            return
        nan = np.isnan(score)
        kinds = np.where(known, np.where(nan, 0, 1), 2).astype(np.int8)
        minus = np.where(known & ~nan, -score, 0.0)
        self.new.append(pa.table([pa.array(query), pa.array(kinds), pa.array(minus), points.take(pa.array(row))], self.rows.schema.names).cast(self.rows.schema))
        if sum(map(len, self.new)) > max(PAIRS, len(self.rows)):
            self.settle()

    def settle(self) -> None:
        """Only the best k stay."""
        if not self.new:
            return
        rows = pa.concat_tables([self.rows, *self.new])
        self.new = []
        rows = rows.take(pc.sort_indices(rows, sort_keys=[(c, "ascending") for c in rows.schema.names], null_placement="at_start"))
        q = rows.column("query").to_numpy()
        place = np.arange(len(q)) - np.searchsorted(q, q)
        self.rows = rows.filter(pa.array(place < self.k)).combine_chunks()
        last = np.flatnonzero(place == self.k - 1)
        kinds, minus = rows.column("class").to_numpy()[last], rows.column("minus").to_numpy()[last]
        self.floor[q[last]] = np.where(kinds == 0, np.inf, np.where(kinds == 1, -minus, -np.inf))


class Asked:
    """Queries with the same keys."""

    def __init__(self, at: np.ndarray, column: pa.Array) -> None:
        self.at, self.by_size = at, {size: (at[rows], Vectors(x)) for size, (rows, x) in rows_of(column).items()}
        held = [a for a, _ in self.by_size.values()]
        self.none = np.setdiff1d(at, np.concatenate(held) if held else at[:0])

    def search(self, points: pa.Array, column: pa.Array, best: Best) -> None:
        """Puts a batch's points where they belong."""
        k, by_size, every = best.k, rows_of(column), np.arange(len(points))

        def nulls(query: np.ndarray, rows: np.ndarray) -> None:
            rows = least(points, rows, k)
            best.add(np.repeat(query, len(rows)), np.zeros(len(query) * len(rows)), np.zeros(len(query) * len(rows), bool), points, np.tile(rows, len(query)))

        nulls(self.none, every)
        for size, (query, q) in self.by_size.items():
            rows, x = by_size.get(size, (every[:0], np.zeros((0, size))))
            nulls(query, np.setdiff1d(every, rows))
            if not len(rows):
                continue
            kept = without_copies(points, rows, x, k)
            rows, v = rows[kept], Vectors(x[kept])

            def exact(i: np.ndarray, j: np.ndarray, query=query, q=q, rows=rows, v=v) -> None:
                step = max(1, PAIRS // max(1, q.x.shape[1]))
                for a in range(0, len(i), step):
                    s, t = i[a : a + step], j[a : a + step]
                    with np.errstate(all="ignore"):
                        below = q.norm[s] * v.norm[t]
                        score = in_order(q.x[s], v.x[t]) / below
                    best.add(query[s], np.where(below == 0, 0, score), below != 0, points, rows[t])

            def pairs(some: np.ndarray, others: np.ndarray, exact=exact) -> None:
                exact(np.repeat(some, len(others)), np.tile(others, len(some)))

            # a query with a NaN is at NaN from every point: of these the least are the best
            few = np.flatnonzero(np.isin(rows, least(points, rows, k)))
            pairs(np.flatnonzero(q.nan), few)
            pairs(np.flatnonzero(~q.usual & ~q.nan), np.arange(len(rows)))
            usual, plain = np.flatnonzero(q.usual), np.flatnonzero(v.usual)
            pairs(usual, np.flatnonzero(~v.usual))
            if not len(plain):
                continue
            wrong, units, step = (size + 8) * 2.0**-23, v.unit[plain].T.copy(), max(1, PAIRS // len(plain))
            for a in range(0, len(usual), step):
                some = usual[a : a + step]
                near = q.unit[some] @ units
                floor = best.floor[query[some]]
                if len(plain) > k and (floor == -np.inf).any():
                    floor = np.maximum(floor, np.partition(near, len(plain) - k, axis=1)[:, len(plain) - k] - wrong)
                i, j = np.nonzero(near >= (floor - wrong)[:, None])
                exact(some[i], plain[j])


def grouped(batch: pa.RecordBatch | pa.Table, keys: list[str]) -> dict[tuple, np.ndarray]:
    """Rows by their keys, without those that have a null."""
    if not keys:
        return {(): np.arange(batch.num_rows)}
    out: dict[tuple, list[int]] = {}
    for i, key in enumerate(zip(*(batch.column(c).to_pylist() for c in keys), strict=True)):
        if None not in key:
            out.setdefault(key, []).append(i)
    return {key: np.array(rows) for key, rows in out.items()}


def nearest(queries: DataFrame, points: DataFrame, k: int, keys: list[str] | None = None) -> DataFrame:
    """Exact top k by cosine: queries (query_id, q) and points (point, v), equal in keys if any are given -> (query_id, point, score, rank). The
    driver holds one block of queries at a time."""
    keys = keys or []
    queries = written(queries.select("query_id", *keys, "q"), "queries")
    entries = queries.agg(F.sum(F.coalesce(F.size("q"), F.lit(0)) + 1)).first()[0] or 0
    blocks = max(1, -(-entries // QUERIES))
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    found = None
    for i in range(blocks):
        some = written(_best(queries.where(block == i), points.select("point", *keys, "v"), k, keys), "nearest")
        found = some if found is None else found.unionByName(some)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "point")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _best(queries: DataFrame, points: DataFrame, k: int, keys: list[str]) -> DataFrame:
    """A partition's best k of each query."""
    asked = queries.toArrow().combine_chunks()
    of = lambda c: asked.column(c).combine_chunks() if len(asked) else pa.array([], asked.schema.field(c).type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q = of("query_id"), of("q")
        groups = {key: Asked(rows, q.take(pa.array(rows))) for key, rows in grouped(asked, keys).items()}
        best = None
        for whole in batches:
            best = best or Best(len(ids), k, whole.column("point").type)
            step = max(1, POINTS * whole.num_rows // max(1, len(whole.column("v").flatten()), whole.num_rows))
            for a in range(0, whole.num_rows, step):
                batch = whole.slice(a, step)
                for key, rows in grouped(batch, keys).items():
                    if key in groups:
                        part = batch if len(rows) == batch.num_rows else batch.take(pa.array(rows))
                        groups[key].search(part.column("point"), part.column("v"), best)
                best.settle()
        if best is not None:
            rows = best.rows.combine_chunks()
            kinds, minus = rows.column("class").to_numpy(), rows.column("minus").to_numpy()
            score = pa.array(np.where(kinds == 0, np.nan, -minus), mask=kinds == 2)
            for batch in pa.table([ids.take(rows.column("query")), rows.column("point"), score], ["query_id", "point", "score"]).combine_chunks().to_batches(10_000):
                yield batch

    shape = T.StructType([queries.schema["query_id"], points.schema["point"], T.StructField("score", T.DoubleType())])
    return points.mapInArrow(run, shape)
