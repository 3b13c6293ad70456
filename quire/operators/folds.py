"""What depends on earlier rows, without a task for each manual.

Rows of a manual are cut into buckets of their order. Running totals are made inside buckets and over buckets. Choices that carry a state
from row to row are made in three steps: each bucket finds what it would do to any state that may reach it (its effect, small), the effects
are put one after another (one row a bucket), and each bucket is gone through again from the state that does reach it. Buckets are worked
on as columns, by composing functions and following pointers in doubling steps, not row by row. A null manual is a manual of its own.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quire.sources.storage import written

#: Rows of a bucket of the order, or its width where the order has gaps.
BUCKET = 4096


def same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    """Equal keys, null with null."""
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])


def matched(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """left joined with right on keys, null with null; keys are left's, and both may come of one table."""
    other = right.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return left.join(other, on, how).drop(*[f"_k_{k}" for k in keys])


#: How totals of two stretches of rows are put together.
_JOIN = {"sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)), "max": F.greatest, "min": F.least}


def running(df: DataFrame, keys: list[str], order: list[str], totals: dict[str, tuple[str, Column]]) -> DataFrame:
    """df, a written narrow table, with totals over all earlier rows of a group, each a name with its kind (sum, max or min) and value; 0
    for a sum and null otherwise where there are none. order: a whole number, then what tells rows with the same number apart."""
    kinds = {n: getattr(F, kind) for n, (kind, _) in totals.items()}
    df = df.withColumns({"_b": F.floor(F.col(order[0]) / BUCKET), **{f"_v_{n}": v for n, (_, v) in totals.items()}})
    earlier = lambda *parts: Window.partitionBy(*keys, *parts).rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(*keys, "_b").agg(*[total(f"_v_{n}").alias(f"_s_{n}") for n, total in kinds.items()])
    over = earlier().orderBy("_b")
    sums = sums.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_b").alias("_bucket"), *[total(f"_s_{n}").over(over).alias(f"_before_{n}") for n, total in kinds.items()])
    inside = df.withColumns({f"_in_{n}": total(f"_v_{n}").over(earlier("_b").orderBy(*order)) for n, total in kinds.items()})
    on = reduce(lambda x, y: x & y, [inside[k].eqNullSafe(sums[f"_k_{k}"]) for k in keys], inside["_b"].eqNullSafe(sums["_bucket"]))
    made = [_JOIN[kind](F.col(f"_before_{n}"), F.col(f"_in_{n}")).alias(n) for n, (kind, _) in totals.items()]
    return inside.join(sums, on).select(*[inside[c] for c in df.columns if c != "_b" and not c.startswith("_v_")], *made)


def before(df: DataFrame, keys: list[str], order: str, value: str, name: str, total: Callable[[Column | str], Column] = F.sum) -> DataFrame:
    """``running`` for one total."""
    return running(df, keys, [order], {name: ("sum" if total is F.sum else "max", F.col(value))})


class Fold:
    """A choice that carries a state. States are what JSON can hold; None is that before the first row."""

    def effect(self, rows: pa.Table) -> bytes:
        """What a bucket, its rows in order, does to any state."""
        raise NotImplementedError

    def after(self, state: Any, effect: bytes, bucket: int) -> Any:
        """The state after the bucket."""
        raise NotImplementedError

    def chosen(self, rows: pa.Table, state: Any, bucket: int) -> pa.Table:
        """What comes of the rows of a bucket that state reaches."""
        raise NotImplementedError


def folded(df: DataFrame, keys: list[str], order: list[str], fold: Fold, schema: T.StructType) -> DataFrame:
    """df, a written narrow table, gone through in order in each group; a bucket is a stretch of BUCKET of the first of order."""
    sort = [(o, "ascending") for o in order]
    df = df.withColumn("_b", F.floor(F.col(order[0]) / BUCKET))
    at = df.select(*keys, "_b").schema

    def effects(rows: pa.Table) -> pa.Table:
        return rows.select([f.name for f in at])[:1].append_column("effect", pa.array([fold.effect(rows.sort_by(sort))], pa.binary()))

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, last = None, None
        for batch in batches:
            out = []
            *groups, buckets, codes = (c.to_pylist() for c in batch.columns)
            for *group, bucket, code in zip(*groups, buckets, codes, strict=True):
                if group != last:
                    state, last = None, group
                out.append(json.dumps(state))
                state = fold.after(state, code, bucket)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.string())], [*batch.schema.names[:-1], "state"])

    def choose(rows: pa.Table, state: pa.Table) -> pa.Table:
        out = fold.chosen(rows.sort_by(sort), json.loads(state.column("state")[0].as_py()), rows.column("_b")[0].as_py())
        return out.select(schema.fieldNames())

    found = df.groupBy(*keys, "_b").applyInArrow(effects, T.StructType([*at, T.StructField("effect", T.BinaryType())]))
    reached = found.repartition(*keys).sortWithinPartitions(*keys, "_b").mapInArrow(states, T.StructType([*at, T.StructField("state", T.StringType())]))
    return df.groupBy(*keys, "_b").cogroup(written(reached, "states").groupBy(*keys, "_b")).applyInArrow(choose, schema)


def orbit(start: int, after: np.ndarray) -> np.ndarray:
    """Which of n places are met from start on by following after, whose places lie behind one another; n is the end."""
    n = len(after)
    met, jump = np.zeros(n + 1, bool), np.append(after, n)
    met[start] = True
    while True:
        met[jump[met]] = True
        if (jump[:n] == n).all():
            return met[:n]
        jump = jump[jump]


def ends(after: np.ndarray) -> np.ndarray:
    """The last place met from each."""
    n = len(after)
    to = np.where(after < n, after, np.arange(n))
    while (to[to] != to).any():
        to = to[to]
    return to


class Levels(Fold):
    """Rows with mask, a bit for each level that may be taken: the least level beyond the present one, else the least; it is the present
    level from there on, and column level. A row is a function of levels; a bucket's effect is that of its rows one after another."""

    def __init__(self, most: int) -> None:
        self.most = most

    def table(self, rows: pa.Table) -> np.ndarray:
        mask = rows.column("mask").to_numpy()[:, None]
        deeper = mask & ~((np.int64(2) << np.arange(self.most + 1)) - 1)
        left = np.where(deeper != 0, deeper, mask)
        return np.log2((left & -left).astype(np.float64)).astype(np.uint8)

    def effect(self, rows: pa.Table) -> bytes:
        f = self.table(rows)
        while len(f) > 1:
            if len(f) % 2:
                f = np.vstack([np.arange(self.most + 1, dtype=np.uint8)[None], f])
            f = np.take_along_axis(f[1::2], f[0::2].astype(np.int64), axis=1)
        return f[0].tobytes()

    def after(self, state: int | None, effect: bytes, bucket: int) -> int:
        return effect[state or 0]

    def chosen(self, rows: pa.Table, state: int | None, bucket: int) -> pa.Table:
        f, step = self.table(rows), 1
        while step < len(f):
            f[step:] = np.take_along_axis(f[step:], f[:-step].astype(np.int64), axis=1)
            step *= 2
        return rows.append_column("level", pa.array(f[:, state or 0].astype(np.int32)))


class Gaps(Fold):
    """Rows with line_number and gap, the same for all of a group: a row stays if it is at least gap behind the last that stayed. The
    effect: the last to stay, for each line from which on one may stay; -1 if none does."""

    def __init__(self) -> None:
        self.width = BUCKET

    def after_each(self, rows: pa.Table) -> tuple[np.ndarray, np.ndarray, int]:
        line, gap = rows.column("line_number").to_numpy(), rows.column("gap")[0].as_py()
        return line, np.searchsorted(line, line + gap), gap

    def effect(self, rows: pa.Table) -> bytes:
        line, after, gap = self.after_each(rows)
        first = np.searchsorted(line, rows.column("_b")[0].as_py() * self.width + np.arange(gap))
        return np.where(first < len(line), np.append(line[ends(after)], -1)[first], -1).tobytes()

    def after(self, state: int | None, effect: bytes, bucket: int) -> int | None:
        lasts = np.frombuffer(effect, np.int64)
        last = int(lasts[0 if state is None else max(0, state + len(lasts) - bucket * self.width)])
        return state if last < 0 else last

    def chosen(self, rows: pa.Table, state: int | None, bucket: int) -> pa.Table:
        line, after, gap = self.after_each(rows)
        return rows.filter(pa.array(orbit(0 if state is None else int(np.searchsorted(line, state + gap)), after)))


class Runs(Fold):
    """Rows with a label and a size n: a row joins the run before it if that run's size is under least, its label the same, and both
    together are at most most; begins tells where runs begin. A state is the open run's size, at most least, and its label."""

    def __init__(self, least: int, most: int) -> None:
        self.least, self.most = least, most

    def bounds(self, rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sizes up to each row, the end of each row's label, and the beginning of the run behind one that begins at a row."""
        total = np.concatenate([[0], np.cumsum(rows.column("n").to_numpy())])
        label = rows.column("label").to_numpy(zero_copy_only=False)
        n = len(label)
        stops = np.append(np.flatnonzero(label[1:] != label[:-1]) + 1, n)
        end = stops[np.searchsorted(stops, np.arange(n), "right")]
        return total, end, np.minimum(self._reach(total, total[:-1], np.arange(n) + 1), end)

    def _reach(self, total: np.ndarray, origin: np.ndarray | int, least: np.ndarray | int) -> np.ndarray:
        """The row before which runs from an origin of sizes end, if labels don't end them before: behind the row that fills
        them, or before one that doesn't fit; at least least."""
        full = np.searchsorted(total, origin + self.least)
        over = np.searchsorted(total, origin + self.most, "right") - 1
        return np.minimum(full, np.maximum(over, least))

    def _open(self, total: np.ndarray, end: np.ndarray, held: np.ndarray) -> np.ndarray:
        """The first row that doesn't join an open run of a size and the first row's label."""
        return np.where(held < self.least, np.minimum(np.minimum(self._reach(total, -held, 0), end[0]), len(end)), 0)

    def effect(self, rows: pa.Table) -> bytes:
        total, end, after = self.bounds(rows)
        held = np.arange(self.least + 1)
        first = self._open(total, end, held)
        n = len(end)
        last = ends(after)[np.minimum(first, n - 1)]
        size = np.where(first < n, total[n] - total[last], held + total[n])
        label = rows.column("label")
        return json.dumps({"first": label[0].as_py(), "last": label[n - 1].as_py(), "size": np.minimum(size, self.least).tolist()}).encode()

    def after(self, state: list | None, effect: bytes, bucket: int) -> list:
        e = json.loads(effect)
        held = state[0] if state and state[1] == e["first"] else self.least
        return [e["size"][held], e["last"]]

    def chosen(self, rows: pa.Table, state: list | None, bucket: int) -> pa.Table:
        total, end, after = self.bounds(rows)
        held = state[0] if state and state[1] == rows.column("label")[0].as_py() else self.least
        first = int(self._open(total, end, np.array([held]))[0])
        return rows.append_column("begins", pa.array(orbit(first, after).astype(np.int64)))
