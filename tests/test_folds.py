"""Bucketed folds against the plain pass over rows, with buckets of a few rows."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.operators import folds


def buckets(fold, rows, order, width):
    """The fold over buckets, without Spark."""
    state, out = None, []
    for b in sorted({r[order] // width for r in rows}):
        part = pa.Table.from_pylist([r | {"_b": b} for r in rows if r[order] // width == b])
        out += fold.chosen(part, state, b).to_pylist()
        state = fold.after(state, fold.effect(part), b)
    return out


@pytest.mark.parametrize("width", [1, 3, 16, 1000])
def test_levels(width):
    rng = random.Random(width)
    for _ in range(60):
        rows = [{"i": i, "mask": sum(1 << x for x in rng.sample(range(1, 6), rng.choice([1, 1, 2, 3])))} for i in sorted(rng.sample(range(200), rng.randrange(1, 80)))]
        now, expected = 0, []
        for r in rows:
            levels = [x for x in range(6) if r["mask"] >> x & 1]
            now = next((x for x in levels if x > now), levels[0])
            expected.append(now)
        assert [r["level"] for r in buckets(folds.Levels(5), rows, "i", width)] == expected


@pytest.mark.parametrize("width", [1, 3, 16, 1000])
def test_gaps(width, monkeypatch):
    monkeypatch.setattr(folds, "BUCKET", width)
    rng = random.Random(width)
    for _ in range(100):
        gap = rng.choice([1, 2, 5, 20, 90])
        rows = [{"line_number": i, "gap": gap} for i in sorted(rng.choices(range(300), k=rng.randrange(1, 120)))]
        last, expected = None, []
        for r in rows:
            if last is None or r["line_number"] - last >= gap:
                last = r["line_number"]
                expected.append(last)
        assert [r["line_number"] for r in buckets(folds.Gaps(), rows, "line_number", width)] == expected


@pytest.mark.parametrize("width", [1, 3, 16, 1000])
def test_runs(width):
    rng = random.Random(width)
    for _ in range(200):
        least, most = rng.choice([(1, 1), (5, 20), (20, 30), (20, 12), (3, 100)])
        rows, label = [], "a"
        for i in range(rng.randrange(1, 60)):
            label = rng.choice("ab") if rng.random() < 0.2 else label
            rows.append({"i": i, "label": label, "n": rng.choice([0, 1, 2, 3, least, most, most + 1, rng.randrange(25)])})
        held, expected = None, []
        for r in rows:
            joins = held is not None and held[0] < least and held[1] == r["label"] and held[0] + r["n"] <= most
            held = (held[0] + r["n"] if joins else r["n"], r["label"])
            expected.append(0 if joins else 1)
        assert [r["begins"] for r in buckets(folds.Runs(least, most), rows, "i", width)] == expected


def test_folded_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(folds, "BUCKET", 16)
    rng = random.Random(7)
    rows = [(m, i, 7) for m in ("a", "b", None) for i in sorted(rng.sample(range(2000), 400))]
    df = spark.createDataFrame(rows, "m string, line_number long, gap long").repartition(6)
    got = {(r["m"], r["line_number"]) for r in folds.folded(df, ["m"], ["line_number"], folds.Gaps(), df.schema).collect()}
    expected, last = set(), {}
    for m, i, gap in rows:
        if m not in last or i - last[m] >= gap:
            last[m] = i
            expected.add((m, i))
    assert got == expected
    sums = folds.running(df, ["m"], ["line_number"], {"n": ("sum", F.lit(1)), "low": ("min", F.col("line_number")), "top": ("max", F.struct("line_number", "gap"))})
    by = {(r["m"], r["line_number"]): (r["n"], r["low"], r["top"] and r["top"]["line_number"]) for r in sums.collect()}
    for m in ("a", "b", None):
        own = [i for x, i, _ in rows if x == m]
        assert all(by[m, i] == (k, own[0] if k else None, own[k - 1] if k else None) for k, i in enumerate(own))
