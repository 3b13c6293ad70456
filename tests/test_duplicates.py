"""Near-duplicates: every link whatever order the counters give, and no sets dealt out."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.functions import text
from quire.operators import checks

SHAPE = "manual_id string, chunk_ord int, chunk_id string, text string"


def made(n):
    rng, out = random.Random(5), []
    for i in range(n):
        words = [f"w{min(rng.randrange(400), rng.randrange(400))}" for _ in range(60)] if i % 3 == 0 or not out else out[-1][3].split()
        if i % 3 == 1:
            words = [*words[:-1], "x" if i % 2 else words[-1]]
        out.append(("mn"[i % 7 == 0], i, f"c{i}", " ".join(words)))
    return out


def expected(rows):
    sets, first = {}, {}
    for m, i, _, t in rows:
        first.setdefault((m, len(t.split()), frozenset(t.split())), i)
        sets[i] = m, t.split(), frozenset(t.split())
    rep = {i: first[m, len(w), s] for i, (m, w, s) in sets.items()}
    links = {(rep[i], i): 1.0 for i in sets if rep[i] != i}
    heads = sorted(set(rep.values()))
    for a in heads:
        for b in (b for b in heads if b > a and sets[b][0] == sets[a][0]):
            (_, wa, sa), (_, wb, sb) = sets[a], sets[b]
            sim = len(sa & sb) / len(sa | sb)
            if sim >= 0.95 and min(len(wa), len(wb)) >= 0.95 * max(len(wa), len(wb)):
                links[a, b] = sim
    return links


@pytest.mark.parametrize("counters", [1, 8, 1 << 21])
def test_links_do_not_depend_on_the_counters(spark, monkeypatch, counters):
    monkeypatch.setattr(checks, "COUNTERS", counters)
    rows = made(120)
    got = {(r["oa"], r["ob"]): r["sim"] for r in checks.duplicate_pairs(spark.createDataFrame(rows, SHAPE)).collect()}
    assert got == pytest.approx(expected(rows)) and 0 < sum(s < 1 for s in got.values())


def test_sets_are_not_dealt_out(spark):
    sets = checks.token_sets(spark.createDataFrame(made(30), SHAPE))
    prefix = checks.set_prefixes(sets, checks.token_counts(sets), 0.95)
    assert "Exchange" not in prefix._jdf.queryExecution().executedPlan().toString()
    rows = prefix.collect()
    assert {r["w"] for r in rows} and max(r["r"] for r in rows) <= 4


def test_words_are_pythons(spark):
    white = [chr(i) for i in range(0x3001) if chr(i).isspace()]
    texts = ["", None, *white, *(f"{a}x{a}{b}é{b}" for a, b in zip(white, reversed(white), strict=True)), "a" * 5_000_000 + " b", "c"]
    words, ends = text.split_words(pa.array(texts))
    assert [words.slice(a, b - a).to_pylist() for a, b in zip(ends, ends[1:])] == [(t or "").split() for t in texts]
    assert np.concatenate([p.column("t").to_pylist() for p in text.slices(pa.RecordBatch.from_arrays([pa.array(texts)], ["t"]), "t")]).tolist() == texts
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", text.word_counts(F.col("t")).alias("n")).where("n > 0 or n = 0 or n is null").collect()
    assert all(r["n"] == (None if r["t"] is None else len(r["t"].split())) for r in rows)


def test_pairs_with_few_first_tokens_in_common_are_not_compared(spark, monkeypatch):
    rng = random.Random(3)
    base = [f"c{i}" for i in range(400)]
    rows = [("m", i, f"c{i}", " ".join([f"rare{i // 2}", *(f"u{i}_{j}" for j in range(10)), *rng.sample(base, 340)])) for i in range(40)]
    rows += [("m", 40 + i, f"c{40 + i}", " ".join([*rows[i][3].split()[:-(i + 1)], *(f"x{j}" for j in range(i + 1))])) for i in range(15)]
    compared, write = [], checks.written

    def told(df, name, *rest):
        out = write(df, name, *rest)
        if name == "set-pairs":
            compared.append(out.count())
        return out

    monkeypatch.setattr(checks, "written", told)
    got = {(r["oa"], r["ob"]): r["sim"] for r in checks.duplicate_pairs(spark.createDataFrame(rows, SHAPE)).collect()}
    assert got == pytest.approx(expected(rows)) and len(got) >= 9
    assert len(got) <= compared[0] <= 2 * len(got)


@pytest.mark.parametrize("counters", [1, 8, 1 << 21])
def test_counters_are_dealt_out_packed(spark, monkeypatch, counters):
    monkeypatch.setattr(checks, "COUNTERS", counters)
    sets = checks.token_sets(spark.createDataFrame(made(60), SHAPE).repartition(3))
    counts, seen, write = checks.token_counts(sets), [], checks.written
    rows = sets.select(F.xxhash64("manual_id").alias("seed"), "set").collect()
    want = np.zeros(counters, np.int64)
    np.add.at(want, [(w ^ r["seed"]) & (counters - 1) for r in rows for w in r["set"]], 1)
    assert counts.dtype == np.int64 and (counts == want).all() and counts.sum() == sum(len(r["set"]) for r in rows)
    monkeypatch.setattr(checks, "written", lambda df, name, *rest: (seen.append(name), write(df, name, *rest))[1])
    checks.token_counts(sets)
    assert seen == ["token-counts"]  # no shuffle files stay
    packed = checks.packed_counts(sets)
    assert packed.count() <= packed.rdd.getNumPartitions() * checks.STRETCHES
    assert (checks.token_counts(sets.limit(0)) == 0).all()
