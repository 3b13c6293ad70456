"""The exact search against each pair on its own."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.operators import ann, flat, index


def by_pairs(queries, points, k, keys):
    pairs = points.join(F.broadcast(queries), keys) if keys else points.crossJoin(F.broadcast(queries))
    scored = pairs.select("query_id", "point", index.cosine(F.col("q"), F.col("v")).alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "point")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


@pytest.mark.parametrize("keys", [None, ["label"]])
@pytest.mark.parametrize("kind", ["long", "string"])
def test_equals_each_pair_on_its_own(spark, keys, kind, monkeypatch):
    monkeypatch.setattr(flat, "QUERIES", 300)
    rng = np.random.default_rng(3)
    v = rng.normal(size=(700, 7)).astype(np.float32)
    v[100:200] = v[100]  # copies
    v[200:230] = 2 * v[100]
    v[230:250] = v[0] + rng.normal(size=(20, 7)) * 1e-7
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [1.0], [0.0] * 7, [-0.0] * 7, [nan] * 7, [nan, *[1.0] * 6], [None] * 7, [None, *[1.0] * 6], [inf, *[1.0] * 6], [-inf] * 7, [1e-38] * 7, [3e38] * 7, [1.0] * 3, [2.0] * 3] * 3
    vectors = [*v.tolist(), *odd]
    rows = [(i, x, i % 3 if i % 50 else None) for i, x in enumerate(vectors)]
    points = spark.createDataFrame(rows, "point long, v array<float>, label int").withColumn("point", F.col("point").cast(kind)).repartition(3)
    ask = points.where("point % 9 = 0 or point > 695").select(F.col("point").alias("query_id"), F.col("v").alias("q"), "label")
    ask = ask if keys else ask.drop("label")
    told = lambda df: sorted((r["query_id"], r["rank"], r["point"], str(r["score"])) for r in df.collect())
    assert told(index.nearest(ask, points, 12, keys)) == told(by_pairs(ask, points, 12, keys))


def test_scores_few_pairs_one_by_one(spark, monkeypatch):
    """Of 4 million pairs, copies among them, less than a twentieth are scored in double precision."""
    scored = []
    one_by_one = flat.in_order
    monkeypatch.setattr(flat, "in_order", lambda x, y: scored.append(len(x)) or one_by_one(x, y))
    import pyarrow as pa

    x = np.random.default_rng(1).normal(size=(20_000, 16))
    x[:15_000] = x[0]
    column = pa.array(x.tolist(), pa.list_(pa.float64()))
    best = flat.Best(200, 10, pa.int64())
    asked = flat.Asked(np.arange(200), column.take(pa.array(np.arange(14_900, 15_100))))
    for a in range(0, 20_000, 1000):
        asked.search(pa.array(np.arange(a, a + 1000)), column.slice(a, 1000), best)
        best.settle()
    assert sum(scored) < 200_000 and len(best.rows) == 2000
    assert best.rows.filter(pa.compute.equal(best.rows.column("query"), 0)).column("point").to_pylist() == list(range(10))


def test_tasks_keep_the_best_candidates_of_all_cells(spark, monkeypatch):
    """What is written of a query doesn't grow with the cells that it looks into, and queries in blocks find the same."""
    counts = []
    kept = ann.written

    def counted(df, name):
        out = kept(df, name)
        if name == "candidates":
            counts.append(out.count())
        return out

    monkeypatch.setattr(ann, "written", counted)
    v = np.random.default_rng(2).normal(size=(2000, 8))
    points = spark.createDataFrame([(i, x.tolist(), i % 2) for i, x in enumerate(v)], "point long, v array<double>, label int")
    ask = points.where("point % 100 = 0").select(F.col("point").alias("query_id"), F.col("v").alias("q"), "label")
    for keys in (None, ["label"]):
        asked = ask if keys else ask.drop("label")
        found = [(r["query_id"], r["rank"], r["point"], r["score"], r["scanned"]) for r in ann.nearest_approximately(asked, points, 5, keys, probed=1.0).collect()]
        assert len(found) == 100 and sum(counts) <= 20 * (100 + 1) * 4  # queries, candidates and a count of what was read, tasks
        assert {r[4] for r in found} == {1000 if keys else 2000}
        exact = [(r["query_id"], r["rank"], r["point"], r["score"]) for r in index.nearest(asked, points, 5, keys).collect()]
        assert len({r[:4] for r in found} & set(exact)) >= 90
        counts.clear()
        with monkeypatch.context() as m:
            m.setattr(ann, "BLOCK", 7, raising=False)
            again = [(r["query_id"], r["rank"], r["point"], r["score"], r["scanned"]) for r in ann.nearest_approximately(asked, points, 5, keys, probed=1.0).collect()]
        assert sorted(again) == sorted(found)
        counts.clear()
