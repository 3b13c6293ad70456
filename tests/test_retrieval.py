"""The index and retrieval from question to results."""

from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.operators import ann, index, retrieval
from quire.sources import snapshots, tables

META = "manual_id string, level1_id string, procedure_name string, hierarchical_header string, vehicle_models array<string>, figure_references array<string>, cross_references array<string>, has_safety_callouts array<string>, parent_chunk_id string, sibling_chunk_ids array<string>"
SHAPE = f"manual_id string, chunk_ord int, chunk_id string, text string, metadata struct<{META.replace(' string', ': string').replace(' array', ': array')}>"


def chunk(n, text, refs=(), parent=None, siblings=(), safe=(), manual="m"):
    name = f"{manual}::{n}"
    return manual, n, name, text, (manual, str(n), f"name {n}", "h", ["CJ-5"], ["B-1"], list(refs), list(safe), parent, list(siblings))


CHUNKS = [
    chunk(1, "brake pads wear", ["m::8"], "m::p", ["m::2", "m::5"], ["warning"]), chunk(2, "engine oil level"), chunk(3, "brake pads new", ["m::8"]),
    chunk(4, "other words entirely", ["m::8"]), chunk(5, "nothing"), chunk(6, "brake pads elsewhere", manual="n"),
]


def ask(spark, path, **options):
    queries = spark.createDataFrame([("q", "brake pads wear on a CJ-5"), ("none", "")], "query_id string, query string")
    return {r["query_id"]: r for r in retrieval.retrieve(queries, path, **options).collect()}


def test_retrieve(spark, tmp_path):
    path = str(tmp_path / "index")
    assert index.build(spark.createDataFrame(CHUNKS, SHAPE), path) == len(CHUNKS)
    r = ask(spark, path, top_k=2)["q"]
    assert r["vehicle_scope"] == ["CJ-5"] and r["system_scope"] == ["brake"] and r["has_safety_warnings"] and r["multi_manual"] and r["retrieval_warnings"] == []
    assert [(x["chunk_id"], x["source"]) for x in r["results"]][0] == ("m::1", "primary") and len(r["results"]) == 2
    r = ask(spark, path, top_k=5)["q"]
    assert r["results"][0]["text"] == "brake pads wear" and r["results"][0]["metadata"]["procedure_name"] == "name 1"
    scores = [x["score"] for x in r["results"]]
    assert scores == sorted(scores, reverse=True) and len(r["results"]) == 5
    r = ask(spark, path, manuals=["m"])["q"]
    assert not r["multi_manual"] and r["manual_id_filter"] == "m" and all(x["chunk_id"].startswith("m::") for x in r["results"])


def test_parts_of_the_results(spark, tmp_path):
    path = str(tmp_path / "index")
    index.build(spark.createDataFrame(CHUNKS, SHAPE), path)
    shape = "query_id int, ord int, chunk_id string, score double, parent_chunk_id string, sibling_chunk_ids array<string>, cross_references array<string>"
    primary = spark.createDataFrame([(1, 0, "a", 0.9, "p", ["b", "s"], ["m::8"]), (1, 1, "b", 0.8, "a", [], ["m::8"])], shape)
    look = {t: snapshots.opened(spark, path, t) for t in index.LOOKUPS}
    look["cross_ref_lookup"] = look["cross_ref_lookup"].where("chunk_id = 'm::3'")
    out = retrieval.reranked(retrieval.enriched(primary, look))
    points = spark.createDataFrame([("a", "text a", {"k": "v"})], "chunk_id string, text string, metadata map<string, string>")
    rows = retrieval.with_payload(out, points, look["procedure_lookup"]).orderBy("rank").collect()
    assert [(r["chunk_id"], round(r["score"], 6), r["source"]) for r in rows] == [("a", 0.9, "primary"), ("b", 0.8, "primary"), ("p", 0.63, "parent"), ("s", 0.54, "sibling"), ("m::3", 0.45, "cross_ref")]
    assert rows[0]["text"] == "text a" and rows[0]["metadata"] == {"k": "v"} and rows[2]["metadata"] == {}
    assert rows[4]["metadata"] == {"manual_id": "m", "procedure_name": "name 3"} and rows[4]["text"] == ""


def test_missing_lookup_tables_are_told(spark, tmp_path):
    path = str(tmp_path / "index")
    tables.create_vectors(spark, f"{path}/vectors")
    index.vectors(spark.createDataFrame(CHUNKS, SHAPE)).write.mode("overwrite").parquet(f"{path}/vectors")
    r = ask(spark, path)["q"]
    assert len(r["retrieval_warnings"]) == 2 and "cross_ref_lookup" in r["retrieval_warnings"][0] and r["results"] and all(x["source"] != "cross_ref" for x in r["results"])


def test_build_replaces_chunks_of_one_id_and_adds_lookups(spark, tmp_path):
    path = str(tmp_path / "index")
    index.build(spark.createDataFrame(CHUNKS[:3], SHAPE), path)
    index.build(spark.createDataFrame([chunk(2, "changed"), chunk(9, "fresh")], SHAPE), path)
    points = snapshots.opened(spark, path, "vectors").select(F.get_json_object("payload", "$.chunk_id"), F.get_json_object("payload", "$.text"), F.get_json_object("payload", "$.manual_id"))
    assert sorted(map(tuple, points.collect())) == [("m::1", "brake pads wear", "m"), ("m::2", "changed", "m"), ("m::3", "brake pads new", "m"), ("m::9", "fresh", "m")]
    assert snapshots.opened(spark, path, "procedure_lookup").count() == 5


def named(spark, path):
    return snapshots.latest(spark, path)[1]["vectors"]


def test_a_change_rewrites_the_buckets_of_its_points_only(spark, tmp_path):
    path = str(tmp_path / "index")
    index.build(spark.createDataFrame([chunk(i, f"text {i}") for i in range(200)], SHAPE), path, buckets=32)
    before = named(spark, path)
    assert len(before) > 20
    index.build(spark.createDataFrame([chunk(7, "changed"), chunk(500, "fresh")], SHAPE), path)
    after = named(spark, path)
    assert 1 <= sum(after[b] != before.get(b) for b in after) <= 2
    texts = {r[0]: r[1] for r in snapshots.opened(spark, path, "vectors").select(F.get_json_object("payload", "$.chunk_id"), F.get_json_object("payload", "$.text")).collect()}
    assert len(texts) == 201 and texts["m::7"] == "changed" and texts["m::500"] == "fresh" and texts["m::8"] == "text 8"
    assert snapshots.vacuum(spark, path) >= 1 and snapshots.opened(spark, path, "vectors").count() == 201 and snapshots.vacuum(spark, path) == 0


def test_a_build_that_stops_leaves_the_old_index(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "index")
    index.build(spark.createDataFrame(CHUNKS, SHAPE), path)
    rows = lambda: sorted(map(str, snapshots.opened(spark, path, "vectors").collect()))
    old, number = rows(), snapshots.latest(spark, path)[0]

    def fails(*_):
        raise OSError("stopped")

    with monkeypatch.context() as m:
        m.setattr(snapshots, "publish", fails)
        with pytest.raises(OSError, match="stopped"):
            index.build(spark.createDataFrame([chunk(1, "new")], SHAPE), path)
    assert rows() == old and snapshots.opened(spark, path, "procedure_lookup").count() == len(CHUNKS)
    with pytest.raises(Exception, match="embeds nothing"):

        def broken(texts):
            raise ValueError("embeds nothing")

        index.build(spark.createDataFrame([chunk(1, "new")], SHAPE), path, broken)
    assert rows() == old and snapshots.latest(spark, path)[0] == number
    index.build(spark.createDataFrame([chunk(1, "new")], SHAPE), path)
    with pytest.raises(RuntimeError, match="meanwhile"):
        snapshots.publish(spark, path, number, {})
    assert rows() != old and ask(spark, path)["q"]["results"]


def test_lookup_tables_that_cannot_be_read_give_partial_results_and_a_warning(spark, tmp_path):
    path = str(tmp_path / "index")
    index.build(spark.createDataFrame(CHUNKS, SHAPE), path)
    whole = ask(spark, path)["q"]
    for f in Path(snapshots.latest(spark, path)[1]["cross_ref_lookup"][0]).glob("*.parquet"):
        f.write_bytes(b"no table at all")
        (f.parent / f".{f.name}.crc").unlink(missing_ok=True)
    r = ask(spark, path)["q"]
    assert len(r["retrieval_warnings"]) == 1 and "can't be read" in r["retrieval_warnings"][0]
    assert r["results"] and all(x["source"] != "cross_ref" for x in r["results"])
    assert [x["chunk_id"] for x in r["results"] if x["source"] == "primary"][0] == whole["results"][0]["chunk_id"]


def test_an_index_without_snapshots_is_taken_over(spark, tmp_path):
    path = str(tmp_path / "index")
    tables.create_vectors(spark, f"{path}/vectors")
    assert index.build(spark.createDataFrame(CHUNKS, SHAPE), path) == len(CHUNKS)
    assert snapshots.opened(spark, path, "vectors").count() == len(CHUNKS)


def test_approximate_neighbours(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 24)) * 3
    v = centres[rng.integers(0, 30, 3000)] + rng.normal(size=(3000, 24))
    v[:900] = v[0]  # copies
    rows = [(i, x.tolist(), i % 3) for i, x in enumerate(v)]
    odd = [(10_000, None, 0), (10_001, [], 0), (10_002, [1.0], 1), (10_003, [0.0] * 24, 0), (10_004, [float("nan")] * 24, 2), (10_005, [None] * 24, 0)]
    points = spark.createDataFrame([*rows, *odd], "point long, v array<double>, label int").repartition(5)
    ask = points.where("point % 50 = 0").select(F.col("point").alias("query_id"), F.col("v").alias("q"), "label")
    for keys in (None, ["label"]):
        asked = ask if keys else ask.drop("label")
        near = {(r["query_id"], r["point"]): r for r in ann.nearest_approximately(asked, points, 10, keys, probed=0.3).collect()}
        exact = {(r["query_id"], r["point"]): r["score"] for r in index.nearest(asked.where("size(q) = 24 and q[0] <> 0"), points.where("size(v) = 24 and v[0] <> 0"), 10, keys).collect()}
        assert all(r["score"] == pytest.approx(exact[k]) for k, r in near.items() if k in exact) and all(1 <= r["rank"] <= 10 for r in near.values())
        hot = {k for k in exact if v[k[0]][0] == v[0][0]}  # any ten of the copies do
        found = len((exact.keys() - hot) & near.keys()) / len(exact.keys() - hot)
        assert found >= 0.9 and all(r["scanned"] < 3000 for r in near.values())
        assert sum(1 for k in near if k[0] == 50) == 10
    assert ann.nearest_approximately(ask, points.limit(0), 3).count() == 0 and ann.nearest_approximately(ask.limit(0).drop("label"), points, 3).count() == 0


def test_a_target_that_very_many_cite(spark):
    shape = "query_id int, ord int, chunk_id string, score double, parent_chunk_id string, sibling_chunk_ids array<string>, cross_references array<string>"
    primary = spark.createDataFrame([(q, o, f"c{q + o:04}", 0.9 - o / 10, f"c{q:04}", [f"c{o:04}", "s"], ["m::hot", f"m::{o}"]) for q in range(20) for o in range(2)], shape)
    cited = [(f"c{i:04}", r) for i in range(3000) for r in ("m::hot", "m::hot", f"m::{i % 50}")]
    look = {"cross_ref_lookup": spark.createDataFrame(cited, "chunk_id string, cross_reference string")}
    row = lambda r: (r["query_id"], r["rank"], r["chunk_id"], r["source"], r["score"])
    for top in (1, 5, 12):
        some, every = retrieval.enriched(primary, look, top), retrieval.enriched(primary, look)
        assert sorted(map(row, retrieval.reranked(some, top).collect())) == sorted(map(row, retrieval.reranked(every, top).collect()))
        assert some.count() < 20 * 4 * (top + 7)
