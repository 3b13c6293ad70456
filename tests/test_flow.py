"""Pages to chunks to report, and files."""

import json
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.operators import checks, chunks, index, structure
from quire.plans.samples import MANUAL
from quire.sources import files, tables
from quire.sources.profile import from_mapping
from quire.sources.storage import written

PAGES = [("m", 0, "lost\nGROUP 8 IGNITION\n8 COILS\nWARNING: HOT\n\n(1) Remove FIG. B-1\n(2) Refer to 9"), ("m", 1, ""), ("m", 2, "GROUP 9 FUEL\n9 PUMPS\nCJ-5 text\nGROUP 8W WIRES\nskipped")]


def test_chunks_and_files(spark, tmp_path):
    made = chunks.assembled(spark.createDataFrame(PAGES, "manual_id string, page_number int, text string"), MANUAL).orderBy("chunk_ord")
    rows = made.collect()
    assert [r["chunk_id"] for r in rows] == ["m::8::8", "m::9::9"]
    assert rows[0]["metadata"]["figure_references"] == ["B-1"] and rows[0]["metadata"]["has_safety_callouts"] == ["warning"]
    assert rows[1]["metadata"]["vehicle_models"] == ["CJ-5"] and rows[1]["text"].startswith("GROUP 9 FUEL")
    path = str(tmp_path / "c.jsonl")
    tables.save_chunks(made, path)
    again = tables.load_chunks(spark, path)
    assert again.orderBy("chunk_ord").select("chunk_id", "text").collect() == made.select("chunk_id", "text").collect()
    found = checks.summary(checks.suite(again.withColumn("chunk_ord", F.col("chunk_ord")), MANUAL)).collect()
    assert {r["check"] for r in found} == set(checks.CHECKS) and {r["warnings"] for r in found if r["check"] == "size_outliers"} == {2}


def test_no_pages(spark):
    assert chunks.assembled(spark.createDataFrame([], "manual_id string, page_number int, text string"), MANUAL).count() == 0


def test_nearest_takes_any_number_of_queries(spark):
    queries = spark.range(10_050).select(F.col("id").alias("query_id"), F.array(F.lit(1.0), F.col("id") % 3).alias("q"))
    points = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(3)], "point long, v array<double>")
    rows = index.nearest(queries, points, 1).collect()
    assert len(rows) == 10_050 and all(r["point"] == r["query_id"] % 3 and r["rank"] == 1 for r in rows)


def test_chunks_that_lack_a_key_are_refused(spark, tmp_path):
    path = tmp_path / "c.jsonl"
    for line in ('{"chunk_id": "a", "manual_id": "m", "text": "t"}', "[1]", "nonsense"):
        path.write_text(line + "\n\n")
        with pytest.raises(Exception, match="lacks|JSON|json|MALFORMED"):
            tables.load_chunks(spark, str(path)).collect()
    path.write_text('{"chunk_id": "a", "manual_id": "m", "text": null, "metadata": {"manual_id": null}}\n')
    rows = tables.load_chunks(spark, str(path)).collect()
    assert [(r["chunk_id"], r["text"], r["raw"]) for r in rows] == [("a", None, {"manual_id": None})]


def test_manifest_files(spark, tmp_path):
    numbered = structure.numbered_pages(spark.createDataFrame(PAGES, "manual_id string, page_number int, text string"))
    made = structure.manifest(structure.detect(structure.exploded(numbered), MANUAL), MANUAL)
    tables.save_manifest(made, str(tmp_path / "m"))
    again = tables.load_manifest(spark, str(tmp_path / "m"))
    names = ["manual_id", "entry_idx", "chunk_id", "level", "parent_chunk_id", "children", "line_range"]
    key = lambda r: r["entry_idx"]
    assert sorted(made.select(names).collect(), key=key) == sorted(again.select(names).collect(), key=key) and again.count() > 3


def test_running_totals_over_buckets(spark):
    rows = [(g, i, float(i % 7), i if i % 5 == 0 else None) for g in ("a", None) for i in range(0, 20_000, 3)]
    df = spark.createDataFrame(rows, "g string, i long, v double, m long")
    for name, total in (("v", F.sum), ("m", F.max)):
        got = {(r["g"], r["i"]): r["out"] for r in structure.before(df, ["g"], "i", name, "out", total).collect()}
        held: dict = {}
        for g, i, v, m in rows:
            assert got[g, i] == held.get(g, 0 if name == "v" else None)
            x = v if name == "v" else m
            held[g] = held.get(g, 0) + x if name == "v" else x if x is not None else held.get(g)


def test_a_task_tried_again_leaves_no_second_copy(spark, tmp_path):
    path = str(tmp_path / "out")
    write = lambda w, rows: w.write(iter([pa.RecordBatch.from_pylist([{"name": n, "part": p} for n, p in rows])]))
    w = files.Writer(path, ".txt", True)
    write(w, [("a", "half")])  # an attempt that is lost
    done = [write(w, [("a", "1"), ("a", "2"), ("b/c", "3")]), write(w, [(None, "4"), ("", None)]), None]
    write(w, [("a", "a late copy")])
    w.commit(done)
    read = lambda: {f.name: f.read_text() for f in (tmp_path / "out").iterdir()}
    assert read() == {"a.txt": "12", "b%2Fc.txt": "3", "%null.txt": "4", "%empty.txt": ""}
    w = files.Writer(path, ".txt", True)
    write(w, [("z", "lost")])
    w.abort([])
    assert len(read()) == 4 and not any("_staging" in n for n in read())
    w = files.Writer(path, ".txt", True)
    w.commit([write(w, [("a", "new")])])
    assert read() == {"a.txt": "new"}


def test_a_file_for_each_manual(spark, tmp_path):
    path = str(tmp_path / "c")
    rows = [(m, i, f"{m}::{i}", None if i == 3 else f"text {i} é", (m, "x" if i % 2 else None)) for m in ("one", "two/2", None) for i in range(50)]
    df = spark.createDataFrame(rows, "manual_id string, chunk_ord int, chunk_id string, text string, metadata struct<manual_id: string, level1_id: string>").repartition(7)
    tables.save_chunks(df, path)
    assert sorted(f.name for f in Path(path).iterdir() if f.suffix == ".jsonl") == ["%null.jsonl", "one.jsonl", "two%2F2.jsonl"]
    assert [json.loads(x)["chunk_id"] for x in Path(path, "one.jsonl").read_text().splitlines()] == [f"one::{i}" for i in range(50)]
    again = tables.load_chunks(spark, path).orderBy("chunk_ord")
    assert sorted(map(str, again.select("manual_id", "chunk_id", "text", "metadata.level1_id").collect())) == sorted(map(str, df.select("manual_id", "chunk_id", "text", "metadata.level1_id").collect()))


def test_filters_count_what_they_leave(spark):
    hierarchy = [{"level": 1, "name": "a", "id_pattern": r"^A(\d+)", "known_ids": [{"id": str(i), "title": "x"} for i in range(1, 9)], "require_known_id": True, "min_gap_lines": 3}, {"level": 2, "name": "b", "id_pattern": r"^B(\d+)", "require_blank_before": True, "min_content_words": 3}]
    p = from_mapping({"structure": {"hierarchy": hierarchy}})
    text = "A1\nA2\nx\ny\nA99\nA3\n\nB1 one two three\nB2 four five six\n\nB3\n\nA4"
    rows = written(structure.page_lines(spark.createDataFrame([("m", 0, text)], "manual_id string, page_number int, text string")), "lines")
    counts: dict = {}
    kept = written(structure.filtered(structure.detect(rows, p), rows, p, counts), "kept")
    assert tuple(counts) == structure.PASSES and [o.get["n"] for o in counts.values()] == [8, 7, 6, 5, 4]
    assert sorted(r["id"] for r in kept.collect()) == ["1", "1", "3", "4"]
    plain = structure.filtered(structure.detect(rows, p), rows, p)
    assert sorted(map(str, plain.collect())) == sorted(map(str, kept.collect()))
