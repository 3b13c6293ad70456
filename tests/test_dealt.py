"""Texts of the flow are dealt out and counted as seldom as can be, with the same chunks."""

from pyspark.sql import functions as F

from quire.functions.text import count_tokens
from quire.operators import chunks, structure
from quire.plans.samples import MANUAL, PROSE
from quire.sources import tables


def test_chunks_know_their_tokens(spark):
    rows = [("m" if i % 2 else None, i, f"GROUP {i % 3}\n\n{'word ' * (i * 37 % 400)}\n(1) do 　 it") for i in range(40)]
    pages = spark.createDataFrame(rows, "manual_id string, page_number int, text string")
    for p in (MANUAL, PROSE):
        made = chunks.assembled(pages, p).select("tokens", count_tokens(F.col("text")).alias("n")).collect()
        assert all(r["tokens"] == r["n"] for r in made)
    assert chunks.assembled(pages, MANUAL).count() > 2


def test_merged_and_lone_chunks(spark):
    rows = [("m", i, 0, f"m::{'a' if i < 4 else 'b'}::{i}", text, (str(i),)) for i, text in enumerate(["one", "two " * 250, "three " * 1900, "four", "five " * 300, None])]
    df = spark.createDataFrame(rows, "manual_id string, entry_idx int, part_idx int, chunk_id string, text string, metadata struct<k: string>")
    out = {r["chunk_ord"]: r for r in chunks.merge_across(df.withColumn("text", F.coalesce("text", F.lit(""))), ["entry_idx", "part_idx"]).collect()}
    assert [(n, r["chunk_id"], r["metadata"]["k"], r["tokens"]) for n, r in sorted(out.items())] == [(0, "m::a::1", "1", 251), (1, "m::a::2", "2", 1900), (2, "m::a::3", "3", 1), (3, "m::b::4", "4", 300), (4, "m::b::5", "5", 0)]
    assert out[0]["text"] == "one\n\n" + "two " * 250 and out[4]["text"] == ""


def test_pages_are_numbered_within_their_slices(spark):
    rows = [(i * 1500 if i % 11 else None, ("s", "t", None)[i % 3], "\n" * (i % 4) if i % 5 else None) for i in range(60)]
    made = tables.document_pages(spark.createDataFrame(rows, "doc_id long, source string, text string"))
    assert "slice" in made.columns and made.count() == 60
    for some in (made, made.drop("slice")):
        got = {(r["manual_id"], r["page_number"]): (r["offset"], r["text"]) for r in structure.numbered_pages(some).collect()}
        assert len(got) == 60
        for m in ("s", "t", None):
            at = 0
            for i in range(20):
                assert got[m, i][0] == at
                at += (got[m, i][1] or "").count("\n") + 1


def test_texts_meet_their_entries_without_being_dealt_out_again(spark):
    pages = structure.numbered_pages(spark.createDataFrame([("m", i, f"GROUP {i}\ntext {i}") for i in range(9)], "manual_id string, page_number int, text string"))
    entries = structure.manifest(structure.detect(structure.exploded(pages), MANUAL), MANUAL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = structure.entry_text(pages, entries)
        plan = made._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    top = plan.split("SortMergeJoin")[1]  # of the entries and the texts
    assert "_name" in top.split("\n")[0] and made.count() == 9
