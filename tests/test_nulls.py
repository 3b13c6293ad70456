"""A null manual is treated as any other: what comes of its rows is what comes of the same rows under a name."""

import pytest
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import analytics, checks, chunks, folds, structure
from quire.plans.samples import MANUAL
from quire.sources.profile import from_mapping

PAGES = [
    (0, "lost\nGROUP 8 IGNITION\n8 COILS\nWARNING: HOT\n\n(1) Remove FIG. B-1\n(2) Refer to 9"), (1, ""), (2, None), (3, "GROUP 9 FUEL\n9 PUMPS\nCJ-5 text\n9 PUMPS\nGROUP 8W WIRES\nskipped"),
    (4, "GROUP 8 IGNITION\n8 COILS\n" + "one two three four " * 60), (5, "8 COILS\n" + "one two three four " * 60),
]
PROFILE = {
    "schema_version": "1.0", "manual_id": "m", "manual_title": "t", "source_url": "none", "source_format": "html",
    "structure": {"hierarchy": [
        {"level": 1, "name": "group", "id_pattern": r"^GROUP (\w+)", "known_ids": [{"id": "8", "title": "x"}], "require_blank_before": False},
        {"level": 2, "name": "part", "id_pattern": r"^(\d) [A-Z]+", "min_gap_lines": 2, "require_blank_before": True},
    ]},
}


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(m, n, t) for m in ("m", None) for n, t in PAGES]
    return spark.createDataFrame(rows, "manual_id string, page_number int, text string").repartition(3)


def halves(df):
    """Rows of the named and of the null manual, as text without the manual's name."""
    out = {True: [], False: []}
    for r in df.collect():
        d = r.asDict(recursive=True)
        null = d["manual_id"] is None
        plain = str({k: v for k, v in d.items() if k != "manual_id"}).replace("'manual_id': 'm'", "'manual_id': None").replace("m::", "::")
        out[null].append(plain)
    return sorted(out[False]), sorted(out[True])


def test_structure(spark, pages, monkeypatch):
    monkeypatch.setattr(folds, "BUCKET", 4)
    p = from_mapping(PROFILE)
    numbered = structure.numbered_pages(pages)
    rows = structure.exploded(numbered)
    bounds = structure.detect(rows, p)
    entries = structure.manifest(bounds, p)
    for made in (rows, bounds, structure.after_blank(bounds, rows, p), structure.far_enough(bounds, p), structure.with_words(bounds, rows), structure.diagnostics(bounds, rows), structure.warnings(bounds, p), entries, structure.adjacency(entries), structure.entry_text(numbered, entries, ("9",))):
        named, null = halves(made)
        assert named == null and named


def test_chunks_and_checks(spark, pages):
    made = chunks.assembled(pages, MANUAL)
    named, null = halves(made)
    assert named == null and len(named) >= 2
    pairs = checks.duplicate_pairs(made)
    named, null = halves(pairs)
    assert named == null
    found = [(r["check"], r["severity"], r["chunk_id"].replace("m::", "::")) for r in checks.suite(made, MANUAL).collect()]
    assert all(found.count(f) % 2 == 0 for f in found) and found


def test_equal_chunks_of_a_null_manual_are_linked(spark):
    rows = [(m, i, f"c{i}", t) for m in ("m", None) for i, t in enumerate(["a b c d", "a b c d", None, "", "x y", "a b c d"])]
    df = spark.createDataFrame(rows, "manual_id string, chunk_ord int, chunk_id string, text string")
    got = sorted(((r["manual_id"] or "", r["oa"], r["ob"]) for r in checks.duplicate_pairs(df).collect()))
    assert got == [("", 0, 1), ("", 0, 5), ("m", 0, 1), ("m", 0, 5)]


def test_figures(spark, pages):
    c = T.cleaned_pages(pages, MANUAL.cleanup)
    for made in (analytics.ocr_quality(c), analytics.cleanup_statistics(c), analytics.page_profile(pages.select("manual_id", F.coalesce("text", F.lit("")).alias("text")))):
        named, null = halves(made)
        assert named == null and len(named) == 1


def test_merge_of_a_null_manual(spark):
    rows = [(m, i, 0, f"g::{i // 3}::{i}", "w " * n, (str(i),)) for m in ("m", None) for i, n in enumerate([5, 300, 10, 10, 10, 250, 0, 1999, 150])]
    df = spark.createDataFrame(rows, "manual_id string, entry_idx int, part_idx int, chunk_id string, text string, metadata struct<k: string>")
    named, null = halves(chunks.merge_across(df, ["entry_idx", "part_idx"]))
    assert named == null and 0 < len(named) < 9
