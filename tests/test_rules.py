"""Rules, checks and cleanup on small texts."""

import random

import pytest
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import checks, chunks, rules, structure
from quire.plans.samples import MANUAL


def words(n, w="w"):
    return " ".join([w] * n)


STEPS, REFS = list(MANUAL.step_patterns), list(MANUAL.cross_reference_patterns)
CASES = [
    (lambda t: rules.keep_steps(t, STEPS), ["intro\n(1) a\n(2) b\nafter"], ["intro", "(1) a\n(2) b", "after"]),
    (lambda t: rules.keep_steps(t, STEPS), ["(1) a\nx\n(1) b"], ["(1) a", "x", "(1) b"]),
    (lambda t: rules.keep_steps(t, STEPS), ["(1) a\n(1) b"], ["(1) a\n(1) b"]),
    (lambda t: rules.attach_callouts(t, MANUAL.callouts), ["WARNING: HOT\nSTILL", "(1) do", "x"], ["WARNING: HOT\nSTILL\n\n(1) do", "x"]),
    (lambda t: rules.attach_callouts(t, MANUAL.callouts), ["WARNING: HOT\n\nplain words", "y"], ["WARNING: HOT\n\nplain words", "y"]),
    (lambda t: rules.attach_callouts(t, MANUAL.callouts), ["WARNING: LAST"], ["WARNING: LAST"]),
    (rules.join_tables, ["SPEC\nBore....3", "Stroke....4", "Gap....5"], ["SPEC\nBore....3\nStroke....4\nGap....5"]),
    (rules.join_tables, ["Bore....3\na\nb\nc", "Stroke....4"], ["Bore....3\na\nb\nc", "Stroke....4"]),
    (rules.split_large, [words(2001)], [words(2000), "w"]),
    (rules.split_large, [words(1500) + "\n" + words(600)], [words(1500), words(600)]),
    (rules.split_large, ["a b\n\n" + words(2001) + "\n\nc"], ["a b", words(2000), "w", "a b\n\nc"]),
    (rules.merge_small, ["a", words(100), "b"], ["a\n\n" + words(100), "b"]),
    (rules.merge_small, [words(99), "x"], [words(99) + "\n\nx"]),
    (lambda t: rules.merge_references(t, REFS), ["x y", "Refer to 8A", "z"], ["x y\n\nRefer to 8A", "z"]),
    (lambda t: rules.merge_references(t, REFS), ["Refer to 8A", "x"], ["Refer to 8A", "x"]),
    (lambda t: rules.merge_references(t, REFS), ["a", "OIL PUMP\nRefer to 9"], ["a\n\nOIL PUMP\nRefer to 9"]),
    (lambda t: rules.keep_figures(t, MANUAL.figure_pattern), ["see FIG. B-1", "FIG. B-1 pump", "x"], ["see FIG. B-1\n\nFIG. B-1 pump", "x"]),
    (lambda t: rules.keep_figures(t, MANUAL.figure_pattern), ["see FIG. B-2", "FIG. B-1 pump"], ["see FIG. B-2", "FIG. B-1 pump"]),
]


@pytest.mark.parametrize(("rule", "given", "expected"), CASES)
def test_rule(rule, given, expected):
    assert rule(given) == expected


def test_finders():
    assert rules.steps("(1) a\n(2) b\nc\n(1) d", STEPS) == [(0, 1), (3, 3)] and rules.steps("a. x\nb. y", STEPS) == [(0, 1)]
    assert rules.tables("SPECS\nBore....3\nsub\nGap....1\n\n\n\n\nLone....2") == [(0, 3), (8, 8)] and rules.tables("none..") == []
    assert [c[:3] for c in rules.callouts("Note: be kind\nWARNING: HOT\nMORE\n(1) go", MANUAL.callouts)] == [("warning", 1, 2), ("note", 0, 0)]


def test_large_pieces_keep_every_word():
    rng = random.Random(1)
    for _ in range(50):
        text = "".join(rng.choice(["a ", "b ", "\n", "\n\n", words(30) + " "]) for _ in range(rng.randrange(60)))
        out = rules.split_large([text], 25, repeat=False)
        assert " ".join(" ".join(out).split()) == " ".join(text.split()) and all(rules.size(x) <= 25 for x in out)


def test_spaced_capitals(spark):
    cases = {"W A R N I N G and A B": "WARNING and A B", "A B C D": "ABCD", "x A B C y": "x ABC y", "AB C D": "AB C D", "": ""}
    df = spark.createDataFrame([(a,) for a in cases], "raw string")
    assert {r[0]: r[1] for r in df.select("raw", T.collapse_spaced(F.col("raw"))).collect()} == cases


def test_only_texts_that_need_it_are_composed(spark):
    df = spark.createDataFrame([("plain",), ("é ﬁn “x”",), (None,), ("",)], "t string")
    assert [r[0] for r in T.normalized(df, "t").collect()] == ["plain", 'é fin "x"', None, ""]


def test_merge_across_entries(spark):
    sizes = [("m::A::1", 10), ("m::A::2", 5), ("m::A::3", 300), ("m::B::1", 8), ("m::B::2", 1995), ("m::B::3", 150)]
    rows = [("m", i, 0, c, words(n), (c,)) for i, (c, n) in enumerate(sizes)]
    df = spark.createDataFrame(rows, "manual_id string, entry_idx int, part_idx int, chunk_id string, text string, metadata struct<x: string>")
    out = chunks.merge_across(df, ["entry_idx", "part_idx"]).select("chunk_id", T.count_tokens(F.col("text"))).collect()
    assert sorted(map(tuple, out)) == [("m::A::3", 315), ("m::B::1", 8), ("m::B::2", 1995), ("m::B::3", 150)]


def test_ambiguous_boundaries(spark):
    text = "\n".join(["GROUP 8 IGNITION", "text", "8 COILS", "GROUP 9 FUEL", "9 PUMPS"])
    pages = spark.createDataFrame([("m", 0, text)], "manual_id string, page_number int, text string")
    out = structure.detect(structure.page_lines(pages), MANUAL).select("level", "id", "line_number").collect()
    assert sorted(map(tuple, out), key=lambda r: r[2]) == [(1, "8", 0), (2, "8", 2), (1, "9", 3), (2, "9", 4)]


def test_checks_on_small_chunks(spark):
    starts = [("c1", "(1) start"), ("c2", "(3) middle"), ("c3", "b. middle"), ("c4", "a. start"), ("c5", "plain"), ("c6", "")]
    df = spark.createDataFrame(starts, "chunk_id string, text string")
    assert sorted((r["chunk_id"], r["details"]["first_step"]) for r in checks.orphaned_steps(df, MANUAL).collect()) == [("c2", "3"), ("c3", "b")]
    calls = [("c1", "WARNING: HOT"), ("c2", "WARNING: HOT\n(1) go"), ("c3", "a note: x\nMORE"), ("c4", "WARNING: X\nthis is governed real text"), ("c5", "text")]
    df = spark.createDataFrame(calls, "chunk_id string, text string")
    assert sorted((r["chunk_id"], r["severity"]) for r in checks.split_callouts(df, MANUAL).collect()) == [("c1", "error"), ("c3", "warning")]


def references(spark, rows):
    df = spark.createDataFrame(rows, "manual_id string, chunk_ord int, chunk_id string, text string, metadata struct<cross_references: array<string>>")
    return sorted((r["chunk_id"], r["details"]["target"], r["severity"]) for r in checks.broken_references(df, MANUAL).collect())


def test_references(spark):
    rows = [("m", 0, "m::8::1", "77. Heading", (["m::9"],)), ("m", 1, "m::8::2", "see 55. here", (["m::77", "m::55", "m::8W1", "m::1", "m::8"],)), ("m", 2, "m::9A", "x", ([],))]
    assert references(spark, rows) == [("m::8::2", "m::55", "error"), ("m::8::2", "m::8W1", "warning")]


def test_a_heading_needs_white_space_behind_it(spark):
    asks = ("m", 1, "m::8::2", "x", (["m::77", "m::7.1"],))
    assert references(spark, [("m", 0, "m::8::1", "a\n77.", ([],)), asks]) == [("m::8::2", "m::7.1", "error"), ("m::8::2", "m::77", "error")]
    assert references(spark, [("m", 0, "m::8::1", "a\n77.\n", ([],)), asks]) == [("m::8::2", "m::7.1", "error")]
    assert references(spark, [("m", 0, "m::8::1", "77.\nb\n7.1. c", ([],)), asks]) == []
    assert references(spark, [("m", 0, "m::8::1", None, ([],)), ("m", 1, "m::8::2", "77. own\n7.1. own", asks[4])]) == [("m::8::2", "m::7.1", "error"), ("m::8::2", "m::77", "error")]


def test_duplicates_keep_every_link_between_different_texts(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(40)], k=60)) for _ in range(30)]
    for t in texts[:12]:
        w = t.split()
        texts += [t, " ".join([*w, "new"]), " ".join(reversed(w))]
    texts += ["", "a", "a", "a b"]
    rows = [(f"m{i % 2}", i, f"c{i}", t) for i, t in enumerate(texts)]
    got = {(r["oa"], r["ob"]): r["sim"] for r in checks.duplicate_pairs(spark.createDataFrame(rows, "manual_id string, chunk_ord int, chunk_id string, text string")).collect()}
    key = lambda i: (i % 2, len(texts[i].split()), frozenset(texts[i].split()))
    first: dict = {}
    for i, t in enumerate(texts):
        if t.split():
            first.setdefault(key(i), i)
    expected = {(first[key(i)], i): 1.0 for i, t in enumerate(texts) if t.split() and first[key(i)] != i}
    heads = list(first.values())
    for x, i in enumerate(heads):
        for j in heads[x + 1 :]:
            a, b = set(texts[i].split()), set(texts[j].split())
            n = sorted((len(texts[i].split()), len(texts[j].split())))
            if i % 2 == j % 2 and n[0] >= 0.95 * n[1] and len(a & b) / len(a | b) >= 0.95:
                expected[i, j] = len(a & b) / len(a | b)
    assert got == pytest.approx(expected) and len(expected) > 20
