"""Rank-queue BPE, whitening and source divergence against libraries, dense algebra and plain Python; odd tables."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.llm import divergence, rank_queue, whitening

# BPE


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken

    ours = rank_queue.Ranks(rank_queue.default_path(), public_tokenizers.PATTERN)
    return ours, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ours.ranks, special_tokens={})


def ids(code):
    return np.frombuffer(code, "<u4").tolist()


def test_ids_are_the_librarys(library):
    ours, theirs = library
    rng = random.Random(1)
    bits = ["a", "Z", "'s", " ", "\n", "\t", "é", "1", "<|endoftext|>", "中", "!", " ", "\x1c", "՘", "\U00011de0", " ", "ab", "th", "ing", "ﬁ", "🙂", "é", "\x00", "͸"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(14))) for _ in range(5000)]
    texts += ["a" * 30_000, "".join(rng.choices("abcd", k=30_000)), "中文字" * 5000, "ab" * 7001 + " x" * 80_000, "", "\n" * 5000, "9" * 999]
    codes = ours.encode(texts)
    assert [ids(c) for c in codes] == [theirs.encode_ordinary(t) for t in texts]
    assert ours.decode(codes) == [t.encode() for t in texts]
    assert not ours.queue.top and not any(ours.queue.words)


def test_every_character_is_of_the_librarys_class(library):
    ours, theirs = library
    every = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x110000)]]
    texts = ["".join(f"a{c}1{c}." for c in every[i : i + 5000]) for i in range(0, len(every), 5000)]
    for t, code in zip(texts, ours.encode(texts), strict=True):
        assert ids(code) == theirs.encode_ordinary(t)


def test_small_tables_of_seen_pre_tokens_change_nothing(library, monkeypatch):
    ours, theirs = library
    monkeypatch.setattr(rank_queue, "SEEN", 5)
    monkeypatch.setattr(rank_queue, "UNIT", 50)
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("aeiounst", k=rng.randrange(9))) for _ in range(40)) for _ in range(40)]
    assert [ids(c) for c in ours.encode(texts)] == [theirs.encode_ordinary(t) for t in texts]


def test_a_lower_rank_made_in_a_bucket_comes_first():
    ours = object.__new__(rank_queue.Ranks)
    ours.ranks = {bytes([b]): b for b in range(256)} | {b"ab": 300, b"abc": 260, b"abcab": 280, b"ca": 290}
    ours.longest, ours.queue, ours.first = 5, rank_queue.RankQueue(300), np.full(1 << 16, -1)
    for pair in (b"ab", b"ca"):
        ours.first[pair[0] << 8 | pair[1]] = ours.ranks[pair]

    def plain(piece):
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while True:
            best = min(((ours.ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ours.ranks), default=None)
            if best is None:
                return [ours.ranks[p] for p in parts]
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    rng = random.Random(4)
    pieces = ["".join(rng.choices("abc", k=rng.randrange(2, 30))).encode() for _ in range(500)]
    assert ours.merged(pieces) == [plain(p) for p in pieces]


def test_encoded_tables(spark, library):
    _, theirs = library
    rows = [(0, None), (1, ""), (2, "Alpha beta's  10\n"), (2, "Alpha beta's  10\n"), (None, "x"), (3, "word " * 40_000), (4, "ü" * 50_000)]
    df = spark.createDataFrame([(i, t, b"q", "t", 1) for i, t in rows], "doc_id long, text string, ids binary, t string, bytes int")
    made = rank_queue.decoded(rank_queue.encoded(df))
    got = sorted(((r["doc_id"], bytes(r["ids"]), bytes(r["bytes"])) for r in made.collect()), key=str)
    assert got == sorted(((i, np.array(theirs.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in rows), key=str)
    assert sorted(map(str, rank_queue.round_trip(df).collect())) == sorted(map(str, made.collect()))
    assert rank_queue.encoded(df.limit(0)).count() == 0
    assert [r["bytes"] for r in rank_queue.decoded(spark.createDataFrame([(1, None)], "doc_id long, ids binary")).collect()] == [b""]


def test_query_of_bpe(spark, library):
    _, theirs = library
    texts = {r["doc_id"]: (r["text"] or "") for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = rank_queue.query(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(texts)
    for r in rows:
        code = np.array(theirs.encode_ordinary(texts[r["doc_id"]]), "<u4").tobytes()
        assert (r["n_tokens"], r["ids_sha256"]) == (len(code) // 4, hashlib.sha256(code).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


# whitening


def dense(vectors, k=4):
    x = np.floor(256 * np.array(vectors, dtype=np.float64)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    v = (fit - s / n).T @ (fit - s / n) / n
    e, w = np.linalg.eigh(v)
    e, w = e[::-1][:k], w[:, ::-1][:, :k]
    return n, ((n * x - s) ** 2).sum(axis=1), (x - s / n) @ w / np.sqrt(e), e / np.trace(v)


def test_whitening(spark):
    rng = np.random.default_rng(1)
    v = (rng.normal(size=(700, 12)) @ rng.normal(size=(12, 12)) + 3).astype(np.float32)
    v[::3] = v[0]  # a third of all rows
    rows = [(i, x.tolist(), 7) for i, x in enumerate(v)]
    bad = [(1000, None, 1), (1001, [None] * 12, 1), (1002, [float("nan")] * 12, 1), (1003, [float("-inf")] * 12, 1), (1004, [1.0], 1), (1005, [], 1)]
    df = spark.createDataFrame([*rows, *bad], "vec_id long, embedding array<float>, x int")
    n, deviation, y, explained = dense(v)
    out = defaultdict(dict)
    for r in whitening.whitened(df.repartition(5)).collect():
        out[r["vec_id"]][r["component"]] = r
    assert set(out) == set(range(700)) and all(set(rs) == {1, 2, 3, 4} for rs in out.values())
    for c in range(4):
        got = np.array([out[i][c + 1]["whitened"] for i in range(700)])
        assert min(np.abs(got - y[:, c]).max(), np.abs(got + y[:, c]).max()) < 1e-9
        assert abs(out[0][c + 1]["explained"] - explained[c]) < 1e-12 and out[0][c + 1]["identity_error"] < 1e-10
    assert all(r["n"] == n and r["deviation"] == deviation[i] for i in range(700) for r in out[i].values())


def test_whitening_of_odd_tables(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert whitening.whitened(make([])).collect() == [] and whitening.whitened(make([(1, None)])).collect() == []
    assert whitening.whitened(make([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    line = whitening.whitened(make([(1, [0.0, 0.0]), (None, [1.0, 1.0]), (None, [1.0, 1.0])])).collect()
    assert sorted((str(r["vec_id"]), r["component"], round(r["whitened"], 9)) for r in line) == [("1", 1, -1.0), ("None", 1, 1.0), ("None", 1, 1.0)]
    big = whitening.whitened(make([(1, [1e12, 0.0]), (2, [0.0, 1e12]), (3, [-1e12, 5.0])])).collect()
    x = [[256 * 10**12, 0], [0, 256 * 10**12], [-256 * 10**12, 1280]]
    s = [sum(c) for c in zip(*x, strict=True)]
    whole = {i + 1: sum((3 * a - b) ** 2 for a, b in zip(v, s, strict=True)) for i, v in enumerate(x)}
    assert all(r["deviation"] is None and int(r["deviation_whole"]) == whole[r["vec_id"]] for r in big) and len(big) == 6


def test_jacobi_keeps_small_eigenvalues():
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.normal(size=(20, 20)))
    values = 10.0 ** -np.arange(20)
    scale = np.diag(10.0 ** -np.arange(0, 10, 0.5))
    a = scale @ (q @ np.diag(np.linspace(1, 2, 20)) @ q.T) @ scale  # graded, so that small ones are well determined
    e, v = whitening.jacobi((a + a.T) / 2)
    assert np.abs(v.T @ v - np.eye(20)).max() < 1e-13 and (np.diff(e) <= 0).all() and (e > 0).all()
    sign, log = np.linalg.slogdet(scale)
    assert abs(np.log(e).sum() - (2 * log + np.log(np.linspace(1, 2, 20)).sum())) < 1e-8
    assert (whitening.jacobi(np.diag(values[::-1]))[0] == values).all()


# divergence


def brute(rows, top=200):
    """lang, source, part, item, value, rank for (text, lang, source)."""
    counts, docs, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        counts[lang, source].update(words)
        docs[lang].update(set(words))
        langs[lang].add(source)
    out = set()
    for lang, sources in langs.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= 3)
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c[x] for x in kept) + len(kept)) for t in kept} if kept else {}  # noqa: B023, E731
        p = {s: share(counts[lang, s]) for s in sources}
        q = share(sum((counts[lang, s] for s in sources), Counter()))
        for a in sources:
            f = lambda x, y: (x - y) ** 2 // y
            pairs = [(sum(f(p[a][t], p[b][t]) for t in kept), b) for b in sources if b != a]
            terms = [(f(p[a][t], q[t]), t) for t in kept if counts[lang, a][t] and p[a][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out |= {(lang, a, part, item, v, k + 1) for k, (v, item) in enumerate(ranked)}
    return out


def odd_documents():
    rng = random.Random(5)
    terms = [*"abcdefgh", "Alpha", "alpHa", "alphabet", "é", "éa", "ź", "中", "🙂", "￮", "x" * 500, "al", "alp"]
    rows = [(" ".join(rng.choices(terms, k=rng.randrange(30))), rng.choice(["en", None, "de"]), rng.choice(["s1", "s2", None, "hot", "hot", "hot"])) for _ in range(300)]
    return [*rows, (None, "en", "s9"), ("", "fr", "s1"), ("1 2-3", "fr", "s2"), ("alpha " * 300_000, "en", "s1"), ("a9b_c", "en", ""), ("solo", "es", "one")]


@pytest.mark.parametrize("bounds", [{}, {"LEAVES": 7, "PAIRS": 3, "RANGE": 300}, {"CHUNK": 100, "fits": lambda df: False}])
def test_divergence(spark, monkeypatch, bounds):
    rows = odd_documents()
    df = spark.createDataFrame([(t, lang, s, 1, "q", 2) for t, lang, s in rows], "text string, lang string, source string, term int, item string, n int").repartition(3)
    for name, value in bounds.items():  # those that functions take along when they are sent to tasks
        monkeypatch.setattr(divergence, name, value)
    got = [tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in divergence.divergence(df).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)
    assert divergence.divergence(df.limit(0)).count() == 0
    few = [tuple(r) for r in divergence.divergence(df, top=2).where("part = 'term'").select("lang", "source", "part", "item", "value", "rank").collect()]
    assert set(few) == {r for r in brute(rows, 2) if r[2] == "term"}


def test_shares_and_tries():
    for count, size in ((0, 1), (5, 7), (10**12, 3 * 10**13), (10**14, 5 * 10**14), (10**9, 10**9 + 1)):
        assert divergence.share(np.array([count]), np.array([size]))[0] == 1 + 10**9 * (count + 1) // size
    rng = random.Random(6)
    texts = [(d, f"s{d % 3}", ["".join(rng.choices("abé中", k=rng.randrange(1, 9))).encode() for _ in range(rng.randrange(1, 60))]) for d in range(90)]
    held: dict = {}
    for d, source, found in texts:
        for t in found:
            docs, counts = held.setdefault(t, (set(), Counter()))
            docs.add(d)
            counts[source] += 1
    plain = [("en", t, len(docs), counts) for t, (docs, counts) in sorted(held.items())]
    rows = lambda batch: [(r["lang"], r["term"], r["docs"], Counter(dict(zip(r["source"], r["n"], strict=True)))) for r in batch.to_pylist()]
    whole = divergence.trie(texts, "en")
    assert rows(whole) == plain and rows(divergence.unpacked("en", divergence.packed(whole))) == plain
    assert rows(divergence.collapsed([divergence.trie(texts[i : i + 7], "en") for i in range(0, 90, 7)])) == plain
    cut = list(divergence.segments(whole))
    assert len({prefix for _, prefix, _ in cut}) == len(cut) and all(r[1].startswith(p) and (len(p) == 2 or r[1] == p) for _, p, c in cut for r in rows(divergence.unpacked("en", c)))
    assert [r for _, _, c in cut for r in rows(divergence.unpacked("en", c))] == plain


def test_blocks_of_pairs_change_nothing(monkeypatch):
    rng = np.random.default_rng(8)
    rows = [{"lang": "en", "term": f"t{t:03}".encode(), "source": f"s{s}", "n": int(rng.integers(1, 50)), "size": 1000 + 100 * s, "lang_n": 90, "lang_size": 9000} for t in range(60) for s in range(9) if rng.random() < 0.6]
    made = []
    for block in (1 << 20, 1, 17):
        monkeypatch.setattr(divergence, "PAIRS", block)
        audit = divergence.Audit(5)
        audit.add(pa.RecordBatch.from_pylist(rows))
        made.append((sorted(audit.sums.items()), sorted(audit.shares.items()), audit.taken("term").to_pylist()))
    assert made[0] == made[1] == made[2] and len(made[0][0]) == 72


def test_divergence_of_a_source_that_differs(spark):
    common = [("one two three four five six", "en", f"s{i % 3}") for i in range(60)]
    rows = common + [("one two strange strange strange", "en", "odd") for _ in range(5)]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    best = divergence.divergence(df).where(F.col("rank") == 1)
    assert {r["item"] for r in best.where("part = 'pair' and source like 's%'").collect()} == {"odd"}
    assert {r["item"] for r in best.where("part = 'term' and source = 'odd'").collect()} == {"strange"}
