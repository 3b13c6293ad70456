"""Operators on small tables with nulls, repeats, empty and long texts, against plain Python."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from quire.llm import bpe, eliasfano, exact, licenses, mixing, ngram_lm, packing, pii, quality, simhash, tokens, urls

SCHEMA = "doc_id long, text string, lang string, source string, row string, n int"
LONG = "word " * 3000 + "tail"


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(1)
    words = ["the", "of", "Alpha", "beta,", "gamma", "é", "a@b.co", "1.2.3.4"]
    texts = [None, "", "  \n", LONG, LONG + " ", "same text", "same  text", *[" ".join(rng.choices(words, k=rng.randrange(3, 60))) for _ in range(40)]]
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, "x", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[8], rows[8], (None, "null id", "en", "s1", "x", 1)], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact(docs, none):
    rows = exact.groups(docs).collect()
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    sizes = Counter(norm(r["text"]) for r in docs.collect())
    assert len(rows) == docs.count() and sum(r["kept"] for r in rows) == len(sizes)
    by = {r["doc_id"]: r for r in rows}
    assert by[6]["keep_id"] == 5 and by[6]["group_size"] == 2 and by[4]["keep_id"] == 4
    assert sorted(r["kept"] for r in rows if r["doc_id"] == 8) == [False, False, True]
    kept = exact.kept_documents(docs)
    assert kept.count() == len(sizes) and kept.columns == docs.columns
    assert exact.groups(none).count() == 0


def test_golomb():
    v = np.unique(np.random.default_rng(0).integers(0, 1 << 63, 500, np.int64)).astype(np.uint64)
    for x in (v, v[:1], v[:0], np.arange(9, dtype=np.uint64)):
        k, code = exact.golomb(x)
        assert (exact.ungolomb(len(x), k, code) == x).all()


def test_eliasfano():
    for top in (5, 1000, 1 << 62):
        v = np.sort(np.random.default_rng(top % 7).integers(0, top, 700, np.int64)).astype(np.uint64)
        e = eliasfano.EliasFano(eliasfano.unpacked(eliasfano.packed(eliasfano.EliasFano.coded(v))))
        assert (e[np.arange(700)] == v).all()
        q = np.concatenate([v, v + np.uint64(1), np.array([0, top], np.uint64)])
        index, equal = e.successor(q)
        assert (index == np.searchsorted(v, q)).all() and (equal == np.isin(q, v)).all()


def test_simhash(docs, none):
    rows = simhash.linked(docs).collect()
    fps = [(r["doc_id"], r["fp"] & (2**64 - 1)) for r in rows]
    near = {a: min(j for j, f in fps if j is not None and bin(f ^ g).count("1") <= 3) for a, g in fps if a is not None}
    assert all(r["component_id"] <= near[r["doc_id"]] for r in rows if r["doc_id"] is not None)
    assert {r["doc_id"] for r in rows if r["component_id"] == 0} >= {0, 1, 2}
    assert simhash.fingerprint("A b") == simhash.fingerprint("a  b") and simhash.fingerprint(" ") == 0
    assert simhash.kept_documents(docs).count() == len({r["component_id"] for r in rows})
    assert simhash.linked(none).count() == 0


def test_simhash_keeps_a_row_of_each_component_whatever_its_ids(spark):
    rng = random.Random(5)
    text = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(40))
    alone, one, other = [text() for _ in range(5)], text(), text()
    rows = [*[(None, t) for t in alone], (7, one), (7, other), (9, other.upper()), (None, other + " "), (None, alone[0])]
    docs = spark.createDataFrame([(i, t, "en", "s", "x", 1) for i, t in rows], SCHEMA)
    kept = [(r["doc_id"], r["text"]) for r in simhash.kept_documents(docs).collect()]
    assert sorted(kept, key=str) == sorted([*[(None, t) for t in alone], (7, one), (7, other)], key=str)


def test_tree_links_all_within_the_radius():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62, 1).astype(np.uint64)[0]
    fps = np.unique(base ^ (np.uint64(1) << rng.integers(0, 20, 30).astype(np.uint64)))
    assert len(simhash.tree(fps)) == len(fps) - 1


def test_tokens_and_packing(docs, none):
    one = bpe.encoder(bpe.default_path())
    rng = random.Random(2)
    for _ in range(300):
        t = "".join(rng.choice(["a", "Z", "'s", " ", "\n", "\t", "é", "1", "<|endoftext|>", "中", "!", "\u00a0"]) for _ in range(rng.randrange(12)))
        assert one.ids(t).tolist() == one.library.encode(t, add_special_tokens=False).ids
    assert "".join(bpe.parts(LONG, 50)) == LONG
    assert sum(len(one.part(p)) for p in bpe.parts(LONG, 50)) == len(one.ids(LONG))
    counted = tokens.token_counts(docs).collect()
    rows = packing.packed(docs, size=64).collect()
    assert len(counted) == docs.count() and sum(r["length"] for r in rows) == sum(r["n_tokens"] + 1 for r in counted)
    bins: dict = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))] and sum(n for _, n in parts) <= 64
    assert len(bins) <= math.ceil(sum(r["length"] for r in rows) / 64) + 1
    assert packing.packed(none).count() == 0 and tokens.token_counts(none).count() == 0


def test_mixing(docs, none):
    rows = mixing.taken(docs).collect()
    assert len(rows) == docs.count() and all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    assert mixing.targets([10, 10, 100], [1, 2, 3]) == [22.5, 30.0, 67.5]
    assert mixing.mixed_documents(docs).count() == sum(r["copies"] for r in rows)
    assert mixing.taken(none).count() == 0


def test_quality(docs, none):
    rows = {r["doc_id"]: r for r in quality.judged(docs).collect()}
    assert rows[3]["n_words"] == 3001 and rows[3]["n_repeat_words"] == 3000 and rows[3]["base_failed"]
    assert rows[0]["n_words"] == 0 and not rows[0]["kept"]
    assert quality.kept_documents(docs).columns == docs.columns and quality.judged(none).count() == 0


def test_quality_finds_outliers_in_groups_of_any_size(spark):
    rng = random.Random(6)
    text = lambda: " ".join("".join(rng.choices("abcdefgh", k=rng.randrange(2, 8))) for _ in range(150))
    odd = " ".join("#$%*" * 3 + "x" * 20 + str(i) for i in range(150))
    sources = [("en", "big")] * 200 + [("en", "small")] * 5 + [("de", "a")] * 20 + [("fr", "b")]
    rows = [(i, text(), lang, source, "x", 1) for i, (lang, source) in enumerate(sources)]
    rows += [(1000 + i, odd, lang, source, "x", 1) for i, (lang, source) in enumerate([("en", "big"), ("en", "small"), ("de", "a"), ("fr", "b"), ("es", "c")])]
    out = {r["doc_id"]: r for r in quality.judged(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert not any(r["base_failed"] for r in out.values()) and all(r["distance"] is not None for r in out.values())
    assert [i for i, r in out.items() if i >= 1000 and r["kept"]] == []
    assert sum(r["kept"] for i, r in out.items() if i < 1000) >= 220


def test_pii(spark, none):
    texts = ["x a@b.co, 1.2.3.4.5 +1 (555) 123-4567 or 4111 1111 1111 1111", None, "", "1.2.3.999 é a@b.c", *[f"my phone: +1 555 123 4{i:03d} now" for i in range(8)], "my phone: 555-01234 now"]
    rows = {r["doc_id"]: r for r in pii.found(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert rows[0]["spans"] == "email:2:8,ip:10:17,card:41:60,phone:20:37" and rows[3]["spans"] == "email:12:17"
    assert rows[1]["spans"] == "" and rows[12]["spans"] == "phone:10:19" and rows[12]["n_phone"] == 0
    assert pii.found(none).count() == 0


def test_pii_goes_on_from_found_values_to_any_candidate(spark):
    kinds = {"phone": lambda i: f"+1 555 123 4{i:03d}", "mail": lambda i: f"u{i}@ex.co"}
    texts = [f"my {kind}: {value(i)} now" for kind, value in kinds.items() for i in range(200)]
    first = [f"555-77{i:04d}" for i in range(6)]
    texts += [f"my phone: {v} now" for v in first] + [f"dial quickly {v} today" for v in first]
    at = len(texts)
    more = {"dial quickly 555-880000 today": "phone:13:23", "my mail: jane.doe@localhost now": "email:9:27", "my mail: @handle now": "email:9:16", "my phone: 555 123 4567 now": "phone:10:22", "my phone: AB123C now": "phone:10:16", "my phone: 12 now": "phone:10:12", "in 12 years": ""}
    texts += list(more)
    rows = {r["doc_id"]: r["spans"] for r in pii.found(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [rows[at + i] for i in range(len(more))] == list(more.values())


def test_urls(spark):
    pages = [(1, "http://a.example.org/es/x?y"), (2, "https://EXAMPLE.org/en/1#z"), (3, "x://b.com/de/"), (4, "nothing"), (5, None), (6, "http://notorg/"), (7, "http://c.net/org/")]
    rows = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judged(spark.createDataFrame(pages, "page_id long, url string")).collect()}
    assert rows[1] == ("a.example.org", "/es/x", "example.org/es/", "block") and rows[2][2:] == ("example.org/en/1", "block")
    assert rows[3][2:] == ("com/de/", "block") and rows[4] == rows[5] == ("", "", None, "allow") and rows[6][2] is None and rows[7][2] is None


def test_licenses():
    s = licenses.Scanner()
    exact_, fuzzy = s.scan("x Released under the MIT License."), s.scan("x Relaesed undr the M1T License y")
    assert exact_[:6] == (6, 1, 4, 4, "mit", "mit") and exact_[6] == 1.0
    assert fuzzy[1] == 0 and fuzzy[5] == "" and s.scan("x Released undr the MIT Licence y")[5] == "mit"
    assert s.scan("") == (0, 0, None, None, "", "", 0.0, "")


def test_ends_are_the_least_edit_distances():
    rng = random.Random(4)
    for _ in range(300):
        notice, text = ("".join(rng.choices("abc ", k=rng.randrange(1, n))) for n in (9, 40))
        row = list(range(len(notice) + 1))
        edits = [row[-1]]  # of the best stretch that ends at each place
        for c in text:
            last, row = row, [0]
            for i, x in enumerate(notice):
                row.append(min(last[i] + (x != c), last[i + 1] + 1, row[i] + 1))
            edits.append(row[-1])
        masks = {c: sum(1 << i for i, x in enumerate(notice) if x == c) for c in notice}
        errors = rng.randrange(len(notice) + 1)
        # the last place before more are needed, where the last change was not a rise
        rises = [p for p in range(len(edits)) if p + 1 == len(edits) or edits[p + 1] > edits[p]]
        fell = [p for p in rises if next((edits[q] > edits[q + 1] for q in range(p - 1, -1, -1) if edits[q] != edits[q + 1]), True)]
        assert licenses.ends(notice, text, masks, errors) == [(p, edits[p]) for p in fell if edits[p] <= errors]
        assert min((e for _, e in licenses.ends(notice, text, masks, len(notice))), default=None) == min(edits)


def _brute_model(texts):
    """(token counts, N, V, log10 probability of a list of tokens): pairs and triples in plain Python."""
    token = lambda t: [*ngram_lm.tokens(t or ""), ngram_lm.END]
    train = [token(t) for i, t in texts if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    count = Counter(w for t in train for w in t)
    pairs = Counter(p for t in train for p in zip([ngram_lm.END, *t], t, strict=False))
    triples = Counter(p for t in train for p in zip([ngram_lm.END, *t], t, t[1:], strict=False))
    n, v = sum(count.values()), len(count)
    base = lambda w: (count[w] + 1) / (n + v + 1)
    two = lambda a, w: (pairs[a, w] + ngram_lm.MU[0] * base(w)) / (count[a] + ngram_lm.MU[0])
    three = lambda a, b, w: (triples[a, b, w] + ngram_lm.MU[1] * two(b, w)) / (pairs[a, b] + ngram_lm.MU[1])
    score = lambda t: math.log10(two(ngram_lm.END, t[0])) + sum(math.log10(three(*x)) for x in zip([ngram_lm.END, *t], t, t[1:], strict=False))
    return token, count, n, v, base, score


def _same_model(rows, texts):
    token, count, n, _, base, score = _brute_model(texts)
    expected = sorted((str(i), str(zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2), len(token(t)), sum(count[w] > 0 for w in token(t)), n) for i, t in texts)
    assert sorted((str(r["doc_id"]), str(r["held_out"]), r["n_tokens"], r["n_known"], r["train_tokens"]) for r in rows) == expected
    by = {(i, len(token(t))): token(t) for i, t in texts}
    for r in rows:
        t = by[r["doc_id"], r["n_tokens"]]
        assert r["base_score"] == pytest.approx(sum(math.log10(base(w)) for w in t))
        assert r["score"] == pytest.approx(score(t), abs=0.03 * len(t))


def test_language_model_is_that_of_every_pair_and_triple(spark, docs, none, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = ngram_lm.query(spark, str(tmp_path)).collect()
    _same_model(rows, [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert ngram_lm.scored(none).count() == 0


def test_language_model_in_many_runs_shards_parts_and_stretches(spark):
    rng = random.Random(8)
    words = ["x", *[f"w{i}" for i in range(60)], "\u00c9", "\u00e9"]
    text = lambda n: " ".join("x" if rng.random() < 0.4 else rng.choice(words) for _ in range(n))
    texts = [(i, text(rng.randrange(30))) for i in range(150)] + [(1000, text(900)), (1001, " " * 700), (1002, "y" * 900 + " x w1  " + " " * 450 + "x"), (1003, text(400))]
    cut = list(ngram_lm._stretches(b"a b " * 200, 200))
    assert len(cut) > 2 and sum(cut, []) == [*ngram_lm.tokens("a b " * 200), ngram_lm.END]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    _same_model(ngram_lm.scored(docs, run=300, piece=200, shard=500, split=40).collect(), texts)


def test_levels_find_what_they_hold_and_nothing_else():
    rng = np.random.default_rng(4)
    for contexts, words in ((1, 1), (3, 5), (200, 3000)):
        keys = np.unique(rng.integers(0, contexts, 2000) << 32 | rng.integers(0, words, 2000)).astype(np.uint64)
        level = ngram_lm.Level(keys, np.arange(len(keys)).astype("<u4"))
        asked = np.unique(np.concatenate([keys, (rng.integers(0, contexts + 2, 3000) << 32 | rng.integers(0, words + 2, 3000)).astype(np.uint64)]))
        place, there = level.find(asked)
        assert (there == np.isin(asked, keys)).all() and (keys[place[there]] == asked[there]).all()
