"""The stages of the pipeline and their operators against plain Python, with clashing names, ties, nulls and repeats."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from quire.llm import bpe, exact, mixing, packing, quality, simhash, tokens

CLASHING = ["__doc_id", "__text_hash", "__text_len", "__row_hash", "__copies", "__rank", "__row", "__sum", "row", "copies", "n", "k", "slice", "rank", "before", "size", "kept", "fp", "g", "t", "a.b"]


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randrange(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(11)
    texts = [words(rng, rng.randrange(12, 90)) for _ in range(70)]
    rows = [(i, t, ("en", "de", None)[i % 3], ("s0", "s1", "s2", None)[i % 4]) for i, t in enumerate(texts)]
    rows += [(100 + i, texts[i % 4] + ("  " if i % 2 else " "), "en", "s1") for i in range(30)]  # copies
    rows += [(200 + i, texts[9] + f" {words(rng, 1)}", "en", "s2") for i in range(5)]  # near copies
    rows += [(300, None, "en", "s1"), (301, "", None, None), (None, texts[5], "en", "s0"), (None, words(rng, 40), "en", "s0"), (None, None, None, None), (400, words(rng, 9000), "fr", "s3"), (401, "# $ " * 30 + words(rng, 30), "en", "s0")]
    rows += [rows[3], rows[3], rows[3]]
    shape = ", ".join(["doc_id long", "text string", "lang string", "source string", *[f"`{c}` string" for c in CLASHING], "m map<string, int>"])
    # rows 7 and 8 again, alike but for one column
    made = [(*r, *[f"{c}{r[0]}" for c in CLASHING], {"x": i}) for i, r in enumerate(rows)]
    made += [(*made[k][:4], *["other"] * len(CLASHING), None) for k in (7, 8)] + [made[20], made[20]]
    return spark.createDataFrame(made, shape)


def whole(df):
    return sorted((tuple(str(sorted(x.items()) if isinstance(x, dict) else x) for x in r) for r in df.collect()), key=str)


def test_stages_keep_every_column_and_agree_over_any_partitions(spark, docs):
    every = Counter(whole(docs))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
        first = whole(out)
        assert set(first) <= set(every), name
        if name != "mixing sources to target weights":
            assert not Counter(first) - every, name
        assert whole(stage(spark, docs.repartition(3, "`a.b`"), "")) == first, name
        assert stage(spark, docs.limit(0), "").count() == 0, name
    name, stage = corpus_pipeline.STAGES[-1]
    assert stage(spark, docs.limit(0), "").count() == 0 and stage(spark, docs, "").count() >= docs.count()


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def order(i):
    return (i is None, i or 0)


def fingerprint(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64))


def components(pairs):
    """Least id reachable of each row, and its group, over all pairs of (id, fingerprint)."""
    group = list(range(len(pairs)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, (_, f) in enumerate(pairs):
        for j in range(i):
            if bin(f ^ pairs[j][1]).count("1") <= 3:
                group[root(i)] = root(j)
    members = defaultdict(list)
    for i in range(len(pairs)):
        members[root(i)].append(i)
    return members


def test_pipeline_against_plain_python(spark, docs, tmp_path):
    docs.drop(*[f"`{c}`" for c in CLASHING], "m").write.parquet(f"{tmp_path}/documents.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    kept = {(r["doc_id"], r["n_words"], r["word_chars"]) for r in quality.judged(docs).where("kept").collect()}
    left = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect() if (r["doc_id"], *base_columns(r["text"])[:2]) in kept]
    best: dict = {}
    for i, t, s in left:
        if normal(t) not in best or order(i) < order(best[normal(t)][0]):
            best[normal(t)] = (i, t, s)
    once = list(best.values())
    groups = components([(i, fingerprint(t)) for i, t, _ in once])
    stay = [min((once[k] for k in m), key=lambda r: order(r[0])) for m in groups.values()]
    lengths = {r["doc_id"]: 0 for r in rows}
    for r in rows:
        lengths[r["doc_id"]] += r["length"]
    assert set(lengths) <= {i for i, _, _ in stay}
    sizes = defaultdict(int)
    for _, t, s in stay:
        sizes[s] += len(t.split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    goal = dict(zip(names, mixing.targets([sizes[s] for s in names], [(1, 2, 3)[i % 3] for i in range(len(names))]), strict=True))
    one = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    per = {i: len(one.encode(t, add_special_tokens=False).ids) + 1 for i, t, _ in stay}
    got = defaultdict(int)
    for i, t, s in stay:
        copies, rest = divmod(lengths.get(i, 0), per[i])
        assert rest == 0 and copies <= 3
        got[s] += copies * len(t.split())
    least = {s: min(len(t.split()) for _, t, x in stay if x == s) for s in names}
    assert all(abs(got[s] - goal[s]) <= max(least[s], 0.02 * goal[s]) for s in names), (dict(got), goal)
    _gapless(rows, 2048)


def _gapless(rows, size):
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(bins)


def test_packing_pieces_are_the_librarys_ids(spark):
    rng = random.Random(12)
    texts = [None, "", "x", *[words(rng, rng.randrange(400)) for _ in range(40)], "é中 <|endoftext|> " * 60, words(rng, 5000)]
    docs = spark.createDataFrame([*enumerate(texts), (3, texts[3])], "doc_id long, text string")
    one = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for size in (2048, 64):
        rows = packing.packed(docs, size=size).collect()
        found = defaultdict(list)
        for r in rows:
            found[r["doc_id"]].append((r["start"], r["piece"], r["length"], r["ids_crc32"]))
        total = 0
        for i, t in enumerate(texts):
            ids = np.array([*one.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
            first = len(ids) % size or size
            cuts = [0, *range(first, len(ids), size)]
            expected = [(a, k, min(b, len(ids)) - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(ids)], strict=True))]
            assert sorted(found[i]) == sorted(expected * (2 if i == 3 else 1))
            total += len(ids) * (2 if i == 3 else 1)
        assert _gapless(rows, size) <= math.ceil(total / size) + 1


def test_mixing_meets_targets(spark, docs):
    rows = mixing.taken(docs).collect()
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((r["doc_id"], len((r["text"] or "").split())) for r in docs.collect())
    source = defaultdict(int)
    for r in docs.collect():
        source[r["source"]] += len((r["text"] or "").split())
    names = sorted(source, key=lambda s: (s is None, s or ""))
    goal = mixing.targets([source[s] for s in names], [(1, 2, 3)[i % 3] for i in range(len(names))])
    assert sum(goal) == pytest.approx(sum(source.values())) and all(g <= 3 * source[s] for g, s in zip(goal, names, strict=True))
    by = defaultdict(list)
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        by[r["source_size"], r["target"]].append(r)
    assert sorted((source[s], pytest.approx(g)) for s, g in zip(names, goal, strict=True)) == sorted(by)
    for (_, target), group in by.items():
        sizes = [r["size"] for r in group if r["size"]]
        assert abs(sum(r["taken"] for r in group) - target) <= max(min(sizes), 0.01 * target)


def test_targets_by_hand():
    assert mixing.targets([10, 10, 100], [1, 2, 3]) == [22.5, 30.0, 67.5]
    assert mixing.targets([0, 5], [1, 2]) == [0.0, 5.0] and mixing.targets([], []) == []


def test_rates_tilt_sizes_and_minimise_the_dual(spark):
    rng = random.Random(13)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 60)), "en", f"s{i % 3}") for i in range(600)]
    out = mixing.taken(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    by = defaultdict(list)
    for r in out:
        by[r["source_size"]].append(r)
    for group in by.values():
        assert sum(r["rate"] * r["size"] for r in group) == pytest.approx(group[0]["target"], rel=1e-6)
        mean = group[0]["source_size"] / len(group)
        slopes = {round(math.log(r["rate"] / (3 - r["rate"]) * 2) / (r["size"] / mean), 6) for r in group if 0 < r["rate"] < 3 - 1e-9}
        assert len(slopes) <= 1  # one multiplier a source


def test_token_counts_of_each_row(spark):
    rng = random.Random(14)
    bits = ["a", "Z", "'s", " ", "\n", "\t", "é", "1", "<|endoftext|>", "中", "!", " ", "word", "\U0001f600", "‍", "  "]
    texts = [None, "", *["".join(rng.choices(bits, k=rng.randrange(60))) for _ in range(300)], "ab " * 60_000, "x" * 250_000, "中文 " * 50_000]
    docs = spark.createDataFrame([*enumerate(texts), (None, "a b"), (5, texts[5])], "doc_id long, text string")
    one = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for path, count in ((None, lambda t: len(one.encode(t, add_special_tokens=False).ids)), (public_tokenizers.path("piece_bpe_32k.model"), lambda t: len(model.encode(t)))):
        rows = tokens.token_counts(docs, path).collect()
        assert len(rows) == len(texts) + 2
        for r in rows:
            t = "a b" if r["doc_id"] is None else texts[r["doc_id"]] or ""
            assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(t.encode()), count(t), count(t) > 1024)
    assert tokens.token_counts(docs.limit(0), public_tokenizers.path("piece_bpe_32k.model")).count() == 0


def test_every_known_character_is_split_alike_by_both_libraries():
    one = bpe.encoder(bpe.default_path())
    known = [chr(c) for c in range(0x2100) if re.fullmatch(f"[{bpe.KNOWN}]", chr(c))]
    for c in known:
        for t in (c, f"a{c}b", f" {c} ", f"1{c}2", f"{c}{c}", f"\n{c}'s", f"!{c}?"):
            assert one.fast.encode(t, allowed_special="all") == one.library.encode(t, add_special_tokens=False).ids, (hex(ord(c)), t)


def test_simhash_links_all_pairs_within_the_radius(spark):
    rng = random.Random(15)
    base = [words(rng, rng.randrange(1, 60)) for _ in range(60)]
    texts = [None, "", " \n", "A", "a", "a b", *base]
    for t in base[:25]:  # near copies
        w = t.split()
        w[rng.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    texts += [words(rng, 300)] + [None]
    long = words(rng, 1500).split()
    texts += [" ".join(long)] + [" ".join([*long[:k], "x", *long[k + 1 :]]) for k in (3, 700, 1499)]
    pairs = [(i * 3 % 101, t) for i, t in enumerate(texts)]
    rows = simhash.linked(spark.createDataFrame(pairs, "doc_id long, text string")).collect()
    prints = [(i, fingerprint(t)) for i, t in pairs]
    least = {}
    for m in components(prints).values():
        for k in m:
            least[prints[k]] = min(prints[j][0] for j in m)
    assert sorted((r["doc_id"], r["fp"] & (2**64 - 1), r["component_id"]) for r in rows) == sorted((i, f, least[i, f]) for i, f in prints)
    assert len(components(prints)) < len(set(prints))


def base_columns(text):
    w = (text or "").encode().split()
    w = [x.decode() for x in w]
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    count = Counter(windows)
    repeated = {i + d for i, x in enumerate(windows) if count[x] > 1 for d in range(5)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated)


def test_quality_base_columns(spark):
    rng = random.Random(16)
    bits = ["a", "b", "é", "#", "\n", " ", "\t", "c d", "𝄞", "\x0b", " ", "x x x x x x", "|"]
    texts = [None, "", *["".join(rng.choices(bits, k=rng.randrange(80))) for _ in range(300)], "a b c d e " * 500, words(rng, 3000)]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    for r in quality.judged(docs).collect():
        n, chars, symbols, lines, repeat = base_columns(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, lines, repeat), texts[r["doc_id"]]
        assert r["base_failed"] == (n < 10 or 100 * repeat > 20 * n) and not (r["kept"] and r["base_failed"])


def test_exact_keeps_the_least_id_of_equal_texts(docs):
    rows = exact.groups(docs).collect()
    groups = defaultdict(list)
    for r in docs.collect():
        groups[normal(r["text"])].append(r["doc_id"])
    by_hash = {hashlib.sha256(t.encode()).hexdigest(): (min(ids, key=order), len(ids)) for t, ids in groups.items()}
    kept = Counter()
    for r in rows:
        assert (r["keep_id"], r["group_size"]) == by_hash[r["text_sha256"]]
        kept[r["text_sha256"]] += r["kept"]
    assert len(rows) == docs.count() and set(kept) == set(by_hash) and set(kept.values()) == {1}
