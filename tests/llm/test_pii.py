"""Base spans against plain Python, what patterns find beyond them, and its graph."""

import hashlib
import random
import re
from collections import defaultdict

from quire.llm import pii

#: The base kinds as the contract writes them.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    twice = [2 * int(c) if i % 2 else int(c) for i, c in enumerate(reversed(digits))]
    return sum(n - 9 if n > 9 else n for n in twice) % 10 == 0


def holds(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in BASE.items() for m in re.finditer(p, text or "") if holds(k, m[0])]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_base_spans_are_those_of_plain_python(spark):
    rng = random.Random(1)
    bits = ["a@b.co", "x", "é@", ".", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 123-4567", "+", "5", " ", " ", "\n", "-", "(", "12", "𝄞", "%", "@", "_", "0" * 16, "a.b+c@d-e.f.g"]
    texts = [None, "", *["".join(rng.choices(bits, k=rng.randrange(40))) for _ in range(400)], "9 " * 3000 + "+1 555 123 4567 " + "1.2.3.4," * 3000, "a" * 4_000 + "@", "4" * 4_000, "4111 1111 1111 1111 " * 40]
    texts += texts[5:9]  # repeated rows
    rows = {r["doc_id"]: r for r in pii.found(frame(spark, texts).selectExpr("*", "1 AS row", "2 AS others", "'x' AS base")).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        expected, r = base_spans(text), rows[i]
        assert r["base_sha256"] == hashlib.sha256(",".join(expected).encode()).hexdigest(), text
        assert [r[f"n_{k}"] for k in BASE] == [sum(x.startswith(k) for x in expected) for k in BASE]
        found = r["spans"].split(",") if r["spans"] else []
        assert set(expected) <= set(found) and r["n_spans"] == len(found) and r["personal"] == bool(found)
        assert len(expected) + r["n_seed_secrets"] + r["n_found"] == len(found)
        assert [x for x in found if x.split(":")[0] in BASE and x in expected] == expected


def test_patterns_find_planted_identifiers_and_leave_other_numbers(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randrange(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    digits = lambda n: "".join(rng.choices("0123456789", k=n))
    seeds = {
        "phone": lambda: f"call me at: +1 (555) {digits(3)}-{digits(4)} or", "ip": lambda: f"host <10.{rng.randrange(250)}.{rng.randrange(250)}.7> up",
        "secret": lambda: f'token = "{rng.randrange(16**40):040x}";', "email": lambda: f"mail to [{word()}{digits(3)}@ex.org]",
    }
    unseen = {
        "phone": lambda: ("call me at: ", f"555-{digits(6)}", " or"), "secret": lambda: ('token = "', f"sk-{word()}{digits(7)}", '";'),
        "email": lambda: ("mail to [", f"{word()}{digits(2)}@localhost", "]"), "ip": lambda: ("host <", f"node{digits(4)}", "> up"),
    }
    texts, planted = [], {}
    for kind, make in seeds.items():
        texts += [f"{prose(20)} {make()} {prose(20)}" for _ in range(120)]
    for kind, make in unseen.items():
        for _ in range(12):
            before, value, after = make()
            start = prose(20) + " " + before
            planted[len(texts)] = f"{kind}:{len(start)}:{len(start) + len(value)}"
            texts.append(start + value + after + " " + prose(20))
    clean = range(len(texts), len(texts) + 200)
    texts += [f"{prose(10)} {digits(rng.randrange(1, 9))} {prose(5)} version {rng.randrange(9)}.{rng.randrange(9)} {prose(5)}" for _ in clean]
    rows = {r["doc_id"]: r["spans"] for r in pii.found(frame(spark, texts)).collect()}
    caught = sum(rows[i] == span for i, span in planted.items())
    wrong = sum(rows[i] != "" for i in clean)
    assert caught >= 0.9 * len(planted) and wrong <= 0.01 * len(clean), (caught, len(planted), wrong)


def test_graph_counts_and_rounds_are_those_of_plain_python(spark):
    rng = random.Random(3)
    kinds = [lambda: f"+1 555 {rng.randrange(100, 999)} 1234", lambda: f"u{rng.randrange(10**6)}@ex.co", lambda: f"ID{rng.randrange(10**5, 10**6)}", lambda: f"{rng.randrange(10**6, 10**7)}"]
    heads = ["dial", "ring now", "write", "see", "code is", "x y z"]
    texts = [f"{rng.choice(heads)} {rng.choice(kinds)()} {rng.choice(['ok', 'end', 'then'])}" for _ in range(300)]
    texts += ["dial 5551234 ok", "ring now 5551234 end"] * 3
    rows = pii.written(pii.extracted(frame(spark, texts)), "test")  # as found() does
    seeds, others = set(), set()
    for r in rows.collect():
        for x in [*r["base"], *r["secret"], *r["others"]]:
            a, b = list(x["l"]), list(x["r"])
            names = [f"l {' '.join(a[-n:])}" for n in (1, 2, 3) if len(a) >= n] + [f"r {' '.join(b[:n])}" for n in (1, 2) if len(b) >= n]
            names += [f"b {' '.join(a[-n:])} _ {b[0]}" for n in (1, 2, 3) if len(a) >= n and b]
            (seeds if x["k"] >= 0 else others).update((p, x["k"], x["v"]) for p in names)
    own, every = defaultdict(int), defaultdict(int)
    for p, k, _ in seeds:
        own[p, k] += 1
        every[p] += 1
    for p, _, _ in others:
        every[p] += 1
    accepted: dict = {}
    while True:
        count = defaultdict(int, own)
        for p, _, v in others:
            if v in accepted:
                count[p, accepted[v]] += 1
        best: dict = {}
        for p, _, v in others:
            for k in range(5):
                if v not in accepted and count[p, k] >= 5 and count[p, k] / (every[p] - 1) >= 0.5:
                    best[v] = max(best.get(v, (0, 0)), (count[p, k] / (every[p] - 1), -k))
        if not best:
            break
        accepted |= {v: -x[1] for v, x in best.items()}
    got = {r["v"]: r["k"] for r in pii.discovered(rows, accept=0.5).collect()}
    assert got == accepted and len(got) > 5
