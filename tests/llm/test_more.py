"""URL filters, license scans and outliers against plain Python; odd tables."""

import random
import re
from collections import Counter

import numpy as np

from quire.llm import licenses, quality, urls


def judge(url):
    """(host, path, rule, verdict) by every rule in turn."""
    rest = url.partition("://")[2] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = max(((h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)), key=lambda x: len(x[0]), default=(None, urls.DEFAULT))
    return host, path, *best


def test_urls_against_every_rule(spark):
    rng = random.Random(1)
    bits = ["http://", "://", "example.org", "org", ".", "a", "/es/", "/en/1", "/", "com", "fr", "/fr/", "/de/", "?", "#", "EXAMPLE.ORG", "é", "x" * 3000, ""]
    pages = [(i, "".join(rng.choices(bits, k=rng.randrange(7)))) for i in range(500)] + [(501, None), (None, "http://example.org/es/"), (None, None), (3, "http://b.org/")]
    pages += [(600 + i, f"http://hot.example.org/es/{i}") for i in range(400)] + [(5, "http://b.com/de/x")] * 3
    rows = [(i, u, "x", "y", 1, True, "z") for i, u in pages]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, path string, range int, is_url boolean, rule string")
    for ranges in (1, 7):
        got = Counter(map(tuple, urls.judged(df, ranges=ranges).collect()))
        assert got == Counter((i, *judge(u)) for i, u in pages)
    assert urls.judged(df.limit(0)).count() == 0


def test_license_scans_on_odd_tables(spark):
    rng = random.Random(2)
    bits = ["mit", "license", "apache", "general", "public", "MIT License", "the", "é", ".", ",", " ", "\n", "x"]
    texts = [None, "", " . ", *["".join(b + rng.choice([" ", "-", ""]) for b in rng.choices(bits, k=rng.randrange(40))) for _ in range(200)], "all rights reserved " * 20_000, "mit license " * 50_000 + "y"]
    df = spark.createDataFrame([*[(i, t, "a", 1) for i, t in enumerate(texts)], (3, texts[3], "b", 2), (None, "mit license", "c", 3)], "doc_id long, text string, spans string, n_words int")
    rows = licenses.scanned(df).collect()
    assert len(rows) == len(texts) + 2 and licenses.scanned(df.limit(0)).count() == 0
    for r in rows:
        t = ("mit license" if r["doc_id"] is None else texts[r["doc_id"]]) or ""
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t))
        found = [(i, label) for phrase, label in licenses.PHRASES for p in [phrase.split()] for i in range(len(words)) if words[i : i + len(p)] == p]
        places = [i for i, _ in found]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(words), len(found), min(places, default=None), max(places, default=None))
        base = {x for _, x in found}
        assert r["base_labels"] == ",".join(sorted(base)) and base <= set(r["labels"].split(",")) | {""} and 0 <= r["score"] <= 1
    long = {r["doc_id"]: r["spans"] for r in rows}
    assert long[len(texts) - 2].count("proprietary") == 20_000


def test_each_notice_of_a_text_is_a_span():
    spans = lambda t: licenses.Scanner().scan(t)[7]
    assert spans("released undr the mit license released under the mit license") == "mit:0:4:1,mit:5:9:0"
    assert spans("all rights reservd all rights reserved") == "proprietary:0:2:1,proprietary:3:5:0"


def test_edited_notices_are_found():
    rng, scanner, missed, total = random.Random(3), licenses.Scanner(), 0, 0
    for label, notice in licenses.NOTICES:
        for _ in range(30):
            chars = list(notice)
            for _ in range(rng.randrange(int(licenses.RATE * len(notice)) + 1)):
                k = rng.randrange(len(chars))
                chars[k : k + 1] = rng.choice([[], ["q"], [chars[k], "q"]])
            total += 1
            missed += label not in scanner.scan(f"lorem ipsum {''.join(chars)} dolor sit")[5].split(",")
    assert missed <= 0.02 * total


def dense(x, support, cutoff_floor):
    """Distances under a minimum-covariance-determinant estimate by exact concentration steps."""
    floor = np.array(list(quality.FLOOR.values()))
    q1, med, q3 = np.quantile(x, [0.25, 0.5, 0.75], axis=0)
    mean, cov = med, np.diag(((q3 - q1) / 1.349) ** 2 + floor**2)
    distance = lambda: np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
    for _ in range(50):
        near = x[np.argsort(distance(), kind="stable")[: int(np.ceil(support * len(x)))]]
        new = near.mean(0)
        if np.abs(new - mean).max() < 1e-6:
            break
        mean, cov = new, quality.CONSISTENCY * np.cov(near.T, bias=True) + np.diag(floor**2)
    return distance()


def test_outliers_are_those_of_a_dense_estimate(spark):
    rng = np.random.default_rng(5)
    n = len(quality.FEATURES)
    mix = rng.normal(size=(n, n)) * 0.3
    x = rng.normal(size=(600, n)) @ mix + rng.normal(size=n)
    x[:30] += rng.normal(size=n) * 4  # a cluster of outliers
    df = spark.createDataFrame([("g", *map(float, row), i) for i, row in enumerate(x)], ", ".join(["g string", *[f"{f} double" for f in quality.FEATURES], "i int"]))
    params = quality._quartiles(df)
    for _ in range(12):
        before, params = params, quality.written(quality._concentrated(df, params, 0.75), "test")
        if quality._moved(before, params) <= 0.02:
            break
    got = np.array([r["d2"] for r in quality._with_distance(df, params).orderBy("i").collect()])
    expected = dense(x, 0.75, quality.CUTOFF)
    assert np.corrcoef(np.log(got), np.log(expected))[0, 1] > 0.99
    differ = (got > quality.CUTOFF) != (expected > quality.CUTOFF)
    assert (got[:30] > quality.CUTOFF).all() and differ.mean() <= 0.01
