"""Patterns in Java's regex against Python's own on the same strings."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quire.functions.patterns import Unsayable, java, java_replacement, unsayable
from quire.sources.profile import from_mapping, validate

PATTERNS = [
    r"^(\d+)$", r"^([A-Z]\w?-\d+)\.", r"^[A-Z0-9][a-z]?-\d+\.\s+(.+)", r"^PART\s+([IVX\d]+)\.?", r"(?:FIG|Fig)\.\s*(\w+-\d+)", r"[Ff]ig(?:ure|\.)?\s+(\d+)", r"\bOfl\b", r"\b(\w+)ZZ(\w+)\b", r"’", r"“|”", "'Jeep[*']?",
    r"\*J", r"^WARNING\s*$", r"(?i)^note[.:]", r"(?im)^note\b.*$", r"(?s)a.b", r"a.b", r"a$", r"(?m)a$", r"a\Z", r"\Aa", r"(?m)^\S+", r"(?P<first_name>a+)-(?P=first_name)", r"(a)(b)?\1(?!c)", r"(?<=\d)[a-z]", r"(?<!\w)é", r"\101\x42C",
    r"[^\W\d]+", r"[\W_]+", r"[^\S\n]+", r"[\]\-^a\\]", r"[&&[a]", r"a{2}", r"a{2,}?b", r"a{,2}b", r"(?:a|b|)+c", r"x*+y", r"(?>a+)b", r"(?i:straße)X", r"(?i)ÉCOLE", r"(?i)[à-ü]+", r"(?i)s", r"(?a)\w+\b", r"\w+", r"\B-", r"\bé\b",
    r"\$(\d)", r"#\s", r"(?x) a  b # comment", r"(\w)(\w)(\w)(\w)(\w)(\w)(\w)(\w)(\w)(\w)\10", r"\.{3,}", r"[.\s]{3,}(\d+)", r"~~|``", r"(?-i:A)b", r"(?i)a(?-i:B)c", r"^\s*\((\w)\)\s", r"\t|\v|\f", r"[\b]",
]


def strings():
    rng = random.Random(1)
    bits = ["a", "b", "c", "A", "B", "C", "é", "É", "ß", "SS", "ſ", "1", "12", "٣", "²", "_", "-", ".", "...", "\n", "\r", " ", "\x85", "\x1c", "\xa0", " ", "\t", "\x0b", "\x08", "'", "’", "“", "*", "$", "#", "(a)", "Fig. 3", "FIG. A-1", "NOTE:", "note", "PART IV.", "ZZ", "Ofl", "Jeep", "école", "aa-aa", "́", "中", "😀", "&", "[", "]", "^", "\\", "~~", "abcdefghijj", "xxy", "WARNING"]
    return ["", *bits, *["".join(rng.choices(bits, k=rng.randrange(2, 9))) for _ in range(600)]]


def test_matches_groups_and_replacements_are_pythons(spark):
    texts = strings()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").coalesce(2)
    firsts = [F.struct(F.col("t").rlike(java(p)).alias("hit"), F.regexp_extract("t", java(p), 1 if re.compile(p).groups else 0).alias("got"), F.regexp_replace("t", java(p), java_replacement("<$1\\\\>", p)).alias("put")).alias(f"p{k}") for k, p in enumerate(PATTERNS)]
    for r in df.select("i", *firsts).collect():
        t = texts[r["i"]]
        for k, p in enumerate(PATTERNS):
            m = re.search(p, t)
            if p == r"\B-" and t == "":
                continue
            want = (m is not None, (m[1 if m.re.groups else 0] or "") if m else "", re.sub(p, "<$1\\\\>", t))
            if not any(x.start() == x.end() for x in re.finditer(p, t)):  # both go on otherwise after an empty match
                assert tuple(r[f"p{k}"]) == want, (p, t)
            else:
                assert tuple(r[f"p{k}"])[:2] == want[:2], (p, t)


@pytest.mark.parametrize("replacement", [r"\1lation", r"\g<1>2", r"<\g<word>>", r"\1\n\\", "$1", r"a\t$", "J'"])
def test_replacements(spark, replacement):
    p, t = r"\b(?P<word>\w+)Zation\b", "nationalZation is aZation 5Zation"
    df = spark.createDataFrame([(t,)], "t string")
    assert df.select(F.regexp_replace("t", java(p), java_replacement(replacement, p))).first()[0] == re.sub(p, replacement, t)


def test_what_java_cannot_say():
    assert unsayable(r"(a)?b(?(1)c|d)") == "a condition on a group" and unsayable(r"a+") is None
    with pytest.raises(Unsayable):
        java(r"(a)?(?(1)b)")
    assert any("can't be told" in m for m in validate(from_mapping({"structure": {"step_patterns": [r"(a)?(?(1)b)"]}})))
