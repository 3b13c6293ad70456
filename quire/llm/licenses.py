"""License scans by fuzzy search for short notices.

A notice of n characters may differ from its standard wording by ``errors`` edits, about a tenth of n. Cut into errors + 1
pieces, at least one piece of any such match is unchanged (pigeonhole); pieces are cut so that they are as even as
possible. One Aho-Corasick automaton finds all pieces of all notices in one pass over the words of the text, and
each hit names a place where its notice would begin. Bit vectors of edit distance run once over these places and give
each end where fewer edits are needed than around it, which loses no match; there the regex library's bounded-error matching, with
its best-match flag, verifies the edits in a window of the notice's length and reports the span. So time grows with the text and the notices in it.
A text is read whole, whatever its length; the base labels look for exact phrases of words.

Defined results. Null text counts as empty: no words, no labels, score 0. Words with other letters
than A-Z are words too. Overlapping places of a phrase all count. A label is named once. score is 1 minus edits / length of the best verified
notice, 1 if a base phrase stands, else 0. Repeated rows are scanned each; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from quire.llm.common import documents, text_of

# Base phrases, and short notices in words as people write them, with labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
NOTICES = (
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "under the terms of the gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright"),
    ("proprietary", "all rights reserved"),
)
#: Edits for each character of a notice.
RATE = 0.1

_table = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def words_line(text: str) -> tuple[str, int]:
    """The text's words, each after one space, with a closing space; and their number."""
    words = text.encode("utf-8", "surrogatepass").translate(_table).split()
    return f" {b' '.join(words).decode('utf-8', 'surrogatepass')} ", len(words)


def pieces(notice: str, errors: int) -> list[tuple[int, str]]:
    """(place, piece): errors + 1 pieces, of which no edit can reach two."""
    cuts = [round(i * len(notice) / (errors + 1)) for i in range(errors + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def ends(notice: str, text: str, masks: dict[str, int], errors: int) -> list[tuple[int, int]]:
    """(end, edits) where a stretch of text that ends there is at most errors edits from notice: of neighbouring ends that need
    as many, and fewer than those around them, the last. By Myers's bit vectors, one step a character.
    masks: the places of each character in notice, as bits."""
    full = (1 << len(notice)) - 1
    top = full ^ full >> 1
    plus, minus, edits = full, 0, len(notice)
    out: list[tuple[int, int]] = []
    falling = True  # whether the last change of edits was downwards
    for at, c in enumerate(text):
        same = masks.get(c, 0)
        vertical = same | minus
        across = (same & plus) + plus ^ plus | same
        up, down = (minus | ~(across | plus)) & full, plus & across
        if up & top:
            if falling and edits <= errors:
                out.append((at, edits))
            edits, falling = edits + 1, False
        elif down & top:
            edits, falling = edits - 1, True
        up, down = up << 1 & full, down << 1 & full
        plus, minus = (down | ~(vertical | up)) & full, up & vertical
    if falling and edits <= errors:
        out.append((len(text), edits))
    return out


def apart(spans: list[tuple[str, int, int, int]]) -> list[tuple[str, int, int, int]]:
    """Of overlapping spans the one with the fewest edits stays, then the longest; in the order of the text."""
    starts: list[int] = []
    kept: list[tuple[str, int, int, int]] = []
    for span in sorted(set(spans), key=lambda s: (s[3], s[1] - s[2], s[1], s[0])):
        k = bisect_left(starts, span[2])  # those before k begin before the span ends; the last of them ends last
        if not k or kept[k - 1][2] <= span[1]:
            starts.insert(k, span[1])
            kept.insert(k, span)
    return kept


class Scanner:
    def __init__(self, phrases=PHRASES, notices=NOTICES, rate: float = RATE) -> None:
        self.phrases = [(re.compile(f"(?<= ){p}(?= )"), label, p.rpartition(" ")[2]) for p, label in phrases]
        self.notices = [(label, n, int(rate * len(n))) for label, n in notices]
        self.patterns: dict[tuple[int, int], regex.Pattern] = {}
        self.masks = [{c: sum(1 << i for i, x in enumerate(n) if x == c) for c in n} for _, n, _ in self.notices]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for number, (_, notice, errors) in enumerate(self.notices):
            for at, piece in pieces(notice, errors):
                seeds.setdefault(piece, []).append((number, at))
        self.automaton = ahocorasick.Automaton()
        for piece, where in seeds.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def base(self, line: str) -> list[tuple[int, str]]:
        """(word, label) for each place of a phrase."""
        out = []
        for pattern, label, last in self.phrases:
            if last in line:
                at, words = 0, -1
                for m in pattern.finditer(line):
                    words += line.count(" ", at, m.start())
                    at = m.start()
                    out.append((words, label))
        return out

    def verified(self, number: int, line: str, start: int, end: int, edits: int) -> tuple[str, int, int, int] | None:
        """The best match of a notice that needs edits and ends at end or just before, not before start."""
        label, notice, _ = self.notices[number]
        if not edits:
            return label, end - len(notice), end, 0
        if (number, edits) not in self.patterns:
            self.patterns[number, edits] = regex.compile(f"(?b)(?:{regex.escape(notice)}){{e<={edits}}}")
        m = self.patterns[number, edits].search(line, max(start, end - len(notice) - edits), end)
        return m and (label, m.start(), m.end(), sum(m.fuzzy_counts))

    def fuzzy(self, line: str) -> list[tuple[str, int, int, int]]:
        """(label, start, end, edits) of verified notices, characters of line, none overlapping."""
        windows: dict[int, list[tuple[int, int]]] = {}
        for end, (length, where) in self.automaton.iter(line):
            for number, at in where:
                _, notice, errors = self.notices[number]
                begin = end - length + 1 - at
                window = max(begin - errors, 0), min(begin + len(notice) + errors, len(line))
                held = windows.setdefault(number, [])
                if held and window[0] <= held[-1][1] and window[1] >= held[-1][0]:
                    held[-1] = min(window[0], held[-1][0]), max(window[1], held[-1][1])
                else:
                    held.append(window)
        out = []
        for number, held in windows.items():
            _, notice, errors = self.notices[number]
            for a, b in held:
                found = (self.verified(number, line, a, a + end, edits) for end, edits in ends(notice, line[a:b], self.masks[number], errors))
                out += [x for x in found if x]
        return apart(out)

    def scan(self, text: str) -> tuple:
        """n_words, n_base, first_word, last_word, base_labels, labels, score, spans (label:first
        word:last word:edits)."""
        line, n = words_line(text)
        base, found = self.base(line), self.fuzzy(line)
        places, names = [w for w, _ in base], {label for _, label in base}
        score = 1.0 if base else 0.0
        spans, at, words = [], 0, -1
        for label, start, end, edits in found:
            names.add(label)
            score = max(score, 1 - edits / max(end - start, edits, 1))
            words += line.count(" ", at, start + 1)
            first = words
            words += line.count(" ", start + 1, end)
            at = max(end, start + 1)
            spans.append(f"{label}:{first}:{words}:{edits}")
        return n, len(base), min(places, default=None), max(places, default=None), ",".join(sorted({label for _, label in base})), ",".join(sorted(names)), score, ",".join(spans)


_OUT = ("n_words long", "n_base long", "first_word long", "last_word long", "base_labels string", "labels string", "score double", "spans string")
_TYPES = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}


def scanned(docs: DataFrame, phrases=PHRASES, notices=NOTICES, rate: float = RATE) -> DataFrame:
    """One row per document: doc_id and what Scanner.scan gives."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, notices, rate)
        for batch in batches:
            rows = [scanner.scan(t) for t in batch.column("t").to_pylist()]
            columns = zip(*rows, strict=True) if rows else [[]] * len(_OUT)
            arrays = [pa.array(c, _TYPES[o.split()[1]]) for c, o in zip(columns, _OUT, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", *[o.split()[0] for o in _OUT]])

    rows = docs.select(docs["doc_id"].alias("doc_id"), text_of(docs).alias("t"))
    schema = rows.select("doc_id").schema
    for o in _OUT:
        schema = schema.add(*o.split())
    return rows.mapInArrow(scan, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned(documents(spark, sf_dir))
