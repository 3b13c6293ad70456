"""The chunk rules: each takes a list of texts and gives a list of texts. They depend on what came
before, so they run in Arrow functions over one entry's few texts at a time."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quire.sources.profile import Callout, Profile

#: Token limits.
MOST, LEAST = 2000, 200
#: Texts whose parts are held at once.
TEXTS = 64
_leader = re.compile(r"\.{3,}")
_numbered = re.compile(r"(?:\(\d+\)|[a-z]\.)\s")


def on_texts(df: DataFrame, text: str, rule: Callable[[str], list[tuple]], shape: T.StructType) -> DataFrame:
    """df without its texts, a row for each that a rule gives for one, with columns of shape. Rows leave Python after every TEXTS texts."""
    names = [c for c in df.columns if c != text]
    kept, made = T.StructType([df.schema[c] for c in names]), to_arrow_schema(shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(a, TEXTS)
                found = [(i, row) for i, x in enumerate(batch.column(text).to_pylist()) for row in rule(x)]
                others = batch.select(names).take(pa.array([i for i, _ in found], pa.int64()))
                new = [pa.array([row[j] for _, row in found], f.type) for j, f in enumerate(made)]
                yield pa.RecordBatch.from_arrays([*others.columns, *new], [*names, *made.names])

    return df.mapInArrow(run, T.StructType([*kept, *shape]))


def size(text: str) -> int:
    return len(text.split())


def islands(marks: list[int], apart: Callable[[int, int], bool]) -> list[tuple[int, int]]:
    """Runs of line numbers; apart(a, b) says whether b begins a new one."""
    out: list[tuple[int, int]] = []
    for n in marks:
        if out and not apart(out[-1][1], n):
            out[-1] = out[-1][0], n
        else:
            out.append((n, n))
    return out


def steps(text: str, patterns: list[str]) -> list[tuple[int, int]]:
    """Step sequences. A new one begins where numbering starts again after other lines."""
    found = [re.compile(p) for p in patterns]
    rows = [x.strip() for x in text.split("\n")]
    marks = [i for i, x in enumerate(rows) if any(p.search(x) for p in found)]

    def apart(a: int, b: int) -> bool:
        both = next(((p.search(rows[a]), p.search(rows[b])) for p in found if p.search(rows[a]) and p.search(rows[b])), None)
        if both is None or b - a <= 1:
            return False
        old, new = (m.group(1) for m in both)
        if old.isdigit() and new.isdigit():
            return int(new) == 1 <= int(old)
        return old.isalpha() and new == "a" <= old

    return islands(marks, apart)


def callouts(text: str, kinds: tuple[Callout, ...]) -> list[tuple[str, int, int, str]]:
    """(level, first line, last line, text), by kind and then by line."""
    found = [re.compile(k.pattern, 0 if k.pattern.startswith("^") else re.IGNORECASE) for k in kinds]
    rows = text.split("\n")
    bare = [x.strip() for x in rows]
    starts = [[bool(p.search(x)) for x in bare] for p in found]
    stops = [i for i, x in enumerate(bare) if not x or any(s[i] for s in starts) or _numbered.match(x)] + [len(rows)]
    out = []
    for kind, hits in zip(kinds, starts, strict=True):
        for i in (i for i, hit in enumerate(hits) if hit):
            end = next(s for s in stops if s > i) - 1
            out.append((kind.level, i, end, "\n".join(rows[i : end + 1])))
    return out


def tables(text: str) -> list[tuple[int, int]]:
    """Dot-leader lines at most three apart, with the line above as header."""
    rows = [x.strip() for x in text.split("\n")]
    found = islands([i for i, x in enumerate(rows) if _leader.search(x)], lambda a, b: b - a > 3)
    return [(a - 1 if a and rows[a - 1] and not _leader.search(rows[a - 1]) else a, b) for a, b in found]


def keep_steps(texts: list[str], patterns: list[str]) -> list[str]:
    """R3: a step sequence is a piece of its own."""
    out = []
    for text in texts:
        rows, at = text.split("\n"), 0
        for a, b in steps(text, patterns):
            out += ["\n".join(rows[at:a]), "\n".join(rows[a : b + 1])]
            at = b + 1
        out.append("\n".join(rows[at:]))
    return [x.strip() for x in out if x.strip()]


def attach_callouts(texts: list[str], kinds: tuple[Callout, ...]) -> list[str]:
    """R4: a piece of callouts alone joins the next, once."""
    out, rest = [], list(texts)
    while rest:
        text = rest.pop(0)
        found = callouts(text, kinds) if rest else []
        if found:
            inside = {n for _, a, b, _ in found for n in range(a, b + 1)}
            if all(not x.strip() for i, x in enumerate(text.strip().split("\n")) if i not in inside):
                text += "\n\n" + rest.pop(0)
        out.append(text)
    return out


def _at_end(text: str) -> bool:
    found = tables(text)
    return bool(found) and found[-1][1] >= len(text.rstrip().split("\n")) - 2


def _at_start(text: str) -> bool:
    found, rows = tables(text), text.split("\n")
    return bool(found) and found[0][0] <= next((i for i, x in enumerate(rows) if x.strip()), len(rows)) + 1


def join_tables(texts: list[str]) -> list[str]:
    """R5: a table that was cut is put together again."""
    out: list[str] = []
    for text in texts:
        if out and _at_end(out[-1]) and _at_start(text):
            out[-1] += "\n" + text
        else:
            out.append(text)
    return out


def _by_words(line: str, most: int) -> list[str]:
    words = line.split()
    return [" ".join(words[i : i + most]) for i in range(0, len(words), most)]


def _by_lines(text: str, most: int) -> list[str]:
    out: list[str] = []
    held: list[str] = []
    n = 0
    for line in text.split("\n"):
        k = size(line)
        if n + k <= most:
            held.append(line)
            n += k
            continue
        if held:
            out.append("\n".join(held))
        parts = _by_words(line, most) if k > most else [line]
        out += parts[:-1]
        held, n = [parts[-1]], size(parts[-1])
    return out + ["\n".join(held)] if held else out or [text]


def split_large(texts: list[str], most: int = MOST, repeat: bool = True) -> list[str]:
    """R2: pieces over the limit are packed anew by paragraphs, else lines, else words. repeat: what
    is held when a paragraph is itself too large comes out before it and again with the next one."""
    out: list[str] = []
    for text in texts:
        paragraphs = re.split(r"\n\s*\n", text) if size(text) > most else [text]
        if size(text) <= most or len(paragraphs) == 1:
            out += [text] if size(text) <= most else _by_lines(text, most)
            continue
        held = ""
        for p in paragraphs:
            joined = f"{held}\n\n{p}".strip() if held else p
            if size(joined) <= most:
                held = joined
                continue
            out += [held] if held else []
            if size(p) > most:
                out += _by_lines(p, most)
                held = held if repeat else ""
            else:
                held = p
        out += [held] if held else []
    return out


def merge_small(texts: list[str], least: int = LEAST) -> list[str]:
    """R6: a piece under half the least size goes before the next one."""
    out, held = [], None
    for i, text in enumerate(texts):
        held = text if held is None else f"{held}\n\n{text}"
        if size(held) >= least // 2 or i == len(texts) - 1:
            out.append(held)
            held = None
    return out


def references_only(text: str, patterns: list[str]) -> bool:
    found = [re.compile(p) for p in patterns]
    rows = [x.strip() for x in text.split("\n") if x.strip()]
    return all(any(p.search(x) for p in found) or x.isupper() and size(x) <= 5 for x in rows)


def merge_references(texts: list[str], patterns: list[str]) -> list[str]:
    """R7: a piece of references alone goes after the one before."""
    out: list[str] = []
    for text in texts:
        if out and references_only(text, patterns):
            out[-1] += "\n\n" + text
        else:
            out.append(text)
    return out


def keep_figures(texts: list[str], pattern: str) -> list[str]:
    """R8: a piece that begins with a figure that the one before mentions goes after it."""
    found = re.compile(pattern)
    name = lambda m: m.group(1) if m.lastindex else m.group(0)
    out: list[str] = []
    for text in texts:
        m = found.search(next((x.strip() for x in text.split("\n") if x.strip()), ""))
        if out and m and any(name(k) == name(m) for k in found.finditer(out[-1])):
            out[-1] += "\n\n" + text
        else:
            out.append(text)
    return out


def assembled(text: str, p: Profile) -> list[str]:
    """All rules in their order, on the text of one entry."""
    out = keep_steps([text] if text.strip() else [], list(p.step_patterns))
    out = merge_small(split_large(join_tables(attach_callouts(out, p.callouts))))
    out = merge_references(out, list(p.cross_reference_patterns))
    return keep_figures(out, p.figure_pattern) if p.figure_pattern else out
