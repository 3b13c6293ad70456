"""Column functions on text: cleanup, tokens, identifiers. All run inside the JVM, but for NFC."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.sources.profile import Cleanup, java, java_replacement

_SPACE = r"\s\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Python's white space, for Java's classes. Visible ASCII is told first, since every part of a class that misses costs a call.
WS = f"[[^!-~]&&[{_SPACE}]]"
NOT_WS = f"[!-~[^{_SPACE}]]"


#: The same characters one by one.
_WHITE = "".join(map(chr, [*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(c: Column) -> Column:
    """Looks at a text's ends only."""
    return F.btrim(c, F.lit(_WHITE))


def tokens(c: Column) -> Column:
    """Words between white space."""
    return F.regexp_extract_all(c, F.lit(f"{NOT_WS}+"), F.lit(0))


def count_tokens(c: Column) -> Column:
    return F.regexp_count(c, F.lit(f"{NOT_WS}+"))


#: Bytes of texts that are cut into words at once, about.
BYTES = 1 << 22


def slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about BYTES of its texts."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy().astype(np.int64)
    stops = np.flatnonzero(np.diff(np.cumsum(sizes) // BYTES, append=-1)) + 1
    for a, b in zip([0, *stops[:-1]], stops, strict=False):  # neither of an empty batch
        yield batch.slice(a, b - a)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words between white space, which is Python's, of texts one after another, and where each text's begin; a null has none."""
    found = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
    words, ends = found.flatten(), np.concatenate([[0], np.cumsum(pc.list_value_length(found).to_numpy())])
    real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)  # there is an empty word before and behind white space at the ends
    return words.filter(pa.array(real)), np.concatenate([[0], np.cumsum(real)])[ends]


def word_counts(c: Column) -> Column:
    """``count_tokens`` on whole columns of texts, for where many are counted."""

    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        made = [np.diff(split_words(part.column("t"))[1]) for part in slices(pa.RecordBatch.from_arrays([texts], ["t"]), "t")]
        n = np.concatenate([np.zeros(0, np.int64), *made])
        return pa.array(n, pa.int64(), mask=texts.is_null().to_numpy(zero_copy_only=False))

    return run.asNondeterministic()(c)  # so that it is not counted once for each use


def lines(c: Column) -> Column:
    return F.split(c, "\n", -1)


def collapse_spaced(c: Column) -> Column:
    """"W A R N I N G" becomes one word: runs of three or more single capitals, one space apart."""
    return F.regexp_replace(c, r"(?<=\b[A-Z]) (?=[A-Z]\b)(?:(?<=\b[A-Z] [A-Z] )|(?=[A-Z] [A-Z]\b))", "")


def substitute(c: Column, pairs) -> Column:
    return reduce(lambda x, p: F.replace(x, F.lit(p["from"]), F.lit(p["to"])), pairs, c)


def substitute_patterns(c: Column, pairs) -> Column:
    return reduce(lambda x, p: F.regexp_replace(x, java(p["pattern"]), java_replacement(p["replacement"], p["pattern"])), pairs, c)


def any_match(c: Column, patterns) -> Column:
    return reduce(lambda a, b: a | b, [c.rlike(java(p)) for p in patterns], F.lit(False))


def strip_headers(c: Column, patterns) -> tuple[Column, Column]:
    """(text without the lines that match, page id from the first such line with digits)."""
    keep = F.array_join(F.filter(lines(c), lambda x: ~any_match(x, patterns)), "\n")
    dropped = F.filter(lines(c), lambda x: any_match(x, patterns) & x.rlike("[0-9]"))
    first = F.get(dropped, F.lit(0))
    pair = r"(\d+)\s*-\s*(\d+)"
    page = F.when(first.rlike(pair), F.concat_ws("-", F.regexp_extract(first, pair, 1), F.regexp_extract(first, pair, 2))).otherwise(F.regexp_extract(first, r"(\d+)", 1))
    return keep, F.when(first.isNotNull(), page)


def garbage_lines(c: Column, threshold: float) -> Column:
    """Indices of lines with a word whose share of other than ASCII characters is above the threshold."""
    share = lambda w: F.length(F.regexp_replace(w, r"[\x00-\x7F]", "")) / F.length(w)
    bad = F.transform(lines(c), lambda x, i: F.when(F.exists(tokens(x), lambda w: share(w) > threshold), i))
    return F.array_compact(bad)


def nfc(c: Column) -> Column:
    """Canonical composition; Spark has no function for it. Nulls stay null."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.str.normalize("NFC")

    return run(c)


def plain(c: Column) -> Column:
    """Straight quotes, no ligatures."""
    # What is replaced.
    c = F.translate(c, "‘’“”", "''\"\"")
    for a, b in (("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬁ", "fi"), ("ﬂ", "fl")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def composed(df: DataFrame, column: str) -> DataFrame:
    """df with a column in NFC. Texts without characters from U+0300 on are in NFC as they are; only others go through Python."""
    marked = F.when(F.col(column).rlike(r"[^\x00-\x{02ff}]"), F.col(column))
    return df.withColumn("_nfc", marked).withColumn(column, F.coalesce(nfc(F.col("_nfc")), column)).drop("_nfc")


def spaced(c: Column) -> Column:
    """Single spaces, no more than one blank line."""
    c = F.array_join(F.transform(lines(c), lambda x: strip(F.regexp_replace(x, r"[ \t]+", " "))), "\n")
    return F.regexp_replace(c, r"\n{3,}", "\n\n")


def normalized(df: DataFrame, column: str) -> DataFrame:
    """df with a column normalised: plain, NFC, spaced."""
    df = composed(df.withColumn(column, plain(F.col(column))), column)
    return df.withColumn(column, spaced(F.col(column)))


def cleaned_pages(pages: DataFrame, rules: Cleanup) -> DataFrame:
    """pages (with text) and the columns of a cleaned page after all steps, in order, each a column of its own so that none
    is computed twice. Garbage is looked for before normalisation, and substitutions are counted in the raw page."""
    c = F.coalesce("text", F.lit(""))
    count = lambda s: ((F.length(c) - F.length(F.replace(c, F.lit(s["from"]), F.lit("")))) / len(s["from"])).cast("int")
    df = pages.withColumn("substitutions_applied", reduce(lambda a, b: a + b, [count(s) for s in rules.known_substitutions if s["from"]], F.lit(0)))
    x = collapse_spaced(c) if rules.collapse_spaced_chars else c
    df = df.withColumn("cleaned_text", substitute_patterns(substitute(x, rules.known_substitutions), rules.regex_substitutions))
    page = F.lit(None).cast("string")
    if rules.header_footer_patterns:
        kept, page = strip_headers(F.col("cleaned_text"), rules.header_footer_patterns)
        df = df.withColumns({"extracted_page_id": page, "cleaned_text": kept})
    else:
        df = df.withColumn("extracted_page_id", page)
    df = df.withColumn("garbage_lines", garbage_lines(F.col("cleaned_text"), rules.garbage_threshold) if rules.garbage_enabled else F.array().cast("array<int>"))
    return normalized(df, "cleaned_text")


def find_all(c: Column, pattern: str) -> Column:
    """All matches of a pattern: its first group, or the whole match if it has none."""
    import re

    return F.regexp_extract_all(c, F.lit(java(pattern)), F.lit(1 if re.compile(pattern).groups else 0))


def first_words(c: Column, n: int = 150) -> Column:
    return F.array_join(F.slice(tokens(c), 1, n), " ")


def point_id(c: Column) -> Column:
    """Version 5 UUID of a name in the URL namespace."""
    h = F.sha1(F.concat(F.unhex(F.lit("6ba7b8119dad11d180b400c04fd430c8")), F.encode(c, "UTF-8")))
    variant = F.substring(F.lit("89ab"), 1, 4)
    digit = F.substring(variant, (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4 + 1), F.lit(1))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(digit, F.substring(h, 18, 3)), F.substring(h, 21, 12))
