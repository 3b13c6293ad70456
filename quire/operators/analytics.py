"""Figures about pages, words and chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.text import count_tokens, lines, strip, tokens
from quire.operators.folds import matched

# Structural markers, kinds of documents and their words.
MARKERS = {
    "chapter": r"^\s*(?i:CHAPTER)\s+\d+",
    "section": r"^\s*(?i:Section)\s+(?i:[IVXLC])+",
    "paragraph": r"^\s*\d+-\d+\.",
    "header": r"^\s*TM\s+9-\d+",
    "figure": r"[Ff]ig\.?\s*\d+",
    "table": r"^\s*(?i:Table)\s+\d+",
    "callout": r"^\s*(?:WARNING|CAUTION|NOTE)\b",
    "part_number": r"\b\d{7}\b",
    "contents": r"(?i:TABLE\s+OF\s+CONTENTS|CONTENTS)",
}
INDICATORS = {"service": ["procedure", "service", "repair"], "parts": ["part number", "catalog"], "license": ["license", "licensed"]}
HISTOGRAM = (50, 100, 200, 300, 500, 750, 1000, 1500, 2000, 3000)


def page_profile(pages: DataFrame) -> DataFrame:
    n = F.length(strip(F.col("text")))
    printable = F.length(F.regexp_replace("text", r"[^\x20-\x7E\n\t]", ""))
    return pages.groupBy("manual_id").agg(F.count(F.lit(1)).alias("pages"), F.count_if(n == 0).alias("empty_pages"), F.sum(F.length("text")).alias("chars"), F.round(F.try_divide(F.sum(printable), F.sum(F.length("text"))), 6).alias("printable"), F.round(F.avg(F.length("text")), 6).alias("avg_chars"), F.count_if(n < 50).alias("under_50"), F.count_if(n < 200).alias("under_200"))


def marker_counts(pages: DataFrame) -> DataFrame:
    rows = pages.select(F.explode(lines(F.col("text"))).alias("x"))
    return rows.agg(*[F.count_if(F.col("x").rlike(p)).alias(k) for k, p in MARKERS.items()])


def char_classes(pages: DataFrame) -> DataFrame:
    n = lambda p: F.sum(F.regexp_count("text", F.lit(p))).cast("long")
    df = pages.agg(n(r"\p{L}").alias("alpha"), n(r"\p{Nd}").alias("digit"), n(r"[\x20\x09-\x0D]").alias("space"), F.sum(F.length("text")).alias("all"))
    return df.select("alpha", "digit", "space", (F.col("all") - F.col("alpha") - F.col("digit") - F.col("space")).alias("other"))


def top_words(pages: DataFrame, k: int = 30) -> DataFrame:
    w = pages.select(F.explode(tokens(F.lower("text"))).alias("word")).where(F.col("word").rlike(r"^\p{L}{4,}$"))
    return w.groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word").limit(k)


def indicators(pages: DataFrame) -> DataFrame:
    hit = lambda ws: F.bool_or(F.lower("text").rlike("|".join(ws)))
    return pages.groupBy("manual_id").agg(*[hit(ws).alias(k) for k, ws in INDICATORS.items()])


def ocr_quality(pages: DataFrame, sample: int = 50) -> DataFrame:
    """Per manual, over its first pages: share of tokens that are words, share of garbage lines, and whether
    to read it again. pages: manual_id, page_number, cleaned_text, garbage_lines."""
    total = pages.groupBy("manual_id").agg(F.count(F.lit(1)).alias("total_pages"))
    bare = F.transform(tokens(F.col("cleaned_text")), lambda w: F.regexp_replace(w, "^[^a-zA-Z0-9]+|[^a-zA-Z0-9]+$", ""))
    named = F.filter(bare, lambda w: w != "")
    good = F.filter(named, lambda w: F.replace(w, F.lit("-"), F.lit("")).rlike(r"^\p{L}+$"))
    first = pages.where(F.col("page_number") < sample).groupBy("manual_id").agg(
        F.count(F.lit(1)).alias("sampled_pages"), F.sum(F.size(bare)).alias("tokens"), F.sum(F.size(good)).alias("words"), F.sum(F.size(named) - F.size(good)).alias("suspected_errors"),
        F.sum(F.size("garbage_lines")).alias("garbage"), F.sum(F.size(lines(F.col("cleaned_text")))).alias("lines"),
    )
    df = matched(total, first, ["manual_id"], "left").withColumns({"match": F.coalesce(F.try_divide("words", "tokens"), F.lit(0.0)), "garbage_rate": F.coalesce(F.try_divide("garbage", "lines"), F.lit(0.0))})
    return df.select("manual_id", "total_pages", F.coalesce("sampled_pages", F.lit(0)).alias("sampled_pages"), F.round("match", 6).alias("dictionary_match_rate"), F.round("garbage_rate", 6).alias("garbage_line_rate"), F.coalesce("suspected_errors", F.lit(0)).alias("suspected_errors"), ((F.col("match") < 0.7) | (F.col("garbage_rate") > 0.3)).alias("needs_reocr"))


def token_stats(chunks: DataFrame, least: int = 200, most: int = 2000) -> DataFrame:
    n = F.col("n")
    df = chunks.select(count_tokens(F.col("text")).alias("n"))
    share = lambda c: F.round(100.0 * F.count_if(c) / F.count(F.lit(1)), 4)
    return df.agg(F.count(F.lit(1)).alias("chunks"), F.min(n).alias("min"), F.max(n).alias("max"), F.round(F.avg(n), 6).alias("mean"), F.median(n).alias("median"), F.round(F.stddev_samp(n), 6).alias("stdev"), share(n < least).alias("under"), share((n >= least) & (n <= most)).alias("within"), share(n > most).alias("over"))


def size_histogram(chunks: DataFrame, width: int = 200, last: int = 9) -> DataFrame:
    bucket = F.least(F.floor(count_tokens(F.col("text")) / width), F.lit(last)).cast("int")
    return chunks.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def size_ladder(chunks: DataFrame, steps: tuple[int, ...] = HISTOGRAM) -> DataFrame:
    """Chunks by the first of the irregular thresholds that they are under."""
    n = F.col("n")
    under = F.coalesce(*[F.when(n < s, F.lit(s)) for s in steps], F.lit(1 << 30))
    sizes = chunks.select(count_tokens(F.col("text")).alias("n")).groupBy("n").agg(F.count(F.lit(1)).alias("of"))  # each text is counted once
    return sizes.groupBy(under.alias("under")).agg(F.sum("of").alias("n"))


def metadata_coverage(chunks: DataFrame) -> DataFrame:
    m = lambda k: F.col(f"metadata.{k}")
    return chunks.agg(F.count(F.lit(1)).alias("chunks"), *[F.count_if(m(k).isNotNull() & (m(k) != "")).alias(k) for k in ("manual_id", "level1_id", "content_type", "procedure_name")], *[F.count_if(F.size(m(k)) > 0).alias(k) for k in ("has_safety_callouts", "figure_references", "cross_references")])


def issue_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("check", "severity").agg(F.count(F.lit(1)).alias("n"))


def cleanup_statistics(pages: DataFrame) -> DataFrame:
    """Per manual, what cleaning did: pages as ``cleaned_pages`` gives them."""
    garbage = F.size("garbage_lines")
    return pages.groupBy("manual_id").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("substitutions_applied").cast("long").alias("substitutions"), F.count_if(F.col("substitutions_applied") > 0).alias("pages_with_substitutions"),
        F.sum(garbage).cast("long").alias("garbage_lines"), F.count_if(garbage > 0).alias("pages_with_garbage"), F.count_if(F.col("extracted_page_id") != "").alias("page_ids"),
    )


def level1_frequency(bounds: DataFrame) -> DataFrame:
    """How often each id of the first level begins a boundary."""
    return bounds.where("level = 1").groupBy("id").agg(F.count(F.lit(1)).alias("n"))


def size_extremes(chunks: DataFrame, k: int = 5) -> DataFrame:
    """The k smallest and the k largest chunks by tokens; ties by chunk id."""
    sizes = chunks.select("chunk_id", count_tokens(F.col("text")).cast("long").alias("n"))
    ends = (("smallest", F.asc("n")), ("largest", F.desc("n")))
    small, large = (sizes.orderBy(order, "chunk_id").limit(k).select(F.lit(kind).alias("kind"), "chunk_id", "n") for kind, order in ends)
    return small.unionByName(large)
