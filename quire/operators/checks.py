"""The quality suite: each check takes chunks and gives issues (check, severity, chunk_id, message, details)."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quire.functions.text import WS, any_match, count_tokens, lines, slices, split_words, strip, word_counts
from quire.operators.chunks import level1
from quire.sources.profile import Profile, java
from quire.sources.storage import settled, written

CHECKS = ("orphaned_steps", "split_safety_callouts", "size_outliers", "metadata_completeness", "duplicate_content", "cross_ref_validity", "profile_validation")
_STEP = rf"^(?:\(\d+\)|[a-z]\.){WS}"


def issues(df: DataFrame, check: str, severity: Column, message: Column, **details: Column) -> DataFrame:
    pairs = [x for k, v in details.items() for x in (F.lit(k), v.cast("string"))]
    return df.select(F.lit(check).alias("check"), severity.alias("severity"), "chunk_id", message.alias("message"), F.create_map(*pairs).cast("map<string,string>").alias("details"))


def _first_line(text: Column) -> Column:
    return strip(F.substring_index(strip(text), "\n", 1))


def orphaned_steps(chunks: DataFrame, p: Profile) -> DataFrame:
    """Chunks that begin with a step other than the first of its sequence."""
    first = _first_line(F.col("text"))
    value = F.coalesce(*[F.when(first.rlike(java(x)), F.regexp_extract(first, java(x), 1)) for x in p.step_patterns], F.lit(None).cast("string"))
    df = chunks.withColumn("v", value).where("v is not null")
    start = F.when(F.col("v").rlike(r"^\p{Nd}+$"), F.try_to_number("v", F.lit("999999999999999999")) == 1).when(F.col("v").rlike(r"^\p{L}+$"), F.lower("v") == "a").otherwise(False)
    return issues(df.where(~start), "orphaned_steps", F.lit("warning"), F.format_string("First step is '%s', not the start of a sequence", "v"), first_step=F.col("v"))


def split_callouts(chunks: DataFrame, p: Profile) -> DataFrame:
    """Chunks that begin with a callout and have nothing that it governs."""
    kinds = [c.pattern for c in p.callouts]
    chunks = chunks.select("chunk_id", lines(strip(F.col("text"))).alias("rows"))
    chunks = chunks.withColumn("first", strip(F.get("rows", F.lit(0))))
    first = F.col("first")
    level = F.coalesce(*[F.when(first.rlike(java(c.pattern)), F.lit(c.level)) for c in p.callouts], F.lit(None).cast("string"))
    upper = lambda x: (F.upper(x) == x) & (F.lower(x) != x)
    governed = lambda x: x.rlike(_STEP) | ((x != "") & ~any_match(x, kinds) & ~upper(x) & (count_tokens(x) > 3))
    # a line is stripped when it is come to; those after the first that is governed are not
    rest = F.slice("rows", 2, 1 << 30)
    df = chunks.withColumn("level", level).where(F.col("level").isNotNull() & ~F.exists(rest, lambda x: governed(strip(x))))
    severity = F.when(F.col("level") == "note", "warning").otherwise("error")
    return issues(df, "split_safety_callouts", severity, F.format_string("Nothing follows that the callout (%s) is about", "level"), callout_level=F.col("level"))


def size_outliers(chunks: DataFrame, least: int = 100, most: int = 3000) -> DataFrame:
    n = F.col("tokens") if "tokens" in chunks.columns else word_counts(F.col("text"))
    df = chunks.select("chunk_id", n.alias("n"))
    df = df.where(F.abs(2 * F.col("n") - (least + most)) > most - least)  # outside of both; n is named once, so it is counted once
    message = F.when(F.col("n") < least, F.format_string(f"Chunk has %d tokens, below {least}", "n")).otherwise(F.format_string(f"Chunk has %d tokens, above {most}", "n"))
    return issues(df, "size_outliers", F.lit("warning"), message, token_count=F.col("n"))


def missing_metadata(chunks: DataFrame) -> DataFrame:
    """Keys that are absent; a null counts as present. chunks: with raw, the metadata as a map."""
    keys = F.array(*map(F.lit, ("manual_id", "level1_id", "content_type")))
    df = chunks.select("chunk_id", F.explode(F.filter(keys, lambda k: ~F.map_contains_key("raw", k))).alias("field"))
    return issues(df, "metadata_completeness", F.lit("error"), F.format_string("metadata lacks '%s'", "field"), field=F.col("field"))


def _named(manual: Column) -> Column:
    """A manual's name in joins: no name is null, and a null manual's is no other's."""
    return F.coalesce(F.concat(F.lit("="), manual), F.lit(""))


def token_sets(chunks: DataFrame, order: str = "chunk_ord") -> DataFrame:
    """(manual_id, ord, chunk_id, n tokens, set, k tokens in the set, h, h2) of chunks with tokens, as a written table. Tokens are 64-bit hashes; sets,
    in order, are told apart by two hashes."""
    names = ["manual_id", "ord", "chunk_id"]
    df = chunks.select(_named(F.col("manual_id")).alias("manual_id"), F.col(order).alias("ord"), "chunk_id", F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in slices(whole, "text"):
                words, ends = split_words(part.column("text"))
                code = words.dictionary_encode()
                hashes = pd.util.hash_array(code.dictionary.to_numpy(zero_copy_only=False).astype(object), categorize=False).view(np.int64)
                known, at = np.unique(hashes, return_inverse=True)
                row = np.repeat(np.arange(part.num_rows), np.diff(ends))
                pairs = np.unique(row * len(known) + at[code.indices.to_numpy()]) if len(row) else np.zeros(0, np.int64)
                row, size = pairs // max(len(known), 1), np.diff(ends)
                sets = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)), pa.array(known[pairs % max(len(known), 1)]))
                yield pa.RecordBatch.from_arrays([*part.select(names).columns, pa.array(size.astype(np.int32)), sets], [*names, "n", "set"])

    shape = T.StructType([*df.select(*names).schema, T.StructField("n", T.IntegerType()), T.StructField("set", T.ArrayType(T.LongType()))])
    return written(df.mapInArrow(run, shape).where("n > 0").withColumns({"k": F.size("set"), "h": F.xxhash64("set"), "h2": F.hash("set")}), "sets")


def class_members(sets: DataFrame) -> DataFrame:
    """Chunks of a manual with the same set and number of tokens are a class, named by its first chunk: (manual_id, rep, ord, chunk_id). No sets
    are dealt out."""
    same = ["manual_id", "n", "k", "h", "h2"]
    rows = sets.select(*same, "ord", "chunk_id")
    return written(rows.join(rows.groupBy(*same).agg(F.min("ord").alias("rep")), same).select("manual_id", "rep", "ord", "chunk_id"), "set-members")


#: Counters of tokens: 16 MB in each task; and the stretches in which tasks' counters meet.
COUNTERS, STRETCHES = 1 << 21, 256


def packed_counts(sets: DataFrame) -> DataFrame:
    """(stretch, counts): how many of its sets each task has with a token, in COUNTERS counters, packed by stretches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            k = batch.column("k").to_numpy()
            held += np.bincount((batch.column("set").flatten().to_numpy() ^ np.repeat(batch.column("seed").to_numpy(), k)) & (COUNTERS - 1), minlength=COUNTERS)
        parts = np.array_split(held, min(STRETCHES, COUNTERS))
        some = [i for i, x in enumerate(parts) if x.any()]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([zlib.compress(parts[i].tobytes(), 1) for i in some], pa.binary())], ["stretch", "counts"])

    return sets.select(F.xxhash64("manual_id").alias("seed"), "k", "set").mapInArrow(run, "stretch int, counts binary")


def token_counts(sets: DataFrame) -> np.ndarray:
    """How many sets have a token, in COUNTERS counters that tokens share by their hash: never too few."""

    def added(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(zlib.decompress(x.as_py()), np.int64) for x in rows.column("counts"))
        return rows.select(["stretch"])[:1].append_column("counts", pa.array([zlib.compress(total.tobytes(), 1)], pa.binary()))

    # written, so that its shuffle files go
    rows = written(packed_counts(sets).groupBy("stretch").applyInArrow(added, "stretch int, counts binary"), "token-counts").toArrow()
    out = np.zeros(COUNTERS, np.int64)
    parts = np.array_split(out, min(STRETCHES, COUNTERS))  # views
    for i, x in zip(rows.column("stretch").to_pylist(), rows.column("counts").to_pylist(), strict=True):
        parts[i][:] = np.frombuffer(zlib.decompress(x), np.int64)
    return out


def set_prefixes(sets: DataFrame, counts: np.ndarray, threshold: float) -> DataFrame:
    """(manual_id, w, rep, k, n, r): each set's first tokens in order of their counters, then of their hashes, as many as two sets that are alike
    share one of; r is a token's place. Tokens that no other set has are left out."""
    held = sets.sparkSession.sparkContext.broadcast(counts.astype(np.int32) if counts.max(initial=0) < 1 << 31 else counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.column("k").to_numpy().astype(np.int64)
            row, w = np.repeat(np.arange(len(k)), k), batch.column("set").flatten().to_numpy()
            f = held.value[(w ^ np.repeat(batch.column("seed").to_numpy(), k)) & (COUNTERS - 1)]
            order = np.lexsort((w, f, row))
            r = np.arange(len(w)) - np.repeat(np.cumsum(k) - k, k) + 1
            most = k - np.ceil(k * threshold - 1e-9).astype(np.int64) + 1
            f = f[order]
            kept = np.flatnonzero((r <= np.repeat(most, k)) & (f > 1))
            others = batch.select(["manual_id", "rep", "k", "n"]).take(pa.array(row[kept]))
            yield pa.RecordBatch.from_arrays([*others.columns, pa.array(w[order[kept]]), pa.array(r[kept].astype(np.int32))], [*others.schema.names, "w", "r"])

    df = sets.select("manual_id", F.col("ord").alias("rep"), "k", "n", F.xxhash64("manual_id").alias("seed"), "set")
    shape = T.StructType([*df.select("manual_id", "rep", "k", "n").schema, T.StructField("w", T.LongType()), T.StructField("r", T.IntegerType())])
    return df.mapInArrow(run, shape)


def duplicate_links(sets: DataFrame, members: DataFrame, threshold: float = 0.95) -> DataFrame:
    """(manual_id, ra, rb, sim) of classes whose sets are alike and whose token counts are near, ra before rb. Two such sets share
    one of their first tokens in any order of all tokens (prefix filter), here of rarity, as counters know it; lengths, the places of the shared
    token, and how many of the first tokens are shared bound what else they can share, and only pairs that may reach the threshold are compared
    whole. Sets of others stay where they are."""
    others = members.where("rep <> ord").select("manual_id", F.col("ord").alias("rep"))
    prefix = set_prefixes(sets, token_counts(sets), threshold).join(others, ["manual_id", "rep"], "left_anti")
    prefix = written(prefix, "set-prefixes")
    a, b = prefix.alias("a"), prefix.alias("b")
    alike = lambda c: F.least(f"a.{c}", f"b.{c}") >= threshold * F.greatest(f"a.{c}", f"b.{c}") - 1e-9
    least = F.ceil((F.col("a.k") + F.col("b.k")) * F.lit(threshold / (1 + threshold)) - 1e-9)
    may = F.least("a.r", "b.r") + F.least(F.col("a.k") - F.col("a.r"), F.col("b.k") - F.col("b.r")) >= least
    near = (F.col("a.manual_id") == F.col("b.manual_id")) & (F.col("a.w") == F.col("b.w")) & (F.col("a.rep") < F.col("b.rep")) & alike("k") & alike("n") & may
    # what both sets have is in both beginnings, or else behind that one which ends first
    behind = F.greatest(*[F.ceil(F.col(f"{x}.k") * F.lit(threshold) - 1e-9) - 1 for x in "ab"])
    pairs = a.join(b, near).groupBy(F.col("a.manual_id").alias("manual_id"), F.col("a.rep").alias("ra"), F.col("b.rep").alias("rb"))
    pairs = pairs.agg(F.count(F.lit(1)).alias("shared"), F.first(least - behind).alias("least")).where("shared >= least")
    pairs = written(pairs.select("manual_id", "ra", "rb"), "set-pairs")
    asked = written(pairs.select("manual_id", F.col("ra").alias("ord")).union(pairs.select("manual_id", "rb")).distinct(), "set-asked")
    sets = written(sets.join(asked, ["manual_id", "ord"], "left_semi").select("manual_id", "ord", "set", "n"), "sets-asked")
    side = lambda x: sets.select("manual_id", F.col("ord").alias(f"r{x}"), F.col("set").alias(f"s{x}"), F.col("n").alias(f"n{x}"))
    both = F.size(F.array_intersect("sa", "sb"))
    pairs = pairs.join(side("a"), ["manual_id", "ra"]).join(side("b"), ["manual_id", "rb"]).withColumn("both", both)
    pairs = pairs.withColumn("sim", F.col("both") / (F.size("sa") + F.size("sb") - F.col("both")))
    return pairs.where((F.col("sim") >= threshold) & (F.least("na", "nb") >= threshold * F.greatest("na", "nb"))).select("manual_id", "ra", "rb", "sim")


def duplicate_pairs(chunks: DataFrame, threshold: float = 0.95, order: str = "chunk_ord") -> DataFrame:
    """(manual_id, oa, ob, a, b, sim): every link between the first chunks of two classes, and each other member of a class with
    its first chunk, so that no link between different texts is lost and copies are not expanded into all their pairs."""

    def made() -> DataFrame:
        sets = token_sets(chunks, order)
        members = class_members(sets)
        names = lambda x: members.where("rep = ord").select("manual_id", F.col("rep").alias(f"r{x}"), F.col("chunk_id").alias(x))
        links = duplicate_links(sets, members, threshold).join(names("a"), ["manual_id", "ra"]).join(names("b"), ["manual_id", "rb"])
        links = links.select("manual_id", F.col("ra").alias("oa"), F.col("rb").alias("ob"), "a", "b", "sim")
        own = members.where("rep <> ord").select("manual_id", F.col("rep").alias("ra"), F.col("ord").alias("ob"), F.col("chunk_id").alias("b")).join(names("a"), ["manual_id", "ra"])
        both = links.unionByName(own.select("manual_id", F.col("ra").alias("oa"), "ob", "a", "b", F.lit(1.0).alias("sim")))
        return both.withColumn("manual_id", F.when(F.col("manual_id") != "", F.substring("manual_id", 2, 1 << 30)))

    return settled(chunks.sparkSession, made, "duplicate-pairs")


def duplicates(chunks: DataFrame, threshold: float = 0.95) -> DataFrame:
    pairs = duplicate_pairs(chunks, threshold)
    # chunk ids repeat; a pair of ids is told once
    pairs = pairs.groupBy("manual_id", "a", "b").agg(F.min_by("sim", F.struct("oa", "ob")).alias("sim"))
    return issues(pairs.withColumn("chunk_id", F.col("a")), "duplicate_content", F.lit("warning"), F.format_string("Near-duplicate of '%s' (similarity %.2f)", "b", "sim"), duplicate_of=F.col("b"), similarity=F.round("sim", 6))


def broken_references(chunks: DataFrame, p: Profile) -> DataFrame:
    """References that no chunk id begins with, whose last segment is no segment of an id, and that are no
    paragraph heading of another chunk."""
    refs = chunks.select("manual_id", "chunk_id", F.explode("metadata.cross_references").alias("ref"))
    refs = refs.withColumn("last", F.when(F.contains("ref", F.lit("::")), F.element_at(F.split("ref", "::"), -1)))
    ids = chunks.select("chunk_id").distinct()
    asked = refs.select("ref").distinct()
    # prefixes: every id's beginnings of the lengths that references have
    lengths = asked.select(F.length("ref").alias("n")).distinct()
    begins = ids.join(F.broadcast(lengths), F.length("chunk_id") >= F.col("n")).select(F.expr("left(chunk_id, n)").alias("ref")).distinct()
    refs = refs.join(begins, "ref", "left_anti")
    parts = ids.select(F.explode(F.slice(F.split("chunk_id", "::"), 2, 1 << 30)).alias("last")).distinct()
    refs = refs.join(parts, "last", "left_anti")
    # headings: a line that is a name still sought, a dot and white space; the end of a line is white space, that of the text is not
    refs = written(refs, "broken-references")
    sought = refs.where("last is not null").select("last").distinct()
    sizes = sought.select(F.length("last").alias("n")).distinct()  # no more than a text has characters
    longest = F.broadcast(sizes)
    rows = lines(F.coalesce("text", F.lit("")))
    ended = F.transform(rows, lambda x, i: F.when(i < F.size(rows) - 1, F.concat(x, F.lit("\n"))).otherwise(x))
    dotted = F.filter(ended, lambda x: x.rlike(rf"\.{WS}"))
    heads = chunks.select(F.col("chunk_id").alias("other"), F.explode(dotted).alias("line")).join(longest, F.substring("line", F.col("n") + 1, F.lit(1)) == ".")
    heads = heads.where(F.substring("line", F.col("n") + 2, F.lit(1)).rlike(WS)).select("other", F.expr("left(line, n)").alias("last"))
    heads = heads.join(sought, "last", "left_semi").distinct()
    found = refs.select("chunk_id", "last").distinct().join(heads, "last").where(F.col("chunk_id") != F.col("other")).select("chunk_id", "last").distinct()
    refs = refs.join(found, ["chunk_id", "last"], "left_anti")
    skipped = reduce(lambda a, s: a | F.startswith(F.col("ref"), F.concat(F.coalesce("manual_id", F.lit("")), F.lit(f"::{s}"))), p.skip_sections, F.lit(False))
    severity = F.when(skipped, "warning").otherwise(p.unresolved_severity or "error")
    message = F.concat(F.format_string("Nothing answers to the reference '%s'", "ref"), F.when(skipped, " (skipped section)").otherwise(""))
    return issues(refs, "cross_ref_validity", severity, message, target=F.col("ref"), skipped=skipped)


def unknown_sections(chunks: DataFrame, p: Profile) -> DataFrame:
    known = [i for h in p.hierarchy if h.level == 1 for i in h.ids]
    own = F.col("metadata.level1_id")
    df = chunks.where((own != "") & ~own.isin(known)) if known else chunks.limit(0)
    return issues(df, "profile_validation", F.lit("warning"), F.format_string("level1_id '%s' is not a known id", "metadata.level1_id"), level1_id=own)


def with_raw(chunks: DataFrame) -> DataFrame:
    """Chunks of our own making have all keys that their type has."""
    if "raw" in chunks.columns:
        return chunks
    keys = F.create_map(*[x for f in chunks.schema["metadata"].dataType for x in (F.lit(f.name), F.lit(None).cast("string"))])
    return chunks.withColumn("raw", F.when(F.col("metadata").isNotNull(), keys))


def suite(chunks: DataFrame, p: Profile) -> DataFrame:
    """All checks' issues."""
    parts = [size_outliers(chunks), missing_metadata(with_raw(chunks)), duplicates(chunks), broken_references(chunks, p), unknown_sections(chunks, p)]
    if p.step_patterns:
        parts.append(orphaned_steps(chunks, p))
    if p.callouts:
        parts.append(split_callouts(chunks, p))
    return reduce(DataFrame.unionByName, parts)


def summary(found: DataFrame) -> DataFrame:
    """Errors and warnings of every check, zeros too, and whether all passes."""
    checks = found.sparkSession.createDataFrame([(c,) for c in sorted(CHECKS)], "check string")
    counts = found.groupBy("check").agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))
    df = checks.join(counts, "check", "left").fillna(0)
    return df.withColumn("passed", F.sum("errors").over(Window.partitionBy()) == 0)


__all__ = ["CHECKS", "suite", "summary", "level1"]
