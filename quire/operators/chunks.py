"""Entries to chunks: rules, tags, references and the merge across entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quire.functions.text import find_all, word_counts
from quire.operators import rules
from quire.operators.folds import Runs, folded, matched, running
from quire.operators.structure import detect, entry_text, exploded, filtered, manifest, numbered_pages
from quire.sources.profile import Profile
from quire.sources.storage import settled, written


def header(title: str, path: Column) -> Column:
    return F.concat_ws(" | ", F.lit(title), path)


def level1(chunk_id: Column) -> Column:
    return F.coalesce(F.get(F.split(chunk_id, "::"), F.lit(1)), F.lit(""))


def applicability(text: Column, p: Profile) -> dict[str, Column]:
    """Models, engines and drive types that a text names, in any case; "all" if it names none."""
    low = F.lower(text)
    models, engines, drives = {}, {}, {}
    for v in p.vehicles:
        models.setdefault(v.model, []).append(v.model)
        for e in v.engines:
            engines.setdefault(e.name, []).extend([e.name, e.code, *e.aliases])
        for d in v.drive_type:
            drives.setdefault(d, []).append(d)

    def named(kinds: dict[str, list[str]]) -> Column:
        parts = []
        for label, needles in kinds.items():
            hit = F.lit(False)
            for n in needles:
                hit = hit | F.contains(low, F.lit(n.lower()))
            parts.append(F.when(hit, F.lit(label)))
        found = F.array_compact(F.array(*parts)) if parts else F.array().cast("array<string>")
        return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("all")))

    return {"vehicle_models": named(models), "engine_applicability": named(engines), "drivetrain_applicability": named(drives)}


def references(text: Column, manual_id: Column, p: Profile) -> dict[str, Column]:
    """Figures and cross-references of a text, sorted and distinct; those of a null manual begin with ::, as its ids do."""
    none = F.array().cast("array<string>")

    sort = lambda c: F.array_sort(F.array_distinct(c))
    refs = F.flatten(F.array(*[find_all(text, x) for x in p.cross_reference_patterns])) if p.cross_reference_patterns else none
    refs = F.transform(refs, lambda r: F.concat(F.coalesce(manual_id, F.lit("")), F.lit("::"), r))
    return {
        "figure_references": sort(find_all(text, p.figure_pattern)) if p.figure_pattern else none,
        "cross_references": sort(refs),
    }


def parts_of(entries: DataFrame, p: Profile) -> DataFrame:
    """A row per part: the rules on each entry's text, with the levels of its callouts, sorted and distinct. Texts cross to Python once, and
    parts come back a few texts at a time."""

    def levels(text: str) -> list[str]:
        return sorted({c[0] for c in rules.callouts(text, p.callouts)}) if p.callouts else []

    tagged = entries.drop("has_safety_callouts").withColumns(applicability(F.col("text"), p))
    shape = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("part_idx", T.IntegerType()), T.StructField("part", T.StringType()), T.StructField("has_safety_callouts", T.ArrayType(T.StringType())), T.StructField("tokens", T.LongType())])

    def assemble(text: str) -> list[tuple]:
        made = rules.assembled(text, p)
        return [(len(made), i, x, levels(x), rules.size(x)) for i, x in enumerate(made)]

    return rules.on_texts(tagged, "text", assemble, shape)


def with_metadata(parts: DataFrame, p: Profile) -> DataFrame:
    """(manual_id, entry_idx, part_idx, chunk_id, text, metadata, tokens)"""
    df = parts.withColumns(references(F.col("part"), F.col("manual_id"), p))
    own = F.when(F.col("n") > 1, F.concat("chunk_id", F.lit("::part"), (F.col("part_idx") + 1).cast("string"))).otherwise(F.col("chunk_id"))
    meta = F.struct("manual_id", level1(F.col("chunk_id")).alias("level1_id"), F.col("title").alias("procedure_name"), header(p.manual_title, F.col("hierarchy_path")).alias("hierarchical_header"), "hierarchy_path", "content_type", "page_range", "vehicle_models", "engine_applicability", "drivetrain_applicability", "has_safety_callouts", "figure_references", "cross_references")
    return df.select("manual_id", "entry_idx", "part_idx", own.alias("chunk_id"), F.col("part").alias("text"), meta.alias("metadata"), "tokens")


def merge_across(chunks: DataFrame, order: list[str], least: int = rules.LEAST, most: int = rules.MOST) -> DataFrame:
    """A chunk under the least size goes before the next of its first level if both fit; the next one's
    id and metadata stay. order: a whole number, then what tells chunks with the same number apart. Only sizes (tokens, counted where
    chunks lack them) are gone through in order; texts are put together by aggregation, and those that stay alone are only given their number."""
    n = F.col("tokens") if "tokens" in chunks.columns else word_counts(F.col("text"))
    sizes = written(chunks.select("manual_id", *order, level1(F.col("chunk_id")).alias("label"), n.alias("n")), "chunk-sizes")
    begun = written(folded(sizes, ["manual_id"], order, Runs(least, most), sizes.select("manual_id", *order, "n").schema.add("begins", "long")), "chunk-runs")
    groups = running(begun, ["manual_id"], order, {"earlier": ("sum", F.col("begins"))}).withColumn("grp", F.col("earlier") + F.col("begins") - 1)
    size = Window.partitionBy("manual_id", "grp")
    groups = groups.select("manual_id", *order, "grp", (F.count(F.lit(1)).over(size) == 1).alias("alone"), F.sum("n").over(size).alias("tokens"))
    groups = written(groups, "chunk-groups")
    chunks = chunks.select("manual_id", *order, "chunk_id", "text", "metadata")
    put = lambda where: matched(chunks, groups.where(where).drop("alone"), ["manual_id", *order])
    rows = F.array_sort(F.collect_list(F.struct(*order, "text", "chunk_id", "metadata")))
    out = put("not alone").groupBy("manual_id", "grp").agg(rows.alias("rows"), F.first("tokens").alias("tokens"))
    last = F.element_at("rows", -1)
    joined = out.select("manual_id", F.col("grp").alias("chunk_ord"), last["chunk_id"].alias("chunk_id"), F.array_join(F.transform("rows", lambda r: r["text"]), "\n\n").alias("text"), last["metadata"].alias("metadata"), "tokens")
    return joined.unionByName(put("alone").select("manual_id", F.col("grp").alias("chunk_ord"), "chunk_id", F.coalesce("text", F.lit("")).alias("text"), "metadata", "tokens"))


def assembled(pages: DataFrame, p: Profile) -> DataFrame:
    """Cleaned pages to chunks: (manual_id, chunk_ord, chunk_id, text, metadata, tokens)."""
    spark = pages.sparkSession

    def parts() -> DataFrame:
        numbered = numbered_pages(pages)
        rows = exploded(numbered)
        entries = settled(spark, lambda: manifest(filtered(detect(rows, p), rows, p), p), "entries")
        return with_metadata(parts_of(entry_text(numbered, entries, p.skip_sections), p), p)

    return merge_across(settled(spark, parts, "parts", "zstd"), ["entry_idx", "part_idx"])
