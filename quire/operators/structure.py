"""Lines, boundaries and the manifest of many manuals at once, partitioned by manual."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions.text import lines, strip, word_counts
from quire.operators.folds import BUCKET, Gaps, Levels, before, folded, matched, running, same
from quire.sources.profile import Profile, java
from quire.sources.storage import written

BOUNDARY = ["manual_id", "level", "level_name", "id", "title", "page_number", "line_number"]


def numbered_pages(pages: DataFrame) -> DataFrame:
    """pages with offset, the number of their first line in the manual. Texts are written once, in order inside slices of a manual; how many lines
    are before a slice is a written table of a row a slice. Slices are those of pages, if they have any."""
    cut = F.col("slice") if "slice" in pages.columns else F.floor(F.col("page_number") / BUCKET)
    df = pages.select("manual_id", "page_number", cut.alias("slice"), "text")
    df = df.withColumn("n", F.size(lines(F.coalesce("text", F.lit("")))).cast("long"))
    inside = Window.partitionBy("manual_id", "slice").orderBy("page_number").rowsBetween(Window.unboundedPreceding, -1)
    texts = written(df.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))), "page-texts", "zstd")
    earlier = Window.partitionBy("_manual").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = texts.groupBy(F.col("manual_id").alias("_manual"), F.col("slice").alias("_slice")).agg(F.sum("n").alias("n"))
    sums = written(sums.select("_manual", "_slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier")), "slices")
    out = texts.join(sums, texts["manual_id"].eqNullSafe(sums["_manual"]) & texts["slice"].eqNullSafe(sums["_slice"]))
    return out.select("manual_id", "page_number", "text", (F.col("earlier") + F.col("inside")).alias("offset"))


def exploded(pages: DataFrame) -> DataFrame:
    """numbered pages -> (manual_id, page_number, line_number, text)."""
    rows = pages.select("manual_id", "page_number", "offset", F.posexplode(lines(F.coalesce("text", F.lit("")))).alias("i", "text"))
    return rows.select("manual_id", "page_number", (F.col("offset") + F.col("i")).alias("line_number"), "text")


def page_lines(pages: DataFrame) -> DataFrame:
    """(manual_id, page_number, line_number, text): lines are numbered through the manual."""
    return exploded(numbered_pages(pages))


def candidates(rows: DataFrame, profile: Profile) -> DataFrame:
    """Lines with the levels that they match, in the profile's order."""
    x = strip(F.col("text"))
    found = []
    for h in profile.hierarchy:
        tests = [(p, x.rlike(java(p))) for p in (h.id_pattern, h.title_pattern) if p]
        if tests:
            hit = tests[0][1] if len(tests) == 1 else tests[0][1] | tests[1][1]
            part = lambda p: F.when(x.rlike(java(p)), F.regexp_extract(x, java(p), 1)) if p else F.lit(None).cast("string")
            found.append(F.when(hit, F.struct(F.lit(h.level).alias("level"), F.lit(h.name).alias("level_name"), part(h.id_pattern).alias("id"), part(h.title_pattern).alias("title"))))
    return rows.where(x != "").withColumn("found", F.array_compact(F.array(*found))).where(F.size("found") > 0).drop("text")


def detect(rows: DataFrame, profile: Profile) -> DataFrame:
    """Boundaries. Of several levels on a line, the shallowest below the present one is taken, else the
    shallowest; this choice is the present level from there on. Lines with a candidate are found once and written."""
    found = candidates(rows, profile)
    if not any(h.id_pattern or h.title_pattern for h in profile.hierarchy):
        return found.select("manual_id", *[F.lit(None).cast(t).alias(n) for n, t in (("level", "int"), ("level_name", "string"), ("id", "string"), ("title", "string"))], "page_number", "line_number")
    found = written(found, "candidates")
    bits = F.aggregate("found", F.lit(0).cast("long"), lambda m, c: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), c["level"])))
    masks = found.select("manual_id", "line_number", bits.alias("mask"))
    levels = folded(masks, ["manual_id"], ["line_number"], Levels(max(h.level for h in profile.hierarchy)), found.select("manual_id", "line_number").schema.add("level", "integer"))
    taken = matched(found, levels, ["manual_id", "line_number"])
    of = F.filter("found", lambda c: c["level"] == F.col("level"))[0]
    return taken.select("manual_id", "level", of["level_name"].alias("level_name"), of["id"].alias("id"), of["title"].alias("title"), "page_number", "line_number")


def known_only(bounds: DataFrame, profile: Profile) -> DataFrame:
    keep = F.lit(True)
    for h in profile.hierarchy:
        if h.require_known_id and h.ids:
            keep = keep & ((F.col("level") != h.level) | F.coalesce(F.col("id").isin(h.ids), F.lit(False)))
    return bounds.where(keep)


def after_blank(bounds: DataFrame, rows: DataFrame, profile: Profile) -> DataFrame:
    gated = [h.level for h in profile.hierarchy if h.require_blank_before]
    if not gated:
        return bounds
    blank = rows.where(strip(F.col("text")) == "").select("manual_id", (F.col("line_number") + 1).alias("line_number"))
    bounds = written(bounds, "bounds")  # it is read twice
    free, held = bounds.where(~F.col("level").isin(gated)), bounds.where(F.col("level").isin(gated))
    return free.unionByName(matched(held, blank, ["manual_id", "line_number"], "left_semi"))


def far_enough(bounds: DataFrame, profile: Profile) -> DataFrame:
    """Greedy: a boundary too near the last one kept of its level goes."""
    gaps = {h.level: h.min_gap_lines for h in profile.hierarchy if h.min_gap_lines > 0}
    if not gaps:
        return bounds
    bounds = written(bounds, "bounds")
    gap = F.element_at(F.create_map(*[F.lit(x) for pair in gaps.items() for x in pair]), F.col("level")).cast("long")
    held = bounds.where(F.col("level").isin(*gaps)).withColumn("gap", gap)
    kept = folded(held, ["manual_id", "level"], ["line_number"], Gaps(), bounds.schema)
    return bounds.where(~F.col("level").isin(*gaps)).unionByName(kept)


def with_words(bounds: DataFrame, rows: DataFrame) -> DataFrame:
    """bounds with words: those from each boundary's line to before the next boundary."""
    counts = written(rows.select("manual_id", "line_number", word_counts(F.col("text")).alias("n")), "line-words")
    sums = before(counts, ["manual_id"], "line_number", "n", "before")
    every = counts.groupBy("manual_id").agg(F.sum("n").alias("all"))
    at = matched(sums, every, ["manual_id"]).select("manual_id", "line_number", "before", "all")
    out = matched(bounds, at, ["manual_id", "line_number"])
    out = written(out.withColumn("_back", -F.col("line_number")), "boundary-words")
    out = running(out, ["manual_id"], ["_back"], {"next": ("min", F.col("before"))})  # of the boundaries behind it
    return out.select(*bounds.columns, (F.coalesce("next", "all") - F.col("before")).alias("words"))


def enough_words(bounds: DataFrame, rows: DataFrame, profile: Profile) -> DataFrame:
    least = {h.level: h.min_content_words for h in profile.hierarchy if h.min_content_words > 0}
    if not least:
        return bounds
    short = F.lit(False)
    for level, n in least.items():
        short = short | ((F.col("level") == level) & (F.col("words") < n))
    return with_words(bounds, rows).where(~short).select(*bounds.columns)


PASSES = ("detected", "known ids", "blank line before", "least gap", "least words")


def filtered(bounds: DataFrame, rows: DataFrame, profile: Profile, counts: dict[str, Observation] | None = None) -> DataFrame:
    """The four filters in their order, each on what the one before kept. counts takes an observation for each of PASSES, of how many boundaries (n)
    it left; they are there when the result has been computed, which counts them on the way."""

    def told(df: DataFrame, name: str) -> DataFrame:
        if counts is None:
            return df
        counts[name] = Observation(f"boundaries, {name}, {uuid.uuid4().hex}")
        return df.observe(counts[name], F.count(F.lit(1)).alias("n"))

    df = told(bounds, PASSES[0])
    df = told(known_only(df, profile), PASSES[1])
    df = told(after_blank(df, rows, profile), PASSES[2])
    df = told(far_enough(df, profile), PASSES[3])
    return told(enough_words(df, rows, profile), PASSES[4])


def warnings(bounds: DataFrame, profile: Profile) -> DataFrame:
    """One message for each boundary whose id its level doesn't know."""
    odd = F.lit(False)
    for h in profile.hierarchy:
        if h.ids:
            odd = odd | ((F.col("level") == h.level) & ~F.col("id").isin(h.ids))
    return bounds.where(F.col("id").isNotNull() & odd).select("manual_id", "line_number", F.format_string("Boundary %s '%s' at line %d is not a known id", "level_name", "id", "line_number").alias("message"))


def diagnostics(bounds: DataFrame, rows: DataFrame) -> DataFrame:
    """Per manual: boundaries, words between them, and those with three words or fewer."""
    pages = rows.groupBy("manual_id").agg(F.countDistinct("page_number").alias("pages"))
    w = with_words(bounds, rows).groupBy("manual_id").agg(
        F.count(F.lit(1)).alias("boundaries"), F.min("words").alias("min_words"), F.median("words").cast("long").alias("median_words"),
        F.avg("words").cast("long").alias("avg_words"), F.max("words").alias("max_words"), F.count_if(F.col("words") <= 3).alias("suspects"),
    )
    return matched(pages, w, ["manual_id"]).withColumn("per_page", F.round(F.col("boundaries") / F.col("pages"), 6))


def manifest(bounds: DataFrame, profile: Profile) -> DataFrame:
    """A row per boundary in order (entry_idx), with its open ancestors' path, chunk_id, parent and children.
    A level is open if it was entered after every level above it: of each level the last entry so far, and the last line
    of a level above, are running totals over buckets. The ids of a null manual begin with ::."""
    levels = sorted(h.level for h in profile.hierarchy)
    seg, name = F.coalesce("id", "title", F.lit("")), F.coalesce("title", "id", F.lit(""))
    df = written(bounds.select(*BOUNDARY, F.struct("line_number", seg.alias("seg"), name.alias("name")).alias("_own")), "bounds")
    at = {n: F.when(F.col("level") == n, F.col("_own")) for n in levels}
    cut = {n: F.when(F.col("level") < n, F.col("line_number")) for n in levels}
    totals = {"entry_idx": ("sum", F.lit(1)), **{f"_at{n}": ("max", v) for n, v in at.items()}, **{f"_cut{n}": ("max", v) for n, v in cut.items()}}
    df = running(df, ["manual_id"], ["line_number"], totals)
    df = df.withColumns({"entry_idx": F.col("entry_idx").cast("int"), **{f"_at{n}": F.coalesce(at[n], F.col(f"_at{n}")) for n in levels}, **{f"_cut{n}": F.coalesce(cut[n], F.col(f"_cut{n}")) for n in levels}})
    open_ = lambda n: (F.col("level") >= n) & F.col(f"_at{n}").isNotNull() & (F.col(f"_at{n}.line_number") > F.coalesce(F.col(f"_cut{n}"), F.lit(-1)))
    pick = lambda part: F.array_compact(F.array(*[F.when(open_(n), F.col(f"_at{n}.{part}")) for n in levels]))
    df = df.withColumns({"segs": pick("seg"), "hierarchy_path": pick("name")})
    place = F.struct(F.col("page_number").cast("string").alias("start"), F.col("page_number").cast("string").alias("end"))
    manual = F.coalesce("manual_id", F.lit(""))
    df = df.select(
        "manual_id", "entry_idx", F.concat_ws("::", manual, "segs").alias("chunk_id"), "level", "level_name", name.alias("title"),
        "hierarchy_path", F.col("level_name").alias("content_type"), place.alias("page_range"), F.struct(F.col("line_number").alias("start"), F.col("line_number").alias("end")).alias("line_range"),
        F.when(F.size("segs") > 1, F.concat_ws("::", manual, F.slice("segs", 1, F.greatest(F.size("segs") - 1, F.lit(0))))).alias("parent_chunk_id"),
        *[F.array(*map(F.lit, v)).cast("array<string>").alias(k) for k, v in (("vehicle_applicability", [v.model for v in profile.vehicles]), ("engine_applicability", ["all"]), ("drivetrain_applicability", ["all"]), ("has_safety_callouts", []), ("figure_references", []), ("cross_references", []))],
    )
    kids = adjacency(df).groupBy("manual_id", "entry_idx").agg(F.transform(F.array_sort(F.collect_list(F.struct("child_idx", "child_id"))), lambda x: x["child_id"]).alias("children"))
    out = matched(df, kids, ["manual_id", "entry_idx"], "left")
    return out.withColumn("children", F.coalesce("children", F.array().cast("array<string>")))


def adjacency(entries: DataFrame) -> DataFrame:
    """(manual_id, entry_idx, child_idx, child_id): a row for each child of an entry; of entries with a parent's id, the first has them."""
    first = entries.groupBy("manual_id", "chunk_id").agg(F.min("entry_idx").alias("entry_idx"))
    kids = entries.where("parent_chunk_id is not null").select("manual_id", F.col("entry_idx").alias("child_idx"), F.col("chunk_id").alias("child_id"), F.col("parent_chunk_id").alias("chunk_id"))
    return matched(first, kids, ["manual_id", "chunk_id"]).select("manual_id", "entry_idx", "child_idx", "child_id")


def entry_text(pages: DataFrame, entries: DataFrame, skip: tuple[str, ...] = ()) -> DataFrame:
    """entries with their text, of numbered pages: the lines from each to before the next, whether skipped or not. Entries
    in skipped sections, by prefix of their id, and those before the first boundary go. A page is cut once, where entries begin in it,
    and its pieces go to their entries; which entry a page begins in is known from the numbers of entries alone."""
    keys = ["manual_id", "page_number"]
    marks = written(entries.select("manual_id", F.col("page_range.start").cast("long").alias("page_number"), F.col("line_range.start").alias("line"), F.col("entry_idx").cast("long").alias("entry_idx")), "marks")
    on_page = marks.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("line", "entry_idx"))).alias("marks"), F.max("entry_idx").alias("last"))
    numbers = pages.select("manual_id", F.col("page_number").cast("long").alias("page_number"), "offset")
    numbers = numbers.join(on_page, same(numbers, on_page, keys), "left").select(*[numbers[k] for k in keys], "marks", "last")
    held = before(written(numbers, "page-marks"), ["manual_id"], "page_number", "last", "carried", F.max)
    joined = pages.join(held, pages["manual_id"].eqNullSafe(held["manual_id"]) & (pages["page_number"] == held["page_number"]))
    df = joined.select(pages["manual_id"], pages["page_number"], lines(F.coalesce("text", F.lit(""))).alias("l"), "offset", "marks", "carried")
    # the piece before the page's first mark is the carried entry's
    cuts = F.concat(F.array(F.struct(F.col("offset").alias("line"), F.col("carried").alias("entry_idx"))), F.coalesce("marks", F.array().cast("array<struct<line: bigint, entry_idx: bigint>>")))
    df = df.withColumn("cuts", cuts).withColumn("end", F.col("offset") + F.size("l"))
    piece = lambda c, i: F.struct(c["entry_idx"].alias("entry_idx"), (c["line"] - F.col("offset")).cast("int").alias("a"), (F.coalesce(F.get("cuts", i + 1)["line"], F.col("end")) - F.col("offset")).cast("int").alias("b"))
    df = df.select("manual_id", "page_number", "l", F.explode(F.transform("cuts", piece)).alias("p")).where("p.entry_idx is not null and p.b > p.a")
    df = df.select("manual_id", "page_number", F.col("p.entry_idx").alias("entry_idx"), F.col("p.a").alias("a"), F.array_join(F.slice("l", F.col("p.a") + 1, F.col("p.b") - F.col("p.a")), "\n").alias("text"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_number", "a", "text"))), lambda x: x["text"]), "\n")
    # a name that is not null, so that texts stay where they were put together
    name = F.coalesce(F.concat(F.lit("="), F.col("manual_id")), F.lit("")).alias("_name")
    texts = df.groupBy(name, F.col("entry_idx").alias("_entry")).agg(strip(text).alias("text"))
    keep = F.lit(True)
    for s in skip:
        keep = keep & ~F.startswith(F.col("chunk_id"), F.concat(F.coalesce("manual_id", F.lit("")), F.lit(f"::{s}")))
    kept = entries.where(keep).select("*", name, F.col("entry_idx").cast("long").alias("_entry"))
    return kept.join(texts, ["_name", "_entry"]).drop("_name", "_entry")
