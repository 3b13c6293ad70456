"""Questions: what they ask about, and ranked results with their surroundings."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions.text import point_id
from quire.operators import index
from quire.sources import snapshots
from quire.sources.storage import written

# Patterns and words that questions are read by; (?i) where case does not matter.
VEHICLES = [r"(?i)\bCherokee\b", r"(?i)\bCJ[-\s]?([23567])\b", r"(?i)\bCJ[-\s]?3[AB]\b", r"(?i)\bM38A1\b", r"(?i)\bM38\b", r"\bXJ\b", r"(?i)\bWrangler\b"]
ENGINES = [r"\b(\d+\.\d+)\s*[Ll]\b", r"\bI[46]\b", r"\bV[68]\b", r"(?i)\bHurricane\b", r"\b[Dd]iesel\b", r"\bF[\-]?4\b", r"(?i)\bF[\-]?head\b", r"(?i)\bL[\-]?head\b"]
DRIVETRAINS = [r"(?i)\b4WD\b", r"(?i)\b2WD\b", r"(?i)\bAWD\b", r"(?i)\b4x4\b", r"(?i)\b4[\s-]?wheel\s+drive\b", r"(?i)\b2[\s-]?wheel\s+drive\b", r"(?i)\btransfer\s+case\b"]
SYSTEMS = {
    "brake": ["brake", "braking", "caliper", "rotor", "pad", "drum", "abs"],
    "engine": ["engine", "motor", "cylinder", "piston", "valve", "camshaft", "crankshaft", "oil pump"],
    "cooling": ["coolant", "radiator", "thermostat", "water pump", "cooling"],
    "electrical": ["battery", "alternator", "starter", "wiring", "fuse", "ignition", "spark plug"],
    "transmission": ["transmission", "clutch", "gear", "shift", "transaxle"],
    "suspension": ["suspension", "shock", "spring", "strut", "control arm", "ball joint"],
    "steering": ["steering", "power steering", "tie rod", "rack"],
    "fuel": ["fuel", "carburetor", "carburettor", "fuel pump", "fuel filter", "fuel injection", "injector"],
    "exhaust": ["exhaust", "muffler", "catalytic", "manifold"],
    "lubrication": ["oil", "lubrication", "lubricant", "grease"],
    "body": ["body", "door", "window", "fender", "hood", "bumper"],
    "hvac": ["heater", "air conditioning", "a/c", "hvac", "blower"],
    "transfer case": ["transfer case"],
    "axle": ["axle", "differential", "drive shaft", "driveshaft"],
}
PROCEDURE = [r"\bhow\s+(do|to|can)\b", r"\bprocedure\b", r"\breplace\b", r"\binstall\b", r"\bremov(e|al)\b", r"\bchange\b", r"\badjust\b", r"\bstep[s]?\b", r"\brepair\b", r"\brebuild\b", r"\bservice\b", r"\bbleed\b", r"\bflush\b"]
SPECIFICATION = [r"\bspec(ification)?s?\b", r"\btorque\b", r"\bcapacity\b", r"\bpressure\b", r"\bwhat\s+is\b", r"\bwhat\s+are\b", r"\bhow\s+much\b", r"\bhow\s+many\b", r"\brating\b", r"\bsize\b", r"\bweight\b", r"\bdimension\b", r"\bclearance\b", r"\bgap\b", r"\bfluid\s+type\b"]
DIAGNOSTIC = [r"\bwon'?t\s+start\b", r"\btroubleshoot\b", r"\bdiagnos(e|tic|is)\b", r"\bwhat\s+should\s+I\s+check\b", r"\bproblem\b", r"\bnoise\b", r"\bleak\b", r"\boverheating\b", r"\bvibration\b", r"\bfault\b", r"\bcheck\b", r"\bwhy\b"]
#: A result's share of the score of the one that led to it.
SHARES = {"parent": 0.7, "sibling": 0.6, "cross_ref": 0.5}


def scopes(q: Column) -> dict[str, Column]:
    """What a question names: first matches in order of the patterns, and systems by their words."""
    firsts = lambda ps: F.array_distinct(F.filter(F.array(*[F.regexp_extract(q, p, 0) for p in ps]), lambda x: x != ""))
    low = F.lower(q)

    def names(words: list[str]) -> Column:
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(low, F.lit(w))
        return hit

    systems = F.array_compact(F.array(*[F.when(names(ws), F.lit(s)) for s, ws in SYSTEMS.items()]))
    return {"vehicle_scope": firsts(VEHICLES), "engine_scope": firsts(ENGINES), "drivetrain_scope": firsts(DRIVETRAINS), "system_scope": systems}


def query_type(q: Column) -> Column:
    """The kind with most patterns; procedure wins every tie that it is part of."""
    count = lambda ps: sum((q.rlike(f"(?i){p}").cast("int") for p in ps), F.lit(0))
    p, s, d = count(PROCEDURE), count(SPECIFICATION), count(DIAGNOSTIC)
    return F.when((d >= s) & (d > p), "diagnostic").when((s >= d) & (s > p), "specification").otherwise("procedure")


def analyzed(queries: DataFrame, manuals: list[str] | None = None) -> DataFrame:
    only = manuals[0] if manuals and len(manuals) == 1 else None
    q = F.col("query")
    return queries.withColumns({**scopes(q), "query_type": query_type(q), "manual_id_filter": F.lit(only).cast("string")})


def enriched(primary: DataFrame, lookups: dict[str, DataFrame] | None = None, best: int | None = None) -> DataFrame:
    """primary (query_id, ord, chunk_id, score, parent_chunk_id, sibling_chunk_ids, cross_references) with parents, siblings
    and other chunks that cite the same targets. An id that a query already has is not added again. best: only ``reranked``'s so many are wanted,
    scores falling with ord: of the chunks that cite a target only the first by id can be among them, as many as that and what a query already has."""
    shape = ["query_id", "chunk_id", "score", "source", "ord"]
    base = primary.select("query_id", "chunk_id", "score", F.lit("primary").alias("source"), F.array(F.lit(0).cast("long"), F.col("ord").cast("long"), F.lit(0).cast("long")).alias("ord"))

    def added(rows: DataFrame, kind: str, step: int, have: DataFrame) -> DataFrame:
        rows = rows.join(have.select("query_id", "chunk_id").distinct(), ["query_id", "chunk_id"], "left_anti")
        w = Window.partitionBy("query_id", "chunk_id").orderBy("o", "i")
        rows = rows.withColumn("_r", F.row_number().over(w)).where("_r = 1")
        return rows.select("query_id", "chunk_id", (F.col("score") * SHARES[kind]).alias("score"), F.lit(kind).alias("source"), F.array(F.lit(step).cast("long"), F.col("o").cast("long"), F.col("i").cast("long")).alias("ord"))

    parents = primary.where("parent_chunk_id is not null").select("query_id", F.col("parent_chunk_id").alias("chunk_id"), "score", F.col("ord").alias("o"), F.lit(0).alias("i"))
    out = base.unionByName(added(parents, "parent", 1, base))
    siblings = primary.select("query_id", "score", F.col("ord").alias("o"), F.posexplode("sibling_chunk_ids").alias("i", "chunk_id"))
    out = out.unionByName(added(siblings, "sibling", 2, out))
    if lookups:
        refs = primary.select("query_id", "score", F.col("ord").alias("o"), F.posexplode("cross_references").alias("i", "cross_reference"))
        citing = lookups["cross_ref_lookup"].select("cross_reference", "chunk_id")
        if best is not None:
            have = out.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
            citing = citing.join(refs.select("cross_reference").distinct(), "cross_reference", "left_semi").distinct()
            first = F.row_number().over(Window.partitionBy("cross_reference").orderBy("chunk_id"))
            citing = citing.withColumn("_c", first).where(F.col("_c") <= best + have).drop("_c")
        cited = refs.join(citing, "cross_reference").drop("cross_reference")
        out = out.unionByName(added(cited, "cross_ref", 3, out))
    return out.select(*shape)


def reranked(results: DataFrame, top: int = 5) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "ord", "chunk_id")
    return results.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)

_RESULT = "array<struct<chunk_id: string, text: string, metadata: map<string, string>, score: double, source: string>>"


def with_payload(results: DataFrame, points: DataFrame, procedures: DataFrame | None) -> DataFrame:
    """results with text and metadata: those of the chunk for primary results; for a cross-reference its manual and the name
    of its procedure; nothing for the others, as they are known by id only."""
    own = points.select("chunk_id", F.col("text").alias("own_text"), F.col("metadata").alias("own"))
    out = results.join(own, "chunk_id", "left")
    if procedures is not None:
        first = procedures.groupBy("chunk_id").agg(F.min(F.struct("manual_id", "procedure_name")).alias("p"))
        out = out.join(first, "chunk_id", "left")
    else:
        out = out.withColumn("p", F.lit(None).cast("struct<manual_id: string, procedure_name: string>"))
    primary, cited = F.col("source") == "primary", F.col("source") == "cross_ref"
    named = F.create_map(F.lit("manual_id"), F.col("p.manual_id"), F.lit("procedure_name"), F.coalesce("p.procedure_name", F.lit("")))
    meta = F.when(primary, F.col("own")).when(cited, named).otherwise(F.create_map().cast("map<string,string>"))
    return out.withColumns({"text": F.when(primary, F.coalesce("own_text", F.lit(""))).otherwise(""), "metadata": meta}).drop("own_text", "own", "p")


def _list(key: str) -> Column:
    return F.coalesce(F.from_json(F.col("metadata")[key], "array<string>"), F.array().cast("array<string>"))


def retrieve(queries: DataFrame, path: str, top_k: int = 10, manuals: list[str] | None = None, embed: Callable = index.hashed) -> DataFrame:
    """One row per query (query_id, query) against the index in a folder: its analysis, results by descending score (the nearest chunks, their
    parents, siblings and chunks that cite the same targets, at most five), whether one has safety callouts, whether several manuals
    were searched, and warnings. Where lookup tables are missing or can't be read there are no cross-references, and a warning says so."""
    spark = queries.sparkSession
    asked = written(analyzed(queries, manuals), "asked")
    held = snapshots.opened(spark, path, "vectors")
    only = manuals[0] if manuals and len(manuals) == 1 else None
    searched = held.select(F.from_json("payload", "chunk_id string, manual_id string").alias("m"), "vector").select("m.*", "vector")
    searched = searched.where(F.col("manual_id") == only) if only else searched
    hits = index.nearest(asked.select("query_id", index.embedding(embed, "query").alias("q")), searched.select(F.col("chunk_id").alias("point"), F.col("vector").alias("v")), top_k)
    hits = written(hits.select("query_id", (F.col("rank") - 1).alias("ord"), F.col("point").alias("chunk_id"), "score", point_id(F.col("point")).alias("point_id")), "nearest-hits")
    # payloads of hits only are read whole
    found = hits.join(held.select("point_id", "payload"), "point_id").withColumn("m", F.from_json("payload", "map<string,string>"))
    hits = written(found.select("query_id", "ord", "chunk_id", "score", F.col("m")["text"].alias("text"), F.map_filter("m", lambda k, v: ~k.isin("chunk_id", "text")).alias("metadata")), "hits")
    primary = hits.select("query_id", "ord", "chunk_id", "score", F.col("metadata")["parent_chunk_id"].alias("parent_chunk_id"), _list("sibling_chunk_ids").alias("sibling_chunk_ids"), _list("cross_references").alias("cross_references"))
    told = []

    def results(lookups: dict[str, DataFrame] | None) -> DataFrame:
        top = min(top_k, 5)
        best = reranked(enriched(primary, lookups, top), top)
        return with_payload(best, hits.select("chunk_id", "text", "metadata").dropDuplicates(["chunk_id"]), lookups and lookups["procedure_lookup"])

    try:
        tables = {t: snapshots.opened(spark, path, t) for t in ("cross_ref_lookup", "procedure_lookup")}
        told += [f"Cross-references are not resolved: there is no table {t}" for t, df in tables.items() if df is None]
        best = results(None if told else tables)
        best = best if told else written(best, "results")  # so that a table that can't be read fails here
    except (PySparkException, Py4JError) as e:
        told.append(f"Cross-references are not resolved: the tables can't be read ({str(e).strip().splitlines()[0][:200]})")
        best = results(None)
    best = best.withColumn("safe", F.coalesce(F.size(F.from_json(F.col("metadata")["has_safety_callouts"], "array<string>")) > 0, F.lit(False)))
    rows = F.array_sort(F.collect_list(F.struct("rank", F.struct("chunk_id", "text", "metadata", "score", "source").alias("r"), "safe")), lambda a, b: a["rank"] - b["rank"])
    found = best.groupBy("query_id").agg(rows.alias("rows"))
    warned = F.array(*map(F.lit, told)).cast("array<string>")
    out = asked.join(found, "query_id", "left")
    return out.select(
        *asked.columns, F.coalesce(F.transform("rows", lambda x: x["r"]), F.array().cast(_RESULT)).alias("results"),
        F.coalesce(F.exists("rows", lambda x: x["safe"]), F.lit(False)).alias("has_safety_warnings"), F.lit(only is None).alias("multi_manual"), warned.alias("retrieval_warnings"),
    )
