"""Mixing sources to target weights by entropy balancing.

Among all document rates r between 0 and CAP, take those nearest in relative entropy to keeping each
document once whose words meet each source's target. The dual is convex with one multiplier a
source; its solution tilts documents exponentially with their size z (in means of the source):
r / (CAP - r) = exp(lambda z) / (CAP - 1). Newton's iterations run distributed: rates depend on
(source, size) only, so the documents are first counted by both, and each iteration is one aggregation of
gradient and curvature over that table, bracketed by bisection. Only sums per source reach the driver.

Rounding: the sizes of a source are taken in descending order; each (source, size) takes the whole number of copies that
brings the words taken so far nearest to the sum of the rates so far, so that what large documents leave over or short is made
up by the next smaller ones, and a source ends within its small documents' sizes of the target. Inside a (source,
size), copies are dealt evenly, the odd ones by hash of doc_id. Ranks are counted in
``SLICES`` slices and put together from the slices' counts, so no hot group is sorted in one task.

Defined results. Null text: size 0, taken 0. A null source is a source of its own, last in order.
Sources of no words have target 0. Repeated rows are separate documents, and may get different
copies. Sources whose target is CAP times their size take every document CAP times. An empty table
gives no rows. Extra columns are ignored by ``taken`` and kept by ``mixed_documents``, whatever their names.
Rows with equal doc_id and text are told apart by a hash of their other columns; rows alike in all columns get copies in any order.
The driver holds a number or two for each source; a recipe of more than MAX_SOURCES sources is refused.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.llm.common import DOCUMENT_KEY, checked_broadcast, documents, key_columns, keyed, same_key, text_of, written

CAP = 3
WEIGHTS = (1, 2, 3)
MAX_SOURCES = 100_000
SLICES = 64


def targets(sizes: list[int], weights: list[float], cap: float = CAP) -> list[float]:
    """Shares of all sizes by weight; a share above cap times its source's size stops there, and the
    excess goes to the others by weight until none is above."""
    total, out, open_ = float(sum(sizes)), [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        weight = sum(weights[i] for i in open_)
        left = total - sum(out[i] for i in range(len(sizes)) if i not in open_)
        over = {i for i in open_ if left * weights[i] / weight >= cap * sizes[i]}
        if not over:
            for i in open_:
                out[i] = left * weights[i] / weight
            break
        for i in over:
            out[i] = float(cap * sizes[i])
        open_ -= over
    return out


def _rate(slope, z):
    """CAP / (1 + (CAP - 1) exp(-slope z)), without overflow."""
    e = F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), -slope * z)))
    return CAP / (1 + (CAP - 1) * e)


def _solve(spark: SparkSession, counts: DataFrame, sources: list, tolerance: float, steps: int) -> dict[int, float]:
    """The multiplier of each source number by safeguarded Newton iterations on the dual's gradient."""
    slope = {s["number"]: 0.0 for s in sources if 0 < s["target"] < CAP * s["source_size"]}
    target = {s["number"]: s["target"] for s in sources}
    low, high = dict.fromkeys(slope, -math.inf), dict.fromkeys(slope, math.inf)
    moving = set(slope)
    for _ in range(steps):
        if not moving:
            break
        table = spark.createDataFrame([(n, slope[n]) for n in sorted(moving)], "number int, slope double")
        rate = _rate(F.col("slope"), F.col("z"))
        sums = counts.join(F.broadcast(table), "number").groupBy("number").agg(
            F.sum(F.col("n") * F.col("size") * rate).alias("got"), F.sum(F.col("n") * F.col("size") * F.col("z") * rate * (1 - rate / CAP)).alias("curve")
        )
        for row in sums.collect():  # one row a source
            n, gap = row["number"], row["got"] - target[row["number"]]
            if abs(gap) <= tolerance * max(target[n], 1.0):
                moving.discard(n)
                continue
            (high if gap > 0 else low)[n] = slope[n]
            step = slope[n] - gap / row["curve"] if row["curve"] > 0 else math.nan
            if not low[n] < step < high[n]:
                ends = low[n], high[n]
                step = sum(ends) / 2 if all(map(math.isfinite, ends)) else (2 * low[n] + 1 if math.isfinite(low[n]) and low[n] > 0 else max(low[n], -1.0) + 1) if gap < 0 else (2 * high[n] - 1 if high[n] < 0 else min(high[n], 1.0) - 1)
            slope[n] = step
    return slope


def _rounded(key, table):  # without types: Spark reads them
    """Whole copies of each size of a source, of which there is one row. table: number, size, n, rate."""
    table = table.sort_by([("size", "descending")])
    size, n, rate = (table.column(c).to_pylist() for c in ("size", "n", "rate"))
    whole, goal, got = [], 0.0, 0
    for z, k, r in zip(size, n, rate, strict=True):
        goal += k * r * z
        copies = min(max(math.floor((goal - got) / z + 0.5), 0), CAP * k) if z else round(k * r)
        got += copies * z
        whole.append(copies)
    return table.select(["number", "size", "n", "rate"]).append_column("whole", pa.array(whole, pa.int64()))


def taken(docs: DataFrame, weights: tuple = WEIGHTS, tolerance: float = 1e-9, steps: int = 60) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies, taken, rate, and the row's key."""
    spark = docs.sparkSession
    source = docs["source"].cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    size = F.regexp_count(text_of(docs), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    rows = docs.select(docs["doc_id"].alias("doc_id"), *key_columns(docs), source.alias("source"), size.alias("size"))
    # rows alike in all columns are told apart by the row's number
    rows = rows.withColumns({"slice": F.pmod(F.xxhash64("doc_id", DOCUMENT_KEY[1]), F.lit(SLICES)).cast("int"), "row": F.monotonically_increasing_id()})
    rows = written(rows, "mix-rows")
    by_slice = written(rows.groupBy("source", "size", "slice").agg(F.count(F.lit(1)).alias("n")), "mix-slices")
    by_size = by_slice.groupBy("source", "size").agg(F.sum("n").alias("n"))
    found = by_size.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("docs")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"a mix has at most {MAX_SOURCES} sources")
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    goal = targets([r["source_size"] for r in found], [weights[i % len(weights)] for i in range(len(found))])
    sources = [r.asDict() | {"number": i, "target": t, "mean": max(r["source_size"] / r["docs"], 1.0)} for i, (r, t) in enumerate(zip(found, goal, strict=True))]
    shape = "source string, source_size long, docs long, number int, target double, mean double"
    table = F.broadcast(spark.createDataFrame([tuple(s[c] for c in ("source", "source_size", "docs", "number", "target", "mean")) for s in sources], shape))
    numbered = lambda df: df.join(table, df["source"].eqNullSafe(table["source"])).drop("source")
    counts = written(numbered(by_size).withColumn("z", F.col("size") / F.col("mean")), "mix-counts")
    slope = _solve(spark, counts, sources, tolerance, steps)
    solved = F.broadcast(spark.createDataFrame([(s["number"], slope.get(s["number"])) for s in sources], "number int, slope double"))
    rate = F.when(F.col("slope").isNotNull(), _rate(F.col("slope"), F.col("z"))).otherwise(F.when(F.col("target") > 0, F.lit(float(CAP))).otherwise(F.lit(1.0)))
    # whole copies of each (source, size), from running sums of rates
    rates = counts.join(solved, "number").withColumn("rate", rate)
    rates = rates.groupBy("number").applyInArrow(_rounded, "number int, size long, n long, rate double, whole long")
    # ranks: those of the slices before, then those inside the slice
    slices = numbered(by_slice).select("number", "size", "slice", "n")
    before = F.sum("n").over(Window.partitionBy("number", "size").orderBy("slice")) - F.col("n")
    slices = slices.withColumn("before", before).drop("n")
    slices = slices.join(rates.select("number", "size", "n", "whole", "rate"), ["number", "size"])
    ranked = numbered(rows).drop("docs", "mean")
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("number", "size", "slice").orderBy(F.xxhash64("doc_id", DOCUMENT_KEY[1]), "doc_id", DOCUMENT_KEY[3], "row")))
    out = ranked.join(slices, ["number", "size", "slice"])
    copies = F.floor(F.col("whole") / F.col("n")) + (F.col("before") + F.col("rank") <= F.col("whole") % F.col("n")).cast("long")
    out = out.withColumn("copies", copies)
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "rate", "row", *DOCUMENT_KEY)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """docs with each row as often as the mix takes it; all their columns, whatever their names."""
    copies = taken(docs, **options)
    # rows with one key are alike: their copies are dealt among them in any order, which is counted in slices
    keys = written(copies.groupBy(*DOCUMENT_KEY).agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("n")).where("copies > 0"), "mix-keys")
    rows = keyed(docs)
    single, several = (checked_broadcast(keys.where(c)) for c in ("n = 1", "n > 1"))
    out = rows.join(single, same_key(rows, single)).select("row", "copies")
    tied = rows.join(several, same_key(rows, several)).select("row", *[rows[c] for c in DOCUMENT_KEY], "copies", "n")
    tied = written(tied.withColumn("slice", F.pmod(F.monotonically_increasing_id(), F.lit(SLICES))), "mix-tied")
    before = tied.groupBy(*DOCUMENT_KEY, "slice").agg(F.count(F.lit(1)).alias("k"))
    before = before.withColumn("before", F.sum("k").over(Window.partitionBy(*DOCUMENT_KEY).orderBy("slice")) - F.col("k"))
    tied = tied.withColumn("rank", F.row_number().over(Window.partitionBy(*DOCUMENT_KEY, "slice").orderBy(F.lit(1))))
    joined = tied.join(before, same_key(tied, before) & (tied["slice"] == before["slice"]))
    dealt = F.floor(F.col("copies") / F.col("n")) + (F.col("before") + F.col("rank") <= F.col("copies") % F.col("n")).cast("long")
    out = out.unionByName(joined.select("row", dealt.alias("copies")))
    return out.where("copies > 0").select("row", F.explode(F.expr("sequence(1L, copies)"))).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "rate")
