"""Quality rules: base statistics of a text, then robust multivariate outliers, all in SQL functions.

A minimum-covariance-determinant estimate is fitted for each (lang, source): concentration steps
start from medians and interquartile ranges, and each keeps the share ``support`` of the group's
rows that lie nearest, until no group's means move by more than ``settled`` of a standard deviation, in ``steps`` steps at most. One aggregation a step makes count, sums and products for each (group,
distance bin); cumulative sums over the bins, of which there are at most a few hundred whatever
the number of rows, give the moments of the nearest rows. So no group is gathered in one task, and
one source with a third of all rows is pre-aggregated on the map side like any other.

Defined results. Null text: no words, base_failed, not kept. A null lang or source is a group of
its own. The estimate of a group with n < ``min_rows`` usable rows is mixed with that of its language's
pooled rows, at n / min_rows to the rest; a language's with under ``min_rows`` is mixed likewise with that
of all rows. So every usable row gets a distance, whatever the sizes, and no size switches it. A group without spread is no special case:
``FLOOR`` is added to each variance. Repeated rows are rows like any other. An empty table gives no
rows. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.llm.common import DOCUMENT_KEY, checked_broadcast, documents, key_columns, text_of, without, written

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Standard deviation that each feature has at least.
FLOOR = {"f_word": 0.06, "f_symbol": 0.08, "f_calls": 0.08, "f_lines": 0.06, "f_repeat": 0.06}
FEATURES = tuple(FLOOR)
#: Chi-square quantile with 5 degrees of freedom at 0.75, and the factor that makes the covariance
#: of the nearest 75% of normal rows consistent: 0.75 / P(chi2 with 7 <= that quantile).
CONSISTENCY = 1.602
#: A squared distance beyond this is an outlier (chi-square with 5 degrees of freedom at 1 - 1e-4).
CUTOFF = 25.74
_BINS = 16  # of squared distance, to each doubling


def statistics(docs: DataFrame) -> DataFrame:
    """docs' doc_id, lang, source, key and STATISTICS, with base_failed and two counts more."""
    have = set(docs.columns)
    name = lambda c: F.coalesce(docs[c].cast("string"), F.lit("\x00")) if c in have else F.lit("\x00")
    text = text_of(docs)
    df = docs.select(
        docs["doc_id"].alias("doc_id"), name("lang").alias("lang"), name("source").alias("source"),
        *key_columns(docs), text.alias("t"),
    )
    df = df.withColumns({
        "w": F.split(F.expr(r"trim(BOTH ' \t\n\u000b\u000c\r' FROM t)"), SPACE),
        "l": F.expr(r"filter(split(t, '\n'), x -> length(trim(BOTH ' \t\n\u000b\u000c\r' FROM x)) > 0)"),
        "n_symbols": F.regexp_count("t", F.lit(SYMBOLS)).cast("long"),
        "n_calls": F.octet_length("t") - F.octet_length(F.replace("t", F.lit("!"), F.lit(""))),
    }).drop("t")
    df = df.withColumn("w", F.expr("if(w[0] = '', array(), w)"))
    df = df.withColumns({
        "n_words": F.size("w").cast("long"),
        "word_chars": F.length(F.array_join("w", "")).cast("long"),
        "n_lines": F.size("l").cast("long"),
        "n_dup_lines": (F.size("l") - F.size(F.array_distinct("l"))).cast("long"),
        "a": F.expr("transform(w, x -> xxhash64(x))"),
    }).drop("l")
    # h: a hash of each window of five words, of its pairs' hashes
    df = df.withColumn("b", F.expr("zip_with(a, slice(a, 2, n_words), (x, y) -> xxhash64(x, y))"))
    df = df.withColumn("b", F.expr("zip_with(b, slice(b, 3, n_words), (x, y) -> xxhash64(x, y))"))
    df = df.withColumn("h", F.expr("if(n_words < 6, array(), slice(zip_with(b, slice(a, 5, n_words), (x, y) -> xxhash64(x, y)), 1, n_words - 4))")).drop("a", "b")
    # s: where hashes repeat, they are sorted with the place in the low bits; equal neighbours are
    # compared word by word
    df = df.withColumn("low", F.expr("shiftleft(1L, cast(ceil(log2(n_words + 2)) as int)) - 1"))
    df = df.withColumn("s", F.expr("if(size(array_distinct(h)) < size(h), sort_array(transform(h, (x, i) -> (x & ~low) | (i + 1))), array())")).drop("h")
    same = "((x & ~low) = (get(s, {k}) & ~low) and slice(w, cast(x & low as int), 5) = slice(w, cast(get(s, {k}) & low as int), 5))"
    df = df.withColumn("p", F.expr(f"sort_array(transform(filter(s, (x, k) -> {same.format(k='k - 1')} or {same.format(k='k + 1')}), x -> x & low))")).drop("s", "w", "low")
    df = df.withColumn("n_repeat_words", F.expr("aggregate(zip_with(p, slice(p, 2, size(p)), (a, b) -> if(b is null, 5L, least(5L, b - a))), 0L, (n, x) -> n + x)")).drop("p")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return df.withColumn("base_failed", failed)


def features() -> dict[str, Column]:
    """Transformed statistics. Small texts are drawn towards usual values by pseudo-counts."""
    c = lambda x: F.col(x).cast("double")
    return {
        "f_word": F.log((c("word_chars") + 500) / (c("n_words") + 100)),
        "f_symbol": F.log1p(10 * c("n_symbols") / (c("n_words") + 20)),
        "f_calls": F.log1p(10 * c("n_calls") / (c("n_words") + 20)),
        "f_lines": c("n_dup_lines") / (c("n_lines") + 20),
        "f_repeat": c("n_repeat_words") / (c("n_words") + 50),
    }


def _distance(p: str = "") -> list[dict[str, Column]]:
    """Squared Mahalanobis distance of the features from the means m_* under the lower triangle
    c_*_* by Cholesky's factors and forward substitution, as columns in layers."""
    layers: list[dict[str, Column]] = []
    n = len(FEATURES)
    for j in range(n):
        inner = F.lit(0.0)
        for k in range(j):
            inner = inner + F.col(f"l_{j}_{k}") ** 2
        layers.append({f"l_{j}_{j}": F.sqrt(F.greatest(F.col(f"c_{j}_{j}") - inner, F.lit(1e-9)))})
        below = {}
        for i in range(j + 1, n):
            inner = F.lit(0.0)
            for k in range(j):
                inner = inner + F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            below[f"l_{i}_{j}"] = (F.col(f"c_{i}_{j}") - inner) / F.col(f"l_{j}_{j}")
        layers.append(below)
    return [x for x in layers if x]


def _factored(params: DataFrame) -> DataFrame:
    """One row a group: means and Cholesky factors."""
    for layer in _distance():
        params = params.withColumns(layer)
    n = len(FEATURES)
    return params.select("g", *[f"m_{i}" for i in range(n)], *[f"l_{i}_{j}" for i in range(n) for j in range(i + 1)])


def _with_distance(df: DataFrame, params: DataFrame) -> DataFrame:
    """df with the column d2; rows whose group has no estimate get null."""
    df = df.join(checked_broadcast(_factored(params)), "g", "left")
    total = F.lit(0.0)
    for i, f in enumerate(FEATURES):
        z = F.col(f) - F.col(f"m_{i}")
        for j in range(i):
            z = z - F.col(f"l_{i}_{j}") * F.col(f"z_{j}")
        df = df.withColumn(f"z_{i}", z / F.col(f"l_{i}_{i}"))
        total = total + F.col(f"z_{i}") ** 2
    return df.withColumn("d2", total)


def _moments() -> list[Column]:
    n = len(FEATURES)
    x = [F.col(f) for f in FEATURES]
    return [F.count(F.lit(1)).alias("n"), *[F.sum(x[i]).alias(f"s_{i}") for i in range(n)], *[F.sum(x[i] * x[j]).alias(f"q_{i}_{j}") for i in range(n) for j in range(i + 1)]]


def _quartiles(df: DataFrame) -> DataFrame:
    """Medians as means, and squared interquartile ranges as variances, from bins of 1/256."""
    n = len(FEATURES)
    long = df.select("g", F.posexplode(F.array(*[F.round(F.col(f) * 256).cast("long") for f in FEATURES])).alias("i", "b"))
    bins = long.groupBy("g", "i", "b").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("g", "i")
    bins = bins.withColumns({"cum": F.sum("n").over(w.orderBy("b")), "all": F.sum("n").over(w)})
    at = lambda q: F.min(F.when(F.col("cum") >= q * F.col("all"), F.col("b"))) / 256.0
    by = bins.groupBy("g", "i").agg(at(0.5).alias("med"), (at(0.75) - at(0.25)).alias("iqr"))
    pick = lambda i, c: F.max(F.when(F.col("i") == i, F.col(c)))
    out = by.groupBy("g").agg(*[pick(i, "med").alias(f"m_{i}") for i in range(n)], *[pick(i, "iqr").alias(f"r_{i}") for i in range(n)])
    floor = list(FLOOR.values())
    return out.select("g", *[f"m_{i}" for i in range(n)], *[((F.col(f"r_{i}") / 1.349) ** 2 + floor[i] ** 2 if i == j else F.lit(0.0)).alias(f"c_{i}_{j}") for i in range(n) for j in range(i + 1)])


def _concentrated(df: DataFrame, params: DataFrame, support: float) -> DataFrame:
    """The estimate from the nearest share of each group's rows under the present one."""
    n = len(FEATURES)
    near = _with_distance(df, params).withColumn("bin", F.greatest(F.ceil(F.log2(F.col("d2") + 1e-6) * _BINS), F.lit(-20 * _BINS)))
    bins = near.groupBy("g", "bin").agg(*_moments())
    w = Window.partitionBy("g")
    bins = bins.withColumns({"cum": F.sum("n").over(w.orderBy("bin")) - F.col("n"), "all": F.sum("n").over(w)})
    kept = bins.where(F.col("cum") < support * F.col("all")).groupBy("g").agg(*[F.sum(c).alias(c) for c in bins.columns if c == "n" or c[:2] in ("s_", "q_")])
    floor = list(FLOOR.values())
    mean = [F.col(f"s_{i}") / F.col("n") for i in range(n)]
    cov = {(i, j): CONSISTENCY * (F.col(f"q_{i}_{j}") / F.col("n") - mean[i] * mean[j]) + (floor[i] ** 2 if i == j else 0.0) for i in range(n) for j in range(i + 1)}
    return kept.select("g", *[mean[i].alias(f"m_{i}") for i in range(n)], *[v.alias(f"c_{i}_{j}") for (i, j), v in cov.items()])


def _moved(before: DataFrame, after: DataFrame) -> float:
    """The most that a mean has moved, in standard deviations."""
    both = after.join(before.select("g", *[F.col(f"m_{i}").alias(f"b_{i}") for i in range(len(FEATURES))]), "g")
    steps = [F.abs(F.col(f"m_{i}") - F.col(f"b_{i}")) / F.sqrt(F.col(f"c_{i}_{i}")) for i in range(len(FEATURES))]
    return both.agg(F.coalesce(F.max(F.greatest(*steps)), F.lit(0.0))).first()[0]  # one number


def _mixed(groups: DataFrame, params: DataFrame, min_rows: int) -> DataFrame:
    """The estimate of each group, drawn towards those of its pools. What lies between their
    means adds nothing: a pool's covariance has its groups' spread, and an outlier's own group must not hide it."""
    n = len(FEATURES)
    names = [*[f"m_{i}" for i in range(n)], *[f"c_{i}_{j}" for i in range(n) for j in range(i + 1)]]
    named = lambda key: checked_broadcast(params).select(F.col("g").alias(key), *[F.col(c).alias(f"{key}_{c}") for c in names])
    df = groups
    for key in ("g", "g_lang", "g_all"):
        df = df.join(named(key), key, "left")
    for key, pool, size in (("g_lang", "g_all", "n_lang"), ("g", "g_lang", "n")):
        # no pool: the size is min_rows or more, the share 1
        w = F.least(F.lit(1.0), F.col(size) / F.lit(float(min_rows)))
        a = {c: F.col(f"{key}_{c}") for c in names}
        b = {c: F.coalesce(f"{pool}_{c}", f"{key}_{c}") for c in names}
        df = df.withColumns({f"{key}_{c}": w * a[c] + (1 - w) * b[c] for c in names})
    return df.select("g", *[F.col(f"g_{c}").alias(c) for c in names])


def judged(docs: DataFrame, support: float = 0.75, steps: int = 12, settled: float = 0.02, min_rows: int = 50, cutoff: float = CUTOFF) -> DataFrame:
    """One row per document: doc_id, STATISTICS, base_failed, distance (null only for base_failed
    rows of a group without a usable one), kept, and the row's key."""
    stats = written(statistics(docs).withColumns(features()), "quality")
    usable = stats.where(~F.col("base_failed"))
    sizes = usable.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.withColumn("n_lang", F.sum("n").over(Window.partitionBy("lang")))
    groups = written(sizes.select(
        "lang", "source", "n", "n_lang", F.to_json(F.struct("lang", "source")).alias("g"),
        F.when(F.col("n") < min_rows, F.to_json(F.struct("lang"))).alias("g_lang"),
        F.when(F.col("n_lang") < min_rows, F.lit("{}")).alias("g_all"),
    ), "quality-groups")
    own = checked_broadcast(groups.select("lang", "source", "g"))
    df = stats.join(own, ["lang", "source"], "left")
    # a pooled estimate, made only where a group needs it, uses every row of its language, or every row
    one = usable.join(own, ["lang", "source"]).select("g", *FEATURES)
    pooled = groups.where("g_lang is not null").select("lang", F.col("g_lang").alias("g")).distinct()
    of_lang = usable.join(checked_broadcast(pooled), "lang").select("g", *FEATURES)
    last = groups.where("g_all is not null").select(F.col("g_all").alias("g")).distinct()  # one row or none
    of_all = usable.crossJoin(F.broadcast(last)).select("g", *FEATURES)
    fit = written(one.unionByName(of_lang).unionByName(of_all), "quality-fit")
    params = written(_quartiles(fit), "quality-start")
    for k in range(steps):
        before, params = params, written(_concentrated(fit, params, support), f"quality-step{k}")
        if _moved(before, params) <= settled:
            break
    out = _with_distance(df, written(_mixed(groups, params, min_rows), "quality-mixed"))
    return out.select(
        "doc_id", *STATISTICS, "base_failed",
        (~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= cutoff)).alias("kept"),
        F.col("d2").alias("distance"), *DOCUMENT_KEY,
    )


def kept_documents(docs: DataFrame, **options) -> DataFrame:
    """docs without the rows that are rejected; all their columns."""
    gone = written(judged(docs, **options).where(~F.col("kept")).select(*DOCUMENT_KEY).distinct(), "quality-gone")
    return without(docs, gone)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(documents(spark, sf_dir)).select("doc_id", *STATISTICS, "base_failed", "kept", "distance")
