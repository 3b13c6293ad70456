"""Personal data by bootstrapped contextual extraction, all in SQL functions.

Seeds are the base kinds' spans, and for the kind "secret", which comes after them, runs of 32 or more hexadecimal digits, letters
and numbers among them, as keys and digests are written. What stands around a seed gives its lexical patterns: the last one, two
and three words or punctuation marks before it, the first one and two after it, and those before with the first after.
Other tokens with digits or "@", and runs of numbers with single spaces between, are candidates with
patterns of their own. A candidate with "@", or of six characters with three digits, is one instance wherever it stands;
a shorter one only with the words around it, so that a found "12" says nothing of others.

Both give a graph of patterns and instances (values), which is scored in rounds. A pattern speaks for a kind when it has SUPPORT
different seeds and found values of that kind; its confidence is their share of its other instances, the judged one left out.
A candidate that a pattern gives ACCEPT or more is found, in the kind of the best one, and counts from the next round on, so
that found values bring new patterns. What is found stays found, so rounds end: when one finds nothing more.

Spans are code points. All searches are linear in the text: runs of characters are taken possessively and begin
only where a run begins (or the last match ended), which finds the same leftmost matches; contexts are read from the span outwards.

Defined results. Null text counts as empty: no spans. Repeated rows are searched each, but a value counts once for a pattern. Spans at an end of the
text have no patterns on that side. Between kinds with equal confidence the first listed wins. Spans of different base kinds may
overlap; those that the method adds overlap no base span. Texts, words and values of any length are read whole; in the graph one
of over 64 characters is named by its SHA-256. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import checked_broadcast, documents, text_of, written

# The kinds in order, their patterns, and where they can't be.
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
KINDS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
IP_VALID = rf"\A{_PART}(?:\.{_PART}){{3}}\z"
_WS = r"\x20\x09-\x0D"
_NUMBER = rf"[+(]*+[0-9][0-9().-]*+(?![^{_WS},;:!?\"'\]}}])"
#: Numbers with single spaces between, else white-space tokens with a digit or "@".
TOKEN = rf"(?<![^{_WS}]){_NUMBER}(?:\x20{_NUMBER})++|(?<![^{_WS}])[^0-9@{_WS}]*+[0-9@][^{_WS}]*+"
EDGES = r".,;:!?()\[\]{}\"'<>"
SUPPORT, ACCEPT = 5, 0.9
#: Kinds of the method beside the base ones: seeds, and what has to be in one.
SECRET = {"secret": r"(?<![\p{L}\p{N}])[0-9A-Fa-f]{32,}+(?![\p{L}\p{N}])"}
ALL = (*KINDS, *SECRET)
_BLOCK, _LEVELS = 32, 4


def _upto(m: str) -> str:
    """SQL for the sum of the first i - 1 entries of le_m, from sums over blocks of blocks."""
    parts, done = [], "0"
    for level in range(_LEVELS - 1, -1, -1):
        size = _BLOCK**level
        here = f"cast((i - 1) div {size} as int)"
        parts.append(f"aggregate(slice(le{level}_{m}, {done} + 1, {here} - {done}), 0L, (n, x) -> n + x)")
        done = f"({here} * {_BLOCK})"
    return " + ".join(parts)


def _found(df: DataFrame, name: str, pattern: str, guard: Column) -> DataFrame:
    """df with m_, p_ and s_ of a pattern on the column t: matches, pieces between them, starts."""
    m, p, s = f"m_{name}", f"p_{name}", f"s_{name}"
    none = F.array().cast("array<string>")
    df = df.withColumn(m, F.when(guard, F.regexp_extract_all("t", F.lit(pattern), F.lit(0))).otherwise(none))
    df = df.withColumn(p, F.when(F.size(m) > 0, F.split("t", pattern, -1)).otherwise(none))
    lens = f"zip_with(slice({p}, 1, size({m})), {m}, (a, b) -> cast(length(a) + length(b) as long))"
    df = df.withColumn(f"le0_{m}", F.expr(f"if(size({m}) = 0, array(), {lens})"))
    for level in range(1, _LEVELS):
        below = f"le{level - 1}_{m}"
        sums = f"transform(sequence(0, cast((size({below}) - 1) div {_BLOCK} as int)), j -> aggregate(slice({below}, j * {_BLOCK} + 1, {_BLOCK}), 0L, (n, x) -> n + x))"
        df = df.withColumn(f"le{level}_{m}", F.expr(f"if(size({below}) = 0, array(), {sums})"))
    df = df.withColumn(s, F.expr(f"if(size({m}) = 0, array(), transform(sequence(1, size({m})), i -> length({p}[i - 1]) + {_upto(m)}))"))
    return df.drop(*[f"le{level}_{m}" for level in range(_LEVELS)])


def _blocks(df: DataFrame, name: str, spans: Column) -> DataFrame:
    """df with spans sorted by their starts, and the first start and last end of each block and block of blocks of them."""
    df = df.withColumn(f"{name}0", F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))))
    for level in (1, 2):
        below = f"{name}{level - 1}"
        block = f"slice({below}, j * {_BLOCK} + 1, {_BLOCK})"
        blocks = f"transform(sequence(0, cast((size({below}) - 1) div {_BLOCK} as int)), j -> named_struct('s', {below}[j * {_BLOCK}].s, 'e', array_max(transform({block}, y -> y.e))))"
        df = df.withColumn(f"{name}{level}", F.expr(f"if(size({below}) = 0, array(), {blocks})"))
    return df


def _overlaps(name: str) -> str:
    """SQL on x: whether it overlaps one of the spans, looked for only in blocks that it overlaps."""
    meets = lambda y: f"{y}.s < x.e and x.s < {y}.e"
    inner = f"exists(slice({name}0, b * {_BLOCK} + 1, {_BLOCK}), y -> {meets('y')})"
    middle = f"exists(sequence(a * {_BLOCK}, least(size({name}1), (a + 1) * {_BLOCK}) - 1), b -> {meets(f'{name}1[b]')} and {inner})"
    return f"if(size({name}0) = 0, false, exists(sequence(0, size({name}2) - 1), a -> {meets(f'{name}2[a]')} and {middle}))"


def _valid(kind: str) -> str:
    """SQL on x: whether a match stays."""
    if kind == "email":
        return "true"
    if kind == "secret":
        return f"x.v rlike '[0-9]' and x.v rlike '[A-Za-z]' and not {_overlaps('base_')}"
    if kind == "ip":
        return f"x.v rlike '{IP_VALID}'".replace("\\", "\\\\")
    digits = "regexp_replace(x.v, '[^0-9]', '')"
    if kind == "phone":
        return f"length({digits}) between 9 and 15"
    luhn = f"aggregate(sequence(1, length({digits})), 0, (n, i) -> n + if(i % 2 = 1, cast(substr({digits}, -i, 1) as int), 2 * cast(substr({digits}, -i, 1) as int) - if(substr({digits}, -i, 1) >= '5', 9, 0))) % 10 = 0"
    return f"if(length({digits}) between 13 and 19, {luhn}, false)"


_WORD = r"(?:[\\p{L}\\p{N}_]++|[^\\s\\p{L}\\p{N}_])"
_short = lambda x: f"if(length({x}) > 64, sha2({x}, 256), {x})"


def _context(piece: str, last: bool) -> str:
    """SQL for the words and marks of a piece next to its end (three) or its start (two), in the order of the text, in
    lower case; digits become 0. Read from the span outwards, at most three words are looked at."""
    side = f"reverse({piece})" if last else piece
    near = rf"regexp_extract({side}, '\\A(?:\\s*+{_WORD}){{1,{3 if last else 2}}}+', 0)"
    words = rf"regexp_extract_all(regexp_replace(lower({f'reverse({near})' if last else near}), '[0-9]+', '0'), '{_WORD}', 0)"
    return f"transform({words}, w -> {_short('w')})"


def _spans(order: int, m: str, p: str, s: str, where: str) -> str:
    items = f"transform(sequence(1, size({m})), i -> named_struct('k', {order}, 's', cast({s}[i - 1] as long), 'e', cast({s}[i - 1] as long) + length({m}[i - 1]), 'v', {m}[i - 1], 'l', {p}[i - 1], 'r', {p}[i]))"
    return f"filter(if(size({m}) = 0, array(), {items}), x -> {where})"


def _with_contexts(spans: str, anywhere: str = "true") -> str:
    """SQL for spans with words for the pieces around them. A value that is not an instance anywhere is named with its context."""
    named = f"if({anywhere}, {_short('x.v')}, concat_ws(char(0), x.v, array_join(x.l, ' '), array_join(x.r, ' ')))"
    worded = f"transform({spans}, x -> named_struct('k', x.k, 's', x.s, 'e', x.e, 'v', x.v, 'l', {_context('x.l', True)}, 'r', {_context('x.r', False)}))"
    return f"transform({worded}, x -> named_struct('k', x.k, 's', x.s, 'e', x.e, 'v', {named}, 'l', x.l, 'r', x.r))"


def extracted(docs: DataFrame) -> DataFrame:
    """doc_id, row, base and others: arrays of spans (k kind number, s, e, v value, l and r context words)."""
    df = docs.select(docs["doc_id"].alias("doc_id"), text_of(docs).alias("t"))
    df = df.withColumn("digits", F.col("t").rlike("[0-9]"))
    guards = {"email": F.instr("t", "@") > 0, "ip": F.col("digits"), "card": F.col("digits"), "phone": F.instr("t", "+") > 0}
    guards["secret"] = F.col("digits")
    for kind, pattern in (KINDS | SECRET).items():
        df = _found(df, kind, pattern, guards[kind])
    df = _found(df, "token", TOKEN, F.col("digits") | (F.instr("t", "@") > 0))
    spans = lambda k, where: F.expr(_spans(ALL.index(k) if k in ALL else -1, f"m_{k}", f"p_{k}", f"s_{k}", where))
    df = df.withColumns({f"b_{k}": spans(k, _valid(k)) for k in KINDS})
    df = df.withColumn("base", F.concat(*[f"b_{k}" for k in KINDS]))
    df = _blocks(df, "base_", F.col("base"))
    df = df.withColumn("secret", spans("secret", _valid("secret")))
    df = df.withColumn("others", spans("token", "true"))
    # the token without what stands around letters and digits, which belongs to the context, unless it lies across a found span
    before, after = (rf"regexp_extract(x.v, '{e}', 0)" for e in (r"\\A[^\\p{L}\\p{N}+@]*+", r"[^\\p{L}\\p{N}]*+\\z"))
    after = rf"reverse(regexp_extract(reverse(x.v), '\\A[^\\p{{L}}\\p{{N}}]*+', 0))"
    cut = f"transform(others, x -> named_struct('x', x, 'a', {before}, 'b', {after}))"
    core = "substr(y.x.v, length(y.a) + 1, greatest(0, length(y.x.v) - length(y.a) - length(y.b)))"
    df = df.withColumn("others", F.expr(f"transform({cut}, y -> named_struct('k', y.x.k, 's', y.x.s + length(y.a), 'e', y.x.e - length(y.b), 'v', {core}, 'l', concat(y.x.l, y.a), 'r', concat(y.b, y.x.r)))"))
    df = _blocks(df, "taken_", F.concat("base", "secret"))
    df = df.withColumn("others", F.expr(rf"filter(others, x -> x.v rlike '[\\p{{L}}0-9]' and not {_overlaps('taken_')})"))
    anywhere = "x.v like '%@%' or length(x.v) >= 6 and length(regexp_replace(x.v, '[^0-9]', '')) >= 3"
    df = df.withColumns({"base": F.expr(_with_contexts("base")), "secret": F.expr(_with_contexts("secret")), "others": F.expr(_with_contexts("others", anywhere))})
    return df.select("doc_id", F.monotonically_increasing_id().alias("row"), "base", "secret", "others")


def _edges(spans: DataFrame) -> DataFrame:
    """(pattern, k, v), each once: a pattern is side and words."""
    before = [f"if(size(l) >= {n}, array_join(slice(l, -{n}, {n}), ' '), null)" for n in (1, 2, 3)]
    after = [f"if(size(r) >= {n}, array_join(slice(r, 1, {n}), ' '), null)" for n in (1, 2)]
    patterns = [*[f"concat('l ', {x})" for x in before], *[f"concat('r ', {x})" for x in after], *[f"concat('b ', {x}, ' _ ', {after[0]})" for x in before]]
    return spans.select(F.explode(F.expr(f"filter(array({', '.join(patterns)}), x -> x is not null)")).alias("pattern"), "k", "v").distinct()


def patterns(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The graph: (pattern, k, own, all) with the number of seeds of kind k and of all instances; (pattern, v) of candidates."""
    spans = lambda c: rows.select(F.explode(c).alias("x")).select("x.*")
    seeds = written(_edges(spans(F.concat("base", "secret"))), "pii-seeds")
    edges = written(_edges(spans("others")).select("pattern", "v"), "pii-edges")
    counts = seeds.groupBy("pattern", "k").agg(F.count(F.lit(1)).alias("own"))
    kinds = counts.groupBy("pattern").agg(F.collect_list(F.struct("k", "own")).alias("kinds"), F.sum("own").alias("n"))
    others = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("others"))
    every = kinds.join(others, "pattern", "full").select("pattern", "kinds", (F.coalesce("n", F.lit(0)) + F.coalesce("others", F.lit(0))).alias("all"), F.coalesce("others", F.lit(0)).alias("others"))
    return every.where("others > 0"), edges


def discovered(rows: DataFrame, support: int = SUPPORT, accept: float = ACCEPT) -> DataFrame:
    """(v, k): candidate values with the kind that patterns give them."""
    every, edges = patterns(rows)
    every = written(every, "pii-patterns")  # those with a candidate
    own = every.select("pattern", "all", F.explode("kinds").alias("x")).select("pattern", "all", "x.*")
    found, number = None, 0
    while True:
        counts = own
        if found is not None:
            taken = edges.join(checked_broadcast(found), "v").groupBy("pattern", "k").agg(F.count(F.lit(1)).alias("own"))
            counts = own.drop("all").unionByName(taken).groupBy("pattern", "k").agg(F.sum("own").alias("own")).join(every.select("pattern", "all"), "pattern")
        # the judged value is one of the instances, and not of those that speak for the kind
        strong = counts.where(F.col("own") >= support).select("pattern", "k", (F.col("own") / (F.col("all") - 1)).alias("c")).where(F.col("c") >= accept)
        strong = checked_broadcast(written(strong, f"pii-strong{number}"))
        best = edges.join(strong, "pattern").groupBy("v").agg(F.max(F.struct("c", (-F.col("k")).alias("k"))).alias("x")).select("v", (-F.col("x.k")).alias("k"))
        if found is not None:
            best = best.join(checked_broadcast(found), "v", "left_anti").unionByName(found)
        before = found.count() if found is not None else 0
        found, number = written(best, f"pii-found{number}"), number + 1
        if found.count() == before:
            return found


def _named(spans: str) -> str:
    kinds = "array({})".format(", ".join(f"'{k}'" for k in ALL))
    return f"array_join(transform({spans}, x -> concat_ws(':', {kinds}[x.k], x.s, x.e)), ',')"


def found(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans, personal (whether there is a span), and of
    the spans beyond the base ones how many are seeds and how many were found by patterns."""
    rows = written(extracted(docs), "pii-rows")
    values = checked_broadcast(written(discovered(rows, **options), "pii-values"))
    more = rows.select("row", F.explode("others").alias("x")).select("row", F.col("x.v").alias("v"), F.col("x.s").alias("s"), F.col("x.e").alias("e")).join(values, "v")
    more = written(more.groupBy("row").agg(F.collect_list(F.struct("k", "s", "e")).alias("more")), "pii-more")
    rows = rows.join(checked_broadcast(more, 100_000), "row", "left")
    rows = rows.withColumns({c: F.expr(f"transform({c}, x -> named_struct('k', x.k, 's', x.s, 'e', x.e))") for c in ("base", "secret")})
    rows = rows.withColumn("every", F.expr("array_sort(concat(base, secret, coalesce(more, array())))"))
    count = lambda i: F.expr(f"size(filter(base, x -> x.k = {i}))").cast("long")
    return rows.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(F.encode(F.expr(_named("base")), "UTF-8"), 256).alias("base_sha256"),
        F.expr(_named("every")).alias("spans"), F.size("every").cast("long").alias("n_spans"), (F.size("every") > 0).alias("personal"),
        F.size("secret").cast("long").alias("n_seed_secrets"), F.size(F.coalesce("more", F.array().cast("array<struct<k: int, s: int, e: int>>"))).cast("long").alias("n_found"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found(documents(spark, sf_dir))
