"""URL filters by a sort-merge range join.

A host's labels are written in reverse with a closing dot ("org.example."), so that a rule's host is a
prefix of the keys of its host and all subdomains, and these lie in one interval of the sorted keys. Cut points, drawn
from a bounded sample, deal (key, path, hash of page_id) into ranges; a rule goes to every range that its interval
touches, a URL to its own, and each range is a partition. It is sorted with rules before URLs, and swept once: a stack
holds the rules whose interval is open, each nested in the one below. A host with very many URLs
is cut by path and page, and neither rules nor URLs are broadcast. The sample decides only where ranges end.

Defined results. Null URLs and those without "://" have an empty host and path; no rule fits them and they get the
default verdict. Of fitting rules the longest (host and path together) wins, at equal length that with the longer
host; of two rules with equal host and path, "block". Repeated pages and null ids are judged like any other. An
empty table gives no rows; URLs of any length are read whole; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The rules of the query.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
DEFAULT = "allow"
#: URLs drawn for each range to place the cuts.
SAMPLE = 100


def rules_frame(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def _lower(c: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(c, upper, upper.lower())


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, host, path."""
    url = F.coalesce(pages["url"].cast("string"), F.lit(""))
    rest = pages.select(pages["page_id"].alias("page_id"), F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("").alias("rest"))
    rest = rest.withColumn("h", F.regexp_extract("rest", r"\A[^/?#]*", 0))
    after = F.substring(F.col("rest"), F.length("h") + 1, F.length("rest"))
    return rest.select("page_id", _lower(F.col("h")).alias("host"), F.regexp_extract(after, r"\A[^?#]*", 0).alias("path"))


def reversed_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _cuts(rows: DataFrame, ranges: int) -> list[tuple[str, str, int]]:
    total = rows.count()
    share = min(1.0, 1.2 * SAMPLE * ranges / max(total, 1))
    drawn = sorted((r[0], r[1], r[2]) for r in rows.select("key", "path", "salt").sample(share, 7).limit(2 * SAMPLE * ranges).collect())
    step = max(len(drawn) // ranges, 1)
    return drawn[step::step][: ranges - 1]


class Sweep:
    """The stack of open hosts, each with its rules by path."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, dict[str, tuple[str, str]], list[int]]] = []

    def close(self, key: str) -> None:
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()

    def rule(self, key: str, path: str, rule: str, verdict: str) -> None:
        self.close(key)
        if not self.stack or self.stack[-1][0] != key:
            self.stack.append((key, {}, []))
        _, paths, lengths = self.stack[-1]
        if path not in paths:
            if -len(path) not in lengths:
                lengths.insert(bisect_left(lengths, -len(path)), -len(path))
            paths[path] = rule, verdict
        elif verdict == "block":
            paths[path] = rule, verdict

    def url(self, key: str, path: str) -> tuple[str | None, str | None]:
        self.close(key)
        best, most = (None, None), -1
        for host, paths, lengths in reversed(self.stack):
            for n in lengths:  # longest first
                if len(host) - n <= most:
                    break
                if -n <= len(path) and (hit := paths.get(path[:-n])):
                    best, most = hit, len(host) - n
                    break
        return best


def judged(pages: DataFrame, rules: DataFrame | None = None, default: str = DEFAULT, ranges: int | None = None) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict."""
    spark = pages.sparkSession
    rules = rules if rules is not None else rules_frame(spark)
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = parsed(pages)
    rows = rows.withColumns({"key": reversed_key(F.col("host")), "salt": F.xxhash64("page_id")})
    cuts = _cuts(rows, ranges)
    schema = rows.select(F.lit(0).alias("range"), "key", F.lit(False).alias("is_url"), "path", "page_id", "host", F.lit("").alias("rule"), F.lit("").alias("verdict")).schema
    for f in schema.fields:
        f.nullable = True
    names = schema.names

    def place_urls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            at = [bisect_right(cuts, row) for row in zip(*[b.column(c).to_pylist() for c in ("key", "path", "salt")], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), b.column("key"), pa.array([True] * n, pa.bool_()), b.column("path"), b.column("page_id"), b.column("host"), pa.nulls(n, pa.string()), pa.nulls(n, pa.string())], names)

    def place_rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for key, path, host, rule, verdict in zip(*[b.column(c).to_pylist() for c in ("key", "path", "host", "rule", "verdict")], strict=True):
                for at in range(bisect_left(cuts, (key,)), bisect_right(cuts, (key + "\U0010ffff",)) + 1):
                    out.append((at, key, False, path, None, host, rule, verdict))
            types = [pa.int32(), pa.string(), pa.bool_(), pa.string(), page_type, pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 8, types, strict=True)], names)

    from pyspark.sql.pandas.types import to_arrow_type

    page_type = to_arrow_type(schema["page_id"].dataType)
    open_ = rules.select("verdict", _lower(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), F.concat("host", F.coalesce("path", F.lit(""))).alias("rule"))
    open_ = open_.withColumn("key", reversed_key(F.col("host")))
    both = rows.mapInArrow(place_urls, schema).unionByName(open_.mapInArrow(place_rules, schema))
    both = both.repartitionById(ranges, F.col("range")).sortWithinPartitions("range", "key", "is_url", "path")

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = Sweep(), None
        for b in batches:
            urls, rule, verdict = [], [], []
            columns = [b.column(c).to_pylist() for c in ("range", "key", "is_url", "path", "rule", "verdict")]
            for i, (part, key, is_url, path, r, v) in enumerate(zip(*columns, strict=True)):
                if part != at:
                    held, at = Sweep(), part
                if not is_url:
                    held.rule(key, path, r, v)
                    continue
                found = held.url(key, path)
                urls.append(i)
                rule.append(found[0])
                verdict.append(found[1] or default)
            take = pa.array(urls, pa.int64())
            yield pa.RecordBatch.from_arrays([*[b.column(c).take(take) for c in ("page_id", "host", "path")], pa.array(rule, pa.string()), pa.array(verdict, pa.string())], ["page_id", "host", "path", "rule", "verdict"])

    return both.mapInArrow(sweep, schema=both.select("page_id", "host", "path", "rule", "verdict").schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def _oracle() -> str:
    fits = []
    for verdict, host, path in sorted(RULES, key=lambda r: -len(r[1] + r[2])):
        fits.append((f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')", host + path, verdict))
    case = lambda i, other: "CASE " + " ".join(f"WHEN {f[0]} THEN '{f[i]}'" for f in fits) + f" ELSE {other} END"
    return f"""
WITH r AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM r
), p AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h
)
SELECT page_id, host, path, {case(1, "NULL")} AS rule, {case(2, f"'{DEFAULT}'")} AS verdict FROM p
"""


ORACLE = _oracle()
