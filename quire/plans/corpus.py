"""The operators as queries over the driver's tables, each with SQL for the same rows where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType
from pyspark.sql.window import Window

from quire.functions import text as T
from quire.operators import analytics, ann, checks, chunks, index, retrieval, rules, structure
from quire.plans.samples import MANUAL, PROSE
from quire.sources import snapshots, tables
from quire.sources.profile import from_mapping
from quire.sources.storage import settled, shared_dir, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLE[name] = oracle
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.document_pages(docs(spark, sf_dir))


def as_chunks(d: DataFrame) -> DataFrame:
    """Documents as chunks, one each, with what the checks read."""
    meta = F.struct(F.col("source").alias("manual_id"), F.col("lang").alias("level1_id"), F.col("lang").alias("content_type"), F.array().cast("array<string>").alias("cross_references"))
    return d.select(F.col("source").alias("manual_id"), F.col("doc_id").alias("chunk_ord"), F.concat_ws("::", "source", F.col("doc_id").cast("string")).alias("chunk_id"), "text", meta.alias("metadata"))


# cleanup

@query("clean_literal_subs", "SELECT doc_id, replace(replace(text, 'tion', 'zion'), 'zz', 'z') AS cleaned FROM documents")
def _(spark, d):
    return docs(spark, d).select("doc_id", T.substitute(F.col("text"), PROSE.cleanup.known_substitutions).alias("cleaned"))


@query("clean_regex_subs", r"SELECT doc_id, regexp_replace(text, '([A-Za-z0-9_])ing\b', '\1in', 'g') AS cleaned FROM documents")
def _(spark, d):
    return docs(spark, d).select("doc_id", T.substitute_patterns(F.col("text"), [{"pattern": r"([A-Za-z0-9_])ing(?![A-Za-z0-9_])", "replacement": r"\1in"}]).alias("cleaned"))


_AZ = "abcdefghijklmnopqrstuvwxyz"


#: Words of capitals alone are spaced out, two spaces apart; of two letters they stay so.
@query("clean_spaced_caps", f"""
SELECT doc_id, array_to_string(list_transform(string_split(translate(text, '{_AZ}', '{_AZ.upper()}'), ' '), lambda w: CASE WHEN regexp_matches(w, '^[A-Z][A-Z]$') THEN w[1:1] || ' ' || w[2:2] ELSE w END), '  ') AS cleaned FROM documents""")
def _(spark, d):
    words = F.split(F.translate("text", _AZ, _AZ.upper()), " ", -1)
    raw = F.array_join(F.transform(words, lambda w: F.when(w.rlike("^[A-Z]+$"), F.array_join(F.split(w, ""), " ")).otherwise(w)), "  ")
    return docs(spark, d).select("doc_id", T.collapse_spaced(raw).alias("cleaned"))


_LINES = "string_split(text, chr(10))"


@query("clean_strip_headers", f"""
SELECT doc_id, array_to_string(list_filter({_LINES}, lambda l: NOT regexp_matches(l, '^Released under the|^Licensed under the')), chr(10)) AS cleaned,
  regexp_extract(list_filter({_LINES}, lambda l: regexp_matches(l, '^Released under the|^Licensed under the') AND regexp_matches(l, '[0-9]'))[1], '([0-9]+)', 1) AS page_id
FROM documents""")
def _(spark, d):
    keep, page = T.strip_headers(F.col("text"), PROSE.cleanup.header_footer_patterns)
    return docs(spark, d).select("doc_id", keep.alias("cleaned"), page.alias("page_id"))


@query("clean_garbage_lines", f"""
SELECT doc_id, array_to_string(list_filter(list_transform({_LINES}, lambda l, i: CASE WHEN len(list_filter(regexp_extract_all(l, '\\S+'), lambda w: length(regexp_replace(w, '[\\x00-\\x7F]', '', 'g')) / length(w) > 0.4)) > 0 THEN i - 1 END), lambda x: x IS NOT NULL), ',') AS garbage
FROM documents""")
def _(spark, d):
    return docs(spark, d).select("doc_id", F.array_join(T.garbage_lines(F.col("text"), 0.4).cast("array<string>"), ",").alias("garbage"))


@query("clean_normalize", f"""
SELECT doc_id, regexp_replace(array_to_string(list_transform(string_split(nfc_normalize(replace(replace(text, '’', ''''), 'ﬁ', 'fi')), chr(10)), lambda l: trim(regexp_replace(l, '[ \\t]+', ' ', 'g'))), chr(10)), '\\n{{3,}}', chr(10) || chr(10), 'g') AS cleaned
FROM documents""")
def _(spark, d):
    return T.normalized(docs(spark, d).select("doc_id", F.col("text").alias("cleaned")), "cleaned")


_HEAD = "^Released under the|^Licensed under the"
_CLEAN = r"""WITH pages_r AS (SELECT source AS manual_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS page_number, coalesce(text, '') AS raw FROM documents),
subs AS (SELECT *, string_split(regexp_replace(replace(replace(raw, 'tion', 'zion'), 'zz', 'z'), '([A-Za-z0-9_])ing\b', '\1in', 'g'), chr(10)) AS l FROM pages_r),
kept AS (SELECT *, list_filter(l, lambda x: NOT regexp_matches(x, '{h}')) AS k, list_filter(l, lambda x: regexp_matches(x, '{h}') AND regexp_matches(x, '[0-9]'))[1] AS first FROM subs),
clean AS (SELECT manual_id, page_number, raw,
  regexp_replace(array_to_string(list_transform(string_split(nfc_normalize(replace(replace(array_to_string(k, chr(10)), '’', ''''), 'ﬁ', 'fi')), chr(10)), lambda x: trim(regexp_replace(x, '[ \t]+', ' ', 'g'))), chr(10)), '\n{{3,}}', chr(10) || chr(10), 'g') AS text,
  CASE WHEN regexp_matches(first, '([0-9]+)\s*-\s*([0-9]+)') THEN regexp_extract(first, '([0-9]+)\s*-\s*([0-9]+)', 1) || '-' || regexp_extract(first, '([0-9]+)\s*-\s*([0-9]+)', 2) WHEN first IS NOT NULL THEN regexp_extract(first, '([0-9]+)', 1) END AS page_id,
  array_to_string(list_filter(list_transform(k, lambda x, i: CASE WHEN len(list_filter(regexp_extract_all(x, '\S+'), lambda w: length(regexp_replace(w, '[\x00-\x7F]', '', 'g')) / length(w) > 0.4)) > 0 THEN i - 1 END), lambda x: x IS NOT NULL), ',') AS garbage,
  CAST((length(raw) - length(replace(raw, 'tion', ''))) / 4 + (length(raw) - length(replace(raw, 'zz', ''))) / 2 AS BIGINT) AS subs
  FROM kept)""".format(h=_HEAD)


def cleaned(spark, d):
    return T.cleaned_pages(pages(spark, d), PROSE.cleanup)


@query("clean_page", _CLEAN + " SELECT manual_id, page_number, text AS cleaned_text, page_id AS extracted_page_id, garbage AS garbage_lines, subs AS substitutions_applied FROM clean")
def _(spark, d):
    garbage = F.array_join(F.col("garbage_lines").cast("array<string>"), ",").alias("garbage_lines")
    return cleaned(spark, d).select("manual_id", "page_number", "cleaned_text", "extracted_page_id", garbage, F.col("substitutions_applied").cast("long").alias("substitutions_applied"))


@query("cleanup_statistics", _CLEAN + """ SELECT manual_id, count(*) AS pages, CAST(sum(subs) AS BIGINT) AS substitutions, count(*) FILTER (subs > 0) AS pages_with_substitutions,
  CAST(sum(len(list_filter(string_split(garbage, ','), lambda x: x <> ''))) AS BIGINT) AS garbage_lines, count(*) FILTER (garbage <> '') AS pages_with_garbage, count(*) FILTER (page_id <> '') AS page_ids FROM clean GROUP BY 1""")
def _(spark, d):
    return analytics.cleanup_statistics(cleaned(spark, d))


_PAGES = "WITH pages_m AS (SELECT source AS manual_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS page_number, text FROM documents)"


@query("ocr_quality", _CLEAN + r""", n AS (
  SELECT manual_id, page_number, len(string_split(text, chr(10))) AS lines, len(list_filter(string_split(garbage, ','), lambda x: x <> '')) AS garbage, regexp_extract_all(text, '\S+') AS t FROM clean
), w AS (
  SELECT *, list_filter(list_transform(t, lambda x: regexp_replace(x, '^[^a-zA-Z0-9]+|[^a-zA-Z0-9]+$', '', 'g')), lambda x: x <> '') AS named FROM n
), q AS (
  SELECT *, len(list_filter(named, lambda x: regexp_matches(replace(x, '-', ''), '^\p{L}+$'))) AS good FROM w
), s AS (
  SELECT manual_id, count(*) AS total_pages, count(*) FILTER (page_number < 50) AS sampled_pages, sum(len(t)) FILTER (page_number < 50) AS tokens, sum(good) FILTER (page_number < 50) AS good,
    sum(len(named) - good) FILTER (page_number < 50) AS suspected_errors, sum(garbage) FILTER (page_number < 50) AS garbage, sum(lines) FILTER (page_number < 50) AS lines FROM q GROUP BY 1
)
SELECT manual_id, total_pages, sampled_pages, round(good / tokens, 6) AS dictionary_match_rate, round(garbage / lines, 6) AS garbage_line_rate, CAST(suspected_errors AS BIGINT) AS suspected_errors,
  good / tokens < 0.7 OR garbage / lines > 0.3 AS needs_reocr FROM s""")
def _(spark, d):
    return analytics.ocr_quality(cleaned(spark, d))


# lines and boundaries

_L = _PAGES + """, split AS (
  SELECT manual_id, page_number, string_split(text, chr(10)) AS l FROM pages_m
), off AS (
  SELECT *, coalesce(sum(len(l)) OVER (PARTITION BY manual_id ORDER BY page_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM split
), lines AS (
  SELECT manual_id, page_number, CAST(o + generate_subscripts(l, 1) - 1 AS BIGINT) AS line_number, unnest(l) AS text FROM off
)"""
_B = _L + r""", raw AS (
  SELECT manual_id, page_number, line_number,
    CASE WHEN regexp_matches(trim(text), '^\S+\.$') THEN 1 WHEN regexp_matches(trim(text), '^\S+ \S+\.$') THEN 2 WHEN regexp_matches(trim(text), '^\S+ \S+ \S+\.$') THEN 3 END AS level,
    regexp_extract(trim(text), '^(.*)\.$', 1) AS name FROM lines
), bounds AS (
  SELECT manual_id, level, CASE level WHEN 1 THEN 'one' WHEN 2 THEN 'two' ELSE 'three' END AS level_name, CASE WHEN level < 3 THEN name END AS id, CASE WHEN level = 3 THEN name END AS title, page_number, line_number
  FROM raw WHERE level IS NOT NULL
)"""
_W = _B + r""", sums AS (
  SELECT manual_id, line_number, sum(len(regexp_extract_all(text, '\S+'))) OVER (PARTITION BY manual_id ORDER BY line_number) - len(regexp_extract_all(text, '\S+')) AS before,
    sum(len(regexp_extract_all(text, '\S+'))) OVER (PARTITION BY manual_id) AS total FROM lines
), words AS (
  SELECT b.*, coalesce(lead(before) OVER (PARTITION BY b.manual_id ORDER BY b.line_number), total) - before AS words FROM bounds b JOIN sums USING (manual_id, line_number)
)"""


@query("lines_global", _L + " SELECT * FROM lines")
def _(spark, d):
    return structure.page_lines(pages(spark, d))


def found(spark, d):
    rows = structure.page_lines(pages(spark, d))
    return rows, structure.detect(rows, PROSE)


@query("boundaries_raw", _B + " SELECT * FROM bounds")
def _(spark, d):
    return found(spark, d)[1].select(structure.BOUNDARY)


#: Two levels that match the same lines.
_TWO = [{"level": 1, "name": "one", "id_pattern": r"^(\S+ \S+)\.$"}, {"level": 2, "name": "two", "id_pattern": r"^(?:\S+ )?(\S+)\.$"}]


@query("boundaries_ambiguous", """
WITH RECURSIVE """ + _L.removeprefix("WITH ") + r""", c AS (
  SELECT manual_id, line_number, regexp_matches(trim(text), '^\S+ \S+\.$') AS pair, regexp_extract(trim(text), '^(.*)\.$', 1) AS name, row_number() OVER (PARTITION BY manual_id ORDER BY line_number) AS k
  FROM lines WHERE regexp_matches(trim(text), '^(\S+ )?\S+\.$')
), walk AS (
  SELECT manual_id, k, CASE WHEN pair THEN 1 ELSE 2 END AS level FROM c WHERE k = 1
  UNION ALL
  SELECT c.manual_id, c.k, CASE WHEN NOT pair THEN 2 WHEN w.level = 1 THEN 2 ELSE 1 END FROM walk w JOIN c ON c.manual_id = w.manual_id AND c.k = w.k + 1
)
SELECT c.manual_id, level, CASE WHEN level = 1 THEN name ELSE regexp_extract(name, '(\S+)$', 1) END AS id, line_number FROM walk JOIN c USING (manual_id, k)""")
def _(spark, d):
    p = from_mapping({"schema_version": "1.0", "manual_id": "m", "manual_title": "t", "source_url": "none", "source_format": "html", "structure": {"hierarchy": _TWO}})
    return structure.detect(structure.page_lines(pages(spark, d)), p).select("manual_id", "level", "id", "line_number")


@query("filter_known_id", _B + " SELECT manual_id, level, id, line_number FROM bounds WHERE level <> 1 OR id IN ('The', 'A', 'Of')")
def _(spark, d):
    from dataclasses import replace

    p = replace(PROSE, hierarchy=tuple(replace(h, require_known_id=h.level == 1) for h in PROSE.hierarchy))
    return structure.known_only(found(spark, d)[1], p).select("manual_id", "level", "id", "line_number")


@query("filter_blank_before", _B + ", prev AS (SELECT manual_id, line_number, lag(text) OVER (PARTITION BY manual_id ORDER BY line_number) AS p FROM lines) SELECT manual_id, level, line_number FROM bounds JOIN prev USING (manual_id, line_number) WHERE level <> 3 OR trim(p) = ''")
def _(spark, d):
    from dataclasses import replace

    p = replace(PROSE, hierarchy=tuple(replace(h, require_blank_before=h.level == 3) for h in PROSE.hierarchy))
    rows, b = found(spark, d)
    return structure.after_blank(b, rows, p).select("manual_id", "level", "line_number")


@query("filter_min_gap", """
WITH RECURSIVE """ + _B.removeprefix("WITH ") + """, n AS (
  SELECT *, row_number() OVER (PARTITION BY manual_id, level ORDER BY line_number) AS k FROM bounds WHERE level = 2
), walk AS (
  SELECT manual_id, k, line_number, true AS kept, line_number AS last FROM n WHERE k = 1
  UNION ALL
  SELECT n.manual_id, n.k, n.line_number, n.line_number - w.last >= 40, CASE WHEN n.line_number - w.last >= 40 THEN n.line_number ELSE w.last END FROM walk w JOIN n ON n.manual_id = w.manual_id AND n.k = w.k + 1
)
SELECT manual_id, level, line_number FROM bounds WHERE level <> 2 UNION ALL SELECT manual_id, 2, line_number FROM walk WHERE kept""")
def _(spark, d):
    from dataclasses import replace

    p = replace(PROSE, hierarchy=tuple(replace(h, min_gap_lines=40 if h.level == 2 else 0) for h in PROSE.hierarchy))
    return structure.far_enough(found(spark, d)[1], p).select("manual_id", "level", "line_number")


@query("filter_min_words", _W + " SELECT manual_id, level, line_number FROM words WHERE level <> 2 OR words >= 20")
def _(spark, d):
    rows, b = found(spark, d)
    return structure.enough_words(b, rows, PROSE).select("manual_id", "level", "line_number")


@query("boundary_warnings", _B + " SELECT manual_id, line_number, 'Boundary one ''' || id || ''' at line ' || line_number || ' is not a known id' AS message FROM bounds WHERE level = 1 AND id NOT IN ('The', 'A', 'Of')")
def _(spark, d):
    return structure.warnings(found(spark, d)[1], PROSE)


@query("boundary_diagnostics", _W + """, p AS (SELECT manual_id, count(*) AS pages FROM pages_m GROUP BY 1)
SELECT w.manual_id, any_value(pages) AS pages, count(*) AS boundaries, CAST(min(words) AS BIGINT) AS min_words, CAST(trunc(median(words)) AS BIGINT) AS median_words, CAST(trunc(avg(words)) AS BIGINT) AS avg_words,
  CAST(max(words) AS BIGINT) AS max_words, count(*) FILTER (words <= 3) AS suspects, round(count(*) / any_value(pages), 6) AS per_page FROM words w JOIN p USING (manual_id) GROUP BY 1""")
def _(spark, d):
    rows, b = found(spark, d)
    return structure.diagnostics(b, rows)


@query("boundaries_by_level", _B + " SELECT level, count(*) AS n FROM bounds GROUP BY 1")
def _(spark, d):
    return found(spark, d)[1].groupBy("level").agg(F.count(F.lit(1)).alias("n"))


@query("boundaries_dropped", _W + " SELECT manual_id, level, line_number FROM words WHERE level = 2 AND words < 20")
def _(spark, d):
    rows, b = found(spark, d)
    return b.select("manual_id", "level", "line_number").exceptAll(structure.filtered(b, rows, PROSE).select("manual_id", "level", "line_number"))


_M = _B + """, open AS (
  SELECT *, row_number() OVER w - 1 AS entry_idx, coalesce(id, title) AS seg,
    last_value(CASE WHEN level = 1 THEN {'l': line_number, 's': coalesce(id, title)} END IGNORE NULLS) OVER w AS a1,
    last_value(CASE WHEN level = 2 THEN {'l': line_number, 's': coalesce(id, title)} END IGNORE NULLS) OVER w AS a2,
    max(CASE WHEN level < 2 THEN line_number END) OVER w AS c2
  FROM bounds WINDOW w AS (PARTITION BY manual_id ORDER BY line_number)
), parts AS (
  SELECT *, list_filter([CASE WHEN level > 1 THEN a1.s END, CASE WHEN level > 2 AND a2.l > coalesce(c2, -1) THEN a2.s END], lambda x: x IS NOT NULL) AS up FROM open
), manifest AS (
  SELECT manual_id, entry_idx, array_to_string(list_concat([manual_id], up, [seg]), '::') AS chunk_id, level, array_to_string(list_concat(up, [seg]), ' > ') AS path,
    CASE WHEN len(up) > 0 THEN array_to_string(list_concat([manual_id], up), '::') END AS parent_chunk_id, line_number FROM parts
)"""


def entries(spark, d):
    rows, b = found(spark, d)
    return rows, structure.manifest(b, PROSE)


@query("manifest_paths", _M + " SELECT manual_id, entry_idx, chunk_id, level, path, parent_chunk_id FROM manifest")
def _(spark, d):
    return entries(spark, d)[1].select("manual_id", F.col("entry_idx").cast("long").alias("entry_idx"), "chunk_id", "level", F.array_join("hierarchy_path", " > ").alias("path"), "parent_chunk_id")


@query("manifest_children", _M + """, kids AS (SELECT manual_id, parent_chunk_id AS chunk_id, string_agg(chunk_id, '|' ORDER BY entry_idx) AS children FROM manifest WHERE parent_chunk_id IS NOT NULL GROUP BY 1, 2),
first AS (SELECT manual_id, chunk_id, min(entry_idx) AS entry_idx FROM manifest GROUP BY 1, 2)
SELECT manual_id, entry_idx, children FROM first JOIN kids USING (manual_id, chunk_id)""")
def _(spark, d):
    return entries(spark, d)[1].where(F.size("children") > 0).select("manual_id", F.col("entry_idx").cast("long").alias("entry_idx"), F.array_join("children", "|").alias("children"))


@query("manifest_files", _M + " SELECT manual_id, entry_idx, chunk_id, level, path, parent_chunk_id FROM manifest")
def _(spark, d):
    """Manifests written as documents, one a manual, and read again."""
    path = f"{shared_dir(spark)}/quire-manifests-{uuid.uuid4().hex}"
    tables.save_manifest(entries(spark, d)[1], path)
    return tables.load_manifest(spark, path).select("manual_id", F.col("entry_idx").cast("long").alias("entry_idx"), "chunk_id", "level", F.array_join("hierarchy_path", " > ").alias("path"), "parent_chunk_id")


@query("chunk_files", "SELECT source AS manual_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS at, source || '::' || doc_id AS chunk_id, text, lang AS level1_id FROM documents")
def _(spark, d):
    """Documents as chunks, written as lines, a file a manual, and read again in order."""
    path = f"{shared_dir(spark)}/quire-chunks-{uuid.uuid4().hex}"
    tables.save_chunks(as_chunks(docs(spark, d)), path)
    at = F.row_number().over(Window.partitionBy("manual_id").orderBy("chunk_ord")).cast("long") - 1
    return tables.load_chunks(spark, path).select("manual_id", at.alias("at"), "chunk_id", "text", F.col("metadata.level1_id").alias("level1_id"))


_E = _M + """, filled AS (
  SELECT l.manual_id, l.line_number, l.text, last_value(m.entry_idx IGNORE NULLS) OVER (PARTITION BY l.manual_id ORDER BY l.line_number) AS entry_idx FROM lines l LEFT JOIN manifest m USING (manual_id, line_number)
), entry AS (
  SELECT manual_id, entry_idx, trim(string_agg(text, chr(10) ORDER BY line_number), ' ' || chr(10) || chr(9)) AS text FROM filled WHERE entry_idx IS NOT NULL GROUP BY 1, 2
)"""


@query("entry_text", _E + " SELECT manual_id, entry_idx, text FROM entry")
def _(spark, d):
    numbered = structure.numbered_pages(pages(spark, d))
    m = structure.manifest(structure.detect(structure.exploded(numbered), PROSE), PROSE)
    return structure.entry_text(numbered, m).select("manual_id", F.col("entry_idx").cast("long").alias("entry_idx"), "text")


# chunks

def flow(spark, d):
    """Pages cleaned as the command line does, where they lie, so that they are dealt out once; then chunks. Of all tables written on the way only
    the chunks stay."""
    clean = T.cleaned_pages(docs(spark, d), PROSE.cleanup).select("source", "doc_id", F.col("cleaned_text").alias("text"))
    return settled(spark, lambda: chunks.assembled(tables.document_pages(clean), PROSE), "chunks", "zstd")


_RANGES = r""", ranges AS (
  SELECT *, len(regexp_extract_all(x, '\S+')) AS n, regexp_extract_all(x, '\S+') AS w FROM big
), cut AS (
  SELECT k, i, generate_subscripts(p, 1) AS j, unnest(p) AS x, n > 2000 AS forced FROM (
    SELECT *, CASE WHEN n <= 2000 THEN [x] ELSE list_transform(range(0, n, 2000), lambda a: array_to_string(w[a + 1:a + 2000], ' ')) END AS p FROM ranges)
), units AS (SELECT *, len(regexp_extract_all(x, '\S+')) AS n, row_number() OVER (PARTITION BY k ORDER BY i, j) AS u FROM cut),
packing AS (
  SELECT k, u, n AS held, 0 AS g FROM units WHERE u = 1
  UNION ALL
  SELECT s.k, s.u, CASE WHEN s.forced OR w.held + s.n > 2000 THEN s.n ELSE w.held + s.n END, CASE WHEN s.forced OR w.held + s.n > 2000 THEN w.g + 1 ELSE w.g END FROM packing w JOIN units s ON s.k = w.k AND s.u = w.u + 1
), pieces AS (SELECT k, g AS i, string_agg(x, chr(10) ORDER BY u) AS x FROM packing JOIN units USING (k, u) GROUP BY 1, 2),
weighed AS (SELECT *, len(regexp_extract_all(x, '\S+')) AS n FROM pieces),
joining AS (
  SELECT k, i, n AS held, 0 AS g FROM weighed WHERE i = 0
  UNION ALL
  SELECT s.k, s.i, CASE WHEN w.held >= 100 THEN s.n ELSE w.held + s.n END, CASE WHEN w.held >= 100 THEN w.g + 1 ELSE w.g END FROM joining w JOIN weighed s ON s.k = w.k AND s.i = w.i + 1
), merged AS (SELECT k, g AS i, string_agg(x, chr(10) || chr(10) ORDER BY i) AS x FROM joining JOIN weighed USING (k, i) GROUP BY 1, 2)"""
#: The whole flow for the prose: cleaned pages, filtered boundaries, manifest, the rules that its profile leaves something to do, and the merge across entries.
_FLOW = "WITH RECURSIVE " + _CLEAN.removeprefix("WITH ") + _L.removeprefix(_PAGES).replace("FROM pages_m", "FROM clean") + _B.removeprefix(_L) + _W.removeprefix(_B) + r""", far AS (
  SELECT * FROM words WHERE level <> 2 OR words >= 20
)""" + _M.removeprefix(_B).replace("FROM bounds", "FROM far") + _E.removeprefix(_M) + r""", whole AS (
  SELECT manual_id || '|' || entry_idx AS k, manual_id, entry_idx, text, len(regexp_extract_all(text, '\S+')) AS n FROM entry WHERE regexp_matches(text, '\S')
), big AS (SELECT k, generate_subscripts(l, 1) - 1 AS i, unnest(l) AS x FROM (SELECT k, string_split(text, chr(10)) AS l FROM whole WHERE n > 2000))""" + _RANGES + r""", cited AS (
  SELECT *, CASE WHEN i > 0 AND len(list_filter(string_split(x, chr(10)), lambda y: trim(y) <> '' AND NOT regexp_matches(y, '\bthe ([\p{L}\p{N}_]+)\.') AND NOT (upper(y) = y AND lower(y) <> y AND len(regexp_extract_all(y, '\S+')) <= 5))) = 0 THEN 0 ELSE 1 END AS h FROM merged
), ruled AS (
  SELECT k, g - 1 AS part, string_agg(x, chr(10) || chr(10) ORDER BY i) AS x FROM (SELECT *, sum(h) OVER (PARTITION BY k ORDER BY i) AS g FROM cited) GROUP BY k, g
  UNION ALL SELECT k, 0, text FROM whole WHERE n <= 2000
), chunk_parts AS (
  SELECT w.manual_id AS m, w.entry_idx, r.part, lower(w.text) AS low, r.x AS text, o.chunk_id || CASE WHEN count(*) OVER (PARTITION BY k) > 1 THEN '::part' || CAST(r.part + 1 AS BIGINT) ELSE '' END AS chunk_id,
    split_part(o.chunk_id, '::', 2) AS l1, o.path, coalesce(f.title, f.id) AS title, f.level_name, f.page_number, len(regexp_extract_all(r.x, '\S+')) AS n,
    row_number() OVER (PARTITION BY w.manual_id ORDER BY w.entry_idx, r.part) AS i
  FROM ruled r JOIN whole w USING (k) JOIN manifest o ON o.manual_id = w.manual_id AND o.entry_idx = w.entry_idx JOIN far f ON f.manual_id = o.manual_id AND f.line_number = o.line_number
), runs AS (
  SELECT m, i, l1, n AS held, 0 AS g FROM chunk_parts WHERE i = 1
  UNION ALL
  SELECT c.m, c.i, c.l1, CASE WHEN j THEN held + c.n ELSE c.n END, CASE WHEN j THEN g ELSE g + 1 END
  FROM (SELECT w.m, w.i, w.held, w.g, w.held < 200 AND w.l1 = c.l1 AND w.held + c.n <= 2000 AS j FROM runs w JOIN chunk_parts c ON c.m = w.m AND c.i = w.i + 1) w JOIN chunk_parts c ON c.m = w.m AND c.i = w.i + 1
), chunks AS (
  SELECT m, g AS ord, arg_max(chunk_id, i) AS id, string_agg(text, chr(10) || chr(10) ORDER BY i) AS text, arg_max(chunk_parts.l1, i) AS l1, arg_max(title, i) AS title, arg_max(path, i) AS path, arg_max(level_name, i) AS kind, arg_max(page_number, i) AS page,
    arg_max(low, i) AS low, list_sort(list_distinct(list_transform(regexp_extract_all(arg_max(text, i), '\bthe ([\p{L}\p{N}_]+)\.', 1), lambda x: m || '::' || x))) AS refs
  FROM runs JOIN chunk_parts USING (m, i) GROUP BY m, g
)"""


@query("chunks", _FLOW + """ SELECT m AS manual_id, CAST(ord AS BIGINT) AS chunk_ord, id AS chunk_id, text, l1 AS level1_id, title AS procedure_name, 'Prose | ' || replace(path, ' > ', ' | ') AS hierarchical_header, kind AS content_type, CAST(page AS VARCHAR) AS page,
  CASE WHEN contains(low, 'the') THEN 'The' ELSE 'all' END AS models, CASE WHEN contains(low, 'la') OR contains(low, 'queue') OR contains(low, 'thing') THEN 'la' ELSE 'all' END AS engines, CASE WHEN contains(low, 'und') THEN 'und' ELSE 'all' END AS drives,
  array_to_string(refs, ',') AS cross_references FROM chunks""")
def _(spark, d):
    listed = (("vehicle_models", "models"), ("engine_applicability", "engines"), ("drivetrain_applicability", "drives"), ("cross_references", "cross_references"))
    plain = [F.col(f"metadata.{c}").alias(c) for c in ("level1_id", "procedure_name", "hierarchical_header", "content_type")]
    return flow(spark, d).select("manual_id", "chunk_ord", "chunk_id", "text", *plain, F.col("metadata.page_range.start").alias("page"), *[F.array_join(f"metadata.{a}", ",").alias(b) for a, b in listed])


# rules, on texts made from documents

def numbered(text):
    """Lines as steps, but for every third by its length."""
    return F.array_join(F.transform(T.lines(text), lambda x: F.when(F.length(x) % 3 == 0, x).otherwise(F.concat(F.lit("("), (F.length(x) % 4).cast("string"), F.lit(") "), x))), "\n")


def called(text):
    """Lines with callouts of two kinds, by their length."""
    warning = lambda x: F.when(F.length(x) % 5 == 0, F.concat(F.lit("WARNING: "), x)).otherwise(x)
    note = lambda x: F.when(F.length(x) % 7 == 0, F.concat(x, F.lit(" note: x"))).otherwise(x)
    return F.array_join(F.transform(T.lines(text), lambda x: note(warning(x))), "\n")


def leadered(text):
    """Lines with dot leaders, but for every third by its length."""
    return F.array_join(F.transform(T.lines(text), lambda x: F.when(F.length(x) % 3 == 0, x).otherwise(F.concat(F.lit("Gap....3 "), x))), "\n")


def marked(text, name: str, every: int, kinds: int):
    """Lines that begin with a name and a number below kinds, where their length is a multiple of every."""
    number = lambda x: F.floor(F.length(x) / every) % kinds
    return F.array_join(F.transform(T.lines(text), lambda x: F.when(F.length(x) % every == 0, F.concat(F.lit(name), number(x).cast("string"), F.lit(" "), x)).otherwise(x)), "\n")


_TEXT_LINES = "list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: {})"
_NUMBERED = _TEXT_LINES.format("CASE WHEN length(x) % 3 = 0 THEN x ELSE '(' || (length(x) % 4) || ') ' || x END")
_CALLED = _TEXT_LINES.format("(CASE WHEN length(x) % 5 = 0 THEN 'WARNING: ' ELSE '' END) || x || (CASE WHEN length(x) % 7 = 0 THEN ' note: x' ELSE '' END)").replace(
    "CASE WHEN length(x) % 7 = 0", "CASE WHEN (length(x) + CASE WHEN length(x) % 5 = 0 THEN 9 ELSE 0 END) % 7 = 0"
)
_LEADERED = _TEXT_LINES.format("CASE WHEN length(x) % 3 = 0 THEN x ELSE 'Gap....3 ' || x END")
_REFS = _TEXT_LINES.format("CASE WHEN length(x) % 4 = 0 THEN 'Refer to ' || (length(x) // 4 % 9) || ' ' || x ELSE x END")
_FIGURES = _TEXT_LINES.format("CASE WHEN length(x) % 2 = 0 THEN 'FIG. B-' || (length(x) // 2 % 3) || ' ' || x ELSE x END")


def _rows(made: str) -> str:
    """SQL: the lines of each document with their numbers."""
    return f"WITH a AS (SELECT doc_id, {made} AS l FROM documents), rows AS (SELECT doc_id, generate_subscripts(l, 1) - 1 AS i, unnest(l) AS x FROM a)"


def ruled(spark, d, text, rule) -> DataFrame:
    """doc_id and what a rule gives for the document's text, in rows with their place."""
    made = docs(spark, d).select("doc_id", text(F.coalesce("text", F.lit(""))).alias("t"))
    return rules.on_texts(made, "t", lambda t: list(enumerate(rule(t))), StructType([StructField("place", IntegerType()), StructField("part", StringType())]))


_BARE = "trim(x, ' ' || chr(9) || chr(10) || chr(13))"
#: SQL: islands of step lines; a new one begins where numbering starts again after other lines.
_STEPS = _rows(_NUMBERED) + r""", marks AS (
  SELECT doc_id, i, CAST(regexp_extract(x, '^\((\d+)\)\s', 1) AS INT) AS n FROM rows WHERE regexp_matches(trim(x), '^\((\d+)\)\s')
), fresh AS (
  SELECT *, CASE WHEN lag(i) OVER w IS NULL OR (i - lag(i) OVER w > 1 AND n = 1 AND lag(n) OVER w >= 1) THEN 1 ELSE 0 END AS f FROM marks WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), numbered AS (SELECT *, sum(f) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM fresh),
steps AS (SELECT doc_id, k, min(i) AS a, max(i) AS b FROM numbered GROUP BY 1, 2)"""


@query("step_sequences", _STEPS + " SELECT doc_id, CAST(k - 1 AS INT) AS place, a || '-' || b AS part FROM steps")
def _(spark, d):
    return ruled(spark, d, numbered, lambda t: [f"{a}-{b}" for a, b in rules.steps(t, list(MANUAL.step_patterns[:1]))])


@query("rule_r3", _STEPS + f""", placed AS (
  SELECT r.doc_id, r.i, r.x, s.k, (SELECT count(*) FROM steps e WHERE e.doc_id = r.doc_id AND e.b < r.i) AS before FROM rows r LEFT JOIN steps s ON s.doc_id = r.doc_id AND r.i BETWEEN s.a AND s.b
), pieces AS (SELECT doc_id, CASE WHEN k IS NULL THEN 2 * before ELSE 2 * k - 1 END AS g, {_BARE.replace('(x,', "(string_agg(x, chr(10) ORDER BY i),")} AS part FROM placed GROUP BY 1, 2)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY g) - 1 AS INT) AS place, part FROM pieces WHERE part <> ''""")
def _(spark, d):
    return ruled(spark, d, numbered, lambda t: rules.keep_steps([t], list(MANUAL.step_patterns[:1])))


#: SQL: callouts with the line before the next stop.
_CALLOUTS = _rows(_CALLED) + r""", kinds AS (
  SELECT *, regexp_matches(trim(x), '^WARNING') AS warning, regexp_matches(trim(x), '(?i)note:') AS note FROM rows
), ends AS (SELECT *, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i), (SELECT max(i) + 1 FROM rows r WHERE r.doc_id = kinds.doc_id)) - 1 AS b FROM kinds
  WHERE warning OR note OR trim(x) = '' OR regexp_matches(trim(x), '^(\(\d+\)|[a-z]\.)\s')
), found AS (SELECT doc_id, 'warning' AS level, 1 AS o, i, b FROM ends WHERE warning UNION ALL SELECT doc_id, 'note', 2, i, b FROM ends WHERE note)"""


@query("safety_callouts", _CALLOUTS + " SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY o, i) - 1 AS INT) AS place, level || ':' || i || '-' || b AS part FROM found")
def _(spark, d):
    return ruled(spark, d, called, lambda t: [f"{x}:{a}-{b}" for x, a, b, _ in rules.callouts(t, MANUAL.callouts)])


#: Of lines that are callouts in a row, the first, third and so on take the next line.
@query("rule_r4", _rows(_CALLED) + r""", kinds AS (
  SELECT *, regexp_matches(trim(x), '^WARNING') OR regexp_matches(trim(x), '(?i)note:') AS c FROM rows
), runs AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, c ORDER BY i) AS run FROM kinds),
odd AS (SELECT *, c AND row_number() OVER (PARTITION BY doc_id, c, run ORDER BY i) % 2 = 1 AS takes FROM runs),
heads AS (SELECT *, CASE WHEN coalesce(lag(takes) OVER (PARTITION BY doc_id ORDER BY i), false) THEN 0 ELSE 1 END AS h FROM odd),
grouped AS (SELECT *, sum(h) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM heads)
SELECT doc_id, CAST(g - 1 AS INT) AS place, string_agg(x, chr(10) || chr(10) ORDER BY i) AS part FROM grouped GROUP BY 1, 2""")
def _(spark, d):
    return ruled(spark, d, called, lambda t: rules.attach_callouts(t.split("\n"), MANUAL.callouts))


@query("tables_detected", _rows(_LEADERED) + r""", marks AS (
  SELECT doc_id, i FROM rows WHERE regexp_matches(x, '\.{3,}')
), fresh AS (SELECT *, CASE WHEN coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i), 9) > 3 THEN 1 ELSE 0 END AS f FROM marks),
numbered AS (SELECT *, sum(f) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM fresh),
islands AS (SELECT doc_id, k, min(i) AS a, max(i) AS b FROM numbered GROUP BY 1, 2)
SELECT s.doc_id, CAST(k - 1 AS INT) AS place, (CASE WHEN trim(r.x) <> '' AND NOT regexp_matches(r.x, '\.{3,}') THEN a - 1 ELSE a END) || '-' || b AS part
FROM islands s LEFT JOIN rows r ON r.doc_id = s.doc_id AND r.i = s.a - 1""")
def _(spark, d):
    return ruled(spark, d, leadered, lambda t: [f"{a}-{b}" for a, b in rules.tables(t)])


#: Neighbours that both have leaders are one table.
@query("rule_r5", _rows(_LEADERED) + r""", heads AS (
  SELECT *, CASE WHEN regexp_matches(x, '\.{3,}') AND coalesce(lag(regexp_matches(x, '\.{3,}')) OVER (PARTITION BY doc_id ORDER BY i), false) THEN 0 ELSE 1 END AS h FROM rows
), grouped AS (SELECT *, sum(h) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM heads)
SELECT doc_id, CAST(g - 1 AS INT) AS place, string_agg(x, chr(10) ORDER BY i) AS part FROM grouped GROUP BY 1, 2""")
def _(spark, d):
    return ruled(spark, d, leadered, lambda t: rules.join_tables(t.split("\n")))


#: For texts without blank lines, as the documents are: lines are packed, and one of over 2000 words is cut into pieces of which the last is packed on.
@query("rule_r2", """
WITH RECURSIVE """ + _rows(_TEXT_LINES.format("x")).removeprefix("WITH ") + r""", sized AS (
  SELECT *, len(regexp_extract_all(x, '\S+')) AS n, regexp_extract_all(x, '\S+') AS w FROM rows
), cut AS (
  SELECT doc_id, i, generate_subscripts(p, 1) AS j, unnest(p) AS x, n > 2000 AS forced FROM (
    SELECT *, CASE WHEN n <= 2000 THEN [x] ELSE list_transform(range(0, n, 2000), lambda k: array_to_string(w[k + 1:k + 2000], ' ')) END AS p FROM sized)
), units AS (SELECT *, len(regexp_extract_all(x, '\S+')) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY i, j) AS u FROM cut),
walk AS (
  SELECT doc_id, u, n AS held, 0 AS g FROM units WHERE u = 1
  UNION ALL
  SELECT s.doc_id, s.u, CASE WHEN s.forced OR w.held + s.n > 2000 THEN s.n ELSE w.held + s.n END, CASE WHEN s.forced OR w.held + s.n > 2000 THEN w.g + 1 ELSE w.g END FROM walk w JOIN units s ON s.doc_id = w.doc_id AND s.u = w.u + 1
)
SELECT doc_id, g AS place, string_agg(x, chr(10) ORDER BY u) AS part FROM walk JOIN units USING (doc_id, u) GROUP BY 1, 2""")
def _(spark, d):
    return ruled(spark, d, lambda t: t, lambda t: rules.split_large([t]))


@query("rule_r6", """
WITH RECURSIVE """ + _rows(_TEXT_LINES.format("x")).removeprefix("WITH ") + r""", sized AS (
  SELECT *, len(regexp_extract_all(x, '\S+')) AS n, max(i) OVER (PARTITION BY doc_id) AS last FROM rows
), walk AS (
  SELECT doc_id, i, n AS held, 0 AS g FROM sized WHERE i = 0
  UNION ALL
  SELECT s.doc_id, s.i, CASE WHEN w.held >= 100 THEN s.n ELSE w.held + s.n END, CASE WHEN w.held >= 100 THEN w.g + 1 ELSE w.g END FROM walk w JOIN sized s ON s.doc_id = w.doc_id AND s.i = w.i + 1
)
SELECT doc_id, g AS place, string_agg(x, chr(10) || chr(10) ORDER BY i) AS part FROM walk JOIN sized USING (doc_id, i) GROUP BY 1, 2""")
def _(spark, d):
    return ruled(spark, d, lambda t: t, lambda t: rules.merge_small(t.split("\n")))


#: A line of references alone, or with no more than five words in capitals, goes after the one before.
@query("rule_r7", _rows(_REFS) + r""", heads AS (
  SELECT *, CASE WHEN i > 0 AND (trim(x) = '' OR regexp_matches(trim(x), '[Rr]efer to ([\p{L}\p{N}_]+)') OR (upper(x) = x AND lower(x) <> x AND len(regexp_extract_all(x, '\S+')) <= 5)) THEN 0 ELSE 1 END AS h FROM rows
), grouped AS (SELECT *, sum(h) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM heads)
SELECT doc_id, CAST(g - 1 AS INT) AS place, string_agg(x, chr(10) || chr(10) ORDER BY i) AS part FROM grouped GROUP BY 1, 2""")
def _(spark, d):
    return ruled(spark, d, lambda t: marked(t, "Refer to ", 4, 9), lambda t: rules.merge_references(t.split("\n"), list(MANUAL.cross_reference_patterns)))


#: Neighbours that begin with the same figure are one piece.
@query("rule_r8", _rows(_FIGURES) + r""", named AS (SELECT *, regexp_extract(x, 'FIG\. (\w+-\d+)', 1) AS f FROM rows),
heads AS (SELECT *, CASE WHEN f <> '' AND f = lag(f) OVER (PARTITION BY doc_id ORDER BY i) THEN 0 ELSE 1 END AS h FROM named),
grouped AS (SELECT *, sum(h) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM heads)
SELECT doc_id, CAST(g - 1 AS INT) AS place, string_agg(x, chr(10) || chr(10) ORDER BY i) AS part FROM grouped GROUP BY 1, 2""")
def _(spark, d):
    return ruled(spark, d, lambda t: marked(t, "FIG. B-", 2, 3), lambda t: rules.keep_figures(t.split("\n"), MANUAL.figure_pattern))


@query("merge_across_entries", r"""
WITH RECURSIVE c AS (
  SELECT source AS m, lang AS l1, source || '::' || lang || '::' || doc_id AS chunk_id, len(regexp_extract_all(coalesce(text, ''), '\S+')) AS n, row_number() OVER (PARTITION BY source ORDER BY lang, doc_id) AS i FROM documents
), walk AS (
  SELECT m, i, l1, chunk_id, n AS held, 1 AS g FROM c WHERE i = 1
  UNION ALL
  SELECT c.m, c.i, c.l1, c.chunk_id, CASE WHEN j THEN held + c.n ELSE c.n END, CASE WHEN j THEN g ELSE g + 1 END
  FROM (SELECT w.m, w.i, w.held, w.g, w.held < 200 AND w.l1 = c.l1 AND w.held + c.n <= 2000 AS j FROM walk w JOIN c ON c.m = w.m AND c.i = w.i + 1) w JOIN c ON c.m = w.m AND c.i = w.i + 1
)
SELECT arg_max(chunk_id, i) AS chunk_id, max_by(held, i) AS n FROM walk GROUP BY m, g""")
def _(spark, d):
    order = F.row_number().over(Window.partitionBy("source").orderBy("lang", "doc_id"))
    c = docs(spark, d).select(F.col("source").alias("manual_id"), order.alias("entry_idx"), F.lit(0).alias("part_idx"), F.concat_ws("::", "source", "lang", F.col("doc_id").cast("string")).alias("chunk_id"), F.coalesce("text", F.lit("")).alias("text"), F.struct("lang").alias("metadata"))
    return chunks.merge_across(c, ["entry_idx", "part_idx"]).select("chunk_id", T.count_tokens(F.col("text")).cast("long").alias("n"))


@query("tag_applicability", """
SELECT doc_id, CASE WHEN contains(lower(text), 'the') THEN 'The' ELSE 'all' END AS models, CASE WHEN contains(lower(text), 'la') OR contains(lower(text), 'queue') OR contains(lower(text), 'thing') THEN 'la' ELSE 'all' END AS engines,
  CASE WHEN contains(lower(text), 'und') THEN 'und' ELSE 'all' END AS drives FROM documents""")
def _(spark, d):
    a = chunks.applicability(F.col("text"), PROSE)
    return docs(spark, d).select("doc_id", *[F.array_join(a[k], ",").alias(n) for k, n in (("vehicle_models", "models"), ("engine_applicability", "engines"), ("drivetrain_applicability", "drives"))])


@query("enrich_refs", r"SELECT doc_id, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(text, '\bthe ([\p{L}\p{N}_]+)\.', 1), lambda x: source || '::' || x))), ',') AS refs FROM documents")
def _(spark, d):
    r = chunks.references(F.col("text"), F.col("source"), PROSE)
    return docs(spark, d).select("doc_id", F.array_join(r["cross_references"], ",").alias("refs"))


_N = r"len(regexp_extract_all(text, '\S+'))"


@query("token_counts", f"SELECT doc_id, {_N} AS n_tokens FROM documents")
def _(spark, d):
    return docs(spark, d).select("doc_id", T.count_tokens(F.col("text")).cast("long").alias("n_tokens"))


@query("token_stats", f"""
WITH t AS (SELECT {_N} AS n FROM documents)
SELECT count(*) AS chunks, min(n) AS min, max(n) AS max, round(avg(n), 6) AS mean, median(n) AS median, round(stddev_samp(n), 6) AS stdev, round(100.0 * count(*) FILTER (n < 200) / count(*), 4) AS under,
  round(100.0 * count(*) FILTER (n BETWEEN 200 AND 2000) / count(*), 4) AS within, round(100.0 * count(*) FILTER (n > 2000) / count(*), 4) AS over FROM t""")
def _(spark, d):
    return analytics.token_stats(docs(spark, d))


@query("size_histogram", f"SELECT CAST(least({_N} // 200, 9) AS INT) AS bucket, count(*) AS n FROM documents GROUP BY 1")
def _(spark, d):
    return analytics.size_histogram(docs(spark, d))


@query("size_ladder", f"SELECT CASE {' '.join(f'WHEN {_N} < {s} THEN {s}' for s in analytics.HISTOGRAM)} ELSE {1 << 30} END AS under, count(*) AS n FROM documents GROUP BY 1")
def _(spark, d):
    return analytics.size_ladder(docs(spark, d))


# embeddings, index and retrieval

@query("embedding_input", r"SELECT doc_id, lang || chr(10) || chr(10) || array_to_string(regexp_extract_all(text, '\S+')[1:150], ' ') AS embedding_input FROM documents")
def _(spark, d):
    df = docs(spark, d).withColumn("metadata", F.struct(F.col("lang").alias("hierarchical_header")))
    return index.embedding_input(df).select("doc_id", "embedding_input")


@query("point_ids", """
WITH h AS (SELECT doc_id, sha1(from_hex('6ba7b8119dad11d180b400c04fd430c8') || encode(source || '::' || doc_id)) AS h FROM documents)
SELECT doc_id, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || substr('89ab', CAST(('0x' || h[17:17])::INT % 4 + 1 AS INT), 1) || h[18:20] || '-' || h[21:32] AS point_id FROM h""")
def _(spark, d):
    return docs(spark, d).select("doc_id", T.point_id(F.concat_ws("::", "source", F.col("doc_id").cast("string"))).alias("point_id"))


@query("vectors")
def _(spark, d):
    return index.vectors(as_chunks(docs(spark, d)).withColumn("metadata", F.struct(F.col("metadata.manual_id").alias("level1_id"), F.col("metadata.level1_id").alias("hierarchical_header"))))


def _search(spark, d, keys=None):
    e = read(spark, d, "embeddings")
    q = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"), F.col("label").alias("manual_id"))
    return index.nearest(q if keys else q.drop("manual_id"), e.select(F.col("vec_id").alias("point"), F.col("embedding").alias("v"), F.col("label").alias("manual_id")), 10, keys).select("query_id", "point", F.round("score", 6).alias("score"), "rank")


def _top(where: str) -> str:
    return f"""
WITH s AS (SELECT q.vec_id AS query_id, p.vec_id AS point, list_cosine_similarity(q.embedding::DOUBLE[], p.embedding::DOUBLE[]) AS s FROM embeddings q, embeddings p WHERE q.vec_id % 50 = 0 {where}),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, point) AS rank FROM s)
SELECT query_id, point, round(s, 6) AS score, CAST(rank AS INT) AS rank FROM r WHERE rank <= 10"""


@query("vector_topk", _top(""))
def _(spark, d):
    return _search(spark, d)


@query("vector_topk_filtered", _top("AND q.label = p.label"))
def _(spark, d):
    return _search(spark, d, ["manual_id"])


def _near(spark, d) -> DataFrame:
    """The same searches by inverted file and codes."""
    e = read(spark, d, "embeddings")
    q = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))
    return ann.nearest_approximately(q, e.select(F.col("vec_id").alias("point"), F.col("embedding").alias("v")), 10)


@query("vector_topk_approx")
def _(spark, d):
    return _near(spark, d).select("query_id", "point", F.round("score", 6).alias("score"), "rank", "scanned")


#: Recall at 10 against the exact search, which has to be 0.9 or more, and that scores are the exact ones.
@query("vector_recall", "SELECT count(*) AS queries, CAST(10 AS INT) AS k, true AS enough, true AS exact_scores FROM embeddings WHERE vec_id % 50 = 0")
def _(spark, d):
    near, exact = written(_near(spark, d), "near"), _search(spark, d)
    both = exact.join(near.select("query_id", "point", F.round("score", 6).alias("near")), ["query_id", "point"], "left")
    counts = both.agg(F.count_distinct("query_id").alias("queries"), (F.count("near") >= 0.9 * F.count(F.lit(1))).alias("enough"), F.coalesce(F.bool_and(F.abs(F.col("near") - F.col("score")) < 1e-5), F.lit(True)).alias("exact_scores"))
    return counts.select("queries", F.lit(10).alias("k"), "enough", "exact_scores")


#: What is put behind a question, by its conversation.
_ASKED = " on a CJ-5 with 4WD, brake pads?", " What is the torque for the 4.0L I6 engine of a Cherokee?", " Why the noise from the transfer case?", ""
_ASKED_SQL = "text || CASE conv_id % 4 " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(_ASKED)) + " END"


def questions(spark, d):
    more = F.element_at(F.array(*map(F.lit, _ASKED)), (F.col("conv_id") % 4 + 1).cast("int"))
    return read(spark, d, "conversations").where("role = 'user'").select("conv_id", "turn", F.concat("text", more).alias("query"))


def _firsts(patterns: list[str]) -> str:
    each = ", ".join("regexp_extract(text, '{}', 0)".format(p.replace("'", "''")) for p in patterns)
    return f"array_to_string(list_filter([{each}], lambda x: x <> ''), ',')"


def _systems() -> str:
    each = ", ".join("CASE WHEN " + " OR ".join(f"contains(lower(text), '{w}')" for w in ws) + f" THEN '{s}' END" for s, ws in retrieval.SYSTEMS.items())
    return f"array_to_string(list_filter([{each}], lambda x: x IS NOT NULL), ',')"


def _hits(patterns: list[str]) -> str:
    return " + ".join("CAST(regexp_matches(text, '(?i){}') AS INT)".format(p.replace("'", "''")) for p in patterns)


_TYPE = "CASE WHEN d >= s AND d > p THEN 'diagnostic' WHEN s >= d AND s > p THEN 'specification' ELSE 'procedure' END AS query_type"
_COUNTS = f"{_hits(retrieval.PROCEDURE)} AS p, {_hits(retrieval.SPECIFICATION)} AS s, {_hits(retrieval.DIAGNOSTIC)} AS d"


@query("query_analysis", f"""
WITH q AS (SELECT conv_id, turn, {_ASKED_SQL} AS text FROM conversations WHERE role = 'user'), c AS (SELECT *, {_COUNTS} FROM q)
SELECT conv_id, turn, {_firsts(retrieval.VEHICLES)} AS vehicles, {_firsts(retrieval.ENGINES)} AS engines, {_firsts(retrieval.DRIVETRAINS)} AS drivetrains, {_systems()} AS systems, {_TYPE} FROM c""")
def _(spark, d):
    names = (("vehicle_scope", "vehicles"), ("engine_scope", "engines"), ("drivetrain_scope", "drivetrains"), ("system_scope", "systems"))
    return retrieval.analyzed(questions(spark, d)).select("conv_id", "turn", *[F.array_join(a, ",").alias(b) for a, b in names], "query_type")


@query("query_type", f"WITH c AS (SELECT conv_id, turn, {_COUNTS} FROM conversations WHERE role = 'user') SELECT conv_id, turn, {_TYPE} FROM c")
def _(spark, d):
    return read(spark, d, "conversations").where("role = 'user'").select("conv_id", "turn", retrieval.query_type(F.col("text")).alias("query_type"))


@query("query_systems", f"SELECT conv_id, turn, {_systems()} AS systems FROM conversations WHERE role = 'user'")
def _(spark, d):
    return read(spark, d, "conversations").where("role = 'user'").select("conv_id", "turn", F.array_join(retrieval.scopes(F.col("text"))["system_scope"], ",").alias("systems"))


# retrieval over tables

_APPLIES = """CASE WHEN contains(lower(text), 'the') THEN ['The'] ELSE ['all'] END"""


def tagged(spark, d) -> DataFrame:
    """Documents as chunks with what the lookup tables read."""
    from dataclasses import replace

    p = replace(PROSE, figure_pattern=r"\bthe (\w+),")
    c = docs(spark, d).withColumns(chunks.applicability(F.col("text"), p)).withColumns(chunks.references(F.col("text"), F.col("source"), p))
    meta = F.struct(F.col("source").alias("manual_id"), F.col("lang").alias("procedure_name"), F.col("source").alias("level1_id"), "vehicle_models", "figure_references", "cross_references")
    return c.select(F.concat_ws("::", "source", F.col("doc_id").cast("string")).alias("chunk_id"), F.col("source").alias("manual_id"), F.col("doc_id").alias("chunk_ord"), "text", meta.alias("metadata"))


def _each(name: str, pattern: str, prefix: str = "") -> str:
    return rf"SELECT source || '::' || doc_id AS chunk_id, source AS manual_id, {prefix}unnest(list_distinct(regexp_extract_all(text, '{pattern}', 1))) AS {name} FROM documents"


@query("lookup_procedure", "SELECT source || '::' || doc_id AS chunk_id, source AS manual_id, lang AS procedure_name, source AS level1_id FROM documents")
def _(spark, d):
    return index.lookups(tagged(spark, d))["procedure_lookup"]


@query("lookup_vehicle", f"SELECT source || '::' || doc_id AS chunk_id, source AS manual_id, unnest({_APPLIES}) AS vehicle_model FROM documents")
def _(spark, d):
    return index.lookups(tagged(spark, d))["vehicle_model_lookup"]


@query("lookup_figure", _each("figure_reference", r"\bthe ([\p{L}\p{N}_]+),"))
def _(spark, d):
    return index.lookups(tagged(spark, d))["figure_lookup"]


@query("lookup_cross_ref", _each("cross_reference", r"\bthe ([\p{L}\p{N}_]+)\.", "source || '::' || "))
def _(spark, d):
    return index.lookups(tagged(spark, d))["cross_ref_lookup"]


def _built(spark, d) -> str:
    """The index of the flow's chunks, as written tables."""
    path = f"{shared_dir(spark)}/quire-index-{uuid.uuid4().hex}"
    index.build(flow(spark, d), path)
    return path


@query("index_counts", _FLOW + """ SELECT 'vectors' AS "table", count(DISTINCT id) AS n FROM chunks UNION ALL SELECT 'procedure_lookup', count(*) FROM chunks UNION ALL SELECT 'vehicle_model_lookup', count(*) FROM chunks
  UNION ALL SELECT 'figure_lookup', 0 UNION ALL SELECT 'cross_ref_lookup', CAST(coalesce(sum(len(refs)), 0) AS BIGINT) FROM chunks""")
def _(spark, d):
    path = _built(spark, d)
    tables_ = ["vectors", *index.LOOKUPS]
    return reduce(DataFrame.unionByName, [snapshots.opened(spark, path, t).agg(F.lit(t).alias("table"), F.count(F.lit(1)).alias("n")) for t in tables_])


@query("retrieve")
def _(spark, d):
    """Users' questions of every 50th conversation, against all chunks of the flow."""
    q = questions(spark, d).where("conv_id % 50 = 0").select(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("query_id"), "query")
    return retrieval.retrieve(q, _built(spark, d))


#: Neighbours by text: the primary results are the three longest documents of each source, their parent the first document of the source, siblings the next.
@query("retrieve_enriched", r"""
WITH c AS (SELECT source AS query_id, source || '::' || doc_id AS id, row_number() OVER (PARTITION BY source ORDER BY length(text) DESC, doc_id) - 1 AS ord, source || '::' || min(doc_id) OVER (PARTITION BY source) AS parent, source || '::' || (doc_id + 1) AS sibling,
  list_sort(list_distinct(list_transform(regexp_extract_all(text, '\bthe ([\p{L}\p{N}_]+)\.', 1), lambda x: source || '::' || x))) AS refs, source, doc_id FROM documents),
p AS (SELECT *, 0.9 - 0.1 * ord AS score FROM c WHERE ord < 3),
r1 AS (SELECT query_id, id, score, 'primary' AS source, 0 AS step, ord AS o, 0 AS i FROM p),
r2 AS (SELECT query_id, parent AS id, score * 0.7 AS score, 'parent' AS source, 1 AS step, ord AS o, 0 AS i FROM p),
r3 AS (SELECT query_id, sibling AS id, score * 0.6 AS score, 'sibling' AS source, 2 AS step, ord AS o, 0 AS i FROM p),
cited AS (SELECT c.id, unnest(c.refs) AS ref FROM c),
asked AS (SELECT query_id, score, ord, generate_subscripts(refs, 1) - 1 AS i, unnest(refs) AS ref FROM p),
r4 AS (SELECT a.query_id, c.id, a.score * 0.5 AS score, 'cross_ref' AS source, 3 AS step, a.ord AS o, a.i FROM asked a JOIN cited c USING (ref)),
every AS (SELECT * FROM r1 UNION ALL SELECT * FROM r2 UNION ALL SELECT * FROM r3 UNION ALL SELECT * FROM r4),
first AS (SELECT *, row_number() OVER (PARTITION BY query_id, id ORDER BY step, o, i) AS k FROM every),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, step, o, i, id) AS rank FROM first WHERE k = 1)
SELECT query_id, id AS chunk_id, round(score, 6) AS score, source, CAST(rank AS INT) AS rank FROM ranked WHERE rank <= 5""")
def _(spark, d):
    c = tagged(spark, d).withColumn("doc_id", F.col("chunk_ord"))
    w = Window.partitionBy("manual_id")
    c = c.withColumns({"ord": F.row_number().over(w.orderBy(F.desc(F.length("text")), "doc_id")) - 1, "least": F.min("doc_id").over(w)})
    name = lambda i: F.concat_ws("::", "manual_id", i.cast("string"))
    primary = c.where("ord < 3").select(
        F.col("manual_id").alias("query_id"), "ord", "chunk_id", (F.lit(0.9) - 0.1 * F.col("ord")).alias("score"), name(F.col("least")).alias("parent_chunk_id"),
        F.array(name(F.col("doc_id") + 1)).alias("sibling_chunk_ids"), F.col("metadata.cross_references").alias("cross_references"),
    )
    found = retrieval.reranked(retrieval.enriched(primary, index.lookups(tagged(spark, d))))
    return found.select("query_id", "chunk_id", F.round("score", 6).alias("score"), "source", "rank")


# checks

def _plain(df: DataFrame, *details: str) -> DataFrame:
    return df.select("check", "severity", "chunk_id", *[F.col(f"details.{k}").alias(k) for k in details])


@query("qa_size", f"SELECT 'size_outliers' AS \"check\", 'warning' AS severity, source || '::' || doc_id AS chunk_id, CAST({_N} AS VARCHAR) AS token_count FROM documents WHERE {_N} < 100 OR {_N} > 3000")
def _(spark, d):
    return _plain(checks.size_outliers(as_chunks(docs(spark, d))), "token_count")


def texts(spark, d, made) -> DataFrame:
    return docs(spark, d).select(F.concat_ws("::", "source", F.col("doc_id").cast("string")).alias("chunk_id"), made(F.coalesce("text", F.lit(""))).alias("text"))


@query("qa_orphaned", _rows(_NUMBERED) + r""", first AS (
  SELECT doc_id, trim(arg_min(x, i)) AS x FROM (SELECT *, row_number() OVER () FROM rows) r WHERE trim(x) <> '' GROUP BY 1
) SELECT source || '::' || doc_id AS chunk_id, regexp_extract(x, '^\((\d+)\)\s', 1) AS first_step FROM first JOIN documents USING (doc_id) WHERE regexp_matches(x, '^\((\d+)\)\s') AND regexp_extract(x, '^\((\d+)\)\s', 1) <> '1'""")
def _(spark, d):
    return _plain(checks.orphaned_steps(texts(spark, d, numbered), MANUAL), "first_step").select("chunk_id", "first_step")


#: Texts in capitals but for every other document, so that some callouts govern nothing.
@query("qa_callouts", r"""
WITH a AS (SELECT source || '::' || doc_id AS chunk_id, string_split(trim(CASE WHEN doc_id % 3 = 0 THEN 'a note: ' ELSE 'WARNING: ' END || CASE WHEN doc_id % 2 = 0 THEN coalesce(text, '') ELSE upper(regexp_replace(coalesce(text, ''), '[^\x0A\x20A-Za-z]', '', 'g')) END, ' ' || chr(10) || chr(9) || chr(13)), chr(10)) AS l FROM documents),
c AS (SELECT *, list_filter(list_transform(l[2:], lambda x: trim(x)), lambda x: regexp_matches(x, '^(\(\d+\)|[a-z]\.)\s') OR (x <> '' AND NOT regexp_matches(x, '^WARNING|note:') AND NOT (upper(x) = x AND lower(x) <> x) AND len(regexp_extract_all(x, '\S+')) > 3)) AS g FROM a)
SELECT chunk_id, CASE WHEN l[1] LIKE 'WARNING%' THEN 'error' ELSE 'warning' END AS severity, CASE WHEN l[1] LIKE 'WARNING%' THEN 'warning' ELSE 'note' END AS callout_level FROM c WHERE len(g) = 0""")
def _(spark, d):
    body = F.when(F.col("doc_id") % 2 == 0, F.coalesce("text", F.lit(""))).otherwise(F.upper(F.regexp_replace(F.coalesce("text", F.lit("")), r"[^\x0A\x20A-Za-z]", "")))
    c = texts(spark, d, lambda t: F.concat(F.when(F.col("doc_id") % 3 == 0, "a note: ").otherwise("WARNING: "), body))
    return _plain(checks.split_callouts(c, MANUAL), "callout_level").select("chunk_id", "severity", "callout_level")


@query("qa_metadata", "SELECT source || '::' || doc_id AS chunk_id, unnest(list_concat(CASE WHEN doc_id % 3 = 0 THEN ['level1_id'] ELSE [] END, CASE WHEN doc_id % 5 = 0 THEN ['content_type'] ELSE [] END)) AS field FROM documents")
def _(spark, d):
    keys = F.filter(F.array(F.lit("manual_id"), F.when(F.col("doc_id") % 3 != 0, "level1_id"), F.when(F.col("doc_id") % 5 != 0, "content_type")), lambda k: k.isNotNull())
    raw = F.map_from_arrays(keys, F.transform(keys, lambda k: F.when(k != "level1_id", k)))  # a null counts as present
    c = docs(spark, d).select(F.concat_ws("::", "source", F.col("doc_id").cast("string")).alias("chunk_id"), raw.alias("raw"))
    return _plain(checks.missing_metadata(c), "field").select("chunk_id", "field")


#: Texts with the same set and number of tokens are a class, named by its first document.
_DUP = """
WITH t AS (SELECT doc_id, {m} AS m, len(regexp_extract_all(text, '\\S+')) AS n, list_sort(list_distinct(regexp_extract_all(text, '\\S+'))) AS s FROM documents),
c AS (SELECT *, min(doc_id) OVER (PARTITION BY m, n, s) AS rep FROM t WHERE n > 0), f AS (SELECT * FROM c WHERE doc_id = rep)
SELECT a.doc_id AS a, b.doc_id AS b, round(len(list_intersect(a.s, b.s)) / (len(a.s) + len(b.s) - len(list_intersect(a.s, b.s))), 6) AS similarity
FROM f a JOIN f b ON a.m = b.m AND a.doc_id < b.doc_id AND least(a.n, b.n) >= 0.95 * greatest(a.n, b.n) AND least(len(a.s), len(b.s)) >= 0.95 * greatest(len(a.s), len(b.s))
WHERE len(list_intersect(a.s, b.s)) / (len(a.s) + len(b.s) - len(list_intersect(a.s, b.s))) >= 0.95
UNION ALL SELECT rep, doc_id, 1.0 FROM c WHERE doc_id <> rep"""


def _pairs(spark, d, whole):
    c = as_chunks(docs(spark, d))
    c = c.withColumn("manual_id", F.lit("all")) if whole else c
    return checks.duplicate_pairs(c).select(F.col("oa").alias("a"), F.col("ob").alias("b"), F.round("sim", 6).alias("similarity"))


@query("qa_duplicates", _DUP.format(m="source"))
def _(spark, d):
    return _pairs(spark, d, False)


@query("qa_duplicates_whole", _DUP.format(m="'all'"))
def _(spark, d):
    return _pairs(spark, d, True)


#: Chunks are named by their first word too; a line "word. " elsewhere also resolves a reference to the word.
@query("qa_xref", r"""
WITH c AS (SELECT source AS m, source || '::' || coalesce(nullif(regexp_extract(text, '^([\p{L}\p{N}_]+)', 1), ''), 'x') || '::' || doc_id AS id, text FROM documents),
refs AS (SELECT m, id, unnest(list_distinct(list_transform(regexp_extract_all(text, '(?:^|[^\p{L}\p{N}_])(?:the|le|el|und) ([\p{L}\p{N}_]+)\.', 1), lambda x: m || '::' || x))) AS ref FROM c),
asked AS (SELECT DISTINCT ref FROM refs),
begun AS (SELECT ref FROM asked WHERE EXISTS (SELECT 1 FROM c WHERE starts_with(c.id, asked.ref))),
segs AS (SELECT DISTINCT unnest(string_split(id, '::')[2:]) AS seg FROM c),
l AS (SELECT id, string_split(text, chr(10)) AS l FROM c),
heads AS (SELECT DISTINCT id, regexp_extract(x || CASE WHEN i < n THEN chr(10) ELSE '' END, '^([\p{L}\p{N}_]+)\.\s', 1) AS seg FROM (SELECT id, generate_subscripts(l, 1) AS i, len(l) AS n, unnest(l) AS x FROM l))
SELECT id AS chunk_id, ref AS target, CASE WHEN skipped THEN 'warning' ELSE 'error' END AS severity, CAST(skipped AS VARCHAR) AS skipped
FROM (SELECT *, starts_with(ref, m || '::th') AS skipped FROM refs) r
WHERE ref NOT IN (SELECT ref FROM begun) AND split_part(ref, '::', 2) NOT IN (SELECT seg FROM segs)
  AND NOT EXISTS (SELECT 1 FROM heads h WHERE h.seg = split_part(r.ref, '::', 2) AND h.id <> r.id)""")
def _(spark, d):
    from dataclasses import replace

    first = F.regexp_extract("text", r"^([\p{L}\p{N}_]+)", 1)
    c = docs(spark, d).withColumn("first", F.when(first != "", first).otherwise("x"))
    p = replace(PROSE, cross_reference_patterns=(r"\b(?:the|le|el|und) (\w+)\.",), skip_sections=("th",))
    meta = F.struct(chunks.references(F.col("text"), F.col("source"), p)["cross_references"].alias("cross_references"))
    c = c.select(F.col("source").alias("manual_id"), F.concat_ws("::", "source", "first", F.col("doc_id").cast("string")).alias("chunk_id"), "text", meta.alias("metadata"))
    return _plain(checks.broken_references(c, p), "target", "skipped").select("chunk_id", "target", "severity", "skipped")


@query("qa_profile", "SELECT source || '::' || doc_id AS chunk_id, lang AS level1_id FROM documents WHERE lang NOT IN ('The', 'A', 'Of') AND lang <> ''")
def _(spark, d):
    return _plain(checks.unknown_sections(as_chunks(docs(spark, d)), PROSE), "level1_id").select("chunk_id", "level1_id")


#: The checks that the prose's profile leaves something to find, on the flow's chunks: size, near-duplicates in a manual, references and sections.
_ISSUES = _FLOW + r""", toks AS (SELECT m, ord, id, len(regexp_extract_all(text, '\S+')) AS n, list_sort(list_distinct(regexp_extract_all(text, '\S+'))) AS s FROM chunks),
cls AS (SELECT *, min(ord) OVER (PARTITION BY m, n, s) AS rep FROM toks WHERE n > 0), rep AS (SELECT * FROM cls WHERE ord = rep),
twins AS (
  SELECT a.m, a.id AS a, b.id AS b FROM rep a JOIN rep b ON a.m = b.m AND a.ord < b.ord AND least(a.n, b.n) >= 0.95 * greatest(a.n, b.n) AND least(len(a.s), len(b.s)) >= 0.95 * greatest(len(a.s), len(b.s))
  WHERE len(list_intersect(a.s, b.s)) / (len(a.s) + len(b.s) - len(list_intersect(a.s, b.s))) >= 0.95
  UNION SELECT c.m, r.id, c.id FROM cls c JOIN rep r ON r.m = c.m AND r.ord = c.rep WHERE c.ord <> c.rep
), refs AS (SELECT m, id, unnest(refs) AS ref FROM chunks),
begun AS (SELECT ref FROM (SELECT DISTINCT ref FROM refs) q WHERE EXISTS (SELECT 1 FROM chunks c WHERE starts_with(c.id, q.ref))),
segs AS (SELECT DISTINCT unnest(string_split(id, '::')[2:]) AS seg FROM chunks),
tl AS (SELECT id, string_split(text, chr(10)) AS l FROM chunks),
heads AS (SELECT DISTINCT id, regexp_extract(x || CASE WHEN i < n THEN chr(10) ELSE '' END, '^([\p{L}\p{N}_]+)\.\s', 1) AS seg FROM (SELECT id, generate_subscripts(l, 1) AS i, len(l) AS n, unnest(l) AS x FROM tl)),
issues AS (
  SELECT 'size_outliers' AS "check", 'warning' AS severity, id AS chunk_id, CAST(n AS VARCHAR) AS detail FROM toks WHERE n < 100 OR n > 3000
  UNION ALL SELECT 'duplicate_content', 'warning', a, b FROM twins
  UNION ALL SELECT 'cross_ref_validity', 'error', id, ref FROM refs r WHERE ref NOT IN (SELECT ref FROM begun) AND split_part(ref, '::', 2) NOT IN (SELECT seg FROM segs) AND NOT EXISTS (SELECT 1 FROM heads h WHERE h.seg = split_part(r.ref, '::', 2) AND h.id <> r.id)
  UNION ALL SELECT 'profile_validation', 'warning', id, l1 FROM chunks WHERE l1 NOT IN ('The', 'A', 'Of') AND l1 <> ''
)"""


@query("qa_report", _ISSUES + ' SELECT "check", severity, chunk_id, detail FROM issues')
def _(spark, d):
    """Every issue with what it is about."""
    found = checks.suite(flow(spark, d), PROSE)
    detail = F.coalesce(*[F.col("details")[k] for k in ("token_count", "duplicate_of", "target", "field", "level1_id")])
    return found.select("check", "severity", "chunk_id", detail.alias("detail"))


_CHECKS = ", ".join(f"('{c}')" for c in checks.CHECKS)


@query("qa_summary", _ISSUES + f""", known AS (SELECT * FROM (VALUES {_CHECKS}) t("check")), counts AS (
  SELECT "check", count(*) FILTER (severity = 'error') AS errors, count(*) FILTER (severity = 'warning') AS warnings FROM known LEFT JOIN issues USING ("check") GROUP BY 1
) SELECT *, sum(errors) OVER () = 0 AS passed FROM counts""")
def _(spark, d):
    return checks.summary(checks.suite(flow(spark, d), PROSE))


@query("issue_counts", _ISSUES + ' SELECT "check", severity, count(*) AS n FROM issues GROUP BY 1, 2')
def _(spark, d):
    return analytics.issue_counts(checks.suite(flow(spark, d), PROSE))


@query("metadata_coverage", _FLOW + """ SELECT count(*) AS chunks, count(*) FILTER (m <> '') AS manual_id, count(*) FILTER (l1 <> '') AS level1_id, count(*) FILTER (kind <> '') AS content_type, count(*) FILTER (title <> '') AS procedure_name,
  CAST(0 AS BIGINT) AS has_safety_callouts, CAST(0 AS BIGINT) AS figure_references, count(*) FILTER (len(refs) > 0) AS cross_references FROM chunks""")
def _(spark, d):
    return analytics.metadata_coverage(flow(spark, d))


# figures

@query("profile_pages", _PAGES + r""" SELECT manual_id, count(*) AS pages, count(*) FILTER (length(trim(text)) = 0) AS empty_pages, CAST(sum(length(text)) AS BIGINT) AS chars,
  round(sum(length(regexp_replace(text, '[^\x20-\x7E\n\t]', '', 'g'))) / sum(length(text)), 6) AS printable, round(avg(length(text)), 6) AS avg_chars, count(*) FILTER (length(trim(text)) < 50) AS under_50, count(*) FILTER (length(trim(text)) < 200) AS under_200
  FROM pages_m GROUP BY 1""")
def _(spark, d):
    return analytics.page_profile(pages(spark, d))


@query("top_words", r"""
WITH w AS (SELECT unnest(regexp_extract_all(lower(text), '\S+')) AS word FROM documents)
SELECT word, count(*) AS n FROM w WHERE regexp_matches(word, '^\p{L}{4,}$') GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 30""")
def _(spark, d):
    return analytics.top_words(docs(spark, d))


@query("char_classes", r"""
WITH c AS (SELECT sum(length(regexp_replace(text, '\P{L}', '', 'g'))) AS alpha, sum(length(regexp_replace(text, '\P{Nd}', '', 'g'))) AS digit, sum(length(regexp_replace(text, '[^\x20\x09-\x0D]', '', 'g'))) AS space, sum(length(text)) AS n FROM documents)
SELECT CAST(alpha AS BIGINT) AS alpha, CAST(digit AS BIGINT) AS digit, CAST(space AS BIGINT) AS space, CAST(n - alpha - digit - space AS BIGINT) AS other FROM c""")
def _(spark, d):
    return analytics.char_classes(docs(spark, d))


@query("marker_counts", "WITH l AS (SELECT unnest(string_split(html, chr(10))) AS x FROM pages) SELECT " + ", ".join(f"count(*) FILTER (regexp_matches(x, '{p}')) AS \"{k}\"" for k, p in analytics.MARKERS.items()) + " FROM l")
def _(spark, d):
    return analytics.marker_counts(read(spark, d, "pages").select(F.col("html").alias("text")))


@query("level1_frequency", _B + " SELECT id, count(*) AS n FROM bounds WHERE level = 1 GROUP BY 1")
def _(spark, d):
    return analytics.level1_frequency(found(spark, d)[1])


@query("size_extremes", f"""
WITH t AS (SELECT source || '::' || doc_id AS chunk_id, {_N} AS n FROM documents),
r AS (SELECT *, row_number() OVER (ORDER BY n, chunk_id) AS a, row_number() OVER (ORDER BY n DESC, chunk_id) AS b FROM t)
SELECT 'smallest' AS kind, chunk_id, n FROM r WHERE a <= 5 UNION ALL SELECT 'largest', chunk_id, n FROM r WHERE b <= 5""")
def _(spark, d):
    return analytics.size_extremes(as_chunks(docs(spark, d)))


@query("doc_indicators", "SELECT source AS manual_id, " + ", ".join(f"bool_or(regexp_matches(lower(text), '{'|'.join(ws)}')) AS {k}" for k, ws in analytics.INDICATORS.items()) + " FROM documents GROUP BY 1")
def _(spark, d):
    return analytics.indicators(pages(spark, d))
