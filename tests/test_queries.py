"""Queries against their SQL in DuckDB, on the smallest tables."""

import duckdb
import pytest

from quire.plans.registry import ORACLE, QUERIES

DATA = "/root/testdata/sf0.001"
FAST = [
    "clean_literal_subs", "clean_spaced_caps", "clean_page", "cleanup_statistics", "ocr_quality", "clean_strip_headers", "clean_garbage_lines", "lines_global", "boundaries_raw", "boundaries_ambiguous", "filter_min_gap", "manifest_paths", "level1_frequency",
    "rule_r2", "rule_r3", "rule_r4", "rule_r5", "rule_r6", "rule_r7", "rule_r8", "step_sequences", "tables_detected", "safety_callouts", "merge_across_entries", "tag_applicability", "enrich_refs", "token_stats", "size_extremes", "point_ids",
    "query_analysis", "query_systems", "retrieve_enriched", "lookup_procedure", "lookup_vehicle", "lookup_figure", "lookup_cross_ref", "vector_topk", "qa_orphaned", "qa_callouts", "qa_metadata", "qa_xref", "qa_size", "qa_duplicates_whole", "marker_counts",
]


def same(v):
    return round(float(v), 6) if isinstance(v, float) or hasattr(v, "as_tuple") else v


@pytest.mark.parametrize("name", FAST)
def test_query(spark, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    found = sorted((tuple(map(same, r)) for r in df.select(*columns).collect()), key=str)
    with duckdb.connect() as c:
        for t in ("documents", "embeddings", "pages", "conversations"):
            c.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
        r = c.execute(ORACLE[name])
        at = [d[0] for d in r.description]
        expected = sorted((tuple(same(row[at.index(k)]) for k in columns) for row in r.fetchall()), key=str)
    assert sorted(at) == columns
    assert found == expected
