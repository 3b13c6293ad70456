"""Command line: process, validate, validate-chunks; bootstrap-profile and qa are not implemented."""

from __future__ import annotations

import argparse
import logging
import sys
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import cleaned_pages
from quire.operators import checks, chunks, structure
from quire.sources import profile as profiles
from quire.sources import tables
from quire.sources.storage import exists, written

log = logging.getLogger("quire")


def build_parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="quire", description="Structure, chunk and check paged manuals on Spark.")
    loud = top.add_mutually_exclusive_group()
    loud.add_argument("-v", "--verbose", action="store_true")
    loud.add_argument("-q", "--quiet", action="store_true")
    sub = top.add_subparsers(dest="command", required=True)
    for name, pages in (("process", True), ("validate", True), ("validate-chunks", False), ("qa", False)):
        p = sub.add_parser(name)
        p.add_argument("--profile", required=True)
        p.add_argument("--pages" if pages else "--chunks", required=True, help="Parquet of (manual_id, page_number, text), or PDF files" if pages else "JSON lines")
        p.add_argument("--summary-only", action="store_true")
        if name == "process":
            p.add_argument("--output-dir")
        if name == "validate":
            p.add_argument("--diagnostics", action="store_true")
    sub.add_parser("bootstrap-profile").add_argument("--pdf")
    return top


def _profile(path: str) -> profiles.Profile:
    if not Path(path).is_file():
        raise ValueError(f"there is no profile {path}")
    p = profiles.load(path)
    if wrong := profiles.validate(p):
        raise ValueError("; ".join(wrong))
    return p


def _pages(spark: SparkSession, path: str, p: profiles.Profile) -> DataFrame:
    pages = tables.pdf_pages(spark, path) if path.endswith(".pdf") else spark.read.parquet(path)
    return cleaned_pages(pages, p.cleanup).select("manual_id", "page_number", F.col("cleaned_text").alias("text"))


def report(found: DataFrame, summary_only: bool) -> bool:
    """Prints the issues and the summary; whether all passed."""
    found = written(found, "issues")
    if not summary_only:
        for row in found.orderBy("check", "chunk_id").toLocalIterator():
            print(f"[{row['severity']}] {row['check']} {row['chunk_id']}: {row['message']}")
    rows = checks.summary(found).orderBy("check").collect()  # one a check
    for r in rows:
        print(f"{r['check']:<24}{r['errors']:>8} errors{r['warnings']:>8} warnings")
    passed = all(r["passed"] for r in rows)
    print("PASSED" if passed else "FAILED")
    return passed


def run(args: argparse.Namespace, spark: SparkSession) -> int:
    if args.command in ("bootstrap-profile", "qa"):
        log.error("%s is not implemented", args.command)
        return 1
    p = _profile(args.profile)
    source = args.chunks if args.command == "validate-chunks" else args.pages
    if "*" not in source and not exists(spark, source):
        raise ValueError(f"there is no {source}")
    if args.command == "validate-chunks":
        return int(not report(checks.suite(written(tables.load_chunks(spark, args.chunks), "chunks"), p), args.summary_only))
    pages = _pages(spark, args.pages, p)
    made = written(chunks.assembled(pages, p), "chunks")
    if args.command == "process":
        if args.output_dir:
            tables.save_chunks(made, args.output_dir, "_chunks.jsonl", replace=False)
        log.info("%d chunks", made.count())
        return 0
    rows = structure.page_lines(pages)
    counts: dict[str, Observation] = {}
    bounds = written(structure.filtered(structure.detect(rows, p), rows, p, counts), "bounds")
    for name, seen in counts.items():
        log.info("boundaries after %s: %d", name, seen.get["n"])
    for row in structure.warnings(bounds, p).toLocalIterator():
        log.warning("%s", row["message"])
    if args.diagnostics:
        structure.diagnostics(bounds, rows).show(truncate=False)
    return int(not report(checks.suite(made, p), args.summary_only))


def main(argv: list[str] | None = None) -> int:
    parser = build_parser()
    if not (sys.argv[1:] if argv is None else argv):
        parser.print_help()
        return 2
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.DEBUG if args.verbose else logging.ERROR if args.quiet else logging.INFO)
    try:
        return run(args, SparkSession.builder.appName("quire").getOrCreate())
    except Exception as e:
        log.error("%s", e)
        return 1


if __name__ == "__main__":
    sys.exit(main())
