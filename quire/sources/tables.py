"""Sources and sinks: pages, chunks and manifests."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.sources import files
from quire.sources.storage import written


def _inner(ddl: str) -> str:
    """Columns as the fields of a struct."""
    return re.sub(r"(\w) (string|int|array|struct)", r"\1: \2", ddl)


METADATA = (
    "manual_id string, level1_id string, procedure_name string, hierarchical_header string, hierarchy_path array<string>, content_type string, "
    "page_range struct<start: string, end: string>, vehicle_models array<string>, engine_applicability array<string>, drivetrain_applicability array<string>, "
    "has_safety_callouts array<string>, figure_references array<string>, cross_references array<string>"
)
CHUNK = f"chunk_id string, manual_id string, text string, metadata struct<{_inner(METADATA)}>"
ENTRY = (
    "chunk_id string, level int, level_name string, title string, hierarchy_path array<string>, content_type string, page_range struct<start: string, end: string>, "
    "line_range struct<start: bigint, end: bigint>, vehicle_applicability array<string>, engine_applicability array<string>, drivetrain_applicability array<string>, "
    "has_safety_callouts array<string>, figure_references array<string>, cross_references array<string>, parent_chunk_id string, children array<string>"
)


def document_pages(docs: DataFrame) -> DataFrame:
    """documents as pages: a source is a manual, its documents are pages in order of doc_id. They are ranked inside slices of doc_id and
    over slices, so that a source of very many documents is no single task's. Texts are dealt out once, by slices; how many pages are before a slice is a
    written table of a row a slice. Column slice tells pages of a slice, which are together and in its order."""
    docs = docs.select("source", F.floor(F.col("doc_id") / 4096).alias("_slice"), "doc_id", "text")
    counts = docs.groupBy(F.col("source").alias("_source"), F.col("_slice").alias("_s")).agg(F.count(F.lit(1)).alias("_n"))
    counts = written(counts.withColumn("_before", F.sum("_n").over(Window.partitionBy("_source").orderBy("_s")) - F.col("_n")), "slices")
    order = Window.partitionBy("source", "_slice").orderBy("doc_id")
    ranked = docs.select("source", "_slice", F.row_number().over(order).alias("_r"), "text")
    joined = ranked.join(counts, ranked["source"].eqNullSafe(counts["_source"]) & ranked["_slice"].eqNullSafe(counts["_s"]))
    return joined.select(F.col("source").alias("manual_id"), (F.col("_before") + F.col("_r") - 1).cast("int").alias("page_number"), "text", F.col("_slice").alias("slice"))


def pdf_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages of PDF files; the executors need pypdf."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io

        from pypdf import PdfReader

        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                texts = [p.extract_text() or "" for p in PdfReader(io.BytesIO(content)).pages]
                yield pd.DataFrame({"manual_id": name.rsplit("/", 1)[-1].removesuffix(".pdf"), "page_number": range(len(texts)), "text": texts})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(read, "manual_id string, page_number int, text string")


def save_chunks(chunks: DataFrame, path: str, suffix: str = ".jsonl", replace: bool = True) -> None:
    """A file for each manual in a folder, named by it: one JSON object a line, in order."""
    line = F.concat(F.to_json(F.struct("chunk_id", "manual_id", "text", "metadata"), {"ignoreNullFields": "false"}), F.lit("\n"))
    files.save(chunks, chunks["manual_id"], [chunks["chunk_ord"]], line, path, suffix, replace)


def load_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Chunks of JSON lines, blank lines skipped, with their order, and the raw metadata as a map
    (raw) that tells a missing key from a null. A line that is no JSON object, or lacks a key of a chunk, fails the job."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    # Spark reads files in any order: chunks are ordered by file, place in it, and row
    lines = lines.withColumn("chunk_ord", F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row")))
    wanted = F.array(*map(F.lit, ("chunk_id", "manual_id", "text", "metadata")))
    lacking = F.array_except(wanted, F.coalesce(F.json_object_keys("value"), F.array().cast("array<string>")))
    message = F.concat(F.lit("a chunk lacks "), F.array_join(lacking, ", "))
    lines = lines.withColumn("value", F.when(F.size(lacking) == 0, F.col("value")).otherwise(F.raise_error(message)))
    parsed = F.from_json("value", CHUNK, {"mode": "FAILFAST"})
    raw = F.from_json(F.get_json_object("value", "$.metadata"), "map<string, string>")
    return lines.select(parsed.alias("c"), raw.alias("raw"), "chunk_ord").select("c.*", "raw", "chunk_ord")


def save_manifest(manifest: DataFrame, path: str, suffix: str = ".json") -> None:
    """A JSON document for each manual in a folder, named by it, with an entry a line."""
    names = [f.strip().split(" ")[0] for f in ("chunk_id, level, level_name, title, hierarchy_path, content_type, page_range, line_range, vehicle_applicability, engine_applicability, drivetrain_applicability, has_safety_callouts, figure_references, cross_references, parent_chunk_id, children").split(",")]
    none = F.array().cast("array<string>")
    full = manifest.withColumns({n: none for n in names if n not in manifest.columns})
    entry = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    head = F.concat(F.lit('{"manual_id": '), F.coalesce(F.regexp_replace(F.to_json(F.array("manual_id")), r"^\[|\]$", ""), F.lit("null")), F.lit(', "entries": [\n'))
    rows, order, part = files.document(full, ["manual_id"], "entry_idx", head, entry, "\n]}\n")
    files.save(rows, F.col("manual_id"), order, part, path, suffix)


def load_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Entries of manifest documents: each file is one."""
    struct = f"struct<{_inner(ENTRY)}>"
    docs = spark.read.text(path, wholetext=True).select(F.from_json("value", f"manual_id string, entries array<{struct}>", {"mode": "FAILFAST"}).alias("m"))
    return docs.select("m.manual_id", F.posexplode("m.entries").alias("entry_idx", "e")).select("manual_id", "entry_idx", "e.*")


def create_vectors(spark: SparkSession, path: str, size: int = 768) -> DataFrame:
    """An empty table of vectors of that size; a payload is a JSON object."""
    spark.createDataFrame([], "point_id string, vector array<float>, payload string").write.mode("ignore").option("vector_size", size).parquet(path)
    return spark.read.parquet(path)


def checked_size(vector: Column, size: int) -> Column:
    return F.when(F.size(vector) == size, vector).otherwise(F.raise_error(F.lit(f"a vector is not of size {size}")))
