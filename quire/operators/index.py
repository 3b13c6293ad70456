"""Embedding inputs, vectors and lookup tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions.text import first_words, point_id, strip
from quire.operators.flat import nearest
from quire.sources import snapshots
from quire.sources.storage import exists, written
from quire.sources.tables import checked_size

SIZE, WORDS = 768, 150


def embedding_input(chunks: DataFrame, n: int = WORDS) -> DataFrame:
    head, body = F.coalesce("metadata.hierarchical_header", F.lit("")), first_words(F.col("text"), n)
    return chunks.withColumn("embedding_input", F.when(strip(head) != "", F.concat(head, F.lit("\n\n"), body)).otherwise(body))


def hashed(texts: list[str], size: int = SIZE) -> list[list[float]]:
    """A deterministic embedder for use without a service: signed hashed words, of length 1."""
    import zlib

    out = np.zeros((len(texts), size), np.float32)
    for row, text in zip(out, texts, strict=True):
        for w in text.lower().split():
            h = zlib.crc32(w.encode())
            row[h % size] += 1 if h >> 31 else -1
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    return (out / np.where(norms == 0, 1, norms)).tolist()


Embedder = Callable[[list[str]], list[list[float]]]
#: Texts that an embedder is given at once: what it makes of them is lists of numbers, of many times the size of a column's.
TEXTS = 256


def embedding(embed: Embedder, text: str) -> Column:
    """A column's texts as vectors."""

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            out: list[np.ndarray] = []
            for i in range(0, len(s), TEXTS):
                out += [np.asarray(v, np.float32) for v in embed(s.iloc[i : i + TEXTS].tolist())]
            yield pd.Series(out, dtype=object)

    return run(text)


def service(url: str, model: str, timeout: float = 30, attempts: int = 3, at_once: int = 8, wait: float = 1) -> Embedder:
    """An embedder that asks an HTTP service, at_once texts at a time; server errors, timeouts and lost connections are tried again, after
    wait, then twice that, and so on. Another error ends the batch, as does an answer without an embedding."""

    def ask(text: str) -> list[float]:
        import http.client
        import json
        import time
        import urllib.error
        import urllib.request

        body = json.dumps({"model": model, "prompt": text}).encode()
        for k in range(attempts):
            try:
                request = urllib.request.Request(f"{url}/api/embeddings", body, {"Content-Type": "application/json"})
                with urllib.request.urlopen(request, timeout=timeout) as answer:
                    return json.load(answer)["embedding"]
            except urllib.error.HTTPError as e:
                if e.code < 500:
                    raise RuntimeError(f"the service refuses a text: {e.code} {e.reason}") from None
                error = e
            except (OSError, http.client.HTTPException) as e:  # no connection, one that is lost, or no answer in time
                error = e
            if k + 1 < attempts:
                time.sleep(wait * 2**k)
        raise RuntimeError(f"no embedding after {attempts} attempts: {error}") from None

    def embed(texts: list[str]) -> list[list[float]]:
        from concurrent.futures import ThreadPoolExecutor

        with ThreadPoolExecutor(max(1, min(at_once, len(texts)))) as pool:
            asked = [pool.submit(ask, t) for t in texts]
            try:
                return [a.result() for a in asked]
            except BaseException:
                pool.shutdown(cancel_futures=True)
                raise

    return embed


def resumed(embed: Embedder, folder: str, size: int = 64) -> Embedder:
    """embed in batches of size texts, each kept in a folder that all executors see: what tries a task again asks for those only that were
    not finished. A batch is known by its texts; folder belongs to one embedder."""

    def run(texts: list[str]) -> list[list[float]]:
        import hashlib
        import io
        import json
        import uuid

        from quire.sources.files import file_system

        system, at = file_system(folder)
        system.create_dir(at, recursive=True)
        out: list[list[float]] = []
        for i in range(0, len(texts), size):
            part = texts[i : i + size]
            name = f"{at}/{hashlib.sha256(json.dumps(part).encode()).hexdigest()}.npy"
            if system.get_file_info(name).is_file:
                with system.open_input_file(name) as f:
                    made = np.load(io.BytesIO(f.read()), allow_pickle=False)
            else:
                made = np.asarray(embed(part), np.float32)
                held = io.BytesIO()
                np.save(held, made)
                mine = f"{name}.{uuid.uuid4().hex}"
                with system.open_output_stream(mine) as f:
                    f.write(held.getvalue())
                system.move(mine, name)
            out += made.tolist()
        return out

    return run


def vectors(chunks: DataFrame, embed: Embedder = hashed) -> DataFrame:
    """(point_id, vector, payload): of chunks with one id the last is kept, as an upsert would."""

    last = Window.partitionBy("chunk_id").orderBy(F.desc("manual_id"), F.desc("chunk_ord"))
    df = embedding_input(chunks).withColumn("_r", F.row_number().over(last)).where("_r = 1")
    fields = [f.name for f in chunks.schema["metadata"].dataType]
    own = [F.col("manual_id")] if "manual_id" not in fields else []
    payload = F.to_json(F.struct("chunk_id", *own, "text", "metadata.*"))
    return df.select(point_id(F.col("chunk_id")).alias("point_id"), embedding(embed, "embedding_input").alias("vector"), payload.alias("payload"))


def lookups(chunks: DataFrame) -> dict[str, DataFrame]:
    """The four lookup tables."""
    each = lambda field, name: chunks.select("chunk_id", "manual_id", F.explode(f"metadata.{field}").alias(name))
    return {
        "procedure_lookup": chunks.select("chunk_id", "manual_id", "metadata.procedure_name", "metadata.level1_id"),
        "vehicle_model_lookup": each("vehicle_models", "vehicle_model"),
        "figure_lookup": each("figure_references", "figure_reference"),
        "cross_ref_lookup": each("cross_references", "cross_reference"),
    }


#: Tables of the index beside the vectors.
LOOKUPS = ("procedure_lookup", "vehicle_model_lookup", "figure_lookup", "cross_ref_lookup")
#: Buckets of point ids of a new index. What a change rewrites is the buckets of its points; a bucket is written by one task.
BUCKETS = 64


def build(chunks: DataFrame, path: str, embed: Embedder = hashed, size: int = SIZE, buckets: int = BUCKETS) -> int:
    """Adds chunks to the index in a folder: their vectors, where one with the same id is replaced, and their rows in the lookup
    tables. Gives the number of chunks. Vectors lie in buckets of their ids, of which those with new points are written anew beside the
    old ones; a snapshot then names all tables' new folders at once, so a build that stops before leaves the old index as it was."""
    spark = chunks.sparkSession
    number, old = snapshots.latest(spark, path)
    buckets = old["buckets"] if old else buckets
    bucket = F.pmod(F.xxhash64("point_id"), F.lit(buckets)).cast("int").alias("bucket")
    chunks = written(chunks, "index-chunks")
    new = written(vectors(chunks, embed).select("point_id", checked_size(F.col("vector"), size).alias("vector"), "payload", bucket), "index-vectors")
    at = snapshots.new_folder(path)
    held = dict(old.get("vectors", {}))
    touched = {str(r["bucket"]) for r in new.select("bucket").distinct().collect()}  # at most buckets
    before = [held[b] for b in touched & held.keys()]
    if old:
        kept = snapshots.parts(spark, before) if before else None
    else:  # a table from before there were snapshots
        kept = snapshots.opened(spark, path, "vectors")
        touched |= {str(r["bucket"]) for r in kept.select(bucket).distinct().collect()} if kept else set()
    merged = new if kept is None else kept.join(new, "point_id", "left_anti").select("point_id", "vector", "payload", bucket).unionByName(new)
    merged.repartition("bucket").write.partitionBy("bucket").parquet(f"{at}/vectors")
    held |= {b: f"{at}/vectors/bucket={b}" for b in touched}
    snapshot = {"buckets": buckets, "vectors": held}
    for name, rows in lookups(chunks).items():
        rows.write.parquet(f"{at}/{name}")
        earlier = old.get(name, []) if old else [f"{path}/{name}"] if exists(spark, f"{path}/{name}") else []
        snapshot[name] = [*earlier, f"{at}/{name}"]
    if held:
        snapshots.publish(spark, path, number, snapshot)
    return chunks.count()


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


__all__ = ["build", "cosine", "embedding", "embedding_input", "hashed", "lookups", "nearest", "resumed", "service", "vectors"]
