"""What the operators share: tables in the cluster's shared folder, checked broadcasts, row keys.

A row of ``documents`` is identified by its doc_id, the xxhash64 and the length of its text, and the xxhash64 of its other
columns, so that rows with one key are alike in every column, and it is no matter which of them a decision takes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.sources.storage import remove, shared_dir, written, written_at

#: The most rows, and bytes of their strings, that a join may broadcast; beyond it both sides are shuffled.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 100_000_000

#: Columns that every result of a filtering stage carries.
DOCUMENT_KEY = ("__doc_id", "__text_hash", "__text_len", "__row_hash")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fits(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether df (a table that was written before, so counting is cheap) has at most that many rows, and strings of no more than BROADCAST_BYTES."""
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in df.dtypes if kind in ("string", "binary")]
    n, size = df.limit(rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(sum(texts, F.lit(0).cast("long"))), F.lit(0))).first()
    return n <= rows and size <= BROADCAST_BYTES


def checked_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it is proven small; else as it is, and the join shuffles."""
    return F.broadcast(df) if fits(df, rows) else df


def text_of(df: DataFrame, column: str = "text") -> Column:
    return F.coalesce(df[column].cast("string"), F.lit(""))


def columns(docs: DataFrame) -> list[Column]:
    """All columns of docs, whatever their names."""
    return [docs["`" + c.replace("`", "``") + "`"] for c in docs.columns]


def key_columns(docs: DataFrame) -> list[Column]:
    """The columns of DOCUMENT_KEY."""
    text = text_of(docs)
    others = [(c, f) for c, f in zip(columns(docs), docs.schema, strict=True) if f.name not in ("doc_id", "text")]
    plain = [F.to_json(F.struct(c)) if "map<" in f.dataType.simpleString() else c for c, f in others]
    nulls = F.concat(F.lit(""), *[F.when(c.isNull(), "0").otherwise("1") for c, _ in others])
    return [c.alias(n) for n, c in zip(DOCUMENT_KEY, (docs["doc_id"], F.xxhash64(text), F.length(text), F.xxhash64(nulls, *plain)), strict=True)]


def keyed(docs: DataFrame) -> DataFrame:
    """DOCUMENT_KEY and row, a struct of all columns of docs, so that none of their names matters."""
    return docs.select(F.struct(*columns(docs)).alias("row"), *key_columns(docs))


def same_key(a: DataFrame, b: DataFrame) -> Column:
    """A null doc_id equals another null."""
    out = None
    for c in DOCUMENT_KEY:
        out = a[c].eqNullSafe(b[c]) if out is None else out & a[c].eqNullSafe(b[c])
    return out


def without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of docs whose key is not in keys (a written table). Only keys are broadcast, and only
    below BROADCAST_ROWS."""
    rows = keyed(docs)
    keys = checked_broadcast(keys)
    return rows.join(keys, same_key(rows, keys), "left_anti").select("row.*")


def kept_of(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """docs without the rows that go. keys: a written table of keys with kept, whether a row of the key stays, and n, how many rows of
    docs have it; rows of one key are alike, and one of them stays. Keys of a single row that stays needn't be there."""
    rows = keyed(docs)
    changed, several = (checked_broadcast(keys.where(c).select(*DOCUMENT_KEY)) for c in ("n > 1 or not kept", "n > 1 and kept"))
    out = rows.join(changed, same_key(rows, changed), "left_anti").select("row")
    tied = rows.join(several, same_key(rows, several), "left_semi").groupBy(*DOCUMENT_KEY).agg(F.first("row").alias("row"))
    return out.unionByName(tied.select("row")).select("row.*")
