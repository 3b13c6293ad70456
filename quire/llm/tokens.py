"""Token counts: batch encoding in Arrow functions that return lengths only.

Texts of an Arrow batch are gathered into batches of about RUN_BYTES, whatever rows they come in, so that a batch of long texts is no larger
than one of short texts, and each is given to the library as a whole; long texts are split where no token
reaches across (see ``bpe.parts``, and ``SPACED`` for sentencepiece). Kinds of files: ``.json`` for tokenizers, ``.model`` for sentencepiece.

Defined results. Null text: 0 bytes and 0 tokens. Strings of special tokens in a text count as the
library counts them by default. Repeated rows and null ids are rows like any other. An empty table
gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.bpe import PART, Encoder, default_path, encoder
from quire.llm.common import documents, text_of

LIMIT = 1024
RUN_BYTES = 4_000_000


class Pieces:
    """Lengths by sentencepiece."""

    #: A single space between such characters begins the next word's first piece, as does the start of a text.
    SPACED = re.compile("(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def parts(self, text: str, size: int = PART) -> Iterator[str]:
        start = 0
        while len(text) - start > size and (m := self.SPACED.search(text, start + size)):
            yield text[start : m.start()]
            start = m.end()
        yield text[start:]

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.model.encode(texts, num_threads=1)]


def counter(path: str) -> Pieces | Encoder:
    return Pieces(path) if path.endswith(".model") else encoder(path)


def lengths(texts: Iterable[str], of: Pieces | Encoder, size: int = RUN_BYTES) -> np.ndarray:
    """The number of tokens of each text, encoded in batches of about size bytes."""
    n: list[int] = []
    rows, held, held_bytes = [], [], 0

    def encode() -> None:
        for row, k in zip(rows, of.lengths(held), strict=True):
            n[row] += k

    for row, text in enumerate(texts):
        n.append(0)
        for part in of.parts(text):
            rows.append(row)
            held.append(part)
            held_bytes += len(part) if part.isascii() else len(part.encode())
            if held_bytes >= size:
                encode()
                rows, held, held_bytes = [], [], 0
    encode()
    return np.array(n, np.int64)


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit."""
    path = path or default_path()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = counter(path)
        for batch in batches:
            n = lengths((t.as_py() for t in batch.column("t")), of)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(n)], ["doc_id", "n_bytes", "n_tokens"])

    text = text_of(docs)
    rows = docs.select(docs["doc_id"].alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("t"))
    schema = rows.select("doc_id", "n_bytes").schema.add("n_tokens", "long")
    return rows.mapInArrow(count, schema).withColumn("over_limit", F.col("n_tokens") > limit)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))
