"""Our own extension: pages cleaned as they arrive. The cleaner has no state, so it runs on a stream unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.text import cleaned_pages
from quire.sources.profile import Profile


def clean_pages(pages: DataFrame, p: Profile) -> DataFrame:
    """pages (batch or stream) with the cleaner's columns."""
    return cleaned_pages(pages, p.cleanup)


def clean_stream(pages: DataFrame, p: Profile, path: str, checkpoint: str):
    """Starts a query that appends cleaned pages to a Parquet table, each once."""
    return clean_pages(pages, p).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").start()
