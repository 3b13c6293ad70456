"""Connected components of a table of edges by alternating large and small stars.

Each round is two aggregations and joins over the edges, written to the shared folder; the number of rounds
grows with the logarithm of the number of vertices. No edges come to the driver. Large stars send
only smaller neighbours on, so a hub's edges are spread over its neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Both stars point vertices at the least vertex m around u. Large: u's larger neighbours.
    Small: u and its smaller neighbours."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = both.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b), in any order and with repeats -> (vertex, root): for each vertex that has an
    edge to another, the least vertex of its component. No edges: no rows."""
    edges = written(edges.where("a <> b").select("a", "b").distinct(), "edges")
    before = None
    while True:
        edges = written(_star(_star(edges, True), False), "stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("vertex"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("vertex"), F.col("b").alias("root")).distinct())
        before = now
