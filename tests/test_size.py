"""Work and memory that don't grow with the rows of a batch or the uses of a column."""

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions import text
from quire.operators import analytics, index, rules, structure


def test_embedders_get_few_texts_at_once(spark):
    shape = "manual_id string, chunk_ord int, chunk_id string, text string, metadata struct<hierarchical_header: string>"
    chunks = spark.createDataFrame([("m", i, f"m::{i}", f"text {i}", ("h",)) for i in range(1000)], shape).coalesce(1)
    rows = index.vectors(chunks, lambda texts: [[float(len(texts)), float(t.split()[-1])] for t in texts]).collect()
    assert len(rows) == 1000 and max(r["vector"][0] for r in rows) <= 256
    assert all(f'"text {int(r["vector"][1])}"' in r["payload"] for r in rows)


def test_parts_leave_python_after_few_texts(spark):
    made = spark.range(1000).select("id", F.col("id").cast("string").alias("t"), F.lit("x").alias("kept"))
    out = rules.on_texts(made, "t", lambda t: [(i, t) for i in range(int(t) % 3)], T.StructType([T.StructField("place", T.IntegerType()), T.StructField("part", T.StringType())]))
    assert out.columns == ["id", "kept", "place", "part"]
    rows = {(r["id"], r["place"], r["part"]) for r in out.collect()}
    assert rows == {(i, j, str(i)) for i in range(1000) for j in range(i % 3)}
    # batches as the function gives them
    plan = out.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long")
    sizes = [r["n"] for r in plan.collect()]
    assert sum(sizes) == len(rows)


def test_texts_are_counted_once(spark):
    docs = spark.createDataFrame([("a " * n,) for n in (0, 49, 50, 3000, 5000)], "text string")
    out = analytics.size_ladder(docs)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
    assert {(r["under"], r["n"]) for r in out.collect()} == {(50, 2), (100, 1), (1 << 30, 2)}


def test_strip_is_pythons(spark):
    white = [chr(i) for i in range(0x3001) if chr(i).isspace()]
    texts = ["", *white, "".join(white), *(f"{a}x{a}y{b}{a}" for a, b in zip(white, reversed(white), strict=True)), "​x​", "é "]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", text.strip(F.col("t")).alias("s")).collect()
    assert all(r["s"] == r["t"].strip() for r in rows)


def test_pages_are_cleaned_once(spark):
    done = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def clean(t):
        done.add(1)
        return t.upper()

    pages = spark.createDataFrame([("m", i, f"a\nb {i}") for i in range(50)], "manual_id string, page_number int, text string").withColumn("text", clean("text"))
    rows = structure.numbered_pages(pages).collect()
    assert done.value == 50 and sorted(r["offset"] for r in rows) == list(range(0, 100, 2)) and rows[0]["text"].startswith("A")
