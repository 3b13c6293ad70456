"""Tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Spark's setting that shuffle files go when the query that made them has ended.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Tables written since the innermost ``settled`` began; None outside of any.
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where none is, as in tests, a temporary one is set if all tasks run on this
    machine; elsewhere that is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    java = spark.sparkContext._jsc.sc().getCheckpointDir()
    if java.isDefined():
        return java.get().rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quire-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def file_system(spark: SparkSession, path: str):
    """The path as Hadoop has it, and its file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    p, fs = file_system(spark, path)
    fs.delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = file_system(spark, path)
    return fs.exists(p)


def nullable(kind: T.DataType) -> T.DataType:
    """kind as it is when read from a file, with nulls allowed everywhere."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType), True, f.metadata) for f in kind])
    return T.ArrayType(nullable(kind.elementType), True) if isinstance(kind, T.ArrayType) else kind


def written(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """df as a Parquet table in the shared folder: computed once, its lineage cut, safe when
    executors are lost. Shuffle files that it took go at once, the table when the driver ends. codec: zstd for whole texts, of which it makes less."""
    return written_at(df, name, codec=codec)[0]


def written_at(df: DataFrame, name: str, by: str | None = None, codec: str = "snappy") -> tuple[DataFrame, str]:
    """df as ``written`` makes it, in a folder for each value of by, and its path."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quire-{name}-{uuid.uuid4().hex}"
    schema = nullable(df.schema)
    before = spark.conf.get(_CLEAN)
    spark.conf.set(_CLEAN, "true")
    try:
        (df.write.partitionBy(by) if by else df.write).parquet(path, compression=codec)
    finally:
        spark.conf.set(_CLEAN, before)
    p, fs = file_system(spark, path)
    fs.deleteOnExit(p)
    if (passing := _passing.get()) is not None:
        passing.append(path)
    return spark.read.schema(schema).parquet(path), path


def settled(spark: SparkSession, make: Callable[[], DataFrame], name: str, codec: str = "snappy") -> DataFrame:
    """What make gives, as ``written`` writes it. Tables that make wrote on its way go as soon as that is done, so nothing else may read them."""
    within = _passing.set([])
    try:
        out, path = written_at(make(), name, codec=codec)
        passing = [x for x in _passing.get() if x != path]
    except BaseException:
        passing = _passing.get()
        raise
    finally:
        _passing.reset(within)
        for x in passing:
            remove(spark, x)
    if (outer := _passing.get()) is not None:
        outer.append(path)
    return out
