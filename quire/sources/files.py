"""A sink that makes one file for each name, from ordered parts.

Each task writes the files of its rows beside their folder, under a name of its own attempt. Only when all tasks have ended are the files of the
attempts that count put in their place, and what else was written goes: a task that is tried again, or a speculative copy of it, leaves no second
copy, and a write that fails leaves the folder as it was. Paths are those that pyarrow's file systems know; executors need to see the folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "quire_files"


def file_name(name: str | None) -> str:
    """A file's name for any text; no text is spelled like null's."""
    return "%null" if name is None else quote(name, safe=" ()+,=@~") or "%empty"


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    system, at = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return system, at.rstrip("/")


@dataclass
class Written(WriterCommitMessage):
    folder: str
    files: list[str]


class Writer(DataSourceArrowWriter):
    def __init__(self, path: str, suffix: str, overwrite: bool) -> None:
        self.path, self.suffix, self.overwrite = path, suffix, overwrite
        self.staging = f"_staging-{uuid.uuid4().hex}"

    def place(self) -> tuple[fs.FileSystem, str, str]:
        """The file system, the folder and the staging folder as it names them."""
        system, at = file_system(self.path)
        return system, at, f"{at}/{self.staging}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """Rows (name, part), those of a name one after another."""
        system, _, staging = self.place()
        folder, files, out, at = f"{staging}/{uuid.uuid4().hex}", [], None, None
        for batch in iterator:
            for name, part in zip(batch.column("name").to_pylist(), batch.column("part").to_pylist(), strict=True):
                if out is None or name != at:
                    if out is not None:
                        out.close()
                    at = name
                    files.append(file_name(name) + self.suffix)
                    system.create_dir(folder, recursive=True)
                    out = system.open_output_stream(f"{folder}/{files[-1]}")
                out.write((part or "").encode())
        if out is not None:
            out.close()
        return Written(folder, files)

    def commit(self, messages: list[Written | None]) -> None:
        system, at, staging = self.place()
        system.create_dir(at, recursive=True)
        made = {f for m in messages if m for f in m.files}
        for m in messages:
            for f in m.files if m else ():
                system.move(f"{m.folder}/{f}", f"{at}/{f}")
        if self.overwrite:
            for info in system.get_file_info(fs.FileSelector(at)):
                if info.type == fs.FileType.File and info.base_name.endswith(self.suffix) and info.base_name not in made:
                    system.delete_file(info.path)
        self._clear(system, staging)

    def abort(self, messages: list[Written | None]) -> None:
        system, _, staging = self.place()
        self._clear(system, staging)

    def _clear(self, system: fs.FileSystem, staging: str) -> None:
        if system.get_file_info(staging).type == fs.FileType.Directory:
            system.delete_dir(staging)


class Files(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "name string, part string"

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        return Writer(self.options["path"], self.options.get("suffix", ""), overwrite and self.options.get("replace") == "true")


def save(rows: DataFrame, name: Column, order: list[Column], part: Column, path: str, suffix: str, replace: bool = True) -> None:
    """A file for each name in a folder, of its rows' parts in order. A name's rows pass one task, as a stream. replace: other files of the
    folder with that suffix go."""
    rows.sparkSession.dataSource.register(Files)
    keyed = rows.select(name.alias("name"), part.alias("part"), *[c.alias(f"_o{i}") for i, c in enumerate(order)])
    ordered = keyed.repartition("name").sortWithinPartitions("name", *[f"_o{i}" for i in range(len(order))])
    ordered.select("name", "part").write.format(FORMAT).option("suffix", suffix).option("replace", str(replace).lower()).mode("overwrite").save(path)


def document(items: DataFrame, keys: list[str], order: str, head: Column, item: Column, tail: str) -> tuple[DataFrame, list[Column], Column]:
    """What ``save`` needs for documents that list items: a head, items with commas between them, and a tail for each of keys."""
    rows = items.select(*keys, F.col(order).alias("_at"), head.alias("_head"), item.alias("_item"))
    ends = rows.groupBy(*keys).agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"))
    ends = ends.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_first", "_last")
    both = rows.join(ends, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]))
    part = F.concat(F.when(F.col("_at") == F.col("_first"), F.col("_head")).otherwise(F.lit(",\n")), F.col("_item"), F.when(F.col("_at") == F.col("_last"), F.lit(tail)).otherwise(F.lit("")))
    return both, [F.col("_at")], part
