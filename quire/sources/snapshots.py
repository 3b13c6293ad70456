"""Tables of a folder that change as a whole: versions of their data, and numbered snapshots that tell which versions count.

Data are written to a folder of their own for each change, never over what a snapshot names. The snapshot comes last, by renaming a file to the next
number, which fails if somebody else took that number first. So readers see all of a change or nothing of it, and one that was stopped
leaves only data that no snapshot names; ``vacuum`` removes those. A snapshot has a line for each version of a table, and of a table in buckets for
each bucket, so its size is bounded by buckets and changes, not by rows.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from quire.sources.storage import exists, file_system, remove


def _numbers(spark: SparkSession, path: str) -> list[int]:
    at = f"{path}/snapshots"
    if not exists(spark, at):
        return []
    p, fs = file_system(spark, at)
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != ".")


def latest(spark: SparkSession, path: str) -> tuple[int, dict]:
    """The newest snapshot and its number; number 0 and an empty one if there is none. A snapshot: name -> parts, each a folder."""
    numbers = _numbers(spark, path)
    if not numbers:
        return 0, {}
    return numbers[-1], json.loads(spark.read.text(f"{path}/snapshots/{numbers[-1]:08d}.json", wholetext=True).first()[0])


def publish(spark: SparkSession, path: str, after: int, snapshot: dict) -> None:
    """Makes snapshot the newest one, if the newest is still that numbered after."""
    p, fs = file_system(spark, f"{path}/snapshots/.{uuid.uuid4().hex}")
    out = fs.create(p, False)
    out.write(bytearray(json.dumps(snapshot).encode()))
    out.close()
    to, _ = file_system(spark, f"{path}/snapshots/{after + 1:08d}.json")
    if fs.exists(to) or not fs.rename(p, to):
        fs.delete(p, False)
        raise RuntimeError(f"{path} was changed meanwhile")


def new_folder(path: str) -> str:
    return f"{path}/data/{uuid.uuid4().hex}"


def opened(spark: SparkSession, path: str, name: str) -> DataFrame | None:
    """A table as of the newest snapshot; without one, the plain table of that name; none if there is neither."""
    _, snapshot = latest(spark, path)
    if name in snapshot:
        return parts(spark, snapshot[name])
    return spark.read.parquet(f"{path}/{name}") if exists(spark, f"{path}/{name}") else None


def parts(spark: SparkSession, folders: dict[str, str] | list[str]) -> DataFrame:
    return spark.read.parquet(*(folders.values() if isinstance(folders, dict) else folders))


def vacuum(spark: SparkSession, path: str) -> int:
    """Removes data that the newest snapshot doesn't name, and older snapshots; gives how many folders went. Not while somebody reads or
    changes the tables."""
    number, snapshot = latest(spark, path)
    named = {f for of in snapshot.values() if not isinstance(of, int) for f in (of.values() if isinstance(of, dict) else of)}
    for n in _numbers(spark, path):
        if n != number:
            remove(spark, f"{path}/snapshots/{n:08d}.json")
    gone = 0
    if exists(spark, f"{path}/data"):
        p, fs = file_system(spark, f"{path}/data")
        for version in fs.listStatus(p):
            at = f"{path}/data/{version.getPath().getName()}"
            for table in fs.listStatus(version.getPath()):
                # a table in buckets has a folder for each, one of rows alone is a folder itself
                inner = [s.getPath().getName() for s in fs.listStatus(table.getPath()) if s.getPath().getName().startswith("bucket=")]
                for folder in [f"{at}/{table.getPath().getName()}/{b}" for b in inner] or [f"{at}/{table.getPath().getName()}"]:
                    if folder not in named:
                        remove(spark, folder)
                        gone += 1
    return gone
