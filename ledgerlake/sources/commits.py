"""Versions of a table by commit files (SNK1).

A table is a folder of version folders and ``_commits/<number>.json``, one file per
committed version.  A commit file appears whole and only if it is absent: it is written
under a hidden name and then linked (local file systems) or renamed (HDFS, whose rename
refuses an existing target), both atomic.  So of two writers that read the same
versions one gets the next number; the other sees ``CommitConflict``, reads again and retries
or gives up.  Version folders that no commit names are never read.

A plain object store whose rename overwrites has no such step; there one writer at a time
is the rule.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

WIDTH = 10
COMPRESSION = "zstd"  # of versions and sub-ledgers, which are written whole


class CommitConflict(RuntimeError):
    """Another writer took the commit number."""


@dataclass(frozen=True)
class Commit:
    seq: int
    version: str
    path: str


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def present(spark: SparkSession, path: str) -> bool:
    target, fs = _fs(spark, path)
    return bool(fs.exists(target))


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Writes ``text`` to a new file; False if ``path`` is there already."""
    target, fs = _fs(spark, path)
    hidden, _ = _fs(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    out = fs.create(hidden, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getScheme() == "file":
            try:
                os.link(hidden.toUri().getPath(), target.toUri().getPath())
                return True
            except FileExistsError:
                return False
        return bool(fs.rename(hidden, target))
    finally:
        fs.delete(hidden, False)


def drop_files(spark: SparkSession, path: str) -> None:
    """Lets go of files of a version that was not committed."""
    target, fs = _fs(spark, path)
    fs.delete(target, True)


def commits(spark: SparkSession, root: str) -> list[Commit]:
    """Committed versions, oldest first: one small file each, read on the driver."""
    folder, fs = _fs(spark, f"{root}/_commits")
    if not fs.exists(folder):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.getPath().getName().endswith(".json"))
    found = []
    for name in names:
        stream = fs.open(_fs(spark, f"{root}/_commits/{name}")[0])
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        found.append(Commit(**json.loads(text)))
    return found


def commit(spark: SparkSession, root: str, version: str, path: str, after: int) -> Commit:
    """Commits ``path`` as the version that follows number ``after`` (-1: the first)."""
    made = Commit(after + 1, version, path)
    if not create_if_absent(spark, f"{root}/_commits/{made.seq:0{WIDTH}d}.json", json.dumps(made.__dict__)):
        raise CommitConflict(f"version number {made.seq} of {root} was committed by another writer")
    return made


def write_files(df: DataFrame, root: str, version: str, partition_by: str | None = None) -> str:
    """The files of a version, in a folder of their own; not read before they are committed."""
    path = f"{root}/v={version}/{uuid.uuid4().hex}"
    w = df.write
    (w.partitionBy(partition_by) if partition_by else w).parquet(path, compression=COMPRESSION)
    return path


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Writes the files of a version in buckets of its key and returns them as a bucketed table,
    whose joins on the key need no shuffle.  ``df`` is dealt by the key already.  The catalog
    holds the table only until it is read here; the files stay, readable by their path."""
    spark, name = df.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, *keys).option("path", path).option("compression", COMPRESSION).saveAsTable(name, format="parquet")
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # external: its files are left
    return table


def once(spark: SparkSession, root: str, write: Callable[[str], None]) -> str:
    """The path of a table that is made once: ``write(path)`` writes it if no version is
    committed yet.  Of two makers at a time one commits, and both read what it wrote."""
    done = commits(spark, root)
    if not done:
        path = f"{root}/v=1/{uuid.uuid4().hex}"
        write(path)
        try:
            return commit(spark, root, "1", path, -1).path
        except CommitConflict:
            done = commits(spark, root)
    return done[-1].path
