"""Helpers shared by the operators: stored intermediates, byte-level words,
64-bit mixing, sizes and connected components."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import shared_dir

#: Fixed odd multipliers of a 64-bit finaliser.
MIX_A, MIX_B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
S33 = np.uint64(33)


def ship(spark: SparkSession) -> None:
    """Gives executors this package, as ``--py-files`` would, once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_ledgerlake_shipped", False):
        return
    root = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp()) / "ledgerlake.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))
    sc._ledgerlake_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str, observation: Observation | None = None, *observed: Column) -> DataFrame:
    """Cuts lineage: writes ``df`` below the shared folder of the session and
    reads it back.  The files outlive lost executors and go when the driver ends."""
    spark = df.sparkSession
    ship(spark)
    if observation is not None:
        df = df.observe(observation, *observed)
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """As ``stored``, in a table bucketed by ``key``: a grouping or join by it reads the
    buckets as they are, without a shuffle."""
    spark = df.sparkSession
    ship(spark)
    table_name, path = f"{name}_{uuid.uuid4().hex}", f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").bucketBy(buckets, key).format("parquet").option("path", path).saveAsTable(table_name)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return spark.table(table_name)


def reclaim(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete the shuffles that no plan refers to any more.  It does so
    when the driver's JVM collects garbage, which may not happen for long.  The JVM learns of
    plans that Python has let go a moment later, from a thread of the gateway, so it
    collects twice."""
    for _ in range(2):
        gc.collect()
        time.sleep(1)
        spark._jvm.System.gc()


def drop_stored(*tables: DataFrame) -> None:
    """Deletes the files of tables made by ``stored`` that no plan needs any more."""
    for df in tables:
        spark = df.sparkSession
        for f in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            hadoop = spark._jvm.org.apache.hadoop.fs.Path(f)
            hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def corpus_size(df: DataFrame, text: str = "text") -> tuple[int, int]:
    """Rows and UTF-8 bytes of text, in one narrow scan."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text)).alias("b")).first()
    return r["n"], r["b"] or 0


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64 (in place on a fresh array)."""
    h = h ^ (h >> S33)
    h *= MIX_A
    h ^= h >> S33
    h *= MIX_B
    h ^= h >> S33
    return h


#: The hash that tells words apart.
word_hash = xxhash.xxh64_intdigest


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, filled on demand.  It is emptied when it has
    grown to ``limit`` words, which bounds memory and changes no result."""

    def __init__(self, limit: int = 1 << 20):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        h = word_hash(word)
        self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def as_bytes(text) -> bytes:
    """UTF-8 bytes of a text; null is empty.  Takes str, bytes and bytearray."""
    if text is None or text != text:
        return b""
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else bytes(text)


def words_of(text) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case: exactly what
    ``bytes.lower`` and ``bytes.split`` do on the UTF-8 bytes."""
    return as_bytes(text).lower().split()


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Distinct hashes of the k-word shingles of a word-hash sequence, sorted; a
    shorter sequence is one shingle, an empty one none."""
    n = len(h)
    if n == 0:
        return h
    m = min(k, n)
    a = np.full(n - m + 1, 0x9E3779B97F4A7C15 + m, np.uint64)
    for i in range(m):
        a = (a ^ (a >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + h[i:n - m + 1 + i]
    return np.unique(mix(a))


def packs(rows: Iterator, size: int) -> Iterator[list]:
    """Lists of at most ``size`` items of an iterator."""
    pack: list = []
    for r in rows:
        pack.append(r)
        if len(pack) >= size:
            yield pack
            pack = []
    if pack:
        yield pack


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components by alternating large-star and small-star.

    ``edges``: columns a, b (long).  Returns (node, root) for every node of an
    edge, root being the smallest node of its component.  Each half round is one
    grouped minimum (combined map-side) and one join back on the node, whose
    large partitions adaptive execution can split, so a node with very many
    neighbours is no single task.  Rounds end when a round changes nothing.
    """
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    mark = None
    for _ in range(max_rounds):
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        seen = Observation()
        new = stored(small, "cc", seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"))
        drop_stored(e)
        e = new
        if seen.get == mark:
            break
        mark = seen.get
    else:
        raise RuntimeError("components did not settle")
    return (e.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
