"""Scans (SRC1-SRC5): typed reads, full-reload staging, incremental pulls.

Filters are on raw columns so Catalyst pushes them into the Parquet scan
(``PushedFilters``) and the projection prunes columns (``ReadSchema``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rtrim_text(df: DataFrame) -> DataFrame:
    """Right-trim every string column once, on read (CHAR columns are blank-padded)."""
    return df.select(*[
        F.rtrim(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ])


def scan_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """SRC1: typed scan of a replicated table with a fixed schema (no inference)."""
    return rtrim_text(spark.read.schema(schema).parquet(path))


def scan_subledger(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """SRC2: the same typed scan for a sub-ledger history table."""
    return scan_table(spark, path, schema)


def full_reload_pull(source: DataFrame, run_id: str, loaded_at: dt.datetime) -> DataFrame:
    """SRC3: every source row, stamped with the run id and load time (staging shape:
    all columns nullable).  The caller writes it with ``mode('overwrite')``."""
    from ..functions.columns import ntz_literal
    return source.select("*", F.lit(run_id).alias("LoadRunId"), ntz_literal(loaded_at).alias("LoadedAt"))


def incremental_pull(source: DataFrame, watermark: int, uid: str = "YJ_UID") -> DataFrame:
    """SRC4: rows strictly above the watermark; a pushed-down Parquet filter."""
    return source.where(F.col(uid) > F.lit(watermark).cast("bigint"))


def staged_for_run(staging: DataFrame, run_id: str) -> DataFrame:
    """SRC5: the staging rows of one run."""
    return staging.where(F.col("LoadRunId") == run_id)
