"""Load runs over the driver's data (FIXTURES F4).

* The run log comes from runs that are executed over the ledger's tables: counts and
  journal watermarks of what each load reads, an empty increment, a failed load and a
  process that is lost.  The clock is fixed.
* The merge sides are two overlapping slices of ``orders`` (every row is used:
  the key's last digit decides the side), with changed prices, NULL-vs-blank
  statuses and target-only rows that must survive.
* Snapshot captures run over three versions of the merged table.

The run log, the merged table, the captures and their intervals are each written once
and read by all queries that need them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ingest as IG
from ..sources.adapter import read_source
from ..sources.commits import once, write_bucketed
from ..sources.scan import incremental_pull
from ..sources.store import source_root
from ..sources.subledgers import SUBLEDGERS, stored_subledger

# --- Fixed values: load calendar and run ids -------------------------------------------
RUN_LOG_T0 = dt.datetime(2001, 3, 1, 3, 0, 0)
RUN_LOG_NOW = dt.datetime(2001, 3, 2, 3, 0, 0)
JOURNAL_SPLIT_UID = 200101010000000000
MERGE_INITIAL = dt.datetime(2001, 3, 1, 0, 0, 0)
MERGE_NOW = dt.datetime(2001, 3, 9, 19, 0, 0)
SNAP_BASE = dt.datetime(2001, 3, 10, 12, 0, 0)
SNAP_MARKS = [SNAP_BASE + dt.timedelta(hours=h) for h in (2, 8, 16.5, 51)]
SNAP_AS_OF = dt.date(2001, 3, 11)
ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _h(hours: float) -> dt.timedelta:
    return dt.timedelta(hours=hours)


#: Runs in order: (run, table, kind, start in hours, minutes).  The last two end badly: a
#: load that fails, and a process that is gone after it opened its run.
RUNS = [
    ("run-01", "journal", "INITIAL", 0, 2),
    ("run-02", "glcal", "FULL_RELOAD", 1, 3),
    ("run-03", "glfis", "FULL_RELOAD", 2, 4),
    ("run-04", "deptmast", "FULL_RELOAD", 3, 5),
    ("run-05", "coacmast", "FULL_RELOAD", 4, 6),
    ("run-06", "journal", "INCREMENTAL", 10, 7),
    ("run-07", "journal", "INCREMENTAL", 11, 1),
    ("run-08", "glcal", "FULL_RELOAD", 12, 1),
    ("run-09", "deptmast", "FULL_RELOAD", 13, None),
]
LOADED = ("journal", "glcal", "glfis", "deptmast", "coacmast")


def _load(led, run_id: str, table: str):
    """The load of a run: rows of a full reload, or journal rows above the watermark."""
    def load(watermark):
        if run_id == "run-08":
            raise TimeoutError("source read timed out")
        if table != "journal":
            n = getattr(led, table).count()
            return {"RowsCopied": n, "RowsInserted": n, "RowsUpdated": 0}
        rows = incremental_pull(led.journal, watermark)
        if run_id == "run-01":
            rows = rows.where(F.col("YJ_UID") <= JOURNAL_SPLIT_UID)
        got = rows.agg(F.count(F.lit(1)).alias("n"), F.max("YJ_UID").alias("to")).first()
        return {"RowsCopied": got["n"], "RowsInserted": got["n"], "RowsUpdated": 0, "WatermarkTo": got["to"]}
    return load


def _replay(led, path: str) -> None:
    """Execute every run of RUNS on a fixed clock, each event appended to the log at ``path``."""
    for run_id, table, kind, hour, minutes in RUNS:
        start = RUN_LOG_T0 + _h(hour)
        if minutes is None:
            IG.record_run(IG.start_run(IG.read_runs(led.spark, path), table, kind, run_id, start, LOADED), path, start)
            continue
        ticks = iter([start, start, start + dt.timedelta(minutes=minutes), start + dt.timedelta(minutes=minutes)])
        try:
            IG.execute_run(led.spark, path, table, kind, run_id, _load(led, run_id, table), lambda: next(ticks), LOADED)
        except TimeoutError:
            pass  # recorded as FAILED


def run_log(led) -> DataFrame:
    """The load-control log of the ledger's own loads: executed once per ledger, stored
    with the ledger and read from there by every query."""
    path = once(led.spark, f"{led.root}/runlog", lambda p: _replay(led, p))
    return IG.read_runs(led.spark, path)


# --- merge sides -----------------------------------------------------------------------------

def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_source(spark, sf_dir, "orders").select(*ORDER_COLS)


def merge_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current table before the run: keys ending 0-7, blank status on every 13th key."""
    k = F.col("o_orderkey")
    t = orders(spark, sf_dir).where(k % 10 < 8).withColumn(
        "o_orderstatus", F.when(k % 13 == 0, F.lit("")).otherwise(F.col("o_orderstatus")))
    return t.select("*", IG.ts(MERGE_INITIAL).alias(IG.ADDED), IG.ts(MERGE_INITIAL).alias(IG.MODIFIED),
                    F.lit("run-initial").alias(IG.RUN))


def merge_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging of the run: keys ending 2-9, price +1 on every 7th key, NULL status
    where the target has a blank one (NULL equals '': unchanged)."""
    k = F.col("o_orderkey")
    s = orders(spark, sf_dir).where(k % 10 >= 2).withColumn(
        "o_totalprice", F.when(k % 7 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))).withColumn(
        "o_orderstatus", F.when(k % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderstatus")))
    return s


def merged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return IG.merge_upsert(merge_target(spark, sf_dir), merge_staged(spark, sf_dir), ["o_orderkey"], "run-merge",
                           MERGE_NOW, validate=False)


# --- snapshot captures -----------------------------------------------------------------------

def snapshot_versions(merged: DataFrame) -> list[DataFrame]:
    """Three states of the current table: modified times spread over an Eastern day
    by key bucket; then some keys change again the same day; then on a later day."""
    k = F.col("o_orderkey")
    base = IG.ts(SNAP_BASE)
    v1 = merged.withColumn(IG.MODIFIED, base + F.make_dt_interval(F.lit(0), (k % 20).cast("int")))
    v1 = v1.withColumn(IG.ADDED, F.when(k % 3 == 0, F.col(IG.MODIFIED)).otherwise(IG.ts(SNAP_BASE - _h(24))))
    hit2 = (k % 20).isin(3, 4)
    v2 = v1.withColumn("o_totalprice", F.when(hit2, F.col("o_totalprice") + 10).otherwise(F.col("o_totalprice"))) \
        .withColumn(IG.MODIFIED, F.when(hit2, IG.ts(SNAP_BASE + _h(12))).otherwise(F.col(IG.MODIFIED)))
    hit3 = k % 20 == 5
    v3 = v2.withColumn("o_totalprice", F.when(hit3, F.col("o_totalprice") + 20).otherwise(F.col("o_totalprice"))) \
        .withColumn(IG.MODIFIED, F.when(hit3, IG.ts(SNAP_BASE + _h(48))).otherwise(F.col(IG.MODIFIED)))
    return [v1, v2, v3]


def _stored(spark: SparkSession, sf_dir: str, name: str) -> str:
    return f"{source_root(spark, sf_dir)}/{name}"


def current_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current table after the merge run: committed once, then read."""
    root = _stored(spark, sf_dir, "orders")
    once(spark, root, lambda path: merge_target(spark, sf_dir).write.parquet(path))
    IG.merge_into(spark, root, merge_staged(spark, sf_dir), ["o_orderkey"], "run-merge", MERGE_NOW)
    return IG.read_version(spark, root, "run-merge")


def capture_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three captures (each over its own window of modified times) of the stored
    table, each one partition of a log that is written once."""
    def write(path: str) -> None:
        for i, v in enumerate(snapshot_versions(current_orders(spark, sf_dir))):
            IG.write_capture(IG.check_change_kinds(IG.capture_snapshot(v, SNAP_MARKS[i], SNAP_MARKS[i + 1], f"cap-{i + 1}")), path)
    return spark.read.parquet(once(spark, _stored(spark, sf_dir, "captures"), write))


def snapshot_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshots with the days they hold for: written once from the capture log."""
    def write(path: str) -> None:
        IG.validity_intervals(capture_log(spark, sf_dir), ["o_orderkey"]).write.parquet(path)
    return spark.read.parquet(once(spark, _stored(spark, sf_dir, "snapshots"), write))


def snapshot_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_intervals(spark, sf_dir).drop("ValidTo")


# --- sub-ledger merges -----------------------------------------------------------------------

#: The column of each sub-ledger that tells which order a row is of, as a number.
ORDER_OF = {"CGIHIST": "cast(CH_ORD as bigint)", "YTDIST": "DN_TID div 10000000", "SUBLED": "SL_SEQ div 10000000", "PARTHIST": "cast(PH_PO as bigint)",
            "INVHCC": "EB_TID div 10000000"}


def merge_subledger(spark: SparkSession, sf_dir: str, name: str, root: str) -> dict:
    """JN11: one run of a sub-ledger on its own key (1, 2, 5 or 8 columns), validated and
    committed: orders ending 0-7 are in the target, staging has those ending 2-9 with
    the amount raised on every 7th.  Returns the counts of the run.

    The rows are dealt by the key once: the target is written in buckets of that deal and
    read as such, staging is a part of the dealt rows, and their join moves nothing."""
    s, order = SUBLEDGERS[name], F.expr(ORDER_OF[name])
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = stored_subledger(spark, sf_dir, name).repartition(buckets, *s.keys).persist()
    target = rows.where(order % 10 < 8).select("*", IG.ts(MERGE_INITIAL).alias(IG.ADDED), IG.ts(MERGE_INITIAL).alias(IG.MODIFIED),
                                               F.lit("run-initial").alias(IG.RUN))
    raised = F.when(order % 7 == 0, F.col(s.amount) + 1).otherwise(F.col(s.amount)).cast(s.schema[s.amount].dataType)
    staged = rows.where(order % 10 >= 2).withColumn(s.amount, raised)
    held = {}
    try:
        once(spark, root, lambda path: held.update({path: write_bucketed(target, path, s.keys, buckets)}))
        return IG.merge_into(spark, root, staged, list(s.keys), "run-merge", MERGE_NOW, held=held)
    finally:
        rows.unpersist()
