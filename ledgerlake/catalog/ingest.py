"""Registered ingest, load-control and snapshot queries (SRC3, SRC5, SNK*, JN9-JN11,
JN14, SET4, AGG19, AGG20, WIN10, WIN11, FS10, DQ8, DQ9, DQ13, DQ17, DQ22, EXT7)."""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from .. import fixed
from ..operators import aggregates as AG
from ..operators import ingest as IG
from ..operators import joins as JN
from ..operators import sets as SE
from ..operators import windows as WN
from ..oracle import midx
from ..plans import loads as LD
from ..plans import statements as st
from ..session import shared_dir
from ..sources import commits, scan
from . import register
from .common import L


def T(x: dt.datetime | dt.date) -> str:
    if isinstance(x, dt.datetime):
        return f"TIMESTAMP '{x:%Y-%m-%d %H:%M:%S}'"
    return f"DATE '{x:%Y-%m-%d}'"


def _h(h):
    return dt.timedelta(hours=h)


S = LD.JOURNAL_SPLIT_UID
T0 = LD.RUN_LOG_T0
_RUNS = [  # (run, table, kind, status, start hour, minutes, copied, wm_from, wm_to, error, count source)
    ("run-01", "journal", "INITIAL", "COMPLETE", 0, 2, "a", "0", "wa", None),
    ("run-02", "glcal", "FULL_RELOAD", "COMPLETE", 1, 3, "(SELECT COUNT(*) FROM glcal)", None, None, None),
    ("run-03", "glfis", "FULL_RELOAD", "COMPLETE", 2, 4, "(SELECT COUNT(*) FROM glfis)", None, None, None),
    ("run-04", "deptmast", "FULL_RELOAD", "COMPLETE", 3, 5, "(SELECT COUNT(*) FROM deptmast)", None, None, None),
    ("run-05", "coacmast", "FULL_RELOAD", "COMPLETE", 4, 6, "(SELECT COUNT(*) FROM coacmast)", None, None, None),
    ("run-06", "journal", "INCREMENTAL", "COMPLETE", 10, 7, "b", "wa", "wb", None),
    ("run-07", "journal", "INCREMENTAL", "COMPLETE", 11, 1, "0", "wb", None, None),
    ("run-08", "glcal", "FULL_RELOAD", "FAILED", 12, 1, None, None, None, "TimeoutError: source read timed out"),
    ("run-09", "deptmast", "FULL_RELOAD", "RUNNING", 13, None, None, None, None, None),
]


def _run_sql(r) -> str:
    run, table, kind, status, h, mins, copied, wf, wt, err = r
    start = T0 + _h(h)
    end = T(start + dt.timedelta(minutes=mins)) if mins is not None else "CAST(NULL AS TIMESTAMP)"
    c = f"CAST({copied} AS BIGINT)" if copied else "CAST(NULL AS BIGINT)"
    ins = c if status == "COMPLETE" else "CAST(NULL AS BIGINT)"
    upd = "CAST(0 AS BIGINT)" if status == "COMPLETE" else "CAST(NULL AS BIGINT)"
    e = f"'{err}'" if err else "CAST(NULL AS VARCHAR)"
    wfs = f"CAST({wf} AS BIGINT)" if wf else "CAST(NULL AS BIGINT)"
    wts = f"CAST({wt} AS BIGINT)" if wt else "CAST(NULL AS BIGINT)"
    return (f"SELECT '{run}' AS RunId, '{table}' AS TableName, '{kind}' AS RunKind, '{status}' AS Status, "
            f"{T(start)} AS StartedUtc, {end} AS EndedUtc, {c} AS RowsCopied, {ins} AS RowsInserted, "
            f"{upd} AS RowsUpdated, CAST(NULL AS BIGINT) AS RowsMerged, {wfs} AS WatermarkFrom, {wts} AS WatermarkTo, "
            f"{e} AS ErrorMessage FROM rl_j")


RUNLOG = [
    ("rl_j", f"SELECT COUNT(*) FILTER (WHERE YJ_UID <= {S}) AS a, max(CASE WHEN YJ_UID <= {S} THEN YJ_UID END) AS wa, "
             f"COUNT(*) FILTER (WHERE YJ_UID > {S}) AS b, max(YJ_UID) AS wb FROM journal"),
    ("runlog", " UNION ALL ".join(_run_sql(r) for r in _RUNS)),
]


def _runs(spark, sf):
    return LD.run_log(L(spark, sf))


# --- merge CTEs
VALS = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
MERGE = [
    ("m_target", f"""SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE o_orderstatus END AS o_orderstatus,
                     o_totalprice, o_orderdate, o_orderpriority, {T(LD.MERGE_INITIAL)} AS DateAddedUtc,
                     {T(LD.MERGE_INITIAL)} AS DateModifiedUtc, 'run-initial' AS LastRunId
                     FROM orders WHERE o_orderkey % 10 < 8"""),
    ("m_staged", """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
                    CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
                    o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 10 >= 2"""),
    ("m_join", "SELECT coalesce(t.o_orderkey, s.o_orderkey) AS k, t.o_orderkey IS NOT NULL AS in_t, s.o_orderkey IS NOT NULL AS in_s, "
               + ", ".join(f"t.{c} AS t_{c}, s.{c} AS s_{c}" for c in VALS)
               + ", t.DateAddedUtc AS t_added, t.DateModifiedUtc AS t_modified, t.LastRunId AS t_run "
               "FROM m_target t FULL JOIN m_staged s ON t.o_orderkey = s.o_orderkey"),
    ("m_act", """SELECT *, CASE WHEN in_t AND NOT in_s THEN 'KEPT' WHEN in_s AND NOT in_t THEN 'INSERT'
                 WHEN coalesce(t_o_custkey, 0) <> coalesce(s_o_custkey, 0) OR coalesce(t_o_orderstatus, '') <> coalesce(s_o_orderstatus, '')
                   OR coalesce(t_o_totalprice, 0) <> coalesce(s_o_totalprice, 0) OR t_o_orderdate IS DISTINCT FROM s_o_orderdate
                   OR coalesce(t_o_orderpriority, '') <> coalesce(s_o_orderpriority, '') THEN 'UPDATE' ELSE 'UNCHANGED' END AS act
                 FROM m_join"""),
    ("merged", "SELECT k AS o_orderkey, "
               + ", ".join(f"CASE WHEN act IN ('INSERT', 'UPDATE') THEN s_{c} ELSE t_{c} END AS {c}" for c in VALS)
               + f", CASE WHEN act = 'INSERT' THEN {T(LD.MERGE_NOW)} ELSE t_added END AS DateAddedUtc"
               f", CASE WHEN act IN ('INSERT', 'UPDATE') THEN {T(LD.MERGE_NOW)} ELSE t_modified END AS DateModifiedUtc"
               ", CASE WHEN act IN ('INSERT', 'UPDATE') THEN 'run-merge' ELSE t_run END AS LastRunId, act AS MergeAction FROM m_act"),
]
B = LD.SNAP_BASE
W = LD.SNAP_MARKS


def _cap_sql(v: str, i: int) -> str:
    prev, now = W[i], W[i + 1]
    return (f"SELECT CAST((({T(now)} AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') AS DATE) AS SnapshotDate, "
            f"o_orderkey, {', '.join(VALS)}, CASE WHEN DateAddedUtc > {T(prev)} THEN 'I' ELSE 'U' END AS ChangeKind, "
            f"DateAddedUtc AS SourceFirstSeenUtc, DateModifiedUtc AS SourceLastSeenUtc, LastRunId AS SourceRunId, "
            f"{T(now)} AS SnapshotCapturedUtc, 'cap-{i + 1}' AS CaptureRunId FROM {v} "
            f"WHERE DateModifiedUtc > {T(prev)} AND DateModifiedUtc <= {T(now)}")


SNAP = MERGE + [
    ("snap_v1", f"""SELECT o_orderkey, {', '.join(VALS)}, LastRunId, DateModifiedUtc,
                    CASE WHEN o_orderkey % 3 = 0 THEN DateModifiedUtc ELSE {T(B - _h(24))} END AS DateAddedUtc
                    FROM (SELECT * REPLACE ({T(B)} + to_hours(CAST(o_orderkey % 20 AS INTEGER)) AS DateModifiedUtc) FROM merged)"""),
    ("snap_v2", f"""SELECT * REPLACE (CASE WHEN o_orderkey % 20 IN (3, 4) THEN o_totalprice + 10 ELSE o_totalprice END AS o_totalprice,
                    CASE WHEN o_orderkey % 20 IN (3, 4) THEN {T(B + _h(12))} ELSE DateModifiedUtc END AS DateModifiedUtc) FROM snap_v1"""),
    ("snap_v3", f"""SELECT * REPLACE (CASE WHEN o_orderkey % 20 = 5 THEN o_totalprice + 20 ELSE o_totalprice END AS o_totalprice,
                    CASE WHEN o_orderkey % 20 = 5 THEN {T(B + _h(48))} ELSE DateModifiedUtc END AS DateModifiedUtc) FROM snap_v2"""),
    ("caplog", " UNION ALL ".join(_cap_sql(v, i) for i, v in enumerate(["snap_v1", "snap_v2", "snap_v3"]))),
    ("snap", """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY SnapshotDate, o_orderkey
                ORDER BY SnapshotCapturedUtc DESC, CaptureRunId DESC) AS rn FROM caplog) WHERE rn = 1"""),
]


# ======================================================================= sources
@register("full_reload_pull", f"""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
           'run-reload' AS LoadRunId, {T(LD.MERGE_NOW)} AS LoadedAt FROM orders""")
def q_full_reload_pull(spark, sf):
    return scan.full_reload_pull(LD.orders(spark, sf), "run-reload", LD.MERGE_NOW)


@register("staged_for_run", """
    SELECT LoadRunId, o_orderstatus, COUNT(*) AS Rows FROM (
        SELECT *, 'run-a' AS LoadRunId FROM orders WHERE o_orderkey % 2 = 0
        UNION ALL SELECT *, 'run-b' FROM orders) WHERE LoadRunId = 'run-b' GROUP BY LoadRunId, o_orderstatus""")
def q_staged_for_run(spark, sf):
    o = LD.orders(spark, sf)
    staging = scan.full_reload_pull(o.where(F.col("o_orderkey") % 2 == 0), "run-a", LD.MERGE_NOW).unionByName(
        scan.full_reload_pull(o, "run-b", LD.MERGE_NOW))
    return scan.staged_for_run(staging, "run-b").groupBy("LoadRunId", "o_orderstatus").agg(F.count(F.lit(1)).alias("Rows"))


# ======================================================================= merge
@register("merge_upsert", "SELECT * FROM merged", extra_ctes=MERGE)
def q_merge_upsert(spark, sf):
    return LD.merged_orders(spark, sf)


@register("change_predicate", """
    SELECT COUNT(*) AS Matched, CAST(SUM(CASE WHEN act = 'UPDATE' THEN 1 ELSE 0 END) AS BIGINT) AS Changed,
           CAST(SUM(CASE WHEN act = 'UNCHANGED' THEN 1 ELSE 0 END) AS BIGINT) AS Unchanged,
           CAST(SUM(CASE WHEN act = 'UNCHANGED' AND t_o_orderstatus IS DISTINCT FROM s_o_orderstatus THEN 1 ELSE 0 END) AS BIGINT) AS NullEqualsBlank
    FROM m_act WHERE in_t AND in_s""", extra_ctes=MERGE)
def q_change_predicate(spark, sf):
    t = LD.merge_target(spark, sf).select("o_orderkey", F.col("o_orderstatus").alias("t_status"))
    s = LD.merge_staged(spark, sf).select("o_orderkey", F.col("o_orderstatus").alias("s_status"))
    m = LD.merged_orders(spark, sf).where(F.col("MergeAction").isin("UPDATE", "UNCHANGED"))
    j = m.join(t, "o_orderkey").join(s, "o_orderkey")
    a = F.col("MergeAction")
    return j.agg(F.count(F.lit(1)).alias("Matched"), F.count_if(a == "UPDATE").alias("Changed"),
                 F.count_if(a == "UNCHANGED").alias("Unchanged"),
                 F.count_if((a == "UNCHANGED") & ~F.col("t_status").eqNullSafe(F.col("s_status"))).alias("NullEqualsBlank"))


@register("audit_stamps", """
    SELECT MergeAction, DateAddedUtc, DateModifiedUtc, LastRunId, COUNT(*) AS Rows FROM merged GROUP BY ALL""",
          extra_ctes=MERGE)
def q_audit_stamps(spark, sf):
    return LD.merged_orders(spark, sf).groupBy("MergeAction", IG.ADDED, IG.MODIFIED, IG.RUN).agg(F.count(F.lit(1)).alias("Rows"))


@register("merge_actions", """
    SELECT CAST(SUM(CASE WHEN MergeAction = 'INSERT' THEN 1 ELSE 0 END) AS BIGINT) AS RowsInserted,
           CAST(SUM(CASE WHEN MergeAction = 'UPDATE' THEN 1 ELSE 0 END) AS BIGINT) AS RowsUpdated FROM merged""",
          extra_ctes=MERGE)
def q_merge_actions(spark, sf):
    return IG.merge_actions(LD.merged_orders(spark, sf))


@register("merge_join", """
    SELECT CASE WHEN in_t AND in_s THEN 'both' WHEN in_t THEN 'target_only' ELSE 'staged_only' END AS MatchKind,
           COUNT(*) AS Keys FROM m_join GROUP BY ALL""", extra_ctes=MERGE)
def q_merge_join(spark, sf):
    t = LD.merge_target(spark, sf).select("o_orderkey", F.lit(True).alias("t"))
    s = LD.merge_staged(spark, sf).select("o_orderkey", F.lit(True).alias("s"))
    j = t.join(s, "o_orderkey", "full_outer")
    kind = F.when(F.col("t").isNotNull() & F.col("s").isNotNull(), "both").when(F.col("t").isNotNull(), "target_only") \
        .otherwise("staged_only")
    return j.groupBy(kind.alias("MatchKind")).agg(F.count(F.lit(1)).alias("Keys"))


@register("row_diff", f"""
    SELECT *, 'missing_in_replica' AS Side FROM (
        SELECT o_orderkey, {', '.join(VALS)} FROM m_staged EXCEPT ALL SELECT o_orderkey, {', '.join(VALS)} FROM merged)
    UNION ALL
    SELECT *, 'extra_in_replica' FROM (
        SELECT o_orderkey, {', '.join(VALS)} FROM merged EXCEPT ALL SELECT o_orderkey, {', '.join(VALS)} FROM m_staged)""",
          extra_ctes=MERGE)
def q_row_diff(spark, sf):
    cols = ["o_orderkey", *LD.ORDER_COLS[1:]]
    return SE.row_diff(LD.merge_staged(spark, sf).select(*cols), LD.merged_orders(spark, sf).select(*cols))


@register("stage_vs_current", """
    SELECT 'staging' AS Layer, COUNT(*) AS Rows,
           CAST(SUM(CASE WHEN coalesce(o_orderstatus, '') <> '' THEN 1 ELSE 0 END) AS BIGINT) AS StatusFilled,
           CAST(SUM(CASE WHEN coalesce(o_orderpriority, '') <> '' THEN 1 ELSE 0 END) AS BIGINT) AS PriorityFilled FROM m_staged
    UNION ALL
    SELECT 'current', COUNT(*), CAST(SUM(CASE WHEN coalesce(o_orderstatus, '') <> '' THEN 1 ELSE 0 END) AS BIGINT),
           CAST(SUM(CASE WHEN coalesce(o_orderpriority, '') <> '' THEN 1 ELSE 0 END) AS BIGINT) FROM merged""",
          extra_ctes=MERGE)
def q_stage_vs_current(spark, sf):
    def counts(df, layer):
        return df.agg(F.lit(layer).alias("Layer"), F.count(F.lit(1)).alias("Rows"),
                      F.count_if(F.coalesce("o_orderstatus", F.lit("")) != "").alias("StatusFilled"),
                      F.count_if(F.coalesce("o_orderpriority", F.lit("")) != "").alias("PriorityFilled"))
    return SE.union_all([("x", counts(LD.merge_staged(spark, sf), "staging")),
                         ("x", counts(LD.merged_orders(spark, sf), "current"))]).drop("Source")


# ======================================================================= append
@register("append_journal", "SELECT period, COUNT(*) AS Legs, CAST(SUM(YJ_AMT) AS DECIMAL(18, 2)) AS Amount, "
                            "max(YJ_UID) AS MaxUid FROM journal GROUP BY period")
def q_append_journal(spark, sf):
    """The journal as of the first run (UIDs up to the split) plus the appended
    increment: only the increment is written, and base and increment are read
    together, as a reader of an append-only table sees them."""
    j = L(spark, sf).journal
    path = f"{shared_dir(spark)}/ledgerlake/scratch/append-{uuid.uuid4().hex}"
    IG.append_journal(scan.incremental_pull(j, S), path, "run-increment")
    out = j.where(F.col("YJ_UID") <= S).unionByName(spark.read.parquet(path).drop("run"))
    return out.groupBy("period").agg(F.count(F.lit(1)).alias("Legs"), F.sum("YJ_AMT").cast("decimal(18,2)").alias("Amount"),
                                     F.max("YJ_UID").alias("MaxUid"))


@register("merge_commit", f"""
    SELECT o_orderkey, {', '.join(VALS)}, DateAddedUtc, DateModifiedUtc,
           CASE WHEN MergeAction IN ('INSERT', 'UPDATE') THEN 'run-' || CAST(o_orderkey % 2 AS VARCHAR) ELSE LastRunId END AS LastRunId
    FROM merged""", extra_ctes=MERGE)
def q_merge_commit(spark, sf):
    """Two writers merge the even and the odd keys into one table at the same time; the one
    that loses a commit merges again, and each run is then repeated, which adds nothing."""
    root = f"{shared_dir(spark)}/ledgerlake/scratch/merge-{uuid.uuid4().hex}"
    commits.once(spark, root, lambda path: LD.merge_target(spark, sf).write.parquet(path))
    staged = LD.merge_staged(spark, sf)

    def run(part: int) -> None:
        for _ in range(2):
            IG.merge_into(spark, root, staged.where(F.col("o_orderkey") % 2 == part), ["o_orderkey"], f"run-{part}", LD.MERGE_NOW)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(run, (0, 1)))
    return IG.read_current(spark, root)


@register("append_runs", f"""
    SELECT period, COUNT(*) AS Legs, CAST(SUM(YJ_AMT) AS DECIMAL(18, 2)) AS Amount, max(YJ_UID) AS MaxUid,
           CASE WHEN YJ_UID <= {S} THEN 'append-1' ELSE 'append-3' END AS Run
    FROM journal GROUP BY ALL""")
def q_append_runs(spark, sf):
    """Three guarded runs over the journal: an initial one, an increment that fails after
    its write (never visible), and the increment again."""
    return _appended(spark, sf)[0].groupBy("period", F.col("run").alias("Run")).agg(
        F.count(F.lit(1)).alias("Legs"), F.sum("YJ_AMT").cast("decimal(18,2)").alias("Amount"), F.max("YJ_UID").alias("MaxUid"))


@register("append_run_log", f"""
    SELECT * FROM (
      SELECT 'append-1' AS RunId, 'INITIAL' AS RunKind, 'COMPLETE' AS Status, a AS RowsCopied, CAST(0 AS BIGINT) AS WatermarkFrom, wa AS WatermarkTo,
             CAST(NULL AS VARCHAR) AS ErrorMessage FROM rl_j
      UNION ALL SELECT 'append-2', 'INCREMENTAL', 'FAILED', NULL, wa, NULL, 'ConnectionError: lost after the write' FROM rl_j
      UNION ALL SELECT 'append-3', 'INCREMENTAL', 'COMPLETE', b, wa, wb, NULL FROM rl_j)""", extra_ctes=RUNLOG[:1])
def q_append_run_log(spark, sf):
    return _appended(spark, sf)[1].select("RunId", "RunKind", "Status", "RowsCopied", "WatermarkFrom", "WatermarkTo", "ErrorMessage")


def _appended(spark, sf):
    """(rows that a reader sees, the run log) after the three runs."""
    j = L(spark, sf).journal.select("YJ_UID", "YJ_ACC", "YJ_AMT", "period")
    root = f"{shared_dir(spark)}/ledgerlake/scratch/runs-{uuid.uuid4().hex}"
    ticks = (T0 + _h(h) for h in range(100))

    def load(run: str, upto: int | None = None, fails: bool = False):
        def go(watermark):
            rows = scan.incremental_pull(j, watermark)
            counts = IG.append_journal(rows.where(F.col("YJ_UID") <= upto) if upto else rows, f"{root}/journal", run)
            if fails:
                raise ConnectionError("lost after the write")
            return counts
        return go
    for run, kind, upto, fails in (("append-1", "INITIAL", S, False), ("append-2", "INCREMENTAL", None, True), ("append-3", "INCREMENTAL", None, False)):
        try:
            IG.execute_run(spark, f"{root}/log", "journal", kind, run, load(run, upto, fails), lambda: next(ticks), ["journal"])
        except ConnectionError:
            pass  # recorded as FAILED
    runs = IG.read_runs(spark, f"{root}/log")
    return IG.visible(spark.read.parquet(f"{root}/journal"), runs), runs


# ======================================================================= snapshots
@register("capture_snapshot", "SELECT * FROM snap", extra_ctes=SNAP)
def q_capture_snapshot(spark, sf):
    return LD.snapshot_table(spark, sf)


@register("change_kind", "SELECT SnapshotDate, ChangeKind, COUNT(*) AS Rows FROM snap GROUP BY ALL", extra_ctes=SNAP)
def q_change_kind(spark, sf):
    return LD.snapshot_table(spark, sf).groupBy("SnapshotDate", "ChangeKind").agg(F.count(F.lit(1)).alias("Rows"))


@register("advance_snapshot_watermark", f"""
    SELECT 'orders' AS TableName, {T(W[3])} AS LastCapturedThroughUtc, {T(W[3] + dt.timedelta(minutes=5))} AS LastSnapshotRunUtc,
           (SELECT COUNT(*) FROM caplog WHERE CaptureRunId = 'cap-3') AS LastRowsCaptured
    UNION ALL SELECT 'journal', {T(T0)}, CAST(NULL AS TIMESTAMP), CAST(NULL AS BIGINT)""", extra_ctes=SNAP)
def q_advance_snapshot_watermark(spark, sf):
    control = spark.createDataFrame([("orders", W[0], None, None), ("journal", T0, None, None)],  # NTZ: zone-free
                                    "TableName string, LastCapturedThroughUtc timestamp_ntz, "
                                    "LastSnapshotRunUtc timestamp_ntz, LastRowsCaptured bigint")
    # Rows captured per run, in one aggregation (one row per capture run).
    counts = {r["CaptureRunId"]: r["n"] for r in
              LD.capture_log(spark, sf).groupBy("CaptureRunId").agg(F.count(F.lit(1)).alias("n")).collect()}
    for i in (1, 2, 3):
        control = IG.advance_snapshot_watermark(control, "orders", W[i], W[i] + dt.timedelta(minutes=5),
                                                counts.get(f"cap-{i}", 0))
    return control


@register("snapshot_as_of", f"""
    SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY SnapshotDate DESC) AS rn
                               FROM snap WHERE SnapshotDate <= {T(LD.SNAP_AS_OF)}) WHERE rn = 1""", extra_ctes=SNAP)
def q_snapshot_as_of(spark, sf):
    return IG.as_of(LD.snapshot_intervals(spark, sf), LD.SNAP_AS_OF)


@register("snapshot_lookup", f"""
    SELECT r.o_orderkey, r.AsOf, s.SnapshotDate, s.o_totalprice, s.ChangeKind
    FROM (SELECT o_orderkey, CAST({T(LD.SNAP_AS_OF)} + CAST(o_orderkey % 4 - 2 AS INTEGER) AS DATE) AS AsOf FROM orders) r
    LEFT JOIN snap s ON s.o_orderkey = r.o_orderkey AND s.SnapshotDate =
         (SELECT max(q.SnapshotDate) FROM snap q WHERE q.o_orderkey = r.o_orderkey AND q.SnapshotDate <= r.AsOf)""", extra_ctes=SNAP)
def q_snapshot_lookup(spark, sf):
    """Every order asks for its state on a day of its own."""
    asked = LD.orders(spark, sf).select("o_orderkey", F.date_add(F.lit(LD.SNAP_AS_OF), (F.col("o_orderkey") % 4 - 2).cast("int")).alias("AsOf"))
    return IG.as_of_lookup(asked, LD.snapshot_intervals(spark, sf), ["o_orderkey"], "AsOf").select(
        "o_orderkey", "AsOf", "SnapshotDate", "o_totalprice", "ChangeKind")


@register("snapshot_diff", """
    SELECT * FROM (SELECT o_orderkey, SnapshotDate, lag(o_totalprice) OVER (PARTITION BY o_orderkey ORDER BY SnapshotDate) AS OldValue,
                          o_totalprice AS NewValue FROM snap) WHERE OldValue IS NOT NULL""", extra_ctes=SNAP)
def q_snapshot_diff(spark, sf):
    d = WN.snapshot_diff(LD.snapshot_table(spark, sf), ["o_orderkey"], "o_totalprice")
    return d.where(F.col("OldValue").isNotNull())


@register("closed_period_restated", f"""
    SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS Period, COUNT(*) AS RestatedRows
    FROM snap WHERE ChangeKind = 'U' AND year(o_orderdate) * 100 + month(o_orderdate) <= {fixed.LAST_CLOSE} GROUP BY ALL""",
          extra_ctes=SNAP)
def q_closed_period_restated(spark, sf):
    s = LD.snapshot_table(spark, sf)
    per = (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("int")
    return s.where((F.col("ChangeKind") == "U") & (per <= fixed.LAST_CLOSE)).groupBy(per.alias("Period")).agg(
        F.count(F.lit(1)).alias("RestatedRows"))


@register("lockstep_timing", """
    SELECT coalesce(m.Period, s.Period) AS Period, m.FirstAdded, s.FirstCaptured,
           CAST(date_diff('second', m.FirstAdded, s.FirstCaptured) AS BIGINT) AS LagSeconds
    FROM (SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS Period, min(DateAddedUtc) AS FirstAdded
          FROM merged GROUP BY ALL) m
    FULL JOIN (SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS Period, min(SnapshotCapturedUtc) AS FirstCaptured
               FROM snap GROUP BY ALL) s ON m.Period = s.Period""", extra_ctes=SNAP)
def q_lockstep_timing(spark, sf):
    def per(df):
        return df.withColumn("Period", (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("int"))
    m = per(LD.current_orders(spark, sf)).groupBy("Period").agg(F.min(IG.ADDED).alias("FirstAdded"))
    s = per(LD.snapshot_table(spark, sf)).groupBy("Period").agg(F.min("SnapshotCapturedUtc").alias("FirstCaptured"))
    j = m.join(s, "Period", "full_outer")
    return j.withColumn("LagSeconds", F.timestamp_diff("SECOND", F.col("FirstAdded"), F.col("FirstCaptured")).cast("bigint"))


# ======================================================================= run log
@register("start_run", """
    SELECT TableName, RunKind, CASE WHEN RunKind = 'INCREMENTAL' THEN inc WHEN RunKind = 'INITIAL' THEN CAST(0 AS BIGINT)
           ELSE CAST(NULL AS BIGINT) END AS WatermarkFrom
    FROM (SELECT TableName, coalesce(max(CASE WHEN Status = 'COMPLETE' THEN WatermarkTo END), 0) AS inc,
                 unnest(['INITIAL', 'INCREMENTAL', 'FULL_RELOAD']) AS RunKind FROM runlog GROUP BY TableName)""",
          extra_ctes=RUNLOG)
def q_start_run(spark, sf):
    return IG.watermark_table(_runs(spark, sf))


_END = LD.RUN_LOG_NOW


@register("finish_run", f"""
    SELECT * REPLACE (CASE WHEN RunId = 'run-09' THEN 'COMPLETE' ELSE Status END AS Status,
                      CASE WHEN RunId = 'run-09' THEN {T(_END)} ELSE EndedUtc END AS EndedUtc) FROM runlog""",
          extra_ctes=RUNLOG)
def q_finish_run(spark, sf):
    return IG.finish_run(_runs(spark, sf), "run-09", _END)


@register("fail_run", f"""
    SELECT * REPLACE (CASE WHEN RunId = 'run-10' THEN 'FAILED' ELSE Status END AS Status,
                      CASE WHEN RunId = 'run-10' THEN {T(_END + dt.timedelta(minutes=1))} ELSE EndedUtc END AS EndedUtc,
                      CASE WHEN RunId = 'run-10' THEN 'network error' ELSE ErrorMessage END AS ErrorMessage)
    FROM (SELECT * FROM runlog UNION ALL
          SELECT 'run-10', 'journal', 'INCREMENTAL', 'RUNNING', {T(_END)}, CAST(NULL AS TIMESTAMP), NULL, NULL, NULL, NULL,
                 (SELECT coalesce(max(WatermarkTo), 0) FROM runlog WHERE TableName = 'journal' AND Status = 'COMPLETE'),
                 CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR))""", extra_ctes=RUNLOG)
def q_fail_run(spark, sf):
    runs = _runs(spark, sf)
    started = runs.unionByName(IG.start_run(runs, "journal", "INCREMENTAL", "run-10", _END, ["journal", "glcal"]))
    return IG.fail_run(started, "run-10", _END + dt.timedelta(minutes=1), "network error")


_CONTROL_SQL = f"""SELECT 'journal' AS TableName, {T(T0)} AS LastCapturedThroughUtc, CAST(NULL AS TIMESTAMP) AS LastSnapshotRunUtc,
                   CAST(NULL AS BIGINT) AS LastRowsCaptured UNION ALL
                   SELECT 'glcal', {T(T0)}, CAST(NULL AS TIMESTAMP), CAST(NULL AS BIGINT)"""


def _control(spark):
    return spark.createDataFrame([("journal", T0, None, None), ("glcal", T0, None, None)],
                                 "TableName string, LastCapturedThroughUtc timestamp_ntz, "
                                 "LastSnapshotRunUtc timestamp_ntz, LastRowsCaptured bigint")


@register("seed_control", f"""
    SELECT * FROM ({_CONTROL_SQL}) UNION ALL
    SELECT DISTINCT TableName, {T(_END)}, CAST(NULL AS TIMESTAMP), CAST(NULL AS BIGINT) FROM runlog r
    WHERE NOT EXISTS (SELECT 1 FROM ({_CONTROL_SQL}) c WHERE c.TableName = r.TableName)""", extra_ctes=RUNLOG)
def q_seed_control(spark, sf):
    return IG.seed_control(_control(spark), _runs(spark, sf), _END)


@register("not_exists", f"""
    SELECT DISTINCT TableName FROM runlog r WHERE NOT EXISTS (SELECT 1 FROM ({_CONTROL_SQL}) c WHERE c.TableName = r.TableName)""",
          extra_ctes=RUNLOG)
def q_not_exists(spark, sf):
    return _runs(spark, sf).select("TableName").distinct().join(_control(spark).select("TableName"), "TableName", "left_anti")


@register("self_join_latest", """
    SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY TableName ORDER BY StartedUtc DESC) AS rn FROM runlog)
    WHERE rn = 1""", extra_ctes=RUNLOG)
def q_self_join_latest(spark, sf):
    return JN.self_join_latest(_runs(spark, sf), "TableName", "StartedUtc")


@register("max_watermark", """
    SELECT coalesce(max(WatermarkTo), 0) AS Watermark FROM runlog WHERE TableName = 'journal' AND Status = 'COMPLETE'""",
          extra_ctes=RUNLOG)
def q_max_watermark(spark, sf):
    return AG.max_watermark(_runs(spark, sf), "journal")


@register("last_success", """
    SELECT TableName, max(EndedUtc) AS LastSuccessUtc, max(RowsCopied) AS MaxRowsCopied FROM runlog
    WHERE Status = 'COMPLETE' GROUP BY TableName""", extra_ctes=RUNLOG)
def q_last_success(spark, sf):
    return AG.last_success(_runs(spark, sf))


@register("load_status", f"""
    SELECT o.TableName, o.LastSuccessUtc, CAST(date_diff('second', o.LastSuccessUtc, {T(_END)}) AS BIGINT) AS SecondsSinceSuccess,
           a.Status AS LastAttemptStatus, o.RowsCopied AS LastSuccessRowsCopied, a.ErrorMessage AS LastErrorMessage
    FROM (SELECT TableName, EndedUtc AS LastSuccessUtc, RowsCopied, row_number() OVER (PARTITION BY TableName ORDER BY EndedUtc DESC) rn
          FROM runlog WHERE Status = 'COMPLETE') o
    LEFT JOIN (SELECT TableName, Status, ErrorMessage, row_number() OVER (PARTITION BY TableName ORDER BY StartedUtc DESC) rn
               FROM runlog) a ON a.TableName = o.TableName AND a.rn = 1
    WHERE o.rn = 1""", extra_ctes=RUNLOG)
def q_load_status(spark, sf):
    return st.load_status(_runs(spark, sf), _END)


@register("load_history", """
    SELECT * FROM (SELECT RunId, TableName, RunKind, Status, StartedUtc, EndedUtc, RowsCopied,
                          CAST(row_number() OVER (PARTITION BY TableName ORDER BY StartedUtc DESC) AS INTEGER) AS Recent FROM runlog)
    WHERE Recent <= 3""", extra_ctes=RUNLOG)
def q_load_history(spark, sf):
    from ..operators.topk import top_n_per_group
    r = _runs(spark, sf).select("RunId", "TableName", "RunKind", "Status", "StartedUtc", "EndedUtc", "RowsCopied")
    return top_n_per_group(r, ["TableName"], [F.col("StartedUtc").desc()], 3).withColumnRenamed("Rank", "Recent")


@register("failed_loads", """
    SELECT RunId, TableName, StartedUtc, ErrorMessage, CAST(date_diff('second', StartedUtc, EndedUtc) AS BIGINT) AS DurationSec
    FROM runlog WHERE Status = 'FAILED'""", extra_ctes=RUNLOG)
def q_failed_loads(spark, sf):
    r = _runs(spark, sf).where(F.col("Status") == "FAILED")
    dur = F.timestamp_diff("SECOND", F.col("StartedUtc"), F.col("EndedUtc"))
    return r.select("RunId", "TableName", "StartedUtc", "ErrorMessage", dur.cast("bigint").alias("DurationSec"))


@register("duration_trend", """
    SELECT TableName, RunId, StartedUtc, DurationSec, DurationSec - lag(DurationSec) OVER w AS ChangeSec,
           round(avg(DurationSec) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS MovingAvgSec
    FROM (SELECT *, CAST(date_diff('second', StartedUtc, EndedUtc) AS BIGINT) AS DurationSec FROM runlog WHERE EndedUtc IS NOT NULL)
    WINDOW w AS (PARTITION BY TableName ORDER BY StartedUtc, RunId)""", extra_ctes=RUNLOG)
def q_duration_trend(spark, sf):
    return WN.duration_trend(_runs(spark, sf))


@register("audit_log_search", f"""
    SELECT * FROM runlog WHERE CAST(StartedUtc AS DATE) = {T(T0.date())} AND TableName = 'journal'""", extra_ctes=RUNLOG)
def q_audit_log_search(spark, sf):
    from ..plans.extensions import audit_log_search
    return audit_log_search(_runs(spark, sf), T0.date(), table="journal")


@register("pre_post_close", f"""
    SELECT d.GB_CO, d.GB_GLA, CAST(d.GB_DATE // 100 AS INTEGER) AS Year, {'CAST(SUM(d.GB_AMT) AS DECIMAL(18, 2))'} AS FlaggedAmount,
           CAST(SUM(n.GB_AMT) AS DECIMAL(18, 2)) AS NextMonthAmount
    FROM glcal d LEFT JOIN glcal n ON n.GB_CO = d.GB_CO AND n.GB_DIV = d.GB_DIV AND n.GB_GLC = d.GB_GLC AND n.GB_GLA = d.GB_GLA
         AND {midx('n.GB_DATE')} = {midx('d.GB_DATE')} + 1
    WHERE d.GB_YE = 'Y' GROUP BY d.GB_CO, d.GB_GLA, d.GB_DATE // 100""")
def q_pre_post_close(spark, sf):
    from ..functions.periods import month_index
    g = L(spark, sf).glcal
    keys = ["GB_CO", "GB_DIV", "GB_GLC", "GB_GLA"]
    d = g.where(F.col("GB_YE") == "Y").select(*keys, (month_index(F.col("GB_DATE")) + 1).alias("nidx"),
                                                  (F.col("GB_DATE") / 100).cast("int").alias("Year"),
                                                  F.col("GB_AMT").alias("FlaggedAmount"))
    n = g.select(*keys, month_index(F.col("GB_DATE")).alias("nidx"), F.col("GB_AMT").alias("NextMonthAmount"))
    j = d.join(n, [*keys, "nidx"], "left")
    return j.groupBy("GB_CO", "GB_GLA", "Year").agg(F.sum("FlaggedAmount").cast("decimal(18,2)").alias("FlaggedAmount"),
                                                     F.sum("NextMonthAmount").cast("decimal(18,2)").alias("NextMonthAmount"))
