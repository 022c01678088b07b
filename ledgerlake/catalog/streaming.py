"""Registered streaming queries (STR1-STR4).  Each lands the events, runs the
stream to completion with ``availableNow`` and returns the sink read back; the
oracle computes the same result as a batch query."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.columns import money
from ..streaming import events as EV
from . import register
from .common import L

_ACC = "CASE event_type " + " ".join(f"WHEN '{t}' THEN '{a}'" for t, a in EV.EVENT_ACCOUNTS) + " END"
_AMT = "CAST(CAST(CAST(round(value * 100) AS BIGINT) AS DECIMAL(18, 0)) * CAST(0.01 AS DECIMAL(3, 2)) AS DECIMAL(12, 2))"
NOW = dt.datetime(2024, 2, 1, 0, 0, 0)


@register("stream_append", f"""
    SELECT {_ACC} AS account, COUNT(*) AS Postings, CAST(SUM({_AMT}) AS DECIMAL(18, 2)) AS Amount FROM events GROUP BY ALL""")
def q_stream_append(spark, sf):
    src, sink = EV.scratch(spark, "events"), EV.scratch(spark, "append-sink")
    EV.land_events(spark, sf, src, corrections=False)
    EV.stream_append(spark, src, sink, EV.scratch(spark, "append-ckpt"))
    out = spark.read.parquet(sink)
    return out.groupBy("account").agg(F.count(F.lit(1)).alias("Postings"), money(F.sum("amount")).alias("Amount"))


_MERGED = f"""
    SELECT {_ACC} AS account, COUNT(*) AS Postings,
           CAST(SUM(CAST(CAST(CAST(round(CASE WHEN event_id % {EV.CORRECTION_EVERY} = 0 THEN value + 1 ELSE value END * 100)
                AS BIGINT) AS DECIMAL(18, 0)) * CAST(0.01 AS DECIMAL(3, 2)) AS DECIMAL(12, 2))) AS DECIMAL(18, 2)) AS Amount
    FROM events GROUP BY ALL"""


def _by_account(df):
    return df.groupBy("account").agg(F.count(F.lit(1)).alias("Postings"), money(F.sum("amount")).alias("Amount"))


@register("stream_merge", _MERGED)
def q_stream_merge(spark, sf):
    src, root = EV.scratch(spark, "events"), EV.scratch(spark, "merge-target")
    EV.land_events(spark, sf, src, corrections=True)
    EV.stream_merge(spark, src, root, EV.scratch(spark, "merge-ckpt"), NOW)
    return _by_account(EV.merged(spark, root))


@register("stream_merge_disordered", _MERGED)
def q_stream_merge_disordered(spark, sf):
    """The corrections arrive first and are compacted; then all events, twice, the second
    time with a new checkpoint; then another compaction.  The table is the same."""
    early, src, root = EV.scratch(spark, "events"), EV.scratch(spark, "events"), EV.scratch(spark, "merge-target")
    EV.land_events(spark, sf, early, only=EV.SPLIT_FILES)
    EV.stream_merge(spark, early, root, EV.scratch(spark, "merge-ckpt"), NOW)
    EV.compact(spark, root, ["event_id"], "version")
    EV.land_events(spark, sf, src, corrections=False)
    for _ in range(2):
        EV.stream_merge(spark, src, root, EV.scratch(spark, "merge-ckpt"), NOW + dt.timedelta(days=1), files_per_batch=3)
    EV.compact(spark, root, ["event_id"], "version")
    return _by_account(EV.merged(spark, root))


@register("stream_flash", f"""
    SELECT CAST(ts AS DATE) AS Day, {_ACC} AS account, COUNT(*) AS Postings,
           CAST(CAST(SUM(CAST(round(value * 100) AS BIGINT)) AS DECIMAL(18, 0)) * CAST(0.01 AS DECIMAL(3, 2)) AS DECIMAL(18, 2)) AS Amount
    FROM events GROUP BY ALL""")
def q_stream_flash(spark, sf):
    src, sink, late = EV.scratch(spark, "events"), EV.scratch(spark, "flash-sink"), EV.scratch(spark, "flash-late")
    EV.land_events(spark, sf, src, corrections=False)
    EV.stream_flash(spark, src, sink, late, EV.scratch(spark, "flash-ckpt"))
    return EV.flash(spark, sink).select("Day", "account", "Postings",
                                        (F.col("cents").cast("decimal(18,0)") * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(18,2)").alias("Amount"))


@register("stream_late_rows", f"""
    SELECT e.event_id, e.ts, {_ACC} AS account, CAST(round(e.value * 100) AS BIGINT) AS cents
    FROM events e JOIN (SELECT b, max(h) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high
                        FROM (SELECT event_id % {EV.SPLIT_FILES} AS b, max(ts) AS h FROM events GROUP BY ALL)) m
      ON m.b = e.event_id % {EV.SPLIT_FILES}
    WHERE e.ts < m.high - INTERVAL 1 DAY""")
def q_stream_late_rows(spark, sf):
    """The folders land one after the other, each taken in by the stream as it comes: rows of a
    later folder that lie a day behind what was seen before are late."""
    src, sink, late, ckpt = (EV.scratch(spark, f"flash-{n}") for n in ("events", "sink", "late", "ckpt"))
    for folder in range(EV.SPLIT_FILES):
        EV.land_events(spark, sf, src, corrections=False, only=folder)
        EV.stream_flash(spark, src, sink, late, ckpt, files_per_batch=10_000)
    return EV.late_rows(spark, late)


@register("late_postings", """
    SELECT period AS BusinessPeriod, CAST(YJ_PDT // 100 AS INTEGER) AS PostingPeriod, COUNT(*) AS Legs,
           CAST(SUM(abs(YJ_AMT)) AS DECIMAL(18, 2)) AS GrossAmount
    FROM journal WHERE period < YJ_PDT // 100 GROUP BY ALL""")
def q_late_postings(spark, sf):
    j = L(spark, sf).journal
    pp = (F.col("YJ_PDT") / 100).cast("int")
    return j.where(F.col("period") < pp).groupBy(F.col("period").alias("BusinessPeriod"), pp.alias("PostingPeriod")).agg(
        F.count(F.lit(1)).alias("Legs"), money(F.sum(F.abs("YJ_AMT"))).alias("GrossAmount"))
