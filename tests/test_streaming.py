"""Streaming behaviour beyond the totals the oracle checks."""

import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import SMOKE
from ledgerlake.operators import ingest as IG
from ledgerlake.sources.adapter import read_source
from ledgerlake.streaming import events as EV


def test_flash_keeps_late_rows_and_records_them(spark):
    src, sink, late = EV.scratch(spark, "t-events"), EV.scratch(spark, "t-flash"), EV.scratch(spark, "t-late")
    EV.land_events(spark, SMOKE, src, corrections=False)
    EV.stream_flash(spark, src, sink, late, EV.scratch(spark, "t-ckpt"))
    total = EV.flash(spark, sink).agg(F.sum("Postings"), F.sum("LatePostings")).first()
    assert total[0] == read_source(spark, SMOKE, "events").count()  # nothing dropped
    assert total[1] == EV.late_rows(spark, late).count() > 0  # out-of-order files do produce late rows


def _rows(df):
    return sorted((r.event_id, r.version, r.amount) for r in df.collect())


def test_stream_merge_does_not_depend_on_order_replay_or_compaction(spark):
    now = dt.datetime(2024, 2, 1)
    src, early, a, b = (EV.scratch(spark, f"t-{n}") for n in ("events", "early", "a", "b"))
    EV.land_events(spark, SMOKE, src, corrections=True)
    EV.stream_merge(spark, src, a, EV.scratch(spark, "t-ckpt"), now)
    first = EV.merged(spark, a)
    assert first.count() == read_source(spark, SMOKE, "events").count()
    EV.land_events(spark, SMOKE, early, only=EV.SPLIT_FILES)
    EV.stream_merge(spark, early, b, EV.scratch(spark, "t-ckpt"), now)
    EV.compact(spark, b, ["event_id"], "version")
    files = set(os.listdir(f"{b}/log"))
    EV.stream_merge(spark, src, b, EV.scratch(spark, "t-ckpt"), now + dt.timedelta(hours=1), files_per_batch=4)
    assert files <= set(os.listdir(f"{b}/log"))  # nothing that was written is rewritten
    assert _rows(EV.merged(spark, b)) == _rows(first)
    EV.compact(spark, b, ["event_id"], "version")
    assert _rows(EV.merged(spark, b)) == _rows(first)
    corrected = EV.merged(spark, b).where("version = 1").agg(F.max(IG.MODIFIED), F.min(IG.ADDED)).first()
    assert corrected[0] == now  # the older rows that came later are no change


def test_latest_rows_of_a_log(spark):
    t = [dt.datetime(2024, 1, d) for d in range(1, 6)]
    log = spark.createDataFrame(
        [(1, 0, "x", t[0], t[0], "a"), (1, 1, "y", t[1], t[1], "b"), (1, 1, "y", t[3], t[3], "d"), (1, 2, "y", t[2], t[2], "c"),
         (2, 5, None, t[0], t[0], "a"), (2, 6, "", t[1], t[1], "b")],
        f"k int, version int, s string, {IG.ADDED} timestamp_ntz, {IG.MODIFIED} timestamp_ntz, {IG.RUN} string")
    got = {r.k: (r.version, r.s, r[IG.ADDED], r[IG.MODIFIED], r[IG.RUN]) for r in EV.latest_rows(log, ["k"], "version").collect()}
    assert got == {1: (2, "y", t[0], t[1], "b"), 2: (6, "", t[0], t[0], "a")}  # a repeated value is no change
