"""Versions, runs and snapshots under writers that race, fail and repeat."""

import datetime as dt
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import ingest as IG
from ledgerlake.sources import commits as CM

T0 = dt.datetime(2001, 3, 1)
NOW = dt.datetime(2001, 3, 2)


def _target(spark, n=40):
    return spark.range(n).select(F.col("id").alias("k"), F.lit("a").alias("s"), IG.ts(T0).alias(IG.ADDED), IG.ts(T0).alias(IG.MODIFIED),
                                 F.lit("r0").alias(IG.RUN))


def test_of_two_writers_that_read_the_same_version_one_commits(spark, tmp_path):
    root = str(tmp_path / "t")
    IG.write_version(_target(spark), root, "r0")
    at = CM.commits(spark, root)[-1].seq
    gate = threading.Barrier(4)

    def write(i):
        path = CM.write_files(_target(spark, i + 1), root, f"w{i}")
        gate.wait()
        try:
            return CM.commit(spark, root, f"w{i}", path, at)
        except CM.CommitConflict:
            return None
    with ThreadPoolExecutor(4) as pool:
        won = [c for c in pool.map(write, range(4)) if c]
    assert len(won) == 1 and [c.seq for c in CM.commits(spark, root)] == [0, 1]
    assert IG.read_current(spark, root).count() == int(won[0].version[1:]) + 1
    assert not [f for f in (tmp_path / "t" / "_commits").iterdir() if f.suffix != ".json" and not f.name.endswith(".crc")]


def test_concurrent_merges_lose_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    IG.write_version(_target(spark), root, "r0")
    staged = spark.range(60).select(F.col("id").alias("k"), F.lit("b").alias("s"))
    with ThreadPoolExecutor(4) as pool:
        counts = list(pool.map(lambda i: IG.merge_into(spark, root, staged.where(F.col("k") % 4 == i), ["k"], f"m{i}", NOW, 20), range(4)))
    assert sum(c["RowsInserted"] for c in counts) == 20 and sum(c["RowsUpdated"] for c in counts) == 40
    got = {r.k: (r.s, r[IG.RUN]) for r in IG.read_current(spark, root).collect()}
    assert got == {k: ("b", f"m{k % 4}") for k in range(60)}
    assert len(CM.commits(spark, root)) == 5
    assert IG.merge_into(spark, root, staged, ["k"], "m1", NOW) == {"RowsInserted": 0, "RowsUpdated": 0}  # a repeated run
    assert len(CM.commits(spark, root)) == 5
    assert IG.read_version(spark, root, "r0").count() == 40


def test_a_writer_that_stops_before_its_commit_leaves_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    IG.write_version(_target(spark), root, "r0")
    CM.write_files(_target(spark, 3), root, "lost")
    assert IG.read_current(spark, root).count() == 40
    with pytest.raises(ValueError, match="duplicate key"):
        IG.merge_into(spark, root, spark.createDataFrame([(1, "x"), (1, "y")], "k bigint, s string"), ["k"], "r1", NOW)
    with pytest.raises(CM.CommitConflict):
        IG.write_version(_target(spark), root, "stale", after=-1)
    with pytest.raises(ValueError, match="no version"):
        IG.merge_into(spark, str(tmp_path / "none"), spark.createDataFrame([(1, "x")], "k bigint, s string"), ["k"], "r1", NOW)


def test_appends_need_a_run_and_are_seen_only_when_it_is_complete(spark, tmp_path):
    rows = spark.createDataFrame([(1, 200101), (2, 200101), (3, 200102)], "YJ_UID bigint, period int")
    path, log = str(tmp_path / "j"), str(tmp_path / "log")
    with pytest.raises(TypeError):
        IG.append_journal(rows, path)
    with pytest.raises(ValueError):
        IG.append_journal(rows, path, "")
    ticks = iter(dt.datetime(2001, 3, 1, h) for h in range(24))
    run = lambda rid, load: IG.execute_run(spark, log, "journal", "INCREMENTAL", rid, load, lambda: next(ticks), ["journal"])

    def fails(watermark):
        IG.append_journal(rows, path, "a")
        raise OSError("lost after the write")
    with pytest.raises(OSError):
        run("a", fails)
    assert spark.read.parquet(path).count() == 3
    assert IG.visible(spark.read.parquet(path), IG.read_runs(spark, log)).count() == 0
    run("b", lambda w: IG.append_journal(rows.where(F.col("YJ_UID") <= 2), path, "b"))
    run("c", lambda w: IG.append_journal(rows.where(F.col("YJ_UID") > w), path, "c"))
    seen = IG.visible(spark.read.parquet(path), IG.read_runs(spark, log)).collect()
    assert sorted((r.YJ_UID, r.run) for r in seen) == [(1, "b"), (2, "b"), (3, "c")]


def test_intervals_hold_the_last_capture_of_a_day(spark):
    d, at = dt.date, dt.datetime
    log = spark.createDataFrame(
        [(1, d(2001, 1, 1), at(2001, 1, 1, 8), "c1", 10), (1, d(2001, 1, 1), at(2001, 1, 1, 9), "c2", 11),
         (1, d(2001, 1, 5), at(2001, 1, 5, 8), "c3", 12), (2, d(2001, 1, 2), at(2001, 1, 2, 8), "c2", 20)],
        "k int, SnapshotDate date, SnapshotCapturedUtc timestamp_ntz, CaptureRunId string, v int")
    held = IG.validity_intervals(log, ["k"])
    assert {(r.k, r.v): r.ValidTo for r in held.collect()} == {(1, 11): d(2001, 1, 5), (1, 12): None, (2, 20): None}
    assert {(r.k, r.v) for r in IG.as_of(held, d(2001, 1, 4)).collect()} == {(1, 11), (2, 20)}
    assert IG.as_of(held, d(2000, 12, 31)).count() == 0
    asked = spark.createDataFrame([(1, d(2001, 1, 5)), (1, d(2001, 1, 1)), (2, d(2001, 1, 1)), (3, d(2001, 1, 9))], "k int, day date")
    got = {(r.k, r.day): r.v for r in IG.as_of_lookup(asked, held, ["k"], "day").collect()}
    assert got == {(1, d(2001, 1, 5)): 12, (1, d(2001, 1, 1)): 11, (2, d(2001, 1, 1)): None, (3, d(2001, 1, 9)): None}
