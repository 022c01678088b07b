"""Operators on hand-made rows: the edge cases of FIXTURES F6."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import periods as PR
from ledgerlake.functions.columns import pad_code, safe_pct
from ledgerlake.operators import ingest as IG
from ledgerlake.operators import windows as WN
from ledgerlake.plans.statements import account_search

# --------------------------------------------------------------------------- periods

@pytest.mark.parametrize("text,expected", [
    ("2025-04", 202504), ("2025-04-30", 202504), ("202504", 202504), (202504, 202504), (" 2025-04 ", 202504),
])
def test_parse_period_accepts(text, expected):
    assert PR.parse_period(text) == expected


@pytest.mark.parametrize("bad", ["2025-13", "189912", 189912, "2025/04", "", "Q1 2025", 210001])
def test_parse_period_rejects(bad):
    with pytest.raises(ValueError):
        PR.parse_period(bad)


def test_period_range_rejects_reversed():
    with pytest.raises(ValueError):
        PR.period_range("2025-05", "2025-04")
    assert PR.period_range(None, "2025-04") == (None, 202504)


def test_period_keywords():
    assert PR.period_keyword("Q1 2025") == [202501, 202502, 202503]
    assert PR.period_keyword("q4 2000") == [200010, 200011, 200012]
    assert PR.period_keyword("YTD", latest_period=200103) == [200101, 200102, 200103]


def test_parse_period_column_form(spark):
    rows = spark.createDataFrame([("2025-04",), ("2025-04-30",), ("202504",), ("2025-13",), ("189912",), ("x",)], "t string")
    got = [r[0] for r in rows.select(PR.parse_period_col(F.col("t"))).collect()]
    assert got == [202504, 202504, 202504, None, None, None]


def test_month_index_round_trip(spark):
    df = spark.createDataFrame([(200012,), (200101,), (199512,)], "p int")
    r = df.select(PR.shift_period(F.col("p"), 1).alias("n"), PR.shift_period(F.col("p"), -12).alias("y")).collect()
    assert [(x.n, x.y) for x in r] == [(200101, 199912), (200102, 200001), (199601, 199412)]


def test_pad_code_never_truncates():
    assert pad_code(" 1 ", 2) == "01"
    assert pad_code("123", 2) == "123"
    assert pad_code("", 2) is None


# --------------------------------------------------------------------------- percent, gaps

def test_percent_change_zero_and_negative_base(spark):
    df = spark.createDataFrame([(Decimal("10.00"), Decimal("0.00")), (Decimal("-5.00"), Decimal("-10.00")),
                                (Decimal("5.00"), None)], "n decimal(18,2), b decimal(18,2)")
    got = [r[0] for r in df.select(safe_pct(F.col("n"), F.col("b"))).collect()]
    assert got == [None, -50.0, None]


def test_missing_month_is_a_gap_not_a_lag(spark):
    df = spark.createDataFrame([("A", 200011, Decimal("1.00")), ("A", 200101, Decimal("3.00"))],
                               "k string, p int, a decimal(18,2)")
    gaps = WN.period_gaps(df, ["k"], "p").collect()
    assert [(g.GapFrom, g.GapTo, g.MissingMonths) for g in gaps] == [(200012, 200012, 1)]
    grid = WN.dense_grid(df, ["k"], "p", "a").orderBy("p").collect()
    assert [(r.p, r.a) for r in grid] == [(200011, Decimal("1.00")), (200012, Decimal("0.00")), (200101, Decimal("3.00"))]
    mom = WN.mom_variance(WN.dense_grid(df, ["k"], "p", "a"), ["k"], "p", "a").orderBy("p").collect()
    assert [r.PriorAmount for r in mom] == [None, Decimal("1.00"), Decimal("0.00")]


# --------------------------------------------------------------------------- search

def test_search_is_literal_and_case_insensitive(spark):
    acc = spark.createDataFrame([("01", "10100", "Cash 100% owned", "1", ""), ("01", "20100", "Cash_pool", "1", ""),
                                 ("01", "30100", "Sales", "2", "")],
                                "ACCO string, ACACC string, ACNME string, ACTYP string, ACSTA string")
    assert [r.Account for r in account_search(acc, "100%").collect()] == ["10100"]
    assert [r.Account for r in account_search(acc, "h_p").collect()] == ["20100"]
    assert [r.Account for r in account_search(acc, "CASH").collect()] == ["10100", "20100"]
    assert [r.Account for r in account_search(acc, "301").collect()] == ["30100"]
    assert account_search(acc, "", limit=0).count() == 1  # limit clamped to 1..100


# --------------------------------------------------------------------------- merge

T0 = dt.datetime(2001, 1, 1)
T1 = dt.datetime(2001, 1, 2, 10)
SCHEMA_T = "k bigint, s string, n decimal(10,2), DateAddedUtc timestamp_ntz, DateModifiedUtc timestamp_ntz, LastRunId string"
SCHEMA_S = "k bigint, s string, n decimal(10,2)"


def _target(spark, rows):
    return spark.createDataFrame([(k, s, n, T0, T0, "r0") for k, s, n in rows], SCHEMA_T)


def test_merge_null_equals_blank_and_zero(spark):
    tgt = _target(spark, [(1, "", Decimal("0")), (2, "a", Decimal("1")), (3, "b", Decimal("2"))])
    stg = spark.createDataFrame([(1, None, None), (2, "a", Decimal("1.5")), (4, "z", Decimal("9"))], SCHEMA_S)
    m = {r.k: r for r in IG.merge_upsert(tgt, stg, ["k"], "r1", T1).collect()}
    assert m[1].MergeAction == "UNCHANGED" and m[1].s == "" and m[1].DateModifiedUtc == T0
    assert m[2].MergeAction == "UPDATE" and m[2].n == Decimal("1.5") and m[2].DateModifiedUtc == T1
    assert m[2].DateAddedUtc == T0 and m[2].LastRunId == "r1"
    assert m[3].MergeAction == "KEPT"  # never deleted
    assert m[4].MergeAction == "INSERT" and m[4].DateAddedUtc == T1 == m[4].DateModifiedUtc
    counts = IG.merge_actions(IG.merge_upsert(tgt, stg, ["k"], "r1", T1)).first()
    assert (counts.RowsInserted, counts.RowsUpdated) == (1, 1)


def test_merge_rejects_null_and_duplicate_keys(spark):
    tgt = _target(spark, [(1, "a", Decimal("1"))])
    with pytest.raises(ValueError, match="NULL key"):
        IG.merge_upsert(tgt, spark.createDataFrame([(None, "a", Decimal("1"))], SCHEMA_S), ["k"], "r", T1)
    with pytest.raises(ValueError, match="duplicate"):
        IG.merge_upsert(tgt, spark.createDataFrame([(2, "a", Decimal("1")), (2, "b", Decimal("1"))], SCHEMA_S), ["k"], "r", T1)


def test_merge_twice_changes_nothing_and_matches_a_dict_model(spark):
    rnd = random.Random(7)
    target = {k: (rnd.choice(["", "a", "b", None]), Decimal(rnd.randint(0, 3))) for k in range(60)}
    staged = {k: (rnd.choice(["", "a", "b", None]), rnd.choice([None, Decimal(rnd.randint(0, 3))]))
              for k in rnd.sample(range(30, 100), 50)}
    tgt = _target(spark, [(k, s, n) for k, (s, n) in target.items()])
    stg = spark.createDataFrame([(k, s, n) for k, (s, n) in staged.items()], SCHEMA_S)
    once = IG.merge_upsert(tgt, stg, ["k"], "r1", T1).drop("MergeAction")
    rows = {r.k: r for r in once.collect()}
    # plain-Python model of the merge
    for k in set(target) | set(staged):
        if k not in staged:
            exp = target[k] + ("r0",)
        elif k not in target:
            exp = staged[k] + ("r1",)
        else:
            (ts_, tn), (ss, sn) = target[k], staged[k]
            changed = (ts_ or "") != (ss or "") or (tn or 0) != (sn or 0)
            exp = (staged[k] + ("r1",)) if changed else (target[k] + ("r0",))
        r = rows[k]
        assert (r.s, r.n, r.LastRunId) == exp, k
    twice = IG.merge_upsert(once, stg, ["k"], "r2", dt.datetime(2001, 1, 3))
    assert twice.where("MergeAction IN ('INSERT', 'UPDATE')").count() == 0


# --------------------------------------------------------------------------- snapshots

def test_snapshot_eastern_day_and_same_day_insert_then_update(spark):
    # 2001-03-11 04:30 UTC is still 2001-03-10 in New York (EST, UTC-5)
    now1, now2 = dt.datetime(2001, 3, 10, 20, 0), dt.datetime(2001, 3, 11, 4, 30)
    prev = dt.datetime(2001, 3, 10, 12, 0)
    cur1 = spark.createDataFrame([(1, "a", Decimal("1"), dt.datetime(2001, 3, 10, 13), dt.datetime(2001, 3, 10, 13), "r1"),
                                  (2, "b", Decimal("1"), T0, prev, "r0")], SCHEMA_T)
    c1 = IG.capture_snapshot(cur1, prev, now1, "cap-1")
    kinds = {r.k: (r.ChangeKind, r.SnapshotDate) for r in c1.collect()}
    assert kinds == {1: ("I", dt.date(2001, 3, 10))}  # key 2 exactly on the lower watermark: excluded
    cur2 = spark.createDataFrame([(1, "a2", Decimal("1"), dt.datetime(2001, 3, 10, 13), now2, "r2")], SCHEMA_T)
    c2 = IG.capture_snapshot(cur2, now1, now2, "cap-2")  # change exactly on the upper watermark: included
    snap = IG.snapshot_view(c1.unionByName(c2), ["k"]).collect()
    assert [(r.k, r.s, r.ChangeKind, r.SnapshotDate) for r in snap] == [(1, "a2", "U", dt.date(2001, 3, 10))]


def test_eastern_day_across_daylight_saving(spark):
    df = spark.createDataFrame([(dt.datetime(2001, 4, 1, 4, 30),), (dt.datetime(2001, 4, 1, 6, 59),),
                                (dt.datetime(2001, 4, 2, 3, 59),), (dt.datetime(2001, 4, 2, 4, 0),)], "t timestamp_ntz")
    got = [r[0] for r in df.select(IG.eastern_date(F.col("t"))).collect()]
    # EST (UTC-5) until 2001-04-01 07:00 UTC, then EDT (UTC-4)
    assert got == [dt.date(2001, 3, 31), dt.date(2001, 4, 1), dt.date(2001, 4, 1), dt.date(2001, 4, 2)]


def test_as_of_before_first_capture_has_no_row(spark):
    from ledgerlake.operators.joins import snapshot_as_of
    snap = spark.createDataFrame([(1, dt.date(2001, 3, 10), "a")], "k bigint, SnapshotDate date, v string")
    assert snapshot_as_of(snap, ["k"], dt.date(2001, 3, 9)).count() == 0
    assert snapshot_as_of(snap, ["k"], dt.date(2001, 3, 10)).count() == 1


def test_watermark_rules(spark):
    from pyspark.sql import Row
    runs = spark.createDataFrame([
        Row(RunId="a", TableName="journal", Status="COMPLETE", WatermarkTo=10),
        Row(RunId="b", TableName="journal", Status="COMPLETE", WatermarkTo=None),
        Row(RunId="c", TableName="journal", Status="FAILED", WatermarkTo=99),
    ], "RunId string, TableName string, Status string, WatermarkTo bigint")
    assert IG.choose_watermark(runs, "journal", "INCREMENTAL").first().WatermarkFrom == 10
    assert IG.choose_watermark(runs, "glcal", "INCREMENTAL").first().WatermarkFrom == 0
    assert IG.choose_watermark(runs, "journal", "INITIAL").first().WatermarkFrom == 0
    assert IG.choose_watermark(runs, "journal", "FULL_RELOAD").first().WatermarkFrom is None
    with pytest.raises(ValueError):
        IG.choose_watermark(runs, "journal", "SOMETIMES")


def test_advance_watermark_requires_control_row(spark):
    control = spark.createDataFrame([("orders", T0, None, None)], "TableName string, LastCapturedThroughUtc timestamp_ntz, "
                                    "LastSnapshotRunUtc timestamp_ntz, LastRowsCaptured bigint")
    out = IG.advance_snapshot_watermark(control, "orders", T1, T1, 5).first()
    assert (out.LastCapturedThroughUtc, out.LastRowsCaptured) == (T1, 5)
    with pytest.raises(ValueError):
        IG.advance_snapshot_watermark(control, "journal", T1, T1, 5)


# --------------------------------------------------------------------------- guarded runs

def test_guarded_runs_advance_the_watermark_only_when_complete(spark, led):
    from ledgerlake.streaming.events import scratch
    log, target = scratch(spark, "t-runlog"), scratch(spark, "t-journal")
    ticks = iter(dt.datetime(2001, 3, 1, 3, m) for m in range(60))
    clock = lambda: next(ticks)
    split = 200101010000000000
    j = led.journal

    def initial(wm):
        assert wm == 0
        return IG.append_journal(j.where(F.col("YJ_UID") <= split), target, run_id="r1")

    def incremental(wm):
        assert wm is not None and wm <= split
        IG.append_journal(j.where(F.col("YJ_UID") > wm), target, run_id="r2")
        return IG.append_journal(j.where(F.col("YJ_UID") > wm), target, run_id="r2")  # a retry adds nothing

    def broken(wm):
        raise RuntimeError("source unreachable")

    IG.execute_run(spark, log, "journal", "INITIAL", "r1", initial, clock, ["journal"])
    IG.execute_run(spark, log, "journal", "INCREMENTAL", "r2", incremental, clock, ["journal"])
    with pytest.raises(RuntimeError, match="unreachable"):
        IG.execute_run(spark, log, "journal", "INCREMENTAL", "r3", broken, clock, ["journal"])
    runs = {r.RunId: r for r in IG.run_log_view(spark.read.parquet(log)).collect()}
    assert [runs[k].Status for k in ("r1", "r2", "r3")] == ["COMPLETE", "COMPLETE", "FAILED"]
    assert "unreachable" in runs["r3"].ErrorMessage
    max_uid = j.agg(F.max("YJ_UID")).first()[0]
    assert runs["r2"].WatermarkTo == max_uid and runs["r3"].WatermarkFrom == max_uid
    assert spark.read.parquet(target).count() == j.count()
    with pytest.raises(ValueError):
        IG.execute_run(spark, log, "glcal", "INCREMENTAL", "r4", initial, clock, ["journal"])


def test_adhoc_select_is_read_only_and_capped(spark, led):
    from ledgerlake.plans.statements import adhoc_select
    from pyspark.errors import AnalysisException, ParseException
    cut = adhoc_select(led, "SELECT GB_CO FROM glcal", limit=5).collect()
    assert len(cut) == 5 and all(r.Truncated for r in cut)
    whole = adhoc_select(led, "SELECT 1 AS x", limit=0).collect()
    assert [tuple(r) for r in whole] == [(1, False)]
    assert adhoc_select(led, "WITH a AS (SELECT Period FROM v_IncomeStatementLines) SELECT * FROM a", 99_999).count() <= 10_000
    for bad in ("DROP VIEW glcal", "INSERT INTO x SELECT 1", "SELECT 1; DROP VIEW glcal", "  ",
                "WITH a AS (SELECT 1 AS x) INSERT OVERWRITE DIRECTORY '/tmp/never' USING parquet SELECT * FROM a",
                "FROM glcal INSERT OVERWRITE DIRECTORY '/tmp/never' USING parquet SELECT GB_CO",
                "SELECT * FROM parquet.`/root/testdata/sf0.001/nation.parquet`"):
        with pytest.raises((AnalysisException, ParseException)):
            adhoc_select(led, bad)


def test_departments_outside_the_named_ones_are_in_other(spark, led):
    from ledgerlake.plans import reports as RP
    from ledgerlake.plans.statements import income_statement_lines
    li = income_statement_lines(led.glcal, led.accmast)
    period = li.agg(F.max("Period")).first()[0]
    moved = li.withColumn("Department", F.when(F.col("Department") == "1", F.lit("0"))
                          .when(F.col("Department") == "5", F.lit(None).cast("string")).otherwise(F.col("Department")))
    total = lambda x: {(r.Line, r.Measure): r.Total for r in RP.departmental_pnl(x, period).where("Measure <> 'PctOfRevenue'").collect()}
    assert total(moved) == total(li)
    assert any(r.Other for r in RP.departmental_pnl(moved, period).collect())


def test_dense_grid_ends_before_the_last_posting(spark):
    from ledgerlake.operators.windows import dense_grid
    m = spark.createDataFrame([("a", 200101, 5), ("a", 200103, 7), ("a", 200105, 9)], "k string, period int, activity int")
    got = [(r.period, int(r.activity)) for r in dense_grid(m, ["k"], "period", "activity", 200104).orderBy("period").collect()]
    assert got == [(200101, 5), (200102, 0), (200103, 7), (200104, 0)]


# --------------------------------------------------------------------------- scale helpers

def test_cluster_settings_scale_with_input_and_cluster():
    from ledgerlake.session import cluster_settings
    small = cluster_settings(10 << 30, executors=10, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 120  # three waves of 40 slots
    big = cluster_settings(100 << 40, executors=1000, cores_per_executor=8)
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)  # ~256 MB per partition
    assert big["spark.sql.adaptive.enabled"] == "true" and big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_cached_view_is_released(spark, led):
    from ledgerlake.plans.statements import cached, income_statement, income_statement_lines
    with cached(income_statement_lines(led.glcal, led.accmast)) as lines:
        assert lines.is_cached
        a = income_statement(lines, 200102).collect()
        b = income_statement(lines, 200102, detail="by_account").count()
    assert not lines.is_cached and a and b


def test_versioned_merge_commit_and_date_floor(spark):
    from ledgerlake.streaming.events import scratch
    root = scratch(spark, "t-versioned")
    tgt = _target(spark, [(1, "a", Decimal("1")), (2, "b", Decimal("2"))])
    stg = spark.createDataFrame([(2, "c", Decimal("2")), (3, "d", Decimal("3"))], SCHEMA_S)
    IG.write_version(tgt.withColumn("MergeAction", F.lit("KEPT")), root, "r0")
    merged = IG.merge_upsert(IG.read_current(spark, root), stg, ["k"], "r1", T1)
    IG.write_version(merged, root, "r1")
    cur = {r.k: r.s for r in IG.read_current(spark, root).collect()}
    assert cur == {1: "a", 2: "c", 3: "d"}
    assert IG.read_version(spark, root, "r0").count() == 2  # the old version stays readable
    with pytest.raises(ValueError, match="committed already"):  # a retry of a committed run loses nothing
        IG.write_version(IG.read_current(spark, root), root, "r1")
    assert IG.read_current(spark, root).count() == 3
    snap = IG.capture_snapshot(IG.read_current(spark, root), T0, T1, "cap", date_floor=T1)
    assert sorted(r.k for r in snap.collect()) == [2, 3]


def test_asset_flag_wins_over_the_section_rule(spark):
    from ledgerlake.plans.statements import flag_side
    df = spark.createDataFrame([("20150", "A", "BL"), ("20350", "L", "BL"), ("19999", "", "BA"), ("18888", None, None)],
                               "acc string, ACLIA string, Statement string")
    assert [r.Statement for r in flag_side(df).orderBy("acc").collect()] == [None, "BA", "BA", "BL"]


def test_section_rules_exact_first_then_longest_prefix(spark):
    from ledgerlake.functions.sections import classify_section
    df = spark.createDataFrame([("31001",), ("15500",), ("15999",), ("19000",), ("77777",)], "acc string")
    prefix = [("1", "BA", "Other assets", 90), ("155", "BA", "Equipment", 45), ("15", "BA", "Fixed assets", 40)]
    got = {r.acc: (r.Section, r.SectionOrder) for r in classify_section(df, "acc", prefix_rules=prefix).collect()}
    assert got["31001"] == ("Equipment revenue", 10)       # exact rule from the fixed table
    assert got["15500"] == ("Equipment", 45)               # longest prefix wins
    assert got["15999"] == ("Fixed assets", 40)
    assert got["19000"] == ("Other assets", 90)
    assert got["77777"] == (None, None)                    # unclassified stays NULL, never guessed
