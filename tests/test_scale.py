"""What a query makes and moves: only the tables it reads, each row's work once."""

import datetime as dt
import shutil
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from conftest import SMOKE
from ledgerlake import catalog
from ledgerlake.functions import periods as PR
from ledgerlake.operators import ingest as IG
from ledgerlake.plans import quality as Q
from ledgerlake.sources import adapter, store, subledgers
from ledgerlake.sources.commits import present, write_bucketed
from ledgerlake.sources.schemas import JOURNAL_KEY

NOW = dt.datetime(2001, 3, 9)
TABLES = ["lineitem", "orders", "part", "supplier", "nation", "region", "customer", "events"]


@pytest.fixture
def fresh(tmp_path):
    """A source folder that no ledger was made of yet."""
    for t in TABLES:
        shutil.copyfile(f"{SMOKE}/{t}.parquet", tmp_path / f"{t}.parquet")
    return str(tmp_path)


def test_monthly_reports_make_no_journal(spark, fresh):
    root = store.source_root(spark, fresh)
    for key in ("consolidated_pnl", "rank_movers", "series_stats", "adhoc_select", "bucket_scan", "structured_balance_sheet"):
        catalog.REGISTRY[key].run(spark, fresh).collect()
        assert not present(spark, f"{root}/journal"), key
    assert present(spark, f"{root}/glcal")


def test_reports_of_the_pnl_view_make_no_journal(spark, fresh):
    root = store.source_root(spark, fresh)
    for key in ("rolling_12_pnl", "account_activity", "ytd_prior_ytd"):
        catalog.REGISTRY[key].run(spark, fresh).collect()
        assert present(spark, f"{root}/glcal") and not present(spark, f"{root}/journal"), key


def test_late_postings_make_the_journal_only(spark, fresh):
    root = store.source_root(spark, fresh)
    assert catalog.REGISTRY["late_postings"].run(spark, fresh).collect()
    assert present(spark, f"{root}/journal") and not present(spark, f"{root}/monthly") and not present(spark, f"{root}/glcal")


def test_parts_scan_makes_its_own_table_only(spark, fresh):
    root = store.source_root(spark, fresh)
    assert catalog.REGISTRY["scan_subledger"].run(spark, fresh).collect()
    assert present(spark, f"{root}/parthist") and not present(spark, f"{root}/monthly")


def test_journal_is_written_without_a_shuffle_of_its_legs(spark):
    plan = adapter.derive_journal(spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("Generate")]
    assert "Exchange" not in above and "Sort" not in above


def test_journal_is_stored_once_a_line_item(spark, fresh):
    """What the legs of a line item share is written once; readers get every leg."""
    led = store.ledger(spark, fresh)
    stored = spark.read.parquet(led.path("journal"))
    items = adapter.line_items(spark, fresh)
    first = items.where(F.col("l_linenumber") == 1).count()
    assert stored.count() == items.count() and first > 0
    assert led.journal.count() == 8 * items.count() + 2 * first


def test_legs_cost_only_the_columns_that_are_read(spark, fresh):
    plan = catalog.REGISTRY["late_postings"].run(spark, fresh)._jdf.queryExecution().optimizedPlan().toString()
    made = plan[:plan.index("Relation [")]
    assert "YJ_PDT" in made and "YJ_AMT" in made and "first" in made
    for unread in ("p_type", "o_orderpriority", "l_linestatus", "n_regionkey", "branch", "YJ_UID", "YJ_CRT"):
        assert unread not in made, unread


def test_entries_expand_into_the_legs_of_the_line_items(spark, tmp_path):
    """Written and read back; codes, dates and amounts that are null, lines that come twice."""
    day = dt.datetime(2001, 1, 31)
    rows = [(7, 5, 1, 10.0, 0.1, 0.05, "R", "F", day, "PROMO", 1, 33, "2-HIGH"), (7, 5, 1, 10.0, 0.1, 0.05, "R", "F", day, "PROMO", 1, 33, "2-HIGH"),
            (8, 17, 2, 20.0, None, 0.0, "N", None, None, None, None, None, None), (None, 3, None, None, 0.1, 0.1, None, "O", day, "x", 0, 1, "5-LOW")]
    items = spark.createDataFrame(rows, "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                                  "l_linestatus string, l_shipdate timestamp, p_type string, n_regionkey int, o_custkey bigint, o_orderpriority string")
    adapter.entries_from_line_items(items).write.parquet(f"{tmp_path}/entries")
    got = adapter.journal_from_entries(spark.read.parquet(f"{tmp_path}/entries")).collect()
    assert len(got) == 10 + 10 + 8 + 8
    own = sorted((r.leg, r.YJ_CO, r.YJ_CC, r.YJ_ACC, r.YJ_AMT) for r in got if r.YJ_JRL == "0007")
    amounts = [D("10"), D("-10"), D("7"), D("-7"), D("1"), D("-1"), D("0.5"), D("-0.5"), D("1"), D("-1")]
    places = [("02", "006", "10200"), ("02", "506", "35000"), ("02", "506", "45000"), ("02", "006", "12000"), ("02", "106", "51910"), ("02", "006", "10100"),
              ("02", "106", "55100"), ("02", "006", "16100"), ("02", "006", "27400"), ("01", "006", "27400")]
    want = [(n, *place, amount) for n, (place, amount) in enumerate(zip(places, amounts, strict=True), 1)]
    assert own == sorted(want * 2)
    assert {(r.YJ_DT, r.YJ_PDT, r.YJ_RDT, r.YJ_UID, r.YJ_CRT, r.period, r.YJ_DIV, r.YJ_DES) for r in got if r.YJ_JRL == "0007"} == {
        (20010131, 20010205, 10131, 200101310000000071, "USER33", 200101, "01", "")}
    blank = {r.leg: (r.YJ_CO, r.YJ_CC, r.YJ_ACC, r.YJ_AMT, r.period) for r in got if r.YJ_JRL == "0008"}
    assert blank[2] == (None, "201", "32000", D("-20"), None) and blank[5] == (None, "101", "58400", None, None) and blank[4][2] == "20350"


def test_monthly_is_the_journal_summed(spark, tmp_path):
    """Null amounts, null dates, repeated lines and a null line number included."""
    read = lambda t: spark.read.parquet(f"{SMOKE}/{t}.parquet")
    li = read("lineitem").limit(300).localCheckpoint()
    k = F.col("l_orderkey")
    odd = li.select(*[F.when(k % 5 == i, F.lit(None)).otherwise(F.col(c)).alias(c) if (i := {"l_extendedprice": 0, "l_shipdate": 1, "l_linenumber": 2, "l_tax": 3}.get(c)) is not None
                      else F.col(c) for c in li.columns])
    odd.unionByName(li).unionByName(li.limit(20)).write.parquet(f"{tmp_path}/lineitem.parquet")
    for t in ("orders", "part", "supplier", "nation"):
        read(t).write.parquet(f"{tmp_path}/{t}.parquet")
    rows = lambda df: {tuple(r)[:5]: r["s"] for r in df.groupBy(*JOURNAL_KEY, "period").agg(F.sum("YJ_AMT").alias("s")).collect()}
    want = rows(adapter.derive_journal(spark, str(tmp_path)))
    assert rows(adapter.derive_monthly(spark, str(tmp_path))) == want
    assert None in {key[4] for key in want} and len(want) > 100


def test_monthly_sums_line_items_before_they_become_legs(spark):
    """The legs are made of the sums by code, so none of the line items is expanded into legs."""
    plan = adapter.derive_monthly(spark, SMOKE)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate inline") == 1 and "Aggregate [" in plan[plan.index("Generate inline"):]


def test_legs_of_sums_are_the_legs_summed(spark):
    """Codes that are null or in no map, null amounts, negative cents and rows that come twice."""
    types, priorities, states = ["ECONOMY", "PROMO", "other", None], ["1-URGENT", "x", None], ["F", "O", "?", None]
    days = [dt.datetime(2001, 1, 31), dt.datetime(2001, 2, 1), None]
    rows = [(i, i % 11, i % 19, [1, 2, None][i % 3], None if i % 7 == 0 else i * 1.37 - 20, None if i % 13 == 0 else 0.07, 0.03, ["R", "N"][i % 2], states[i % 4],
             days[i // 3 % 3], types[i // 2 % 4], None if i % 17 == 0 else i % 5, i % 6, priorities[i // 5 % 3]) for i in range(240)]
    items = spark.createDataFrame(rows + rows[:50], "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double, l_discount double, l_tax double, "
                                  "l_returnflag string, l_linestatus string, l_shipdate timestamp, p_type string, n_regionkey int, o_custkey bigint, o_orderpriority string")
    key = ["YJ_CO", "YJ_CC", "YJ_ACC", "period"]
    total = lambda df: sorted(map(repr, df.groupBy(*key).agg(F.sum("cents").alias("cents")).collect()))
    cents = adapter.line_items_in_cents(items)
    want = total(adapter.legs(cents, "period"))
    assert total(adapter.legs(adapter.sums_by_code(cents), "period", by_code=True)) == want and len(want) > 300
    assert adapter.legs(cents, "period").count() == sum(10 if r[3] == 1 else 8 for r in rows + rows[:50])


def test_texts_of_days_are_parsed_after_they_are_counted(spark):
    plan = catalog.REGISTRY["parse_period"].run(spark, SMOKE)._jdf.queryExecution().optimizedPlan().toString()
    matching = [line.strip() for line in plan.split("\n") if "regexp_extract" in line]
    assert len(matching) == 1 and matching[0].startswith("+- Aggregate [YJ_DT#")


def test_a_period_text_is_matched_once_a_group(spark):
    texts = ["2001-02", "200102", "2001-02-28", "2001-13", "200100", "189912", "210001", " 200102", "+200102", "20010", "x", "", None, "209912", "2001-2"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", PR.parse_period_col(F.col("t")).alias("p"))
    got = {r.t: r.p for r in df.collect()}
    assert {t: p for t, p in got.items() if p} == {"2001-02": 200102, "200102": 200102, "2001-02-28": 200102, "209912": 209912}
    assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract(") == 2


def test_duplicate_keys_dealt_by_id(spark):
    rows = [(1, "a", D(1)), (1, "a", D(1)), (1, "b", D(1)), (2, "a", None), (2, "a", None), (None, "a", D(1)), (None, "a", D(1)), (None, "b", D(2)), (None, None, None)]
    df = spark.createDataFrame(rows, "u bigint, c string, v decimal(12,2)")
    want = Q.duplicate_keys(df, ["u", "c", "v"]).first()
    got = Q.duplicate_keys(df, ["u", "c", "v"], near="u")
    assert got.first() == want and (want.Rows, want.DistinctKeys, want.DuplicateRows) == (9, 6, 3)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2  # one for the rows, one for the sum


def test_sub_ledgers_share_their_items(spark, fresh):
    for name in subledgers.SUBLEDGERS:
        plan = subledgers.derive(spark, fresh, name)._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Window" not in plan, name


STAGED = "k bigint, s string, v decimal(12,2)"


def _version(spark, rows):
    return spark.createDataFrame(rows, STAGED).select("*", IG.ts(NOW).alias(IG.ADDED), IG.ts(NOW).alias(IG.MODIFIED), F.lit("r0").alias(IG.RUN))


def _moves(df):
    return df._jdf.queryExecution().executedPlan().toString().count("ENSURE_REQUIREMENTS")


def test_a_merge_deals_each_side_once(spark, tmp_path):
    """The check of the staged keys included; a target in buckets and rows dealt alike aren't dealt again."""
    rows = [(k, f"s{k}", D(k)) for k in range(40)]
    _version(spark, rows).write.parquet(f"{tmp_path}/plain")
    staged = spark.createDataFrame([(k, s, v + k % 2) for k, s, v in rows[20:]] + [(99, "new", D(1))], STAGED)
    plain = IG._merged(spark.read.parquet(f"{tmp_path}/plain"), staged, ["k"], "r1", NOW)
    assert _moves(plain) == 2
    dealt = staged.repartition(8, "k").persist()
    bucketed = write_bucketed(_version(spark, rows).repartition(8, "k"), f"{tmp_path}/bucketed", ["k"], 8)
    assert dealt.count() == 21  # the deal of cached rows is known once they are there
    merged = IG._merged(bucketed, dealt, ["k"], "r1", NOW)
    assert _moves(merged) == 0
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, plain.collect()))
    dealt.unpersist()
    assert spark.read.parquet(f"{tmp_path}/bucketed").count() == 40 and not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


def test_refused_staging_leaves_no_files(spark, tmp_path):
    root = str(tmp_path / "t")
    IG.write_version(_version(spark, [(1, "a", D(1))]), root, "r0")
    for bad, says in (([(1, "x", None), (1, "y", None), (1, "z", None)], "2 duplicate key"), ([(None, "x", None), (None, "x", None), (2, "b", D(2)), (2, "b", D(2))], "2 row.s. with a NULL key")):
        with pytest.raises(ValueError, match=says):
            IG.merge_into(spark, root, spark.createDataFrame(bad, STAGED), ["k"], "r1", NOW)
    assert not list(tmp_path.glob("t/v=r1/**/*.parquet")) and IG.read_current(spark, root).count() == 1
    assert IG.merge_into(spark, root, spark.createDataFrame([(1, "a", D(2)), (2, "b", None)], STAGED), ["k"], "r1", NOW) == {"RowsInserted": 1, "RowsUpdated": 1}


def test_sub_ledger_merges_on_its_dealt_rows(spark, fresh, tmp_path):
    """A second call on the same folder finds the run committed, and reads the target by its path."""
    from ledgerlake.plans import loads as LD
    kept = lambda: set(dict(spark.sparkContext._jsc.getPersistentRDDs()))
    before = kept()
    counts = LD.merge_subledger(spark, fresh, "PARTHIST", str(tmp_path / "m"))
    stored = subledgers.stored_subledger(spark, fresh, "PARTHIST")
    assert IG.read_current(spark, str(tmp_path / "m")).count() == stored.count()
    assert counts["RowsInserted"] > 0 and counts["RowsUpdated"] > 0
    assert LD.merge_subledger(spark, fresh, "PARTHIST", str(tmp_path / "m")) == {"RowsInserted": 0, "RowsUpdated": 0}
    assert not kept() - before
