"""Group reports, metrics and receivables on small tables worked out by hand."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerlake import catalog, fixed
from ledgerlake.operators import rollups
from ledgerlake.plans import extensions as EX
from ledgerlake.plans import reports as rp
from ledgerlake.plans import statements as st


def test_netting_by_pair_and_what_does_not_net(spark):
    legs = [(1, "02", "27400", 10), (1, "01", "27400", -10), (2, "01", "27400", 4), (2, "03", "27400", -4), (3, "03", "27400", 6), (3, "01", "27400", -6),
            (4, "02", "27400", 9), (5, "01", "27400", 5), (5, "01", "27400", -5), (6, "02", "31001", 99), (7, "02", "27400", 0)]
    j = spark.createDataFrame([(u, c, a, D(v), 200101) for u, c, a, v in legs], "YJ_UID bigint, YJ_CO string, YJ_ACC string, YJ_AMT decimal(12,2), period int")
    got = {(r.CompanyA, r.CompanyB): (r.Postings, r.DueFrom, r.DueTo, r.Net, r.Residual, r.Balanced)
           for r in rp.intercompany_netting(j, ["27400"], 200101).collect()}
    assert got == {("01", "02"): (1, 0, 10, -10, 0, True), ("01", "03"): (2, 4, 6, -2, 0, True), ("01", "01"): (1, 5, 5, 0, 0, True),
                   ("02", None): (1, 9, 0, 9, 9, False)}


def test_elimination_is_of_accounts_between_companies(spark):
    lines = spark.createDataFrame([("Other revenue", 40, "10180", 200102, D(7)), ("Interest expense", 130, "58200", 200102, D(-3))],
                                  "Section string, SectionOrder int, AccountNumber string, Period int, NetIncomeImpact decimal(18,2)")
    got = {r.Section: (r.Combined, r.Eliminations, r.Consolidated) for r in rp.consolidated_pnl(lines, 200102).collect()}
    assert got == {"Other revenue": (7, 7, 0), "Interest expense": (-3, 0, -3)}


def test_every_account_between_companies_is_eliminated_and_interest_is_not(spark):
    rows = [("Other revenue", 40, "10180", 200102, D(7)), ("Other revenue", 40, "10182", 200102, D(5)), ("Other revenue", 40, "24900", 200102, D(3)),
            ("Other revenue", 40, "27400", 200102, D(-4)), ("Other revenue", 40, "35000", 200102, D(20)), ("Other revenue", 40, "10182", 200101, D(9)),
            ("Interest expense", 130, "58200", 200102, D(-3)), ("Interest expense", 130, "10182", 200102, D(-2))]
    lines = spark.createDataFrame(rows, "Section string, SectionOrder int, AccountNumber string, Period int, NetIncomeImpact decimal(18,2)")
    got = {r.Section: (r.Combined, r.Eliminations, r.Consolidated) for r in rp.consolidated_pnl(lines, 200102).collect()}
    assert got == {"Other revenue": (31, 11, 20), "Interest expense": (-5, -2, -3)}
    sql = catalog.oracle_sql()["consolidated_pnl"].rpartition("AccountNumber IN (")[2].partition(")")[0]
    assert sql == ", ".join(f"'{a}'" for a in fixed.ELIMINATION_ACCOUNTS)


def test_a_new_account_of_a_section_is_in_its_metrics(spark):
    rows = spark.createDataFrame([("01", "Parts revenue", D(5)), ("01", "Parts revenue", D(2)), ("02", "Nothing", D(1))], "Company string, Section string, Amount decimal(18,2)")
    got = {r.Company: (r.PartsRevenue, r.EquipmentSales) for r in rp.metric_values(rows, ["Company"], "flow").collect()}
    assert got == {"01": (7, 0), "02": (0, 0)}


def test_income_is_extended_without_its_history(spark):
    rows = [("01", "01", "201", 200011, D(5)), ("01", "01", "201", 200101, D(-2)), ("02", "01", "305", 200102, D(9)), ("02", "01", "305", 200104, D(1)), ("03", "01", "1", 200104, D(4))]
    lines = spark.createDataFrame(rows, "Company string, Division string, CostCenter string, Period int, NetIncomeImpact decimal(18,2)")
    whole = rollups.build_income(lines, 200104)
    got = {(r.Company, r.Period): r.NetIncome for r in whole.collect()}
    assert got[("01", 200012)] == 5 and got[("01", 200104)] == 3 and got[("02", 200103)] == 9 and got[("02", 200104)] == 10 and got[("03", 200104)] == 4
    late = rollups.extend_income(rollups.build_income(lines, 200102), lines.where("Period > 200102"), 200102, 200104)
    a, b = whole.where("Period > 200102"), late
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_freshness(spark, tmp_path):
    spark.createDataFrame([(1, dt.datetime(2001, 1, 1))], "k int, m timestamp_ntz").write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    r = st.row_freshness({"t": t}, dt.datetime(2001, 1, 2), "m").first()
    assert (r.Rows, r.LatestRowUtc, r.SecondsSinceLatest) == (1, dt.datetime(2001, 1, 1), 86400)
    assert 0 <= st.file_freshness({"t": t}).first().SecondsSinceLatest < 600


def test_days_outstanding_and_payments(spark):
    d = dt.date(2001, 1, 31)
    items = spark.createDataFrame([(1, "a", dt.date(2001, 1, 1), 100.0, True), (2, "a", dt.date(2001, 1, 5), 50.0, False), (3, "a", dt.date(2001, 2, 5), 70.0, True),
                                   (4, "b", dt.date(1999, 1, 1), 10.0, True)], "i int, p string, d date, v double, o boolean")
    got = {r.p: (r.Receivable, r.Sales, r.DaysOutstanding) for r in EX.days_sales_outstanding(items, d, "p", "d", "v", F.col("o"), 30 + 1).collect()}
    assert got["a"] == (100, 150, pytest.approx(100 * 31 / 150)) and got["b"] == (10, 0, None)
    paid = spark.createDataFrame([("a", 60.0), ("a", 60.0)], "p string, paid double")
    got = {r.i: (r.Applied, r.StillOpen) for r in EX.apply_payments(items, paid, "p", "i", "d", "v", "paid").collect()}
    assert got == {1: (100, 0), 2: (20, 30), 3: (0, 70)}


def test_conditions_and_metrics_name_known_sections():
    known = {s for _, _, s, _ in fixed.SECTIONS}
    assert {s for _, _, s in fixed.METRIC_RULES} <= known
