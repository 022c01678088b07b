"""Invariants that hold by construction on the derived ledger, and the checks
that must fire on the seeded-fault ledger."""

from decimal import Decimal

from pyspark.sql import functions as F

from conftest import SMOKE
from ledgerlake import catalog, fixed
from ledgerlake.plans import quality as Q
from ledgerlake.plans import statements as st


def _q(spark, key):
    return catalog.REGISTRY[key].run(spark, SMOKE)


def test_journal_legs_balance_per_branch(led):
    total = led.journal.agg(F.sum("YJ_AMT")).first()[0]
    assert total == 0
    by_branch = led.journal.groupBy(F.substring("YJ_CC", -2, 2)).agg(F.sum("YJ_AMT").alias("s")).where("s <> 0")
    assert by_branch.count() == 0


def test_every_branch_balances_after_net_income(spark, led):
    rows = st.branch_balance_check(led, st.income_statement_lines(led.glcal, led.accmast), fixed.LAST_CLOSE).collect()
    assert rows and all(r.Balanced for r in rows)


def test_balance_sheet_difference_is_zero(spark):
    diff = [r for r in _q(spark, "balance_sheet").collect() if r.Section == "Difference"]
    assert diff and diff[0].Amount == 0 and diff[0].ComparativeAmount == 0


def test_rollups_reconcile(spark):
    assert _q(spark, "recon_drift").count() == 0
    assert all(r.Mismatches == 0 for r in _q(spark, "recon_dept_glcal").collect())
    assert all(r.Mismatches == 0 for r in _q(spark, "recon_glfis_glcal").collect())
    assert all(r.Mismatches == 0 for r in _q(spark, "recon_ytd_pnl").collect())
    assert all(r.Mismatches == 0 for r in _q(spark, "recon_ytd_bs").collect())
    assert all(r.Difference == 0 for r in _q(spark, "recon_total").collect())
    assert all(r.nonzero_rows == 0 for r in _q(spark, "unclosed_bucket_scan").collect())


def test_clean_checks_are_empty_and_seeded_checks_fire(spark, led):
    assert _q(spark, "one_sided_journals").count() == 0
    assert _q(spark, "one_sided_journals_seeded").count() > 0
    drift = _q(spark, "recon_drift_seeded").collect()
    assert len(drift) == 1 and abs(drift[0].Difference) == Decimal("0.01")
    assert _q(spark, "period_completeness").count() == 0
    missing = _q(spark, "period_completeness_seeded").collect()
    assert [(r.YJ_CO, r.MissingPeriod) for r in missing] == [(Q.FAULT_GAP[0], Q.FAULT_GAP[1])]
    unknown = _q(spark, "unknown_accounts_seeded").collect()
    assert unknown and {r.YJ_ACC for r in unknown} == {Q.FAULT_UNKNOWN[2]}


def test_unclosed_activity_is_the_difference_of_live_and_closed(spark):
    live = {r.Company: r.LiveYTD for r in _q(spark, "live_ytd").collect()}
    unclosed = {r.Company: r.UnclosedNetIncome for r in _q(spark, "unclosed_activity").collect()}
    assert set(live) == set(unclosed)


def test_intercompany_nets_to_zero_over_companies(spark):
    total = [r for r in _q(spark, "intercompany_check").collect() if r.Company == "Total"][0]
    assert total.Balance == 0 and total.OutOfBalance is False


def test_cash_flow_has_no_residual(spark):
    resid = [r for r in _q(spark, "cash_flow_indirect").collect() if r.Line == "Residual"][0]
    assert resid.Amount == 0


def test_append_union_equals_journal(spark, led):
    a = {r.period: (r.Legs, r.Amount) for r in _q(spark, "append_journal").collect()}
    j = {r.period: (r.n, r.s) for r in led.journal.groupBy("period").agg(
        F.count(F.lit(1)).alias("n"), F.sum("YJ_AMT").cast("decimal(18,2)").alias("s")).collect()}
    assert a == j


def test_balance_sheet_has_one_total_per_side_and_they_agree(spark):
    for key, label in (("balance_sheet", "Section"), ("structured_balance_sheet", "Label")):
        rows = _q(spark, key).collect()
        totals = {r[label]: r.Amount for r in rows if r[label].startswith("Total")}
        assert sum(1 for r in rows if r[label].lower() == "total liabilities and equity") == 1
        assert totals["Total assets"] == totals["Total liabilities and equity"]
