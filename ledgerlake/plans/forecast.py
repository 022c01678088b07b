"""Forecasting (FC1-FC6): annualised, run-rate, seasonal and growth projections.

Every ratio is one double division of exact decimal sums, so the projection does
not depend on the order rows are added in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import money, safe_pct
from ..functions.periods import parse_period


def annualize(lines: DataFrame, period) -> DataFrame:
    """FC1: year-to-date net income x 12 / months elapsed, per company."""
    per = parse_period(period)
    n = per % 100
    ytd = lines.where(F.col("Period").between((per // 100) * 100 + 1, per)).groupBy("Company").agg(
        money(F.sum("NetIncomeImpact")).alias("YTD"))
    return ytd.withColumn("Annualized", F.col("YTD").cast("double") * 12.0 / float(n))


def run_rate(lines: DataFrame, period) -> DataFrame:
    """FC2: trailing-12-month net income and its monthly run rate, per company."""
    per = parse_period(period)
    i = (per // 100) * 12 + per % 100 - 1 - 11
    start = (i // 12) * 100 + i % 12 + 1
    t = lines.where(F.col("Period").between(start, per)).groupBy("Company").agg(
        money(F.sum("NetIncomeImpact")).alias("TTM"))
    return t.withColumn("MonthlyRunRate", F.col("TTM").cast("double") / 12.0)


def seasonal_forecast(lines: DataFrame, period, first_year: int, last_year: int) -> DataFrame:
    """FC3: full-year revenue = YTD revenue / the average share of the year that
    months 1..N carried in past complete years (per company)."""
    per = parse_period(period)
    n = per % 100
    rev = lines.where(F.col("SectionOrder") <= 40)
    hist = rev.where(F.col("PeriodYear").between(first_year, last_year)).groupBy("Company", "PeriodYear").agg(
        F.sum(F.when(F.col("PeriodMonth") <= n, F.col("NetIncomeImpact"))).alias("head"),
        F.sum("NetIncomeImpact").alias("year"))
    share = F.round(F.col("head").cast("double") / F.col("year").cast("double"), 6).cast("decimal(18,6)")
    cum = hist.where(F.col("year") != 0).groupBy("Company").agg(
        (F.sum(share).cast("double") / F.count(F.lit(1)).cast("double")).alias("CumShare"))
    ytd = rev.where(F.col("Period").between((per // 100) * 100 + 1, per)).groupBy("Company").agg(
        money(F.sum("NetIncomeImpact")).alias("YTDRevenue"))
    j = ytd.join(cum, "Company", "left")
    return j.withColumn("Forecast", F.when(F.col("CumShare") != 0, F.col("YTDRevenue").cast("double") / F.col("CumShare")))


def cagr_forecast(glfis: DataFrame, accmast: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """FC4: compound annual growth of revenue between two years of the annual table
    (GLFIS), NULL on a sign change or a zero base, and next year's projection."""
    from ..operators.joins import left_dim
    f = left_dim(glfis, accmast, co="GF_CO", acc="GF_GLA", cols=("ACTYP",)).where(F.col("ACTYP") == "2")
    total = -sum((F.col(f"GF_H{m}") for m in range(1, 13)), F.lit(0))
    y = f.where(F.col("GF_YR").isin(first_year, last_year)).groupBy(F.col("GF_CO").alias("Company")).agg(
        money(F.sum(F.when(F.col("GF_YR") == first_year, total))).alias("FirstYear"),
        money(F.sum(F.when(F.col("GF_YR") == last_year, total))).alias("LastYear"))
    ratio = F.col("LastYear").cast("double") / F.col("FirstYear").cast("double")
    ok = (F.col("FirstYear") != 0) & (F.signum("FirstYear") == F.signum("LastYear"))
    cagr = F.when(ok, F.round(F.pow(ratio, 1.0 / (last_year - first_year)) - 1.0, 6))
    return y.withColumn("CAGR", cagr).withColumn(
        "NextYear", F.round(F.col("LastYear").cast("double") * (1.0 + F.col("CAGR")), 2))


def cash_runway(glcal: DataFrame, period, cash_account: str = "10100", months: int = 3) -> DataFrame:
    """FC5: cash at the period over the average monthly cash decrease of the last
    ``months`` months (NULL when cash is not falling), per company."""
    per = parse_period(period)
    i = (per // 100) * 12 + per % 100 - 1 - months
    start = (i // 12) * 100 + i % 12 + 1
    g = glcal.where((F.col("GB_GLA") == cash_account) & F.col("GB_DATE").isin(start, per))
    c = g.groupBy(F.col("GB_CO").alias("Company")).agg(
        money(F.coalesce(F.sum(F.when(F.col("GB_DATE") == per, F.col("GB_AMT"))), F.lit(0))).alias("Cash"),
        money(F.coalesce(F.sum(F.when(F.col("GB_DATE") == start, F.col("GB_AMT"))), F.lit(0))).alias("CashBefore"))
    burn = (F.col("CashBefore") - F.col("Cash")).cast("double") / float(months)
    return c.withColumn("MonthlyBurn", burn).withColumn(
        "RunwayMonths", F.when(F.col("MonthlyBurn") > 0, F.col("Cash").cast("double") / F.col("MonthlyBurn")))


def turn_forecast(glcal: DataFrame, lines: DataFrame, period, inventory_account: str = "12000") -> DataFrame:
    """FC5: inventory turns = cost of sales of the last 12 months / average month-end
    inventory over the same months, per company."""
    per = parse_period(period)
    i = (per // 100) * 12 + per % 100 - 1 - 11
    start = (i // 12) * 100 + i % 12 + 1
    inv = glcal.where((F.col("GB_GLA") == inventory_account) & F.col("GB_DATE").between(start, per)).groupBy(
        F.col("GB_CO").alias("Company")).agg(money(F.sum("GB_AMT")).alias("InventorySum"))
    cogs = lines.where(F.col("Period").between(start, per) & F.col("SectionOrder").between(50, 80)).groupBy("Company").agg(
        money(-F.sum("NetIncomeImpact")).alias("CostOfSales"))
    j = cogs.join(inv, "Company", "full_outer")
    avg_inv = F.col("InventorySum").cast("double") / 12.0
    return j.withColumn("Turns", F.when(avg_inv != 0, F.col("CostOfSales").cast("double") / avg_inv))


def plan_vs_actual(lines: DataFrame, plan: DataFrame, start: int, end: int) -> DataFrame:
    """FC6: the caller's plan (Section, Period, Plan) against actual net income by
    section and period; variance and % of plan (JN4 shape)."""
    act = lines.where(F.col("Period").between(start, end)).groupBy("Section", "Period").agg(
        money(F.sum("NetIncomeImpact")).alias("Actual"))
    p = plan.where(F.col("Period").between(start, end)).groupBy("Section", "Period").agg(money(F.sum("Plan")).alias("Plan"))
    j = act.join(p, ["Section", "Period"], "full_outer")
    j = j.withColumn("Variance", money(F.coalesce("Actual", F.lit(0)) - F.coalesce("Plan", F.lit(0))))
    return j.withColumn("VariancePct", safe_pct(F.col("Variance"), F.col("Plan")))


def plan_from_prior_year(lines: DataFrame, uplift: str = "1.05") -> DataFrame:
    """A plan derived from data: last year's same month times ``uplift``."""
    return lines.groupBy("Section", (F.col("Period") + 100).alias("Period")).agg(
        money(F.sum("NetIncomeImpact") * F.lit(uplift).cast("decimal(3,2)")).alias("Plan"))
