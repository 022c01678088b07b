"""Registered forecasting (FC*) and extension (EXT*) queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..plans import extensions as EX
from ..plans import forecast as FC
from ..sources.adapter import read_source
from . import register
from .common import CY, P, PY, L, lines

Y0 = CY * 100 + 1
AS_OF = dt.date(2001, 12, 1)
CENTS = "CAST(round({} * 100) AS BIGINT)"
MONEY = "CAST(CAST({} AS DECIMAL(18, 0)) * CAST(0.01 AS DECIMAL(3, 2)) AS DECIMAL(18, 2))"


def c(x):
    return CENTS.format(x)


def m(x):
    return MONEY.format(x)


def _src(spark, sf, name):
    return read_source(spark, sf, name)


# ======================================================================= FC
@register("annualize", f"""
    SELECT Company, YTD, CAST(YTD AS DOUBLE) * 12.0 / {float(P % 100)} AS Annualized FROM (
        SELECT Company, CAST(SUM(NetIncomeImpact) AS DECIMAL(18, 2)) AS YTD FROM is_lines
        WHERE Period BETWEEN {Y0} AND {P} GROUP BY Company)""")
def q_annualize(spark, sf):
    return FC.annualize(lines(spark, sf), P)


@register("run_rate", f"""
    SELECT Company, TTM, CAST(TTM AS DOUBLE) / 12.0 AS MonthlyRunRate FROM (
        SELECT Company, CAST(SUM(NetIncomeImpact) AS DECIMAL(18, 2)) AS TTM FROM is_lines
        WHERE Period BETWEEN {PY}03 AND {P} GROUP BY Company)""")
def q_run_rate(spark, sf):
    return FC.run_rate(lines(spark, sf), P)


_N = P % 100


@register("seasonal_forecast", f"""
    SELECT y.Company, y.YTDRevenue, s.CumShare,
           CASE WHEN s.CumShare <> 0 THEN CAST(y.YTDRevenue AS DOUBLE) / s.CumShare END AS Forecast
    FROM (SELECT Company, CAST(SUM(NetIncomeImpact) AS DECIMAL(18, 2)) AS YTDRevenue FROM is_lines
          WHERE SectionOrder <= 40 AND Period BETWEEN {Y0} AND {P} GROUP BY Company) y
    LEFT JOIN (SELECT Company, CAST(SUM(CAST(round(CAST(head AS DOUBLE) / CAST(yr AS DOUBLE), 6) AS DECIMAL(18, 6))) AS DOUBLE)
                               / CAST(COUNT(*) AS DOUBLE) AS CumShare
               FROM (SELECT Company, PeriodYear, SUM(CASE WHEN PeriodMonth <= {_N} THEN NetIncomeImpact END) AS head,
                            SUM(NetIncomeImpact) AS yr FROM is_lines
                     WHERE SectionOrder <= 40 AND PeriodYear BETWEEN 1995 AND {PY} GROUP BY Company, PeriodYear)
               WHERE yr <> 0 GROUP BY Company) s ON s.Company = y.Company""")
def q_seasonal_forecast(spark, sf):
    return FC.seasonal_forecast(lines(spark, sf), P, 1995, PY)


_TOT = "-(0 + " + " + ".join(f"f.GF_H{k}" for k in range(1, 13)) + ")"


@register("cagr_forecast", f"""
    SELECT *, round(CAST(LastYear AS DOUBLE) * (1.0 + CAGR), 2) AS NextYear FROM (
        SELECT *, CASE WHEN FirstYear <> 0 AND sign(FirstYear) = sign(LastYear)
                       THEN round(pow(CAST(LastYear AS DOUBLE) / CAST(FirstYear AS DOUBLE), 1.0 / {PY - 1996}) - 1.0, 6) END AS CAGR
        FROM (SELECT f.GF_CO AS Company,
                     CAST(SUM(CASE WHEN f.GF_YR = 1996 THEN {_TOT} END) AS DECIMAL(18, 2)) AS FirstYear,
                     CAST(SUM(CASE WHEN f.GF_YR = {PY} THEN {_TOT} END) AS DECIMAL(18, 2)) AS LastYear
              FROM glfis f JOIN accmast a ON a.ACCO = f.GF_CO AND a.ACACC = f.GF_GLA
              WHERE a.ACTYP = '2' AND f.GF_YR IN (1996, {PY}) GROUP BY f.GF_CO))""")
def q_cagr_forecast(spark, sf):
    led = L(spark, sf)
    return FC.cagr_forecast(led.glfis, led.accmast, 1996, PY)


@register("cash_runway", f"""
    SELECT *, CASE WHEN MonthlyBurn > 0 THEN CAST(Cash AS DOUBLE) / MonthlyBurn END AS RunwayMonths FROM (
        SELECT *, CAST(CashBefore - Cash AS DOUBLE) / 3.0 AS MonthlyBurn FROM (
            SELECT GB_CO AS Company, CAST(coalesce(SUM(CASE WHEN GB_DATE = {P} THEN GB_AMT END), 0) AS DECIMAL(18, 2)) AS Cash,
                   CAST(coalesce(SUM(CASE WHEN GB_DATE = {PY}11 THEN GB_AMT END), 0) AS DECIMAL(18, 2)) AS CashBefore
            FROM glcal WHERE GB_GLA = '10100' AND GB_DATE IN ({PY}11, {P}) GROUP BY GB_CO))""")
def q_cash_runway(spark, sf):
    return FC.cash_runway(L(spark, sf).glcal, P)


@register("turn_forecast", f"""
    SELECT coalesce(g.Company, i.Company) AS Company, g.CostOfSales, i.InventorySum,
           CASE WHEN CAST(i.InventorySum AS DOUBLE) / 12.0 <> 0
                THEN CAST(g.CostOfSales AS DOUBLE) / (CAST(i.InventorySum AS DOUBLE) / 12.0) END AS Turns
    FROM (SELECT Company, CAST(-SUM(NetIncomeImpact) AS DECIMAL(18, 2)) AS CostOfSales FROM is_lines
          WHERE Period BETWEEN {PY}03 AND {P} AND SectionOrder BETWEEN 50 AND 80 GROUP BY Company) g
    FULL JOIN (SELECT GB_CO AS Company, CAST(SUM(GB_AMT) AS DECIMAL(18, 2)) AS InventorySum FROM glcal
               WHERE GB_GLA = '12000' AND GB_DATE BETWEEN {PY}03 AND {P} GROUP BY GB_CO) i ON g.Company = i.Company""")
def q_turn_forecast(spark, sf):
    return FC.turn_forecast(L(spark, sf).glcal, lines(spark, sf), P)


@register("plan_vs_actual", f"""
    SELECT *, CASE WHEN abs(CAST(Plan AS DOUBLE)) = 0 THEN NULL
                   ELSE CAST(Variance AS DOUBLE) * 100.0 / abs(CAST(Plan AS DOUBLE)) END AS VariancePct FROM (
        SELECT coalesce(a.Section, p.Section) AS Section, coalesce(a.Period, p.Period) AS Period, a.Actual, p.Plan,
               CAST(coalesce(a.Actual, 0) - coalesce(p.Plan, 0) AS DECIMAL(18, 2)) AS Variance
        FROM (SELECT Section, Period, CAST(SUM(NetIncomeImpact) AS DECIMAL(18, 2)) AS Actual FROM is_lines
              WHERE Period BETWEEN {Y0} AND {P} GROUP BY Section, Period) a
        FULL JOIN (SELECT Section, Period, CAST(SUM(Plan) AS DECIMAL(18, 2)) AS Plan FROM (
                       SELECT Section, Period + 100 AS Period,
                              CAST(SUM(NetIncomeImpact) * CAST(1.05 AS DECIMAL(3, 2)) AS DECIMAL(18, 2)) AS Plan
                       FROM is_lines GROUP BY Section, Period + 100)
                   WHERE Period BETWEEN {Y0} AND {P} GROUP BY Section, Period) p
          ON a.Section = p.Section AND a.Period = p.Period)""")
def q_plan_vs_actual(spark, sf):
    li = lines(spark, sf)
    return FC.plan_vs_actual(li, FC.plan_from_prior_year(li), Y0, P)


# ======================================================================= EXT
_AGE = f"date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF}')"
_AGING_SQL = f"""
    SELECT o_custkey, {', '.join(f"{m(f'coalesce(SUM(CASE WHEN age BETWEEN {lo} AND {hi} THEN c END), 0)')} AS {n}" for n, lo, hi in EX.AGING_BUCKETS)},
           {m('coalesce(SUM(CASE WHEN age < 0 THEN c END), 0)')} AS NotDue,
           {m('coalesce(SUM(CASE WHEN age > 120 THEN c END), 0)')} AS Over120, {m('SUM(c)')} AS Total
    FROM (SELECT o_custkey, {_AGE} AS age, {c('o_totalprice')} AS c FROM orders WHERE o_orderstatus = 'O')
    GROUP BY o_custkey"""


def _aging(spark, sf):
    o = _src(spark, sf, "orders").where(F.col("o_orderstatus") == "O")
    return EX.aging(o, AS_OF, "o_custkey", "o_orderdate", "o_totalprice")


@register("aging", _AGING_SQL)
def q_aging(spark, sf):
    return _aging(spark, sf)


@register("days_sales_outstanding", f"""
    SELECT o_custkey, {m('SUM(CASE WHEN open THEN c ELSE 0 END)')} AS Receivable, {m('SUM(CASE WHEN age BETWEEN 0 AND 364 THEN c ELSE 0 END)')} AS Sales,
           CASE WHEN SUM(CASE WHEN age BETWEEN 0 AND 364 THEN c ELSE 0 END) <> 0
                THEN CAST(SUM(CASE WHEN open THEN c ELSE 0 END) AS DOUBLE) * 365.0::DOUBLE / CAST(SUM(CASE WHEN age BETWEEN 0 AND 364 THEN c ELSE 0 END) AS DOUBLE) END AS DaysOutstanding
    FROM (SELECT o_custkey, {_AGE} AS age, {c('o_totalprice')} AS c, o_orderstatus = 'O' AND {_AGE} >= 0 AS open FROM orders) GROUP BY o_custkey""")
def q_days_sales_outstanding(spark, sf):
    o = _src(spark, sf, "orders")
    return EX.days_sales_outstanding(o, AS_OF, "o_custkey", "o_orderdate", "o_totalprice", F.col("o_orderstatus") == "O")


@register("payments_applied", f"""
    SELECT o_orderkey, o_custkey, {m('c')} AS Amount, {m('least(c, greatest(0, paid - before))')} AS Applied,
           {m('c - least(c, greatest(0, paid - before))')} AS StillOpen
    FROM (SELECT o_orderkey, o_custkey, c, pay AS paid, coalesce(SUM(c) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
          FROM (SELECT * , {c('o_totalprice')} AS c FROM orders WHERE o_orderstatus = 'O')
          JOIN (SELECT c_custkey, CAST(round(greatest(c_acctbal, 0) * 1000) AS BIGINT) AS pay FROM customer) ON c_custkey = o_custkey)""")
def q_payments_applied(spark, sf):
    """Each customer's balance, tenfold, as a payment on the oldest open orders."""
    o = _src(spark, sf, "orders").where(F.col("o_orderstatus") == "O")
    pay = _src(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), (F.greatest("c_acctbal", F.lit(0.0)) * 10).alias("paid"))
    return EX.apply_payments(o, pay, "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "paid")


@register("top_customers", f"SELECT * FROM ({_AGING_SQL}) ORDER BY Total DESC, o_custkey LIMIT 10")
def q_top_customers(spark, sf):
    return _aging(spark, sf).orderBy(F.col("Total").desc(), "o_custkey").limit(10)


@register("customer_balance", f"""
    SELECT b.*, cu.c_name, cu.c_mktsegment FROM (
        SELECT o_custkey, COUNT(*) AS Orders, {m(f"SUM({c('o_totalprice')})")} AS Total,
               {m(f"coalesce(SUM(CASE WHEN o_orderstatus = 'O' THEN {c('o_totalprice')} END), 0)")} AS OpenTotal
        FROM orders GROUP BY o_custkey) b LEFT JOIN customer cu ON cu.c_custkey = b.o_custkey""")
def q_customer_balance(spark, sf):
    return EX.customer_balance(_src(spark, sf, "orders"), _src(spark, sf, "customer"))


@register("customer_search", """
    SELECT * FROM customer WHERE contains(lower(c_name), '00001') ORDER BY c_custkey LIMIT 25""")
def q_customer_search(spark, sf):
    return EX.search(_src(spark, sf, "customer"), "c_name", "c_custkey", "00001")


_ECON = ("econ", f"""SELECT *, c * dp // 100 AS di, c * 7 // 10 AS cost FROM (
    SELECT *, {c('l_extendedprice')} AS c, {c('l_discount')} AS dp FROM lineitem)""")


@register("parts_margin", f"""
    SELECT e.*, CAST(Revenue - Cost AS DECIMAL(18, 2)) AS Margin, p.p_name, p.p_type FROM (
        SELECT l_partkey, {m('SUM(c - di)')} AS Revenue, {m('SUM(cost)')} AS Cost FROM econ GROUP BY l_partkey) e
    LEFT JOIN part p ON p.p_partkey = e.l_partkey""", extra_ctes=[_ECON])
def q_parts_margin(spark, sf):
    return EX.parts_margin(_src(spark, sf, "lineitem"), _src(spark, sf, "part"))


@register("part_lookup", "SELECT * FROM part WHERE contains(lower(p_name), 'gear') ORDER BY p_partkey LIMIT 25")
def q_part_lookup(spark, sf):
    return EX.search(_src(spark, sf, "part"), "p_name", "p_partkey", "Gear")


@register("slow_moving_parts", f"""
    SELECT p.p_partkey, p.p_name, l.LastShipped, CAST(date_diff('day', l.LastShipped, DATE '{AS_OF}') AS INTEGER) AS IdleDays
    FROM part p LEFT JOIN (SELECT l_partkey, max(CAST(l_shipdate AS DATE)) AS LastShipped FROM lineitem GROUP BY l_partkey) l
      ON l.l_partkey = p.p_partkey
    WHERE l.LastShipped IS NULL OR date_diff('day', l.LastShipped, DATE '{AS_OF}') > 90""")
def q_slow_moving_parts(spark, sf):
    return EX.slow_moving_parts(_src(spark, sf, "lineitem"), _src(spark, sf, "part"), AS_OF, 90)


_LABOR = f"""
    SELECT Technician, Hours, Billing, CAST(Billing AS DOUBLE) / Hours AS RatePerHour,
           Hours / (CAST(ActiveMonths AS DOUBLE) * 160.0) AS Utilization FROM (
        SELECT l_suppkey AS Technician, SUM(l_quantity) AS Hours, {m('SUM(c - di)')} AS Billing,
               COUNT(DISTINCT year(l_shipdate) * 100 + month(l_shipdate)) AS ActiveMonths
        FROM econ e JOIN part p ON p.p_partkey = e.l_partkey WHERE p.p_type = 'MEDIUM' GROUP BY l_suppkey)"""


def _labor(spark, sf):
    return EX.service_labor(_src(spark, sf, "lineitem"), _src(spark, sf, "part"))


@register("service_labor", f"SELECT Technician, Hours, Billing, RatePerHour FROM ({_LABOR})", extra_ctes=[_ECON])
def q_service_labor(spark, sf):
    return _labor(spark, sf).select("Technician", "Hours", "Billing", "RatePerHour")


@register("technician_utilization", f"SELECT Technician, Utilization FROM ({_LABOR})", extra_ctes=[_ECON])
def q_technician_utilization(spark, sf):
    return _labor(spark, sf).select("Technician", "Utilization")


@register("sales_detail", f"""
    SELECT l_orderkey, {m('SUM(c)')} AS Gross, {m('SUM(di)')} AS Discount, {m('SUM(c - di)')} AS Net,
           {m('SUM(c - di - cost)')} AS Margin FROM econ GROUP BY l_orderkey""", extra_ctes=[_ECON])
def q_sales_detail(spark, sf):
    return EX.sales_detail(_src(spark, sf, "lineitem"))


@register("salesperson_performance", f"""
    SELECT g.*, s.s_name FROM (
        SELECT l_suppkey AS s_suppkey, COUNT(*) AS Lines, {m('SUM(c - di)')} AS Revenue, {m('SUM(c - di - cost)')} AS Margin,
               {m('SUM(di)')} AS DiscountGiven FROM econ GROUP BY l_suppkey) g
    LEFT JOIN supplier s ON s.s_suppkey = g.s_suppkey""", extra_ctes=[_ECON])
def q_salesperson_performance(spark, sf):
    return EX.salesperson_performance(_src(spark, sf, "lineitem"), _src(spark, sf, "supplier"))


@register("bank_rec_summary", f"""
    SELECT *, CAST(date_diff('day', strptime(CAST(YJ_DT AS VARCHAR), '%Y%m%d')::DATE, DATE '{AS_OF}') AS INTEGER) AS AgeDays FROM (
        SELECT coalesce(b.YJ_JRL, k.YJ_JRL) AS YJ_JRL, coalesce(b.YJ_DT, k.YJ_DT) AS YJ_DT, b.Book, k.Bank,
               CAST(coalesce(b.Book, 0) - coalesce(k.Bank, 0) AS DECIMAL(18, 2)) AS Difference
        FROM (SELECT YJ_JRL, YJ_DT, CAST(SUM(-YJ_AMT) AS DECIMAL(18, 2)) AS Book FROM journal WHERE YJ_ACC = '10100'
              GROUP BY YJ_JRL, YJ_DT) b
        FULL JOIN (SELECT lpad(CAST(l_orderkey % 10000 AS VARCHAR), 4, '0') AS YJ_JRL,
                          CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INTEGER) AS YJ_DT,
                          CAST(SUM({m('di')}) AS DECIMAL(18, 2)) AS Bank
                   FROM econ WHERE l_returnflag <> 'R' GROUP BY ALL) k
          ON b.YJ_JRL = k.YJ_JRL AND b.YJ_DT = k.YJ_DT)
    WHERE Difference <> 0""", extra_ctes=[_ECON])
def q_bank_rec_summary(spark, sf):
    book = L(spark, sf).journal.where(F.col("YJ_ACC") == "10100").select("YJ_JRL", "YJ_DT", (-F.col("YJ_AMT")).alias("Amount"))
    e = EX.line_economics(_src(spark, sf, "lineitem")).where(F.col("l_returnflag") != "R")
    ship = F.to_date("l_shipdate")
    bank = e.select(F.lpad((F.col("l_orderkey") % 10000).cast("string"), 4, "0").alias("YJ_JRL"),
                    (F.year(ship) * 10000 + F.month(ship) * 100 + F.dayofmonth(ship)).cast("int").alias("YJ_DT"),
                    EX._money(F.col("di")).alias("Amount"))
    return EX.bank_rec_summary(book, bank, ["YJ_JRL", "YJ_DT"], AS_OF, "YJ_DT")


@register("vendor_patterns", f"""
    SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY s_nationkey ORDER BY Purchases DESC, s_suppkey) AS INTEGER) AS RankInNation
                   FROM (SELECT g.*, s.s_nationkey FROM (
                             SELECT l_suppkey AS s_suppkey, COUNT(*) AS Lines, {m('SUM(cost)')} AS Purchases
                             FROM econ GROUP BY l_suppkey) g JOIN supplier s ON s.s_suppkey = g.s_suppkey))
    WHERE RankInNation <= 3""", extra_ctes=[_ECON])
def q_vendor_patterns(spark, sf):
    return EX.vendor_patterns(_src(spark, sf, "lineitem"), _src(spark, sf, "supplier"))
