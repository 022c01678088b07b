"""Registered financial statements and reporting tools (FS*)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import fixed
from ..functions.columns import money
from ..functions.sections import longest_prefix
from ..operators import joins as JN
from ..oracle import midx
from ..plans import loads as LD
from ..plans import statements as st
from ..sources.detail import detailed_balances
from ..sources.store import ledger
from . import ingest as _INGEST
from . import register


def _lines(spark, sf_dir):
    led = ledger(spark, sf_dir)
    return st.income_statement_lines(led.glcal, led.accmast)


P = fixed.LAST_CLOSE


# --- FS1 / SRC6 -----------------------------------------------------------------------
@register("income_statement_lines", "SELECT * FROM is_lines")
def q_income_statement_lines(spark, sf_dir):
    return _lines(spark, sf_dir)


# --- FS2 ------------------------------------------------------------------------------
@register("income_statement", f"""
    SELECT CASE WHEN GROUPING(Section, SectionOrder) = 0 THEN Section ELSE '{st.TOTAL_LABEL}' END AS Section,
           SectionOrder, COUNT(*) AS Lines, CAST(SUM(NetIncomeImpact) AS DECIMAL(18, 2)) AS NetIncomeImpact
    FROM is_lines WHERE Period = {P}
    GROUP BY GROUPING SETS ((Section, SectionOrder), ())""")
def q_income_statement(spark, sf_dir):
    return st.income_statement(_lines(spark, sf_dir), P)


@register("income_statement_by_account", f"""
    SELECT Section, SectionOrder, AccountNumber, AccountName, Company, Division, Branch,
           CAST(SUM(NetIncomeImpact) AS DECIMAL(18, 2)) AS NetIncomeImpact,
           CAST(SUM(Amount) AS DECIMAL(18, 2)) AS Amount
    FROM is_lines WHERE Period = {P}
    GROUP BY Section, SectionOrder, AccountNumber, AccountName, Company, Division, Branch
    UNION ALL
    SELECT 'Total net income', NULL, NULL, NULL, NULL, NULL, NULL, CAST(SUM(NetIncomeImpact) AS DECIMAL(18, 2)), CAST(SUM(Amount) AS DECIMAL(18, 2))
    FROM is_lines WHERE Period = {P}""")
def q_income_statement_by_account(spark, sf_dir):
    return st.income_statement(_lines(spark, sf_dir), P, detail="by_account")


# --- FS3 ------------------------------------------------------------------------------
@register("pnl_by_section", f"""
    SELECT Section, SectionOrder, COUNT(*) AS Lines,
           CAST(SUM(NetIncomeImpact) AS DECIMAL(18, 2)) AS NetIncomeImpact
    FROM is_lines WHERE Period BETWEEN {fixed.PRIOR_YEAR}01 AND {P}
    GROUP BY Section, SectionOrder""")
def q_pnl_by_section(spark, sf_dir):
    return st.pnl_by_section(_lines(spark, sf_dir), f"{fixed.PRIOR_YEAR}01", P)


# ============================================================================ FS4 - FS50
from pyspark.sql import functions as F  # noqa: E402

from ..plans import reports as rp  # noqa: E402
from .common import CY, PY, L, lines  # noqa: E402

PREV = P - 1 if P % 100 > 1 else P - 89
PY_P = P - 100
Y0 = CY * 100 + 1
M = "CAST(SUM({}) AS DECIMAL(18, 2))"


def _m(x):
    return M.format(x)


def _z(x):
    return f"CAST(coalesce(SUM({x}), 0) AS DECIMAL(18, 2))"


# --- FS4
@register("trial_balance", f"""
    SELECT g.GB_CO AS Company, g.GB_DIV AS Division, g.GB_GLC AS CostCtr, g.GB_GLA AS Account,
           rtrim(a.ACNME) AS AccountName, c.CA_GLFA AS Alias, a.ACTYP AS AccountType, g.GB_AMT AS Amount
    FROM glcal g LEFT JOIN accmast a ON a.ACCO = g.GB_CO AND a.ACACC = g.GB_GLA
    LEFT JOIN coacmast c ON c.CA_CO = g.GB_CO AND c.CA_DIV = g.GB_DIV AND c.CA_ACC = g.GB_GLA AND c.CA_CC = g.GB_GLC
    WHERE g.GB_DATE = {P} AND g.GB_AMT <> 0""")
def q_trial_balance(spark, sf):
    return st.trial_balance(L(spark, sf), P)


@register("trial_balance_totals", f"""
    SELECT {_z('CASE WHEN GB_AMT > 0 THEN GB_AMT END')} AS Debits, {_z('CASE WHEN GB_AMT < 0 THEN GB_AMT END')} AS Credits,
           {_z('GB_AMT')} AS Total, COUNT(*) AS Rows FROM glcal WHERE GB_DATE = {P} AND GB_AMT <> 0""")
def q_trial_balance_totals(spark, sf):
    return st.trial_balance_totals(st.trial_balance(L(spark, sf), P))


# --- FS5
@register("account_search_tool", """
    SELECT ACCO AS Company, ACACC AS Account, rtrim(ACNME) AS AccountName, ACTYP AS AccountType, ACSTA AS Status
    FROM accmast WHERE (starts_with(ACACC, '4') OR contains(lower(ACNME), '4')) AND ACCO = '02'
    ORDER BY ACCO, ACACC LIMIT 100""")
def q_account_search_tool(spark, sf):
    return st.account_search(L(spark, sf).accmast, " 4 ", company="2", limit=500)


# --- FS6 / FS7
@register("account_activity", f"""
    SELECT GB_CO AS Company, GB_DIV AS Division, GB_GLC AS CostCtr, GB_GLA AS Account, GB_DATE AS Period, GB_AMT AS Amount
    FROM glcal WHERE GB_GLA = '31001' AND GB_AMT <> 0 AND GB_DATE >= {PY}01 AND GB_DATE <= {P}""")
def q_account_activity(spark, sf):
    return st.account_activity(L(spark, sf), "31001", from_period=f"{PY}01", to_period=P)


@register("account_activity_stats", f"""
    SELECT COUNT(*) AS count, {_m('GB_AMT')} AS total, CAST(SUM(GB_AMT) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS mean,
           min(GB_AMT) AS min, max(GB_AMT) AS max, min(GB_DATE) AS first_period, max(GB_DATE) AS last_period
    FROM glcal WHERE GB_GLA = '31001' AND GB_AMT <> 0 AND GB_DATE >= {PY}01 AND GB_DATE <= {P}""")
def q_account_activity_stats(spark, sf):
    a = st.account_activity(L(spark, sf), "31001", from_period=f"{PY}01", to_period=P)
    v = F.col("Amount")
    return a.agg(F.count(F.lit(1)).alias("count"), st.money(F.sum(v)).alias("total"),
                 (F.sum(v).cast("double") / F.count(F.lit(1)).cast("double")).alias("mean"),
                 F.min(v).alias("min"), F.max(v).alias("max"), F.min("Period").alias("first_period"),
                 F.max("Period").alias("last_period"))


@register("monthly_trend", f"""
    SELECT GB_DATE AS Period, {_m('GB_AMT')} AS Amount FROM glcal
    WHERE GB_GLA = '31001' AND GB_DATE >= {PY}03 AND GB_DATE <= {P} GROUP BY GB_DATE""")
def q_monthly_trend(spark, sf):
    return st.monthly_trend(L(spark, sf), "31001", from_period=f"{PY}-03", to_period=P)


@register("monthly_trend_default", f"""
    SELECT GB_DATE AS Period, {_m('GB_AMT')} AS Amount FROM glcal
    WHERE GB_GLA = '33100' AND {midx('GB_DATE')} > (SELECT {midx('max(GB_DATE)')} - 12 FROM glcal) GROUP BY GB_DATE""")
def q_monthly_trend_default(spark, sf):
    """No bounds: the last twelve months."""
    return st.monthly_trend(L(spark, sf), "33100")


@register("monthly_trend_stats", f"""
    SELECT COUNT(*) AS Months, CAST(SUM(Amount) AS DECIMAL(18, 2)) AS Total, CAST(SUM(Amount) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS Mean,
           min(Amount) AS Smallest, max(Amount) AS Largest, max(Period) AS LatestPeriod, arg_max(Amount, Period) AS LatestAmount
    FROM (SELECT GB_DATE AS Period, {_m('GB_AMT')} AS Amount FROM glcal
          WHERE GB_GLA = '31001' AND GB_DATE >= {PY}03 AND GB_DATE <= {P} GROUP BY GB_DATE)""")
def q_monthly_trend_stats(spark, sf):
    return st.monthly_trend_stats(st.monthly_trend(L(spark, sf), "31001", from_period=f"{PY}-03", to_period=P))


# --- FS8
@register("alias_rollup", f"""
    SELECT c.CA_GLFA AS Alias, COUNT(*) AS Lines, {_m('g.GB_AMT')} AS Amount
    FROM glcal g JOIN coacmast c ON c.CA_CO = g.GB_CO AND c.CA_DIV = g.GB_DIV AND c.CA_ACC = g.GB_GLA AND c.CA_CC = g.GB_GLC
    WHERE g.GB_DATE = {P} AND c.CA_GLFA <> '' GROUP BY c.CA_GLFA""")
def q_alias_rollup(spark, sf):
    return st.alias_rollup(L(spark, sf), P)


@register("alias_rollup_detail", f"""
    SELECT c.CA_GLFA AS Alias, g.GB_CO AS Company, g.GB_DIV AS Division, g.GB_GLC AS CostCtr, g.GB_GLA AS Account,
           rtrim(a.ACNME) AS AccountName, g.GB_AMT AS Amount
    FROM glcal g JOIN coacmast c ON c.CA_CO = g.GB_CO AND c.CA_DIV = g.GB_DIV AND c.CA_ACC = g.GB_GLA AND c.CA_CC = g.GB_GLC
    LEFT JOIN accmast a ON a.ACCO = g.GB_CO AND a.ACACC = g.GB_GLA
    WHERE g.GB_DATE = {P} AND c.CA_GLFA = 'F101'""")
def q_alias_rollup_detail(spark, sf):
    return st.alias_rollup(L(spark, sf), P, alias="F101")


# --- FS9
@register("period_coverage", f"""
    SELECT min(GB_DATE) AS MinPeriod, max(GB_DATE) AS MaxPeriod, COUNT(DISTINCT GB_DATE) AS DistinctPeriods,
           COUNT(*) AS TotalRows, CAST(coalesce(SUM(gap), 0) AS BIGINT) AS GapMonths
    FROM (SELECT GB_DATE, coalesce(lead({midx('GB_DATE')}) OVER (PARTITION BY GB_CO, GB_DIV, GB_GLC, GB_GLA
                 ORDER BY GB_DATE) - {midx('GB_DATE')} - 1, 0) AS gap FROM glcal)""")
def q_period_coverage(spark, sf):
    return st.period_coverage(L(spark, sf))


# --- FS11 / FS20 / FS21 / FS28
def _bs_block(p: int, name: str, where: str = "", ni_where: str = "") -> str:
    return f"""
    SELECT CASE WHEN gid = 7 THEN 'Check' ELSE Side END AS Side,
           CASE WHEN gid = 0 THEN Section WHEN gid = 3 AND Side = 'Assets' THEN 'Total assets'
                WHEN gid = 3 THEN 'Total liabilities and equity' ELSE 'Difference' END AS Section,
           CASE WHEN gid = 0 THEN SectionOrder WHEN gid = 3 AND Side = 'Assets' THEN 45 WHEN gid = 3 THEN 95
                ELSE 99 END AS SectionOrder,
           CASE WHEN gid = 7 THEN net ELSE amt END AS {name}
    FROM (SELECT Side, Section, SectionOrder, {_m('Amount')} AS amt,
                 GROUPING(Side, Section, SectionOrder) AS gid,
                 {_m("CASE WHEN Side = 'Assets' THEN Amount ELSE -Amount END")} AS net
          FROM (SELECT CASE WHEN Statement = 'BA' THEN 'Assets' ELSE 'Liabilities and equity' END AS Side, * FROM (
                SELECT Statement, Section, SectionOrder,
                       {_m("CASE WHEN Statement = 'BA' THEN GB_AMT ELSE -GB_AMT END")} AS Amount
                FROM bsl WHERE GB_DATE = {p} {where} GROUP BY Statement, Section, SectionOrder
                UNION ALL
                SELECT 'BE', '{fixed.NET_INCOME_SECTION[0]}', {fixed.NET_INCOME_SECTION[1]},
                       {_z('NetIncomeImpact')} FROM is_lines WHERE Period <= {p} {ni_where}))
          GROUP BY GROUPING SETS ((Side, Section, SectionOrder), (Side), ()))"""


@register("balance_sheet", f"""
    SELECT * FROM ({_bs_block(P, 'Amount')}) c FULL JOIN ({_bs_block(PY_P, 'ComparativeAmount')}) p
    USING (Side, Section, SectionOrder)""")
def q_balance_sheet(spark, sf):
    return st.balance_sheet(L(spark, sf), lines(spark, sf), P, comparative="prior_year")


@register("balance_sheet_detail", f"""
    SELECT CASE WHEN Statement = 'BA' THEN 'Assets' ELSE 'Liabilities and equity' END AS Side, Section, SectionOrder,
           GB_GLA AS Account, rtrim(ACNME) AS AccountName,
           {_m("CASE WHEN Statement = 'BA' THEN GB_AMT ELSE -GB_AMT END")} AS Amount
    FROM bsl WHERE GB_DATE = {P} GROUP BY ALL""")
def q_balance_sheet_detail(spark, sf):
    return st.balance_sheet(L(spark, sf), lines(spark, sf), P, detail="by_account")


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _detail_sql() -> str:
    """GLCAL's balance-sheet rows in detailed accounts (FIXTURES F8)."""
    inv, dep, n = fixed.INVENTORY_ACCOUNT, fixed.ACCUM_DEPRECIATION_ACCOUNT, len(fixed.INVENTORY_PAIRS)
    base = ("(SELECT g.*, CAST(right(g.GB_GLC, 2) AS INTEGER) AS br, CAST(round(g.GB_AMT * 100) AS BIGINT) AS cents FROM glcal g "
            "JOIN accmast a ON a.ACCO = g.GB_CO AND a.ACACC = g.GB_GLA WHERE a.ACTYP = '1')")
    key = "GB_CO, GB_DIV, GB_GLC, GB_DATE"
    suffix = f"{_list(fixed.ASSET_SUFFIXES)}[br % {len(fixed.ASSET_SUFFIXES)} + 1]"
    picks = " ".join(f"WHEN '{a}' THEN {_list(v)}[br % {len(v)} + 1]" for a, v in fixed.DETAIL_OF.items())
    arms = [
        f"SELECT {key}, CASE GB_GLA {picks} ELSE GB_GLA END AS acc, cents FROM b WHERE GB_GLA NOT IN ('{inv}', '{dep}')",
        f"SELECT {key}, {_list(p[0] for p in fixed.INVENTORY_PAIRS)}[br % {n} + 1], cents + abs(cents) // {fixed.RESERVE_SHARE} FROM b WHERE GB_GLA = '{inv}'",
        f"SELECT {key}, {_list(p[1] for p in fixed.INVENTORY_PAIRS)}[br % {n} + 1], -(abs(cents) // {fixed.RESERVE_SHARE}) FROM b WHERE GB_GLA = '{inv}'",
        f"SELECT {key}, '15' || {suffix}, abs(cents) * {fixed.ASSET_COST_FACTOR} FROM b WHERE GB_GLA = '{dep}'",
        f"SELECT {key}, '16' || {suffix}, cents - abs(cents) * {fixed.ASSET_COST_FACTOR} FROM b WHERE GB_GLA = '{dep}'",
    ]
    return f"WITH b AS {base} " + " UNION ALL ".join(arms)


def _rows(rows) -> str:
    return ", ".join("(" + ", ".join(str(v) if isinstance(v, int) else f"'{v}'" for v in r) + ")" for r in rows)


DETAIL = [
    ("det", _detail_sql()),
    ("det_rules", f"SELECT * FROM (VALUES {_rows(fixed.BS_PREFIX_RULES)}) AS t(prefix, Side, Section, SectionOrder, IsCurrent)"),
    ("det_names", f"SELECT * FROM (VALUES {_rows(fixed.DETAIL_ACCOUNTS)}) AS t(acc, name)"),
    ("det_acct", f"""
        SELECT a.acc, n.name, r.Side, r.Section, r.SectionOrder, r.IsCurrent,
               CASE WHEN r.Side = 'Assets' THEN a.cents ELSE -a.cents END AS cents
        FROM (SELECT acc, SUM(cents) AS cents FROM det WHERE GB_DATE = {P} GROUP BY acc) a
        JOIN det_names n ON n.acc = a.acc
        JOIN det_rules r ON starts_with(a.acc, r.prefix)
         AND NOT EXISTS (SELECT 1 FROM det_rules q WHERE starts_with(a.acc, q.prefix) AND length(q.prefix) > length(r.prefix))"""),
    ("det_ni", f"SELECT coalesce(CAST(SUM(NetIncomeImpact) * 100 AS BIGINT), 0) AS cents FROM is_lines WHERE Period <= {P}"),
]


@register("structured_balance_sheet", f"""
    SELECT Side, Section, CAST(SectionOrder AS INTEGER) AS SectionOrder, LineGroup, CAST(LineOrder AS INTEGER) AS LineOrder, Account, Label,
           CAST(cents * CAST(0.01 AS DECIMAL(3, 2)) AS DECIMAL(18, 2)) AS Amount FROM (
      SELECT Side, Section, SectionOrder, CASE WHEN substr(acc, 1, 2) IN ('15', '16') THEN substr(acc, 3) ELSE acc END AS LineGroup,
             CASE WHEN substr(acc, 1, 2) = '16' THEN 2 ELSE 1 END AS LineOrder, acc AS Account, name AS Label, CAST(cents AS DECIMAL(18, 0)) AS cents FROM det_acct
      UNION ALL
      SELECT 'Assets', '{fixed.PPE_SECTION}', 90, substr(acc, 3), 3, '', 'Net book value ' || substr(acc, 3), SUM(cents)
      FROM det_acct WHERE substr(acc, 1, 2) IN ('15', '16') GROUP BY substr(acc, 3)
      UNION ALL SELECT Side, Section, SectionOrder, '~', 9, '', 'Total ' || lower(Section), SUM(cents) FROM det_acct GROUP BY Side, Section, SectionOrder
      UNION ALL SELECT 'Liabilities and equity', '{fixed.NET_INCOME_SECTION[0]}', 280, '~', 9, '', 'Total ' || lower('{fixed.NET_INCOME_SECTION[0]}'), cents FROM det_ni
      UNION ALL SELECT 'Assets', 'Current assets', 65, '~', 9, '', 'Total current assets', SUM(cents) FROM det_acct
                WHERE substr(acc, 1, 3) IN ('101', '102', '103') AND acc NOT LIKE '1018%' OR acc IN ('12000', '13000', '14000')
      UNION ALL SELECT 'Assets', 'Assets', 199, '~', 9, '', 'Total assets', SUM(cents) FROM det_acct WHERE acc < '2'
      UNION ALL SELECT 'Liabilities and equity', 'Liabilities and equity', 299, '~', 9, '', 'Total liabilities and equity',
                SUM(cents) + (SELECT cents FROM det_ni) FROM det_acct WHERE acc >= '2'
      UNION ALL SELECT 'Check', 'Check', 999, '~', 9, '', 'Difference', 0)""", DETAIL)
def q_structured_balance_sheet(spark, sf):
    led = L(spark, sf)
    bal = st.bs_lines(led, P).select(*led.glcal.columns)
    return st.structured_balance_sheet(detailed_balances(bal), st.cumulative_income(led), P, fixed.BS_PREFIX_RULES, fixed.DETAIL_ACCOUNTS)


@register("paired_assets", """
    SELECT coalesce(a.GB_CO, d.GB_CO) AS GB_CO, coalesce(a.GB_DATE, d.GB_DATE) AS GB_DATE, coalesce(a.s, d.s) AS suffix,
           a.acc AS LeftAccount, a.v AS LeftAmount, d.acc AS RightAccount, d.v AS RightAmount
    FROM (SELECT GB_CO, GB_DATE, acc, substr(acc, 3) AS s, CAST(SUM(cents) * CAST(0.01 AS DECIMAL(3, 2)) AS DECIMAL(18, 2)) AS v
          FROM det WHERE acc LIKE '15%' GROUP BY GB_CO, GB_DATE, acc) a
    FULL JOIN (SELECT GB_CO, GB_DATE, acc, substr(acc, 3) AS s, CAST(SUM(cents) * CAST(0.01 AS DECIMAL(3, 2)) AS DECIMAL(18, 2)) AS v
               FROM det WHERE acc LIKE '16%' GROUP BY GB_CO, GB_DATE, acc) d
      ON a.GB_CO = d.GB_CO AND a.GB_DATE = d.GB_DATE AND a.s = d.s""", DETAIL[:1])
def q_paired_assets(spark, sf):
    led = L(spark, sf)
    bal = led.glcal.join(led.accmast.where("ACTYP = '1'").select(F.col("ACCO").alias("GB_CO"), F.col("ACACC").alias("GB_GLA")), ["GB_CO", "GB_GLA"])
    return JN.paired_accounts(detailed_balances(bal.select(*led.glcal.columns)), "GB_GLA", "GB_AMT", ["GB_CO", "GB_DATE"], "15", "16")


@register("section_by_prefix", """
    SELECT d.acc AS Account, CAST(SUM(d.cents) * CAST(0.01 AS DECIMAL(3, 2)) AS DECIMAL(18, 2)) AS Balance, r.Side, r.Section
    FROM det d JOIN det_rules r ON starts_with(d.acc, r.prefix)
     AND NOT EXISTS (SELECT 1 FROM det_rules q WHERE starts_with(d.acc, q.prefix) AND length(q.prefix) > length(r.prefix))
    WHERE d.GB_DATE = """ + str(P) + """ GROUP BY d.acc, r.Side, r.Section""", DETAIL[:2])
def q_section_by_prefix(spark, sf):
    rules = spark.createDataFrame([r[:3] for r in fixed.BS_PREFIX_RULES], "prefix string, Side string, Section string")
    bal = detailed_balances(st.bs_lines(L(spark, sf), P).select(*L(spark, sf).glcal.columns))
    return longest_prefix(bal.groupBy(F.col("GB_GLA").alias("Account")).agg(money(F.sum("GB_AMT")).alias("Balance")), "Account", rules)


@register("branch_balance_check", f"""
    SELECT Branch, Assets, Liabilities, Equity, CAST(Assets - Liabilities - Equity AS DECIMAL(18, 2)) AS Difference,
           abs(Assets - Liabilities - Equity) <= {fixed.BALANCE_TOLERANCE} AS Balanced
    FROM (SELECT coalesce(b.Branch, n.Branch) AS Branch, coalesce(b.Assets, 0) AS Assets,
                 coalesce(b.Liabilities, 0) AS Liabilities, coalesce(n.NetIncome, 0) AS Equity
          FROM (SELECT right(GB_GLC, 2) AS Branch, {_z("CASE WHEN Statement = 'BA' THEN GB_AMT END")} AS Assets,
                       {_z("CASE WHEN Statement <> 'BA' THEN -GB_AMT END")} AS Liabilities
                FROM bsl WHERE GB_DATE = {P} GROUP BY right(GB_GLC, 2)) b
          FULL JOIN (SELECT Branch, {_m('NetIncomeImpact')} AS NetIncome FROM is_lines WHERE Period <= {P}
                     GROUP BY Branch) n ON b.Branch = n.Branch)""")
def q_branch_balance_check(spark, sf):
    return st.branch_balance_check(L(spark, sf), lines(spark, sf), P)


@register("live_balance_sheet", f"""
    SELECT CASE WHEN Statement = 'BA' THEN 'Assets' ELSE 'Liabilities and equity' END AS Side, Section, SectionOrder, Amount
    FROM (SELECT s.Statement, s.Section, s.SectionOrder,
                 {_m("CASE WHEN s.Statement = 'BA' THEN s.CA_CUR ELSE -s.CA_CUR END")} AS Amount
          FROM (SELECT t.CA_CUR, s.Section, s.SectionOrder,
                       CASE t.ACLIA WHEN 'A' THEN 'BA' WHEN 'L' THEN 'BL' ELSE s.Statement END AS Statement
                FROM tchart t LEFT JOIN sections s ON s.rule_account = t.CA_ACC WHERE t.ACTYP = '1') s
          GROUP BY s.Statement, s.Section, s.SectionOrder
          UNION ALL
          SELECT 'BE', 'Current and prior net income', 70, {_z('x')} FROM (
              SELECT -CA_CUR AS x FROM tchart WHERE ACTYP IN ('2', '3')
              UNION ALL
              SELECT -j.YJ_AMT FROM journal j JOIN accmast a ON a.ACCO = j.YJ_CO AND a.ACACC = j.YJ_ACC
              WHERE j.period < {Y0} AND a.ACTYP IN ('2', '3')))""")
def q_live_balance_sheet(spark, sf):
    return st.live_balance_sheet(L(spark, sf), CY)


# --- FS12 / FS24 / FS49
_PCT = "CASE WHEN abs(CAST({b} AS DOUBLE)) = 0 THEN NULL ELSE CAST({n} AS DOUBLE) * 100.0 / abs(CAST({b} AS DOUBLE)) END"


def pct(n, b):
    return _PCT.format(n=n, b=b)


@register("yoy_comparison", f"""
    SELECT * FROM (
        SELECT *, CAST(Current - PriorYear AS DECIMAL(18, 2)) AS Variance, {pct('Current - PriorYear', 'PriorYear')} AS VariancePct
        FROM (SELECT Company, AccountNumber, AccountName, Section,
                     {_z(f'CASE WHEN Period = {P} THEN NetIncomeImpact END')} AS Current,
                     {_z(f'CASE WHEN Period = {PY_P} THEN NetIncomeImpact END')} AS PriorYear
              FROM is_lines WHERE Period IN ({P}, {PY_P}) GROUP BY Company, AccountNumber, AccountName, Section))
    WHERE VariancePct IS NULL OR abs(VariancePct) >= 10.0""")
def q_yoy_comparison(spark, sf):
    return st.yoy_comparison(lines(spark, sf), P, min_variance_pct=10.0)


@register("comparative_statements", f"""
    SELECT Section, SectionOrder, {_z(f'CASE WHEN Period = {P} THEN NetIncomeImpact END')} AS Current,
           {_z(f'CASE WHEN Period = {PREV} THEN NetIncomeImpact END')} AS PriorPeriod,
           {_z(f'CASE WHEN Period = {PY_P} THEN NetIncomeImpact END')} AS PriorYear
    FROM is_lines WHERE Period IN ({P}, {PREV}, {PY_P}) GROUP BY Section, SectionOrder""")
def q_comparative_statements(spark, sf):
    return st.comparative_statements(lines(spark, sf), P)


@register("period_compare", f"""
    SELECT Section, SectionOrder, PeriodA, PeriodB, CAST(PeriodA - PeriodB AS DECIMAL(18, 2)) AS Change
    FROM (SELECT Section, SectionOrder, {_z(f'CASE WHEN Period = {P} THEN NetIncomeImpact END')} AS PeriodA,
                 {_z(f'CASE WHEN Period = {PY}12 THEN NetIncomeImpact END')} AS PeriodB
          FROM is_lines WHERE Period IN ({P}, {PY}12) GROUP BY Section, SectionOrder)""")
def q_period_compare(spark, sf):
    return st.period_compare(lines(spark, sf), P, f"{PY}12")


# --- FS13 - FS16
@register("data_freshness", f"""
    SELECT *, CAST({midx('(SELECT max(period) FROM journal)')} - {midx('LatestPeriod')} AS INTEGER) AS AgeMonths FROM (
        SELECT 'journal' AS TableName, COUNT(*) AS Rows, max(period) AS LatestPeriod FROM journal
        UNION ALL SELECT 'glcal', COUNT(*), max(GB_DATE) FROM glcal
        UNION ALL SELECT 'glfis', COUNT(*), max(GF_YR) * 100 + 12 FROM glfis
        UNION ALL SELECT 'deptmast', COUNT(*), CAST(NULL AS INTEGER) FROM deptmast
        UNION ALL SELECT 'coacmast', COUNT(*), CAST(NULL AS INTEGER) FROM coacmast)""")
def q_data_freshness(spark, sf):
    return st.data_freshness(L(spark, sf))


@register("data_freshness_rows", f"""
    SELECT TableName, COUNT(*) AS Rows, max(m) AS LatestRowUtc, CAST(date_diff('second', max(m), TIMESTAMP '2001-03-10 00:00:00') AS BIGINT) AS SecondsSinceLatest
    FROM (SELECT 'orders' AS TableName, DateModifiedUtc AS m FROM merged
          UNION ALL SELECT 'snapshots', DateModifiedUtc FROM snap_rows) GROUP BY TableName""",
          [*_INGEST.SNAP, ("snap_rows", "SELECT SourceLastSeenUtc AS DateModifiedUtc FROM snap")])
def q_data_freshness_rows(spark, sf):
    tables = {"orders": LD.current_orders(spark, sf), "snapshots": LD.snapshot_table(spark, sf).withColumnRenamed("SourceLastSeenUtc", "DateModifiedUtc")}
    return st.row_freshness(tables, dt.datetime(2001, 3, 10), "DateModifiedUtc")


@register("intercompany_check", f"""
    SELECT CASE WHEN GROUPING(GB_CO) = 1 THEN 'Total' ELSE GB_CO END AS Company, {_m('GB_AMT')} AS Balance,
           GROUPING(GB_CO) = 1 AND abs(SUM(GB_AMT)) > {fixed.BALANCE_TOLERANCE} AS OutOfBalance
    FROM glcal WHERE GB_DATE = {P} AND GB_GLA = '27400' GROUP BY ROLLUP (GB_CO)""")
def q_intercompany_check(spark, sf):
    return st.intercompany_check(L(spark, sf), P)


@register("unmapped_accounts", f"""
    SELECT g.GB_CO, g.GB_GLA, c.CA_GLFA IS NULL AS MissingFromChart, COUNT(*) AS Keys, {_m('g.GB_AMT')} AS Amount
    FROM glcal g LEFT JOIN coacmast c ON c.CA_CO = g.GB_CO AND c.CA_DIV = g.GB_DIV AND c.CA_ACC = g.GB_GLA AND c.CA_CC = g.GB_GLC
    WHERE g.GB_DATE = {P} AND g.GB_AMT <> 0 AND coalesce(c.CA_GLFA, '') = ''
    GROUP BY g.GB_CO, g.GB_GLA, c.CA_GLFA IS NULL""")
def q_unmapped_accounts(spark, sf):
    return st.unmapped_accounts(L(spark, sf), P)


@register("orphan_accounts", f"""
    SELECT GB_CO, GB_DIV, GB_GLC, GB_GLA, COUNT(*) AS Rows, {_m('GB_AMT')} AS Amount, min(GB_DATE) AS FirstPeriod,
           max(GB_DATE) AS LastPeriod
    FROM glcal g WHERE NOT EXISTS (SELECT 1 FROM coacmast c WHERE c.CA_CO = g.GB_CO AND c.CA_DIV = g.GB_DIV
                                   AND c.CA_CC = g.GB_GLC AND c.CA_ACC = g.GB_GLA)
    GROUP BY GB_CO, GB_DIV, GB_GLC, GB_GLA""")
def q_orphan_accounts(spark, sf):
    return st.orphan_accounts(L(spark, sf))


# --- FS17 / FS18 / FS19 / FS46
_SUBLINES = " ".join(
    f"UNION ALL SELECT '{label}', {order}, Department, Measure, v FROM dm_base WHERE SectionOrder <= {last}"
    for label, order, last in fixed.PL_SUBTOTALS)
DEPTS = [("2", "Sales"), ("3", "Service"), ("4", "Parts"), ("5", "Rental"), ("1", "Admin"), (None, "Other")]


def _is_dept(d) -> str:
    named = ", ".join(repr(k) for k, _ in DEPTS if k)
    return f"Department = {d!r}" if d else f"coalesce(Department, '') NOT IN ({named})"


def _dept_sql() -> str:
    cols = ", ".join(f"{_z(f'CASE WHEN {_is_dept(d)} THEN v END')} AS {n}" for d, n in DEPTS)
    base = f"""
    SELECT *, CAST(Sales + TotalFixed + Admin + Other AS DECIMAL(18, 2)) AS Total FROM (
    SELECT *, CAST(Service + Parts + Rental AS DECIMAL(18, 2)) AS TotalFixed FROM (
    SELECT Line, LineOrder, Measure, {cols} FROM (
        SELECT Section AS Line, SectionOrder AS LineOrder, Department, Measure, v FROM dm_base {_SUBLINES})
    GROUP BY Line, LineOrder, Measure))"""
    rc = ["Sales", "Service", "Parts", "Rental", "Admin", "Other", "TotalFixed", "Total"]
    pcts = ", ".join(f"CAST({pct(f'c.{x}', f'r.{x}')} AS DECIMAL(18, 2)) AS {x}" for x in rc)
    return f"""
    SELECT * FROM ({base}) UNION ALL
    SELECT c.Line, c.LineOrder, 'PctOfRevenue', {pcts}
    FROM ({base}) c JOIN ({base}) r ON r.Measure = c.Measure AND r.Line = 'Total revenue'
    WHERE c.Measure = 'Current'"""


def _dept_ctes(account_filter: str = ""):
    prev12 = (P // 100 - 1) * 100 + P % 100
    return [
        ("dept_base", f"""SELECT Section, SectionOrder, Department, Period, {_m('NetIncomeImpact')} AS v FROM is_lines
                          WHERE Period BETWEEN {prev12} AND {P} {account_filter}
                          GROUP BY Section, SectionOrder, Department, Period"""),
        ("dm_base", f"""SELECT Section, SectionOrder, Department, 'Current' AS Measure, v FROM dept_base WHERE Period = {P}
              UNION ALL SELECT Section, SectionOrder, Department, 'PriorMonth', v FROM dept_base WHERE Period = {PREV}
              UNION ALL SELECT Section, SectionOrder, Department, 'Change', v FROM dept_base WHERE Period = {P}
              UNION ALL SELECT Section, SectionOrder, Department, 'Change', -v FROM dept_base WHERE Period = {PREV}
              UNION ALL SELECT Section, SectionOrder, Department, 'YTD', v FROM dept_base WHERE Period BETWEEN {Y0} AND {P}"""),
    ]


@register("departmental_pnl", _dept_sql(), extra_ctes=_dept_ctes())
def q_departmental_pnl(spark, sf):
    return rp.departmental_pnl(lines(spark, sf), P)


@register("per_brand_pnl", _dept_sql(), extra_ctes=_dept_ctes("AND AccountNumber IN ('31001', '41001')"))
def q_per_brand_pnl(spark, sf):
    return rp.per_brand_pnl(lines(spark, sf), P, "Brand A")


@register("departmental_pnl_detail", f"""
    SELECT Section, SectionOrder, AccountNumber, AccountName,
           {_z(f'CASE WHEN Period = {P} THEN NetIncomeImpact END')} AS Current,
           {_z(f'CASE WHEN Period = {PREV} THEN NetIncomeImpact END')} AS PriorMonth,
           {_z(f'CASE WHEN Period = {P} THEN NetIncomeImpact WHEN Period = {PREV} THEN -NetIncomeImpact END')} AS Change,
           {_z(f'CASE WHEN Period BETWEEN {Y0} AND {P} THEN NetIncomeImpact END')} AS YTD
    FROM is_lines WHERE Period BETWEEN {(P // 100 - 1) * 100 + P % 100} AND {P} AND Department = '4'
    GROUP BY Section, SectionOrder, AccountNumber, AccountName""")
def q_departmental_pnl_detail(spark, sf):
    return rp.departmental_pnl_detail(lines(spark, sf), P, "4")


_SUB_STRUCT = " ".join(
    f"UNION ALL SELECT '{label}', {order}, Current, YTD FROM s WHERE SectionOrder <= {last}"
    for label, order, last in fixed.PL_SUBTOTALS)


@register("structured_income_statement", f"""
    SELECT Line, LineOrder, {_m('Current')} AS Current, {_m('YTD')} AS YTD FROM (
        WITH s AS (SELECT Section, SectionOrder, {_z(f'CASE WHEN Period = {P} THEN NetIncomeImpact END')} AS Current,
                          {_m('NetIncomeImpact')} AS YTD FROM is_lines WHERE Period BETWEEN {Y0} AND {P}
                   GROUP BY Section, SectionOrder)
        SELECT Section AS Line, SectionOrder AS LineOrder, Current, YTD FROM s {_SUB_STRUCT})
    GROUP BY Line, LineOrder""")
def q_structured_income_statement(spark, sf):
    return rp.structured_income_statement(lines(spark, sf), P)


# --- FS22 / FS23
_CF = [
    ("cf_ni", f"SELECT * FROM is_lines WHERE Period > {PY_P} AND Period <= {P}"),
    ("cf_da", "SELECT CAST(-coalesce(SUM(NetIncomeImpact), 0) AS DECIMAL(18, 2)) AS Amount FROM cf_ni WHERE SectionOrder = 120"),
    ("cf_delta", f"""SELECT Section, SectionOrder, {_m('d')} AS delta FROM (
                SELECT Section, SectionOrder, -GB_AMT AS d FROM bsl WHERE GB_DATE = {PY_P}
                UNION ALL SELECT Section, SectionOrder, GB_AMT FROM bsl WHERE GB_DATE = {P})
              GROUP BY Section, SectionOrder"""),
    ("cf_explained", f"""SELECT Line, LineOrder, {_m('Amount')} AS Amount FROM (
        SELECT 'Net income' AS Line, 100 AS LineOrder, CAST(coalesce(SUM(NetIncomeImpact), 0) AS DECIMAL(18, 2)) AS Amount FROM cf_ni
        UNION ALL SELECT 'Depreciation and amortization', 110, Amount FROM cf_da
        UNION ALL SELECT 'Change in fixed assets net', 240, -Amount FROM cf_da
        UNION ALL SELECT 'Change in ' || lower(Section), SectionOrder + 200, -delta FROM cf_delta WHERE Section <> 'Cash')
        GROUP BY Line, LineOrder"""),
    ("cf_cash", "SELECT CAST(coalesce(SUM(delta), 0) AS DECIMAL(18, 2)) AS Amount FROM cf_delta WHERE Section = 'Cash'"),
]


@register("cash_flow_indirect", """
    SELECT * FROM cf_explained
    UNION ALL SELECT 'Net change in cash', 900, Amount FROM cf_cash
    UNION ALL SELECT 'Residual', 950, CAST((SELECT Amount FROM cf_cash) - (SELECT SUM(Amount) FROM cf_explained) AS DECIMAL(18, 2))""",
          extra_ctes=_CF)
def q_cash_flow_indirect(spark, sf):
    return rp.cash_flow_indirect(L(spark, sf), lines(spark, sf), PY_P, P)


@register("retained_earnings", f"""
    SELECT Company, Opening, NetIncome, CAST(0 AS DECIMAL(18, 2)) AS Distributions,
           CAST(Opening + NetIncome AS DECIMAL(18, 2)) AS Closing
    FROM (SELECT Company, {_z(f'CASE WHEN Period < {Y0} THEN NetIncomeImpact END')} AS Opening,
                 {_z(f'CASE WHEN Period >= {Y0} THEN NetIncomeImpact END')} AS NetIncome
          FROM is_lines WHERE Period <= {P} GROUP BY Company)""")
def q_retained_earnings(spark, sf):
    return rp.retained_earnings(lines(spark, sf), P)


@register("retained_earnings_distributions", f"""
    SELECT Company, Opening, NetIncome, Distributions, CAST(Opening + NetIncome - Distributions AS DECIMAL(18, 2)) AS Closing
    FROM (SELECT r.*, CAST(CAST(coalesce(d.cents, 0) AS DECIMAL(18, 0)) * CAST(0.01 AS DECIMAL(3, 2)) AS DECIMAL(18, 2)) AS Distributions
          FROM (SELECT Company, {_z(f'CASE WHEN Period < {Y0} THEN NetIncomeImpact END')} AS Opening,
                       {_z(f'CASE WHEN Period >= {Y0} THEN NetIncomeImpact END')} AS NetIncome
                FROM is_lines WHERE Period <= {P} GROUP BY Company) r
          LEFT JOIN (SELECT GB_CO, SUM(CASE WHEN GB_DATE = {P} THEN cents ELSE -cents END) AS cents FROM det
                     WHERE acc = '27550' AND GB_DATE IN ({PY}12, {P}) GROUP BY GB_CO) d ON d.GB_CO = r.Company)""", DETAIL[:1])
def q_retained_earnings_distributions(spark, sf):
    led = L(spark, sf)
    bal = detailed_balances(st.bs_lines(led, [PY * 100 + 12, P]).select(*led.glcal.columns))
    return rp.retained_earnings(lines(spark, sf), P, rp.distributions(bal, fixed.DISTRIBUTION_ACCOUNTS, P))


# --- FS25 - FS27, FS29, FS30
@register("live_ytd", f"""
    SELECT CA_CO AS Company, CAST(-SUM(CA_CUR) AS DECIMAL(18, 2)) AS LiveYTD FROM tchart
    WHERE ACTYP IN ('2', '3') AND coalesce(ACSTA, '') <> 'D' GROUP BY CA_CO""")
def q_live_ytd(spark, sf):
    return rp.live_ytd(L(spark, sf))


@register("unclosed_activity", """
    SELECT CA_CO AS Company, CAST(-SUM(CA_CUR - CA_YTD) AS DECIMAL(18, 2)) AS UnclosedNetIncome FROM tchart
    WHERE ACTYP IN ('2', '3') GROUP BY CA_CO""")
def q_unclosed_activity(spark, sf):
    return rp.unclosed_activity(L(spark, sf))


@register("unclosed_monthly_pnl", f"""
    SELECT period AS Period, CAST(-{_z("CASE WHEN ACTYP = '2' THEN amt END")} AS DECIMAL(18, 2)) AS Revenue,
           {_z("CASE WHEN ACTYP = '3' THEN amt END")} AS Expense,
           CAST(-{_z("CASE WHEN ACTYP IN ('2', '3') THEN amt END")} AS DECIMAL(18, 2)) AS NetIncome
    FROM (SELECT j.YJ_CO, j.YJ_ACC, j.period, {_m('j.YJ_AMT')} AS amt FROM journal j WHERE j.period > {P}
          GROUP BY j.YJ_CO, j.YJ_ACC, j.period) x
    JOIN accmast a ON a.ACCO = x.YJ_CO AND a.ACACC = x.YJ_ACC GROUP BY period""")
def q_unclosed_monthly_pnl(spark, sf):
    return rp.unclosed_monthly_pnl(L(spark, sf))


@register("ttm_run_rate", """
    SELECT CA_CO AS Company, CAST(-SUM(CASE WHEN ACTYP = '2' THEN CA_L12 ELSE 0 END) AS DECIMAL(18, 2)) AS RevenueTTM,
           CAST(SUM(CASE WHEN ACTYP = '3' THEN CA_L12 ELSE 0 END) AS DECIMAL(18, 2)) AS ExpenseTTM,
           CAST(-SUM(CA_L12) AS DECIMAL(18, 2)) AS NetIncomeTTM
    FROM tchart WHERE ACTYP IN ('2', '3') GROUP BY CA_CO""")
def q_ttm_run_rate(spark, sf):
    return rp.ttm_run_rate(L(spark, sf))


@register("closed_plus_unclosed", f"""
    SELECT 'Closed' AS Block, Period, {_m('NetIncomeImpact')} AS NetIncome FROM is_lines WHERE PeriodYear = {CY}
    GROUP BY Period
    UNION ALL
    SELECT 'Unclosed', CAST(NULL AS INTEGER), CAST(-SUM(CA_CUR - CA_YTD) AS DECIMAL(18, 2)) FROM tchart
    WHERE ACTYP IN ('2', '3')""")
def q_closed_plus_unclosed(spark, sf):
    return rp.closed_plus_unclosed(L(spark, sf), lines(spark, sf))


# --- FS31 / FS32
@register("pivot_matrix", f"""
    SELECT p.*, a.ACNME, c.CA_GLFA FROM (
        SELECT GB_CO, GB_DIV, GB_GLC, GB_GLA,
               {', '.join(f'CAST(SUM(CASE WHEN GB_DATE = {PY}{m:02d} THEN GB_AMT END) AS DECIMAL(18, 2)) AS M{PY}{m:02d}' for m in range(1, 13))}
        FROM glcal WHERE GB_DATE BETWEEN {PY}01 AND {PY}12 GROUP BY GB_CO, GB_DIV, GB_GLC, GB_GLA) p
    LEFT JOIN accmast a ON a.ACCO = p.GB_CO AND a.ACACC = p.GB_GLA
    LEFT JOIN coacmast c ON c.CA_CO = p.GB_CO AND c.CA_DIV = p.GB_DIV AND c.CA_CC = p.GB_GLC AND c.CA_ACC = p.GB_GLA""")
def q_pivot_matrix(spark, sf):
    return rp.pivot_matrix(L(spark, sf), PY)


@register("monthly_named", f"""
    SELECT g.GB_CO, g.GB_DIV, g.GB_GLC, g.GB_GLA, rtrim(a.ACNME) AS AccountName, c.CA_GLFA, g.GB_DATE, g.GB_AMT
    FROM glcal g LEFT JOIN accmast a ON a.ACCO = g.GB_CO AND a.ACACC = g.GB_GLA
    LEFT JOIN coacmast c ON c.CA_CO = g.GB_CO AND c.CA_DIV = g.GB_DIV AND c.CA_CC = g.GB_GLC AND c.CA_ACC = g.GB_GLA
    WHERE g.GB_DATE BETWEEN {Y0} AND {P}""")
def q_monthly_named(spark, sf):
    return rp.monthly_named(L(spark, sf), Y0, P)


# --- FS33 - FS36, FS40 - FS42
@register("cash_summary", f"""
    SELECT Branch, Cash, Receivables, Inventory, FloorPlan,
           CAST(Cash + Receivables + Inventory - FloorPlan AS DECIMAL(18, 2)) AS NetCash,
           CAST(Inventory - FloorPlan AS DECIMAL(18, 2)) AS NetEquity
    FROM (SELECT right(GB_GLC, 2) AS Branch, {_z("CASE WHEN Section = 'Cash' THEN GB_AMT END")} AS Cash,
                 {_z("CASE WHEN Section = 'Receivables' THEN GB_AMT END")} AS Receivables,
                 {_z("CASE WHEN Section = 'Wholegoods inventory' THEN GB_AMT END")} AS Inventory,
                 {_z("CASE WHEN Section = 'Floorplan payable' THEN -GB_AMT END")} AS FloorPlan
          FROM bsl WHERE GB_DATE = {P} GROUP BY right(GB_GLC, 2))""")
def q_cash_summary(spark, sf):
    return rp.cash_summary(L(spark, sf), lines(spark, sf), P)


@register("cash_equivalents", f"""
    SELECT *, CAST(CashInBank + ContractsInTransit + VehicleReceivables AS DECIMAL(18, 2)) AS TotalCashEquivalents FROM (
      SELECT right(GB_GLC, 2) AS Branch, """ + ", ".join(
    f"CAST(CAST(coalesce(SUM(CASE WHEN {w} THEN cents END), 0) AS DECIMAL(18, 0)) * CAST(0.01 AS DECIMAL(3, 2)) AS DECIMAL(18, 2)) AS {n}"
    for n, w in (("CashInBank", "acc IN ('10113', '10114', '10140', '10151')"), ("ContractsInTransit", "acc = '10170'"), ("VehicleReceivables", "acc = '10200'")))
    + f""" FROM det WHERE GB_DATE = {P} AND (acc LIKE '101%' OR acc = '10200') GROUP BY right(GB_GLC, 2))""", DETAIL[:1])
def q_cash_equivalents(spark, sf):
    led = L(spark, sf)
    return rp.cash_equivalents(detailed_balances(st.bs_lines(led, P).select(*led.glcal.columns)), P)


@register("cash_detail", f"""
    SELECT right(GB_GLC, 2) AS Branch, Section, GB_GLA AS Account, rtrim(ACNME) AS AccountName, {_m('GB_AMT')} AS Balance
    FROM bsl WHERE GB_DATE = {P} GROUP BY ALL""")
def q_cash_detail(spark, sf):
    return rp.cash_detail(L(spark, sf), P)


@register("sales_and_gross", f"""
    SELECT *, {pct('GrossMargin', 'Revenue')} AS MarginPct FROM (
        SELECT *, CAST(Revenue - CostOfSales AS DECIMAL(18, 2)) AS GrossMargin FROM (
            SELECT b.Brand, l.Branch,
                   CAST(-{_z("CASE WHEN substr(l.AccountNumber, 1, 1) = '3' THEN l.Amount END")} AS DECIMAL(18, 2)) AS Revenue,
                   {_z("CASE WHEN substr(l.AccountNumber, 1, 1) = '4' THEN l.Amount END")} AS CostOfSales
            FROM is_lines l JOIN brands b ON b.brand_account = l.AccountNumber
            WHERE l.Period BETWEEN {PY}01 AND {PY}12 GROUP BY b.Brand, l.Branch))""")
def q_sales_and_gross(spark, sf):
    return rp.sales_and_gross(lines(spark, sf), PY * 100 + 1, PY * 100 + 12)


@register("branch_scorecard", f"""
    SELECT *, {pct('GrossMargin', 'Revenue')} AS GrossMarginPct FROM (
        SELECT Branch, {_z('CASE WHEN SectionOrder <= 40 THEN NetIncomeImpact END')} AS Revenue,
               {_z('CASE WHEN SectionOrder <= 80 THEN NetIncomeImpact END')} AS GrossMargin,
               {_z('CASE WHEN SectionOrder > 80 AND SectionOrder <= 130 THEN NetIncomeImpact END')} AS OperatingExpense,
               {_z('CASE WHEN SectionOrder <= 130 THEN NetIncomeImpact END')} AS NetIncome
        FROM is_lines WHERE Period BETWEEN {PY}01 AND {PY}12 GROUP BY Branch)""")
def q_branch_scorecard(spark, sf):
    return rp.branch_scorecard(lines(spark, sf), PY * 100 + 1, PY * 100 + 12)


@register("cost_center_pnl", f"""
    SELECT CostCenter, Department, Branch, {_m('NetIncomeImpact')} AS NetIncome FROM is_lines
    WHERE Period BETWEEN {PY}01 AND {PY}12 GROUP BY CostCenter, Department, Branch""")
def q_cost_center_pnl(spark, sf):
    return rp.cost_center_pnl(lines(spark, sf), PY * 100 + 1, PY * 100 + 12)


@register("contribution_margin", f"""
    SELECT *, CAST(Revenue - DirectCosts AS DECIMAL(18, 2)) AS ContributionMargin FROM (
        SELECT Department, {_z('CASE WHEN SectionOrder <= 40 THEN NetIncomeImpact END')} AS Revenue,
               CAST(-{_z('CASE WHEN SectionOrder > 40 AND SectionOrder <= 90 THEN NetIncomeImpact END')} AS DECIMAL(18, 2)) AS DirectCosts
        FROM is_lines WHERE Period BETWEEN {PY}01 AND {PY}12 GROUP BY Department)""")
def q_contribution_margin(spark, sf):
    return rp.contribution_margin(lines(spark, sf), PY * 100 + 1, PY * 100 + 12)


@register("ratios", """
    SELECT Period, CurrentAssets, CurrentLiabilities,
           CASE WHEN CAST(CurrentLiabilities AS DOUBLE) <> 0 THEN CAST(CurrentAssets AS DOUBLE) / CAST(CurrentLiabilities AS DOUBLE) END AS CurrentRatio,
           CASE WHEN CAST(CurrentLiabilities AS DOUBLE) <> 0 THEN CAST(QuickAssets AS DOUBLE) / CAST(CurrentLiabilities AS DOUBLE) END AS QuickRatio,
           CAST(CurrentAssets - CurrentLiabilities AS DECIMAL(18, 2)) AS WorkingCapital
    FROM (SELECT GB_DATE AS Period,
                 CAST(coalesce(SUM(CASE WHEN GB_GLA IN ('10100', '10200', '12000') THEN GB_AMT END), 0) AS DECIMAL(18, 2)) AS CurrentAssets,
                 CAST(coalesce(SUM(CASE WHEN GB_GLA IN ('10100', '10200') THEN GB_AMT END), 0) AS DECIMAL(18, 2)) AS QuickAssets,
                 CAST(coalesce(SUM(CASE WHEN GB_GLA IN ('20350') THEN -GB_AMT END), 0) AS DECIMAL(18, 2)) AS CurrentLiabilities
          FROM bsl GROUP BY GB_DATE)""")
def q_ratios(spark, sf):
    return rp.ratios(L(spark, sf))


_KPI_SQL = ("kpi", f"""
    SELECT coalesce(f.Company, s.Company) AS Company, f.EquipmentSales,
           CASE WHEN CAST(s.Inventory AS DOUBLE) <> 0 THEN CAST(f.CostOfSalesTTM AS DOUBLE) / CAST(s.Inventory AS DOUBLE) END AS InventoryTurns,
           CASE WHEN CAST(s.Inventory AS DOUBLE) <> 0 THEN CAST(s.FloorPlan AS DOUBLE) / CAST(s.Inventory AS DOUBLE) END AS FloorplanCoverage,
           {pct('f.PartsRevenue - f.PartsCost', 'f.PartsRevenue')} AS PartsMarginPct,
           CASE WHEN CAST(f.ServiceCost AS DOUBLE) <> 0 THEN CAST(f.ServiceRevenue AS DOUBLE) / CAST(f.ServiceCost AS DOUBLE) END AS LaborRecovery,
           CAST(f.RentalRevenue - f.RentalCost AS DECIMAL(18, 2)) AS RentalContribution
    FROM (SELECT Company,
                 {_z("CASE WHEN AccountNumber IN ('31001', '31500', '32000') THEN NetIncomeImpact END")} AS EquipmentSales,
                 {_z("CASE WHEN AccountNumber IN ('41001', '41500', '42000', '43100', '44000', '45000') THEN -NetIncomeImpact END")} AS CostOfSalesTTM,
                 {_z("CASE WHEN AccountNumber IN ('33100') THEN NetIncomeImpact END")} AS PartsRevenue,
                 {_z("CASE WHEN AccountNumber IN ('43100') THEN -NetIncomeImpact END")} AS PartsCost,
                 {_z("CASE WHEN AccountNumber IN ('34000') THEN NetIncomeImpact END")} AS ServiceRevenue,
                 {_z("CASE WHEN AccountNumber IN ('44000') THEN -NetIncomeImpact END")} AS ServiceCost,
                 {_z("CASE WHEN AccountNumber IN ('35000') THEN NetIncomeImpact END")} AS RentalRevenue,
                 {_z("CASE WHEN AccountNumber IN ('45000') THEN -NetIncomeImpact END")} AS RentalCost
          FROM is_lines WHERE Period BETWEEN {PY}03 AND {P} GROUP BY Company) f
    FULL JOIN (SELECT GB_CO AS Company, {_z("CASE WHEN GB_GLA = '12000' THEN GB_AMT END")} AS Inventory,
                      CAST(-{_z("CASE WHEN GB_GLA = '20350' THEN GB_AMT END")} AS DECIMAL(18, 2)) AS FloorPlan
               FROM bsl WHERE GB_DATE = {P} GROUP BY GB_CO) s ON f.Company = s.Company""")
@register("equipment_by_condition", f"""
    SELECT *, CAST(Revenue - CostOfSales AS DECIMAL(18, 2)) AS GrossMargin, {pct('Revenue - CostOfSales', 'Revenue')} AS MarginPct FROM (
      SELECT Company, CASE WHEN AccountNumber IN ('31001', '31500', '41001', '41500') THEN 'New' ELSE 'Used' END AS Condition,
             {_z("CASE WHEN AccountNumber LIKE '3%' THEN NetIncomeImpact END")} AS Revenue,
             {_z("CASE WHEN AccountNumber LIKE '4%' THEN -NetIncomeImpact END")} AS CostOfSales
      FROM is_lines WHERE Period BETWEEN {PY}03 AND {P} AND AccountNumber IN ('31001', '31500', '32000', '41001', '41500', '42000') GROUP BY ALL)""")
def q_equipment_by_condition(spark, sf):
    return rp.equipment_by_condition(lines(spark, sf), PY * 100 + 3, P)


_KPIS = {"equipment_sales": "EquipmentSales", "inventory_turns": "InventoryTurns",
         "floorplan_coverage": "FloorplanCoverage", "parts_margin_pct": "PartsMarginPct",
         "labor_recovery": "LaborRecovery", "rental_performance": "RentalContribution"}


def _kpi_query(col):
    def run(spark, sf):
        return rp.dealer_kpis(L(spark, sf), lines(spark, sf), P).select("Company", col)
    return run


for _key, _col in _KPIS.items():
    register(_key, f"SELECT Company, {_col} FROM kpi", extra_ctes=[_KPI_SQL])(_kpi_query(_col))


@register("cogs_vs_default", f"""
    SELECT coalesce(r.Company, c.Company) AS Company, coalesce(r.CostCenter, c.CostCenter) AS CostCenter,
           c.RightAccount, r.LeftAmount, c.RightAmount,
           CASE WHEN CAST(r.LeftAmount AS DOUBLE) <> 0 THEN CAST(c.RightAmount AS DOUBLE) * 100.0 / abs(CAST(r.LeftAmount AS DOUBLE)) END AS ActualPct,
           CAST(d.DefaultPct AS DOUBLE) * 100.0 AS DefaultPct
    FROM (SELECT Company, CostCenter, substr(AccountNumber, 2, 4) AS suffix, AccountNumber AS LeftAccount,
                 {_m('Amount')} AS LeftAmount FROM is_lines WHERE substr(AccountNumber, 1, 1) = '3'
                 AND Period BETWEEN {PY}01 AND {PY}12 GROUP BY ALL) r
    FULL JOIN (SELECT Company, CostCenter, substr(AccountNumber, 2, 4) AS suffix, AccountNumber AS RightAccount,
                      {_m('Amount')} AS RightAmount FROM is_lines WHERE substr(AccountNumber, 1, 1) = '4'
                      AND Period BETWEEN {PY}01 AND {PY}12 GROUP BY ALL) c
      ON r.Company = c.Company AND r.CostCenter = c.CostCenter AND r.suffix = c.suffix
    LEFT JOIN (SELECT CA_CO, CA_CC, CA_ACC, max(CA_GLCP) AS DefaultPct FROM coacmast GROUP BY ALL) d
      ON d.CA_CO = coalesce(r.Company, c.Company) AND d.CA_CC = coalesce(r.CostCenter, c.CostCenter) AND d.CA_ACC = c.RightAccount
    WHERE c.RightAccount IS NOT NULL""")
def q_cogs_vs_default(spark, sf):
    return rp.cogs_vs_default(L(spark, sf), lines(spark, sf), PY * 100 + 1, PY * 100 + 12)


# --- FS37
@register("quarterly_summary", """
    SELECT PeriodYear, CAST((PeriodMonth - 1) // 3 + 1 AS INTEGER) AS Quarter, Section,
           CAST(SUM(NetIncomeImpact) AS DECIMAL(18, 2)) AS NetIncome FROM is_lines GROUP BY ALL""")
def q_quarterly_summary(spark, sf):
    return rp.quarterly_summary(lines(spark, sf))


@register("ytd_prior_ytd", f"""
    SELECT *, CAST(YTD - PriorYTD AS DECIMAL(18, 2)) AS Change FROM (
        SELECT Section, SectionOrder, {_z(f'CASE WHEN Period BETWEEN {Y0} AND {P} THEN NetIncomeImpact END')} AS YTD,
               {_z(f'CASE WHEN Period BETWEEN {Y0 - 100} AND {PY_P} THEN NetIncomeImpact END')} AS PriorYTD
        FROM is_lines WHERE Period BETWEEN {Y0 - 100} AND {P} GROUP BY Section, SectionOrder)""")
def q_ytd_prior_ytd(spark, sf):
    return rp.ytd_prior_ytd(lines(spark, sf), P)


@register("five_year_trend", "SELECT Section, SectionOrder, " + ", ".join(
    f"CAST(SUM(CASE WHEN PeriodYear = {y} THEN NetIncomeImpact END) AS DECIMAL(18, 2)) AS Y{y}" for y in range(PY - 4, PY + 1))
    + f" FROM is_lines WHERE PeriodYear BETWEEN {PY - 4} AND {PY} GROUP BY Section, SectionOrder")
def q_five_year_trend(spark, sf):
    return rp.five_year_trend(lines(spark, sf), PY)


@register("rolling_12_pnl", f"""
    SELECT Company, Period, NetIncome,
           CAST(SUM(NetIncome) OVER (PARTITION BY Company ORDER BY {midx('Period')} RANGE BETWEEN 11 PRECEDING AND CURRENT ROW)
                AS DECIMAL(18, 2)) AS Rolling12NetIncome
    FROM (SELECT Company, Period, {_m('NetIncomeImpact')} AS NetIncome FROM is_lines GROUP BY Company, Period)""")
def q_rolling_12_pnl(spark, sf):
    return rp.rolling_12_pnl(lines(spark, sf))


# --- FS38 / FS39
@register("consolidated_pnl", f"""
    SELECT *, CAST(Combined - Eliminations AS DECIMAL(18, 2)) AS Consolidated FROM (
        SELECT Section, SectionOrder, {_m('NetIncomeImpact')} AS Combined,
               {_z("CASE WHEN AccountNumber IN ('10180', '10182', '24900', '27400') THEN NetIncomeImpact END")} AS Eliminations
        FROM is_lines WHERE Period = {P} GROUP BY Section, SectionOrder)""")
def q_consolidated_pnl(spark, sf):
    return rp.consolidated_pnl(lines(spark, sf), P)


@register("intercompany_netting", f"""
    SELECT *, CAST(DueFrom - DueTo AS DECIMAL(18, 2)) AS Net, Residual = 0 AS Balanced FROM (
      SELECT least(co, '01') AS CompanyA, greatest(co, '01') AS CompanyB, COUNT(*) AS Postings,
             CAST(CAST(SUM(CASE WHEN co = '01' THEN di ELSE 0 END) AS DECIMAL(18, 0)) * CAST(0.01 AS DECIMAL(3, 2)) AS DECIMAL(18, 2)) AS DueFrom,
             CAST(CAST(SUM(di) AS DECIMAL(18, 0)) * CAST(0.01 AS DECIMAL(3, 2)) AS DECIMAL(18, 2)) AS DueTo,
             CAST(0 AS DECIMAL(18, 2)) AS Residual
      FROM (SELECT co, c * dp // 100 AS di, CAST(year(ship) * 100 + month(ship) AS INTEGER) AS per FROM jbase WHERE l_linenumber = 1)
      WHERE di <> 0 AND per <= {P} GROUP BY co)""")
def q_intercompany_netting(spark, sf):
    return rp.intercompany_netting(L(spark, sf).journal, fixed.INTERCOMPANY_ACCOUNTS, P)


@register("transfer_nets", f"""
    SELECT *, abs(Net) <= {fixed.BALANCE_TOLERANCE} AS NetsToZero FROM (
      SELECT acc AS Account, CASE WHEN GROUPING(GB_DIV) = 0 THEN GB_DIV ELSE 'all' END AS Division, COUNT(DISTINCT GB_CO) AS Companies,
             CAST(CAST(SUM(cents) AS DECIMAL(18, 0)) * CAST(0.01 AS DECIMAL(3, 2)) AS DECIMAL(18, 2)) AS Net
      FROM det WHERE GB_DATE = {P} AND acc IN ('10180', '24900', '27400') GROUP BY GROUPING SETS ((acc, GB_DIV), (acc)))""", DETAIL[:1])
def q_transfer_nets(spark, sf):
    led = L(spark, sf)
    return rp.transfer_nets(detailed_balances(st.bs_lines(led, P).select(*led.glcal.columns)), fixed.INTERCOMPANY_ACCOUNTS, P)


@register("income_bridge", f"""
    SELECT Section, SectionOrder, CAST(a - b AS DECIMAL(18, 2)) AS Contribution FROM (
        SELECT Section, SectionOrder, {_z(f'CASE WHEN Period = {P} THEN NetIncomeImpact END')} AS a,
               {_z(f'CASE WHEN Period = {PY_P} THEN NetIncomeImpact END')} AS b
        FROM is_lines WHERE Period IN ({P}, {PY_P}) GROUP BY Section, SectionOrder)""")
def q_income_bridge(spark, sf):
    return rp.income_bridge(lines(spark, sf), P, PY_P)


@register("margin_walk", f"""
    SELECT Department, {pct('MarginA', 'RevenueA')} AS MarginPctA, {pct('MarginB', 'RevenueB')} AS MarginPctB FROM (
        SELECT Department,
               {_z(f'CASE WHEN SectionOrder <= 40 AND Period = {P} THEN NetIncomeImpact END')} AS RevenueA,
               {_z(f'CASE WHEN SectionOrder <= 80 AND Period = {P} THEN NetIncomeImpact END')} AS MarginA,
               {_z(f'CASE WHEN SectionOrder <= 40 AND Period = {PY_P} THEN NetIncomeImpact END')} AS RevenueB,
               {_z(f'CASE WHEN SectionOrder <= 80 AND Period = {PY_P} THEN NetIncomeImpact END')} AS MarginB
        FROM is_lines WHERE Period IN ({P}, {PY_P}) GROUP BY Department)""")
def q_margin_walk(spark, sf):
    return rp.margin_walk(lines(spark, sf), P, PY_P)


@register("cfo_dashboard", f"""
    SELECT 'Revenue' AS Metric, {_z('CASE WHEN SectionOrder <= 40 THEN NetIncomeImpact END')} AS Value FROM is_lines WHERE Period = {P}
    UNION ALL SELECT 'GrossMargin', {_z('CASE WHEN SectionOrder <= 80 THEN NetIncomeImpact END')} FROM is_lines WHERE Period = {P}
    UNION ALL SELECT 'EBITDA', {_z('CASE WHEN SectionOrder <= 110 THEN NetIncomeImpact END')} FROM is_lines WHERE Period = {P}
    UNION ALL SELECT 'NetIncome', {_z('CASE WHEN SectionOrder <= 130 THEN NetIncomeImpact END')} FROM is_lines WHERE Period = {P}
    UNION ALL SELECT 'Cash', {_z("CASE WHEN Section = 'Cash' THEN GB_AMT END")} FROM bsl WHERE GB_DATE = {P}
    UNION ALL SELECT 'Receivables', {_z("CASE WHEN Section = 'Receivables' THEN GB_AMT END")} FROM bsl WHERE GB_DATE = {P}""")
def q_cfo_dashboard(spark, sf):
    return rp.cfo_dashboard(L(spark, sf), lines(spark, sf), P)


# --- FS43 - FS45, FS47, FS48, FS50
@register("cnh_alias_rollup", f"""
    SELECT c.CA_CNHA AS SecondAlias, COUNT(*) AS Lines, {_m('g.GB_AMT')} AS Amount
    FROM glcal g JOIN coacmast c ON c.CA_CO = g.GB_CO AND c.CA_DIV = g.GB_DIV AND c.CA_ACC = g.GB_GLA AND c.CA_CC = g.GB_GLC
    WHERE g.GB_DATE = {P} GROUP BY c.CA_CNHA""")
def q_cnh_alias_rollup(spark, sf):
    return rp.second_alias_rollup(L(spark, sf), P)


@register("alias_coverage", f"""
    SELECT *, CAST(MappedKeys AS DOUBLE) * 100.0 / CAST(Keys AS DOUBLE) AS KeyPct,
           {pct('MappedAbsBalance', 'AbsBalance')} AS BalancePct FROM (
        SELECT COUNT(*) AS Keys, CAST(SUM(CASE WHEN coalesce(CA_GLFA, '') <> '' THEN 1 ELSE 0 END) AS BIGINT) AS MappedKeys,
               {_m('abs(CA_CUR)')} AS AbsBalance, {_z("CASE WHEN coalesce(CA_GLFA, '') <> '' THEN abs(CA_CUR) END")} AS MappedAbsBalance
        FROM coacmast)""")
def q_alias_coverage(spark, sf):
    return rp.alias_coverage(L(spark, sf))


@register("multi_alias", """
    SELECT CA_CO AS Company, CA_ACC AS Account, COUNT(DISTINCT CA_GLFA) AS Aliases,
           array_to_string(list_sort(list(DISTINCT CA_GLFA)), ',') AS AliasList
    FROM coacmast WHERE coalesce(CA_GLFA, '') <> '' GROUP BY CA_CO, CA_ACC HAVING COUNT(DISTINCT CA_GLFA) > 1""")
def q_multi_alias(spark, sf):
    return rp.multi_alias(L(spark, sf))


@register("accrual_aging", f"""
    SELECT GB_CO, GB_GLA, arg_max(Balance, GB_DATE) AS LatestBalance, max(GB_DATE) AS LatestPeriod,
           max(CASE WHEN reset THEN GB_DATE END) AS LastResetPeriod, min(GB_DATE) AS FirstPeriod,
           CAST({midx('max(GB_DATE)')} - {midx('coalesce(max(CASE WHEN reset THEN GB_DATE END), min(GB_DATE))')} AS INTEGER) AS MonthsOutstanding
    FROM (SELECT *, Balance = 0 OR sign(Balance) <> sign(coalesce(lag(Balance) OVER (PARTITION BY GB_CO, GB_GLA ORDER BY GB_DATE), Balance)) AS reset
          FROM (SELECT GB_CO, GB_GLA, GB_DATE, {_m('GB_AMT')} AS Balance FROM glcal WHERE GB_GLA IN ('12000', '20350')
                GROUP BY GB_CO, GB_GLA, GB_DATE))
    GROUP BY GB_CO, GB_GLA""")
def q_accrual_aging(spark, sf):
    return rp.accrual_aging(L(spark, sf))


@register("cash_accounts", f"""
    SELECT GB_CO, GB_GLA, GB_DATE, {_m('GB_AMT')} AS Balance FROM bsl
    WHERE ACCT = 'Y' AND GB_DATE BETWEEN {PY}09 AND {P} GROUP BY GB_CO, GB_GLA, GB_DATE""")
def q_cash_accounts(spark, sf):
    return rp.cash_accounts(L(spark, sf), P, 6)


@register("ar_flagged_balances", f"""
    SELECT GB_CO, right(GB_GLC, 2) AS Branch, {_m('GB_AMT')} AS Balance FROM glcal
    WHERE GB_DATE = {P} AND GB_GLA = '10200' GROUP BY GB_CO, right(GB_GLC, 2)""")
def q_ar_flagged_balances(spark, sf):
    return rp.ar_flagged_balances(L(spark, sf), P)


_ALLOC = ["51900", "51910", "54000", "55100", "58200", "58400"]


@register("allocation_analysis", "SELECT AccountNumber, " + ", ".join(
    f"{_z(f'CASE WHEN {_is_dept(d)} THEN Amount END')} AS {n}" for d, n in DEPTS)
    + f" FROM is_lines WHERE Period = {P} AND AccountNumber IN ({', '.join(repr(a) for a in _ALLOC)}) GROUP BY AccountNumber")
def q_allocation_analysis(spark, sf):
    return rp.allocation_analysis(lines(spark, sf), P, _ALLOC)


ADHOC_SQL = ("SELECT GB_CO, GB_DATE, CAST(SUM(GB_AMT) AS DECIMAL(18, 2)) AS Amount FROM glcal "
             f"WHERE GB_DATE >= {PY}01 GROUP BY GB_CO, GB_DATE")


@register("adhoc_select", f"SELECT *, FALSE AS Truncated FROM ({ADHOC_SQL}) LIMIT 5000")
def q_adhoc_select(spark, sf):
    return st.adhoc_select(L(spark, sf), ADHOC_SQL, 5000)


@register("adhoc_run_log", f"""
    SELECT TableName, COUNT(*) AS Runs, max(WatermarkTo) AS WatermarkTo, FALSE AS Truncated FROM runlog WHERE Status = 'COMPLETE' GROUP BY TableName""",
          _INGEST.RUNLOG)
def q_adhoc_run_log(spark, sf):
    return st.adhoc_select(L(spark, sf), "SELECT TableName, COUNT(*) AS Runs, max(WatermarkTo) AS WatermarkTo FROM run_log "
                                         "WHERE Status = 'COMPLETE' GROUP BY TableName", 100)


@register("account_reconcile", """
    SELECT coalesce(a.Company, b.Company) AS Company, coalesce(a.Period, b.Period) AS Period, a.LeftAmount, b.RightAmount,
           CAST(coalesce(a.LeftAmount, 0) - coalesce(b.RightAmount, 0) AS DECIMAL(18, 2)) AS Difference
    FROM (SELECT YJ_CO AS Company, period AS Period, CAST(SUM(YJ_AMT) AS DECIMAL(18, 2)) AS LeftAmount FROM journal
          WHERE YJ_ACC = '16100' GROUP BY YJ_CO, period) a
    FULL JOIN (SELECT YJ_CO AS Company, period AS Period, CAST(SUM(-YJ_AMT) AS DECIMAL(18, 2)) AS RightAmount FROM journal
               WHERE YJ_ACC = '55100' GROUP BY YJ_CO, period) b ON a.Company = b.Company AND a.Period = b.Period""")
def q_account_reconcile(spark, sf):
    return rp.account_reconcile(L(spark, sf).journal, "16100", "55100")
