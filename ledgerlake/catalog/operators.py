"""Registered operator queries: predicates, joins, aggregations, windows, top-k,
set operations and scalar functions (survey sections 2.1, 2.3-2.9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed
from ..functions import columns as C
from ..functions import periods as PR
from ..functions.sections import classify_section
from ..operators import aggregates as AG
from ..operators import joins as JN
from ..operators import sets as SE
from ..operators import topk as TK
from ..operators import windows as WN
from ..oracle import midx, period_of_midx
from ..sources import scan
from ..sources.schemas import GLCAL, GLCAL_KEY, JOURNAL_KEY
from ..plans import quality as Q
from . import register
from .quality import FAULT_CTES
from .common import CY, P, PL_MONTHLY_SQL, PY, SERIES_ACCOUNT, L, lines, pl_monthly

money = C.money
G4 = "GB_CO, GB_DIV, GB_GLC, GB_GLA"

# ======================================================================= 2.1 sources

@register("scan_table", "SELECT * FROM glcal")
def q_scan_table(spark, sf):
    return scan.scan_table(spark, L(spark, sf).path("glcal"), GLCAL)


@register("incremental_pull", "SELECT * FROM journal WHERE YJ_UID > 200101010000000000")
def q_incremental_pull(spark, sf):
    return scan.incremental_pull(L(spark, sf).journal, 200101010000000000)


# ======================================================================= 2.3 predicates

@register("dim_filter", f"SELECT * FROM glcal WHERE GB_CO = '01' AND GB_DIV = '01' AND right(GB_GLC, 2) = '05'")
def q_dim_filter(spark, sf):
    return C.dim_filter(L(spark, sf).glcal, company="1", division=" 1", branch=" 05 ")


_TXT = ("CAST(YJ_DT // 10000 AS VARCHAR) || '-' || lpad(CAST(YJ_DT // 100 % 100 AS VARCHAR), 2, '0') || '-' "
        "|| lpad(CAST(YJ_DT % 100 AS VARCHAR), 2, '0')")
_RX = r"^(\d{4})-?(\d{2})(?:-\d{2})?$"


def _parse_sql(t: str) -> str:
    v = (f"(CASE WHEN regexp_extract({t}, '{_RX}', 1) <> '' THEN "
         f"CAST(regexp_extract({t}, '{_RX}', 1) AS INTEGER) * 100 + CAST(regexp_extract({t}, '{_RX}', 2) AS INTEGER) END)")
    return f"(CASE WHEN {v} BETWEEN 190001 AND 209912 AND {v} % 100 BETWEEN 1 AND 12 THEN {v} END)"


@register("parse_period", f"""
    SELECT ParsedDate, ParsedPosting, COUNT(*) AS Legs FROM (
        SELECT {_parse_sql(_TXT)} AS ParsedDate,
               {_parse_sql("CAST(YJ_PDT // 100 AS VARCHAR)")} AS ParsedPosting FROM journal)
    GROUP BY ParsedDate, ParsedPosting""")
def q_parse_period(spark, sf):
    j = L(spark, sf).journal
    d = F.col("YJ_DT")
    txt = F.concat_ws("-", (d / 10000).cast("int").cast("string"),
                      F.lpad(((d / 100).cast("int") % 100).cast("string"), 2, "0"),
                      F.lpad((d % 100).cast("string"), 2, "0"))
    days = j.groupBy("YJ_DT", "YJ_PDT").agg(F.count(F.lit(1)).alias("n"))  # a text is parsed once per pair of days
    return days.select(PR.parse_period_col(txt).alias("ParsedDate"),
                       PR.parse_period_col((F.col("YJ_PDT") / 100).cast("int").cast("string")).alias("ParsedPosting"), "n") \
        .groupBy("ParsedDate", "ParsedPosting").agg(F.sum("n").alias("Legs"))


@register("period_keyword", f"""
    SELECT 'Q4 {PY}' AS Keyword, Section, CAST(SUM(NetIncomeImpact) AS DECIMAL(18, 2)) AS NetIncomeImpact
    FROM is_lines WHERE Period IN ({PY}10, {PY}11, {PY}12) GROUP BY Section
    UNION ALL
    SELECT 'YTD', Section, CAST(SUM(NetIncomeImpact) AS DECIMAL(18, 2)) FROM is_lines
    WHERE Period BETWEEN (SELECT max(GB_DATE) // 100 * 100 + 1 FROM glcal) AND (SELECT max(GB_DATE) FROM glcal)
    GROUP BY Section""")
def q_period_keyword(spark, sf):
    led = L(spark, sf)
    li = lines(spark, sf)
    latest = led.glcal.agg(F.max("GB_DATE")).first()[0]
    out = None
    for kw in (f"Q4 {PY}", "YTD"):
        months = PR.period_keyword(kw, latest_period=latest)
        part = li.where(F.col("Period").isin(months)).groupBy("Section").agg(
            money(F.sum("NetIncomeImpact")).alias("NetIncomeImpact")).select(F.lit(kw).alias("Keyword"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@register("period_between", f"""
    SELECT GB_DATE AS Period, COUNT(*) AS Rows, CAST(SUM(GB_AMT) AS DECIMAL(18, 2)) AS Amount
    FROM glcal WHERE GB_DATE BETWEEN {PY}07 AND {PY}12 GROUP BY GB_DATE""")
def q_period_between(spark, sf):
    s, e = PR.period_range(f"{PY}-07", f"{PY}12")
    g = L(spark, sf).glcal.where(PR.between(F.col("GB_DATE"), s, e))
    return g.groupBy(F.col("GB_DATE").alias("Period")).agg(F.count(F.lit(1)).alias("Rows"), money(F.sum("GB_AMT")).alias("Amount"))


@register("nonzero", "SELECT GB_DATE AS Period, COUNT(*) AS Rows FROM glcal WHERE GB_AMT <> 0 GROUP BY GB_DATE")
def q_nonzero(spark, sf):
    g = L(spark, sf).glcal.where(C.nonzero(F.col("GB_AMT")))
    return g.groupBy(F.col("GB_DATE").alias("Period")).agg(F.count(F.lit(1)).alias("Rows"))


@register("active_only", """
    SELECT AccountNumber, COUNT(*) AS Lines, CAST(SUM(NetIncomeImpact) AS DECIMAL(18, 2)) AS NetIncomeImpact
    FROM is_lines WHERE coalesce(AccountStatus, '') <> 'D' GROUP BY AccountNumber""")
def q_active_only(spark, sf):
    return AG.sum_by(lines(spark, sf).where(C.active_only(F.col("AccountStatus"))), ["AccountNumber"])


@register("year_end_filter", """
    SELECT PeriodYear, CAST(SUM(NetIncomeImpact) AS DECIMAL(18, 2)) AS Stated,
           CAST(coalesce(SUM(CASE WHEN coalesce(YearEnd, '') <> 'Y' THEN NetIncomeImpact END), 0) AS DECIMAL(18, 2)) AS Operating,
           CAST(coalesce(SUM(CASE WHEN YearEnd = 'Y' THEN NetIncomeImpact END), 0) AS DECIMAL(18, 2)) AS YearEndOnly
    FROM is_lines GROUP BY PeriodYear""")
def q_year_end_filter(spark, sf):
    li = lines(spark, sf)
    ye = F.col("YearEnd")
    amt = F.col("NetIncomeImpact")
    return li.groupBy("PeriodYear").agg(
        money(F.sum(F.when(C.year_end_filter(ye, "include"), amt))).alias("Stated"),
        money(F.coalesce(F.sum(F.when(C.year_end_filter(ye, "exclude"), amt)), F.lit(0))).alias("Operating"),
        money(F.coalesce(F.sum(F.when(C.year_end_filter(ye, "only"), amt)), F.lit(0))).alias("YearEndOnly"),
    )


@register("memo_excluded", """
    SELECT a.ACTYP AS AccountType, COUNT(*) AS Rows, CAST(SUM(g.GB_AMT) AS DECIMAL(18, 2)) AS Amount
    FROM glcal g JOIN accmast a ON a.ACCO = g.GB_CO AND a.ACACC = g.GB_GLA
    WHERE coalesce(a.ACMEM, '') = '' GROUP BY a.ACTYP""")
def q_memo_excluded(spark, sf):
    led = L(spark, sf)
    j = JN.left_dim(led.glcal, led.accmast, cols=("ACTYP", "ACMEM")).where(F.col("ACMEM").isNotNull())
    j = j.where(C.memo_excluded(F.col("ACMEM")))
    return j.groupBy(F.col("ACTYP").alias("AccountType")).agg(
        F.count(F.lit(1)).alias("Rows"), money(F.sum("GB_AMT")).alias("Amount"))


@register("account_search", """
    SELECT ACCO AS Company, ACACC AS Account, rtrim(ACNME) AS AccountName, ACTYP AS AccountType, ACSTA AS Status
    FROM accmast WHERE (starts_with(ACACC, 'cost') OR contains(lower(ACNME), 'cost'))
    ORDER BY ACCO, ACACC LIMIT 25""")
def q_account_search(spark, sf):
    from ..plans.statements import account_search
    return account_search(L(spark, sf).accmast, "Cost")


@register("mapped_only", """
    SELECT CA_GLFA AS Alias, COUNT(*) AS KeyCount FROM coacmast WHERE coalesce(CA_GLFA, '') <> '' GROUP BY CA_GLFA""")
def q_mapped_only(spark, sf):
    c = L(spark, sf).coacmast.where(C.mapped_only(F.col("CA_GLFA")))
    return c.groupBy(F.col("CA_GLFA").alias("Alias")).agg(F.count(F.lit(1)).alias("KeyCount"))


@register("type_in", """
    SELECT a.ACTYP AS AccountType, a.ACTYP IN ('2', '3') AS IsProfitAndLoss, COUNT(*) AS Rows,
           CAST(SUM(g.GB_AMT) AS DECIMAL(18, 2)) AS Amount
    FROM glcal g JOIN accmast a ON a.ACCO = g.GB_CO AND a.ACACC = g.GB_GLA GROUP BY a.ACTYP""")
def q_type_in(spark, sf):
    led = L(spark, sf)
    j = JN.left_dim(led.glcal, led.accmast, cols=("ACTYP",)).where(F.col("ACTYP").isNotNull())
    return j.groupBy(F.col("ACTYP").alias("AccountType")).agg(
        F.count(F.lit(1)).alias("Rows"), money(F.sum("GB_AMT")).alias("Amount")
    ).withColumn("IsProfitAndLoss", C.is_profit_and_loss(F.col("AccountType")))


@register("net_income_impact", """
    SELECT g.GB_DATE AS Period,
           CAST(SUM(CASE WHEN a.ACTYP IN ('2', '3') THEN -g.GB_AMT ELSE 0 END) AS DECIMAL(18, 2)) AS NetIncome
    FROM glcal g LEFT JOIN accmast a ON a.ACCO = g.GB_CO AND a.ACACC = g.GB_GLA GROUP BY g.GB_DATE""")
def q_net_income_impact(spark, sf):
    led = L(spark, sf)
    j = JN.left_dim(led.glcal, led.accmast, cols=("ACTYP",))
    return j.groupBy(F.col("GB_DATE").alias("Period")).agg(
        money(F.sum(C.net_income_impact(F.col("GB_AMT"), F.coalesce(F.col("ACTYP"), F.lit(""))))).alias("NetIncome"))


@register("friendly_columns", """
    SELECT ACCO AS Company, ACACC AS Account, rtrim(ACNME) AS AccountName, ACTYP AS AccountType,
           ACSTA AS Status FROM accmast""")
def q_friendly_columns(spark, sf):
    return C.friendly_columns(L(spark, sf).accmast, {
        "ACCO": "Company", "ACACC": "Account", "ACNME": "AccountName", "ACTYP": "AccountType", "ACSTA": "Status"},
        trim=["ACNME"])


@register("decode_cost_center", """
    SELECT c.CostCenter, c.Department, d.DepartmentName, c.Branch, 'Branch ' || c.Branch AS BranchName
    FROM (SELECT DISTINCT CA_CC AS CostCenter, substr(CA_CC, 1, 1) AS Department, right(CA_CC, 2) AS Branch
          FROM coacmast) c
    LEFT JOIN departments d ON d.Department = c.Department""")
def q_decode_cost_center(spark, sf):
    from ..plans.statements import decode_cost_centers
    return decode_cost_centers(L(spark, sf).coacmast.select(F.col("CA_CC").alias("CostCenter")))


@register("classify_section", """
    SELECT s.Statement, s.Section, s.SectionOrder, COUNT(*) AS KeyCount,
           CAST(SUM(c.CA_CUR) AS DECIMAL(18, 2)) AS Balance
    FROM coacmast c LEFT JOIN sections s ON s.rule_account = c.CA_ACC
    GROUP BY s.Statement, s.Section, s.SectionOrder""")
def q_classify_section(spark, sf):
    c = classify_section(L(spark, sf).coacmast, "CA_ACC")
    return c.groupBy("Statement", "Section", "SectionOrder").agg(
        F.count(F.lit(1)).alias("KeyCount"), money(F.sum("CA_CUR")).alias("Balance"))


@register("tolerance", f"""
    SELECT CA_ACC AS Account, COUNT(*) AS KeysWithUnclosed FROM coacmast
    WHERE abs(coalesce(CA_CUR, 0) - coalesce(CA_YTD, 0)) > {fixed.BALANCE_TOLERANCE} GROUP BY CA_ACC""")
def q_tolerance(spark, sf):
    c = L(spark, sf).coacmast.where(C.tolerance_exceeded(F.col("CA_CUR"), F.col("CA_YTD"), fixed.BALANCE_TOLERANCE))
    return c.groupBy(F.col("CA_ACC").alias("Account")).agg(F.count(F.lit(1)).alias("KeysWithUnclosed"))


# ======================================================================= 2.4 joins

@register("left_dim", f"""
    SELECT g.GB_CO, g.GB_DIV, g.GB_GLC, g.GB_GLA, g.GB_AMT, a.ACNME, a.ACTYP
    FROM glcal g LEFT JOIN accmast a ON a.ACCO = g.GB_CO AND a.ACACC = g.GB_GLA WHERE g.GB_DATE = {P}""")
def q_left_dim(spark, sf):
    led = L(spark, sf)
    g = led.glcal.where(F.col("GB_DATE") == P).select(*GLCAL_KEY, "GB_AMT")
    return JN.left_dim(g, led.accmast, cols=("ACNME", "ACTYP"))


@register("left_chart", f"""
    SELECT g.GB_CO, g.GB_DIV, g.GB_GLC, g.GB_GLA, g.GB_AMT, c.CA_GLFA
    FROM glcal g LEFT JOIN coacmast c ON c.CA_CO = g.GB_CO AND c.CA_DIV = g.GB_DIV AND c.CA_CC = g.GB_GLC
         AND c.CA_ACC = g.GB_GLA WHERE g.GB_DATE = {P}""")
def q_left_chart(spark, sf):
    led = L(spark, sf)
    g = led.glcal.where(F.col("GB_DATE") == P).select(*GLCAL_KEY, "GB_AMT")
    return JN.chart_join(g, led.coacmast, "left")


@register("inner_chart", f"""
    SELECT g.GB_CO, g.GB_DIV, g.GB_GLC, g.GB_GLA, g.GB_AMT, c.CA_GLFA
    FROM glcal g JOIN coacmast c ON c.CA_CO = g.GB_CO AND c.CA_DIV = g.GB_DIV AND c.CA_CC = g.GB_GLC
         AND c.CA_ACC = g.GB_GLA WHERE g.GB_DATE = {P}""")
def q_inner_chart(spark, sf):
    led = L(spark, sf)
    g = led.glcal.where(F.col("GB_DATE") == P).select(*GLCAL_KEY, "GB_AMT")
    return JN.chart_join(g, led.coacmast, "inner")


@register("full_outer_reconcile", f"""
    SELECT coalesce(j.Company, l.Company) AS Company, coalesce(j.AccountNumber, l.AccountNumber) AS AccountNumber,
           coalesce(j.Period, l.Period) AS Period, j.LeftAmount, l.RightAmount,
           CAST(coalesce(j.LeftAmount, 0) - coalesce(l.RightAmount, 0) AS DECIMAL(18, 2)) AS Difference
    FROM (SELECT YJ_CO AS Company, YJ_ACC AS AccountNumber, period AS Period,
                 CAST(SUM(YJ_AMT) AS DECIMAL(18, 2)) AS LeftAmount
          FROM journal WHERE period <= {P} AND substr(YJ_ACC, 1, 1) IN ('3', '4', '5')
          GROUP BY YJ_CO, YJ_ACC, period) j
    FULL JOIN (SELECT Company, AccountNumber, Period, CAST(SUM(Amount) AS DECIMAL(18, 2)) AS RightAmount
               FROM is_lines GROUP BY Company, AccountNumber, Period) l
      ON j.Company = l.Company AND j.AccountNumber = l.AccountNumber AND j.Period = l.Period""")
def q_full_outer_reconcile(spark, sf):
    led = L(spark, sf)
    j = led.journal.where((F.col("period") <= P) & F.substring("YJ_ACC", 1, 1).isin("3", "4", "5")).select(
        F.col("YJ_CO").alias("Company"), F.col("YJ_ACC").alias("AccountNumber"), F.col("period").alias("Period"), "YJ_AMT")
    return JN.full_outer_reconcile(j, lines(spark, sf), ["Company", "AccountNumber", "Period"], "YJ_AMT", "Amount")


@register("agg_then_dim", f"""
    SELECT j.YJ_CO, j.YJ_ACC, j.Amount, a.ACNME, a.ACTYP
    FROM (SELECT YJ_CO, YJ_ACC, CAST(SUM(YJ_AMT) AS DECIMAL(18, 2)) AS Amount FROM journal
          WHERE period > {P} GROUP BY YJ_CO, YJ_ACC) j
    JOIN accmast a ON a.ACCO = j.YJ_CO AND a.ACACC = j.YJ_ACC""")
def q_agg_then_dim(spark, sf):
    return JN.agg_then_dim(L(spark, sf).journal.where(F.col("period") > P), L(spark, sf).accmast)


@register("correlated_lookup", f"""
    SELECT d.DP_CO, d.DP_DIV, d.DP_CC, d.DP_ACC, d.DP_C1,
           (SELECT g.GB_AMT FROM glcal g WHERE g.GB_CO = d.DP_CO AND g.GB_DIV = d.DP_DIV AND g.GB_GLC = d.DP_CC
                AND g.GB_GLA = d.DP_ACC AND g.GB_DATE = {CY}01) AS GlcalAmount
    FROM deptmast d""")
def q_correlated_lookup(spark, sf):
    led = L(spark, sf)
    g = led.glcal.where(F.col("GB_DATE") == CY * 100 + 1).select(
        F.col("GB_CO").alias("DP_CO"), F.col("GB_DIV").alias("DP_DIV"), F.col("GB_GLC").alias("DP_CC"),
        F.col("GB_GLA").alias("DP_ACC"), F.col("GB_AMT").alias("GlcalAmount"))
    # (key, period) is unique in GLCAL, so the left join returns at most one row per
    # DEPTMAST row, exactly like the scalar subquery.
    return led.deptmast.select("DP_CO", "DP_DIV", "DP_CC", "DP_ACC", "DP_C1").join(
        g, ["DP_CO", "DP_DIV", "DP_CC", "DP_ACC"], "left")


@register("anti_orphans", f"""
    SELECT DISTINCT {G4} FROM glcal g WHERE NOT EXISTS (
        SELECT 1 FROM coacmast c WHERE c.CA_CO = g.GB_CO AND c.CA_DIV = g.GB_DIV AND c.CA_CC = g.GB_GLC
           AND c.CA_ACC = g.GB_GLA)""")
def q_anti_orphans(spark, sf):
    led = L(spark, sf)
    return JN.anti_orphans(led.glcal, led.coacmast, GLCAL_KEY, ["CA_CO", "CA_DIV", "CA_CC", "CA_ACC"])


@register("semi_used", """
    SELECT * FROM accmast a WHERE EXISTS (SELECT 1 FROM journal j WHERE j.YJ_CO = a.ACCO AND j.YJ_ACC = a.ACACC)""")
def q_semi_used(spark, sf):
    led = L(spark, sf)
    return JN.semi_used(led.accmast, led.journal, ["ACCO", "ACACC"], ["YJ_CO", "YJ_ACC"])


@register("annual_monthly", f"""
    SELECT f.GF_YR, COUNT(*) AS MonthRows, CAST(SUM(g.GB_AMT) AS DECIMAL(18, 2)) AS GlcalTotal,
           CAST(SUM(CASE g.GB_DATE % 100 {' '.join(f'WHEN {k} THEN f.GF_H{k}' for k in range(1, 13))} END)
                AS DECIMAL(18, 2)) AS BucketTotal
    FROM glfis f JOIN glcal g ON g.GB_CO = f.GF_CO AND g.GB_DIV = f.GF_DIV AND g.GB_GLC = f.GF_GLC
         AND g.GB_GLA = f.GF_GLA AND g.GB_DATE // 100 = f.GF_YR
    GROUP BY f.GF_YR""")
def q_annual_monthly(spark, sf):
    led = L(spark, sf)
    g = led.glcal.select(
        F.col("GB_CO").alias("GF_CO"), F.col("GB_DIV").alias("GF_DIV"), F.col("GB_GLC").alias("GF_GLC"),
        F.col("GB_GLA").alias("GF_GLA"), (F.col("GB_DATE") / 100).cast("int").alias("GF_YR"),
        (F.col("GB_DATE") % 100).alias("m"), "GB_AMT")
    j = led.glfis.join(g, ["GF_CO", "GF_DIV", "GF_GLC", "GF_GLA", "GF_YR"])
    bucket = F.element_at(F.array(*[F.col(f"GF_H{k}") for k in range(1, 13)]), F.col("m").cast("int"))
    return j.groupBy("GF_YR").agg(F.count(F.lit(1)).alias("MonthRows"), money(F.sum("GB_AMT")).alias("GlcalTotal"),
                                  money(F.sum(bucket)).alias("BucketTotal"))


@register("period_shift", f"""
    SELECT coalesce(c.Company, p.Company) AS Company, coalesce(c.AccountNumber, p.AccountNumber) AS AccountNumber,
           {period_of_midx('coalesce(c.midx, p.midx)')} AS Period, c.Amount AS CurrentAmount, p.Amount AS PriorYearAmount
    FROM (SELECT Company, AccountNumber, {midx('Period')} AS midx, Amount FROM pl_monthly) c
    FULL JOIN (SELECT Company, AccountNumber, {midx('Period')} + 12 AS midx, Amount FROM pl_monthly) p
      ON c.Company = p.Company AND c.AccountNumber = p.AccountNumber AND c.midx = p.midx""",
          extra_ctes=[PL_MONTHLY_SQL])
def q_period_shift(spark, sf):
    s = JN.period_shift(pl_monthly(spark, sf), ["Company", "AccountNumber"], 12, period="Period", amount="Amount",
                        name="PriorYearAmount")
    return s.select("Company", "AccountNumber", PR.period_of_index(F.col("midx")).alias("Period"),
                    "CurrentAmount", "PriorYearAmount")


@register("paired_accounts", """
    SELECT coalesce(r.Company, c.Company) AS Company, coalesce(r.Branch, c.Branch) AS Branch,
           coalesce(r.suffix, c.suffix) AS suffix, r.LeftAccount, r.LeftAmount, c.RightAccount, c.RightAmount
    FROM (SELECT Company, Branch, substr(AccountNumber, 2, 4) AS suffix, AccountNumber AS LeftAccount,
                 CAST(SUM(Amount) AS DECIMAL(18, 2)) AS LeftAmount FROM is_lines
          WHERE substr(AccountNumber, 1, 1) = '3' GROUP BY ALL) r
    FULL JOIN (SELECT Company, Branch, substr(AccountNumber, 2, 4) AS suffix, AccountNumber AS RightAccount,
                      CAST(SUM(Amount) AS DECIMAL(18, 2)) AS RightAmount FROM is_lines
               WHERE substr(AccountNumber, 1, 1) = '4' GROUP BY ALL) c
      ON r.Company = c.Company AND r.Branch = c.Branch AND r.suffix = c.suffix""")
def q_paired_accounts(spark, sf):
    return JN.paired_accounts(lines(spark, sf), "AccountNumber", "Amount", ["Company", "Branch"])


# ======================================================================= 2.5 aggregations

@register("sum_by_section", """
    SELECT Section, SectionOrder, COUNT(*) AS Lines, CAST(SUM(NetIncomeImpact) AS DECIMAL(18, 2)) AS NetIncomeImpact
    FROM is_lines GROUP BY Section, SectionOrder""")
def q_sum_by_section(spark, sf):
    return AG.sum_by(lines(spark, sf), ["Section", "SectionOrder"])


@register("sum_by_account", f"""
    SELECT Section, AccountNumber, Company, Division, Branch, CAST(SUM(NetIncomeImpact) AS DECIMAL(18, 2)) AS NetIncomeImpact
    FROM is_lines WHERE Period = {P} GROUP BY Section, AccountNumber, Company, Division, Branch""")
def q_sum_by_account(spark, sf):
    li = lines(spark, sf).where(F.col("Period") == P)
    return AG.sum_by(li, ["Section", "AccountNumber", "Company", "Division", "Branch"], count_name=None)


@register("sum_by_period", f"""
    SELECT GB_DATE AS Period, CAST(SUM(GB_AMT) AS DECIMAL(18, 2)) AS Amount FROM glcal
    WHERE GB_GLA = '{SERIES_ACCOUNT}' GROUP BY GB_DATE""")
def q_sum_by_period(spark, sf):
    g = C.dim_filter(L(spark, sf).glcal, account=SERIES_ACCOUNT)
    return AG.sum_by(g.withColumnRenamed("GB_DATE", "Period"), ["Period"], amount="GB_AMT", count_name=None,
                     sum_name="Amount")


@register("sum_by_alias", f"""
    SELECT c.CA_GLFA AS Alias, COUNT(*) AS Lines, CAST(SUM(g.GB_AMT) AS DECIMAL(18, 2)) AS Amount
    FROM glcal g JOIN coacmast c ON c.CA_CO = g.GB_CO AND c.CA_DIV = g.GB_DIV AND c.CA_CC = g.GB_GLC
         AND c.CA_ACC = g.GB_GLA WHERE g.GB_DATE = {P} AND c.CA_GLFA <> '' GROUP BY c.CA_GLFA""")
def q_sum_by_alias(spark, sf):
    led = L(spark, sf)
    j = JN.chart_join(led.glcal.where(F.col("GB_DATE") == P), led.coacmast, "inner").where(C.mapped_only(F.col("CA_GLFA")))
    return AG.sum_by(j.withColumnRenamed("CA_GLFA", "Alias"), ["Alias"], amount="GB_AMT", sum_name="Amount")


@register("coverage_stats", """
    SELECT GB_CO AS Company, min(GB_DATE) AS MinPeriod, max(GB_DATE) AS MaxPeriod,
           COUNT(DISTINCT GB_DATE) AS DistinctPeriods, COUNT(*) AS TotalRows FROM glcal GROUP BY GB_CO""")
def q_coverage_stats(spark, sf):
    return AG.coverage_stats(L(spark, sf).glcal.withColumnRenamed("GB_CO", "Company"), by=["Company"])


_SERIES_SQL = f"""
    SELECT GB_CO AS Company, GB_DATE AS Period, CAST(SUM(GB_AMT) AS DECIMAL(18, 2)) AS Amount
    FROM glcal WHERE GB_GLA = '{SERIES_ACCOUNT}' GROUP BY GB_CO, GB_DATE"""


@register("series_stats", """
    SELECT Company, COUNT(Amount) AS count, CAST(SUM(Amount) AS DECIMAL(18, 2)) AS total,
           CAST(SUM(Amount) AS DOUBLE) / CAST(COUNT(Amount) AS DOUBLE) AS mean, min(Amount) AS min, max(Amount) AS max,
           min(Period) AS first_period, max(Period) AS latest_period, arg_min(Amount, Period) AS first_amount,
           arg_max(Amount, Period) AS latest_amount,
           CASE WHEN COUNT(Amount) > 1 THEN sqrt(greatest((CAST(SUM(Amount * Amount) AS DOUBLE)
                - CAST(SUM(Amount) AS DOUBLE) * CAST(SUM(Amount) AS DOUBLE) / CAST(COUNT(Amount) AS DOUBLE))
                / CAST(COUNT(Amount) - 1 AS DOUBLE), 0.0)) END AS stdev
    FROM series GROUP BY Company""", extra_ctes=[("series", _SERIES_SQL)])
def q_series_stats(spark, sf):
    g = C.dim_filter(L(spark, sf).glcal, account=SERIES_ACCOUNT)
    s = g.groupBy(F.col("GB_CO").alias("Company"), F.col("GB_DATE").alias("Period")).agg(money(F.sum("GB_AMT")).alias("Amount"))
    return AG.series_stats(s, "Period", "Amount", by=["Company"])


@register("conditional_pivot", f"""
    SELECT {G4}, {', '.join(f'CAST(SUM(CASE WHEN GB_DATE = {PY}{m:02d} THEN GB_AMT END) AS DECIMAL(18, 2)) AS P{PY}{m:02d}' for m in range(1, 13))}
    FROM glcal WHERE GB_DATE BETWEEN {PY}01 AND {PY}12 GROUP BY {G4}""")
def q_conditional_pivot(spark, sf):
    g = L(spark, sf).glcal.where(F.col("GB_DATE").between(PY * 100 + 1, PY * 100 + 12))
    return AG.conditional_pivot(g, GLCAL_KEY, "GB_DATE", [PY * 100 + m for m in range(1, 13)], "GB_AMT")


@register("conditional_count", "SELECT " + ", ".join(
    f"CAST(SUM(CASE WHEN DP_C{k} <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS nonzero_DP_C{k}" for k in range(1, 13))
    + " FROM deptmast")
def q_conditional_count(spark, sf):
    return AG.conditional_count(L(spark, sf).deptmast, [f"DP_C{k}" for k in range(1, 13)])


@register("bucket_scan", " UNION ALL ".join(
    f"SELECT 'DP_C{k}' AS bucket, CAST(SUM(DP_C{k}) AS DECIMAL(18, 2)) AS total, "
    f"CAST(SUM(CASE WHEN DP_C{k} <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS nonzero_rows, COUNT(*) AS rows FROM deptmast"
    for k in range(1, 13)))
def q_bucket_scan(spark, sf):
    return AG.bucket_scan(L(spark, sf).deptmast, ["DP_CO", "DP_DIV", "DP_CC", "DP_ACC"], [f"DP_C{k}" for k in range(1, 13)])


@register("journal_to_period", """
    SELECT YJ_CO, YJ_DIV, YJ_CC, YJ_ACC, period, CAST(SUM(YJ_AMT) AS DECIMAL(18, 2)) AS activity
    FROM journal GROUP BY YJ_CO, YJ_DIV, YJ_CC, YJ_ACC, period""")
def q_journal_to_period(spark, sf):
    from ..operators.rollups import journal_to_period
    return journal_to_period(L(spark, sf).journal)


@register("build_glcal", "SELECT * FROM glcal")
def q_build_glcal(spark, sf):
    return L(spark, sf).glcal


@register("build_glfis", "SELECT * FROM glfis")
def q_build_glfis(spark, sf):
    return L(spark, sf).glfis


@register("build_deptmast", "SELECT * FROM deptmast")
def q_build_deptmast(spark, sf):
    return L(spark, sf).deptmast


@register("build_balances", "SELECT * FROM coacmast")
def q_build_balances(spark, sf):
    return L(spark, sf).coacmast


@register("by_department", f"""
    SELECT Department, COUNT(*) AS Lines, CAST(SUM(NetIncomeImpact) AS DECIMAL(18, 2)) AS NetIncomeImpact
    FROM is_lines WHERE Period = {P} GROUP BY Department""")
def q_by_department(spark, sf):
    return AG.by_department(lines(spark, sf).where(F.col("Period") == P))


@register("by_branch", f"""
    SELECT Branch, COUNT(*) AS Lines, CAST(SUM(NetIncomeImpact) AS DECIMAL(18, 2)) AS NetIncomeImpact
    FROM is_lines WHERE Period = {P} GROUP BY Branch""")
def q_by_branch(spark, sf):
    return AG.by_branch(lines(spark, sf).where(F.col("Period") == P))


@register("subtotals", f"""
    SELECT SubtotalGroup, COUNT(*) AS Lines, CAST(SUM(NetIncomeImpact) AS DECIMAL(18, 2)) AS NetIncomeImpact FROM (
        SELECT 'Department ' || Department AS SubtotalGroup, NetIncomeImpact FROM is_lines WHERE Period = {P}
        UNION ALL SELECT 'Total Fixed', NetIncomeImpact FROM is_lines
            WHERE Period = {P} AND Department IN ({', '.join(repr(d) for d in fixed.FIXED_DEPARTMENTS)})
        UNION ALL SELECT 'Total branches ' || substr(Branch, 1, 1) || '0-' || substr(Branch, 1, 1) || '9', NetIncomeImpact
            FROM is_lines WHERE Period = {P}
        UNION ALL SELECT 'Chain total', NetIncomeImpact FROM is_lines WHERE Period = {P})
    GROUP BY SubtotalGroup""")
def q_subtotals(spark, sf):
    return AG.subtotals(lines(spark, sf).where(F.col("Period") == P))


@register("dept_branch_matrix", f"""
    SELECT Department, Branch, CAST(SUM(NetIncomeImpact) AS DECIMAL(18, 2)) AS NetIncomeImpact,
           GROUPING(Department, Branch) AS GroupingLevel
    FROM is_lines WHERE Period = {P} GROUP BY CUBE (Department, Branch)""")
def q_dept_branch_matrix(spark, sf):
    return AG.dept_branch_matrix(lines(spark, sf).where(F.col("Period") == P))


@register("recent_periods", "SELECT GB_DATE AS Period, COUNT(*) AS Rows FROM glcal GROUP BY GB_DATE ORDER BY GB_DATE DESC LIMIT 12")
def q_recent_periods(spark, sf):
    return AG.recent_periods(L(spark, sf).glcal)


# ======================================================================= 2.6 windows

_GRID_SQL = ("pl_grid", f"""
    SELECT k.Company, k.AccountNumber, {period_of_midx('k.i')} AS Period,
           CAST(coalesce(m.Amount, 0) AS DECIMAL(18, 2)) AS Amount, k.i AS midx
    FROM (SELECT Company, AccountNumber, unnest(generate_series(min({midx('Period')}), max({midx('Period')}))) AS i
          FROM pl_monthly GROUP BY Company, AccountNumber) k
    LEFT JOIN pl_monthly m ON m.Company = k.Company AND m.AccountNumber = k.AccountNumber
         AND {midx('m.Period')} = k.i""")
_GRID = [PL_MONTHLY_SQL, _GRID_SQL]
KEYS2 = ["Company", "AccountNumber"]


def _grid(spark, sf):
    return WN.dense_grid(pl_monthly(spark, sf), KEYS2, "Period", "Amount")


@register("running_balance", """
    SELECT m.YJ_CO, m.YJ_DIV, m.YJ_CC, m.YJ_ACC, m.period, m.activity,
           CAST(SUM(m.activity) OVER (PARTITION BY m.YJ_CO, m.YJ_DIV, m.YJ_CC, m.YJ_ACC ORDER BY m.period
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(18, 2)) AS Balance
    FROM (SELECT YJ_CO, YJ_DIV, YJ_CC, YJ_ACC, period, CAST(SUM(YJ_AMT) AS DECIMAL(18, 2)) AS activity
          FROM journal GROUP BY YJ_CO, YJ_DIV, YJ_CC, YJ_ACC, period) m
    JOIN accmast a ON a.ACCO = m.YJ_CO AND a.ACACC = m.YJ_ACC WHERE a.ACTYP = '1'""")
def q_running_balance(spark, sf):
    from ..operators.rollups import journal_to_period
    led = L(spark, sf)
    m = journal_to_period(led.journal)
    bs = led.accmast.where(C.is_balance_sheet(F.col("ACTYP"))).select(
        F.col("ACCO").alias("YJ_CO"), F.col("ACACC").alias("YJ_ACC"))
    m = m.join(bs, ["YJ_CO", "YJ_ACC"], "left_semi")
    return WN.running_balance(m, JOURNAL_KEY)


_MOM_SQL = """
    SELECT Company, AccountNumber, Period, Amount, PriorAmount,
           CAST(Amount - PriorAmount AS DECIMAL(18, 2)) AS Change,
           CASE WHEN abs(CAST(PriorAmount AS DOUBLE)) = 0 THEN NULL
                ELSE CAST(Amount - PriorAmount AS DOUBLE) * 100.0 / abs(CAST(PriorAmount AS DOUBLE)) END AS ChangePct
    FROM (SELECT *, max(Amount) OVER (PARTITION BY Company, AccountNumber ORDER BY midx
                                      RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS PriorAmount FROM pl_grid)"""


@register("mom_variance", _MOM_SQL, extra_ctes=_GRID)
def q_mom_variance(spark, sf):
    return WN.mom_variance(_grid(spark, sf), KEYS2, "Period", "Amount")


@register("trailing_anomaly", """
    SELECT Company, AccountNumber, Period, Amount, TrailingMean, TrailingStdev, TrailingMonths
    FROM (SELECT *, CAST(sx AS DOUBLE) / CAST(TrailingMonths AS DOUBLE) AS TrailingMean,
                 CASE WHEN TrailingMonths > 1 THEN sqrt(greatest((CAST(sxx AS DOUBLE) - CAST(sx AS DOUBLE) * CAST(sx AS DOUBLE)
                      / CAST(TrailingMonths AS DOUBLE)) / CAST(TrailingMonths - 1 AS DOUBLE), 0.0)) END AS TrailingStdev
          FROM (SELECT *, SUM(Amount) OVER w AS sx, SUM(Amount * Amount) OVER w AS sxx, count(Amount) OVER w AS TrailingMonths
                FROM pl_grid WINDOW w AS (PARTITION BY Company, AccountNumber ORDER BY midx
                                          RANGE BETWEEN 12 PRECEDING AND 1 PRECEDING)))
    WHERE TrailingMonths >= 3 AND TrailingStdev > 0
      AND abs(CAST(Amount AS DOUBLE) - TrailingMean) > 2.0 * TrailingStdev""", extra_ctes=_GRID)
def q_trailing_anomaly(spark, sf):
    return WN.trailing_anomaly(_grid(spark, sf), KEYS2, 2.0, "Period", "Amount")


@register("rolling_12m", """
    SELECT Company, AccountNumber, Period, Amount,
           CAST(SUM(Amount) OVER (PARTITION BY Company, AccountNumber ORDER BY midx
                RANGE BETWEEN 11 PRECEDING AND CURRENT ROW) AS DECIMAL(18, 2)) AS Rolling12
    FROM pl_grid""", extra_ctes=_GRID)
def q_rolling_12m(spark, sf):
    return WN.rolling_12m(_grid(spark, sf), KEYS2, "Period", "Amount")


@register("ytd", """
    SELECT Company, AccountNumber, Period, Amount,
           CAST(SUM(Amount) OVER (PARTITION BY Company, AccountNumber, Period // 100 ORDER BY Period
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(18, 2)) AS YTD
    FROM pl_grid""", extra_ctes=_GRID)
def q_ytd(spark, sf):
    return WN.ytd(_grid(spark, sf), KEYS2, "Period", "Amount")


@register("seasonality", """
    SELECT Company, AccountNumber, month,
           CAST(SUM(CAST(round(CAST(Amount AS DOUBLE) / CAST(year_total AS DOUBLE), 6) AS DECIMAL(18, 6))) AS DOUBLE)
               / CAST(COUNT(*) AS DOUBLE) AS AvgShare,
           COUNT(*) AS Years
    FROM (SELECT Company, AccountNumber, CAST(Period // 100 AS INTEGER) AS year, CAST(Period % 100 AS INTEGER) AS month,
                 Amount, SUM(Amount) OVER (PARTITION BY Company, AccountNumber, Period // 100) AS year_total,
                 COUNT(*) OVER (PARTITION BY Company, AccountNumber, Period // 100) AS months FROM pl_grid)
    WHERE months = 12 AND year_total <> 0 GROUP BY Company, AccountNumber, month""", extra_ctes=_GRID)
def q_seasonality(spark, sf):
    return WN.seasonality(_grid(spark, sf), KEYS2, "Period", "Amount")


@register("rank_movers", f"""
    SELECT * FROM (SELECT *, CAST(rank() OVER (PARTITION BY Period ORDER BY abs(Change) DESC) AS INTEGER) AS MoverRank
                   FROM ({_MOM_SQL})) WHERE MoverRank <= 5""", extra_ctes=_GRID)
def q_rank_movers(spark, sf):
    r = WN.rank_movers(WN.mom_variance(_grid(spark, sf), KEYS2, "Period", "Amount"), ["Period"])
    return r.where(F.col("MoverRank") <= 5)


@register("period_gaps", f"""
    SELECT YJ_CO, YJ_ACC, {period_of_midx('i + 1')} AS GapFrom, {period_of_midx('nxt - 1')} AS GapTo,
           CAST(nxt - i - 1 AS INTEGER) AS MissingMonths
    FROM (SELECT YJ_CO, YJ_ACC, i, lead(i) OVER (PARTITION BY YJ_CO, YJ_ACC ORDER BY i) AS nxt
          FROM (SELECT DISTINCT YJ_CO, YJ_ACC, {midx('period')} AS i FROM journal))
    WHERE nxt - i > 1""")
def q_period_gaps(spark, sf):
    return WN.period_gaps(L(spark, sf).journal, ["YJ_CO", "YJ_ACC"], "period")


@register("period_gaps_seeded", f"""
    SELECT YJ_CO, YJ_ACC, {period_of_midx('i + 1')} AS GapFrom, {period_of_midx('nxt - 1')} AS GapTo,
           CAST(nxt - i - 1 AS INTEGER) AS MissingMonths
    FROM (SELECT YJ_CO, YJ_ACC, i, lead(i) OVER (PARTITION BY YJ_CO, YJ_ACC ORDER BY i) AS nxt
          FROM (SELECT DISTINCT YJ_CO, YJ_ACC, {midx('period')} AS i FROM fjournal))
    WHERE nxt - i > 1""", extra_ctes=FAULT_CTES[:1])
def q_period_gaps_seeded(spark, sf):
    return WN.period_gaps(Q.faulted_journal(L(spark, sf).journal), ["YJ_CO", "YJ_ACC"], "period")


@register("zero_activity_run", f"""
    SELECT YJ_CO, YJ_ACC, LastActivePeriod, IdleMonths FROM (
        SELECT YJ_CO, YJ_ACC, max(period) AS LastActivePeriod,
               CAST({midx('(SELECT max(period) FROM journal)')} - {midx('max(period)')} AS INTEGER) AS IdleMonths
        FROM (SELECT YJ_CO, YJ_ACC, period, SUM(YJ_AMT) AS a FROM journal GROUP BY ALL) WHERE a <> 0
        GROUP BY YJ_CO, YJ_ACC) WHERE IdleMonths >= 1""")
def q_zero_activity_run(spark, sf):
    led = L(spark, sf)
    act = led.journal.groupBy("YJ_CO", "YJ_ACC", "period").agg(F.sum("YJ_AMT").alias("a"))
    return WN.zero_activity_run(act, ["YJ_CO", "YJ_ACC"], "period", "a", led.latest_period, 1)


# ======================================================================= 2.7 top-k

@register("order_report", f"""
    SELECT SectionOrder, Section, CAST(SUM(NetIncomeImpact) AS DECIMAL(18, 2)) AS NetIncomeImpact FROM is_lines
    WHERE Period = {P} GROUP BY SectionOrder, Section ORDER BY SectionOrder""")
def q_order_report(spark, sf):
    s = AG.sum_by(lines(spark, sf).where(F.col("Period") == P), ["SectionOrder", "Section"], count_name=None)
    return TK.order_report(s, ["SectionOrder"])


@register("top_abs", f"""
    SELECT c.CA_GLFA AS Alias, COUNT(*) AS Lines, CAST(SUM(g.GB_AMT) AS DECIMAL(18, 2)) AS Amount
    FROM glcal g JOIN coacmast c ON c.CA_CO = g.GB_CO AND c.CA_DIV = g.GB_DIV AND c.CA_CC = g.GB_GLC
         AND c.CA_ACC = g.GB_GLA WHERE g.GB_DATE = {P} AND c.CA_GLFA <> ''
    GROUP BY c.CA_GLFA ORDER BY abs(SUM(g.GB_AMT)) DESC, Alias""")
def q_top_abs(spark, sf):
    from ..plans.statements import alias_rollup
    return alias_rollup(L(spark, sf), P)


@register("top_n", f"""
    SELECT {G4}, GB_AMT FROM glcal WHERE GB_DATE = {P}
    ORDER BY abs(GB_AMT) DESC, {G4} LIMIT 10""")
def q_top_n(spark, sf):
    g = L(spark, sf).glcal.where(F.col("GB_DATE") == P).select(*GLCAL_KEY, "GB_AMT")
    return TK.top_abs(g, "GB_AMT", GLCAL_KEY, n=TK.clamp(10, 1, 100, 25))


@register("capped_result", f"""
    SELECT {G4}, GB_AMT, (SELECT COUNT(*) FROM glcal WHERE GB_DATE = {P}) > 100 AS Truncated
    FROM glcal WHERE GB_DATE = {P} ORDER BY {G4} LIMIT 100""")
def q_capped_result(spark, sf):
    g = L(spark, sf).glcal.where(F.col("GB_DATE") == P).select(*GLCAL_KEY, "GB_AMT")
    return TK.capped_result(g, GLCAL_KEY, 100)


@register("top_n_balance", f"""
    SELECT g.GB_CO, g.GB_DIV, g.GB_GLC, g.GB_GLA, g.GB_AMT FROM glcal g
    JOIN accmast a ON a.ACCO = g.GB_CO AND a.ACACC = g.GB_GLA
    WHERE g.GB_DATE = {P} AND a.ACTYP = '1' ORDER BY abs(g.GB_AMT) DESC, g.GB_CO, g.GB_DIV, g.GB_GLC, g.GB_GLA LIMIT 10""")
def q_top_n_balance(spark, sf):
    led = L(spark, sf)
    g = JN.left_dim(led.glcal.where(F.col("GB_DATE") == P), led.accmast, cols=("ACTYP",)).where(
        C.is_balance_sheet(F.col("ACTYP"))).select(*GLCAL_KEY, "GB_AMT")
    return TK.top_abs(g, "GB_AMT", GLCAL_KEY, n=10)


@register("top_n_movement", f"""
    SELECT Company, AccountNumber, Period, Change FROM ({_MOM_SQL}) WHERE Change IS NOT NULL
    ORDER BY abs(Change) DESC, Company, AccountNumber, Period LIMIT 10""", extra_ctes=_GRID)
def q_top_n_movement(spark, sf):
    m = WN.mom_variance(_grid(spark, sf), KEYS2, "Period", "Amount").where(F.col("Change").isNotNull())
    return TK.top_abs(m.select("Company", "AccountNumber", "Period", "Change"), "Change",
                      ["Company", "AccountNumber", "Period"], n=10)


# ======================================================================= 2.8 set operations

@register("union_all", f"""
    SELECT 'journal' AS Source, CAST(SUM(-j.YJ_AMT) AS DECIMAL(18, 2)) AS NetIncome FROM journal j
    JOIN accmast a ON a.ACCO = j.YJ_CO AND a.ACACC = j.YJ_ACC WHERE j.period = {P} AND a.ACTYP IN ('2', '3')
    UNION ALL
    SELECT 'monthly', CAST(SUM(NetIncomeImpact) AS DECIMAL(18, 2)) FROM is_lines WHERE Period = {P}""")
def q_union_all(spark, sf):
    led = L(spark, sf)
    j = JN.left_dim(led.journal.where(F.col("period") == P), led.accmast, co="YJ_CO", acc="YJ_ACC", cols=("ACTYP",))
    jt = j.where(C.is_profit_and_loss(F.col("ACTYP"))).agg(money(F.sum(-F.col("YJ_AMT"))).alias("NetIncome"))
    mt = lines(spark, sf).where(F.col("Period") == P).agg(money(F.sum("NetIncomeImpact")).alias("NetIncome"))
    return SE.union_all([("journal", jt), ("monthly", mt)])


@register("union_columns", " UNION ALL ".join(
    f"SELECT DP_CO, DP_DIV, DP_CC, DP_ACC, 'DP_C{k}' AS \"Column\", DP_C{k} AS Value FROM deptmast" for k in range(1, 13)))
def q_union_columns(spark, sf):
    return SE.union_columns(L(spark, sf).deptmast, ["DP_CO", "DP_DIV", "DP_CC", "DP_ACC"], [f"DP_C{k}" for k in range(1, 13)])


@register("inline_values", f"""
    SELECT l.Department, d.DepartmentName, CAST(SUM(l.NetIncomeImpact) AS DECIMAL(18, 2)) AS NetIncomeImpact
    FROM is_lines l LEFT JOIN departments d ON d.Department = l.Department WHERE l.Period = {P}
    GROUP BY l.Department, d.DepartmentName""")
def q_inline_values(spark, sf):
    depts = SE.inline_values(spark, fixed.DEPARTMENTS, "Department string, DepartmentName string")
    li = lines(spark, sf).where(F.col("Period") == P)
    return li.join(F.broadcast(depts), "Department", "left").groupBy("Department", "DepartmentName").agg(
        money(F.sum("NetIncomeImpact")).alias("NetIncomeImpact"))


# ======================================================================= 2.9 scalar functions

@register("fn_strings", """
    SELECT DISTINCT c.CA_CC, substr(c.CA_CC, 1, 1) AS DeptCode, right(c.CA_CC, 2) AS BranchCode,
           lpad(trim(CAST(CAST(right(c.CA_CC, 2) AS INTEGER) AS VARCHAR)), 3, '0') AS Padded,
           rtrim(a.ACNME || '   ') AS Name, starts_with(c.CA_ACC, '4') AS IsCost,
           contains(lower(a.ACNME), 'sales') AS IsSales
    FROM coacmast c JOIN accmast a ON a.ACCO = c.CA_CO AND a.ACACC = c.CA_ACC""")
def q_fn_strings(spark, sf):
    led = L(spark, sf)
    c = led.coacmast.join(led.accmast.select(F.col("ACCO").alias("CA_CO"), F.col("ACACC").alias("CA_ACC"), "ACNME"),
                          ["CA_CO", "CA_ACC"])
    return c.select(
        "CA_CC", F.substring("CA_CC", 1, 1).alias("DeptCode"), F.substring("CA_CC", -2, 2).alias("BranchCode"),
        F.lpad(F.trim(F.substring("CA_CC", -2, 2).cast("int").cast("string")), 3, "0").alias("Padded"),
        F.rtrim(F.concat("ACNME", F.lit("   "))).alias("Name"), F.col("CA_ACC").startswith("4").alias("IsCost"),
        F.lower("ACNME").contains("sales").alias("IsSales"),
    ).distinct()


@register("fn_dates", """
    SELECT dow AS DayOfWeek, COUNT(*) AS Legs, CAST(SUM(lag_days) AS BIGINT) AS PostingLagDays,
           COUNT(DISTINCT YJ_DT) AS Days
    FROM (SELECT YJ_DT, isodow(make_date(YJ_DT // 10000, YJ_DT // 100 % 100, YJ_DT % 100)) AS dow,
                 date_diff('day', make_date(YJ_DT // 10000, YJ_DT // 100 % 100, YJ_DT % 100),
                           make_date(YJ_PDT // 10000, YJ_PDT // 100 % 100, YJ_PDT % 100)) AS lag_days FROM journal)
    GROUP BY dow""")
def q_fn_dates(spark, sf):
    j = L(spark, sf).journal
    d = F.make_date((F.col("YJ_DT") / 10000).cast("int"), (F.col("YJ_DT") / 100).cast("int") % 100, F.col("YJ_DT") % 100)
    p = F.make_date((F.col("YJ_PDT") / 10000).cast("int"), (F.col("YJ_PDT") / 100).cast("int") % 100, F.col("YJ_PDT") % 100)
    # ISO day of week: Monday 1 .. Sunday 7 (Spark's dayofweek is Sunday 1).
    iso = ((F.dayofweek(d) + 5) % 7 + 1).cast("bigint")
    return j.select("YJ_DT", iso.alias("DayOfWeek"), F.datediff(p, d).alias("lag_days")).groupBy("DayOfWeek").agg(
        F.count(F.lit(1)).alias("Legs"), F.sum("lag_days").cast("bigint").alias("PostingLagDays"),
        F.countDistinct("YJ_DT").alias("Days"))


@register("fn_period_math", f"""
    SELECT GB_DATE AS Period, CAST(GB_DATE // 100 AS INTEGER) AS Year, CAST(GB_DATE % 100 AS INTEGER) AS Month,
           CAST((GB_DATE % 100 - 1) // 3 + 1 AS INTEGER) AS Quarter, {midx('GB_DATE')} AS MonthIndex,
           {period_of_midx(midx('GB_DATE') + ' + 1')} AS NextPeriod, {period_of_midx(midx('GB_DATE') + ' - 12')} AS PriorYearPeriod,
           make_date(CAST(GB_DATE // 100 AS INTEGER), CAST(GB_DATE % 100 AS INTEGER), 1) AS PeriodStart
    FROM (SELECT DISTINCT GB_DATE FROM glcal)""")
def q_fn_period_math(spark, sf):
    p = F.col("GB_DATE")
    return L(spark, sf).glcal.select("GB_DATE").distinct().select(
        p.alias("Period"), PR.year_of(p).alias("Year"), PR.month_of(p).alias("Month"), PR.quarter_of(p).alias("Quarter"),
        PR.month_index(p).alias("MonthIndex"), PR.shift_period(p, 1).alias("NextPeriod"),
        PR.shift_period(p, -12).alias("PriorYearPeriod"), PR.period_start(p).alias("PeriodStart"))


@register("fn_null_case", f"""
    SELECT c.CA_ACC, CASE WHEN g.GB_AMT IS NULL THEN 'none' WHEN g.GB_AMT > 0 THEN 'debit'
                          WHEN g.GB_AMT < 0 THEN 'credit' ELSE 'zero' END AS Kind,
           COUNT(*) AS KeyCount, CAST(SUM(coalesce(g.GB_AMT, 0)) AS DECIMAL(18, 2)) AS Amount
    FROM coacmast c LEFT JOIN glcal g ON g.GB_CO = c.CA_CO AND g.GB_DIV = c.CA_DIV AND g.GB_GLC = c.CA_CC
         AND g.GB_GLA = c.CA_ACC AND g.GB_DATE = {P}
    GROUP BY ALL""")
def q_fn_null_case(spark, sf):
    led = L(spark, sf)
    g = led.glcal.where(F.col("GB_DATE") == P).select(
        F.col("GB_CO").alias("CA_CO"), F.col("GB_DIV").alias("CA_DIV"), F.col("GB_GLC").alias("CA_CC"),
        F.col("GB_GLA").alias("CA_ACC"), "GB_AMT")
    j = led.coacmast.select("CA_CO", "CA_DIV", "CA_CC", "CA_ACC").join(g, ["CA_CO", "CA_DIV", "CA_CC", "CA_ACC"], "left")
    a = F.col("GB_AMT")
    kind = F.when(a.isNull(), "none").when(a > 0, "debit").when(a < 0, "credit").otherwise("zero")
    return j.groupBy("CA_ACC", kind.alias("Kind")).agg(
        F.count(F.lit(1)).alias("KeyCount"), money(F.sum(F.coalesce(a, F.lit(0)))).alias("Amount"))
