"""Registered reconciliation, audit and data-quality checks (DQ*)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import fixed
from ..functions.columns import money
from ..oracle import midx, period_of_midx
from ..operators import windows as WN
from ..plans import quality as Q
from ..session import shared_dir
from ..sources import subledgers
from . import register
from .common import CY, P, PL_MONTHLY_SQL, PY, L, lines, pl_monthly

Y0 = CY * 100 + 1
KEYS = "GB_CO, GB_DIV, GB_GLC, GB_GLA"


def _z(x):
    return f"CAST(coalesce(SUM({x}), 0) AS DECIMAL(18, 2))"


def _m(x):
    return f"CAST(SUM({x}) AS DECIMAL(18, 2))"


FAULT_CTES = [
    ("fjournal", f"""
        SELECT * REPLACE (CASE WHEN YJ_JRL = '{Q.FAULT_UNKNOWN[0]}' AND leg = {Q.FAULT_UNKNOWN[1]}
                               THEN '{Q.FAULT_UNKNOWN[2]}' ELSE YJ_ACC END AS YJ_ACC)
        FROM journal WHERE NOT (YJ_JRL = '{Q.FAULT_DROP[0]}' AND leg = {Q.FAULT_DROP[1]})
          AND NOT (YJ_CO = '{Q.FAULT_GAP[0]}' AND period = {Q.FAULT_GAP[1]})
        UNION ALL
        SELECT * REPLACE (CASE WHEN YJ_JRL = '{Q.FAULT_UNKNOWN[0]}' AND leg = {Q.FAULT_UNKNOWN[1]}
                               THEN '{Q.FAULT_UNKNOWN[2]}' ELSE YJ_ACC END AS YJ_ACC)
        FROM journal WHERE YJ_JRL = '{Q.FAULT_DUPLICATE[0]}' AND leg = {Q.FAULT_DUPLICATE[1]}
          AND NOT (YJ_JRL = '{Q.FAULT_DROP[0]}' AND leg = {Q.FAULT_DROP[1]})
          AND NOT (YJ_CO = '{Q.FAULT_GAP[0]}' AND period = {Q.FAULT_GAP[1]})"""),
    ("fglcal", f"""
        SELECT * REPLACE (CASE WHEN GB_CO = '{Q.FAULT_DRIFT[0]}' AND GB_GLC = '{Q.FAULT_DRIFT[1]}'
                                    AND GB_GLA = '{Q.FAULT_DRIFT[2]}' AND GB_DATE = {Q.FAULT_DRIFT[3]}
                               THEN CAST(GB_AMT + {Q.FAULT_DRIFT[4]} AS DECIMAL(18, 2)) ELSE GB_AMT END AS GB_AMT)
        FROM glcal"""),
]


@register("recon_total", f"""
    SELECT coalesce(j.Period, m.Period) AS Period, j.v AS JournalNetIncome, m.v AS MonthlyNetIncome,
           CAST(coalesce(j.v, 0) - coalesce(m.v, 0) AS DECIMAL(18, 2)) AS Difference
    FROM (SELECT j.period AS Period, {_m('-j.YJ_AMT')} AS v FROM journal j
          JOIN accmast a ON a.ACCO = j.YJ_CO AND a.ACACC = j.YJ_ACC
          WHERE j.period IN ({Y0}, {P}) AND a.ACTYP IN ('2', '3') GROUP BY j.period) j
    FULL JOIN (SELECT Period, {_m('NetIncomeImpact')} AS v FROM is_lines WHERE Period IN ({Y0}, {P}) GROUP BY Period) m
      ON j.Period = m.Period""")
def q_recon_total(spark, sf):
    return Q.recon_total(L(spark, sf), lines(spark, sf), [Y0, P])


def _drift_sql(journal: str, glcal: str) -> str:
    return f"""
    SELECT * FROM (
        SELECT coalesce(j.GB_CO, g.GB_CO) AS GB_CO, coalesce(j.GB_DIV, g.GB_DIV) AS GB_DIV,
               coalesce(j.GB_GLC, g.GB_GLC) AS GB_GLC, coalesce(j.GB_GLA, g.GB_GLA) AS GB_GLA,
               coalesce(j.GB_DATE, g.GB_DATE) AS GB_DATE, j.LeftAmount, g.RightAmount,
               CAST(coalesce(j.LeftAmount, 0) - coalesce(g.RightAmount, 0) AS DECIMAL(18, 2)) AS Difference
        FROM (SELECT j.YJ_CO AS GB_CO, j.YJ_DIV AS GB_DIV, j.YJ_CC AS GB_GLC, j.YJ_ACC AS GB_GLA, j.period AS GB_DATE,
                     {_m('j.YJ_AMT')} AS LeftAmount
              FROM {journal} j JOIN accmast a ON a.ACCO = j.YJ_CO AND a.ACACC = j.YJ_ACC
              WHERE j.period <= {P} AND a.ACTYP IN ('2', '3') GROUP BY ALL) j
        FULL JOIN (SELECT g.GB_CO, g.GB_DIV, g.GB_GLC, g.GB_GLA, g.GB_DATE, {_m('g.GB_AMT')} AS RightAmount
                   FROM {glcal} g JOIN accmast a ON a.ACCO = g.GB_CO AND a.ACACC = g.GB_GLA
                   WHERE a.ACTYP IN ('2', '3') GROUP BY ALL) g
          ON j.GB_CO = g.GB_CO AND j.GB_DIV = g.GB_DIV AND j.GB_GLC = g.GB_GLC AND j.GB_GLA = g.GB_GLA
         AND j.GB_DATE = g.GB_DATE)
    WHERE abs(Difference) > {fixed.DRIFT_TOLERANCE}"""


@register("recon_drift", _drift_sql("journal", "glcal"))
def q_recon_drift(spark, sf):
    led = L(spark, sf)
    return Q.recon_drift(led.journal, led.glcal, led.accmast)


@register("recon_drift_seeded", _drift_sql("journal", "fglcal"), extra_ctes=FAULT_CTES)
def q_recon_drift_seeded(spark, sf):
    led = L(spark, sf)
    return Q.recon_drift(led.journal, Q.faulted_glcal(led.glcal), led.accmast)


@register("recon_dept_glcal", f"""
    SELECT Month, COUNT(*) AS Keys,
           CAST(SUM(CASE WHEN abs(coalesce(DeptAmount, 0) - coalesce(GlcalAmount, 0)) > {fixed.DRIFT_TOLERANCE} THEN 1 ELSE 0 END) AS BIGINT) AS Mismatches,
           {_m('DeptAmount')} AS DeptTotal, {_m('GlcalAmount')} AS GlcalTotal
    FROM (SELECT coalesce(d.Month, g.Month) AS Month, d.DeptAmount, g.GlcalAmount
          FROM ({' UNION ALL '.join(f'SELECT DP_CO, DP_DIV, DP_CC, DP_ACC, {m} AS Month, DP_C{m} AS DeptAmount FROM deptmast' for m in range(1, 13))}) d
          FULL JOIN (SELECT GB_CO, GB_DIV, GB_GLC, GB_GLA, CAST(GB_DATE % 100 AS INTEGER) AS Month, GB_AMT AS GlcalAmount
                     FROM glcal WHERE GB_DATE BETWEEN {Y0} AND {CY}12) g
            ON d.DP_CO = g.GB_CO AND d.DP_DIV = g.GB_DIV AND d.DP_CC = g.GB_GLC AND d.DP_ACC = g.GB_GLA AND d.Month = g.Month)
    GROUP BY Month""")
def q_recon_dept_glcal(spark, sf):
    return Q.recon_dept_glcal(L(spark, sf))


def _ytd_sql(kind: str) -> str:
    if kind == "pnl":
        cond, g = "t.ACTYP IN ('2', '3')", f"GB_DATE BETWEEN {Y0} AND {P}"
    else:
        cond, g = "t.ACTYP = '1'", f"GB_DATE = {P}"
    return f"""
    SELECT t.ACTYP, COUNT(*) AS Keys,
           CAST(SUM(CASE WHEN abs(coalesce(t.CA_YTD, 0) - coalesce(g.Glcal, 0)) > {fixed.DRIFT_TOLERANCE} THEN 1 ELSE 0 END) AS BIGINT) AS Mismatches,
           {_m('t.CA_YTD')} AS ChartTotal, {_m('g.Glcal')} AS GlcalTotal
    FROM tchart t LEFT JOIN (SELECT {KEYS}, {_m('GB_AMT')} AS Glcal FROM glcal WHERE {g} GROUP BY {KEYS}) g
      ON g.GB_CO = t.CA_CO AND g.GB_DIV = t.CA_DIV AND g.GB_GLC = t.CA_CC AND g.GB_GLA = t.CA_ACC
    WHERE {cond} GROUP BY t.ACTYP"""


@register("recon_ytd_pnl", _ytd_sql("pnl"))
def q_recon_ytd_pnl(spark, sf):
    return Q.recon_ytd(L(spark, sf), "pnl")


@register("recon_ytd_bs", _ytd_sql("bs"))
def q_recon_ytd_bs(spark, sf):
    return Q.recon_ytd(L(spark, sf), "bs")


@register("recon_glfis_glcal", f"""
    SELECT GF_YR, COUNT(*) AS Cells,
           CAST(SUM(CASE WHEN abs(coalesce(BucketAmount, 0) - coalesce(GlcalAmount, 0)) > {fixed.DRIFT_TOLERANCE} THEN 1 ELSE 0 END) AS BIGINT) AS Mismatches,
           {_m('BucketAmount')} AS BucketTotal, {_m('GlcalAmount')} AS GlcalTotal
    FROM (SELECT coalesce(f.GF_YR, g.GF_YR) AS GF_YR, f.BucketAmount, g.GlcalAmount
          FROM ({' UNION ALL '.join(f'SELECT GF_CO, GF_DIV, GF_GLC, GF_GLA, GF_YR, {m} AS Month, GF_H{m} AS BucketAmount FROM glfis' for m in range(1, 13))}) f
          FULL JOIN (SELECT GB_CO, GB_DIV, GB_GLC, GB_GLA, CAST(GB_DATE // 100 AS INTEGER) AS GF_YR,
                            CAST(GB_DATE % 100 AS INTEGER) AS Month, GB_AMT AS GlcalAmount FROM glcal) g
            ON f.GF_CO = g.GB_CO AND f.GF_DIV = g.GB_DIV AND f.GF_GLC = g.GB_GLC AND f.GF_GLA = g.GB_GLA
           AND f.GF_YR = g.GF_YR AND f.Month = g.Month)
    GROUP BY GF_YR""")
def q_recon_glfis_glcal(spark, sf):
    return Q.recon_glfis_glcal(L(spark, sf))


@register("date_coverage", f"""
    SELECT min(YJ_DT) AS MinDate, max(YJ_DT) AS MaxDate, COUNT(*) AS Rows,
           CAST(SUM(CASE WHEN YJ_DT > {P}31 THEN 1 ELSE 0 END) AS BIGINT) AS RowsAfterCutoff FROM journal""")
def q_date_coverage(spark, sf):
    return Q.date_coverage(L(spark, sf).journal, P * 100 + 31)


@register("unclosed_bucket_scan", " UNION ALL ".join(
    f"SELECT 'DP_C{k}' AS bucket, CAST(SUM(DP_C{k}) AS DECIMAL(18, 2)) AS total, "
    f"CAST(SUM(CASE WHEN DP_C{k} <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS nonzero_rows, COUNT(*) AS rows FROM deptmast"
    for k in range(P % 100 + 1, 13)))
def q_unclosed_bucket_scan(spark, sf):
    return Q.unclosed_bucket_scan(L(spark, sf))


_DUP_KEY = ["YJ_UID", "YJ_CO", "YJ_CC", "YJ_ACC", "YJ_AMT"]


@register("duplicate_keys", f"""
    SELECT CAST(SUM(n) AS BIGINT) AS Rows, COUNT(*) AS DistinctKeys, CAST(SUM(n - 1) AS BIGINT) AS DuplicateRows,
           CAST(SUM(n - 1) AS DOUBLE) * 100.0 / CAST(SUM(n) AS DOUBLE) AS DuplicatePct
    FROM (SELECT COUNT(*) AS n FROM journal GROUP BY {', '.join(_DUP_KEY)})""")
def q_duplicate_keys(spark, sf):
    return Q.duplicate_keys(L(spark, sf).journal, _DUP_KEY, near="YJ_UID")


@register("row_count_check", """
    SELECT TableName, SourceRows, ReplicaRows, CAST(ReplicaRows - SourceRows AS BIGINT) AS Difference FROM (
        SELECT 'journal' AS TableName,
               (SELECT CAST(SUM(CASE WHEN l_linenumber = 1 THEN 10 ELSE 8 END) AS BIGINT) FROM lineitem) AS SourceRows,
               (SELECT COUNT(*) FROM journal) AS ReplicaRows)""")
def q_row_count_check(spark, sf):
    from ..sources.adapter import read_source
    li = read_source(spark, sf, "lineitem")
    src = li.agg(F.sum(F.when(F.col("l_linenumber") == 1, 10).otherwise(8)).alias("SourceRows"))
    rep = L(spark, sf).journal.agg(F.count(F.lit(1)).alias("ReplicaRows"))
    # Two single-row aggregates side by side: a union then one aggregation.
    both = src.select("SourceRows", F.lit(None).cast("bigint").alias("ReplicaRows")).unionByName(
        rep.select(F.lit(None).cast("bigint").alias("SourceRows"), "ReplicaRows"))
    return both.agg(F.lit("journal").alias("TableName"), F.max("SourceRows").alias("SourceRows"),
                    F.max("ReplicaRows").alias("ReplicaRows")).withColumn(
        "Difference", F.col("ReplicaRows") - F.col("SourceRows"))


def _completeness_sql(journal: str) -> str:
    return f"""
    SELECT e.YJ_CO, e.YJ_DIV, {period_of_midx('e.midx')} AS MissingPeriod FROM (
        SELECT YJ_CO, YJ_DIV, unnest(generate_series(min(midx), max(midx))) AS midx
        FROM (SELECT DISTINCT YJ_CO, YJ_DIV, {midx('period')} AS midx FROM {journal}) GROUP BY YJ_CO, YJ_DIV) e
    WHERE NOT EXISTS (SELECT 1 FROM {journal} j WHERE j.YJ_CO = e.YJ_CO AND j.YJ_DIV = e.YJ_DIV
                      AND {midx('j.period')} = e.midx)"""


@register("period_completeness", _completeness_sql("journal"))
def q_period_completeness(spark, sf):
    return Q.period_completeness(L(spark, sf).journal)


@register("period_completeness_seeded", _completeness_sql("fjournal"), extra_ctes=FAULT_CTES)
def q_period_completeness_seeded(spark, sf):
    return Q.period_completeness(Q.faulted_journal(L(spark, sf).journal))


@register("deleted_with_balance", """
    SELECT c.CA_CO, c.CA_DIV, c.CA_CC, c.CA_ACC, c.CA_CUR FROM coacmast c
    JOIN accmast a ON a.ACCO = c.CA_CO AND a.ACACC = c.CA_ACC WHERE a.ACSTA = 'D' AND c.CA_CUR <> 0""")
def q_deleted_with_balance(spark, sf):
    return Q.deleted_with_balance(L(spark, sf))


@register("status_coverage", """
    SELECT ACCO AS Company, COUNT(*) AS Accounts, CAST(SUM(CASE WHEN ACSTA = 'D' THEN 1 ELSE 0 END) AS BIGINT) AS Deleted,
           CAST(SUM(CASE WHEN ACSTA = 'D' THEN 1 ELSE 0 END) AS DOUBLE) * 100.0 / CAST(COUNT(*) AS DOUBLE) AS DeletedPct
    FROM accmast GROUP BY ACCO""")
def q_status_coverage(spark, sf):
    return Q.status_coverage(L(spark, sf).accmast)


@register("unused_accounts", """
    SELECT ACCO, ACACC, ACNME, ACSTA FROM accmast a
    WHERE NOT EXISTS (SELECT 1 FROM journal j WHERE j.YJ_CO = a.ACCO AND j.YJ_ACC = a.ACACC)""")
def q_unused_accounts(spark, sf):
    led = L(spark, sf)
    return Q.unused_accounts(led.accmast, led.journal)


@register("unknown_accounts_seeded", f"""
    SELECT j.YJ_CO, j.YJ_ACC, COUNT(*) AS Legs, {_m('j.YJ_AMT')} AS Amount FROM fjournal j
    WHERE NOT EXISTS (SELECT 1 FROM accmast a WHERE a.ACCO = j.YJ_CO AND a.ACACC = j.YJ_ACC)
    GROUP BY j.YJ_CO, j.YJ_ACC""", extra_ctes=FAULT_CTES)
def q_unknown_accounts_seeded(spark, sf):
    led = L(spark, sf)
    return Q.unknown_accounts(Q.faulted_journal(led.journal), led.accmast)


@register("year_end_adjustments", """
    SELECT GB_GLA, CAST(GB_DATE // 100 AS INTEGER) AS Year, COUNT(*) AS Rows, CAST(SUM(GB_AMT) AS DECIMAL(18, 2)) AS Amount
    FROM glcal WHERE GB_YE = 'Y' GROUP BY GB_GLA, GB_DATE // 100""")
def q_year_end_adjustments(spark, sf):
    g = L(spark, sf).glcal.where(F.col("GB_YE") == "Y")
    return g.groupBy("GB_GLA", (F.col("GB_DATE") / 100).cast("int").alias("Year")).agg(
        F.count(F.lit(1)).alias("Rows"), F.sum("GB_AMT").cast("decimal(18,2)").alias("Amount"))


@register("unusual_journals", """
    SELECT YJ_CRT AS CreatedBy,
           CAST(SUM(CASE WHEN YJ_AMT <> 0 AND YJ_AMT % 1000 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS RoundAmounts,
           CAST(SUM(CASE WHEN isodow(make_date(YJ_DT // 10000, YJ_DT // 100 % 100, YJ_DT % 100)) IN (6, 7) THEN 1 ELSE 0 END) AS BIGINT) AS WeekendLegs,
           CAST(SUM(CASE WHEN YJ_RDT <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS ReversalLegs, COUNT(*) AS Legs
    FROM journal GROUP BY YJ_CRT""")
def q_unusual_journals(spark, sf):
    return Q.unusual_journals(L(spark, sf).journal)


@register("je_audit_trail", """
    SELECT YJ_JRL, YJ_DT, YJ_PDT, YJ_CO, YJ_CC, YJ_ACC, YJ_AMT, YJ_CRT, YJ_DES, YJ_RDT, YJ_UID FROM journal
    WHERE YJ_JRL = '0042'""")
def q_je_audit_trail(spark, sf):
    return Q.je_audit_trail(L(spark, sf).journal, "0042")


def _one_sided_sql(journal: str) -> str:
    return f"""
    SELECT YJ_JRL, YJ_DT, {_m('YJ_AMT')} AS Imbalance, CAST(SUM(CASE WHEN YJ_OSJ = 'Y' THEN 1 ELSE 0 END) AS BIGINT) AS FlaggedLegs,
           COUNT(*) AS Legs FROM {journal} GROUP BY YJ_JRL, YJ_DT
    HAVING SUM(YJ_AMT) <> 0 OR SUM(CASE WHEN YJ_OSJ = 'Y' THEN 1 ELSE 0 END) > 0"""


@register("one_sided_journals", _one_sided_sql("journal"))
def q_one_sided_journals(spark, sf):
    return Q.one_sided_journals(L(spark, sf).journal)


@register("one_sided_journals_seeded", _one_sided_sql("fjournal"), extra_ctes=FAULT_CTES)
def q_one_sided_journals_seeded(spark, sf):
    return Q.one_sided_journals(Q.faulted_journal(L(spark, sf).journal))


_GRID_CTES = [PL_MONTHLY_SQL, ("pl_grid", f"""
    SELECT k.Company, k.AccountNumber, {period_of_midx('k.i')} AS Period,
           CAST(coalesce(m.Amount, 0) AS DECIMAL(18, 2)) AS Amount, k.i AS midx
    FROM (SELECT Company, AccountNumber, unnest(generate_series(min({midx('Period')}), max({midx('Period')}))) AS i
          FROM pl_monthly GROUP BY Company, AccountNumber) k
    LEFT JOIN pl_monthly m ON m.Company = k.Company AND m.AccountNumber = k.AccountNumber AND {midx('m.Period')} = k.i""")]


@register("large_change_alert", """
    SELECT * FROM (
        SELECT Company, AccountNumber, Period, Amount, PriorAmount, CAST(Amount - PriorAmount AS DECIMAL(18, 2)) AS Change,
               CASE WHEN abs(CAST(PriorAmount AS DOUBLE)) = 0 THEN NULL
                    ELSE CAST(Amount - PriorAmount AS DOUBLE) * 100.0 / abs(CAST(PriorAmount AS DOUBLE)) END AS ChangePct
        FROM (SELECT *, max(Amount) OVER (PARTITION BY Company, AccountNumber ORDER BY midx
                                          RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS PriorAmount FROM pl_grid))
    WHERE abs(Change) > 250000""", extra_ctes=_GRID_CTES)
def q_large_change_alert(spark, sf):
    g = WN.dense_grid(pl_monthly(spark, sf), ["Company", "AccountNumber"], "Period", "Amount")
    return Q.large_change_alert(WN.mom_variance(g, ["Company", "AccountNumber"], "Period", "Amount"), "250000")


_AMT2 = "CAST(CAST({} AS DECIMAL(18, 0)) * CAST(0.01 AS DECIMAL(3, 2)) AS DECIMAL(12, 2))"
_COST = f"c * {fixed.COST_NUMERATOR} // {fixed.COST_DENOMINATOR}"


def _sub(name: str, acc: str, cents: str, where: str = "") -> str:
    return (f"SELECT '{name}' AS TableName, co, {acc} AS acc, CAST(year(ship) * 10000 + month(ship) * 100 + day(ship) AS INTEGER) AS Date, "
            f"l_orderkey, {_AMT2.format(cents)} AS amt FROM jbase {where}")


SUBLEDGER_CTES = [("subs", " UNION ALL ".join([
    _sub("CGIHIST", "rev", "-c", "WHERE dept = '3'"), _sub("CGIHIST", "'4' || substr(rev, 2, 4)", _COST, "WHERE dept = '3'"),
    _sub("YTDIST", "expacc", "c * dp // 100"),
    _sub("SUBLED", f"'{fixed.DEPRECIATION_ACCOUNT}'", "c * tp // 100", "WHERE l_returnflag = 'R'"),
    _sub("PARTHIST", "rev", "-c", "WHERE dept = '4'"), _sub("PARTHIST", "'4' || substr(rev, 2, 4)", _COST, "WHERE dept = '4'"),
    _sub("INVHCC", "rev", "-c", "WHERE dept = '2'")]))]


@register("subledger_coverage", f"""
    SELECT Section, {_m('GlAmount')} AS GlAmount, {_z('SubledgerAmount')} AS SubledgerAmount,
           CASE WHEN SUM(GlAmount) <> 0 THEN CAST(coalesce(SUM(SubledgerAmount), 0) AS DOUBLE) * 100.0 / CAST(SUM(GlAmount) AS DOUBLE) END AS CoveragePct
    FROM (SELECT g.Section, g.GlAmount, s.SubledgerAmount
          FROM (SELECT Company, AccountNumber, Section, {_m('Amount')} AS GlAmount FROM is_lines
                WHERE Period BETWEEN {PY}01 AND {PY}12 GROUP BY ALL) g
          LEFT JOIN (SELECT co AS Company, acc AS AccountNumber, {_m('amt')} AS SubledgerAmount FROM subs
                     WHERE Date // 100 BETWEEN {PY}01 AND {PY}12 GROUP BY co, acc) s
            ON s.Company = g.Company AND s.AccountNumber = g.AccountNumber)
    GROUP BY Section""", SUBLEDGER_CTES)
def q_subledger_coverage(spark, sf):
    return Q.subledger_coverage(subledgers.all_subledgers(spark, sf), lines(spark, sf), PY * 100 + 1, PY * 100 + 12)


@register("scan_subledgers", """
    SELECT TableName, co AS Company, acc AS AccountNumber, COUNT(*) AS Rows, CAST(SUM(amt) AS DECIMAL(18, 2)) AS Amount, min(Date) AS FirstDate,
           max(Date) AS LastDate FROM subs GROUP BY TableName, co, acc""", SUBLEDGER_CTES)
def q_scan_subledgers(spark, sf):
    return subledgers.all_subledgers(spark, sf).groupBy("TableName", "Company", "AccountNumber").agg(
        F.count(F.lit(1)).alias("Rows"), money(F.sum("Amount")).alias("Amount"), F.min("Date").alias("FirstDate"), F.max("Date").alias("LastDate"))


@register("merge_subledgers", """
    SELECT TableName, LastRunId, COUNT(*) AS Rows, CAST(SUM(CASE WHEN t AND NOT up THEN amt WHEN s THEN amt + r ELSE amt END) AS DECIMAL(18, 2)) AS Amount,
           CAST(SUM(CASE WHEN NOT t THEN 1 ELSE 0 END) AS BIGINT) AS RowsInserted, CAST(SUM(CASE WHEN t AND up THEN 1 ELSE 0 END) AS BIGINT) AS RowsUpdated
    FROM (SELECT *, s AND r = 1 AS up, CASE WHEN NOT t OR (s AND r = 1) THEN 'run-merge' ELSE 'run-initial' END AS LastRunId
          FROM (SELECT *, l_orderkey % 10 < 8 AS t, l_orderkey % 10 >= 2 AS s, CASE WHEN l_orderkey % 7 = 0 THEN 1 ELSE 0 END AS r FROM subs))
    GROUP BY TableName, LastRunId""", SUBLEDGER_CTES)
def q_merge_subledgers(spark, sf):
    """Each sub-ledger merged on its own key, committed and read back."""
    from ..operators import ingest as IG
    from ..plans import loads as LD
    root = f"{shared_dir(spark)}/ledgerlake/scratch/subledgers-{uuid.uuid4().hex}"
    out = None
    for name, s in subledgers.SUBLEDGERS.items():
        counts = LD.merge_subledger(spark, sf, name, f"{root}/{name}")
        new = F.col(IG.RUN) == "run-merge"
        one = IG.read_current(spark, f"{root}/{name}").groupBy(F.lit(name).alias("TableName"), IG.RUN).agg(
            F.count(F.lit(1)).alias("Rows"), money(F.sum(s.amount)).alias("Amount"),
            F.when(F.max(new.cast("int")) == 1, F.lit(counts["RowsInserted"])).otherwise(F.lit(0)).cast("bigint").alias("RowsInserted"),
            F.when(F.max(new.cast("int")) == 1, F.lit(counts["RowsUpdated"])).otherwise(F.lit(0)).cast("bigint").alias("RowsUpdated"))
        out = one if out is None else out.unionByName(one)
    return out


@register("close_checklist", f"""
    SELECT g.GB_DATE AS Period, g.GB_CO, g.GB_GLA, a.ACNME, a.ACSTA, a.ACTYP, COUNT(*) AS Keys, {_m('g.GB_AMT')} AS Amount
    FROM glcal g LEFT JOIN accmast a ON a.ACCO = g.GB_CO AND a.ACACC = g.GB_GLA
    WHERE g.GB_DATE IN ({PY}12, {Y0}, {P}) AND g.GB_AMT <> 0 GROUP BY ALL""")
def q_close_checklist(spark, sf):
    return Q.close_checklist(L(spark, sf), [PY * 100 + 12, Y0, P])


# --- SRC2: sub-ledger scan (PARTHIST shape) ----------------------------------------------
@register("scan_subledger", f"""
    SELECT PH_CO, PH_GLIA, COUNT(*) AS Rows, CAST(SUM(PH_NET) AS DECIMAL(18, 2)) AS Amount, min(PH_DTR) AS FirstDate,
           max(PH_DTR) AS LastDate FROM (
        SELECT co AS PH_CO, '33100' AS PH_GLIA, CAST(year(ship) * 10000 + month(ship) * 100 + day(ship) AS INTEGER) AS PH_DTR,
               CAST(CAST(-c AS DECIMAL(18, 0)) * CAST(0.01 AS DECIMAL(3, 2)) AS DECIMAL(12, 2)) AS PH_NET FROM jbase WHERE dept = '4'
        UNION ALL
        SELECT co, '43100', CAST(year(ship) * 10000 + month(ship) * 100 + day(ship) AS INTEGER),
               CAST(CAST(c * {fixed.COST_NUMERATOR} // {fixed.COST_DENOMINATOR} AS DECIMAL(18, 0)) * CAST(0.01 AS DECIMAL(3, 2)) AS DECIMAL(12, 2))
        FROM jbase WHERE dept = '4')
    GROUP BY PH_CO, PH_GLIA""")
def q_scan_subledger(spark, sf):
    ph = _parthist(spark, sf)
    return ph.groupBy("PH_CO", "PH_GLIA").agg(
        F.count(F.lit(1)).alias("Rows"), F.sum("PH_NET").cast("decimal(18,2)").alias("Amount"),
        F.min("PH_DTR").alias("FirstDate"), F.max("PH_DTR").alias("LastDate"))


def _parthist(spark, sf):
    """The parts sub-ledger, written with the ledger build, read back with its fixed
    schema (SRC2)."""
    from ..sources import scan
    from ..sources.subledgers import PARTHIST
    return scan.scan_subledger(spark, L(spark, sf).path("parthist"), PARTHIST)
