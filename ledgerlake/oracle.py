"""Independent SQL for the correctness check (DuckDB dialect, ANSI where possible).

Each registered query has an oracle statement that re-derives the ledger from the
driver's raw tables with plain SQL: the same fixed values, different code.  The
roll-ups here use a dense month grid with a left join and a running SUM, where
the Spark side uses a window with ``lead`` and an explode, so a shared mistake in
one algorithm is not repeated in the other.

``with_ctes(body)`` prepends only the common table expressions ``body`` needs.
"""

from __future__ import annotations

import re

from . import fixed


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case(col: str, pairs, default: str) -> str:
    arms = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in pairs)
    return f"CASE {col} {arms} ELSE {_q(default)} END"


def _values(rows, cols) -> str:
    def lit(v):
        return str(v) if isinstance(v, int) else _q(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(cols)})"


def _yyyymmdd(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"


MIDX = "(CAST({p} // 100 AS INTEGER) * 12 + {p} % 100 - 1)"


def midx(p: str) -> str:
    return MIDX.format(p=p)


def period_of_midx(i: str) -> str:
    return f"CAST(({i}) // 12 * 100 + ({i}) % 12 + 1 AS INTEGER)"


_chart_rows = [
    (sta, acc, name, fixed.ACCOUNT_TYPE_BY_DIGIT.get(acc[0], ""), fixed.LIABILITY_FLAG_BY_DIGIT.get(acc[0], ""),
     "", "Y" if acc in fixed.CASH_ACCOUNTS else "")
    for acc, name, sta in fixed.ACCOUNTS
]
_account_list = "[" + ", ".join(_q(a) for a, _, _ in fixed.ACCOUNTS) + "]"
LC = fixed.LAST_CLOSE
CY = fixed.CURRENT_YEAR
KEYJ = "YJ_CO, YJ_DIV, YJ_CC, YJ_ACC"
KEYG = "GB_CO, GB_DIV, GB_GLC, GB_GLA"

CTES: list[tuple[str, str]] = [
    ("chart", _values(_chart_rows, ["ACSTA", "ACACC", "ACNME", "ACTYP", "ACLIA", "ACMEM", "ACCT"])),
    ("sections", _values(fixed.SECTIONS, ["rule_account", "Statement", "Section", "SectionOrder"])),
    ("departments", _values(fixed.DEPARTMENTS, ["Department", "DepartmentName"])),
    ("brands", _values(fixed.BRANDS, ["brand_account", "Brand"])),
    ("jbase", f"""
        SELECT lpad(CAST(n.n_regionkey + 1 AS VARCHAR), 2, '0') AS co,
               lpad(CAST(l.l_suppkey % {fixed.BRANCH_COUNT} + 1 AS VARCHAR), 2, '0') AS br,
               {_case('p.p_type', [(t, d) for t, d, _ in fixed.PART_TYPE_MAP], '2')} AS dept,
               {_case('p.p_type', [(t, a) for t, _, a in fixed.PART_TYPE_MAP], '32000')} AS rev,
               {_case('o.o_orderpriority', fixed.PRIORITY_EXPENSE_MAP, '58400')} AS expacc,
               {_case('l.l_linestatus', fixed.LINESTATUS_STOCK_MAP, '20350')} AS stock,
               CAST(round(l.l_extendedprice * 100) AS BIGINT) AS c,
               CAST(round(l.l_discount * 100) AS BIGINT) AS dp,
               CAST(round(l.l_tax * 100) AS BIGINT) AS tp,
               l.l_linenumber, l.l_orderkey, o.o_custkey, l.l_returnflag,
               CAST(l.l_shipdate AS DATE) AS ship
        FROM lineitem l
        JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN part p ON l.l_partkey = p.p_partkey
        JOIN supplier s ON l.l_suppkey = s.s_suppkey
        JOIN nation n ON s.s_nationkey = n.n_nationkey"""),
    ("jlegs", f"""
        SELECT *, c * {fixed.COST_NUMERATOR} // {fixed.COST_DENOMINATOR} AS cost,
               c * dp // 100 AS di, c * tp // 100 AS tx,
               unnest(CASE WHEN l_linenumber = 1 THEN [1, 2, 3, 4, 5, 6, 7, 8, 9, 10]
                           ELSE [1, 2, 3, 4, 5, 6, 7, 8] END) AS leg
        FROM jbase"""),
    ("journal", f"""
        SELECT CASE WHEN leg = 10 THEN {_q(fixed.HOLDING_COMPANY)} ELSE co END AS YJ_CO,
               '01' AS YJ_DIV,
               lpad(CAST(l_orderkey % 10000 AS VARCHAR), 4, '0') AS YJ_JRL,
               CASE WHEN leg IN (2, 3) THEN dept || br WHEN leg IN (5, 7) THEN '1' || br ELSE '0' || br END AS YJ_CC,
               CASE leg WHEN 1 THEN {_q(fixed.RECEIVABLE_ACCOUNT)} WHEN 2 THEN rev
                        WHEN 3 THEN '4' || substr(rev, 2, 4) WHEN 4 THEN stock WHEN 5 THEN expacc
                        WHEN 6 THEN {_q(fixed.CASH_ACCOUNT)} WHEN 7 THEN {_q(fixed.DEPRECIATION_ACCOUNT)}
                        WHEN 8 THEN {_q(fixed.ACCUM_DEPRECIATION_ACCOUNT)}
                        ELSE {_q(fixed.INTERCOMPANY_ACCOUNT)} END AS YJ_ACC,
               CAST(CAST(CASE leg WHEN 1 THEN c WHEN 2 THEN -c WHEN 3 THEN cost WHEN 4 THEN -cost
                                  WHEN 5 THEN di WHEN 6 THEN -di WHEN 7 THEN tx WHEN 8 THEN -tx
                                  WHEN 9 THEN di ELSE -di END AS DECIMAL(18, 0))
                    * CAST(0.01 AS DECIMAL(3, 2)) AS DECIMAL(12, 2)) AS YJ_AMT,
               '' AS YJ_OSJ,
               CASE WHEN l_returnflag = 'R'
                    THEN CAST((year(ship) % 100) * 10000 + month(ship) * 100 + day(ship) AS INTEGER)
                    ELSE 0 END AS YJ_RDT,
               '' AS YJ_RJRL,
               CAST({_yyyymmdd('ship')} AS BIGINT) * 10000000000 + l_orderkey * 10 + l_linenumber AS YJ_UID,
               {_yyyymmdd('ship + 5 * l_linenumber')} AS YJ_PDT,
               {_yyyymmdd('ship')} AS YJ_DT,
               '' AS YJ_MEM, '' AS YJ_SRC, '' AS YJ_STA, '' AS YJ_RID, '' AS YJ_USE,
               'USER' || lpad(CAST(o_custkey % 50 AS VARCHAR), 2, '0') AS YJ_CRT,
               '' AS YJ_DES,
               CAST(leg AS INTEGER) AS leg,
               CAST({_yyyymmdd('ship')} // 100 AS INTEGER) AS period
        FROM jlegs"""),
    ("accmast", f"""
        SELECT ch.ACSTA, c.ACCO, ch.ACACC, ch.ACNME, ch.ACTYP, ch.ACLIA, ch.ACMEM, ch.ACCT,
               '' AS ACLT, '' AS ACGRP, '' AS AC_MCR, '' AS AC_ET, '' AS AC_FILA
        FROM (SELECT ACCO, unnest({_account_list}) AS ACACC
              FROM (SELECT DISTINCT YJ_CO AS ACCO FROM journal)) c
        JOIN chart ch ON ch.ACACC = c.ACACC"""),
    ("monthly", f"""
        SELECT m.*, a.ACTYP FROM (
            SELECT {KEYJ}, period, CAST(SUM(YJ_AMT) AS DECIMAL(18, 2)) AS activity
            FROM journal WHERE period <= {LC} GROUP BY {KEYJ}, period) m
        LEFT JOIN accmast a ON a.ACCO = m.YJ_CO AND a.ACACC = m.YJ_ACC"""),
    ("bs_grid", f"""
        SELECT {KEYJ}, unnest(generate_series(first_idx, {midx(str(LC))})) AS midx
        FROM (SELECT {KEYJ}, min({midx('period')}) AS first_idx
              FROM monthly WHERE ACTYP = '1' GROUP BY {KEYJ})"""),
    ("glcal_bs", f"""
        SELECT g.YJ_CO, g.YJ_DIV, g.YJ_CC, g.YJ_ACC, {period_of_midx('g.midx')} AS period,
               CAST(SUM(coalesce(m.activity, 0)) OVER (PARTITION BY g.YJ_CO, g.YJ_DIV, g.YJ_CC, g.YJ_ACC
                    ORDER BY g.midx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(18, 2)) AS amt
        FROM bs_grid g LEFT JOIN monthly m
          ON m.YJ_CO = g.YJ_CO AND m.YJ_DIV = g.YJ_DIV AND m.YJ_CC = g.YJ_CC AND m.YJ_ACC = g.YJ_ACC
         AND {midx('m.period')} = g.midx AND m.ACTYP = '1'"""),
    ("glcal", f"""
        SELECT '' AS GB_STA, YJ_CO AS GB_CO, YJ_DIV AS GB_DIV, YJ_CC AS GB_GLC, YJ_ACC AS GB_GLA,
               CAST(period AS INTEGER) AS GB_DATE, CAST(amt AS DECIMAL(18, 2)) AS GB_AMT,
               CASE WHEN YJ_ACC = {_q(fixed.YEAR_END_ACCOUNT)} AND period % 100 = {fixed.YEAR_END_MONTH}
                    THEN 'Y' ELSE '' END AS GB_YE
        FROM (SELECT {KEYJ}, period, activity AS amt FROM monthly WHERE coalesce(ACTYP, '') <> '1'
              UNION ALL
              SELECT {KEYJ}, period, amt FROM glcal_bs)"""),
    ("glfis", "SELECT '' AS GF_STA, GB_CO AS GF_CO, GB_DIV AS GF_DIV, GB_GLC AS GF_GLC, GB_GLA AS GF_GLA, "
              "CAST(GB_DATE // 100 AS INTEGER) AS GF_YR, "
              + ", ".join(f"CAST(coalesce(SUM(CASE WHEN GB_DATE % 100 = {k} THEN GB_AMT END), 0) AS DECIMAL(18, 2)) AS GF_H{k}"
                          for k in range(1, 13))
              + f" FROM glcal GROUP BY {KEYG}, GB_DATE // 100"),
    ("deptmast", "SELECT GB_CO AS DP_CO, GB_DIV AS DP_DIV, GB_GLC AS DP_CC, GB_GLA AS DP_ACC, "
                 + ", ".join(f"CAST(coalesce(SUM(CASE WHEN GB_DATE = {CY * 100 + k} THEN GB_AMT END), 0) AS DECIMAL(18, 2)) AS DP_C{k}"
                             for k in range(1, 13)) + ", "
                 + ", ".join(f"CAST(coalesce(SUM(CASE WHEN GB_DATE = {(CY - 1) * 100 + k} THEN GB_AMT END), 0) AS DECIMAL(18, 2)) AS DP_L{k}"
                             for k in range(1, 13))
                 + ", '' AS DP_AL, '' AS DP_GRP, '' AS DP_STA, '' AS DP_FILB"
                 + f" FROM glcal WHERE GB_DATE BETWEEN {(CY - 1) * 100 + 1} AND {CY * 100 + 12} GROUP BY {KEYG}"),
    ("latest", "SELECT max(period) AS latest_period, "
               f"{midx('max(period)')} - 11 AS l12_idx FROM journal"),
    ("balances", f"""
        SELECT s.{KEYJ.replace(', ', ', s.')},
               CASE WHEN a.ACTYP = '1' THEN bs_ytd ELSE pl_ytd END AS CA_YTD,
               CASE WHEN a.ACTYP = '1' THEN bs_cur ELSE pl_cur END AS CA_CUR,
               CASE WHEN a.ACTYP = '1' THEN CAST(0 AS DECIMAL(18, 2)) ELSE pl_l12 END AS CA_L12
        FROM (SELECT {KEYJ},
                CAST(coalesce(SUM(CASE WHEN period BETWEEN {CY * 100 + 1} AND {LC} THEN YJ_AMT END), 0) AS DECIMAL(18, 2)) AS pl_ytd,
                CAST(coalesce(SUM(CASE WHEN period BETWEEN {CY * 100 + 1} AND {CY * 100 + 12} THEN YJ_AMT END), 0) AS DECIMAL(18, 2)) AS pl_cur,
                CAST(coalesce(SUM(CASE WHEN {midx('period')} BETWEEN (SELECT l12_idx FROM latest)
                                            AND (SELECT l12_idx + 11 FROM latest) THEN YJ_AMT END), 0) AS DECIMAL(18, 2)) AS pl_l12,
                CAST(coalesce(SUM(CASE WHEN period <= {LC} THEN YJ_AMT END), 0) AS DECIMAL(18, 2)) AS bs_ytd,
                CAST(SUM(YJ_AMT) AS DECIMAL(18, 2)) AS bs_cur
              FROM journal GROUP BY {KEYJ}) s
        LEFT JOIN accmast a ON a.ACCO = s.YJ_CO AND a.ACACC = s.YJ_ACC"""),
    ("coacmast", f"""
        SELECT '' AS CA_STA, YJ_CO AS CA_CO, YJ_DIV AS CA_DIV, YJ_CC AS CA_CC, YJ_ACC AS CA_ACC,
               CASE WHEN YJ_ACC = {_q(fixed.UNMAPPED_ACCOUNT)} THEN ''
                    WHEN YJ_ACC = {_q(fixed.SPLIT_ALIAS_ACCOUNT)}
                         THEN CASE WHEN right(YJ_CC, 2) <= {_q(fixed.SPLIT_ALIAS_CUT)}
                                   THEN {_q(fixed.SPLIT_ALIAS_LOW)} ELSE {_q(fixed.SPLIT_ALIAS_HIGH)} END
                    ELSE 'F' || substr(YJ_ACC, 1, 3) END AS CA_GLFA,
               CASE WHEN YJ_ACC < '3' THEN '' ELSE 'C' || substr(YJ_ACC, 1, 2) END AS CA_CNHA,
               CAST(CASE WHEN substr(YJ_ACC, 1, 1) = '4' THEN {fixed.COGS_DEFAULT_PCT} ELSE 0 END AS DECIMAL(5, 3)) AS CA_GLCP,
               CAST(0 AS DECIMAL(7, 0)) AS CA_SLS, CA_YTD, CA_CUR, CA_L12
        FROM balances
        WHERE NOT (YJ_ACC = {_q(fixed.ORPHAN_ACCOUNT)} AND right(YJ_CC, 2) = {_q(fixed.ORPHAN_BRANCH)})"""),
    ("bsl", """
        SELECT g.*, a.ACNME, a.ACTYP, a.ACCT,
               CASE a.ACLIA WHEN 'A' THEN 'BA' WHEN 'L' THEN 'BL' ELSE s.Statement END AS Statement,
               s.Section, s.SectionOrder
        FROM glcal g JOIN accmast a ON a.ACCO = g.GB_CO AND a.ACACC = g.GB_GLA
        LEFT JOIN sections s ON s.rule_account = g.GB_GLA WHERE a.ACTYP = '1'"""),
    ("tchart", """
        SELECT c.*, a.ACTYP, a.ACSTA, a.ACLIA FROM coacmast c
        LEFT JOIN accmast a ON a.ACCO = c.CA_CO AND a.ACACC = c.CA_ACC"""),
    ("is_lines", """
        SELECT g.GB_CO AS Company, g.GB_DIV AS Division, right(g.GB_GLC, 2) AS Branch,
               g.GB_GLC AS CostCenter, substr(g.GB_GLC, 1, 1) AS Department,
               g.GB_GLA AS AccountNumber, a.ACNME AS AccountName,
               g.GB_DATE AS Period, CAST(g.GB_DATE // 100 AS INTEGER) AS PeriodYear,
               CAST(g.GB_DATE % 100 AS INTEGER) AS PeriodMonth,
               make_date(CAST(g.GB_DATE // 100 AS INTEGER), CAST(g.GB_DATE % 100 AS INTEGER), 1) AS PeriodStart,
               a.ACTYP AS AcctType, a.ACLIA AS AcctSubType, a.AC_ET AS ExpenseType,
               a.AC_MCR AS MCRatioCode, a.ACGRP AS ReportGroupCode, a.ACSTA AS AccountStatus,
               s.Section, s.SectionOrder, g.GB_AMT AS Amount,
               CAST(-g.GB_AMT AS DECIMAL(18, 2)) AS NetIncomeImpact, g.GB_YE AS YearEnd
        FROM glcal g
        JOIN accmast a ON a.ACCO = g.GB_CO AND a.ACACC = g.GB_GLA
        LEFT JOIN sections s ON s.rule_account = g.GB_GLA
        WHERE a.ACTYP IN ('2', '3')"""),
]

_NAMES = [n for n, _ in CTES]
_BODY = dict(CTES)


def _refs(sql: str) -> set[str]:
    return {n for n in _NAMES if re.search(rf"\b{n}\b", sql)}


def with_ctes(body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prepend the CTEs that ``body`` (and ``extra`` CTEs) reference, in order."""
    extra = extra or []
    text = body + " ".join(s for _, s in extra)
    need: set[str] = set()
    todo = _refs(text)
    while todo:
        n = todo.pop()
        if n in need:
            continue
        need.add(n)
        todo |= _refs(_BODY[n]) - need - {n}
    parts = [f"{n} AS ({_BODY[n]})" for n in _NAMES if n in need]
    parts += [f"{n} AS ({s})" for n, s in extra]
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body
