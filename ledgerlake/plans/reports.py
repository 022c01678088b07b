"""Catalogue reports (FS17-FS19, FS22-FS27, FS29-FS47, FS50) composed from the
operators.  Inputs are the ledger tables; every report aggregates before it
pivots, so pivots and explodes run on already-small frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed
from ..functions.columns import is_profit_and_loss, money, safe_pct
from ..functions.periods import month_index, parse_period
from .statements import bs_lines

#: Named departments; any other code, and none, is in the column Other.
DEPT_COLUMNS = [("2", "Sales"), ("3", "Service"), ("4", "Parts"), ("5", "Rental"), ("1", "Admin"), ("other", "Other")]


def department_column(department: Column) -> Column:
    """The department's column key, so that a pivot over the keys loses no row."""
    named = [d for d, name in DEPT_COLUMNS if name != "Other"]
    return F.when(department.isin(*named), department).otherwise(F.lit("other"))


def _prev_period(p: int, months: int = 1) -> int:
    i = (p // 100) * 12 + p % 100 - 1 - months
    return (i // 12) * 100 + i % 12 + 1


def statement_lines(section_order: Column) -> Column:
    """Each P&L section row feeds its own line and every subtotal that covers it
    (Gross profit = 10..80, EBITDA = 10..110, ...): a bounded array to explode."""
    own = F.struct(F.lit(None).cast("string").alias("label"), section_order.alias("ord"))
    subs = [F.when(section_order <= last, F.struct(F.lit(label).alias("label"), F.lit(order).alias("ord")))
            for label, order, last in fixed.PL_SUBTOTALS]
    return F.filter(F.array(own, *subs), lambda x: x.isNotNull())


def with_subtotals(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Add subtotal lines to section rows (columns Section, SectionOrder + measures)."""
    e = df.select("*", F.explode(statement_lines(F.col("SectionOrder"))).alias("_l"))
    e = e.select(
        F.coalesce(F.col("_l.label"), F.col("Section")).alias("Line"), F.col("_l.ord").alias("LineOrder"),
        *[F.col(m) for m in measures])
    return e.groupBy("Line", "LineOrder").agg(*[money(F.sum(m)).alias(m) for m in measures])


# --- FS17 / FS18 / FS46 departmental P&L ---------------------------------------------

def _measures(period: int):
    """(measure, sign, predicate) of the departmental layout: current month, prior
    month, their change, and year to date."""
    prev = _prev_period(period)
    y0 = (period // 100) * 100 + 1
    p = F.col("Period")
    return [
        ("Current", 1, p == period), ("PriorMonth", 1, p == prev),
        ("Change", 1, p == period), ("Change", -1, p == prev),
        ("YTD", 1, p.between(y0, period)),
    ], [prev, period, y0]


def departmental_pnl(lines: DataFrame, period, account_filter: Column | None = None) -> DataFrame:
    """FS17: section and subtotal lines x measures, one column per department plus
    Total Fixed (3+4+5) and the total.  Aggregated to (section, department,
    period) first; the measure explode and the department pivot run on that."""
    per = parse_period(period)
    meas, _ = _measures(per)
    li = lines.where(F.col("Period").between(min(_prev_period(per), per // 100 * 100 + 1), per))
    if account_filter is not None:
        li = li.where(account_filter)
    li = li.withColumn("Department", department_column(F.col("Department")))
    base = li.groupBy("Section", "SectionOrder", "Department", "Period").agg(
        money(F.sum("NetIncomeImpact")).alias("v"))
    arr = F.filter(F.array(*[F.when(cond, F.struct(F.lit(m).alias("m"), F.lit(sg).alias("s"))) for m, sg, cond in meas]),
                   lambda x: x.isNotNull())
    e = base.select("Section", "SectionOrder", "Department", "v", F.explode(arr).alias("_m")).select(
        "Section", "SectionOrder", "Department", F.col("_m.m").alias("Measure"), (F.col("v") * F.col("_m.s")).alias("v"))
    lines_ = e.select("*", F.explode(statement_lines(F.col("SectionOrder"))).alias("_l")).select(
        F.coalesce(F.col("_l.label"), F.col("Section")).alias("Line"), F.col("_l.ord").alias("LineOrder"),
        "Department", "Measure", "v")
    pv = lines_.groupBy("Line", "LineOrder", "Measure").pivot("Department", [d for d, _ in DEPT_COLUMNS]).agg(
        money(F.sum("v")))
    z = F.lit(0).cast("decimal(18,2)")
    cols = {name: F.coalesce(F.col(d), z) for d, name in DEPT_COLUMNS}
    out = pv.select("Line", "LineOrder", "Measure", *[c.alias(n) for n, c in cols.items()])
    out = out.withColumn("TotalFixed", money(F.col("Service") + F.col("Parts") + F.col("Rental")))
    out = out.withColumn("Total", money(F.col("Sales") + F.col("TotalFixed") + F.col("Admin") + F.col("Other")))
    return _with_pct_of_revenue(out)


REPORT_COLUMNS = ["Sales", "Service", "Parts", "Rental", "Admin", "Other", "TotalFixed", "Total"]


def _with_pct_of_revenue(out: DataFrame) -> DataFrame:
    """Adds the '%' measure: each current-month line as a percent of its column's total
    revenue, found by a window over the measure's lines (a row per line), so the P&L is
    evaluated once."""
    w = Window.partitionBy("Measure")
    rev = {c: F.max(F.when(F.col("Line") == "Total revenue", F.col(c))).over(w) for c in REPORT_COLUMNS}
    known = out.select("*", *[r.alias("rev_" + c) for c, r in rev.items()], F.max((F.col("Line") == "Total revenue").cast("int")).over(w).alias("has"))
    own = F.struct(F.col("Measure"), *[F.col(c) for c in REPORT_COLUMNS])
    pct = F.struct(F.lit("PctOfRevenue").alias("Measure"),
                   *[safe_pct(F.col(c), F.col("rev_" + c)).cast("decimal(18,2)").alias(c) for c in REPORT_COLUMNS])
    both = F.when((F.col("Measure") == "Current") & (F.col("has") == 1), F.array(own, pct)).otherwise(F.array(own))
    return known.select("Line", "LineOrder", F.inline(both))


def departmental_pnl_detail(lines: DataFrame, period, department: str) -> DataFrame:
    """FS18: account rows of one department with the same measures."""
    per = parse_period(period)
    meas, _ = _measures(per)
    li = lines.where(F.col("Period").between(_prev_period(per, 12), per) & (F.col("Department") == department))
    aggs = []
    for name in ("Current", "PriorMonth", "Change", "YTD"):
        conds = [(sg, cond) for m, sg, cond in meas if m == name]
        expr = None
        for sg, cond in conds:
            term = F.when(cond, F.col("NetIncomeImpact") * sg)
            expr = term if expr is None else F.coalesce(expr, term)
        aggs.append(money(F.coalesce(F.sum(expr), F.lit(0))).alias(name))
    return li.groupBy("Section", "SectionOrder", "AccountNumber", "AccountName").agg(*aggs)


def per_brand_pnl(lines: DataFrame, period, brand: str) -> DataFrame:
    """FS46: departmental P&L restricted to one brand's accounts."""
    accounts = [a for a, b in fixed.BRANDS if b == brand]
    return departmental_pnl(lines, period, F.col("AccountNumber").isin(accounts))


# --- FS19 structured income statement -------------------------------------------------

def structured_income_statement(lines: DataFrame, period) -> DataFrame:
    """FS19: sections and subtotal lines (gross profit, EBITDA, operating income,
    net income) for the month and the year to date."""
    per = parse_period(period)
    y0 = (per // 100) * 100 + 1
    li = lines.where(F.col("Period").between(y0, per))
    s = li.groupBy("Section", "SectionOrder").agg(
        money(F.coalesce(F.sum(F.when(F.col("Period") == per, F.col("NetIncomeImpact"))), F.lit(0))).alias("Current"),
        money(F.sum("NetIncomeImpact")).alias("YTD"))
    return with_subtotals(s, ["Current", "YTD"])


# --- FS22 / FS23 cash flow and retained earnings ---------------------------------------

def cash_flow_indirect(led, lines: DataFrame, start_period, end_period) -> DataFrame:
    """FS22: indirect cash flow between two balance-sheet periods: net income of the
    months in (start, end], depreciation added back, the change of every other
    balance-sheet section (sign: a rise in an asset uses cash), the net change in
    cash, and the residual left unexplained (shown, not hidden).

    One aggregation gives net income and depreciation; one pruned GLCAL read gives
    both balance sheets (closing minus opening)."""
    s, e = parse_period(start_period), parse_period(end_period)
    v = F.col("NetIncomeImpact")
    pl = lines.where((F.col("Period") > s) & (F.col("Period") <= e)).agg(
        money(F.coalesce(F.sum(v), F.lit(0))).alias("ni"),
        money(-F.coalesce(F.sum(F.when(F.col("SectionOrder") == 120, v)), F.lit(0))).alias("da"))
    # Depreciation is inside net income and inside the fixed-asset change; it is shown
    # as an add-back and taken out of the fixed-asset line so nothing counts twice.
    def line(label: str, order: int, amount) -> Column:
        return F.struct(F.lit(label).alias("Line"), F.lit(order).alias("LineOrder"), money(amount).alias("Amount"))
    pl_lines = pl.select(F.inline(F.array(
        line("Net income", 100, F.col("ni")), line("Depreciation and amortization", 110, F.col("da")),
        line("Change in fixed assets net", 240, -F.col("da")))))
    b = bs_lines(led, [s, e])
    delta = b.groupBy("Section", "SectionOrder").agg(
        money(F.sum(F.when(F.col("GB_DATE") == e, F.col("GB_AMT")).otherwise(-F.col("GB_AMT")))).alias("delta"))
    wc = delta.where(F.col("Section") != "Cash").select(
        F.concat(F.lit("Change in "), F.lower("Section")).alias("Line"), (F.col("SectionOrder") + 200).alias("LineOrder"),
        money(-F.col("delta")).alias("Amount"))
    explained = pl_lines.unionByName(wc).groupBy("Line", "LineOrder").agg(money(F.sum("Amount")).alias("Amount"))
    cash = delta.where(F.col("Section") == "Cash").select(F.col("delta").alias("Amount"))
    tail = cash.agg(F.lit("Net change in cash").alias("Line"), F.lit(900).alias("LineOrder"),
                    money(F.coalesce(F.sum("Amount"), F.lit(0))).alias("Amount"))
    resid = cash.unionByName(explained.select(money(-F.col("Amount")).alias("Amount"))).agg(
        F.lit("Residual").alias("Line"), F.lit(950).alias("LineOrder"), money(F.sum("Amount")).alias("Amount"))
    return explained.unionByName(tail).unionByName(resid)


def retained_earnings(lines: DataFrame, period, distributions: DataFrame | None = None) -> DataFrame:
    """FS23: per company, opening (net income of all earlier years) + net income of
    the year to date - distributions = closing.  Distributions are the caller's
    (company, amount) frame; the ledger has none."""
    per = parse_period(period)
    y0 = (per // 100) * 100 + 1
    li = lines.where(F.col("Period") <= per)
    r = li.groupBy("Company").agg(
        money(F.coalesce(F.sum(F.when(F.col("Period") < y0, F.col("NetIncomeImpact"))), F.lit(0))).alias("Opening"),
        money(F.coalesce(F.sum(F.when(F.col("Period") >= y0, F.col("NetIncomeImpact"))), F.lit(0))).alias("NetIncome"))
    if distributions is not None:
        d = distributions.groupBy("Company").agg(money(F.sum("Amount")).alias("Distributions"))
        r = r.join(d, "Company", "left")
    else:
        r = r.withColumn("Distributions", F.lit(None).cast("decimal(18,2)"))
    r = r.withColumn("Distributions", money(F.coalesce("Distributions", F.lit(0))))
    return r.withColumn("Closing", money(F.col("Opening") + F.col("NetIncome") - F.col("Distributions")))


def distributions(balances: DataFrame, accounts: Sequence[str], period) -> DataFrame:
    """FS23: (Company, Amount) paid out in the year to date: how far the balances of the
    distribution accounts moved since the end of the last year.  Two periods are read."""
    per = parse_period(period)
    end = (per // 100 - 1) * 100 + 12
    b = balances.where(F.col("GB_DATE").isin(end, per) & F.col("GB_GLA").isin(*accounts))
    moved = F.when(F.col("GB_DATE") == per, F.col("GB_AMT")).otherwise(-F.col("GB_AMT"))
    return b.groupBy(F.col("GB_CO").alias("Company")).agg(money(F.sum(moved)).alias("Amount"))


# --- FS25 - FS27, FS29, FS30 balances and unclosed activity ---------------------------

def _typed_chart(led) -> DataFrame:
    return led.coacmast.join(led.accmast.select(
        F.col("ACCO").alias("CA_CO"), F.col("ACACC").alias("CA_ACC"), "ACTYP", "ACSTA"), ["CA_CO", "CA_ACC"], "left")


def live_ytd(led) -> DataFrame:
    """FS25: live year-to-date net income, -SUM(CA_CUR) of active P&L accounts."""
    c = _typed_chart(led).where(is_profit_and_loss(F.col("ACTYP")) & (F.coalesce("ACSTA", F.lit("")) != "D"))
    return c.groupBy(F.col("CA_CO").alias("Company")).agg(money(-F.sum("CA_CUR")).alias("LiveYTD"))


def unclosed_activity(led) -> DataFrame:
    """FS26: net income booked after the last close, -SUM(CA_CUR - CA_YTD)."""
    c = _typed_chart(led).where(is_profit_and_loss(F.col("ACTYP")))
    return c.groupBy(F.col("CA_CO").alias("Company")).agg(
        money(-F.sum(F.col("CA_CUR") - F.col("CA_YTD"))).alias("UnclosedNetIncome"))


def unclosed_monthly_pnl(led, last_close: int = fixed.LAST_CLOSE) -> DataFrame:
    """FS27: revenue, expense and net income per unclosed month from the journal:
    aggregate first, then join ACCMAST on company and account."""
    j = led.journal.where(F.col("period") > last_close)
    a = j.groupBy("YJ_CO", "YJ_ACC", "period").agg(money(F.sum("YJ_AMT")).alias("amt"))
    a = a.join(led.accmast.select(F.col("ACCO").alias("YJ_CO"), F.col("ACACC").alias("YJ_ACC"), "ACTYP"),
               ["YJ_CO", "YJ_ACC"])
    t = F.col("ACTYP")
    return a.groupBy(F.col("period").alias("Period")).agg(
        money(-F.coalesce(F.sum(F.when(t == "2", F.col("amt"))), F.lit(0))).alias("Revenue"),
        money(F.coalesce(F.sum(F.when(t == "3", F.col("amt"))), F.lit(0))).alias("Expense"),
        money(-F.coalesce(F.sum(F.when(is_profit_and_loss(t), F.col("amt"))), F.lit(0))).alias("NetIncome"))


def ttm_run_rate(led) -> DataFrame:
    """FS29: trailing-twelve-month net income, -SUM(CA_L12), per company."""
    c = _typed_chart(led).where(is_profit_and_loss(F.col("ACTYP")))
    t = F.col("ACTYP")
    return c.groupBy(F.col("CA_CO").alias("Company")).agg(
        money(-F.sum(F.when(t == "2", F.col("CA_L12")).otherwise(0))).alias("RevenueTTM"),
        money(F.sum(F.when(t == "3", F.col("CA_L12")).otherwise(0))).alias("ExpenseTTM"),
        money(-F.sum("CA_L12")).alias("NetIncomeTTM"))


def closed_plus_unclosed(led, lines: DataFrame, current_year: int = fixed.CURRENT_YEAR) -> DataFrame:
    """FS30: closed months of the year plus one labelled unclosed block, no overlap
    (the unclosed block is CA_CUR - CA_YTD, i.e. only what the closed months miss)."""
    closed = lines.where(F.col("PeriodYear") == current_year).groupBy("Period").agg(
        money(F.sum("NetIncomeImpact")).alias("NetIncome")).select(F.lit("Closed").alias("Block"), "Period", "NetIncome")
    c = _typed_chart(led).where(is_profit_and_loss(F.col("ACTYP")))
    unclosed = c.agg(F.lit("Unclosed").alias("Block"), F.lit(None).cast("int").alias("Period"),
                     money(-F.sum(F.col("CA_CUR") - F.col("CA_YTD"))).alias("NetIncome"))
    return closed.unionByName(unclosed)


# --- FS31 / FS32 matrices ----------------------------------------------------------------

def pivot_matrix(led, year: int) -> DataFrame:
    """FS31: key + name + alias x one column per month of ``year`` (NULL if absent)."""
    from ..operators.aggregates import conditional_pivot
    from ..operators.joins import chart_join, left_dim
    g = led.glcal.where(F.col("GB_DATE").between(year * 100 + 1, year * 100 + 12))
    p = conditional_pivot(g, ["GB_CO", "GB_DIV", "GB_GLC", "GB_GLA"], "GB_DATE",
                          [year * 100 + m for m in range(1, 13)], "GB_AMT", prefix="M")
    p = left_dim(p, led.accmast, cols=("ACNME",))
    return chart_join(p, led.coacmast, "left")


def monthly_named(led, start: int, end: int) -> DataFrame:
    """FS32: monthly amounts with account name and alias."""
    from ..operators.joins import chart_join, left_dim
    g = led.glcal.where(F.col("GB_DATE").between(start, end))
    g = left_dim(g, led.accmast, cols=("ACNME",))
    return chart_join(g, led.coacmast, "left").select(
        "GB_CO", "GB_DIV", "GB_GLC", "GB_GLA", F.rtrim("ACNME").alias("AccountName"), "CA_GLFA", "GB_DATE", "GB_AMT")


# --- FS33 - FS36, FS40 - FS42 dealer reports ----------------------------------------------

def cash_summary(led, lines: DataFrame, period) -> DataFrame:
    """FS33: per branch: cash, receivables, inventory, floor plan (display sign),
    net cash (cash + receivables + inventory - floor plan) and net equity (inventory -
    floor plan: what the dealer owns of the goods on the lot)."""
    per = parse_period(period)
    b = bs_lines(led, per).withColumn("Branch", F.substring("GB_GLC", -2, 2))
    sec = F.col("Section")

    def s(name, sign=1):
        return money(F.coalesce(F.sum(F.when(sec == name, F.col("GB_AMT") * sign)), F.lit(0)))
    r = b.groupBy("Branch").agg(
        s("Cash").alias("Cash"), s("Receivables").alias("Receivables"),
        s("Wholegoods inventory").alias("Inventory"), s("Floorplan payable", -1).alias("FloorPlan"))
    return r.select("Branch", "Cash", "Receivables", "Inventory", "FloorPlan",
                    money(F.col("Cash") + F.col("Receivables") + F.col("Inventory") - F.col("FloorPlan")).alias("NetCash"),
                    money(F.col("Inventory") - F.col("FloorPlan")).alias("NetEquity"))


def cash_equivalents(balances: DataFrame, period) -> DataFrame:
    """FS33: per branch cash in bank, contracts in transit and vehicle receivables, and
    their total; kinds by prefix of the detailed accounts, the longest wins."""
    from ..functions.sections import longest_prefix
    per = parse_period(period)
    rules = balances.sparkSession.createDataFrame(fixed.CASH_EQUIVALENT_PREFIXES, "prefix string, Kind string")
    acct = balances.where(F.col("GB_DATE") == per).groupBy(F.substring("GB_GLC", -2, 2).alias("Branch"), F.col("GB_GLA").alias("Account")).agg(F.sum("GB_AMT").alias("v"))
    kinds = longest_prefix(acct.select("Account").distinct(), "Account", rules).where("Kind is not null")
    names = ["CashInBank", "ContractsInTransit", "VehicleReceivables"]
    g = acct.join(kinds, "Account").groupBy("Branch").pivot("Kind", names).agg(F.sum("v"))
    g = g.select("Branch", *[money(F.coalesce(F.col(n), F.lit(0))).alias(n) for n in names])
    return g.withColumn("TotalCashEquivalents", money(F.col(names[0]) + F.col(names[1]) + F.col(names[2])))


def cash_detail(led, period) -> DataFrame:
    """FS33 detail: the balance-sheet accounts behind the cash summary, by branch."""
    per = parse_period(period)
    b = bs_lines(led, per)
    return b.groupBy(F.substring("GB_GLC", -2, 2).alias("Branch"), "Section", F.col("GB_GLA").alias("Account"),
                     F.rtrim("ACNME").alias("AccountName")).agg(money(F.sum("GB_AMT")).alias("Balance"))


def _brand_table(spark):
    return spark.createDataFrame(fixed.BRANDS, "AccountNumber string, Brand string")


def sales_and_gross(lines: DataFrame, start: int, end: int) -> DataFrame:
    """FS34: brand x branch revenue, cost of sales and margin (equipment accounts,
    brand from the fixed lookup, broadcast)."""
    li = lines.where(F.col("Period").between(start, end)).join(F.broadcast(_brand_table(lines.sparkSession)), "AccountNumber")
    d = F.substring("AccountNumber", 1, 1)
    g = li.groupBy("Brand", "Branch").agg(
        money(-F.coalesce(F.sum(F.when(d == "3", F.col("Amount"))), F.lit(0))).alias("Revenue"),
        money(F.coalesce(F.sum(F.when(d == "4", F.col("Amount"))), F.lit(0))).alias("CostOfSales"))
    g = g.withColumn("GrossMargin", money(F.col("Revenue") - F.col("CostOfSales")))
    return g.withColumn("MarginPct", safe_pct(F.col("GrossMargin"), F.col("Revenue")))


def branch_scorecard(lines: DataFrame, start: int, end: int) -> DataFrame:
    """FS35: revenue, gross margin, operating expense and net income by branch."""
    li = lines.where(F.col("Period").between(start, end))
    o = F.col("SectionOrder")
    v = F.col("NetIncomeImpact")

    def s(cond):
        return money(F.coalesce(F.sum(F.when(cond, v)), F.lit(0)))
    g = li.groupBy("Branch").agg(s(o <= 40).alias("Revenue"), s(o <= 80).alias("GrossMargin"),
                                 s((o > 80) & (o <= 130)).alias("OperatingExpense"), s(o <= 130).alias("NetIncome"))
    return g.withColumn("GrossMarginPct", safe_pct(F.col("GrossMargin"), F.col("Revenue")))


def cost_center_pnl(lines: DataFrame, start: int, end: int) -> DataFrame:
    """FS36: net income by cost center."""
    li = lines.where(F.col("Period").between(start, end))
    return li.groupBy("CostCenter", "Department", "Branch").agg(money(F.sum("NetIncomeImpact")).alias("NetIncome"))


def contribution_margin(lines: DataFrame, start: int, end: int) -> DataFrame:
    """FS36: revenue less direct costs (cost of sales and variable expense) per
    department."""
    li = lines.where(F.col("Period").between(start, end))
    o = F.col("SectionOrder")
    v = F.col("NetIncomeImpact")
    g = li.groupBy("Department").agg(
        money(F.coalesce(F.sum(F.when(o <= 40, v)), F.lit(0))).alias("Revenue"),
        money(-F.coalesce(F.sum(F.when((o > 40) & (o <= 90), v)), F.lit(0))).alias("DirectCosts"))
    return g.withColumn("ContributionMargin", money(F.col("Revenue") - F.col("DirectCosts")))


def metric_values(sections: DataFrame, by: Sequence[str], part: str, rules=None) -> DataFrame:
    """One row per ``by`` with a column for each metric of ``part``: ``sections`` (by, Section,
    Amount in display sign) joined with the rule rows once, summed and pivoted.  A new
    account needs a section, a new metric a rule; neither is named here."""
    rules = [r for r in (rules or fixed.METRIC_RULES) if r[1] == part]
    names = list(dict.fromkeys(r[0] for r in rules))
    table = sections.sparkSession.createDataFrame([(m, sec) for m, _, sec in rules], "Metric string, Section string")
    per = sections.groupBy(*by, "Section").agg(F.sum("Amount").alias("Amount"))
    wide = per.join(table, "Section", "left").groupBy(*by).pivot("Metric", names).agg(F.sum("Amount"))
    return wide.select(*by, *[money(F.coalesce(F.col(n), F.lit(0))).alias(n) for n in names])


def _stocks(led, per: int | None = None) -> DataFrame:
    """Balance-sheet sections in display sign: of one period, or of all."""
    from ..functions.sections import classify_section
    from ..operators.joins import left_dim
    from .statements import flag_side
    g = led.glcal if per is None else led.glcal.where(F.col("GB_DATE") == per)
    g = left_dim(g, led.accmast, cols=("ACTYP", "ACLIA")).where(F.col("ACTYP") == "1")
    amount = F.when(F.col("Statement") == "BA", F.col("GB_AMT")).otherwise(-F.col("GB_AMT"))
    return flag_side(classify_section(g, "GB_GLA")).select(
        F.col("GB_CO").alias("Company"), F.col("GB_DATE").alias("Period"), "Section", amount.alias("Amount"))


def _flows(lines: DataFrame) -> DataFrame:
    """P&L sections in display sign: expense sections positive."""
    cost = F.substring("AccountNumber", 1, 1) != "3"
    return lines.select("*", F.when(cost, -F.col("NetIncomeImpact")).otherwise(F.col("NetIncomeImpact")).alias("Shown")).drop("Amount") \
        .withColumnRenamed("Shown", "Amount")


def _ratio(n, d):
    return F.when(F.col(d).cast("double") != 0, F.col(n).cast("double") / F.col(d).cast("double"))


def ratios(led) -> DataFrame:
    """FS40: current ratio, quick ratio and working capital per month (all companies), by
    the sections of the metric rules.  Ratios are one double division of exact sums."""
    m = metric_values(_stocks(led), ["Period"], "stock")
    return m.select(
        "Period", "CurrentAssets", "CurrentLiabilities", _ratio("CurrentAssets", "CurrentLiabilities").alias("CurrentRatio"),
        _ratio("QuickAssets", "CurrentLiabilities").alias("QuickRatio"),
        money(F.col("CurrentAssets") - F.col("CurrentLiabilities")).alias("WorkingCapital"))


def dealer_kpis(led, lines: DataFrame, period) -> DataFrame:
    """FS41: equipment sales, inventory turns, floor-plan coverage, parts margin %,
    labour recovery and rental performance per company (trailing 12 closed months
    for flows, the period's balance for stocks), by the sections of the metric rules."""
    per = parse_period(period)
    flows = metric_values(_flows(lines.where(F.col("Period").between(_prev_period(per, 11), per))), ["Company"], "flow")
    k = flows.join(metric_values(_stocks(led, per), ["Company"], "stock"), "Company", "full_outer")
    return k.select(
        "Company", "EquipmentSales", _ratio("CostOfSales", "Inventory").alias("InventoryTurns"),
        _ratio("FloorPlan", "Inventory").alias("FloorplanCoverage"),
        safe_pct(F.col("PartsRevenue") - F.col("PartsCost"), F.col("PartsRevenue")).alias("PartsMarginPct"),
        _ratio("ServiceRevenue", "ServiceCost").alias("LaborRecovery"),
        money(F.col("RentalRevenue") - F.col("RentalCost")).alias("RentalContribution"))


def equipment_by_condition(lines: DataFrame, start: int, end: int) -> DataFrame:
    """FS41: new and used equipment per company: revenue, cost, margin and margin %, the
    condition by account prefix."""
    from ..functions.sections import longest_prefix
    rules = lines.sparkSession.createDataFrame(fixed.CONDITION_PREFIXES, "prefix string, Condition string")
    acct = lines.where(F.col("Period").between(start, end)).groupBy("Company", "AccountNumber").agg(F.sum("NetIncomeImpact").alias("v"))
    known = longest_prefix(acct.select("AccountNumber").distinct(), "AccountNumber", rules).where("Condition is not null")
    revenue = F.substring("AccountNumber", 1, 1) == "3"
    g = acct.join(known, "AccountNumber").groupBy("Company", "Condition").agg(
        money(F.coalesce(F.sum(F.when(revenue, F.col("v"))), F.lit(0))).alias("Revenue"),
        money(F.coalesce(F.sum(F.when(~revenue, -F.col("v"))), F.lit(0))).alias("CostOfSales"))
    g = g.withColumn("GrossMargin", money(F.col("Revenue") - F.col("CostOfSales")))
    return g.withColumn("MarginPct", safe_pct(F.col("GrossMargin"), F.col("Revenue")))


def cogs_vs_default(led, lines: DataFrame, start: int, end: int) -> DataFrame:
    """FS42: actual cost-of-sales % of the paired revenue vs the chart default
    CA_GLCP, per company, branch and cost account."""
    from ..operators.joins import paired_accounts
    li = lines.where(F.col("Period").between(start, end))
    p = paired_accounts(li, "AccountNumber", "Amount", ["Company", "CostCenter"]).where(F.col("RightAccount").isNotNull())
    d = led.coacmast.groupBy(F.col("CA_CO").alias("Company"), F.col("CA_CC").alias("CostCenter"),
                             F.col("CA_ACC").alias("RightAccount")).agg(F.max("CA_GLCP").alias("DefaultPct"))
    j = p.join(d, ["Company", "CostCenter", "RightAccount"], "left")
    actual = F.when(F.col("LeftAmount").cast("double") != 0,
                    F.col("RightAmount").cast("double") * 100.0 / F.abs(F.col("LeftAmount").cast("double")))
    return j.select("Company", "CostCenter", "RightAccount", "LeftAmount", "RightAmount", actual.alias("ActualPct"),
                    (F.col("DefaultPct").cast("double") * 100.0).alias("DefaultPct"))


# --- FS37 time layouts -----------------------------------------------------------------------

def quarterly_summary(lines: DataFrame) -> DataFrame:
    """FS37: net income per year, quarter and section."""
    q = ((F.col("PeriodMonth") - 1) / 3).cast("int") + 1
    return lines.groupBy("PeriodYear", q.alias("Quarter"), "Section").agg(money(F.sum("NetIncomeImpact")).alias("NetIncome"))


def ytd_prior_ytd(lines: DataFrame, period) -> DataFrame:
    """FS37: year to date vs the same months of the prior year, by section."""
    per = parse_period(period)
    y0, p0 = (per // 100) * 100 + 1, per - 100
    li = lines.where(F.col("Period").between(y0 - 100, per))
    v = F.col("NetIncomeImpact")
    g = li.groupBy("Section", "SectionOrder").agg(
        money(F.coalesce(F.sum(F.when(F.col("Period").between(y0, per), v)), F.lit(0))).alias("YTD"),
        money(F.coalesce(F.sum(F.when(F.col("Period").between(y0 - 100, p0), v)), F.lit(0))).alias("PriorYTD"))
    return g.withColumn("Change", money(F.col("YTD") - F.col("PriorYTD")))


def five_year_trend(lines: DataFrame, last_year: int) -> DataFrame:
    """FS37: annual net income by section for the five years ending ``last_year``."""
    years = list(range(last_year - 4, last_year + 1))
    li = lines.where(F.col("PeriodYear").between(years[0], years[-1]))
    p = li.groupBy("Section", "SectionOrder").pivot("PeriodYear", years).agg(money(F.sum("NetIncomeImpact")))
    return p.select("Section", "SectionOrder", *[F.col(str(y)).alias(f"Y{y}") for y in years])


def rolling_12_pnl(lines: DataFrame) -> DataFrame:
    """FS37: trailing-12-month net income per company and month (range window on
    the month index, partitioned by company)."""
    m = lines.groupBy("Company", "Period").agg(money(F.sum("NetIncomeImpact")).alias("NetIncome"))
    w = Window.partitionBy("Company").orderBy(month_index(F.col("Period"))).rangeBetween(-11, 0)
    return m.withColumn("Rolling12NetIncome", money(F.sum("NetIncome").over(w)))


# --- FS38, FS39, FS43 - FS45, FS47, FS50 ------------------------------------------------------

def consolidated_pnl(lines: DataFrame, period, elimination_accounts: Sequence[str] = tuple(fixed.ELIMINATION_ACCOUNTS)) -> DataFrame:
    """FS38: section totals over all companies, P&L lines on accounts between companies
    (by default the intercompany accounts) eliminated and shown beside."""
    per = parse_period(period)
    li = lines.where(F.col("Period") == per)
    elim = F.col("AccountNumber").isin(*elimination_accounts) if elimination_accounts else F.lit(False)
    v = F.col("NetIncomeImpact")
    g = li.groupBy("Section", "SectionOrder").agg(
        money(F.sum(v)).alias("Combined"),
        money(F.coalesce(F.sum(F.when(elim, v)), F.lit(0))).alias("Eliminations"))
    return g.withColumn("Consolidated", money(F.col("Combined") - F.col("Eliminations")))


def intercompany_netting(journal: DataFrame, accounts: Sequence[str], upto: int) -> DataFrame:
    """FS38: due-from and due-to netted by pair of companies, with what does not net.

    The two legs of a posting are found by its id and amount: the n-th debit of an
    amount meets the n-th credit of it, by company.  A leg without its other side is shown with no
    second company, so nothing that is eliminated is lost."""
    legs = journal.where(F.col("YJ_ACC").isin(*accounts) & (F.col("period") <= upto) & (F.col("YJ_AMT") != 0)).select(
        "YJ_UID", F.col("YJ_CO").alias("co"), F.col("YJ_AMT").alias("amt"), F.abs("YJ_AMT").alias("size"))
    w = Window.partitionBy("YJ_UID", "amt").orderBy("co")
    legs = legs.withColumn("n", F.row_number().over(w))
    on = ["YJ_UID", "size", "n"]
    debit = legs.where("amt > 0").select(*on, F.col("co").alias("from"), F.col("amt").alias("due_from"))
    credit = legs.where("amt < 0").select(*on, F.col("co").alias("to"), F.col("amt").alias("due_to"))
    j = debit.join(credit, on, "full_outer")
    a, b = F.least("from", "to"), F.greatest("from", "to")
    paired = F.col("from").isNotNull() & F.col("to").isNotNull()
    zero = F.lit(0)
    rows = j.select(a.alias("CompanyA"), F.when(paired, b).alias("CompanyB"),
                    F.when(F.col("from") == a, F.col("due_from")).otherwise(zero).alias("fa"), F.when(F.col("to") == a, F.col("due_to")).otherwise(zero).alias("ta"),
                    (F.coalesce("due_from", zero) + F.coalesce("due_to", zero)).alias("r"))
    g = rows.groupBy("CompanyA", "CompanyB").agg(
        F.count(F.lit(1)).alias("Postings"), money(F.sum("fa")).alias("DueFrom"), money(-F.sum("ta")).alias("DueTo"), money(F.sum("r")).alias("Residual"))
    return g.withColumn("Net", money(F.col("DueFrom") - F.col("DueTo"))).withColumn("Balanced", F.col("CompanyB").isNotNull() & (F.col("Residual") == 0))


def transfer_nets(balances: DataFrame, accounts: Sequence[str], period) -> DataFrame:
    """FS38: each intercompany account by division and over all of them, with the companies
    that carry it: a transfer within the group nets to zero in the last."""
    per = parse_period(period)
    b = balances.where((F.col("GB_DATE") == per) & F.col("GB_GLA").isin(*accounts)).groupBy(
        F.col("GB_GLA").alias("Account"), F.col("GB_DIV").alias("Division"), F.col("GB_CO").alias("co")).agg(F.sum("GB_AMT").alias("v"))
    g = b.groupingSets([["Account", "Division"], ["Account"]], "Account", "Division").agg(
        F.grouping_id().alias("gid"), F.count_distinct("co").alias("Companies"), money(F.sum("v")).alias("Net"))
    return g.select("Account", F.when(F.col("gid") == 0, F.col("Division")).otherwise(F.lit("all")).alias("Division"), "Companies", "Net",
                    (F.abs("Net") <= F.lit(fixed.BALANCE_TOLERANCE).cast("decimal(10,3)")).alias("NetsToZero"))


def income_bridge(lines: DataFrame, a, b) -> DataFrame:
    """FS39: net income of period ``b`` -> period ``a`` explained by section."""
    from .statements import period_compare
    return period_compare(lines, a, b).select("Section", "SectionOrder", F.col("Change").alias("Contribution"))


def margin_walk(lines: DataFrame, a, b) -> DataFrame:
    """FS39: gross margin % by department for two periods."""
    pa, pb = parse_period(a), parse_period(b)
    li = lines.where(F.col("Period").isin(pa, pb))
    o, v, p = F.col("SectionOrder"), F.col("NetIncomeImpact"), F.col("Period")

    def s(cond):
        return money(F.coalesce(F.sum(F.when(cond, v)), F.lit(0)))
    g = li.groupBy("Department").agg(
        s((o <= 40) & (p == pa)).alias("RevenueA"), s((o <= 80) & (p == pa)).alias("MarginA"),
        s((o <= 40) & (p == pb)).alias("RevenueB"), s((o <= 80) & (p == pb)).alias("MarginB"))
    return g.select("Department", safe_pct(F.col("MarginA"), F.col("RevenueA")).alias("MarginPctA"),
                    safe_pct(F.col("MarginB"), F.col("RevenueB")).alias("MarginPctB"))


def cfo_dashboard(led, lines: DataFrame, period) -> DataFrame:
    """FS39: headline figures of one period as (Metric, Value) rows."""
    per = parse_period(period)
    li = lines.where(F.col("Period") == per)
    o, v = F.col("SectionOrder"), F.col("NetIncomeImpact")

    def s(cond):
        return money(F.coalesce(F.sum(F.when(cond, v)), F.lit(0)))
    pl = li.agg(s(o <= 40).alias("Revenue"), s(o <= 80).alias("GrossMargin"), s(o <= 110).alias("EBITDA"),
                s(o <= 130).alias("NetIncome"))
    b = bs_lines(led, per)
    bs = b.agg(money(F.coalesce(F.sum(F.when(F.col("Section") == "Cash", F.col("GB_AMT"))), F.lit(0))).alias("Cash"),
               money(F.coalesce(F.sum(F.when(F.col("Section") == "Receivables", F.col("GB_AMT"))), F.lit(0))).alias("Receivables"))
    return pl.unpivot([], ["Revenue", "GrossMargin", "EBITDA", "NetIncome"], "Metric", "Value").unionByName(
        bs.unpivot([], ["Cash", "Receivables"], "Metric", "Value"))


def second_alias_rollup(led, period) -> DataFrame:
    """FS43 cnh_alias_rollup: roll up by the second alias column."""
    from ..operators.joins import chart_join
    per = parse_period(period)
    j = chart_join(led.glcal.where(F.col("GB_DATE") == per), led.coacmast, "inner", cols=("CA_CNHA",))
    return j.groupBy(F.col("CA_CNHA").alias("SecondAlias")).agg(F.count(F.lit(1)).alias("Lines"),
                                                                money(F.sum("GB_AMT")).alias("Amount"))


def alias_coverage(led) -> DataFrame:
    """FS43: share of chart keys and of absolute balance that carry an alias."""
    c = led.coacmast
    mapped = F.coalesce(F.col("CA_GLFA"), F.lit("")) != ""
    g = c.agg(F.count(F.lit(1)).alias("Keys"), F.count_if(mapped).alias("MappedKeys"),
              money(F.sum(F.abs("CA_CUR"))).alias("AbsBalance"),
              money(F.coalesce(F.sum(F.when(mapped, F.abs("CA_CUR"))), F.lit(0))).alias("MappedAbsBalance"))
    return g.select("*", (F.col("MappedKeys").cast("double") * 100.0 / F.col("Keys").cast("double")).alias("KeyPct"),
                    safe_pct(F.col("MappedAbsBalance"), F.col("AbsBalance")).alias("BalancePct"))


def multi_alias(led) -> DataFrame:
    """FS43: accounts mapped to more than one alias."""
    c = led.coacmast.where(F.coalesce(F.col("CA_GLFA"), F.lit("")) != "")
    g = c.groupBy(F.col("CA_CO").alias("Company"), F.col("CA_ACC").alias("Account")).agg(
        F.countDistinct("CA_GLFA").alias("Aliases"), F.array_sort(F.collect_set("CA_GLFA")).alias("AliasList"))
    # collect_set here gathers the distinct aliases of one account: bounded by the alias count.
    return g.where(F.col("Aliases") > 1).select("Company", "Account", "Aliases",
                                                 F.array_join("AliasList", ",").alias("AliasList"))


def accrual_aging(led, accounts: Sequence[str] = ("12000", "20350")) -> DataFrame:
    """FS44: per company and accrual account, latest balance, the last period the
    balance was zero or changed sign, and months since."""
    g = led.glcal.where(F.col("GB_GLA").isin(*accounts)).groupBy("GB_CO", "GB_GLA", "GB_DATE").agg(
        money(F.sum("GB_AMT")).alias("Balance"))
    w = Window.partitionBy("GB_CO", "GB_GLA").orderBy("GB_DATE")
    g = g.withColumn("prev", F.lag("Balance").over(w))
    reset = (F.col("Balance") == 0) | (F.signum("Balance") != F.signum(F.coalesce("prev", F.col("Balance"))))
    a = g.groupBy("GB_CO", "GB_GLA").agg(
        F.max_by("Balance", "GB_DATE").alias("LatestBalance"), F.max("GB_DATE").alias("LatestPeriod"),
        F.max(F.when(reset, F.col("GB_DATE"))).alias("LastResetPeriod"), F.min("GB_DATE").alias("FirstPeriod"))
    since = month_index(F.col("LatestPeriod")) - month_index(F.coalesce("LastResetPeriod", "FirstPeriod"))
    return a.withColumn("MonthsOutstanding", since.cast("int"))


def cash_accounts(led, period, months: int = 6) -> DataFrame:
    """FS45: balances of the accounts flagged as cash (ACCT = 'Y'), per company, for
    the last ``months`` periods."""
    from ..operators.joins import left_dim
    per = parse_period(period)
    g = led.glcal.where(F.col("GB_DATE").between(_prev_period(per, months - 1), per))
    g = left_dim(g, led.accmast, cols=("ACCT",)).where(F.col("ACCT") == "Y")
    return g.groupBy("GB_CO", "GB_GLA", "GB_DATE").agg(money(F.sum("GB_AMT")).alias("Balance"))


def ar_flagged_balances(led, period, account: str = "10200") -> DataFrame:
    """FS45: receivable balances by company and branch at the period, largest first."""
    per = parse_period(period)
    g = led.glcal.where((F.col("GB_DATE") == per) & (F.col("GB_GLA") == account))
    return g.groupBy("GB_CO", F.substring("GB_GLC", -2, 2).alias("Branch")).agg(money(F.sum("GB_AMT")).alias("Balance")) \
        .orderBy(F.abs("Balance").desc(), "GB_CO", "Branch")


def allocation_analysis(lines: DataFrame, period, accounts: Sequence[str]) -> DataFrame:
    """FS47: the given allocation accounts pivoted by department for one period."""
    per = parse_period(period)
    li = lines.where((F.col("Period") == per) & F.col("AccountNumber").isin(*accounts))
    li = li.withColumn("Department", department_column(F.col("Department")))
    p = li.groupBy("AccountNumber").pivot("Department", [d for d, _ in DEPT_COLUMNS]).agg(money(F.sum("Amount")))
    return p.select("AccountNumber", *[F.coalesce(F.col(d), F.lit(0).cast("decimal(18,2)")).alias(n) for d, n in DEPT_COLUMNS])


def account_reconcile(journal: DataFrame, account_a: str, account_b: str, sign_b: int = -1) -> DataFrame:
    """FS50: monthly activity of one account against another (times ``sign_b``),
    per company and period, with the difference (full outer on the period)."""
    from ..operators.joins import full_outer_reconcile
    a = journal.where(F.col("YJ_ACC") == account_a).select(F.col("YJ_CO").alias("Company"), F.col("period").alias("Period"), "YJ_AMT")
    b = journal.where(F.col("YJ_ACC") == account_b).select(F.col("YJ_CO").alias("Company"), F.col("period").alias("Period"),
                                                           (F.col("YJ_AMT") * sign_b).alias("YJ_AMT"))
    return full_outer_reconcile(a, b, ["Company", "Period"], "YJ_AMT", "YJ_AMT")
