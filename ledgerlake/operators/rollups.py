"""Roll-ups of the one journal: AGG10-AGG14 and WIN1.

The monthly, annual, departmental and balance tables are *alternative
aggregations of the same journal* (never add across them).  Each is built with
partial (map-side) aggregation first, so a hot key costs one row per map task,
and only then joined to the bounded account master.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed
from ..functions.columns import money
from ..functions.periods import month_index, period_of_index
from ..sources.schemas import GLCAL_KEY, JOURNAL_KEY


def journal_to_period(journal: DataFrame, upto: int | None = None, start: int | None = None) -> DataFrame:
    """AGG10: SUM(amount) by spine key and period (``YJ_DT div 100``).

    The range filter is on the partition column ``period``, so it prunes files.
    """
    j = journal
    if upto is not None:
        j = j.where(F.col("period") <= upto)
    if start is not None:
        j = j.where(F.col("period") >= start)
    return j.groupBy(*JOURNAL_KEY, "period").agg(money(F.sum("YJ_AMT")).alias("activity"))


def _account_types(accmast: DataFrame) -> DataFrame:
    # ACCMAST is bounded by companies x chart (not by the journal), so broadcast is safe.
    return accmast.select(
        F.col("ACCO").alias("YJ_CO"), F.col("ACACC").alias("YJ_ACC"), "ACTYP")


def build_glcal(journal: DataFrame, accmast: DataFrame, last_close: int = fixed.LAST_CLOSE) -> DataFrame:
    """AGG11 + WIN1: journal -> GLCAL for closed periods.

    P&L keys carry the period's activity.  Balance-sheet keys carry the running
    balance on a dense month grid from the key's first period to ``last_close``:
    one window per key computes the cumulative sum and the next posting month, and
    each posting row is exploded over the months until the next one — densifying
    without a grid join or a second shuffle.
    """
    monthly = journal_to_period(journal, upto=last_close).join(
        _account_types(accmast), ["YJ_CO", "YJ_ACC"], "left")
    pl = monthly.where(F.coalesce(F.col("ACTYP"), F.lit("")) != "1").select(
        *JOURNAL_KEY, F.col("period"), F.col("activity").alias("amt"))

    close_idx = month_index(F.lit(last_close))
    w = Window.partitionBy(*JOURNAL_KEY).orderBy("midx")
    bs = (
        monthly.where(F.col("ACTYP") == "1")
        .withColumn("midx", month_index(F.col("period")))
        .withColumn("bal", money(F.sum("activity").over(w.rowsBetween(Window.unboundedPreceding, 0))))
        .withColumn("nxt", F.lead("midx", 1).over(w))
        .withColumn("until", F.coalesce(F.col("nxt") - 1, close_idx))
        .select(*JOURNAL_KEY, F.explode(F.sequence("midx", "until")).alias("midx"), F.col("bal").alias("amt"))
        .select(*JOURNAL_KEY, period_of_index(F.col("midx")).alias("period"), "amt")
    )
    both = pl.unionByName(bs)
    return both.select(
        F.lit("").alias("GB_STA"),
        F.col("YJ_CO").alias("GB_CO"),
        F.col("YJ_DIV").alias("GB_DIV"),
        F.col("YJ_CC").alias("GB_GLC"),
        F.col("YJ_ACC").alias("GB_GLA"),
        F.col("period").cast("int").alias("GB_DATE"),
        money(F.col("amt")).alias("GB_AMT"),
        F.when((F.col("YJ_ACC") == fixed.YEAR_END_ACCOUNT) & (F.col("period") % 100 == fixed.YEAR_END_MONTH),
               F.lit("Y")).otherwise(F.lit("")).alias("GB_YE"),
    )


def build_glfis(glcal: DataFrame) -> DataFrame:
    """AGG12: monthly -> key x year with 12 buckets (missing months 0).

    A pivot on a fixed list of months is twelve conditional sums in one pass."""
    y = (F.col("GB_DATE") / 100).cast("int")
    m = F.col("GB_DATE") % 100
    buckets = [
        money(F.coalesce(F.sum(F.when(m == k, F.col("GB_AMT"))), F.lit(0))).alias(f"GF_H{k}")
        for k in range(1, 13)
    ]
    return (
        glcal.groupBy(*GLCAL_KEY, y.alias("GF_YR"))
        .agg(*buckets)
        .select(
            F.lit("").alias("GF_STA"), F.col("GB_CO").alias("GF_CO"), F.col("GB_DIV").alias("GF_DIV"),
            F.col("GB_GLC").alias("GF_GLC"), F.col("GB_GLA").alias("GF_GLA"), "GF_YR",
            *[f"GF_H{k}" for k in range(1, 13)],
        )
    )


def build_deptmast(glcal: DataFrame, current_year: int = fixed.CURRENT_YEAR) -> DataFrame:
    """AGG13: current-year and prior-year buckets from closed months only."""
    y = (F.col("GB_DATE") / 100).cast("int")
    m = F.col("GB_DATE") % 100
    prior = current_year - 1

    def bucket(year: int, k: int, name: str):
        return money(F.coalesce(F.sum(F.when((y == year) & (m == k), F.col("GB_AMT"))), F.lit(0))).alias(name)

    aggs = [bucket(current_year, k, f"DP_C{k}") for k in range(1, 13)]
    aggs += [bucket(prior, k, f"DP_L{k}") for k in range(1, 13)]
    return (
        glcal.where((F.col("GB_DATE") >= prior * 100 + 1) & (F.col("GB_DATE") <= current_year * 100 + 12))
        .groupBy(*GLCAL_KEY).agg(*aggs)
        .select(
            F.col("GB_CO").alias("DP_CO"), F.col("GB_DIV").alias("DP_DIV"),
            F.col("GB_GLC").alias("DP_CC"), F.col("GB_GLA").alias("DP_ACC"),
            *[f"DP_C{k}" for k in range(1, 13)], *[f"DP_L{k}" for k in range(1, 13)],
            F.lit("").alias("DP_AL"), F.lit("").alias("DP_GRP"), F.lit("").alias("DP_STA"),
            F.lit("").alias("DP_FILB"),
        )
    )


def build_balances(journal: DataFrame, accmast: DataFrame, latest_period: int,
                   last_close: int = fixed.LAST_CLOSE) -> DataFrame:
    """AGG14: CA_YTD, CA_CUR, CA_L12 per key in one pass of conditional sums.

    P&L: YTD = closed months of the current year, CUR = all of the current year,
    L12 = the 12 periods ending at ``latest_period``.  Balance sheet: YTD = balance
    at the last close, CUR = balance after the last posting, L12 = 0.
    """
    year = last_close // 100
    p = F.col("period")
    a = F.col("YJ_AMT")
    l12_start = ((latest_period // 100) * 12 + latest_period % 100 - 1) - 11
    l12_start_period = (l12_start // 12) * 100 + l12_start % 12 + 1

    def s(cond):
        return money(F.coalesce(F.sum(F.when(cond, a)), F.lit(0)))

    sums = journal.groupBy(*JOURNAL_KEY).agg(
        s((p >= year * 100 + 1) & (p <= last_close)).alias("pl_ytd"),
        s((p >= year * 100 + 1) & (p <= year * 100 + 12)).alias("pl_cur"),
        s((p >= l12_start_period) & (p <= latest_period)).alias("pl_l12"),
        s(p <= last_close).alias("bs_ytd"),
        money(F.sum(a)).alias("bs_cur"),
    )
    t = sums.join(_account_types(accmast), ["YJ_CO", "YJ_ACC"], "left")
    is_bs = F.col("ACTYP") == "1"
    return t.select(
        *JOURNAL_KEY,
        F.when(is_bs, F.col("bs_ytd")).otherwise(F.col("pl_ytd")).alias("CA_YTD"),
        F.when(is_bs, F.col("bs_cur")).otherwise(F.col("pl_cur")).alias("CA_CUR"),
        F.when(is_bs, F.lit(0).cast("decimal(18,2)")).otherwise(F.col("pl_l12")).alias("CA_L12"),
    )


def build_coacmast(balances: DataFrame) -> DataFrame:
    """COACMAST: every posted key except the orphan rule, with alias and balances
    (FIXTURES F2)."""
    acc = F.col("YJ_ACC")
    branch = F.substring(F.col("YJ_CC"), -2, 2)
    alias = (
        F.when(acc == fixed.UNMAPPED_ACCOUNT, F.lit(""))
        .when(acc == fixed.SPLIT_ALIAS_ACCOUNT,
              F.when(branch <= fixed.SPLIT_ALIAS_CUT, F.lit(fixed.SPLIT_ALIAS_LOW))
              .otherwise(F.lit(fixed.SPLIT_ALIAS_HIGH)))
        .otherwise(F.concat(F.lit("F"), F.substring(acc, 1, 3)))
    )
    orphan = (acc == fixed.ORPHAN_ACCOUNT) & (branch == fixed.ORPHAN_BRANCH)
    return balances.where(~orphan).select(
        F.lit("").alias("CA_STA"),
        F.col("YJ_CO").alias("CA_CO"),
        F.col("YJ_DIV").alias("CA_DIV"),
        F.col("YJ_CC").alias("CA_CC"),
        F.col("YJ_ACC").alias("CA_ACC"),
        alias.alias("CA_GLFA"),
        F.when(F.substring(acc, 1, 1).isin("1", "2"), F.lit("")).otherwise(F.concat(F.lit("C"), F.substring(acc, 1, 2))).alias("CA_CNHA"),
        F.when(F.substring(acc, 1, 1) == "4", F.lit(fixed.COGS_DEFAULT_PCT))
        .otherwise(F.lit("0.000")).cast("decimal(5,3)").alias("CA_GLCP"),
        F.lit(0).cast("decimal(7,0)").alias("CA_SLS"),
        "CA_YTD", "CA_CUR", "CA_L12",
    )


INCOME_KEY = ["Company", "Division", "CostCenter"]


def build_income(lines: DataFrame, last_close: int = fixed.LAST_CLOSE) -> DataFrame:
    """Cumulative net income per company, division and cost center at every month from the
    key's first to the last close (months without activity carry the balance on)."""
    from .windows import dense_grid, running_balance
    monthly = lines.where(F.col("Period") <= last_close).groupBy(*INCOME_KEY, "Period").agg(money(F.sum("NetIncomeImpact")).alias("Amount"))
    grid = dense_grid(monthly, INCOME_KEY, "Period", "Amount", last_close)
    return running_balance(grid, INCOME_KEY, "Period", "Amount").select(*INCOME_KEY, "Period", F.col("Balance").alias("NetIncome"))


def extend_income(stored: DataFrame, lines: DataFrame, last_close: int, new_close: int) -> DataFrame:
    """The months after ``last_close`` up to ``new_close``, from the stored balances at the last
    close and the P&L lines after it: history is not read again."""
    carried = stored.where(F.col("Period") == last_close).select(*INCOME_KEY, "Period", F.col("NetIncome").alias("Amount"))
    new = lines.where((F.col("Period") > last_close) & (F.col("Period") <= new_close)).groupBy(*INCOME_KEY, "Period").agg(
        money(F.sum("NetIncomeImpact")).alias("Amount"))
    return build_income(carried.unionByName(new).withColumnRenamed("Amount", "NetIncomeImpact"), new_close).where(F.col("Period") > last_close)
