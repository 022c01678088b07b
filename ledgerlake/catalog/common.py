"""Shared inputs of the registered queries, on both sides of the check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.columns import money
from ..plans import statements as st
from ..sources.store import Ledger, ledger

P = fixed.LAST_CLOSE          # the report period: last closed month
CY = fixed.CURRENT_YEAR
PY = fixed.PRIOR_YEAR
SERIES_ACCOUNT = "31001"      # account used by the single-account tools


def L(spark, sf_dir) -> Ledger:
    return ledger(spark, sf_dir)


def lines(spark, sf_dir) -> DataFrame:
    led = ledger(spark, sf_dir)
    return st.income_statement_lines(led.glcal, led.accmast)


def pl_monthly(spark, sf_dir) -> DataFrame:
    """Closed P&L activity per company, account and period (from the P&L view)."""
    return lines(spark, sf_dir).groupBy(
        F.col("Company"), F.col("AccountNumber"), F.col("Period")
    ).agg(money(F.sum("Amount")).alias("Amount"))


# Oracle counterparts (DuckDB CTEs) of the helpers above.
PL_MONTHLY_SQL = ("pl_monthly", "SELECT Company, AccountNumber, Period, "
                  "CAST(SUM(Amount) AS DECIMAL(18, 2)) AS Amount FROM is_lines "
                  "GROUP BY Company, AccountNumber, Period")
