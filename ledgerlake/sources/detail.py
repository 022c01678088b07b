"""Balances in detailed accounts (FIXTURES F8): the GLCAL balances of the few accounts
that the driver's tables post to, dealt to the accounts that a full chart would hold.

Every row becomes one or two rows of the same company, division, cost center and period whose
amounts add up to it, so a sheet that balances still does.  All in cents, in one narrow
pass; no join and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from .adapter import cents_to_amount


def _pick(values: list[str], branch: Column) -> Column:
    return F.array(*[F.lit(v) for v in values])[(branch % len(values)).cast("int")]


def detailed_balances(balances: DataFrame) -> DataFrame:
    """``balances``: GLCAL rows of balance-sheet accounts; the same columns come back."""
    branch = F.coalesce(F.substring("GB_GLC", -2, 2).try_cast("int"), F.lit(0))
    cents = F.round(F.col("GB_AMT") * 100).cast("bigint")
    row = lambda account, amount: F.struct(account.alias("account"), amount.alias("cents"))
    reserve = F.expr(f"abs(cents) div {fixed.RESERVE_SHARE}")
    cost = F.abs(F.col("cents")) * fixed.ASSET_COST_FACTOR
    stock, held = (F.array(*[F.lit(p[i]) for p in fixed.INVENTORY_PAIRS])[(F.col("branch") % len(fixed.INVENTORY_PAIRS)).cast("int")] for i in (0, 1))
    suffix = _pick(fixed.ASSET_SUFFIXES, F.col("branch"))
    parts = (F.when(F.col("GB_GLA") == fixed.INVENTORY_ACCOUNT, F.array(row(stock, F.col("cents") + reserve), row(held, -reserve)))
             .when(F.col("GB_GLA") == fixed.ACCUM_DEPRECIATION_ACCOUNT,
                   F.array(row(F.concat(F.lit("15"), suffix), cost), row(F.concat(F.lit("16"), suffix), F.col("cents") - cost))))
    for account, values in fixed.DETAIL_OF.items():
        parts = parts.when(F.col("GB_GLA") == account, F.array(row(_pick(values, F.col("branch")), F.col("cents"))))
    parts = parts.otherwise(F.array(row(F.col("GB_GLA"), F.col("cents"))))
    keep = [c for c in balances.columns if c not in ("GB_GLA", "GB_AMT")]
    return (balances.withColumn("branch", branch).withColumn("cents", cents).select(*keep, F.explode(parts).alias("p"))
            .select(*keep, F.col("p.account").alias("GB_GLA"), cents_to_amount(F.col("p.cents"), "decimal(18,2)").alias("GB_AMT")))
