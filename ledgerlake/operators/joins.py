"""Joins (JN1-JN15).  All equi-joins.

Dimension joins broadcast only tables whose size is bounded by construction
(ACCMAST: companies x chart; literal rule tables).  Joins of two data-sized sides
(journal vs GLCAL, staged vs target, fact vs itself) are left to the planner:
sort-merge on the keys, or a broadcast that AQE chooses at runtime from the
measured size of a shuffle stage — a size-checked broadcast with sort-merge as the
fallback.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import money
from ..functions.periods import month_index


def left_dim(fact: DataFrame, accmast: DataFrame, co: str = "GB_CO", acc: str = "GB_GLA",
             cols: Sequence[str] = ("ACNME", "ACTYP", "ACSTA")) -> DataFrame:
    """JN1: fact LEFT JOIN ACCMAST on company + account (broadcast, bounded)."""
    a = accmast.select(F.col("ACCO").alias(co), F.col("ACACC").alias(acc), *cols)
    return fact.join(a, [co, acc], "left")


def chart_join(fact: DataFrame, coacmast: DataFrame, how: str = "left",
               keys: Sequence[str] = ("GB_CO", "GB_DIV", "GB_GLC", "GB_GLA"),
               cols: Sequence[str] = ("CA_GLFA",)) -> DataFrame:
    """JN2 (``how='left'``) / JN3 (``how='inner'``): fact ⋈ COACMAST on the four
    spine keys.  COACMAST grows with the posted keys, so no broadcast hint: AQE
    broadcasts it when the measured side is small, else sort-merge."""
    c = coacmast.select(*[F.col(s).alias(d) for s, d in zip(("CA_CO", "CA_DIV", "CA_CC", "CA_ACC"), keys)], *cols)
    return fact.join(c, list(keys), how)


def full_outer_reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], left_amt: str, right_amt: str,
                         tol: str | None = None) -> DataFrame:
    """JN4: aggregate both sides, FULL JOIN, coalesce the key, compare.

    Missing sides count as 0; ``tol`` keeps only rows whose |difference| > tol."""
    l = left.groupBy(*keys).agg(money(F.sum(left_amt)).alias("LeftAmount"))
    r = right.groupBy(*keys).agg(money(F.sum(right_amt)).alias("RightAmount"))
    j = l.join(r, list(keys), "full_outer")  # USING-style join coalesces the keys
    j = j.withColumn("Difference", money(F.coalesce("LeftAmount", F.lit(0)) - F.coalesce("RightAmount", F.lit(0))))
    if tol is not None:
        j = j.where(F.abs(F.col("Difference")) > F.lit(tol).cast("decimal(10,3)"))
    return j


def agg_then_dim(journal: DataFrame, accmast: DataFrame, keys: Sequence[str] = ("YJ_CO", "YJ_ACC")) -> DataFrame:
    """JN5: pre-aggregate the journal, then join ACCMAST on company *and* account
    (the reference's account-only join fans out when companies share an account)."""
    agg = journal.groupBy(*keys).agg(money(F.sum("YJ_AMT")).alias("Amount"))
    a = accmast.select(F.col("ACCO").alias(keys[0]), F.col("ACACC").alias(keys[1]), "ACNME", "ACTYP")
    return agg.join(a, list(keys), "inner")


def anti_orphans(fact: DataFrame, dim: DataFrame, fact_keys: Sequence[str], dim_keys: Sequence[str]) -> DataFrame:
    """JN7: distinct fact keys with no dimension row (``left_anti``)."""
    d = dim.select(*[F.col(s).alias(t) for s, t in zip(dim_keys, fact_keys)])
    return fact.select(*fact_keys).distinct().join(d, list(fact_keys), "left_anti")


def semi_used(dim: DataFrame, fact: DataFrame, dim_keys: Sequence[str], fact_keys: Sequence[str]) -> DataFrame:
    """JN8: dimension rows having at least one fact row (``left_semi``)."""
    # distinct first: its map-side combine keeps hot keys out of the exchange
    f = fact.select(*[F.col(s).alias(t) for s, t in zip(fact_keys, dim_keys)]).distinct()
    return dim.join(f, list(dim_keys), "left_semi")


def self_join_latest(df: DataFrame, key: str, order: str) -> DataFrame:
    """JN10: per key, the row with the greatest ``order`` value (``row_number`` in a
    key-partitioned window; ties broken by all columns for determinism)."""
    w = Window.partitionBy(key).orderBy(F.col(order).desc_nulls_last(), *[F.col(c) for c in df.columns])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def period_shift(monthly: DataFrame, keys: Sequence[str], months: int, period: str = "period",
                 amount: str = "amount", name: str = "PriorAmount") -> DataFrame:
    """JN13: the fact joined to itself ``months`` earlier, as an equi-join on the
    shifted month index (full outer: a month with no prior or no current row
    still appears)."""
    cur = monthly.select(*keys, month_index(F.col(period)).alias("midx"), F.col(amount).alias("CurrentAmount"))
    pri = monthly.select(*keys, (month_index(F.col(period)) + months).alias("midx"), F.col(amount).alias(name))
    return cur.join(pri, [*keys, "midx"], "full_outer")


def snapshot_as_of(snap: DataFrame, keys: Sequence[str], as_of, date_col: str = "SnapshotDate") -> DataFrame:
    """JN14: state of each key as of a date — latest snapshot on or before it.
    A key first captured after ``as_of`` has no row (never invented)."""
    s = snap.where(F.col(date_col) <= F.lit(as_of).cast("date"))
    w = Window.partitionBy(*keys).orderBy(F.col(date_col).desc())
    return s.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def paired_accounts(monthly: DataFrame, acc: str, amount: str, by: Sequence[str],
                    left: str = "3", right: str = "4") -> DataFrame:
    """JN15: pair accounts that agree in what follows their prefix (revenue 3xxxx with cost
    4xxxx; fixed asset 15xxx with its accumulated depreciation 16xxx), as an equi-join on
    the derived suffix."""
    def half(prefix: str, name: str) -> DataFrame:
        suffix = F.substring(F.col(acc), len(prefix) + 1, 5 - len(prefix))
        return monthly.where(F.col(acc).startswith(prefix)).groupBy(*by, suffix.alias("suffix"), F.col(acc).alias(f"{name}Account")) \
            .agg(money(F.sum(amount)).alias(f"{name}Amount"))
    return half(left, "Left").join(half(right, "Right"), [*by, "suffix"], "full_outer")
