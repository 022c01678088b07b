"""Sort, limit and top-k (TOP1-TOP5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def clamp(n, low: int, high: int, default: int) -> int:
    try:
        n = int(n)
    except (TypeError, ValueError):
        n = default
    return max(low, min(n, high))


def order_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """TOP1: order a (small, aggregated) report by its keys."""
    return df.orderBy(*keys)


def top_abs(df: DataFrame, amount: str, tie: Sequence[str], n: int | None = None) -> DataFrame:
    """TOP2/TOP3: order by ABS(amount) desc, key as tie-break; with ``n`` this is a
    TakeOrderedAndProject (a per-partition heap, never a full sort)."""
    out = df.orderBy(F.abs(F.col(amount)).desc(), *tie)
    return out.limit(n) if n is not None else out


def top_n_per_group(df: DataFrame, group: Sequence[str], order, n: int) -> DataFrame:
    """Top ``n`` rows per group (``row_number`` in a group-partitioned window)."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("Rank", F.row_number().over(w)).where(F.col("Rank") <= n)


def capped_result(df: DataFrame, order: Sequence, cap: int) -> DataFrame:
    """TOP4: the first ``cap`` rows in ``order`` (a top-k: per-partition heaps,
    never a full sort) plus a ``Truncated`` flag: whether the top-k of ``cap + 1`` is
    full.  One pass, nothing is counted beforehand; the flag's window holds those rows
    only.  Totals belong in a separate aggregate, never in the capped rows."""
    top = df.orderBy(*order).limit(cap + 1)
    return top.withColumn("Truncated", F.count(F.lit(1)).over(Window.partitionBy()) > cap).orderBy(*order).limit(cap)
