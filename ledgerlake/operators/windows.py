"""Window operators (WIN1-WIN11).

Every window is partitioned by a business key (account, company, table ...), so
no window ever runs in a single partition over fact-size data.  Time offsets use
the month index (``y*12 + m - 1``) with ``rangeBetween``, so missing months never
shift a comparison the way ``lag`` over rows would.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import money, safe_pct
from ..functions.periods import month_index, period_of_index


def running_balance(monthly: DataFrame, keys: Sequence[str], period: str = "period",
                    amount: str = "activity") -> DataFrame:
    """WIN1: balance after each posting month, per key."""
    w = Window.partitionBy(*keys).orderBy(period).rowsBetween(Window.unboundedPreceding, 0)
    return monthly.withColumn("Balance", money(F.sum(amount).over(w)))


def dense_grid(monthly: DataFrame, keys: Sequence[str], period: str, amount: str,
               end_period: int | None = None) -> DataFrame:
    """Fill missing months with 0 from each key's first month to its last (or
    ``end_period``): one window (first/last per key), then a per-row explode of the
    months up to the next posting — no grid join."""
    w = Window.partitionBy(*keys).orderBy("midx")
    m = monthly.withColumn("midx", month_index(F.col(period)))
    last = month_index(F.lit(end_period)) if end_period is not None else None
    if last is not None:  # postings after the end are not part of the grid
        m = m.where(F.col("midx") <= last)
    m = m.withColumn("nxt", F.lead("midx", 1).over(w))
    until = F.coalesce(F.col("nxt") - 1, last if last is not None else F.col("midx"))
    out = m.select(*keys, "midx", F.col(amount), F.explode(F.sequence("midx", until)).alias("gidx"))
    return out.select(
        *keys,
        period_of_index(F.col("gidx")).alias(period),
        F.when(F.col("gidx") == F.col("midx"), F.col(amount)).otherwise(F.lit(0)).cast("decimal(18,2)").alias(amount),
    )


def mom_variance(grid: DataFrame, keys: Sequence[str], period: str = "period", amount: str = "amount") -> DataFrame:
    """WIN2: month-over-month change ($ and %) on a dense grid."""
    w = Window.partitionBy(*keys).orderBy(month_index(F.col(period))).rangeBetween(-1, -1)
    prior = F.max(amount).over(w)
    return grid.withColumn("PriorAmount", prior).withColumn(
        "Change", money(F.col(amount) - F.col("PriorAmount"))).withColumn(
        "ChangePct", safe_pct(F.col("Change"), F.col("PriorAmount")))


def exact_stats(sx, sxx, n):
    """Mean and sample deviation from *exact* decimal sums: one double division and
    one square root, so every engine gets the same bits (floating sums depend on
    the order rows arrive in)."""
    mean = sx.cast("double") / n.cast("double")
    var = (sxx.cast("double") - sx.cast("double") * sx.cast("double") / n.cast("double")) / (n - 1).cast("double")
    sd = F.when(n > 1, F.sqrt(F.greatest(var, F.lit(0.0))))
    return mean, sd


def trailing_anomaly(grid: DataFrame, keys: Sequence[str], n_sd: float = 2.0, period: str = "period",
                     amount: str = "amount", min_months: int = 3) -> DataFrame:
    """WIN3: months whose amount is more than ``n_sd`` sample deviations from the
    mean of the trailing 12 months (window on the month index, -12..-1)."""
    w = Window.partitionBy(*keys).orderBy(month_index(F.col(period))).rangeBetween(-12, -1)
    a = F.col(amount)
    out = grid.select(
        "*",
        F.sum(a).over(w).alias("_sx"),
        F.sum(a * a).over(w).alias("_sxx"),
        F.count(a).over(w).alias("TrailingMonths"),
    )
    mean, sd = exact_stats(F.col("_sx"), F.col("_sxx"), F.col("TrailingMonths"))
    out = out.withColumn("TrailingMean", mean).withColumn("TrailingStdev", sd)
    return out.where(
        (F.col("TrailingMonths") >= min_months) & (F.col("TrailingStdev") > 0)
        & (F.abs(a.cast("double") - F.col("TrailingMean")) > F.lit(n_sd) * F.col("TrailingStdev"))
    ).select(*keys, period, amount, "TrailingMean", "TrailingStdev", "TrailingMonths")


def rolling_12m(monthly: DataFrame, keys: Sequence[str], period: str = "period", amount: str = "amount") -> DataFrame:
    """WIN4: trailing-12-month total per key and month (range -11..0 months)."""
    w = Window.partitionBy(*keys).orderBy(month_index(F.col(period))).rangeBetween(-11, 0)
    return monthly.withColumn("Rolling12", money(F.sum(amount).over(w)))


def ytd(monthly: DataFrame, keys: Sequence[str], period: str = "period", amount: str = "amount") -> DataFrame:
    """WIN5: year-to-date running sum, partitioned by key and year."""
    yr = (F.col(period) / 100).cast("int")
    w = Window.partitionBy(*keys, yr).orderBy(period).rowsBetween(Window.unboundedPreceding, 0)
    return monthly.withColumn("YTD", money(F.sum(amount).over(w)))


def seasonality(monthly: DataFrame, keys: Sequence[str], period: str = "period", amount: str = "amount") -> DataFrame:
    """WIN6: each month's share of its year's total, averaged over years per month.

    Only complete years (12 months present) count; share is NULL for zero years."""
    yr = (F.col(period) / 100).cast("int")
    w = Window.partitionBy(*keys, yr)
    s = monthly.select(
        *keys, yr.alias("year"), (F.col(period) % 100).cast("int").alias("month"), F.col(amount),
        F.sum(amount).over(w).alias("year_total"), F.count(F.lit(1)).over(w).alias("months"),
    ).where((F.col("months") == 12) & (F.col("year_total") != 0))
    # Each share is rounded to a DECIMAL(18,6) first, so the average is an exact
    # decimal sum divided once (engine-independent).
    share = F.round(F.col(amount).cast("double") / F.col("year_total").cast("double"), 6).cast("decimal(18,6)")
    return s.groupBy(*keys, "month").agg(
        (F.sum(share).cast("double") / F.count(F.lit(1)).cast("double")).alias("AvgShare"),
        F.count(F.lit(1)).alias("Years"))


def rank_movers(changes: DataFrame, partition: Sequence[str], change: str = "Change") -> DataFrame:
    """WIN7: rank of the absolute change within each partition (e.g. period)."""
    w = Window.partitionBy(*partition).orderBy(F.abs(F.col(change)).desc())
    return changes.withColumn("MoverRank", F.rank().over(w))


def period_gaps(df: DataFrame, keys: Sequence[str], period: str) -> DataFrame:
    """WIN8: missing months inside each key's sequence: the next present month is
    more than one month later.  Returns one row per gap with its bounds."""
    d = df.select(*keys, period).distinct().withColumn("midx", month_index(F.col(period)))
    w = Window.partitionBy(*keys).orderBy("midx")
    g = d.withColumn("next_idx", F.lead("midx").over(w)).where(F.col("next_idx") - F.col("midx") > 1)
    return g.select(
        *keys,
        period_of_index(F.col("midx") + 1).alias("GapFrom"),
        period_of_index(F.col("next_idx") - 1).alias("GapTo"),
        (F.col("next_idx") - F.col("midx") - 1).cast("int").alias("MissingMonths"),
    )


def zero_activity_run(activity: DataFrame, keys: Sequence[str], period: str, amount: str,
                      as_of: int, months: int) -> DataFrame:
    """WIN9: keys whose last non-zero month is ``months`` or more before ``as_of``."""
    last = activity.where(F.col(amount) != 0).groupBy(*keys).agg(F.max(period).alias("LastActivePeriod"))
    idle = F.lit(month_index(F.lit(as_of))) - month_index(F.col("LastActivePeriod"))
    return last.withColumn("IdleMonths", idle.cast("int")).where(F.col("IdleMonths") >= months)


def snapshot_diff(snap: DataFrame, keys: Sequence[str], value: str, order: str = "SnapshotDate") -> DataFrame:
    """WIN10: old -> new value per key across snapshots (``lag`` per key)."""
    w = Window.partitionBy(*keys).orderBy(order)
    return snap.select(*keys, order, F.lag(value).over(w).alias("OldValue"), F.col(value).alias("NewValue"))


def duration_trend(runs: DataFrame) -> DataFrame:
    """WIN11: load duration per table over time, change from the previous run and a
    3-run moving average."""
    dur = F.timestamp_diff("SECOND", F.col("StartedUtc"), F.col("EndedUtc")).cast("bigint")
    w = Window.partitionBy("TableName").orderBy("StartedUtc", "RunId")
    r = runs.where(F.col("EndedUtc").isNotNull()).withColumn("DurationSec", dur)
    return r.select(
        "TableName", "RunId", "StartedUtc", "DurationSec",
        (F.col("DurationSec") - F.lag("DurationSec").over(w)).alias("ChangeSec"),
        F.round(F.avg("DurationSec").over(w.rowsBetween(-2, 0)), 4).alias("MovingAvgSec"),
    )
