"""Aggregations (AGG1-AGG9, AGG15-AGG21).

All are ``groupBy``/``groupingSets``/``cube`` plans: Spark does a partial
aggregation in each map task before the shuffle, so a key holding a third of the
rows still sends one partial row per task.  No aggregate collects a group's rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.columns import branch_of, department_of, money


def sum_by(df: DataFrame, keys: Sequence[str], amount: str = "NetIncomeImpact", count_name: str | None = "Lines",
           sum_name: str | None = None) -> DataFrame:
    """AGG1/AGG2/AGG4: COUNT and SUM by keys."""
    aggs = []
    if count_name:
        aggs.append(F.count(F.lit(1)).alias(count_name))
    aggs.append(money(F.sum(amount)).alias(sum_name or amount))
    return df.groupBy(*keys).agg(*aggs)


def coverage_stats(df: DataFrame, period: str = "GB_DATE", by: Sequence[str] = (),
                   approximate: bool = False) -> DataFrame:
    """AGG5: MIN, MAX, COUNT DISTINCT and COUNT of the period column.

    The distinct count is exact by default (periods are bounded by the calendar);
    ``approximate=True`` uses a HyperLogLog sketch (``approx_count_distinct``,
    fixed-size state per group) for unbounded columns."""
    distinct = F.approx_count_distinct(period) if approximate else F.countDistinct(period)
    return df.groupBy(*by).agg(
        F.min(period).alias("MinPeriod"), F.max(period).alias("MaxPeriod"),
        distinct.alias("DistinctPeriods"), F.count(F.lit(1)).alias("TotalRows"),
    )


def series_stats(df: DataFrame, order: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """AGG6: count, total, mean, min, max, first, last (by ``order``) and sample stdev.

    ``min_by``/``max_by`` give first/last in one pass, with no sort of the group."""
    v = F.col(value)
    return df.groupBy(*by).agg(
        F.count(v).alias("count"),
        money(F.sum(v)).alias("total"),
        (F.sum(v).cast("double") / F.count(v).cast("double")).alias("mean"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        F.min(order).alias("first_period"),
        F.max(order).alias("latest_period"),
        F.min_by(v, F.col(order)).alias("first_amount"),
        F.max_by(v, F.col(order)).alias("latest_amount"),
        F.sum(v * v).alias("_sxx"),
    ).transform(lambda d: d.withColumn("stdev", _sd(F.col("total"), F.col("_sxx"), F.col("count"))).drop("_sxx"))


def _sd(sx, sxx, n):
    from .windows import exact_stats
    return exact_stats(sx, sxx, n)[1]


def conditional_pivot(df: DataFrame, keys: Sequence[str], pivot_col: str, values: Sequence, amount: str,
                      prefix: str = "P") -> DataFrame:
    """AGG7: one column per pivot value, absent value -> NULL.

    ``pivot`` with an explicit value list: no extra job to discover the values and
    one aggregation pass of conditional sums."""
    out = df.groupBy(*keys).pivot(pivot_col, list(values)).agg(money(F.sum(amount)))
    return out.select(*keys, *[F.col(str(v)).alias(f"{prefix}{v}") for v in values])


def conditional_count(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """AGG8: SUM(CASE WHEN c <> 0 THEN 1 ELSE 0 END) per column, as ``count_if``."""
    return df.groupBy(*by).agg(*[F.count_if(F.col(c) != 0).alias(f"nonzero_{c}") for c in cols])


def bucket_scan(df: DataFrame, keys: Sequence[str], bucket_cols: Sequence[str]) -> DataFrame:
    """AGG9 / SET2: unpivot the bucket columns, then one groupBy — one scan, not 12."""
    long = df.unpivot(list(keys), list(bucket_cols), "bucket", "amount")
    return long.groupBy("bucket").agg(
        money(F.sum("amount")).alias("total"), F.count_if(F.col("amount") != 0).alias("nonzero_rows"),
        F.count(F.lit(1)).alias("rows"),
    )


def by_department(lines: DataFrame, cc: str = "CostCenter", amount: str = "NetIncomeImpact") -> DataFrame:
    """AGG15: GROUP BY LEFT(cc, 1)."""
    return lines.groupBy(department_of(F.col(cc)).alias("Department")).agg(
        F.count(F.lit(1)).alias("Lines"), money(F.sum(amount)).alias(amount))


def by_branch(lines: DataFrame, cc: str = "CostCenter", amount: str = "NetIncomeImpact") -> DataFrame:
    """AGG16: GROUP BY RIGHT(cc, 2)."""
    return lines.groupBy(branch_of(F.col(cc)).alias("Branch")).agg(
        F.count(F.lit(1)).alias("Lines"), money(F.sum(amount)).alias(amount))


def subtotal_groups(dept: Column, branch: Column) -> Column:
    """Membership of a row in the report's overlapping subtotal groups (AGG17):
    its department, Total Fixed (departments 3+4+5), its branch decade and the
    chain.  Returned as an array to ``explode``: each row feeds at most four groups."""
    fixed_member = dept.isin(*fixed.FIXED_DEPARTMENTS)
    decade = F.concat(F.lit("Total branches "), F.substring(branch, 1, 1), F.lit("0-"),
                      F.substring(branch, 1, 1), F.lit("9"))
    return F.filter(
        F.array(
            F.concat(F.lit("Department "), dept),
            F.when(fixed_member, F.lit("Total Fixed")),
            decade,
            F.lit("Chain total"),
        ),
        lambda x: x.isNotNull(),
    )


def subtotals(lines: DataFrame, amount: str = "NetIncomeImpact") -> DataFrame:
    """AGG17: department totals, Total Fixed, branch-decade totals and chain total.

    Overlapping groups (a Parts row is in its department *and* Total Fixed) are
    expressed by exploding a bounded membership array: of one row per department and
    branch, not of the lines."""
    per = lines.groupBy("Department", "Branch").agg(F.count(F.lit(1)).alias("n"), F.sum(amount).alias("v"))
    g = per.select(F.explode(subtotal_groups(F.col("Department"), F.col("Branch"))).alias("SubtotalGroup"), "n", "v")
    return g.groupBy("SubtotalGroup").agg(F.sum("n").alias("Lines"), money(F.sum("v")).alias(amount))


def dept_branch_matrix(lines: DataFrame, amount: str = "NetIncomeImpact") -> DataFrame:
    """AGG18: every department x branch with all margins, via ``cube``."""
    return lines.cube("Department", "Branch").agg(
        money(F.sum(amount)).alias(amount), F.grouping_id().alias("GroupingLevel"))


def max_watermark(runs: DataFrame, table: str) -> DataFrame:
    """AGG19: MAX(WatermarkTo) over COMPLETE runs of ``table``, 0 when none."""
    return runs.where((F.col("TableName") == table) & (F.col("Status") == "COMPLETE")).agg(
        F.coalesce(F.max("WatermarkTo"), F.lit(0).cast("bigint")).alias("Watermark"))


def last_success(runs: DataFrame) -> DataFrame:
    """AGG20: MAX(EndedUtc) and MAX(RowsCopied) per table over COMPLETE runs."""
    return runs.where(F.col("Status") == "COMPLETE").groupBy("TableName").agg(
        F.max("EndedUtc").alias("LastSuccessUtc"), F.max("RowsCopied").alias("MaxRowsCopied"))


def recent_periods(df: DataFrame, period: str = "GB_DATE", n: int = 12) -> DataFrame:
    """AGG21: rows per period, newest ``n`` (a top-k; TakeOrderedAndProject)."""
    return df.groupBy(F.col(period).alias("Period")).agg(F.count(F.lit(1)).alias("Rows")) \
        .orderBy(F.col("Period").desc()).limit(n)
