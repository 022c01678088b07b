"""Extensions the reference names for tables it has not replicated (EXT*), as
generic operators a caller points at their own tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def audit_log_search(log: DataFrame, date: dt.date, user: str | None = None, table: str | None = None,
                     time_col: str = "StartedUtc") -> DataFrame:
    """EXT7: log rows of one day, optionally one user and one table."""
    out = log.where(F.to_date(F.col(time_col)) == F.lit(date))
    if user is not None:
        out = out.where(F.col("UserName") == user)
    if table is not None:
        out = out.where(F.col("TableName") == table)
    return out


def _cents(c):
    return F.round(c * 100).cast("bigint")


def _money(cents):
    return (cents.cast("decimal(18,0)") * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(18,2)")


AGING_BUCKETS = [("Current", 0, 30), ("D31_60", 31, 60), ("D61_90", 61, 90), ("D91_120", 91, 120)]


def aging(items: DataFrame, as_of: dt.date, party: str, date_col: str, amount_col: str) -> DataFrame:
    """EXT1: open items by party in age buckets (days since ``date_col`` at
    ``as_of``), items dated later as not due, plus the total; amounts in exact cents."""
    days = F.datediff(F.lit(as_of), F.to_date(F.col(date_col)))
    cents = _cents(F.col(amount_col))
    it = items.select(F.col(party), days.alias("age"), cents.alias("c"))
    aggs = [_money(F.coalesce(F.sum(F.when(F.col("age").between(lo, hi), F.col("c"))), F.lit(0))).alias(name)
            for name, lo, hi in AGING_BUCKETS]
    aggs.append(_money(F.coalesce(F.sum(F.when(F.col("age") < 0, F.col("c"))), F.lit(0))).alias("NotDue"))
    aggs.append(_money(F.coalesce(F.sum(F.when(F.col("age") > 120, F.col("c"))), F.lit(0))).alias("Over120"))
    aggs.append(_money(F.sum("c")).alias("Total"))
    return it.groupBy(party).agg(*aggs)


def days_sales_outstanding(items: DataFrame, as_of: dt.date, party: str, date_col: str, amount_col: str, is_open, days: int = 365) -> DataFrame:
    """EXT1: per party what is open at ``as_of``, the sales of the ``days`` up to it, and how
    many days of those sales are open (null without sales)."""
    age = F.datediff(F.lit(as_of), F.to_date(F.col(date_col)))
    it = items.select(F.col(party), age.alias("age"), _cents(F.col(amount_col)).alias("c"), is_open.alias("open"))
    g = it.groupBy(party).agg(F.sum(F.when(F.col("open") & (F.col("age") >= 0), F.col("c")).otherwise(0)).alias("r"),
                              F.sum(F.when(F.col("age").between(0, days - 1), F.col("c")).otherwise(0)).alias("s"))
    dso = F.when(F.col("s") != 0, F.col("r").cast("double") * float(days) / F.col("s").cast("double"))
    return g.select(party, _money(F.col("r")).alias("Receivable"), _money(F.col("s")).alias("Sales"), dso.alias("DaysOutstanding"))


def apply_payments(items: DataFrame, payments: DataFrame, party: str, item: str, date_col: str, amount_col: str, paid_col: str) -> DataFrame:
    """EXT1: a party's payments on its oldest items first: what of each is paid and still
    open.  One window per party over its open items."""
    w = Window.partitionBy(party).orderBy(date_col, item).rowsBetween(Window.unboundedPreceding, -1)
    paid = payments.groupBy(party).agg(F.sum(_cents(F.col(paid_col))).alias("paid"))
    it = items.select(party, item, date_col, _cents(F.col(amount_col)).alias("c")).withColumn("before", F.coalesce(F.sum("c").over(w), F.lit(0)))
    j = it.join(paid, party)
    applied = F.least(F.col("c"), F.greatest(F.lit(0), F.col("paid") - F.col("before")))
    return j.select(item, party, _money(F.col("c")).alias("Amount"), _money(applied).alias("Applied"), _money(F.col("c") - applied).alias("StillOpen"))


def customer_balance(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """EXT2: per customer, orders, total and open total, with name and segment."""
    c = _cents(F.col("o_totalprice"))
    b = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("Orders"), _money(F.sum(c)).alias("Total"),
                                        _money(F.coalesce(F.sum(F.when(F.col("o_orderstatus") == "O", c)), F.lit(0))).alias("OpenTotal"))
    cu = customers.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return b.join(cu, "o_custkey", "left")


def search(df: DataFrame, text_col: str, key_col: str, query: str, limit: int = 25) -> DataFrame:
    """EXT2/EXT3 lookups: case-insensitive literal contains, ordered by key, capped."""
    from ..operators.topk import clamp
    return df.where(F.lower(F.col(text_col)).contains(query.lower())).orderBy(key_col).limit(clamp(limit, 1, 100, 25))


def line_economics(lineitem: DataFrame) -> DataFrame:
    """Per line item: revenue (price less discount), cost (70 %), discount, in cents."""
    from .. import fixed
    base = lineitem.select("*", _cents(F.col("l_extendedprice")).alias("c"), _cents(F.col("l_discount")).alias("dp"))
    return base.select("*", F.expr("c * dp div 100").alias("di"),
                       F.expr(f"c * {fixed.COST_NUMERATOR} div {fixed.COST_DENOMINATOR}").alias("cost"))


def parts_margin(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """EXT3: per part, revenue, cost and margin."""
    e = line_economics(lineitem).groupBy("l_partkey").agg(
        _money(F.sum(F.col("c") - F.col("di"))).alias("Revenue"), _money(F.sum("cost")).alias("Cost"))
    e = e.withColumn("Margin", (F.col("Revenue") - F.col("Cost")).cast("decimal(18,2)"))
    p = part.select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_type")
    return e.join(p, "l_partkey", "left")


def slow_moving_parts(lineitem: DataFrame, part: DataFrame, as_of: dt.date, days: int) -> DataFrame:
    """EXT3: parts with no shipment in the last ``days`` days (or never shipped)."""
    last = lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.max(F.to_date("l_shipdate")).alias("LastShipped"))
    j = part.select("p_partkey", "p_name").join(last, "p_partkey", "left")
    idle = F.datediff(F.lit(as_of), F.col("LastShipped"))
    return j.withColumn("IdleDays", idle).where(F.col("LastShipped").isNull() | (idle > days))


def service_labor(lineitem: DataFrame, part: DataFrame, service_type: str = "MEDIUM",
                  hours_per_month: int = 160) -> DataFrame:
    """EXT4: per technician (supplier), hours (quantity), billing, rate per hour
    and utilisation against ``hours_per_month`` for each active month."""
    li = lineitem.join(part.select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey").where(
        F.col("p_type") == service_type)
    e = line_economics(li)
    m = F.year("l_shipdate") * 100 + F.month("l_shipdate")
    g = e.groupBy(F.col("l_suppkey").alias("Technician")).agg(
        F.sum("l_quantity").alias("Hours"), _money(F.sum(F.col("c") - F.col("di"))).alias("Billing"),
        F.countDistinct(m).alias("ActiveMonths"))
    return g.select("Technician", "Hours", "Billing",
                    (F.col("Billing").cast("double") / F.col("Hours")).alias("RatePerHour"),
                    (F.col("Hours") / (F.col("ActiveMonths").cast("double") * float(hours_per_month))).alias("Utilization"))


def sales_detail(lineitem: DataFrame) -> DataFrame:
    """EXT5: per order (transaction): gross, discount impact, net revenue and margin."""
    e = line_economics(lineitem)
    g = e.groupBy("l_orderkey").agg(_money(F.sum("c")).alias("Gross"), _money(F.sum("di")).alias("Discount"),
                                    _money(F.sum(F.col("c") - F.col("di"))).alias("Net"),
                                    _money(F.sum(F.col("c") - F.col("di") - F.col("cost"))).alias("Margin"))
    return g


def salesperson_performance(lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    """EXT5: per salesperson (supplier stands in): lines, revenue, margin, discount."""
    e = line_economics(lineitem)
    g = e.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(
        F.count(F.lit(1)).alias("Lines"), _money(F.sum(F.col("c") - F.col("di"))).alias("Revenue"),
        _money(F.sum(F.col("c") - F.col("di") - F.col("cost"))).alias("Margin"), _money(F.sum("di")).alias("DiscountGiven"))
    return g.join(supplier.select("s_suppkey", "s_name"), "s_suppkey", "left")


def bank_rec_summary(book: DataFrame, bank: DataFrame, keys, as_of: dt.date, date_col: str) -> DataFrame:
    """EXT6: match book and bank amounts on ``keys`` (full outer); unmatched or
    differing items only, with their age in days at ``as_of``."""
    b = book.groupBy(*keys).agg(F.sum("Amount").cast("decimal(18,2)").alias("Book"))
    k = bank.groupBy(*keys).agg(F.sum("Amount").cast("decimal(18,2)").alias("Bank"))
    j = b.join(k, list(keys), "full_outer")
    diff = (F.coalesce("Book", F.lit(0)) - F.coalesce("Bank", F.lit(0))).cast("decimal(18,2)")
    d = F.to_date(F.col(date_col).cast("string"), "yyyyMMdd")
    return j.withColumn("Difference", diff).where(F.col("Difference") != 0).withColumn(
        "AgeDays", F.datediff(F.lit(as_of), d))


def vendor_patterns(lineitem: DataFrame, supplier: DataFrame, top: int = 3) -> DataFrame:
    """EXT8: purchases (cost) per vendor, and the top vendors per nation."""
    e = line_economics(lineitem).groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(
        F.count(F.lit(1)).alias("Lines"), _money(F.sum("cost")).alias("Purchases"))
    j = e.join(supplier.select("s_suppkey", "s_nationkey"), "s_suppkey")
    w = Window.partitionBy("s_nationkey").orderBy(F.col("Purchases").desc(), "s_suppkey")
    return j.withColumn("RankInNation", F.row_number().over(w)).where(F.col("RankInNation") <= top)
