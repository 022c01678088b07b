"""PRD15 ``classify_section``: account -> statement section.

Exact-account rules come from a fixed literal table, joined with ``broadcast``
(its size is the rule count, not the data).  Prefix rules, when given, are applied
to the accounts no exact rule matched, longest prefix first, as one CASE
expression, so classification never needs a second join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed

SECTION_SCHEMA = T.StructType([
    T.StructField("rule_account", T.StringType()),
    T.StructField("Statement", T.StringType()),
    T.StructField("Section", T.StringType()),
    T.StructField("SectionOrder", T.IntegerType()),
])


def section_table(spark: SparkSession, rules=None) -> DataFrame:
    return spark.createDataFrame(list(rules or fixed.SECTIONS), SECTION_SCHEMA)


def _prefix_case(acc: Column, prefix_rules, field: int) -> Column | None:
    if not prefix_rules:
        return None
    ordered = sorted(prefix_rules, key=lambda r: -len(r[0]))
    expr = None
    for rule in ordered:
        cond = acc.startswith(rule[0])
        expr = F.when(cond, F.lit(rule[field])) if expr is None else expr.when(cond, F.lit(rule[field]))
    return expr


def classify_section(df: DataFrame, account_col: str, rules=None, prefix_rules=None) -> DataFrame:
    """Add Statement, Section and SectionOrder for ``account_col``.

    ``prefix_rules`` is a list of (prefix, statement, section, order); exact rules win.
    """
    table = section_table(df.sparkSession, rules)
    out = df.join(F.broadcast(table), F.col(account_col) == F.col("rule_account"), "left").drop("rule_account")
    if prefix_rules:
        acc = F.col(account_col)
        for name, i in (("Statement", 1), ("Section", 2), ("SectionOrder", 3)):
            out = out.withColumn(name, F.coalesce(F.col(name), _prefix_case(acc, prefix_rules, i)))
    return out


def longest_prefix(df: DataFrame, account_col: str, rules: DataFrame, prefix_col: str = "prefix") -> DataFrame:
    """``df`` (one row per account) with the columns of the rule whose prefix of
    ``account_col`` is the longest, null where no prefix fits.

    An account's prefixes are exploded and meet the rules in an equi-join, so any number
    of rules costs one join; nothing is compared rule by rule."""
    values = [c for c in rules.columns if c != prefix_col]
    prefixes = F.transform(F.sequence(F.lit(1), F.length(account_col)), lambda n: F.substring(F.col(account_col), F.lit(1), n))
    met = (df.where(F.length(account_col) > 0).select(account_col, F.explode(prefixes).alias(prefix_col)).distinct()
           .join(rules, prefix_col))
    best = met.groupBy(account_col).agg(F.max_by(F.struct(*values), F.length(prefix_col)).alias("_rule"))
    return df.join(best, account_col, "left").select(*df.columns, *[F.col(f"_rule.{c}").alias(c) for c in values])
