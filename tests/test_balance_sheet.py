"""FS20 and its rules on small balances worked out by hand."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerlake import fixed
from ledgerlake.functions.sections import longest_prefix
from ledgerlake.operators.joins import paired_accounts
from ledgerlake.plans import statements as st
from ledgerlake.sources.detail import detailed_balances

BAL = [("10151", 100), ("10180", 7), ("10200", 50), ("10224", 3), ("12000", 40), ("12100", -5), ("13010", -1), ("15100", 90), ("16100", -30),
       ("16110", -2), ("17800", 4), ("18888", 1), ("20350", -60), ("24100", -20), ("24900", -9), ("27400", -8), ("30000", 0), ("99999", -10)]


@pytest.fixture(scope="module")
def sheet(spark):
    bal = spark.createDataFrame([("01", "01", "001", a, 200102, D(v)) for a, v in BAL],
                                "GB_CO string, GB_DIV string, GB_GLC string, GB_GLA string, GB_DATE int, GB_AMT decimal(18,2)")
    income = spark.createDataFrame([("01", "01", "001", 200101, D(1)), ("01", "01", "001", 200102, D(150))],
                                   "Company string, Division string, CostCenter string, Period int, NetIncome decimal(18,2)")
    return st.structured_balance_sheet(bal, income, 200102, fixed.BS_PREFIX_RULES, fixed.DETAIL_ACCOUNTS).collect()


def _amount(sheet, label):
    (row,) = [r for r in sheet if r.Label == label]
    return row.Amount


def test_sections_and_totals(sheet):
    assert _amount(sheet, "Total cash and equivalents") == 100      # 10180 is not cash
    assert _amount(sheet, "Total accounts receivable") == 50        # 10224 is not a receivable
    assert _amount(sheet, "Total other current assets") == 3
    assert _amount(sheet, "Total intercompany") == 7
    assert _amount(sheet, "Total reserves") == -6                   # of both inventories
    assert _amount(sheet, "Total current assets") == 100 + 50 + 3 + 40
    assert _amount(sheet, "Total related party loans") == 20
    assert _amount(sheet, "Total intercompany liabilities") == 17   # 24900 and 27400
    assert _amount(sheet, "Total intangibles and other") == 5
    assert _amount(sheet, "Total assets") == 257
    assert _amount(sheet, "Total liabilities and equity") == 60 + 20 + 17 + 10 + 150
    assert _amount(sheet, "Difference") == 0


def test_assets_with_their_depreciation(sheet):
    ppe = [(r.LineGroup, r.LineOrder, r.Account, r.Amount) for r in sheet if r.Section == fixed.PPE_SECTION]
    assert ppe == [("100", 1, "15100", 90), ("100", 2, "16100", -30), ("100", 3, "", 60),
                   ("110", 2, "16110", -2), ("110", 3, "", -2), ("~", 9, "", 58)]  # depreciation without its asset is shown


def test_accounts_without_a_rule_are_shown(sheet):
    other = {(r.Account, r.Side) for r in sheet if r.Section == "Unclassified" and r.Account}
    assert other == {("30000", "Liabilities and equity"), ("99999", "Liabilities and equity")}


def test_longest_prefix(spark):
    rules = spark.createDataFrame([("1", "a"), ("12", "b"), ("1210", "c")], "prefix string, name string")
    df = spark.createDataFrame([("12100",), ("12000",), ("13000",), ("20000",), ("",), (None,), ("12100",)], "acc string")
    got = sorted(((r.acc, r.name) for r in longest_prefix(df, "acc", rules).collect()), key=str)
    assert got == sorted([("12100", "c"), ("12100", "c"), ("12000", "b"), ("13000", "a"), ("20000", None), ("", None), (None, None)], key=str)


def test_pairs_by_prefix(spark):
    df = spark.createDataFrame([("15100", D(5)), ("16100", D(-2)), ("16950", D(-1)), ("31001", D(9))], "acc string, v decimal(18,2)")
    got = {r.suffix: (r.LeftAccount, r.RightAccount) for r in paired_accounts(df.withColumn("c", F.lit("x")), "acc", "v", ["c"], "15", "16").collect()}
    assert got == {"100": ("15100", "16100"), "950": (None, "16950")}


def test_detail_keeps_every_balance(spark, led):
    bal = led.glcal.where("GB_DATE = 200102").join(led.accmast.where("ACTYP = '1'").select(
        F.col("ACCO").alias("GB_CO"), F.col("ACACC").alias("GB_GLA")), ["GB_CO", "GB_GLA"]).select(*led.glcal.columns)
    by = ["GB_CO", "GB_DIV", "GB_GLC", "GB_DATE"]
    a = bal.groupBy(*by).agg(F.sum("GB_AMT").alias("v"))
    b = detailed_balances(bal).groupBy(*by).agg(F.sum("GB_AMT").alias("v"))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
