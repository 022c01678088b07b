"""Reconciliation, audit and data-quality checks (DQ*).

Every check is a plan over the ledger tables; the "expect no rows" checks are
also run against a ledger with seeded faults (FIXTURES F5) so they are seen to
fire.  Faults are chosen by fixed predicates, never by sampling.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.columns import is_profit_and_loss, money, tolerance_exceeded
from ..functions.periods import month_index, period_of_index
from ..operators.joins import full_outer_reconcile, left_dim
from ..sources.schemas import GLCAL_KEY, JOURNAL_KEY

# --- Fixed values: seeded faults (FIXTURES F5) -------------------------------------
FAULT_DROP = ("0001", 1)            # (journal number, leg) of the legs dropped
FAULT_DUPLICATE = ("0002", 2)       # legs posted twice
FAULT_UNKNOWN = ("0003", 5, "59999")  # legs re-posted to an account absent from ACCMAST
FAULT_GAP = ("03", 200006)          # company and period removed
FAULT_DRIFT = ("01", "205", "31001", fixed.LAST_CLOSE, "0.01")  # GLCAL row nudged (present at every scale)


def faulted_journal(journal: DataFrame) -> DataFrame:
    """The journal with dropped, duplicated, mis-posted and missing-period legs."""
    jrl, leg = F.col("YJ_JRL"), F.col("leg")
    j = journal.where(~((jrl == FAULT_DROP[0]) & (leg == FAULT_DROP[1])))
    j = j.where(~((F.col("YJ_CO") == FAULT_GAP[0]) & (F.col("period") == FAULT_GAP[1])))
    j = j.withColumn("YJ_ACC", F.when((jrl == FAULT_UNKNOWN[0]) & (leg == FAULT_UNKNOWN[1]),
                                      F.lit(FAULT_UNKNOWN[2])).otherwise(F.col("YJ_ACC")))
    dup = j.where((jrl == FAULT_DUPLICATE[0]) & (leg == FAULT_DUPLICATE[1]))
    return j.unionByName(dup)


def faulted_glcal(glcal: DataFrame) -> DataFrame:
    """GLCAL with one row nudged by a cent: just above the 0.005 drift tolerance."""
    co, cc, acc, per, delta = FAULT_DRIFT
    hit = (F.col("GB_CO") == co) & (F.col("GB_GLC") == cc) & (F.col("GB_GLA") == acc) & (F.col("GB_DATE") == per)
    return glcal.withColumn("GB_AMT", F.when(hit, money(F.col("GB_AMT") + F.lit(delta).cast("decimal(3,2)")))
                            .otherwise(F.col("GB_AMT")))


# --- DQ1 / DQ2 ------------------------------------------------------------------------

def _journal_pl(journal: DataFrame, accmast: DataFrame, keys: Sequence[str]) -> DataFrame:
    """P&L activity of the journal per ``keys``: summed before the master is joined."""
    keys = list(dict.fromkeys([*keys, "YJ_CO", "YJ_ACC"]))
    journal = journal.groupBy(*keys).agg(F.sum("YJ_AMT").alias("YJ_AMT"))
    j = left_dim(journal, accmast, co="YJ_CO", acc="YJ_ACC", cols=("ACTYP",))
    return j.where(is_profit_and_loss(F.col("ACTYP")))


def recon_total(led, lines: DataFrame, periods: Sequence[int]) -> DataFrame:
    """DQ1: net income per closed period from the journal and from the monthly
    table, side by side with the difference."""
    j = _journal_pl(led.journal.where(F.col("period").isin(*periods)), led.accmast, ["period"]).select(
        F.col("period").alias("Period"), (-F.col("YJ_AMT")).alias("v"))
    m = lines.where(F.col("Period").isin(*periods)).select("Period", F.col("NetIncomeImpact").alias("v"))
    r = full_outer_reconcile(j, m, ["Period"], "v", "v")
    return r.select("Period", F.col("LeftAmount").alias("JournalNetIncome"),
                    F.col("RightAmount").alias("MonthlyNetIncome"), "Difference")


def recon_drift(journal: DataFrame, glcal: DataFrame, accmast: DataFrame, last_close: int = fixed.LAST_CLOSE,
                tol: str = fixed.DRIFT_TOLERANCE) -> DataFrame:
    """DQ2: per key and closed period, journal activity vs GLCAL for P&L keys;
    rows whose |difference| > tolerance (expect none)."""
    j = _journal_pl(journal.where(F.col("period") <= last_close), accmast, [*JOURNAL_KEY, "period"]).select(
        *[F.col(c).alias(g) for c, g in zip(JOURNAL_KEY, GLCAL_KEY)], F.col("period").alias("GB_DATE"), "YJ_AMT")
    g = left_dim(glcal, accmast, cols=("ACTYP",)).where(is_profit_and_loss(F.col("ACTYP")))
    return full_outer_reconcile(j, g, [*GLCAL_KEY, "GB_DATE"], "YJ_AMT", "GB_AMT", tol=tol)


# --- DQ3 / DQ5 / DQ7 bucket reconciliations --------------------------------------------

def recon_dept_glcal(led, current_year: int = fixed.CURRENT_YEAR) -> DataFrame:
    """DQ3: DEPTMAST bucket n of the current year equals GLCAL month n, per key;
    one unpivot, one full outer join, summarised per month."""
    keys = ["DP_CO", "DP_DIV", "DP_CC", "DP_ACC"]
    d = led.deptmast.unpivot(keys, [f"DP_C{m}" for m in range(1, 13)], "bucket", "amt").select(
        *keys, F.expr("cast(substring(bucket, 5) as int)").alias("Month"), F.col("amt").alias("DeptAmount"))
    g = led.glcal.where(F.col("GB_DATE").between(current_year * 100 + 1, current_year * 100 + 12)).select(
        *[F.col(a).alias(b) for a, b in zip(GLCAL_KEY, keys)], (F.col("GB_DATE") % 100).cast("int").alias("Month"),
        F.col("GB_AMT").alias("GlcalAmount"))
    j = d.join(g, [*keys, "Month"], "full_outer")
    bad = tolerance_exceeded(F.col("DeptAmount"), F.col("GlcalAmount"))
    return j.groupBy("Month").agg(
        F.count(F.lit(1)).alias("Keys"), F.count_if(bad).alias("Mismatches"),
        money(F.sum("DeptAmount")).alias("DeptTotal"), money(F.sum("GlcalAmount")).alias("GlcalTotal"))


def recon_glfis_glcal(led) -> DataFrame:
    """DQ5: GLFIS buckets equal the monthly table, per key, year and month."""
    keys = ["GF_CO", "GF_DIV", "GF_GLC", "GF_GLA"]
    f = led.glfis.unpivot([*keys, "GF_YR"], [f"GF_H{m}" for m in range(1, 13)], "bucket", "amt").select(
        *keys, "GF_YR", F.expr("cast(substring(bucket, 5) as int)").alias("Month"), F.col("amt").alias("BucketAmount"))
    g = led.glcal.select(*[F.col(a).alias(b) for a, b in zip(GLCAL_KEY, keys)],
                         (F.col("GB_DATE") / 100).cast("int").alias("GF_YR"), (F.col("GB_DATE") % 100).cast("int").alias("Month"),
                         F.col("GB_AMT").alias("GlcalAmount"))
    j = f.join(g, [*keys, "GF_YR", "Month"], "full_outer")
    bad = tolerance_exceeded(F.col("BucketAmount"), F.col("GlcalAmount"))
    return j.groupBy("GF_YR").agg(F.count(F.lit(1)).alias("Cells"), F.count_if(bad).alias("Mismatches"),
                                  money(F.sum("BucketAmount")).alias("BucketTotal"), money(F.sum("GlcalAmount")).alias("GlcalTotal"))


def unclosed_bucket_scan(led, last_close: int = fixed.LAST_CLOSE) -> DataFrame:
    """DQ7: DEPTMAST current-year buckets beyond the last closed month that are
    non-zero (expect none: the table holds closed months only)."""
    from ..operators.aggregates import bucket_scan
    first_open = last_close % 100 + 1
    cols = [f"DP_C{m}" for m in range(first_open, 13)]
    return bucket_scan(led.deptmast, ["DP_CO", "DP_DIV", "DP_CC", "DP_ACC"], cols)


# --- DQ4 ---------------------------------------------------------------------------------

def recon_ytd(led, kind: str, last_close: int = fixed.LAST_CLOSE) -> DataFrame:
    """DQ4: CA_YTD equals the sum of the closed months of the year (P&L) or the
    balance at the last close (balance sheet), per key; counts of keys checked and
    mismatched by account type."""
    y0 = (last_close // 100) * 100 + 1
    c = led.coacmast.join(led.accmast.select(F.col("ACCO").alias("CA_CO"), F.col("ACACC").alias("CA_ACC"), "ACTYP"),
                          ["CA_CO", "CA_ACC"], "left")
    keys = ["CA_CO", "CA_DIV", "CA_CC", "CA_ACC"]
    if kind == "pnl":
        c = c.where(is_profit_and_loss(F.col("ACTYP")))
        g = led.glcal.where(F.col("GB_DATE").between(y0, last_close))
    elif kind == "bs":
        c = c.where(F.col("ACTYP") == "1")
        g = led.glcal.where(F.col("GB_DATE") == last_close)
    else:
        raise ValueError("kind must be 'pnl' or 'bs'")
    g = g.groupBy(*[F.col(a).alias(b) for a, b in zip(GLCAL_KEY, keys)]).agg(money(F.sum("GB_AMT")).alias("Glcal"))
    j = c.select(*keys, "ACTYP", "CA_YTD").join(g, keys, "left")
    bad = tolerance_exceeded(F.col("CA_YTD"), F.col("Glcal"))
    return j.groupBy("ACTYP").agg(F.count(F.lit(1)).alias("Keys"), F.count_if(bad).alias("Mismatches"),
                                  money(F.sum("CA_YTD")).alias("ChartTotal"), money(F.sum("Glcal")).alias("GlcalTotal"))


# --- DQ6, DQ10, DQ11, DQ12 ----------------------------------------------------------------

def date_coverage(journal: DataFrame, cutoff_date: int) -> DataFrame:
    """DQ6: first and last date, rows, and rows dated after the cut-off."""
    return journal.agg(F.min("YJ_DT").alias("MinDate"), F.max("YJ_DT").alias("MaxDate"),
                       F.count(F.lit(1)).alias("Rows"), F.count_if(F.col("YJ_DT") > cutoff_date).alias("RowsAfterCutoff"))


def duplicate_keys(df: DataFrame, key: Sequence[str], near: str | None = None) -> DataFrame:
    """DQ10: rows, distinct candidate keys, rows beyond the first per key and the
    duplicate share.  A count per key, then one global sum.

    ``near``: a column of the key that nearly tells the rows apart and that neighbouring
    rows share (a posting's id).  Rows are dealt by it, so neighbours travel together and
    compress well, and are counted once, after the shuffle; rows without it are dealt by
    the whole key."""
    rows, by = df.select(*key), list(key)
    if near is not None:
        rows = rows.withColumn("_rest", F.when(F.col(near).isNull(), F.xxhash64(*key)))
        by.append("_rest")
        rows = rows.repartition(near, "_rest")
    k = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    return k.agg(F.sum("n").alias("Rows"), F.count(F.lit(1)).alias("DistinctKeys"),
                  F.sum(F.col("n") - 1).alias("DuplicateRows")).withColumn(
        "DuplicatePct", F.col("DuplicateRows").cast("double") * 100.0 / F.col("Rows").cast("double"))


def period_completeness(journal: DataFrame, keys: Sequence[str] = ("YJ_CO", "YJ_DIV")) -> DataFrame:
    """DQ12: months missing between each key's first and last period: the expected
    months come from ``sequence`` + ``explode`` per key (bounded by the calendar),
    the present ones are removed with a ``left_anti`` join."""
    have = journal.select(*keys, month_index(F.col("period")).alias("midx")).distinct()
    span = have.groupBy(*keys).agg(F.min("midx").alias("lo"), F.max("midx").alias("hi"))
    expected = span.select(*keys, F.explode(F.sequence("lo", "hi")).alias("midx"))
    missing = expected.join(have, [*keys, "midx"], "left_anti")
    return missing.select(*keys, period_of_index(F.col("midx")).alias("MissingPeriod"))


# --- DQ14 - DQ16, DQ18 - DQ21, DQ23, DQ24 ---------------------------------------------------

def deleted_with_balance(led) -> DataFrame:
    """DQ14: keys of deleted accounts (status 'D') still carrying a balance."""
    c = led.coacmast.join(led.accmast.select(F.col("ACCO").alias("CA_CO"), F.col("ACACC").alias("CA_ACC"), "ACSTA"),
                          ["CA_CO", "CA_ACC"])
    return c.where((F.col("ACSTA") == "D") & (F.col("CA_CUR") != 0)).select("CA_CO", "CA_DIV", "CA_CC", "CA_ACC", "CA_CUR")


def status_coverage(accmast: DataFrame) -> DataFrame:
    """DQ15: share of deleted accounts per company."""
    return accmast.groupBy(F.col("ACCO").alias("Company")).agg(
        F.count(F.lit(1)).alias("Accounts"), F.count_if(F.col("ACSTA") == "D").alias("Deleted")).withColumn(
        "DeletedPct", F.col("Deleted").cast("double") * 100.0 / F.col("Accounts").cast("double"))


def unused_accounts(accmast: DataFrame, journal: DataFrame) -> DataFrame:
    """DQ16: accounts in the dictionary that were never posted (``left_anti``)."""
    posted = journal.select(F.col("YJ_CO").alias("ACCO"), F.col("YJ_ACC").alias("ACACC")).distinct()
    return accmast.join(posted, ["ACCO", "ACACC"], "left_anti").select("ACCO", "ACACC", "ACNME", "ACSTA")


def unknown_accounts(journal: DataFrame, accmast: DataFrame) -> DataFrame:
    """Postings to accounts absent from ACCMAST (a fault the seeded ledger shows)."""
    known = accmast.select(F.col("ACCO").alias("YJ_CO"), F.col("ACACC").alias("YJ_ACC"))
    return journal.join(known, ["YJ_CO", "YJ_ACC"], "left_anti").groupBy("YJ_CO", "YJ_ACC").agg(
        F.count(F.lit(1)).alias("Legs"), money(F.sum("YJ_AMT")).alias("Amount"))


def unusual_journals(journal: DataFrame) -> DataFrame:
    """DQ18: per creating user: legs with round amounts (multiple of 1,000), legs
    dated on a weekend, and reversal legs."""
    d = F.make_date((F.col("YJ_DT") / 10000).cast("int"), (F.col("YJ_DT") / 100).cast("int") % 100, F.col("YJ_DT") % 100)
    amt = F.col("YJ_AMT")
    return journal.groupBy(F.col("YJ_CRT").alias("CreatedBy")).agg(
        F.count_if((amt != 0) & (amt % 1000 == 0)).alias("RoundAmounts"),
        F.count_if(F.dayofweek(d).isin(1, 7)).alias("WeekendLegs"),
        F.count_if(F.col("YJ_RDT") != 0).alias("ReversalLegs"),
        F.count(F.lit(1)).alias("Legs"))


def je_audit_trail(journal: DataFrame, journal_no: str) -> DataFrame:
    """DQ19: every line of one journal number with user, description and dates."""
    return journal.where(F.col("YJ_JRL") == journal_no).select(
        "YJ_JRL", "YJ_DT", "YJ_PDT", "YJ_CO", "YJ_CC", "YJ_ACC", "YJ_AMT", "YJ_CRT", "YJ_DES", "YJ_RDT", "YJ_UID")


def one_sided_journals(journal: DataFrame) -> DataFrame:
    """DQ20: journals (number, date) whose legs do not sum to zero, or flagged
    one-sided.  Partial aggregation per journal handles a hot journal."""
    g = journal.groupBy("YJ_JRL", "YJ_DT").agg(
        money(F.sum("YJ_AMT")).alias("Imbalance"), F.count_if(F.col("YJ_OSJ") == "Y").alias("FlaggedLegs"),
        F.count(F.lit(1)).alias("Legs"))
    return g.where((F.col("Imbalance") != 0) | (F.col("FlaggedLegs") > 0))


def large_change_alert(changes: DataFrame, threshold: str) -> DataFrame:
    """DQ21: month moves larger than ``threshold`` in absolute value."""
    return changes.where(F.abs(F.col("Change")) > F.lit(threshold).cast("decimal(18,2)"))


def subledger_coverage(subledger: DataFrame, lines: DataFrame, start: int, end: int) -> DataFrame:
    """DQ23: share of each P&L section's GL amount reached by the sub-ledger
    (normalised to company, account, period, amount)."""
    sl = subledger.where(F.col("Period").between(start, end)).groupBy("Company", "AccountNumber").agg(
        money(F.sum("Amount")).alias("SubledgerAmount"))
    gl = lines.where(F.col("Period").between(start, end)).groupBy("Company", "AccountNumber", "Section").agg(
        money(F.sum("Amount")).alias("GlAmount"))
    j = gl.join(sl, ["Company", "AccountNumber"], "left")
    s = j.groupBy("Section").agg(money(F.sum("GlAmount")).alias("GlAmount"),
                                 money(F.coalesce(F.sum("SubledgerAmount"), F.lit(0))).alias("SubledgerAmount"))
    return s.withColumn("CoveragePct", F.when(F.col("GlAmount") != 0, F.col("SubledgerAmount").cast("double") * 100.0
                                              / F.col("GlAmount").cast("double")))


def close_checklist(led, periods: Sequence[int]) -> DataFrame:
    """DQ24: per period, the accounts with activity that need sign-off, with status."""
    g = led.glcal.where(F.col("GB_DATE").isin(*periods) & (F.col("GB_AMT") != 0))
    g = left_dim(g, led.accmast, cols=("ACNME", "ACSTA", "ACTYP"))
    return g.groupBy(F.col("GB_DATE").alias("Period"), "GB_CO", "GB_GLA", "ACNME", "ACSTA", "ACTYP").agg(
        F.count(F.lit(1)).alias("Keys"), money(F.sum("GB_AMT")).alias("Amount"))
