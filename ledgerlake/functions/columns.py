"""Column-level building blocks: predicates, projections and sign rules (PRD*).

Every function returns a ``Column`` or a ``DataFrame -> DataFrame`` transform built
from ``pyspark.sql.functions``; nothing here runs Python per row.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed


def case_map(col: Column, pairs: Iterable[tuple[str, str]], default: str | None = None) -> Column:
    """A CASE expression from a fixed (value -> result) list."""
    pairs = list(pairs)
    expr = F.when(col == pairs[0][0], F.lit(pairs[0][1]))
    for k, v in pairs[1:]:
        expr = expr.when(col == k, F.lit(v))
    return expr.otherwise(F.lit(default))


def pad_code(value: str | int | None, width: int) -> str | None:
    """PRD1 parameter normalisation: strip, then left-pad with zeros (``zfill``).

    Done on the driver for parameters: unlike Spark's ``lpad`` it never truncates.
    """
    if value is None:
        return None
    s = str(value).strip()
    if not s:
        return None
    return s.zfill(width)


def dim_filter(df: DataFrame, *, company=None, division=None, cost_center=None, account=None,
               branch=None, cols=("GB_CO", "GB_DIV", "GB_GLC", "GB_GLA")) -> DataFrame:
    """PRD1 ``dim_filter``: optional equality filters on the spine.

    Company and division pad to 2, cost center to 3, account to 5; branch is only
    stripped and compared with the last two characters of the cost center.
    """
    co, div, cc, acc = cols
    conds = []
    if (v := pad_code(company, 2)) is not None:
        conds.append(F.col(co) == v)
    if (v := pad_code(division, 2)) is not None:
        conds.append(F.col(div) == v)
    if (v := pad_code(cost_center, 3)) is not None:
        conds.append(F.col(cc) == v)
    if (v := pad_code(account, 5)) is not None:
        conds.append(F.col(acc) == v)
    if branch is not None and str(branch).strip():
        conds.append(branch_of(F.col(cc)) == str(branch).strip())
    return df.where(reduce(lambda a, b: a & b, conds)) if conds else df


def nonzero(col: Column, include_zero: bool = False) -> Column:
    """PRD5: ``amount <> 0`` unless ``include_zero``."""
    return F.lit(True) if include_zero else (col != 0)


def active_only(status: Column) -> Column:
    """PRD6: status <> 'D' (NULL status counts as active)."""
    return F.coalesce(status, F.lit("")) != "D"


def year_end_filter(flag: Column, mode: str = "include") -> Column:
    """PRD7: include / exclude / only year-end adjustment rows (flag 'Y')."""
    if mode == "include":
        return F.lit(True)
    if mode == "exclude":
        return F.coalesce(flag, F.lit("")) != "Y"
    if mode == "only":
        return flag == "Y"
    raise ValueError(f"year_end mode must be include, exclude or only, got {mode!r}")


def memo_excluded(memo: Column) -> Column:
    """PRD8: memo accounts (flag set) do not feed totals."""
    return F.coalesce(memo, F.lit("")) == ""


def mapped_only(alias: Column) -> Column:
    """PRD10: alias present."""
    return F.coalesce(alias, F.lit("")) != ""


def is_profit_and_loss(actyp: Column) -> Column:
    """PRD11: revenue ('2') or expense ('3') accounts."""
    return actyp.isin("2", "3")


def is_balance_sheet(actyp: Column) -> Column:
    """PRD11: balance-sheet accounts ('1')."""
    return actyp == "1"


def net_income_impact(amount: Column, actyp: Column | None = None) -> Column:
    """PRD12: revenue is stored negative and expense positive, so the impact on net
    income is ``-amount`` for both; accounts outside the P&L have no impact."""
    if actyp is None:
        return -amount
    return F.when(is_profit_and_loss(actyp), -amount).otherwise(F.lit(0).cast("decimal(18,2)"))


def department_of(cc: Column) -> Column:
    """PRD14: first character of the cost center."""
    return F.substring(cc, 1, 1)


def branch_of(cc: Column) -> Column:
    """PRD14: last two characters of the cost center."""
    return F.substring(cc, -2, 2)


def tolerance_exceeded(a: Column, b: Column, tol: str = fixed.DRIFT_TOLERANCE) -> Column:
    """PRD16: ``abs(a - b) > tol`` with NULL read as 0."""
    return F.abs(F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0))) > F.lit(tol).cast("decimal(10,3)")


def ntz_literal(value) -> Column:
    """A wall-clock TIMESTAMP_NTZ literal parsed from text: neither the session nor
    the machine time zone can shift it (a Python datetime literal goes through the
    machine's zone)."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def money(c: Column) -> Column:
    """Cast an aggregate to DECIMAL(18,2), the one money type of all outputs."""
    return c.cast("decimal(18,2)")


def friendly_columns(df: DataFrame, names: dict[str, str], trim: Iterable[str] = ()) -> DataFrame:
    """PRD13: rename physical columns and right-trim the text ones."""
    trim = set(trim)
    return df.select(*[
        (F.rtrim(F.col(src)) if src in trim else F.col(src)).alias(dst) for src, dst in names.items()
    ])


def safe_pct(num: Column, base: Column) -> Column:
    """Percent change helper: NULL when the base is 0 or NULL, divided by ABS(base)."""
    b = F.abs(base).cast("double")
    return F.when(b == 0, F.lit(None).cast("double")).otherwise(num.cast("double") * 100.0 / b)
