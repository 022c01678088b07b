"""Period arithmetic (PRD2-PRD4): CCYYMM integers, month indexes, keywords.

Periods are integers CCYYMM, not dates.  Parameters are parsed on the driver (they
are scalars); the column forms below are pure expressions for use on data.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted period text forms and range.
PERIOD_PATTERN = re.compile(r"^(\d{4})-?(\d{2})(?:-\d{2})?$")
PERIOD_MIN, PERIOD_MAX = 190001, 209912
QUARTER_PATTERN = re.compile(r"^Q([1-4])\s+(\d{4})$", re.IGNORECASE)


def parse_period(p) -> int:
    """PRD2: ``YYYY-MM``, ``YYYY-MM-DD``, ``YYYYMM`` or an int -> CCYYMM int."""
    year, month = _year_and_month(p)
    value = 100 * year + month
    if month not in range(1, 13) or not PERIOD_MIN <= value <= PERIOD_MAX:
        raise ValueError(f"no such month: {p!r}")
    return value


def _year_and_month(p) -> tuple[int, int]:
    """The two numbers a period is written with, unchecked."""
    if type(p) is int:
        return divmod(p, 100)
    text = "" if isinstance(p, bool) else str(p).strip()
    if PERIOD_PATTERN.match(text) is None:
        raise ValueError(f"{p!r} is neither a number CCYYMM nor a month or date in ISO form")
    digits = text.replace("-", "")
    return int(digits[:4]), int(digits[4:6])


def period_range(start, end=None) -> tuple[int | None, int | None]:
    """PRD4: inclusive range with open ends; a range that runs backwards is an error."""
    first, last = (None if x is None else parse_period(x) for x in (start, end))
    if None not in (first, last) and first > last:
        raise ValueError(f"the range {first}..{last} runs backwards")
    return first, last


def period_keyword(text: str, latest_period: int | None = None) -> list[int]:
    """PRD3: ``'Q1 2025'`` -> its three months; ``'YTD'`` -> January..latest period.

    ``latest_period`` is the newest period in the data (``agg(max(period))``)."""
    t = text.strip()
    m = QUARTER_PATTERN.match(t)
    if m:
        q, y = int(m.group(1)), int(m.group(2))
        return [y * 100 + 3 * (q - 1) + k for k in (1, 2, 3)]
    if t.upper() == "YTD":
        if latest_period is None:
            raise ValueError("YTD needs the latest period in the data")
        y = latest_period // 100
        return [y * 100 + k for k in range(1, latest_period % 100 + 1)]
    return [parse_period(t)]


def between(col: Column, start: int | None, end: int | None) -> Column:
    """PRD4 as a column predicate."""
    c = F.lit(True)
    if start is not None:
        c = c & (col >= start)
    if end is not None:
        c = c & (col <= end)
    return c


# --- column forms -----------------------------------------------------------------

def month_index(period: Column) -> Column:
    """CCYYMM -> months since year 0 (``y*12 + m - 1``): gaps and year ends align."""
    return (period / 100).cast("int") * 12 + period % 100 - 1


def period_of_index(idx: Column) -> Column:
    """Inverse of :func:`month_index`."""
    return (F.floor(idx / 12) * 100 + idx % 12 + 1).cast("int")


def period_start(period: Column) -> Column:
    """First day of the period as a DATE."""
    return F.make_date((period / 100).cast("int"), period % 100, F.lit(1))


def year_of(period: Column) -> Column:
    return (period / 100).cast("int")


def month_of(period: Column) -> Column:
    return (period % 100).cast("int")


def shift_period(period: Column, months: int) -> Column:
    """Period ``months`` later (negative: earlier), via the month index."""
    return period_of_index(month_index(period) + months)


def period_of_date(yyyymmdd: Column) -> Column:
    """YYYYMMDD int -> CCYYMM int."""
    return (yyyymmdd / 100).cast("int")


def quarter_of(period: Column) -> Column:
    return ((month_of(period) - 1) / 3).cast("int") + 1


def parse_period_col(text: Column) -> Column:
    """PRD2 column form: text ``YYYY-MM``, ``YYYY-MM-DD`` or ``YYYYMM`` -> CCYYMM, or
    NULL when the text does not parse or is out of range."""
    rx = PERIOD_PATTERN.pattern
    # The number is bound by a lambda: a column named four times would be matched four times.
    v = F.concat(F.regexp_extract(text, rx, 1), F.regexp_extract(text, rx, 2)).try_cast("int")
    return F.transform(F.array(v), lambda x: F.when(x.between(PERIOD_MIN, PERIOD_MAX) & (x % 100).between(1, 12), x))[0]
