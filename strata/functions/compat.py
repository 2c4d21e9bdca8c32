"""Column helpers that pin down warehouse-dialect semantics on Spark.

All are plain Column expressions (JVM side, whole-stage codegen); no UDFs.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_or_name", "date_key", "safe_div", "pct", "year_diff", "month_diff",
    "second_diff", "money", "money4", "strict_least", "dbl", "iff", "lit_date",
    "lit_ts", "month_start", "null_if_blank",
]


def col_or_name(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_date(d) -> Column:
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d)


def lit_ts(ts) -> Column:
    """A TIMESTAMP_NTZ literal (wall-clock, no zone).  Built from text so that
    neither the Python process zone nor the session zone shifts it."""
    if isinstance(ts, Column):
        return ts
    if isinstance(ts, str):
        ts = _dt.datetime.fromisoformat(ts)
    if isinstance(ts, _dt.datetime) and ts.tzinfo is not None:
        ts = ts.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")


def date_key(d) -> Column:
    """YYYYMMDD integer surrogate for a date (TO_NUMBER(TO_CHAR(d,'YYYYMMDD')))."""
    d = col_or_name(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("bigint")


def dbl(c) -> Column:
    return col_or_name(c).cast("double")


def safe_div(num, den) -> Column:
    """num / den as double; NULL when den is 0 or NULL (ANSI Spark would raise)."""
    n, d = dbl(num), dbl(den)
    return F.when(d != 0, n / d)


def pct(num, den) -> Column:
    """IFF(den > 0, num / den * 100, NULL)."""
    n, d = dbl(num), dbl(den)
    return F.when(d > 0, n / d * 100.0)


def year_diff(start, end) -> Column:
    """DATEDIFF('year', a, b): calendar-year boundaries crossed."""
    return (F.year(col_or_name(end)) - F.year(col_or_name(start))).cast("bigint")


def month_diff(start, end) -> Column:
    """DATEDIFF('month', a, b): calendar-month boundaries crossed."""
    s, e = col_or_name(start), col_or_name(end)
    return ((F.year(e) - F.year(s)) * 12 + F.month(e) - F.month(s)).cast("bigint")


def second_diff(start, end) -> Column:
    """DATEDIFF('second', a, b): second boundaries crossed.  Computed on
    second-truncated wall-clock values, so no session time zone (or DST
    change) enters the result."""
    s, e = col_or_name(start), col_or_name(end)
    return F.timestamp_diff("SECOND", F.date_trunc("second", s), F.date_trunc("second", e)).cast("bigint")


def money(c) -> Column:
    """NUMBER(18,2): exact, rounded half away from zero."""
    return col_or_name(c).cast("decimal(18,2)")


def money4(c) -> Column:
    return col_or_name(c).cast("decimal(18,4)")


def strict_least(*cols) -> Column:
    """LEAST that is NULL when any input is NULL (Spark's least skips NULLs)."""
    cs = [col_or_name(c) for c in cols]
    any_null = cs[0].isNull()
    for c in cs[1:]:
        any_null = any_null | c.isNull()
    return F.when(~any_null, F.least(*cs))


def iff(cond: Column, a, b) -> Column:
    return F.when(cond, a).otherwise(b)


def month_start(d) -> Column:
    return F.trunc(col_or_name(d), "month")


def null_if_blank(c) -> Column:
    c = col_or_name(c)
    return F.when(F.trim(c) != "", c)
