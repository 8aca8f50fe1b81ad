"""Scalar expressions shared by the operators."""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import day_end, day_start


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def on_day(ts: str | Column, d: date | str) -> Column:
    """``ts::date = d`` written as a half-open range so it reaches the
    Parquet scan as ``PushedFilters``. NULL timestamps are not on any day."""
    t = _c(ts)
    return (t >= day_start(d)) & (t < day_end(d))


def changed(old: list[Column], new: list[Column]) -> Column:
    """"Any attribute changed": a disjunction of ``<>``.

    NULL compares as unknown, so a NULL on either side is not a change
    (same as the SQL the reference runs)."""
    return reduce(or_, [o != n for o, n in zip(old, new)])


def within(gap: Column, max_seconds: int) -> Column:
    """``gap <= interval 'max_seconds seconds'`` (inclusive) for a day-time interval."""
    return gap <= F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(max_seconds))


def full_name(last: str | Column, first: str | Column, middle: str | Column) -> Column:
    """``last || ' ' || first || ' ' || middle``; NULL in any part gives NULL
    (``concat`` propagates NULL, ``concat_ws`` would not)."""
    return F.concat(_c(last), F.lit(" "), _c(first), F.lit(" "), _c(middle))


def result_code(result: str | Column, success: str, refused: str) -> Column:
    """Refused -> 0, success -> 1, anything else -> NULL (CASE without ELSE)."""
    r = _c(result)
    return F.when(r == refused, F.lit(0)).when(r == success, F.lit(1))


def falling_flag(amt: str | Column, prev_amt: str | Column) -> Column:
    """0 when there is no previous amount or the amount fell, else 1
    (equal amounts and a NULL current amount count as 1)."""
    a, p = _c(amt), _c(prev_amt)
    return F.when(p.isNull(), F.lit(0)).when(a < p, F.lit(0)).otherwise(F.lit(1))


def seconds_of_day(ts: str | Column) -> Column:
    t = _c(ts)
    return F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
