"""Calendar expressions (SC10-SC14, SC40, SC44)."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed as K
from .text import as_col, is_missing

_ISO = "^\\d{4}-\\d{2}-\\d{2}"
_DMY = "^\\d{1,2}/\\d{1,2}/\\d{4}"


def parse_date(c: Column | str) -> Column:
    """ISO or day-first date; the two notations cannot be confused, so each value decides alone."""
    s = F.trim(as_col(c).cast("string"))
    iso = F.try_to_timestamp(F.substring(s, 1, 10), F.lit("yyyy-MM-dd"))
    dmy = F.try_to_timestamp(F.regexp_extract(s, "^(\\d{1,2}/\\d{1,2}/\\d{4})", 1), F.lit("d/M/yyyy"))
    return F.when(is_missing(s), None).when(s.rlike(_ISO), iso).when(s.rlike(_DMY), dmy).cast("date")


def event_date(cols: Iterable[Column | str]) -> Column:
    return F.coalesce(*[as_col(c) for c in cols])


def iso_year(c: Column | str) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), as_col(c))


def iso_week(c: Column | str) -> Column:
    return F.weekofyear(as_col(c))


def iso_monday(c: Column | str) -> Column:
    return F.trunc(as_col(c), "WEEK")


def monday_of(year: Column | str, week: Column | str) -> Column:
    """Monday of an ISO (year, week): week 1 holds 4 January."""
    jan4 = F.make_date(as_col(year), F.lit(1), F.lit(4))
    return F.date_add(F.trunc(jan4, "WEEK"), (7 * (as_col(week) - 1)).cast("int"))


def period_label(year: Column | str, week: Column | str) -> Column:
    return F.format_string("%d-S%02d", as_col(year).cast("int"), as_col(week).cast("int"))


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.datediff(as_col(end), as_col(start))


def valid_lag(c: Column | str, bound: int = 365) -> Column:
    """Present, not negative and below the bound (365 or, for closure, 800 days)."""
    x = as_col(c)
    return x.isNotNull() & (x >= 0) & (x < bound)


def month_label(c: Column | str) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in K.MONTHS]), as_col(c).cast("int"))
