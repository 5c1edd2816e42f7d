"""Week codes, week ends and date shifts, for columns and for plain Python dates.

A week here is the n-th run of seven days of its year (week 1 = 1 to 7 January),
so week 53 holds the last one or two days. A week code is ``year * 100 + week``.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b)).cast("int")


def week_of_year(day: Column) -> Column:
    return _div(F.dayofyear(day) - 1, 7) + 1


def week_code(day: Column) -> Column:
    return F.year(day) * 100 + week_of_year(day)


def code_year(code: Column) -> Column:
    return _div(code, 100)


def code_week(code: Column) -> Column:
    return code % 100


def week_end(code: Column | None = None, day: Column | None = None) -> Column:
    """Last day of a week, given its code or any day in it; week 53 ends on 31 December."""
    if code is None and day is None:
        raise ValueError("a week code or a day is needed")
    if code is None:
        code = week_code(day)
    year, week = code_year(code), code_week(code)
    new_year = F.make_date(year, F.lit(1), F.lit(1))
    return F.when(week == 53, F.make_date(year, F.lit(12), F.lit(31))).otherwise(F.date_add(new_year, week * 7 - 1))


def date_parts(day: Column) -> dict[str, Column]:
    """The calendar columns used by the sales scripts."""
    year, month, week = F.year(day), F.month(day), week_of_year(day)
    return {
        "mnth": month,
        "wkday": F.date_format(day, "EEEE"),
        "wk": week,
        "yr": year,
        "yrmnth": year * 100 + month,
        "yrweek": year * 100 + week,
    }


def _carry(low: Column, high: Column, size: int) -> tuple[Column, Column]:
    """Move whole multiples of ``size`` from ``low`` to ``high``, each keeping ``low``'s sign."""
    sign = F.signum(low).cast("int")
    return sign * (F.abs(low) % size), high + sign * _div(F.abs(low), size)


def normalize_offset(day: Column, week: Column, month: Column, year: Column) -> Column:
    """Struct (day, week, month, year) with days carried to weeks and weeks to months or years.

    Weeks go to months by fours only where a month offset was given, else to years by 52.
    """
    d, w = _carry(day, week, 7)
    week_left, month_up = _carry(w, month, 4)
    month_left, year_by_month = _carry(month_up, year, 12)
    week_of_52, year_by_week = _carry(w, year, 52)
    by_month = month != 0
    return F.struct(
        d.alias("day"),
        F.when(by_month, week_left).otherwise(week_of_52).alias("week"),
        F.when(by_month, month_left).otherwise(month).alias("month"),
        F.when(by_month, year_by_month).otherwise(year_by_week).alias("year"),
    )


def _add_months_rolling(day: Column, months: Column) -> Column:
    """Add months; a day the target month lacks rolls into the month after (31 Jan + 1 = 2 or 3 Mar)."""
    return F.date_add(F.add_months(F.trunc(day, "MM"), months), F.dayofmonth(day) - 1)


def shift_date(
    day: Column,
    days: int | Column | None = None,
    weeks: int | Column | None = None,
    months: int | Column | None = None,
    years: int | Column | None = None,
) -> Column:
    """Shift by days, then weeks, then months, then years."""

    def as_column(n: int | Column) -> Column:
        return n if isinstance(n, Column) else F.lit(n)

    if days is not None:
        day = F.date_add(day, as_column(days))
    if weeks is not None:
        day = F.date_add(day, as_column(weeks) * 7)
    if months is not None:
        day = _add_months_rolling(day, as_column(months))
    if years is not None:
        day = _add_months_rolling(day, as_column(years) * 12)
    return day


# --- the same on plain dates, for report parameters -----------------------------------


@dataclass(frozen=True)
class Offset:
    day: int
    week: int
    month: int
    year: int


def plain_week_code(day: date) -> int:
    return day.year * 100 + (day.timetuple().tm_yday - 1) // 7 + 1


def plain_week_end(day: date) -> date:
    year, week = divmod(plain_week_code(day), 100)
    return date(year, 12, 31) if week == 53 else date(year, 1, 1) + timedelta(days=7 * week - 1)


def plain_offset(day: int = 0, week: int = 0, month: int = 0, year: int = 0) -> Offset:
    def carry(low: int, high: int, size: int) -> tuple[int, int]:
        sign = (low > 0) - (low < 0)
        return sign * (abs(low) % size), high + sign * (abs(low) // size)

    day, week = carry(day, week, 7)
    if month != 0:
        week, month = carry(week, month, 4)
        month, year = carry(month, year, 12)
    else:
        week, year = carry(week, year, 52)
    return Offset(day, week, month, year)


def plain_shift(day: date, weeks: int = 0, years: int = 0) -> date:
    day = day + timedelta(weeks=weeks)
    return date(day.year + years, day.month, 1) + timedelta(days=day.day - 1)
