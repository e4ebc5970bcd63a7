"""ISO-week arithmetic as column expressions.

A week key is an integer ``iso_year * 100 + iso_week`` (``202053``).  Everything
here is a plain expression, so it stays inside whole-stage codegen and can be
pushed around by the optimizer.  Malformed or out-of-range keys give NULL, never
an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MIDPOINT_WEEKDAY = {"wednesday": 3, "thursday": 4, "arithmetic": 4}


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _whole(c: Column, divisor: int) -> Column:
    return F.floor(c / F.lit(divisor)).cast("int")


def date_to_week(d: Column | str) -> Column:
    """Week key of a date."""
    d = as_column(d)
    return (F.extract(F.lit("YEAROFWEEK"), d) * 100 + F.extract(F.lit("WEEK"), d)).cast("int")


def iso_parts(d: Column | str) -> Column:
    """Struct of ISO year, ISO week and ISO weekday (Monday = 1)."""
    d = as_column(d)
    return F.struct(
        F.extract(F.lit("YEAROFWEEK"), d).cast("int").alias("iso_year"),
        F.extract(F.lit("WEEK"), d).cast("int").alias("iso_week"),
        F.extract(F.lit("DAYOFWEEK_ISO"), d).cast("int").alias("iso_weekday"),
    )


def weeks_in_year(y: Column | str) -> Column:
    """52 or 53: the ISO week that holds 28 December."""
    return F.weekofyear(F.make_date(as_column(y), F.lit(12), F.lit(28)))


def is_leap_year(y: Column | str) -> Column:
    y = as_column(y)
    return ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)


def _number(w: Column | str) -> Column:
    return as_column(w).try_cast("int")


def week_year(w: Column | str) -> Column:
    """ISO year of a six-digit key, NULL for anything else."""
    n = _number(w)
    return F.when(n.between(100001, 999999), _whole(n, 100))


def week_number(w: Column | str) -> Column:
    n = _number(w)
    return F.when(n.between(100001, 999999), n % 100)


def is_valid_week(w: Column | str) -> Column:
    """True when the key has six digits and names a week its year has."""
    year, week = week_year(w), week_number(w)
    return F.coalesce(week.between(F.lit(1), weeks_in_year(year)), F.lit(False))


def week_to_date(w: Column | str, weekday: int | Column = 1) -> Column:
    """Date of a weekday (1 = Monday .. 7 = Sunday) of the week."""
    year, week = week_year(w), week_number(w)
    first_monday = F.trunc(F.make_date(year, F.lit(1), F.lit(4)), "week")
    offset = (week - 1) * 7 + (weekday - 1 if isinstance(weekday, Column) else F.lit(weekday - 1))
    return F.when(is_valid_week(w), F.date_add(first_monday, offset.cast("int")))


def week_range(w: Column | str) -> Column:
    """Struct of the Monday and Sunday of the week."""
    return F.struct(week_to_date(w, 1).alias("week_start"), week_to_date(w, 7).alias("week_end"))


def week_midpoint(w: Column | str, kind: str = "wednesday") -> Column:
    """Mid-week date under one of the three conventions."""
    return week_to_date(w, MIDPOINT_WEEKDAY[kind])


def week_info(w: Column | str) -> Column:
    """Struct with the parts of the key, its seven days and the year's week count."""
    year = week_year(w)
    return F.struct(
        year.alias("iso_year"),
        week_number(w).alias("iso_week"),
        is_valid_week(w).alias("is_valid"),
        F.array(*[week_to_date(w, k) for k in range(1, 8)]).alias("days"),
        weeks_in_year(year).alias("weeks_in_year"),
    )


def week_days_diff(a: Column | str, b: Column | str, kind: str = "wednesday") -> Column:
    """Days from the midpoint of week ``a`` to the midpoint of week ``b``."""
    return F.datediff(week_midpoint(b, kind), week_midpoint(a, kind))


def weeks_between(a: Column | str, b: Column | str, exact: bool = False) -> Column:
    """Weeks from ``a`` to ``b``.

    The default counts 52 weeks to every year and both end weeks, which is how
    activity durations have always been reported; ``exact`` gives the true
    number of week steps.
    """
    if exact:
        return (F.datediff(week_to_date(b), week_to_date(a)) / 7).cast("int")
    return (week_year(b) - week_year(a)) * 52 + (week_number(b) - week_number(a)) + 1


def fill_week(w: Column | str, d: Column | str) -> Column:
    """The week key where there is one, else the week of the date."""
    return F.coalesce(as_column(w).cast("int"), date_to_week(d))


def days_to_event(
    flag: Column | str, event: Column | str, w: Column | str, sentinel: int = 9999, kind: str = "wednesday"
) -> Column:
    """Days from mid-week to the event for flagged rows, a sentinel for the others."""
    return F.when(as_column(flag) == 1, F.datediff(as_column(event), week_midpoint(w, kind))).otherwise(
        F.lit(sentinel)
    )


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.datediff(as_column(end), as_column(start))


def months_between_30(start: Column | str, end: Column | str) -> Column:
    """Elapsed months on a 30-day month."""
    return days_between(start, end) / F.lit(30)


def elapsed(since: Column | str, as_of: Column | str) -> Column:
    """Struct of days and 30-day months from a date up to a given day."""
    return F.struct(
        days_between(since, as_of).alias("days_elapsed"),
        months_between_30(since, as_of).alias("months_elapsed"),
    )


def earliest(*dates: Column | str) -> Column:
    """Earliest of several dates, NULLs skipped."""
    return F.least(*[as_column(d) for d in dates])


def first_present(*values: Column | str) -> Column:
    return F.coalesce(*[as_column(v) for v in values])


def calendar_parts(d: Column | str) -> Column:
    """Struct of year, quarter, month, ``yyyy-MM`` label and month name."""
    d = as_column(d)
    return F.struct(
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "yyyy-MM").alias("month_label"),
        F.date_format(d, "MMMM").alias("month_name"),
    )


def month_of(d: Column | str) -> Column:
    return F.trunc(as_column(d), "month")
