"""Calendar expressions and reference dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PEAK_HOURS = (20, 23)
PAYDAYS = (1, 15)


def latest(df: DataFrame, col: str = "date") -> Column:
    """The table's largest date as a scalar subquery (one value, no join)."""
    return df.agg(F.max(col).alias("latest")).scalar()


def anchor(df: DataFrame, as_of: dt.date | str | Column | None, col: str = "date") -> Column:
    """Reference day of look-backs: the one given, else the last day in the data.

    Never the wall clock, so a rerun gives the same table.
    """
    if as_of is None:
        return latest(df, col)
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("date")


def look_back(df: DataFrame, days: int | None, as_of=None, col: str = "date") -> DataFrame:
    """Rows of the last ``days`` days; the first day of the window is included."""
    if days is None:
        return df
    return df.where(F.col(col) >= F.date_sub(anchor(df, as_of, col), days))


def month_of(col: Column | str) -> Column:
    return F.to_date(F.date_trunc("month", F.col(col) if isinstance(col, str) else col))


def week_of(col: Column | str) -> Column:
    """The Monday of the week."""
    return F.to_date(F.date_trunc("week", F.col(col) if isinstance(col, str) else col))


def month_index(month: Column, cohort: Column, mode: str = "calendar") -> Column:
    """Whole months from ``cohort`` to ``month`` (both first days of a month).

    ``calendar`` counts months; ``days_30_44`` divides days by 30.44 and rounds
    down, which puts some neighbouring months into the same index.
    """
    if mode == "calendar":
        return F.months_between(month, cohort).cast("int")
    if mode == "days_30_44":
        return F.floor(F.datediff(month, cohort) / F.lit(30.44)).cast("int")
    raise ValueError(f"unknown month index mode: {mode}")


def month_abbreviation(month_number: Column | str) -> Column:
    """P10: ``"3"`` -> ``Mar``."""
    c = F.col(month_number) if isinstance(month_number, str) else month_number
    return F.date_format(month_order(c), "MMM")


def month_order(month_number: Column) -> Column:
    """A date that sorts month numbers in calendar order."""
    return F.to_date(month_number.cast("string"), "M")


def day_name(day_of_week: Column) -> Column:
    """Name of a day numbered from 0 = Monday."""
    # Axis labels of the weekly profile.
    names = F.array(*[F.lit(d) for d in ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")])
    return F.get(names, day_of_week)
