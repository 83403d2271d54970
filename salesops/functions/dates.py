"""Date functions and driver-side period parameters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names per language, January to December.
MONTH_NAMES = {
    "ru": ["Январь", "Февраль", "Март", "Апрель", "Май", "Июнь",
           "Июль", "Август", "Сентябрь", "Октябрь", "Ноябрь", "Декабрь"],
    "en": ["January", "February", "March", "April", "May", "June",
           "July", "August", "September", "October", "November", "December"],
}


def date_text(col: Column | str) -> Column:
    """dd.MM.yyyy"""
    return F.date_format(col, "dd.MM.yyyy")


def iso_text(col: Column | str) -> Column:
    """yyyy-MM-dd"""
    return F.date_format(col, "yyyy-MM-dd")


def month_name(col: Column | str, language: str = "ru") -> Column:
    """Month name in the given language; NULL for a NULL date."""
    names = F.array(*[F.lit(n) for n in MONTH_NAMES[language]])
    return F.get(names, F.month(col) - 1)


def third_of_year(col: Column | str) -> Column:
    """1 for January to April, 2 for May to August, 3 for the rest."""
    return (F.floor((F.month(col) - 1) / 4) + 1).cast("int")


def month_start(col: Column | str) -> Column:
    return F.trunc(col, "MM")


def month_end(col: Column | str) -> Column:
    return F.last_day(col)


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.datediff(end, start)


def first_of_month(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


def parse_date(col: Column | str) -> Column:
    """dd.MM.yyyy text to a date; text that is no date becomes NULL."""
    return F.try_to_date(col, "dd.MM.yyyy")


def resolve_period(mode: str, today: dt.date | None = None) -> tuple[int, int]:
    """(year, month) of the period to process; January's previous month is last year's December."""
    today = today or dt.date.today()
    if mode == "current period":
        return today.year, today.month
    if mode == "previous period":
        last = today.replace(day=1) - dt.timedelta(days=1)
        return last.year, last.month
    raise ValueError(f"unknown period mode: {mode!r}")


def month_bounds(year: int, month: int) -> tuple[dt.date, dt.date]:
    """First and last day of a month."""
    start = dt.date(year, month, 1)
    after = dt.date(year + month // 12, month % 12 + 1, 1)
    return start, after - dt.timedelta(days=1)
