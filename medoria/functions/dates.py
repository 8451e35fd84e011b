"""Calendar expressions shared by the date dimension, the facts and the questions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """Integer key ``yyyymmdd``; NULL stays NULL."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def to_date_key(day: dt.date) -> int:
    """The same key for a Python date, for use in filters."""
    return day.year * 10000 + day.month * 100 + day.day


def calendar(day: Column) -> dict[str, Column]:
    """Parts of a date under the names the date dimension uses."""
    month = F.month(day)
    return {
        "annee": F.year(day),
        "mois": month,
        "jour": F.dayofmonth(day),
        "trimestre": F.quarter(day),
        "semestre": F.when(month.isNotNull(), F.ceil(month / 6)).cast("int"),
    }


def age_at(birth: Column, as_of: dt.date) -> Column:
    """Completed years between ``birth`` and a fixed day, so a rerun gives the same age."""
    return F.floor(F.months_between(F.lit(as_of), birth) / 12).cast("int")


def in_period(key: Column, year: Column, start: dt.date, end: dt.date) -> Column:
    """Half-open period ``[start, end)`` on a date key.

    The redundant condition on ``year`` is what prunes partitions of a fact
    stored by year; the key condition is exact and reaches the Parquet reader.
    """
    return (
        (year >= start.year)
        & (year <= end.year)
        & (key >= to_date_key(start))
        & (key < to_date_key(end))
    )
