"""Dates are carried as whole days since 1970-01-01, so that windows can range over them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_day(date: Column) -> Column:
    return F.unix_date(date.cast("date"))


def to_date(day: Column) -> Column:
    return F.date_from_unix_date(day.cast("int"))
