"""Quarter keys of the form ``2020Q3``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PERIOD_PATTERN = r"^[0-9]{4}Q[1-4]$"


def period_key(year: Column, quarter: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("Q"), quarter.cast("string"))


def period_of_date(day: Column) -> Column:
    return period_key(F.year(day), F.quarter(day))


def period_year(key: Column) -> Column:
    return F.split_part(key, F.lit("Q"), F.lit(1)).cast("int")


def period_quarter(key: Column) -> Column:
    return F.split_part(key, F.lit("Q"), F.lit(2)).cast("int")


def period_sort(year: Column, quarter: Column) -> Column:
    """Integer that sorts like the calendar."""
    return year * 10 + quarter


def next_period_key(year: Column, quarter: Column) -> Column:
    """Key of the following calendar quarter, NULL outside quarters 1 to 4."""
    following = F.when(quarter == 4, period_key(year + 1, F.lit(1)))
    return following.when(quarter.between(1, 3), period_key(year, quarter + 1))
