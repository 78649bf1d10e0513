"""Guarded arithmetic and ages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """Numerator over denominator as double; NULL unless the denominator is positive."""
    return F.when(denominator > 0, numerator.cast("double") / denominator.cast("double"))


def age_micros(as_of: Column, moment: Column) -> Column:
    return F.unix_micros(as_of) - F.unix_micros(moment)


def age_hours(as_of: Column, moment: Column) -> Column:
    return age_micros(as_of, moment) / F.lit(3.6e9)


def model_family(version: Column) -> Column:
    """Model name from the prefix of its version string."""
    return (
        F.when(version.startswith("rule_score"), "rule_score")
        .when(version.startswith("logreg"), "logreg")
        .otherwise("unknown")
    )
