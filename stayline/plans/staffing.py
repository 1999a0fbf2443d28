"""The staffing study."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stayline.operators import staffing


def utilisation(tables) -> DataFrame:
    return staffing.doctor_utilisation(tables.availability, staffing.doctor_days(tables.doctor_lines))


def study(tables, after: str, before: str) -> DataFrame:
    """Utilisation rows inside the dates, without revenue-per-hour outliers."""
    return staffing.without_outliers(staffing.in_study(utilisation(tables), after, before))
