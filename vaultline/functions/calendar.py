"""Hierarchical date buckets for partition layout.

Recent dates keep a partition per day, dates of the last few calendar months
are grouped per month, and anything older than the active years is grouped
per year.  Gaps are counted in calendar boundaries crossed between the date and
``as_of`` (e.g. 2024-03-31 is three months before 2024-06-15).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The warehouse groups partitions with 3 active months and 2 active years.
ACTIVE_MONTHS = 3
ACTIVE_YEARS = 2


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def calendar_bucket(
    d: str | Column,
    as_of: str | Column,
    active_months: int = ACTIVE_MONTHS,
    active_years: int = ACTIVE_YEARS,
) -> Column:
    """Partition bucket (a ``date``) of date/timestamp ``d`` seen from ``as_of``."""
    day = F.to_date(_col(d))
    ref = F.to_date(F.lit(as_of) if isinstance(as_of, str) else as_of)
    year_gap = F.year(ref) - F.year(day)
    month_gap = (F.year(ref) * 12 + F.month(ref)) - (F.year(day) * 12 + F.month(day))
    return (
        F.when(day.isNull(), F.lit(None).cast("date"))
        .when(year_gap >= active_years, F.trunc(day, "year"))
        .when(month_gap >= active_months, F.trunc(day, "month"))
        .otherwise(day)
    )


def calendar_bucket_sql(d: str, as_of: str, active_months: int = ACTIVE_MONTHS,
                        active_years: int = ACTIVE_YEARS) -> str:
    """The same bucket as DuckDB SQL text (used by the oracle queries)."""
    day = f"CAST({d} AS DATE)"
    ref = f"CAST({as_of} AS DATE)"
    year_gap = f"(year({ref}) - year({day}))"
    month_gap = f"((year({ref}) * 12 + month({ref})) - (year({day}) * 12 + month({day})))"
    return (
        f"CASE WHEN {day} IS NULL THEN NULL "
        f"WHEN {year_gap} >= {active_years} THEN CAST(date_trunc('year', {day}) AS DATE) "
        f"WHEN {month_gap} >= {active_months} THEN CAST(date_trunc('month', {day}) AS DATE) "
        f"ELSE {day} END"
    )
