"""Date predicates and parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_years(df: DataFrame, column: str, years: int | tuple[int, int]) -> Column:
    """``column`` falls in the calendar year, or in the inclusive span of years.

    Written as a half-open range of the column's own type, so that it reaches the Parquet scan.
    """
    first, last = (years, years) if isinstance(years, int) else years
    kind = df.select(column).schema[0].dataType
    bound = lambda year: F.lit(f"{year:04d}-01-01").cast(kind)
    return (F.col(column) >= bound(first)) & (F.col(column) < bound(last + 1))


def parse_dmy(text: Column) -> Column:
    """Day-month-year text to a date; text that fits neither form gives null."""
    return F.coalesce(
        F.try_to_date(text, "d/M/yyyy"), F.try_to_date(text, "d-M-yyyy"),
        F.try_to_date(text, "d-MMM-yyyy"), F.try_to_date(text, "d-MMM-yy"),
    )
