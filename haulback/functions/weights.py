"""Species weights and the ratios built on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------------------
COD_HAD_THRESHOLD = 0.8
KG_PER_TONNE = 1000.0
# ----------------------------------------------------------------------------------------------


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives null, never an error, for a zero or null denominator."""
    return F.when(denominator != 0, numerator / denominator)


def cod_had_ratio(cod: Column, had: Column) -> Column:
    """cod / had with a signed infinity for x/0 and null for 0/0."""
    return (
        F.when(had != 0, cod / had)
        .when(cod > 0, F.lit(float("inf")))
        .when(cod < 0, F.lit(float("-inf")))
    )


def pollock_dominant(cod: Column, had: Column, pol: Column) -> Column:
    return pol > cod + had


def zero_if_null(weight: Column) -> Column:
    return F.coalesce(weight, F.lit(0e0))


def floor_zero(weight: Column) -> Column:
    """0 becomes 1, so that a ratio of sums over a stratum is always defined."""
    return F.when(weight == 0, F.lit(1e0)).otherwise(weight)
