"""The observer trip code carried by a landing; an empty code means unobserved."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_empty(trip: Column) -> Column:
    """Null to the empty string, so that 'unobserved' has one spelling from ingest on."""
    return F.coalesce(trip, F.lit(""))


def observed_flag(trip: Column) -> Column:
    """0 for an empty trip code, else 1; null stays null."""
    return (trip != "").cast("int")
