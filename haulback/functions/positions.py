"""Positions packed as degrees, minutes and hundredths of a minute."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode_packed(packed: Column, sign: int = 1) -> Column:
    """``DDMMmm`` text to decimal degrees; null or unreadable parts give null."""
    part = lambda start: F.substring(packed, start, 2).try_cast("double")
    degrees = part(1) + part(3) / F.lit(60e0) + part(5) / F.lit(6000e0)
    return F.lit(float(sign)) * degrees
