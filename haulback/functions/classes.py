"""Code lists: size classes, fleet sectors and analysis groups."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------------------
TONNAGE_BREAKS = [25, 50, 150, 500, 1000, 2000]
LENGTH_BREAKS = [35, 45, 65, 100, 125]

# sector -> fleet description codes
SECTOR_CODES = {
    90: [90, 91, 92, 93, 94, 95, 8976, 8977, 9318, 9319, 10865, 10866, 12305, 12195],
    89: [89, 9317],
    881: [881],
    884: [884, 6875],
    885: [885, 1472],
    886: [886, 1817],
    311: [311, 1523],
    3328: [3328],
}

# (label, sectors, quarters or None for any, zones or None for any); the first match wins
GROUP_RULES = [
    ("311_Z12345_Q1234", [311], None, None),
    ("881_Z1_Q1", [881, 3328], [1], [1]),
    ("881_Z1_Q23", [881, 3328], [2, 3], [1]),
    ("881_Z1_Q4", [881, 3328], [4], [1]),
    ("881_Z2_Q1", [881, 3328], [1], [2]),
    ("881_Z2_Q2", [881, 3328], [2], [2]),
    ("881_Z2_Q3", [881, 3328], [3], [2]),
    ("881_Z2_Q4", [881, 3328], [4], [2]),
    ("881_Z3_Q1", [881, 3328], [1], [3]),
    ("881_Z3_Q234", [881, 3328], [2, 3, 4], [3]),
    ("881_Z45_Q1234", [881, 3328], [1, 2, 3, 4], [4, 5]),
    ("885_Z12345_Q1234", [885], None, None),
]
# ----------------------------------------------------------------------------------------------


def left_closed_class(value: Column, breaks: list[float]) -> Column:
    """1 below the first break, one more from each break on; null stays null."""
    known = F.when(~F.isnan(value), value)
    return reduce(add, [(known >= F.lit(float(b))).cast("int") for b in breaks], F.lit(1))


def tonnage_class(gross_tonnage: Column) -> Column:
    return left_closed_class(gross_tonnage, TONNAGE_BREAKS)


def length_class(length_overall: Column) -> Column:
    return left_closed_class(length_overall, LENGTH_BREAKS)


def sector_of(fleet_code: Column, codes: dict[int, list[int]] | None = None) -> Column:
    """Fleet description code to sector; unmapped codes give null."""
    result = None
    for sector, members in (codes or SECTOR_CODES).items():
        test = fleet_code.isin(members)
        result = F.when(test, F.lit(sector)) if result is None else result.when(test, F.lit(sector))
    return result


def assign_group(sector: Column, zone: Column, quarter: Column, rules=None) -> Column:
    """Analysis group label of a sector, zone and quarter; null where no rule applies."""
    result = None
    for label, sectors, quarters, zones in rules or GROUP_RULES:
        test = sector.isin(sectors)
        if quarters is not None:
            test = test & quarter.isin(quarters)
        if zones is not None:
            test = test & zone.isin(zones)
        result = F.when(test, F.lit(label)) if result is None else result.when(test, F.lit(label))
    return result
