"""Trip roll-up, observer coverage, tiers and analysis groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.classes import GROUP_RULES, assign_group
from ..functions.trips import observed_flag
from .attributes import TRIP_ATTRIBUTES, Attributes
from .keys import anti_by, semi_by

# --- fixed values -----------------------------------------------------------------------------
LONGLINE_GEAR = 51
TIER_SHARE = 0.2
# ----------------------------------------------------------------------------------------------

TRIP_KEYS = [
    "vr_number", "vessel_name", "licence_id", "tc", "lc", "trip_id", "landed_date", "gear_code", "q", "trip",
    "zone", "sector",
]
CELL_KEYS = ["sector", "zone", "q"]


def aggregate_trips(kept: DataFrame, exclude_gear: int | None = LONGLINE_GEAR, attributes: Attributes | None = None) -> DataFrame:
    """Weights per trip, vessel, licence, gear, quarter, zone and sector; longline left out.

    With ``attributes``, vessel names and size classes aren't columns of ``kept`` but looked up for the summed rows.
    """
    rows = kept if exclude_gear is None else kept.where(F.col("gear_code") != exclude_gear)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0e0)).alias(c)
    weights = [total("cod"), total("had"), total("pol")]
    if attributes is None:
        return rows.groupBy(*TRIP_KEYS).agg(*weights)
    narrow = [k for k in TRIP_KEYS if k not in TRIP_ATTRIBUTES]
    keys = list(dict.fromkeys([*narrow, *attributes.trip_keys(rows)]))
    return attributes.add(rows.groupBy(*keys).agg(*weights), *TRIP_ATTRIBUTES).select(*TRIP_KEYS, "cod", "had", "pol")


def coverage_cells(aggregated: DataFrame, by=tuple(CELL_KEYS)) -> DataFrame:
    """Unobserved and observed trips per cell. Coarser reports are summed up from this."""
    blank = F.col("trip") == ""
    return aggregated.groupBy(*by).agg(F.count_if(blank).alias("unobs"), F.count_if(~blank).alias("obs"))


def coverage(cells: DataFrame, *by: str) -> DataFrame:
    """Coverage at a coarser level of the cells, e.g. ``coverage(cells, "sector", "q")``."""
    return _with_coverage(cells.groupBy(*by).agg(F.sum("unobs").alias("unobs"), F.sum("obs").alias("obs")))


def _with_coverage(counts: DataFrame) -> DataFrame:
    return counts.withColumn("coverage", F.col("obs") / (F.col("obs") + F.col("unobs")))


def coverage_summary(cells: DataFrame) -> DataFrame:
    """Coverage by sector, sector and quarter, and sector, quarter and zone in one report."""
    level = (
        F.when(F.grouping("q") == 1, "sector").when(F.grouping("zone") == 1, "sector_quarter")
        .otherwise("sector_quarter_zone")
    )
    sector, q, zone = F.col("sector"), F.col("q"), F.col("zone")
    counts = cells.groupingSets([[sector], [sector, q], [sector, q, zone]], sector, q, zone).agg(
        level.alias("level"), F.sum("unobs").alias("unobs"), F.sum("obs").alias("obs")
    )
    return _with_coverage(counts)


def split_fully_covered(aggregated: DataFrame, by: str = "sector") -> tuple[DataFrame, DataFrame]:
    """``(rest, covered)``: trips of a sector whose every trip is observed are set aside.

    Sectors come from a fixed code list, so the covered ones are at most that many rows and are
    broadcast; any other ``by`` is left to the optimiser.
    """
    covered = coverage_cells(aggregated, (by,)).where("unobs = 0").select(by)
    if by == "sector":
        covered = F.broadcast(covered)
    return anti_by(aggregated, covered, by), semi_by(aggregated, covered, by)


def coverage_tiers(cells: DataFrame, keep_unknown: bool = True) -> DataFrame:
    """Tier per cell: 1 all observed, 2 enough observed, 3 needs grouping, else UK.

    2: more than a fifth and at least one observed. 3: none, or one that is at most a fifth.
    """
    share = F.col("obs") / F.col("total")
    tier = (
        F.when(F.col("obs") == F.col("total"), "1")
        .when((share > TIER_SHARE) & (F.col("obs") >= 1), "2")
        .when((F.col("obs") == 0) | ((share <= TIER_SHARE) & (F.col("obs") == 1)), "3")
        .otherwise("UK")
    )
    tiers = cells.withColumn("total", F.col("unobs") + F.col("obs")).withColumn("tier", tier)
    if not keep_unknown:
        tiers = tiers.where("tier <> 'UK'")
    keys = [c for c in cells.columns if c not in ("unobs", "obs")]
    return tiers.orderBy(*keys, "tier")


def add_group(aggregated: DataFrame, rules=None) -> DataFrame:
    """Add the analysis group label; null where no rule applies."""
    return aggregated.withColumn("analysis_group", assign_group(F.col("sector"), F.col("zone"), F.col("q"), rules or GROUP_RULES))


def ungrouped_counts(grouped: DataFrame) -> DataFrame:
    """Trips that no group rule takes, and so no estimate, per sector, observed or not."""
    return grouped.where(F.col("analysis_group").isNull()).groupBy(
        "sector", observed_flag(F.col("trip")).alias("observed")).agg(
        F.count(F.lit(1)).alias("n_trips"), F.sum("cod").alias("cod"), F.sum("had").alias("had"))


def group_landings(grouped: DataFrame) -> DataFrame:
    """Cod landings per group, unobserved and observed side by side; an absent stratum is null."""
    observed = observed_flag(F.col("trip"))
    return grouped.groupBy("analysis_group").agg(
        F.sum(F.when(observed == 0, F.col("cod"))).alias("unobsland_kg"),
        F.sum(F.when(observed == 1, F.col("cod"))).alias("obsland_kg"),
    )
