"""Observer trips, separator panels and species sought."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import in_years
from ..session import materialize
from ..sources.tables import ObserverTables

# --- fixed values -----------------------------------------------------------------------------
AREA_PREFIX = "5Z"
EXCLUDED_GEARS = [71, 62]
PANEL_POINT, PANEL_GEAR, PANEL_FEATURES = 2, 12, [89, 90]
SOUGHT_POINTS, SOUGHT_SET_CODE = [1, 2], 1
SET_COLUMNS = ["trip_id", "gear_id", "nafarea_id", "setcd_id", "set_no", "specscd_id"]
# ----------------------------------------------------------------------------------------------


def _vessel_number(cfv="cfv"):
    """Vessel numbers are kept as text by the observer programme; anything else becomes null."""
    return F.col(cfv).try_cast("bigint")


@dataclass(frozen=True)
class AreaSets(ObserverTables):
    """Observer tables with ``profiled``: the sets of the areas with their profiles, a row for each pair."""

    profiled: DataFrame


def area_sets(tables: ObserverTables, area_prefix: str = AREA_PREFIX) -> AreaSets:
    """``tables`` with the sets cut to the areas and the listed trips, joined with their profiles and written once.

    Trips, panels and species sought each read them from there, so both tables move by set a single time. All three
    look up a set's trip, so sets of a trip that isn't listed leave before they meet their profiles.
    """
    sets = (
        tables.isfishsets.where(F.col("nafarea_id").startswith(area_prefix)).select("fishset_id", *SET_COLUMNS)
        .join(tables.istrips.select("trip_id"), "trip_id", "left_semi")
    )
    profile = tables.issetprofile.select("fishset_id", "setdate", "latitude", "longitude", "pntcd_id")
    written = materialize(sets.join(profile, "fishset_id").drop("fishset_id"), "observer-sets", compression="zstd")
    return AreaSets(**{f.name: getattr(tables, f.name) for f in fields(ObserverTables)}, profiled=written)


def _profiled(tables: ObserverTables, area_prefix: str, sets: Column, profile: Column, *columns: str, trips: DataFrame | None = None) -> DataFrame:
    """The named columns of the area's ``sets``, of ``trips`` only, with each ``profile`` row of theirs."""
    in_area = F.col("nafarea_id").startswith(area_prefix) & sets
    of_trips = lambda df: df if trips is None else df.join(trips.select("trip_id"), "trip_id", "left_semi")
    if isinstance(tables, AreaSets):
        return of_trips(tables.profiled.where(in_area & profile).select(*columns))
    of_set, of_profile = ([c for c in columns if (c in SET_COLUMNS) == held] for held in (True, False))
    return of_trips(tables.isfishsets.where(in_area).select("fishset_id", *of_set)).join(
        tables.issetprofile.where(profile).select("fishset_id", *of_profile), "fishset_id").select(*columns)


def observer_trips(tables: ObserverTables, years, area_prefix: str = AREA_PREFIX, exclude_gears=None) -> DataFrame:
    """Dates and position of observed trips, one row per trip, gear code and set code.

    Sets of other gears leave before they meet their profiles, unless :func:`area_sets` has joined them. Minima and
    maxima are first taken per trip, gear code and set code, before any name is looked up; taking them again over the
    final keys gives the same values and shuffles little.
    The position is the smallest latitude and the smallest (positive west) longitude.
    """
    profile = tables.issetprofile
    gears = tables.isgears.where(~F.col("gearcd_id").isin(list(exclude_gears or EXCLUDED_GEARS)))
    extents = lambda low, high, lat, lon: [
        F.min(low).alias("min_date"), F.max(high).alias("max_date"),
        F.min(lat).alias("lat2"), F.min(lon).alias("lon2"),
    ]
    gears = gears.select("gear_id", "gearcd_id")
    in_year = in_years(profile, "setdate", years)
    if isinstance(tables, AreaSets):
        hauls = _profiled(tables, area_prefix, F.lit(True), in_year, "trip_id", "gear_id", "setcd_id", "setdate", "latitude", "longitude").join(gears, "gear_id")
    else:
        hauls = profile.where(in_year).select("fishset_id", "setdate", "latitude", "longitude").join(
            tables.isfishsets.where(F.col("nafarea_id").startswith(area_prefix))
            .select("fishset_id", "trip_id", "gear_id", "setcd_id").join(gears, "gear_id"),
            "fishset_id",
        )
    per_gear = (
        hauls.repartition("trip_id")  # for the sums and the trips' names
        .groupBy("trip_id", "gearcd_id", "setcd_id")
        .agg(*extents("setdate", "setdate", "latitude", "longitude"))
    )
    keys = ["cfv", "vessel_name", "trip", "tripcd_id", "conf_number", "landing_date", "gearcd_id", "setcd_id"]
    named = (
        per_gear.join(tables.istrips.select("trip_id", "vess_id", "trip", "tripcd_id", "conf_number", "landing_date"), "trip_id")
        .join(tables.isvessels.select("vess_id", "cfv", "vessel_name"), "vess_id")
        .groupBy(*keys)
        .agg(*extents("min_date", "max_date", "lat2", "lon2"))
    )
    return named.select(
        _vessel_number().alias("vr_number"), "vessel_name", "trip", "tripcd_id", "conf_number",
        F.to_date("landing_date").alias("landing_date"), "min_date", "max_date",
        "gearcd_id", "setcd_id", "lat2", (-F.col("lon2")).alias("lon2"),
    )


def separator_panels(tables: ObserverTables, years, area_prefix: str = AREA_PREFIX, point: int = PANEL_POINT,
                     gear: int = PANEL_GEAR, features=None) -> DataFrame:
    """Number of sets per trip and panel feature of the separator gear.

    The year is a property of the trips, so the sets are cut down to the year's trips first.
    """
    trips = tables.istrips.where(in_years(tables.istrips, "landing_date", years))
    per_gear = (
        _profiled(tables, area_prefix, F.lit(True), F.col("pntcd_id") == point, "trip_id", "gear_id", "set_no", trips=trips)
        .groupBy("trip_id", "gear_id")
        .agg(F.count("set_no").alias("n"))
    )
    gears = (
        tables.isgears.where(F.col("gearcd_id") == gear).select("gear_id", "gearcd_id")
        .join(tables.isgearfeatures.where(F.col("gearfcd_id").isin(list(features or PANEL_FEATURES)))
              .select("gear_id", "gearfcd_id"), "gear_id")
    )
    return (
        per_gear.join(gears, "gear_id")
        .join(trips.select("trip_id", "vess_id", "trip", "landing_date"), "trip_id")
        .join(tables.isvessels.select("vess_id", "cfv", "vessel_name"), "vess_id")
        .groupBy("cfv", "vessel_name", "trip", "landing_date", "gearcd_id", "gearfcd_id")
        .agg(F.sum("n").alias("n_sets"))
    )


def sought_species(tables: ObserverTables, years, area_prefix: str = AREA_PREFIX, points=None,
                   set_code: int = SOUGHT_SET_CODE) -> DataFrame:
    """Distinct species sought per trip, gear, set and set date; the sets of the year's trips only, from the start."""
    trips = tables.istrips.where(in_years(tables.istrips, "landing_date", years))
    wanted = F.col("pntcd_id").isin(list(points or SOUGHT_POINTS))
    sets = _profiled(tables, area_prefix, F.col("setcd_id") == set_code, wanted, "trip_id", "gear_id", "specscd_id", "set_no", "setdate", trips=trips)
    return (
        sets.join(tables.isgears.select("gear_id", "gearcd_id"), "gear_id")
        .join(trips.select("trip_id", "vess_id", "trip", "landing_date"), "trip_id")
        .join(tables.isvessels.select("vess_id", "cfv", "vessel_name"), "vess_id")
        .select("cfv", "vessel_name", "trip", "gearcd_id", "landing_date", "specscd_id", "set_no", "setdate")
        .distinct()
    )
