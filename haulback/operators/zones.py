"""Zones by position: point-in-polygon, vessel positions, and the fallback chain."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.zones import MOST_EDGES, ZoneIndex, inside, zone_index

#: Vessel numbers of 8 bytes that may be broadcast.
MOST_SENT_VESSELS = 1_000_000


def identify_zone(df: DataFrame, zones: DataFrame, lat: str = "lat", lon: str = "lon", zone: str = "zone",
                  most_edges: int = MOST_EDGES) -> DataFrame:
    """Add the id of the zone holding each position; null outside all zones or without position.

    Planar even-odd test. Overlapping zones give the lowest id, so that no row is repeated. ``zones``
    is the edges of :func:`..sources.zones.zones_from_vertices`; rows keep their number.
    """
    return _locate(df, zone_index(zones, most_edges), lat, lon, zone)


def _locate(df: DataFrame, index: ZoneIndex, lat: str, lon: str, zone: str) -> DataFrame:
    """A position probes the leaves' keys at each level that has leaves, and one is met; then it meets that leaf's edges."""
    leaf = F.struct("level", "ix", "iy")
    keys = index.leaves.select(leaf.alias("_leaf"), F.lit(True).alias("_met"))
    edges = index.leaves.select(leaf.alias("_leaf"), "candidates")
    at = (
        df.withColumn("_leaf", F.explode(index.keys(lon, lat))).join(keys, "_leaf", "left")
        .where("_met or _leaf is null")
    )
    right = index.right_of(F.col("_leaf.level"), F.col("_leaf.ix"))
    held = F.filter("candidates", lambda c: inside(c, F.col("_right"), F.col(lon), F.col(lat)))
    return (
        at.join(edges, "_leaf", "left").withColumn("_right", right)
        .withColumn(zone, F.array_min(F.transform(held, lambda c: c.zone_id)))
        .drop("_leaf", "_met", "candidates", "_right")
    )


def fleet_trips(trips: DataFrame, fleet: str, stock: str, start: str, end: str) -> DataFrame:
    """Trips of one fleet type and stock landed between two dates, both included."""
    kind = trips.select("landed_date").schema[0].dataType
    return trips.where(
        (F.col("fleet") == fleet) & (F.col("stock") == stock)
        & F.col("landed_date").between(F.lit(start).cast(kind), F.lit(end).cast(kind))
    )


def fleet_positions(positions: DataFrame, *fleets: DataFrame) -> DataFrame:
    """Positions of the vessels of one or more fleets, fleet after fleet as in a UNION ALL."""
    parts = [positions.join(trips.select("vr_number"), "vr_number", "left_semi") for trips in fleets]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def positions_between(positions: DataFrame, days: DataFrame) -> DataFrame:
    """Positions from the first to the last ``date`` of ``days``: a range of the raw timestamp, so that it reaches the scan."""
    first, last = days.agg(F.min("date"), F.max("date")).first()
    if first is None:
        return positions.where(F.lit(False))
    kind = positions.schema["position_utc_date"].dataType
    bound = lambda day: F.lit(f"{day.isoformat()} 00:00:00").cast(kind)
    return positions.where(
        (F.col("position_utc_date") >= bound(first)) & (F.col("position_utc_date") < bound(last + dt.timedelta(days=1)))
    )


def vessel_day_mean_position(positions: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Mean position per vessel and UTC day, of the ``wanted`` vessel-days (vr_number, date) if given.

    Averaged before the join with the vessel-days: the partial averages shrink the position track ahead of the
    shuffle. Where the vessel-days are few enough to broadcast, Catalyst moves that join below the average by itself.
    Where they aren't, their vessels mostly still are, one number each: up to ``MOST_SENT_VESSELS`` of them are
    broadcast and cut the track at its scan. Beyond that the track is only averaged; the raw positions are never
    shuffled. ``wanted`` is read three times; pass a written table.
    """
    if wanted is not None:
        vessels = wanted.select("vr_number").distinct()
        if vessels.count() <= MOST_SENT_VESSELS:
            positions = positions.join(F.broadcast(vessels), "vr_number", "left_semi")
    days = (
        positions.groupBy("vr_number", F.to_date("position_utc_date").alias("date"))
        .agg(F.avg("latitude").alias("mean_lat"), F.avg("longitude").alias("mean_lon"))
    )
    return days if wanted is None else days.join(wanted, ["vr_number", "date"], "left_semi")


def parse_positions(raw: DataFrame) -> DataFrame:
    """Position track with text timestamps (year/month/day h:m:s) parsed."""
    return raw.withColumn("position_utc_date", F.try_to_timestamp("position_utc_date", F.lit("yyyy/MM/dd HH:mm:ss")))


def observer_position(observer: DataFrame) -> DataFrame:
    """One position per trip, that of its lowest gear and set code."""
    return (
        observer.groupBy("trip")
        .agg(F.min(F.struct("gearcd_id", "setcd_id", "lat2", "lon2")).alias("p"))
        .select("trip", F.col("p.lat2").alias("lat2"), F.col("p.lon2").alias("lon2"))
    )


def report_zone(landings: DataFrame, zones: DataFrame | ZoneIndex) -> DataFrame:
    """Add ``zone_reported``, the zone of the reported position, for :func:`assign_zone`."""
    return _locate(landings, _index(zones), "lat", "lon", "zone_reported")


def _index(zones: DataFrame | ZoneIndex) -> ZoneIndex:
    return zones if isinstance(zones, ZoneIndex) else zone_index(zones)


def assign_zone(landings: DataFrame, zones: DataFrame | ZoneIndex, observer: DataFrame, positions: DataFrame,
                per_trip: DataFrame | None = None) -> DataFrame:
    """Add ``zone`` and ``zone_source``: reported position, else observer's, else vessel track's.

    Observed landings fall back on their trip's observer position, unobserved ones on the
    vessel's mean position on the day fished. Both fallbacks are turned into zones at their own
    grain, one test per trip or vessel-day instead of one per landing. Observed landings meet the
    trips, unobserved ones without a reported zone the vessel-days; all others stay where they are.
    ``per_trip``, one row per trip, is brought along by the join on the trip code: its columns are
    added too, without moving the landings once more.

    ``landings`` with ``zone_reported``, see :func:`report_zone`, is read several times; pass a written
    table. Without it, they are located and written here. Before the rest, the vessel-days that need the
    track are collected from it into a narrow table: their first and last date bound the scan of
    the positions, and only their vessel-days are averaged. The written index serves three joins.
    """
    index = _index(zones)
    if "zone_reported" not in landings.columns:
        landings = materialize(report_zone(landings, index), "located")
    per_obs = _locate(observer_position(observer), index, "lat2", "lon2", "zone_obs").select("trip", "zone_obs")
    brought = [] if per_trip is None else [c for c in per_trip.columns if c != "trip"]
    if per_trip is not None:
        per_obs = per_obs.join(per_trip, "trip", "full")
    observed = F.coalesce(F.col("trip") != "", F.lit(False))
    lacking = ~observed & F.col("zone_reported").isNull() & F.col("vr_number").isNotNull() & F.col("date_fished").isNotNull()
    blank = (F.col("trip") == "") & lacking  # a null trip has no fallback
    wanted = materialize(
        landings.where(blank).select("vr_number", F.col("date_fished").alias("date")).distinct(), "vessel-days")
    track = vessel_day_mean_position(positions_between(positions, wanted), wanted)
    zone_vms = (
        _locate(track, index, "mean_lat", "mean_lon", "zone_vms")
        .where(F.col("zone_vms").isNotNull())
        .select(F.col("vr_number").alias("p_vr"), F.col("date").alias("p_date"), "zone_vms")
    )
    none = {c: F.lit(None).cast(per_obs.schema[c].dataType) for c in brought}
    by_trip = landings.where(observed).join(per_obs, "trip", "left").withColumns({
        "zone": F.coalesce("zone_reported", "zone_obs"),
        "zone_source": F.when(F.col("zone_reported").isNotNull(), "reported").when(F.col("zone_obs").isNotNull(), "observer"),
    })
    by_track = landings.where(blank).join(
        zone_vms, (F.col("vr_number") == F.col("p_vr")) & (F.col("date_fished") == F.col("p_date")), "left",
    ).withColumns({**none, "zone": F.col("zone_vms"), "zone_source": F.when(F.col("zone_vms").isNotNull(), "vessel_track")})
    staying = landings.where(~observed & ~F.coalesce(blank, F.lit(False))).withColumns({
        **none, "zone": F.col("zone_reported"), "zone_source": F.when(F.col("zone_reported").isNotNull(), "reported")})
    columns = [*[c for c in landings.columns if c != "zone_reported"], *brought, "zone", "zone_source"]
    parts = [part.select(*columns) for part in (by_trip, by_track, staying)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


__all__ = [
    "identify_zone", "fleet_trips", "fleet_positions", "positions_between", "vessel_day_mean_position",
    "parse_positions",
    "observer_position", "report_zone", "assign_zone",
]
