"""Remove trips and sets that are out of scope, each with its reason."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.weights import COD_HAD_THRESHOLD, cod_had_ratio, pollock_dominant, zero_if_null
from ..session import materialize
from .keys import left_join_on_trip

# --- fixed values -----------------------------------------------------------------------------
NONCOMMERCIAL_SET_CODE = 7
NO_PANEL_FEATURE = 89
TARGET_SPECIES = [10, 11]
# ----------------------------------------------------------------------------------------------

# Reasons in the order in which they are applied; a row keeps the first.
ZONE_UNRESOLVED, ZONE_INVALID = "zone_unresolved", "zone_invalid"
NONCOMMERCIAL, NO_PANEL, OTHER_SOUGHT = "noncommercial", "no_panel", "other_species_sought"
COD_TRIP, COD_LAST_SET, POLLOCK = "cod_directed_trip", "cod_directed_last_set", "pollock_directed"


# Trips flagged by observer data ----------------------------------------------------------------

def noncommercial_trips(observer: DataFrame) -> DataFrame:
    return observer.where(F.col("setcd_id") == NONCOMMERCIAL_SET_CODE).select("trip")


def no_panel_trips(panels: DataFrame) -> DataFrame:
    return panels.where(F.col("gearfcd_id") == NO_PANEL_FEATURE).select("trip")


def other_sought_trips(sought: DataFrame, target=None) -> DataFrame:
    """Trips with any set that sought another species; a null species flags nothing."""
    return sought.where(~F.col("specscd_id").isin(list(target or TARGET_SPECIES))).select("trip")


def mark_trips(df: DataFrame, flagged: DataFrame) -> DataFrame:
    """Add ``removed``: the row's trip is flagged. One join, blank trips salted by the other columns."""
    marker = flagged.select("trip").distinct().withColumn("removed", F.lit(True))
    spread = [c for c in df.columns if c != "trip"] or ["trip"]
    return left_join_on_trip(df, marker, *spread).withColumn("removed", F.coalesce("removed", F.lit(False)))


def _split(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    return marked.where(~F.col("removed")).drop("removed"), marked.where("removed").drop("removed")


def remove_noncommercial(df: DataFrame, observer: DataFrame) -> tuple[DataFrame, DataFrame]:
    return _split(mark_trips(df, noncommercial_trips(observer)))


def remove_no_panel(df: DataFrame, panels: DataFrame) -> tuple[DataFrame, DataFrame]:
    return _split(mark_trips(df, no_panel_trips(panels)))


def remove_other_sought(df: DataFrame, sought: DataFrame) -> tuple[DataFrame, DataFrame]:
    return _split(mark_trips(df, other_sought_trips(sought)))


def trip_reasons(observer: DataFrame, panels: DataFrame, sought: DataFrame, target=None) -> DataFrame:
    """One row per flagged trip with the first reason that applies."""
    flagged = [noncommercial_trips(observer), no_panel_trips(panels), other_sought_trips(sought, target)]
    ranked = [trips.select("trip", F.lit(rank).alias("rank")) for rank, trips in enumerate(flagged)]
    reason = F.when(F.col("rank") == 0, NONCOMMERCIAL).when(F.col("rank") == 1, NO_PANEL).otherwise(OTHER_SOUGHT)
    return (
        reduce(DataFrame.unionByName, ranked)
        .groupBy("trip").agg(F.min("rank").alias("rank"))
        .select("trip", reason.alias("trip_reason"))
    )


# Cod-directed trips and sets -------------------------------------------------------------------

def add_cod_had_verdict(df: DataFrame, threshold: float = COD_HAD_THRESHOLD) -> DataFrame:
    """Add ``codhad_ratio`` and ``met`` (ratio below the threshold); both null for 0/0."""
    ratio = cod_had_ratio(zero_if_null(F.col("cod")), zero_if_null(F.col("had")))
    return df.withColumn("codhad_ratio", ratio).withColumn("met", F.col("codhad_ratio") < F.lit(threshold))


def trip_verdicts(verdicts: DataFrame, threshold: float = COD_HAD_THRESHOLD) -> DataFrame:
    """Per trip: whether every set failed, and the id of its last set if that one fails.

    Takes the output of :func:`add_cod_had_verdict`. A trip is all-fail when no set is met or
    undefined. The last set counts only in the other trips, and only if some set of the trip is
    above the threshold; a ratio equal to it is not met but does not count as above. A last set
    of several rows fails if all of them do.

    The last id and the last id that doesn't fail are two maxima, so that the pass is a hash
    aggregation over fixed-width values, combined before the shuffle, for ids of any size.
    """
    failed = F.coalesce(~F.col("met"), F.lit(False))
    last_fails = F.col("last_passing").isNull() | (F.col("last_passing") < F.col("last"))
    return (
        verdicts.groupBy("trip_id")
        .agg(
            F.bool_and(failed).alias("all_failed"),
            F.bool_or(F.coalesce(F.col("codhad_ratio") > F.lit(threshold), F.lit(False))).alias("any_above"),
            F.max("set_id").alias("last"),
            F.max(F.when(~failed, F.col("set_id"))).alias("last_passing"),
        )
        .select(
            "trip_id", "all_failed",
            F.when(~F.col("all_failed") & F.col("any_above") & last_fails, F.col("last")).alias("failing_last_set"),
        )
    )


def all_sets_fail_trips(verdicts: DataFrame) -> DataFrame:
    return trip_verdicts(verdicts).where("all_failed").select("trip_id")


def failing_last_sets(verdicts: DataFrame, threshold: float = COD_HAD_THRESHOLD) -> DataFrame:
    return trip_verdicts(verdicts, threshold).where(F.col("failing_last_set").isNotNull()).select(
        "trip_id", F.col("failing_last_set").alias("set_id")
    )


def remove_cod_directed(df: DataFrame, threshold: float = COD_HAD_THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """``(kept, removed)``: whole trips whose sets all fail, then failing last sets."""
    marked = mark_cod_directed(df, F.lit(True), threshold)
    return (
        marked.where(F.col("cod_reason").isNull()).drop("cod_reason"),
        marked.where(F.col("cod_reason").isNotNull()).withColumnRenamed("cod_reason", "reason"),
    )


@dataclass(frozen=True)
class CodDirected:
    """What :func:`cod_directed` found: ``trips`` that fail or whose last set does, and where else such a set occurs."""

    trips: DataFrame
    elsewhere: DataFrame


def cod_directed(df: DataFrame, in_scope: Column, threshold: float = COD_HAD_THRESHOLD) -> CodDirected:
    """The failing trips and sets among the rows in scope.

    Only the failing trips, and those with a failing last set, are kept from the per-trip pass and written out, so that
    the join sees their true size and broadcasts them when small; otherwise it shuffles on the trip id, and AQE splits a
    trip that is too large. A set id that fails as the last one of a trip fails wherever else it occurs: such pairs
    of trip and set, few if set ids are the sets' own, are found by their ids alone and written too.
    """
    verdicts = add_cod_had_verdict(df.where(in_scope).select("trip_id", "set_id", "cod", "had"), threshold)
    failing = materialize(
        trip_verdicts(verdicts, threshold).where(F.col("all_failed") | F.col("failing_last_set").isNotNull()),
        "cod-directed",
    )
    trips = failing.select(F.col("trip_id").alias("f_trip_id"), F.col("all_failed").alias("f_trip"), F.col("failing_last_set").alias("f_last"))
    last_sets = trips.where(~F.col("f_trip"))
    elsewhere = materialize(
        df.where(in_scope).select("trip_id", "set_id")
        .join(last_sets, (F.col("set_id") == F.col("f_last")) & ~F.col("trip_id").eqNullSafe(F.col("f_trip_id")))
        .select(F.col("trip_id").alias("e_trip_id"), F.col("set_id").alias("e_set_id")).distinct(),
        "cod-directed-elsewhere",
    )
    return CodDirected(trips, elsewhere)


def mark_cod_directed(df: DataFrame, in_scope: Column, threshold: float = COD_HAD_THRESHOLD, found: CodDirected | None = None) -> DataFrame:
    """Add ``cod_reason`` to the rows in scope; the others pass through with null. ``found``, see :func:`cod_directed`, if it is there already."""
    found = found or cod_directed(df, in_scope, threshold)
    elsewhere = found.elsewhere.withColumn("f_elsewhere", F.lit(True))
    last = F.coalesce(F.col("set_id") == F.col("f_last"), F.lit(False)) | F.col("f_elsewhere").isNotNull()
    reason = F.when(in_scope & F.col("f_trip"), COD_TRIP).when(in_scope & last, COD_LAST_SET)
    return (
        df.join(found.trips, F.col("trip_id").eqNullSafe(F.col("f_trip_id")), "left")
        .join(elsewhere, F.col("trip_id").eqNullSafe(F.col("e_trip_id")) & (F.col("set_id") == F.col("e_set_id")), "left")
        .withColumn("cod_reason", reason)
        .drop("f_trip_id", "f_trip", "f_last", "e_trip_id", "e_set_id", "f_elsewhere")
    )


def trip_set_listing(verdicts: DataFrame, threshold: float = COD_HAD_THRESHOLD) -> DataFrame:
    """Sets of the trips whose last set fails, to check that failing sets come only last.

    One row per set, in trip and set order (sorting a partition at a time, so a trip of any length
    can be listed). ``is_last`` marks the last set id of the trip. A null trip is a trip. The
    verdicts are written first, as they are read twice.
    """
    verdicts = materialize(verdicts.select("trip_id", "set_id", "codhad_ratio", "met"), "verdicts")
    last = failing_last_sets(verdicts, threshold).select(F.col("trip_id").alias("last_trip_id"), F.col("set_id").alias("last_set_id"))
    return (
        verdicts.join(last, F.col("trip_id").eqNullSafe(F.col("last_trip_id")))
        .select("trip_id", "set_id", "codhad_ratio", "met", (F.col("set_id") == F.col("last_set_id")).alias("is_last"))
        .orderBy("trip_id", "set_id")
    )


def early_failing_sets(verdicts: DataFrame, threshold: float = COD_HAD_THRESHOLD) -> DataFrame:
    """Per trip with a failing last set: number of sets, and of failing sets that are not last."""
    return (
        trip_set_listing(verdicts, threshold).groupBy("trip_id")
        .agg(F.count(F.lit(1)).alias("n_sets"),
             F.count_if(~F.col("met") & ~F.coalesce("is_last", F.lit(False))).alias("n_failing_before_last"))
    )


def remove_pollock_directed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(kept, removed)``: sets with more pollock than cod and haddock together."""
    test = pollock_dominant(*[zero_if_null(F.col(c)) for c in ("cod", "had", "pol")])
    return df.where(~test), df.where(test)


# All steps -------------------------------------------------------------------------------------

def flag_out_of_scope(zoned: DataFrame) -> DataFrame:
    """Add ``reason`` from the zone and from ``trip_reason``, see :func:`trip_reasons`.

    One column instead of a split and a union per step. Null weights in scope become 0.
    """
    zone_reason = F.when(F.col("zone").isNull(), ZONE_UNRESOLVED).when(F.col("zone") < 1, ZONE_INVALID)
    flagged = zoned.withColumn("reason", F.coalesce(zone_reason, F.col("trip_reason"))).drop("trip_reason")
    in_scope = F.col("reason").isNull()
    return flagged.withColumns({
        c: F.when(in_scope, zero_if_null(F.col(c))).otherwise(F.col(c)) for c in ("cod", "had", "pol")
    })


def directed(flagged: DataFrame, threshold: float = COD_HAD_THRESHOLD) -> CodDirected:
    """The failing trips and sets among the rows without a reason, for :func:`flag_directed` and :func:`kept_directed`."""
    return cod_directed(flagged, F.col("reason").isNull(), threshold)


def flag_directed(flagged: DataFrame, threshold: float = COD_HAD_THRESHOLD, found: CodDirected | None = None) -> DataFrame:
    """Add the reasons that depend on the catch. ``flagged`` is read several times; pass a written table."""
    marked = mark_cod_directed(flagged, F.col("reason").isNull(), threshold, found)
    return marked.withColumn("reason", F.coalesce("reason", "cod_reason", F.when(_pollock(), POLLOCK))).drop("cod_reason")


def kept_directed(flagged: DataFrame, threshold: float = COD_HAD_THRESHOLD, found: CodDirected | None = None) -> DataFrame:
    """``kept(flag_directed(flagged))``: rows with a reason of their own leave before the rest meets the failing trips."""
    found = found or directed(flagged, threshold)
    rows = flagged.where(F.col("reason").isNull() & ~F.coalesce(_pollock(), F.lit(False)))
    marked = mark_cod_directed(rows, F.lit(True), threshold, found)
    return marked.where(F.col("cod_reason").isNull()).drop("cod_reason", "reason")


def _pollock() -> Column:
    return pollock_dominant(F.col("cod"), F.col("had"), F.col("pol"))


def kept(cleaned: DataFrame) -> DataFrame:
    return cleaned.where(F.col("reason").isNull()).drop("reason")


def removed_audit(cleaned: DataFrame) -> DataFrame:
    return cleaned.where(F.col("reason").isNotNull())


__all__ = [
    "noncommercial_trips", "no_panel_trips", "other_sought_trips", "mark_trips", "remove_noncommercial", "remove_no_panel",
    "remove_other_sought", "trip_reasons", "add_cod_had_verdict", "trip_verdicts", "all_sets_fail_trips",
    "failing_last_sets", "remove_cod_directed", "CodDirected", "cod_directed", "mark_cod_directed", "trip_set_listing",
    "early_failing_sets", "remove_pollock_directed", "flag_out_of_scope", "directed", "flag_directed", "kept_directed", "kept",
    "removed_audit",
]
