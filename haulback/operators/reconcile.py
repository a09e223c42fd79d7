"""Reconcile landings with observer trips on vessel and landed date.

Whether and to what a landing matches depends only on its vessel and landed date. So the matching
is worked out on the small observer side, as one table keyed by (vessel, date), and the landings
are joined to it once. A tolerance of a few days is unrolled into days there, which makes the
interval join an equi-join on two keys: one busy vessel spreads over its dates, and no pair of rows
is ever compared only to be discarded. A longer tolerance would repeat each observer row too often;
there the days that have landings meet the observer rows in bins of dates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.trips import blank_to_empty
from .keys import semi_by

TOLERANCE_DAYS = 2
MATCH_KEYS = ["vr_number", "landed_date"]

#: The longest tolerance that is unrolled: up to 15 copies of an observer row. Both ways give the same rows.
MOST_UNROLLED_DAYS = 7


def first_per_vessel_day(observer: DataFrame) -> DataFrame:
    """The first observer row of each vessel and landing date, in trip, set code, gear order.

    A minimum of structs: combined before the shuffle, however many rows share a vessel and day.
    """
    return (
        observer.groupBy("vr_number", F.col("landing_date").alias("landed_date"))
        .agg(F.min(F.struct("trip", "setcd_id", "gearcd_id")).alias("first"))
        .select(*MATCH_KEYS, F.col("first.trip").alias("obs_trip"),
                F.col("first.setcd_id").alias("setcd_id"), F.col("first.gearcd_id").alias("gearcd_id"))
    )


def unroll_days(observer: DataFrame, tolerance_days: int = TOLERANCE_DAYS) -> DataFrame:
    """Each observer row once per landed date it can match, with the distance in days.

    Rows without vessel or date match nothing here.
    """
    return (
        observer.where(F.col("vr_number").isNotNull() & F.col("landing_date").isNotNull())
        .withColumn("offset", F.explode(F.sequence(F.lit(-tolerance_days), F.lit(tolerance_days))))
        .withColumn("landed_date", F.date_add("landing_date", F.col("offset")))
        .withColumn("days_off", F.abs("offset"))
    )


def in_bins(observer: DataFrame, tolerance_days: int) -> DataFrame:
    """Each observer row in the one or two bins of dates that its reach touches, whatever the tolerance.

    A bin is as long as the reach: the tolerance before and after, and the day itself.
    """
    reach = [F.floor((F.unix_date("landing_date") + F.lit(d)) / F.lit(2 * tolerance_days + 1)) for d in (-tolerance_days, tolerance_days)]
    return (
        observer.where(F.col("vr_number").isNotNull() & F.col("landing_date").isNotNull())
        .withColumn("bin", F.explode(F.sequence(*reach)))
    )


def landed_days(landings: DataFrame) -> DataFrame:
    """The vessels and days that have landings, each once."""
    return landings.select(*MATCH_KEYS).distinct()


def near_landed_days(observer: DataFrame, days: DataFrame, tolerance_days: int) -> DataFrame:
    """As :func:`unroll_days`, for the landed ``days`` (vr_number, landed_date) only, each listed once.

    A range join as an equi-join: a day lies in one bin, so no pair is met twice, and at least about
    half of the pairs within a bin are in reach.
    """
    day_bin = F.floor(F.unix_date("landed_date") / F.lit(2 * tolerance_days + 1))
    return (
        in_bins(observer, tolerance_days)
        .join(days.withColumn("bin", day_bin), ["vr_number", "bin"])
        .withColumn("days_off", F.abs(F.date_diff("landed_date", "landing_date")))
        .where(F.col("days_off") <= tolerance_days)
    )


def match_table(observer: DataFrame, tolerance_days: int = TOLERANCE_DAYS, one_match: bool = False,
                days: DataFrame | None = None, by_vessel: bool = False) -> DataFrame:
    """``(vr_number, landed_date, obs_trip, match)`` for every vessel and day that can match.

    With the landed ``days`` (vr_number, landed_date), interval matches are found for these only.

    A vessel and day with an observer landing on that very day matches its first row ("exact").
    Any other day within the tolerance matches every observer row in reach ("interval"), or with
    ``one_match`` only the nearest, ties by trip, set code and gear.

    ``by_vessel`` lays the observer rows out by vessel before they are unrolled into days, for landings that are laid out
    so; written with ``keep_layout``, see :func:`..session.materialize`, nothing after that moves.
    """
    coded = observer.where(F.col("trip").isNotNull())
    if by_vessel:
        coded = coded.repartition("vr_number")
    exact = first_per_vessel_day(coded).select(*MATCH_KEYS, "obs_trip", F.lit("exact").alias("match"))
    reached = unroll_days(coded, tolerance_days) if days is None else near_landed_days(coded, days, tolerance_days)
    near = reached.where("days_off > 0").join(exact, MATCH_KEYS, "left_anti")
    if one_match:
        near = (
            near.groupBy(*MATCH_KEYS)
            .agg(F.min(F.struct("days_off", "trip", "setcd_id", "gearcd_id")).alias("nearest"))
            .select(*MATCH_KEYS, F.col("nearest.trip").alias("trip"))
        )
    near = near.select(*MATCH_KEYS, F.col("trip").alias("obs_trip"), F.lit("interval").alias("match"))
    return exact.unionByName(near)


def reconcile(landings: DataFrame, observer: DataFrame, tolerance_days: int = TOLERANCE_DAYS,
              trust_observer: bool = True, one_match: bool = False, days: DataFrame | None = None,
              null_keys: bool = True) -> DataFrame:
    """Landings with ``obs_trip``, ``match``, ``status`` and the corrected ``trip``.

    The entered code stays in ``landed_trip``. ``status`` is agree, missing, incorrect, unobserved
    or not_in_observer. With ``trust_observer`` the observer's code replaces a differing one,
    otherwise it only fills a blank. Without ``one_match`` a landing appears once per observer row
    it matches within the tolerance. A tolerance above ``MOST_UNROLLED_DAYS`` needs the landed days,
    see :func:`landed_days`; unless given, they are taken from the landings, which are then read twice.

    A null vessel or date matches the observer's null. Landings that have neither, as those of
    :func:`.landings.narrow_landings`, say so by ``null_keys=False``: laid out by vessel, they needn't be moved where the
    table is written with ``keep_layout``, see :func:`..session.materialize`.
    """
    if tolerance_days <= MOST_UNROLLED_DAYS:
        days = None
    elif days is None:
        days = landed_days(landings)
    table = match_table(observer, tolerance_days, one_match, days, by_vessel=not null_keys)
    same = lambda k: F.col(f"l.{k}").eqNullSafe(F.col(f"m.{k}")) if null_keys else F.col(f"l.{k}") == F.col(f"m.{k}")
    joined = landings.withColumn("trip", blank_to_empty(F.col("trip"))).alias("l").join(
        table.alias("m"), same("vr_number") & same("landed_date"), "left",
    ).select("l.*", "m.obs_trip", F.coalesce("m.match", F.lit("none")).alias("match"))
    blank = F.col("trip") == ""
    status = (
        F.when((F.col("match") == "none") & blank, "unobserved")
        .when(F.col("match") == "none", "not_in_observer")
        .when(F.col("trip") == F.col("obs_trip"), "agree")
        .when(blank, "missing")
        .otherwise("incorrect")
    )
    replace = F.col("status").isin("missing", "incorrect") if trust_observer else F.col("status") == "missing"
    return (
        joined.withColumn("status", status)
        .withColumn("landed_trip", F.col("trip"))
        .withColumn("trip", F.when(replace, F.col("obs_trip")).otherwise(F.col("trip")))
    )


def landing_errors(reconciled: DataFrame) -> DataFrame:
    """Landings whose entered code differs from the observer's, with a comment."""
    return (
        reconciled.where(F.col("status").isin("missing", "incorrect"))
        .withColumn("comment", F.when(F.col("landed_trip") == "", "landing trip missing").otherwise("landing trip incorrect"))
    )


def landing_error_list(reconciled: DataFrame) -> DataFrame:
    """Those landings as they are handed on, both kinds in one list."""
    return landing_errors(reconciled).select(
        "vr_number", "trip_id", "set_id", "landed_date", F.col("landed_trip").alias("trip"), "obs_trip", "comment")


def landing_errors_missing(reconciled: DataFrame) -> DataFrame:
    """Observed trips without an entered code, once each."""
    return _error_list(reconciled, "missing").distinct()


def landing_errors_incorrect(reconciled: DataFrame) -> DataFrame:
    """Landings with another code than the observer's."""
    return _error_list(reconciled, "incorrect")


def _error_list(reconciled: DataFrame, status: str) -> DataFrame:
    return reconciled.where(F.col("status") == status).select(
        "vr_number", "trip_id", "landed_date", F.col("landed_trip").alias("trip"), "obs_trip"
    )


def observer_check(observer: DataFrame, incorrect: DataFrame) -> DataFrame:
    """Observer rows whose trip is named by an incorrect landing."""
    named = incorrect.select(F.col("obs_trip").alias("trip"))
    return semi_by(observer, named, "trip").select("vr_number", "trip", "landing_date")


def observer_missing(reconciled: DataFrame) -> DataFrame:
    """Trips with an entered code that the observer data do not hold."""
    return (
        reconciled.where(F.col("status") == "not_in_observer")
        .select("vr_number", "trip_id", "landed_date", "trip").distinct()
    )
