"""Membership joins with NA semantics, and the join key that keeps blank trips spread out."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK_TRIP_SALTS = 4096


def _on(keys: list[str]) -> Column:
    return reduce(and_, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])


def _join(df: DataFrame, keys_df: DataFrame, on, how: str) -> DataFrame:
    # Distinct first: a key listed a million times is one row before it is shuffled.
    keys = [on] if isinstance(on, str) else list(on)
    return df.alias("l").join(keys_df.select(*keys).distinct().alias("r"), _on(keys), how)


def semi_by(df: DataFrame, keys_df: DataFrame, on) -> DataFrame:
    """Rows whose key is in ``keys_df``; null matches null."""
    return _join(df, keys_df, on, "left_semi")


def anti_by(df: DataFrame, keys_df: DataFrame, on) -> DataFrame:
    """Rows whose key is not in ``keys_df``; a null key is kept unless null is listed."""
    return _join(df, keys_df, on, "left_anti")


def split_by(df: DataFrame, keys_df: DataFrame, on) -> tuple[DataFrame, DataFrame]:
    """``(kept, removed)``: rows whose key is not flagged, and rows whose key is."""
    return anti_by(df, keys_df, on), semi_by(df, keys_df, on)


def left_join_on_trip(df: DataFrame, per_trip: DataFrame, *spread: str) -> DataFrame:
    """Left join of a one-row-per-trip table, with the blank trips salted.

    Most landings are unobserved and share the empty trip code. It matches nothing, but joined
    plainly it would send all of them to one partition. They get a salt from the ``spread``
    columns instead; observed trips, and all of ``per_trip``, have salt 0.
    """
    salt = F.when(F.col("trip") != "", F.lit(0)).otherwise(
        F.lit(1) + F.pmod(F.xxhash64(*spread), F.lit(BLANK_TRIP_SALTS)).cast("int")
    )
    # 0 for every code; computed, since Catalyst would fold a literal and drop it from the join keys
    right = per_trip.withColumn("trip_salt", F.when(F.length("trip") > 0, F.lit(0)).otherwise(F.lit(-1)))
    joined = df.withColumn("trip_salt", salt).join(right, ["trip", "trip_salt"], "left")
    return joined.select(*df.columns, *[c for c in per_trip.columns if c != "trip"])
