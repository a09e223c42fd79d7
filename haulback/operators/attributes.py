"""Descriptions of landings, looked up where a report or the roll-up needs them instead of being carried through the run.

The steps between the landings and the roll-up work on ids, dates, weights and the trip code. Names, sizes and size
classes are functions of a few ids, so they lie in tables of one row per key and are joined late.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classes import length_class, tonnage_class
from ..session import materialize
from ..sources.tables import LandingTables

#: Described by the roll-up's keys; the rest is for reports only.
TRIP_ATTRIBUTES = ["vessel_name", "tc", "lc"]
SET_ATTRIBUTES = ["area", "desc_eng", "gross_tonnage", "loa"]
ATTRIBUTES = TRIP_ATTRIBUTES + SET_ATTRIBUTES

#: Key columns made up for rows that came with their descriptions.
TRIP_PROFILE, SET_PROFILE = "trip_profile", "set_profile"


@dataclass(frozen=True)
class Attributes:
    """Tables of descriptions, each with the columns that are its key."""

    tables: tuple[tuple[tuple[str, ...], DataFrame], ...] = ()

    def add(self, df: DataFrame, *columns: str) -> DataFrame:
        """``df`` with the named descriptions, or with all; null keys are looked up like others.

        A row whose key isn't listed gets nulls; no row is lost or repeated. Catalyst and AQE choose the joins from
        the tables' sizes.
        """
        for keys, table in self.tables:
            asked = [c for c in table.columns if c not in keys and (not columns or c in columns)]
            if asked:
                right = table.select(*[F.col(k).alias(f"_{k}") for k in keys], *asked)
                on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
                df = df.join(right, on, "left").drop(*[f"_{k}" for k in keys])
        return df

    def widened(self, df: DataFrame) -> DataFrame:
        """``df`` with all descriptions and without the keys made up for them."""
        return self.add(df).drop(TRIP_PROFILE, SET_PROFILE)

    def trip_keys(self, df: DataFrame) -> list[str]:
        """The columns of ``df`` that stand for the descriptions among the roll-up's keys."""
        return [k for keys, table in self.tables for k in keys if k in df.columns and set(table.columns) & set(TRIP_ATTRIBUTES)]


def area_keys(tables: LandingTables, areas: list[int]) -> DataFrame:
    """Area ids with their name and the smallest id of that name, which stands for all of them."""
    return tables.areas.where(F.col("area_id").isin(areas)).select(
        "area_id", "area", F.min("area_id").over(Window.partitionBy("area")).alias("area_key"))


def landing_attributes(tables: LandingTables, areas: list[int]) -> Attributes:
    """Descriptions of the rows of :func:`.landings.narrow_landings`, from the source's own lookup tables.

    Their keys are the source's primary keys: one row each.
    """
    vessels = tables.vessels.select(
        "vr_number", "vessel_name", "gross_tonnage", "loa",
        tonnage_class(F.col("gross_tonnage")).alias("tc"), length_class(F.col("loa")).alias("lc"))
    names = area_keys(tables, areas).select(F.col("area_key").alias("area_id"), "area").distinct()
    return Attributes((
        (("vr_number",), vessels),
        (("area_id",), names),
        (("sflt_desc_id",), tables.sflt_descs.select("sflt_desc_id", "desc_eng")),
    ))


def narrowed(rows: DataFrame) -> tuple[DataFrame, Attributes]:
    """``(narrow, attributes)`` of rows that came with their descriptions, e.g. from a file.

    Each different set of descriptions of a vessel is listed once, under a 64-bit hash that stays in the rows. Rows
    are read twice; pass a written table. Should two sets of one vessel share a hash, another seed is taken, so a
    key always means one set.
    """
    narrow, tables = rows, []
    for profile, wanted in ((TRIP_PROFILE, TRIP_ATTRIBUTES), (SET_PROFILE, SET_ATTRIBUTES)):
        held = [c for c in wanted if c in rows.columns]
        if not held:
            continue
        # a null adds nothing to the hash, so each column is followed by whether it is null
        parts = [part for c in held for part in (F.col(c), F.col(c).isNull())]
        for seed in range(16):
            key = F.xxhash64(F.lit(seed), *parts)
            found = materialize(rows.select("vr_number", key.alias(profile), *held).distinct(), profile)
            if found.groupBy("vr_number", profile).count().where("count > 1").isEmpty():
                break
        else:
            raise RuntimeError(f"no seed tells the values of {held} apart")
        narrow = narrow.withColumn(profile, key).drop(*held)
        tables.append((("vr_number", profile), found))
    return narrow, Attributes(tuple(tables))
