"""Landings per fishing set, species as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classes import length_class, sector_of, tonnage_class
from ..functions.dates import in_years
from ..functions.positions import decode_packed
from ..functions.trips import blank_to_empty
from ..sources.tables import LandingTables
from .attributes import area_keys

# --- fixed values -----------------------------------------------------------------------------
SPECIES = {"cod": 100, "had": 110, "pol": 170}
AREA_IDS = [198, 199, 200, 201, 202, 203, 204, 205]
TRIP_CODE_FIELD = 741  # the document field holding the observer trip code
# ----------------------------------------------------------------------------------------------

SET_KEYS = [
    "vr_number_fishing", "trip_id", "landed_date", "log_efrt_std_info_id", "date_fished", "gear_code",
    "nafo_unit_area_id", "latitude", "longitude", "licence_id", "sflt_desc_id", "mon_doc_id",
]


def quota_lookup(tables: LandingTables) -> DataFrame:
    """Licence quota to fleet description code. The fleet quota only has to exist."""
    return (
        tables.lic_quotas.select("lic_quota_id", "sflt_quota_id")
        .join(tables.sflt_quotas.select("sflt_quota_id", "sflt_desc_id", "fleet_quota_id"), "sflt_quota_id")
        .join(tables.fleet_quotas.select("fleet_quota_id"), "fleet_quota_id", "left_semi")
        .select("lic_quota_id", "sflt_desc_id")
    )


def landings_by_set(tables: LandingTables, years, areas=None) -> DataFrame:
    """Cod, haddock and pollock weights of each set, on the fact table's own narrow keys.

    Areas are told apart by name: ids that share one are replaced by the smallest of them before the sum. For all
    lookups Catalyst and AQE choose the join from their sizes.
    """
    quotas = quota_lookup(tables)
    return _sum_again(landings_by_quota(tables, years, areas).join(quotas, "lic_quota_id"), SET_KEYS)


def _sum_again(sums: DataFrame, keys: list[str]) -> DataFrame:
    """Sums over ``keys``, laid out by vessel: lookups and matches by vessel that follow need no move of their own."""
    return sums.repartition("vr_number_fishing").groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SPECIES])


def landings_by_quota(tables: LandingTables, years, areas=None) -> DataFrame:
    """As :func:`landings_by_set`, for each licence quota instead of each fleet: summed before anything is looked up but areas."""
    fact = tables.pro_spc_info
    area_ids = list(areas or AREA_IDS)
    weights = [
        F.sum(F.when(F.col("species_code") == code, F.col("rnd_weight_kgs")).otherwise(F.lit(0e0))).alias(name)
        for name, code in SPECIES.items()
    ]
    keys = area_keys(tables, area_ids).select(F.col("area_id").alias("nafo_unit_area_id"), "area_key")
    return (
        fact.where(in_years(fact, "landed_date", years) & F.col("nafo_unit_area_id").isin(area_ids))
        .join(keys, "nafo_unit_area_id")
        .withColumn("nafo_unit_area_id", F.col("area_key"))
        .groupBy(*[k for k in SET_KEYS if k != "sflt_desc_id"], "lic_quota_id")
        .agg(*weights)
    )


def landings_crosstab(tables: LandingTables, years, areas=None) -> DataFrame:
    """Set-level landings with cod, haddock and pollock weights as columns.

    Names, sizes and descriptions are looked up after the sum, so they never travel through its shuffle.
    """
    vessels = tables.vessels.select(F.col("vr_number").alias("vr_number_fishing"), "vessel_name", "gross_tonnage", "loa")
    names = area_keys(tables, list(areas or AREA_IDS)).select(F.col("area_key").alias("nafo_unit_area_id"), "area").distinct()
    return (
        landings_by_set(tables, years, areas).join(vessels, "vr_number_fishing")
        .join(names, "nafo_unit_area_id")
        .join(tables.sflt_descs.select("sflt_desc_id", "desc_eng"), "sflt_desc_id")
    )


def trip_codes(tables: LandingTables) -> DataFrame:
    """Observer trip code entered on each landing document."""
    return (
        tables.mon_doc_entrd_dets.where(F.col("column_defn_id") == TRIP_CODE_FIELD)
        .select("mon_doc_id", "data_value")
    )


def add_dates(df: DataFrame) -> DataFrame:
    """Year, month and quarter."""
    return df.withColumns({"year": F.year("landed_date"), "month": F.month("landed_date"), "q": F.quarter("landed_date")})


def add_classes(df: DataFrame) -> DataFrame:
    """Year, month, quarter, tonnage class and length class."""
    return add_dates(df).withColumns({"tc": tonnage_class(F.col("gross_tonnage")), "lc": length_class(F.col("loa"))})


def landings(tables: LandingTables, years, areas=None, documents: str = "left") -> DataFrame:
    """Landings per set with trip code, classes and decimal position.

    ``documents="left"`` keeps landings without an entered trip code (they become blank);
    ``"inner"`` drops them. ``years`` is a year or an inclusive ``(first, last)``.
    """
    coded = landings_crosstab(tables, years, areas).join(trip_codes(tables), "mon_doc_id", documents)
    ids, measures = _set_columns()
    return add_classes(coded).select(
        F.col("vr_number_fishing").alias("vr_number"), "vessel_name", *ids, "area", "desc_eng", "gross_tonnage", "loa",
        *measures, "tc", "lc",
    )


def narrow_landings(tables: LandingTables, years, areas=None, documents: str = "left") -> DataFrame:
    """The rows of :func:`landings` as ids, dates, positions and weights, with no text but the trip code.

    What describes them is added later by :func:`.attributes.landing_attributes`, by vessel, ``area_id`` and fleet. As
    there, a landing of an unlisted vessel or fleet is left out.

    A document's code is looked up ahead of the last sum, once for each different code with the number of its entries,
    which repeat the summed row. So what is left to do by vessel, here and in :func:`.reconcile.reconcile`, follows one move.
    """
    vessels = tables.vessels.select(F.col("vr_number").alias("vr_number_fishing"))
    codes = trip_codes(tables).repartition("mon_doc_id").groupBy("mon_doc_id", "data_value").agg(F.count(F.lit(1)).alias("entries"))
    fleets = quota_lookup(tables).join(tables.sflt_descs.select("sflt_desc_id"), "sflt_desc_id", "left_semi")
    sums = landings_by_quota(tables, years, areas).join(codes, "mon_doc_id", documents).join(fleets, "lic_quota_id")
    coded = _sum_again(sums, [*SET_KEYS, "data_value", "entries"]).join(vessels, "vr_number_fishing", "left_semi")
    coded = coded.withColumn("entry", F.explode(F.sequence(F.lit(1), F.coalesce("entries", F.lit(1)).cast("int"))))
    ids, measures = _set_columns()
    return add_dates(coded).select(
        F.col("vr_number_fishing").alias("vr_number"), *ids, F.col("nafo_unit_area_id").alias("area_id"), *measures)


def _set_columns() -> tuple[list[Column | str], list[Column | str]]:
    """The ids and codes of a set, and its position, date parts and weights."""
    ids = [
        "licence_id", "trip_id", F.col("log_efrt_std_info_id").alias("set_id"),
        F.to_date("landed_date").alias("landed_date"), F.to_date("date_fished").alias("date_fished"),
        blank_to_empty(F.col("data_value")).alias("trip"), "gear_code", "sflt_desc_id", "mon_doc_id",
    ]
    measures = [
        decode_packed(F.col("latitude")).alias("lat"), decode_packed(F.col("longitude"), -1).alias("lon"),
        "year", "month", "q", *SPECIES,
    ]
    return ids, measures


def assign_sector(landings: DataFrame, codes: dict[int, list[int]] | None = None) -> DataFrame:
    """Add the fleet sector of each landing; null for a code that no sector lists."""
    return landings.withColumn("sector", sector_of(F.col("sflt_desc_id"), codes))
