"""The relational inputs, as named DataFrames.

Column names are those of the source databases (Spark matches them without regard to case), so a
Parquet export or a JDBC read of each table can be passed as it is. Only the landing confirmation
number of ``istrips`` has to be renamed, to ``conf_number``.
"""

from __future__ import annotations

from dataclasses import dataclass, fields
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class LandingTables:
    """Landings database: one fact table, seven lookups."""

    pro_spc_info: DataFrame  # species weight per fishing set
    vessels: DataFrame
    areas: DataFrame
    sflt_descs: DataFrame
    sflt_quotas: DataFrame
    fleet_quotas: DataFrame
    lic_quotas: DataFrame
    mon_doc_entrd_dets: DataFrame  # entered document fields, one row per document and field


@dataclass(frozen=True)
class ObserverTables:
    """At-sea observer database."""

    isvessels: DataFrame
    istrips: DataFrame
    isfishsets: DataFrame
    issetprofile: DataFrame
    isgears: DataFrame
    isgearfeatures: DataFrame


T = TypeVar("T", LandingTables, ObserverTables)


def read_tables(spark: SparkSession, kind: type[T], folder: str, fmt: str = "parquet", **options) -> T:
    """Every table of ``kind`` from ``folder/<table name>``."""
    reader = spark.read.format(fmt).options(**options)
    return kind(**{f.name: reader.load(f"{folder}/{f.name}") for f in fields(kind)})
