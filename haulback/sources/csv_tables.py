"""Delimited inputs and report outputs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..functions.dates import parse_dmy
from ..functions.trips import blank_to_empty

# --- fixed values: header of the landings crosstab -> (our name, type) --------------------------
LANDINGS_HEADER = {
    "VR_NUMBER_FISHING": ("vr_number", "bigint"),
    "VESSEL_NAME": ("vessel_name", "string"),
    "LICENCE_ID": ("licence_id", "bigint"),
    "TRIP_ID": ("trip_id", "bigint"),
    "LOG_EFRT_STD_INFO_ID": ("set_id", "bigint"),
    "LANDED_DATE": ("landed_date", "dmy"),
    "DATE_FISHED": ("date_fished", "dmy"),
    "DATA_VALUE": ("trip", "trip"),
    "GEAR_CODE": ("gear_code", "int"),
    "SFLT_DESC_ID": ("sflt_desc_id", "int"),
    "LAT": ("lat", "double"),
    "LON": ("lon", "double"),
    "Q": ("q", "int"),
    "TC": ("tc", "int"),
    "LC": ("lc", "int"),
    "100": ("cod", "double"),
    "110": ("had", "double"),
    "170": ("pol", "double"),
}
# header of a ratio-results file -> (our name, type)
RESULTS_HEADER = {
    "zones_q": ("analysis_group", "string"),
    "mean": ("mean", "double"),
    "SE": ("se", "double"),
    "bias": ("bias", "double"),
    "OBSLAND": ("obsland_kg", "double"),
    "UNOBSLAND": ("unobsland_kg", "double"),
}
# ----------------------------------------------------------------------------------------------


def _typed(text, kind):
    if kind == "dmy":
        return parse_dmy(text)
    if kind == "trip":
        return blank_to_empty(text)
    return text if kind == "string" else text.try_cast(kind)


# Columns that a file may do without; the steps then see none, or do not need them.
OPTIONAL = {"VESSEL_NAME", "LICENCE_ID", "DATE_FISHED", "GEAR_CODE", "SFLT_DESC_ID", "LAT", "LON", "Q", "TC", "LC",
            "SE", "BIAS", "OBSLAND", "UNOBSLAND"}


#: Holds the whole text of a record whose number of fields isn't the header's.
RECORD = "_malformed_record"
#: The problem of such a record; other problems are named after the column.
MALFORMED = "number of fields"


@dataclass(frozen=True)
class CheckedRows:
    """``rows`` with columns of our names and types, and ``quarantine``: ``(record, problems)``.

    A record with another number of fields than the header is in quarantine only, as none of its
    values can be trusted to stand in its column. A value that can't be read as its column's type is
    null in ``rows``, and its record is in quarantine too, with the names of such columns.
    """

    rows: DataFrame
    quarantine: DataFrame

    def problem_counts(self) -> DataFrame:
        """``(problem, n)``: records by what is wrong with them."""
        return self.quarantine.select(F.explode("problems").alias("problem")).groupBy("problem").agg(F.count(F.lit(1)).alias("n"))


def _unreadable(text: Column, kind: str) -> Column:
    return F.lit(False) if kind in ("string", "trip") else (F.btrim(text) != "") & _typed(text, kind).isNull()


def read_checked(spark: SparkSession, path: str, header: dict) -> CheckedRows:
    """A file, or a folder of files of one header, with its bad records apart.

    Columns are picked by header name, so that their order and any extra ones do not matter. A file
    of another header fails the read rather than being taken for another's columns. A missing column
    is an error unless it is in ``OPTIONAL``. All is read as text; one scan serves each of the results.
    """
    reader = lambda: spark.read.option("header", True).option("nullValue", "NA").option("enforceSchema", False)
    names = reader().csv(path).columns
    by_name = {name.upper(): name for name in names}
    if missing := [name for name in header if name.upper() not in by_name and name.upper() not in OPTIONAL]:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    schema = StructType()
    for name in [*names, RECORD]:
        schema = schema.add(name, StringType())
    # every field is parsed, or else a record's number of them wouldn't show
    raw = reader().schema(schema).option("columnNameOfCorruptRecord", RECORD).option("columnPruning", False).csv(path)
    found = [(theirs, F.col(f"`{by_name[theirs.upper()]}`"), ours, kind) for theirs, (ours, kind) in header.items() if theirs.upper() in by_name]
    whole = F.col(RECORD).isNull()
    unreadable = F.array_compact(F.array(*[F.when(_unreadable(text, kind), theirs) for theirs, text, _, kind in found]))
    problems = F.when(whole, unreadable).otherwise(F.array(F.lit(MALFORMED)))
    record = F.coalesce(RECORD, F.to_json(F.struct(*[F.col(f"`{n}`") for n in names])))
    return CheckedRows(
        raw.where(whole).select(*[_typed(text, kind).alias(ours) for _, text, ours, kind in found]),
        raw.select(record.alias("record"), problems.alias("problems")).where(F.size("problems") > 0),
    )


def check_landings_csv(spark: SparkSession, path: str) -> CheckedRows:
    """A landings crosstab file or folder. The trip code is never null."""
    return read_checked(spark, path, LANDINGS_HEADER)


def read_landings_csv(spark: SparkSession, path: str) -> DataFrame:
    """The rows of :func:`check_landings_csv`."""
    return check_landings_csv(spark, path).rows


def read_results_csv(spark: SparkSession, path: str) -> DataFrame:
    """Group ratios computed elsewhere, in place of the bootstrap's."""
    return read_checked(spark, path, RESULTS_HEADER).rows


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write a report in parallel, one file per task; CSV gets a header."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
