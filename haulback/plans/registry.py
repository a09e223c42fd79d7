"""The registered queries: every operator on the stand-in tables of one test-data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.classes import length_class, tonnage_class
from ..functions.positions import decode_packed
from ..functions.trips import blank_to_empty
from ..operators.attributes import landing_attributes
from ..operators.bootstrap import bootstrap_ratio, ratio_of_ratios, ratio_rows
from ..operators.cleaning import (
    add_cod_had_verdict, all_sets_fail_trips, early_failing_sets, failing_last_sets, flag_directed, flag_out_of_scope,
    kept_directed, mark_trips, no_panel_trips, noncommercial_trips, other_sought_trips, remove_cod_directed,
    remove_pollock_directed, removed_audit, trip_reasons, trip_set_listing,
)
from ..operators.coverage import (
    TRIP_KEYS, add_group, aggregate_trips, coverage, coverage_cells, coverage_summary, coverage_tiers, group_landings,
    split_fully_covered, ungrouped_counts,
)
from ..operators.discards import allocate_discards, check_allocation, estimate_discards
from ..operators.landings import assign_sector, landings, landings_crosstab, narrow_landings, trip_codes
from ..operators.observer import area_sets, observer_trips, separator_panels, sought_species
from ..operators.reconcile import (
    first_per_vessel_day, landing_error_list, landing_errors_incorrect, landing_errors_missing, observer_check, observer_missing, reconcile,
)
from ..operators.zones import assign_zone, fleet_positions, fleet_trips, identify_zone, report_zone, vessel_day_mean_position
from ..session import materialize, scratch_path
from ..sources.csv_tables import LANDINGS_HEADER, CheckedRows, check_landings_csv, read_results_csv, write_report
from ..sources.reports import publish_reports, read_reports
from ..sources.zones import zone_index
from .pipeline import run_discards
from .settings import Settings
from .standins import ALL_AREAS, ALL_FLEETS, OTHER_RULES, YEARS, Standins, case_list


class Steps:
    """The stand-in run, one step after another, for queries that start in its middle."""

    #: What the steps from the zones to the roll-up and the lists of removed rows need of a landing.
    CARRIED = ["vr_number", "licence_id", "trip_id", "set_id", "landed_date", "date_fished", "trip", "gear_code", "q", "sector",
               "cod", "had", "pol"]

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.s = Standins(spark, sf_dir)
        self.sources = self.s.observer_tables()

    def landings(self) -> DataFrame:
        return landings(self.s.landing_tables(), YEARS, ALL_AREAS)

    def narrow_landings(self) -> DataFrame:
        return narrow_landings(self.s.landing_tables(), YEARS, ALL_AREAS)

    def verdicts(self) -> DataFrame:
        return add_cod_had_verdict(self.landings())

    def observer(self) -> DataFrame:
        return observer_trips(self.sources, YEARS)

    def panels(self) -> DataFrame:
        return separator_panels(self.sources, YEARS)

    def sought(self) -> DataFrame:
        return sought_species(self.sources, YEARS)

    def reconciled(self, observer: DataFrame | None = None) -> DataFrame:
        return reconcile(self.narrow_landings(), self.observer() if observer is None else observer, null_keys=False)

    def fleet(self) -> DataFrame:
        """The trips whose vessels' tracks may stand in for a missing zone."""
        return fleet_trips(self.s.table("chp_trips"), "MOBILE", "5Z", f"{YEARS[0]}-01-01", f"{YEARS[1]}-12-31")

    def zoned(self, observer: DataFrame, per_trip: DataFrame | None = None, *more: str) -> DataFrame:
        """Landings with their zones: the columns that are CARRIED, and ``more``."""
        index = zone_index(self.s.zones())
        located = report_zone(assign_sector(self.reconciled(observer)), index)
        rows = materialize(located.select(*self.CARRIED, *more, "zone_reported"), "reconciled", keep_layout=True, compression="zstd")
        positions = fleet_positions(self.s.table("positions"), self.fleet())
        return assign_zone(rows, index, observer, positions, per_trip=per_trip)

    def flagged(self) -> DataFrame:
        self.sources = area_sets(self.sources)
        observer = materialize(self.observer(), "observer")
        zoned = self.zoned(observer, trip_reasons(observer, self.panels(), self.sought()))
        return materialize(flag_out_of_scope(zoned).drop("date_fished", "zone_source"), "flagged", compression="zstd")

    def cleaned(self) -> DataFrame:
        return flag_directed(self.flagged())

    def aggregated(self) -> DataFrame:
        return aggregate_trips(kept_directed(self.flagged()), attributes=landing_attributes(self.s.landing_tables(), ALL_AREAS))

    def trips(self) -> DataFrame:
        """The trips in scope, written once: most of what follows reads them several times."""
        return materialize(self.aggregated(), "trips")

    def grouped(self) -> DataFrame:
        return materialize(add_group(split_fully_covered(self.trips())[0]), "grouped")

    def results(self, grouped: DataFrame) -> DataFrame:
        return bootstrap_ratio(ratio_rows(grouped), TRIP_KEYS)

    def estimates(self, grouped: DataFrame) -> DataFrame:
        return estimate_discards(self.results(grouped), group_landings(grouped), self.s.flags())


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _set_columns(df: DataFrame, *more) -> DataFrame:
    return df.select("vr_number", "trip_id", "set_id", *more)


def _flag_split(split: tuple[DataFrame, DataFrame]) -> DataFrame:
    """Kept and removed rows in one frame."""
    kept_rows, removed = split
    return kept_rows.withColumn("removed", F.lit(False)).unionByName(removed.withColumn("removed", F.lit(True)))


# Landings and observer sources -----------------------------------------------------------------

def q_landings_crosstab(p: Steps) -> DataFrame:
    return landings_crosstab(p.s.landing_tables(), 1997).drop("nafo_unit_area_id")


def _documents(p: Steps, how: str) -> DataFrame:
    tables = p.s.landing_tables()
    return landings_crosstab(tables, YEARS, ALL_AREAS).join(trip_codes(tables), "mon_doc_id", how).select(
        "mon_doc_id", "trip_id", F.col("log_efrt_std_info_id").alias("set_id"),
        blank_to_empty(F.col("data_value")).alias("trip"),
    )


def q_date_parts(p: Steps) -> DataFrame:
    day = p.s.table("chp_trips").select("landed_date")
    return day.groupBy(F.year("landed_date").alias("year"), F.month("landed_date").alias("month"),
                       F.quarter("landed_date").alias("q")).agg(
        F.count(F.lit(1)).alias("n"), F.min("landed_date").alias("first_day"), F.max("landed_date").alias("last_day"))


def q_tonnage_length_class(p: Steps) -> DataFrame:
    return p.s.table("vessels").select(
        "vr_number", "gross_tonnage", "loa",
        tonnage_class(F.col("gross_tonnage")).alias("tc"), length_class(F.col("loa")).alias("lc"))


def q_packed_position(p: Steps) -> DataFrame:
    keys = p.s.table("pro_spc_info").groupBy(F.col("log_efrt_std_info_id").alias("set_id"), "latitude", "longitude")
    return keys.agg(F.count(F.lit(1)).alias("n")).withColumns(
        {"lat": decode_packed(F.col("latitude")), "lon": decode_packed(F.col("longitude"), -1)})


def q_sector_map(p: Steps) -> DataFrame:
    code = F.expr(case_list(f"c_custkey % {len(ALL_FLEETS)}", ALL_FLEETS))
    customers = p.s._base("customer").select("c_custkey", code.alias("sflt_desc_id"))
    return assign_sector(customers)


# Files -----------------------------------------------------------------------------------------

def _landings_file(p: Steps) -> CheckedRows:
    """The landings written as a crosstab file and read back.

    Dates are written day first. Some sets have a fishing date or a cod weight that can't be read,
    and some vessels a name that breaks the line, so that their record becomes two, both too short.
    """
    set_id = F.col("set_id")
    written = p.landings().withColumns({
        "landed_date": F.date_format("landed_date", "d/M/yyyy"),
        "date_fished": F.when(set_id % 97 == 0, "soon").otherwise(F.date_format("date_fished", "d/M/yyyy")),
        "cod": F.when(set_id % 101 == 0, "heavy").otherwise(F.col("cod").cast("string")),
        "vessel_name": F.when(set_id % 89 == 0, F.concat("vessel_name", F.lit("\nII"))).otherwise(F.col("vessel_name")),
    })
    path = scratch_path(p.s.spark, "landings-csv")
    write_report(written.select(*[F.col(ours).alias(theirs) for theirs, (ours, _) in LANDINGS_HEADER.items()]), path)
    return check_landings_csv(p.s.spark, path)


def q_estimates_from_file(p: Steps) -> DataFrame:
    """Ratios and landings of the groups written as a results file, which replaces the bootstrap."""
    grouped = p.grouped()
    ratios = ratio_of_ratios(ratio_rows(grouped)).join(group_landings(grouped), "analysis_group", "left")
    path = scratch_path(p.s.spark, "results-csv")
    write_report(ratios.select(
        F.col("analysis_group").alias("zones_q"), "mean", F.lit("NA").alias("SE"), F.lit("NA").alias("bias"),
        F.col("obsland_kg").alias("OBSLAND"), F.col("unobsland_kg").alias("UNOBSLAND")), path)
    return _rounded(estimate_discards(read_results_csv(p.s.spark, path), None, p.s.flags()), 9, "mean", "discards", "sigdiscards").drop("se", "bias")


def q_reports_read_back(p: Steps) -> DataFrame:
    """The trips that stay and those set aside, published together by sector and quarter and read back."""
    rest, covered = split_fully_covered(p.trips())
    folder = scratch_path(p.s.spark, "reports")
    publish_reports({"aggregated_trips": rest, "fully_covered": covered}, folder)
    back = read_reports(p.s.spark, folder)
    return back["aggregated_trips"].withColumn("covered", F.lit(False)).unionByName(back["fully_covered"].withColumn("covered", F.lit(True)))


# Reconcile -------------------------------------------------------------------------------------

def q_first_observer_row(p: Steps) -> DataFrame:
    return first_per_vessel_day(p.observer())


def q_reconcile_exact(p: Steps) -> DataFrame:
    exact = p.reconciled().where("match = 'exact'")
    return _set_columns(exact, "landed_date", F.col("landed_trip").alias("trip"), "obs_trip",
                        (F.col("status") == "agree").alias("agree"))


def q_reconcile_interval(p: Steps) -> DataFrame:
    near = p.reconciled().where("match = 'interval'")
    return _set_columns(near, "landed_date", F.col("landed_trip").alias("trip"), "obs_trip")


def q_reconcile_interval_wide(p: Steps) -> DataFrame:
    """Landings up to 60 days from an observer row, matched in bins of dates."""
    near = reconcile(materialize(p.narrow_landings(), "landings"), p.observer(), tolerance_days=60).where("match = 'interval'")
    return _set_columns(near, "landed_date", F.col("landed_trip").alias("trip"), "obs_trip")


def q_reconcile_status(p: Steps) -> DataFrame:
    return _set_columns(p.reconciled(), "landed_date", "trip", "landed_trip", "obs_trip", "match", "status")


def q_reconcile_one_match(p: Steps) -> DataFrame:
    one = reconcile(p.narrow_landings(), p.observer(), trust_observer=False, one_match=True)
    return _set_columns(one, "landed_date", "landed_trip", "trip", "obs_trip")


def q_observer_check(p: Steps) -> DataFrame:
    observer = materialize(p.observer(), "observer")
    return observer_check(observer, landing_errors_incorrect(p.reconciled(observer)))


# Zones -----------------------------------------------------------------------------------------

def q_fleet_positions(p: Steps) -> DataFrame:
    parts = [
        fleet_positions(p.s.table("positions"), fleet_trips(p.s.table("chp_trips"), fleet, "5Z", "1997-01-01", "1998-12-31"))
        .withColumn("fleet", F.lit(fleet))
        for fleet in ("MOBILE", "FIXED")
    ]
    return parts[0].unionByName(parts[1])


def q_zone_point_in_polygon(p: Steps) -> DataFrame:
    return identify_zone(p.s.table("positions"), p.s.zones(), "latitude", "longitude")


def q_vessel_day_mean_position(p: Steps) -> DataFrame:
    return _rounded(vessel_day_mean_position(p.s.table("positions")), 6, "mean_lat", "mean_lon")


def q_zone_fallback(p: Steps) -> DataFrame:
    return _set_columns(p.zoned(materialize(p.observer(), "observer"), None, "lat", "lon"), "trip", "lat", "lon", "zone", "zone_source")


def q_zone_source_counts(p: Steps) -> DataFrame:
    return p.zoned(materialize(p.observer(), "observer")).groupBy(F.coalesce("zone_source", F.lit("none")).alias("zone_source")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("trip_id").alias("n_trips"))


# Cleaning --------------------------------------------------------------------------------------

def q_flag_split_noncommercial(p: Steps) -> DataFrame:
    observer = materialize(p.observer(), "observer")
    return mark_trips(_set_columns(p.reconciled(observer), "trip"), noncommercial_trips(observer))


def q_flag_split_no_panel(p: Steps) -> DataFrame:
    return mark_trips(_set_columns(p.reconciled(), "trip"), no_panel_trips(p.panels()))


def q_sought_other_species(p: Steps) -> DataFrame:
    return mark_trips(_set_columns(p.reconciled(), "trip"), other_sought_trips(p.sought()))


def _finite(ratio: str = "codhad_ratio"):
    """Infinity written as -1, so that results compare as plain numbers."""
    return F.when(F.col(ratio) == float("inf"), F.lit(-1e0)).otherwise(F.col(ratio)).alias("ratio_or_inf")


def q_cod_had_verdict(p: Steps) -> DataFrame:
    verdict = F.when(F.col("met"), "met").when(~F.col("met"), "not met").alias("verdict")
    return p.verdicts().select("trip_id", "set_id", "cod", "had", _finite(), verdict)


def q_cod_directed_split(p: Steps) -> DataFrame:
    rows = materialize(p.landings().select("trip_id", "set_id", "cod", "had"), "landings")
    kept_rows, removed = remove_cod_directed(rows)
    return (
        kept_rows.withColumn("reason", F.lit("kept")).unionByName(removed)
        .select("trip_id", "set_id", F.col("reason").alias("outcome"))
    )


def q_trip_set_listing(p: Steps) -> DataFrame:
    return trip_set_listing(p.verdicts()).select("trip_id", "set_id", _finite(), "met", "is_last")


def q_pollock_directed(p: Steps) -> DataFrame:
    rows = materialize(p.landings().select("trip_id", "set_id", "cod", "had", "pol"), "landings")
    return _flag_split(remove_pollock_directed(rows))


def q_removed_audit(p: Steps) -> DataFrame:
    return _set_columns(removed_audit(p.cleaned()), "landed_date", "trip", "zone", "sector", "cod", "had", "pol", "reason")


def q_removed_counts(p: Steps) -> DataFrame:
    return p.cleaned().groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("cod").alias("cod"))


# Coverage and groups ---------------------------------------------------------------------------

def _covered_split(p: Steps, by: str) -> DataFrame:
    rest, covered = split_fully_covered(p.trips(), by)
    return rest.withColumn("covered", F.lit(False)).unionByName(covered.withColumn("covered", F.lit(True)))


def q_fully_covered_quarters(p: Steps) -> DataFrame:
    cells = coverage_cells(p.trips(), ("vr_number", "sector", "q"))
    return coverage(cells, "vr_number", "q").where("coverage = 1").drop("coverage")


def _tiers(p: Steps, by: str, *cell: str) -> DataFrame:
    """Tiers of the cells, ``by`` that are fully covered left out before."""
    return coverage_tiers(coverage_cells(split_fully_covered(p.trips(), by)[0], cell))


# Estimate --------------------------------------------------------------------------------------

def q_ratio_of_ratios(p: Steps) -> DataFrame:
    return _rounded(ratio_of_ratios(ratio_rows(p.grouped())), 9, "mean")


def q_bootstrap_ratio(p: Steps) -> DataFrame:
    return _rounded(p.results(p.grouped()), 9, "mean", "se", "bias")


def q_estimate_discards(p: Steps) -> DataFrame:
    return _rounded(p.estimates(p.grouped()), 9, "mean", "se", "bias", "discards", "sigdiscards")


def q_allocate_discards(p: Steps) -> DataFrame:
    grouped = p.grouped()
    estimates = materialize(p.estimates(grouped), "estimates")
    return _rounded(allocate_discards(grouped, estimates), 9, "portion", "discardsmt")


def q_allocation_check(p: Steps) -> DataFrame:
    grouped = p.grouped()
    estimates = materialize(p.estimates(grouped), "estimates")
    return _rounded(check_allocation(allocate_discards(grouped, estimates), estimates), 6, "allocated", "discards")


def _full_run(p: Steps, settings: Settings):
    return run_discards(p.s.landing_tables(), p.s.observer_tables(), p.s.zones(), p.s.table("positions"), p.s.flags(),
                        YEARS, settings, fleet_trips=p.fleet())


def q_full_pipeline(p: Steps) -> DataFrame:
    return _rounded(_full_run(p, Settings(areas=ALL_AREAS)).by_vessel, 9, "portion", "discardsmt")


def q_full_pipeline_other_rules(p: Steps) -> DataFrame:
    """Another threshold, other groups, and longline kept in."""
    settings = Settings(areas=ALL_AREAS, cod_had_threshold=0.5, group_rules=OTHER_RULES, gear_excluded=None)
    return _rounded(_full_run(p, settings).by_vessel, 9, "portion", "discardsmt")


STEPS: dict[str, Callable[[Steps], DataFrame]] = {
    "landings_crosstab": q_landings_crosstab,
    "landings_all_years": Steps.landings,
    "document_left_join": lambda p: _documents(p, "left"),
    "document_inner_join": lambda p: _documents(p, "inner"),
    "date_parts": q_date_parts,
    "tonnage_length_class": q_tonnage_length_class,
    "packed_position": q_packed_position,
    "csv_landings": lambda p: _landings_file(p).rows,
    "csv_problem_counts": lambda p: _landings_file(p).problem_counts(),
    "observer_extents": Steps.observer,
    "separator_panels": Steps.panels,
    "sought_species": Steps.sought,
    "first_observer_row": q_first_observer_row,
    "reconcile_exact": q_reconcile_exact,
    "reconcile_interval": q_reconcile_interval,
    "reconcile_interval_wide": q_reconcile_interval_wide,
    "reconcile_status": q_reconcile_status,
    "reconcile_one_match": q_reconcile_one_match,
    "landing_errors": lambda p: landing_error_list(p.reconciled()),
    "landing_errors_missing": lambda p: landing_errors_missing(p.reconciled()),
    "landing_errors_incorrect": lambda p: landing_errors_incorrect(p.reconciled()),
    "observer_check": q_observer_check,
    "observer_missing": lambda p: observer_missing(p.reconciled()),
    "sector_map": q_sector_map,
    "fleet_positions": q_fleet_positions,
    "zone_point_in_polygon": q_zone_point_in_polygon,
    "vessel_day_mean_position": q_vessel_day_mean_position,
    "zone_fallback": q_zone_fallback,
    "zone_source_counts": q_zone_source_counts,
    "flag_split_noncommercial": q_flag_split_noncommercial,
    "flag_split_no_panel": q_flag_split_no_panel,
    "sought_other_species": q_sought_other_species,
    "cod_had_verdict": q_cod_had_verdict,
    "all_sets_fail": lambda p: all_sets_fail_trips(p.verdicts()),
    "last_set_fail": lambda p: failing_last_sets(p.verdicts()),
    "cod_directed_split": q_cod_directed_split,
    "trip_set_listing": q_trip_set_listing,
    "early_failing_sets": lambda p: early_failing_sets(p.verdicts()),
    "pollock_directed": q_pollock_directed,
    "removed_audit": q_removed_audit,
    "removed_counts": q_removed_counts,
    "trip_rollup": Steps.aggregated,
    "coverage_summary": lambda p: coverage_summary(coverage_cells(p.trips())),
    "fully_covered_split": lambda p: _covered_split(p, "sector"),
    "fully_covered_split_by_vessel": lambda p: _covered_split(p, "vr_number"),
    "fully_covered_quarters": q_fully_covered_quarters,
    "coverage_tiers": lambda p: _tiers(p, "sector", "sector", "zone", "q"),
    "coverage_tiers_by_vessel": lambda p: _tiers(p, "vr_number", "vr_number", "q"),
    "assign_group": Steps.grouped,
    "ungrouped_trips": lambda p: ungrouped_counts(p.grouped()),
    "group_landings_pivot": lambda p: group_landings(p.grouped()),
    "ratio_of_ratios": q_ratio_of_ratios,
    "bootstrap_ratio": q_bootstrap_ratio,
    "estimate_discards": q_estimate_discards,
    "estimates_from_file": q_estimates_from_file,
    "reports_read_back": q_reports_read_back,
    "allocate_discards": q_allocate_discards,
    "allocation_check": q_allocation_check,
    "full_pipeline": q_full_pipeline,
    "full_pipeline_other_rules": q_full_pipeline_other_rules,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {key: (lambda spark, sf_dir, step=step: step(Steps(spark, sf_dir))) for key, step in STEPS.items()}
