"""The whole estimation, from source tables to discards per vessel."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.attributes import Attributes, landing_attributes, narrowed
from ..operators.bootstrap import bootstrap_ratio, ratio_rows
from ..operators.cleaning import (
    add_cod_had_verdict, directed, early_failing_sets, flag_directed, flag_out_of_scope, kept_directed, removed_audit, trip_reasons,
)
from ..operators.coverage import (
    TRIP_KEYS, add_group, aggregate_trips, coverage_cells, coverage_summary, coverage_tiers, group_landings,
    split_fully_covered, ungrouped_counts,
)
from ..operators.discards import allocate_discards, check_allocation, estimate_discards
from ..operators.landings import AREA_IDS, assign_sector, narrow_landings
from ..operators.observer import area_sets, observer_trips, separator_panels, sought_species
from ..operators.reconcile import (
    MOST_UNROLLED_DAYS, landing_error_list, landing_errors_incorrect, landing_errors_missing, landed_days, observer_check, observer_missing, reconcile,
)
from ..operators.zones import assign_zone, fleet_positions, parse_positions, report_zone
from ..session import delete_written, materialize, watch_written
from ..sources.csv_tables import write_report
from ..sources.reports import publish_reports
from ..sources.tables import LandingTables, ObserverTables
from ..sources.zones import zone_index
from .checks import Measured, count_by, weights
from .settings import Settings


@dataclass(frozen=True)
class DiscardRun:
    """Every table an analyst looks at: lazy frames over the tables that the run has written.

    The run itself writes those while it is set up, and reports that list the sets of failing trips
    write theirs when asked for. :meth:`release` deletes all of them.
    """

    observer: DataFrame
    reconciled: DataFrame
    cleaned: DataFrame  # every landing row, with the reason it was removed or null
    aggregated: DataFrame  # trips in scope, longline and fully covered sectors left out
    fully_covered: DataFrame
    cells: DataFrame  # coverage counts per sector, zone and quarter, fully covered sectors included
    grouped: DataFrame
    estimates: DataFrame
    by_vessel: DataFrame
    attributes: Attributes = field(default_factory=Attributes)  # what describes the rows of reconciled and cleaned
    settings: Settings = field(default_factory=Settings)
    measured: Measured = field(default_factory=Measured)  # rows and sums of the tables, as they were written
    written: list[str] = field(default_factory=list)

    def reports(self) -> dict[str, DataFrame]:
        """The lists handed on or looked through, by name."""
        checked = self.cleaned.where("reason is null or reason in ('cod_directed_last_set', 'pollock_directed')")
        with watch_written() as tables:
            lists = {
                "landing_errors": landing_error_list(self.reconciled),
                "landing_trips_missing": landing_errors_missing(self.reconciled),
                "observer_check": observer_check(self.observer, landing_errors_incorrect(self.reconciled)),
                "observer_missing": observer_missing(self.reconciled),
                "removed_records": self.attributes.widened(removed_audit(self.cleaned)),
                "early_failing_sets": early_failing_sets(add_cod_had_verdict(checked, self.settings.cod_had_threshold), self.settings.cod_had_threshold),
                "aggregated_trips": self.aggregated,
                "coverage": coverage_summary(self.cells),
                "coverage_tiers": coverage_tiers(coverage_cells(self.aggregated)),
                "ungrouped_trips": ungrouped_counts(self.grouped),
                "group_landings": group_landings(self.grouped),
                "estimates": self.estimates,
                "by_vessel": self.by_vessel,
                "allocation_check": check_allocation(self.by_vessel, self.estimates),
                "run_counts": self.by_vessel.sparkSession.createDataFrame(self.measured.counts(), "step string, measure string, value double"),
            }
        self.written.extend(path for _, path in tables)
        return lists

    def release(self) -> None:
        """Delete the tables written for this run; its frames can't be read afterwards."""
        delete_written(self.by_vessel.sparkSession, self.written)
        self.written.clear()

    def write_reports(self, folder: str, fmt: str = "csv") -> None:
        for name, report in self.reports().items():
            write_report(report, f"{folder}/{name}", fmt)

    def publish(self, folder: str) -> str:
        """All reports as a new version of ``folder``, seen whole or not at all; see :func:`..sources.reports.publish_reports`."""
        return publish_reports(self.reports(), folder)


def run_discards(landing_tables: LandingTables | None, observer_tables: ObserverTables, zone_layer: DataFrame,
                 positions: DataFrame, flags: DataFrame, years, settings: Settings | None = None,
                 landing_rows: DataFrame | None = None, fleet_trips: DataFrame | None = None,
                 results: DataFrame | None = None) -> DiscardRun:
    """Run all steps. ``landing_rows`` (e.g. from a CSV) replaces the landings query.

    ``fleet_trips`` (see :func:`..operators.zones.fleet_trips`) names the vessels whose track may
    stand in for a missing zone; without it, any vessel's may. Positions with text timestamps are
    parsed. ``results`` (e.g. from :func:`..sources.read_results_csv`) replaces the bootstrap: ratios
    per group, with the groups' landings or without. Names, areas, descriptions and sizes are looked up
    for the roll-up and for reports only; ``attributes`` adds them to landings. Written to the shared
    folder on the way, because each is read by several steps: given landing rows, observer trips, reconciled and flagged landings, the zone index,
    needed vessel-days, failing trips, rolled-up trips, their groups, bootstrap rows and draws, the
    group estimates and the vessels' shares.

    What is written is counted and summed up by the same job; a step that loses rows, weights or
    allocated discards ends the run with a :class:`.checks.RunCheckError`.
    """
    use = settings or Settings()
    with watch_written() as tables:
        run = _run(landing_tables, observer_tables, zone_layer, positions, flags, years, use, landing_rows, fleet_trips, results)
    return replace(run, settings=use, written=[path for _, path in tables])


STATUSES = ["agree", "missing", "incorrect", "unobserved", "not_in_observer"]
ZONE_SOURCES = ["reported", "vessel_track", "observer"]


def _run(landing_tables, observer_tables, zone_layer, positions, flags, years, use, landing_rows, fleet_trips, results) -> DiscardRun:
    seen = Measured()
    observer_tables = area_sets(observer_tables, use.area_prefix)
    observed = materialize(observer_trips(observer_tables, years, use.area_prefix, use.observer_gears_excluded), "observer")
    if landing_rows is not None:
        rows, attributes = narrowed(materialize(landing_rows, "landing-rows"))
    else:
        rows = narrow_landings(landing_tables, years, use.areas)
        attributes = landing_attributes(landing_tables, list(use.areas or AREA_IDS))
        if use.tolerance_days > MOST_UNROLLED_DAYS:
            rows = materialize(rows, "landings")  # read for their days, and again
    days = landed_days(rows)
    rows = seen.watch(rows, "landings")
    index = zone_index(zone_layer)
    matched = reconcile(rows, observed, use.tolerance_days, use.trust_observer, use.one_match, days, null_keys=landing_rows is not None)
    located = seen.written(report_zone(assign_sector(matched, use.sector_codes), index), "reconciled", True, **count_by("status", STATUSES))
    reconciled = located.drop("sector", "zone_reported")
    seen.at_least("reconciled landings", seen.rows("reconciled"), seen.rows("landings"))
    if use.one_match:
        seen.same("landings with one match each", seen.rows("reconciled"), seen.rows("landings"))
    seen.same("landings with a status", sum(seen.values["reconciled"][s] for s in STATUSES), seen.rows("reconciled"))
    reasons = trip_reasons(
        observed, separator_panels(observer_tables, years, use.area_prefix),
        sought_species(observer_tables, years, use.area_prefix), use.target_species,
    )
    if dict(positions.dtypes)["position_utc_date"] == "string":
        positions = parse_positions(positions)
    if fleet_trips is not None:
        positions = fleet_positions(positions, fleet_trips)
    zoned = assign_zone(located, index, observed, positions, per_trip=reasons)
    flagged = seen.written(flag_out_of_scope(zoned), "flagged", **count_by("zone_source", ZONE_SOURCES))
    seen.same("landings with their zones and reasons", seen.rows("flagged"), seen.rows("reconciled"))
    found_directed = directed(flagged, use.cod_had_threshold)
    cleaned = flag_directed(flagged, use.cod_had_threshold, found_directed)
    in_scope = kept_directed(flagged, use.cod_had_threshold, found_directed)
    if use.gear_excluded is not None:
        in_scope = in_scope.where(F.col("gear_code") != use.gear_excluded)
    trips = seen.written(aggregate_trips(seen.watch(in_scope, "in_scope", **weights()), None, attributes), "trips", **weights())
    for c in weights():
        seen.same(f"{c} of the trips", seen.values["trips"][c], seen.values["in_scope"][c])
    rest, covered = split_fully_covered(trips)
    grouped = seen.written(add_group(rest, use.group_rules), "grouped", **weights(), ungrouped=F.count_if(F.col("analysis_group").isNull()))
    found = results if results is not None else bootstrap_ratio(ratio_rows(grouped), TRIP_KEYS, use.replicates, use.sample_size, use.seed)
    from_file = "unobsland_kg" in found.columns
    estimates = materialize(estimate_discards(found, None if from_file else group_landings(grouped), flags), "estimates")
    # one row for each group rule
    shared = {r["analysis_group"]: r["discards"] for r in estimates.where("significant = 1").collect()}
    allocated = {g: F.sum(F.when(F.col("analysis_group") == g, F.col("discardsmt"))) for g in shared}
    by_vessel = seen.written(allocate_discards(grouped, estimates), "by_vessel", **allocated)
    for group, discards in shared.items():
        if seen.values["by_vessel"][group] is not None:  # a group without unobserved haddock has no shares
            seen.same(f"discards allocated in {group}", seen.values["by_vessel"][group], discards)
    return DiscardRun(
        observer=observed, reconciled=reconciled, cleaned=cleaned, aggregated=rest, fully_covered=covered,
        cells=coverage_cells(trips), grouped=grouped, estimates=estimates, by_vessel=by_vessel, attributes=attributes, measured=seen,
    )
