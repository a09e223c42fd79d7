"""The whole run on the stand-ins: invariants, reports, the CSV route, and plans without broadcasts."""

from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from haulback import run_discards
from haulback.operators import ATTRIBUTES, landing_attributes, landings, narrow_landings, narrowed, reconcile
from haulback.operators import coverage_cells, coverage_tiers, fleet_trips
from haulback.plans import pipeline
from haulback.plans.checks import RunCheckError
from haulback.plans.settings import Settings
from haulback.plans.standins import ALL_AREAS, YEARS, Standins
from haulback.sources import read_landings_csv, read_reports, read_results_csv, write_report
from haulback.sources.csv_tables import LANDINGS_HEADER

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def standins(spark):
    return Standins(spark, SF)


SETTINGS = {"areas": ALL_AREAS, "replicates": 20}


def run(standins, fleet=None, **options):
    s = standins
    return run_discards(s.landing_tables(), s.observer_tables(), s.zones(), s.table("positions"), s.flags(), YEARS,
                        Settings(**SETTINGS, **options), fleet_trips=fleet)


@pytest.fixture(scope="module")
def result(standins):
    return run(standins)


def rounded(df):
    return rows(df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]))


def test_nothing_is_lost(standins, result):
    direct = reconcile(landings(standins.landing_tables(), YEARS, ALL_AREAS), result.observer)
    assert result.cleaned.count() == result.reconciled.count() == direct.count()
    reasons = {r.reason for r in result.cleaned.select("reason").distinct().collect()}
    assert reasons == {None, "zone_unresolved", "zone_invalid", "noncommercial", "no_panel", "other_species_sought",
                       "cod_directed_trip", "cod_directed_last_set", "pollock_directed"}


def test_coverage_recounts_the_trips(result):
    total = result.cells.agg(F.sum("obs"), F.sum("unobs")).first()
    trips = result.aggregated.unionByName(result.fully_covered)
    assert total[0] == trips.where("trip <> ''").count() and total[1] == trips.where("trip = ''").count()


def test_allocation_adds_up_to_the_group(result):
    checks = result.reports()["allocation_check"].collect()
    assert checks
    for r in checks:
        assert r.allocated == pytest.approx(r.discards, rel=1e-9)


def test_reports_are_written(spark, result, tmp_path):
    result.write_reports(str(tmp_path))
    for name, report in result.reports().items():
        assert spark.read.option("header", True).csv(str(tmp_path / name)).count() == report.count(), name


def test_the_csv_route_gives_the_same_discards(spark, standins, result, tmp_path):
    table = landings(standins.landing_tables(), YEARS, ALL_AREAS)
    columns = [
        (F.date_format(ours, "d/M/yyyy") if kind == "dmy" else F.col(ours)).alias(theirs)
        for theirs, (ours, kind) in LANDINGS_HEADER.items()
    ]
    write_report(table.select(*columns), str(tmp_path / "landings"))
    s = standins
    again = run_discards(None, s.observer_tables(), s.zones(), s.table("positions"), s.flags(), YEARS, Settings(replicates=20),
                         landing_rows=read_landings_csv(spark, str(tmp_path / "landings")))
    assert rounded(again.by_vessel) == rounded(result.by_vessel)


def test_without_any_automatic_broadcast_the_result_is_the_same(spark, standins, result):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        again = run(standins)
        assert rounded(again.by_vessel) == rounded(result.by_vessel)
        assert rounded(again.estimates) == rounded(result.estimates)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_one_match_keeps_the_number_of_landings(standins):
    one = run(standins, one_match=True)
    assert one.cleaned.count() == landings(standins.landing_tables(), YEARS, ALL_AREAS).count()


def test_tiers_leave_out_fully_covered_sectors(result):
    covered = {r.sector for r in result.fully_covered.select("sector").distinct().collect()}
    assert covered == {886}
    tiers = result.reports()["coverage_tiers"]
    assert not covered & {r.sector for r in tiers.select("sector").distinct().collect()}
    assert covered & {r.sector for r in coverage_tiers(result.cells).select("sector").distinct().collect()}
    assert tiers.count() == coverage_cells(result.aggregated).count()


def test_reconciled_keeps_null_weights_apart(result):
    assert "reason" not in result.reconciled.columns and "status" in result.reconciled.columns


def test_a_vessel_outside_the_fleet_lends_no_zone(standins):
    nobody = fleet_trips(standins.table("chp_trips"), "NONE", "5Z", "1990-01-01", "1990-01-02")
    none = run(standins, fleet=nobody)
    assert none.cleaned.where("zone_source = 'vessel_track'").count() == 0
    assert none.cleaned.where("zone_source = 'reported'").count() > 0


def test_settings_reach_the_steps(standins, result):
    other = run(standins, cod_had_threshold=0.2, group_rules=[("all", [881], None, None)], gear_excluded=None)
    assert {r.analysis_group for r in other.estimates.collect()} == {"all"}
    count = lambda r: r.cleaned.where("reason = 'cod_directed_trip'").count()
    assert count(other) > count(result)
    assert other.aggregated.where("gear_code = 51").count() > 0 == result.aggregated.where("gear_code = 51").count()


def test_release_deletes_what_the_run_wrote(standins):
    mine = run(standins)
    mine.reports()
    paths = [Path(p.removeprefix("file:")) for p in mine.written]
    assert len(paths) > 10 and all(p.exists() for p in paths)
    mine.release()
    assert not any(p.exists() for p in paths) and not mine.written


@pytest.mark.parametrize("step, lose", [
    ("assign_zone", lambda df: df.where("trip_id % 50 <> 3")),
    ("aggregate_trips", lambda df: df.withColumn("had", F.col("had") * 0.999)),
    ("allocate_discards", lambda df: df.where("licence_id % 9 <> 1")),
])
def test_a_planted_loss_ends_the_run(standins, monkeypatch, step, lose):
    whole = getattr(pipeline, step)
    monkeypatch.setattr(pipeline, step, lambda *a, **k: lose(whole(*a, **k)))
    with pytest.raises(RunCheckError):
        run(standins)


def test_counts_are_those_of_the_tables(result):
    counted = {(r.step, r.measure): r.value for r in result.reports()["run_counts"].collect()}
    assert counted["reconciled", "rows"] == result.reconciled.count() and counted["flagged", "rows"] == result.cleaned.count()
    assert counted["reconciled", "missing"] == result.reconciled.where("status = 'missing'").count()
    for source in ("reported", "vessel_track", "observer"):
        assert counted["flagged", source] == result.cleaned.where(F.col("zone_source") == source).count()
    assert counted["grouped", "ungrouped"] == result.grouped.where("analysis_group is null").count()


def test_ratios_from_a_file_replace_the_bootstrap(spark, standins, result, tmp_path):
    given = result.estimates.select(F.col("analysis_group").alias("zones_q"), "mean", F.col("se").alias("SE"), "bias")
    write_report(given, str(tmp_path / "ratios"))
    s = standins
    again = run_discards(s.landing_tables(), s.observer_tables(), s.zones(), s.table("positions"), s.flags(), YEARS, Settings(**SETTINGS),
                         results=read_results_csv(spark, str(tmp_path / "ratios")))
    assert rounded(again.by_vessel) == rounded(result.by_vessel)
    assert not any("draws" in path for path in again.written) and any("draws" in path for path in result.written)


def test_published_reports_read_back(spark, result, tmp_path):
    result.publish(str(tmp_path / "out"))
    back = read_reports(spark, str(tmp_path / "out"))
    assert set(back) == set(result.reports())
    assert rounded(back["by_vessel"]) == rounded(result.by_vessel)
    assert back["aggregated_trips"].schema["sector"].dataType == result.aggregated.schema["sector"].dataType


def test_landings_travel_without_their_descriptions(spark, standins, result):
    for table in (result.reconciled, result.cleaned):
        assert not set(ATTRIBUTES) & set(table.columns)
        text = {c for c, t in table.dtypes if t == "string"}
        assert text <= {"trip", "obs_trip", "landed_trip", "match", "status", "zone_source", "reason"}
    wide = landings(standins.landing_tables(), YEARS, ALL_AREAS)
    narrow = narrow_landings(standins.landing_tables(), YEARS, ALL_AREAS)
    back = landing_attributes(standins.landing_tables(), ALL_AREAS).add(narrow).select(*wide.columns)
    assert back.exceptAll(wide).isEmpty() and wide.exceptAll(back).isEmpty()
    assert set(ATTRIBUTES) < set(result.reports()["removed_records"].columns)


def test_descriptions_that_differ_in_nulls_stay_apart(spark):
    rows_in = spark.createDataFrame(
        [(1, "A", None, 2, 1e0), (1, "A", 2, None, 2e0), (1, None, None, None, 3e0), (None, "A", 2, 2, 4e0), (1, "A", None, 2, 5e0)],
        "vr_number long, vessel_name string, tc int, lc int, cod double")
    narrow, attributes = narrowed(rows_in)
    assert "vessel_name" not in narrow.columns and narrow.select("trip_profile").distinct().count() == 4
    assert rows(attributes.widened(narrow).select(*rows_in.columns)) == rows(rows_in)
    assert attributes.trip_keys(narrow) == ["vr_number", "trip_profile"]


def test_rows_without_descriptions_are_left_as_they_are(spark):
    bare = spark.createDataFrame([(1, 2e0)], "vr_number long, cod double")
    narrow, attributes = narrowed(bare)
    assert rows(attributes.widened(narrow)) == rows(bare) and not attributes.tables
    empty = spark.createDataFrame([], "vr_number long, vessel_name string, area string")
    narrow, attributes = narrowed(empty)
    assert attributes.widened(narrow).count() == 0 and len(attributes.tables) == 2


def test_a_long_tolerance_runs_through(standins):
    wide = run(standins, tolerance_days=30)
    direct = reconcile(narrow_landings(standins.landing_tables(), YEARS, ALL_AREAS), wide.observer, tolerance_days=30)
    assert wide.reconciled.count() == direct.count() == wide.measured.rows("reconciled")
    assert wide.reconciled.where("match = 'interval'").count() > 0
