import pytest
from conftest import rows

from haulback.operators import (
    add_group, aggregate_trips, coverage, coverage_cells, coverage_summary, coverage_tiers, group_landings,
    split_fully_covered,
)

TRIPS = "sector int, zone int, q int, trip string"


def trips(spark, *cells):
    """Cells as (sector, zone, quarter, unobserved trips, observed trips)."""
    data = [(s, z, q, "") for s, z, q, n, _ in cells for _ in range(n)]
    data += [(s, z, q, f"J{i}") for s, z, q, _, n in cells for i in range(n)]
    return spark.createDataFrame(data, TRIPS)


@pytest.mark.parametrize("unobs, obs, tier", [
    (0, 1, "1"), (0, 5, "1"), (3, 1, "2"), (7, 2, "2"), (4, 1, "3"), (9, 1, "3"), (5, 0, "3"), (8, 2, "UK"), (20, 3, "UK"),
])
def test_tiers(spark, unobs, obs, tier):
    cells = coverage_cells(trips(spark, (90, 1, 1, unobs, obs)))
    assert rows(coverage_tiers(cells), "unobs", "obs", "total", "tier") == [(unobs, obs, unobs + obs, tier)]
    assert coverage_tiers(cells, keep_unknown=False).count() == (tier != "UK")


def test_tiers_are_ordered_and_each_cell_has_one(spark):
    cells = coverage_cells(trips(spark, (90, 2, 1, 1, 1), (90, 1, 2, 1, 0), (89, 5, 4, 0, 1), (None, 1, 1, 1, 1)))
    found = [tuple(r) for r in coverage_tiers(cells).select("sector", "zone", "q").collect()]
    assert found == [(None, 1, 1), (89, 5, 4), (90, 1, 2), (90, 2, 1)]


def test_coverage_levels(spark):
    cells = coverage_cells(trips(spark, (90, 1, 1, 3, 1), (90, 2, 1, 0, 4), (90, 1, 2, 2, 0), (None, 1, 1, 1, 1)))
    assert rows(coverage(cells, "sector")) == [(None, 1, 1, 0.5), (90, 5, 5, 0.5)]
    summary = coverage_summary(cells)
    assert rows(summary.where("level = 'sector'"), "sector", "unobs", "obs") == [(None, 1, 1), (90, 5, 5)]
    assert rows(summary.where("level = 'sector_quarter'"), "sector", "q", "unobs", "obs", "coverage") == [
        (None, 1, 1, 1, 0.5), (90, 1, 3, 5, 0.625), (90, 2, 2, 0, 0.0)]
    assert summary.where("level = 'sector_quarter_zone'").count() == 4


def test_fully_covered_sectors_are_set_aside(spark):
    df = trips(spark, (90, 1, 1, 3, 1), (89, 2, 1, 0, 4), (None, 1, 2, 0, 2))
    rest, covered = split_fully_covered(df)
    assert rows(rest.select("sector").distinct()) == [(90,)]
    assert rows(covered.select("sector").distinct()) == [(None,), (89,)]
    assert rest.count() + covered.count() == df.count()


def test_aggregate_trips_sums_sets_and_drops_longline(spark):
    base = (1, "A", 5, 2, 3, 7, None, 12, 1, "J1", 1, 881)
    schema = ("vr_number long, vessel_name string, licence_id long, tc int, lc int, trip_id long, landed_date date, "
              "gear_code int, q int, trip string, zone int, sector int, cod double, had double, pol double")
    longline = base[:7] + (51,) + base[8:]
    data = [base + (1.0, 2.0, None), base + (3.0, None, None), longline + (9.0, 9.0, 9.0)]
    df = spark.createDataFrame(data, schema)
    assert rows(aggregate_trips(df), "trip_id", "cod", "had", "pol") == [(7, 4.0, 2.0, 0.0)]
    assert aggregate_trips(df, exclude_gear=None).count() == 2


def test_groups_and_landings(spark):
    df = spark.createDataFrame(
        [(311, 1, 1, "", 5.0), (311, 4, 2, "J1", 7.0), (885, 1, 1, "", 3.0), (90, 1, 1, "", 1.0)], TRIPS + ", cod double")
    grouped = add_group(df)
    assert rows(group_landings(grouped), "analysis_group", "unobsland_kg", "obsland_kg") == [
        (None, 1.0, None), ("311_Z12345_Q1234", 5.0, 7.0), ("885_Z12345_Q1234", 3.0, None)]
