import datetime as dt
import math
import random

import numpy as np
import pytest
from conftest import rows

from haulback.operators import (
    assign_zone, fleet_positions, fleet_trips, identify_zone, observer_position, parse_positions, positions_between,
    vessel_day_mean_position,
)
from haulback.operators import zones as zones_module
from haulback.operators.zones import _locate
from haulback.sources import zone_index, zones_from_vertices

RINGS = [
    (1, 1, [(0, 0), (10, 0), (10, 10), (0, 10)]),
    (2, 1, [(10, 0), (20, 0), (20, 10), (10, 10)]),
    (2, 2, [(14, 4), (16, 4), (16, 6), (14, 6)]),  # hole
    (3, 1, [(5, 5), (12, 5), (12, 12), (5, 12)]),  # overlaps 1 and 2
    (4, 1, [(30, 0), (33.3, 0.7), (31.1, 4.9)]), (4, 2, [(40, 0), (41, 0), (40.5, 3)]),  # two parts
]


def zones(spark, rings=RINGS):
    data = [(z, r, i, float(x), float(y)) for z, r, points in rings for i, (x, y) in enumerate(points)]
    return zones_from_vertices(spark.createDataFrame(data, "zone_id int, ring_id int, seq int, x double, y double"))


def by_hand(x, y, rings=RINGS):
    if x is None or y is None:
        return None
    hits = []
    for zone in sorted({z for z, _, _ in rings}):
        crossings = 0
        for z, _, points in rings:
            if z != zone:
                continue
            for (x1, y1), (x2, y2) in zip(points, points[1:] + points[:1], strict=True):
                if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                    crossings += 1
        if crossings % 2:
            hits.append(zone)
    return min(hits, default=None)


def test_zone_edges_close_each_ring(spark):
    edges = [tuple(r) for r in zones(spark).collect()]
    assert [sum(e[0] == z for e in edges) for z in (1, 2, 3, 4)] == [4, 8, 4, 6]
    assert (1, 0.0, 10.0, 0.0, 0.0) in edges
    closed = [(z, r, points + points[:1]) for z, r, points in RINGS]
    assert sorted(tuple(r) for r in zones(spark, closed).collect()) == sorted(edges)


@pytest.mark.parametrize("most_edges", [2, 8, 1000])
def test_identify_zone_by_hand(spark, most_edges):
    rnd = random.Random(3)
    points = [(rnd.uniform(-2, 43), rnd.uniform(-2, 13)) for _ in range(400)]
    points += [(float(x), float(y)) for x in (0, 5, 10, 12, 14, 15, 20, 40) for y in (0, 4, 5, 6, 10, 12)]  # on edges
    points += [(None, 1.0), (1.0, None), (None, None)]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "id int, lon double, lat double")
    found = dict(rows(identify_zone(df, zones(spark), most_edges=most_edges), "id", "zone"))
    assert found == {i: by_hand(x, y) for i, (x, y) in enumerate(points)}


def test_shared_edge_goes_to_one_zone(spark):
    df = spark.createDataFrame([(10.0, 2.0)], "lon double, lat double")
    assert identify_zone(df, zones(spark)).first().zone == 2


def leaf_edges(index):
    """Different edges of each leaf."""
    return [len({frozenset([(e.x1, e.y1), (e.x2, e.y2)]) for c in r.candidates for e in c.edges}) for r in index.leaves.collect()]


def test_leaves_tile_the_layer_and_hold_few_edges(spark):
    index = zone_index(zones(spark), 3)
    cells = index.leaves.select("level", "ix", "iy").collect()
    assert len(set(cells)) == len(cells) and sum(16.0 ** -r.level for r in cells) == 1.0
    # where four edges end in one point no split helps
    assert max(leaf_edges(index)) <= 6 and sum(n > 3 for n in leaf_edges(index)) <= 5


def test_edges_that_several_zones_share_count_once(spark):
    stacked = [(z, 1, [(0, 0), (8, 0), (8, 8), (0, 8)]) for z in range(20)]
    assert zone_index(zones(spark, stacked), 4).levels == (0,)
    star = [(z, 1, [(0, 0), (10 * math.cos(z), 10 * math.sin(z)), (10 * math.cos(z + 0.5), 10 * math.sin(z + 0.5))]) for z in range(1, 9)]
    df = spark.createDataFrame([(0.01 * math.cos(k / 10), 0.01 * math.sin(k / 10)) for k in range(63)], "lon double, lat double")
    found = identify_zone(df, zones(spark, star), most_edges=4).collect()
    assert [r.zone for r in found] == [by_hand(r.lon, r.lat, star) for r in found]


def coast(n):
    """A ring of n vertices with bays of every size."""
    points = []
    for k in range(n):
        a = 2 * math.pi * k / n
        r = 3 + 0.5 * math.sin(7 * a) + 0.1 * math.sin(101 * a) + 0.003 * math.sin(5003 * a)
        points.append((r * math.cos(a) - 60, r * math.sin(a) + 42))
    return points


def test_random_polygons_by_hand(spark):
    rnd = random.Random(8)
    rings = [(z, 1, [(rnd.uniform(0, 10), rnd.uniform(0, 10)) for _ in range(rnd.randrange(3, 40))]) for z in range(1, 7)]
    rings += [(z, 2, [(float(rnd.randrange(10)), float(rnd.randrange(10))) for _ in range(12)]) for z in range(1, 4)]
    points = [(rnd.uniform(-1, 11), rnd.uniform(-1, 11)) for _ in range(500)] + [(float(x), float(y)) for x in range(10) for y in range(10)]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "id int, lon double, lat double")
    found = dict(rows(identify_zone(df, zones(spark, rings), most_edges=8), "id", "zone"))
    assert found == {i: by_hand(x, y, rings) for i, (x, y) in enumerate(points)}


def test_a_ring_of_many_vertices(spark):
    points = coast(100_000)
    edges = zones(spark, [(1, 1, points), (2, 1, [(-64, 38), (-56, 38), (-56, 46), (-64, 46)])])
    index = zone_index(edges)
    assert max(leaf_edges(index)) <= 32 and len(index.levels) > 5
    rnd = random.Random(2)
    near = [points[rnd.randrange(len(points))] for _ in range(150)]
    tried = [(x + rnd.uniform(-1e-4, 1e-4), y + rnd.uniform(-1e-4, 1e-4)) for x, y in near] + [(rnd.uniform(-64, -56), rnd.uniform(38, 46)) for _ in range(50)]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(tried)], "id int, lon double, lat double")
    found = dict(rows(_locate(df, index, "lat", "lon", "zone"), "id", "zone"))
    e = np.array([(*a, *b) for a, b in zip(points, points[1:] + points[:1], strict=True)])
    for i, (x, y) in enumerate(tried):
        up = (e[:, 1] > y) != (e[:, 3] > y)
        at = (e[up, 2] - e[up, 0]) * (y - e[up, 1]) / (e[up, 3] - e[up, 1]) + e[up, 0]
        assert found[i] == (1 if (x < at).sum() % 2 else 2)


def test_no_zones(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0)], "lon double, lat double")
    assert [r.zone for r in identify_zone(df, zones(spark).where("1 = 0")).collect()] == [None, None]


def test_fallback_chain(spark):
    day = dt.date(2021, 6, 1)
    landings = spark.createDataFrame([
        (1, 1, 1, "", day, 1.0, 1.0),  # reported position
        (1, 1, 2, "", day, None, None),  # track
        (2, 2, 3, "", day, None, None),  # no track that day
        (1, 3, 4, "J1", day, 99.0, 99.0),  # observer, outside reported
        (1, 4, 5, "J", day, None, None),  # one-character code without observer position
        (3, 5, 6, "J2", day, None, None),  # observed trips do not use the track
        (1, 6, 7, "", None, None, None),
    ], "vr_number long, trip_id long, set_id long, trip string, date_fished date, lon double, lat double")
    observer = spark.createDataFrame(
        [("J1", 2, 1, 1.0, 12.0), ("J1", 1, 2, 1.0, 2.0), ("J2", 1, 1, 50.0, 50.0)],
        "trip string, gearcd_id int, setcd_id int, lat2 double, lon2 double")
    track = spark.createDataFrame([
        (1, dt.datetime(2021, 6, 1, 1), 1.0, 30.0), (1, dt.datetime(2021, 6, 1, 23), 1.0, 34.0),
        (1, dt.datetime(2021, 6, 2, 1), 1.0, 1.0), (3, dt.datetime(2021, 6, 1, 1), 1.0, 1.0),
    ], "vr_number long, position_utc_date timestamp_ntz, latitude double, longitude double")
    out = assign_zone(landings, zones(spark), observer, track)
    assert out.columns == landings.columns + ["zone", "zone_source"]
    assert rows(out, "set_id", "zone", "zone_source") == [
        (1, 1, "reported"), (2, 4, "vessel_track"), (3, None, None), (4, 1, "observer"), (5, None, None),
        (6, None, None), (7, None, None)]


def test_observer_position_is_one_row_per_trip(spark):
    observer = spark.createDataFrame(
        [("J1", 2, 1, 1.0, 2.0), ("J1", 1, 7, 3.0, 4.0), ("J1", 1, 1, 5.0, 6.0)],
        "trip string, gearcd_id int, setcd_id int, lat2 double, lon2 double")
    assert rows(observer_position(observer)) == [("J1", 5.0, 6.0)]


def test_fleet_positions(spark):
    trips = spark.createDataFrame([
        (1, "MOBILE", "5Z", dt.date(2021, 1, 1)), (1, "MOBILE", "5Z", dt.date(2021, 2, 1)),
        (2, "FIXED", "5Z", dt.date(2021, 12, 31)), (3, "MOBILE", "4X", dt.date(2021, 5, 1)),
        (4, "MOBILE", "5Z", dt.date(2022, 1, 1)),
    ], "vr_number long, fleet string, stock string, landed_date date")
    raw = spark.createDataFrame(
        [(v, "2021/06/01 12:30:00", 1.0, 2.0) for v in (1, 2, 3, 4)],
        "vr_number long, position_utc_date string, latitude double, longitude double")
    positions = parse_positions(raw)
    fleets = [fleet_trips(trips, f, "5Z", "2021-01-01", "2021-12-31") for f in ("MOBILE", "FIXED")]
    assert rows(fleet_positions(positions, *fleets), "vr_number") == [(1,), (2,)]
    means = vessel_day_mean_position(fleet_positions(positions, fleets[0]))
    assert rows(means) == [(1, dt.date(2021, 6, 1), 1.0, 2.0)]


def test_needed_days_bound_the_scan_of_positions(spark, tmp_path, capsys):
    spark.sql("select 1L vr_number, timestamp_ntz '2021-06-01 23:59:59' position_utc_date, 1e0 latitude, 2e0 longitude "
              "union all select 1L, timestamp_ntz '2021-06-03 00:00:00', 1e0, 2e0").write.parquet(str(tmp_path / "p"))
    days = spark.createDataFrame([(1, dt.date(2021, 5, 30)), (1, dt.date(2021, 6, 2))], "vr_number long, date date")
    found = positions_between(spark.read.parquet(str(tmp_path / "p")), days)
    assert found.count() == 1
    found.explain("formatted")
    text = capsys.readouterr().out
    assert "GreaterThanOrEqual(position_utc_date,2021-05-30T00:00)" in text and "LessThan(position_utc_date,2021-06-03T00:00)" in text
    assert positions_between(found, days.where("1 = 0")).count() == 0


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_the_track_is_cut_to_the_wanted_vessels_below_the_average(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(zones_module, "MOST_SENT_VESSELS", most)
    spark.range(2000).selectExpr(
        "id % 50 as vr_number", "timestamp'1997-01-01 00:00:00' + make_interval(0, 0, 0, 0, id % 500) as position_utc_date",
        "cast(id as double) as latitude", "cast(-id as double) as longitude").write.parquet(str(tmp_path / "track"))
    track = spark.read.parquet(str(tmp_path / "track"))
    spark.range(90).selectExpr("id % 7 as vr_number", "date'1997-01-01' + cast(id % 15 as int) as date").distinct().write.parquet(str(tmp_path / "days"))
    days = spark.read.parquet(str(tmp_path / "days"))
    whole = vessel_day_mean_position(track).join(days, ["vr_number", "date"], "left_semi")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cut = vessel_day_mean_position(track, days)
        plan = cut._jdf.queryExecution().optimizedPlan().toString()
        below = plan[plan.index("Aggregate"):]  # the tree's lines go from the top down
        assert ("strategy=broadcast" in below and "LeftSemi" in below) == (most > 0)
        assert rows(cut) == rows(whole) and rows(whole)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
