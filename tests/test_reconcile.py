import datetime as dt
import random
from collections import Counter

import pytest
from conftest import rows

from haulback.operators import (
    landing_errors, landing_errors_incorrect, landing_errors_missing, observer_check, observer_missing, reconcile,
)
from haulback.operators.reconcile import in_bins, near_landed_days, unroll_days

DAY = dt.date(2021, 5, 10)
LANDINGS = "vr_number long, trip_id long, set_id long, landed_date date, trip string"
OBSERVER = "vr_number long, trip string, landing_date date, setcd_id int, gearcd_id int"


def at(days):
    return DAY + dt.timedelta(days=days)


def expected(landings, observer, trust=True, one_match=False, tolerance=2):
    """The same rules row by row: first of the day, else all within the tolerance."""
    out = Counter()
    for vr, trip_id, set_id, day, trip in landings:
        trip = trip or ""
        same = sorted(((t, s, g) for v, t, d, s, g in observer if (v, d) == (vr, day) and t is not None))
        if same:
            found = [(same[0][0], "exact")]
        else:
            near = [
                (abs((d - day).days), t, s, g) for v, t, d, s, g in observer
                if None not in (v, vr, d, day, t) and v == vr and abs((d - day).days) <= tolerance
            ]
            found = [(n[1], "interval") for n in (sorted(near)[:1] if one_match else near)] or [(None, "none")]
        for obs, match in found:
            if match == "none":
                status, fixed = ("not_in_observer" if trip else "unobserved"), trip
            elif obs == trip:
                status, fixed = "agree", trip
            else:
                status = "incorrect" if trip else "missing"
                fixed = obs if trust or not trip else trip
            out[(vr, trip_id, set_id, day, trip, obs, match, status, fixed)] += 1
    return out


def actual(spark, landings, observer, **options):
    df = reconcile(spark.createDataFrame(landings, LANDINGS), spark.createDataFrame(observer, OBSERVER), **options)
    columns = ["vr_number", "trip_id", "set_id", "landed_date", "landed_trip", "obs_trip", "match", "status", "trip"]
    return Counter(tuple(r) for r in df.select(*columns).collect())


EDGE_LANDINGS = [
    (1, 1, 1, at(0), "J1"),  # agrees on the day
    (1, 2, 2, at(0), ""),  # blank on the day
    (1, 3, 3, at(0), "J9"),  # second genuine trip of the day counts as incorrect
    (2, 4, 4, at(2), "J2"), (2, 5, 5, at(-2), ""), (2, 6, 6, at(3), "J2"), (2, 7, 7, at(-3), ""),
    (3, 8, 8, at(0), None),  # null code is blank
    (4, 9, 9, at(1), "J4"),  # two observer rows in reach: appears twice
    (None, 10, 10, at(0), ""),  # no vessel: matches a vesselless observer row on the very day only
    (None, 11, 11, at(1), ""),
    (5, 12, 12, None, "J5"),
]
EDGE_OBSERVER = [
    (1, "J1", at(0), 1, 1), (1, "J9", at(0), 1, 1), (1, "J1", at(0), 2, 1), (2, "J2", at(0), 1, 1),
    (4, "J4", at(0), 1, 1), (4, "J4", at(0), 2, 1), (None, "J7", at(0), 1, 1), (5, "J5", at(0), 1, 1),
    (6, None, at(0), 1, 1),
]


@pytest.mark.parametrize("options", [{}, {"trust_observer": False}, {"one_match": True}])
def test_edges(spark, options):
    want = expected(EDGE_LANDINGS, EDGE_OBSERVER, options.get("trust_observer", True), options.get("one_match", False))
    assert actual(spark, EDGE_LANDINGS, EDGE_OBSERVER, **options) == want


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("one_match", [False, True])
def test_against_brute_force(spark, seed, one_match):
    rnd = random.Random(seed)
    vessel = lambda: rnd.choice([1, 1, 1, 2, 3, 4])  # noqa: E731  one vessel holds about half the rows
    landings = [
        (vessel(), i, i, at(rnd.randint(0, 30)), rnd.choice(["", "", f"J{rnd.randint(1, 9)}"])) for i in range(300)
    ]
    observer = [
        (vessel(), f"J{rnd.randint(1, 9)}", at(rnd.randint(0, 30)), rnd.randint(1, 2), rnd.randint(1, 2))
        for _ in range(40)
    ]
    assert actual(spark, landings, observer, one_match=one_match) == expected(landings, observer, True, one_match)


def test_other_tolerance(spark):
    assert actual(spark, EDGE_LANDINGS, EDGE_OBSERVER, tolerance_days=3) == expected(
        EDGE_LANDINGS, EDGE_OBSERVER, tolerance=3)


@pytest.mark.parametrize("tolerance", [8, 60])
@pytest.mark.parametrize("one_match", [False, True])
def test_long_tolerance_in_bins(spark, tolerance, one_match):
    rnd = random.Random(tolerance)
    vessel = lambda: rnd.choice([1, 1, 1, 2, 3, None])
    day = lambda: rnd.choice([None, *[at(rnd.randint(-400, 400))] * 15])  # noqa: E731  bins begin before and after 1970 alike
    landings = [(vessel(), i, i, day(), rnd.choice(["", f"J{rnd.randint(1, 9)}"])) for i in range(200)]
    observer = [(vessel(), rnd.choice([None, "J1", "J2", "J3"]), day(), rnd.randint(1, 2), 1) for _ in range(60)]
    want = expected(landings, observer, True, one_match, tolerance)
    assert actual(spark, landings, observer, tolerance_days=tolerance, one_match=one_match) == want
    assert any(k[6] == "interval" for k in want)


@pytest.mark.parametrize("tolerance", [0, 1, 2, 7, 60, 400])
def test_bins_give_the_unrolled_days_from_two_rows_at_most(spark, tolerance):
    rnd = random.Random(5)
    observer = spark.createDataFrame(
        [(rnd.randint(1, 3), f"J{i}", dt.date(1970, 1, 1) + dt.timedelta(days=rnd.randint(-300, 300)), 1, 1) for i in range(50)], OBSERVER)
    days = spark.createDataFrame(
        [(v, dt.date(1970, 1, 1) + dt.timedelta(days=d)) for v in (1, 2, 9) for d in range(-400, 400, 3)], "vr_number long, landed_date date")
    picked = ["vr_number", "landed_date", "trip", "days_off"]
    binned = near_landed_days(observer, days, tolerance).select(*picked)
    unrolled = unroll_days(observer, tolerance).join(days, ["vr_number", "landed_date"], "left_semi").select(*picked)
    assert rows(binned) == rows(unrolled)
    assert in_bins(observer, tolerance).count() <= 100


def test_every_landing_has_a_status_and_one_match_keeps_the_row_count(spark):
    df = reconcile(spark.createDataFrame(EDGE_LANDINGS, LANDINGS), spark.createDataFrame(EDGE_OBSERVER, OBSERVER), one_match=True)
    assert df.count() == len(EDGE_LANDINGS)
    assert df.where("status is null").count() == 0


def test_reports(spark):
    landings = EDGE_LANDINGS + [(1, 2, 22, at(0), "")]  # a second set of the same trip
    observer = spark.createDataFrame(EDGE_OBSERVER, OBSERVER)
    reconciled = reconcile(spark.createDataFrame(landings, LANDINGS), observer)
    assert rows(landing_errors_missing(reconciled), "trip_id", "trip", "obs_trip") == [
        (2, "", "J1"), (5, "", "J2"), (10, "", "J7")]
    incorrect = landing_errors_incorrect(reconciled)
    assert rows(incorrect, "trip_id", "trip", "obs_trip") == [(3, "J9", "J1")]
    assert rows(observer_check(observer, incorrect), "vr_number", "trip") == [(1, "J1"), (1, "J1")]
    assert rows(observer_missing(reconciled), "trip_id", "trip") == [(6, "J2"), (12, "J5")]
    comments = {r.comment for r in landing_errors(reconciled).collect()}
    assert comments == {"landing trip missing", "landing trip incorrect"}
