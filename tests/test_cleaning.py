import pytest
from conftest import rows
from pyspark.sql import functions as F

from haulback.operators import (
    add_cod_had_verdict, all_sets_fail_trips, early_failing_sets, failing_last_sets, flag_directed, flag_out_of_scope, kept, left_join_on_trip, mark_trips, remove_cod_directed, remove_no_panel, remove_noncommercial, remove_other_sought, remove_pollock_directed, removed_audit, semi_by, split_by, trip_reasons, trip_set_listing,
)
from haulback.session import materialize

SETS = [
    # trip_id, set_id, cod, had
    (1, 10, 9.0, 1.0), (1, 11, 1.0, 0.0),  # all fail (x/0 fails)
    (2, 20, 9.0, 1.0), (2, 21, 0.0, 0.0),  # undefined set saves the trip; last set undefined
    (3, 30, 1.0, 9.0), (3, 31, 9.0, 1.0),  # last set fails
    (4, 40, 9.0, 1.0), (4, 41, 1.0, 9.0),  # fails before the last
    (5, 50, 1.0, 9.0), (5, 51, 8.0, 10.0),  # exactly 0.8 is not met, but no set is above 0.8
    (6, 60, 1.0, 9.0), (6, 61, 9.0, 1.0), (6, 61, 1.0, 9.0),  # tied last set, not all rows fail
    (7, 70, 1.0, 9.0), (7, None, 9.0, 1.0),  # a null id is never last
    (8, 80, 8.0, 10.0),  # exactly 0.8 in the only set: all fail
    (9, 90, 9.0, 1.0), (9, 91, 1.0, 9.0), (9, 92, 9.0, 1.0),  # only the last of two failing sets goes
    (None, 100, 9.0, 1.0), (None, 101, 9.0, 1.0),  # sets without trip form one trip
    (10, 110, None, 5.0), (10, 111, 9.0, None),  # null weights are zero
    (11, 31, 1.0, 9.0),  # shares a set id with trip 3
]


@pytest.fixture()
def sets(spark):
    return spark.createDataFrame(SETS, "trip_id long, set_id long, cod double, had double")


def test_trip_and_last_set_rules(sets):
    verdicts = add_cod_had_verdict(sets)
    assert rows(all_sets_fail_trips(verdicts)) == [(None,), (1,), (8,)]
    assert rows(failing_last_sets(verdicts)) == [(3, 31), (9, 92), (10, 111)]


def test_remove_cod_directed(sets):
    left, removed = remove_cod_directed(sets)
    assert left.count() + removed.count() == len(SETS)
    assert rows(removed, "reason", "trip_id", "set_id") == [
        ("cod_directed_last_set", 3, 31), ("cod_directed_last_set", 9, 92), ("cod_directed_last_set", 10, 111),
        ("cod_directed_last_set", 11, 31),  # removal goes by set id
        ("cod_directed_trip", None, 100), ("cod_directed_trip", None, 101), ("cod_directed_trip", 1, 10),
        ("cod_directed_trip", 1, 11), ("cod_directed_trip", 8, 80)]


def test_listing_shows_sets_failing_before_the_last(sets):
    verdicts = add_cod_had_verdict(sets)
    listing = [tuple(r) for r in trip_set_listing(verdicts).select("trip_id", "set_id", "is_last").collect()]
    assert listing == [(3, 30, False), (3, 31, True), (9, 90, False), (9, 91, False), (9, 92, True),
                       (10, 110, False), (10, 111, True)]
    assert rows(early_failing_sets(verdicts)) == [(3, 2, 0), (9, 3, 1), (10, 2, 0)]


def test_pollock(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0, 2.0), (2, 1.0, 1.0, 2.1), (3, None, None, None), (4, None, 1.0, 2.0)],
                               "id int, cod double, had double, pol double")
    left, removed = remove_pollock_directed(df)
    assert (rows(left, "id"), rows(removed, "id")) == ([(1,), (3,)], [(2,), (4,)])


TRIPS = [("",), ("J1",), ("J2",), ("J3",), ("J4",), (None,)]


def test_flag_splits(spark):
    df = spark.createDataFrame(TRIPS, "trip string")
    observer = spark.createDataFrame([("J1", 7), ("J1", 7), ("J1", 1), ("J2", 1)], "trip string, setcd_id int")
    panels = spark.createDataFrame([("J2", 89), ("J2", 90), ("J3", 90)], "trip string, gearfcd_id int")
    sought = spark.createDataFrame([("J3", 10), ("J3", 12), ("J3", 13), ("J4", 11), ("J4", None)], "trip string, specscd_id int")
    for (left, removed), gone in (
        (remove_noncommercial(df, observer), "J1"), (remove_no_panel(df, panels), "J2"), (remove_other_sought(df, sought), "J3"),
    ):
        assert rows(removed) == [(gone,)]
        assert rows(left) == sorted((t for t in TRIPS if t != (gone,)), key=lambda t: (t[0] is not None, t[0]))


def test_membership_treats_null_as_a_value(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, k string")
    with_null = spark.createDataFrame([("a",), (None,), ("a",)], "k string")
    left, removed = split_by(df, with_null, "k")
    assert (rows(left, "id"), rows(removed, "id")) == ([(3,)], [(1,), (2,)])
    assert rows(semi_by(df, with_null.where("k is not null"), "k"), "id") == [(1,)]


def test_blank_trips_join_nothing_and_spread(spark):
    df = spark.range(3000).select(
        (F.col("id") % 50).alias("vr_number"), F.col("id").alias("set_id"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("J"), F.col("id").cast("string"))).otherwise("").alias("trip"))
    per_trip = spark.createDataFrame([("J3", 1), ("J6", 2), ("", 3)], "trip string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = left_join_on_trip(df, per_trip, "vr_number", "set_id")
        assert rows(out.where("v is not null"), "set_id", "v") == [(3, 1), (6, 2)]
        assert out.count() == 3000
        sizes = [r[0] for r in out.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert max(sizes) < 1000  # 2000 rows share the blank code
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_clean_gives_each_row_its_first_reason(spark):
    data = [
        # trip_id, set_id, trip, zone, cod, had, pol
        (1, 10, "J1", None, 9.0, 1.0, 0.0), (1, 11, "J1", 0, 9.0, 1.0, 0.0), (1, 12, "J1", 1, 9.0, 1.0, 0.0),
        (2, 20, "J2", 1, 9.0, 1.0, 0.0), (3, 30, "J3", 1, 9.0, 1.0, 0.0), (4, 40, "J4", 2, 1.0, 9.0, 0.0),
        (5, 50, "", 2, 9.0, 1.0, 0.0), (6, 60, "", 2, 1.0, 9.0, 0.0), (6, 61, "", 2, 9.0, 1.0, 99.0),
        (7, 70, "", 2, 1.0, 9.0, 99.0), (7, 71, "", 2, 1.0, 9.0, None), (8, 80, "", None, 1.0, 9.0, 0.0),
        (8, 81, "", 3, 9.0, 1.0, 0.0),  # its met set has no zone, so the rest of the trip fails
    ]
    df = spark.createDataFrame(data, "trip_id long, set_id long, trip string, zone int, cod double, had double, pol double")
    df = df.withColumn("vr_number", F.lit(1))
    observer = spark.createDataFrame([("J1", 7), ("J2", 1)], "trip string, setcd_id int")
    panels = spark.createDataFrame([("J2", 89), ("J1", 89)], "trip string, gearfcd_id int")
    sought = spark.createDataFrame([("J3", 12), ("J2", 12)], "trip string, specscd_id int")
    zoned = left_join_on_trip(df, trip_reasons(observer, panels, sought), "vr_number", "trip_id", "set_id")
    out = flag_directed(materialize(flag_out_of_scope(zoned), "flagged"))
    assert dict(rows(out, "set_id", "reason")) == {
        10: "zone_unresolved", 11: "zone_invalid", 12: "noncommercial", 20: "no_panel", 30: "other_species_sought",
        40: None, 50: "cod_directed_trip", 60: None, 61: "cod_directed_last_set", 70: "pollock_directed", 71: None,
        80: "zone_unresolved", 81: "cod_directed_trip"}
    assert kept(out).count() + removed_audit(out).count() == len(data)
    assert rows(out.where("set_id = 71"), "pol") == [(0.0,)]


@pytest.mark.parametrize(("kind", "top"), [("int", 2**31 - 1), ("bigint", 2**63 - 1)])
def test_last_set_of_large_ids_and_null_trips(spark, kind, top):
    data = [
        (1, top - 1, 1.0, 9.0), (1, top, 9.0, 1.0),  # the last fails
        (2, top - 1, 9.0, 1.0), (2, top, 1.0, 9.0),  # the last passes
        (None, top - 3, 1.0, 9.0), (None, top - 2, 9.0, 1.0),  # a null trip is a trip
        (3, top - 5, 9.0, 1.0), (3, top - 5, 1.0, 9.0), (3, top - 6, 9.0, 1.0),  # one row of the last set passes
    ]
    sets = add_cod_had_verdict(spark.createDataFrame(data, f"trip_id int, set_id {kind}, cod double, had double"))
    assert rows(failing_last_sets(sets)) == [(None, top - 2), (1, top)]
    listed = trip_set_listing(sets)
    assert rows(listed, "trip_id", "set_id", "is_last") == [
        (None, top - 3, False), (None, top - 2, True), (1, top - 1, False), (1, top, True)]


def test_flagged_trips_are_marked_by_one_salted_join(spark):
    df = spark.createDataFrame([("J1", 1), ("J2", 2), ("", 3), ("", 4)], "trip string, set_id int")
    flagged = spark.createDataFrame([("J1",), ("J1",), ("",)], "trip string")
    marked = mark_trips(df, flagged)
    assert rows(marked, "set_id", "removed") == [(1, True), (2, False), (3, False), (4, False)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = marked._jdf.queryExecution().toString()
        physical = text[text.index("== Physical"):]
        assert physical.count("LeftOuter") == 1 and "trip_salt" in physical
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
