"""Every registered query: same result as its SQL, and a plan that scales."""

import contextlib
import io

import check_queries
import pytest

import __spark_entry__ as driver
from haulback.operators import add_cod_had_verdict, landings_crosstab, match_table, reconcile, trip_verdicts
from haulback.plans.oracle import ORACLE
from haulback.plans.registry import Steps, queries
from haulback.plans.standins import STANDIN_SQL
from haulback.session import materialize, watch_written

SF = "/root/testdata/sf0.001"
QUERIES, SQL = queries(), ORACLE
NO_ROWS_AT_THIS_SIZE = {"fully_covered_quarters"}


def plan(df, mode="simple"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.fixture(scope="module")
def con():
    return check_queries.connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


BAD_NODES = ("CartesianProduct", "NestedLoopJoin", "Python", "Pandas", "SinglePartition")


def bad_stages(query):
    """Nodes that don't scale, in the plan of the result or of any table written on the way."""
    with watch_written() as written:
        df = query()
    found = [(bad, frame.columns) for frame in [*(f for f, _ in written), df] for bad in BAD_NODES if bad in plan(frame)]
    return df, found


@pytest.mark.parametrize("key", list(QUERIES))
def test_query_equals_its_sql(spark, con, key):
    df, found = bad_stages(lambda: QUERIES[key](spark, SF))
    assert not found
    problems = [p for p in check_queries.compare(df, con, SQL[key]) if not (p == "no rows" and key in NO_ROWS_AT_THIS_SIZE)]
    assert not problems


def test_a_single_partition_behind_a_written_table_is_seen(spark):
    def planted():
        ranked = spark.range(10).selectExpr("id", "row_number() over (order by id) as n")
        return materialize(ranked, "planted").groupBy("n").count()

    _, found = bad_stages(planted)
    assert [bad for bad, _ in found] == ["SinglePartition"]


def test_observer_sets_meet_the_years_trips_first(spark):
    for step in (Steps.panels, Steps.sought):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            text = plan(step(Steps(spark, SF)), "extended")
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        optimized = text[text.index("Optimized"):text.index("Physical")]
        lines = optimized.splitlines()
        depth = lambda line: len(line) - len(line.lstrip(" :+-"))
        semi = [depth(x) for x in lines if "Join LeftSemi" in x]
        profile = [depth(x) for x in lines if "Join Inner" in x and "fishset_id" in x]
        assert semi and profile and min(semi) > min(profile)


def test_entry_is_the_full_pipeline(spark):
    df = driver.entry(spark)
    assert df.columns == ["vessel", "licence_id", "analysis_group", "codkg", "haddockkg", "portion", "discardsmt"]
    assert df.count() > 0


def test_year_and_area_reach_the_scan(spark):
    text = plan(landings_crosstab(Steps(spark, SF).s.landing_tables(), 1997), "formatted")
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01T00:00)" in text
    assert "LessThan(o_orderdate,1998-01-01T00:00)" in text


def test_area_prefix_and_gear_filters_run_before_the_joins(spark):
    text = plan(Steps(spark, SF).observer(), "extended")
    optimized = text[text.index("Optimized"):text.index("Physical")]
    assert "StartsWith" in optimized and optimized.index("Join") < optimized.index("StartsWith")


def test_scan_reads_only_the_needed_columns(spark):
    text = plan(landings_crosstab(Steps(spark, SF).s.landing_tables(), 1997), "formatted")
    (lineitem,) = [line for line in text.splitlines() if "ReadSchema" in line and "l_orderkey" in line]
    assert "l_extendedprice" not in lineitem and "l_shipdate" not in lineitem


def test_trip_pass_is_a_hash_aggregation(spark):
    sets = spark.sql(
        "select * from values (1L, 1L, 1e0, 1e0) t(trip_id, set_id, cod, had)")
    text = plan(trip_verdicts(add_cod_had_verdict(sets.repartition(2))))
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text


def test_reconcile_joins_landings_once_on_two_equal_keys(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = Steps(spark, SF)
        landings = spark.read.parquet(SF + "/orders.parquet").selectExpr(
            "o_custkey as vr_number", "o_orderkey as trip_id", "o_orderkey as set_id",
            "cast(o_orderdate as date) as landed_date", "'' as trip")
        observer = p.s.table("istrips").selectExpr(
            "vess_id as vr_number", "trip", "landing_date", "1 as setcd_id", "1 as gearcd_id")
        text = plan(reconcile(landings, observer))
        assert text.count("LeftOuter") == 1 and "NestedLoop" not in text
        assert match_table(observer).columns == ["vr_number", "landed_date", "obs_trip", "match"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stand_ins_use_whole_tables():
    for name, sql in STANDIN_SQL.items():
        assert "limit" not in sql.lower(), name
        filters = [part for part in sql.split(" where ")[1:]]
        assert all("%" not in f for f in filters), name
