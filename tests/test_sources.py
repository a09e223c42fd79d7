import datetime as dt
import json
from types import SimpleNamespace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from haulback import materialize, shared_folder
from haulback.operators import landings, observer_trips, separator_panels, sought_species
from haulback.sources import (
    LandingTables, ObserverTables, check_landings_csv, publish_reports, read_landings_csv, read_reports, read_results_csv, read_tables,
    write_report,
)

CSV = """VR_NUMBER_FISHING,VESSEL_NAME,TRIP_ID,extra,LOG_EFRT_STD_INFO_ID,LANDED_DATE,DATA_VALUE,110,100,170,LAT
1,Alpha,10,x,100,3/1/2021,J1,5,2.5,,42.5
2,"Be, ta",11,y,101,04-Jan-21,,NA,1,0,
bad,Gamma,12,z,102,nonsense,"",1,1,1,41
"""


def test_landings_csv_is_read_by_name(spark, tmp_path):
    (tmp_path / "landings.csv").write_text(CSV)
    df = read_landings_csv(spark, str(tmp_path / "landings.csv"))
    assert rows(df, "vr_number", "vessel_name", "set_id", "landed_date", "trip", "cod", "had", "pol", "lat") == [
        (None, "Gamma", 102, None, "", 1.0, 1.0, 1.0, 41.0),
        (1, "Alpha", 100, dt.date(2021, 1, 3), "J1", 2.5, 5.0, None, 42.5),
        (2, "Be, ta", 101, dt.date(2021, 1, 4), "", 1.0, None, 0.0, None)]


def test_csv_files_of_other_column_order_are_not_mixed_up(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(CSV)
    (tmp_path / "in" / "b.csv").write_text(CSV.replace("110,100,", "100,110,", 1))
    with pytest.raises(Exception, match="(?s)CSV header does not conform"):
        read_landings_csv(spark, str(tmp_path / "in")).collect()


def test_a_missing_column_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text(CSV.replace("TRIP_ID", "OTHER"))
    with pytest.raises(ValueError, match="TRIP_ID"):
        read_landings_csv(spark, str(tmp_path / "a.csv"))


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_report_round_trip(spark, tmp_path, fmt):
    df = spark.createDataFrame([("a", 1.5), ("b", None)], "zones_q string, mean double")
    for _ in range(2):  # overwrites
        write_report(df, str(tmp_path / "out"), fmt)
    back = read_results_csv(spark, str(tmp_path / "out")) if fmt == "csv" else spark.read.parquet(str(tmp_path / "out"))
    assert rows(back) == [("a", 1.5), ("b", None)]


def test_materialize_writes_to_the_configured_folder(spark):
    df = materialize(spark.range(5), "five")
    assert df.count() == 5
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert df.inputFiles() and all(shared_folder(spark) in path for path in df.inputFiles())


def test_a_cluster_must_name_its_shared_folder():
    def session(master, folder, checkpoint=None, mount=None):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default: folder if key == "spark.checkpoint.dir" else (mount or default)),
            sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint))

    assert shared_folder(session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert shared_folder(session("yarn", None, "hdfs:///set/by/user")) == "hdfs:///set/by/user"
    for folder in (None, "file:///tmp/own"):
        with pytest.raises(RuntimeError):
            shared_folder(session("yarn", folder))
    assert shared_folder(session("yarn", "file:///mnt/shared", mount="true")) == "file:///mnt/shared"
    assert shared_folder(session("local[2]", "file:///tmp/own")) == "file:///tmp/own"


def landing_tables(spark):
    make = spark.createDataFrame
    ts = dt.datetime
    fact = [
        (1, 10, ts(2021, 1, 5), 100, ts(2021, 1, 4), 12, 198, "420530", None, 9, 50, 1000, 100, 5.0),
        (1, 10, ts(2021, 1, 5), 100, ts(2021, 1, 4), 12, 198, "420530", None, 9, 50, 1000, 110, 7.0),
        (1, 10, ts(2021, 1, 5), 100, ts(2021, 1, 4), 12, 198, "420530", None, 9, 51, 1000, 170, 3.0),  # other quota, same fleet
        (1, 10, ts(2021, 1, 5), 100, ts(2021, 1, 4), 12, 198, "420530", None, 9, 50, 1000, 999, 8.0),  # other species
        (1, 11, ts(2022, 1, 1), 101, ts(2021, 12, 31), 12, 198, None, None, 9, 50, 1001, 100, 5.0),  # next year
        (1, 12, ts(2021, 5, 5), 102, ts(2021, 5, 4), 12, 300, None, None, 9, 50, 1002, 100, 5.0),  # other area
        (1, 13, ts(2021, 5, 5), 103, ts(2021, 5, 4), 12, 199, None, "660000", 9, 50, 1003, 999, 5.0),  # no target species
        (1, 14, ts(2021, 5, 5), 104, ts(2021, 5, 4), 12, 199, None, None, 9, 52, 1004, 100, 5.0),  # quota without fleet
    ]
    return LandingTables(
        pro_spc_info=make(fact, "VR_NUMBER_FISHING long, TRIP_ID long, LANDED_DATE timestamp, LOG_EFRT_STD_INFO_ID long, "
                          "DATE_FISHED timestamp, GEAR_CODE int, NAFO_UNIT_AREA_ID int, LATITUDE string, LONGITUDE string, "
                          "LICENCE_ID long, LIC_QUOTA_ID long, MON_DOC_ID long, SPECIES_CODE int, RND_WEIGHT_KGS double"),
        vessels=make([(1, "Alpha", 60.0, 50.0)], "VR_NUMBER long, VESSEL_NAME string, GROSS_TONNAGE double, LOA double"),
        areas=make([(198, "5ZEJ"), (199, "5ZEM"), (300, "4X")], "AREA_ID int, AREA string"),
        sflt_descs=make([(881, "mobile")], "SFLT_DESC_ID int, DESC_ENG string"),
        sflt_quotas=make([(5, 881, 1), (6, 881, 1), (7, 881, 2)], "SFLT_QUOTA_ID long, SFLT_DESC_ID int, FLEET_QUOTA_ID int"),
        fleet_quotas=make([(1,)], "FLEET_QUOTA_ID int"),
        lic_quotas=make([(50, 5), (51, 6), (52, 7)], "LIC_QUOTA_ID long, SFLT_QUOTA_ID long"),
        mon_doc_entrd_dets=make([(1000, 741, "J1"), (1000, 3, "other"), (1003, 3, "other")],
                                "MON_DOC_ID long, COLUMN_DEFN_ID int, DATA_VALUE string"),
    )


def test_landings_query(spark):
    out = landings(landing_tables(spark), 2021)
    columns = ["set_id", "trip", "cod", "had", "pol", "q", "tc", "lc", "lat", "lon"]
    assert rows(out, *columns) == [
        (100, "J1", 5.0, 7.0, 3.0, 1, 3, 3, 42 + 5 / 60 + 30 / 6000, None),
        (103, "", 0.0, 0.0, 0.0, 2, 3, 3, None, -66.0)]
    assert rows(landings(landing_tables(spark), 2021, documents="inner"), "set_id") == [(100,)]
    assert rows(landings(landing_tables(spark), (2021, 2022), [198, 300]), "set_id") == [(100,), (101,), (102,)]


def test_tables_can_be_read_from_a_folder(spark, tmp_path):
    tables = landing_tables(spark)
    for name in LandingTables.__dataclass_fields__:
        getattr(tables, name).write.parquet(str(tmp_path / name))
    again = read_tables(spark, LandingTables, str(tmp_path))
    assert rows(landings(again, 2021), "set_id", "cod") == rows(landings(tables, 2021), "set_id", "cod")


def observer_tables(spark):
    make = spark.createDataFrame
    day = lambda m, d, y=2021: dt.datetime(y, m, d)
    return ObserverTables(
        isvessels=make([(1, "501", "Alpha"), (2, "X9", "Beta")], "vess_id int, cfv string, vessel_name string"),
        istrips=make([(10, 1, "J10", 7001, 5, day(3, 9)), (11, 2, "J11", 7001, 6, day(1, 1, 2022))],
                     "trip_id int, vess_id int, trip string, tripcd_id int, conf_number int, landing_date timestamp"),
        isfishsets=make([
            (100, 10, 1, "5ZEJ", 1, 1, 10), (101, 10, 2, "5ZEM", 1, 2, 12), (102, 10, 3, "5ZEM", 1, 3, 10),
            (103, 10, 1, "4X", 1, 4, 10), (104, 11, 1, "5ZU", 7, 5, None),
        ], "fishset_id int, trip_id int, gear_id int, nafarea_id string, setcd_id int, set_no int, specscd_id int"),
        issetprofile=make([
            (100, day(3, 1), 42.0, 67.0, 1), (100, day(3, 2), 41.0, 68.0, 2), (101, day(3, 5), 40.0, 66.0, 2),
            (102, day(3, 6), 30.0, 60.0, 2), (103, day(3, 7), 20.0, 50.0, 2), (104, day(12, 31), 42.0, 67.0, 1),
            (100, day(1, 1, 2020), 1.0, 1.0, 3),
        ], "fishset_id int, setdate timestamp, latitude double, longitude double, pntcd_id int"),
        isgears=make([(1, 12), (2, 12), (3, 71)], "gear_id int, gearcd_id int"),
        isgearfeatures=make([(1, 89), (2, 90), (1, 91), (3, 89)], "gear_id int, gearfcd_id int"),
    )


def test_observer_trips(spark):
    out = observer_trips(observer_tables(spark), 2021)
    found = rows(out.selectExpr("vr_number", "trip", "gearcd_id", "setcd_id", "cast(min_date as date)",
                                "cast(max_date as date)", "lat2", "lon2", "landing_date"))
    assert found == [
        (None, "J11", 12, 7, dt.date(2021, 12, 31), dt.date(2021, 12, 31), 42.0, -67.0, dt.date(2022, 1, 1)),
        (501, "J10", 12, 1, dt.date(2021, 3, 1), dt.date(2021, 3, 5), 40.0, -66.0, dt.date(2021, 3, 9))]


def test_panels_and_sought(spark):
    tables = observer_tables(spark)
    assert rows(separator_panels(tables, 2021), "trip", "gearcd_id", "gearfcd_id", "n_sets") == [
        ("J10", 12, 89, 1), ("J10", 12, 90, 1)]
    assert rows(sought_species(tables, 2021), "trip", "gearcd_id", "specscd_id", "set_no") == [
        ("J10", 12, 10, 1), ("J10", 12, 10, 1), ("J10", 12, 12, 2), ("J10", 71, 10, 3)]


def test_bad_records_go_to_quarantine(spark, tmp_path):
    path = tmp_path / "landings.csv"
    path.write_text(
        "TRIP_ID,VR_NUMBER_FISHING,LOG_EFRT_STD_INFO_ID,LANDED_DATE,DATA_VALUE,100,110,170,REMARK\n"
        "1,2,3,31/1/2021,J1,1.5,2,,fine\n"
        "1,2,4,31/2/2021,,much,2,3,no such day\n"
        "1,2,5,1/2/2021\n"
        "1,2,6,1/2/2021,,1,2,3,four,five\n"
        "one,2,7,NA,NA, ,2,3,\n")
    found = check_landings_csv(spark, str(path))
    assert rows(found.rows, "set_id", "trip_id", "cod", "trip") == [(3, 1, 1.5, "J1"), (4, 1, None, ""), (7, None, None, "")]
    assert {r.record.split(",")[2] if r.problems == ["number of fields"] else json.loads(r.record)["LOG_EFRT_STD_INFO_ID"]: r.problems for r in found.quarantine.collect()} == {
        "4": ["LANDED_DATE", "100"], "5": ["number of fields"], "6": ["number of fields"], "7": ["TRIP_ID"]}
    assert rows(found.problem_counts()) == [("100", 1), ("LANDED_DATE", 1), ("TRIP_ID", 1), ("number of fields", 2)]


def test_a_failed_write_leaves_the_version_before(spark, tmp_path):
    folder = str(tmp_path / "out")
    table = spark.createDataFrame([(1, 881, 2, "a"), (2, None, None, "b"), (3, 90, 4, "c")], "id int, sector int, q int, name string")
    plain = spark.createDataFrame([(1.5,)], "x double")
    with pytest.raises(ValueError, match="no published version"):
        read_reports(spark, folder)
    first = publish_reports({"trips": table, "plain": plain}, folder)
    assert (tmp_path / "out" / "tables" / first / "trips" / "sector=881" / "q=2").is_dir()
    broken = table.withColumn("name", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        publish_reports({"plain": plain.withColumn("x", F.col("x") * 2), "trips": broken}, folder)
    back = read_reports(spark, folder)
    assert rows(back["trips"].select(table.columns)) == rows(table) and rows(back["plain"]) == [(1.5,)]
    second = publish_reports({"plain": plain.withColumn("x", F.col("x") * 2)}, folder)
    assert rows(read_reports(spark, folder)["plain"]) == [(3.0,)] and second > first
    assert rows(read_reports(spark, folder, first)["plain"]) == [(1.5,)]
