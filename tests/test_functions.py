import datetime as dt
import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from haulback.functions import (
    assign_group, blank_to_empty, cod_had_ratio, decode_packed, floor_zero, in_years, length_class, observed_flag,
    parse_dmy, pollock_dominant, safe_ratio, sector_of, tonnage_class,
)


def one(spark, expression):
    return spark.range(1).select(expression.alias("v")).first().v


@pytest.mark.parametrize("value, expected", [
    (None, None), (-3.0, 1), (24.99, 1), (25.0, 2), (49.9, 2), (50.0, 3), (150.0, 4), (500.0, 5), (999.9, 5),
    (1000.0, 6), (2000.0, 7), (float("nan"), None),
])
def test_tonnage_class(spark, value, expected):
    assert one(spark, tonnage_class(F.lit(value).cast("double"))) == expected


def test_length_class(spark):
    df = spark.createDataFrame([(34.9,), (35.0,), (45.0,), (65.0,), (100.0,), (124.9,), (125.0,)], "loa double")
    assert [r[0] for r in df.select(length_class(F.col("loa"))).collect()] == [1, 2, 3, 4, 5, 5, 6]


@pytest.mark.parametrize("packed, expected", [
    ("420530", 42 + 5 / 60 + 30 / 6000), ("400000", 40.0), (None, None), ("42", None), ("4x0530", None),
])
def test_packed_position(spark, packed, expected):
    north = one(spark, decode_packed(F.lit(packed).cast("string")))
    west = one(spark, decode_packed(F.lit(packed).cast("string"), -1))
    if expected is None:
        assert north is None and west is None
    else:
        assert north == pytest.approx(expected) and west == pytest.approx(-expected)


@pytest.mark.parametrize("code, expected", [
    (90, 90), (95, 90), (12195, 90), (9317, 89), (881, 881), (6875, 884), (1472, 885), (1817, 886), (1523, 311),
    (3328, 3328), (96, None), (999, None), (None, None),
])
def test_sector(spark, code, expected):
    assert one(spark, sector_of(F.lit(code).cast("int"))) == expected


@pytest.mark.parametrize("sector, zone, quarter, expected", [
    (311, None, None, "311_Z12345_Q1234"), (885, 4, 2, "885_Z12345_Q1234"), (881, 1, 1, "881_Z1_Q1"),
    (3328, 1, 2, "881_Z1_Q23"), (3328, 1, 3, "881_Z1_Q23"), (881, 1, 4, "881_Z1_Q4"), (881, 2, 3, "881_Z2_Q3"),
    (881, 3, 1, "881_Z3_Q1"), (881, 3, 4, "881_Z3_Q234"), (881, 5, 2, "881_Z45_Q1234"), (881, 6, 2, None),
    (881, None, 2, None), (90, 1, 1, None), (None, 1, 1, None),
])
def test_group(spark, sector, zone, quarter, expected):
    args = [F.lit(v).cast("int") for v in (sector, zone, quarter)]
    assert one(spark, assign_group(*args)) == expected


def test_group_first_match_wins(spark):
    rules = [("first", [1], None, None), ("second", [1], [1], [1])]
    assert one(spark, assign_group(F.lit(1), F.lit(1), F.lit(1), rules)) == "first"


@pytest.mark.parametrize("text, expected", [
    ("3/1/2021", dt.date(2021, 1, 3)), ("31-12-2021", dt.date(2021, 12, 31)), ("05-Mar-21", dt.date(2021, 3, 5)),
    ("05-Mar-2021", dt.date(2021, 3, 5)), ("not a date", None), (None, None), ("31/2/2021", None),
])
def test_parse_dmy(spark, text, expected):
    assert one(spark, parse_dmy(F.lit(text).cast("string"))) == expected


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
def test_in_years(spark, kind):
    days = ["2020-12-31 23:59:59", "2021-01-01 00:00:00", "2021-12-31 23:59:59", "2022-01-01 00:00:00"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select("d", F.col("d").cast("timestamp_ntz").cast(kind).alias("t"))
    assert rows(df.where(in_years(df, "t", 2021)), "d") == [(days[1],), (days[2],)]
    assert df.where(in_years(df, "t", (2020, 2021))).count() == 3


@pytest.mark.parametrize("cod, had, expected", [
    (8.0, 10.0, 0.8), (1.0, 0.0, math.inf), (0.0, 0.0, None), (0.0, 5.0, 0.0), (None, 5.0, None),
])
def test_cod_had_ratio(spark, cod, had, expected):
    assert one(spark, cod_had_ratio(F.lit(cod).cast("double"), F.lit(had).cast("double"))) == expected


def test_small_helpers(spark):
    assert one(spark, safe_ratio(F.lit(1e0), F.lit(0e0))) is None
    assert one(spark, floor_zero(F.lit(0e0))) == 1 and one(spark, floor_zero(F.lit(2e0))) == 2
    assert one(spark, pollock_dominant(F.lit(1e0), F.lit(1e0), F.lit(2e0))) is False
    assert one(spark, blank_to_empty(F.lit(None).cast("string"))) == ""
    assert [one(spark, observed_flag(F.lit(t).cast("string"))) for t in ("", "J1", None)] == [0, 1, None]
