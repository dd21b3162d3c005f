"""Unit tests of the scalar expressions at their edges."""

import datetime as dt
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from legwise.functions import hashing as H
from legwise.functions import labels as L
from legwise.functions import timefns as T
from legwise.functions.text import py_number_text


def one(spark, expr, schema=None, row=None):
    df = spark.createDataFrame([row or (1,)], schema or "x int")
    return df.select(expr.alias("v")).first()["v"]


@pytest.mark.parametrize("service,mode,expected", [
    ("AGENCY_FIXED_ROUTE", "walk", "FIXED_ROUTE"),
    ("AGENCY_DEMAND_RESPONSE", None, "DEMAND_RESPONSE"),
    ("X", "Walk", "WALK"), ("X", "BIKE", "BIKE"), ("X", "bikeshare", "BIKE"),
    ("X", "Scooter", "SCOOTER"), ("X", "rideshare", "RIDESHARE"), ("X", "TRANSIT", "OTHER_TRANSIT"),
    ("X", "ferry", "OTHER"), (None, None, "OTHER"),
])
def test_service_group(spark, service, mode, expected):
    df = spark.createDataFrame([(service, mode)], "s string, m string")
    assert df.select(L.service_group("s", "m")).first()[0] == expected


def test_provider_name(spark):
    df = spark.createDataFrame([("BIKESHARE",), ("SOMETHING",), (None,)], "s string")
    assert [r[0] for r in df.select(L.provider_name("s")).collect()] == ["BIKESHARE", "(UNKNOWN)", "(UNKNOWN)"]


def test_blank_semantics(spark):
    df = spark.createDataFrame([(None,), ("",), ("   ",), ("R1 ",)], "r string")
    got = [r[0] for r in df.select(L.coalesce_blank("r", "(NA)")).collect()]
    assert got == ["(NA)", "(NA)", "(NA)", "R1 "]  # value itself is not trimmed


def test_bg_length_ignores_trailing_blanks(spark):
    df = spark.createDataFrame([("480290000001",), ("480290000001  ",), ("48029000001",), (None,)], "b string")
    assert [r[0] for r in df.select(L.bg_is_valid("b")).collect()] == [True, True, False, False]


@pytest.mark.parametrize("prev,cur,pr,r,flag,ttype", [
    (None, "AGENCY_FIXED_ROUTE", None, "R1", 0, None),
    ("AGENCY_FIXED_ROUTE", "AGENCY_FIXED_ROUTE", "R1", "R1", 0, "OTHER"),
    ("AGENCY_FIXED_ROUTE", "AGENCY_FIXED_ROUTE", "R1", "R2", 1, "ROUTE_CHANGE"),
    ("AGENCY_FIXED_ROUTE", "AGENCY_FIXED_ROUTE", None, "", 0, "OTHER"),
    ("AGENCY_FIXED_ROUTE", "AGENCY_DEMAND_RESPONSE", "R1", None, 1, "FIXED_TO_DEMAND"),
    ("AGENCY_DEMAND_RESPONSE", "AGENCY_FIXED_ROUTE", None, "R1", 1, "DEMAND_TO_FIXED"),
    ("AGENCY_DEMAND_RESPONSE", "AGENCY_DEMAND_RESPONSE", None, None, 0, "OTHER"),
    ("WALKING", "AGENCY_FIXED_ROUTE", None, "R1", 0, "OTHER"),
])
def test_transfer(spark, prev, cur, pr, r, flag, ttype):
    df = spark.createDataFrame([(prev, cur, pr, r)], "p string, c string, pr string, r string")
    row = df.select(L.is_transfer_leg("p", "c", "pr", "r"), L.transfer_type("p", "c", "pr", "r")).first()
    assert (row[0], row[1]) == (flag, ttype)


def test_route_labels(spark):
    rows = [("AGENCY_DEMAND_RESPONSE", "R1", "x"), ("AGENCY_FIXED_ROUTE", "", "x"),
            ("AGENCY_FIXED_ROUTE", "R9", "x"), ("WALKING", None, "WALK"), ("BIKESHARE", "", "bike"),
            ("BIKESHARE", "B2", "bike")]
    df = spark.createDataFrame(rows, "s string, r string, m string")
    got = [x[0] for x in df.select(L.to_route_label("s", "r", "m")).collect()]
    assert got == ["DEMAND_RESPONSE", "(UNKNOWN_ROUTE)", "R9", "WALK", "(NA)", "B2"]
    got = [x[0] for x in df.select(L.from_route_label("s", "r")).collect()]
    assert got == ["DEMAND_RESPONSE", "(UNKNOWN_ROUTE)", "R9", "(NA)", "(NA)", "B2"]  # no walk arm
    nul = spark.createDataFrame([(None, "R1")], "s string, r string")
    assert nul.select(L.from_route_label("s", "r")).first()[0] is None


@pytest.mark.parametrize("lon,lat,expected", [
    (-98.4936, 29.4241, "COORD_-98.4936_29.4241"),
    (-100.1234, 29.4, "COORD_-100.123_29.4"),
    (-98.70004, 29.20006, "COORD_-98.7_29.2001"),
    (None, None, "COORD__"),
    (None, 29.5, "COORD__29.5"),
])
def test_hotspot_key_coords(spark, lon, lat, expected):
    df = spark.createDataFrame([(None, lon, lat)], "s string, x double, y double")
    assert df.select(L.hotspot_key("s", "x", "y")).first()[0] == expected


def test_hotspot_key_prefers_stop(spark):
    df = spark.createDataFrame([("STOP_1", 1.0, 2.0), ("  ", 1.0, 2.0)], "s string, x double, y double")
    assert [r[0] for r in df.select(L.hotspot_key("s", "x", "y")).collect()] == ["STOP_1", "COORD_1_2"]


def test_utf16_hash(spark):
    df = spark.createDataFrame([("STOP_1",), ("Plaza Mayor ñ",)], "k string")
    got = [r[0] for r in df.select(H.utf16_sha256_hex("k")).collect()]
    assert got == [hashlib.sha256(k.encode("utf-16-le")).hexdigest() for k in ("STOP_1", "Plaza Mayor ñ")]


@pytest.mark.parametrize("v", [0.0005, 0.00015, 1e-05, 1e7, 12345678.5, 1e16, 1.5e20, -98.69999999999999,
                               29.2, 0.0, -0.0, 123456789.125, 0.001, 2.5e-300, float("inf"),
                               float("-inf"), float("nan"), -1234.5, 1e22, 9007199254740993.0,
                               1.7976931348623157e308, 0.1, 123456.789e3])
def test_py_number_text(spark, v):
    df = spark.createDataFrame([(v,)], "x double")
    assert df.select(py_number_text("x")).first()[0] == repr(v)


def test_row_hash_null_vs_empty_and_zero(spark):
    fields = H.ROW_HASH_FIELDS
    base = {f: None for f in fields}
    df = spark.createDataFrame([tuple(base.values())], ", ".join(f"{f} string" for f in fields))
    got = df.select(H.row_hash_hex()).first()[0]
    assert got == hashlib.sha256("|".join([""] * len(fields)).encode()).hexdigest()


def test_leg_minutes_boundaries(spark):
    rows = [(dt.datetime(2024, 1, 1, 0, 0, 0, 900000), dt.datetime(2024, 1, 1, 0, 0, 1, 100000)),
            (dt.datetime(2024, 1, 1, 0, 0, 0), dt.datetime(2024, 1, 1, 0, 7, 0)),
            (dt.datetime(2024, 1, 1, 0, 5, 0), dt.datetime(2024, 1, 1, 0, 4, 0)),
            (dt.datetime(2024, 1, 1, 0, 5, 0), None)]
    df = spark.createDataFrame(rows, "s timestamp_ntz, e timestamp_ntz")
    got = [r[0] for r in df.select(T.leg_minutes("s", "e")).collect()]
    assert got[0] == pytest.approx(1 / 60.0)
    assert got[1] == pytest.approx(7.0)
    assert got[2] is None and got[3] is None


def test_parse_utc_and_floor(spark):
    df = spark.createDataFrame([("2024-01-05T10:00:00+05:00",), ("2024-01-01 00:00:07.179575",), ("junk",)],
                               "t string")
    got = [r[0] for r in df.select(T.floor_ms(T.parse_utc("t"))).collect()]
    assert got == [dt.datetime(2024, 1, 5, 5, 0), dt.datetime(2024, 1, 1, 0, 0, 7, 179000), None]


def test_window_edges(spark):
    days = [dt.date(2024, 1, 1), dt.date(2023, 12, 31), dt.date(2024, 1, 31), dt.date(2024, 2, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r[0] for r in df.select(T.in_window("d", "2024-02-01", 31)).collect()]
    assert got == [True, False, True, False]  # today excluded


def test_file_trip_date(spark):
    df = spark.createDataFrame([("2024-01-05",), ("not-a-date",), ("2024-01-05 13:00:00",)], "t string")
    got = [r[0] for r in df.select(T.file_trip_date("t")).collect()]
    assert got == [dt.date(2024, 1, 5), None, dt.date(2024, 1, 5)]
