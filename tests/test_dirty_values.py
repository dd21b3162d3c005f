"""Values outside the fixtures: numbers, float text, times, route labels, links."""

import pytest
from pyspark.sql import functions as F

from legwise.functions import labels as L
from legwise.functions.text import py_number_text
from legwise.functions.timefns import file_trip_date, parse_utc
from legwise.operators.clean import to_number
from legwise.operators.sequence import sequence_within


def column(spark, values, kind, expr):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r["x"] for r in df.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


def test_number_coercion(spark):
    cases = {"1.5": 1.5, " 2 ": 2.0, "-3e2": -300.0, ".5": 0.5, "7.": 7.0, "+1": 1.0, "1.5d": None, "2f": None,
             "0x1p3": None, "1,5": None, "": None, "n/a": None, "1e": None, "1 2": None}
    assert column(spark, list(cases), "string", to_number) == list(cases.values())
    special = column(spark, ["inf", "-Infinity", "nan"], "string", to_number)
    assert special[:2] == [float("inf"), float("-inf")] and special[2] != special[2]


def test_float_text(spark):
    cases = {1e9: "1e+009", 1234567.0: "1.23457e+006", -100.1234: "-100.123", 2e23: "2e+023", 0.0: "0", -98.5: "-98.5",
             999999.0: "999999", 1000000.0: "1e+006", 0.0001: "0.0001", 0.00001234: "1.234e-005", 29.4241: "29.4241",
             -0.5: "-0.5", 123456.7: "123457", 1e-300: "1e-300", None: None, float("nan"): None, float("inf"): None}
    assert column(spark, list(cases), "double", L.tsql_float_text) == list(cases.values())


def test_hotspot_key_of_any_coordinate(spark):
    df = spark.createDataFrame([(None, 1e9, -100.1234), (" ", 1e300, 5e-324), (None, None, 29.0)],
                               "s string, x double, y double")
    assert [r[0] for r in df.select(L.hotspot_key("s", "x", "y")).collect()] == [
        "COORD_1e+009_-100.123", "COORD_1e+300_0", "COORD__29"]


def test_number_text_is_the_shortest(spark):
    values = [2e23, 5.197911675827665e16, 0.1, 1 / 3, 1e16, 1e15, 123456789.125, 1e-5, 0.0001, -2.5e-7,
              1.7976931348623157e308, 9007199254740993.0, 1.0, -0.0, 100.0]
    assert column(spark, values, "double", py_number_text) == [repr(v) for v in values]


def test_times_in_other_layouts(spark):
    cases = {"2024-01-15 07:30:00": "2024-01-15 07:30:00", "2024-01-15T07:30:00Z": "2024-01-15 07:30:00",
             "2024-01-15T07:30:00-06:00": "2024-01-15 13:30:00", "1/15/2024 7:30 PM": "2024-01-15 19:30:00",
             "01/15/2024 07:30:05": "2024-01-15 07:30:05", "1/15/2024": "2024-01-15 00:00:00",
             "20240115 073000": "2024-01-15 07:30:00", "Jan 15, 2024 7:30 am": "2024-01-15 07:30:00",
             "07:30": None, "junk": None, "13/45/2024": None, "": None}
    got = column(spark, list(cases), "string", lambda c: parse_utc(c).cast("string"))
    assert got == list(cases.values())
    assert column(spark, ["12:30", "2024-01-05"], "string", lambda c: file_trip_date(c).cast("string")) == [None, "2024-01-05"]


@pytest.mark.parametrize("prev, route, changed", [
    ("", None, 0), ("  ", None, 0), (None, "", 0), ("R1 ", "R1", 0), ("R1", "R2", 1), (None, "R1", 1), ("R1", " ", 1)])
def test_blank_routes_are_no_change(spark, prev, route, changed):
    df = spark.createDataFrame([(L.FIXED_ROUTE_SERVICE, prev, route)], "s string, p string, r string")
    flag, kind = df.select(L.is_transfer_leg("s", "s", "p", "r"), L.transfer_type("s", "s", "p", "r")).first()
    assert flag == changed and kind == ("ROUTE_CHANGE" if changed else "OTHER")


def test_hot_path_repeats_and_needs_an_order_without_ties(spark):
    from legwise.operators.flags import flags
    from legwise.sources import fixtures as FX
    from conftest import SF_SMALL
    legs = FX.hot_legs(spark, SF_SMALL)
    hot = legs.select(F.lit("0").alias("user_trip_id"), F.lit("2024-01-15").cast("date").alias("trip_date")).limit(1)
    with pytest.raises(ValueError):
        flags(legs, FX.AS_OF, FX.DAYS_BACK, tie_break=None, hot_keys=hot)

    def runs():
        df = sequence_within(legs, ["user_trip_id", "trip_date"], ["start_time_utc", "event_id"], {"p": "event_id"},
                             {"n": "event_id"}, rows_per_task=64)
        assert "Union" in df._jdf.queryExecution().optimizedPlan().toString()
        return sorted(tuple(r) for r in df.select("event_id", "seq", F.coalesce("p", F.lit(-1)), F.coalesce("n", F.lit(-1))).collect())
    plain = sequence_within(legs, ["user_trip_id", "trip_date"], ["start_time_utc", "event_id"], {"p": "event_id"},
                            {"n": "event_id"}, hot_keys=None)
    want = sorted(tuple(r) for r in plain.select("event_id", "seq", F.coalesce("p", F.lit(-1)), F.coalesce("n", F.lit(-1))).collect())
    assert runs() == runs() == want
