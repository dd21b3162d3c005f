"""Golden trips (FIXTURES §6): expected transfer type of every leg."""

import datetime as dt

import pytest

from legwise.operators import aggregates as G
from legwise.operators.flags import flags

FIXED, DEMAND = "AGENCY_FIXED_ROUTE", "AGENCY_DEMAND_RESPONSE"
BG = "480290000001"
D = dt.date(2024, 1, 10)
T0 = dt.datetime(2024, 1, 10, 8, 0)

# (trip, legs: (service, route, mode, start offset min, end offset min, origin_bg))
TRIPS = {
    "t01": [(FIXED, "R1", "transit", 0, 10, BG)],
    "t02": [(FIXED, "R1", "transit", 0, 10, BG), (FIXED, "R1", "transit", 20, 30, BG)],
    "t03": [(FIXED, "R1", "transit", 0, 10, BG), (FIXED, "R2", "transit", 20, 30, BG)],
    "t04": [(FIXED, None, "transit", 0, 10, BG), (FIXED, "", "transit", 20, 30, BG)],
    "t05": [(FIXED, "R1", "transit", 0, 10, BG), (DEMAND, None, "transit", 20, 30, BG)],
    "t06": [(DEMAND, None, "transit", 0, 10, BG), (FIXED, "R1", "transit", 20, 30, BG)],
    "t07": [(DEMAND, None, "transit", 0, 10, BG), (DEMAND, None, "transit", 20, 30, BG)],
    "t08": [(FIXED, "R1", "transit", 0, 10, BG), ("WALKING", None, "walk", 11, 15, BG),
            (FIXED, "R2", "transit", 20, 30, BG)],
    "t09": [(FIXED, "R1", "transit", 0, 10, BG), (None, None, "walk", 11, 15, BG),
            (FIXED, "R2", "transit", 20, 30, BG)],
    "t10": [(FIXED, "R1", "transit", 0, 10, BG), (FIXED, "R2", "transit", 20, 30, None),
            (FIXED, "R3", "transit", 40, 50, BG)],
    "t11": [(FIXED, "R1", "transit", 0, 12, BG), (FIXED, "R1", "transit", 0, 10, BG)],
    "t12": [("WALKING", None, "walk", 0, 5, BG), (FIXED, "R1", "transit", 6, 20, BG),
            ("WALKING", None, "Walk", 21, 25, BG)],
}
EXPECTED = {
    "t01": [None], "t02": [None, "OTHER"], "t03": [None, "ROUTE_CHANGE"], "t04": [None, "OTHER"],
    "t05": [None, "FIXED_TO_DEMAND"], "t06": [None, "DEMAND_TO_FIXED"], "t07": [None, "OTHER"],
    "t08": [None, "OTHER", "OTHER"], "t09": [None, "OTHER", None], "t10": [None, "ROUTE_CHANGE"],
    "t11": [None, "OTHER"], "t12": [None, "OTHER", "OTHER"],
}

SCHEMA = ("leg_id long, user_trip_id string, trip_date date, start_time_utc timestamp_ntz, "
          "end_time_utc timestamp_ntz, start_longitude double, start_latitude double, end_longitude double, "
          "end_latitude double, service_name string, route_short_name string, mode string, "
          "start_stop_name string, end_stop_name string, Origin_BG string, Dest_BG string, "
          "manhattan_distance_mi double, euclidean_distance_mi double")


def legs_df(spark):
    rows, i = [], 0
    for trip, legs in TRIPS.items():
        for svc, route, mode, s, e, bg in legs:
            i += 1
            rows.append((i, trip, D, T0 + dt.timedelta(minutes=s), T0 + dt.timedelta(minutes=e),
                         -98.5, 29.4, -98.49, 29.41, svc, route, mode, f"S{i}", f"E{i}", bg, BG, 1.0, 0.8))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def golden(spark):
    return flags(legs_df(spark), as_of="2024-01-11", days_back=31, tie_break="leg_id", hot_keys=None)


def test_transfer_types(golden):
    got = {}
    for r in golden.orderBy("user_trip_id", "leg_seq").collect():
        got.setdefault(r["user_trip_id"], []).append(r["transfer_type"])
    assert got == EXPECTED


def test_sequence_by_end_time_on_equal_start(golden):
    rows = golden.filter("user_trip_id = 't11'").orderBy("leg_seq").collect()
    assert [r["end_time_utc"].minute for r in rows] == [10, 12]


def test_walk_roles(golden):
    walk = G.walk_roles(golden).filter("walk_type IS NOT NULL")
    t12 = {(r["walk_type"]) for r in walk.join(golden.select("user_trip_id").distinct(), "user_trip_id")
           .filter("user_trip_id = 't12'").collect()}
    assert t12 == {"ACCESS", "EGRESS"}
    # t08: the walk leg between two fixed legs is both ACCESS and EGRESS
    t08 = sorted(r["walk_type"] for r in walk.filter("user_trip_id = 't08'").collect())
    assert t08 == ["ACCESS", "EGRESS"]
    # t09: null service walk keeps both roles (mode decides, neighbours are FIXED)
    t09 = sorted(r["walk_type"] for r in walk.filter("user_trip_id = 't09'").collect())
    assert t09 == ["ACCESS", "EGRESS"]


def test_empty_input_gives_empty_tables(spark):
    empty = legs_df(spark).limit(0)
    out = G.all_aggregates(flags(empty, as_of="2024-01-11", tie_break="leg_id", hot_keys=None))
    assert all(df.count() == 0 for df in out.values())
