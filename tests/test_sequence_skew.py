"""The hot-group path of the trip window must equal the plain window."""

import datetime as dt

from pyspark.sql import functions as F

from legwise.operators.flags import LAGS, LEADS, flags
from legwise.operators.sequence import detect_hot_keys, sequence_within
from legwise.sources import fixtures as FX

from conftest import SF_SMALL

COLS = ["event_id", "leg_seq", *LAGS, *LEADS, "transfer_type", "is_transfer_leg"]


def rows(df):
    return sorted(tuple(r) for r in df.select(*COLS).collect())


def test_forced_hot_keys_match_plain(spark):
    legs = FX.legs(spark, SF_SMALL)
    plain = flags(legs, FX.AS_OF, FX.DAYS_BACK, tie_break="event_id", hot_keys=None)
    # every trip of the three busiest users is treated as hot
    hot = (legs.groupBy("user_trip_id", "trip_date").count().orderBy(F.desc("count"), "user_trip_id")
           .limit(40).select("user_trip_id", "trip_date", F.col("count").cast("double").alias("_est_rows")))
    split = flags(legs, FX.AS_OF, FX.DAYS_BACK, tie_break="event_id", hot_keys=hot)
    assert rows(split) == rows(plain)


def test_one_giant_group_is_split(spark):
    # one trip holding a third of all rows (plus many small trips), nulls in the order column
    t0 = dt.datetime(2024, 1, 1)
    data = [("hot", None if i % 7 == 0 else t0 + dt.timedelta(seconds=i // 3), i, f"S{i % 5}")
            for i in range(3000)]
    data += [(f"u{i % 2000}", t0 + dt.timedelta(seconds=i), 10_000 + i, f"S{i % 3}") for i in range(6000)]
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, tb long, s string")
    kw = dict(keys=["k"], order=["t", "tb"], lags={"prev_s": "s"}, leads={"next_s": "s"}, seq_col="seq")
    plain = sequence_within(df, hot_keys=None, **kw)
    hot = detect_hot_keys(df, ["k"], rows_per_task=500)
    assert hot is not None and [r["k"] for r in hot.collect()] == ["hot"]
    split = sequence_within(df, hot_keys=hot, rows_per_task=500, **kw)
    cols = ["tb", "seq", "prev_s", "next_s"]
    assert sorted(map(tuple, split.select(cols).collect())) == sorted(map(tuple, plain.select(cols).collect()))


def test_null_key_can_be_hot(spark):
    data = [(None if i < 400 else f"k{i % 50}", i, f"S{i % 4}") for i in range(1000)]
    df = spark.createDataFrame(data, "k string, o long, s string")
    kw = dict(keys=["k"], order=["o"], lags={"p": "s"}, leads={"n": "s"}, seq_col="seq")
    plain = sequence_within(df, hot_keys=None, **kw)
    split = sequence_within(df, hot_keys=detect_hot_keys(df, ["k"], rows_per_task=100), rows_per_task=100, **kw)
    def key(r):
        return tuple((v is None, v or "") if not isinstance(v, int) else (False, v) for v in r)
    assert sorted(map(tuple, split.collect()), key=key) == sorted(map(tuple, plain.collect()), key=key)


def test_no_hot_keys_on_fixture(spark):
    assert detect_hot_keys(FX.legs(spark, SF_SMALL), ["user_trip_id", "trip_date"]) is None


def test_auto_detection_with_low_threshold_matches_plain(spark):
    """End to end through flags(): a tiny threshold makes the busiest trips hot."""
    legs = FX.legs(spark, SF_SMALL)
    plain = flags(legs, FX.AS_OF, FX.DAYS_BACK, tie_break="event_id", hot_keys=None)
    auto = flags(legs, FX.AS_OF, FX.DAYS_BACK, tie_break="event_id", hot_keys="auto", rows_per_task=8)
    assert "Union" in auto._jdf.queryExecution().optimizedPlan().toString()  # the split path was taken
    assert rows(auto) == rows(plain)
