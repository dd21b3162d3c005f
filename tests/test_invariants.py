"""Cross-table invariants of the refresh."""

import pytest
from pyspark.sql import functions as F

from legwise.operators import aggregates as G
from legwise.operators import publish as P
from legwise.operators.flags import flags
from legwise.sources import fixtures as FX

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def refreshed(spark):
    f = flags(FX.legs(spark, SF_SMALL), FX.AS_OF, FX.DAYS_BACK, tie_break=FX.TIE_BREAK).cache()
    t = G.all_aggregates(f)
    yield f, t
    f.unpersist()


def total(df, col):
    return df.agg(F.sum(col)).first()[0] or 0


def test_leg_counts_agree(refreshed):
    f, t = refreshed
    n = f.count()
    assert n == 910  # FIXTURES §2 at sf0.001
    assert total(t["Flow_BG_BG_Daily"], "leg_count") == n
    assert total(t["Flow_BG_BG_Daily_Route"], "leg_count") == n
    assert total(t["BG_Summary_Daily"], "legs") == n


def test_transfer_counts_agree(refreshed):
    f, t = refreshed
    n = f.filter("is_transfer_leg = 1").count()
    assert total(t["Transfer_Hotspots_Daily"], "transfer_events") == n
    assert total(t["Transfer_Hotspots_Daily_Route"], "transfer_events") == n
    assert total(t["Transfer_Hotspots_Daily_RoutePair"], "transfer_events") == n
    assert total(t["BG_Summary_Daily"], "transfer_legs") == n


def test_fixture_transfer_type_counts(refreshed):
    f, _ = refreshed
    got = {r[0]: r[1] for r in f.groupBy("transfer_type").count().collect()}
    assert got == {None: 419, "FIXED_TO_DEMAND": 46, "DEMAND_TO_FIXED": 43, "ROUTE_CHANGE": 91, "OTHER": 311}


def test_walk_counts(refreshed):
    f, t = refreshed
    assert f.filter(F.lower("mode") == "walk").count() == 178
    w = t["Walk_AccessEgress_Daily"]
    assert total(w.filter("walk_type = 'ACCESS'"), "walk_leg_count") == 61
    assert total(w.filter("walk_type = 'EGRESS'"), "walk_leg_count") == 70


def test_route_pair_is_projection_of_route(refreshed):
    _, t = refreshed
    assert t["Transfer_Hotspots_Daily_Route"].count() == t["Transfer_Hotspots_Daily_RoutePair"].count()


def test_trips_with_transfer_bounded(refreshed):
    _, t = refreshed
    assert t["BG_Summary_Daily"].filter("trips_with_transfer > trips").count() == 0
    assert t["Flow_BG_BG_Daily"].filter("transfer_trip_count > trip_count").count() == 0


def test_oid_is_dense(refreshed, spark):
    _, t = refreshed
    for pub in (P.publish_flows(t["Flow_BG_BG_Daily_Route"], FX.AS_OF, FX.DAYS_BACK),
                P.publish_hotspots(t["Transfer_Hotspots_Daily_Route"], FX.AS_OF, FX.DAYS_BACK),
                P.publish_walk_egress(t["Walk_AccessEgress_Daily"], FX.AS_OF, FX.DAYS_BACK)):
        r = pub.agg(F.min("oid"), F.max("oid"), F.count("*"), F.countDistinct("oid")).first()
        assert r[0] == 1 and r[1] == r[2] == r[3]


def test_oid_follows_order(refreshed):
    _, t = refreshed
    pub = P.publish_flows(t["Flow_BG_BG_Daily_Route"], FX.AS_OF, FX.DAYS_BACK)
    rows = pub.orderBy("oid").select(*P.FLOW_ORDER).collect()
    keys = [tuple(r) for r in rows]
    assert keys == sorted(keys, key=lambda k: tuple((v is not None, v) for v in k))
