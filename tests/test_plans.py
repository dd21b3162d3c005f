"""Physical-plan checks: shuffles, codegen-only expressions,
pushdown, no single-partition steps on leg-sized data."""

import re

import pytest

from legwise.operators import aggregates as G
from legwise.operators.clean import clean_transform
from legwise.operators.flags import flags
from legwise.sources import fixtures as FX

from conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas")


@pytest.fixture(scope="module")
def clean_table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("clean"))
    clean_transform(FX.raw(spark, SF_SMALL)).write.mode("overwrite").partitionBy("trip_date").parquet(path)
    return spark.read.parquet(path)


def test_one_exchange_and_window_for_sequence(spark, clean_table):
    f = flags(clean_table, FX.AS_OF, FX.DAYS_BACK, hot_keys=None)
    p = plan(f)
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 1
    assert "hashpartitioning(user_trip_id" in p
    assert len(re.findall(r"\bWindow \[", p)) == 1


def test_filters_and_columns_reach_the_scan(spark, clean_table):
    f = flags(clean_table, FX.AS_OF, FX.DAYS_BACK, region_prefix="48029", hot_keys=None)
    p = plan(f)
    assert "PartitionFilters: [isnotnull(trip_date" in p and "2024-01-01" in p and "2024-02-01" in p
    assert re.search(r"PushedFilters: \[IsNotNull\(Origin_BG\), IsNotNull\(Dest_BG\), StringStartsWith\(Origin_BG,48029\)", p)
    scan_cols = re.search(r"FileScan parquet \[([^\]]*)\]", p).group(1)
    assert "source_file" not in scan_cols and "file_date_raw" not in scan_cols


def test_no_python_in_clean_flags_aggregates(spark, clean_table):
    f = flags(clean_table, FX.AS_OF, FX.DAYS_BACK, hot_keys=None)
    for df in [clean_transform(FX.raw(spark, SF_SMALL)), f, *G.all_aggregates(f).values()]:
        p = plan(df)
        assert not any(n in p for n in PYTHON_NODES)


def test_no_single_partition_on_leg_data(spark, clean_table):
    f = flags(clean_table, FX.AS_OF, FX.DAYS_BACK, hot_keys=None)
    for df in [f, *G.all_aggregates(f).values()]:
        assert "SinglePartition" not in plan(df)


def test_route_pair_adds_no_shuffle(spark, clean_table):
    f = flags(clean_table, FX.AS_OF, FX.DAYS_BACK, hot_keys=None)
    route = G.transfer_hotspots_route(f)
    pair = G.transfer_hotspots_routepair(route)
    assert plan(pair).count("Exchange") == plan(route).count("Exchange")


def test_walk_roles_single_aggregate(spark, clean_table):
    f = flags(clean_table, FX.AS_OF, FX.DAYS_BACK, hot_keys=None)
    p = plan(G.walk_access_egress(f))
    assert "Union" not in p  # one pass over the flags, not two


def test_numbering_sorts_by_range(spark, clean_table):
    from legwise.operators.publish import publish_flows
    f = flags(clean_table, FX.AS_OF, FX.DAYS_BACK, hot_keys=None)
    pub = publish_flows(G.flow_daily_route(f), FX.AS_OF, FX.DAYS_BACK)
    assert pub.count() > 0
    # the numbered rows were written once; what is left joins a per-partition count table
    p = plan(pub)
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p
