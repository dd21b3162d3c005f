"""run_refresh at scale settings: flags written to the checkpoint folder,
ten tables written, intermediate tables removed afterwards."""

import os

from pyspark.sql import functions as F

from legwise.plans.refresh import AGGREGATE_TABLES, PUBLISH_TABLES, run_refresh
from legwise.plans.validate import validate_refresh
from legwise.session import checkpoint_dir
from legwise.sources import fixtures as FX

from conftest import SF_SMALL


def _listing(path):
    path = path.replace("file:", "")
    return set(os.listdir(path)) if os.path.isdir(path) else set()


def test_run_refresh_parquet_materialization(spark, tmp):
    ckpt = checkpoint_dir(spark)
    before = _listing(ckpt)
    paths = run_refresh(spark, FX.legs(spark, SF_SMALL), f"{tmp}/out", FX.AS_OF, FX.DAYS_BACK,
                        tie_break=FX.TIE_BREAK, materialize="parquet", tune_shuffle=True)
    assert set(paths) == set(AGGREGATE_TABLES) | set(PUBLISH_TABLES)
    flows = spark.read.parquet(paths["Flow_BG_BG_Daily"])
    assert flows.agg(F.sum("leg_count")).first()[0] == 910
    pub = spark.read.parquet(paths["ArcGIS_Flow_BG_BG_Daily_Route_Rolling31"])
    assert pub.agg(F.min("oid"), F.max("oid"), F.count("*")).first() == (1, pub.count(), pub.count())
    # the aggregates are partitioned by day
    assert any(d.startswith("trip_date=") for d in os.listdir(paths["BG_Summary_Daily"]))
    # flags and numbered rows were removed from the checkpoint folder
    left = {d for d in _listing(ckpt) - before if d.startswith(("flags-", "numbered-"))}
    assert not left
    v = validate_refresh(spark, f"{tmp}/out")
    r = v["flows_date_range"].first()
    assert r["n_rows"] == pub.count() and str(r["min_date"]) >= "2024-01-01"
    assert v["walk_egress_latest"].count() == 10
