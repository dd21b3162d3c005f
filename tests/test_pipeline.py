"""End to end: landing CSV files -> raw -> clean -> aggregates -> features."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from legwise.config import IngestConfig, PipelineConfig, PublishConfig, TransformConfig
from legwise.plans.ingest import ingest
from legwise.plans.pipeline import run_pipeline
from legwise.plans.refresh import read_refreshed
from legwise.plans.transform import compute_since, load_state, transform
from legwise.sources import fixtures as FX
from legwise.streaming.ingest_stream import start_ingest_stream

from conftest import SF_SMALL

CSV_COLUMNS = ["user_trip_id", "start_time", "end_time", "start_longitude", "start_latitude",
               "end_longitude", "end_latitude", "service_name", "route_short_name", "mode",
               "start_stop_name", "end_stop_name"]


def write_landing(spark, folder, days=None):
    """One CSV per day from the legs fixture (pandas writes the small files)."""
    legs = FX.legs(spark, SF_SMALL).toPandas()
    os.makedirs(folder, exist_ok=True)
    names = []
    for day, part in legs.groupby("trip_date"):
        if days is not None and day not in days:
            continue
        out = part.rename(columns={"start_time_utc": "start_time", "end_time_utc": "end_time"})[CSV_COLUMNS]
        name = f"tapped_trip_view_legs_{day.isoformat()}.csv"
        out.to_csv(os.path.join(folder, name), index=False)
        names.append(name)
    with open(os.path.join(folder, "readme.txt"), "w") as f:
        f.write("not a leg file\n")
    return names


def polygons(spark):
    return FX.grid_polygons(spark)


def configs(tmp):
    ing = IngestConfig(landing_path=f"{tmp}/landing", raw_path=f"{tmp}/raw")
    tr = TransformConfig(raw_path=f"{tmp}/raw", clean_path=f"{tmp}/clean", state_path=f"{tmp}/state",
                         output_path=f"{tmp}/out", reject_path=f"{tmp}/rejects", as_of="2024-02-01",
                         materialize="persist")
    pub = PublishConfig(output_path=f"{tmp}/out", features_path=f"{tmp}/features")
    return ing, tr, pub


def test_compute_since():
    assert compute_since(None, 34, 5, today=dt.date(2024, 2, 1)) == dt.datetime(2023, 12, 29)
    assert compute_since("2024-01-30 00:00:00", 34, 5) == dt.datetime(2024, 1, 25)


def test_ingest_transform_publish(spark, tmp):
    days = {dt.date(2024, 1, d) for d in range(1, 11)}
    names = write_landing(spark, f"{tmp}/landing", days)
    ing, tr, pub = configs(tmp)
    n = ingest(spark, ing, polygons(spark))
    raw = spark.read.parquet(ing.raw_path)
    assert n == raw.count() > 0
    assert raw.select("source_file").distinct().count() == len(names)
    assert raw.filter(F.col("Origin_BG").isNotNull()).count() > 0
    assert raw.filter("manhattan_distance_mi < euclidean_distance_mi - 1e-9").count() == 0
    # idempotent: nothing new the second time
    assert ingest(spark, ing, polygons(spark)) == 0

    r1 = transform(spark, tr, today=dt.date(2024, 2, 1))
    clean = spark.read.parquet(tr.clean_path)
    assert r1.inserted == clean.count() == clean.select("row_hash").distinct().count()
    state = load_state(spark, tr.state_path)
    assert state["last_file_dt"].startswith("2024-01-10")
    # re-running reads the 5-day overlap again and inserts nothing
    r2 = transform(spark, tr)
    assert r2.fetched > 0 and r2.inserted == 0
    assert spark.read.parquet(tr.clean_path).count() == clean.count()

    # more files arrive: only they are ingested; the overlap re-read adds only them
    write_landing(spark, f"{tmp}/landing", {dt.date(2024, 1, d) for d in range(11, 16)})
    assert ingest(spark, ing, polygons(spark)) > 0
    r3 = transform(spark, tr)
    assert r3.inserted > 0
    total = spark.read.parquet(tr.clean_path)
    assert total.count() == total.select("row_hash").distinct().count()

    flows = read_refreshed(spark, tr.output_path, "ArcGIS_Flow_BG_BG_Daily_Route_Rolling31")
    assert flows.count() > 0
    assert flows.agg(F.min("oid"), F.max("oid")).first() == (1, flows.count())

    from legwise.plans.publish import publish
    from dataclasses import replace
    dry = publish(spark, replace(pub, dry_run=True))
    assert not os.path.exists(f"{tmp}/features/flows")
    assert dry["flows"].count() == flows.count()
    publish(spark, pub)
    feats = spark.read.parquet(f"{tmp}/features/flows")
    assert feats.filter(F.col("wkt").startswith("LINESTRING (")).count() == flows.count()
    publish(spark, replace(pub, fmt="geojson", features_path=f"{tmp}/geojson"))
    line = spark.read.text(f"{tmp}/geojson/transfer_hotspots").first()["value"]
    assert line.startswith('{"type":"Feature","geometry":{"type":"Point"')


def test_publish_missing_input_raises(spark, tmp):
    from legwise.plans.publish import publish
    with pytest.raises(FileNotFoundError):
        publish(spark, PublishConfig(output_path=f"{tmp}/nothing", features_path=f"{tmp}/f"))


def test_pipeline_guards_and_exit_codes(spark, tmp):
    write_landing(spark, f"{tmp}/landing", {dt.date(2024, 1, 3), dt.date(2024, 1, 4)})
    ing, tr, pub = configs(tmp)
    cfg = PipelineConfig(ing, tr, pub)
    r = run_pipeline(spark, cfg, today=dt.date(2024, 2, 1))
    assert r.exit_code == 0 and r.inserted > 0 and r.transformed and r.published
    r = run_pipeline(spark, cfg)   # nothing new: transform runs, publish is skipped (defaults)
    assert r.exit_code == 0 and r.inserted == 0 and r.transformed and not r.published
    from dataclasses import replace
    r = run_pipeline(spark, replace(cfg, run_transform_if_no_new=False, run_publish_if_no_new=True))
    assert r.exit_code == 0 and not r.transformed and r.published
    bad = replace(cfg, publish=replace(pub, output_path=f"{tmp}/missing"), run_publish_if_no_new=True)
    assert run_pipeline(spark, bad).exit_code == 3
    assert run_pipeline(spark, replace(cfg, ingest=replace(ing, landing_path=f"{tmp}/nope"))).exit_code == 1


def test_streaming_ingest_loads_each_file_once(spark, tmp):
    write_landing(spark, f"{tmp}/landing", {dt.date(2024, 1, 5), dt.date(2024, 1, 6)})
    ing, tr, _ = configs(tmp)
    q = start_ingest_stream(spark, ing, f"{tmp}/ckpt", polygons(spark))
    q.awaitTermination(300)
    n1 = spark.read.parquet(ing.raw_path).count()
    assert n1 > 0
    write_landing(spark, f"{tmp}/landing", {dt.date(2024, 1, 7)})
    q = start_ingest_stream(spark, ing, f"{tmp}/ckpt", polygons(spark), transform_cfg=tr,
                            today=dt.date(2024, 2, 1))
    q.awaitTermination(300)
    raw = spark.read.parquet(ing.raw_path)
    assert raw.select("source_file").distinct().count() == 3
    assert raw.count() == raw.dropDuplicates().count()
    assert spark.read.parquet(tr.clean_path).count() > 0
