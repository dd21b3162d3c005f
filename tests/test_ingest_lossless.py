"""CSV ingest that loses nothing, the manifest, rejects and the refresh commit."""

import datetime as dt
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from legwise.config import ConfigError, IngestConfig, PipelineConfig, TransformConfig
from legwise.plans import ingest as ING
from legwise.plans import transform as TR
from legwise.plans.refresh import AGGREGATE_TABLES, read_refreshed, run_refresh
from legwise.plans.versions import VersionedTables
from legwise.schemas import CLEAN
from legwise.sources import csv_legs as CSV
from legwise.sources import fixtures as FX
from legwise.sources.manifest import Manifest

from conftest import SF_SMALL

HEADER = "user_trip_id,start_time,end_time,start_longitude,start_latitude,end_longitude,end_latitude,start_stop_name"
ROW = "{0},2024-01-05 07:00:00,2024-01-05 07:10:00,-98.5,29.4,-98.6,29.5,{1}"


def put(folder, name, *lines, header=HEADER):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write("\n".join([header, *lines]) + "\n")
    return path


def config(tmp, **kw):
    return IngestConfig(landing_path=f"{tmp}/landing", raw_path=f"{tmp}/raw", **kw)


def name(day):
    return f"tapped_trip_view_legs_2024-01-{day:02d}.csv"


def loaded(spark, cfg):
    return sorted((r["user_trip_id"], r["start_stop_name"], r["source_file"])
                  for r in spark.read.parquet(cfg.raw_path).collect())


def quarantine(spark, cfg):
    return sorted((r["source_file"], r["kind"], r["reason"], r["record"])
                  for r in spark.read.parquet(ING.quarantine_path(cfg.raw_path)).collect())


def test_quotes_line_breaks_and_header_orders(spark, tmp):
    cfg = config(tmp)
    put(cfg.landing_path, name(1), ROW.format("u1", '"Main ""St"", No 5"'), ROW.format("u2", '"two\nlines"'),
        ROW.format("u3", "plain"))
    turned = ",".join(reversed(HEADER.split(",")))
    put(cfg.landing_path, name(2), ",".join(reversed(ROW.format("u4", "turned").split(","))), "", header="﻿" + turned)
    put(cfg.landing_path, name(3), ROW.format("u5", "x") + ",bus", header=HEADER + ",mode")
    put(cfg.landing_path, name(4), "u6,2024-01-05 07:00:00,,-98.5,29.4,-98.6,29.5")  # short record
    assert ING.ingest(spark, cfg) == 6
    assert loaded(spark, cfg) == [
        ("u1", 'Main "St", No 5', name(1)), ("u2", "two\nlines", name(1)), ("u3", "plain", name(1)),
        ("u4", "turned", name(2)), ("u5", "x", name(3)), ("u6", None, name(4))]
    assert quarantine(spark, cfg) == []
    assert ING.ingest(spark, cfg) == 0


def test_broken_files_wait_and_are_loaded_once_mended(spark, tmp):
    cfg = config(tmp)
    put(cfg.landing_path, name(1), ROW.format("u1", "a"))
    put(cfg.landing_path, name(2), ROW.format("u2", "b"), ROW.format("u3", "c,one,too many"))
    put(cfg.landing_path, name(3), "u4,2024-01-05", header="user_trip_id,start_time")
    put(cfg.landing_path, name(4), ROW.format("u5", '"never closed'), ROW.format("u6", "d"))
    put(cfg.landing_path, name(5), header="")
    got = ING.run_ingest(spark, cfg)
    assert got.n_rows == 1 and got.loaded == [name(1)]
    held = quarantine(spark, cfg)
    assert [(f, kind) for f, kind, _, _ in held] == [(name(2), "record"), (name(3), "file"), (name(4), "record"),
                                                     (name(5), "file")]
    assert held[0][2] == CSV.EXTRA_FIELDS and held[0][3] == ROW.format("u3", "c,one,too many")
    assert held[2][2] == CSV.OPEN_QUOTE and "u6" in held[2][3]  # the whole rest of the file
    assert "start_longitude" in held[1][2] and held[3][2] == "no header"
    # tried again: still broken, nothing twice; then mended
    assert ING.ingest(spark, cfg) == 0
    put(cfg.landing_path, name(2), ROW.format("u2", "b"), ROW.format("u3", "c"))
    assert ING.ingest(spark, cfg) == 2
    assert [u for u, _, _ in loaded(spark, cfg)] == ["u1", "u2", "u3"]


def test_good_records_can_load_beside_bad_ones(spark, tmp):
    cfg = config(tmp, whole_files=False)
    put(cfg.landing_path, name(2), ROW.format("u2", "b"), ROW.format("u3", "c,one,too many"))
    assert ING.ingest(spark, cfg) == 1
    assert [r[3] for r in quarantine(spark, cfg)] == [ROW.format("u3", "c,one,too many")]
    assert ING.ingest(spark, cfg) == 0


def test_a_file_spark_cannot_read_stands_alone(spark, tmp):
    cfg = config(tmp, file_suffix=".csv.gz")
    import gzip
    os.makedirs(cfg.landing_path)
    whole = gzip.compress((HEADER + "\n" + "\n".join(ROW.format(f"u{i}", i) for i in range(4000))).encode(), mtime=0)
    for day, data in ((1, whole), (2, whole[:len(whole) // 2]), (3, whole)):
        with open(os.path.join(cfg.landing_path, name(day) + ".gz"), "wb") as f:
            f.write(data)
    got = ING.run_ingest(spark, cfg)
    assert got.n_rows == 8000 and len(got.quarantined) == 1
    assert next(iter(got.quarantined)).endswith(name(2) + ".gz")


def test_same_file_name_in_two_folders(spark, tmp):
    cfg = config(tmp)
    put(f"{cfg.landing_path}/a", name(1), ROW.format("u1", "a"))
    put(f"{cfg.landing_path}/b", name(1), ROW.format("u2", "b"))
    assert ING.ingest(spark, cfg) == 2
    put(f"{cfg.landing_path}/c", name(1), ROW.format("u3", "c"))
    assert ING.ingest(spark, cfg) == 1


def test_duplicate_and_empty_column_names():
    assert CSV.Header.of(["a", "A", "", " b ", "a"]).names == ("a", "A.1", "Unnamed: 2", "b", "a.2")


def test_steady_state_does_not_read_raw(spark, tmp):
    cfg = config(tmp)
    for day in (1, 2):
        put(cfg.landing_path, name(day), ROW.format(f"u{day}", "a"))
    ING.ingest(spark, cfg)
    manifest = Manifest(spark, cfg.raw_path)
    listing = spark.createDataFrame([(name(1), name(1)), (name(3), name(3))], "path string, name string")
    fresh = manifest.fresh(listing)
    assert [r["path"] for r in fresh.collect()] == [name(3)]
    assert all("/raw/" not in f and "raw_manifest" in f for f in fresh.inputFiles())


def test_manifest_compacts_and_adopts(spark, tmp):
    cfg = config(tmp)
    put(cfg.landing_path, name(1), ROW.format("u1", "a"))
    ING.ingest(spark, cfg)
    manifest = Manifest(spark, cfg.raw_path)
    before = {r["path"] for r in manifest.events().where("event = 'loaded'").collect()}
    assert manifest.compact(most=0)
    assert {r["path"] for r in manifest.events().where("event = 'loaded'").collect()} == before
    assert manifest._generations() == [2] and ING.ingest(spark, cfg) == 0
    # a raw table that is older than its manifest
    import shutil
    shutil.move(manifest.base, f"{tmp}/elsewhere")
    assert ING.ingest(spark, cfg) == 0
    assert [r["event"] for r in manifest.events().collect()] == ["adopted"]


@pytest.mark.parametrize("reached_raw", [True, False])
def test_a_run_that_dies_is_settled(spark, tmp, monkeypatch, reached_raw):
    cfg = config(tmp)
    put(cfg.landing_path, name(1), ROW.format("u1", "a"))
    record = Manifest.record

    def dying(self, run_id, event, files):
        if event == "loaded" or not reached_raw:
            if not reached_raw:
                record(self, run_id, event, files)
            raise RuntimeError("died")
        record(self, run_id, event, files)

    monkeypatch.setattr(Manifest, "record", dying)
    with pytest.raises(RuntimeError):
        ING.ingest(spark, cfg)
    monkeypatch.undo()
    assert ING.ingest(spark, cfg) == (0 if reached_raw else 1)
    assert [u for u, _, _ in loaded(spark, cfg)] == ["u1"]
    assert Manifest(spark, cfg.raw_path).unsettled() == []
    assert ING.ingest(spark, cfg) == 0


# Rejects

def test_every_fetched_row_has_a_route(spark, tmp):
    cfg = config(tmp)
    put(cfg.landing_path, name(5), ROW.format("u1", "a"), ROW.format("", "no id"), ROW.format("u3", "s" * 201),
        ROW.format("u4", "s" * 200 + "   "), ROW.format("u5", "\U0001F68C" * 101), ROW.format("u1", "a"))
    put(cfg.landing_path, "tapped_trip_view_legs_latest.csv", ROW.format("u6", "undated"))
    assert ING.ingest(spark, cfg) == 7
    raw = spark.read.parquet(cfg.raw_path)
    assert raw.where("file_date IS NULL").count() == 1
    tr = TransformConfig(raw_path=cfg.raw_path, clean_path=f"{tmp}/clean", state_path=f"{tmp}/state",
                         output_path=f"{tmp}/out")
    for again in (False, True):
        r = TR.transform(spark, tr, today=dt.date(2024, 2, 1), refresh=False)
        assert (r.fetched, r.cleaned, r.undated, r.rejected, r.inserted) == (6, 3, 0, 3, 0 if again else 2)
        rejects = spark.read.parquet(f"{tmp}/clean_rejects")
        assert sorted((x["user_trip_id"] or "", x["reject_reason"]) for x in rejects.collect()) == [
            ("", "null user_trip_id"), ("u3", "start_stop_name longer than 200"), ("u5", "start_stop_name longer than 200")]
    assert spark.read.parquet(tr.clean_path).select(*CLEAN.names).count() == 2


def test_watermark_never_goes_back():
    now = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)
    state = TR.advance({"last_file_dt": None, "last_run_utc": None}, dt.datetime(2024, 1, 10), now)
    assert state == {"last_file_dt": "2024-01-10 00:00:00", "last_run_utc": "2024-02-01T00:00:00+00:00"}
    assert TR.advance(state, dt.datetime(2024, 1, 8), now)["last_file_dt"] == "2024-01-10 00:00:00"
    assert TR.advance(state, None, now)["last_file_dt"] == "2024-01-10 00:00:00"
    assert TR.Horizon(34, 5).since("2024-01-10 00:00:00") == dt.datetime(2024, 1, 5)


def test_switches_refuse_unknown_words():
    env = {"LANDING_PATH": "l", "RAW_PATH": "r", "CLEAN_PATH": "c", "STATE_PATH": "s", "OUTPUT_PATH": "o",
           "FEATURES_PATH": "f"}
    assert PipelineConfig.from_env({**env, "PUBLISH_ENABLED": "off"}).publish_enabled is False
    assert PipelineConfig.from_env({**env, "DRY_RUN": "Yes"}).publish.dry_run is True
    with pytest.raises(ConfigError):
        PipelineConfig.from_env({**env, "DRY_RUN": "maybe"})


# Commit of a refresh

def refreshed(spark, base, prefix=None):
    run_refresh(spark, FX.legs(spark, SF_SMALL), base, FX.AS_OF, FX.DAYS_BACK, prefix, tie_break=FX.TIE_BREAK,
                materialize="persist")


def seen(spark, base):
    return {t: read_refreshed(spark, base, t).count() for t in AGGREGATE_TABLES}


@pytest.mark.parametrize("step", ["third table", "before commit", "draft of the pointer"])
def test_readers_see_one_whole_version(spark, tmp, monkeypatch, step):
    from legwise.plans import refresh as R
    base = f"{tmp}/out"
    refreshed(spark, base)
    first, version = seen(spark, base), VersionedTables(spark, base).current()
    if step == "third table":
        write, calls = R._write, []

        def failing(df, path, partitioned, fmt):
            calls.append(path)
            if len(calls) == 3:
                raise RuntimeError("died")
            write(df, path, partitioned, fmt)
        monkeypatch.setattr(R, "_write", failing)
    elif step == "before commit":
        monkeypatch.setattr(VersionedTables, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("died")))
    else:
        swap = VersionedTables._swap

        def dying(self, text):
            self._path = lambda p, path=self._path: (_ for _ in ()).throw(RuntimeError("died")) \
                if p.endswith("/_current") else path(p)
            swap(self, text)
        monkeypatch.setattr(VersionedTables, "_swap", dying)
    with pytest.raises(RuntimeError):
        refreshed(spark, base, "48029")
    monkeypatch.undo()
    assert VersionedTables(spark, base).current() == version and seen(spark, base) == first
    refreshed(spark, base, "48029")  # the next run commits, and tidies up after two versions
    assert VersionedTables(spark, base).current() != version and seen(spark, base) != first
    refreshed(spark, base, "48029")
    assert len(os.listdir(f"{base}/_versions")) == 2
    assert [f for f in os.listdir(base) if f.startswith("_current-")] == []


def test_a_table_that_is_not_complete_is_not_committed(spark, tmp):
    store = VersionedTables(spark, f"{tmp}/t")
    version = store.begin()
    spark.range(3).write.parquet(store.path("a", version))
    with pytest.raises(FileNotFoundError):
        store.commit(version, ["a", "b"])
    assert store.current() is None
    with pytest.raises(FileNotFoundError):
        store.path("a")
    store.commit(version, ["a"])
    assert spark.read.parquet(store.path("a")).count() == 3 and store.exists("a") and not store.exists("b")
