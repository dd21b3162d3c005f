"""The streaming clean step: restarts, replays and late files add nothing twice."""

from legwise.config import IngestConfig, TransformConfig
from legwise.plans.ingest import ingest
from legwise.streaming.clean_stream import start_clean_stream

from test_ingest_lossless import ROW, name, put


def test_restarts_replays_and_late_files(spark, tmp):
    ing = IngestConfig(landing_path=f"{tmp}/landing", raw_path=f"{tmp}/raw")
    tr = TransformConfig(raw_path=ing.raw_path, clean_path=f"{tmp}/clean", state_path=f"{tmp}/state",
                         output_path=f"{tmp}/out", overlap_days=5)

    def land(day, *rows):
        put(ing.landing_path, name(day), *rows)
        assert ingest(spark, ing) == len(rows)

    def run():
        for q in start_clean_stream(spark, tr, f"{tmp}/checkpoint"):
            q.awaitTermination(300)
            assert q.exception() is None
        return sorted(r["user_trip_id"] for r in spark.read.parquet(tr.clean_path).collect())

    land(20, ROW.format("a", "s"), ROW.format("a", "s"), ROW.format("", "no id"))
    land(21, ROW.format("b", "s"))
    assert run() == ["a", "b"]
    assert run() == ["a", "b"]  # a restart with nothing new
    # the same file once more in raw (a replayed append), and a late file within the overlap
    again = spark.read.parquet(ing.raw_path).where("user_trip_id IN ('a', 'b')").cache()
    again.count()
    again.write.mode("append").partitionBy("file_date").parquet(ing.raw_path)
    land(18, ROW.format("late", "s"))
    assert run() == ["a", "b", "late"]
    # rows that the state has forgotten are still found in the stored table
    land(30, ROW.format("c", "s"))
    assert run() == ["a", "b", "c", "late"]
    again.write.mode("append").partitionBy("file_date").parquet(ing.raw_path)
    land(29, ROW.format("d", "s"))
    assert run() == ["a", "b", "c", "d", "late"]
    put(ing.landing_path, "tapped_trip_view_legs_latest.csv", ROW.format("e", "s"))
    assert ingest(spark, ing) == 1
    assert run() == ["a", "b", "c", "d", "late"]
    rejects = [(r["reject_reason"], r["user_trip_id"]) for p in ("", "_undated")
               for r in spark.read.parquet(f"{tmp}/clean_rejects{p}").collect()]
    assert rejects == [("null user_trip_id", None), ("no trip date", "e")]
