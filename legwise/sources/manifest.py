"""Which landing files are loaded, as a small append-only table beside
raw.

A row is one event of a file: ``intent`` before its rows are appended to raw,
``loaded`` after, ``adopted`` for files that raw held before there was a
manifest. A file is known by its path below the landing folder; adopted ones are
known by name only. A run that dies between the append and its ``loaded`` rows
leaves intents; the next run looks for just those files in raw and settles them.

Every append adds a few small files; ``compact`` rewrites the table as one new
generation. Readers take the newest generation that is complete.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legwise.session import path_exists

EVENTS = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("event", T.StringType()),
    T.StructField("path", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("length", T.LongType()), T.StructField("n_rows", T.LongType()),
    T.StructField("at", T.TimestampNTZType())])
#: Files of a generation from which it is rewritten.
COMPACT_FILES = 64


class Manifest:
    def __init__(self, spark: SparkSession, raw_path: str):
        self.spark, self.raw_path = spark, raw_path
        self.base = raw_path.rstrip("/") + "_manifest"

    def _fs(self, path: str):
        sc = self.spark.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(sc._jsc.hadoopConfiguration()), p

    def _generations(self) -> list[int]:
        """Complete generations, oldest first."""
        fs, p = self._fs(self.base)
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        found = sorted(int(n[4:]) for n in names if n.startswith("gen-") and n[4:].isdigit())
        return [g for g in found if path_exists(self.spark, f"{self.base}/gen-{g}/_SUCCESS")]

    def _current(self) -> str | None:
        found = self._generations()
        return f"{self.base}/gen-{found[-1]}" if found else None

    def exists(self) -> bool:
        return self._current() is not None

    def events(self) -> DataFrame:
        path = self._current()
        if path is None:
            return self.spark.createDataFrame([], EVENTS)
        return self.spark.read.schema(EVENTS).parquet(path)

    def append(self, events: DataFrame) -> None:
        rows = events.withColumn("at", F.localtimestamp()).select(*EVENTS.names)
        rows.coalesce(1).write.mode("append").parquet(self._current() or f"{self.base}/gen-1")

    def record(self, run_id: str, event: str, files: list[tuple]) -> None:
        """``files``: (path, name, length, n_rows) of one run's new files."""
        self.append(self.spark.createDataFrame([(run_id, event, *f) for f in files],
                                               "run_id string, event string, path string, name string, length long, n_rows long"))

    def adopt(self) -> None:
        """Start the manifest of a raw table that was loaded without one: its
        file names, read once."""
        if self.exists() or not path_exists(self.spark, self.raw_path):
            return
        names = (self.spark.read.schema("source_file string").parquet(self.raw_path)
                 .where("source_file IS NOT NULL").groupBy(F.col("source_file").alias("name"))
                 .agg(F.count(F.lit(1)).alias("n_rows")))
        self.append(names.select(F.lit("adopted").alias("run_id"), F.lit("adopted").alias("event"),
                                 F.lit(None).cast("string").alias("path"), "name",
                                 F.lit(None).cast("long").alias("length"), "n_rows"))

    def unsettled(self) -> list:
        """Intents without an outcome (files of one run that died)."""
        e = self.events()
        done = e.where("event IN ('loaded', 'void')").select("run_id", "path")
        return (e.where("event = 'intent'").join(done, ["run_id", "path"], "left_anti")
                .select("run_id", "path", "name", "length").collect())

    def fresh(self, candidates: DataFrame) -> DataFrame:
        """Candidates (path, name) that are not loaded. Only the
        manifest is read, never raw."""
        e = self.events()
        by_path = e.where("event = 'loaded'").select("path")
        by_name = e.where("event = 'adopted'").select("name")
        return candidates.join(by_path, "path", "left_anti").join(by_name, "name", "left_anti")

    def compact(self, most: int = COMPACT_FILES) -> bool:
        """Rewrite the table once it has many files: settled intents go, all
        else stays. The old generation goes after the new one is complete."""
        found = self._generations()
        if not found:
            return False
        fs, p = self._fs(f"{self.base}/gen-{found[-1]}")
        if len(fs.listStatus(p)) <= most:
            return False
        e = self.events()
        done = e.where("event IN ('loaded', 'void')").select("run_id", "path").distinct()
        open_intents = e.where("event = 'intent'").join(done, ["run_id", "path"], "left_anti")
        kept = e.where("event IN ('loaded', 'adopted')").unionByName(open_intents.select(*e.columns))
        kept.coalesce(1).write.mode("overwrite").parquet(f"{self.base}/gen-{found[-1] + 1}")
        for g in found:
            fs.delete(self._fs(f"{self.base}/gen-{g}")[1], True)
        return True
