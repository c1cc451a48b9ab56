"""A prediction store with a commit list: what a reader sees changes only when a write is complete.

Every write goes to a folder of its own below ``data``, partitioned by run, model and direction. Then one small file
below ``log``, named by the next free version, tells the folder and the keys it replaces. Readers take each key from the
latest version that names it; folders that no version names do not exist for them. So a writer that dies leaves the
store as it was, and of two writers at once each one's keys are whole, the later commit winning where both wrote a key.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tandem.session import release
from tandem.sinks.writers import flat_predictions, in_stretches

KEYS = ["run", "model", "src_lang", "tgt_lang"]
_SCHEMA = "write string, run string, model string, src_lang string, tgt_lang string, line_no bigint, text string"
_LOG = f"write string, keys array<struct<{', '.join(f'{key}: string' for key in KEYS)}>>"
DIGITS = 12


class PredictionStore:
    """Predictions (run, model, src_lang, tgt_lang, line_no, text) below ``path``; it need not exist before a write."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _file(self, *parts: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def versions(self) -> list[int]:
        """The numbers of all commits."""
        files, folder = self._file("log")
        if not files.exists(folder):
            return []
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        return sorted(int(name.removesuffix(".json")) for name in names if name[0].isdigit() and name.endswith(".json"))

    def stage(self, predictions: DataFrame, newlines: str = "space") -> str:
        """Write predictions, each once, to a folder that no reader follows yet; its name."""
        write = uuid.uuid4().hex
        in_stretches(flat_predictions(predictions, newlines), KEYS).write.partitionBy(*KEYS).parquet(
            f"{self.path}/data/write={write}")
        return write

    def commit(self, write: str) -> int:
        """Make a staged folder the live one of all keys in it; the version that does so.

        The file of a version is created only if none has its name, so two writers never share a number.
        """
        files, folder = self._file("data", f"write={write}")
        if not files.exists(folder):
            raise ValueError(f"nothing is staged in {folder}")
        listed = self._data().filter(F.col("write") == write).select(*KEYS).distinct().collect()
        entry = json.dumps({"write": write, "keys": [row.asDict() for row in listed]}, ensure_ascii=False) + "\n"
        version = (self.versions() or [0])[-1]
        while True:
            version += 1
            files, target = self._file("log", f"{version:0{DIGITS}d}.json")
            try:
                out = files.create(target, False)
            except Py4JJavaError as error:
                if "FileAlreadyExists" in str(error.java_exception):
                    continue
                raise
            try:
                out.write(bytearray(entry.encode()))
            finally:
                out.close()
            return version

    def write(self, predictions: DataFrame, newlines: str = "space") -> int:
        """Replace all (run, model, src_lang, tgt_lang) that ``predictions`` has; everything else stays.

        Predictions without rows replace nothing.
        """
        return self.commit(self.stage(predictions, newlines))

    def _data(self) -> DataFrame:
        return self.spark.read.schema(_SCHEMA).parquet(f"{self.path}/data")

    def live(self, version: int | None = None) -> DataFrame:
        """(write, *keys): the folder each key is read from, now or as of a version."""
        known = [v for v in self.versions() if version is None or v <= version]
        if not known:
            return self.spark.createDataFrame([], ", ".join(f"{name} string" for name in ["write", *KEYS]))
        log = self.spark.read.schema(_LOG).json([f"{self.path}/log/{v:0{DIGITS}d}.json" for v in known])
        # an entry that is still being written cannot be parsed and has no keys
        entries = log.select(F.col("_metadata.file_name").alias("_version"), "write", F.inline("keys"))
        latest = Window.partitionBy(*KEYS).orderBy(F.desc("_version"))
        return entries.withColumn("_n", F.row_number().over(latest)).filter("_n = 1").select("write", *KEYS)

    def read(self, version: int | None = None) -> DataFrame:
        """The live predictions, now or as of a version; only folders of live keys are opened."""
        if not self.versions():
            return self.spark.createDataFrame([], _SCHEMA).drop("write")
        return self._data().join(self.live(version), ["write", *KEYS], "left_semi").select(*KEYS, "line_no", "text")

    def vacuum(self) -> int:
        """Delete committed folders without a live key, which earlier versions then lack; how many went.

        Folders that were never committed may belong to a running writer and stay.
        """
        files, _ = self._file("log")
        named = {row.write for row in self.spark.read.schema(_LOG).json(
            [f"{self.path}/log/{v:0{DIGITS}d}.json" for v in self.versions()]).select("write").distinct().collect()}
        dead = named - {row.write for row in self.live().select("write").distinct().collect()}
        gone = [write for write in dead if files.exists(self._file("data", f"write={write}")[1])]
        for write in gone:
            release(self.spark, f"{self.path}/data/write={write}")
        return len(gone)
