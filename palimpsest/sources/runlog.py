"""The run log: appended rows in Parquet, and what may be done next."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "seq long, run string, stage string, tbl string, status string, fingerprint string, salt string"
NEEDED = {"pass1", "verify"}


class RunLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def mark(self, run: str, stage: str, tbl: str, status: str, fingerprint: str, salt: str) -> None:
        row = [(time.time_ns(), run, stage, tbl, status, fingerprint, salt)]
        self.spark.createDataFrame(row, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def start(self, fingerprint: str, salt: str) -> str:
        """The run to go on with, or a new one after a publishable run. A run left open under other fingerprints raises."""
        last = self.rows().orderBy(F.desc("seq")).first() if self.exists() else None
        if last is not None and not self.publishable(last["run"]):
            if (last["fingerprint"], last["salt"]) != (fingerprint, salt):
                raise ValueError(f"run {last['run']} was begun with another plan or salt")
            return last["run"]
        run = f"run-{time.time_ns()}"
        self.mark(run, "start", "*", "done", fingerprint, salt)
        return run

    def exists(self) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def rows(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def entries(self, run: str) -> DataFrame:
        return self.rows().where(F.col("run") == run).orderBy("seq")

    def done(self, run: str, stage: str, tbl: str) -> bool:
        last = self.entries(run).where((F.col("stage") == stage) & (F.col("tbl") == tbl)).agg(F.max_by("status", "seq").alias("s")).first()
        return last["s"] == "done"

    def meta(self, run: str) -> tuple[str, str]:
        """Plan fingerprint and salt fingerprint of a run's first row."""
        row = self.rows().where(F.col("run") == run).agg(F.min_by(F.struct("fingerprint", "salt"), "seq").alias("m")).first()["m"]
        return row["fingerprint"], row["salt"]

    def mismatched(self, run: str) -> bool:
        return self.rows().where(F.col("run") == run).agg(F.count_distinct(F.struct("fingerprint", "salt")).alias("n")).first()["n"] > 1

    def publishable(self, run: str) -> bool:
        """The latest row of every stage and table is done, the needed stages are there, and one plan and salt made all."""
        last = self.rows().where(F.col("run") == run).groupBy("stage", "tbl").agg(F.max_by("status", "seq").alias("status"))
        row = last.agg(F.coalesce(F.bool_and(F.col("status") == "done"), F.lit(False)).alias("ok"), F.collect_set("stage").alias("stages")).first()
        return bool(row["ok"]) and set(row["stages"]) >= NEEDED and not self.mismatched(run)
