"""Rows fixed in files that all executors share, so that several uses of them see the same rows."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _use_checkpoint_dir(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`. Only a local session may go without that setting."""
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            folder = tempfile.mkdtemp(prefix="brindle-checkpoint-")
        sc.setCheckpointDir(folder)
    return sc._jsc.sc().getCheckpointDir().get()


def fixed(df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder and read from there. Spark removes them with the last use if
    spark.cleaner.referenceTracking.cleanCheckpoints is on."""
    _use_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Rounds:
    """The state of a loop: each round's table is written before the last one's goes, so one is left at the end.

    These are plain tables, because a checkpoint inherits the size estimates of its plan, and a loop's joins would square these each round.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.last = spark, f"{_use_checkpoint_dir(spark)}/rounds-{uuid.uuid4().hex}", None

    def keep(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        if self.last:
            old = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.last)
            old.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)
        self.last = path
        return self.spark.read.schema(df.schema).parquet(path)
