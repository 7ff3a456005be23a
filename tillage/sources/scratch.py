"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where it is unset, a local session (tests) gets a temporary folder; a cluster must name one.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return spark.sparkContext.getCheckpointDir()


class Scratch:
    """Tables written once and read again, so that lost executors cost a read and not a lineage."""

    def __init__(self, spark: SparkSession):
        self.spark, self.base, self.made = spark, f"{shared_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}", {}
        self.n = 0

    def path(self) -> str:
        """A new path, not yet written."""
        self.n += 1
        return f"{self.base}/{self.n - 1}"

    def save(self, df: DataFrame) -> DataFrame:
        path = self.path()
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.made[id(out)] = (path, out)
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Delete tables that no later step reads."""
        jvm = self.spark._jvm
        for frame in frames:
            path = jvm.org.apache.hadoop.fs.Path(self.made.pop(id(frame))[0])
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def keep(self, *frames: DataFrame) -> None:
        """Delete all tables but those that the result still reads."""
        stay = {id(f) for f in frames}
        self.drop(*[f for i, (_, f) in self.made.items() if i not in stay])
