"""Intermediate tables in the folder that the whole cluster shares."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names; one of the machine's own only in local mode, where none is set."""
    told = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if told:
        return told.rstrip("/")
    got = spark.sparkContext._jsc.sc().getCheckpointDir()
    if got.isDefined():
        return str(got.get()).rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    import tempfile

    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="newsloom-"))
    return str(spark.sparkContext._jsc.sc().getCheckpointDir().get()).rstrip("/")


class Scratch:
    """Tables written to the shared folder: lineage ends there, and a lost executor costs one re-read."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}", 0

    def path(self, name: str) -> str:
        self.n += 1
        return f"{self.root}/{self.n:03d}-{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *frames_or_names: str) -> None:
        """Deletes what keep() wrote under these names, once nothing reads it."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = root.getFileSystem(conf)
        if fs.exists(root):
            for status in fs.listStatus(root):
                if status.getPath().getName().split("-", 1)[-1] in frames_or_names:
                    fs.delete(status.getPath(), True)
