"""Intermediate tables on storage that all executors share, removed when the session ends."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallyward.sources.contracts import ContractError


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir`` or ``setCheckpointDir``; an error without one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ContractError("set spark.checkpoint.dir to a folder all executors can reach")
    return base.rstrip("/")


@dataclass(frozen=True)
class Scratch:
    """A fresh folder below the checkpoint folder.

    Spark's file system deletes it when the session's JVM ends; ``remove`` does so earlier. What a
    lazy frame still reads must stay until that frame has been written.
    """

    spark: SparkSession
    folder: str

    @classmethod
    def create(cls, spark: SparkSession) -> Scratch:
        scratch = cls(spark, f"{checkpoint_folder(spark)}/tallyward-{uuid.uuid4().hex}")
        path, files = scratch._path("")
        files.mkdirs(path)
        files.deleteOnExit(path)
        return scratch

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}".rstrip("/"))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write the frame as Parquet and read it back with the schema it was written with."""
        df.write.mode("overwrite").parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def remove(self, name: str = "") -> None:
        path, files = self._path(name)
        files.delete(path, True)

    def make(self, name: str) -> None:
        """An empty folder, for tasks that write files of their own."""
        path, files = self._path(name)
        files.mkdirs(path)

    def finish(self, df: DataFrame) -> DataFrame:
        """Keep the frame and remove everything else that was kept here."""
        result = self.keep(df, "result")
        path, files = self._path("")
        for entry in files.listStatus(path):
            if entry.getPath().getName() != "result":
                files.delete(entry.getPath(), True)
        return result
