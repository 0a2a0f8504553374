"""Intermediate tables in the shared folder, dropped when no longer read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from threadloom.session import shared_dir


class Scratch:
    """Writes intermediate tables below ``spark.checkpoint.dir`` and removes them on request.

    A stored table has no lineage, so a lost executor costs only the tasks it was running, and its
    file sizes are known to the planner.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0

    def path(self, label: str) -> str:
        self.count += 1
        return f"{self.base}/{self.count:03d}-{label}"

    def store(self, df: DataFrame, label: str, *partition_by: str) -> DataFrame:
        path = self.path(label)
        writer = df.write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        stored.scratch_path = path
        return stored

    def drop(self, *tables: DataFrame) -> None:
        """Remove stored tables that no later step reads."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(table.scratch_path)
            path.getFileSystem(conf).delete(path, True)
