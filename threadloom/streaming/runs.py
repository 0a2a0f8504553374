"""Sources, sinks and bounded runs shared by the streaming jobs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from threadloom.session import shared_dir


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def scratch(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def start(df: DataFrame, path: str, output_mode: str = "append") -> StreamingQuery:
    """Write an append stream to parquet, with its checkpoint beside it, until the input is used up."""
    return (
        df.writeStream.outputMode(output_mode).format("parquet").option("path", f"{path}/table")
        .option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start())


def run_to_table(df: DataFrame, label: str) -> DataFrame:
    """Run a stream over everything available and read back what it wrote."""
    spark = df.sparkSession
    path = scratch(spark, label)
    start(df, path).awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{path}/table")
