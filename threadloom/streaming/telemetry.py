"""Running and windowed telemetry totals over a stream of decision events."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from threadloom.operators.telemetry import counters, reason_counts, windowed_totals, with_rates
from threadloom.operators.threads import one_row
from threadloom.streaming.runs import scratch


def running_totals(events: DataFrame) -> DataFrame:
    """Counts per decision and reason since the stream began; the enums bound the state."""
    return reason_counts(events)


def running_summary(events: DataFrame) -> DataFrame:
    """Totals, escalation rate and mean confidence since the stream began, as one row (``scope``)."""
    return with_rates(events.groupBy(F.lit("all").alias("scope")).agg(*counters()))


def windowed_stream(events: DataFrame, delay: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Totals and histogram per event-time window; windows older than the watermark leave the state."""
    return windowed_totals(events.withWatermark("ts", delay), width)


def start_updates(df: DataFrame, path: str) -> StreamingQuery:
    """Write changed rows per micro-batch, each to its own folder: a repeated batch replaces itself."""
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/updates/batch={number}")

    return df.writeStream.outputMode("update").option("checkpointLocation", f"{path}/checkpoint").trigger(
        availableNow=True).foreachBatch(write).start()


def _base(spark: SparkSession, path: str) -> int | None:
    """The newest complete merge of an update log: the number of the last batch it holds."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/merged")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return None
    done = [int(f.getPath().getName().split("=")[1]) for f in files.listStatus(folder)
            if files.exists(spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))]
    return max(done, default=None)


def latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The newest row per key of an update log: of the merged part, and of the batches after it."""
    base = _base(spark, path)
    log = None if base is None else spark.read.parquet(f"{path}/merged/upto={base}")
    if _exists(spark, f"{path}/updates"):
        updates = spark.read.parquet(f"{path}/updates")
        # a batch that is already merged and was run again brings nothing new
        updates = updates.where(F.col("batch") > (-1 if base is None else base))
        log = updates if log is None else log.select(updates.columns).unionByName(updates)
    newest = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("batch")))
    return log.withColumn("newest", newest).where("newest = 1").drop("newest", "batch")


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def merge_updates(spark: SparkSession, path: str, keys: list[str]) -> int | None:
    """Fold all committed batches of an update log into one table and remove their folders; the last batch merged.

    The merge counts from the moment its success mark is there. Folders go only after that: a run that stops in between
    leaves folders whose batches are known to be merged. So readers always see each key once, and the number
    of files stays that of one merge and the batches since. Run it between runs of the stream.
    """
    if not _exists(spark, f"{path}/updates"):
        return _base(spark, path)
    base = _base(spark, path)
    upto = spark.read.parquet(f"{path}/updates").agg(F.max("batch")).first()[0]
    if upto is None or (base is not None and upto <= base):
        return base
    rows = latest(spark, path, keys).withColumn("batch", F.lit(upto).cast("int"))
    rows.write.mode("overwrite").parquet(f"{path}/merged/upto={upto}")
    hadoop = spark._jvm.org.apache.hadoop.fs
    gone = [f"{path}/updates"] + ([] if base is None else [f"{path}/merged/upto={base}"])
    for folder in gone:
        target = hadoop.Path(folder)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return upto


def run_updates(df: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Run an update stream over everything available and read the final state of its rows."""
    spark = df.sparkSession
    path = scratch(spark, label)
    start_updates(df, path).awaitTermination()
    return latest(spark, path, keys)


class InputLog(StreamingQueryListener):
    """Rows read by each batch of each run, from the progress of every batch, however many there are."""

    def __init__(self) -> None:
        self.rows: dict[str, dict[int, int]] = {}
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self.rows.setdefault(str(progress.runId), {})[progress.batchId] = progress.numInputRows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))


def run_accounted(df: DataFrame, path: str, wait_seconds: float = 60) -> None:
    """Run an update stream over everything available and store how many rows each batch read, beside its updates."""
    spark = df.sparkSession
    log = InputLog()
    spark.streams.addListener(log)
    try:
        query = start_updates(df, path)
        run = str(query.runId)
        try:
            query.awaitTermination()
        finally:
            until = time.monotonic() + wait_seconds
            while run not in log.ended and time.monotonic() < until:
                time.sleep(0.05)
            counts = [(batch, n) for batch, n in sorted(log.rows.get(run, {}).items()) if n]
            if counts:
                spark.createDataFrame(counts, "batch long, input_rows long").coalesce(1).write.mode("append").parquet(f"{path}/inputs")
        if run not in log.ended:
            raise TimeoutError("the progress of the stream did not arrive")
    finally:
        spark.streams.removeListener(log)


def row_account(spark: SparkSession, path: str, keys: list[str], counter: str) -> DataFrame:
    """One row: rows read, rows that the stored updates count, and rows dropped as late, over all runs.

    Every row read is either counted in its window or dropped, so the difference is exact, and it is one of rows,
    where the engine's own counter is one of partial groups. A batch that ran twice counts once.
    """
    read = spark.read.parquet(f"{path}/inputs").groupBy("batch").agg(F.max("input_rows").alias("n")).agg(F.sum("n").alias("input_rows"))
    kept = latest(spark, path, keys).agg(F.coalesce(F.sum(counter), F.lit(0)).alias("counted"))
    return one_row(read, kept).withColumn("late_rows", F.col("input_rows") - F.col("counted"))
