"""Sinks and their readers: splits, statistics, golden set, audit log, thresholds."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom.operators.triage import TAU_CONFIDENCE, TAU_SIMILARITY
from threadloom.schemas import GOLDEN_COLUMNS, TELEMETRY

# Everything quoted, empty text and null kept apart, white space kept: text comes back as it was.
_CSV = {"header": True, "quoteAll": True, "escape": '"', "emptyValue": "", "nullValue": "\\N",
        "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}

_THRESHOLDS = "tau_confidence double, tau_similarity double, f1 double, precision double, recall double, " \
              "false_auto_rate double, calibration_rows long, constraint string"


def write_splits(split: DataFrame, path: str) -> None:
    """One folder per split; a reader that filters on ``split`` opens only that folder."""
    split.write.mode("overwrite").partitionBy("split").parquet(path)


def write_statistics(stats: DataFrame, path: str) -> None:
    """A small statistics table as JSON lines."""
    stats.coalesce(1).write.mode("overwrite").json(path)


def write_golden(golden: DataFrame, path: str) -> None:
    """The labelled set as CSV with header and as JSON lines with plain Unicode text."""
    rows = golden.select(*GOLDEN_COLUMNS)
    rows.write.mode("overwrite").options(**_CSV).csv(f"{path}/csv")
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/jsonl")


def read_golden(spark: SparkSession, path: str, schema, form: str) -> DataFrame:
    if form == "csv":
        return spark.read.schema(schema).options(**_CSV, multiLine=True).csv(f"{path}/csv")
    return spark.read.schema(schema).json(f"{path}/jsonl")


def write_csv(df: DataFrame, path: str) -> None:
    """A bounded report (brand ranking, thread sample) as one CSV with header."""
    df.coalesce(1).write.mode("overwrite").options(**_CSV).csv(path)


def append_audit(records: DataFrame, path: str, job: str | None = None) -> None:
    """Append telemetry records as JSON lines, in a folder of their ``job``.

    A job that runs again with its name replaces what it wrote, so that its records are in the log once. Without a name
    each call is a job of its own.
    """
    job = uuid.uuid4().hex if job is None else job
    if not re.fullmatch(r"[\w-][\w.-]*", job):
        raise ValueError(f"not a folder's name: {job!r}")
    records.write.mode("overwrite").json(f"{path}/job={job}")


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """The records of all jobs."""
    return spark.read.schema(TELEMETRY).option("recursiveFileLookup", True).json(path)


def write_thresholds(best: DataFrame, path: str, calibration_rows: int, constraint: str) -> None:
    best.select("tau_confidence", "tau_similarity", "f1", "precision", "recall", "false_auto_rate").withColumn(
        "calibration_rows", F.lit(calibration_rows).cast("long")).withColumn(
        "constraint", F.lit(constraint)).coalesce(1).write.mode("overwrite").json(path)


def read_thresholds(spark: SparkSession, path: str) -> tuple[float, float]:
    """Tuned thresholds, or the defaults where the file or a value is missing."""
    from pyspark.errors import AnalysisException

    try:
        row = spark.read.schema(_THRESHOLDS).json(path).first()
    except AnalysisException:
        row = None
    if row is None:
        return TAU_CONFIDENCE, TAU_SIMILARITY

    def value(name: str, default: float) -> float:
        return default if row[name] is None else row[name]

    return value("tau_confidence", TAU_CONFIDENCE), value("tau_similarity", TAU_SIMILARITY)
