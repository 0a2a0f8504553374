"""Intent taxonomy from YAML, as a small table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom.schemas import TAXONOMY


def load_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """Intents ordered by id with ``text`` = "name. description".

    ``intents`` may be a list of entries or a mapping by id. The file is read through Spark, so any
    file system the cluster knows will do.
    """
    import yaml

    document = yaml.safe_load(spark.read.text(path, wholetext=True).first()[0]) or {}
    intents = document.get("intents") or []
    entries = intents if isinstance(intents, list) else [{**v, "intent_id": k} for k, v in intents.items()]
    rows = []
    for entry in sorted(entries, key=lambda e: e["intent_id"]):
        rows.append(tuple(
            entry["intent_id"] if name == "name" and not entry.get(name) else entry.get(name)
            for name in TAXONOMY.names))
    table = spark.createDataFrame(rows, TAXONOMY)
    return table.withColumn("text", F.concat("name", F.lit(". "), F.coalesce("description", F.lit(""))))
