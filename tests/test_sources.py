import random

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from threadloom.schemas import TWEET_SOURCE
from threadloom.sources import csv_ranges, sinks
from threadloom.sources.taxonomy import load_taxonomy
from threadloom.sources.tweets import read_tweets, read_tweets_by_ranges

LIST = """
intents:
- intent_id: b
  name: Bee
  description: Second
  default_risk: low
  examples: [x, y]
- intent_id: a
  description: First
  default_risk: high
"""
MAPPING = "intents:\n  b: {name: Bee, description: Second}\n  a: {name: Ay}\n"


def test_taxonomy_from_list_and_mapping(spark, tmp_path):
    for name, text, expected in (("l", LIST, [("a", "a. First"), ("b", "Bee. Second")]),
                                 ("m", MAPPING, [("a", "Ay. "), ("b", "Bee. Second")])):
        path = tmp_path / f"{name}.yaml"
        path.write_text(text, encoding="utf-8")
        assert tuples(load_taxonomy(spark, str(path)), "intent_id", "text") == expected
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        load_taxonomy(spark, str(tmp_path / "none.yaml"))


def test_thresholds_round_trip_and_defaults(spark, tmp_path):
    path = str(tmp_path / "thresholds")
    assert sinks.read_thresholds(spark, path) == (0.60, 0.50)
    best = spark.createDataFrame([(0.45, 0.7, 0.9, 0.8, 1.0, 0.0)],
                                 "tau_confidence double, tau_similarity double, f1 double, precision double, "
                                 "recall double, false_auto_rate double")
    sinks.write_thresholds(best, path, 300, "false_auto_rate <= 15.0%")
    assert sinks.read_thresholds(spark, path) == (0.45, 0.7)
    sinks.write_thresholds(best.withColumn("tau_similarity", F.lit(None).cast("double")), path, 300, "x")
    assert sinks.read_thresholds(spark, path) == (0.45, 0.50)


def test_golden_text_survives_both_formats(spark, tmp_path):
    from threadloom.schemas import GOLDEN_COLUMNS

    row = {c: "" for c in GOLDEN_COLUMNS}
    row.update(example_id="GOLD_001", customer_message=' "届かない",\nline\r\n two ', conversation_context="\\N? no")
    df = spark.createDataFrame([tuple(row[c] for c in GOLDEN_COLUMNS)], ", ".join(f"{c} string" for c in GOLDEN_COLUMNS))
    sinks.write_golden(df, str(tmp_path / "g"))
    for form in ("csv", "json"):
        assert tuples(sinks.read_golden(spark, str(tmp_path / "g"), df.schema, form)) == tuples(df)
    raw = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "g" / "jsonl").glob("*.json"))
    assert "届かない" in raw


def test_splits_audit_and_reports(spark, tmp_path):
    df = spark.createDataFrame([(1, "train"), (2, "test")], "id long, split string")
    sinks.write_splits(df, str(tmp_path / "s"))
    assert (tmp_path / "s" / "split=train").is_dir()
    back = spark.read.parquet(str(tmp_path / "s"))
    assert tuples(back.where("split = 'test'"), "id") == [(2,)]
    record = spark.createDataFrame([("i", "t", "AUTO", "none", "x", 0.5, 0.5, 1.0, "mock")], sinks.TELEMETRY)
    sinks.append_audit(record, str(tmp_path / "a"))
    sinks.append_audit(record, str(tmp_path / "a"))
    assert sinks.read_audit(spark, str(tmp_path / "a")).count() == 2
    for path in ("b", "b", "c"):
        sinks.append_audit(record, str(tmp_path / "jobs"), path)
    assert tuples(sinks.read_audit(spark, str(tmp_path / "jobs"))) == tuples(record) * 2
    with pytest.raises(ValueError, match="folder"):
        sinks.append_audit(record, str(tmp_path / "jobs"), "../c")
    sinks.write_statistics(df, str(tmp_path / "stats"))
    assert spark.read.json(str(tmp_path / "stats")).count() == 2
    sinks.write_csv(df, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == ["id", "split"]


def write_csv_file(path, rows, end="\n", last_end=True):
    def field(value):
        return "" if value is None else '"' + value.replace('"', '""') + '"' if set(value) & set('",\n\r') or value == "" else value

    lines = [",".join(sinks_columns)] + [",".join(map(field, row)) for row in rows]
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(end.join(lines) + (end if last_end else ""))


sinks_columns = [f.name for f in TWEET_SOURCE]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_by_ranges_equals_the_plain_scan(spark, tmp_path, end):
    rng = random.Random(11)
    pieces = ["a word", "届かない", '"', ",", "\n", "\n\n", " ", "x" * 40, '",\n"', ""]
    # a text longer than several ranges, which holds what looks like records
    long_text = "\n".join(f"{i},c,True,now,text {i},," for i in range(200))
    folder = tmp_path / "csv"
    folder.mkdir()
    for n in range(3):
        rows = []
        for i in range(120):
            text = "".join(rng.choices(pieces, k=rng.randrange(8)))
            rows.append((str(1000 * n + i), f"c{i}", "True", None, long_text if i == 50 and n == 1 else text, None, rng.choice([None, "1.0"])))
        write_csv_file(folder / f"{n}.csv", rows, end, last_end=n != 2)
    (folder / "empty.csv").write_text("")
    write_csv_file(folder / "header.csv", [])
    plain = tuples(read_tweets(spark, str(folder)))
    assert len(plain) == 360
    old = {key: spark.conf.get(key) for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size, batch in ((157, 3), (1000, 10000), (1 << 27, 5)):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
            assert tuples(read_tweets_by_ranges(spark, str(folder))) == plain
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        lines = csv_ranges._lines(spark, str(folder / "1.csv"))
        assert lines.rdd.getNumPartitions() > 5 and lines.select("range_start").distinct().count() > 5
        # ranges that change between the passes are an error, never wrong records
        late = csv_ranges.records(spark, str(folder))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "333")
        with pytest.raises(Exception, match="other ranges"):
            late.withColumn("n", F.length("text")).collect()
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_csv_by_ranges_of_broken_or_empty_input(spark, tmp_path):
    write_csv_file(tmp_path / "none.csv", [])
    assert read_tweets_by_ranges(spark, str(tmp_path / "none.csv")).count() == 0
    (tmp_path / "bad.csv").write_text('tweet_id,author_id\n1,"open\n')
    with pytest.raises(ValueError, match="pair up"):
        read_tweets_by_ranges(spark, str(tmp_path / "bad.csv"))
