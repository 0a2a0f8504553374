from conftest import tuples
from pyspark.sql import functions as F

from threadloom.operators import context, retrieval, telemetry
from threadloom.streaming import memory, runs
from threadloom.streaming import telemetry as stream_telemetry
from threadloom.streaming import triage as stream_triage

SCHEMA = "conversation_id long, position long, role string, text string, ts timestamp"


def turn_rows(spark, n=40):
    return spark.range(n).select(
        (F.col("id") % 3).alias("conversation_id"), F.col("id").alias("position"),
        F.when(F.col("id") % 2 == 0, "Customer").otherwise("AmazonHelp").alias("role"),
        F.concat(F.lit(" t"), F.col("id")).alias("text"), F.timestamp_seconds(F.col("id") * 60 + 1_000_000).alias("ts"))


def stream_of(spark, path, parts):
    """One file, and so one micro-batch, per part."""
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(path)
    return runs.file_stream(spark, path, parts[0].schema, files_per_trigger=1)


def test_memory_over_many_batches_equals_batch(spark, tmp_path):
    rows = turn_rows(spark)
    parts = [rows.where(F.col("position").between(i, i + 9)) for i in range(0, 40, 10)]
    streamed = runs.run_to_table(memory.memory_stream(stream_of(spark, str(tmp_path / "in"), parts)), "t")
    expected = context.memory_context(rows)
    columns = ["conversation_id", "position", "context"]
    assert tuples(streamed, *columns) == tuples(expected, *columns)


def test_ordered_memory_restores_event_time_order(spark, tmp_path):
    rows = turn_rows(spark)
    # neighbours swapped across batches, then a far later row that lets the watermark pass
    last = spark.createDataFrame([(99, 0, "Customer", "end", None)], SCHEMA).withColumn(
        "ts", F.timestamp_seconds(F.lit(10_000_000)))
    parts = [rows.where("position % 2 = 1 AND position < 10"), rows.where("position % 2 = 0 AND position < 10"),
             rows.where("position >= 10"), last]
    streamed = runs.run_to_table(
        memory.memory_stream(stream_of(spark, str(tmp_path / "in"), parts), "30 minutes"), "t")
    columns = ["conversation_id", "position", "context"]
    expected = context.memory_context(rows)
    assert tuples(streamed.where("conversation_id < 99"), *columns) == tuples(expected, *columns)


def events(spark, start, n):
    return spark.range(start, start + n).select(
        F.timestamp_seconds(F.col("id") * 600).alias("ts"),
        F.when(F.col("id") % 3 == 0, "ESCALATE").otherwise("AUTO").alias("decision"),
        F.when(F.col("id") % 3 == 0, "high_risk").otherwise("none").alias("escalation_reason"),
        (F.col("id") % 10 / 10).alias("intent_confidence"), (F.col("id") % 4).alias("evidence_count"))


def test_running_totals_and_windows_equal_batch(spark, tmp_path):
    parts = [events(spark, i * 10, 10) for i in range(3)]
    whole = events(spark, 0, 30)
    totals = stream_telemetry.run_updates(
        stream_telemetry.running_totals(stream_of(spark, str(tmp_path / "a"), parts)), ["decision", "escalation_reason"], "t")
    assert tuples(totals, "decision", "escalation_reason", "n") == tuples(telemetry.reason_counts(whole))
    windows = stream_telemetry.run_updates(
        stream_telemetry.windowed_stream(stream_of(spark, str(tmp_path / "b"), parts)), ["window_start"], "t")
    expected = telemetry.windowed_totals(whole)
    assert tuples(windows, *expected.columns) == tuples(expected)


def test_late_rows_are_counted_over_all_runs(spark, tmp_path):
    path, source = str(tmp_path / "out"), str(tmp_path / "in")
    for part in [events(spark, 100, 10), events(spark, 200, 10), events(spark, 0, 3), events(spark, 210, 4)]:
        part.coalesce(1).write.mode("append").parquet(source)
        stream = runs.file_stream(spark, source, part.schema)
        stream_telemetry.run_accounted(stream_telemetry.windowed_stream(stream), path)
    # three rows of one window are one dropped group, but three dropped rows
    assert tuple(stream_telemetry.row_account(spark, path, ["window_start"], "total_inquiries").first()) == (27, 24, 3)
    stream_telemetry.run_accounted(stream_telemetry.windowed_stream(stream), path)
    assert stream_telemetry.row_account(spark, path, ["window_start"], "total_inquiries").first()["input_rows"] == 27


def test_more_batches_than_the_engine_remembers_are_accounted(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    path = str(tmp_path / "out")
    parts = [events(spark, i, 1) for i in [100, 101, 102, 200, 3, 4, 5]]
    stream_telemetry.run_accounted(stream_telemetry.windowed_stream(stream_of(spark, str(tmp_path / "in"), parts)), path)
    spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    account = stream_telemetry.row_account(spark, path, ["window_start"], "total_inquiries").first()
    assert (account["input_rows"], account["late_rows"]) == (7, 3)


def test_a_merged_log_ignores_replayed_batches_and_stays_small(spark, tmp_path):
    path, source, keys = str(tmp_path / "out"), str(tmp_path / "in"), ["decision", "escalation_reason"]
    assert stream_telemetry.merge_updates(spark, path, keys) is None
    for i in range(3):
        events(spark, i * 10, 10).coalesce(1).write.mode("append").parquet(source)
        stream = runs.file_stream(spark, source, events(spark, 0, 1).schema)
        stream_telemetry.start_updates(stream_telemetry.running_totals(stream), path).awaitTermination()
        before = tuples(stream_telemetry.latest(spark, path, keys), *keys, "n")
        upto = stream_telemetry.merge_updates(spark, path, keys)
        assert tuples(stream_telemetry.latest(spark, path, keys), *keys, "n") == before
        # folders that a stopped merge left behind
        stream_telemetry.latest(spark, path, keys).withColumn("n", F.lit(-1).cast("long")).write.parquet(f"{path}/updates/batch={upto}")
        assert tuples(stream_telemetry.latest(spark, path, keys), *keys, "n") == before
        assert stream_telemetry.merge_updates(spark, path, keys) == upto
    assert before == tuples(telemetry.reason_counts(events(spark, 0, 30)))
    assert len(list((tmp_path / "out" / "merged").iterdir())) == 1
    # a merge that never finished does not count
    (tmp_path / "out" / "merged" / "upto=99").mkdir()
    assert tuples(stream_telemetry.latest(spark, path, keys), *keys, "n") == before


def test_idle_conversations_are_forgotten_and_leave_the_state(spark, tmp_path):
    minutes = [(1, 0, 0), (1, 2, 3), (1, 4, 40), (1, 6, 41), (2, 0, 1), (2, 2, 16)]
    rows = spark.createDataFrame([(c, p, "Customer", f"t{p}") for c, p, _ in minutes], "conversation_id long, position long, role string, text string")
    times = F.create_map(*[F.lit(x) for c, p, m in minutes for x in (f"{c}-{p}", m)])
    rows = rows.withColumn("ts", F.timestamp_seconds(F.lit(1_000_000) + times[F.concat_ws("-", "conversation_id", "position")] * 60))
    end = spark.createDataFrame([(99, i, "Customer", "end", None) for i in (0, 1)], SCHEMA)
    ends = [end.where(F.col("position") == i).withColumn("ts", F.timestamp_seconds(F.lit(9_000_000) + i * 9_000_000)) for i in (0, 1)]
    parts = [rows.where("position IN (2, 4)"), rows.where("position IN (0, 6)"), *ends]
    path = str(tmp_path / "out")
    query = runs.start(memory.memory_stream(stream_of(spark, str(tmp_path / "in"), parts), "100 minutes", idle_ms=900_000), path)
    query.awaitTermination()
    got = {(r.conversation_id, r.position): r.context for r in spark.read.parquet(f"{path}/table").where("conversation_id < 99").collect()}
    frame = lambda line, text: f"Preceding Context:\nCustomer: {line}\n\nCurrent Inquiry:\n{text}"
    assert got == {(1, 0): "t0", (1, 2): frame("t0", "t2"), (1, 4): "t4", (1, 6): frame("t4", "t6"), (2, 0): "t0", (2, 2): frame("t0", "t2")}
    left = spark.read.format("statestore").option("stateVarName", "last").load(f"{path}/checkpoint")
    assert {r.key.conversation_id for r in left.collect()} <= {99}


def test_triage_stream_writes_one_audit_row_per_valid_inquiry(spark, tmp_path):
    corpus = spark.createDataFrame(
        [(1, [1.0, 0.0], "I1", "C1", "q1", "r1"), (2, [0.0, 1.0], "I2", "C2", "q2", "r2")],
        "corpus_id long, vector array<float>, interaction_id string, conversation_id string, "
        "customer_message string, brand_response string")
    classes = spark.createDataFrame(
        [("order_tracking_delivery", [1.0, 0.0]), ("account_security_access", [0.0, 1.0])],
        "class_id string, vector array<double>")
    schema = "query_id long, interaction_id string, conversation_id string, customer_message string, timestamp string, vector array<float>"
    parts = [spark.createDataFrame([(1, "a", "c", "where", "t", [1.0, 0.0]), (2, "b", "c", "  ", "t", [1.0, 0.0])], schema),
             spark.createDataFrame([(3, "d", "c", "help", "t", [0.0, 1.0])], schema)]
    out = str(tmp_path / "out")
    index = retrieval.build_index(corpus, str(tmp_path / "index"), "test")
    stream_triage.start_triage(stream_of(spark, str(tmp_path / "in"), parts), corpus, index, classes, out).awaitTermination()
    audit = spark.read.json(f"{out}/audit")
    assert tuples(audit, "interaction_id", "decision", "escalation_reason") == [
        ("a", "AUTO", "none"), ("d", "ESCALATE", "high_risk")]
    assert audit.select("batch").distinct().count() == 2


def test_explicit_history_replaces_memory_and_clear_empties_it(spark, tmp_path):
    schema = SCHEMA + ", history array<string>"
    rows = [(1, 0, "Customer", "a", None, None), (1, 1, "AmazonHelp", "b", None, None),
            (1, 2, "Customer", "c", None, ["Customer: x", "Agent: y"]), (1, 3, "clear", None, None, None),
            (1, 4, "Customer", "d", None, None), (1, 5, "Customer", "e", None, [])]
    df = spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_seconds(F.col("position") + 1_000_000))
    got = tuples(runs.run_to_table(memory.memory_stream(stream_of(spark, str(tmp_path / "in"), [df])), "t"), "position", "context")
    frame = lambda lines, text: "Preceding Context:\n" + "\n".join(lines) + "\n\nCurrent Inquiry:\n" + text
    assert got == [(0, "a"), (2, frame(["Customer: x", "Agent: y"], "c")), (4, "d"), (5, frame(["Customer: d"], "e"))]
