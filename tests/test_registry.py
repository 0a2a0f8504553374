import duckdb
import pytest
from conftest import tuples

import __spark_entry__ as entry
from threadloom.operators import agent
from threadloom.operators.replies import Template
from threadloom.plans import oracle, registry
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
# one query per family; tools/check_oracle.py compares all of them
SAMPLE = ["interaction_funnel", "split_sample", "golden_carveout", "cleaned_examples", "class_report",
          "agent_pipeline", "agent_certificate", "agent_closed_loop", "bleu_rouge_means", "tfidf_phrases", "telemetry_windows", "logreg_certificate",
          "scoring_guard", "kmeans_certificate"]


def test_names_match_and_entry_runs(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.QUERIES) - set(oracle.SQL) == {"logreg_model", "kmeans_sweep", "agent_trained"}
    assert entry.entry(spark).count() > 0


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, sf, duck, name):
    df = entry.queries()[name](spark, sf)
    columns = sorted(df.columns)
    cursor = duck.execute(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})")
    assert tuples(df, *columns) == sorted(cursor.fetchall(), key=repr)


def test_closed_loop_against_a_plain_loop(spark):
    rows = [(c, p, text) for c in range(3) for p, text in enumerate(["alpha", "beta x", "stop", "gamma alpha", "beta"][:5 - c])]
    df = spark.createDataFrame(rows, "conversation_id long, position long, customer_message string")
    templates = [Template(("alpha",), "say alpha"), Template(("beta",), "say beta")]

    def decide(rows, framed):
        return {"decision": ["ESCALATE" if message == "stop" else "AUTO" for message in rows["customer_message"]]}

    # batches of two rows cut through the conversations
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    got = {(r.conversation_id, r.position): (r.query_context_used, r.generated_response)
           for r in agent.closed_loop(df, decide, "decision string", "Agent", templates, "other").collect()}
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    memory = {}
    for c, p, text in rows:
        lines = memory.setdefault(c, [])
        context = f"Preceding Context:\n" + "\n".join(lines[-4:]) + f"\n\nCurrent Inquiry:\n{text}" if lines else text
        reply = None if text == "stop" else next((t.reply for t in templates if t.words[0] in context.lower()), "other")
        assert got[(c, p)] == (context, reply)
        lines.append(f"Customer: {text}")
        if reply:
            lines.append(f"Agent: {reply}")
    assert len(got) == len(rows)
