import numpy as np
import pytest
from conftest import tuples
from pyspark.sql import functions as F

from threadloom.operators import agent, replies, retrieval


def unit(rng, n, dim, spread=None):
    points = rng.normal(size=(n, dim))
    if spread is not None:  # a few tight clumps, the first with half of the rows
        centres = rng.normal(size=(6, dim))
        member = np.where(rng.random(n) < 0.5, 0, rng.integers(0, 6, n))
        points = centres[member] + spread * points
    return (points / np.linalg.norm(points, axis=1, keepdims=True)).astype("float32")


def frame(spark, vectors, name, start=0):
    return spark.createDataFrame([(start + i, [float(x) for x in v]) for i, v in enumerate(vectors)],
                                 f"{name} long, vector array<float>")


def brute(queries, corpus, k, exclude=False):
    out = []
    for i, q in enumerate(queries.astype(float)):
        scores = [(-round(float(s), 12), j) for j, s in enumerate(corpus.astype(float) @ q) if not (exclude and i == j)]
        out += [(i, j, r + 1) for r, (_, j) in enumerate(sorted(scores)[:k])]
    return sorted(out)


@pytest.mark.parametrize("spread", [None, 0.1])
@pytest.mark.parametrize("sizes", [{}, {"block_rows": 40, "query_rows": 25}])
def test_knn_is_exact_for_vectors_of_any_length(spark, spread, sizes):
    rng = np.random.default_rng(3)
    corpus, queries = unit(rng, 300, 8, spread), unit(rng, 60, 8, spread)
    corpus[200:203] = corpus[0]  # exact copies: ties go to the smaller id
    longer = corpus * np.where(np.arange(300) % 2, 4, 1)[:, None]  # powers of two keep the cosines' bits
    hits = retrieval.knn_join(frame(spark, queries * 2, "query_id"), frame(spark, longer, "corpus_id"), 4, **sizes)
    norm = lambda m: m.astype(float) / np.linalg.norm(m.astype(float), axis=1, keepdims=True)
    assert sorted(tuples(hits, "query_id", "corpus_id", "rank")) == brute(norm(queries), norm(corpus), 4)
    itself = retrieval.knn_join(frame(spark, corpus, "query_id"), frame(spark, longer, "corpus_id"), 2, True, **sizes)
    assert sorted(tuples(itself, "query_id", "corpus_id", "rank")) == brute(norm(corpus), norm(corpus), 2, True)


def test_rows_are_sent_by_parts_of_many_blocks(spark, monkeypatch):
    rng = np.random.default_rng(5)
    corpus, queries = unit(rng, 300, 8), unit(rng, 30, 8)
    args = frame(spark, queries, "query_id"), frame(spark, corpus, "corpus_id")
    plain = {tuple(r) for r in retrieval.knn_join(*args, 3).collect()}
    groups, placed = [], retrieval._placed
    monkeypatch.setattr(retrieval, "_placed", lambda *a: (groups.append(placed(*a)), groups[-1])[1])
    assert {tuple(r) for r in retrieval.knn_join(*args, 3, block_rows=5, query_rows=2).collect()} == plain
    # 60 blocks and 15 chunks are one task's work
    assert groups[0]._gd1._df.count() == 30 and groups[0]._gd2._df.count() == 300
    # several parts and chunks, and hits cut on the way, give the same
    for name, value in (("BLOCK_ROWS", 70), ("QUERY_ROWS", 8), ("HITS", 10)):
        monkeypatch.setattr(retrieval, name, value)
    assert {tuple(r) for r in retrieval.knn_join(*args, 3, block_rows=5, query_rows=2).collect()} == plain


def test_codes_bound_the_cosine_and_rule_out_most_pairs(spark, tmp_path):
    rng = np.random.default_rng(8)
    corpus, queries = unit(rng, 2000, 32), unit(rng, 40, 32)
    corpus[3] = 0
    corpus[4] = np.eye(32)[0]
    index = retrieval.build_index(frame(spark, corpus, "corpus_id"), str(tmp_path / "index"), "one")
    turned = queries.astype(float) / np.linalg.norm(queries.astype(float), axis=1, keepdims=True) @ retrieval.rotation(32)
    for r in index.table.collect():
        near = turned @ (np.frombuffer(bytes(r["code"]), np.int8) * r["scale"])
        exact = turned @ (np.array(r["vector"]) @ retrieval.rotation(32))
        assert (np.abs(near - exact) <= r["error"] + 1e-12).all() and r["error"] < 0.02
    effort = retrieval.search_effort(frame(spark, queries, "query_id"), index, 5).first()
    assert (effort["queries"], effort["pairs"]) == (40, 80_000) and effort["refined"] < 2_000


def test_an_index_of_another_model_is_refused(spark, tmp_path):
    corpus = frame(spark, unit(np.random.default_rng(2), 5, 4), "corpus_id")
    retrieval.build_index(corpus, str(tmp_path / "index"), "one")
    assert retrieval.load_index(spark, str(tmp_path / "index"), "one").table.count() == 5
    with pytest.raises(ValueError, match="not of two"):
        retrieval.load_index(spark, str(tmp_path / "index"), "two")


def test_small_corpus_gives_fewer_ranks(spark):
    vectors = unit(np.random.default_rng(1), 2, 4)
    hits = retrieval.knn_join(frame(spark, vectors, "query_id"), frame(spark, vectors, "corpus_id"), 5)
    assert tuples(hits, "query_id", "rank") == [(0, 1), (0, 2), (1, 1), (1, 2)]
    empty = frame(spark, vectors, "query_id").where("false")
    assert retrieval.knn_join(empty, frame(spark, vectors, "corpus_id"), 5).count() == 0


def test_corpus_contract_and_storage(spark, tmp_path):
    rows = spark.createDataFrame([("i", "c", "m", "r", 1)],
                                 "interaction_id string, conversation_id string, customer_message string, "
                                 "brand_response string, extra int")
    assert retrieval.retrieval_corpus(rows).columns == retrieval.CORPUS_COLUMNS
    with pytest.raises(ValueError, match="lacks"):
        retrieval.retrieval_corpus(rows.drop("brand_response"))
    with pytest.raises(ValueError, match="empty"):
        retrieval.retrieval_corpus(rows.where("false"))
    retrieval.save_corpus(rows, str(tmp_path / "corpus"), "some-encoder")
    assert retrieval.load_corpus(spark, str(tmp_path / "corpus")).first().model_name == "some-encoder"
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        retrieval.load_corpus(spark, str(tmp_path / "none"))


def test_zero_shot_takes_best_cosine(spark):
    classes = spark.createDataFrame([("b", [0.0, 2.0]), ("a", [1.0, 0.0])], "class_id string, vector array<double>")
    df = frame(spark, np.array([[1.0, 0.0], [0.0, 1.0], [0.7071067, 0.7071067]], "float32"), "query_id")
    rows = sorted(retrieval.zero_shot(df, classes).collect(), key=lambda r: r.query_id)
    assert [r.predicted_class for r in rows] == ["a", "b", "a"]  # the first class on a tie
    assert rows[0].confidence == pytest.approx(np.exp(10) / (np.exp(10) + 1)) and rows[2].confidence == pytest.approx(0.5)


def cases(spark):
    return spark.createDataFrame(
        [(1, 7, 0.9, 1, "INT_7", "q7", "r7"), (1, 8, 0.4567, 2, "INT_8", "q8", "r8")],
        "query_id long, corpus_id long, similarity double, rank int, interaction_id string, customer_message string, "
        "brand_response string")


def test_copy_prompt_and_variants(spark):
    queries = spark.createDataFrame([(1, "hi"), (2, "yo")], "query_id long, message string")
    assert tuples(replies.top1_copy(queries, cases(spark))) == [(1, 7, "r7", 0.9), (2, None, "", 0.0)]
    evidence = replies.evidence_lists(cases(spark), ["customer_message", "brand_response"])
    prompt = queries.join(evidence, "query_id", "left").orderBy("query_id").select(
        replies.grounded_prompt(F.col("message"), F.lit("x"), F.col("evidence"))).collect()
    assert prompt[0][0] == (
        'Customer Inquiry: "hi"\nPredicted Intent Category: x\n\nRetrieved Historical Support Examples:\n'
        "Example 1 (Similarity: 0.90):\n  Customer Inquiry: q7\n  Historical Reply: r7\n\n"
        "Example 2 (Similarity: 0.46):\n  Customer Inquiry: q8\n  Historical Reply: r8\n\n"
        "Draft a grounded, polite Twitter response (<=280 chars):")
    assert "Examples:\n\n\nDraft" in prompt[1][0]


def test_agent_replies_only_when_auto(spark):
    inquiries = spark.createDataFrame(
        [(1, "I1", "C", "track it", "track it", "t"), (2, "I2", "C", "hack", "hack", "t")],
        "query_id long, interaction_id string, conversation_id string, customer_message string, "
        "query_context_used string, timestamp string")
    classified = spark.createDataFrame(
        [(1, "order_tracking_delivery", 0.91239), (2, "account_security_access", 0.99)],
        "query_id long, predicted_intent string, intent_confidence double")
    rows = agent.run(inquiries, classified, cases(spark)).orderBy("query_id").collect()
    assert set(agent.RECORD) <= set(rows[0].asDict())
    assert (rows[0].decision, rows[0].retrieved_evidence_ids, rows[0].retrieval_top_k) == ("AUTO", ["INT_7", "INT_8"], 2)
    assert rows[0].generated_response == replies.TEMPLATES[0].reply and rows[0].intent_confidence == 0.9124
    assert (rows[1].decision, rows[1].generated_response) == ("ESCALATE", None)
    assert rows[1].retrieval_similarity == 0.0 and rows[1].generation_metadata.status == agent.HALTED
    variants = {(r.query_id, r.variant): r.reply for r in replies.reply_variants(agent.run(
        inquiries, classified, cases(spark))).collect()}
    assert variants[(1, "A")] == variants[(1, "B")] == "r7" and variants[(1, "C")] == replies.TEMPLATES[0].reply
    assert variants[(2, "A")] == "" and variants[(2, "C")] == replies.ESCALATED
