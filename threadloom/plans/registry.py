"""Every registered query: name -> callable (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom.functions import text
from threadloom.operators import (
    agent, clustering, context, learning, metrics, ordering, overlap, profile, replies, retrieval, rubric, rules, splits, telemetry, tfidf, threads,
    triage)
from threadloom.plans.inputs import (
    BRAND, STOP_WORDS, TURN_STRIDE, as_telemetry, case_vectors, classified_vectors, intent_of_label, probe_rules, probe_templates, raw_tweets,
    table, telemetry_events, turn_vectors, turns, tweets, vectors)
from threadloom.session import broadcast_if_small, materialize
from threadloom.sources.sinks import (
    append_audit, read_audit, read_golden, read_thresholds, write_golden, write_splits, write_statistics, write_thresholds)
from threadloom.sources.tweets import assert_source, normalise, read_tweets, read_tweets_by_ranges
from threadloom.streaming import memory, runs
from threadloom.streaming import telemetry as stream_telemetry
from threadloom.streaming import triage as stream_triage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- threads and profile -------------------------------------------------------------------


@query
def tweet_quality_profile(spark, sf):
    return profile.quality_profile(tweets(spark, sf))


@query
def brand_ranking(spark, sf):
    # one account per 25th of the conversations, so that the top 20 is a real cut
    accounts = tweets(spark, sf).withColumn(
        "author_id", F.concat("author_id", F.lit("_"), F.floor((F.col("tweet_id") - 1) / TURN_STRIDE) % 25))
    return profile.brand_ranking(accounts)


@query
def thread_cycles(spark, sf):
    """Roots where replies run in circles: the first turn of each third conversation answers the last turn of the next
    third one, so that all of them are one cycle, and that of each other conversation answers a turn of its own."""
    rows = tweets(spark, sf)
    conversation = F.floor((F.col("tweet_id") - 1) / TURN_STRIDE)
    spans = rows.groupBy(conversation.alias("c")).agg(F.min("tweet_id").alias("low"), F.max("tweet_id").alias("high"))
    third = spans.where("c % 3 = 0")
    # the next third conversation, and after the last one the first
    follows = third.select((F.col("c") - 3).alias("c"), F.col("high").alias("target"))
    ends = third.agg(F.max("c").alias("c"), F.min(F.struct("c", "high"))["high"].alias("target"))
    ring = third.join(follows.unionByName(ends), "c").select("low", "target")
    own = spans.where("c % 3 <> 0").select("low", F.when(F.col("c") % 2 == 0, F.col("high")).otherwise(F.least(F.col("low") + 1, F.col("high"))).alias("target"))
    planted = ring.unionByName(own).groupBy("low").agg(F.min("target").alias("target"))
    looped = rows.join(planted, rows.tweet_id == planted.low, "left").withColumn("parent_id", F.coalesce("target", "parent_id"))
    return threads.thread_roots(looped.drop("low", "target"))


@query
def reply_pairs(spark, sf):
    return threads.rooted_pairs(tweets(spark, sf), BRAND).select(
        "interaction_id", "conversation_id", "customer_tweet_id", "brand_tweet_id", "timestamp")


@query
def thread_roots(spark, sf):
    return threads.thread_roots(tweets(spark, sf))


@query
def interactions(spark, sf):
    return threads.interactions(tweets(spark, sf), BRAND).drop("customer_ts")


@query
def interaction_funnel(spark, sf):
    return threads.interaction_funnel(tweets(spark, sf), BRAND)


@query
def parent_match_counts(spark, sf):
    matched = threads.match_parents(tweets(spark, sf), BRAND)
    status = F.when(F.col("parent_inbound").isNull(), "orphan").when(
        F.col("parent_inbound"), "inbound").otherwise("non_inbound")
    return matched.groupBy(status.alias("parent")).agg(F.count("*").alias("n"))


@query
def thread_messages(spark, sf):
    return threads.thread_messages(tweets(spark, sf), BRAND).select(
        "conversation_id", "message_position", "tweet_id", "author_id", "inbound", "created_at", "parent_id")


@query
def thread_sample(spark, sf):
    return threads.thread_sample(threads.thread_messages(tweets(spark, sf), BRAND))


@query
def pair_preview(spark, sf):
    return threads.pair_preview(threads.rooted_pairs(tweets(spark, sf), BRAND))


@query
def thread_metrics(spark, sf):
    return profile.thread_metrics(tweets(spark, sf), BRAND)


@query
def conversation_lengths(spark, sf):
    return profile.conversation_lengths(threads.thread_message_set(tweets(spark, sf), BRAND))


@query
def turn_distribution(spark, sf):
    return profile.turn_distribution(threads.interactions(tweets(spark, sf), BRAND))


# --- splits and golden set -----------------------------------------------------------------

# Working subset targets for the driver tables, small enough to cut every split.
TARGETS = {"train": 80, "validation": 15, "test": 15}
GOLDEN_N, CALIBRATION_N, HUMAN_N = 4, 2, 1


def prepared(spark, sf):
    """Clean interactions as a stored table, as the later stages read them more than once."""
    return materialize(threads.interactions(tweets(spark, sf), BRAND), "interactions")


def split_interactions(spark, sf):
    return splits.split_conversations(prepared(spark, sf))


def carved(spark, sf):
    test = split_interactions(spark, sf).where("split = 'test'")
    return materialize(splits.carve_out(test, GOLDEN_N), "carved")


@query
def conversation_split(spark, sf):
    return split_interactions(spark, sf).select("conversation_id", "split").distinct()


@query
def split_sample(spark, sf):
    return splits.sample_subsets(split_interactions(spark, sf), TARGETS).select(
        "split", "conversation_id", "brand_tweet_id")


@query
def split_stats(spark, sf):
    full = materialize(split_interactions(spark, sf), "split")
    return splits.split_statistics(full, splits.sample_subsets(full, TARGETS))


@query
def split_overlap(spark, sf):
    full = materialize(split_interactions(spark, sf), "split")
    return splits.overlaps(full, "conversation_id", "split", splits.SPLITS).unionByName(
        splits.overlaps(full, "interaction_id", "split", splits.SPLITS))


@query
def golden_carveout(spark, sf):
    return carved(spark, sf).select("conversation_id", "brand_tweet_id", "part")


@query
def golden_template(spark, sf):
    golden = carved(spark, sf).where("part = 'golden'")
    return splits.annotation_template(context.preceding_context(golden, BRAND))


@query
def pool_reconstruction(spark, sf):
    parts = carved(spark, sf)
    test = split_interactions(spark, sf).where("split = 'test'")
    keys = ["interaction_id", "conversation_id", "brand_tweet_id"]
    return splits.reconstruction_violations(
        [parts.where("part = 'golden'"), parts.where("part = 'pool'")], test, keys)


@query
def golden_disjointness(spark, sf):
    full = materialize(split_interactions(spark, sf), "split")
    parts = full.where("split <> 'test'").withColumnRenamed("split", "part").unionByName(
        splits.carve_out(full.where("split = 'test'"), GOLDEN_N).drop("split"))
    names = ["train", "validation", "golden", "pool"]
    return splits.overlaps(parts, "conversation_id", "part", names).unionByName(
        splits.overlaps(parts, "interaction_id", "part", names))


@query
def reply_integrity(spark, sf):
    """The golden template against the source: no violation as it is, and each one that is planted (every third reply)."""
    full = prepared(spark, sf)
    template = materialize(splits.annotation_template(context.preceding_context(full, BRAND)), "template")
    changed = F.when(F.substring("interaction_id", 8, 20).cast("long") % 3 == 0, F.concat("historical_reference_reply", F.lit("!")))
    planted = template.withColumn("historical_reference_reply", F.coalesce(changed, F.col("historical_reference_reply")))
    return splits.reply_violations(template, full).agg(F.count("*").alias("n")).select(F.lit("as_is").alias("template"), "n").unionByName(
        splits.reply_violations(planted, full).agg(F.count("*").alias("n")).select(F.lit("planted").alias("template"), "n"))


@query
def preceding_context(spark, sf):
    return context.preceding_context(prepared(spark, sf), BRAND).select(
        "conversation_id", "brand_tweet_id", "message_position", "is_multi_turn", "conversation_context")


@query
def memory_context(spark, sf):
    return context.memory_context(turns(spark, sf)).select("conversation_id", "position", "context")


# --- labels and examples -------------------------------------------------------------------


def labelled_turns(spark, sf):
    """Customer turns labelled from message and remembered context by the probe rules."""
    rows = context.memory_context(turns(spark, sf))
    return rules.label_by_rules(rows, probe_rules(), "text", F.array_join("history", "\n"))


@query
def rule_labels(spark, sf):
    return labelled_turns(spark, sf).select(
        "conversation_id", "position", "intent", "risk_tier", "requires_human_escalation",
        "escalation_reason", "annotation_notes")


@query
def silver_labels(spark, sf):
    rows = turns(spark, sf).where("role = 'Customer'")
    return rules.label_by_rules(rows, message="text").select(
        "conversation_id", "position", "intent", "risk_tier", "escalation_reason")


@query
def label_violations(spark, sf):
    return rules.label_violations(labelled_turns(spark, sf)).agg(F.count("*").alias("violations"))


@query
def label_distribution(spark, sf):
    rows = labelled_turns(spark, sf)
    parts = [profile.distribution(rows, c).select(F.lit(c).alias("label"), "value", "n", "pct")
             for c in ("intent", "requires_human_escalation", "escalation_reason")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def golden_profile(spark, sf):
    """Risk, turns and escalation of each intent in the golden set, with the shares that the report prints."""
    golden = carved(spark, sf).where("part = 'golden'")
    rows = rules.label_by_rules(
        context.preceding_context(golden, BRAND), probe_rules(), "customer_message", F.col("conversation_context"))
    share = lambda c: F.round(100 * F.count_if(c) / F.count("*"), 6)
    return rows.groupBy("intent", "risk_tier").agg(
        F.count("*").alias("n"), F.count_if("is_multi_turn").alias("multi_turn"),
        F.count_if(~F.col("is_multi_turn")).alias("single_turn"),
        F.count_if("requires_human_escalation").alias("escalate"),
        F.count_if(~F.col("requires_human_escalation")).alias("auto"),
        share("is_multi_turn").alias("multi_turn_pct"), share("requires_human_escalation").alias("escalate_pct")).withColumn(
        "title", text.title_label(F.col("intent")))


@query
def taxonomy_coverage(spark, sf):
    return rules.taxonomy_coverage(turns(spark, sf).where("role = 'Customer'"), "text", probe_rules())


def text_parts(spark, sf):
    """Customer texts with an id, split by conversation: (train, held out)."""
    rows = turns(spark, sf).where("role = 'Customer'")
    rows = rows.withColumn("id", F.col("conversation_id") * TURN_STRIDE + F.col("position"))
    rows = materialize(rows.withColumn("split", splits.split_column(rows, "conversation_id")), "texts")
    train = rules.training_texts(rows.where("split = 'train'"), "text", "id")
    held = [rules.training_texts(rows.where(F.col("split") == s), "text", "id") for s in ("validation", "test")]
    return train, rules.held_out_texts(*held)


@query
def cleaned_examples(spark, sf):
    return rules.mine_examples(*text_parts(spark, sf), probe_rules())


@query
def heldout_filter(spark, sf):
    train, held = text_parts(spark, sf)
    cleaned = text.clean_handles(F.col("text"))
    return train.join(held, "text", "left_anti").select("id", cleaned.alias("cleaned")).where(
        F.length("cleaned").between(15, 180))


def annotated(full):
    """(golden, human): the golden set of the test split, and the validation conversations that people labelled."""
    golden = splits.carve_out(full.where("split = 'test'"), GOLDEN_N).where("part = 'golden'")
    validation = full.where("split = 'validation'")
    human = splits.seeded_sample(validation.select("conversation_id").distinct(), HUMAN_N, splits.SPLIT_SEED, ["conversation_id"])
    return golden, human


@query
def calibration_labels(spark, sf):
    full = materialize(split_interactions(spark, sf), "split")
    golden, human = annotated(full)
    sample = splits.calibration_sample(full.where("split = 'validation'"), [golden, human], CALIBRATION_N)
    predicted = rules.label_by_rules(sample, probe_rules()).withColumn("predicted_intent", F.col("intent"))
    return rules.label_calibration(predicted.drop("requires_human_escalation", "escalation_reason")).select(
        "calib_id", "brand_tweet_id", "predicted_intent", "requires_human_escalation", "escalation_reason")


@query
def inquiry_validation(spark, sf):
    rows = table(spark, sf, "conversations").withColumn("message", text.strip(F.coalesce("text", F.lit(""))))
    status = F.when(F.col("message") != "", "valid").otherwise("rejected")
    return rows.groupBy(status.alias("status"), "role").agg(
        F.count("*").alias("n"), F.sum(F.length("message")).alias("chars"))


# --- retrieval, triage and evaluation ------------------------------------------------------


def _top3(hits):
    return hits.select("query_id", "corpus_id", F.round("similarity", 6).alias("similarity"), "rank")


@query
def knn_top3(spark, sf):
    return _top3(retrieval.knn_join(*case_vectors(spark, sf), 3))


@query
def knn_blocks(spark, sf):
    """The same neighbours from many small blocks and chunks, and from vectors of any length."""
    stretch = lambda df, name: df.withColumn("vector", F.transform(
        F.col("vector").cast("array<double>"), lambda x: x * (F.col(name) % 5 + 1)))
    queries, corpus = case_vectors(spark, sf)
    return _top3(retrieval.knn_join(stretch(queries, "query_id"), stretch(corpus, "corpus_id"), 3, block_rows=64, query_rows=16))


@query
def index_round_trip(spark, sf):
    """The same neighbours from an index that was stored with its model's name and loaded again."""
    queries, corpus = case_vectors(spark, sf)
    path = runs.scratch(spark, "vector-index")
    retrieval.build_index(corpus, path, "driver-embeddings")
    return _top3(retrieval.search(queries, retrieval.load_index(spark, path, "driver-embeddings"), 3))


@query
def search_effort(spark, sf):
    """How many pairs of queries and cases the codes leave open for the exact cosine."""
    queries, corpus = case_vectors(spark, sf)
    effort = retrieval.search_effort(queries, retrieval.build_index(corpus, runs.scratch(spark, "vector-index"), "driver-embeddings"), 3)
    return effort.select("queries", "pairs", (F.col("refined") < 0.2 * F.col("pairs")).alias("below_a_fifth"))


@query
def retrieval_diagnostics(spark, sf):
    queries, corpus = case_vectors(spark, sf)
    hits = materialize(retrieval.knn_join(queries, corpus, 5), "hits")
    return retrieval.retrieval_diagnostics(hits, queries)


@query
def zero_shot_intent(spark, sf):
    vecs = vectors(spark, sf, "query_id")
    scored = retrieval.zero_shot(vecs, retrieval.class_means(vecs, "label"))
    return scored.select("query_id", F.col("predicted_class").cast("int").alias("predicted_class"),
                         F.round("confidence", 6).alias("confidence"))


@query
def triage_decisions(spark, sf):
    return triage.triage(classified_vectors(spark, sf)).select(
        "query_id", "predicted_intent", "intent_confidence", "retrieval_similarity", "decision",
        "requires_human_escalation", "escalation_reason")


def scored_vectors(spark, sf):
    rows = classified_vectors(spark, sf)
    always = F.col("true_intent").isin(list(triage.ALWAYS_ESCALATE))
    return rows.withColumn("truth", always)


def _rounded_grid(grid):
    names = ["precision", "recall", "f1", "false_auto_rate"]
    return grid.select("tau_confidence", "tau_similarity", "tp", "fp", "fn", "tn",
                       *[F.round(c, 6).alias(c) for c in names])


@query
def threshold_grid(spark, sf):
    return _rounded_grid(triage.threshold_grid(scored_vectors(spark, sf)))


@query
def threshold_best(spark, sf):
    return _rounded_grid(triage.best_thresholds(triage.threshold_grid(scored_vectors(spark, sf))))


@query
def confusion_matrix(spark, sf):
    counts = metrics.confusion_counts(classified_vectors(spark, sf), "label", "predicted_label")
    return metrics.confusion_matrix(materialize(counts, "confusion"))


@query
def class_report(spark, sf):
    counts = metrics.confusion_counts(classified_vectors(spark, sf), "label", "predicted_label")
    return metrics.class_report(counts).select(
        "label", "tp", "support", "predicted", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query
def macro_report(spark, sf):
    counts = metrics.confusion_counts(classified_vectors(spark, sf), "label", "predicted_label")
    return metrics.macro_report(metrics.class_report(counts))


@query
def majority_baseline(spark, sf):
    vecs = vectors(spark, sf, "query_id")
    return metrics.majority_predictions(vecs, "label", vecs).select(
        "query_id", "predicted_label", "confidence")


@query
def score_diagnostics(spark, sf):
    rows = triage.triage(classified_vectors(spark, sf))
    return metrics.score_diagnostics(rows, ["intent_confidence", "retrieval_similarity"])


@query
def triage_metrics(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    low = F.lower("text")
    rows = docs.select((F.col("toxic") == 1).alias("truth"),
                       text.contains_any(low, ["hate", "idiot", "whst", "heed"]).alias("predicted"))
    m = triage.triage_metrics(rows, "truth", "predicted")
    return m.select("tp", "fp", "fn", "tn", *[
        F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "false_auto_rate", "accuracy")])


@query
def agreement(spark, sf):
    # a human score from the labels next to a rule score of the document text
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    scored = rubric.score_replies(docs, "text")
    judge = F.col("total_score")
    for word in ("whst", "heed", "ung"):
        judge = judge + F.lower("text").contains(word).cast("int")
    human = F.col("quality") * 2 - F.col("toxic") + 5
    return metrics.agreement(scored.select(human.alias("human"), judge.alias("judge")), "human", "judge").drop("p_value")


@query
def bleu_rouge_n(spark, sf):
    scored = overlap.overlap_scores(prepared(spark, sf), "customer_message", "brand_response")
    return scored.select("brand_tweet_id", *[F.round(s, 6).alias(s) for s in overlap.SCORES[:-1]])


@query
def bleu_rouge_means(spark, sf):
    scored = overlap.overlap_scores(prepared(spark, sf), "customer_message", "brand_response")
    return overlap.corpus_means(scored.drop("rouge_l"))


@query
def rouge_l(spark, sf):
    scored = overlap.overlap_scores(prepared(spark, sf), "customer_message", "brand_response")
    return scored.select("brand_tweet_id", F.round("rouge_l", 6).alias("rouge_l"))


@query
def rubric_scores(spark, sf):
    replies_ = turns(spark, sf).where(F.col("role") == BRAND)
    return rubric.score_replies(replies_, "text").select(
        "conversation_id", "position", *rubric.SCORES, "total_score")


@query
def rubric_ingest(spark, sf):
    # external scores arrive as JSON, here built from the events with values outside 0..2 and gaps
    v = F.col("event_id")
    payload = F.to_json(F.struct(
        (v % 5 - 1).cast("int").alias("correctness"),
        F.when(v % 3 > 0, (v % 4).cast("int")).alias("groundedness"),
        (v % 3).cast("int").alias("helpfulness"),
        F.when(v % 7 > 0, (v % 2).cast("int")).alias("policy_safety")))
    rows = table(spark, sf, "events").select("event_id", payload.alias("payload"))
    return rubric.ingest_scores(rows, "payload").groupBy(*rubric.SCORES, "total_score").agg(F.count("*").alias("n"))


@query
def template_reply(spark, sf):
    rows = context.memory_context(turns(spark, sf))
    reply = replies.template_reply(F.col("context"), probe_templates())
    return rows.select("conversation_id", "position", reply.alias("reply"))


# --- case retrieval and the agent ----------------------------------------------------------


def cases(spark, sf):
    """(corpus from the train split, queries from the others), with vectors."""
    full = materialize(split_interactions(spark, sf), "split")
    corpus = turn_vectors(full.where("split = 'train'"), spark, sf, "corpus_id")
    queries = turn_vectors(full.where("split <> 'train'"), spark, sf, "query_id")
    return materialize(corpus, "cases"), materialize(queries, "inquiries")


def case_hits(corpus, queries, k):
    payload = corpus.select("corpus_id", *retrieval.CORPUS_COLUMNS)
    return retrieval.knn_join(queries, corpus, k).join(payload, "corpus_id")


@query
def top1_copy(spark, sf):
    corpus, queries = cases(spark, sf)
    copied = replies.top1_copy(queries.select("query_id"), case_hits(corpus, queries, 1))
    return copied.withColumn("similarity_score", F.round("similarity_score", 6))


@query
def prompt_table(spark, sf):
    corpus, queries = cases(spark, sf)
    evidence = replies.evidence_lists(case_hits(corpus, queries, 3), ["customer_message", "brand_response"])
    prompt = replies.grounded_prompt(F.col("customer_message"), intent_of_label(F.col("label")), F.col("evidence"))
    return queries.join(evidence, "query_id", "left").select("query_id", prompt.alias("prompt"))


def framed_inquiries(queries):
    """Inquiries with the context that the agent's memory of four turns gives them."""
    turns_ = context.interaction_turns(queries, BRAND)
    return context.memory_context(turns_).select(
        "query_id", "interaction_id", "conversation_id", "customer_message", "timestamp", F.col("context").alias("query_context_used"))


def decisions(spark, sf):
    corpus, queries = cases(spark, sf)
    classes = retrieval.class_means(corpus, "label")
    classified = retrieval.zero_shot(queries, classes).select(
        "query_id", intent_of_label(F.col("predicted_class").cast("int")).alias("predicted_intent"),
        F.least(F.col("confidence") * 2, F.lit(1.0)).alias("intent_confidence"))
    return agent.run(framed_inquiries(queries), classified, case_hits(corpus, queries, 3), tau_similarity=0.3,
                     templates=probe_templates())


def _decision_record(rows):
    return rows.select(
        "query_id", "interaction_id", "predicted_intent", "intent_confidence", "retrieval_top_k",
        "retrieval_similarity", "decision", "requires_human_escalation", "escalation_reason",
        F.to_json("retrieved_evidence_ids").alias("evidence_ids"), "generated_response", "query_context_used")


@query
def agent_pipeline(spark, sf):
    return _decision_record(decisions(spark, sf))


@query
def agent_trained(spark, sf):
    """The agent with the trained classifier: it reads the framed context and learns from the train split's labels."""
    corpus, queries = cases(spark, sf)
    inquiries = materialize(framed_inquiries(queries), "framed")
    rows = labelled_texts(spark, sf)
    model, _ = learning.train(rows.where("split = 'train'"), rows.where("split = 'validation'"))
    texts = inquiries.select(F.col("query_id").alias("doc_id"), F.col("query_context_used").alias("text"))
    classified = learning.predict(texts, model).withColumnRenamed("doc_id", "query_id")
    return _decision_record(agent.run(inquiries, classified, case_hits(corpus, queries, 3), tau_similarity=0.3, templates=probe_templates()))


@query
def agent_certificate(spark, sf):
    """The agent with the trained classifier, checked: context, evidence and template as the tables give them, and whether
    the intent, the decision and the reply of each inquiry follow from the stored coefficients and the rules.
    """
    corpus, queries = cases(spark, sf)
    inquiries = materialize(framed_inquiries(queries), "framed")
    training, _ = trained_candidates(spark, sf)
    texts = inquiries.select(F.col("query_id").alias("doc_id"), F.col("query_context_used").alias("text"))
    classified = learning.predict(texts, training.best).withColumnRenamed("doc_id", "query_id")
    hits = materialize(case_hits(corpus, queries, 3), "hits")
    tau = 0.3
    records = materialize(_decision_record(agent.run(inquiries, classified, hits, tau_similarity=tau, templates=probe_templates())), "records")
    shares = learning.probabilities(texts, training.best).groupBy(F.col("doc_id").alias("query_id")).agg(
        F.max("p").alias("best_p"), F.map_from_entries(F.collect_list(F.struct("intent", "p"))).alias("p"))
    nearest = hits.groupBy("query_id").agg(F.max("similarity").alias("nearest"))
    always = F.create_map(*[F.lit(x) for pair in triage.ALWAYS_ESCALATE.items() for x in pair])
    # equal shares leave the intent open, and a share at the threshold may fall on either side by rounding
    own, close = F.col("p")[F.col("predicted_intent")], 1e-9

    def reason(shift):
        weak = (own + shift < triage.TAU_CONFIDENCE) | (F.coalesce("nearest", F.lit(0.0)) < tau)
        return F.coalesce(always[F.col("predicted_intent")], F.when(weak, "insufficient_context").otherwise("none"))

    template = replies.template_reply(F.col("query_context_used"), probe_templates(), replies.DEFAULT_REPLY)
    auto = F.col("escalation_reason") == "none"
    follows = F.col("escalation_reason").isin(reason(-close), reason(close)) & (F.col("requires_human_escalation") == ~auto) & (
        F.col("decision") == F.when(auto, "AUTO").otherwise("ESCALATE"))
    return records.join(shares, "query_id", "left").join(nearest, "query_id", "left").select(
        "query_id", "interaction_id", "query_context_used", "retrieval_top_k", "retrieval_similarity", "evidence_ids", template.alias("template"),
        F.coalesce((own >= F.col("best_p") - close) & (F.abs(own - F.col("intent_confidence")) <= 0.00005 + close), F.lit(False)).alias("intent_holds"),
        F.coalesce(follows, F.lit(False)).alias("decision_holds"),
        F.col("generated_response").eqNullSafe(F.when(auto, template)).alias("reply_holds"))


@query
def variant_means(spark, sf):
    variants = replies.reply_variants(materialize(decisions(spark, sf), "decisions"))
    return rubric.variant_means(rubric.score_replies(variants, "reply"))


@query
def agent_closed_loop(spark, sf):
    """All customer turns, with the agent's own replies as memory; the probe rules give the intent."""
    rows = turns(spark, sf).where("role = 'Customer'").withColumnRenamed("text", "customer_message")

    known = probe_rules()

    def decide(_, framed):
        intents = [rules.rule_of(text, known).intent for text in framed]
        reasons = [triage.reason_of(intent) for intent in intents]
        return {"intent": intents, "escalation_reason": reasons, "decision": ["AUTO" if r == "none" else "ESCALATE" for r in reasons]}

    answered = agent.closed_loop(rows, decide, "intent string, escalation_reason string, decision string", BRAND, probe_templates())
    return answered.select("conversation_id", "position", "intent", "decision", "escalation_reason",
                           "query_context_used", "generated_response")


@query
def pool_diagnostics(spark, sf):
    """Score diagnostics over all inquiries of the pool."""
    return metrics.score_diagnostics(decisions(spark, sf), ["intent_confidence", "retrieval_similarity"], "customer_message")


@query
def calibration_isolation(spark, sf):
    full = materialize(split_interactions(spark, sf), "split")
    golden, human = annotated(full)
    sample = splits.calibration_sample(full.where("split = 'validation'"), [golden, human], CALIBRATION_N)
    parts = golden.select("interaction_id", F.lit("golden").alias("part")).unionByName(
        sample.select("interaction_id", F.lit("calibration").alias("part")))
    return splits.overlaps(parts, "interaction_id", "part", ["golden", "calibration"])


# --- TF-IDF --------------------------------------------------------------------------------


@query
def tfidf_weights(spark, sf):
    docs = table(spark, sf, "documents")
    lists = tfidf.stored_term_lists(docs, "doc_id", "text")
    fitted = tfidf.fit(lists, docs.count())
    return tfidf.weights(lists, fitted).select("doc_id", "term", F.round("weight", 6).alias("weight"))


@query
def tfidf_phrases(spark, sf):
    docs = table(spark, sf, "documents")
    phrases = tfidf.top_phrases(docs, "doc_id", "text", STOP_WORDS)
    return phrases.select("term", F.round("mean_weight", 6).alias("mean_weight"))


# --- telemetry -----------------------------------------------------------------------------


@query
def telemetry_records(spark, sf):
    return telemetry.telemetry_record(telemetry_events(spark, sf))


@query
def telemetry_summary(spark, sf):
    summary = telemetry.telemetry_summary(telemetry_events(spark, sf))
    reasons = F.col("escalation_reasons")
    return summary.withColumn("escalation_reasons", F.to_json(reasons))


@query
def telemetry_reasons(spark, sf):
    return telemetry.reason_counts(telemetry_events(spark, sf))


@query
def confidence_histogram(spark, sf):
    return telemetry.confidence_histogram(telemetry_events(spark, sf))


@query
def telemetry_windows(spark, sf):
    return telemetry.windowed_totals(telemetry_events(spark, sf))


# --- learning ------------------------------------------------------------------------------


def labelled_texts(spark, sf):
    """Customer turns with silver labels and a split by conversation."""
    rows = turns(spark, sf).where("role = 'Customer'").withColumn(
        "doc_id", F.col("conversation_id") * TURN_STRIDE + F.col("position"))
    rows = rules.label_by_rules(rows, probe_rules(), "text").select("conversation_id", "doc_id", "text", "intent")
    return materialize(rows.withColumn("split", splits.split_column(rows, "conversation_id")), "silver")


@query
def logreg_model(spark, sf):
    rows = labelled_texts(spark, sf)
    model, _ = learning.train(rows.where("split = 'train'"), rows.where("split = 'validation'"))
    test = rows.where("split = 'test'")
    return learning.predict(test, model).join(test.select("doc_id", "intent"), "doc_id").select(
        "doc_id", "intent", "predicted_intent", F.round("intent_confidence", 4).alias("intent_confidence"))


def trained_candidates(spark, sf):
    """(training, rows): the three candidates fitted on the train split of the silver labels."""
    rows = labelled_texts(spark, sf)
    return learning.train_all(rows.where("split = 'train'"), rows.where("split = 'validation'")), rows


@query
def logreg_certificate(spark, sf):
    """For each candidate and class the size of the problem, and whether the gradient at the fitted coefficients is zero."""
    training, _ = trained_candidates(spark, sf)
    sizes = training.features.groupBy("intent").agg(F.count("*").alias("class_rows"), F.first("w").alias("class_weight"))
    out = []
    for model in training.models:
        slopes = learning.gradient(training.features, model).groupBy("class").agg(
            F.count("*").alias("places"), F.max(F.abs("value")).alias("slope"))
        named = slopes.withColumn("intent", F.element_at(F.lit(model.classes), F.col("class").cast("int") + 1))
        out.append(named.join(sizes, "intent").select(
            F.lit(model.c_param).alias("c_param"), "intent", F.lit(model.train_rows).cast("long").alias("train_rows"), "class_rows",
            F.round("class_weight", 6).alias("class_weight"), (F.col("places") - 1).alias("terms"),
            (F.col("slope") < learning.OPTIMAL).alias("optimal")))
    return out[0].unionByName(out[1]).unionByName(out[2])


@query
def logreg_choice(spark, sf):
    """The candidate strengths: whether the stored macro F1 is that of the predictions, and whether the first best was chosen."""
    training, _ = trained_candidates(spark, sf)
    rows = []
    for i, (model, macro_f1) in enumerate(zip(training.models, training.macro_f1)):
        scored = materialize(learning.score(training.held, model).select("intent", "predicted_intent"), "scored")
        # per label 2 tp / (support + predicted), over all labels that occur
        sides = scored.select(F.explode(F.array("intent", "predicted_intent")).alias("label"),
                              (F.col("intent") == F.col("predicted_intent")).cast("int").alias("hit"))
        f1 = sides.groupBy("label").agg((F.sum("hit") / F.count("*")).alias("f1")).agg(F.avg("f1")).first()[0]
        earlier, later = training.macro_f1[:i], training.macro_f1[i + 1:]
        first_best = all(f < macro_f1 for f in earlier) and all(f <= macro_f1 for f in later)
        rows.append((model.c_param, scored.count(), abs(f1 - macro_f1) < 1e-5, first_best == (model is training.best)))
    return spark.createDataFrame(rows, "c_param double, validation_rows long, score_holds boolean, choice_holds boolean")


@query
def model_round_trip(spark, sf):
    """The chosen classifier saved and loaded: whether the loaded one scores every text of the test split the same."""
    training, rows = trained_candidates(spark, sf)
    path = runs.scratch(spark, "classifier")
    learning.save(training.best, path)
    loaded = learning.load(spark, path)
    test = rows.where("split = 'test'")
    before, after = (learning.predict(test, m) for m in (training.best, loaded))
    pairs = before.join(after.select("doc_id", F.col("predicted_intent").alias("again"), F.col("intent_confidence").alias("confidence_again")), "doc_id")
    return pairs.join(test.select("doc_id", "intent"), "doc_id").select(
        "doc_id", "intent", (F.col("predicted_intent") == F.col("again")).alias("same_intent"),
        (F.abs(F.col("intent_confidence") - F.col("confidence_again")) < 1e-9).alias("same_confidence"))


@query
def scoring_guard(spark, sf):
    """Vocabulary and coefficients around scoring the test split: their size, and whether scoring left them as they were."""
    training, rows = trained_candidates(spark, sf)
    model = training.best

    def states():
        terms = model.vocabulary.terms.agg(F.count("*").alias("n"), F.sum(F.xxhash64("term", "df", "idf", "index").cast("decimal(20,0)")).alias("s")).first()
        values = learning.coefficients(model).agg(F.count("*").alias("n"), F.sum(F.xxhash64("class", "index", "value").cast("decimal(20,0)")).alias("s")).first()
        return [("vocabulary", *terms), ("coefficients", *values)]

    before = states()
    scored = learning.predict(rows.where("split = 'test'"), model).count()
    after = states()
    return spark.createDataFrame([(b[0], b[1], scored, b == a) for b, a in zip(before, after)], "part string, size long, scored long, unchanged boolean")


@query
def kmeans_sweep(spark, sf):
    vecs = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    swept = clustering.kmeans_sweep(vecs)
    return swept.select("k", F.round("silhouette", 6).alias("silhouette"), F.round("inertia", 4).alias("inertia"), "best")


@query
def kmeans_certificate(spark, sf):
    """For each k, from the stored centres by joins and sums alone: whether every centre is the mean of its nearest points,
    whether the inertia is right, and whether the silhouettes of every 100th vector equal those over all pairs with them."""
    vecs = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    points = clustering.numbered_points(vecs)
    chosen = clustering.best_clusterings(points)
    centres = materialize(spark.createDataFrame(
        [(c.k, i, v.tolist()) for c in chosen for i, v in enumerate(c.centres)], "k int, cluster int, centre array<double>"), "centres")
    square = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
    # every point meets the centres of every k: their number is fixed by the range of k
    listed = centres.groupBy("k").agg(F.collect_list(F.struct("cluster", "centre")).alias("centres"))
    nearest = materialize(points.crossJoin(F.broadcast(listed)).select(
        "row", "k", "id", "vector", F.array_min(F.transform("centres", lambda c: F.struct(
            square(F.col("vector"), c["centre"]).alias("square"), c["cluster"].alias("cluster")))).alias("own")), "nearest")
    sums = nearest.select("k", F.col("own.cluster").alias("cluster"), F.posexplode("vector").alias("dim", "value")).groupBy(
        "k", "cluster", "dim").agg(F.avg("value").alias("mean"))
    gaps = centres.select("k", "cluster", F.posexplode("centre").alias("dim", "value")).join(sums, ["k", "cluster", "dim"], "left")
    still = gaps.groupBy("k").agg(F.max(F.abs(F.coalesce("mean", "value") - F.col("value"))).alias("move"))
    costs = nearest.groupBy("k").agg(F.sum("own.square").alias("cost"), F.count("*").alias("points"))
    # the asked vectors against all points: a distance serves every k
    by_row = materialize(nearest.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("k", "own.cluster"))).alias("clusters")).join(
        points, "row"), "by-row")
    asked = materialize(by_row.where("id % 100 = 0").select("row", F.col("clusters").alias("mine"), F.col("vector").alias("asked")), "asked")
    means = clustering.gaps_by_cluster(by_row, asked, [c.k for c in chosen]).withColumnRenamed("gap", "total")
    own = F.col("cluster") == F.col("mine")
    sides = means.groupBy("k", "row").agg(
        F.max(F.when(own, F.col("total") / F.greatest(F.col("n") - 1, F.lit(1)))).alias("a"), F.max(F.when(own, F.col("n"))).alias("size"),
        F.min(F.when(~own, F.col("total") / F.col("n"))).alias("b"))
    plain = sides.select("k", "row", F.when(F.col("size") > 1, (F.col("b") - F.col("a")) / F.greatest("a", "b")).otherwise(0.0).alias("plain"))
    stored = clustering.silhouettes(clustering.labelled_points(points, chosen), [c.sizes for c in chosen])
    listed = stored.select("row", F.posexplode("scores").alias("at", "score")).select(
        "row", F.element_at(F.array(*[F.lit(c.k) for c in chosen]), F.col("at") + 1).alias("k"), "score")
    agree = plain.join(listed, ["row", "k"]).groupBy("k").agg(F.count("*").alias("asked"), F.max(F.abs(F.col("plain") - F.col("score"))).alias("gap"))
    inertia = spark.createDataFrame([(c.k, c.inertia) for c in chosen], "k int, inertia double")
    return costs.join(still, "k").join(agree, "k").join(inertia, "k").select(
        "k", "points", "asked", (F.col("move") < 1e-6).alias("fixpoint"),
        (F.abs(F.col("cost") - F.col("inertia")) < 1e-6 * F.col("cost")).alias("inertia_holds"), (F.col("gap") < 1e-6).alias("silhouette_holds"))


# --- sources and sinks ---------------------------------------------------------------------


@query
def tweet_csv_scan(spark, sf):
    """The whole tweet table written as quoted multi-line CSV and scanned back."""
    path = runs.scratch(spark, "tweets-csv")
    source = raw_tweets(spark, sf)
    source.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    scanned = normalise(assert_source(read_tweets(spark, path), min_rows=1))
    return scanned.select("tweet_id", "author_id", "inbound", "created_at", "text", "parent_id",
                          F.unix_seconds("ts").alias("epoch"))


@query
def tweet_csv_ranges(spark, sf):
    """The whole tweet table written as quoted multi-line CSV and scanned back by byte ranges of its files."""
    path = runs.scratch(spark, "tweets-ranges")
    source = raw_tweets(spark, sf)
    source.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    return normalise(read_tweets_by_ranges(spark, path)).select(
        "tweet_id", "author_id", "inbound", "created_at", "text", "parent_id", F.unix_seconds("ts").alias("epoch"))


@query
def split_sink(spark, sf):
    path = runs.scratch(spark, "splits")
    write_splits(split_interactions(spark, sf), path)
    return spark.read.parquet(path).groupBy("split").agg(
        F.count("*").alias("n"), F.countDistinct("conversation_id").alias("conversations"))


@query
def statistics_sink(spark, sf):
    """The statistics of the splits, stored and read back."""
    path = runs.scratch(spark, "statistics")
    full = materialize(split_interactions(spark, sf), "split")
    stats = splits.split_statistics(full, splits.sample_subsets(full, TARGETS))
    write_statistics(stats, path)
    return spark.read.schema(stats.schema).json(path)


@query
def threshold_sink(spark, sf):
    """The best thresholds, stored and read back as the configuration of the agent."""
    path = runs.scratch(spark, "thresholds")
    rows = materialize(scored_vectors(spark, sf), "scored")
    write_thresholds(triage.best_thresholds(triage.threshold_grid(rows)), path, rows.count(), "false auto rate")
    return spark.createDataFrame([read_thresholds(spark, path)], "tau_confidence double, tau_similarity double")


@query
def corpus_projection(spark, sf):
    return retrieval.retrieval_corpus(prepared(spark, sf))


@query
def source_contract(spark, sf):
    """Rows that pass the source's contract, by direction."""
    return normalise(assert_source(raw_tweets(spark, sf), min_rows=1)).groupBy("inbound").agg(F.count("*").alias("n"))


@query
def reply_pairs_spread(spark, sf):
    """The reply pairs with every answered message treated as hot, its replies dealt over two salts."""
    return threads.rooted_pairs(tweets(spark, sf), BRAND, hot_rows=0.5).select(
        "interaction_id", "conversation_id", "customer_tweet_id", "brand_tweet_id", "timestamp")


@query
def thread_messages_sliced(spark, sf):
    """The thread messages with conversations of more than two messages cut into slices."""
    return threads.thread_messages(tweets(spark, sf), BRAND, slice_rows=2).select(
        "conversation_id", "message_position", "tweet_id", "author_id", "inbound", "created_at", "parent_id")


@query
def preceding_context_blocks(spark, sf):
    """The preceding contexts with conversations of more than one pair cut into blocks."""
    return context.preceding_context(prepared(spark, sf), BRAND, block_rows=1).select(
        "conversation_id", "brand_tweet_id", "message_position", "is_multi_turn", "conversation_context")


@query
def memory_context_blocks(spark, sf):
    """The remembered contexts with long conversations cut into blocks of four turns."""
    return context.memory_context(turns(spark, sf), block_rows=4).select("conversation_id", "position", "context")


@query
def value_median(spark, sf):
    """The median of all event values, from ranges instead of one ordered list."""
    return ordering.exact_median(table(spark, sf, "events"), "value", most=50).select(F.round("median", 6).alias("median"))


@query
def golden_sink(spark, sf):
    """Every interaction as an annotation row, through CSV and JSON lines and back."""
    path = runs.scratch(spark, "golden")
    rows = splits.annotation_template(context.preceding_context(prepared(spark, sf), BRAND))
    write_golden(rows, path)
    back = [read_golden(spark, path, rows.schema, form).select(F.lit(form).alias("form"), "*") for form in ("csv", "json")]
    return back[0].unionByName(back[1]).select(
        "form", "example_id", "interaction_id", "conversation_context", "customer_message",
        "historical_reference_reply", "is_multi_turn", "message_position")


@query
def audit_log(spark, sf):
    path = runs.scratch(spark, "audit")
    append_audit(telemetry.telemetry_record(telemetry_events(spark, sf)), path)
    return read_audit(spark, path)


@query
def audit_log_rerun(spark, sf):
    """Two jobs write the audit log, and one of them runs again: each record is there once."""
    path = runs.scratch(spark, "audit-rerun")
    records = telemetry.telemetry_record(telemetry_events(spark, sf))
    part = F.pmod(F.xxhash64("interaction_id"), F.lit(2))
    for job in (0, 1, 0):
        append_audit(records.where(part == job), path, f"part-{job}")
    return read_audit(spark, path)


# --- streams -------------------------------------------------------------------------------


def turn_stream(spark, sf):
    rows = runs.file_stream(spark, f"{sf}/conversations*.parquet", table(spark, sf, "conversations").schema)
    role = F.when(F.col("role") == "user", "Customer").otherwise(F.lit("AmazonHelp"))
    return rows.where(F.col("role").isin("user", "assistant")).select(
        F.col("conv_id").alias("conversation_id"), F.col("turn").alias("position"), role.alias("role"), "text",
        F.timestamp_seconds(F.lit(1704067200) + F.col("conv_id") * 3600 + F.col("turn") * 60).alias("ts"))


def event_stream(spark, sf):
    rows = runs.file_stream(spark, f"{sf}/events*.parquet", table(spark, sf, "events").schema)
    return as_telemetry(rows)


@query
def memory_stream(spark, sf):
    return runs.run_to_table(memory.memory_stream(turn_stream(spark, sf)), "memory")


@query
def memory_stream_ordered(spark, sf):
    return runs.run_to_table(memory.memory_stream(turn_stream(spark, sf), "0 seconds"), "memory")


@query
def telemetry_stream_totals(spark, sf):
    totals = stream_telemetry.running_totals(event_stream(spark, sf))
    return stream_telemetry.run_updates(totals, ["decision", "escalation_reason"], "totals")


@query
def telemetry_stream_summary(spark, sf):
    summary = stream_telemetry.running_summary(event_stream(spark, sf))
    return stream_telemetry.run_updates(summary, ["scope"], "summary").drop("scope")


@query
def telemetry_stream_windows(spark, sf):
    windows = stream_telemetry.windowed_stream(event_stream(spark, sf))
    return stream_telemetry.run_updates(windows, ["window_start"], "windows")


@query
def memory_stream_idle(spark, sf):
    """Turns that arrive out of order in three runs, with a long pause after every third turn, after which nothing is remembered."""
    rows = table(spark, sf, "conversations").where(F.col("role").isin("user", "assistant")).select(
        F.col("conv_id").alias("conversation_id"), F.col("turn").alias("position"),
        F.when(F.col("role") == "user", "Customer").otherwise(F.lit("AmazonHelp")).alias("role"), "text",
        F.timestamp_seconds(F.lit(1704067200) + F.col("conv_id") * 3600 + F.col("turn") * 60 + F.floor(F.col("turn") / 3) * 1800).alias("ts"))
    # a last row, years later, lets the watermark pass all others
    end = spark.sql("SELECT -1L AS conversation_id, 0L AS position, 'Customer' AS role, 'end' AS text, TIMESTAMP '2090-01-01 00:00:00' AS ts")
    path = runs.scratch(spark, "memory-idle")
    for part in [*[rows.where(F.col("position") % 3 == i) for i in (2, 0, 1)], end]:
        part.write.mode("append").parquet(f"{path}/in")
        stream = memory.memory_stream(runs.file_stream(spark, f"{path}/in", rows.schema), "10000 days", idle_ms=900_000)
        runs.start(stream, path).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/table").where("conversation_id >= 0")


def _in_runs(spark, path, parts, run):
    """Parts of a table arrive one after the other, each read by a run that goes on from the last one."""
    for part in parts:
        part.write.mode("append").parquet(f"{path}/in")
        run(runs.file_stream(spark, f"{path}/in", part.schema))


@query
def telemetry_late_rows(spark, sf):
    """Hourly windows over the days in order, with every 50th event of the first half arriving last, and the account of its rows."""
    path = runs.scratch(spark, "late")
    rows = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    late = (F.col("event_id") % 50 == 0) & (F.col("ts") < "2024-01-16")
    parts = [rows.where(~late & (F.col("ts") < "2024-01-11")), rows.where(~late & F.col("ts").between("2024-01-11", "2024-01-20")),
             rows.where(~late & (F.col("ts") > "2024-01-20")), rows.where(late)]
    _in_runs(spark, path, parts, lambda stream: stream_telemetry.run_accounted(stream_telemetry.windowed_stream(as_telemetry(stream)), path))
    return stream_telemetry.row_account(spark, path, ["window_start"], "total_inquiries")


@query
def telemetry_totals_merged(spark, sf):
    """Running totals over three runs, merged after each one; a batch that is already merged is written again before the last."""
    path, keys = runs.scratch(spark, "merged"), ["decision", "escalation_reason"]
    rows = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))

    def run(stream):
        stream_telemetry.start_updates(stream_telemetry.running_totals(as_telemetry(stream)), path).awaitTermination()
        stream_telemetry.merge_updates(spark, path, keys)
        again = stream_telemetry.latest(spark, path, keys).withColumn("n", F.lit(-1).cast("long"))
        again.write.mode("overwrite").parquet(f"{path}/updates/batch=0")

    _in_runs(spark, path, [rows.where(F.col("event_id") % 3 == i) for i in range(3)], run)
    return stream_telemetry.latest(spark, path, keys)


@query
def triage_stream(spark, sf):
    """Customer turns as a stream of inquiries, triaged against the cases of the train split."""
    corpus, _ = cases(spark, sf)
    classes = materialize(
        retrieval.class_means(corpus, "label").withColumn("class_id", intent_of_label(F.col("class_id"))), "classes")
    vecs = vectors(spark, sf, "vec_id")
    size = vecs.count()
    inquiries = turn_stream(spark, sf).where("role = 'Customer'").withColumn(
        "vec_id", (F.col("conversation_id") * 8 + F.col("position")) % size).join(vecs, "vec_id").select(
        (F.col("conversation_id") * TURN_STRIDE + F.col("position")).alias("query_id"),
        F.concat_ws("_", F.lit("INT"), "conversation_id", "position").alias("interaction_id"),
        F.col("conversation_id").cast("string").alias("conversation_id"), F.col("text").alias("customer_message"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"), "vector")
    path = runs.scratch(spark, "triage")
    index = retrieval.build_index(corpus, f"{path}/index", "driver-embeddings")
    stream_triage.start_triage(inquiries, corpus, index, classes, path, tau_confidence=0.25).awaitTermination()
    return read_audit(spark, f"{path}/audit").drop("batch", "latency_ms")
