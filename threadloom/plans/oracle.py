"""The registered queries as SQL over the same parquet tables."""

from __future__ import annotations

from threadloom.operators.replies import DEFAULT_REPLY
from threadloom.operators.rules import INTENTS, LABEL_RULES, OTHER
from threadloom.plans.inputs import STOP_WORDS, probe_rules, probe_templates

SQL: dict[str, str] = {}

SPACE = r"[\s\p{Z}\x{0B}\x{1C}-\x{1F}\x{85}]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


TWEETS = """
tweets AS (
  SELECT tweet_id,
         CASE role WHEN 'assistant' THEN 'Brand' WHEN 'system' THEN 'system'
              ELSE 'cust' || conv_id END AS author_id,
         role = 'user' AS inbound,
         TIMESTAMP '2024-01-01 00:00:00' + to_seconds(conv_id * 3600 + turn * 60) AS ts,
         strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(conv_id * 3600 + turn * 60),
                  '%a %b %d %H:%M:%S +0000 %Y') AS created_at,
         text,
         (tweet_id + 1) || CASE WHEN tweet_id % 23 = 0 THEN ',' || (tweet_id + 2) ELSE '' END AS response_tweet_id,
         CASE WHEN turn = 0 THEN NULL
              WHEN tweet_id % 17 = 0 THEN -(tweet_id - 1)
              WHEN tweet_id % 19 = 0 AND turn > 1 THEN tweet_id - 2
              ELSE tweet_id - 1 END AS parent_id
  FROM (SELECT *, conv_id * 1000000 + turn + 1 AS tweet_id FROM conversations)
)"""

ROOTS = TWEETS + """,
walk(tweet_id, here, top, steps) AS (
  SELECT tweet_id, tweet_id, tweet_id, 0 FROM tweets WHERE inbound
  UNION ALL
  SELECT w.tweet_id, p.tweet_id, CASE WHEN p.inbound THEN p.tweet_id ELSE w.top END, w.steps + 1
  FROM walk w JOIN tweets c ON c.tweet_id = w.here JOIN tweets p ON p.tweet_id = c.parent_id
),
roots AS (SELECT tweet_id, arg_max(top, steps) AS root_id FROM walk GROUP BY tweet_id)"""

PAIRS = ROOTS + """,
pairs AS (
  SELECT 'INT_AH_' || c.tweet_id AS interaction_id, 'CONV_AH_' || r.root_id AS conversation_id,
         c.text AS customer_message, b.text AS brand_response,
         strftime(c.ts, '%Y-%m-%dT%H:%M:%S+00:00') AS timestamp, c.ts AS customer_ts,
         c.author_id AS customer_author_id, c.tweet_id AS customer_tweet_id, b.tweet_id AS brand_tweet_id,
         b.author_id AS brand_author_id, b.created_at AS brand_created_at, c.created_at AS customer_created_at,
         b.ts AS brand_ts, c.parent_id AS customer_parent_id
  FROM tweets b JOIN tweets c ON b.parent_id = c.tweet_id JOIN roots r ON r.tweet_id = c.tweet_id
  WHERE b.author_id = 'Brand' AND NOT b.inbound AND c.inbound
)"""

INTERACTIONS = PAIRS + f""",
inter AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_message, brand_response ORDER BY brand_tweet_id) AS copy
    FROM pairs WHERE {strip('customer_message')} <> '' AND {strip('brand_response')} <> ''
  ) WHERE copy = 1 AND (customer_ts IS NOT NULL OR {strip('customer_created_at')} <> '')
)"""

MESSAGES = PAIRS + """,
sides AS (
  SELECT conversation_id, customer_tweet_id AS tweet_id, customer_author_id AS author_id, true AS inbound,
         customer_created_at AS created_at, customer_ts AS ts, customer_message AS text,
         customer_parent_id AS parent_id FROM pairs
  UNION
  SELECT conversation_id, brand_tweet_id, brand_author_id, false, brand_created_at, brand_ts, brand_response,
         customer_tweet_id FROM pairs
),
messages AS (
  SELECT *, row_number() OVER (PARTITION BY conversation_id ORDER BY ts, tweet_id) AS message_position FROM sides
)"""


def sql(name: str, ctes: str, select: str) -> None:
    head = f"WITH RECURSIVE {ctes.strip()}\n" if ctes else ""
    SQL[name] = head + select.strip()


_COLUMNS = ["tweet_id", "author_id", "inbound", "created_at", "text", "response_tweet_id", "parent_id"]
sql("tweet_quality_profile", TWEETS, " UNION ALL ".join(
    ["SELECT 'rows' AS metric, count(*)::DOUBLE AS value FROM tweets"]
    + [f"SELECT 'missing_{c}', (count(*) FILTER ({c} IS NULL))::DOUBLE FROM tweets" for c in _COLUMNS]
    + [f"SELECT 'missing_pct_{c}', round((count(*) FILTER ({c} IS NULL))::DOUBLE * 100 / count(*), 6) FROM tweets"
       for c in _COLUMNS]
    + [f"SELECT 'blank_text', (count(*) FILTER ({strip('text')} = ''))::DOUBLE FROM tweets",
       "SELECT 'invalid_timestamp', (count(*) FILTER (ts IS NULL))::DOUBLE FROM tweets",
       "SELECT 'multiple_responses', (count(*) FILTER (contains(response_tweet_id, ',')))::DOUBLE FROM tweets",
       "SELECT 'duplicate_tweet_ids', (count(*) - count(DISTINCT tweet_id))::DOUBLE FROM tweets"]))

sql("brand_ranking", TWEETS, """
SELECT author_id || '_' || ((tweet_id - 1) // 1000000) % 25 AS brand, count(*) AS brand_responses,
       count(DISTINCT parent_id) AS direct_queries
FROM tweets WHERE NOT inbound GROUP BY 1 ORDER BY brand_responses DESC, brand LIMIT 20""")

sql("reply_pairs", PAIRS,
    "SELECT interaction_id, conversation_id, customer_tweet_id, brand_tweet_id, timestamp FROM pairs")

sql("thread_roots", ROOTS, "SELECT tweet_id, root_id FROM roots")

sql("thread_cycles", TWEETS + """,
spans AS (SELECT (tweet_id - 1) // 1000000 AS c, min(tweet_id) AS low, max(tweet_id) AS high FROM tweets GROUP BY 1),
third AS (SELECT * FROM spans WHERE c % 3 = 0),
ring AS (
  SELECT p.low, q.high AS target FROM third p JOIN third q ON q.c = p.c + 3
  UNION ALL SELECT (SELECT arg_max(low, c) FROM third), (SELECT arg_min(high, c) FROM third)
  UNION ALL SELECT low, CASE WHEN c % 2 = 0 THEN high ELSE least(low + 1, high) END FROM spans WHERE c % 3 <> 0),
planted AS (SELECT low, min(target) AS target FROM ring GROUP BY low),
looped AS (SELECT tweet_id, inbound, coalesce(target, parent_id) AS parent_id FROM tweets LEFT JOIN planted ON low = tweet_id),
ways(tweet_id, here, top, seen) AS (
  SELECT tweet_id, tweet_id, tweet_id, [tweet_id] FROM looped WHERE inbound
  UNION ALL
  SELECT w.tweet_id, p.tweet_id, CASE WHEN p.inbound THEN p.tweet_id ELSE w.top END, list_append(w.seen, p.tweet_id)
  FROM ways w JOIN looped c ON c.tweet_id = w.here JOIN looped p ON p.tweet_id = c.parent_id
  WHERE NOT list_contains(w.seen, p.tweet_id)
)""", "SELECT tweet_id, arg_max(top, len(seen)) AS root_id FROM ways GROUP BY tweet_id")

sql("interactions", INTERACTIONS, """
SELECT interaction_id, conversation_id, customer_message, brand_response, timestamp, customer_author_id,
       customer_tweet_id, brand_tweet_id FROM inter""")

sql("interaction_funnel", INTERACTIONS, f"""
SELECT (SELECT count(*) FROM tweets) AS raw_total_tweets,
       count(*) AS brand_outbound_responses,
       count(*) FILTER (b.parent_id IS NULL) AS missing_parent_id_count,
       count(*) FILTER (b.parent_id IS NOT NULL AND c.tweet_id IS NULL) AS orphan_parent_count,
       count(*) FILTER (NOT c.inbound) AS non_inbound_parent_count,
       (SELECT count(*) FROM pairs) AS total_reconstructed_pairs_raw,
       (SELECT count(*) FROM pairs WHERE {strip('customer_message')} = '' OR {strip('brand_response')} = '')
         AS empty_whitespace_filtered_count,
       (SELECT count(*) - count(DISTINCT (customer_message, brand_response)) FROM pairs
        WHERE {strip('customer_message')} <> '' AND {strip('brand_response')} <> '')
         AS duplicate_interaction_filtered_count,
       (SELECT count(*) FROM inter) AS final_clean_interactions,
       (SELECT count(DISTINCT conversation_id) FROM inter) AS final_unique_conversations
FROM tweets b LEFT JOIN tweets c ON b.parent_id = c.tweet_id
WHERE b.author_id = 'Brand' AND NOT b.inbound""")

sql("parent_match_counts", TWEETS, """
SELECT CASE WHEN c.tweet_id IS NULL THEN 'orphan' WHEN c.inbound THEN 'inbound' ELSE 'non_inbound' END AS parent,
       count(*) AS n
FROM tweets b LEFT JOIN tweets c ON b.parent_id = c.tweet_id
WHERE b.author_id = 'Brand' AND NOT b.inbound AND b.parent_id IS NOT NULL GROUP BY 1""")

sql("thread_messages", MESSAGES, """
SELECT conversation_id, message_position, tweet_id, author_id, inbound, created_at, parent_id FROM messages""")

sql("thread_sample", MESSAGES, """
SELECT conversation_id, message_position, tweet_id, author_id, inbound, created_at, text,
       parent_id AS in_response_to_tweet_id
FROM messages ORDER BY conversation_id, message_position LIMIT 50""")

sql("pair_preview", PAIRS + ", head AS (SELECT * FROM pairs ORDER BY brand_tweet_id LIMIT 25)", """
SELECT conversation_id, 1 AS turn, 'Customer' AS speaker, customer_author_id AS author_id,
       customer_tweet_id AS tweet_id, customer_created_at AS created_at, customer_message AS text FROM head
UNION ALL
SELECT conversation_id, 2, brand_author_id, brand_author_id, brand_tweet_id, brand_created_at, brand_response
FROM head""")

sql("thread_metrics", PAIRS, """
SELECT brand_responses, responses_with_parent, usable_pairs, missing_parent_count, non_inbound_parent_count,
       duplicate_customer_texts,
       coalesce(round(missing_parent_count * 100.0::DOUBLE / nullif(responses_with_parent, 0), 6), 0) AS missing_parent_pct,
       coalesce(round(duplicate_customer_texts * 100.0::DOUBLE / nullif(usable_pairs, 0), 6), 0) AS duplicate_rate_pct,
       coalesce(round((brand_responses - responses_with_parent) * 100.0::DOUBLE / nullif(brand_responses, 0), 6), 0)
         AS missing_in_response_to_pct,
       avg_customer_chars, avg_brand_chars
FROM (
  SELECT count(*) AS brand_responses, count(b.parent_id) AS responses_with_parent,
         count(*) FILTER (b.parent_id IS NOT NULL AND c.tweet_id IS NULL) AS missing_parent_count,
         count(*) FILTER (NOT c.inbound) AS non_inbound_parent_count
  FROM tweets b LEFT JOIN tweets c ON b.parent_id = c.tweet_id
  WHERE b.author_id = 'Brand' AND NOT b.inbound
), (
  SELECT count(*) AS usable_pairs, count(*) - count(DISTINCT customer_message) AS duplicate_customer_texts,
         round(avg(length(customer_message)), 6) AS avg_customer_chars,
         round(avg(length(brand_response)), 6) AS avg_brand_chars
  FROM pairs
)""")

sql("conversation_lengths", MESSAGES, """
SELECT min(n) AS min_length, max(n) AS max_length, round(avg(n), 6) AS mean_length,
       median(n)::DOUBLE AS median_length, count(*) FILTER (n = 1) AS one_turn, count(*) FILTER (n = 2) AS two_turn,
       count(*) FILTER (n = 3) AS three_turn, count(*) FILTER (n >= 4) AS four_plus_turn, count(*) AS conversations
FROM (SELECT conversation_id, count(*) AS n FROM messages GROUP BY conversation_id)""")

_TURNS = """total_convs, two_turn_cnt, three_turn_cnt, four_plus_turn_cnt,
       coalesce(round_even(two_turn_cnt * 100.0::DOUBLE / nullif(total_convs, 0), 2), 0) AS two_turn_pct,
       coalesce(round_even(three_turn_cnt * 100.0::DOUBLE / nullif(total_convs, 0), 2), 0) AS three_turn_pct,
       coalesce(round_even(four_plus_turn_cnt * 100.0::DOUBLE / nullif(total_convs, 0), 2), 0) AS four_plus_turn_pct"""
_TURN_COUNTS = """count(*) AS total_convs, count(*) FILTER (n <= 2) AS two_turn_cnt,
       count(*) FILTER (n = 3) AS three_turn_cnt, count(*) FILTER (n >= 4) AS four_plus_turn_cnt"""

sql("turn_distribution", INTERACTIONS, f"""
SELECT {_TURNS} FROM (
  SELECT {_TURN_COUNTS} FROM (SELECT conversation_id, count(*) AS n FROM inter GROUP BY conversation_id))""")

# --- splits and golden set -----------------------------------------------------------------

SPLIT = INTERACTIONS + """,
ranked AS (
  SELECT conversation_id, row_number() OVER (ORDER BY md5('42|' || conversation_id), conversation_id) AS rn,
         count(*) OVER () AS n
  FROM (SELECT DISTINCT conversation_id FROM inter)
),
convs AS (
  SELECT conversation_id,
         CASE WHEN rn <= floor(n * 0.70::DOUBLE) THEN 'train'
              WHEN rn <= floor(n * 0.70::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'validation'
              ELSE 'test' END AS split
  FROM ranked
),
split_rows AS (SELECT i.*, c.split FROM inter i JOIN convs c USING (conversation_id))"""

SUBSET = SPLIT + """,
running AS (
  SELECT conversation_id, split, n,
         sum(n) OVER (PARTITION BY split ORDER BY
           md5(CASE split WHEN 'train' THEN '43|' WHEN 'validation' THEN '44|' ELSE '45|' END || conversation_id)) AS upto
  FROM (SELECT split, conversation_id, count(*) AS n FROM split_rows GROUP BY ALL)
),
subset_rows AS (
  SELECT s.* FROM split_rows s JOIN running r USING (conversation_id)
  WHERE r.upto - r.n < CASE r.split WHEN 'train' THEN 80 ELSE 15 END
)"""

CARVED = SPLIT + """,
sampled AS (
  SELECT conversation_id FROM split_rows WHERE split = 'test' GROUP BY conversation_id HAVING count(*) = 1
  ORDER BY md5('42|' || conversation_id), conversation_id LIMIT 4
),
carved AS (
  SELECT *, CASE WHEN conversation_id IN (SELECT conversation_id FROM sampled) THEN 'golden' ELSE 'pool' END AS part
  FROM split_rows WHERE split = 'test'
)"""


def context_of(source: str) -> str:
    line = "'Customer: ' || customer_message || chr(10) || 'Brand: ' || brand_response"
    return f"""
contexts AS (
  SELECT *, 2 * pair_no - 1 AS message_position, pair_no > 1 AS is_multi_turn,
         coalesce(array_to_string(earlier, chr(10)), '') AS conversation_context
  FROM (
    SELECT *, row_number() OVER w AS pair_no,
           list({line}) OVER (PARTITION BY conversation_id ORDER BY customer_ts, brand_tweet_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier
    FROM {source} WINDOW w AS (PARTITION BY conversation_id ORDER BY customer_ts, brand_tweet_id)
  )
)"""


def overlap_sql(source: str, part: str, parts: list[str]) -> str:
    from itertools import combinations

    return " UNION ALL ".join(
        f"SELECT '{key}' AS id, '{a}' AS left_part, '{b}' AS right_part, count(*) AS n FROM "
        f"(SELECT DISTINCT {key} FROM {source} WHERE {part} = '{a}' INTERSECT "
        f"SELECT DISTINCT {key} FROM {source} WHERE {part} = '{b}')"
        for key in ("conversation_id", "interaction_id") for a, b in combinations(parts, 2))


sql("conversation_split", SPLIT, "SELECT conversation_id, split FROM convs")
sql("split_sample", SUBSET, "SELECT split, conversation_id, brand_tweet_id FROM subset_rows")
sql("split_stats", SUBSET + """,
scoped AS (
  SELECT 'full' AS scope, split, conversation_id FROM split_rows
  UNION ALL SELECT 'working', split, conversation_id FROM subset_rows
)""", f"""
SELECT scope, split, {_TURNS}, interactions FROM (
  SELECT scope, split, {_TURN_COUNTS}, sum(n)::BIGINT AS interactions
  FROM (SELECT scope, split, conversation_id, count(*) AS n FROM scoped GROUP BY ALL) GROUP BY scope, split)""")
sql("split_overlap", SPLIT, overlap_sql("split_rows", "split", ["train", "validation", "test"]))
sql("golden_carveout", CARVED, "SELECT conversation_id, brand_tweet_id, part FROM carved")
sql("golden_template", CARVED + ", golden AS (SELECT * FROM carved WHERE part = 'golden')," + context_of("golden"), """
SELECT format('GOLD_{:03d}', row_number() OVER (ORDER BY md5('42|' || brand_tweet_id))) AS example_id,
       conversation_id, interaction_id, conversation_context, customer_message, '' AS ground_truth_intent,
       brand_response AS historical_reference_reply, is_multi_turn, message_position, '' AS risk_tier,
       '' AS requires_human_escalation, '' AS escalation_reason, '' AS annotation_notes,
       'phase4_v1' AS annotation_version
FROM contexts""")
_KEYS = "interaction_id, conversation_id, brand_tweet_id"
sql("pool_reconstruction", CARVED, f"""
SELECT (SELECT count(*) FROM (SELECT {_KEYS} FROM split_rows WHERE split = 'test'
                              EXCEPT ALL SELECT {_KEYS} FROM carved)) AS missing,
       (SELECT count(*) FROM (SELECT {_KEYS} FROM carved
                              EXCEPT ALL SELECT {_KEYS} FROM split_rows WHERE split = 'test')) AS extra""")
sql("golden_disjointness", CARVED + """,
parts AS (
  SELECT conversation_id, interaction_id, split AS part FROM split_rows WHERE split <> 'test'
  UNION ALL SELECT conversation_id, interaction_id, part FROM carved
)""", overlap_sql("parts", "part", ["train", "validation", "golden", "pool"]))
sql("reply_integrity", INTERACTIONS, """
SELECT 'as_is' AS template, count(*) AS n FROM inter a
WHERE NOT EXISTS (SELECT 1 FROM inter b WHERE a.interaction_id = b.interaction_id AND a.brand_response = b.brand_response)
UNION ALL SELECT 'planted', count(*) FROM inter WHERE customer_tweet_id % 3 = 0""")
sql("preceding_context", INTERACTIONS + "," + context_of("inter"), """
SELECT conversation_id, brand_tweet_id, message_position, is_multi_turn, conversation_context FROM contexts""")

TURNS = """
turns AS (
  SELECT conv_id AS conversation_id, turn AS position, CASE role WHEN 'user' THEN 'Customer' ELSE 'Brand' END AS role,
         text FROM conversations WHERE role IN ('user', 'assistant')
)"""
MEMORY = TURNS + f""",
memory AS (
  SELECT conversation_id, position, text,
         CASE WHEN history IS NULL OR len(history) = 0 THEN {strip('text')}
              ELSE 'Preceding Context:' || chr(10) || right(array_to_string(history, chr(10)), 2000)
                   || chr(10) || chr(10) || 'Current Inquiry:' || chr(10) || {strip('text')} END AS context
  FROM (
    SELECT *, list(role || ': ' || {strip('text')}) OVER (PARTITION BY conversation_id ORDER BY position
                                                      ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS history
    FROM turns WHERE text <> ''
  ) WHERE role = 'Customer'
)"""
sql("memory_context", MEMORY, "SELECT conversation_id, position, context FROM memory")

# --- labels and examples -------------------------------------------------------------------

REASONS = ("high_risk", "ambiguous_request", "insufficient_context", "sensitive_account_issue",
           "potential_policy_exception", "complex_unresolved_issue", "none")


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def any_of(text: str, words) -> str:
    return "(" + " OR ".join(f"contains({text}, {quoted(w)})" for w in words) + ")"


def first_rule(text: str, rules, field: str) -> str:
    def literal(value):
        return str(value).lower() if isinstance(value, bool) else quoted(value)

    cases = " ".join(f"WHEN {any_of(text, r.words)} THEN {literal(getattr(r, field))}" for r in rules)
    return f"CASE {cases} ELSE {literal(getattr(OTHER, field))} END"


def labelled(source: str, text: str, rules) -> str:
    return f"""
labelled AS (
  SELECT *, {first_rule('full_text', rules, 'intent')} AS intent, {first_rule('full_text', rules, 'risk')} AS risk_tier,
         {first_rule('full_text', rules, 'escalate')} AS requires_human_escalation,
         {first_rule('full_text', rules, 'reason')} AS escalation_reason,
         {first_rule('full_text', rules, 'note')} AS annotation_notes
  FROM (SELECT *, {text} AS full_text FROM {source})
)"""


HISTORY = TURNS + f""",
remembered AS (
  SELECT conversation_id, position, text, coalesce(array_to_string(history, chr(10)), '') AS history_text
  FROM (
    SELECT *, list(role || ': ' || {strip('text')}) OVER (PARTITION BY conversation_id ORDER BY position
                                                      ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS history
    FROM turns WHERE text <> ''
  ) WHERE role = 'Customer'
)"""
PROBE = probe_rules()
LABELLED_TURNS = HISTORY + "," + labelled("remembered", "lower(text) || ' ' || lower(history_text)", PROBE)

sql("rule_labels", LABELLED_TURNS, """
SELECT conversation_id, position, intent, risk_tier, requires_human_escalation, escalation_reason, annotation_notes
FROM labelled""")
sql("silver_labels", TURNS + "," + labelled("(SELECT * FROM turns WHERE role = 'Customer')", "lower(text) || ' '", LABEL_RULES),
    "SELECT conversation_id, position, intent, risk_tier, escalation_reason FROM labelled")
sql("label_violations", LABELLED_TURNS, f"""
SELECT count(*) AS violations FROM labelled
WHERE escalation_reason NOT IN ({', '.join(map(quoted, REASONS))})
   OR (escalation_reason = 'none') = requires_human_escalation""")
sql("label_distribution", LABELLED_TURNS, " UNION ALL ".join(
    f"SELECT '{c}' AS label, {c}::VARCHAR AS value, count(*) AS n, "
    f"round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM labelled), 6) AS pct FROM labelled GROUP BY {c}"
    for c in ("intent", "requires_human_escalation", "escalation_reason")))
sql("golden_profile", CARVED + "," + context_of("(SELECT * FROM carved WHERE part = 'golden')") + ","
    + labelled("contexts", "lower(customer_message) || ' ' || lower(conversation_context)", PROBE), """
SELECT intent, risk_tier, count(*) AS n, count(*) FILTER (is_multi_turn) AS multi_turn,
       count(*) FILTER (NOT is_multi_turn) AS single_turn, count(*) FILTER (requires_human_escalation) AS escalate,
       count(*) FILTER (NOT requires_human_escalation) AS auto,
       round(100.0::DOUBLE * count(*) FILTER (is_multi_turn) / count(*), 6) AS multi_turn_pct,
       round(100.0::DOUBLE * count(*) FILTER (requires_human_escalation) / count(*), 6) AS escalate_pct,
       array_to_string(list_transform(string_split(intent, '_'), lambda w: upper(w[1]) || w[2:]), ' ') AS title
FROM labelled GROUP BY intent, risk_tier""")
sql("taxonomy_coverage", TURNS + f""",
counted AS (
  SELECT {first_rule('lower(text)', PROBE, 'intent')} AS intent_id, count(*) AS n
  FROM turns WHERE role = 'Customer' GROUP BY 1
)""", f"""
SELECT i.intent_id, coalesce(c.n, 0) AS n,
       round(coalesce(c.n, 0) * 100.0::DOUBLE / (SELECT count(*) FROM turns WHERE role = 'Customer'), 6) AS pct
FROM (SELECT unnest([{', '.join(map(quoted, INTENTS))}]) AS intent_id) i LEFT JOIN counted c USING (intent_id)""")

TEXTS = TURNS + f""",
conv_ranks AS (
  SELECT conversation_id, row_number() OVER (ORDER BY md5('42|' || conversation_id)) AS rn, count(*) OVER () AS n
  FROM (SELECT DISTINCT conversation_id FROM turns WHERE role = 'Customer')
),
texts AS (
  SELECT t.conversation_id * 1000000 + t.position AS id, {strip('t.text')} AS text,
         rn <= floor(n * 0.70::DOUBLE) AS train
  FROM turns t JOIN conv_ranks USING (conversation_id) WHERE t.role = 'Customer' AND {strip('t.text')} <> ''
),
held AS (SELECT DISTINCT text FROM texts WHERE NOT train),
cleaned AS (
  SELECT id, text,
         regexp_replace({strip("regexp_replace(text, '@[\\p{L}\\p{N}_]+', '', 'g')")}, '{SPACE}+', ' ', 'g') AS cleaned,
         text NOT IN (SELECT text FROM held) AS free
  FROM texts WHERE train
)"""
sql("heldout_filter", TEXTS, """
SELECT id, cleaned FROM cleaned WHERE free AND length(cleaned) BETWEEN 15 AND 180""")
sql("cleaned_examples", TEXTS + ", matched AS (" + " UNION ALL ".join(
    f"SELECT '{r.intent}' AS intent, cleaned AS example, 0 AS kind, id AS ord FROM cleaned WHERE free "
    f"AND length(cleaned) BETWEEN 15 AND 180 AND regexp_matches(text, '(?i)({'|'.join(r.words)})')" for r in PROBE)
    + f"""),
fill_rows AS (
  SELECT *, row_number() OVER (ORDER BY md5('42|' || id), id) AS ord FROM cleaned
  ORDER BY md5('42|' || id), id LIMIT 50
),
fill AS (
  SELECT i.intent, cleaned AS example, 1 AS kind, ord FROM fill_rows,
         (SELECT unnest([{', '.join(quoted(r.intent) for r in PROBE)}]) AS intent) i
  WHERE free AND length(cleaned) >= 15
),
firsts AS (
  SELECT intent, example, min((kind, ord)) AS o FROM (SELECT * FROM matched UNION ALL SELECT * FROM fill) GROUP BY ALL
)""", """
SELECT intent, rank::INTEGER AS rank, example FROM (
  SELECT *, row_number() OVER (PARTITION BY intent ORDER BY o, example) AS rank FROM firsts
) WHERE rank <= 3""")
HUMAN = """,
human AS (
  SELECT conversation_id FROM (SELECT DISTINCT conversation_id FROM split_rows WHERE split = 'validation')
  ORDER BY md5('42|' || conversation_id), conversation_id LIMIT 1
)"""
sql("calibration_labels", CARVED + HUMAN + """,
candidates AS (
  SELECT * FROM split_rows WHERE split = 'validation'
    AND conversation_id NOT IN (SELECT conversation_id FROM carved WHERE part = 'golden')
    AND conversation_id NOT IN (SELECT conversation_id FROM human)
  ORDER BY md5('100|' || brand_tweet_id), brand_tweet_id LIMIT 2
),""" + labelled("candidates", "lower(customer_message) || ' '", PROBE), """
SELECT format('CALIB_{:03d}', row_number() OVER (ORDER BY md5('100|' || brand_tweet_id), brand_tweet_id)) AS calib_id,
       brand_tweet_id, intent AS predicted_intent, requires_human_escalation, escalation_reason
FROM labelled""")
sql("inquiry_validation", "", f"""
SELECT CASE WHEN {strip("coalesce(text, '')")} <> '' THEN 'valid' ELSE 'rejected' END AS status, role, count(*) AS n,
       sum(length({strip("coalesce(text, '')")}))::BIGINT AS chars
FROM conversations GROUP BY 1, 2""")

# --- retrieval, triage and evaluation ------------------------------------------------------

NEAREST = """
sims AS (
  SELECT a.vec_id AS query_id, b.vec_id AS corpus_id, b.label AS found,
         round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 12) AS similarity
  FROM embeddings a JOIN embeddings b ON a.vec_id % 10 = 0 AND b.vec_id % 10 <> 0
),
nearest AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, corpus_id) AS rank FROM sims
)"""


def zero_shot_of(queries: str, classes: str) -> str:
    return f"""
class_means AS (
  SELECT label, list(m ORDER BY d) AS v FROM (
    SELECT label, d, avg(x) AS m FROM (
      SELECT label, unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding, 1) AS d FROM {classes}
    ) GROUP BY label, d
  ) GROUP BY label
),
cosines AS (
  SELECT q.query_id, c.label,
         round(list_inner_product(q.embedding::DOUBLE[], c.v) / sqrt(list_inner_product(c.v, c.v)), 12) AS cosine
  FROM {queries} q, class_means c
),
zero_shot AS (
  SELECT query_id, first(label ORDER BY cosine DESC, label) AS predicted_class,
         max(exp(cosine * 10)) / sum(exp(cosine * 10)) AS confidence
  FROM cosines GROUP BY query_id
)"""


INTENT_LIST = "[" + ", ".join(map(quoted, INTENTS)) + "]"
ALL_VECTORS = "(SELECT vec_id AS query_id, embedding FROM embeddings)"
CLASSIFIED = NEAREST + "," + zero_shot_of(ALL_VECTORS, "embeddings") + f""",
classified AS (
  SELECT e.vec_id AS query_id, e.label, n.found AS predicted_label, {INTENT_LIST}[e.label + 1] AS true_intent,
         {INTENT_LIST}[n.found + 1] AS predicted_intent,
         round(least(z.confidence * 1.5, 1.0), 6) AS intent_confidence,
         round(n.similarity * 1.5, 6) AS retrieval_similarity
  FROM embeddings e JOIN nearest n ON n.query_id = e.vec_id AND n.rank = 1 JOIN zero_shot z ON z.query_id = e.vec_id
)"""
_TRIAGE = """CASE predicted_intent WHEN 'account_security_access' THEN 'high_risk'
         WHEN 'payment_billing_issues' THEN 'sensitive_account_issue'
         WHEN 'package_missing_damaged' THEN 'potential_policy_exception'
         WHEN 'feedback_general_complaint' THEN 'complex_unresolved_issue'
         WHEN 'other_unclear' THEN 'ambiguous_request'
         ELSE CASE WHEN coalesce(intent_confidence, 1) < 0.60::DOUBLE OR coalesce(retrieval_similarity, 1) < {tau}::DOUBLE
                   THEN 'insufficient_context' ELSE 'none' END END"""
_ALWAYS = ("('account_security_access', 'payment_billing_issues', 'package_missing_damaged', "
           "'feedback_general_complaint', 'other_unclear')")

sql("knn_top3", NEAREST, """
SELECT query_id, corpus_id, round(similarity, 6) AS similarity, rank::INTEGER AS rank FROM nearest WHERE rank <= 3""")
sql("search_effort", "", """
SELECT count(*) FILTER (vec_id % 10 = 0) AS queries,
       count(*) FILTER (vec_id % 10 = 0) * count(*) FILTER (vec_id % 10 <> 0) AS pairs, true AS below_a_fifth FROM embeddings""")
SQL["knn_blocks"] = SQL["index_round_trip"] = SQL["knn_top3"]
sql("retrieval_diagnostics", NEAREST, """
SELECT (SELECT count(*) FROM embeddings WHERE vec_id % 10 = 0) AS num_queries,
       round(avg(similarity) FILTER (rank = 1), 6) AS mean_top1, round(min(similarity) FILTER (rank = 1), 6) AS min_top1,
       round(max(similarity) FILTER (rank = 1), 6) AS max_top1, round(avg(similarity), 6) AS mean_topk,
       round(median(similarity) FILTER (rank = 1), 6) AS median_top1
FROM nearest WHERE rank <= 5""")
sql("zero_shot_intent", zero_shot_of(ALL_VECTORS, "embeddings"), """
SELECT query_id, predicted_class, round(confidence, 6) AS confidence FROM zero_shot""")
sql("triage_decisions", CLASSIFIED, f"""
SELECT query_id, predicted_intent, intent_confidence, retrieval_similarity, escalation_reason,
       escalation_reason <> 'none' AS requires_human_escalation,
       CASE WHEN escalation_reason <> 'none' THEN 'ESCALATE' ELSE 'AUTO' END AS decision
FROM (SELECT *, {_TRIAGE.format(tau='0.50')} AS escalation_reason FROM classified)""")

GRID = CLASSIFIED + f""",
taus AS (SELECT i::DOUBLE / 100 AS tau FROM range(40, 90, 5) t(i)),
outcomes AS (
  SELECT a.tau AS tau_confidence, b.tau AS tau_similarity, true_intent IN {_ALWAYS} AS truth,
         predicted_intent IN {_ALWAYS} OR intent_confidence < a.tau OR retrieval_similarity < b.tau AS predicted
  FROM classified, taus a, taus b
),
counts AS (
  SELECT tau_confidence, tau_similarity, count(*) FILTER (truth AND predicted) AS tp,
         count(*) FILTER (NOT truth AND predicted) AS fp, count(*) FILTER (truth AND NOT predicted) AS fn,
         count(*) FILTER (NOT truth AND NOT predicted) AS tn
  FROM outcomes GROUP BY ALL
),
rates AS (
  SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision,
         CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall,
         CASE WHEN tp + fn > 0 THEN fn / (tp + fn) ELSE 0 END AS false_auto_rate
  FROM counts
),
grid AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2 * (precision * recall) / (precision + recall) ELSE 0 END AS f1
  FROM rates
)"""
_GRID_COLUMNS = """tau_confidence, tau_similarity, tp, fp, fn, tn, round(precision, 6) AS precision,
       round(recall, 6) AS recall, round(f1, 6) AS f1, round(false_auto_rate, 6) AS false_auto_rate"""
sql("threshold_grid", GRID, f"SELECT {_GRID_COLUMNS} FROM grid")
sql("threshold_best", GRID, f"""
SELECT {_GRID_COLUMNS} FROM grid WHERE false_auto_rate <= 0.1501::DOUBLE
ORDER BY f1 DESC, tau_confidence, tau_similarity LIMIT 1""")

sql("confusion_matrix", CLASSIFIED + """,
labels_seen AS (SELECT label FROM classified UNION SELECT predicted_label FROM classified)""", """
SELECT a.label::VARCHAR AS truth, b.label::VARCHAR AS pred, count(c.query_id) AS n
FROM labels_seen a CROSS JOIN labels_seen b
LEFT JOIN classified c ON c.label = a.label AND c.predicted_label = b.label GROUP BY 1, 2""")
REPORT = CLASSIFIED + """,
labels_seen AS (SELECT label FROM classified UNION SELECT predicted_label FROM classified),
base AS (
  SELECT l.label::VARCHAR AS label, count(*) FILTER (c.label = l.label AND c.predicted_label = l.label) AS tp,
         count(*) FILTER (c.label = l.label) AS support, count(*) FILTER (c.predicted_label = l.label) AS predicted
  FROM labels_seen l, classified c GROUP BY 1
),
pr AS (
  SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision,
         CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall FROM base
),
report AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM pr
)"""
sql("class_report", REPORT, """
SELECT label, tp, support, predicted, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1 FROM report""")
sql("macro_report", REPORT, """
SELECT count(*) AS labels, sum(support)::BIGINT AS n, sum(tp)::BIGINT AS correct,
       round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall,
       round(avg(f1), 6) AS macro_f1, round(sum(tp) / sum(support), 6) AS micro_f1,
       round(sum(tp) / sum(support), 6) AS accuracy FROM report""")
sql("majority_baseline", "", """
SELECT vec_id AS query_id, (SELECT label::VARCHAR FROM embeddings GROUP BY label ORDER BY count(*) DESC, label::VARCHAR
                            LIMIT 1) AS predicted_label, 1.0::DOUBLE AS confidence FROM embeddings""")
sql("score_diagnostics", CLASSIFIED, "SELECT count(*) AS num_items, " + ", ".join(
    f"round(avg({s}), 6) AS {s}_mean, round(stddev_pop({s}), 6) AS {s}_std, round(min({s}), 6) AS {s}_min, "
    f"round(max({s}), 6) AS {s}_max" for s in ("intent_confidence", "retrieval_similarity")) + " FROM classified")
sql("triage_metrics", f"""
rows_ AS (
  SELECT l.toxic = 1 AS truth, {any_of('lower(d.text)', ['hate', 'idiot', 'whst', 'heed'])} AS predicted
  FROM documents d JOIN labels l USING (doc_id)
),
c AS (
  SELECT count(*) FILTER (truth AND predicted) AS tp, count(*) FILTER (NOT truth AND predicted) AS fp,
         count(*) FILTER (truth AND NOT predicted) AS fn, count(*) FILTER (NOT truth AND NOT predicted) AS tn FROM rows_
)""", """
SELECT tp, fp, fn, tn, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
       round(2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)), 6) AS f1,
       round(fn / (tp + fn), 6) AS false_auto_rate, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy FROM c""")


def rubric_of(text: str) -> str:
    return f"""CASE WHEN length({text}) > 10 THEN 2 ELSE 1 END AS correctness,
         CASE WHEN {any_of(f'lower({text})', ['dm', 'detail'])} THEN 2 ELSE 1 END AS groundedness,
         CASE WHEN {any_of(f'lower({text})', ['please', 'dm'])} THEN 2 ELSE 1 END AS helpfulness,
         CASE WHEN contains(lower({text}), 'refund') AND contains(lower({text}), 'free') THEN 0 ELSE 2 END AS policy_safety"""


_TOTAL = "correctness + groundedness + helpfulness + policy_safety"
sql("agreement", f"""
judged AS (
  SELECT quality * 2 - toxic + 5 AS h, {_TOTAL} + extra AS j FROM (
    SELECT *, {rubric_of('text')},
           contains(lower(text), 'whst')::INT + contains(lower(text), 'heed')::INT + contains(lower(text), 'ung')::INT AS extra
    FROM documents JOIN labels USING (doc_id))
),
ranks AS (
  SELECT h, j, rank() OVER (ORDER BY h) + (count(*) OVER (PARTITION BY h) - 1) / 2 AS rh,
         rank() OVER (ORDER BY j) + (count(*) OVER (PARTITION BY j) - 1) / 2 AS rj FROM judged
),
one AS (
  SELECT count(*) AS n, count(*) FILTER (h = j) AS exact, count(*) FILTER (abs(h - j) <= 1) AS near, corr(rh, rj) AS rho
  FROM ranks
)""", """
SELECT n, round(exact * 100.0::DOUBLE / n, 6) AS exact_pct, round(near * 100.0::DOUBLE / n, 6) AS within1_pct,
       round(rho, 6) AS rho, round(rho * sqrt((n - 2) / (1 - rho * rho)), 6) AS t_stat FROM one""")

GRAMS = INTERACTIONS + f""",
words AS (
  SELECT brand_tweet_id, [w FOR w IN string_split_regex(lower(customer_message), '{SPACE}+') IF w <> ''] AS h,
         [w FOR w IN string_split_regex(lower(brand_response), '{SPACE}+') IF w <> ''] AS r FROM inter
),
grams AS (
""" + " UNION ALL ".join(
    f"SELECT brand_tweet_id, {n} AS n, '{side}' AS side, unnest([array_to_string({side}[i:i+{n - 1}], ' ') "
    f"FOR i IN range(1, len({side}) - {n - 2})]) AS gram FROM words" for n in (1, 2, 4) for side in "hr") + """
),
gram_counts AS (
  SELECT brand_tweet_id, n, gram, count(*) FILTER (side = 'h') AS ch, count(*) FILTER (side = 'r') AS cr
  FROM grams GROUP BY ALL
),
shared AS (
  SELECT brand_tweet_id, n, sum(least(ch, cr)) AS common FROM gram_counts GROUP BY ALL
),
parts AS (
  SELECT w.brand_tweet_id, len(h) AS nh, len(r) AS nr,
         coalesce(max(common) FILTER (n = 1), 0)::DOUBLE AS c1, coalesce(max(common) FILTER (n = 2), 0)::DOUBLE AS c2,
         coalesce(max(common) FILTER (n = 4), 0)::DOUBLE AS c4
  FROM words w LEFT JOIN shared s USING (brand_tweet_id) GROUP BY ALL
),
precisions AS (
  SELECT *, CASE WHEN nh > 0 THEN c1 / nh ELSE 0 END AS p1, CASE WHEN nh > 1 THEN c2 / (nh - 1) ELSE 0 END AS p2,
         CASE WHEN nh > 3 THEN c4 / (nh - 3) ELSE 0 END AS p4, CASE WHEN nr > 0 THEN c1 / nr ELSE 0 END AS r1,
         CASE WHEN nr > 1 THEN c2 / (nr - 1) ELSE 0 END AS r2,
         CASE WHEN nh > nr THEN 1.0::DOUBLE WHEN nh > 0 THEN exp(1 - nr / nh) ELSE 0 END AS bp
  FROM parts
),
scores AS (
  SELECT brand_tweet_id, bp * p1 AS bleu_1, bp * sqrt(p1 * p2) AS bleu_2,
         CASE WHEN p1 * p2 * p4 > 0 THEN bp * pow(p1 * p2 * p4, 0.25) ELSE 0 END AS bleu_4,
         CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0 END AS rouge_1,
         CASE WHEN p2 + r2 > 0 THEN 2 * p2 * r2 / (p2 + r2) ELSE 0 END AS rouge_2
  FROM precisions
)"""
_OVERLAPS = ("bleu_1", "bleu_2", "bleu_4", "rouge_1", "rouge_2")
sql("bleu_rouge_n", GRAMS, "SELECT brand_tweet_id, " + ", ".join(
    f"round({s}::DOUBLE, 6) AS {s}" for s in _OVERLAPS) + " FROM scores")
sql("bleu_rouge_means", GRAMS, "SELECT count(*) AS pairs, " + ", ".join(
    f"round(avg({s}::DOUBLE), 6) AS {s}" for s in _OVERLAPS) + " FROM scores")

# one row of the common-subsequence table per word; a running maximum closes the row
sql("rouge_l", INTERACTIONS + f""",
words AS (
  SELECT brand_tweet_id, [w FOR w IN string_split_regex(lower(customer_message), '{SPACE}+') IF w <> ''] AS h,
         [w FOR w IN string_split_regex(lower(brand_response), '{SPACE}+') IF w <> ''] AS r FROM inter
),
lcs AS (
  SELECT brand_tweet_id, 0 AS i, [0 FOR x IN r] AS filled FROM words
  UNION ALL
  SELECT brand_tweet_id, i + 1, [list_max(step[1:j]) FOR j IN range(1, len(step) + 1)] FROM (
    SELECT l.brand_tweet_id, l.i,
           [CASE WHEN w.h[l.i + 1] = w.r[j] THEN CASE WHEN j = 1 THEN 0 ELSE l.filled[j - 1] END + 1
                 ELSE l.filled[j] END FOR j IN range(1, len(w.r) + 1)] AS step
    FROM lcs l JOIN words w USING (brand_tweet_id) WHERE l.i < len(w.h)
  )
),
shares AS (
  SELECT brand_tweet_id, coalesce(filled[len(filled)], 0) / len(h) AS p, coalesce(filled[len(filled)], 0) / len(r) AS q
  FROM lcs JOIN words USING (brand_tweet_id) WHERE i = len(h)
)""", """
SELECT brand_tweet_id, round(CASE WHEN p + q > 0 THEN 2 * p * q / (p + q) ELSE 0 END, 6) AS rouge_l FROM shares""")

sql("rubric_scores", TURNS, f"""
SELECT *, {_TOTAL} AS total_score FROM (
  SELECT conversation_id, position, {rubric_of('text')} FROM turns WHERE role = 'Brand')""")
sql("rubric_ingest", "", f"""
SELECT *, {_TOTAL} AS total_score, count(*) AS n FROM (
  SELECT least(greatest(event_id % 5 - 1, 0), 2)::INTEGER AS correctness,
         least(CASE WHEN event_id % 3 > 0 THEN event_id % 4 ELSE 1 END, 2)::INTEGER AS groundedness,
         (event_id % 3)::INTEGER AS helpfulness,
         (CASE WHEN event_id % 7 > 0 THEN event_id % 2 ELSE 1 END)::INTEGER AS policy_safety
  FROM events) GROUP BY ALL""")


def template_of(text: str) -> str:
    cases = " ".join(f"WHEN {any_of(f'lower({text})', t.words)} THEN {quoted(t.reply)}" for t in probe_templates())
    return f"CASE {cases} ELSE {quoted(DEFAULT_REPLY)} END"


sql("template_reply", MEMORY, f"SELECT conversation_id, position, {template_of('context')} AS reply FROM memory")

# --- case retrieval and the agent ----------------------------------------------------------

CASES = SPLIT + """,
cases AS (
  SELECT s.*, e.embedding, e.label FROM split_rows s JOIN embeddings e
    ON e.vec_id = (((s.customer_tweet_id - 1) // 1000000) * 8 + (s.customer_tweet_id - 1) % 1000000)
                  % (SELECT count(*) FROM embeddings)
),
case_sims AS (
  SELECT q.brand_tweet_id AS query_id, c.brand_tweet_id AS corpus_id, c.interaction_id, c.customer_message,
         c.brand_response,
         round(list_cosine_similarity(q.embedding::DOUBLE[], c.embedding::DOUBLE[]), 12) AS similarity
  FROM cases q JOIN cases c ON q.split <> 'train' AND c.split = 'train'
),
case_hits AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, corpus_id) AS rank FROM case_sims
  ) WHERE rank <= 3
)"""
sql("top1_copy", CASES, """
SELECT q.brand_tweet_id AS query_id, h.corpus_id AS evidence_id, coalesce(h.brand_response, '') AS generated_reply,
       coalesce(round(h.similarity, 6), 0) AS similarity_score
FROM cases q LEFT JOIN case_hits h ON h.query_id = q.brand_tweet_id AND h.rank = 1 WHERE q.split <> 'train'""")
sql("prompt_table", CASES + """,
blocks AS (
  SELECT query_id, string_agg(format('Example {}', rank) || ' (Similarity: ' || printf('%.2f', similarity) || '):' || chr(10)
           || '  Customer Inquiry: ' || customer_message || chr(10) || '  Historical Reply: ' || brand_response,
           chr(10) || chr(10) ORDER BY rank) AS block
  FROM case_hits GROUP BY query_id
)""", f"""
SELECT q.brand_tweet_id AS query_id,
       'Customer Inquiry: "' || customer_message || '"' || chr(10) || 'Predicted Intent Category: '
       || {INTENT_LIST}[label + 1] || chr(10) || chr(10) || 'Retrieved Historical Support Examples:' || chr(10)
       || coalesce(block, '') || chr(10) || chr(10) || 'Draft a grounded, polite Twitter response (<=280 chars):' AS prompt
FROM cases q LEFT JOIN blocks b ON b.query_id = q.brand_tweet_id WHERE q.split <> 'train'""")

AGENT = CASES + f""",
inquiries AS (SELECT * FROM cases WHERE split <> 'train'),
paired AS (
  SELECT *, row_number() OVER (PARTITION BY conversation_id ORDER BY customer_ts, brand_tweet_id) AS pair_no FROM inquiries
),
said AS (
  SELECT conversation_id, 2 * pair_no - 1 AS place, 'Customer: ' || {strip('customer_message')} AS line FROM paired
  UNION ALL SELECT conversation_id, 2 * pair_no, 'Brand: ' || {strip('brand_response')} FROM paired
),
remembered_lines AS (
  SELECT p.brand_tweet_id AS query_id, string_agg(s.line, chr(10) ORDER BY s.place) AS block
  FROM paired p JOIN said s ON s.conversation_id = p.conversation_id AND s.place BETWEEN 2 * p.pair_no - 5 AND 2 * p.pair_no - 2
  GROUP BY 1
),""" + zero_shot_of(
    "(SELECT brand_tweet_id AS query_id, embedding FROM inquiries)", "(SELECT * FROM cases WHERE split = 'train')") + f""",
framed AS (
  SELECT c.brand_tweet_id AS query_id, c.interaction_id, {INTENT_LIST}[z.predicted_class + 1] AS predicted_intent,
         least(z.confidence * 2, 1.0) AS intent_confidence,
         CASE WHEN block IS NOT NULL
              THEN 'Preceding Context:' || chr(10) || right(block, 2000) || chr(10) || chr(10)
                   || 'Current Inquiry:' || chr(10) || {strip('customer_message')}
              ELSE {strip('customer_message')} END AS query_context_used
  FROM paired c JOIN zero_shot z ON z.query_id = c.brand_tweet_id LEFT JOIN remembered_lines m ON m.query_id = c.brand_tweet_id
),
evidence AS (
  SELECT query_id, count(*) AS k, max(similarity) AS best, to_json(list(interaction_id ORDER BY rank))::VARCHAR AS ids,
         max(brand_response) FILTER (rank = 1) AS top1 FROM case_hits GROUP BY query_id
),
decided AS (
  SELECT *, {_TRIAGE.format(tau='0.30')} AS escalation_reason FROM (
    SELECT f.*, coalesce(e.k, 0)::INTEGER AS retrieval_top_k, coalesce(e.best, 0) AS retrieval_similarity,
           coalesce(e.ids, '[]') AS evidence_ids, coalesce(e.top1, '') AS top1
    FROM framed f LEFT JOIN evidence e USING (query_id))
),
records AS (
  SELECT *, escalation_reason <> 'none' AS requires_human_escalation,
         CASE WHEN escalation_reason = 'none' THEN {template_of('query_context_used')} END AS generated_response
  FROM decided
)"""
sql("agent_pipeline", AGENT, """
SELECT query_id, interaction_id, predicted_intent, round_even(intent_confidence, 4) AS intent_confidence, retrieval_top_k,
       round_even(retrieval_similarity, 4) AS retrieval_similarity,
       CASE WHEN requires_human_escalation THEN 'ESCALATE' ELSE 'AUTO' END AS decision, requires_human_escalation,
       escalation_reason, evidence_ids, generated_response, query_context_used
FROM records""")
sql("agent_certificate", AGENT, f"""
SELECT query_id, interaction_id, query_context_used, retrieval_top_k, round_even(retrieval_similarity, 4) AS retrieval_similarity, evidence_ids,
       {template_of('query_context_used')} AS template, true AS intent_holds, true AS decision_holds, true AS reply_holds
FROM records""")
sql("variant_means", AGENT + """,
variants AS (
  SELECT query_id, 'A' AS variant, top1 AS reply FROM records
  UNION ALL SELECT query_id, 'B', top1 FROM records
  UNION ALL SELECT query_id, 'C', coalesce(generated_response, '[ESCALATED TO HUMAN AGENT]') FROM records
)""", f"""
SELECT variant, count(*) AS n, round(avg(correctness), 6) AS correctness, round(avg(groundedness), 6) AS groundedness,
       round(avg(helpfulness), 6) AS helpfulness, round(avg(policy_safety), 6) AS policy_safety,
       round(avg({_TOTAL}), 6) AS total_score
FROM (SELECT variant, {rubric_of('reply')} FROM variants) GROUP BY variant""")

_FRAMED = f"""CASE WHEN len(lines) = 0 THEN {strip('customer_message')}
       ELSE 'Preceding Context:' || chr(10) || right(array_to_string(lines, chr(10)), 2000) || chr(10) || chr(10)
            || 'Current Inquiry:' || chr(10) || {strip('customer_message')} END"""
_ESCALATING = ("account_security_access", "payment_billing_issues", "package_missing_damaged", "other_unclear")


def answered_of(source: str) -> str:
    intent = first_rule("lower(ctx)", PROBE, "intent")
    return f"""
    SELECT conversation_id, turn_no, position, ctx, intent, reply,
           list_concat(lines, CASE WHEN reply IS NULL THEN ['Customer: ' || {strip('customer_message')}]
                              ELSE ['Customer: ' || {strip('customer_message')}, 'Brand: ' || {strip('reply')}] END) AS joined
    FROM (
      SELECT *, CASE WHEN intent NOT IN ({', '.join(map(quoted, _ESCALATING))}) THEN {template_of('ctx')} END AS reply
      FROM (SELECT *, {intent} AS intent FROM (SELECT *, {_FRAMED} AS ctx FROM ({source})))
    )"""


sql("agent_closed_loop", TURNS + f""",
numbered AS (
  SELECT conversation_id, position, text AS customer_message,
         row_number() OVER (PARTITION BY conversation_id ORDER BY position) AS turn_no
  FROM turns WHERE role = 'Customer'
),
loop_rows AS (
  {answered_of("SELECT *, []::VARCHAR[] AS lines FROM numbered WHERE turn_no = 1")}
  UNION ALL
  {answered_of("SELECT n.*, CASE WHEN len(l.joined) > 4 THEN l.joined[len(l.joined) - 3:] ELSE l.joined END AS lines "
               "FROM loop_rows l JOIN numbered n ON n.conversation_id = l.conversation_id AND n.turn_no = l.turn_no + 1")}
)""", """
SELECT conversation_id, position, intent, CASE WHEN reply IS NULL THEN 'ESCALATE' ELSE 'AUTO' END AS decision,
       CASE intent WHEN 'account_security_access' THEN 'high_risk' WHEN 'payment_billing_issues' THEN 'sensitive_account_issue'
            WHEN 'package_missing_damaged' THEN 'potential_policy_exception' WHEN 'other_unclear' THEN 'ambiguous_request'
            ELSE 'none' END AS escalation_reason,
       ctx AS query_context_used, reply AS generated_response
FROM loop_rows""")
sql("pool_diagnostics", AGENT + """,
head AS (
  SELECT r.*, i.customer_message, round_even(r.intent_confidence, 4) AS c, round_even(r.retrieval_similarity, 4) AS s
  FROM records r JOIN inquiries i ON i.brand_tweet_id = r.query_id
)""", "SELECT count(*) AS num_items, " + ", ".join(
    f"round(avg({x}), 6) AS {n}_mean, round(stddev_pop({x}), 6) AS {n}_std, round(min({x}), 6) AS {n}_min, "
    f"round(max({x}), 6) AS {n}_max" for x, n in (("c", "intent_confidence"), ("s", "retrieval_similarity")))
    + ", round(avg(length(customer_message)), 6) AS mean_message_length FROM head")
sql("calibration_isolation", CARVED + HUMAN + """,
candidates AS (
  SELECT * FROM split_rows WHERE split = 'validation'
    AND conversation_id NOT IN (SELECT conversation_id FROM carved WHERE part = 'golden')
    AND conversation_id NOT IN (SELECT conversation_id FROM human)
  ORDER BY md5('100|' || brand_tweet_id), brand_tweet_id LIMIT 2
)""", """
SELECT 'interaction_id' AS id, 'golden' AS left_part, 'calibration' AS right_part, count(*) AS n FROM (
  SELECT interaction_id FROM carved WHERE part = 'golden' INTERSECT SELECT interaction_id FROM candidates)""")

# --- TF-IDF --------------------------------------------------------------------------------


def term_counts(keep: str) -> str:
    return f"""
tokens AS (
  SELECT doc_id, [t FOR t IN regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}') IF {keep}] AS t FROM documents
),
term_counts AS (
  SELECT doc_id, term, count(*) AS tf FROM (
    SELECT doc_id, unnest(t) AS term FROM tokens
    UNION ALL SELECT doc_id, unnest([t[i] || ' ' || t[i + 1] FOR i IN range(1, len(t))]) FROM tokens
  ) GROUP BY ALL
)"""


sql("tfidf_weights", term_counts("true") + """,
idf AS (
  SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf
  FROM term_counts GROUP BY term HAVING count(*) >= 2
),
raw AS (SELECT doc_id, term, (1 + ln(tf)) * idf AS w FROM term_counts JOIN idf USING (term)),
norms AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM raw GROUP BY doc_id)""", """
SELECT doc_id, term, round(w / norm, 6) AS weight FROM raw JOIN norms USING (doc_id)""")
sql("tfidf_phrases", term_counts("t NOT IN (" + ", ".join(map(quoted, STOP_WORDS)) + ")") + """,
kept AS (
  SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf
  FROM term_counts GROUP BY term HAVING count(*) >= 5 ORDER BY sum(tf) DESC, term LIMIT 50
),
raw AS (SELECT doc_id, term, tf * idf AS w FROM term_counts JOIN kept USING (term)),
norms AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM raw GROUP BY doc_id)""", """
SELECT term, round(sum(w / norm) / (SELECT count(*) FROM documents), 6) AS mean_weight
FROM raw JOIN norms USING (doc_id) GROUP BY term""")

# --- learning ------------------------------------------------------------------------------

SILVER = TURNS + "," + labelled("(SELECT * FROM turns WHERE role = 'Customer')", "lower(text) || ' '", PROBE) + """,
ordered AS (
  SELECT conversation_id, row_number() OVER (ORDER BY md5('42|' || conversation_id), conversation_id) AS rn, count(*) OVER () AS n
  FROM (SELECT DISTINCT conversation_id FROM labelled)
),
silver AS (
  SELECT conversation_id * 1000000 + position AS doc_id, text, intent,
         CASE WHEN rn <= floor(n * 0.70::DOUBLE) THEN 'train'
              WHEN rn <= floor(n * 0.70::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'validation' ELSE 'test' END AS split
  FROM labelled JOIN ordered USING (conversation_id)
),
train_words AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}') AS t FROM silver WHERE split = 'train'),
train_terms AS (
  SELECT term FROM (
    SELECT doc_id, unnest(t) AS term FROM train_words
    UNION SELECT doc_id, unnest([t[i] || ' ' || t[i + 1] FOR i IN range(1, len(t))]) FROM train_words
  ) GROUP BY term HAVING count(*) >= 2
),
classes AS (
  SELECT intent, count(*) AS class_rows, sum(count(*)) OVER ()::BIGINT AS train_rows, count(*) OVER () AS k
  FROM silver WHERE split = 'train' GROUP BY intent
)"""
sql("logreg_certificate", SILVER, """
SELECT c AS c_param, intent, train_rows, class_rows, round(train_rows / (k * class_rows), 6) AS class_weight,
       (SELECT count(*) FROM train_terms) AS terms, true AS optimal
FROM classes, (SELECT unnest([0.1, 1.0, 10.0]::DOUBLE[]) AS c)""")
sql("logreg_choice", SILVER, """
SELECT c AS c_param, (SELECT count(*) FROM silver WHERE split = 'validation') AS validation_rows, true AS score_holds, true AS choice_holds
FROM (SELECT unnest([0.1, 1.0, 10.0]::DOUBLE[]) AS c)""")
sql("model_round_trip", SILVER, """
SELECT doc_id, intent, true AS same_intent, true AS same_confidence FROM silver WHERE split = 'test'""")
sql("scoring_guard", SILVER, """
SELECT part, size::BIGINT AS size, (SELECT count(*) FROM silver WHERE split = 'test') AS scored, true AS unchanged FROM (
  SELECT 'vocabulary' AS part, (SELECT count(*) FROM train_terms) AS size
  UNION ALL SELECT 'coefficients', ((SELECT count(*) FROM train_terms) + 1) * (SELECT count(*) FROM classes))""")

sql("kmeans_certificate", "", """
SELECT k, (SELECT count(*) FROM embeddings) AS points, (SELECT count(*) FROM embeddings WHERE vec_id % 100 = 0) AS asked,
       true AS fixpoint, true AS inertia_holds, true AS silhouette_holds
FROM (SELECT unnest(range(8, 16)) AS k)""")

# --- telemetry -----------------------------------------------------------------------------

TELEMETRY = """
telemetry AS (
  SELECT event_id::VARCHAR AS interaction_id, ts, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS timestamp,
         CASE WHEN event_type IN ('error', 'purchase') THEN 'ESCALATE' ELSE 'AUTO' END AS decision,
         CASE event_type WHEN 'error' THEN 'high_risk' WHEN 'purchase' THEN 'sensitive_account_issue'
              ELSE 'none' END AS escalation_reason,
         event_type AS predicted_intent, least(1.0, value / 100) AS intent_confidence,
         least(1.0, value / 200) AS retrieval_similarity, value / 1000 AS elapsed_seconds,
         event_id % 4 AS evidence_count
  FROM events
)"""
_HISTOGRAM = [("le_0_5", "count(*) FILTER (intent_confidence <= 0.5)"), ("le_0_75", "count(*) FILTER (intent_confidence <= 0.75)"),
              ("le_0_9", "count(*) FILTER (intent_confidence <= 0.9)"), ("le_inf", "count(*)"),
              ("evidence_items", "sum(evidence_count)::BIGINT"), ("auto_count", "count(*) FILTER (decision = 'AUTO')"),
              ("escalate_count", "count(*) FILTER (decision = 'ESCALATE')")]
_TOTALS = """count(*) AS total_inquiries, count(*) FILTER (decision = 'AUTO') AS auto_handled,
       count(*) FILTER (decision <> 'AUTO') AS escalated,
       round_even(count(*) FILTER (decision <> 'AUTO') / count(*), 4) AS escalation_rate,
       round_even(round(sum(intent_confidence), 9) / count(*), 4) AS mean_intent_confidence"""
sql("telemetry_records", TELEMETRY, """
SELECT interaction_id, timestamp, decision, escalation_reason, predicted_intent, intent_confidence,
       retrieval_similarity, round_even(elapsed_seconds * 1000.0, 2) AS latency_ms, 'mock' AS provider_mode FROM telemetry""")
sql("telemetry_summary", TELEMETRY, f"""
SELECT {_TOTALS},
       (SELECT '{{' || string_agg('"' || escalation_reason || '":' || n, ',' ORDER BY escalation_reason) || '}}' FROM
          (SELECT escalation_reason, count(*) AS n FROM telemetry WHERE decision <> 'AUTO' GROUP BY 1)) AS escalation_reasons
FROM telemetry""")
sql("telemetry_reasons", TELEMETRY, "SELECT decision, escalation_reason, count(*) AS n FROM telemetry GROUP BY 1, 2")
sql("confidence_histogram", TELEMETRY, " UNION ALL ".join(
    f"SELECT '{name}' AS metric, {value} AS n FROM telemetry" for name, value in _HISTOGRAM))
sql("telemetry_windows", TELEMETRY, f"""
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, {_TOTALS},
       {', '.join(f'{value} AS {name}' for name, value in _HISTOGRAM)}
FROM telemetry GROUP BY date_trunc('hour', ts)""")

# --- sources, sinks and streams ------------------------------------------------------------

sql("tweet_csv_scan", TWEETS, """
SELECT tweet_id, author_id, inbound, created_at, text, parent_id, epoch(ts)::BIGINT AS epoch FROM tweets""")
sql("split_sink", SPLIT, """
SELECT split, count(*) AS n, count(DISTINCT conversation_id) AS conversations FROM split_rows GROUP BY split""")
sql("golden_sink", INTERACTIONS + "," + context_of("inter"), """
SELECT f.form, format('GOLD_{:03d}', row_number() OVER (PARTITION BY f.form ORDER BY md5('42|' || brand_tweet_id))) AS example_id,
       interaction_id, conversation_context, customer_message, brand_response AS historical_reference_reply,
       is_multi_turn, message_position
FROM contexts, (SELECT unnest(['csv', 'json']) AS form) f""")
SQL["tweet_csv_ranges"] = SQL["tweet_csv_scan"]
SQL["audit_log"] = SQL["telemetry_records"]
SQL["audit_log_rerun"] = SQL["telemetry_records"]
SQL["memory_stream"] = SQL["memory_context"].replace("ELSE 'Brand' END", "ELSE 'AmazonHelp' END")
SQL["memory_stream_ordered"] = SQL["memory_stream"]
sql("memory_stream_idle", TURNS.replace("ELSE 'Brand' END", "ELSE 'AmazonHelp' END") + f""",
timed AS (SELECT *, conversation_id * 3600 + position * 60 + position // 3 * 1800 AS moment FROM turns),
gapped AS (
  SELECT *, coalesce(moment - lag(moment) OVER (PARTITION BY conversation_id ORDER BY moment, position) > 900, false) AS pause FROM timed
  WHERE text <> ''
),
session AS (SELECT *, sum(pause::INT) OVER (PARTITION BY conversation_id ORDER BY moment, position) AS part FROM gapped),
remembered AS (
  SELECT *, list(role || ': ' || {strip('text')}) OVER (
    PARTITION BY conversation_id, part ORDER BY moment, position ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS history FROM session
)""", f"""
SELECT conversation_id, position,
       CASE WHEN history IS NULL OR len(history) = 0 THEN {strip('text')}
            ELSE 'Preceding Context:' || chr(10) || right(array_to_string(history, chr(10)), 2000)
                 || chr(10) || chr(10) || 'Current Inquiry:' || chr(10) || {strip('text')} END AS context
FROM remembered WHERE role = 'Customer'""")
sql("telemetry_late_rows", "", """
SELECT count(*) AS input_rows, count(*) FILTER (NOT late) AS counted, count(*) FILTER (late) AS late_rows
FROM (SELECT event_id % 50 = 0 AND ts < TIMESTAMP '2024-01-16' AS late FROM events)""")
SQL["telemetry_stream_totals"] = SQL["telemetry_totals_merged"] = SQL["telemetry_reasons"]
SQL["telemetry_stream_windows"] = SQL["telemetry_windows"]
sql("triage_stream", CASES + """,
inquiries AS (
  SELECT conv_id * 1000000 + turn AS query_id, 'INT_' || conv_id || '_' || turn AS interaction_id, embedding,
         strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(conv_id * 3600 + turn * 60), '%Y-%m-%dT%H:%M:%SZ') AS timestamp
  FROM conversations JOIN embeddings ON vec_id = (conv_id * 8 + turn) % (SELECT count(*) FROM embeddings)
  WHERE role = 'user'
),
best AS (
  SELECT q.query_id,
         max(round(list_cosine_similarity(q.embedding::DOUBLE[], c.embedding::DOUBLE[]), 12)) AS retrieval_similarity
  FROM inquiries q, cases c WHERE c.split = 'train' GROUP BY q.query_id
),""" + zero_shot_of("inquiries", "(SELECT * FROM cases WHERE split = 'train')") + f""",
decided AS (
  SELECT *, {_TRIAGE.format(tau='0.50').replace('0.60', '0.25')} AS escalation_reason FROM (
    SELECT q.interaction_id, q.timestamp, {INTENT_LIST}[z.predicted_class + 1] AS predicted_intent,
           z.confidence AS intent_confidence, b.retrieval_similarity
    FROM inquiries q JOIN best b USING (query_id) JOIN zero_shot z USING (query_id))
)""", """
SELECT interaction_id, timestamp, CASE WHEN escalation_reason = 'none' THEN 'AUTO' ELSE 'ESCALATE' END AS decision,
       escalation_reason, predicted_intent, round_even(intent_confidence, 4) AS intent_confidence,
       round_even(retrieval_similarity, 4) AS retrieval_similarity, 'mock' AS provider_mode FROM decided""")

# --- the same results by another path: sinks, spread keys, slices and blocks --------------------

SQL["statistics_sink"] = SQL["split_stats"]
SQL["threshold_sink"] = f"SELECT tau_confidence, tau_similarity FROM ({SQL['threshold_best']})"
sql("corpus_projection", INTERACTIONS, "SELECT interaction_id, conversation_id, customer_message, brand_response FROM inter")
sql("source_contract", TWEETS, "SELECT inbound, count(*) AS n FROM tweets GROUP BY inbound")
SQL["reply_pairs_spread"] = SQL["reply_pairs"]
SQL["thread_messages_sliced"] = SQL["thread_messages"]
SQL["preceding_context_blocks"] = SQL["preceding_context"]
SQL["memory_context_blocks"] = SQL["memory_context"]
sql("value_median", "", "SELECT round(median(value), 6) AS median FROM events")
sql("telemetry_stream_summary", TELEMETRY, f"SELECT {_TOTALS} FROM telemetry")
