"""DuckDB SQL for the queries that SQL can express."""

SQL: dict[str, str] = {}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _components(links: str) -> str:
    """CTEs ``hop`` and ``component`` (id, component) over a CTE of links (a, b) in both directions."""
    return f"""
hop(id, seen) AS (
  SELECT a, a FROM {links} UNION SELECT l.b, h.seen FROM hop h JOIN {links} l ON l.a = h.id),
component AS (SELECT id, min(seen) AS component FROM hop GROUP BY id)"""


def jaccard_ctes(docs: str, k: int, percent: int) -> str:
    """CTEs up to ``component`` for the n-gram Jaccard join over a table or CTE of documents."""
    return f"""
words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM {docs}),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + {k - 1}], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {k - 2}, 2))) AS i FROM words WHERE len(w) > 0)),
sized AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
both_ways AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM both_ways JOIN sized p ON p.doc_id = a JOIN sized q ON q.doc_id = b
  WHERE 100 * shared >= {percent} * (p.n + q.n - shared)),
{_components('link')}"""


SQL["op6_ngram_jaccard_join"] = f"""
WITH RECURSIVE {jaccard_ctes('documents', 3, 90)}
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, d.doc_id) AS component_id
FROM documents d LEFT JOIN sized USING (doc_id) LEFT JOIN component c ON c.id = d.doc_id
"""

SQL["op10_vector_near_dedup"] = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.93),
{_components('link')}
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component, vec_id) AS component_id,
       coalesce(component, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN (SELECT a, count(*) AS n FROM link GROUP BY a) ON a = vec_id LEFT JOIN component ON id = vec_id
"""


def _rule_rows(rank: int, rule) -> str:
    """Surviving matches of one rule: places follow from the pieces between the matches."""
    pattern = rule.pattern.replace("'", "''")
    return f"""
  SELECT doc_id, '{rule.kind}' AS kind, {rank} AS rank, unnest(range(1, len(m) + 1)) AS i, m, c, p, {rule.min_length} AS least
  FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}', 0) AS m, regexp_extract_all(t, '{pattern}', {rule.group}) AS c,
               regexp_split_to_array(t, '{pattern}') AS p FROM docs) WHERE len(m) > 0"""


def _secrets() -> str:
    from threadloom.llm.secrets import BASE, RULES

    found = "\n  UNION ALL".join(_rule_rows(i, r) for i, r in enumerate(RULES))
    counts = ", ".join(f"count(kind) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE)
    base = ", ".join(f"'{r.kind}'" for r in BASE)
    joined = "coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) {}, '')"
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({found}),
span AS (
  SELECT doc_id, kind, rank, list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS s, length(m[i]) AS n
  FROM found WHERE length(c[i]) >= least),
placed AS (SELECT doc_id, kind, rank, s::BIGINT AS s, (s + n)::BIGINT AS e FROM span)
SELECT d.doc_id, {counts}, sha256({joined.format(f"FILTER (kind IN ({base}))")}) AS base_sha256, {joined.format("")} AS spans
FROM docs d LEFT JOIN placed USING (doc_id) GROUP BY d.doc_id
"""


SQL["op3_secret_scan"] = _secrets()


def _overlaps() -> str:
    from threadloom.llm.decontamination import MASKS, MIN_RUN, MIN_SCORE, MISMATCH

    span = min(m[-1] for m in MASKS) + 1
    words = "list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
    places = lambda t: "\n  UNION ALL ".join(
        f"SELECT id, {i} AS mask, i - 1 AS place, [{', '.join(f'w[i + {j}]' for j in m)}] AS seed FROM (SELECT id, w, unnest(range(1, len(w) - {m[-1]} + 1)) AS i FROM {t})"
        for i, m in enumerate(MASKS))
    return f"""
WITH dw AS (SELECT doc_id AS id, {words} AS w FROM documents),
iw AS (
  SELECT row_number() OVER () AS id, item_id AS name, w
  FROM (SELECT DISTINCT item_id, {words} AS w FROM benchmark) WHERE len(w) > 0),
ds AS ({places('dw')}),
items AS ({places(f'(SELECT * FROM iw WHERE len(w) >= {span})')}),
hit AS (SELECT DISTINCT ds.id AS doc_id, items.id AS item_id, ds.place - items.place AS diagonal FROM ds JOIN items USING (mask, seed)),
line AS (
  SELECT doc_id, item_id, diagonal, i, coalesce(CASE WHEN diagonal + i >= 1 THEN dw.w[diagonal + i] END = iw.w[i], false) AS same
  FROM (SELECT hit.*, unnest(range(1, len(w) + 1)) AS i FROM hit JOIN iw ON iw.id = item_id) h
  JOIN dw ON dw.id = doc_id JOIN iw ON iw.id = item_id),
summed AS (
  SELECT *, sum(CASE WHEN same THEN 1 ELSE {MISMATCH} END) OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY i) AS total FROM line),
low AS (
  SELECT *, coalesce(min(total) OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS least
  FROM summed),
scored AS (
  SELECT doc_id, item_id, diagonal, max(total - least(least, 0)) AS score, count(*) FILTER (same) AS matched, count(*) AS words
  FROM low GROUP BY 1, 2, 3),
-- items without seeds: word for word, or the whole text
short AS (
  SELECT dw.id AS doc_id, iw.id AS item_id, i - 1 AS diagonal, len(iw.w) AS score, len(iw.w) AS matched
  FROM (SELECT id, w, unnest(range(1, len(w) + 1)) AS i FROM dw) dw
  JOIN iw ON len(iw.w) < {span} AND dw.w[i:i + len(iw.w) - 1] = iw.w AND (len(iw.w) >= {MIN_RUN} OR len(dw.w) = len(iw.w))),
counted AS (
  SELECT doc_id, item_id, diagonal, score, matched FROM scored
  WHERE score >= {MIN_SCORE} OR 4 * score >= 3 * words OR 10 * matched >= 7 * words
  UNION ALL SELECT * FROM short)
SELECT doc_id, name AS item_id, diagonal AS doc_place, matched, score::BIGINT AS score FROM counted JOIN iw ON iw.id = item_id
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY score DESC, diagonal, matched DESC) = 1
"""


SQL["op5_decontaminate"] = _overlaps()


def _licenses() -> str:
    from threadloom.llm.licenses import COVERAGE, K, NEAR, PHRASES, TEMPLATES

    phrases = ", ".join(f"('{p}', {len(p.split())}, '{label}')" for p, label in PHRASES.items())
    numbered = [(label, text.split()) for label, texts in TEMPLATES.items() for text in texts]
    rows = ", ".join(f"('{label}', {n}, {i}, '{' '.join(w[i:i + K])}', {len(w) - K + 1})" for n, (label, w) in enumerate(numbered) for i in range(len(w) - K + 1))
    return f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
phrase(gram, k, label) AS (VALUES {phrases}),
template(label, template, place, gram, places) AS (VALUES {rows}),
gram AS (
  SELECT doc_id, i - 1 AS place, k, array_to_string(w[i:i + k - 1], ' ') AS gram
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (VALUES (2), (3)) sizes(k))),
base AS (
  SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS labels
  FROM gram JOIN phrase USING (gram, k) GROUP BY doc_id),
vote AS (
  SELECT doc_id, t.label, t.template, t.place AS tplace, t.places, g.place, g.place - t.place AS diagonal
  FROM gram g JOIN template t ON g.gram = t.gram AND g.k = {K}),
step AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal, place) <= {NEAR} THEN 0 ELSE 1 END AS fresh FROM vote),
merged AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, template ORDER BY diagonal, place ROWS UNBOUNDED PRECEDING) AS span FROM step),
span AS (
  SELECT doc_id, label, count(DISTINCT tplace) / places AS coverage FROM merged GROUP BY doc_id, label, template, places, span
  HAVING count(DISTINCT tplace) / places >= {COVERAGE}),
own AS (SELECT doc_id, list(DISTINCT label) AS labels, max(coverage) AS score FROM span GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(own.labels, [])))), ',') AS labels,
       greatest(CASE WHEN n_base > 0 THEN 1.0 ELSE 0.0 END::DOUBLE, coalesce(score, 0.0)) AS score
FROM words d LEFT JOIN base USING (doc_id) LEFT JOIN own USING (doc_id)
"""


SQL["op9_license_scan"] = _licenses()


def _chat() -> str:
    from threadloom.llm.chat import INSTRUCT

    control = "|".join(c.replace("[", "\\[").replace("]", "\\]") for c in sorted(INSTRUCT.control, key=len, reverse=True))
    marks = " ".join(f"WHEN '{role}' THEN {len(t.before) + len(t.after)}" for role, t in INSTRUCT.turns.items())
    other = len(INSTRUCT.other.before.replace("{role}", "")) + len(INSTRUCT.other.after)
    pattern = f"\\\\|{control}"
    grown = lambda c: f"length(regexp_replace({c}, '{pattern}', '\\0_', 'g'))"
    follows = " OR ".join(f"(state = '{s}' AND role IN ({', '.join(repr(r) for r in after)}))" for s, after in INSTRUCT.follows.items())
    states = ", ".join(f"'{s}'" for s in INSTRUCT.follows)
    learned = ", ".join(f"'{role}'" for role, t in INSTRUCT.turns.items() if t.loss)
    text = "</s>[INST] ok [/INST]"
    order = "ORDER BY turn NULLS FIRST, role, text"
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{text}'), (-1, 1, 'assistant', '{text}')),
seen AS (
  SELECT *, row_number() OVER w AS nth, lag(turn) OVER w AS last_turn,
    CASE WHEN row_number() OVER w = 1 THEN '{INSTRUCT.start}' WHEN lag(role) OVER w IN ({states}) THEN lag(role) OVER w END AS state
  FROM turns WINDOW w AS (PARTITION BY conv_id {order})),
judged AS (
  SELECT *, CASE WHEN turn IS NULL OR (nth > 1 AND turn IS NOT DISTINCT FROM last_turn) THEN 'turn ' || coalesce(turn::VARCHAR, 'None') || ' is missing or repeated'
       WHEN state IS NULL OR NOT ({follows}) THEN (CASE role WHEN '' THEN 'no role' ELSE role END) || ' after ' || coalesce(state, 'None') END AS error
  FROM seen)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' {order})) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role IN ({learned})), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' {order}) FILTER (role IN ({learned})), '')) AS loss_sha256,
       sum(CASE role {marks} ELSE {other} + {grown('role')} END + {grown('text')})::BIGINT AS formatted_chars,
       count(error) = 0 AS valid, arg_min(error, nth) FILTER (error IS NOT NULL) AS error
FROM judged GROUP BY conv_id
"""


SQL["op8_chat_format"] = _chat()


SQL["op11_filter_audit"] = """
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
labelled AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
judged AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS c,
         regexp_matches(t, '[#$%&*|]') AS d, coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e
  FROM texts LEFT JOIN labelled USING (doc_id)),
masks AS (
  SELECT part, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END) || (CASE WHEN c THEN 'C' ELSE '' END)
         || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS fails,
         count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM judged GROUP BY ALL),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT p.l || q.l || r.l || s.l || t.l AS o FROM letter p, letter q, letter r, letter s, letter t
  WHERE len(list_distinct([p.l, q.l, r.l, s.l, t.l])) = 5),
place AS (SELECT o, step, o[step] AS f, o[1:step - 1] AS before FROM orders, (SELECT unnest(range(1, 6)) AS step)),
seen AS (
  SELECT part, o, step, f, n, good, toxic, fails, contains(fails, f) AS hit,
         length(translate(fails, before, '')) < length(fails) AS gone
  FROM place, masks),
counted AS (
  SELECT part, o AS filter_order, step, f,
         coalesce(sum(n) FILTER (NOT gone AND NOT hit), 0) AS kept, coalesce(sum(n) FILTER (hit AND NOT gone), 0) AS removed,
         coalesce(sum(n) FILTER (hit AND gone), 0) AS redundant, coalesce(sum(n) FILTER (fails = f), 0) AS unique_fails,
         coalesce(sum(good) FILTER (hit AND NOT gone), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (hit AND NOT gone), 0) AS toxic_lost
  FROM seen GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM counted
"""
