"""Secret scans through a trigram inverted index, with DataFrame functions only.

From each rule's regular expression a Boolean trigram query is derived. The index holds a posting
(trigram, document) for each trigram that some rule asks for; a rule's candidates are the
intersections of the postings of its branches, counted by join. Candidates are verified with the
expression itself. Rules without mandatory trigrams scan every text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from threadloom.llm.scratch import Scratch
from threadloom.llm.trigrams import ANY, trigram_query


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its expression, and the group that must have at least ``min_length`` characters.

    The expression uses only syntax that Java and Python share. Matches run from left to right without
    overlap; those with a shorter group are dropped afterwards.
    """

    kind: str
    pattern: str
    group: int = 0
    min_length: int = 1


_KEYWORD = "(" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word) for word in
                         ("password", "passwd", "secret", "token")) + "|[aA][pP][iI]_?[kK][eE][yY])"
BASE = (
    Rule("assign", _KEYWORD + "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    Rule("access", "AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", "[0-9a-f]+", 0, 16),
)
#: Public token formats; a scan may take other rules.
MORE = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("url_login", "[a-z][a-z0-9+.-]*://[^\\s:/@]+:[^\\s:/@]+@"),
)
RULES = BASE + MORE


def fast_pattern(rule: Rule) -> str:
    """An expression with the same surviving matches for a plain run of one class, else the rule's own."""
    if rule.group == 0 and rule.min_length > 1 and rule.pattern.startswith("[") and rule.pattern.endswith("]+"):
        return rule.pattern[:-1] + "{" + str(rule.min_length) + ",}"
    return rule.pattern


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("text_key", F.xxhash64("text"))


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram, doc_id): which documents contain which of ``trigrams``, in either ASCII case."""
    folded = docs.select("doc_id", F.lower("text").alias("folded"))
    found = F.array_compact(F.array(*[F.when(F.contains("folded", F.lit(t)), F.lit(t)) for t in trigrams]))
    return folded.select("doc_id", F.explode(found).alias("trigram")).distinct()


def candidates(index: DataFrame, rules: dict[str, frozenset]) -> DataFrame:
    """(doc_id, kinds): intersects the postings of each branch of each rule's query."""
    asked = [(kind, i, t, len(branch)) for kind, query in rules.items() for i, branch in enumerate(sorted(query, key=sorted)) for t in sorted(branch)]
    wanted = index.sparkSession.createDataFrame(asked, "kind string, branch int, trigram string, needed int")
    hits = index.join(F.broadcast(wanted), "trigram")  # a fixed table: one row per rule, branch and trigram
    full = hits.groupBy("doc_id", "kind", "branch", "needed").agg(F.count("*").alias("n")).where("n = needed")
    return full.groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))


def _matches(docs: DataFrame, rules: list[Rule], kinds: Column | None) -> DataFrame:
    """(doc_id, text_key, kind, nth, before, found, checked): pieces before matches, and match lengths."""
    parts = []
    for rule in rules:
        pattern = fast_pattern(rule)
        wanted = F.col("text").rlike(pattern)
        if kinds is not None:
            wanted = F.array_contains(kinds, rule.kind) & wanted
        whole = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        checked = whole if rule.group == 0 else F.regexp_extract_all("text", F.lit(pattern), F.lit(rule.group))
        length = lambda part: F.transform(part, lambda x: F.length(x))
        zipped = F.arrays_zip(length(F.split("text", pattern, -1)).alias("before"), length(whole).alias("found"), length(checked).alias("checked"))
        kind = F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.min_length).alias("least"), zipped.alias("parts"))
        parts.append(F.when(wanted, kind))
    found = docs.select("doc_id", "text_key", F.explode(F.array_compact(F.array(*parts))).alias("m"))
    return found.select("doc_id", "text_key", "m.kind", "m.least", F.posexplode("m.parts").alias("nth", "part")).select(
        "doc_id", "text_key", "kind", "least", "nth", "part.before", "part.found", "part.checked")


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Spans of secrets: doc_id, text_key, kind, start, end (code points, end exclusive).

    ``docs`` has doc_id and text; more columns are ignored. Null texts are empty. Rows that repeat both
    doc_id and text have their spans once; ``text_key`` (a hash of the text) tells rows with one doc_id apart.
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    keyed = _keyed(docs)
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    indexed = {kind: query for kind, query in queries.items() if query != ANY and frozenset() not in query}
    scanned = [rule for rule in rules if rule.kind not in indexed]
    found = None
    if indexed:
        trigrams = sorted({t for query in indexed.values() for branch in query for t in branch})
        index = scratch.store(postings(keyed, trigrams), "postings")
        chosen = scratch.store(candidates(index, indexed), "candidates")
        scratch.drop(index)
        # null-safe, so that texts without id are verified too
        chosen = chosen.withColumnRenamed("doc_id", "candidate")
        verified = keyed.join(chosen, keyed.doc_id.eqNullSafe(F.col("candidate")))
        found = _matches(verified, [r for r in rules if r.kind in indexed], F.col("kinds"))
    if scanned:
        full = _matches(keyed, scanned, None)
        found = full if found is None else found.unionByName(full)
    found = found.distinct()
    order = Window.partitionBy("doc_id", "text_key", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("before") + F.coalesce("found", F.lit(0))).over(order)
    return found.withColumn("end", end).where("checked >= least").select(
        "doc_id", "text_key", "kind", (F.col("end") - F.col("found")).cast("long").alias("start"), F.col("end").cast("long").alias("end"))


def scan_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every row of ``docs`` (doc_id, text_key) with ``spans``: an array of (start, rank, kind, end) in order.

    ``rank`` is the rule's place in ``rules``; it breaks ties of equal starts.
    """
    rank = F.element_at(F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))]), F.col("kind"))
    spans = find_secrets(docs, rules).groupBy("doc_id", "text_key").agg(
        F.sort_array(F.collect_list(F.struct("start", rank.alias("rank"), "kind", "end"))).alias("spans"))
    rows = _keyed(docs).select("doc_id", "text_key")
    spans = spans.select(F.col("doc_id").alias("span_doc"), F.col("text_key").alias("span_key"), "spans")
    joined = rows.join(spans, rows.doc_id.eqNullSafe(F.col("span_doc")) & (F.col("text_key") == F.col("span_key")), "left")
    none = F.expr("array()").cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    return joined.select("doc_id", "text_key", F.coalesce("spans", none).alias("spans"))


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    one = lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def redact(docs: DataFrame, mark: str = "[SECRET]", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with each secret's span, or run of overlapping spans, replaced by ``mark``.

    All rows and columns stay; ``n_chars`` follows the new text where it exists.
    """
    in_text = Window.partitionBy("doc_id", "text_key").orderBy("start", "end")
    fresh = F.coalesce(F.col("start") > F.max("end").over(in_text.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    runs = find_secrets(docs, rules).withColumn("fresh", fresh.cast("int")).withColumn(
        "run", F.sum("fresh").over(in_text.rowsBetween(Window.unboundedPreceding, 0)))
    merged = runs.groupBy("doc_id", "text_key", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    cuts = merged.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_secret_cuts")).select(
        F.col("doc_id").alias("_secret_doc"), F.col("text_key").alias("_secret_key"), "_secret_cuts")
    names = docs.columns
    own_key = F.xxhash64(F.coalesce(docs.text.cast("string"), F.lit("")))
    joined = docs.join(cuts, docs.doc_id.cast("long").eqNullSafe(F.col("_secret_doc")) & (own_key == F.col("_secret_key")), "left")
    cut = F.col("_secret_cuts")
    from_place = lambda i: F.coalesce(F.get(cut, i - 1)["end"], F.lit(0))
    pieces = F.transform(
        F.sequence(F.lit(0), F.size(cut)),
        lambda i: F.substring(
            docs.text, from_place(i).cast("int") + 1,
            (F.coalesce(F.get(cut, i)["start"], F.length(docs.text).cast("long")) - from_place(i)).cast("int")))
    text = F.when(cut.isNull(), docs.text).otherwise(F.array_join(pieces, mark))
    out = joined.withColumn("text", text)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(cut.isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out.select(*names)
