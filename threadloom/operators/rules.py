"""Keyword rule tables, the first-match labeller and its checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from threadloom.functions.text import clean_handles, contains_any, strip
from threadloom.operators.splits import seeded_sample


@dataclass(frozen=True)
class Rule:
    """One intent with its keywords; ``risk`` … ``note`` are what a match assigns."""

    intent: str
    words: tuple[str, ...]
    risk: str = "low"
    escalate: bool = False
    reason: str = "none"
    note: str = ""


# Escalation reasons.
REASONS = ["high_risk", "ambiguous_request", "insufficient_context", "sensitive_account_issue",
           "potential_policy_exception", "complex_unresolved_issue", "none"]

# Labelling rules in order of precedence, and the outcome without a match.
LABEL_RULES = [
    Rule("account_security_access",
         ("password", "reset", "login", "log in", "2fa", "otp", "locked", "verification", "hacked", "sign in"),
         "high", True, "high_risk", "Account access or credential security inquiry"),
    Rule("package_missing_damaged",
         ("stolen", "stole", "damaged", "broken", "crushed", "missing", "never received", "empty box",
          "wrong item", "lost package", "lost my package", "ruined"),
         "medium", True, "potential_policy_exception", "Missing or damaged item requiring claim audit"),
    Rule("refund_return_processing",
         ("refund", "return label", "money back", "returned item", "drop off return", "reimbursement",
          "devolution", "reembolso"),
         "low", False, "none", "Standard return or refund status request"),
    Rule("cancellation_modification",
         ("cancel", "cancelo", "cancelar", "cancelaron", "cancellation", "change address", "wrong address",
          "one-click", "ワンクリック"),
         "medium", False, "none", "Order cancellation or address update request"),
    Rule("prime_subscription_membership",
         ("prime fee", "prime membership", "prime trial", "cancel prime", "prime student", "prime auto",
          "prime video"),
         "low", False, "none", "Prime subscription inquiry"),
    Rule("payment_billing_issues",
         ("charge", "charged", "payment", "card", "declined", "promo code", "gift card", "invoice", "billing",
          "cartão", "boleto", "bank", "mrp", "deals", "discount", "price"),
         "medium", True, "sensitive_account_issue", "Billing or charge dispute requiring account audit"),
    Rule("digital_technical_support",
         ("firestick", "fire tv", "kindle", "alexa", "echo", "app crash", "error code", "streaming",
          "buffering", "stream", "video app", "app"),
         "low", False, "none", "Digital device or app support"),
    Rule("order_tracking_delivery",
         ("where is", "tracking", "delivery status", "delivered yet", "when will it arrive",
          "out for delivery", "livraison", "commandes", "shipment", "shipping", "deliver", "delivery",
          "arrived", "late", "eta", "届かない", "発送"),
         "low", False, "none", "Standard tracking or shipping status query"),
    Rule("product_inquiry_availability",
         ("back in stock", "restock", "warranty", "seller", "compatible", "specification", "product", "deal",
          "offer", "buy", "buying", "sell", "price", "stock", "代引き"),
         "low", False, "none", "Product feature or availability question"),
    Rule("feedback_general_complaint",
         ("terrible", "horrible", "bad service", "rude", "disgusted", "useless", "worst", "complain",
          "complaint", "pathetic", "problem", "disaster", "fail", "sucks", "disappointed"),
         "low", True, "complex_unresolved_issue", "Customer service or logistics complaint"),
]
OTHER = Rule("other_unclear", (), "low", True, "ambiguous_request", "Ambiguous fragment or contextless greeting")

# Keywords that estimate how much of the data the taxonomy covers, in order.
COVERAGE_RULES = [
    Rule("order_tracking_delivery",
         ("where is", "track", "delivery", "arrive", "shipping", "transit", "when will")),
    Rule("package_missing_damaged",
         ("missing", "damaged", "broken", "stolen", "never received", "wrong item", "delivered but")),
    Rule("refund_return_processing", ("refund", "return", "label", "money back", "returned")),
    Rule("cancellation_modification", ("cancel", "cancellation", "change address", "wrong address")),
    Rule("prime_subscription_membership", ("prime", "membership", "subscription", "annual fee")),
    Rule("payment_billing_issues",
         ("charge", "payment", "card", "declined", "gift card", "promo", "overcharge", "bank")),
    Rule("digital_technical_support",
         ("firestick", "fire tv", "kindle", "alexa", "app", "error code", "stream")),
    Rule("account_security_access", ("login", "password", "lock", "otp", "2fa", "unauthorized", "hack")),
    Rule("product_inquiry_availability", ("stock", "restock", "warranty", "seller", "compatible")),
    Rule("feedback_general_complaint", ("horrible", "terrible", "worst", "rude", "complaint", "driver")),
]

# Keywords that select example messages per intent.
EXAMPLE_RULES = [
    Rule("order_tracking_delivery",
         ("where is my", "tracking", "delivery status", "delivered yet", "when will it arrive")),
    Rule("package_missing_damaged",
         ("broken", "damaged", "never received", "missing", "wrong item", "stolen", "empty box")),
    Rule("refund_return_processing",
         ("refund", "return label", "money back", "returned item", "drop off return")),
    Rule("cancellation_modification",
         ("cancel order", "cancellation", "change address", "wrong address", "cancel my")),
    Rule("prime_subscription_membership",
         ("prime fee", "prime membership", "prime trial", "cancel prime", "prime student")),
    Rule("payment_billing_issues",
         ("charged twice", "double charge", "declined card", "promo code", "gift card balance", "overcharged")),
    Rule("digital_technical_support",
         ("firestick", "fire tv", "kindle app", "alexa error", "streaming error", "error code")),
    Rule("account_security_access",
         ("locked out", "cannot login", "password reset", "2fa code", "otp", "unauthorized access")),
    Rule("product_inquiry_availability",
         ("back in stock", "restock date", "warranty info", "seller contact", "compatible with")),
    Rule("feedback_general_complaint",
         ("terrible service", "horrible support", "rude rep", "driver left package", "useless support")),
    Rule("other_unclear", ("hello", "hi there", "please check dm", "sent dm", "amazon help")),
]

# Example length band, examples per intent, size and seed of the fill-up sample.
MIN_CHARS, MAX_CHARS = 15, 180
EXAMPLES_PER_INTENT, FILL_SAMPLE, FILL_SEED = 3, 50, 42

INTENTS = [rule.intent for rule in EXAMPLE_RULES]


def first_match(text: Column, rules: list[Rule], pick, otherwise) -> Column:
    """One CASE over the rules in order; ``pick`` maps a matching rule to a literal value."""
    case = None
    for rule in rules:
        condition, value = contains_any(text, list(rule.words)), F.lit(pick(rule))
        case = F.when(condition, value) if case is None else case.when(condition, value)
    return case.otherwise(F.lit(otherwise))


def label_by_rules(df: DataFrame, rules: list[Rule] = LABEL_RULES, message: str = "customer_message",
                   context: Column | None = None) -> DataFrame:
    """Intent, risk, escalation flag, reason and note of the first rule found in message + context."""
    text = F.concat(F.lower(F.coalesce(message, F.lit(""))), F.lit(" "),
                    F.lower(F.coalesce(context, F.lit(""))) if context is not None else F.lit(""))
    # the cascade runs once, for the rule number; everything else is a lookup by number
    numbers = {rule.intent: i for i, rule in enumerate(rules)}
    fields = [*rules, OTHER]

    def lookup(values):
        return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("rule_no") + 1)

    return (
        df.withColumn("rule_no", first_match(text, rules, lambda r: numbers[r.intent], len(rules)))
        .withColumn("intent", lookup([r.intent for r in fields]))
        .withColumn("risk_tier", lookup([r.risk for r in fields]))
        .withColumn("requires_human_escalation", lookup([r.escalate for r in fields]))
        .withColumn("escalation_reason", lookup([r.reason for r in fields]))
        .withColumn("annotation_notes", lookup([r.note for r in fields]))
        .drop("rule_no")
    )


def rule_of(text: str, rules: list[Rule] = LABEL_RULES) -> Rule:
    """The first rule found in one text, where a step in Python needs it."""
    low = text.lower() + " "
    return next((rule for rule in rules if any(w in low for w in rule.words)), OTHER)


def label_violations(labelled: DataFrame) -> DataFrame:
    """Rows whose reason is unknown, or whose escalation flag contradicts the reason."""
    reason, escalate = F.col("escalation_reason"), F.col("requires_human_escalation")
    allowed = F.coalesce(reason.isin(REASONS), F.lit(False))
    consistent = F.coalesce((reason == "none") != escalate, F.lit(False))
    return labelled.where(~allowed | ~consistent)


def taxonomy_coverage(df: DataFrame, message: str, rules: list[Rule] = COVERAGE_RULES,
                      intents: list[str] = INTENTS) -> DataFrame:
    """Messages and share per intent of the taxonomy, zero rows included."""
    label = first_match(F.lower(F.coalesce(message, F.lit(""))), rules, lambda r: r.intent, OTHER.intent)
    counts = df.groupBy(label.alias("intent_id")).agg(F.count("*").alias("n"))
    total = df.select(F.count("*").alias("t")).scalar()
    names = df.sparkSession.createDataFrame([(i,) for i in intents], "intent_id string")
    n = F.coalesce("n", F.lit(0))
    return names.join(counts, "intent_id", "left").select(
        "intent_id", n.alias("n"), F.coalesce(F.round(n * 100.0 / F.nullif(total, F.lit(0)), 6), F.lit(0.0)).alias("pct"))


def escalation_lookup(spark: SparkSession, rules: list[Rule] = LABEL_RULES) -> DataFrame:
    """(intent, requires_human_escalation, escalation_reason) of the taxonomy; eleven rows."""
    rows = [(r.intent, r.escalate, r.reason) for r in [*rules, OTHER]]
    return spark.createDataFrame(
        rows, "predicted_intent string, requires_human_escalation boolean, escalation_reason string")


def label_calibration(df: DataFrame, rules: list[Rule] = LABEL_RULES) -> DataFrame:
    """Escalation flag and reason by predicted intent; an unknown intent escalates as ambiguous."""
    lookup = F.broadcast(escalation_lookup(df.sparkSession, rules))
    return df.withColumn("predicted_intent", strip(F.col("predicted_intent"))).join(
        lookup, "predicted_intent", "left"
    ).withColumn("requires_human_escalation", F.coalesce("requires_human_escalation", F.lit(OTHER.escalate))) \
        .withColumn("escalation_reason", F.coalesce("escalation_reason", F.lit(OTHER.reason)))


def training_texts(df: DataFrame, message: str, id_column: str) -> DataFrame:
    """(id, text): stripped, null as empty, empty dropped."""
    text = strip(F.coalesce(message, F.lit("")))
    return df.select(F.col(id_column).alias("id"), text.alias("text")).where(F.length("text") > 0)


def held_out_texts(*parts: DataFrame) -> DataFrame:
    """Distinct stripped texts of the given (id, text) tables."""
    texts = parts[0].select("text")
    for part in parts[1:]:
        texts = texts.unionByName(part.select("text"))
    return texts.distinct()


def mine_examples(train: DataFrame, held_out: DataFrame, rules: list[Rule] = EXAMPLE_RULES,
                  n: int = EXAMPLES_PER_INTENT) -> DataFrame:
    """The first n distinct cleaned messages per intent that match its keywords and are not held out.

    An intent with fewer is filled from one seeded sample. Ranks use a partial top-n in each task,
    so a frequent intent does not travel as a whole.
    """
    # copies of a text collapse first, on the key the exclusion join needs anyway
    texts = train.groupBy("text").agg(F.min("id").alias("id"))
    free = texts.join(held_out, "text", "left_anti").withColumn("example", clean_handles(F.col("text")))
    hits = F.array_compact(F.array(*[
        F.when(F.col("text").rlike("(?iu)" + "|".join(rf"\Q{w}\E" for w in rule.words)), F.lit(rule.intent))
        for rule in rules]))
    matched = (
        free.where(F.length("example").between(MIN_CHARS, MAX_CHARS))
        .select("id", "example", F.explode(hits).alias("intent"))
        .select("intent", "example", F.struct(F.lit(0).alias("kind"), F.col("id").cast("bigint").alias("ord")).alias("o"))
    )
    sample = seeded_sample(train, FILL_SAMPLE, FILL_SEED, ["id"])
    ranked = sample.withColumn("ord", F.row_number().over(
        W.partitionBy(F.lit(0)).orderBy(F.md5(F.concat_ws("|", F.lit(str(FILL_SEED)), F.col("id"))), "id")))
    intents = F.array(*[F.lit(rule.intent) for rule in rules])
    fill = (
        ranked.join(held_out, "text", "left_anti").withColumn("example", clean_handles(F.col("text")))
        .where(F.length("example") >= MIN_CHARS)
        .select(F.explode(intents).alias("intent"), "example",
                F.struct(F.lit(1).alias("kind"), F.col("ord").cast("bigint").alias("ord")).alias("o"))
    )
    first = matched.unionByName(fill).groupBy("intent", "example").agg(F.min("o").alias("o"))
    rank = F.row_number().over(W.partitionBy("intent").orderBy("o", "example"))
    return first.withColumn("rank", rank).where(F.col("rank") <= n).select("intent", "rank", "example")
