"""Triage policy and threshold search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from threadloom.functions.text import strip

# Default thresholds, intents that always escalate with their reasons, grid and limit.
TAU_CONFIDENCE, TAU_SIMILARITY = 0.60, 0.50
ALWAYS_ESCALATE = {
    "account_security_access": "high_risk",
    "payment_billing_issues": "sensitive_account_issue",
    "package_missing_damaged": "potential_policy_exception",
    "feedback_general_complaint": "complex_unresolved_issue",
    "other_unclear": "ambiguous_request",
}
GRID = [i / 100 for i in range(40, 90, 5)]
MAX_FALSE_AUTO_RATE = 0.1501


def escalation_reason(intent: Column, confidence: Column, similarity: Column,
                      tau_confidence=TAU_CONFIDENCE, tau_similarity=TAU_SIMILARITY) -> Column:
    """Reason by precedence: intent first, then confidence, then similarity; scores that are null or NaN count as 1."""
    name = strip(intent)
    pairs = list(ALWAYS_ESCALATE.items())
    case = F.when(name == pairs[0][0], pairs[0][1])
    for label, reason in pairs[1:]:
        case = case.when(name == label, reason)
    known = lambda score: F.coalesce(F.nanvl(score.cast("double"), F.lit(1.0)), F.lit(1.0))
    weak = (known(confidence) < tau_confidence) | (known(similarity) < tau_similarity)
    return case.when(weak, "insufficient_context").otherwise("none")


def reason_of(intent: str, confidence: float = 1.0, similarity: float = 1.0,
              tau_confidence: float = TAU_CONFIDENCE, tau_similarity: float = TAU_SIMILARITY) -> str:
    """``escalation_reason`` for one row of known scores, where a step in Python needs it."""
    weak = confidence < tau_confidence or similarity < tau_similarity
    return ALWAYS_ESCALATE.get(intent.strip(), "insufficient_context" if weak else "none")


def triage(df: DataFrame, intent: str = "predicted_intent", confidence: str = "intent_confidence",
           similarity: str = "retrieval_similarity", tau_confidence=TAU_CONFIDENCE,
           tau_similarity=TAU_SIMILARITY) -> DataFrame:
    reason = escalation_reason(F.col(intent), F.col(confidence), F.col(similarity), tau_confidence, tau_similarity)
    return (
        df.withColumn("escalation_reason", reason)
        .withColumn("requires_human_escalation", F.col("escalation_reason") != "none")
        .withColumn("decision", F.when(F.col("requires_human_escalation"), "ESCALATE").otherwise("AUTO"))
    )


def threshold_grid(scored: DataFrame, grid: list[float] = GRID) -> DataFrame:
    """Confusion counts and metrics of every threshold pair, in one pass over the rows.

    ``scored``: predicted_intent, intent_confidence, retrieval_similarity, truth (true = escalate).
    A row's outcome depends only on how many grid values each score reaches, so the rows shrink to
    a histogram of at most 2 x 2 x 11 x 11 cells before the grid is laid over it.
    """
    values = F.array(*[F.lit(float(g)) for g in grid])

    def reached(score: str) -> Column:
        return F.size(F.filter(values, lambda g: g <= F.coalesce(score, F.lit(1.0))))

    cells = scored.groupBy(
        "truth", strip(F.col("predicted_intent")).isin(list(ALWAYS_ESCALATE)).alias("always"),
        reached("intent_confidence").alias("c"), reached("retrieval_similarity").alias("s"),
    ).agg(F.count("*").alias("n"))
    points = F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(float(a)).alias("tau_confidence"),
                 F.lit(float(b)).alias("tau_similarity"))
        for i, a in enumerate(grid) for j, b in enumerate(grid)])
    laid = cells.select("*", F.explode(points).alias("p"))
    # score < grid[i] exactly when it reaches no more than i values
    predicted = F.col("always") | (F.col("c") <= F.col("p.i")) | (F.col("s") <= F.col("p.j"))

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    counts = laid.groupBy("p.tau_confidence", "p.tau_similarity").agg(
        total(F.col("truth") & predicted).alias("tp"), total(~F.col("truth") & predicted).alias("fp"),
        total(F.col("truth") & ~predicted).alias("fn"), total(~F.col("truth") & ~predicted).alias("tn"))
    return binary_metrics(counts)


def safe_ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(0.0)


def binary_metrics(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and false-auto rate from tp, fp, fn, tn; zero where undefined."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    precision, recall = F.col("precision"), F.col("recall")
    return (
        counts.withColumn("precision", safe_ratio(tp, tp + fp))
        .withColumn("recall", safe_ratio(tp, tp + fn))
        .withColumn("f1", safe_ratio(2 * (precision * recall), precision + recall))
        .withColumn("false_auto_rate", safe_ratio(fn, tp + fn))
    )


def best_thresholds(grid: DataFrame, limit: float = MAX_FALSE_AUTO_RATE) -> DataFrame:
    """Highest F1 within the false-auto limit, the first in grid order on ties, else the defaults."""
    found = grid.where(F.col("false_auto_rate") <= limit).withColumn("choice", F.lit(0))
    default = grid.sparkSession.createDataFrame(
        [(TAU_CONFIDENCE, TAU_SIMILARITY, 1)], "tau_confidence double, tau_similarity double, choice int")
    return (
        found.unionByName(default, allowMissingColumns=True)
        .orderBy("choice", F.desc("f1"), "tau_confidence", "tau_similarity").limit(1).drop("choice")
    )


def triage_metrics(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """One row: counts, accuracy, precision, recall, F1, false-auto count and rate."""
    t, p = F.col(truth), F.col(predicted)
    counts = df.agg(F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"),
                    F.count_if(t & ~p).alias("fn"), F.count_if(~t & ~p).alias("tn"))
    total = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return binary_metrics(counts).withColumn("accuracy", safe_ratio(F.col("tp") + F.col("tn"), total))
