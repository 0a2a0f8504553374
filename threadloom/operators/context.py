"""Conversation context: whole history per interaction, and the bounded memory window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from threadloom.functions.text import strip
from threadloom.operators.ordering import SLICE_ROWS, large_groups, positions, sliced_positions

# Memory bounds, speaker labels and the framing of the context.
MAX_TURNS = 4
MAX_CONTEXT_CHARS = 2000
CUSTOMER, AGENT = "Customer", "AmazonHelp"
CONTEXT_HEAD, INQUIRY_HEAD = "Preceding Context:\n", "\n\nCurrent Inquiry:\n"


#: Pairs of one conversation whose whole histories are joined in one task.
HISTORY_BLOCK_ROWS = 10_000


def preceding_context(inter: DataFrame, agent: str = AGENT, block_rows: int = HISTORY_BLOCK_ROWS) -> DataFrame:
    """All earlier lines of the conversation for each interaction, its position and multi-turn flag.

    A conversation above ``block_rows`` pairs is cut into blocks: each block joins its own lines in
    its own task and takes the text of the blocks before it as one ready string.
    """
    keys, order, ties = ["conversation_id"], F.unix_micros("customer_ts"), ["brand_tweet_id"]
    lines = inter.withColumn("line", F.concat(
        F.lit(f"{CUSTOMER}: "), "customer_message", F.lit(f"\n{agent}: "), "brand_response"))
    large = large_groups(inter, keys, order, block_rows)
    if large is None:
        sequence = W.partitionBy(*keys).orderBy(order.asc_nulls_last(), *ties)
        rows = lines.withColumn("pair_no", F.row_number().over(sequence)).withColumn(
            "conversation_context", F.array_join(
                F.collect_list("line").over(sequence.rowsBetween(W.unboundedPreceding, -1)), "\n"))
    else:
        rows = _blocked_history(
            sliced_positions(lines, keys, order, ties, "pair_no", large, block_rows), keys, block_rows)
    return rows.withColumn("message_position", F.col("pair_no") * 2 - 1).withColumn(
        "is_multi_turn", F.col("pair_no") > 1).drop("line", "pair_no")


def _blocked_history(lines: DataFrame, keys: list[str], block_rows: int) -> DataFrame:
    blocked = lines.withColumn("block", F.floor((F.col("pair_no") - 1) / block_rows))
    block_keys = [*keys, "block"]
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("pair_no", "line"))), lambda x: x["line"])
    texts = blocked.groupBy(*block_keys).agg(F.array_join(ordered, "\n").alias("text"))
    earlier = W.partitionBy(*keys).orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    prefix = texts.select(*block_keys, F.array_join(F.collect_list("text").over(earlier), "\n").alias("prefix")) \
        .where("block > 0")
    in_block = W.partitionBy(*block_keys).orderBy("pair_no").rowsBetween(W.unboundedPreceding, -1)
    own = F.when(F.col("in_block") != "", F.col("in_block"))
    return (
        blocked.withColumn("in_block", F.array_join(F.collect_list("line").over(in_block), "\n"))
        .join(prefix, block_keys, "left")
        .withColumn("conversation_context", F.concat_ws("\n", F.col("prefix"), own))
        .drop("block", "prefix", "in_block")
    )


def history_line(role: Column, text: Column) -> Column:
    return F.concat(role, F.lit(": "), strip(text))


def frame_context(history: Column, message: Column, max_chars: int = MAX_CONTEXT_CHARS) -> Column:
    """Framed text from an array of history lines; the stripped message alone without history."""
    block = F.array_join(history, "\n")
    tail = F.when(F.length(block) > max_chars, F.right(block, F.lit(max_chars))).otherwise(block)
    current = strip(message)
    return F.when(F.coalesce(F.size(history), F.lit(0)) <= 0, current).otherwise(
        F.concat(F.lit(CONTEXT_HEAD), tail, F.lit(INQUIRY_HEAD), current))


def frame_text(history: list[str], message: str | None, max_chars: int = MAX_CONTEXT_CHARS) -> str:
    """``frame_context`` for one row, where a step in Python needs it."""
    current = (message or "").strip()
    return CONTEXT_HEAD + "\n".join(history)[-max_chars:] + INQUIRY_HEAD + current if history else current


def memory_context(turns: DataFrame, max_turns: int = MAX_TURNS, max_chars: int = MAX_CONTEXT_CHARS,
                   block_rows: int = SLICE_ROWS) -> DataFrame:
    """The bounded context of every customer turn, from the turns before it.

    ``turns``: conversation_id, position (any orderable number), role, text. Blank ids and empty
    texts never enter the history. A long conversation is cut into blocks whose last ``max_turns``
    rows are also handed to the next block, so no task holds a whole one.
    """
    kept = turns.where((F.col("conversation_id").cast("string") != "") & (F.col("text") != ""))
    kept = kept.withColumn("line", history_line(F.col("role"), F.col("text")))
    keys, order, block_rows = ["conversation_id"], F.col("position"), max(block_rows, max_turns)
    large = large_groups(kept, keys, order, block_rows)
    if large is None:
        window = W.partitionBy(*keys).orderBy(order)
        rows = kept
    else:
        numbered = sliced_positions(kept, keys, order, [], "turn_no", large, block_rows)
        block = F.floor((F.col("turn_no") - 1) / block_rows)
        spill = (F.col("turn_no") - 1) % block_rows >= block_rows - max_turns
        copies = F.explode(F.when(spill, F.array(block, block + 1)).otherwise(F.array(block)))
        rows = numbered.withColumn("own_block", block).withColumn("block", copies)
        window = W.partitionBy(*keys, "block").orderBy("turn_no")
    history = F.collect_list("line").over(window.rowsBetween(-max_turns, -1))
    rows = rows.withColumn("history", history)
    if large is not None:
        rows = rows.where("block = own_block").drop("block", "own_block", "turn_no")
    return rows.where(F.col("role") == CUSTOMER).withColumn(
        "context", frame_context(F.col("history"), F.col("text"), max_chars)).drop("line")


def interaction_turns(inter: DataFrame, agent: str = AGENT) -> DataFrame:
    """Interactions as turns: two rows each, in conversation order, with all columns of the interaction."""
    pairs = positions(inter, ["conversation_id"], F.unix_micros("customer_ts"), ["brand_tweet_id"], "pair_no")
    first = F.col("pair_no") * 2 - 1
    turn = F.explode(F.array(
        F.struct(first.alias("position"), F.lit(CUSTOMER).alias("role"), F.col("customer_message").alias("text")),
        F.struct((first + 1).alias("position"), F.lit(agent).alias("role"), F.col("brand_response").alias("text"))))
    return pairs.select("*", turn.alias("turn")).select("*", "turn.*").drop("turn", "pair_no")


def explicit_context(history: Column, message: Column, max_turns: int = MAX_TURNS,
                     max_chars: int = MAX_CONTEXT_CHARS) -> Column:
    """Context from a given history array of (role, text): it replaces the remembered turns."""
    lines = F.transform(history, lambda h: F.concat(
        F.coalesce(h["role"], F.lit(CUSTOMER)), F.lit(": "), F.coalesce(h["text"], F.lit(""))))
    size = F.size(lines)
    tail = F.slice(lines, F.greatest(size - max_turns + 1, F.lit(1)), F.lit(max_turns))
    return frame_context(tail, message, max_chars)
