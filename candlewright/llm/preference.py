"""Preference formatting with DataFrame functions only: shared prompt once, two masked completions.

Turns are keyed by (pair, turn), so that no step before the last, which builds the text of a pair, gathers a conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The marks of the chat template.
START, STOP = "<|im_start|>", "<|im_end|>\n"


def head(role: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"))


def turns_of(conversations: DataFrame, pair_id: Column, side: Column) -> DataFrame:
    """(pair_id, side, turn, said): one row per turn; of rows that repeat a turn the least (role, text) counts.

    Rows of a null conv_id or turn belong to no conversation and are left out; a null role or text is empty.
    """
    said = F.struct(F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = conversations.filter("conv_id IS NOT NULL AND turn IS NOT NULL")
    return rows.select(pair_id.alias("pair_id"), side.alias("side"), F.col("turn").cast("bigint").alias("turn"), said.alias("said")).groupBy("pair_id", "side", "turn").agg(F.min("said").alias("said"))


def joined(turns: Column, part: Column | None, piece) -> Column:
    chosen = turns if part is None else F.filter(turns, lambda t: t["part"] == part)
    return F.array_join(F.transform(chosen, piece), "")


def rendered(t: Column) -> Column:
    return F.concat(head(t["said"]["role"]), t["said"]["text"], F.lit(STOP))


def mask(t: Column) -> Column:
    """Runs of characters: n- is masked, n+ is learned. Of a turn, only what the assistant says and its stop mark is learned."""
    opening, body = F.char_length(head(t["said"]["role"])), F.char_length(t["said"]["text"]) + len(STOP)
    learned = F.concat(opening.cast("string"), F.lit("-"), body.cast("string"), F.lit("+"))
    return F.when(t["said"]["role"] == "assistant", learned).otherwise(F.concat((opening + body).cast("string"), F.lit("-")))


def preference_pairs(turns: DataFrame) -> DataFrame:
    """One row per pair_id of ``turns`` (pair_id, side "chosen" or "rejected", turn, said{role, text}).

    n_prompt_turns, prompt: the turns before the first that differs in role or text or exists on one side only, rendered
    once. chosen, rejected: the rest of each side, with chosen_mask and rejected_mask; they may be empty. A pair of one
    side has no prompt, and null for the other side's text and mask. Equal conversations are all prompt.
    """
    sides = turns.groupBy("pair_id", "turn").agg(F.max(F.when(F.col("side") == "chosen", F.col("said"))).alias("c"), F.max(F.when(F.col("side") == "rejected", F.col("said"))).alias("r"))
    both = sides.groupBy("pair_id").agg(F.min(F.when(~F.col("c").eqNullSafe(F.col("r")), F.col("turn"))).alias("split"), F.count("c").alias("nc"), F.count("r").alias("nr"))
    rows = sides.select("pair_id", "turn", F.explode(F.array(F.struct(F.lit("c").alias("part"), F.col("c").alias("said")), F.struct(F.lit("r").alias("part"), F.col("r").alias("said")))).alias("x")).filter("x.said IS NOT NULL")
    lists = rows.groupBy("pair_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.col("x.part").alias("part"), F.col("x.said").alias("said")))).alias("turns"))
    whole = lists.join(both, "pair_id")
    before = F.col("split").isNull()
    prompt = F.filter("turns", lambda t: (t["part"] == "c") & (F.coalesce(t["turn"] < F.col("split"), F.lit(True))))
    rest = F.filter("turns", lambda t: ~before & (t["turn"] >= F.col("split")))
    n_prompt = F.size(prompt).cast("bigint")
    out = whole.select("pair_id", n_prompt.alias("n_prompt_turns"), joined(prompt, None, rendered).alias("prompt"), "nc", "nr", rest.alias("rest"))
    for name, part, n in (("chosen", "c", "nc"), ("rejected", "r", "nr")):
        for suffix, piece in (("", rendered), ("_mask", mask)):
            out = out.withColumn(name + suffix, F.when(F.col(n) > 0, joined(F.col("rest"), F.lit(part), piece)))
    return out.drop("nc", "nr", "rest")


def reply_pairs(conversations: DataFrame) -> DataFrame:
    """Turns of one pair per conversation, pair_id its conv_id: its last reply against one to another conversation.

    chosen is the conversation up to its last assistant turn, rejected the same turns with the last reply of the
    conversation that differs in the lowest bit of the id. A conversation without an assistant turn is chosen as it is; it, and one
    whose partner has none, has no rejected side. Repeated turns, nulls and empty tables are as in turns_of.
    """
    said = turns_of(conversations, F.col("conv_id").cast("bigint"), F.lit("chosen"))
    replies = said.filter("said.role = 'assistant'").groupBy("pair_id").agg(F.max(F.struct("turn", "said.text")).alias("r")).select("pair_id", F.col("r.turn").alias("last"), F.col("r.text").alias("reply"))
    others = replies.select(F.col("pair_id").bitwiseXOR(F.lit(1).cast("bigint")).alias("pair_id"), F.col("reply").alias("other"))
    rows = said.join(replies.select("pair_id", "last"), "pair_id", "left").join(others, "pair_id", "left")
    swapped = F.when(F.col("turn") == F.col("last"), F.struct(F.lit("assistant").alias("role"), F.col("other").alias("text"))).otherwise(F.col("said"))
    chosen = rows.filter("last IS NULL OR turn <= last").select("pair_id", "side", "turn", "said")
    rejected = rows.filter("other IS NOT NULL AND turn <= last").select("pair_id", F.lit("rejected").alias("side"), "turn", swapped.alias("said"))
    return chosen.unionByName(rejected)


def neighbours(conversations: DataFrame) -> DataFrame:
    """Turns of given pairs: conversations 2k (chosen) and 2k + 1 (rejected) are pair k. Edge cases as in turns_of."""
    conv = F.col("conv_id").cast("bigint")
    return turns_of(conversations, F.floor(conv / 2).cast("bigint"), F.when(F.pmod(conv, F.lit(2)) == 0, "chosen").otherwise("rejected"))
