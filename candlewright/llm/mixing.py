"""Mixing sources by temperature, with DataFrame functions only.

*Weights.* Source s with t_s tokens gets weight t_s^e / sum t^e. e = 1 keeps the corpus's shares, e = 0 makes them equal;
entropy falls and repetition falls as e grows. The exponent is bisected (31 cuts at a time, each round one small
aggregation over the sources) to the target entropy, or to the least flattening that keeps every source within
``most_epochs`` passes over its documents, whichever is larger.

*Realisation.* A source's budget is its weight times the token budget. Its documents are dealt by hashes to blocks of about
``block_tokens``, and blocks to ``most_groups`` groups at most; each epoch permutes the groups, the blocks in a group and the
documents in a block by further hashes. Whole epochs come first; the last one stops at the budget: groups in order while
they fit, then blocks of the next group, then documents of the next block. Each of the three steps orders, for one
source, only what the step before has left open. Where it stops is a block key and a document key per source, so
emitting needs no join but with one row per source.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

CUTS = 31


def word_tokens(docs: DataFrame):
    """Tokens of a text as mixing counts them: its words."""
    return F.coalesce(F.regexp_count("text", F.lit(r"\S+")), F.lit(0)).cast("bigint")


def curve(sizes: DataFrame, exponents: list[float]) -> dict[float, tuple[float, float, float]]:
    """exponent -> (entropy in nats, passes over the smallest source if the largest gets one, Z)."""
    grid = sizes.select("t", F.explode(F.array(*map(F.lit, exponents))).alias("e"))
    power = F.exp(F.col("e") * F.log("t"))
    found = grid.groupBy("e").agg(F.sum(power).alias("z"), F.sum(power * F.log("t")).alias("d"), F.min("t").alias("least"), F.max("t").alias("most"))
    return {r["e"]: (math.log(r["z"]) - r["e"] * r["d"] / r["z"], (r["most"] / r["least"]) ** (1 - r["e"]), r["z"]) for r in found.collect()}


def fit_exponent(sizes: DataFrame, entropy_gain: float, most_epochs: float, rounds: int = 5) -> float:
    """The exponent in [0, 1] at which entropy has risen by ``entropy_gain`` of what equal shares would add, or more."""
    ends = curve(sizes, [0.0, 1.0])
    target = ends[1.0][0] + entropy_gain * (ends[0.0][0] - ends[1.0][0])
    lo, hi = 0.0, 1.0  # at hi both conditions hold
    for _ in range(rounds):
        cuts = [lo + (hi - lo) * k / (CUTS + 1) for k in range(CUTS + 2)]
        found = curve(sizes, cuts)
        good = [x for x in cuts if found[x][0] <= target + 1e-12 and found[x][1] <= most_epochs + 1e-12]
        hi = min(good, default=hi)
        lo = max((x for x in cuts if x < hi), default=lo)
    return hi


def keyed(docs: DataFrame, seed: int) -> DataFrame:
    """Rows, packed as _row so that no name of theirs clashes, with their source, tokens and document key."""
    return docs.select(F.struct("*").alias("_row"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("_source"), word_tokens(docs).alias("_tokens"), F.xxhash64("doc_id", F.lit(seed)).alias("_key"))


def block_of(groups, blocks, seed: int):
    """(group, block) of a document: hashes of its key."""
    return F.struct(F.pmod(F.xxhash64("_key", F.lit(seed + 1)), groups).alias("g"), F.pmod(F.xxhash64("_key", F.lit(seed + 5)), blocks).alias("b"))


def block_key(epoch, seed: int):
    """Orders the blocks of an epoch: 32 bits of the group, then 32 of the block."""
    group = F.shiftright(F.xxhash64("_source", "_block.g", epoch, F.lit(seed + 2)), 32)
    block = F.shiftrightunsigned(F.xxhash64("_source", "_block", epoch, F.lit(seed + 2)), 32)
    return F.shiftleft(group, 32).bitwiseOR(block)


def first_over(parts: DataFrame, key: str) -> DataFrame:
    """Of parts (_source, key, n, room) in the order of their keys the first that does not fit, and the room left before it."""
    upto = parts.withColumn("upto", F.sum("n").over(Window.partitionBy("_source").orderBy(key)))
    found = upto.filter("upto > room").groupBy("_source").agg(F.min_by(F.struct(key, (F.col("room") - F.col("upto") + F.col("n")).alias("room")), key).alias("c"))
    return written(found.select("_source", f"c.{key}", "c.room"), "mix-cut")


def document_key(epoch, seed: int):
    return F.xxhash64("_key", epoch, F.lit(seed + 3))


def mixing_plan(docs: DataFrame, entropy_gain: float = 0.5, most_epochs: float = 2.0, budget: float | None = None, seed: int = 1, block_tokens: int = 65_536, most_groups: int = 4096) -> DataFrame:
    """One row per source: _source, tokens, weight, groups, blocks (a group), whole (epochs), cut_block, cut_document.

    ``budget`` is in tokens; without one it is such that the largest source gets one pass, so no document is lost.
    A source without tokens has weight 0 and one pass, which costs nothing.
    """
    rows = written(keyed(docs, seed).select("_source", "_tokens", "_key"), "mix-keys")
    totals = written(rows.groupBy("_source").agg(F.sum("_tokens").alias("tokens")), "mix-sources")
    sizes = totals.filter("tokens > 0").select(F.col("tokens").cast("double").alias("t"))
    plan = totals.withColumn("groups", F.least(F.lit(most_groups), F.ceil(F.col("tokens") / block_tokens) + 1).cast("int"))
    plan = plan.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("tokens") / (F.col("groups") * block_tokens))).cast("int"))
    if sizes.isEmpty():
        return plan.select("_source", "tokens", F.lit(0.0).alias("weight"), "groups", "blocks", F.lit(1).cast("bigint").alias("whole"), F.lit(None).cast("bigint").alias("cut_block"), F.lit(None).cast("bigint").alias("cut_document"))
    e = fit_exponent(sizes, entropy_gain, most_epochs)
    z = curve(sizes, [e])[e][2]
    largest = sizes.agg(F.max("t")).first()[0]
    total = budget if budget is not None else largest * z / largest**e
    weight = F.when(F.col("tokens") > 0, F.exp(F.lit(e) * F.log(F.col("tokens").cast("double"))) / z).otherwise(0.0)
    due = F.col("weight") * F.lit(float(total))
    plan = plan.withColumn("weight", weight)
    # a relative 1e-9 keeps rounding from turning a whole pass into all but one document
    plan = plan.withColumn("whole", F.when(F.col("tokens") > 0, F.floor(due / F.col("tokens") * (1 + 1e-9))).otherwise(1).cast("bigint"))
    plan = written(plan.withColumn("left", F.greatest(F.lit(0.0), due - F.col("whole") * F.col("tokens"))), "mix-plan")
    placed = rows.join(plan.select("_source", "groups", "blocks", "whole", F.col("left").alias("room")), "_source").withColumn("_block", block_of(F.col("groups"), F.col("blocks"), seed))
    placed = placed.withColumn("bk", block_key(F.col("whole"), seed)).withColumn("gk", F.shiftright("bk", 32)).select("_source", "_tokens", "_key", "whole", "room", "bk", "gk")
    tokens = F.sum("_tokens").alias("n")
    group = first_over(placed.groupBy("_source", "gk", "room").agg(tokens), "gk")
    block = first_over(placed.drop("room").join(group, ["_source", "gk"]).groupBy("_source", "bk", "room").agg(tokens), "bk")
    edge = placed.drop("room").join(block, ["_source", "bk"]).withColumn("dk", document_key(F.col("whole"), seed)).groupBy("_source", "dk", "room").agg(tokens)
    fits = edge.withColumn("upto", F.sum("n").over(Window.partitionBy("_source").orderBy("dk"))).filter("upto <= room").groupBy("_source").agg(F.max("dk").alias("cut_document"))
    stops = block.select("_source", F.col("bk").alias("cut_block")).join(fits, "_source", "left")
    return written(plan.drop("left").join(stops, "_source", "left"), "mix-result")


def mix(docs: DataFrame, small: int = 100_000, seed: int = 1, keys: bool = True, **options) -> DataFrame:
    """The rows of ``docs`` as often as mixing emits them, with epoch, block_key, document_key, tokens and weight.

    Ordering by (epoch, block_key, document_key) within a source gives its sequence. A null source is a source of its own; a
    null text has no tokens; repeated rows share their key, hence their fate; empty input gives no rows. Columns of ``docs``
    keep their names and values. The added ones are prefixed ``mix_`` and stay away with ``keys=False``; columns of ``docs``
    that have just those names give way to them.
    """
    plan = mixing_plan(docs, seed=seed, **options)
    plan = F.broadcast(plan) if plan.count() <= small else plan  # a row per source; beyond ``small`` a shuffled join
    rows = keyed(docs, seed).join(plan, "_source").withColumn("_block", block_of(F.col("groups"), F.col("blocks"), seed))
    bk, dk = block_key(F.col("whole"), seed), document_key(F.col("whole"), seed)
    partial = (F.col("tokens") > 0) & (F.col("cut_block").isNotNull()) & ((bk < F.col("cut_block")) | ((bk == F.col("cut_block")) & (dk <= F.col("cut_document"))))
    copies = F.col("whole") + F.when(partial, 1).otherwise(0)
    epochs = F.when(copies > 0, F.sequence(F.lit(0).cast("bigint"), copies - 1))
    emitted = rows.select("*", F.explode(epochs).alias("_epoch"))
    epoch = F.col("_epoch")
    if not keys:
        return emitted.select("_row.*")
    added = {"mix_epoch": epoch, "mix_block_key": block_key(epoch, seed), "mix_document_key": document_key(epoch, seed), "mix_tokens": F.col("_tokens"), "mix_weight": F.col("weight")}
    return emitted.select(*(F.col(f"_row.`{c}`") for c in docs.columns if c not in added), *(v.alias(k) for k, v in added.items()))
