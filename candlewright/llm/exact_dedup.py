"""Exact de-duplication by a log-structured merge index, with DataFrame functions only.

1. *Memtables*: every row is keyed by the SHA-256 of its normalised text. A memtable is the
   digest -> (best rank, rows) map of ``memtable_rows`` rows on average, dealt by a hash of the row
   rather than of the digest, so a digest that a third of all rows share loads no memtable more.
2. *Flush*: each memtable is written as a run sorted by digest.
3. *Compaction* merges the runs of a batch into one level, and older levels that are not much larger with it: the
   smallest rank and the row count of each digest. The rank is the row's id or its negative, so "smallest
   identifier wins" covers either end.
4. *Filters*: Bloom filters, blocks of 64 bits in a table (block, bits). Each level has one over its digests, so a probe
   with a later batch reads nothing of a level for digests that it does not hold. The index makes another of
   the digests that it found more than once: rows that miss it are alone, and skip the join and the byte check.
5. *Hits* are compared byte by byte with the keeper's text. Rows of digests with many of them are dealt over
   salts and their keeper is replicated to each; no task gets a whole group.
6. A digest whose rows are not all equal (a collision) is regrouped by the text itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, discard, staying, written

NO_ID = -(2**63) + 1
#: Bits of a filter for each of its digests, and filters of more blocks than this (16 bytes each) are not broadcast.
FILTER_BITS, MOST_BLOCKS = 16, 1_000_000
#: There are no more hot digests than this, so they are broadcast (a few MB).
MOST_HOT = 50_000


def normalised(text: Column) -> Column:
    return ascii_lower(F.coalesce(text, F.lit("")))


def sha256_digest(text: Column) -> Column:
    return F.sha2(text, 256)


def filter_place(blocks: int) -> tuple[Column, Column]:
    """A digest's block, and the four bits it sets there."""
    bit = lambda shift: f"shiftleft(1L, cast(shiftright(xxhash64(digest, 7), {shift}) & 63 AS int))"
    return F.pmod(F.xxhash64("digest"), F.lit(blocks)), F.expr(" | ".join(map(bit, (0, 6, 12, 18))))


class Filter:
    """A blocked Bloom filter of the digests of a table: no false misses, about one false hit in 400."""

    def __init__(self, digests: DataFrame, rows: int):
        self.blocks = max(1, -(-rows * FILTER_BITS // 64))
        block, bits = filter_place(self.blocks)
        self.table = written(digests.select(block.alias("_block"), bits.alias("_bits")).groupBy("_block").agg(F.bit_or("_bits").alias("_set")), "lsm-filter")

    def probe(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``maybe``: False only for a digest that is not in the table. A filter too large to broadcast passes all."""
        if self.blocks > MOST_BLOCKS:
            return rows.withColumn("maybe", F.lit(True))
        block, bits = filter_place(self.blocks)
        met = rows.withColumns({"_block": block, "_bits": bits}).join(F.broadcast(self.table), "_block", "left")
        return met.withColumn("maybe", F.coalesce(F.col("_set").bitwiseAND(F.col("_bits")) == F.col("_bits"), F.lit(False))).drop("_block", "_bits", "_set")


def flush_runs(keyed: DataFrame, memtable_rows: int) -> DataFrame:
    """Write one run for each memtable, sorted by digest: (run, digest, rank, n).

    A row's run is drawn from a hash of its id and raw text, so memtables are even whatever the digests are.
    """
    runs = keyed.count() // memtable_rows + 1
    memtables = (
        keyed.withColumn("run", F.pmod(F.xxhash64("id", "raw", "salt"), F.lit(runs)).cast("int"))
        .repartition(runs, "run")
        .groupBy("run", "digest")
        .agg(F.min("rank").alias("rank"), F.count(F.lit(1)).alias("n"))
        .sortWithinPartitions("run", "digest")
    )
    return written(memtables, "lsm-run", ("run",))


class Level:
    """A merged table (digest, best, n) with the filter of its digests; the filter is made when it is first asked for."""

    def __init__(self, table: DataFrame):
        self.table, self.rows, self._filter = table, table.count(), None

    def probe(self, rows: DataFrame) -> DataFrame:
        self._filter = self._filter or Filter(self.table.select("digest"), self.rows)
        return self._filter.probe(rows)


class DigestIndex:
    """Levels of digests, the newest last. ``add`` takes a batch; ``groups`` says what all levels know of a batch's digests."""

    def __init__(self, memtable_rows: int = 65_536, growth: int = 4):
        self.levels: list[Level] = []
        self.memtable_rows, self.growth = memtable_rows, growth

    def add(self, keyed: DataFrame) -> None:
        """Flush a batch (id, raw, digest, rank, salt) to runs and merge these, with every last level at most ``growth`` times as large."""
        runs = flush_runs(keyed, self.memtable_rows)
        merged = [runs.select("digest", F.col("rank").alias("best"), "n")]
        size, taken = runs.count(), []
        while self.levels and self.levels[-1].rows <= self.growth * size:
            taken.append(self.levels.pop())
            size += taken[-1].rows
            merged.append(taken[-1].table)
        table = merged[0]
        for more in merged[1:]:
            table = table.unionByName(more)
        table = table.groupBy("digest").agg(F.min("best").alias("best"), F.sum("n").alias("n")).sortWithinPartitions("digest")
        self.levels.append(Level(written(table, "lsm-level")))
        discard(runs, *(x.table for x in taken))

    def groups(self, keyed: DataFrame) -> DataFrame:
        """(digest, best, n) of every digest of the batch that came more than once, over all levels."""
        *older, newest = self.levels
        if not older:
            return newest.table.filter("n > 1")
        wanted = written(keyed.select("digest").distinct(), "lsm-wanted")
        known = newest.table.join(wanted, "digest", "left_semi")
        for level in older:
            asked = level.probe(wanted).filter("maybe").select("digest")
            known = known.unionByName(level.table.join(asked, "digest", "left_semi"))
        return known.groupBy("digest").agg(F.min("best").alias("best"), F.sum("n").alias("n")).filter("n > 1")


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest", digest=sha256_digest, memtable_rows: int = 65_536, hits_per_salt: int = 2048,
    index: DigestIndex | None = None, earlier: DataFrame | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. ``keep`` says
    which id of a group stays, "largest" or "smallest". A null id ranks behind every other; a
    group of null ids alone has keep_id null and keeps its rows. A repeated row (same id, same text)
    counts once more in group_size and shares its twin's decision. Empty input gives no rows; columns
    other than id and text are ignored, whatever their names. ``digest`` may be a weaker function of the
    normalised text: byte verification makes up for its collisions.

    With an ``index`` of earlier batches, whose rows are ``earlier`` (for the byte check), a row may be kept for, and
    counted with, rows of these; the batch is added to the index. Groups of colliding digests are then
    made from both tables.
    """
    sign = -1 if keep == "largest" else 1
    index = DigestIndex(memtable_rows) if index is None else index

    def norm_rows(df: DataFrame) -> DataFrame:
        rank = F.coalesce(F.lit(sign) * F.col("id"), F.lit(-NO_ID))
        rows = df.select(F.col(id_col).cast("long").alias("id"), normalised(F.col(text_col)).alias("norm"))
        return rows.select("id", "norm", rank.alias("rank"), digest(F.col("norm")).alias("digest"))

    rows = norm_rows(docs)
    sha = [] if digest is sha256_digest else [F.sha2("norm", 256).alias("sha")]
    keyed = written(rows.select("id", "rank", "digest", *sha, F.xxhash64("norm").alias("raw"), F.monotonically_increasing_id().alias("salt")), "lsm-keys")
    index.add(keyed)
    several = written(index.groups(keyed), "lsm-groups")
    found = several.agg(F.count(F.lit(1)), F.sum("n")).first()
    per_salt = max(hits_per_salt, (found[1] or 0) // MOST_HOT)
    salts = F.ceil(F.col("n") / per_salt).cast("int")
    hot = F.broadcast(several.filter(salts > 1).select("digest", salts.alias("_salts")))
    wide = several.select("digest", "best", "n", F.explode(F.sequence(F.lit(0), salts - 1)).alias("_salt"))
    repeated = Filter(several.select("digest"), found[0])

    def salted(df: DataFrame) -> DataFrame:
        """Rows that may belong to a group, dealt over its salts."""
        near = repeated.probe(df).filter("maybe").drop("maybe").join(hot, "digest", "left")
        return near.withColumn("_salt", F.pmod(F.xxhash64("id", "raw", "_far"), F.coalesce("_salts", F.lit(1))).cast("int")).drop("_salts")

    texts = rows.withColumns({"raw": F.xxhash64("norm"), "_far": F.lit(0)})
    held = salted(texts).join(wide, ["digest", "_salt"])
    if earlier is not None:
        held = held.unionByName(salted(norm_rows(earlier).withColumns({"raw": F.xxhash64("norm"), "_far": F.lit(1)})).join(wide, ["digest", "_salt"]))
    sources = written(held.select("digest", "_salt", "rank", "best", "n", "norm"), "lsm-hits")
    keepers = sources.filter("rank = best").groupBy("digest", "n").agg(F.min("norm").alias("kept_norm"))
    keepers = keepers.select("digest", "kept_norm", F.explode(F.sequence(F.lit(0), salts - 1)).alias("_salt"))
    unequal = sources.join(keepers, ["digest", "_salt"]).filter("norm <> kept_norm").select("digest").distinct()
    clash = written(unequal, "lsm-clash")

    narrow = keyed.withColumn("_far", F.col("salt"))
    alone = repeated.probe(keyed).filter("NOT maybe").withColumns({"best": F.col("rank"), "n": F.lit(1).cast("bigint")})
    members = salted(narrow).join(wide, ["digest", "_salt"], "left").withColumns({"best": F.coalesce("best", "rank"), "n": F.coalesce("n", F.lit(1).cast("bigint"))})
    columns = ["id", "rank", "best", "n", (F.col("sha") if sha else F.col("digest")).alias("sha"), "digest"]
    plain = alone.select(*columns).unionByName(members.select(*columns))
    if not clash.isEmpty():
        mine = rows.join(clash, "digest", "left_semi")
        every = mine if earlier is None else mine.unionByName(norm_rows(earlier).join(clash, "digest", "left_semi"))
        groups = every.groupBy("norm").agg(F.min("rank").alias("best"), F.count(F.lit(1)).alias("n"))
        resolved = mine.join(groups, "norm").select("id", "rank", "best", "n", F.sha2("norm", 256).alias("sha"), "digest")
        plain = plain.join(clash, "digest", "left_anti").unionByName(resolved)
    return plain.select(
        F.col("id").alias("doc_id"),
        F.when(F.col("best") != -NO_ID, F.lit(sign) * F.col("best")).alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("rank") == F.col("best")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def without_copies(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` less all but one of each group of equal texts, with all their columns.

    Rows go one by one: an id that comes again with another text keeps that text. Of rows that repeat the kept id and text, and of
    a group of null ids, one stays. An empty table stays empty.
    """
    decided = exact_dedup(docs, **options).select("doc_id", F.col("text_sha256").alias("key"), "kept")
    return staying(docs, decided, F.sha2(normalised(F.col("text")), 256))
