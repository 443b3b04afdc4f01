"""SimHash near-dedup with an exact similarity: links of fingerprints, checked and completed to all pairs of a Jaccard similarity.

Texts are sets of word shingles; equal sets are one *node*. Two sets of similarity s or more

* differ in at most (1 - s) / (1 + s) of their joint size, so their parity maps (bit i is 1 if an odd number of
  shingles end in i) differ in no more bits, and
* share one of their first n - ceil(s n) + 1 shingles in any order common to all texts (prefix filter). The order is by
  hash, shingles that are common in a sample last: any sample gives the same links, it only keeps widespread lines out. And
* at the first one they share, at places i and j from 0, have no more than the lesser of n - i and m - j in common (positional
  filter). Where the sample shows a group's shingles as common, a copy's own come before them, so one that is too far from
  the group's origin to be linked to it meets nobody.

1. *First links*: fingerprints within a few bits, from the vantage-point trees of ``simhash``, and for each of a node's
   first shared keys the pair with one leader drawn from all nodes of that key and size class; for each of its keys the pair
   with the hub, the node there with the most shared keys, which of a text and its edited copies is the text. Pairs are
   checked, by wide parity maps and then by their sets, and give components. A group of copies, however large, is all but
   one component after that.
2. *Completion*: of the nodes that share a key, only those outside the key's main component meet others: all pairs of
   different components that all bounds allow are checked in the same way.

A pair of similarity s is in one component after step 1 or is checked in step 2, so the components are those of all
pairs at s or more. No step gathers a group in one task, or makes pairs inside a component. Step 2 is quadratic only in nodes
that share a key and a size class and are in different components.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import staying, written
from .components import connected_components
from .exact_dedup import Filter
from .simhash import fingerprint, fingerprint_links, shingle_hashes

MAPS = ("m0", "m1", "m2", "m3")
ROUNDING = 1e-9
#: So many shared keys of each node are used for first links with drawn leaders.
FIRST_KEYS = 16


def text_key(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def shingle_set(text: str | None, words: int, seed: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, words, seed))


def parity_map(shingles: np.ndarray) -> np.ndarray:
    """64-bit words, four or more, a power of two with as many bits as shingles at least. Folding halves gives the map of half the bits."""
    bits = max(256, 1 << max(0, len(shingles) - 1).bit_length())
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def folded(wide: np.ndarray) -> np.ndarray:
    """The map of 256 bits."""
    return np.bitwise_xor.reduce(wide.reshape(-1, len(MAPS)), axis=0)


def prefix(shingles: np.ndarray, common: np.ndarray, ranks: np.ndarray, similarity: float) -> np.ndarray:
    n = len(shingles)
    first = n - math.ceil(similarity * n - ROUNDING) + 1
    if not n or not len(common):
        return shingles[:first]
    at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
    return shingles[np.argsort(np.where(common[at] == shingles, ranks[at], 0), kind="stable")[:first]]


def close(apart: Column, a: Column, b: Column, similarity: float) -> Column:
    """Whether sets of sizes a and b whose maps are ``apart`` may reach the similarity."""
    return (apart * (1 + similarity) <= (1 - similarity) * (a + b) + ROUNDING) & (F.least(a, b) >= similarity * F.greatest(a, b) - ROUNDING)


def possible(a: str, b: str, similarity: float) -> Column:
    apart = sum((F.bit_count(F.col(f"{a}.{m}").bitwiseXOR(F.col(f"{b}.{m}"))) for m in MAPS), F.lit(0))
    return close(apart, F.col(f"{a}.size"), F.col(f"{b}.size"), similarity)


def in_place(a: str, b: str, similarity: float) -> Column:
    """Whether sets that share no key before this one may reach the similarity."""
    rest = F.least(F.col(f"{a}.size") - F.col(f"{a}.place"), F.col(f"{b}.size") - F.col(f"{b}.place"))
    return rest * (1 + similarity) >= similarity * (F.col(f"{a}.size") + F.col(f"{b}.size")) - ROUNDING


def wide_apart(a: Column, b: Column) -> Column:
    """Bits that differ between two wide maps; the longer is folded once (sizes that may match are less than a factor of two apart)."""
    half = lambda x, y: F.when(F.size(x) > F.size(y), F.zip_with(F.slice(x, F.lit(1), F.size(y)), F.slice(x, F.size(y) + 1, F.size(y)), lambda p, q: p.bitwiseXOR(q))).otherwise(x)
    return F.aggregate(F.zip_with(half(a, b), half(b, a), lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda n, x: n + x)


def size_class(size: Column, similarity: float) -> Column:
    """Sizes that may match are in the same class or in neighbouring ones."""
    return F.floor(F.log(F.greatest(size, F.lit(1)).cast("double")) / -math.log(similarity - ROUNDING)).cast("int")


def common_shingles(docs: DataFrame, words: int, seed: int, sample_rows: int, share: float = 1 / 8, least: int = 3, most: int = 1_000_000) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in ``least`` or more of a sample of texts, by hash, and their rank; the more texts, the higher.

    The sample is about ``share`` of the texts, ``sample_rows`` at least, so that a shingle of a given number of texts is found
    in any table: with a sample of fixed size the groups of shingles that it misses would grow with the table.
    """

    def run(batches):
        for batch in batches:
            for text in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(text, words, seed).view(np.int64))], names=["shingle"])

    rows = docs.count()
    sample = docs.filter(F.pmod(F.xxhash64("text"), F.lit(max(1, rows))) < max(sample_rows, math.ceil(share * rows))).select("text")
    counts = sample.mapInArrow(run, "shingle bigint").groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    found = counts.orderBy(F.desc("n"), "shingle").limit(most).toPandas()
    common = found["shingle"].to_numpy(np.int64).view(np.uint64)
    by_hash = np.argsort(common)
    return common[by_hash], (len(common) - np.arange(len(common)))[by_hash]


def measured(texts: DataFrame, words: int, similarity: float, seed: int, sample_rows: int) -> DataFrame:
    """doc_id, key, node, twin (a second hash of the set), fp, size, the maps and the prefix's keys of each row."""
    common, ranks = common_shingles(texts, words, seed, sample_rows)

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                hashes = [shingle_hashes(t, words, seed) for t in part.column(2).to_pylist()]
                sets = [np.unique(x) for x in hashes]
                bytes_of = [x.tobytes() for x in sets]
                nodes, twins = (np.array([xxhash.xxh64_intdigest(x, s) for x in bytes_of], np.uint64).view(np.int64) for s in (seed, seed + 1))
                prints = np.array([fingerprint(x) for x in hashes], np.uint64).view(np.int64)
                wide = [parity_map(x) for x in sets]
                maps = np.array([folded(x) for x in wide]).reshape(-1, len(MAPS))
                lists = pa.list_(pa.int64())
                columns = [
                    part.column(0), part.column(1), pa.array(nodes), pa.array(twins), pa.array(prints), pa.array([len(x) for x in sets], pa.int64()), *(pa.array(np.ascontiguousarray(maps[:, k])) for k in range(len(MAPS))),
                    pa.array(wide, lists), pa.array([prefix(x, common, ranks, similarity).view(np.int64) for x in sets], lists),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "node", "twin", "fp", "size", *MAPS, "wide", "keys"])

    schema = "doc_id bigint, key string, node bigint, twin bigint, fp bigint, size bigint, " + ", ".join(f"{m} bigint" for m in MAPS) + ", wide array<bigint>, keys array<bigint>"
    return written(texts.select("doc_id", text_key(F.col("text")).alias("key"), "text").mapInArrow(run, schema), "near-rows")


class Checker:
    """Checks pairs of nodes: by wide maps, then by the sets, which are made anew from one text of each node that is left."""

    def __init__(self, texts: DataFrame, nodes: DataFrame, words: int, similarity: float, seed: int):
        self.texts, self.nodes, self.words, self.similarity, self.seed = texts, nodes, words, similarity, seed

    def sets(self, ids: DataFrame) -> DataFrame:
        """(node, shingles) of the nodes in ``ids``."""
        words, seed = self.words, self.seed

        def run(batches):
            for batch in batches:
                for lo in range(0, batch.num_rows, 64):
                    part = batch.slice(lo, 64)
                    found = [shingle_set(t, words, seed).view(np.int64) for t in part.column(1).to_pylist()]
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(pa.int64()))], names=["node", "shingles"])

        wanted = written(self.nodes.join(ids, "node", "left_semi").select("node", F.col("key").alias("digest")), "near-wanted")
        probe = Filter(wanted.select("digest"), wanted.count()).probe(self.texts.select(text_key(F.col("text")).alias("digest"), "text")).filter("maybe")
        texts = probe.select("digest", "text").join(wanted, "digest").groupBy("node").agg(F.min("text").alias("text"))
        return written(texts.mapInArrow(run, "node bigint, shingles array<bigint>"), "near-sets")

    def check(self, pairs: DataFrame) -> DataFrame:
        """Those of distinct (u, v) that reach the similarity."""
        side = lambda name: self.nodes.select(F.col("node").alias(name), F.col("size").alias(f"size_{name}"), F.col("wide").alias(f"wide_{name}"))
        met = pairs.join(side("u"), "u").join(side("v"), "v")
        met = met.filter(close(wide_apart(F.col("wide_u"), F.col("wide_v")), F.col("size_u"), F.col("size_v"), self.similarity))
        left = written(met.select("u", "v"), "near-pairs")
        sets = self.sets(left.select(F.col("u").alias("node")).unionByName(left.select(F.col("v").alias("node"))).distinct())
        both = left.join(sets.toDF("u", "set_u"), "u").join(sets.toDF("v", "set_v"), "v").withColumn("both", F.size(F.array_intersect("set_u", "set_v")))
        enough = F.col("both") >= self.similarity * (F.size("set_u") + F.size("set_v") - F.col("both")) - ROUNDING
        return written(both.filter(enough).select("u", "v"), "near-links")


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).filter("u <> v").distinct()


def first_pairs(nodes: DataFrame, keyed: DataFrame, similarity: float, within: int) -> DataFrame:
    """(u, v): links of fingerprints, and each node with the leaders of its size class: under its first keys one drawn, under all the hub."""
    prints = written(nodes.groupBy("fp").agg(F.min("node").alias("node")), "near-prints")
    links = fingerprint_links(prints.select("fp"), within)
    near = links.join(prints.toDF("a", "u"), "a").join(prints.toDF("b", "v"), "b").select("u", "v")
    same = nodes.join(prints.withColumnRenamed("node", "v"), "fp").select(F.col("node").alias("u"), "v")
    rows = keyed.withColumn("class", size_class(F.col("size"), similarity)).withColumn("draw", F.xxhash64("key", "node"))
    own = F.struct("node", "size", *MAPS)
    led = []
    for some, best in ((rows.filter(F.col("nth") <= FIRST_KEYS), "draw"), (rows, "shares")):
        leaders = some.groupBy("key", "class").agg(F.max_by(own, F.struct(best, "node")).alias("x"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("key", "class", "x")
        met = some.select("key", "class", own.alias("y")).join(leaders, ["key", "class"]).filter(possible("x", "y", similarity))
        led.append(met.select(F.col("x.node").alias("u"), F.col("y.node").alias("v")))
    return ordered(near.unionByName(same).unionByName(led[0]).unionByName(led[1]))


def open_pairs(keyed: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """(u, v): nodes of different components that share a key and may reach the similarity."""
    rows = keyed.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rows = written(rows.select("key", "root", size_class(F.col("size"), similarity).alias("class"), F.struct("node", "root", "size", "place", *MAPS).alias("x")), "near-open")
    parts = rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    main = parts.groupBy("key").agg(F.max(F.struct("n", "root")).alias("main"), F.count(F.lit(1)).alias("parts")).filter("parts > 1").select("key", F.col("main.root").alias("main"))
    some = written(rows.join(main, "key"), "near-some")
    strays = some.filter("root <> main").select("key", F.explode(F.array(F.col("class") - 1, F.col("class"), F.col("class") + 1)).alias("class"), F.col("x").alias("y"))
    met = strays.join(some.select("key", "class", "x", (F.col("root") == F.col("main")).alias("in_main")), ["key", "class"])
    return ordered(met.filter(F.col("in_main") | (F.col("x.node") > F.col("y.node"))).filter("x.root <> y.root").filter(in_place("x", "y", similarity)).filter(possible("x", "y", similarity)).select(F.col("x.node").alias("u"), F.col("y.node").alias("v")))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8, within: int = 3, seed: int = 42, sample_rows: int = 10_000) -> DataFrame:
    """doc_id, key, component_id, kept of each row with a near copy: the least doc_id reachable over pairs of the similarity or more.

    key is the SHA-256 of the text; kept marks the row of a component with the least (doc_id, key), null ids last; a row
    that repeats it is marked as well. Words are split at white space, A-Z lowered; a text of fewer words than a shingle is one
    shingle. Texts of equal sets (wordless ones and nulls too) are copies. A null id is kept and never chosen as
    component_id unless its whole component has none. An empty table gives no rows. Other columns are ignored. Sets whose
    64-bit hashes collide, which a second hash shows, are an error rather than a false link.
    """
    texts = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].alias("text"))
    rows = measured(texts, words, similarity, seed, sample_rows)
    collision = F.assert_true(F.min("twin") == F.max("twin"), F.lit("two sets of shingles share a hash: choose another seed"))
    rest = F.struct("key", "fp", "size", *MAPS, "wide", "keys")
    nodes = rows.groupBy("node").agg(F.min_by(rest, "key").alias("r"), F.count(F.lit(1)).alias("copies"), collision.alias("ok"))
    nodes = written(nodes.filter("ok IS NULL").select("node", "copies", "r.*"), "near-nodes")
    keys = nodes.select("node", F.posexplode("keys").alias("place", "key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    keyed = keys.join(shared, "key").join(nodes.select("node", "size", *MAPS), "node")
    own = Window.partitionBy("node")
    keyed = keyed.withColumns({"nth": F.row_number().over(own.orderBy("place")), "shares": F.count(F.lit(1)).over(own)})
    keyed = written(keyed.select("key", "place", "nth", "shares", "node", "size", *MAPS), "near-keys")
    checker = Checker(texts, nodes, words, similarity, seed)
    links = checker.check(first_pairs(nodes, keyed, similarity, within))
    roots = written(connected_components(links, "u", "v"), "near-first")
    more = checker.check(open_pairs(keyed, roots, similarity))
    roots = written(connected_components(links.unionByName(more), "u", "v"), "near-roots")
    classes = nodes.select("node", "copies").join(roots, "node", "left").filter("root IS NOT NULL OR copies > 1").select("node", F.coalesce("root", "node").alias("root"))
    members = written(rows.select("doc_id", "key", "node").join(classes, "node").select("doc_id", "key", "root"), "near-members")
    least = members.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("least"))
    kept = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("key") == F.col("least.key"))
    return members.join(least, "root").select("doc_id", "key", F.col("least.doc_id").alias("component_id"), kept.alias("kept"))


def without_near_copies(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` less all but one of each component of near copies, with all their columns; rows go one by one."""
    return staying(docs, near_copies(docs, **options).select("doc_id", "key", "kept"), text_key(F.col("text")))
