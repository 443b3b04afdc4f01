"""SimHash fingerprints, and exact links between them by sharded vantage-point trees.

Two 64-bit fingerprints that differ in at most r bits differ in at most r // 2 bits on one half. So there is a
vantage-point tree for each half, with the Hamming distance on that half as metric and r // 2 as radius; distances on
32 bits cross a boundary far less often than on 64. A node holds a vantage point and a boundary t: fingerprints at
distance <= t go left, the others right, and by the triangle inequality only those at distance <= t + radius can have a
partner on the left, so just these are copied there as well. Hence any linked pair meets in some leaf, where the full
64-bit distance decides.

The top of each tree is fitted on a bounded sample of fingerprints and cuts all of them into shards of about
``shard_rows``; each shard grows its own subtree in one task. Where no cut on its half helps, as among fingerprints that agree
there, a node is cut by the other half, on which linked pairs differ in up to r bits. A leaf reports a spanning star of each of its groups, never
all pairs, and components of these stars give the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .common import written

HALVES = (0, 32)
LOW = np.uint64(0xFFFFFFFF)
LEAF = 384


def shingle_hashes(text: str | None, words: int, seed: int) -> np.ndarray:
    """XXH64 of each run of ``words`` words of the text with A-Z lowered."""
    found = (text or "").encode().lower().split()  # bytes: lowers A-Z and splits at 20, 09-0D only
    if not found:
        return np.empty(0, np.uint64)
    line, k = b" ".join(found), min(words, len(found))
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(found) - k + 1].tolist(), ends[k - 1 :].tolist())
    return np.fromiter((digest(line[i:j], seed) for i, j in spans), np.uint64, len(found) - k + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is 1 if over half of the hashes have it; no hashes give zero."""
    counts = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 8192):
        part = hashes[lo : lo + 8192].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.add.reduce(np.unpackbits(part, axis=1), axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp) for each row; fp is the fingerprint as a signed bigint."""

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                values = np.array([fingerprint(shingle_hashes(t, words, seed)) for t in part.column(1).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(values.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, "doc_id bigint, fp bigint")


def distance(values: np.ndarray, vantage, shift: int) -> np.ndarray:
    return np.bitwise_count(((values ^ vantage) >> np.uint64(shift)) & LOW)


def choose(values: np.ndarray, shift: int, radius: int, tries: int = 5) -> tuple[np.uint64, int] | None:
    """The vantage point and boundary, of a few tried, whose larger side is smallest; None if no cut helps."""
    best = None
    probe = values if len(values) <= 4096 else values[:: len(values) // 4096]
    for k in range(tries):
        vantage = probe[(2 * k + 1) * len(probe) // (2 * tries)]
        sizes = np.cumsum(np.bincount(distance(probe, vantage, shift), minlength=33 + radius))
        left, right = sizes[radius:33 + radius], sizes[-1] - sizes[:33]
        worst = np.maximum(left, right)
        t = int(np.argmin(worst))
        if best is None or worst[t] < best[0]:
            best = (worst[t], vantage, t)
    return None if best is None or best[0] > 0.9 * len(probe) else best[1:]


def choose_half(values: np.ndarray, shift: int, within: int) -> tuple[int, int, int, int] | None:
    """(vantage point, boundary, shift, radius) of a cut on this half, or else on the other one."""
    for half, radius in ((shift, within // 2), (HALVES[0] + HALVES[1] - shift, within)):
        cut = choose(values, half, radius)
        if cut is not None:
            return int(cut[0]), cut[1], half, radius
    return None


def sides_of(values: np.ndarray, cut: tuple[int, int, int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Which values go left, and which right."""
    vantage, boundary, shift, radius = cut
    d = distance(values, np.uint64(vantage), shift)
    return d <= boundary + radius, d > boundary


def grow(sample: np.ndarray, shift: int, within: int, depth: int, fewest: int) -> tuple | None:
    """The top of a tree: nested (cut, left, right), None for a leaf."""
    cut = choose_half(sample, shift, within) if depth and len(sample) > fewest else None
    if cut is None:
        return None
    left, right = (grow(sample[x], shift, within, depth - 1, fewest) for x in sides_of(sample, cut))
    return cut, left, right


def shards_of(values: np.ndarray, node: tuple | None, name: str = "") -> list[tuple[str, np.ndarray]]:
    """(shard, indices of the values that belong to it or to its boundary)."""
    out, stack = [], [(node, np.arange(len(values)), name)]
    while stack:
        node, at, name = stack.pop()
        if not len(at):
            continue
        if node is None:
            out.append((name, at))
            continue
        left, right = sides_of(values[at], node[0])
        stack += [(node[1], at[left], name + "l"), (node[2], at[right], name + "r")]
    return out


def leaf_stars(values: np.ndarray, within: int) -> list[tuple[np.uint64, np.ndarray]]:
    """(least member, the others) of each group of over one in a leaf.

    Reached values leave the search, so a dense ball takes few passes even if no boundary cuts it.
    """
    out, left = [], values
    if len(values) <= 2 * LEAF:
        near = np.bitwise_count(values[:, None] ^ values[None, :]) <= within
        linked = near.sum(axis=1) > 1
        if not linked.any():
            return out
        left = values[linked]
    while len(left) > 1:
        group, front, left = [left[:1]], left[:1], left[1:]
        while len(front) and len(left):
            hit = np.zeros(len(left), bool)
            step = max(1, 2_000_000 // len(left))
            for lo in range(0, len(front), step):
                hit |= (np.bitwise_count(front[lo : lo + step, None] ^ left[None, :]) <= within).any(axis=0)
            front, left = left[hit], left[~hit]
            group.append(front)
        members = np.sort(np.concatenate(group))
        if len(members) > 1:
            out.append((members[0], members[1:]))
    return out


def shard_stars(values: np.ndarray, shift: int, within: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (root, member) that connect all values of a shard that are linked within it."""
    roots, members, stack = [], [], [values]
    while stack:
        part = stack.pop()
        cut = choose_half(part, shift, within) if len(part) > LEAF else None
        if cut is not None:
            left, right = sides_of(part, cut)
            stack += [part[left], part[right]]
            continue
        for root, others in leaf_stars(part, within):
            roots.append(np.full(len(others), root))
            members.append(others)
    empty = np.empty(0, np.uint64)
    return np.concatenate(roots or [empty]), np.concatenate(members or [empty])


def fingerprint_links(nodes: DataFrame, within: int = 3, shard_rows: int = 4096, sample_rows: int = 32_768, most_depth: int = 16) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) at ``within`` bits or fewer; their components are exact.

    The sample for the tops of the trees is the ``sample_rows`` fingerprints of least hash, or eight for each shard if that
    is more; all fingerprints are indexed. No fingerprints give no edges. There are 2^``most_depth`` shards or so at most, each
    of which then grows: of 10^12 fingerprints a shard has some 10^8 bytes.
    """
    n = nodes.count()
    depth = min(most_depth, max(0, int(np.ceil(np.log2(max(1, n / shard_rows))))))
    picked = nodes.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(max(sample_rows, 8 << depth)).toPandas()["fp"].to_numpy(np.int64).view(np.uint64)
    tops = [grow(picked, shift, within, 2 * depth, max(1, len(picked) >> depth)) for shift in HALVES]

    def deal(batches):
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for shift, top in zip(HALVES, tops):
                for name, at in shards_of(values, top):
                    yield pa.RecordBatch.from_arrays([pa.array([f"{shift}{name}"] * len(at)), pa.array(values[at].view(np.int64))], names=["shard", "fp"])

    def search(key, table):
        values = table.column("fp").combine_chunks().to_numpy(zero_copy_only=False).view(np.uint64)
        shift = 32 if key[0].as_py().startswith("32") else 0
        a, b = shard_stars(values, shift, within)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    dealt = nodes.select("fp").mapInArrow(deal, "shard string, fp bigint")
    return dealt.groupBy("shard").applyInArrow(search, "a bigint, b bigint")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, within: int = 3, **sizes) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the least doc_id reachable over links of ``within`` bits.

    A null or wordless text has fingerprint zero and is linked like any other. A repeated row gives its row again. A null id
    is kept and never chosen as component_id unless its whole component has none. An empty table gives no rows. Other
    columns are ignored.
    """
    prints = written(fingerprints(docs, id_col, text_col, words), "fingerprints")
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = connected_components(fingerprint_links(nodes, within, **sizes))
    linked = written(roots.withColumnRenamed("node", "fp").join(nodes, "fp"), "linked")
    least = written(linked.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    named = written(linked.join(least, "root").select("fp", "component_id"), "named")
    classes = written(nodes.join(named, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id")), "classes")
    return prints.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
