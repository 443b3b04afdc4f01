import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from candlewright.llm import queries, simhash
from candlewright.llm.components import connected_components

SF = "/root/testdata/sf0.001"


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def find(parent, i):
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def slow_components(prints):
    """prints: doc_id -> fingerprint."""
    ids = sorted(prints)
    values = np.array([prints[i] for i in ids], np.uint64)
    parent = list(range(len(ids)))
    for i in range(len(ids)):
        for j in np.nonzero(np.bitwise_count(values[i] ^ values) <= 3)[0]:
            a, b = find(parent, i), find(parent, int(j))
            parent[max(a, b)] = min(a, b)
    return {d: ids[find(parent, i)] for i, d in enumerate(ids)}


def test_query_matches_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    prints = {i: slow_fingerprint(t) for i, t in texts.items()}
    want = slow_components(prints)
    got = queries.op3_simhash_near_dedup(spark, SF).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{prints[i]:016x}", want[i]) for i in texts}
    assert len(got) == len(texts)


def test_links_are_exact_over_many_shards_and_a_dense_ball(spark):
    rng = np.random.default_rng(7)
    base = rng.integers(0, 2**64, 1500, dtype=np.uint64)
    near = []
    for k in range(1500):
        x = int(base[0] if k < 1000 else base[rng.integers(len(base))])
        for _ in range(rng.integers(1, 5)):
            x ^= 1 << int(rng.integers(64))
        near.append(x)
    values = np.unique(np.concatenate([base, np.array(near, np.uint64)]))
    want = slow_components(dict(enumerate(values.tolist())))
    nodes = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp bigint")
    links = simhash.fingerprint_links(nodes, shard_rows=100, sample_rows=500)
    roots = {r.node: r.root for r in connected_components(links).collect()}
    groups = {}
    for i, v in enumerate(values.view(np.int64).tolist()):
        groups.setdefault(roots.get(v, v), set()).add(want[i])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want.values()))


def test_fingerprints_that_agree_on_a_half_are_cut_on_the_other():
    rng = np.random.default_rng(3)
    high = rng.integers(0, 2**32, 6000, dtype=np.uint64)
    high = np.concatenate([high, high[:900] ^ (np.uint64(1) << rng.integers(0, 32, 900, dtype=np.uint64))])
    values = np.unique((high << np.uint64(32)) | np.uint64(12345))
    top = simhash.grow(values, 0, 3, 12, 64)
    shards = simhash.shards_of(values, top)
    assert len(shards) > 8 and max(len(x) for _, x in shards) < len(values) // 2
    want = slow_components(dict(enumerate(values.tolist())))
    parent = list(range(len(values)))
    at = {int(v): i for i, v in enumerate(values)}
    for _, rows in shards:
        for u, v in zip(*simhash.shard_stars(values[rows], 0, 3)):
            a, b = find(parent, at[int(u)]), find(parent, at[int(v)])
            parent[max(a, b)] = min(a, b)
    assert all(find(parent, i) == want[i] for i in range(len(values)))


def test_edge_cases(spark):
    rows = [(5, None), (3, ""), (4, " \t\n"), (1, "One two"), (2, "one TWO"), (2, "one TWO"), (9, "É é one")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("fp", F.lit("clash"))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_components(docs).collect()}
    assert got[5] == got[3] == got[4] == ("0" * 16, 3)
    assert got[1] == got[2] == (f"{xxhash.xxh64_intdigest(b'one two', 42):016x}", 1)
    assert got[9][1] == 9 and simhash.simhash_components(docs).count() == 7
    assert simhash.simhash_components(docs.limit(0)).count() == 0


@pytest.mark.parametrize("size", [1, 2, 700])
def test_chain_components(spark, size):
    edges = spark.createDataFrame([(i, i + 1) for i in range(size)] + [(10_000, 10_000)], "a int, b int")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(size + 1)}
