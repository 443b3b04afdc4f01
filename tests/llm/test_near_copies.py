import random

import numpy as np
from pyspark.sql import functions as F

from candlewright.llm import near_copies as module
from candlewright.llm.near_copies import near_copies, without_near_copies
from tests.llm.helpers import documents


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similar(a, b):
    return a == b or len(a & b) >= 0.8 * len(a | b)


def corpus():
    r = random.Random(7)
    line = " ".join(f"line{i}" for i in range(30))
    rows = []
    for i in range(40):
        base = [f"w{r.randrange(5000)}" for _ in range(r.randint(60, 160))]
        for _ in range(6):
            words = list(base)
            for _ in range(r.randint(0, 5)):
                words[r.randrange(len(words))] = f"x{r.randrange(5000)}"
            rows.append((len(rows) + 1, (line + " " if i % 2 else "") + " ".join(words), "en", "s"))
    return [*rows, (1001, None, "en", "s"), (1002, " ", "en", "s"), (1003, "few words", "en", "s"), (1004, "Few  Words", "en", "s"), (1005, "alone", "en", "s")]


def test_components_match_all_pairs(spark):
    rows = corpus()
    sets = {d: shingles(t) for d, t, *_ in rows}
    least = {d: d for d in sets}
    for a in sets:
        for b in sets:
            if a < b and similar(sets[a], sets[b]):
                old, new = max(least[a], least[b]), min(least[a], least[b])
                least = {d: new if x == old else x for d, x in least.items()}
    want = {d: x for d, x in least.items() if list(least.values()).count(x) > 1}
    got = {x.doc_id: x.component_id for x in near_copies(documents(spark, rows)).collect()}
    assert got == want
    assert 20 < len(want) < len(rows)
    assert near_copies(documents(spark, rows).limit(0)).count() == 0


def test_no_near_copies_stay_and_rows_go_one_by_one(spark):
    rows = corpus() + [(1, "another text under an id that is taken", "en", "s"), (1005, "alone", "en", "s"), (None, "nobody", "en", "s"), (None, "Nobody", "en", "s")]
    docs = documents(spark, rows)
    got = without_near_copies(docs)
    assert got.columns == docs.columns
    kept = [(x.doc_id, x.text) for x in got.collect()]
    sets = [shingles(t) for _, t in kept]
    assert not any(similar(a, b) for i, a in enumerate(sets) for b in sets[:i])
    assert (1, "another text under an id that is taken") in kept and kept.count((1005, "alone")) == 1
    assert sum(d is None for d, _ in kept) == 1 and (1001 in dict(kept)) and 1002 not in dict(kept)


def test_wide_maps_bound_the_difference_of_sets(spark):
    r = np.random.default_rng(2)
    rows = []
    for n in (3, 200, 256, 257, 700, 5000):
        a = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
        for b in (a, a[: -max(1, n // 10)], np.concatenate([a, r.integers(0, 2**63, n // 5).astype(np.uint64)])):
            rows.append((len(np.setxor1d(a, b)), module.parity_map(a).tolist(), module.parity_map(b).tolist(), module.folded(module.parity_map(a)).tolist() == module.parity_map(a)[:4].tolist()))
    df = spark.createDataFrame([x[:3] for x in rows], "differ int, a array<bigint>, b array<bigint>")
    got = df.select("differ", module.wide_apart(F.col("a"), F.col("b")).alias("apart")).collect()
    assert all(x.apart <= x.differ and (x.differ == 0) == (x.apart == 0) for x in got)


def test_one_large_group_of_distinct_near_copies(spark):
    r = random.Random(3)
    base = [f"w{r.randrange(9000)}" for _ in range(200)]
    rows = []
    for i in range(1500):
        words = list(base)
        for _ in range(r.randint(0, 4)):
            words[r.randrange(len(words))] = f"x{r.randrange(90000)}"
        rows.append((i, " ".join(words), "en", "s"))
    got = near_copies(documents(spark, rows)).collect()
    assert len(got) == 1500 and {x.component_id for x in got} == {0} and sum(x.kept for x in got) == 1


def test_edited_copies_that_are_too_far_from_each_other_are_hardly_paired(spark, monkeypatch):
    r = random.Random(5)
    base = [f"w{r.randrange(9000)}" for _ in range(400)]
    rows = [(0, " ".join(base), "en", "s")]
    for i in range(1, 400):
        words = list(base)
        for k in r.sample(range(400), r.randint(2, 20)):
            words[k] = f"x{r.randrange(900000)}"
        rows.append((i, " ".join(words), "en", "s"))
    made = []
    monkeypatch.setattr(module, "open_pairs", lambda *a, f=module.open_pairs: made.append(f(*a)) or made[0])
    got = {x.doc_id: x.component_id for x in near_copies(documents(spark, rows)).collect()}
    sets = [shingles(t) for _, t, *_ in rows]
    group, more = {0}, [0]
    while more:
        a = more.pop()
        met = {b for b in range(len(rows)) if b not in group and similar(sets[a], sets[b])}
        group |= met
        more += met
    assert got == dict.fromkeys(group, 0) and 100 < len(group) < 350
    assert made[0].count() < len(rows)
