import hashlib
import random

import pytest
from pyspark.sql import functions as F

from candlewright.llm import exact_dedup as module
from candlewright.llm.exact_dedup import DigestIndex, Filter, exact_dedup, without_copies
from tests.llm.helpers import ROWS, documents

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, largest=True, earlier=()):
    groups = {}
    for d, t, *_ in [*rows, *earlier]:
        groups.setdefault((t or "").translate(LOWER), []).append(d)
    out = []
    for d, t, *_ in rows:
        key = (t or "").translate(LOWER)
        ids = [x for x in groups[key] if x is not None]
        keep = (max if largest else min)(ids) if ids else None
        out.append((d, keep, len(groups[key]), d == keep, hashlib.sha256(key.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


WEAK = {"none": None, "two digests": lambda text: F.pmod(F.length(text), F.lit(2)).cast("string"), "one digest": lambda text: F.lit("same")}


@pytest.mark.parametrize("largest", [True, False])
@pytest.mark.parametrize("weak", WEAK)
def test_matches_brute_force_also_with_collisions(spark, largest, weak):
    more = {"digest": WEAK[weak]} if WEAK[weak] else {}
    got = exact_dedup(documents(spark), keep="largest" if largest else "smallest", hits_per_salt=2, memtable_rows=3, **more)
    assert found(got) == brute(ROWS, largest)


def test_one_large_group(spark):
    rows = [(i, "Same TEXT" if i % 3 else f"own {i}", "en", "a") for i in range(3000)]
    assert found(exact_dedup(documents(spark, rows), hits_per_salt=64, memtable_rows=500)) == brute(rows)


def batch(r, lo, n):
    return [(lo + i, f"Text {r.randint(0, 60)}" if r.random() < 0.5 else f"own {lo + i}", "en", "a") for i in range(n)]


@pytest.mark.parametrize("weak", [None, "two digests"])
def test_later_batches_meet_the_levels_of_earlier_ones(spark, weak):
    r, more = random.Random(4), {"digest": WEAK[weak]} if weak else {}
    index, before, levels = DigestIndex(memtable_rows=50, growth=2), [], []
    for lo, n in ((0, 400), (1000, 40), (2000, 5), (3000, 200)):
        rows = batch(r, lo, n) + ([(None, None, None, None)] if lo == 2000 else [])
        earlier = documents(spark, before) if before else None
        got = exact_dedup(documents(spark, rows), hits_per_salt=8, index=index, earlier=earlier, **more)
        assert found(got) == brute(rows, earlier=before)
        before += rows
        levels.append(len(index.levels))
    if not weak:
        assert levels == [1, 2, 3, 1]  # small batches get levels of their own, a large one takes those before it


def test_filters_miss_nothing_and_pass_little(spark, monkeypatch):
    inside = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    outside = spark.range(5000, 25000).select(F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    f = Filter(inside, 5000)
    assert f.probe(inside).filter("NOT maybe").isEmpty()
    assert f.probe(outside).filter("maybe").count() < 400
    monkeypatch.setattr(module, "MOST_BLOCKS", 10)
    assert f.probe(outside).filter("maybe").count() == 20000
    assert found(exact_dedup(documents(spark))) == brute(ROWS)


def test_copies_go_row_by_row(spark):
    rows = [(1, "alpha text", "en", "a"), (1, "unique text", "en", "b"), (9, "ALPHA text", "en", "c"), (None, "x", "en", "d"), (None, "X", "en", "e"), (4, "q", "en", "f"), (4, "q", "en", "f"), (4, "Q", None, "g"), (5, None, None, None), (6, "", None, None)]
    docs = documents(spark, rows)
    got = without_copies(docs)
    assert got.columns == docs.columns
    kept = [(r.doc_id, (r.text or "").lower()) for r in got.collect()]
    assert sorted(kept, key=str) == sorted([(1, "unique text"), (9, "alpha text"), (None, "x"), (4, "q"), (6, "")], key=str)
    assert without_copies(docs.limit(0)).count() == 0


def test_empty(spark):
    assert exact_dedup(documents(spark).limit(0)).count() == 0
