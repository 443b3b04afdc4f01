import random
import re
from math import comb

import pytest
from pyspark.sql import functions as F

from candlewright.llm import quality
from tests.llm.helpers import ROWS, documents


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    at = {}
    for i in range(len(words) - 2):
        at.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {j for v in at.values() if len(v) > 1 for i in v for j in (i, i + 1, i + 2)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, len(covered)


def test_statistics_match_brute_force():
    r = random.Random(5)
    for _ in range(3000):
        text = "".join(r.choice("ab \n\t\x1c\xa0#x\x85") for _ in range(r.randint(0, 40)))
        assert quality.stats(text)[:5] == brute(text)


def test_binomial_bound_is_exact():
    for k, n, p in ((0, 10, 0.1), (3, 40, 0.05), (7, 20, 0.5)):
        assert quality.binomial_tail(k, n, p) == pytest.approx(sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)))
    assert quality.certified([0, 0, 2, 0], 1000, 0.01, 0.01) == 4  # P(X <= 2) is 0.003, P(X <= 3) 0.0101
    assert quality.certified([0, 0, 3, 0], 1000, 0.01, 0.01) == 2
    assert quality.certified([0, 5, 0], 1000, 0.01, 0.01) == 1  # a failed step ends the sequence
    assert quality.certified([0, 0], 100, 0.01, 0.01) == 0  # too few labels


def corpus(spark):
    r = random.Random(1)
    rows = [(i, " ".join(r.choice("abcdefgh") * 3 + str(r.randrange(99)) * (r.random() < 0.1) for _ in range(80)), ("en", "de", None)[i % 3], "s") for i in range(3000)]
    rows += [(10_000 + i, " ".join("w%d ###" % r.randrange(999) for _ in range(60)), ("en", "de", None)[i % 3], "s") for i in range(90)]
    rows += [(20_000 + i, "few words", "en", "s") for i in range(5)]
    rows += [(30_000 + i, " ".join("w%d ###" % r.randrange(999) for _ in range(60)), "xx", "s") for i in range(3)]
    labels = spark.createDataFrame([(d, int(d < 10_000), 0) for d, *_ in rows] + [(None, 1, 0), (99, None, None), (999_999, 1, 1)], "doc_id bigint, quality int, toxic int")
    return documents(spark, rows), labels


def test_cutoffs_remove_junk_and_keep_unknown_strata(spark):
    docs, labels = corpus(spark)
    kept = {r.doc_id: r.kept for r in quality.quality_rules(docs, labels).collect()}
    good = [k for d, k in kept.items() if d < 10_000]
    assert sum(good) >= 0.98 * len(good)
    assert not any(k for d, k in kept.items() if 10_000 <= d < 30_000)
    assert all(k for d, k in kept.items() if d >= 30_000)  # no labels in that language: nothing but the base rules
    filtered = quality.keep_good(docs, labels)
    assert filtered.columns == docs.columns
    assert {r.doc_id for r in filtered.collect()} == {d for d, k in kept.items() if k}


def test_strata_with_few_labels_reject_junk(spark):
    r = random.Random(2)
    rows = [(i, " ".join("word%d" % r.randrange(999) for _ in range(60)), "en" if i < 300 else "de", "s") for i in range(360)]
    junk = [(1000 + i, " ".join("w%d ##" % r.randrange(999) for _ in range(60)), ("en", "de")[i % 2], "s") for i in range(20)]
    labels = spark.createDataFrame([(d, 1, 0) for d, *_ in rows], "doc_id bigint, quality int, toxic int")
    docs = documents(spark, rows + junk)
    kept = {x.doc_id for x in quality.quality_rules(docs, labels).collect() if x.kept}
    assert kept == {d for d, *_ in rows}
    assert {x.doc_id for x in quality.keep_good(docs, labels).collect()} == kept


def test_pooled_steps_yield_to_own_labels():
    hits = {"en": {(8, 8): 400}, "de": {(8, 8): 30}, "fr": {(8, 8): 200}, "it": {(8, 8): 100}, "es": {(8, 8): 40, (3, 8): 1}}
    steps = quality.all_steps({s: quality.Counter(x) for s, x in hits.items()}, 0.02, 0.05)
    assert steps["en"] == steps["de"] == (8, 8)  # de: its 30 labels would certify nothing alone
    assert steps["es"] == (3, 0)  # one of its 41 good documents is more than 2 %
    assert quality.certified_steps(quality.Counter({(8, 8): 1000, (2, 8): 50}), 0.02, 0.05) == (2, 8)


def test_edges(spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = quality.quality_rules(documents(spark), labels)
    assert sorted(tuple(r)[:6] for r in got.fillna(-1).collect()) == sorted((d if d is not None else -1, *brute(t)) for d, t, *_ in ROWS)
    assert got.filter(F.col("kept") & F.col("base_failed")).isEmpty()
    assert quality.quality_rules(documents(spark).limit(0), labels).count() == 0
    assert quality.keep_good(documents(spark).limit(0), labels).count() == 0
