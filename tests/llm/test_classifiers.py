import math
import random
from collections import Counter
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from candlewright.llm import langid, queries, toxicity
from tests.llm.helpers import ROWS, documents, held

SF = "/root/testdata/sf0.1"


def test_held_out_rows(spark):
    df = spark.range(500).select("id", toxicity.held_out(F.col("id")).alias("h"))
    assert all(r.h == held(r.id) for r in df.collect())


def words(r, n):
    return " ".join("".join(r.choice(("th", "er", "on", "an", "re", "he", "in", "ed", "nd")) for _ in range(r.randint(1, 4))) for _ in range(n))


def insults(r, n, toxic):
    text = words(r, n).split()
    if toxic:
        stem = r.choice(("zquolb", "vrakmop"))
        text.insert(r.randrange(len(text)), stem + r.choice(("", "er", "ing", "ed")))
    return " ".join(text)


def test_toxic_words_are_found_gapped_and_whole(spark):
    r = random.Random(1)
    rows = [(i, insults(r, 40, i % 5 == 0), int(i % 5 == 0)) for i in range(800)]
    model = toxicity.train(rows)
    test = [("clean " + words(r, 30), 0) for _ in range(40)] + [(words(r, 20) + " zquolbre " + words(r, 9), 1), (words(r, 20) + " vrak.mop", 1), (words(r, 5) + " zqu-olb", 1), (words(r, 5) + " V R A K M O P " + words(r, 5), 1)]
    docs = documents(spark, [(i, t, "en", "s") for i, (t, _) in enumerate(test)] + ROWS[3:5])
    got = toxicity.toxicity(docs, model).collect()
    assert [r.predicted for r in sorted(got, key=lambda r: r.doc_id) if r.doc_id >= 40] == [1, 1, 1, 1]
    assert sum(r.predicted for r in got) <= 6 and all(0 <= r.score <= 1 for r in got)


def plain_features(word):
    """Gapped subsequences of three characters in a span of 6 and of four in a span of 7, by definition."""
    word, out = "^" + word + "$", Counter()
    for size, span in ((3, 6), (4, 7)):
        for places in combinations(range(len(word)), size):
            if places[-1] - places[0] < span:
                out["".join(word[i] for i in places), tuple(q - p for p, q in zip(places, places[1:]))] += 0.6 ** (places[-1] - places[0] + 1 - size)
    return out


def plain_kernel(a, b):
    """Occurrences count by their characters, whatever their gaps."""
    x, y = Counter(), Counter()
    for out, word in ((x, a), (y, b)):
        for (chars, _), v in plain_features(word).items():
            out[chars] += v
    norm = lambda w: math.sqrt(sum(v * v for v in occurrences(w)))
    return sum(v * y[k] for k, v in x.items()) / norm(a) / norm(b)


def occurrences(word):
    n = len(word) + 2
    for size, span in ((3, 6), (4, 7)):
        for places in combinations(range(n), size):
            if places[-1] - places[0] < span:
                yield 0.6 ** (places[-1] - places[0] + 1 - size)


def test_kernel_equals_a_plain_subsequence_kernel():
    words = ["stupid", "st-upid", "stup1d", "sstupid", "moron", "m.o.r.o.n", "clean", "cleaner", "ab"]
    got = toxicity.kernel(words, toxicity.explicit(words))
    want = np.array([[plain_kernel(a, b) for b in words] for a in words])
    apart = np.abs(got - want)  # zero but for features whose 15-bit hashes collide
    assert np.median(apart) < 1e-6 and (apart > 1e-4).mean() < 0.1 and apart.max() < 0.1
    assert want[0, 1] > 0.3 and want[0, 4] < 0.01


def test_collapsed_weights_equal_the_kernel_machine():
    marks = ["stupid", "moron", "clean"]
    at = toxicity.explicit(marks)
    alpha = np.array([1.5, 0.5, -1.0])
    some = ["stupid", "st-upid", "stup", "moronic", "cleaner", "x", ""]
    direct = toxicity.kernel(some, at) @ alpha
    assert np.allclose(toxicity.weigh(some, (alpha @ at).astype(np.float32), 0.0), direct, atol=1e-4)


def test_insults_of_two_words_are_found(spark):
    r = random.Random(5)
    rows = []
    for i in range(900):
        text = words(r, 30).split()
        if i % 5 == 0:  # both words come in clean texts too, apart
            text[10:10] = ["vile", "worm"]
        elif i % 5 < 3:
            text.insert(4, "vile")
            text.insert(20, "worm")
        rows.append((i, " ".join(text), int(i % 5 == 0)))
    model = toxicity.train(rows)
    assert {"vile", "worm"} <= model["phrase_words"]
    test = [words(r, 9) + " vile worm " + words(r, 9), words(r, 9) + " vile. Worm " + words(r, 9), words(r, 9) + " vile " + words(r, 9)]
    got = {x.doc_id: x.predicted for x in toxicity.toxicity(documents(spark, [(i, t, "en", "s") for i, t in enumerate(test)]), model).collect()}
    assert got == {0: 1, 1: 0, 2: 0}


def test_toxic_documents_that_are_held_out(spark):
    got = queries.op5_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic"), "doc_id").filter("held_out")
    n = {(r.toxic, r.predicted): r["count"] for r in got.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] >= 0.9 * (n[1, 1] + n.get((1, 0), 0))
    assert n.get((0, 1), 0) <= 0.02 * (n[0, 0] + n.get((0, 1), 0))
    print(n)


def test_toxicity_edges(spark):
    model = toxicity.train([])
    got = toxicity.toxicity(documents(spark), model)
    assert got.count() == len(ROWS) and got.filter("score NOT BETWEEN 0 AND 1 OR predicted <> 0").isEmpty()
    assert got.filter("doc_id IS NULL AND held_out").isEmpty()
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert toxicity.toxicity(documents(spark).limit(0), toxicity.fit(documents(spark).limit(0), labels)).count() == 0


def test_languages_of_held_out_documents(spark):
    got = queries.op9_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    r = got.filter("held_out AND lang IS NOT NULL AND lang_pred <> 'und'").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.expr("lang = lang_pred")).alias("same")).first()
    assert r.n > 1000 and r.same >= 0.98 * r.n
    assert got.filter("score NOT BETWEEN 0 AND 1").isEmpty()


LANGS = {"a": Counter({"abab": 3, "ba": 2, "abc": 1, "cab": 2, "a" * 300: 1}), "b": Counter({"cc": 4, "acb": 2, "bcc": 1, "ccbcbca": 1})}


def plain_kneser_ney(words, letters):
    """p(c, h) of interpolated Kneser-Ney from plain dictionaries: raw counts at the top order and at the start of words."""
    grams = [Counter() for _ in range(5)]
    left = [{} for _ in range(5)]
    for word, n in words.items():
        word = "^" + word + "$"
        for end in range(2, len(word) + 1):
            for k in range(1, min(4, end) + 1):
                gram = word[end - k : end]
                if k == 4 or end == k:
                    grams[k][gram] += n
                else:
                    left[k].setdefault(gram, set()).add(word[end - k - 1])
    for k in (1, 2, 3):
        grams[k].update({g: len(x) for g, x in left[k].items()})
    discount = {}
    for k in range(1, 5):
        ones, twos = (sum(v == i for v in grams[k].values()) for i in (1, 2))
        discount[k] = ones / (ones + 2 * twos) if ones and twos else 0.5

    def p(c, h):
        lower = p(c, h[1:]) if h else 1 / (letters + 1)
        k = len(h) + 1
        after = {g: v for g, v in grams[k].items() if g[:-1] == h}
        if not after:
            return lower
        total = sum(after.values())
        return max(grams[k][h + c] - discount[k], 0) / total + discount[k] * len(after) / total * lower

    return p


def test_probabilities_equal_those_of_plain_kneser_ney_and_sum_to_one():
    model = langid.train(LANGS)
    plain = [plain_kneser_ney(LANGS[x], 4) for x in model["langs"]]
    for context in ("", "x", "ab", "ba", "zz", "abab", "ccb", "bcc", "aaaa"):
        before, total = sum_until(model, context), 0.0
        for last in "abc$?":  # "?" stands for all that was never seen
            got = np.exp(before - sum_until(model, context + last))
            want = np.array([p(last, ("^" + context)[-3:]) for p in plain])
            assert np.allclose(got, want, rtol=1e-4), (context, last)
            total = total + got
        assert np.allclose(total, 1, atol=1e-4)


def test_languages_equal_the_brute_force_choice(spark):
    r = random.Random(8)
    model = langid.train(LANGS)
    plain = [plain_kneser_ney(LANGS[x], 4) for x in model["langs"]]
    texts = [" ".join("".join(r.choice("abc") for _ in range(r.randint(1, 9))) for _ in range(r.randint(1, 6))) for _ in range(60)] + ["abc" * 40 + " cc"]
    cost = lambda p, w: -sum(math.log(p(w[i], w[max(0, i - 3) : i])) for i in range(1, len(w)))
    want = {i: model["langs"][min(range(2), key=lambda k: sum(cost(plain[k], f"^{w}$") for w in t.split()))] for i, t in enumerate(texts)}
    got = {x.doc_id: x.lang_pred for x in langid.language(documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]), model).collect()}
    assert got == want


def test_rare_languages_are_learned(spark):
    rows = [(i, "the cat and the dog ran over the hill " * 3, "en", "s") for i in range(400)] + [(1001 + i, "zyx wvu zyx qqq wvu " * 4, f"rare{i}", "s") for i in range(300) if not held(1001 + i)]
    model = langid.fit(documents(spark, rows))
    assert len(model["langs"]) == 1 + len({x[2] for x in rows if x[2] != "en"})


def sum_until(model, prefix):
    """Cost of the characters of a word's beginning: that of the word with every end, less the end."""
    codes = np.frombuffer(("^" + prefix).encode("utf-32-le"), np.uint32).reshape(1, -1)
    size = len(prefix) + 1
    row, col = np.zeros(size - 1, int), np.arange(1, size)
    log = np.tile(model["base"], (len(row), 1))
    for n, (keys, values, contexts, weights) in enumerate(model["levels"], 1):
        use = np.nonzero(col >= n - 1)[0]
        if not len(use) or codes.shape[1] < n:
            continue
        at, there = langid.find(keys, langid.hashes(codes, n)[row[use], col[use] - n + 1])
        if n > 1:
            has, known = langid.find(contexts, langid.hashes(codes, n - 1)[row[use], col[use] - n + 1])
            log[use] += np.where(known[:, None], weights[has], 0)
        log[use[there]] = values[at[there]]
    return -log.sum(axis=0)


def test_language_edges(spark):
    got = {r.doc_id: r for r in langid.language(documents(spark), langid.fit(documents(spark))).collect()}
    assert got[3].lang_pred == got[4].lang_pred == got[7].lang_pred == "und" and got[3].score == 0
    assert got[5].lang_pred in ("en", "fr", "de") and not got[None].held_out
    assert langid.language(documents(spark).limit(0), langid.fit(documents(spark).limit(0))).count() == 0
    assert all(r.lang_pred == "und" for r in langid.language(documents(spark), None).collect())
