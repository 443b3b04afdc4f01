"""Language identification by interpolated Kneser-Ney character models.

One model per language over the letters of words ("^word$", lower-cased), orders 1 to ``ORDER``. Highest-order counts are
raw, lower-order counts are continuation counts, each order discounts D = n1 / (n1 + 2 n2) and interpolates with the one
below; the lowest interpolates with a uniform distribution. An order's n-grams of all languages lie in one sorted array of
64-bit hashes with a matrix of log probabilities beside it (interpolated for every language, so one binary search serves all
of them), and its contexts in another with their back-off weights.

A text's language is that of lowest cross-entropy per character. The score is the probability, by a logistic regression on
documents kept from training, that this language is right given the margin to the second best. ``rejected`` marks texts
whose cross-entropy is above what all but ``reject`` of the kept documents of that language have, or whose score is below 0.5.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .toxicity import held_out, platt

ORDER, WIDTH = 4, 26
UNKNOWN = "und"

_letters = re.compile(r"[^\W\d_]+").findall
_letter = regex.compile(r"\p{L}").search


def pieces(word: str) -> list[str]:
    """A word with its edges; a very long one in pieces that overlap by a context, so that all its letters count once."""
    word = "^" + word + "$"
    return [word[lo : lo + WIDTH] for lo in range(0, max(1, len(word) - ORDER + 1), WIDTH - ORDER + 1)]


def hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n characters up to and including each position from n - 1 on."""
    wide = codes.shape[1] - n + 1
    h = np.full((codes.shape[0], wide), n, np.uint64)
    for k in range(n):
        h = (h ^ codes[:, k : k + wide].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def coded(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(w.ljust(WIDTH, "\0") for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, WIDTH)


def hash_of(gram: str) -> int:
    return int(hashes(np.array([[ord(c) for c in gram]], np.uint32), len(gram))[0, 0])


def counts_of(words: Counter) -> list[dict[str, float]]:
    """Kneser-Ney counts by order: raw at the top and at the start of words, numbers of left neighbours below."""
    raw: dict[str, float] = Counter()
    starts: list[Counter] = [Counter() for _ in range(ORDER)]
    left: list[dict[str, set]] = [defaultdict(set) for _ in range(ORDER)]
    for word, n in words.items():
        word = "^" + word + "$"
        for end in range(2, len(word) + 1):
            if end >= ORDER:
                raw[word[end - ORDER : end]] += n
            for k in range(1, min(ORDER, end)):
                gram = word[end - k : end]
                left[k - 1][gram].add(word[end - k - 1])
            if end < ORDER:
                starts[end - 1][word[:end]] += n
    out = [{g: float(len(s)) for g, s in level.items()} | dict(begun) for level, begun in zip(left[: ORDER - 1], starts)]
    return [*out, dict(raw)]


def train(words: dict[str, Counter]) -> dict:
    """The joint model of several languages from their word counts."""
    langs = sorted(words)
    tables = [counts_of(words[x]) for x in langs]
    alphabet = {c for x in langs for w in words[x] for c in w} | {"$"}
    levels, below = [], {"": np.full(len(langs), 1 / (len(alphabet) + 1))}
    for n in range(1, ORDER + 1):
        grams = sorted(set().union(*(t[n - 1] for t in tables)))
        contexts = sorted({g[:-1] for g in grams})
        back = {h: np.ones(len(langs)) for h in contexts}
        total = {h: np.zeros(len(langs)) for h in contexts}
        discounts = []
        for l, t in enumerate(tables):
            ones = sum(1 for v in t[n - 1].values() if v == 1)
            twos = sum(1 for v in t[n - 1].values() if v == 2)
            d = ones / (ones + 2 * twos) if ones and twos else 0.5
            discounts.append(d)
            kinds = Counter()
            for g, v in t[n - 1].items():
                total[g[:-1]][l] += v
                kinds[g[:-1]] += 1
            for h, k in kinds.items():
                back[h][l] = d * k / total[h][l]
        here = {}
        for g in grams:
            h = g[:-1]
            c = np.array([t[n - 1].get(g, 0.0) for t in tables])
            lower = below.get(g[1:])
            if lower is None:
                lower = below_of(g[1:], levels_back)
            here[g] = np.maximum(c - np.array(discounts), 0) / np.maximum(total[h], 1) + back[h] * lower
        levels_back = (here, back) if n == 1 else (levels_back[0] | here, levels_back[1] | back)
        pairs = sorted((hash_of(g), p) for g, p in here.items())
        weights = sorted((hash_of(h) if h else 0, b) for h, b in back.items())
        levels.append((np.array([x for x, _ in pairs], np.uint64), np.log(np.array([p for _, p in pairs])).astype(np.float32), np.array([x for x, _ in weights], np.uint64), np.log(np.array([b for _, b in weights])).astype(np.float32)))
        below = here
    base = np.log(levels_back[1][""] / (len(alphabet) + 1)).astype(np.float32)
    return {"langs": langs, "levels": levels, "base": base, "a": 4.0, "b": 0.0, "most": np.full(len(langs), np.inf)}


def below_of(gram: str, known: tuple[dict, dict]) -> np.ndarray:
    """Probability of the last character of a gram that was not seen at its own order."""
    grams, back = known
    if gram in grams:
        return grams[gram]
    one = np.ones_like(next(iter(grams.values())))
    if not gram:
        return one / max(1, len([g for g in grams if len(g) == 1]) + 1)
    return back.get(gram[:-1], one) * below_of(gram[1:], known)


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
    return at, (keys[at] == wanted) if len(keys) else np.zeros(wanted.shape, bool)


def entropies(words: list[str], model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Total negative log probability of each word under each language, and its predicted characters."""
    parts = [(i, k, p) for i, w in enumerate(words) for k, p in enumerate(pieces(w))]
    owner, first = np.array([i for i, _, _ in parts]), np.array([k == 0 for _, k, _ in parts])
    codes = coded([p for _, _, p in parts])
    size = (codes != 0).sum(axis=1)
    # the first piece predicts from its second character on, the others behind the context they repeat
    skip = np.where(first, 1, ORDER - 1)
    place = np.arange(WIDTH)[None, :]
    row, col = np.nonzero((place >= skip[:, None]) & (place < size[:, None]))
    log = np.tile(model["base"], (len(row), 1))
    for n, (keys, values, contexts, weights) in enumerate(model["levels"], 1):
        use = np.nonzero(col >= n - 1)[0]
        at, there = find(keys, hashes(codes, n)[row[use], col[use] - n + 1])
        if n > 1:
            has, known = find(contexts, hashes(codes, n - 1)[row[use], col[use] - n + 1])
            log[use] += np.where(known[:, None], weights[has], 0)
        log[use[there]] = values[at[there]]
    out = np.zeros((len(words), len(model["langs"])))
    np.add.at(out, owner[row], -log)
    return out, np.bincount(owner[row], minlength=len(words))


def totals(texts: list[str | None], model: dict, memo: dict, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Summed over each text's words. ``memo`` keeps words' values and is emptied when it is full."""
    bags = [Counter(_letters((t or "").lower())) for t in texts]
    if len(memo) > most:
        memo.clear()
    new = sorted(set().union(*bags).difference(memo)) if bags else []
    for lo in range(0, len(new), 8192):
        part = new[lo : lo + 8192]
        cost, chars = entropies(part, model)
        memo.update(zip(part, np.hstack([cost, chars[:, None]])))
    out = np.zeros((len(texts), len(model["langs"]) + 1))
    for i, bag in enumerate(bags):
        if bag:
            out[i] = np.fromiter(bag.values(), float, len(bag)) @ np.array([memo[w] for w in bag])
    return out[:, :-1], out[:, -1]


def fit(docs: DataFrame, docs_per_language: int = 600, reject: float = 0.01, longest: int = 200_000) -> dict | None:
    """Train on a bounded sample of rows that are not held out: per language those of least hash, whole texts.

    Every language is learned; of one with five documents or more in the sample a fifth calibrates instead. Null texts,
    languages and ids are ignored, as are texts of over ``longest`` characters, which bounds what the driver holds for each
    language; of texts that share id and language the least counts. No usable row gives None.
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.char_length("text") <= longest)).filter(~held_out(F.col("doc_id").cast("bigint")))
    sizes = known.groupBy("lang").count().collect()
    if not sizes:
        return None
    # a hash threshold per language draws about docs_per_language rows, the same for every layout of the table
    rates = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, docs_per_language / r["count"])) for r in sizes], "lang string, rate double")
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(1_000_000) * F.col("rate")
    drawn = known.join(F.broadcast(rates), "lang").filter(draw).groupBy("lang", F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.min("text").alias("text"))
    by_lang: dict[str, list] = defaultdict(list)
    for r in drawn.collect():
        by_lang[r["lang"]].append((r["doc_id"], r["text"]))
    kept, words = [], {}
    for lang, rows in sorted(by_lang.items()):
        rows.sort()
        held = set(range(0, len(rows), 5)) if len(rows) >= 5 else set()
        kept += [(lang, rows[i][1]) for i in sorted(held)]
        counts = Counter(w for i, (_, t) in enumerate(rows) if i not in held for w in _letters(t.lower()))
        if counts:
            words[lang] = counts
    if not words:
        return None
    model = train(words)
    cost, chars = totals([t for _, t in kept], model, {}, 1 << 30)
    some = chars > 0
    if some.any() and len(model["langs"]) > 1:
        mean = cost[some] / chars[some, None]
        truth = np.array([model["langs"].index(x) if x in model["langs"] else -1 for (x, _), ok in zip(kept, some) if ok])
        order = np.sort(mean, axis=1)
        right = (mean.argmin(axis=1) == truth).astype(float)
        model["a"], model["b"] = platt(order[:, 1] - order[:, 0], right)
        for k in range(len(model["langs"])):
            own = mean[truth == k, k]
            if len(own) >= 20:
                model["most"][k] = np.quantile(own, 1 - reject)
    return model


def language(docs: DataFrame, model: dict | None, memo: int = 200_000) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every whole text.

    ``und`` with score 0 if the text is null or has no letter, or if nothing could be learned. Repeated rows give repeated
    results; a null id is not held out; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model, seen = shared.value, {}
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = part.column(2).to_pylist()
                lang, score, out = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
                if model is not None and texts:
                    cost, chars = totals(texts, model, seen, memo)
                    some = np.array([bool(_letter(t or "")) for t in texts]) & (chars > 0)
                    mean = cost / np.maximum(chars, 1)[:, None]
                    best = mean.argmin(axis=1)
                    order = np.sort(mean, axis=1)
                    margin = order[:, 1] - order[:, 0] if order.shape[1] > 1 else np.ones(len(texts))
                    score = np.where(some, 1 / (1 + np.exp(-np.clip(model["a"] * margin + model["b"], -30, 30))), 0.0)
                    lang = [model["langs"][k] if ok else UNKNOWN for k, ok in zip(best, some)]
                    out = ~some | (mean[np.arange(len(texts)), best] > model["most"][best]) | (score < 0.5)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(lang, pa.string()), pa.array(score), pa.array(out)], names=["doc_id", "held_out", "lang_pred", "score", "rejected"])

    doc_id = docs["doc_id"].cast("bigint")
    return docs.select(doc_id.alias("doc_id"), F.coalesce(held_out(doc_id), F.lit(False)).alias("held_out"), docs["text"].alias("text")).mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double, rejected boolean")
