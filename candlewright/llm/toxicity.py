"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

*Kernel.* A string's features are its subsequences of three and four characters (its edges count as characters) within a
short span, each occurrence weighted by DECAY per skipped character, so an inserted or gapped character costs a factor
instead of the match. Features are hashed to ``BITS`` bits; each string is scaled by the norm its length gives. It is applied to the
words of a sentence and to letters spelled out one by one.

*Landmarks.* Strings that labelled documents tie to toxicity, and frequent words of clean ones, picked greedily for
coverage under the kernel. Nyström features K_mm^(-1/2) k_m(x) feed a linear SVM.

*Sentences.* A label covers a document, while an insult is a few words of its sentences. Training is multi-instance: what
toxic documents hold more often than their share, by an exact binomial test corrected for all strings tried, are the first
positives: words, neighbours within a sentence (phrases), and families, words of one beginning of which a document
has two or more. Then the witness of each toxic document, the string of highest score in its sentences, joins them,
and strings of clean documents' sentences that score highest become hard negatives, anew in each round. A document's score
comes from its two worst strings, by logistic regression on labelled documents that the SVM has not seen.

*Scoring.* The trained machine is linear in the hashed features, so landmark weights collapse into one weight per feature,
and a word costs a table look-up per subsequence.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS, WIDTH, SPAN, DECAY = 15, 24, 7, 0.6
#: Distances between neighbours of a subsequence: of three characters in a span of 6, of four in a span of 7.
STEPS = [(a, b) for a in range(1, 5) for b in range(1, 6 - a)] + [(a, b, c) for a in range(1, 5) for b in range(1, 6 - a) for c in range(1, 7 - a - b)]
EDGES = "^.,;:!?\"'()[]{}<>«»…-–—*#$%&|/\\_~`"
FLOOR = -2.0

_signs = re.compile(r"[\W_]+").sub
_inner = re.compile(r"[^\W_][\W_]+[^\W_]").search
_spelled = re.compile(r"(?<!\S)\S(?:[ ]\S){3,}(?!\S)").findall
_sentences = re.compile(r"[^.!?\n]+").findall


def held_out(doc_id: Column) -> Column:
    """The rows no label may be learned from."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2


def units(text: str | None) -> set[str]:
    """The strings of a text that the kernel sees: its words, also without signs inside, and words spelled out by letters."""
    text = (text or "").lower()
    out = set(text.split())
    out.update([_signs("", x) for x in out if not x.isalpha() and _inner(x)])
    out.update(x.replace(" ", "") for x in _spelled(text))
    return out


def phrases(text: str | None, within: frozenset[str] | None = None) -> set[str]:
    """Neighbouring words of a sentence, of all words or of those ``within``."""
    out = set()
    for sentence in _sentences((text or "").lower()):
        words = [w.strip(EDGES) for w in sentence.split()]
        out.update(f"{a} {b}" for a, b in zip(words, words[1:]) if within is None or (a in within and b in within))
    return out


def bag_of(text: str | None, model: dict) -> set[str]:
    """Units of a text, with the phrases of words that the model's phrases hold."""
    out = units(text)
    within = model["phrase_words"]
    return out | phrases(text, within) if within and not within.isdisjoint(w.strip(EDGES) for w in out) else out


def matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of padded windows of the words, their lengths, and the word of each window."""
    rows, owner = [], []
    for i, word in enumerate(words):
        word = "^" + word.strip(EDGES) + "$"
        for lo in range(0, max(1, len(word) - SPAN + 1), WIDTH - SPAN + 1) if len(word) > WIDTH else (0,):
            rows.append(word[lo : lo + WIDTH])
            owner.append(i)
    codes = np.frombuffer("".join(r.ljust(WIDTH, "\0") for r in rows).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, WIDTH)
    return codes, np.fromiter(map(len, rows), np.int64, len(rows)), np.array(owner, np.int64)


def features(codes: np.ndarray):
    """(hashed feature, weight, whether it is there) of each occurrence, one block per pair of steps."""
    for steps in STEPS:
        at, wide = 0, WIDTH - sum(steps)
        h = codes[:, :wide] * np.uint32(0x9E3779B1)
        for k, step in enumerate(steps):
            at += step
            h += codes[:, at : at + wide] * np.uint32((0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)[k])
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        yield h >> np.uint32(32 - BITS), np.float32(DECAY ** (sum(steps) - len(steps))), codes[:, at : at + wide] != 0


#: 1 / norm of a string of each length, all occurrences taken as different.
SCALE = np.array([1 / max(1e-9, sum(max(0, n - sum(s)) * DECAY ** (2 * (sum(s) - len(s))) for s in STEPS)) ** 0.5 if n > 2 else 0.0 for n in range(WIDTH + 1)])


def weigh(words: list[str], weights: np.ndarray, bias: float) -> np.ndarray:
    """The machine's value for each word; a long one has that of its worst window."""
    if not words:
        return np.empty(0)
    codes, sizes, owner = matrix(words)
    total = np.zeros(len(codes))
    for h, w, there in features(codes):
        total += w * np.einsum("ij,ij->i", weights[h], there)
    out = np.full(len(words), -np.inf)
    np.maximum.at(out, owner, total * SCALE[sizes] + bias)
    return out


def explicit(words: list[str]) -> np.ndarray:
    """Scaled hashed feature vectors of words; that of a word longer than a window is the sum over its windows."""
    codes, sizes, owner = matrix(words)
    out = np.zeros((len(words), 1 << BITS), np.float32)
    scale = SCALE[sizes].astype(np.float32)[:, None]
    for h, w, there in features(codes):
        rows, weight = np.broadcast_to(owner[:, None], h.shape), np.broadcast_to(w * scale, h.shape)
        np.add.at(out, (rows[there], h[there]), weight[there])
    return out


def kernel(words: list[str], landmarks: np.ndarray) -> np.ndarray:
    return np.concatenate([explicit(words[lo : lo + 256]) @ landmarks.T for lo in range(0, len(words), 256)]) if words else np.empty((0, len(landmarks)))


def spread(words: list[str], most: int, pool: int = 800) -> list[str]:
    """Greedy cover: each pick is the one least like those picked so far, of ``pool`` words spread over all at most."""
    words = words[:: max(1, -(-len(words) // pool))]
    if len(words) <= most:
        return words
    vectors = explicit(words)
    picked, like = [0], vectors @ vectors[0]
    while len(picked) < most:
        k = int(np.argmin(like))
        picked.append(k)
        like = np.maximum(like, vectors @ vectors[k])
    return [words[i] for i in picked]


def svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 120, seed: int = 7) -> np.ndarray:
    """Linear SVM by dual coordinate descent; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, alpha, norm = np.zeros(x.shape[1]), np.zeros(len(x)), (x * x).sum(axis=1)
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(x)):
            new = min(cost[i], max(0.0, alpha[i] - (y[i] * (x[i] @ w) - 1) / norm[i]))
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


def platt(value: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(a, b) of P = 1 / (1 + exp(-(a value + b)))."""
    weights = logistic(np.asarray(value, float)[:, None], y)
    return float(weights[0]), float(weights[1])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights, then the bias, of a logistic regression on smoothed targets: Newton steps, halved until the loss falls.

    No weight is negative: columns that would get one are left out.
    """
    pos, neg = y.sum(), len(y) - y.sum()
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    use = np.arange(x.shape[1])
    while True:
        z = np.hstack([x[:, use], np.ones((len(x), 1))])
        shrink = np.r_[np.full(len(use), ridge), 1e-9]

        def loss(w: np.ndarray) -> float:
            at = z @ w
            return float((np.logaddexp(0, at) - t * at).sum() + (shrink * w * w).sum() / 2)

        w = np.r_[np.zeros(len(use)), np.log((pos + 1) / (neg + 1))]
        now = loss(w)
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -500, 500)))
            step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(shrink), z.T @ (p - t) + shrink * w)
            size = 1.0
            while size > 1e-6 and (new := loss(w - size * step)) > now:
                size /= 2
            if size <= 1e-6 or now - new < 1e-9 * max(1.0, abs(now)):
                break
            w, now = w - size * step, new
        bad = w[:-1] < 0
        if not bad.any() or len(use) == 1:
            out = np.zeros(x.shape[1] + 1)
            out[use], out[-1] = np.maximum(w[:-1], 1e-3), w[-1]
            return out
        use = use[~bad] if (~bad).any() else use[:1]


def log_tail(k: int, n: int, p: float) -> float:
    """-log10 P(X >= k) of Bin(n, p)."""
    terms = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k, n + 1)]
    top = max(terms)
    return -(top + math.log(sum(math.exp(x - top) for x in terms))) / math.log(10)


def tied(toxic: Counter, clean: Counter, rate: float, sure: float = 2.0) -> list[str]:
    """Strings that toxic documents hold more often than ``rate`` of the time, the surest first.

    Surely means that the chance of it, times the number of strings in as many documents or more, is below 10^-``sure``.
    """
    held = {w: n + clean[w] for w, n in toxic.items()}
    sizes = Counter(held.values())
    tried, more = {}, 0
    for n in sorted(sizes, reverse=True):
        more += sizes[n]
        tried[n] = math.log10(more)
    found = [(log_tail(k, held[w], rate) - tried[held[w]], w) for w, k in toxic.items() if k >= 3 and k > 2 * rate * held[w]]
    return [w for x, w in sorted(found, key=lambda x: (-x[0], x[1])) if x > sure]


def beginnings(words) -> set[str]:
    """Beginnings of four to six letters that two or more of the words share."""
    seen = Counter("^" + w[:n] for w in words for n in (4, 5, 6) if len(w) >= n)
    return {g for g, n in seen.items() if n > 1}


def distinct_bags(bags: list[tuple]) -> list[tuple]:
    """Rows (label, bag, ...) without near copies of earlier bags (half of the 16 least word hashes shared): copies aren't independent evidence."""
    seen: dict[int, list[int]] = {}
    out = []
    for row in bags:
        bag = row[1]
        sketch = sorted(zlib.crc32(w.encode()) for w in bag)[:16]
        shared = Counter(k for h in sketch for k in seen.get(h, ()))
        if sketch and shared and 2 * max(shared.values()) >= len(sketch):
            continue
        for h in sketch:
            seen.setdefault(h, []).append(len(out))
        out.append(row)
    return out


def worst_two(text: str | None, bag: set[str], value: dict[str, float]) -> tuple[float, float]:
    """The two highest values of a text's strings; one that comes again counts again."""
    values = [value[w] for w in bag]
    if not values:
        return FLOOR, FLOOR
    first = max(values)
    if first > 0 and (text or "").lower().split().count(next(w for w in bag if value[w] == first)) > 1:
        return first, first
    values.remove(first)
    return max(first, FLOOR), max(max(values, default=FLOOR), FLOOR)


def train(rows: list[tuple[int, str | None, int]], landmarks: int = 400, hard: int = 800, rounds: int = 3) -> dict:
    """The model of labelled (doc_id, text, toxic) rows: weights, bias, calibration, phrase words. Without both labels nothing is toxic."""
    rows = sorted(rows, key=lambda r: r[0])
    strip = lambda bag: {w for x in bag if len(w := x.strip(EDGES)) > 2}
    texts = [t for _, t, _ in rows]
    kept = distinct_bags([(y, strip(units(t)), i) for i, (_, t, y) in enumerate(rows)])
    part = [zlib.crc32(str(rows[i][0]).encode()) % 10 < 8 for _, _, i in kept]
    model = {"weights": np.zeros(1 << BITS, np.float32), "bias": FLOOR, "calibration": np.array([1.0, 0.0, -3.0]), "phrase_words": frozenset()}
    fit_pos = [(u, i) for ok, (y, u, i) in zip(part, kept) if ok and y and u]
    fit_neg = [(u, i) for ok, (y, u, i) in zip(part, kept) if ok and not y]
    if not fit_pos or not fit_neg:
        return model
    rate = len(fit_pos) / (len(fit_pos) + len(fit_neg))
    counted = lambda side, of: Counter(w for u, i in side for w in of(u, i))
    # phrases of words that are not tied alone
    toxic, clean = (counted(side, lambda u, i: u) for side in (fit_pos, fit_neg))
    alone = tied(toxic, clean, rate, 1.0)
    said = [counted(side, lambda u, i: phrases(texts[i])) for side in (fit_pos, fit_neg)]
    phrase = [p for p in tied(*said, rate, 3.0) if not set(alone) & set(p.split())]
    model["phrase_words"] = within = frozenset(w for p in phrase for w in p.split())
    if within:
        fit_pos, fit_neg = ([(u | phrases(texts[i], within), i) for u, i in side] for side in (fit_pos, fit_neg))
        toxic, clean = (counted(side, lambda u, i: u) for side in (fit_pos, fit_neg))
    # families: of a beginning that toxic documents repeat, the words that they hold more often than clean ones do
    likely = lambda w, times: toxic[w] * len(fit_neg) > times * (clean[w] + 0.5) * len(fit_pos)
    begun = [counted(side, lambda u, i: beginnings(u)) for side in (fit_pos, fit_neg)]
    family = set(tied(*begun, rate, 3.0))
    in_family = lambda w: any("^" + w[:n] in family for n in (4, 5, 6))
    kin = sorted((w for w in toxic if in_family(w) and likely(w, 2)), key=lambda w: (-toxic[w], w))
    seeds = [*alone, *phrase, *(w for w in kin if w not in set(alone))]
    if not seeds:  # too few labels for a test: what toxic documents alone hold, most often first
        most = max((n for w, n in toxic.items() if not clean[w]), default=0)
        seeds = sorted(w for w, n in toxic.items() if not clean[w] and 2 * n > most)
    if not seeds:
        return model
    vocabulary = sorted(set(toxic) | set(clean))
    common = [w for w, _ in sorted(clean.items(), key=lambda x: (-x[1], x[0])) if w not in set(seeds)][:400]
    pool = sorted(w for w in clean if w not in set(seeds))
    negatives = sorted(set(common) | set(pool[:: max(1, len(pool) // hard)]) | {w for w in pool if in_family(w) and not likely(w, 1)})
    positives, worst = seeds, []
    for _ in range(rounds):
        half = positives[: landmarks // 4] + spread(positives[landmarks // 4 :], landmarks // 4)
        points = half + worst[: landmarks // 4] + spread(common, landmarks // 4)
        at = explicit(points)
        values, vectors = np.linalg.eigh((at @ at.T).astype(float))
        good = values > 1e-3 * values.max()  # weaker directions are noise of single precision
        whiten = vectors[:, good] / np.sqrt(values[good])
        # a member of a family that clean documents hold too is on both sides, so its value is lower
        words = positives + [w for w in negatives if w not in set(positives)] + [w for w in kin if clean[w]]
        y = np.where(np.arange(len(words)) < len(positives), 1.0, -1.0)
        w = svm(kernel(words, at) @ whiten, y, np.full(len(y), 20.0))
        model |= {"weights": ((whiten @ w[:-1]) @ at).astype(np.float32), "bias": float(w[-1])}
        value = dict(zip(vocabulary, weigh(vocabulary, model["weights"], model["bias"]).tolist()))
        witnesses = {max(u, key=lambda x: (value[x], x)) for u, _ in fit_pos}
        positives = seeds + sorted(k for k in witnesses - set(seeds) if value[k] > 0.6 and likely(k, 3) and toxic[k] > 1)
        worst = sorted(pool, key=lambda x: (-value[x], x))[:hard]
        negatives = sorted(set(negatives) | set(worst))
    rest = [(y, i) for ok, (y, _, i) in zip(part, kept) if not ok]
    if len({y for y, _ in rest}) < 2:
        rest = [(y, i) for _, (y, _, i) in zip(part, kept)]
    bags = [bag_of(texts[i], model) for _, i in rest]
    new = sorted(set().union(*bags))
    value = dict(zip(new, weigh(new, model["weights"], model["bias"]).tolist()))
    top = np.array([worst_two(texts[i], u, value) for (_, i), u in zip(rest, bags)])
    model["calibration"] = logistic(top, np.array([y for y, _ in rest], float), ridge=0.1)
    return model


def fit(docs: DataFrame, labels: DataFrame, toxic_docs: int = 1000, clean_docs: int = 2000, longest: int = 200_000) -> dict:
    """Train on a bounded sample of labelled rows that are not held out: those of least hash, whole texts.

    Null labels and ids are ignored; an id labelled both ways counts on both sides; of texts that share an id the least
    counts; texts of over ``longest`` characters are not learned from, which bounds what the driver holds. Empty tables
    give a model that finds nothing.
    """
    known = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").filter(~held_out(F.col("doc_id"))).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).distinct()
    sides = [known.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for y, n in ((1, toxic_docs), (0, clean_docs))]
    sample = sides[0].unionByName(sides[1])  # toxic_docs + clean_docs rows of two numbers: small enough to broadcast
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter(F.coalesce(F.char_length("text"), F.lit(0)) <= longest)
    rows = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).collect()
    return train([(r["doc_id"], r["text"], r["toxic"]) for r in rows])


def toxicity(docs: DataFrame, model: dict, memo: int = 300_000) -> DataFrame:
    """doc_id, held_out, score, predicted for every whole text.

    A null, empty or wordless text gets the lowest score. Repeated rows give repeated results; a null id is not held out;
    other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model, seen = shared.value, {}
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = part.column(2).to_pylist()
                bags = [bag_of(t, model) for t in texts]
                if len(seen) > memo:
                    seen.clear()
                new = sorted(set().union(*bags).difference(seen)) if bags else []
                for at in range(0, len(new), 4096):
                    some = new[at : at + 4096]
                    seen.update(zip(some, weigh(some, model["weights"], model["bias"]).tolist()))
                top = np.array([worst_two(t, bag, seen) for t, bag in zip(texts, bags)]).reshape(-1, 2)
                score = 1 / (1 + np.exp(-np.clip(top @ model["calibration"][:-1] + model["calibration"][-1], -30, 30)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(score), pa.array((score >= 0.3).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    doc_id = docs["doc_id"].cast("bigint")
    return docs.select(doc_id.alias("doc_id"), F.coalesce(held_out(doc_id), F.lit(False)).alias("held_out"), docs["text"].alias("text")).mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")
