"""Quality rules whose cutoffs carry a guarantee on false rejections.

Each rule is a ratio of a document, in thousandths, that rises with junk. Rules that look for the same kind of junk share a
*path*: a fixed sequence of joint cutoffs from lenient to strict. A step is certified on the labelled documents of good
quality in one stratum (language) while the exact binomial test rejects "the rules chosen so far and this step together
remove more than ``false_rejection`` of the good documents".

The limit is shared by the paths, not split: the second path is tested on top of the step the first one reached, and gets
what the first one left. The first path, and the second after a whole first one, are one fixed sequence at level
``MAIN`` x ``share``; if the first path ends early, the second is tested at (1 - ``MAIN``) x ``share`` / ``STEPS``, a part
for each step it may have ended at. Hence a share of error covers both paths.

A stratum that could certify nothing even if no good document were removed has *few* labels. Whether it has depends on
the number of its labels only, so the tests stay valid. Strata with few labels are tested together, as one pooled stratum
(with all others, if they are too few together), and take its steps, back to where they remove no more than
``false_rejection`` of the stratum's own good documents. ``error`` is divided over the strata that are tested alone and
the pooled one: with probability 1 - ``error``, none of these loses more than ``false_rejection`` of its good documents.
For a stratum with few labels the guarantee is that of the pool, not of its own. A stratum without any good label
certifies none and loses nothing.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

WHITE = "\t\n\x0b\x0c\r "
SYMBOLS = "#*$%&|<>"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Paths of rules with their cutoffs, in thousandths, from lenient to strict: a document with a value above goes.
PATHS = {
    "junk": {"symbols": (500, 400, 300, 200, 150, 100, 80, 60), "capitals": (900, 800, 700, 600, 500, 400, 350, 300), "exclaims": (300, 250, 200, 150, 100, 80, 60, 50)},
    "copies": {"repeats": (500, 480, 460, 440, 420, 400, 380, 360), "dup_lines": (950, 900, 850, 800, 750, 700, 650, 600), "digits": (700, 600, 500, 400, 350, 300, 275, 250)},
}
RULES = [rule for path in PATHS.values() for rule in path]
STEPS = 8
#: The part of a share of error that the main sequence of tests gets.
MAIN = 0.9

_odd_space = re.compile("[\x1c-\x1f\x85\xa0  -     　]").search
_words = re.compile(r"[^\x20\x09-\x0D]+").findall
_capitals = re.compile("[A-ZÀ-ÖØ-Þ]").findall
_digits = re.compile("[0-9]").findall


def repeat_words(words: list[str]) -> int:
    """Words in three-word windows that occur twice or more, the first included."""
    windows = Counter(zip(words, words[1:], words[2:]))
    if len(windows) == max(0, len(words) - 2):
        return 0
    covered = reached = 0
    for i, window in enumerate(zip(words, words[1:], words[2:])):
        if windows[window] > 1:
            covered += i + 3 - max(i, reached)
            reached = i + 3
    return covered


def stats(text: str | None) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, then a value in thousandths for each rule."""
    text = text or ""
    words = _words(text) if _odd_space(text) else text.split()
    n = len(words)
    chars = len(text) - sum(map(text.count, WHITE))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x and not x.isspace() or _words(x)]
    dups = len(lines) - len(set(lines))
    repeats = repeat_words(words)
    of = lambda part, whole: 1000 * part // whole if whole else 0
    return n, chars, symbols, dups, repeats, of(symbols, chars), of(len(_capitals(text)), chars), of(text.count("!"), chars), of(repeats, n), of(dups, len(lines)), of(len(_digits(text)), chars)


def quality_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    names = ["doc_id", "stratum", *STATS, *RULES]
    schema = "doc_id bigint, stratum string, " + ", ".join(f"{x} bigint" for x in names[2:])

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                columns = zip(*map(stats, part.column(2).to_pylist())) if part.num_rows else [[]] * (len(names) - 2)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array(x, pa.int64()) for x in columns)], names=names)

    return docs.select(docs[id_col].cast("bigint").alias("doc_id"), F.coalesce(docs[stratum_col].cast("string"), F.lit("")).alias("stratum"), docs[text_col].alias("text")).mapInArrow(run, schema)


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of Bin(n, p)."""
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    return min(1.0, math.fsum(map(math.exp, logs)))


def certified(rejected: list[int], n: int, limit: float, level: float) -> int:
    """How many cutoffs, in order, pass the exact test; rejected: good documents that each would remove."""
    for i, k in enumerate(rejected):
        if k >= limit * n or binomial_tail(k, n, limit) > level:
            return i
    return len(rejected)


def base_failed():
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def fails(path: str, step: int):
    """Whether a row breaks a rule of the path at this step."""
    out = F.lit(False)
    for rule, cutoffs in PATHS[path].items():
        out = out | (F.col(rule) > cutoffs[step])
    return out


def certified_steps(hits: Counter, limit: float, share: float) -> tuple[int, int]:
    """How many steps of either path are certified; hits: good documents by the first step of either path that removes them."""
    n, lost = sum(hits.values()), lambda i, j: sum(k for (a, b), k in hits.items() if a < i or b < j)
    first = certified([lost(i + 1, 0) for i in range(STEPS)], n, limit, MAIN * share)
    level = MAIN * share if first == STEPS else (1 - MAIN) * share / STEPS
    return first, certified([lost(first, j + 1) for j in range(STEPS)], n, limit, level)


def few_labels(n: int, limit: float, share: float) -> bool:
    """Whether n labels certify nothing even if no good document is removed."""
    return not n or binomial_tail(0, n, limit) > MAIN * share


def all_steps(found: dict[str, Counter], limit: float, error: float) -> dict[str, tuple[int, int]]:
    """How many steps of either path each stratum uses."""
    sizes = {s: sum(hits.values()) for s, hits in found.items()}
    few = {s for s, n in sizes.items() if few_labels(n, limit, error / len(found))}
    share = error / max(1, len(found) - len(few) + bool(few))
    out = {s: certified_steps(hits, limit, share) for s, hits in found.items() if s not in few}
    if few:
        together = few if not few_labels(sum(sizes[s] for s in few), limit, share) else set(found)
        pooled = certified_steps(sum((found[s] for s in together), Counter()), limit, share)
        for s in few:
            i, j = pooled
            while sum(k for (a, b), k in found[s].items() if a < i or b < j) > limit * sizes[s]:
                i, j = (i, j - 1) if j else (i - 1, 0)
            out[s] = i, j
    return out


def fit_cutoffs(measured: DataFrame, labels: DataFrame, false_rejection: float = 0.02, error: float = 0.05) -> dict[tuple[str, str], int]:
    """(stratum, path) -> strictest certified step, from all documents labelled quality 1 that pass the base rules.

    Only counts by stratum and first removing step of either path come to the driver.
    """
    good = labels.filter("quality = 1").select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
    held = measured.filter(~base_failed()).join(good, "doc_id", "left_semi")
    first = [F.coalesce(*(F.when(fails(path, k), k) for k in range(STEPS)), F.lit(STEPS)).alias(path) for path in PATHS]
    found = {}
    for row in held.select("stratum", *first).groupBy("stratum", *PATHS).agg(F.count(F.lit(1)).alias("n")).collect():
        found.setdefault(row["stratum"], Counter())[tuple(row[path] for path in PATHS)] += row["n"]
    steps = all_steps(found, false_rejection, error)
    return {(s, path): passed - 1 for s, both in steps.items() for path, passed in zip(PATHS, both) if passed}


def verdict(steps: dict[tuple[str, str], int]):
    """False if a row fails the base rules, or a path at the step certified for its stratum."""
    bad = base_failed()
    for path in PATHS:
        for step in range(STEPS):
            strata = sorted(s for (s, p), k in steps.items() if (p, k) == (path, step))
            if strata:
                bad = bad | (F.col("stratum").isin(strata) & fails(path, step))
    return ~bad


def quality_rules(docs: DataFrame, labels: DataFrame, false_rejection: float = 0.02, error: float = 0.05) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, and the rules' values.

    A null text has no words, hence fails the base rules. A null language is a stratum of its own; a stratum with few
    good labels uses pooled cutoffs, one without any rejects by the base rules only. Repeated rows give repeated results; labels of unknown documents, null
    labels and other columns are ignored; empty tables give no rows or no cutoffs.
    """
    measured = written(quality_stats(docs), "quality-stats")
    kept = verdict(fit_cutoffs(measured, labels, false_rejection, error))
    return measured.select("doc_id", *STATS, base_failed().alias("base_failed"), kept.alias("kept"), *RULES)


def keep_good(docs: DataFrame, labels: DataFrame, false_rejection: float = 0.02, error: float = 0.05) -> DataFrame:
    """The rows of ``docs`` that quality_rules keeps, with all their columns.

    Texts are measured twice, once to fit the cutoffs and once to filter, so that no text is shuffled.
    """
    steps = fit_cutoffs(written(quality_stats(docs), "quality-stats"), labels, false_rejection, error)
    schema = docs.schema
    limits = {(s, rule): cutoffs[k] for (s, path), k in steps.items() for rule, cutoffs in PATHS[path].items()}

    def run(batches):
        for batch in batches:
            keep = []
            at = batch.schema.get_field_index("lang")
            langs = batch.column(at).to_pylist() if at >= 0 else [None] * batch.num_rows
            for text, lang in zip(batch.column(batch.schema.get_field_index("text")).to_pylist(), langs):
                x = stats(text)
                good = x[0] >= 50 and 100 * x[4] <= 50 * x[0]
                keep.append(good and all(v <= limits.get((lang or "", rule), 1000) for rule, v in zip(RULES, x[5:])))
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, schema)
