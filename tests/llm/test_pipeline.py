from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from candlewright.llm import queries
from candlewright.llm.common import written
from tests.llm.helpers import LONG, documents

SF = "/root/testdata/sf0.001"


def test_stages_follow_their_operators(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), name)
        counts.append(docs.count())
        if name != "tokens":
            assert docs.columns == columns
    kept = {r.doc_id for r in queries.op7_quality_rules(spark, SF).collect() if r.kept}
    assert counts[1] == len(kept)
    assert counts[0] > counts[1] >= counts[2] >= counts[3] <= counts[4] == counts[5]
    again = corpus_pipeline.run(spark, SF)
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, docs.collect()))


def words(n, seed):
    return " ".join(f"w{(seed * 7919 + i * i * 31) % 9973}x{i}" for i in range(n))


A, B, C = words(80, 1), words(80, 2), words(80, 3)
ROWS = [
    (1, A, "en", "a"),
    (1, B, "en", "a"),  # an id that is taken, another text
    (9, A.upper(), "en", "b"),
    (4, C, None, None),
    (4, C, None, None),  # a repeated row
    (None, C + " more", "de", "b"),  # a near copy without an id
    (5, None, "en", "a"),
    (6, "", None, "a"),
    (7, "Too short", "fr", "a"),
    (8, LONG[:20] + words(30_000, 4), "en", "c"),
]
STAYS = {
    "quality": lambda: [r[:2] for r in ROWS if r[1] and len(r[1]) > 100],
    "exact_dedup": lambda: [(1, B), (9, A.upper()), (4, C), (None, C + " more"), (6, ""), (7, "Too short"), (8, ROWS[-1][1])],
    "near_dedup": lambda: [(1, A), (1, B), (4, C), (5, None), (7, "Too short"), (8, ROWS[-1][1])],
}


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_every_stage_survives_odd_rows(spark, name):
    stage, docs = dict(corpus_pipeline.STAGES)[name], documents(spark, ROWS)
    got = stage(spark, docs, SF)
    rows = [(r[0], r[1]) for r in got.collect()]
    if name == "tokens":
        assert Counter(d for d, _ in rows) == Counter(r[0] for r in ROWS)
    elif name == "mixing":
        assert got.columns == docs.columns
        assert set(rows) == {r[:2] for r in ROWS} and max(Counter(rows).values()) <= 4
    else:
        assert got.columns == docs.columns
        mend = lambda xs: sorted(((d, t or "") for d, t in xs), key=str)
        want = STAYS[name]()
        # an empty and a null text are copies: either may stay
        assert mend(rows) == mend(want) or (name == "near_dedup" and mend(rows) == mend([x for x in want if x[0] != 5] + [(5, None)]))
    empty = stage(spark, docs.limit(0), SF)
    assert empty.count() == 0 and empty.columns == got.columns


def test_every_query_is_registered():
    names = set(queries.queries())
    assert {int(n.split("_")[0][2:]) for n in names} == set(range(1, 11)) and set(queries.ORACLES) < names

def test_stages_hand_texts_to_python_in_small_batches(spark):
    """All 20 MB of texts of one task used to be one batch, in the JVM and in the worker at once."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.range(0, 400, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 10_000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    most = lambda: docs.mapInArrow(sizes, "n bigint").agg(F.max("n")).first()[0]
    spark.conf.unset(key)
    corpus_pipeline.tokens(spark, docs, "")
    assert most() < 5_000_000
    spark.conf.set(key, "1m")
    corpus_pipeline.tokens(spark, docs, "")  # a session's own size stays
    assert most() < 1_500_000
    spark.conf.unset(key)
