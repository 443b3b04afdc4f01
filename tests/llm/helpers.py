"""Small tables with everything that operators must survive."""

import zlib

LONG = ("Lorem ipsum dolor sit amet, " * 4000).strip()
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from the big bad wolf", "en", "a"),
    (2, "THE quick brown fox jumps over the lazy dog and runs away from the big bad wolf", "en", "a"),
    (2, "THE quick brown fox jumps over the lazy dog and runs away from the big bad wolf", "en", "a"),
    (3, None, None, None),
    (4, "", "de", "b"),
    (5, LONG, "en", "a"),
    (6, "ÉCOLE École école", "fr", "b"),
    (7, "12 34 !!", None, "c"),
    (None, "no id", "en", None),
    (8, "école " + "x" * 5000, "fr", "b"),
]


def documents(spark, rows=ROWS):
    """Documents with extra columns whose names operators use inside."""
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    return df.selectExpr("*", "1 AS id", "'x' AS digest", "2 AS n", "3 AS run", "4 AS rank", "5 AS tokens", "6 AS weight", "7 AS blocks", "8 AS whole", "9 AS stratum", "10 AS kept", "'y' AS fp", "11 AS score", "12 AS salt", "13 AS ids")


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2
