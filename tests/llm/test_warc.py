import hashlib

import pytest

from candlewright.llm import warc

BIG = "<p>é & more</p>\r\n\r\n" * 20
PAGES = [(5, "http://a/5", BIG), (3, "http://a/3", BIG), (9, "u\r\nX: y", "small"), (2, None, "small"), (7, "u", None), (8, "u", ""), (3, "http://a/3", BIG), (None, "n", BIG), (1, "x", "z" * 200_000), (None, "m", "only null " * 30)]


def brute(pages):
    groups = {}
    for p, _, h in pages:
        groups.setdefault(h or "", []).append(p)
    out = []
    for p, _, h in pages:
        data = (h or "").encode()
        first = min((x for x in groups[h or ""] if x is not None), default=None)
        again = len(data) >= 100 and first is not None and p != first
        out.append((p, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def pages(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 AS payload_digest", "2 AS salt", "3 AS first")


def test_round_trip(spark):
    got = warc.warc_roundtrip(pages(spark), copies_per_salt=2)
    assert sorted(map(tuple, got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str) == brute(PAGES)
    assert warc.warc_roundtrip(pages(spark).limit(0)).count() == 0


def test_payloads_are_stored_once_and_verified(spark):
    path = warc.archive(pages(spark))
    stored = spark.read.parquet(f"{path}/payloads")
    assert stored.count() == stored.select("payload_digest").distinct().count() == len({h or "" for _, _, h in PAGES})
    assert warc.read_back(spark, path).count() == len(PAGES)
    by_id = {(r.page_id, bytes(r.payload)) for r in warc.reconstruct(spark, path, records_per_salt=2).collect()}
    assert by_id == {(p, (h or "").encode()) for p, _, h in PAGES}


def test_damage_is_an_error(spark):
    path = warc.archive(pages(spark))
    spark.read.parquet(f"{path}/payloads").filter("length(payload) < 1000").write.parquet(f"{path}/part/payloads")
    spark.read.parquet(f"{path}/records").write.parquet(f"{path}/part/records")
    with pytest.raises(Exception, match="does not agree"):
        warc.read_back(spark, f"{path}/part").collect()
    bent = "concat(payload, X'20')"
    spark.read.parquet(f"{path}/payloads").selectExpr("payload_digest", f"{bent} AS payload").write.parquet(f"{path}/bent/payloads")
    spark.read.parquet(f"{path}/records").write.parquet(f"{path}/bent/records")
    with pytest.raises(Exception, match="does not agree"):
        warc.read_back(spark, f"{path}/bent").collect()


def test_one_payload_of_many_pages(spark):
    rows = [(i, f"u{i}", BIG if i % 3 else f"own {i}" * 40) for i in range(3000)]
    got = warc.warc_roundtrip(pages(spark, rows), copies_per_salt=64)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_files_parse_back_to_the_exact_records(spark, tmp_path):
    path = warc.archive(pages(spark))
    warc.write_warc_files(spark, path, f"file://{tmp_path}/w", records_per_file=3)
    got = sorted(((r.page_id, r.header, bytes(r.block)) for r in warc.read_warc_files(spark, f"file://{tmp_path}/w/*.txt").collect()), key=str)
    want = sorted(((r.page_id, r.header, bytes(r.block)) for r in warc.reconstruct(spark, path).collect()), key=str)
    assert got == want and len(got) == len(PAGES)
    assert all(f"Content-Length: {len(b)}\r\n" in h for _, h, b in got)
