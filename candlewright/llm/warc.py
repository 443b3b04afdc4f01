"""A content-addressed WARC archive: payload bytes once by digest, exact record headers apart.

``archive`` writes two tables. ``payloads`` holds the bytes of every distinct payload once under its SHA-256;
``records`` holds one row per WARC record: its exact header block and the digest it refers to. Payloads that come once, which a
filter of the repeated digests tells, are written where they lie; only the others are shuffled.

``reconstruct`` puts the records together again by joining the two on the digest, and checks each of them: the payload
is there, its digest is the one the header states, and the length is that of the header. A record that fails is an error.
``read_back`` takes its rows from these records. Rows of a digest with many records are dealt over salts.

``write_warc_files`` renders the records as ordinary WARC files with Spark's text writer (a record ends with two line
ends, so that is the line separator), and ``read_warc_files`` parses such files, so the archive can leave this engine.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_path
from .exact_dedup import Filter

#: Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n"
SMALLEST_REVISIT = 100
#: There are no more hot digests than this, so they are broadcast (a few MB).
MOST_HOT = 50_000


def record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def one_line(url: Column) -> Column:
    """Line ends, which no header line may hold, percent-encoded."""
    return F.regexp_replace(F.regexp_replace(url, "\r", "%0D"), "\n", "%0A")


def header(date: str) -> Column:
    """The exact header block of a record, from page_id, url, digest, bytes, type and refers_to."""
    revisit = F.col("record_type") == "revisit"
    lines = [
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), record_id(F.col("page_id"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), one_line(F.coalesce("url", F.lit("")))),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("payload_digest")),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), record_id(F.col("refers_to")))),
        F.when(revisit, F.concat(F.lit("X-Payload-Length: "), F.col("payload_bytes"))),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))),
    ]
    return F.concat(F.concat_ws(END, *lines), F.lit(END + END))


def salts_of(groups: DataFrame, per_salt: int) -> tuple[DataFrame, Column]:
    """The digests (payload_digest, own_salts) of over ``per_salt`` of n rows, few enough to broadcast, and the salts of n rows."""
    total = groups.agg(F.sum("n")).first()[0] or 0
    salts = F.ceil(F.col("n") / max(per_salt, total // MOST_HOT)).cast("int")
    return F.broadcast(groups.filter(salts > 1).select("payload_digest", salts.alias("own_salts"))), salts


def archive(pages: DataFrame, path: str | None = None, date: str = "1970-01-01T00:00:00Z", copies_per_salt: int = 4096) -> str:
    """Write ``pages`` (page_id, url, html) as ``path``/records and ``path``/payloads; return the path.

    Of records with equal payloads of 100 bytes or more, that with the smallest page_id is the response and the others
    revisit it; smaller payloads are all responses. Null html is an empty payload. A repeated page_id with an equal payload
    is a response each time; a null page_id never is what others refer to. Rows of a digest with very many copies are
    dealt over salts of ``copies_per_salt`` rows (more, if over MOST_HOT digests had several salts).
    """
    spark = pages.sparkSession
    path = path or new_path(spark, "warc")
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.sha2(html, 256).alias("payload_digest"), F.octet_length(html).cast("bigint").alias("payload_bytes"))
    rows.write.parquet(f"{path}/keys", compression="zstd")
    keys = spark.read.schema(rows.schema).parquet(f"{path}/keys")
    keys.groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").write.parquet(f"{path}/groups", compression="zstd")
    groups = spark.read.schema("payload_digest string, first bigint, n bigint").parquet(f"{path}/groups")
    hot, salts = salts_of(groups, copies_per_salt)
    several = groups.select("payload_digest", "first", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    salted = keys.join(hot, "payload_digest", "left").withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.coalesce("own_salts", F.lit(1))).cast("int")).drop("own_salts")
    revisit = F.col("first").isNotNull() & (F.col("payload_bytes") >= SMALLEST_REVISIT) & ~F.col("page_id").eqNullSafe(F.col("first"))
    records = (
        salted.join(several, ["payload_digest", "salt"], "left")
        .withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(revisit, F.col("first")))
        .select("page_id", "payload_digest", "payload_bytes", "record_type", "refers_to", "url")
    )
    records.select("page_id", "payload_digest", header(date).alias("header")).write.parquet(f"{path}/records", compression="zstd")
    # of a digest that comes again, the row of its least page holds the payload; a null id counts as the least number. Rows
    # that repeat that page with that payload collapse
    owner = lambda c: F.coalesce(c, F.lit(-(2**63))).alias("owner")
    held = pages.select(owner(F.col("page_id").cast("bigint")), html.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    probed = Filter(groups.select(F.col("payload_digest").alias("digest")), groups.count()).probe(held)
    alone = probed.filter("NOT maybe").select(F.col("digest").alias("payload_digest"), "payload")
    least = groups.select(F.col("payload_digest").alias("digest"), owner(F.col("first")).alias("least"))
    again = probed.filter("maybe").join(least, "digest", "left").filter("least IS NULL OR owner = least").select(F.col("digest").alias("payload_digest"), "payload")
    payloads = alone.unionByName(again.dropDuplicates(["payload_digest"]))
    payloads.select("payload_digest", F.encode("payload", "UTF-8").alias("payload")).write.parquet(f"{path}/payloads", compression="zstd")
    return path


def field(name: str) -> Column:
    return F.regexp_extract("header", rf"\r\n{re.escape(name)}: ([^\r]*)\r\n", 1)


def reconstruct(spark: SparkSession, path: str, records_per_salt: int = 4096) -> DataFrame:
    """(page_id, header, block, payload): the exact records; a revisit's block is empty and its payload the response's.

    Every record is checked against its header; a payload that is missing, or differs in digest or length, is an error.
    An empty archive gives no rows; records of a null page_id are records like any other.
    """
    stored = spark.read.schema("payload_digest string, payload binary").parquet(f"{path}/payloads")
    records = spark.read.schema("page_id bigint, payload_digest string, header string").parquet(f"{path}/records")
    counts = records.groupBy("payload_digest").agg(F.count(F.lit(1)).alias("n"))
    hot, _ = salts_of(counts, records_per_salt)
    dealt = records.join(hot, "payload_digest", "left").withColumn("salt", F.pmod(F.xxhash64("page_id", "header"), F.coalesce("own_salts", F.lit(1))).cast("int")).drop("own_salts")
    copies = stored.join(hot, "payload_digest", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("own_salts", F.lit(1)) - 1))).drop("own_salts")
    joined = dealt.join(copies.hint("shuffle_merge"), ["payload_digest", "salt"], "left")
    revisit = field("WARC-Type") == "revisit"
    sized = F.when(revisit, (field("Content-Length") == "0") & (field("X-Payload-Length") == F.octet_length("payload").cast("string"))).otherwise(field("Content-Length") == F.octet_length("payload").cast("string"))
    good = F.coalesce((F.sha2("payload", 256) == stated_digest()) & sized, F.lit(False))
    failed = F.assert_true(good, F.concat(F.lit("a record does not agree with its payload: "), F.col("header")))
    whole = joined.withColumn("payload", F.when(failed.isNull(), F.col("payload")))
    return whole.select("page_id", "header", F.when(revisit, F.encode(F.lit(""), "UTF-8")).otherwise(F.col("payload")).alias("block"), "payload")


def stated_digest() -> Column:
    return F.regexp_extract("header", r"\r\nWARC-Payload-Digest: sha256:([0-9a-f]{64})\r\n", 1)


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """One row per reconstructed record: page_id, payload_bytes, payload_digest, record_type, refers_to, read from the record."""
    refers = F.regexp_extract("header", r"\r\nWARC-Refers-To: <urn:page:(-?\d+)>\r\n", 1)
    return reconstruct(spark, path).select(
        "page_id",
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        stated_digest().alias("payload_digest"),
        field("WARC-Type").alias("record_type"),
        F.when(refers != "", refers.cast("bigint")).alias("refers_to"),
    )


def write_warc_files(spark: SparkSession, path: str, to: str, records_per_file: int = 10_000) -> None:
    """Render an archive as .warc text files under ``to``, ``records_per_file`` records each at most."""
    whole = reconstruct(spark, path).select(F.concat("header", F.decode("block", "UTF-8")).alias("value"))
    whole.write.option("lineSep", END + END).option("maxRecordsPerFile", records_per_file).text(to)


_id = re.compile(rb"\r\nWARC-Record-ID: <urn:page:(-?\d+)>\r\n")


def parse_warc(data: bytes):
    """(header, block) of each record of a WARC file."""
    at = 0
    while at < len(data):
        cut = data.index(b"\r\n\r\n", at) + 4
        length = int(re.search(rb"\r\nContent-Length: (\d+)\r\n", data[at:cut])[1])
        yield data[at:cut], data[cut : cut + length]
        at = cut + length + 4


def read_warc_files(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, header, block) from WARC files that fit a task's memory one at a time."""

    def run(batches):
        for batch in batches:
            for data in batch.column(0):
                found = [(int(m[1]) if (m := _id.search(head)) else None, head.decode(), block) for head, block in parse_warc(data.as_py())]
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.string()), pa.array([x[2] for x in found], pa.binary())], names=["page_id", "header", "block"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "page_id bigint, header string, block binary")


def warc_roundtrip(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` to a new archive and read its records back."""
    return read_back(pages.sparkSession, archive(pages, **options))
