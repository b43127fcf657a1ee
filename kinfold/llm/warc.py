"""WARC archives with revisit records.

``deduplicate`` shuffles record headers (payload digest, length, id) by digest and makes all but one record
of a payload revisits of that one; ``write_archive`` writes records with fresh headers; ``read_archive``
reads files back; ``resolve_revisits`` joins revisit records to their originals.

A record ends with an empty line (CR LF CR LF), which is also the line separator of Spark's text writer, so
archives are written by Spark to any file system, with its protection against lost tasks. Files are
bounded by payload bytes and are read whole, several to a task.

Payload digests may be hot: the largest id per digest comes from a partial aggregate, only payloads that occur
twice are kept, and the join back has both sides shuffled, so adaptive execution may split a hot digest.

Defined results: null payload is empty. Records tied on the largest id (repeated rows) are all responses; a
null id is below every id, and where only null ids share a payload all are responses. A null URL is left out of the header.
An empty table gives an empty archive, which reads as an empty table. Columns other than id, URL and payload aren't read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, store

FILE_BYTES = 16_000_000
RECORD_SCHEMA = (
    "record_id string, record_type string, page_id long, url string, payload_digest string, "
    "refers_to_id string, payload binary"
)
# Names and forms of the WARC 1.1 standard.
VERSION = "WARC/1.1"
END = "\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# End of fixed values.
FIVE_BITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
DATE = "1970-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """160 bits are 32 digits of five bits: 20 bits at a time, five hex digits become four."""
    digest = F.upper(F.sha1(payload))
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), FIVE_BITS, BASE32)


def as_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    payload = F.coalesce(F.encode(F.col(html).cast("string"), "UTF-8"), F.lit(b""))
    return pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload")).withColumn(
        "payload_digest", base32_sha1(F.col("payload"))
    )


def deduplicate(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Add ``original``: the id that a record revisits, null for responses.

    Payloads are equal when SHA-1 and length are, as WARC readers assume.
    """
    headers = records.select("payload_digest", F.octet_length("payload").alias("n"), "page_id").filter(F.col("n") >= min_bytes)
    shared = store(
        headers.groupBy("payload_digest", "n")
        .agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("copies"))
        .filter((F.col("copies") > 1) & F.col("original").isNotNull())
        .select("payload_digest", F.col("n").alias("_n"), "original"),
        "digests",
    )
    joined = records.join(
        shared, (records["payload_digest"] == shared["payload_digest"]) & (F.octet_length("payload") == F.col("_n")), "left"
    ).drop(shared["payload_digest"])
    is_original = F.col("page_id").isNotNull() & (F.col("page_id") == F.col("original"))
    return joined.withColumn("original", F.when(~is_original, F.col("original"))).drop("_n")


def _record_id(page_id: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws(" ", page_id.cast("string"), digest))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def write_archive(records: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """Write one WARC record per row; ``records`` comes from ``deduplicate``."""
    revisit = F.col("original").isNotNull()
    body = F.when(revisit, F.lit(b"")).otherwise(F.col("payload"))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(END))

    none = F.lit("")
    head = F.concat(
        F.lit(VERSION + END),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("payload_digest"))),
        line("WARC-Date", F.lit(DATE)),
        F.when(F.col("url").isNotNull(), line("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", " "))).otherwise(none),
        F.when(F.col("page_id").isNotNull(), line("X-Page-ID", F.col("page_id").cast("string"))).otherwise(none),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(
            revisit,
            F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", _record_id(F.col("original"), F.col("payload_digest")))),
        ).otherwise(none),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.octet_length(body).cast("string")),
        F.lit(END),
    )
    # Binary to string changes no byte, and the text writer writes them as they are.
    record = F.concat(F.encode(head, "UTF-8"), body).cast("string").alias("value")
    # Tasks write what they hold, without a shuffle of payloads; files end after so many records that
    # they have about ``file_bytes``.
    row = records.agg(F.sum(F.octet_length("payload") + F.lit(500)).alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    per_file = max(1, row["n"] * file_bytes // max(1, row["bytes"] or 0))
    records.select(record).write.option("lineSep", END + END).option("maxRecordsPerFile", per_file).text(path)


def _parse(content: bytes) -> Iterator[tuple]:
    at = 0
    while at < len(content):
        stop = content.index(b"\r\n\r\n", at)
        fields = dict(
            x.split(": ", 1) for x in content[at:stop].decode("utf-8").split(END)[1:]
        )
        start, n = stop + 4, int(fields["Content-Length"])
        page = fields.get("X-Page-ID")
        yield (
            fields["WARC-Record-ID"],
            fields["WARC-Type"],
            None if page is None else int(page),
            fields.get("WARC-Target-URI"),
            re.sub("^sha1:", "", fields["WARC-Payload-Digest"]),
            fields.get("WARC-Refers-To"),
            content[start : start + n],
        )
        at = start + n + 4


def _parse_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [x.split()[0] for x in RECORD_SCHEMA.split(", ")]
    for batch in batches:
        for content in batch["content"]:
            rows = list(_parse(bytes(content)))
            for i in range(0, len(rows), 2000):
                out = pd.DataFrame(rows[i : i + 2000], columns=names)
                out["page_id"] = out["page_id"].astype("Int64")
                yield out


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of all files under ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)
    return files.select("content").mapInPandas(_parse_files, RECORD_SCHEMA)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Add ``refers_to`` (page id of the response) and ``payload_bytes`` (of the full payload)."""
    slim = store(
        records.select("record_id", "record_type", "page_id", "url", "payload_digest", "refers_to_id", F.octet_length("payload").alias("n")),
        "warc-headers",
    )
    # Responses tied on an id share their record id; one of them answers.
    originals = store(
        slim.filter("record_type = 'response'").groupBy("record_id").agg(F.first("page_id").alias("to_page"), F.first("n").alias("to_n")),
        "warc-responses",
    )
    responses = slim.filter("record_type = 'response'").select(
        "page_id", "url", "payload_digest", "record_type", F.col("n").cast("long").alias("payload_bytes"), F.lit(None).cast("long").alias("refers_to")
    )
    revisits = slim.filter("record_type <> 'response'").join(
        originals.withColumnRenamed("record_id", "refers_to_id"), "refers_to_id", "left"
    )
    return responses.unionByName(
        revisits.select("page_id", "url", "payload_digest", "record_type", F.col("to_n").cast("long").alias("payload_bytes"), F.col("to_page").alias("refers_to"))
    )


def archive_pages(pages: DataFrame, path: str | None = None, min_bytes: int = 0, **columns) -> DataFrame:
    """Deduplicate, write to ``path`` (a new folder of the shared one by default), read back, resolve."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archive(deduplicate(as_records(pages, **columns), min_bytes), path)
    return resolve_revisits(read_archive(spark, path))
