"""A content-addressed WARC archive: payloads once by digest, exact record headers apart, records by joins.

``write`` makes two tables. ``payloads`` holds every payload that a response record needs, once, compressed, under its
SHA-256. ``records`` holds one row per page with the exact header bytes of its record. ``read`` joins
them, checks every payload against its digest, and gives back the full record bytes:
header, payload (empty in a revisit) and the closing line ends. Concatenated, they are a WARC/1.1 file.

Of records with equal payloads of ``least`` bytes or more, the smallest id is the response and the others are
revisits of it; smaller payloads are always responses. Edge cases: a null html is an empty payload; rows
that repeat the smallest id are all responses; a null id is a revisit when the same payload has an id that
is not null, and a response otherwise; a null url is an empty target; an empty table gives empty tables. A
payload that a third of all pages share is stored once; its digest is counted before rows move and its rows can be split
in the joins.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.session import run_folder

LEAST_BYTES = 100
DATE = "1970-01-01T00:00:00Z"
END = "\r\n"


def _compressed(batches):
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        digests, sizes, payloads = [], [], []
        for html in batch.column("html").to_pylist():
            payload = (html or "").encode()
            digests.append(hashlib.sha256(payload).hexdigest())
            sizes.append(len(payload))
            payloads.append(pack.compress(payload))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(digests, pa.string()),
             pa.array(sizes, pa.int64()), pa.array(payloads, pa.binary())],
            names=["page_id", "url", "payload_digest", "payload_bytes", "packed"])


def _rebuilt(batches):
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        heads, records, digests, sizes = [], [], [], []
        columns = [batch.column(x).to_pylist() for x in ("header", "payload_digest", "record_type", "packed")]
        for header, digest, kind, packed in zip(*columns):
            if packed is None:
                raise ValueError(f"no payload for {digest}")
            payload = unpack.decompress(packed)
            found = hashlib.sha256(payload).hexdigest()
            if found != digest:
                raise ValueError(f"payload of {digest} has digest {found}")
            digests.append(found)
            sizes.append(len(payload))
            records.append(header + (payload if kind == "response" else b"") + b"\r\n\r\n")
            heads.append(records[-1].partition(b"\r\n\r\n")[0].decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), pa.array(heads, pa.string()), pa.array(records, pa.binary()),
             pa.array(digests, pa.string()), pa.array(sizes, pa.int64())],
            names=["page_id", "head", "record", "payload_digest", "payload_bytes"])


def _header():
    """Header text of a record from its columns."""
    def line(name: str, *value):
        return F.concat(F.lit(f"{name}: "), *value, F.lit(END))

    hexes = F.md5(F.concat_ws("\x00", F.lit("record"), F.col("page_id").cast("string"), F.coalesce("url", F.lit("")), "payload_digest"))
    uuid = F.regexp_replace(hexes, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    revisit = F.col("record_type") == "revisit"
    text = F.concat(
        F.lit(f"WARC/1.1{END}"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.lit("<urn:uuid:"), uuid, F.lit(">")),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", F.translate(F.coalesce("url", F.lit("")), "\r\n", "")),
        line("WARC-Payload-Digest", F.lit("sha256:"), F.col("payload_digest")),
        F.when(revisit, F.concat(
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            line("WARC-Refers-To-Page", F.col("refers_to").cast("string")))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes")).cast("string")),
        F.lit(END))
    return F.encode(text, "UTF-8")


def write(pages: DataFrame, folder: str | None = None, least: int = LEAST_BYTES) -> str:
    """Write the archive of ``page_id, url, html`` rows; returns its folder."""
    spark = pages.sparkSession
    folder = folder or run_folder(spark, "llm-warc")
    packed = pages.select("page_id", "url", "html").mapInArrow(
        _compressed, "page_id long, url string, payload_digest string, payload_bytes long, packed binary")
    names = packed.select("page_id", "url", "payload_digest", "payload_bytes")
    names.write.parquet(f"{folder}/names")
    names = spark.read.schema(names.schema).parquet(f"{folder}/names")

    first = names.groupBy("payload_digest").agg(F.min("page_id").alias("first"))
    known = names.join(first, "payload_digest")
    again = (F.col("payload_bytes") >= least) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    typed = known.select(
        "page_id", "url", "payload_digest", "payload_bytes",
        F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("first")).alias("refers_to"))
    typed.withColumn("header", _header()).write.parquet(f"{folder}/records")

    # One payload per digest: all copies but those of the first id leave before payloads move.
    single = packed.select("payload_digest", "packed", "page_id")
    keep = first.select("payload_digest", F.col("first").alias("keep"))
    chosen = single.join(keep, "payload_digest").where(F.col("page_id").eqNullSafe(F.col("keep")))
    chosen.select("payload_digest", "packed").dropDuplicates(["payload_digest"]).write.parquet(f"{folder}/payloads")
    return folder


def records(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/records")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``page_id, head, record, payload_digest, payload_bytes`` with digest and size taken from the stored payload."""
    payloads = spark.read.parquet(f"{folder}/payloads")
    met = records(spark, folder).join(payloads, "payload_digest", "left")
    return met.select("page_id", "header", "payload_digest", "record_type", "packed").mapInArrow(
        _rebuilt, "page_id long, head string, record binary, payload_digest string, payload_bytes long")


def parsed(archive: DataFrame) -> DataFrame:
    """Adds ``record_type`` and ``refers_to`` as the head of each record says."""
    refers = F.regexp_extract("head", "\nWARC-Refers-To-Page: (-?\\d+)", 1)
    return archive.withColumn("record_type", F.regexp_extract("head", "\nWARC-Type: (\\w+)", 1)).withColumn(
        "refers_to", F.nullif(refers, F.lit("")).cast("long"))
