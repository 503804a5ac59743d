"""Content-addressed WARC archive: payload bytes once, exact record headers beside them, records by join.

``write`` stores two Parquet tables: ``payloads(address, n_bytes, payload)`` with every distinct payload
once under its SHA-256, and ``headers(record_id, header, block_head, address)`` with the exact bytes
that stand before the payload of each record. ``records`` joins them to the original record bytes and
raises where stored bytes do not have their address. ``parse`` reads the fields back from record bytes.

Copies share a payload however many they are: the first record of a payload is a grouped minimum
(partial aggregates), joined back on the address; a hot payload is split by the skew join.

Defined cases: NULL payload text is the empty payload; NULL page_id or url is an empty header value and
reads back as NULL; rows that repeat a page_id stay, and all of them with the smallest id of a payload
are responses; extra columns are ignored; an empty table gives empty tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def base32(hex_digest: Column, groups: int = 4) -> Column:
    """Upper-case base32 of a hexadecimal digest of 40 * ``groups`` bits, five bytes at a time."""
    parts = [F.lpad(F.conv(F.substring(hex_digest, 10 * g + 1, 10), 16, 32), 8, "0") for g in range(groups)]
    # Digits of base 32 numbers and the base32 alphabet, position by position.
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write(pages: DataFrame, folder: str, min_shared_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """ACTION: archive ``pages(page_id, url, html)``. Of records with equal payloads of at least
    ``min_shared_bytes`` the one with the smallest page_id is a response, the others revisit it."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    keyed = rows.select("page_id", "url", F.sha2("payload", 256).alias("address"), F.sha1("payload").alias("sha"),
                        F.octet_length("payload").alias("n_bytes"))
    rows.select(F.sha2("payload", 256).alias("address"), F.octet_length("payload").alias("n_bytes"), "payload") \
        .dropDuplicates(["address"]).write.parquet(f"{folder}/payloads")
    firsts = keyed.groupBy("address").agg(F.min("page_id").alias("first"))
    joined = keyed.join(firsts, "address")
    own = F.col("page_id").eqNullSafe(F.col("first")) | (F.col("n_bytes") < min_shared_bytes)
    text = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    head = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")
    header = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(own, F.lit("response")).otherwise(F.lit("revisit")),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), text, F.lit(">\r\nWARC-Target-URI: "),
        F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", " "),
        F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Payload-Digest: sha1:"), base32(F.col("sha")),
        F.when(own, F.lit("")).otherwise(F.concat(
            F.lit("\r\nWARC-Refers-To: <urn:page:"), F.col("first").cast("string"),
            F.lit(">\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.octet_length(head) + F.when(own, F.col("n_bytes")).otherwise(F.lit(0))).cast("string"), F.lit("\r\n\r\n"))
    joined.select("page_id", header.cast("binary").alias("header"), head.cast("binary").alias("block_head"), own.alias("full"),
                  "address").write.parquet(f"{folder}/headers")


def records(spark: SparkSession, folder: str) -> DataFrame:
    """``page_id, record, payload``: record bytes rebuilt from the stored parts, and the payload it has or
    refers to. Stored bytes that do not have their address raise an error."""
    payloads = spark.read.schema("address string, n_bytes int, payload binary").parquet(f"{folder}/payloads")
    headers = spark.read.schema("page_id bigint, header binary, block_head binary, full boolean, address string") \
        .parquet(f"{folder}/headers")
    good = (F.sha2("payload", 256) == F.col("address")) & (F.octet_length("payload") == F.col("n_bytes"))
    checked = payloads.select("address", F.when(good, F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("damaged payload "), F.col("address")))).alias("payload"))
    body = F.when(F.col("full"), F.col("payload")).otherwise(F.lit(b""))
    return headers.join(checked, "address").select(
        "page_id", F.concat("header", "block_head", body, F.lit(b"\r\n\r\n")).alias("record"), "payload")


def parse(rebuilt: DataFrame) -> DataFrame:
    """Fields read back from ``record`` bytes: page_id, url, record_type, payload_digest, refers_to, content
    length, and payload_bytes of ``payload``. A record whose lengths do not fit raises ValueError."""
    schema = ("page_id bigint, url string, record_type string, payload_digest string, refers_to bigint, "
              "payload_bytes bigint, payload binary")

    def number(uri: bytes | None) -> int | None:
        digits = (uri or b"").removeprefix(b"<urn:page:").removesuffix(b">")
        return int(digits) if digits else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for record, payload in zip(batch.column(0), batch.column(1)):
                raw, stored = record.as_py(), payload.as_py()
                head, _, rest = raw.partition(b"\r\n\r\n")
                lines = head.split(b"\r\n")
                fields = dict(line.split(b": ", 1) for line in lines[1:])
                block = rest[:int(fields[b"Content-Length"])]
                if lines[0] != b"WARC/1.1" or rest[len(block):] != b"\r\n\r\n":
                    raise ValueError("not a whole WARC record")
                kind = fields[b"WARC-Type"].decode()
                body = block.partition(b"\r\n\r\n")[2] if kind == "response" else stored
                if body != stored:
                    raise ValueError("record and stored payload differ")
                url = fields[b"WARC-Target-URI"].decode()
                out.append((number(fields[b"WARC-Record-ID"]), url or None, kind,
                            fields[b"WARC-Payload-Digest"].decode().removeprefix("sha1:"),
                            number(fields.get(b"WARC-Refers-To")), len(body), body))
            names = ["page_id", "url", "record_type", "payload_digest", "refers_to", "payload_bytes", "payload"]
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
            columns = list(zip(*out)) if out else [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return rebuilt.select("record", "payload").mapInArrow(run, schema)
