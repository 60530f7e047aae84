"""WARC archive, content-addressed.

An archive is a folder of two Parquet tables. ``payloads`` holds the bytes of every distinct payload once,
under its SHA-256; ``records`` holds the exact header of every record (all its bytes before the
payload) with the SHA-256 of its payload. Records with equal payloads are told by digest, and the
first of them in page order is the response, the others revisit it, as WARC 1.1 has it.

The digest is verified twice: when the archive is written, all payloads of a digest must agree in
length and in a second, independent digest; when it is read, the stored bytes must give the digest
they stand under and the one their records state. Original records come back by joining the two
tables. A payload that a third of all pages share is stored once, is combined in every task
before the shuffle, and its records meet it in a join that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.llm.common import NO_ID, staged, table
from stationlake.session import shared_dir

#: letters of base 32 (fixed value: RFC 4648)
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"
ID_PREFIX = "urn:x-page:"
#: of a revisit whose payload is that of an earlier record (fixed value: WARC 1.1)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESPONSE, REVISIT = "response", "revisit"
MIN_BYTES = 0              # payloads below this are all kept as responses

RECORD_SCHEMA = "header string, payload_key binary"
PAYLOAD_SCHEMA = "payload_key binary, payload binary"


# ---- columns ----------------------------------------------------------------------------------


def base32(hexed: Column) -> Column:
    """Base-32 text of a digest in hexadecimal whose length is a multiple of five digits (SHA-1: 40)."""
    def four(group: Column) -> Column:  # five hexadecimal digits are four letters
        bits = F.conv(group, 16, 10).cast("int")
        return F.concat(*[F.substr(F.lit(BASE32), F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1)) for shift in (15, 10, 5, 0)])

    size = F.length(hexed)
    groups = F.transform(F.sequence(F.lit(0), F.floor(size / 5).cast("int") - 1), lambda i: F.substr(hexed, i * 5 + 1, F.lit(5)))
    return F.array_join(F.transform(groups, four), "")


def header_text(kind: Column, page_id: Column, url: Column, sha1: Column, n_bytes: Column, first: Column,
                date: str = DATE) -> Column:
    """All of a record before its payload: WARC fields, an empty line, the HTTP head, an empty line."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    urn = lambda i: F.concat(F.lit(f"<{ID_PREFIX}"), F.coalesce(i.cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    n_bytes.cast("string"), F.lit(CRLF + CRLF))
    # a line break in a url would end the field
    uri = F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    revisit = kind == REVISIT
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(n_bytes)
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"), line("WARC-Type", kind), line("WARC-Record-ID", urn(page_id)),
        F.when(url.isNull(), "").otherwise(line("WARC-Target-URI", uri)), F.lit(f"WARC-Date: {date}{CRLF}"),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), sha1)),
        F.when(revisit, F.concat(F.lit(f"WARC-Profile: {PROFILE}{CRLF}"), line("WARC-Refers-To", urn(first)))).otherwise(""),
        F.lit(f"Content-Type: application/http;msgtype=response{CRLF}"), line("Content-Length", block.cast("string")),
        F.lit(CRLF), http)


def field(header: Column, name: str) -> Column:
    """Value of a WARC field of a header, null if it has none. HTTP fields, which come after an empty line, are not read."""
    value = F.regexp_extract(F.substring_index(header, CRLF + CRLF, 1), rf"\r\n{name}: ([^\r\n]*)", 1)
    return F.when(F.substring_index(header, CRLF + CRLF, 1).contains(f"{CRLF}{name}: "), value)


def _page(urn: Column) -> Column:
    return F.nullif(F.regexp_extract(urn, rf"^<{ID_PREFIX}(-?\d*)>$", 1), F.lit("")).cast("long")


# ---- writing and reading ----------------------------------------------------------------------


def write_archive(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES, date: str = DATE) -> None:
    """One record per row of ``pages`` (page_id, url, html) in a new archive at ``path``.

    The payload is the html in UTF-8 (null: empty). Of equal payloads of at least ``min_bytes`` bytes, the
    record of smallest page_id is a response and the others revisit it; shorter ones are all
    responses. Repeated rows of that page_id are all responses; a row without a page_id counts as
    the last one. A null url has no field; line breaks in a url are escaped. Other columns are not read.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.coalesce(F.col("page_id").cast("long"), F.lit(NO_ID)).alias("page_id"),
                        F.col("url").cast("string").alias("url"), payload.alias("payload"))
    keyed = staged(rows.select("page_id", "url", F.unhex(F.sha2("payload", 256)).alias("payload_key"), F.octet_length("payload").cast("long").alias("n_bytes"),
                               F.sha1("payload").alias("sha1")), "warc-digests")
    # one row per distinct payload and task before the shuffle, whatever number of pages share it
    firsts = keyed.groupBy("payload_key").agg(
        F.min("page_id").alias("first"), F.min("n_bytes").alias("n1"), F.max("n_bytes").alias("n2"),
        F.min("sha1").alias("s1"), F.max("sha1").alias("s2"))
    same = (F.col("n1") == F.col("n2")) & (F.col("s1") == F.col("s2"))
    firsts = firsts.select("payload_key", F.when(same, F.col("first")).otherwise(
        F.raise_error(F.concat(F.lit("different payloads have the SHA-256 "), F.hex("payload_key")))).alias("first"))
    later = (F.col("n_bytes") >= min_bytes) & (F.col("page_id") > F.col("first"))
    known = lambda c: F.when(F.col(c) < NO_ID, F.col(c))
    header = header_text(F.when(later, REVISIT).otherwise(RESPONSE), known("page_id"), F.col("url"), base32(F.col("sha1")),
                         F.col("n_bytes"), known("first"), date)
    keyed.join(firsts, "payload_key").select(header.alias("header"), "payload_key").write.parquet(f"{path}/records")
    # equal payloads of a task become one before they are shuffled
    (rows.select(F.unhex(F.sha2("payload", 256)).alias("payload_key"), "payload").groupBy("payload_key").agg(F.first("payload").alias("payload"))
     .write.parquet(f"{path}/payloads"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of an archive: page_id, url, record_type, refers_to, header, payload, payload_bytes, payload_digest.

    ``payload`` is the full payload, of revisits too; length and SHA-1 are taken from the stored bytes. Bytes
    that do not give the digest they are kept under, or the one that a record states, are an error.
    """
    stored = spark.read.schema(PAYLOAD_SCHEMA).parquet(f"{path}/payloads").select(
        F.when(F.unhex(F.sha2("payload", 256)) == F.col("payload_key"), F.col("payload_key")).otherwise(
            F.raise_error(F.concat(F.lit("damaged payload "), F.hex("payload_key")))).alias("payload_key"),
        "payload", F.octet_length("payload").cast("long").alias("payload_bytes"), base32(F.sha1("payload")).alias("payload_digest"))
    records = spark.read.schema(RECORD_SCHEMA).parquet(f"{path}/records")
    stated = F.substring_index(field(F.col("header"), "WARC-Payload-Digest"), ":", -1)
    return records.join(stored, "payload_key", "left").select(
        _page(field(F.col("header"), "WARC-Record-ID")).alias("page_id"), field(F.col("header"), "WARC-Target-URI").alias("url"),
        field(F.col("header"), "WARC-Type").alias("record_type"), _page(field(F.col("header"), "WARC-Refers-To")).alias("refers_to"),
        "header", "payload", "payload_bytes",
        F.when(stated == F.col("payload_digest"), F.col("payload_digest")).otherwise(
            F.raise_error(F.concat(F.lit("no payload for record "), field(F.col("header"), "WARC-Record-ID")))).alias("payload_digest"))


def export_warc(records: DataFrame, path: str, compression: str = "none") -> None:
    """The original records as ``.warc`` text files: header, payload (none for a revisit), two line ends."""
    body = F.when(F.col("record_type") == RESPONSE, F.decode("payload", "UTF-8")).otherwise("")
    (records.select(F.concat("header", body).alias("value")).write.option("lineSep", CRLF + CRLF)
     .option("compression", compression).text(path))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "warc")
    write_archive(table(spark, sf_dir, "pages"), path)
    return read_records(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP12_SQL = f"""
with payloads as (select page_id, encode(coalesce(html, '')) as payload from pages),
digests as (select page_id, octet_length(payload) as payload_bytes, sha256(payload) as k,
                   unhex(sha1(payload))::bit::varchar as bits from payloads),
firsts as (select *, min(page_id) over (partition by k) as first from digests)
select page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('{BASE32}',
         (list_sum(list_transform(range(5), lambda j: substr(bits, i * 5 + j + 1, 1)::int * (1 << (4 - j)::int)))::int) + 1, 1)), '') as payload_digest,
       case when payload_bytes >= {MIN_BYTES} and page_id > first then '{REVISIT}' else '{RESPONSE}' end as record_type,
       case when payload_bytes >= {MIN_BYTES} and page_id > first then first end as refers_to
from firsts"""
