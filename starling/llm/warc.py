"""Content-addressed WARC archive: payload bytes once per verified SHA-256, exact record headers apart, joined on read.

An archive is a folder with two Parquet tables: ``payloads(digest, payload)`` and ``headers(page_id, digest, header)``,
where ``header`` is the record's text up to its payload, byte for byte.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starling.llm.common import small_side, table

# Payloads below this many bytes are never worth a revisit record.
MIN_REVISIT_BYTES = 100
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _uuid(*parts):
    """A record id that depends on the page and its payload only, so a rerun writes the same archive."""
    h = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-"),
                    F.substring(h, 13, 4), F.lit("-"), F.substring(h, 17, 4), F.lit("-"), F.substring(h, 21, 12), F.lit(">"))


def _lines(*lines):
    """Header lines joined with CRLF; null lines are left out."""
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"))


def archive(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
            min_revisit_bytes: int = MIN_REVISIT_BYTES, date: str = DATE) -> None:
    """Write one WARC/1.1 record per row of ``pages`` to the archive folder ``path`` (which must not exist).

    Records with equal payloads of at least ``min_revisit_bytes`` share one stored payload: the one with the smallest
    id is a ``response``, the others ``revisit`` it; smaller payloads are all responses (and stored once, too). Equal
    digests must have equal lengths and a second equal hash, else the job fails. A null payload is empty; a null url has
    no target line; ids that are null come last, and if all of a payload are null each is a response; a row repeated with
    its id is a response (or a revisit) each time. Line breaks in an url are percent-encoded. Payload bytes are shuffled
    only where a digest occurs more than once, and combine before that shuffle.
    """
    fields = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                          F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"))
    fields = fields.withColumn("digest", F.sha2("payload", 256))
    facts = table(fields.select("id", "url", "digest", F.octet_length("payload").cast("long").alias("bytes"),
                                F.xxhash64("payload").alias("check")), "warc-facts")
    groups = table(facts.groupBy("digest").agg(F.min("id").alias("keeper"), F.count(F.lit(1)).alias("n"),
                                               ((F.min("bytes") == F.max("bytes")) & (F.min("check") == F.max("check")))
                                               .alias("verified")), "warc-groups")
    groups = groups.withColumn("keeper", F.when(F.col("verified"), F.col("keeper")).otherwise(
        F.raise_error(F.concat(F.lit("different payloads under digest "), F.col("digest")))))

    repeated = groups.where("n > 1").select("digest")
    repeated = small_side(repeated)
    once = fields.join(repeated, "digest", "left_anti").select("digest", "payload")
    shared = fields.join(repeated, "digest", "left_semi").groupBy("digest").agg(F.first("payload").alias("payload"))
    once.unionByName(shared).write.option("compression", "zstd").parquet(f"{path}/payloads")

    revisit = (F.col("bytes") >= min_revisit_bytes) & F.col("keeper").isNotNull() & ~F.col("id").eqNullSafe(F.col("keeper"))
    http = _lines(F.lit("HTTP/1.1 200 OK"), F.lit("Content-Type: text/html; charset=utf-8"),
                  F.concat(F.lit("Content-Length: "), F.col("bytes")))

    def line(name, value):
        return F.concat(F.lit(f"{name}: "), value)

    keeper = F.when(F.col("revisit"), F.col("keeper"))
    head = _lines(
        F.lit("WARC/1.1"), line("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        line("WARC-Record-ID", _uuid(F.col("id"), F.col("digest"))), line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        line("WARC-Profile", F.when(F.col("revisit"), PROFILE)),
        line("WARC-Refers-To", F.when(F.col("revisit"), _uuid(F.col("keeper"), F.col("digest")))),
        line("WARC-Refers-To-Page", keeper.cast("string")), line("WARC-Page", F.col("id").cast("string")),
        line("WARC-Payload-Length", F.col("bytes").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response"),
        line("Content-Length", (F.octet_length("http") + F.when(F.col("revisit"), 0).otherwise(F.col("bytes"))).cast("string")))
    headers = (facts.join(groups.select("digest", "keeper"), "digest").withColumn("revisit", revisit)
               .withColumn("http", http)
               .select(F.col("id").alias("page_id"), "digest", F.concat(head, F.col("http")).cast("binary").alias("header")))
    headers.write.option("compression", "zstd").parquet(f"{path}/headers")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, digest, header, payload`` of every record: the original record is header, payload, CRLF CRLF.

    Stored payloads join the headers by digest (a hot digest is one payload row, its many headers are split by AQE); each
    payload's digest and each record's lengths are checked again, and a mismatch fails the job.
    """
    headers = spark.read.parquet(f"{path}/headers")
    payloads = spark.read.parquet(f"{path}/payloads")
    payloads = payloads.withColumn("payload", F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("stored payload does not match "), F.col("digest"))).cast("binary")))
    return headers.join(payloads, "digest").select("page_id", "digest", "header", "payload")


def record_bytes(records: DataFrame) -> DataFrame:
    """``page_id, record``: the bytes of each WARC record (a revisit record has the HTTP header block only)."""
    is_revisit = F.col("header").cast("string").contains("\r\nWARC-Type: revisit\r\n")
    body = F.when(is_revisit, F.lit(b"")).otherwise(F.col("payload"))
    return records.select("page_id", F.concat(F.col("header"), body, F.lit(b"\r\n\r\n")).alias("record"))


def describe(records: DataFrame) -> DataFrame:
    """Per record of ``read_archive``: what its header says, checked against its payload."""
    text = F.col("header").cast("string")
    id_type = records.schema["page_id"].dataType.simpleString()

    def field(name):
        value = F.regexp_extract(text, rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
        return F.when(value != "", value)

    out = records.select("page_id", F.col("digest").alias("payload_digest"), F.octet_length("payload").cast("long").alias("payload_bytes"),
                         field("WARC-Type").alias("record_type"), field("WARC-Refers-To-Page").cast(id_type).alias("refers_to"),
                         field("WARC-Payload-Length").cast("long").alias("stated"), field("WARC-Payload-Digest").alias("named"))
    sound = (F.col("stated") == F.col("payload_bytes")) & (F.col("named") == F.concat(F.lit("sha256:"), F.col("payload_digest")))
    return out.select("page_id", F.when(sound, F.col("payload_bytes")).otherwise(
        F.raise_error(F.concat(F.lit("header and payload differ: "), F.col("payload_digest"))).cast("long")).alias("payload_bytes"),
        "payload_digest", "record_type", "refers_to")
