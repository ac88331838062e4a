"""Content-addressed web archive: payloads stored once by digest, exact record headers apart, records by joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partura.llm.storage import Workspace

LEAST = 100  # bytes from which equal payloads are recorded as revisits
CRLF = "\r\n"
DATE = "2000-01-01T00:00:00Z"
BROADCAST_IDS = 500_000
HTTP = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}{CRLF}"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _clean(text: Column) -> Column:
    """A header value: line ends would end the field, so they are percent-encoded, as % itself is."""
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("%"), F.lit("%25"))
    return F.replace(F.replace(out, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def write_archive(pages: DataFrame, path: str, least: int = LEAST) -> None:
    """Write a record for each row of `pages` (page_id, url, html) to the folder `path`.

    `path`/payloads holds each different payload (the html in UTF-8, null as empty) once, under its SHA-256;
    `path`/records holds each record's exact header bytes and the digest of its payload. Of equal payloads of at
    least `least` bytes, the record with the smallest page_id is a response and the others are revisits of it.
    Smaller ones are all responses. Records without a page_id are responses always; rows with the same page_id
    and payload are all what that page_id is. A null url is as empty. Payloads never move to be compared: digests do, with
    an independent hash and the length, and a digest that stands for two payloads fails the job. Of those with several
    rows that of the smallest page_id is stored, from where it lies; only where rows repeat that page_id are they brought
    together, to keep one.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("payload")
    )
    found = rows.select(
        "page_id",
        "url",
        F.sha2("payload", 256).alias("digest"),
        F.octet_length("payload").cast("long").alias("bytes"),
        F.xxhash64("payload").alias("other"),
    )
    ws = Workspace(pages.sparkSession, "warc")
    found = ws.save(found, "found")
    first = found.groupBy("digest").agg(
        F.min("page_id").alias("first_id"),
        F.min(F.struct("bytes", "other")).alias("lo"),
        F.max(F.struct("bytes", "other")).alias("hi"),
    )
    same = F.when(F.col("lo") == F.col("hi"), F.col("first_id")).otherwise(
        F.raise_error(F.concat(F.lit("one digest for two payloads: "), F.col("digest"))).cast("long")
    )
    first = ws.save(first.select("digest", same.alias("first_id")), "first")
    records = found.join(first, "digest")
    revisit = F.coalesce((F.col("bytes") >= least) & (F.col("page_id") > F.col("first_id")), F.lit(False))
    head = [
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"{CRLF}WARC-Record-ID: "),
        _record_id(F.col("page_id")),
        F.lit(f"{CRLF}WARC-Date: {DATE}{CRLF}WARC-Target-URI: "),
        _clean(F.col("url")),
        F.lit(f"{CRLF}WARC-Payload-Digest: sha256:"),
        F.col("digest"),
        F.when(revisit, F.concat(F.lit(f"{CRLF}WARC-Refers-To: "), _record_id(F.col("first_id")))).otherwise(""),
        F.when(revisit, f"{CRLF}WARC-Profile: {PROFILE}").otherwise(""),
        F.lit(f"{CRLF}Content-Type: application/http; msgtype=response{CRLF}Content-Length: "),
        (F.when(revisit, 0).otherwise(F.col("bytes")) + len(HTTP)).cast("string"),
        F.lit(CRLF + CRLF),
    ]
    records.select(F.concat(*head).cast("binary").alias("header"), "digest").write.parquet(f"{path}/records")
    # One row for each digest goes to the store: rows of other page_ids stay where they are.
    owner = found.join(first, "digest").withColumn("own", F.col("page_id").eqNullSafe(F.col("first_id")))
    extra = ws.save(owner.where("not own").select(F.col("page_id").alias("_other"), "digest").distinct(), "extra")
    again = owner.where("own").groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
    again = ws.save(again, "again")
    digests = rows.select(F.sha2("payload", 256).alias("digest"), "payload", "page_id")
    same = (F.col("k.digest") == F.col("x.digest")) & F.col("page_id").eqNullSafe(F.col("_other"))
    kept = digests.alias("k").join(_small(extra).alias("x"), same, "left_anti").select("digest", "payload")
    if not again.isEmpty():
        repeated = kept.join(_small(again), "digest", "left_semi").dropDuplicates(["digest"])
        kept = kept.join(_small(again), "digest", "left_anti").unionByName(repeated)
    kept.write.parquet(f"{path}/payloads")
    ws.drop("found", "first", "extra", "again")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_IDS else df


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Records of an archive: header, and payload (of a revisit: that of the record it refers to).

    The payload is hashed again and must have the digest that its record's header states.
    """
    records = spark.read.schema("header binary, digest string").parquet(f"{path}/records")
    payloads = spark.read.schema("digest string, payload binary").parquet(f"{path}/payloads")
    joined = records.join(payloads, "digest", "left")
    payload = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload missing or damaged: "), F.col("digest"))).cast("binary")
    )
    return joined.select("header", payload.alias("payload"))


def record_bytes(records: DataFrame) -> DataFrame:
    """`records` with `record`, the original bytes: header, block and the closing line ends. A revisit's block has no payload."""
    revisit = F.col("header").cast("string").contains(f"{CRLF}WARC-Refers-To: ")
    body = F.when(revisit, F.lit("").cast("binary")).otherwise(F.col("payload"))
    end = F.lit(CRLF + CRLF).cast("binary")
    return records.select("*", F.concat("header", F.lit(HTTP).cast("binary"), body, end).alias("record"))


def _field(name: str, pattern: str = "([^\\r\\n]*)") -> Column:
    value = F.regexp_extract("head", f"\\r\\n{name}: {pattern}\\r\\n", 1)
    return F.when(value != "", value)


def parse(records: DataFrame) -> DataFrame:
    """page_id, url, payload, its digest in the header, record type and refers_to, from `record` alone.

    The header's Content-Length, counted back from the record's end, says where the block starts. A revisit's record holds
    no payload; its `payload` is that of the record it refers to, as `records` has it.
    """
    length = F.regexp_extract(F.col("record").cast("string"), "\\r\\nContent-Length: (\\d+)\\r\\n", 1).cast("int")
    size = F.octet_length("record")
    cut = records.withColumn("_block", size - length - len(CRLF + CRLF))
    cut = cut.withColumn("head", F.substr("record", F.lit(1), F.col("_block")).cast("string"))
    url = F.coalesce(_field("WARC-Target-URI"), F.lit(""))
    url = F.replace(F.replace(url, F.lit("%0D"), F.lit("\r")), F.lit("%0A"), F.lit("\n"))
    skip = len(HTTP)  # the block starts with the answer's own header
    inside = F.substr("record", F.col("_block") + 1 + skip, size - F.col("_block") - skip - len(CRLF + CRLF))
    refers = _field("WARC-Refers-To", "<urn:page:(-?\\d+)>").cast("long")
    return cut.select(
        _field("WARC-Record-ID", "<urn:page:(-?\\d+)>").cast("long").alias("page_id"),
        F.replace(url, F.lit("%25"), F.lit("%")).alias("url"),
        F.when(refers.isNull(), inside).otherwise(F.col("payload")).alias("payload"),
        _field("WARC-Payload-Digest", "sha256:([0-9a-f]+)").alias("payload_digest"),
        _field("WARC-Type").alias("record_type"),
        refers.alias("refers_to"),
    )


def round_trip(pages: DataFrame, ws: Workspace | None = None) -> DataFrame:
    """Write an archive of `pages` to the shared folder and read it back; one row for each page."""
    ws = ws or Workspace(pages.sparkSession, "archive")
    write_archive(pages, ws.path("archive"))
    return parse(record_bytes(read_archive(pages.sparkSession, ws.path("archive"))))
