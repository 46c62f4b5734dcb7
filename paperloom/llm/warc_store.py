"""A content-addressed web archive: every payload once, by its digest; every record's header as it was.

Two tables make an archive. ``headers`` holds the exact bytes of a record's WARC and
HTTP header with the digest of its payload, ``payloads`` the bytes of each distinct
payload under its SHA-256. A join of the two gives the original records back.

A digest is trusted only as far as it is verified: at writing, all payloads of a digest
must agree in length and in a second digest of another family, at reading a stored
payload must still have the digest that it stands under; otherwise the job ends with an
error that names it.

Of records with equal payloads of ``least`` bytes or more the one with the smallest id
is a response, the others revisit it. Payloads are not shuffled to find that: ids and
digests are, dealt by digest and salt, so that copies, however many, stand under many
keys. Which rows are left out of ``payloads`` is then a list of (digest, id), broadcast
if its measured size allows and joined by both columns if not.

Edge cases: a null payload is an empty one. A record without an id revisits the smallest
id of its payload; where no record of a payload has an id, all are responses. Records
that repeat an id and a payload are alike: where theirs is the smallest id all are
responses, and the payload is stored once. Control characters, spaces and line ends
of an address are percent-encoded in its header, a null or empty address has no header line.
An empty table gives an empty archive. Columns beside those named are not stored.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import settled, shared_dir, sized, table

#: Payloads of so many bytes are worth a revisit.
LEAST = 100
#: Copies of one payload are dealt to so many keys.
SALTS = 64
#: The date of records whose source has none.
DATE = "1970-01-01T00:00:00Z"


def _address(url: Column) -> Column:
    """An address that cannot end its header line."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(url, "\r", "%0D"), "\n", "%0A"), r"[\x00-\x20\x7f]", "%20")


def _record_id(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(">"))


def _header(date: str) -> Column:
    """The WARC header and the HTTP header of a record, as they stand before its payload."""
    revisit, lines = F.col("revisit"), "\r\n"
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{lines}Content-Type: text/html; charset=utf-8{lines}Content-Length: "), F.col("size").cast("string"), F.lit(lines * 2))
    block = F.length(http) + F.when(revisit, 0).otherwise(F.col("size"))
    named = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(lines))
    return F.concat(
        F.lit(f"WARC/1.1{lines}"),
        named("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        named("WARC-Record-ID", _record_id(F.col("id"))),
        named("WARC-Date", F.lit(date)),
        F.when(F.coalesce(F.col("url"), F.lit("")) != "", named("WARC-Target-URI", _address(F.col("url")))).otherwise(F.lit("")),
        named("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.lower(F.hex("digest")))),
        F.when(revisit, F.concat(named("WARC-Refers-To", _record_id(F.col("first"))), named("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))).otherwise(F.lit("")),
        named("Content-Type", F.lit("application/http; msgtype=response")),
        named("Content-Length", block.cast("string")),
        F.lit(lines),
        http,
    ).cast("binary")


def write_archive(pages: DataFrame, place: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = LEAST, date: str = DATE) -> None:
    """Writes ``pages`` as ``place/headers`` and ``place/payloads``."""
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit(b""))
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"), payload.alias("payload"))
    digest = F.unhex(F.sha2("payload", 256)).alias("digest")
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt")
    narrow = settled(rows.select("id", "url", digest, F.octet_length("payload").cast("long").alias("size"), F.unhex(F.md5("payload")).alias("second"), salt))
    salted = narrow.groupBy("digest", "salt").agg(*(f(c).alias(f"{f.__name__}_{c}") for c in ("size", "second") for f in (F.min, F.max)), F.min("id").alias("own_first"), F.count("*").alias("n"))
    of = Window.partitionBy("digest")  # at most SALTS rows
    apart = (F.min("min_size").over(of) != F.max("max_size").over(of)) | (F.min("min_second").over(of) != F.max("max_second").over(of))
    wrong = F.raise_error(F.concat(F.lit("two payloads under one digest: "), F.hex("digest")))
    firsts = salted.select(F.col("digest").alias("f_digest"), F.col("salt").alias("f_salt"), F.when(apart, wrong.cast("long")).otherwise(F.min("own_first").over(of)).alias("first"), F.sum("n").over(of).alias("n"))
    held = (F.col("digest") == F.col("f_digest")) & (F.col("salt") == F.col("f_salt"))
    records = settled(narrow.join(firsts, held).select("id", "url", "digest", "size", "first", "n"))
    is_first = F.col("id").eqNullSafe(F.col("first"))
    headers = records.withColumn("revisit", (F.col("size") >= least) & F.col("first").isNotNull() & ~is_first)
    headers.select("id", "digest", salt, _header(date).alias("header")).write.parquet(f"{place}/headers")

    # what is not stored, and what would be stored more than once
    several = records.filter("n > 1").groupBy("digest", "id", "first").agg(F.count("*").alias("again"))
    several = settled(several.select(F.hex("digest").alias("x_digest"), F.col("id").alias("x_id"), is_first.alias("x_kept"), F.col("again").alias("x_again")).filter("not x_kept or x_again > 1"))
    found = (F.hex("digest") == F.col("x_digest")) & F.col("id").eqNullSafe(F.col("x_id"))
    stored = rows.select("id", digest, "payload").join(sized(several), found, "left")
    once = stored.filter("x_kept is null").select("digest", "payload")
    repeated = several.filter("x_kept")
    if not repeated.isEmpty():
        once = once.unionAll(stored.filter("x_kept").select("digest", "payload").dropDuplicates(["digest"]))
    once.write.parquet(f"{place}/payloads")


def read_records(spark: SparkSession, place: str, derived: Mapping[str, Column] | None = None) -> DataFrame:
    """The archive's records: ``id, header``, and of each record's full payload what ``derived`` asks for.

    ``derived`` holds columns over ``payload``, by name; they are computed once for each
    stored payload, before the join. Without it each record has ``payload`` and ``record``,
    the record's bytes as they were; a revisit's hold no payload.
    """
    wrong = F.raise_error(F.concat(F.lit("a payload does not have its digest: "), F.hex("digest")))
    stored = spark.read.parquet(f"{place}/payloads")
    verified = F.when(F.unhex(F.sha2("payload", 256)) == F.col("digest"), F.col("payload")).otherwise(wrong.cast("binary"))
    named = {"payload": F.col("payload")} if derived is None else derived
    stored = stored.withColumn("payload", verified).select(F.col("digest").alias("p_digest"), *(c.alias(n) for n, c in named.items()))
    headers = spark.read.parquet(f"{place}/headers")
    needed = headers.select(F.col("digest").alias("n_digest"), F.col("salt").alias("n_salt")).distinct()  # at most SALTS a digest
    needed = needed.join(stored, F.col("n_digest") == F.col("p_digest"), "left")
    lost = F.raise_error(F.concat(F.lit("no payload under the digest "), F.hex("n_digest")))
    needed = needed.withColumn("n_digest", F.when(F.col("p_digest").isNull(), lost.cast("binary")).otherwise(F.col("n_digest")))
    got = headers.join(needed, (F.col("digest") == F.col("n_digest")) & (F.col("salt") == F.col("n_salt")), "left").select("id", "digest", "header", *named)
    if derived is None:
        own = F.when(header_value("WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
        got = got.withColumn("record", F.concat("header", own, F.lit(b"\r\n\r\n")))
    return got


def header_value(name: str) -> Column:
    """The value of a line of the WARC header, null without one."""
    text = F.decode("header", "utf-8")
    return F.nullif(F.regexp_extract(F.substring_index(text, "\r\n\r\n", 1), rf"(?:^|\r\n){name}: ([^\r\n]*)", 1), F.lit(""))


def read_back(spark: SparkSession, place: str) -> DataFrame:
    """Id, type, payload size and digest of each record and what it refers to, from its header and its stored payload."""
    got = read_records(spark, place, {"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha2("payload", 256)})
    number = lambda name: F.nullif(F.regexp_extract(header_value(name), r"urn:page:(-?\d+)", 1), F.lit("")).cast("long")
    return got.select(number("WARC-Record-ID").alias("page_id"), "payload_bytes", "payload_digest", header_value("WARC-Type").alias("record_type"), number("WARC-Refers-To").alias("refers_to"))


def query(spark, sf_dir: str) -> DataFrame:
    place = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archive(table(spark, sf_dir, "pages"), place)
    return read_back(spark, place)


SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS digest, coalesce(html, '') AS html FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM p),
r AS (SELECT *, n >= 100 AND page_id <> first AS revisit FROM f)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest, CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN revisit THEN first END AS refers_to FROM r
"""
