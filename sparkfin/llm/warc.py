"""WARC records in a content-addressed archive.

A record is its exact header block, the payload and two line ends.  The
archive keeps two tables: ``payloads`` stores the bytes of each distinct
payload once under its SHA-256, ``records`` keeps every record's header block
and the address of its payload.  Records are rebuilt by joining the two; the
address is checked against the stored bytes while they are read.

Of records with equal payloads that with the smallest id is the response; the
others are revisits that name it.  The winner of a payload is found by a
map-side combined minimum over digests, and a payload travels to the store
keyed by (row, address), so copies that a third of all pages share never meet
in one task.

Defined results: a null payload is an empty one; a null or repeated id is a
record like any other (the smallest non-null id answers; rows repeated with
the same id and payload are all responses); a null address is left out of the
header; control characters in a header value become blanks; an empty table
gives an empty archive; other columns are not read.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import written

HEX32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: date of all records of a run; a parameter so that reruns give equal bytes
DATE = "1970-01-01T00:00:00Z"
CRLF = "\r\n"


def base32_sha1(payload) -> F.Column:
    """Bare upper-case base32 SHA-1: 160 bits are eight times 20 bits, that is
    five hexadecimal digits or four base32 digits."""
    digest = F.sha1(payload)
    parts = (F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8))
    return F.translate(F.concat(*parts), HEX32, BASE32)


def _line(name: str, value) -> F.Column:
    clean = F.regexp_replace(value.cast("string"), r"[\x00-\x1F\x7F]", " ")
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), clean, F.lit(CRLF))).otherwise("")


def _urn(value) -> F.Column:
    return F.concat(F.lit("<urn:record:"), value.cast("string"), F.lit(">"))


def _row_key(id_col) -> F.Column:
    return F.coalesce(id_col.cast("string"), F.lit(""))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", uri_col: str = "url",
                  payload_col: str = "html", smallest: int = 0, date: str = DATE) -> None:
    """Write the archive of ``pages`` below ``path`` (``payloads``, ``records``).
    Payloads shorter than ``smallest`` bytes are never revisits."""
    src = pages.select(F.col(id_col).alias("id"), F.col(uri_col).cast("string").alias("uri"),
                       F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    src = src.withColumn("row", _row_key(F.col("id"))).withColumn("address", F.sha2("payload", 256))
    facts = written(src.select("id", "row", "uri", "address", F.octet_length("payload").cast("long").alias("bytes"),
                               base32_sha1(F.col("payload")).alias("digest")), "warc-facts")
    first = facts.groupBy("address").agg(F.min("id").alias("first_id"))

    # one row brings the bytes of each address; repeated rows fall together in
    # the join's own partitioning
    bring = first.select(_row_key(F.col("first_id")).alias("row"), "address")
    src.select("row", "address", "payload").join(bring, ["row", "address"]).dropDuplicates(["row", "address"]) \
        .select("address", "payload").write.option("compression", "zstd").parquet(f"{path}/payloads")

    again = (F.col("bytes") >= smallest) & F.col("id").isNotNull() & (F.col("id") != F.col("first_id"))
    again = again | ((F.col("bytes") >= smallest) & F.col("id").isNull() & F.col("first_id").isNotNull())
    kind = F.when(again, "revisit").otherwise("response")
    refers = F.when(again, F.col("first_id"))
    header = F.concat(
        F.lit("WARC/1.1" + CRLF), _line("WARC-Type", kind), _line("WARC-Record-ID", _urn(F.coalesce(F.col("id").cast("string"), F.lit("null")))),
        _line("WARC-Date", F.lit(date)), _line("WARC-Target-URI", F.col("uri")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")), _line("WARC-Refers-To", _urn(refers)),
        _line("WARC-Profile", F.when(again, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(again, F.lit(0)).otherwise(F.col("bytes"))), F.lit(CRLF))
    facts.join(first, "address").select("id", "address", header.alias("header")) \
        .write.option("compression", "zstd").parquet(f"{path}/records")


def _field(name: str) -> F.Column:
    return F.nullif(F.regexp_extract("header", f"\r\n{name}: ([^\r\n]*)\r\n", 1), F.lit(""))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Read an archive: one row per record with the parsed header fields, the
    full payload, and ``record``, the exact bytes.  Bytes that do not give
    their address or the digest in the header, and records that are not as long
    as their header states, stop the read."""
    store = spark.read.parquet(f"{path}/payloads").select(
        "address", "payload", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("found"), base32_sha1(F.col("payload")).alias("found_digest"))
    r = spark.read.parquet(f"{path}/records").withColumns({
        "record_type": _field("WARC-Type"), "digest": F.regexp_replace(_field("WARC-Payload-Digest"), "^sha1:", ""),
        "refers_to": F.regexp_extract(_field("WARC-Refers-To"), "^<urn:record:(.*)>$", 1), "uri": _field("WARC-Target-URI")})
    r = r.join(store, "address", "left")
    sound = F.coalesce((F.col("found") == F.col("address")) & (F.col("found_digest") == F.col("digest")), F.lit(False))
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    record = F.concat(F.col("header").cast("binary"), body, F.lit(CRLF + CRLF).cast("binary"))
    # the rebuilt bytes have the length that the header states
    stated = F.octet_length("header") + _field("Content-Length").cast("long") + 4
    checked = F.when(~sound, F.raise_error(F.concat(F.lit("damaged payload "), "address"))) \
        .when(F.coalesce(F.octet_length(record) == stated, F.lit(False)), F.col("digest")) \
        .otherwise(F.raise_error(F.concat(F.lit("damaged record "), "address")))
    return r.select("id", "uri", "record_type", F.nullif("refers_to", F.lit("")).alias("refers_to"), "payload_bytes",
                    checked.alias("payload_digest"), "payload", "header",
                    record.alias("record"))


def write_warc_files(records: DataFrame, path: str, per_file: int = 10_000) -> None:
    """Export records as gzip-compressed WARC files of at most ``per_file``
    records.  The writer's line separator is the record separator."""
    text = F.concat("header", F.when(F.col("record_type") == "response", F.col("payload").cast("string")).otherwise(""))
    records.select(text).write.option("lineSep", CRLF + CRLF).option("compression", "gzip") \
        .option("maxRecordsPerFile", per_file).text(path)


def read_warc_files(spark: SparkSession, path: str) -> DataFrame:
    """Parse WARC files back to (header, payload); a task holds one file."""
    def parse(batches):
        import gzip

        import pandas as pd
        for batch in batches:
            for name, data in zip(batch["path"], batch["content"], strict=True):
                data = gzip.decompress(data) if name.endswith(".gz") else bytes(data)
                at, heads, bodies = 0, [], []
                while at < len(data):
                    end = data.index(b"\r\n\r\n", at) + 4
                    head = data[at:end]
                    size = next(int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                    heads.append(head.decode())
                    bodies.append(data[end:end + size])
                    at = end + size + 4
                yield pd.DataFrame({"header": heads, "payload": bodies})
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(parse, "header string, payload binary")


ORACLE = r"""
with p as (select page_id, coalesce(html, '') as body from pages),
d as (select page_id, body, strlen(body)::bigint as payload_bytes, sha1(body) as h from p),
w as (select *, min(page_id) over (partition by body) as first_id from d)
select page_id, payload_bytes,
  list_aggregate(list_transform(generate_series(0, 31), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::bigint >> (15 - 5 * (i % 4))) & 31)::int, 1)), 'string_agg', '') as payload_digest,
  case when page_id <> first_id then 'revisit' else 'response' end as record_type,
  case when page_id <> first_id then first_id end as refers_to
from w
"""
