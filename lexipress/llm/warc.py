"""WARC archives with revisit resolution.

Headers alone (page, payload digest, length) are shuffled by payload digest: of records
with equal payloads of at least ``REVISIT_BYTES`` the one with the largest page_id is
the original response, and the others become revisit records that refer to it.  Only the
list of revisits is joined back to the pages, and archives are written, one gzip member a
record, with fresh headers.  A task writes under a name of its own and renames, so a
repeated or lost task leaves either the whole archive or none.

Reading parses the archives member by member and checks payload digests; revisits get
their payload's length and digest from the response they refer to, by a join on the
record id.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

REVISIT_BYTES = 1000
VERSION = b"WARC/1.1"
#: Fixed value: the profile of a revisit whose payload is identical.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Date of all records; a parameter of the writer, so that archives can be compared byte for byte.
DATE = "2024-01-01T00:00:00Z"
#: Bytes read from an archive at once.
_CHUNK = 1 << 20

_MANIFEST = pa.schema([("path", pa.string()), ("n_records", pa.int64())])
_RECORDS = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("uri", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.string()), ("payload", pa.binary())])
_RECORD_SPEC = "record_id string, page_id long, uri string, record_type string, payload_digest string, payload_bytes long, refers_to string, payload binary"


def record_id(page_id: int | None, digest: str) -> str:
    """The id of a page's record; pages that are equal in both have equal records."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def _clean(value: str) -> str:
    """A header value on one line."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def encode_record(page_id: int | None, uri: str | None, payload: bytes, digest: str, original: int | None, date: str) -> bytes:
    """One record, a gzip member; original: the page that a revisit refers to."""
    revisit = original is not None
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", date)]
    head += [("WARC-Target-URI", _clean(uri))] if uri is not None else []
    head += [("WARC-Page-ID", str(page_id))] if page_id is not None else []
    head += [("WARC-Payload-Digest", f"sha1:{digest}")]
    head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(original, digest))] if revisit else [("Content-Type", "text/html; charset=utf-8")]
    body = b"" if revisit else payload
    head += [("Content-Length", str(len(body)))]
    text = VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in head) + b"\r\n" + body + b"\r\n\r\n"
    z = zlib.compressobj(3, zlib.DEFLATED, 31)
    return z.compress(text) + z.flush()


def read_members(stream) -> Iterator[bytes]:
    """The contents of each gzip member of a stream."""
    z, parts, rest = zlib.decompressobj(31), [], b""
    while True:
        chunk = rest or stream.read(_CHUNK)
        rest = b""
        if not chunk:
            if parts:
                raise ValueError("an archive ends inside a record")
            return
        parts.append(z.decompress(chunk))
        if z.eof:
            yield b"".join(parts)
            rest, z, parts = z.unused_data, zlib.decompressobj(31), []


def parse_record(text: bytes) -> tuple[dict[str, str], bytes]:
    """Headers, by lower-case name, and block of a record."""
    head, gap, block = text.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] != VERSION:
        raise ValueError("not a WARC record")
    headers = {}
    for line in lines[1:]:
        name, _, value = line.decode().partition(":")
        headers[name.lower()] = value.strip()
    length = int(headers["content-length"])
    if block[length:] != b"\r\n\r\n":
        raise ValueError("a record's block does not end where its header says")
    return headers, block[:length]


def _write(uri: str, date: str):
    def run(batches):
        fs, folder = common.open_fs(uri)
        part = TaskContext.get().partitionId()
        final, made, n = f"pages-{part:07d}.warc.gz", f"{folder}/.{part:07d}-{uuid.uuid4().hex}", 0
        with fs.open_output_stream(made, compression=None) as out:
            for batch in batches:
                columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "original")]
                for page, url, html, digest, original in zip(*columns, strict=True):
                    out.write(encode_record(page, url, (html or "").encode(), digest, original, date))
                    n += 1
        if n:
            fs.move(made, f"{folder}/{final}")
            yield common.batch_of(_MANIFEST, ([f"{uri}/{final}"], [n]))
        else:
            fs.delete_file(made)

    return run


def _read(with_payload: bool):
    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, at = common.open_fs(path)
                with fs.open_input_stream(at, compression=None) as stream:
                    rows, held = [], 0
                    for member in read_members(stream):
                        h, block = parse_record(member)
                        digest, revisit = h["warc-payload-digest"].removeprefix("sha1:"), h["warc-type"] == "revisit"
                        if not revisit and hashlib.sha1(block).hexdigest() != digest:
                            raise ValueError(f"damaged payload in {path}")
                        page = int(h["warc-page-id"]) if "warc-page-id" in h else None
                        kept = block if with_payload and not revisit else None
                        rows.append((h["warc-record-id"], page, h.get("warc-target-uri"), h["warc-type"], digest, None if revisit else len(block), h.get("warc-refers-to"), kept))
                        held += len(kept or b"")
                        if len(rows) >= 2000 or held > _CHUNK * 8:
                            yield common.batch_of(_RECORDS, zip(*rows, strict=True))
                            rows, held = [], 0
                    if rows:
                        yield common.batch_of(_RECORDS, zip(*rows, strict=True))

    return run


def revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, digest, original) of the pages that revisit another one; pages: page_id, digest, size.

    Pages of equal payload whose page_id is the largest are all responses, should that id
    occur twice; a null page_id is smaller than any other and refers to nothing if alone.
    """
    long = pages.where(F.col("size") >= least)
    # Grouped by digest and size, joined by digest alone: Spark can then split a hot digest.
    first = long.groupBy("digest", "size").agg(F.max("page_id").alias("original")).where("original is not null").select("digest", "original")
    return long.select("page_id", "digest").join(first, "digest").where("page_id is null or page_id < original").distinct()


def write_archives(pages: DataFrame, archives: int | None = None, date: str = DATE) -> DataFrame:
    """Write one record for each row of ``pages`` (page_id, url, html); returns the manifest (path, n_records).

    A null html is an empty payload, a null url leaves the header out.  Rows that are
    equal are written each.  Other columns are not read.
    """
    spark: SparkSession = pages.sparkSession
    common.small_batches(spark)
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    payload = F.coalesce(F.col("html"), F.lit(""))
    source = source.withColumn("digest", F.sha1(payload.cast("binary")))
    listed = common.materialise(revisits(source.select("page_id", "digest", F.octet_length(payload).alias("size"))), "revisits")
    listed = listed.select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "original")
    resolved = source.join(listed, F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest")), "left").drop("_page", "_digest")
    out = common.scratch(spark, "warc")
    fs, folder = common.open_fs(out)
    fs.create_dir(folder, recursive=True)
    if archives:
        resolved = resolved.repartition(archives)
    manifest = resolved.mapInArrow(_write(out, date), "path string, n_records long").collect()  # a row for each archive
    return spark.createDataFrame(manifest, "path string, n_records long")


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """Records of archives: record_id, page_id, uri, record_type, payload_digest, payload_bytes, refers_to, payload.

    payload_bytes of a revisit comes from the response it refers to; refers_to is that
    response's page_id.
    """
    n = max(1, manifest.count())
    records = manifest.select("path").repartition(n).mapInArrow(_read(with_payload), _RECORD_SPEC)
    records = common.materialise(records, "records") if not with_payload else records
    originals = records.where("record_type = 'response'").select(F.col("record_id").alias("_id"), F.col("page_id").alias("_page"), F.col("payload_bytes").alias("_bytes")).distinct()
    # Many revisits may refer to one response: a plain join, which Spark can split.
    met = records.where("record_type = 'revisit'").join(originals, F.col("refers_to") == F.col("_id"), "left")
    columns = ["record_id", "page_id", "uri", "record_type", "payload_digest"]
    back = met.select(*columns, F.col("_bytes").alias("payload_bytes"), F.col("_page").alias("refers_to"), "payload")
    return records.where("record_type = 'response'").select(*columns, "payload_bytes", F.lit(None).cast("long").alias("refers_to"), "payload").unionByName(back)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``pages`` through archives and back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    records = read_archives(write_archives(common.read_table(spark, sf_dir, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: DuckDB SQL for op5_warc.
OP5_SQL = f"""
WITH p AS (
  SELECT page_id, sha1(coalesce(html, '')) AS d, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages
), m AS (SELECT d, max(page_id) AS o FROM p WHERE n >= {REVISIT_BYTES} GROUP BY d)
SELECT p.page_id, p.n AS payload_bytes, p.d AS payload_digest,
       CASE WHEN m.o > p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN m.o > p.page_id THEN m.o END AS refers_to
FROM p LEFT JOIN m ON p.d = m.d AND p.n >= {REVISIT_BYTES}
"""
