"""WARC archives through a chunked record table.

A payload never is one row: it is rows of (record, chunk_no, data) of at most
`chunk` bytes, cut by Spark before anything else sees them. Writers stream the
rows of a partition into an archive of its own (a gzip member per record) and
readers stream archives back into the same table, with the payload's bytes and
SHA-1 so far on each row; the last row of a record carries the whole digest. So
memory is bound by the chunk, however long a payload is.

Equal payloads of `least` bytes or more (same SHA-1 and length) are stored once:
the record with the largest page_id is the response, the others revisit it.

Archives are written through pyarrow's file systems into a folder that all
executors reach (spark.checkpoint.dir unless given). Each task attempt has a file
name of its own and the manifest lists the files of attempts that ended well, so
a retried task leaves at most an unread file behind.

Defined cases. Null html: empty payload, a response. Null url: an empty target.
Null page_id: always a response, read back as null. Repeated rows: a record each
with the same record id; those of the largest page_id are all responses. Extra
columns are ignored. Empty table: no archive, empty result.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import flag_ids, join_counted, materialize, shared_dir

CHUNK = 1 << 20
LEAST = 1000
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the name space of URLs

RECORDS = "page_id long, url string, digest string, bytes long, record_type string, refers_to long, chunk_no int, last boolean, data binary"
TABLE = "archive string, record_id string, page_id long, url string, record_type string, refers_to_record string, declared_digest string, chunk_no int, last boolean, bytes_so_far long, digest_so_far string, data binary"


def decide(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """pages (page_id, url, html) plus payload, digest, bytes, record_type, refers_to."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "bytes": F.octet_length("payload").cast("long")})
    large = rows.where(F.col("page_id").isNotNull() & (F.col("bytes") >= least)).select("page_id", "digest", "bytes")
    large = materialize(large, "page-digests")
    groups = large.groupBy("digest", "bytes").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("low"), F.count("*").alias("n")).where("low < refers_to").drop("low")
    # a payload of a third of all pages meets its group by broadcast
    revisits = join_counted(large, groups, ["digest", "bytes"], "n").where("page_id < refers_to")
    revisits = materialize(revisits.select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "refers_to").distinct(), "revisits")
    flagged = flag_ids(rows, "page_id", revisits.select("_page"))
    some = flagged.where("_maybe").join(revisits, (F.col("page_id") == F.col("_page")) & (F.col("digest") == F.col("_digest")), "left").drop("_page", "_digest")
    rest = flagged.where("NOT _maybe").withColumn("refers_to", F.lit(None).cast("long"))
    out = some.unionByName(rest).drop("_maybe")
    return out.withColumn("record_type", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit"))


def chunk_rows(records: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """RECORDS: a record's rows follow each other; a revisit has one without data."""
    stored = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    n = F.greatest(F.ceil(F.octet_length("_stored") / chunk), F.lit(1)).cast("int")
    out = records.withColumn("_stored", stored).withColumn("_n", n).withColumn("chunk_no", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    data = F.substring(F.col("_stored"), F.col("chunk_no") * chunk + 1, F.lit(chunk))
    return out.select("page_id", "url", "digest", "bytes", "record_type", "refers_to", "chunk_no", (F.col("chunk_no") == F.col("_n") - 1).alias("last"), data.alias("data"))


def record_id(page_id: int | None, digest: str) -> str:
    return f"urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}/{digest}')}"


def header(r: dict, date: str) -> bytes:
    http = HTTP.format(r["bytes"])
    lines = ["WARC/1.1", f"WARC-Type: {r['record_type']}", f"WARC-Record-ID: <{record_id(r['page_id'], r['digest'])}>", f"WARC-Date: {date}"]
    target = "".join(c if c >= " " else f"%{ord(c):02X}" for c in r["url"] or "")
    lines += [f"WARC-Target-URI: {target}", "Content-Type: application/http;msgtype=response"]
    lines += [f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(r['digest'])).decode()}"]
    if r["page_id"] is not None:
        lines.append(f"X-Page-ID: {r['page_id']}")
    size = len(http) + r["bytes"]
    if r["record_type"] == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <{record_id(r['refers_to'], r['digest'])}>")
        size = len(http)
    lines.append(f"Content-Length: {size}")
    return ("\r\n".join(lines) + "\r\n\r\n" + http).encode()


def write_archives(records: DataFrame, folder: str, chunk: int = CHUNK, date: str = "2024-01-01T00:00:00Z", level: int = 6) -> DataFrame:
    """Write records (as decide() gives them); the manifest: archive, records, bytes, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        path, out, count, packer, digest = "", None, 0, None, None
        for batch in batches:
            heads = batch.select([c for c in batch.schema.names if c != "data"]).to_pylist()
            for r, data in zip(heads, batch.column("data"), strict=True):
                if out is None:
                    system.create_dir(root, recursive=True)
                    path = f"{root}/{uuid.uuid4().hex}.warc.gz"
                    out = system.open_output_stream(path, compression=None)
                if r["chunk_no"] == 0:
                    packer, digest, count = zlib.compressobj(level, zlib.DEFLATED, 31), hashlib.sha1(), count + 1
                    out.write(packer.compress(header(r, date)))
                piece = data.as_buffer()
                digest.update(piece)
                out.write(packer.compress(piece))
                if r["last"]:
                    if r["record_type"] == "response" and digest.hexdigest() != r["digest"]:
                        raise OSError(f"chunks of page {r['page_id']} don't make its payload")
                    out.write(packer.compress(b"\r\n\r\n") + packer.flush())
        if out is not None:
            size = out.tell()
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([count], pa.int64()), pa.array([size], pa.int64())], ["archive", "records", "bytes"])

    return materialize(chunk_rows(records, chunk).mapInArrow(run, "archive string, records long, bytes long"), "warc-manifest")


class _Stream:
    """Bytes of a file of gzip members, in bounded steps."""

    STEP = 1 << 18

    def __init__(self, raw):
        self.raw, self.unpack, self.packed, self.have = raw, zlib.decompressobj(31), b"", bytearray()

    def fill(self) -> bool:
        if not self.packed:
            self.packed = self.raw.read(self.STEP)
            if not self.packed:
                return False
        self.have += self.unpack.decompress(self.packed, self.STEP)
        self.packed = self.unpack.unconsumed_tail
        if self.unpack.eof:
            self.packed, self.unpack = self.unpack.unused_data, zlib.decompressobj(31)
        return True

    def until(self, mark: bytes, most: int = 1 << 20) -> bytes | None:
        """What comes before mark, which is taken too; None at the end of the file."""
        at = self.have.find(mark)
        while at < 0:
            if len(self.have) > most:
                raise OSError("a header is too long")
            if not self.fill():
                if self.have:
                    raise OSError("the archive is cut off")
                return None
            at = self.have.find(mark)
        out = bytes(self.have[:at])
        del self.have[: at + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.have) < n:
            if not self.fill():
                raise OSError("the archive is cut off")
        out = bytes(self.have[:n])
        del self.have[:n]
        return out


def _fields(head: bytes) -> dict[str, str]:
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode().split("\r\n")[1:])}


def parse(raw, chunk: int = CHUNK) -> Iterator[tuple]:
    """Rows of TABLE, without the archive, of an archive's stream."""
    s = _Stream(raw)
    while (head := s.until(b"\r\n\r\n")) is not None:
        if not head.startswith(b"WARC/"):
            raise OSError("no record where one should begin")
        f = _fields(head)
        left = int(f["content-length"])
        if f.get("content-type", "").startswith("application/http"):
            left -= len(s.until(b"\r\n\r\n")) + 4
        page, digest = f.get("x-page-id"), f.get("warc-payload-digest", "").removeprefix("sha1:")
        fixed = (f["warc-record-id"].strip("<>"), int(page) if page else None, f.get("warc-target-uri", ""), f["warc-type"], f.get("warc-refers-to", "").strip("<>") or None, base64.b32decode(digest).hex() if digest else None)
        sofar, seen, k = hashlib.sha1(), 0, 0
        while True:
            data = s.take(min(chunk, left))
            left -= len(data)
            seen += len(data)
            sofar.update(data)
            yield (*fixed, k, left == 0, seen, sofar.hexdigest(), data)
            k += 1
            if not left:
                break
        if s.take(4) != b"\r\n\r\n":
            raise OSError("a record doesn't end where it should")


def read_archives(spark: SparkSession, manifest: DataFrame, folder: str, chunk: int = CHUNK) -> DataFrame:
    """The chunked record table (TABLE) of the archives a manifest lists."""
    names = [c.split(" ")[0] for c in TABLE.split(", ")]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.binary()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(folder)
        for b in batches:
            for path in b.column(0).to_pylist():
                rows, size = [], 0
                with system.open_input_stream(path, compression=None) as raw:
                    for row in parse(raw, chunk):
                        rows.append((path, *row))
                        size += len(row[-1])
                        if size >= 4 << 20 or len(rows) >= 4096:
                            yield batch(rows)
                            rows, size = [], 0
                if rows:
                    yield batch(rows)

    # a task an archive: they are of a partition's size
    n = max(1, manifest.count())
    return manifest.select("archive").repartition(n, "archive").mapInArrow(run, TABLE)


def payloads(table: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record."""
    ends = materialize(table.where("last").drop("data"), "warc-ends")
    stored = ends.where("record_type = 'response'")
    one = stored.groupBy(F.col("record_id").alias("refers_to_record")).agg(F.first("page_id").alias("refers_to"), F.first("bytes_so_far").alias("payload_bytes"), F.first("digest_so_far").alias("payload_digest"))
    others = ends.where("record_type = 'revisit'").select("page_id", "record_type", "refers_to_record")
    one = one.join(others.groupBy("refers_to_record").count(), "refers_to_record")
    revisit = join_counted(others, one, ["refers_to_record"], "count")
    own = stored.select("page_id", F.col("bytes_so_far").alias("payload_bytes"), F.col("digest_so_far").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
    return own.unionByName(revisit.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op8_warc(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    manifest = write_archives(decide(pages), folder)
    return payloads(read_archives(spark, manifest, folder))


#: What the archives must give back, by DuckDB.
OP8_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
r AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY html) END AS top FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN top > page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN top > page_id THEN top END AS refers_to
FROM r
"""
