"""WARC archives: payloads travel as chunk rows, are written by streaming, and are read back as chunk rows.

A record's payload is never held whole by the writer or the reader: chunk rows (record identifier, chunk number)
pass one by one, each carrying the number of bytes and the running SHA-1 up to it. Every record is a gzip member of
its own. A writing task puts its records into files with names that no other attempt uses, and only the files of
attempts that succeeded appear in the manifest, so retried and speculative tasks leave nothing that is read.
"""

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermalis.llm.common import bounded_batches, scratch_path, settle, text_bytes

#: Payload bytes in one chunk row.
CHUNK = 256 << 10
#: A task begins a new archive after so many compressed bytes.
ARCHIVE = 256 << 20
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "2020-01-01T00:00:00Z"
RECORDS = "seq long, page_id long, url string, refers_to long, n_bytes long, sha1 string, chunk_no long, data binary"
MANIFEST = "file string, n_records long, n_bytes long"
CHUNKS = ("file string, record_no long, record_type string, page_id long, url string, refers_to long, payload_bytes long, "
          "payload_digest string, chunk_no long, data binary, bytes_so_far long, digest_so_far string, last boolean")


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_chunks(pages: DataFrame, chunk: int = CHUNK, min_bytes: int = 0) -> DataFrame:
    """The rows that the writer takes, from page_id, url, html (null html: an empty payload).

    Of records with equal payloads of at least min_bytes bytes, that with the largest page_id is the response;
    the others refer to it and carry no data. Equal means equal length and SHA-256. Records without a page_id are
    all responses, and so are repeated rows of the largest page_id.
    """
    content = text_bytes("html")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        content.alias("content"))
    rows = rows.withColumns({"n_bytes": F.octet_length("content").cast("long"), "sha256": F.unhex(F.sha2("content", 256))})
    groups = (rows.where(F.col("n_bytes") >= min_bytes).groupBy("sha256", "n_bytes")
              .agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    revisits = (rows.select("page_id", "sha256", "n_bytes").join(groups, ["sha256", "n_bytes"])
                .where("page_id < response").select("page_id", "sha256", F.col("response").alias("refers_to")).distinct())
    marked = rows.join(settle(revisits, "warc-revisits"), ["page_id", "sha256"], "left")
    last = F.when(F.col("refers_to").isNull(), F.greatest(F.ceil(F.col("n_bytes") / chunk) - 1, F.lit(0))).otherwise(F.lit(0))
    cut = F.when(F.col("refers_to").isNull(), F.expr(f"substring(content, CAST(chunk_no * {chunk} + 1 AS INT), {chunk})"))
    return (marked.select("*", F.monotonically_increasing_id().alias("seq"), F.sha1("content").alias("sha1"))
            .select("*", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("chunk_no"))
            .select("seq", "page_id", "url", "refers_to", "n_bytes", "sha1", "chunk_no", cut.alias("data")))


class Archive:
    """One file of gzip members."""

    def __init__(self, folder: str):
        system, path = fs.FileSystem.from_uri(folder)
        self.name = f"{uuid.uuid4().hex}.warc.gz"
        self.out = system.open_output_stream(f"{path}/{self.name}", compression=None)
        self.n_records = self.n_bytes = 0
        self.record = None

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.n_bytes += len(data)

    def begin(self, header: bytes) -> None:
        self.record = zlib.compressobj(4, zlib.DEFLATED, 31)
        self.digest = hashlib.sha1()
        self.write(self.record.compress(header))

    def add(self, data: bytes) -> None:
        self.digest.update(data)
        self.write(self.record.compress(data))

    def end(self) -> bytes:
        self.write(self.record.compress(b"\r\n\r\n") + self.record.flush())
        self.record = None
        self.n_records += 1
        return self.digest.digest()


def header(page_id, url, refers_to, n_bytes, sha1) -> bytes:
    """WARC header and, for responses, the HTTP header; line ends and spaces in a url are percent-encoded."""
    response = refers_to is None
    lines = ["WARC/1.1", f"WARC-Type: {'response' if response else 'revisit'}",
             f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c.isprintable() and c not in " %" else
                                                   "".join(f"%{b:02X}" for b in c.encode()) for c in url))
    lines += ["Content-Type: application/http;msgtype=response",
              f"WARC-Payload-Digest: sha1:{base32_sha1(bytes.fromhex(sha1))}", f"WARC-Payload-Length: {n_bytes}"]
    if not response:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <urn:page:{refers_to}>"]
    block = len(HTTP) + (n_bytes if response else 0)
    return ("\r\n".join([*lines, f"Content-Length: {block}"]) + "\r\n\r\n").encode() + HTTP


def write_archives(chunks: DataFrame, folder: str, archive: int = ARCHIVE) -> DataFrame:
    """Write the rows of record_chunks() to .warc.gz files in a shared folder; return the manifest as a table.

    The chunks of a record are neighbours within a partition, in order. An empty table gives an empty manifest.
    """
    bounded_batches(chunks.sparkSession)

    def run(batches):
        now, open_record = None, None

        def close():
            got = now.end()
            if open_record[1] is None and got.hex() != open_record[2]:
                raise ValueError(f"record {open_record[0]}: the chunks' digest is not the record's")

        def finished():
            now.out.close()
            return pa.RecordBatch.from_pylist([{"file": f"{folder}/{now.name}", "n_records": now.n_records,
                                                "n_bytes": now.n_bytes}])

        for batch in batches:
            for seq, page_id, url, refers_to, n_bytes, sha1, _, data in zip(*(c.to_pylist() for c in batch.columns)):
                if open_record is None or open_record[0] != seq:
                    if open_record is not None:
                        close()
                        if now.n_bytes >= archive:
                            yield finished()
                            now = None
                    now = now or Archive(folder)
                    now.begin(header(page_id, url, refers_to, n_bytes, sha1))
                    open_record = (seq, refers_to, sha1)
                now.add(data or b"")
        if now is not None:
            close()
            yield finished()

    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    return settle(chunks.mapInArrow(run, MANIFEST), "warc-manifest")


def records(stream, chunk: int) -> Iterator[dict]:
    """Chunk rows of one open archive; memory holds a chunk."""
    number = -1
    with gzip.GzipFile(fileobj=stream) as plain:
        while line := plain.readline():
            if line == b"\r\n":
                continue
            number += 1
            fields = {}
            while (line := plain.readline().rstrip(b"\r\n")):
                name, _, value = line.decode().partition(":")
                fields[name.lower()] = value.strip()
            left = int(fields["content-length"])
            while left:
                line = plain.readline()
                left -= len(line)
                if line == b"\r\n":
                    break
            page = fields["warc-record-id"].removeprefix("<urn:page:").rstrip(">")
            refers = fields.get("warc-refers-to")
            row = {"record_no": number, "record_type": fields["warc-type"], "page_id": None if page == "none" else int(page),
                   "url": fields.get("warc-target-uri"),
                   "refers_to": refers and int(refers.removeprefix("<urn:page:").rstrip(">")),
                   "payload_bytes": int(fields["warc-payload-length"]),
                   "payload_digest": fields["warc-payload-digest"].removeprefix("sha1:")}
            digest, seen, place = hashlib.sha1(), 0, 0
            while True:
                data = plain.read(min(chunk, left))
                left -= len(data)
                seen += len(data)
                digest.update(data)
                if left and not data:
                    raise EOFError("the archive ends within a record")
                yield row | {"chunk_no": place, "data": data, "bytes_so_far": seen,
                             "digest_so_far": base32_sha1(digest.copy().digest()), "last": left == 0}
                place += 1
                if not left:
                    break


def read_archives(spark: SparkSession, manifest: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Chunk rows of the files of a manifest (column file): record fields, chunk number, data, bytes and digest so far."""
    bounded_batches(spark)
    fields = CHUNKS

    def run(batches):
        schema = None
        for batch in batches:
            for file in batch.column(0).to_pylist():
                system, path = fs.FileSystem.from_uri(file)
                with system.open_input_stream(path, compression=None) as stream:
                    rows, held = [], 0
                    for row in records(stream, chunk):
                        rows.append({"file": file} | row)
                        held += len(row["data"]) + 400
                        if held >= 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema or arrow_schema())
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema or arrow_schema())

    def arrow_schema():
        kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
        return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in fields.split(", "))])

    files = manifest.select("file")
    return files.repartition(max(1, files.count()), "file").mapInArrow(run, fields)


def archived(chunks: DataFrame) -> DataFrame:
    """A row per record from its last chunk row; a response whose bytes or digest are not those of its header raises."""
    good = (F.col("record_type") == "revisit") | ((F.col("bytes_so_far") == F.col("payload_bytes"))
                                                  & (F.col("digest_so_far") == F.col("payload_digest")))
    checked = F.when(good, F.col("payload_digest")).otherwise(
        F.raise_error(F.concat(F.lit("damaged record in "), F.col("file"))))
    return chunks.where("last").select("page_id", "url", "payload_bytes", checked.alias("payload_digest"), "record_type", "refers_to")


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write pages as WARC files and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    manifest = write_archives(record_chunks(pages), folder if "://" in folder or folder.startswith("/") else
                              folder.replace("file:/", "file:///"))
    return archived(read_archives(spark, manifest)).drop("url")
