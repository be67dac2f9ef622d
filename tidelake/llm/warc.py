"""WARC archives: writing, normalising to one gzip member per record with an offset index, and reading back.

Crawls often hold a whole archive in a single gzip stream, which can only be read from its beginning. The normaliser
inflates such a stream once, in pieces, rewrites every record as a member of its own, and writes beside each archive an
index of (offset, length), after which any record can be read alone.
"""

from __future__ import annotations

import contextlib
import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm.base import fresh

BREAK = b"\r\n\r\n"
PIECE = 1 << 20
#: Payloads below this many bytes are always stored.
LEAST_REVISIT = 100
DATE = "2024-01-01T00:00:00Z"
STORES = {"s3a": "s3", "s3n": "s3"}


# ---- files in the shared folder -------------------------------------------------------------------------------------


def _filesystem(path: str):
    """(filesystem, path inside it): the local one for plain and file: paths, else what the scheme names."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    # Spark's names of object stores that the workers' library knows by another one.
    scheme, _, rest = path.partition("://")
    path = f"{STORES.get(scheme, scheme)}://{rest}"
    return fs.FileSystem.from_uri(path)


@contextlib.contextmanager
def _finished(path: str):
    """Write to a name of one's own and move it in place at the end, so that a repeated task leaves one whole file."""
    system, inside = _filesystem(path)
    system.create_dir(os.path.dirname(inside), recursive=True)
    own = f"{inside}.{uuid.uuid4().hex}.part"
    with system.open_output_stream(own, compression=None) as out:
        yield out
    system.move(own, inside)


# ---- writing --------------------------------------------------------------------------------------------------------


def with_revisits(pages: DataFrame, key: str, payload: Column, least: int = LEAST_REVISIT) -> DataFrame:
    """``pages`` with payload, payload_bytes, payload_digest, record_type and refers_to.

    Of equal payloads of at least ``least`` bytes the smallest key's record is the response and the others revisit it; rows
    that repeat that key are responses too. Null payloads are empty. A null key is never the one referred to unless all
    of them are null, in which case all are responses.
    """
    first = fresh(pages, "_first")[0]
    full = pages.withColumn("payload", F.coalesce(payload.cast("binary"), F.lit(b"")))
    full = full.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("payload_digest", F.sha2("payload", 256))
    groups = full.where(F.col("payload_bytes") >= least).groupBy("payload_digest").agg(F.min(key).alias(first), F.count(F.lit(1)).alias("_n"))
    groups = groups.where("_n > 1").drop("_n")
    revisits = (F.col("payload_bytes") >= least) & F.col(first).isNotNull() & ~F.col(key).eqNullSafe(F.col(first))
    return (
        full.join(groups, "payload_digest", "left")
        .withColumn("record_type", F.when(revisits, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(revisits, F.col(first)))
        .drop(first)
    )


def _record_id(key: Column) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("null")).cast("binary"))
    parts = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def record_bytes(key: str, url: str) -> Column:
    """A record's header block and content, without the closing empty lines, from the columns of ``with_revisits``."""
    revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    # Line breaks in a URL would end the header line.
    target = F.regexp_replace(F.coalesce(F.col(url).cast("string"), F.lit("")), r"[\x00-\x20\x7f]", "%20")
    length = F.octet_length(http) + F.when(revisit, F.lit(0).cast("long")).otherwise(F.col("payload_bytes"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.col("record_type"), F.lit("\r\nWARC-Record-ID: "), _record_id(F.col(key)),
        F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), target, F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("payload_digest"),
        F.coalesce(F.concat(F.lit("\r\nX-Key: "), F.col(key).cast("string")), F.lit("")),
        F.when(
            revisit,
            F.concat(
                F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "), _record_id(F.col("refers_to")),
                F.lit("\r\nX-Refers-To-Key: "), F.col("refers_to").cast("string"),
            ),
        ).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), length.cast("string"), F.lit("\r\n\r\n"), http,
    )
    return F.concat(head.cast("binary"), F.when(revisit, F.lit(b"")).otherwise(F.col("payload")))


def write_monolithic(pages: DataFrame, path: str, key: str, url: str, payload: Column, records_per_file: int = 20_000) -> None:
    """Archives below ``path``, each one gzip stream; written by Spark, a record a line and the closing lines between."""
    records = with_revisits(pages, key, payload).select(record_bytes(key, url).cast("string").alias("value"))
    records.write.option("compression", "gzip").option("lineSep", BREAK.decode()).option("maxRecordsPerFile", records_per_file).text(path)


# ---- normalising ----------------------------------------------------------------------------------------------------


class _Inflated:
    """A gzip file, of one member or many, as a stream that is inflated once and in pieces."""

    def __init__(self, source):
        self.source, self.inflate, self.buffer, self.ended, self.within = source, zlib.decompressobj(31), bytearray(), False, False

    def more(self) -> bool:
        """Inflate one more piece; false at the end of the file."""
        if self.ended:
            return False
        data = self.inflate.unconsumed_tail or self.inflate.unused_data
        if self.inflate.eof:
            self.inflate, self.within = zlib.decompressobj(31), False
        if not data:
            data = self.source.read(PIECE)
        if not data:
            self.ended = True
            if self.within:
                raise ValueError("the archive ends inside a gzip member")
            return False
        self.within = True
        self.buffer += self.inflate.decompress(data, PIECE)
        if self.inflate.eof and not self.inflate.unused_data:
            self.within = False
        return True

    def until(self, mark: bytes) -> bytes | None:
        """What comes before and with the next ``mark``; None if nothing is left."""
        seen = 0
        while (at := self.buffer.find(mark, seen)) < 0:
            seen = max(0, len(self.buffer) - len(mark) + 1)
            if not self.more():
                if self.buffer.strip():
                    raise ValueError("the archive ends inside a record's header")
                return None
        return self.take(at + len(mark))

    def take(self, n: int) -> bytes:
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out

    def exactly(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes, in pieces."""
        while n:
            if not self.buffer and not self.more():
                raise ValueError("the archive ends inside a record")
            part = self.take(min(n, len(self.buffer)))
            n -= len(part)
            if part:
                yield part


def parse_header(block: bytes) -> dict[str, str]:
    """Named fields of a header block, names in lower case; the first line is the version."""
    lines = block.decode("utf-8", "replace").split("\r\n")
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:]) if name}


def normalise_archive(source_path: str, target_path: str, level: int = 6) -> list[dict]:
    """One archive rewritten record by record; its index, also written beside it as tab-separated lines."""
    index, offset = [], 0
    system, inside = _filesystem(source_path)
    with system.open_input_stream(inside, compression=None) as source, _finished(target_path) as out:
        stream = _Inflated(source)
        while (block := stream.until(BREAK)) is not None:
            block = block.lstrip(b"\r\n")
            header = parse_header(block)
            member = zlib.compressobj(level, zlib.DEFLATED, 31)
            length = out.write(member.compress(block))
            for part in stream.exactly(int(header["content-length"])):
                length += out.write(member.compress(part))
            if b"".join(stream.exactly(len(BREAK))) != BREAK:
                raise ValueError("a record is not followed by two line breaks")
            length += out.write(member.compress(BREAK) + member.flush())
            index.append({"offset": offset, "length": length, "record_type": header.get("warc-type", ""), "record_id": header.get("warc-record-id", ""), "target": header.get("warc-target-uri", "")})
            offset += length
    with _finished(target_path + ".index.tsv") as out:
        for r in index:
            out.write("{offset}\t{length}\t{record_type}\t{record_id}\t{target}\n".format(**r).encode())
    return index


INDEX = "archive string, offset long, length long, record_type string, record_id string, target string"


def normalise(spark: SparkSession, source: str, target: str, level: int = 6) -> DataFrame:
    """All ``*.gz`` archives of the folder ``source`` rewritten below ``target``; the index as rows.

    A task inflates an archive as a stream and holds one piece of it and the index of one archive. Archives are finished
    by a move, so a task that runs twice leaves the same file. An empty folder gives no rows. The caller writes the
    index rows before using them twice, as reading them runs the rewriting.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                archive = f"{target}/{os.path.basename(path).removesuffix('.gz').removesuffix('.txt')}.warc.gz"
                rows = normalise_archive(path, archive, level)
                names = ["offset", "length", "record_type", "record_id", "target"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([archive] * len(rows)), *(pa.array([r[n] for r in rows], pa.int64() if n in names[:2] else pa.string()) for n in names)], ["archive", *names]
                )

    return found.mapInArrow(run, INDEX)


# ---- reading --------------------------------------------------------------------------------------------------------


def read_records(index: DataFrame) -> DataFrame:
    """The records an index names, each read alone: key, record_type, payload_bytes, payload_digest, refers_to, payload.

    A response's size and digest are taken from the payload that was read and must equal the digest in its header;
    revisits have no payload of their own and give what their headers say of the full one.
    """

    def one(member: bytes) -> dict:
        data = zlib.decompress(member, 31)
        head, _, rest = data.partition(BREAK)
        header = parse_header(head)
        http, _, body = rest[: int(header["content-length"])].partition(BREAK)
        told = header["warc-payload-digest"].removeprefix("sha256:")
        if header["warc-type"] == "revisit":
            size, digest, payload = int(parse_header(http)["content-length"]), told, None
        else:
            size, digest, payload = len(body), hashlib.sha256(body).hexdigest(), body
            if digest != told:
                raise ValueError(f"payload of {header['warc-record-id']} differs from its digest")
        return {"key": header.get("x-key"), "record_type": header["warc-type"], "payload_bytes": size, "payload_digest": digest, "refers_to": header.get("x-refers-to-key"), "payload": payload}

    schema = pa.schema([("key", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size, current, handle = [], 0, None, None
            for archive, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if archive != current:
                    if handle:
                        handle.close()
                    system, inside = _filesystem(archive)
                    current, handle = archive, system.open_input_file(inside)
                rows.append(one(handle.read_at(length, offset)))
                size += rows[-1]["payload_bytes"]
                if size > 8 * PIECE:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, size = [], 0
            if handle:
                handle.close()
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)

    return index.select("archive", "offset", "length").mapInArrow(
        run, "key string, record_type string, payload_bytes long, payload_digest string, refers_to string, payload binary"
    )
