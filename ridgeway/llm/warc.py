"""WARC archives: writing, normalising a monolithic gzip, reading by offset.

``write`` makes archives of the usual careless kind, each one gzip stream over all its
records.  ``normalise`` inflates every file once as a stream, parses its records as they
come, rewrites each as a gzip member of its own, and writes a sidecar index (``.cdx``: offset,
length, type, record id and target per line).  ``read`` opens single members by their offsets.
All three hold a buffer, never a record or a file; a task's files end at ``max_bytes`` of
payload, so the sequential work for one file is bounded.

Of records with equal payloads the one with the smallest id is a ``response``, the others are
``revisit`` records (identical payload digest) that name it.  Groups are found by a partial
aggregate; the join back is by digest and length, a shuffled join that adaptive execution
splits where one payload has many copies.

Files are named by attempt, and found through manifests that Spark commits (see
``AttemptFile``), so lost or repeated tasks leave nothing that is read.

Defined cases: a null payload is empty; a null id is last in the order and empty in the record id;
all rows that share the smallest id of their payload (repeated rows) are responses; null target:
no header; line ends in targets and ids are percent-encoded; an empty table: no files, no
rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from itertools import chain
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeway.llm.common import AttemptFile, open_input, slices
from ridgeway.session import scratch_path

#: Payload bytes after which a task starts its next archive; buffer size; deflate levels.
MAX_BYTES, CHUNK, RAW_LEVEL, MEMBER_LEVEL = 64 << 20, 1 << 18, 1, 6
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _urn(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else quote(str(page_id), safe='')}>"


def page_of(urn: str) -> str | None:
    return unquote(urn[len("<urn:page:"):-1]) or None


def record(page_id, url, payload: bytes, refers_to=None, refers_url=None, *, revisit: bool = False, number: int = 0) -> bytes:
    """One WARC/1.1 record: HTTP headers and payload, or only the headers for a revisit."""
    clean = lambda u: u.replace("\r", "%0D").replace("\n", "%0A")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _urn(page_id)), ("WARC-Date", DATE),
            ("WARC-Target-URI", None if url is None else clean(url)), ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"),
            ("WARC-Profile", PROFILE if revisit else None), ("WARC-Refers-To", _urn(refers_to) if revisit else None),
            ("WARC-Refers-To-Target-URI", clean(refers_url) if revisit and refers_url is not None else None),
            ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def mark_revisits(pages: DataFrame, *, id_col: str, url_col: str, payload_col: str, min_bytes: int = 0) -> DataFrame:
    """(id, url, payload, revisit, refers_to, refers_url) of each row."""
    rows = (pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                         F.coalesce(F.col(f"`{payload_col}`"), F.lit("")).alias("payload"))
            .withColumn("digest", F.sha1(F.col("payload").cast("binary"))).withColumn("size", F.octet_length("payload")))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "url")
    firsts = (rows.groupBy("digest").agg(F.min(order).alias("first"), F.max("size").alias("size"))
              .select(F.col("digest").alias("d"), F.col("size").alias("s"), "first"))
    joined = rows.join(firsts, (F.col("digest") == F.col("d")) & (F.col("size") == F.col("s")))
    revisit = ~F.col("id").eqNullSafe(F.col("first.id")) & (F.col("size") >= min_bytes)
    return joined.select("id", "url", "payload", revisit.alias("revisit"), F.when(revisit, F.col("first.id")).alias("refers_to"),
                         F.when(revisit, F.col("first.url")).alias("refers_url"))


_FILES = "file string, records long, bytes long"


def _file_rows(rows):
    cols = list(zip(*rows)) if rows else [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())],
                                      names=["file", "records", "bytes"])


def write(pages: DataFrame, folder: str | None = None, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
          min_bytes: int = 0, max_bytes: int = MAX_BYTES) -> tuple[DataFrame, str]:
    """Writes monolithic archives; returns (manifest: file, records, bytes; folder)."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    rows = mark_revisits(pages, id_col=id_col, url_col=url_col, payload_col=payload_col, min_bytes=min_bytes)

    def run(batches):
        out = pack = None
        n = size = 0
        for batch in slices(batches):
            for r in batch.to_pylist():
                if out is None:
                    out, pack, n, size = AttemptFile(folder, ".warc.gz"), zlib.compressobj(RAW_LEVEL, zlib.DEFLATED, 31), 0, 0
                payload = r["payload"].encode()
                out.stream.write(pack.compress(record(r["id"], r["url"], payload, r["refers_to"], r["refers_url"], revisit=r["revisit"])))
                n, size = n + 1, size + len(payload)
                if size >= max_bytes:
                    out.stream.write(pack.flush())
                    yield _file_rows([(out.close(), n, size)])
                    out = None
        if out is not None:
            out.stream.write(pack.flush())
            yield _file_rows([(out.close(), n, size)])

    rows.mapInArrow(run, _FILES).write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest"), folder


class Inflated:
    """The inflated bytes of a file of one or more gzip members, read once, as a stream."""

    def __init__(self, source):
        self.source, self.unpack, self.buffer = source, zlib.decompressobj(31), bytearray()

    def _more(self) -> bool:
        data = self.unpack.unconsumed_tail
        if self.unpack.eof:
            data = self.unpack.unused_data or self.source.read(CHUNK)
            if not data:
                return False
            self.unpack = zlib.decompressobj(31)
        elif not data:
            data = self.source.read(CHUNK)
            if not data:
                raise EOFError("the gzip stream ends within a member")
        self.buffer += self.unpack.decompress(data, CHUNK)
        return True

    def line(self) -> bytes | None:
        """The next line with its end; None at the end of the file."""
        while (at := self.buffer.find(b"\n")) < 0:
            if not self._more():
                if self.buffer:
                    raise EOFError("the file ends within a line")
                return None
        out = bytes(self.buffer[:at + 1])
        del self.buffer[:at + 1]
        return out

    def take(self, n: int):
        """The next ``n`` bytes, in pieces."""
        while n:
            if not self.buffer and not self._more():
                raise EOFError("the file ends within a record")
            piece = bytes(self.buffer[:n])
            del self.buffer[:n]
            n -= len(piece)
            if piece:
                yield piece


def records(stream: Inflated):
    """(head bytes, headers, body pieces) per record; the body must be used up before the next."""
    while (first := stream.line()) is not None:
        if not first.strip():
            continue
        if not first.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {first[:40]!r}")
        head, headers = [first], {}
        while (line := stream.line()) is not None and line.strip():
            head.append(line)
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        yield b"".join(head) + b"\r\n", headers, stream.take(int(headers["content-length"]))


def _normalise_file(folder: str, name: str, level: int):
    """Rewrites one file; returns (archive, its sidecar, index rows)."""
    source = open_input(folder, name)
    rows = []
    with AttemptFile(folder, ".member.warc.gz") as out, AttemptFile(folder, ".cdx") as index:
        at = 0
        for head, headers, body in records(Inflated(source)):
            pack = zlib.compressobj(level, zlib.DEFLATED, 31)
            size = 0
            for piece in chain((head,), body, (b"\r\n\r\n",)):
                done = pack.compress(piece)
                out.stream.write(done)
                size += len(done)
            done = pack.flush()
            out.stream.write(done)
            size += len(done)
            row = (at, size, headers["warc-type"], headers["warc-record-id"], headers.get("warc-target-uri"))
            index.stream.write(("\t".join("-" if v is None else str(v) for v in row) + "\n").encode())
            rows.append(row)
            at += size
    return out.name, index.name, rows


_INDEX = "file string, sidecar string, offset long, length long, record_type string, record_id string, target string"


def normalise(manifest: DataFrame, folder: str, *, level: int = MEMBER_LEVEL) -> DataFrame:
    """One member per record, and a sidecar index, for every file of the manifest.  Returns the
    index as a table: file, sidecar, offset, length, record_type, record_id, target."""
    spark = manifest.sparkSession
    files = manifest.select("file").repartition(max(1, min(manifest.count(), 100_000)))

    def run(batches):
        for batch in batches:
            for name in batch.column("file").to_pylist():
                archive, sidecar, rows = _normalise_file(folder, name, level)
                for lo in range(0, len(rows), 10_000):
                    part = rows[lo:lo + 10_000]
                    cols = list(zip(*part))
                    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([archive] * len(part)), pa.array([sidecar] * len(part)),
                         *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                        names=["file", "sidecar", "offset", "length", "record_type", "record_id", "target"])

    path = f"{folder}/index-{scratch_path(spark, 'x').rsplit('-', 1)[1]}"
    files.mapInArrow(run, _INDEX).write.parquet(path)
    return spark.read.parquet(path)


def read(index: DataFrame, folder: str, *, with_payload: bool = False) -> DataFrame:
    """Opens each indexed member by its offset: page_id, url, payload_bytes, payload_digest,
    record_type, refers_to (ids as text), and the payload (null for a revisit)."""
    def run(batches):
        name = source = None
        for batch in slices(batches, 1 << 20):
            out = []
            for file, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))):
                if file != name:
                    name, source = file, open_input(folder, file)
                source.seek(offset)
                out.append(_read_member(source, length, with_payload))
            cols = list(zip(*out)) if out else [[]] * 7
            kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])

    made = index.select("file", "offset", "length").mapInArrow(
        run, "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, payload binary")
    return made if with_payload else made.drop("payload")


class _Member:
    """The bytes of one member as a readable source."""

    def __init__(self, source, length: int):
        self.source, self.left = source, length

    def read(self, n: int) -> bytes:
        data = self.source.read(min(n, self.left))
        self.left -= len(data)
        return data


def _read_member(source, length: int, with_payload: bool):
    _, headers, body = next(records(Inflated(_Member(source, length))))
    kind, digest = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha1:")
    http, seen, size, hasher, parts = b"", False, 0, hashlib.sha1(), []
    for piece in body:
        if not seen:
            http += piece
            at = http.find(b"\r\n\r\n")
            if at < 0:
                continue
            seen, piece, http = True, http[at + 4:], http[:at]
        hasher.update(piece)
        size += len(piece)
        if with_payload:
            parts.append(piece)
    told = next(int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    if kind == "response" and (size != told or base64.b32encode(hasher.digest()).decode() != digest):
        raise ValueError(f"payload of {headers['warc-record-id']} does not match its digest")
    refers = headers.get("warc-refers-to")
    return (page_of(headers["warc-record-id"]), headers.get("warc-target-uri"), told, digest, kind,
            page_of(refers) if refers else None, b"".join(parts) if with_payload and kind == "response" else None)
