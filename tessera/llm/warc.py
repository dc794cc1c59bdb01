"""WARC archives: writing pages, and a sequential reader.

Archives are ``.warc.gz`` files in shared storage, one gzip member per record.
The reader never holds a whole archive: it feeds blocks of the file to an
incremental zlib decompressor, starts anew at each member, reads the header
lines, takes exactly ``Content-Length`` bytes, and checks the block and payload
digests.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, fs_of, hot_lookup, new_folder, with_slices

CRLF = b"\r\n"
BLOCK = 1 << 16
ARCHIVE_BYTES = 64 << 20  # compressed size after which a new archive is begun
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class WarcError(ValueError):
    """A record that breaks the format or fails a digest."""


def sha1_32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes

    @property
    def kind(self) -> str:
        return self.headers.get("warc-type", "")

    @property
    def payload(self) -> bytes:
        """What follows the HTTP head of the block."""
        head, sep, body = self.block.partition(CRLF + CRLF)
        return body if sep else b""


def record_bytes(kind: str, record_id: str, uri: str, payload: bytes, digest: str, date: str,
                 refers_to: str | None = None, extra: dict[str, str] | None = None) -> bytes:
    """One record as one gzip member. A revisit holds the HTTP head only and
    the digest and length of the payload it leaves out."""
    block = HTTP_HEAD + (b"" if kind == "revisit" else payload)
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", "WARC-Date": date, "WARC-Target-URI": uri,
            "Content-Type": "application/http; msgtype=response", "WARC-Payload-Digest": f"sha1:{digest}",
            "WARC-Block-Digest": f"sha1:{sha1_32(block)}"}
    if kind == "revisit":
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<{refers_to}>"}
    head |= extra or {}
    head["Content-Length"] = str(len(block))
    lines = "".join(f"{k}: {v.translate(CONTROL)}\r\n" for k, v in head.items())
    raw = b"WARC/1.1\r\n" + lines.encode() + CRLF + block + CRLF + CRLF
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


CONTROL = dict.fromkeys([*range(32), 127], " ")  # a header value stays on its line


def members(source, block: int = BLOCK) -> Iterator[Iterator[bytes]]:
    """The decompressed bytes of each gzip member of a stream, in blocks."""
    rest = b""

    def one(first: bytes):
        nonlocal rest
        z, data = zlib.decompressobj(31), first
        while True:
            while data:
                out = z.decompress(data, block)
                if out:
                    yield out
                if z.eof:
                    rest = z.unused_data
                    return
                data = z.unconsumed_tail
            data = source.read(block)
            if not data:
                raise WarcError("the archive ends within a record")

    while True:
        data = rest or source.read(block)
        rest = b""
        if not data:
            return
        member = one(data)
        yield member
        for _ in member:  # what the caller left
            pass


def read_records(source, verify: bool = True) -> Iterator[Record]:
    """The records of an archive, one after another."""
    for member in members(source):
        data = bytearray()
        while (end := data.find(CRLF + CRLF)) < 0:
            more = next(member, None)
            if more is None:
                raise WarcError("a record's header does not end")
            data += more
        lines = data[:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise WarcError(f"not a record: {lines[0][:40]!r}")
        headers = {}
        for line in lines[1:]:
            name, sep, value = line.partition(":")
            if not sep:
                raise WarcError(f"not a header: {line[:40]!r}")
            headers[name.strip().lower()] = value.strip()
        try:
            size = int(headers["content-length"])
        except (KeyError, ValueError):
            raise WarcError("no Content-Length") from None
        del data[:end + 4]
        for more in member:
            data += more
        if len(data) != size + 4 or data[size:] != CRLF + CRLF:
            raise WarcError(f"Content-Length {size}, block of {len(data) - 4}")
        record = Record(headers, bytes(data[:size]))
        if verify:
            check(record)
        yield record


def check(record: Record) -> None:
    """Digests of the block, and of the payload where the record holds it."""
    for name, data in (("warc-block-digest", record.block),
                       ("warc-payload-digest", None if record.kind == "revisit" else record.payload)):
        stated = record.headers.get(name, "")
        if stated.startswith("sha1:") and data is not None and stated[5:] != sha1_32(data):
            raise WarcError(f"{name} does not match")


def page_urn(page_id: int | None) -> str:
    return f"urn:page:{'null' if page_id is None else page_id}"


def page_of(urn: str) -> int | None:
    text = urn.strip("<>").rpartition(":")[2]
    return None if text == "null" else int(text)


def with_canonical(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) with ``digest`` and ``canonical``: the
    largest page_id of its payload if that has ``least_bytes`` at least and
    some other page has it too, else null. Digest groups are pre-aggregated;
    only those of several rows are joined back, hot ones by broadcast."""
    kind = pages.schema["html"].dataType.simpleString()

    def run(batches):
        for b in with_slices(batches):
            sha = [hashlib.sha1((t or "").encode()).digest() for t in b.column(2).to_pylist()]
            yield b.append_column("digest", pa.array([base64.b32encode(d).decode() for d in sha], pa.string()))

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    rows = rows.mapInArrow(run, f"page_id long, url string, html {kind}, digest string")
    size = F.octet_length(F.coalesce(F.col("html"), F.lit("")))
    narrow = cut(rows.select("page_id", "digest", size.alias("size")), "digests")
    groups = (narrow.filter(F.col("size") >= least_bytes).groupBy("digest")
              .agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("canonical")).filter("n > 1"))
    groups = cut(groups, "payloads")
    return hot_lookup(rows, groups, "digest", "n", narrow.count(), F.xxhash64("page_id", "url"))


def write_pages(pages: DataFrame, folder: str, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Write one record per row of :func:`with_canonical`'s result into
    archives under ``folder``; returns the manifest ``(file, n_records,
    n_bytes)``, already written as a table. File names carry the task attempt,
    so a lost attempt's archives are in no manifest."""
    def run(batches):
        fs, root = fs_of(folder)
        ctx = TaskContext.get()
        name = f"part-{ctx.partitionId():06d}-{ctx.taskAttemptId()}"
        schema = pa.schema([("file", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())])
        out, seq, n, size = None, 0, 0, 0
        for b in with_slices(batches, 256):
            for r in b.to_pylist():
                if out is None:
                    file = f"{name}-{seq:05d}.warc.gz"
                    out, n, size = fs.open_output_stream(f"{root}/{file}", compression=None), 0, 0
                payload, page, of = (r["html"] or "").encode(), r["page_id"], r["canonical"]
                revisit = of is not None and of != page
                raw = record_bytes("revisit" if revisit else "response", page_urn(page), r["url"] or "", payload,
                                   r["digest"], date, page_urn(of) if revisit else None,
                                   {"X-Payload-Length": str(len(payload))})
                out.write(raw)
                n, size = n + 1, size + len(raw)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    yield pa.RecordBatch.from_pylist([{"file": file, "n_records": n, "n_bytes": size}], schema=schema)
                    out, seq = None, seq + 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"file": file, "n_records": n, "n_bytes": size}], schema=schema)

    return cut(pages.mapInArrow(run, "file string, n_records long, n_bytes long"), "archives")


def read_pages(manifest: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """Per record of the archives: page_id, ``payload_bytes``,
    ``payload_digest``, ``record_type``, ``refers_to`` (and ``url``,
    ``payload``). Digests are verified; a damaged archive raises."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    names += ["url", "payload"] * with_payload
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.string(), pa.binary()] * with_payload

    def run(batches):
        fs, root = fs_of(folder)
        schema = pa.schema(list(zip(names, types)))
        for b in batches:
            for row in b.to_pylist():
                held, seen, size = [], 0, 0
                with fs.open_input_stream(f"{root}/{row['file']}", compression=None) as source:
                    for rec in read_records(source):
                        h, seen = rec.headers, seen + 1
                        revisit = rec.kind == "revisit"
                        payload = b"" if revisit else rec.payload
                        held.append(dict(zip(names, (
                            page_of(h["warc-record-id"]),
                            int(h["x-payload-length"]) if revisit else len(payload),
                            h["warc-payload-digest"].removeprefix("sha1:"), rec.kind,
                            page_of(h["warc-refers-to"]) if revisit else None,
                            h["warc-target-uri"], payload))))
                        size += len(payload) if with_payload else 0
                        if len(held) >= 4096 or size > 1 << 24:
                            yield pa.RecordBatch.from_pylist(held, schema=schema)
                            held, size = [], 0
                if seen != row["n_records"]:
                    raise WarcError(f"{row['file']}: {seen} records, {row['n_records']} written")
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    # a stated number: AQE would put the small file list into one task
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(n, F.col("file")).mapInArrow(run, schema + ", url string, payload binary" * with_payload)


def archive_and_read(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write all pages to archives and read them back.

    Null html: an empty payload; null url: an empty URI; control characters
    in a url become blanks. A null page_id is written as such; it never is the
    canonical page of a group unless no other id is there, and then its group
    stays responses. Rows that repeat the canonical page_id are responses.
    Only page_id, url and html are read, so other columns can't clash; an
    empty table gives no archive and no row.
    """
    folder = new_folder(pages.sparkSession, "archives")
    return read_pages(write_pages(with_canonical(pages, least_bytes), folder), folder)
