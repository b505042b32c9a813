"""Legacy ARC archives converted to WARC: records parsed by declared length, identifiers and digests synthesised.

* ``write_arcs`` lays pages down as legacy archives, one file per partition,
  each record its own gzip member, versions 1 and 2 by turns.
* ``read_arcs`` parses a file's version block, then each header line by that
  version's fields and the record by its declared length.
* ``convert`` gives every record a date, type, identifier and digest: of records
  with equal payloads of ``MIN_REVISIT`` bytes or more that with the smallest
  page_id is a response, the others revisit it. One WARC file per partition.
* ``read_warcs`` parses the WARC files again.

A file is written under a draft name and renamed, so a task that runs again
replaces it whole; each step's manifest is stored before the next step reads.
Payloads travel in batches of bounded size; one record is held at a time.

Defined cases
* null html is an empty payload; a null url becomes ``urn:page:`` and the id,
  and blanks or control characters of a url are percent-encoded;
* a null page_id stays null; such a record is always a response and never
  referred to; rows with equal page_id and payload are all responses if theirs
  is the smallest id;
* other columns are ignored; an empty table gives no files and no rows.
"""

from __future__ import annotations

import gzip
import hashlib
import os
import re
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import Workspace

MIN_REVISIT = 100
CAPTURE_DATE = "20000101000000"
BATCH_BYTES = 4 << 20
#: Rows of one frequent payload are dealt over this many join keys.
SALTS = 32
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # URLs, by RFC 4122
#: Fields of the header line, fixed by the format's versions.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
ID_HEADER = b"X-Page-Id"
PARSED = pa.schema([
    ("page_id", pa.int64()), ("uri", pa.string()), ("ip", pa.string()), ("date", pa.string()), ("mime", pa.string()),
    ("http", pa.binary()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("digest", pa.string()),
])
MANIFEST = pa.schema([("path", pa.string()), ("records", pa.int64())])
FOUND = pa.schema([
    ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("record_id", pa.string()), ("refers_to_id", pa.string()), ("target_uri", pa.string()), ("date", pa.string()),
])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


class _File:
    """One archive of gzip members, renamed into place when it is whole."""

    def __init__(self, folder: str, suffix: str):
        self.fs, base = pafs.FileSystem.from_uri(folder)
        self.fs.create_dir(base)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}.{suffix}"
        self.address, self.path, self.draft = f"{folder}/{name}", f"{base}/{name}", f"{base}/_draft-{part:06d}-{uuid.uuid4().hex}"
        self.out, self.records = self.fs.open_output_stream(self.draft, compression=None), 0

    def add(self, *parts: bytes) -> None:
        self.out.write(gzip.compress(b"".join(parts), compresslevel=1, mtime=0))

    def close(self) -> pa.RecordBatch:
        self.out.close()
        self.fs.move(self.draft, self.path)
        return pa.RecordBatch.from_pydict({"path": [self.address], "records": [self.records]}, schema=MANIFEST)


class _Unzipped:
    """Reads gzip members as one stream, by line or by length."""

    def __init__(self, raw):
        self.raw, self.zip, self.held, self.at = raw, None, b"", 0

    def _more(self) -> bool:
        rest = self.zip.unused_data if self.zip is not None and self.zip.eof else b""
        data = rest or self.raw.read(1 << 18)
        if not data:
            return False
        if self.zip is None or self.zip.eof:
            self.zip = zlib.decompressobj(31)
        self.held, self.at = self.held[self.at :] + self.zip.decompress(data), 0
        return True

    def line(self) -> bytes:
        """The next line with its end, or what is left."""
        seen = self.at
        while (end := self.held.find(b"\n", seen)) < 0:
            seen = len(self.held) - self.at
            if not self._more():
                end = len(self.held) - 1
                break
        out, self.at = self.held[self.at : end + 1], end + 1
        return out

    def take(self, n: int) -> bytes:
        parts = []
        while n:
            if self.at == len(self.held):
                self.held, self.at = b"", 0
                if not self._more():
                    raise ValueError("archive ends inside a record")
            part = self.held[self.at : self.at + n]
            parts.append(part)
            self.at += len(part)
            n -= len(part)
        return b"".join(parts)


def _safe_uri(url: str | None, page_id) -> str:
    if not url:
        return f"urn:page:{'' if page_id is None else page_id}"
    return re.sub(r"[\x00-\x20\x7f-\x9f  ]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)


def arc_record(version: int, uri: str, ip: str, date: str, mime: str, content: bytes, name: str = "-") -> bytes:
    values = {"URL": uri, "IP-address": ip, "Archive-date": date, "Content-type": mime, "Result-code": "200", "Checksum": "-",
              "Location": "-", "Offset": "0", "Filename": name, "Archive-length": str(len(content))}
    return " ".join(values[f] for f in ARC_FIELDS[version]).encode("utf-8", "surrogatepass") + b"\n" + content + b"\n"


def version_block(version: int, name: str, date: str) -> bytes:
    content = f"{version} 0 archive\n{' '.join(ARC_FIELDS[version])}\n".encode()
    return arc_record(version, f"filedesc://{name}", "0.0.0.0", date, "text/plain", content, name)


def parse_arc(stream: _Unzipped):
    """Yields (header fields, content) of each record after the version block."""
    first = stream.line()
    while first in (b"\n", b"\r\n"):
        first = stream.line()
    if not first:
        return
    if not first.startswith(b"filedesc:"):
        raise ValueError("archive without a version block")
    body = stream.take(int(first.split()[-1]))
    version = int(body.split(None, 1)[0])
    if version not in ARC_FIELDS:
        raise ValueError(f"unknown archive version {version}")
    names = ARC_FIELDS[version]
    while line := stream.line():
        if not line.strip():
            continue
        values = line.decode("utf-8", "surrogatepass").rstrip("\r\n").split(" ")
        # A mime type may hold blanks; the fields around it may not.
        extra = len(values) - len(names)
        if extra < 0:
            raise ValueError(f"header line with {len(values)} fields")
        values[3 : 4 + extra] = [" ".join(values[3 : 4 + extra])]
        fields = dict(zip(names, values))
        yield fields, stream.take(int(fields["Archive-length"]))


def _http_parts(content: bytes) -> tuple[bytes, bytes]:
    """HTTP header block (with its blank line) and payload; content without one is all payload."""
    if not content.startswith(b"HTTP/"):
        return b"", content
    end = content.find(b"\r\n\r\n")
    return (content, b"") if end < 0 else (content[: end + 4], content[end + 4 :])


def _header(block: bytes, name: bytes) -> bytes | None:
    found = re.search(rb"(?im)^" + re.escape(name) + rb":[ \t]*([^\r\n]*)", block)
    return found[1] if found else None


def _write_arcs(folder: str, date: str):
    def run(batches):
        file = version = None
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "html"))):
                page_id, url, html = (v.as_py() for v in row)
                if file is None:
                    version = 1 + TaskContext.get().partitionId() % 2
                    file = _File(folder, "arc.gz")
                    file.add(version_block(version, os.path.basename(file.path), date))
                body = html or b""
                ident = b"" if page_id is None else ID_HEADER + b": %d\r\n" % page_id
                http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + ident + b"Content-Length: %d\r\n\r\n" % len(body)
                file.add(arc_record(version, _safe_uri(url, page_id), "0.0.0.0", date, "text/html", http + body, os.path.basename(file.path)))
                file.records += 1
        if file is not None:
            yield file.close()

    return run


def _files(reader):
    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, base = pafs.FileSystem.from_uri(path)
                with fs.open_input_stream(base, compression=None) as raw:
                    yield from reader(_Unzipped(raw))

    return run


def _batched(rows, schema: pa.Schema, weigh):
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 200 + weigh(row)
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _parsed(stream):
    def rows():
        for fields, content in parse_arc(stream):
            http, payload = _http_parts(content)
            ident = _header(http, ID_HEADER)
            yield {"page_id": None if ident is None else int(ident), "uri": fields["URL"], "ip": fields["IP-address"], "date": fields["Archive-date"],
                   "mime": fields["Content-type"], "http": http, "payload": payload, "payload_bytes": len(payload),
                   "digest": hashlib.sha256(payload).hexdigest()}

    return _batched(rows(), PARSED, lambda r: r["payload_bytes"])


def warc_date(date: str) -> str:
    """W3C form of a legacy date of 8 to 14 digits."""
    d = (date + "0" * 14)[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(page_id, uri: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}|{uri}|{digest}')}>"


def warc_record(kind: str, fields: dict, block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return f"WARC/1.1\r\nWARC-Type: {kind}\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def _write_warcs(folder: str):
    def run(batches):
        file = None
        for batch in batches:
            columns = [batch.column(c) for c in batch.schema.names]
            for row in zip(*columns):
                r = {n: v.as_py() for n, v in zip(batch.schema.names, row)}
                if file is None:
                    file = _File(folder, "warc.gz")
                    name = os.path.basename(file.path)
                    info = {"WARC-Record-ID": record_id(None, name, ""), "WARC-Date": warc_date(r["date"]), "WARC-Filename": name, "Content-Type": "application/warc-fields"}
                    file.add(warc_record("warcinfo", info, b"format: WARC File Format 1.1\r\n"))
                revisit = r["refers_to"] is not None
                block = r["http"] if revisit else r["http"] + r["payload"]
                fields = {
                    "WARC-Record-ID": record_id(r["page_id"], r["uri"], r["digest"]), "WARC-Date": warc_date(r["date"]), "WARC-Target-URI": r["uri"],
                    "WARC-IP-Address": r["ip"], "WARC-Payload-Digest": f"sha256:{r['digest']}", "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
                    "Content-Type": "application/http; msgtype=response" if r["http"] else r["mime"],
                }
                if revisit:
                    fields |= {
                        "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                        "WARC-Refers-To": record_id(r["refers_to"], r["refers_uri"], r["digest"]), "WARC-Refers-To-Target-URI": r["refers_uri"],
                        "X-Refers-To-Page-Id": r["refers_to"], "X-Payload-Length": r["payload_bytes"],
                    }
                file.add(warc_record("revisit" if revisit else "response", fields, block))
                file.records += 1
        if file is not None:
            yield file.close()

    return run


def parse_warc(stream: _Unzipped):
    """Yields (header fields, block) of each record."""
    while line := stream.line():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("record does not start with its version")
        fields = {}
        while (line := stream.line()).strip():
            name, _, value = line.decode("utf-8", "surrogatepass").partition(":")
            fields[name.lower()] = value.strip()
        yield fields, stream.take(int(fields["content-length"]))


def _found(stream):
    def rows():
        for fields, block in parse_warc(stream):
            kind = fields["warc-type"]
            if kind not in ("response", "revisit"):
                continue
            http, payload = _http_parts(block) if fields["content-type"].startswith("application/http") else (b"", block)
            ident, declared = _header(http, ID_HEADER), fields["warc-payload-digest"].removeprefix("sha256:")
            if kind == "response" and hashlib.sha256(payload).hexdigest() != declared:
                raise ValueError(f"payload of {fields['warc-record-id']} differs from its digest")
            refers = fields.get("x-refers-to-page-id")
            yield {"page_id": None if ident is None else int(ident), "payload_bytes": int(fields.get("x-payload-length", len(payload))),
                   "payload_digest": declared, "record_type": kind, "refers_to": None if refers is None else int(refers),
                   "record_id": fields["warc-record-id"], "refers_to_id": fields.get("warc-refers-to"),
                   "target_uri": fields["warc-target-uri"], "date": fields["warc-date"]}

    return _batched(rows(), FOUND, lambda r: 200)


def _each_file(manifest: DataFrame) -> DataFrame:
    """One task per file; the manifest has one row per file."""
    n = max(1, manifest.count())
    return manifest.select("path").repartitionByRange(n, "path") if n > 1 else manifest.select("path")


def write_arcs(pages: DataFrame, folder: str, ws: Workspace, date: str = CAPTURE_DATE) -> DataFrame:
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.col("html").cast("binary").alias("html"))
    return ws.save(rows.mapInArrow(_write_arcs(folder, date), _ddl(MANIFEST)), "arc-manifest")


def read_arcs(manifest: DataFrame) -> DataFrame:
    return _each_file(manifest).mapInArrow(_files(_parsed), _ddl(PARSED))


def convert(manifest: DataFrame, folder: str, ws: Workspace, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """WARC files of the ARC files in ``manifest``; returns their manifest."""
    records = read_arcs(manifest)
    copies = records.where((F.col("payload_bytes") >= min_revisit) & F.col("page_id").isNotNull()).groupBy("digest").agg(
        F.min(F.struct("page_id", "uri")).alias("first"), F.max("page_id").alias("last")
    ).where("first.page_id < last")
    copies = ws.save(copies.select("digest", "first"), "copies")
    # Small tables are broadcast by their stored size; beyond it a payload's rows go to SALTS tasks.
    dealt = copies.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    records = records.withColumn("salt", F.pmod(F.xxhash64("page_id", "uri"), F.lit(SALTS)))
    joined = records.join(dealt, ["digest", "salt"], "left")
    revisits = (F.col("page_id") > F.col("first.page_id")) & (F.col("payload_bytes") >= min_revisit)
    rows = joined.select(
        *[c for c in PARSED.names if c != "payload"], F.when(revisits, F.col("first.page_id")).alias("refers_to"),
        F.when(revisits, F.col("first.uri")).alias("refers_uri"), F.when(~F.coalesce(revisits, F.lit(False)), F.col("payload")).alias("payload"),
    )
    return ws.save(rows.mapInArrow(_write_warcs(folder), _ddl(MANIFEST)), "warc-manifest")


def read_warcs(manifest: DataFrame) -> DataFrame:
    return _each_file(manifest).mapInArrow(_files(_found), _ddl(FOUND))


def report(pages: DataFrame) -> DataFrame:
    ws = Workspace(pages.sparkSession, "archives")
    arcs = write_arcs(pages, ws.address("arc"), ws)
    return read_warcs(convert(arcs, ws.address("warc"), ws))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages),
d AS (SELECT *, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS low FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > low THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > low THEN low END AS refers_to
FROM f
"""
