"""Legacy ARC archives, converted to WARC.

An ARC file starts with a version block that names the fields of its header
lines: version 1 has URL, IP address, date, content type and length; version 2
adds result code, checksum, location, offset and file name.  A record is one
such line, then as many bytes as the line declares, then a line break.  Files
named ``.arc.gz`` hold one gzip member per record.

Conversion first indexes the ARC files: per record, where it lies and its
payload's digest.  Only this index is shuffled, to find of equal payloads the
one that stays a response.  Then each ARC file is read again, next to its part
of the index, and written as a WARC file: one gzip member per record, with
identifiers derived from the record itself, so a repeated run writes the same
file.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.llm.common import bounded_batches, column, open_store, publish, record, session_of, stage

#: Fields of an ARC header line, by version (fixed by the format).
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: (
        "URL", "IP-address", "Archive-date", "Content-type", "Result-code",
        "Checksum", "Location", "Offset", "Filename", "Archive-length",
    ),
}
#: Of revisit records that repeat an earlier payload (fixed by the format).
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
NO_IP = "0.0.0.0"
#: Date of records whose own date can't be read.
NO_DATE = "19700101000000"
PAGE_HEADER = "X-Page-Id"

FILE = "file string, records long"
ENTRY = "file string, at long, page_id long, url string, date string, payload_bytes long, payload_digest string"
RECORD = (
    "record_id string, record_type string, url string, date string, content_type string, page_id long, "
    "payload_bytes long, payload_digest string, refers_to long, payload binary"
)


def digest(data: bytes) -> str:
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _field(text: str) -> str:
    """A value that fits a header line: no line breaks, blanks as %20."""
    return re.sub(r"\s", lambda m: f"%{ord(m[0]):02X}" if ord(m[0]) < 256 else "%20", text) or "-"


# ---------------------------------------------------------------- ARC files


def arc_version_block(name: str, version: int) -> bytes:
    body = f"{version} 0 emporia\n{' '.join(ARC_FIELDS[version])}\n".encode()
    return arc_record(f"filedesc://{name}", "text/plain", body, version, name, 0)


def arc_record(
    url: str, content_type: str, body: bytes, version: int, name: str, offset: int, date: str = "20000101000000", ip: str = NO_IP
) -> bytes:
    """One record: its header line, the body, a line break."""
    values = [_field(url), ip, date, _field(content_type)]
    if version == 2:
        values += ["200", hashlib.md5(body).hexdigest(), "-", str(offset), _field(name)]
    return " ".join([*values, str(len(body))]).encode() + b"\n" + body + b"\n"


def arc_records(file) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset among the plain bytes, header fields, body) of each record of an open ARC file.

    The version block names the fields; a header line is split from the right,
    as only a URL may hold blanks.  A declared length beyond the end of the
    file, or a line with too few fields, raises ValueError.
    """
    data = _Lines(file)
    fields = ARC_FIELDS[1]
    while True:
        at = data.tell()
        line = data.line()
        if not line:
            return
        if not line.strip():  # line breaks between records
            continue
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text.startswith("filedesc://"):
            values = text.rsplit(" ", len(ARC_FIELDS[1]) - 1)
            body = data.take(int(values[-1]))
            names = body.decode("utf-8", "replace").split("\n")
            fields = tuple(names[1].split()) if len(names) > 1 and names[1].strip() else ARC_FIELDS[1]
            yield at, dict(zip(ARC_FIELDS[1], values)), body
            continue
        values = text.rsplit(" ", len(fields) - 1)
        if len(values) != len(fields) or not values[-1].isdigit():
            raise ValueError(f"not an ARC header line at {at}: {text[:80]!r}")
        yield at, dict(zip(fields, values)), data.take(int(values[-1]))


def unzipped(file, name: str):
    """The bytes of an open file, of all its gzip members if its name ends so."""
    return gzip.GzipFile(fileobj=file) if name.endswith(".gz") else file


class _Lines:
    """Lines and counted bytes of a stream, read in blocks."""

    def __init__(self, file, block: int = 1 << 16):
        self.file, self.block, self.kept, self.at = file, block, b"", 0

    def tell(self) -> int:
        return self.at

    def _more(self) -> bool:
        data = self.file.read(self.block)
        self.kept += data
        return bool(data)

    def line(self) -> bytes:
        seen = 0
        while (end := self.kept.find(b"\n", seen)) < 0:
            seen = len(self.kept)
            if not self._more():
                return self.take(len(self.kept))
        return self.take(end + 1)

    def take(self, n: int) -> bytes:
        while len(self.kept) < n:
            if not self._more():
                raise ValueError("a declared length goes beyond the end of the file")
        out, self.kept = self.kept[:n], self.kept[n:]
        self.at += n
        return out


def http_response(payload: bytes, page_id: int | None, content_type: str = "text/html; charset=utf-8") -> bytes:
    lines = ["HTTP/1.1 200 OK", f"Content-Type: {content_type}", f"Content-Length: {len(payload)}"]
    if page_id is not None:
        lines.append(f"{PAGE_HEADER}: {page_id}")
    return "\r\n".join([*lines, "", ""]).encode() + payload


def http_parts(body: bytes) -> tuple[bytes, dict[str, str], bytes]:
    """Head with its empty line, header fields in lower case, payload; no head: all payload."""
    end = body.find(b"\r\n\r\n")
    if not body.startswith(b"HTTP/") or end < 0:
        return b"", {}, body
    head = body[: end + 4]
    lines = head.decode("iso-8859-1").split("\r\n")[1:]
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if v}
    return head, fields, body[end + 4 :]


def write_arc(
    pages: DataFrame,
    path: str,
    version: int | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    compress: bool = True,
) -> DataFrame:
    """Write pages as ARC files below ``path`` and return (file, records), reread.

    One file per task; without ``version`` even tasks write version 1 and odd
    ones version 2.  Null html is an empty payload, a null URL a URN.  With
    ``compress`` each record is a gzip member of its own.
    """
    path = path.rstrip("/")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"),
    )

    def member(data: bytes) -> bytes:
        return gzip.compress(data, 1, mtime=0) if compress else data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}.arc{'.gz' if compress else ''}"
        kind = version or 1 + task.partitionId() % 2
        count = 0

        def fill(out) -> None:
            nonlocal count
            head = member(arc_version_block(name, kind))
            out.write(head)
            offset, batch = len(head), first
            while batch is not None:
                html = column(batch, "html").cast(pa.binary()).to_pylist()
                for page_id, url, data in zip(column(batch, "page_id").to_pylist(), column(batch, "url").to_pylist(), html):
                    url = url or f"urn:page:{page_id}"
                    body = http_response(data, page_id)
                    written = member(arc_record(url, "text/html", body, kind, name, offset))
                    out.write(written)
                    offset += len(written)
                    count += 1
                batch = next(batches, None)

        publish(f"{path}/{name}", task.taskAttemptId(), fill)
        yield record({"file": [f"{path}/{name}"], "records": [count]}, {"file": pa.string(), "records": pa.int64()})

    bounded_batches(session_of(pages))
    return stage(rows.mapInArrow(run, FILE), "arc-files")


# --------------------------------------------------------------- conversion


def index_arc(files: DataFrame) -> DataFrame:
    """(file, at, page_id, url, date, payload_bytes, payload_digest) of each HTTP record of the ARC files."""
    types = {
        "file": pa.string(), "at": pa.int64(), "page_id": pa.int64(),
        "url": pa.string(), "date": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in column(batch, "file").to_pylist():
                store, name = open_store(file)
                out: dict[str, list] = {k: [] for k in types}
                with store.open_input_file(name) as source:
                    for at, fields, body in arc_records(unzipped(source, name)):
                        if fields["URL"].startswith("filedesc://"):
                            continue
                        _, http, payload = http_parts(body)
                        page = http.get(PAGE_HEADER.lower())
                        date = warc_date(fields["Archive-date"])
                        row = (file, at, int(page) if page else None, fields["URL"], date, len(payload), digest(payload))
                        for k, v in zip(types, row):
                            out[k].append(v)
                yield record(out, types)

    count = max(1, files.count())
    return stage(files.select("file").repartition(count).mapInArrow(run, ENTRY), "arc-index")


def revisits(index: DataFrame, min_bytes: int = 0) -> DataFrame:
    """The index with ``refers_to``, ``refers_url`` and ``refers_date``: the response a record repeats, or nulls.

    Of records with equal payloads of at least ``min_bytes``, the smallest
    page id stays a response (all rows of that id do, and the others refer to
    the one smallest by URL and date).  A record without page id refers to it
    too, unless no record has one.
    """
    named = F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url", "date"))
    least = index.groupBy("payload_digest").agg(F.min(named).alias("__least"))
    repeated = (F.col("payload_bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("__least.page_id"))
    refers = (("refers_to", "page_id"), ("refers_url", "url"), ("refers_date", "date"))
    return index.join(least, "payload_digest").select(
        *index.columns, *[F.when(repeated, F.col(f"__least.{c}")).alias(name) for name, c in refers]
    )


def record_id(url: str, date: str, page_id: int | None, payload_digest: str) -> str:
    """The identifier that conversion gives a record: the same on every run."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {date} {page_id} {payload_digest}')}>"


def warc_date(date: str) -> str:
    """An ARC date of 14 digits (12: no seconds) in WARC's form."""
    if re.fullmatch(r"\d{12}", date):
        date += "00"
    try:
        at = datetime.strptime(date, "%Y%m%d%H%M%S")
    except ValueError:
        at = datetime.strptime(NO_DATE, "%Y%m%d%H%M%S")
    return at.replace(tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def warc_record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One record as a gzip member of its own, the same bytes on every run."""
    lines = ["WARC/1.0", *[f"{k}: {v}" for k, v in fields if v is not None], f"Content-Length: {len(block)}", "", ""]
    return gzip.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n", 6, mtime=0)


def convert_record(fields: dict[str, str], body: bytes, refers_to: tuple[int, str, str] | None) -> bytes:
    """An ARC record as a WARC record: version blocks become warcinfo, other schemes than HTTP resources.

    ``refers_to``: page id, URL and date of the response that this record repeats.
    """
    date = warc_date(fields["Archive-date"])
    url, ip = fields["URL"], fields["IP-address"]
    if url.startswith("filedesc://"):
        name = url[len("filedesc://") :]
        own = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(url, date, None, digest(body))), ("WARC-Date", date)]
        block = f"software: emporia\r\nformat: WARC File Format 1.0\r\nconverted-from: {name}\r\n".encode()
        return warc_record([*own, ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], block)
    head, http, payload = http_parts(body)
    page = http.get(PAGE_HEADER.lower())
    page_id = int(page) if page else None
    sha = digest(payload)
    own = [
        ("WARC-Record-ID", record_id(url, date, page_id, sha)), ("WARC-Date", date), ("WARC-Target-URI", url),
        ("WARC-IP-Address", None if ip == NO_IP else ip), ("WARC-Payload-Digest", f"sha1:{sha}"),
    ]
    if not head:
        kind, block, content = "resource", body, fields["Content-type"]
    elif refers_to is None:
        kind, block, content = "response", body, "application/http; msgtype=response"
    else:
        kind, block, content = "revisit", head, "application/http; msgtype=response"
        page, target, then = refers_to
        own += [
            ("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(target, then, page, sha)),
            ("WARC-Refers-To-Target-URI", target), ("WARC-Refers-To-Date", then), ("X-Refers-To-Page", str(page)),
        ]
    own += [("WARC-Block-Digest", f"sha1:{digest(block)}"), ("Content-Type", content)]
    return warc_record([("WARC-Type", kind), *own], block)


def convert(files: DataFrame, path: str, min_bytes: int = 0) -> DataFrame:
    """Convert ARC files (column ``file``) to WARC files below ``path``; returns (file, records), reread.

    The task that has a file's part of the index reads that file once, in
    order; no payload is shuffled.  A WARC file is named after its ARC file and
    a hash of the whole path, so files of one name from several folders stay apart.
    """
    path = path.rstrip("/")
    index = revisits(index_arc(files), min_bytes)
    count = max(1, files.count())
    # a file's rows meet in one task: as many as one ARC file has records
    dealt = index.select("file", "at", "refers_to", "refers_url", "refers_date").repartition(count, "file").sortWithinPartitions("file", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, dict[int, tuple[int, str, str]]] = {}
        order: list[str] = []
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns))
            for file, at, *refers_to in rows:
                if file not in kept:
                    kept[file] = {}
                    order.append(file)
                if refers_to[0] is not None:
                    kept[file][at] = tuple(refers_to)
        for file in order:
            stem = file.rsplit("/", 1)[1].removesuffix(".gz").removesuffix(".arc")
            name = f"{path}/{stem}-{hashlib.sha1(file.encode()).hexdigest()[:12]}.warc.gz"
            count = 0

            def fill(out, file=file) -> None:
                nonlocal count
                store, source = open_store(file)
                with store.open_input_file(source) as data:
                    for at, fields, body in arc_records(unzipped(data, source)):
                        out.write(convert_record(fields, body, kept[file].get(at)))
                        count += 1

            publish(name, TaskContext.get().taskAttemptId(), fill)
            yield record({"file": [name], "records": [count]}, {"file": pa.string(), "records": pa.int64()})

    return stage(dealt.mapInArrow(run, FILE), "warc-files")


# --------------------------------------------------------------- WARC files


def warc_records(file) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of an open, gzipped WARC file."""
    data = _Lines(gzip.GzipFile(fileobj=file))
    while line := data.line():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        fields = {}
        while (line := data.line()).strip():
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields, data.take(int(fields["content-length"]))


def read_warc(files: DataFrame) -> DataFrame:
    """The records of WARC files (column ``file``) but their warcinfo.

    Size and digest are those of the full payload: for responses and resources
    computed from the bytes read, for revisits as their headers state them.
    """
    types = {
        "record_id": pa.string(), "record_type": pa.string(), "url": pa.string(), "date": pa.string(),
        "content_type": pa.string(), "page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
        "refers_to": pa.int64(), "payload": pa.binary(),
    }

    def rows(file: str) -> Iterator[tuple]:
        store, name = open_store(file)
        with store.open_input_file(name) as source:
            for fields, block in warc_records(source):
                kind = fields["warc-type"]
                if kind == "warcinfo":
                    continue
                _, http, payload = http_parts(block)
                page = http.get(PAGE_HEADER.lower())
                refers = fields.get("x-refers-to-page")
                if kind == "revisit":
                    n, sha = int(http.get("content-length", 0)), fields["warc-payload-digest"].removeprefix("sha1:")
                    payload = None
                else:
                    n, sha = len(payload), digest(payload)
                yield (
                    fields["warc-record-id"], kind, fields["warc-target-uri"], fields["warc-date"], fields.get("content-type"),
                    int(page) if page else None, n, sha, int(refers) if refers else None, payload,
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in column(batch, "file").to_pylist():
                out: dict[str, list] = {k: [] for k in types}
                for row in rows(file):
                    for k, v in zip(types, row):
                        out[k].append(v)
                    if len(out["url"]) >= 500:
                        yield record(out, types)
                        out = {k: [] for k in types}
                yield record(out, types)

    return files.select("file").repartition(max(1, files.count())).mapInArrow(run, RECORD)


def pages_to_warc(pages: DataFrame, path: str, min_bytes: int = 0) -> DataFrame:
    """Pages to ARC, ARC to WARC, and the WARC records read back."""
    path = path.rstrip("/")
    return read_warc(convert(write_arc(pages, f"{path}/arc"), f"{path}/warc", min_bytes))


def files_of(spark: SparkSession, paths: list[str]) -> DataFrame:
    """A frame of archive files for :func:`convert` and :func:`read_warc`."""
    return spark.createDataFrame([(p,) for p in paths], "file string")
