"""Legacy archives (ARC, versions 1 and 2) and their conversion to WARC.

``write_arc`` lays captures down as ARC files (a gzip member per record);
``scan_arc`` parses the version block, the version's own header fields and the
declared lengths; ``convert`` synthesises for every ARC record its WARC record:
identifier (from file name and offset, so a repeated run names it alike),
timestamp, type and SHA-1 digests.  Of records with equal payloads the one with
the smallest page_id is written as ``response``, the others as ``revisit`` that
refer to it.  ``read_warc`` parses the WARC files again and recomputes the
digest of every stored payload.

Payloads never move between tasks: the first pass yields one slim row per record
(file, offset, digest), the choice of responses is a partially aggregated
minimum per digest, and the second pass reads each payload where it lies.

Defined cases: a null payload is empty; a null URL leaves the record without a
target URI; white space and control characters in a URL are percent-encoded.  A
null page_id writes no page number and sorts after all others when a response
is chosen.  Repeated rows are further captures: the first stays response (rows
with the same page_id: the one that stands first in the archives), the others
revisit it.  Extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import stored, tasks_for
from .files import make_folder, opened, written

#: Header fields of a record, by version.
FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
EPOCH = datetime(2000, 1, 1, tzinfo=timezone.utc)
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEVEL = 1
_READ = 1 << 20


def digest(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def quoted(url: str) -> str:
    """White space and control characters percent-encoded, as header fields are separated by spaces."""
    return re.sub(r"[\x00-\x20\x7f\s]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)


class Members:
    """Writes one gzip member after the other."""

    def __init__(self, out):
        self.out, self.at = out, 0

    def add(self, *parts: bytes) -> int:
        """The offset of the new member."""
        squeeze, begin = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), self.at
        for data in (*(squeeze.compress(p) for p in parts), squeeze.flush()):
            self.out.write(data)
            self.at += len(data)
        return begin


def members(file, offset: int = 0) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of the gzip members from ``offset`` on; holds one member and a read buffer."""
    file.seek(offset)
    rest, at = b"", offset
    while True:
        rest = rest or file.read(_READ)
        if not rest:
            return
        unpack, content, begin = zlib.decompressobj(31), [], at
        while not unpack.eof:
            if not rest and not (rest := file.read(_READ)):
                raise ValueError(f"truncated gzip member at {begin}")
            content.append(unpack.decompress(rest))
            at += len(rest) - len(unpack.unused_data)
            rest = unpack.unused_data
        yield begin, b"".join(content)


# ---------------------------------------------------------------- ARC

def arc_version_block(name: str, version: int) -> bytes:
    body = f"{version} 0 gleaner\n{' '.join(FIELDS[version])}\n".encode()
    line = {"URL": f"filedesc://{name}", "IP-address": "0.0.0.0", "Archive-date": f"{EPOCH:%Y%m%d%H%M%S}", "Content-type": "text/plain",
            "Result-code": "200", "Checksum": "-", "Location": "-", "Offset": "0", "Filename": name, "Archive-length": str(len(body))}
    return " ".join(line[f] for f in FIELDS[version]).encode() + b"\n" + body + b"\n"


def arc_record(version: int, name: str, offset: int, page_id: int | None, url: str | None, payload: bytes) -> tuple[bytes, bytes, bytes]:
    """(header line, HTTP head, payload) of a captured page."""
    head = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    head += [f"X-Page-Id: {page_id}"] if page_id is not None else []
    http = ("\r\n".join(head) + "\r\n\r\n").encode()
    moment = EPOCH + timedelta(seconds=(page_id or 0) % (10 * 365 * 86400))
    line = {"URL": quoted(url) if url else "-", "IP-address": "0.0.0.0", "Archive-date": f"{moment:%Y%m%d%H%M%S}", "Content-type": "text/html",
            "Result-code": "200", "Checksum": "-", "Location": "-", "Offset": str(offset), "Filename": name,
            "Archive-length": str(len(http) + len(payload))}
    return " ".join(line[f] for f in FIELDS[version]).encode() + b"\n", http, payload


def arc_records(file) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, body) of every record after the version block."""
    parts = members(file)
    _, content = next(parts)
    header, block = parse_arc(content, ())
    version, names = block.decode().split("\n")[:2]
    fields = tuple(names.split(" "))
    if not header["URL"].startswith("filedesc:") or FIELDS.get(int(version.split()[0])) != fields:
        raise ValueError(f"not an ARC version block: {content[:80]!r}")
    for offset, content in parts:
        yield offset, *parse_arc(content, fields)


def parse_arc(content: bytes, fields: tuple[str, ...]) -> tuple[dict[str, str], bytes]:
    """Header fields and exactly the declared length of body.  The version block names its own count of fields."""
    line, _, rest = content.partition(b"\n")
    values = line.decode("utf-8", "replace").split(" ")
    fields = fields or next((f for f in FIELDS.values() if len(f) == len(values)), ())
    if len(values) != len(fields):
        raise ValueError(f"header line does not fit its version: {line[:120]!r}")
    header = dict(zip(fields, values))
    size = int(header["Archive-length"])
    if len(rest) < size:
        raise ValueError(f"record shorter than its declared length {size}")
    return header, rest[:size]


def split_http(body: bytes) -> tuple[bytes, bytes]:
    """(head with its blank line, payload); a body that is no HTTP response is all payload."""
    if not body.startswith(b"HTTP/"):
        return b"", body
    at = body.find(b"\r\n\r\n")
    return (body, b"") if at < 0 else (body[:at + 4], body[at + 4:])


def http_field(head: bytes, name: str) -> str | None:
    m = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*([^\r\n]*)", head)
    return m[1].decode("latin-1") if m else None


FILES = "path string, records long"
_FILES = pa.schema([("path", pa.string()), ("records", pa.int64())])


def write_arc(pages: DataFrame, folder: str) -> DataFrame:
    """Two files per task: version 1 for even, version 2 for odd page ids (null: version 1).  (path, records) of each."""
    make_folder(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        names = {v: f"part-{part:06d}-v{v}.arc.gz" for v in FIELDS}
        counts = dict.fromkeys(FIELDS, 0)
        with written(f"{folder}/{names[1]}") as one, written(f"{folder}/{names[2]}") as two:
            out = {1: Members(one), 2: Members(two)}
            for v in FIELDS:
                out[v].add(arc_version_block(names[v], v))
            for batch in batches:
                for page_id, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                    v = 1 + (page_id or 0) % 2
                    out[v].add(*arc_record(v, names[v], out[v].at, page_id, url, (html or "").encode()), b"\n")
                    counts[v] += 1
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{names[v]}" for v in FIELDS]), pa.array([counts[v] for v in FIELDS], pa.int64())], schema=_FILES)

    return pages.select("page_id", "url", "html").mapInArrow(run, FILES)


def _each_file(files: DataFrame) -> DataFrame:
    """One file per row, dealt out over tasks."""
    return files.filter("records > 0").select("path").repartition(tasks_for(files), "path")


def scan_arc(files: DataFrame) -> DataFrame:
    """(arc, offset, page_id, payload_digest, payload_bytes) of every record."""
    kind = pa.schema([("arc", pa.string()), ("offset", pa.int64()), ("page_id", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = []
                with opened(path) as file:
                    for offset, _, body in arc_records(file):
                        head, payload = split_http(body)
                        page = http_field(head, "X-Page-Id")
                        rows.append((path, offset, None if page is None else int(page), digest(payload), len(payload)))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kind)], schema=kind)

    return _each_file(files).mapInArrow(run, "arc string, offset long, page_id long, payload_digest string, payload_bytes long")


# ---------------------------------------------------------------- WARC

def record_id(arc: str, offset: int) -> str:
    """The identifier of the WARC record made of an ARC record."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{arc.rpartition('/')[2]}#{offset}')}>"


def warc_block(fields: list[tuple[str, str]], content_length: int) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(content_length))]) + "\r\n").encode()


def warc_info(name: str) -> tuple[bytes, bytes]:
    body = b"software: gleaner\r\nformat: WARC File Format 1.1\r\n"
    fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(name, -1)), ("WARC-Date", f"{EPOCH:%Y-%m-%dT%H:%M:%SZ}"),
              ("WARC-Filename", name), ("Content-Type", "application/warc-fields")]
    return warc_block(fields, len(body)), body + b"\r\n\r\n"


def warc_record(arc: str, offset: int, header: dict[str, str], body: bytes, first: tuple[str, int] | None) -> tuple[bytes, ...]:
    """The WARC record of an ARC record; ``first``: (arc, offset) of the response that it repeats."""
    head, payload = split_http(body)
    date = datetime.strptime(header["Archive-date"], "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
    kind = "revisit" if first else "response" if head else "resource"
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id(arc, offset)), ("WARC-Date", date)]
    fields += [("WARC-Target-URI", header["URL"])] if header["URL"] != "-" else []
    fields += [("WARC-IP-Address", header["IP-address"])] if header["IP-address"] != "0.0.0.0" else []
    if first:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(*first))]
        payload_kept = b""
    else:
        payload_kept = payload
    block = hashlib.sha1(head)
    block.update(payload_kept)
    fields += [("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
               ("WARC-Block-Digest", f"sha1:{base64.b32encode(block.digest()).decode()}"),
               ("Content-Type", "application/http; msgtype=response" if head else header["Content-type"])]
    return warc_block(fields, len(head) + len(payload_kept)), head, payload_kept, b"\r\n\r\n"


def convert(records: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """One WARC file per ARC file; of equal payloads of ``least_bytes`` or more all but one are revisits.

    ``records`` is the stored result of ``scan_arc``.  Returns (path, records).
    """
    make_folder(folder)
    order = F.struct(F.col("page_id").isNull().alias("unnamed"), F.col("page_id"), F.col("arc"), F.col("offset"))
    firsts = (records.filter(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest")
              .agg(F.min(order).alias("first"), F.count("*").alias("copies")).filter("copies > 1").drop("copies"))
    mine = F.struct("arc", "offset")
    decided = (records.select("arc", "offset", F.when(F.col("payload_bytes") >= least_bytes, F.col("payload_digest")).alias("payload_digest"))
               .join(firsts, "payload_digest", "left")
               .select("arc", "offset", F.when(F.struct(F.col("first.arc"), F.col("first.offset")) != mine, F.col("first.arc")).alias("first_arc"),
                       F.when(F.struct(F.col("first.arc"), F.col("first.offset")) != mine, F.col("first.offset")).alias("first_offset")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("arc", "offset", "first_arc", "first_offset")))

        todo = rows()
        row = next(todo, None)
        while row is not None:
            arc, count = row[0], 0
            name = arc.rpartition("/")[2].replace(".arc.gz", ".warc.gz")
            with opened(arc) as file, written(f"{folder}/{name}") as out:
                target = Members(out)
                target.add(*warc_info(name))
                for offset, header, body in arc_records(file):
                    if row is None or row[:2] != (arc, offset):
                        raise ValueError(f"{arc}: no decision for the record at {offset}")
                    target.add(*warc_record(arc, offset, header, body, None if row[2] is None else row[2:]))
                    count += 1
                    row = next(todo, None)
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([count], pa.int64())], schema=_FILES)

    return decided.repartition(tasks_for(records), "arc").sortWithinPartitions("arc", "offset").mapInArrow(run, FILES)


def warc_records(file) -> Iterator[tuple[dict[str, str], bytes]]:
    """(named fields, block) of every record but the file's own description."""
    for _, content in members(file):
        head, _, rest = content.partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {content[:40]!r}")
        fields = dict(line.split(": ", 1) for line in lines)
        size = int(fields["Content-Length"])
        if len(rest) != size + 4:
            raise ValueError(f"{fields['WARC-Record-ID']}: block is not of its declared length")
        if fields["WARC-Type"] != "warcinfo":
            yield fields, rest[:size]


def read_warc(files: DataFrame) -> DataFrame:
    """(record_id, refers_to_id, page_id, url, record_type, payload_bytes, payload_digest) of every record.

    Of responses the digest is recomputed from the stored payload (an error if
    it differs); a revisit has the digest and length that its record states.
    """
    kind = pa.schema([("record_id", pa.string()), ("refers_to_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
                      ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = []
                with opened(path) as file:
                    for fields, block in warc_records(file):
                        head, payload = split_http(block)
                        stated = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        if fields["WARC-Type"] == "revisit":
                            size = int(http_field(head, "Content-Length") or 0)
                        else:
                            size = len(payload)
                            if digest(payload) != stated:
                                raise ValueError(f"{path}: payload of {fields['WARC-Record-ID']} does not have its digest")
                        page = http_field(head, "X-Page-Id")
                        rows.append((fields["WARC-Record-ID"], fields.get("WARC-Refers-To"), None if page is None else int(page),
                                     fields.get("WARC-Target-URI"), fields["WARC-Type"], size, stated))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kind)], schema=kind)

    return _each_file(files).mapInArrow(
        run, "record_id string, refers_to_id string, page_id long, url string, record_type string, payload_bytes long, payload_digest string")


def refers_to(records: DataFrame) -> DataFrame:
    """``records`` with ``refers_to``: the page_id of the response that a revisit names."""
    responses = records.filter("record_type = 'response'").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    # only revisits are joined: what names no other record would all meet under the one null key
    named = records.filter("refers_to_id is not null").join(responses, "refers_to_id", "left")
    return named.unionByName(records.filter("refers_to_id is null").withColumn("refers_to", F.lit(None).cast("long")))


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages -> ARC files -> WARC files -> one row per record read back."""
    spark = pages.sparkSession
    arcs = stored(write_arc(pages, scratch_path(spark, "arc")), "arc-files")
    records = stored(scan_arc(arcs), "arc-records")
    warcs = stored(convert(records, scratch_path(spark, "warc"), least_bytes), "warc-files")
    return refers_to(stored(read_warc(warcs), "warc-records"))
