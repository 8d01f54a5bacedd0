"""Legacy web archives (ARC, versions 1 and 2) and their conversion to WARC.

An ARC file begins with a version block, whose second line names the version. Each record has one
header line, with five fields in version 1 and ten in version 2, the last the declared length of
what follows. The converter takes records by their declared lengths alone, so content that looks
like a header does no harm, and writes one WARC file per ARC file: identifiers are derived from
address, time and payload (the same record always gets the same), 14-digit times become ISO ones,
digests are computed anew, and of records with equal payloads of at least ``LEAST_PAYLOAD`` bytes all
but the first become revisits, which name its record, address and time. Every record of either format is a gzip member of its own.

Payloads are never shuffled: an index of digests decides which records are revisits, and each file
is then converted by the task that gets its part of the index.

Defined cases: a null html is an empty payload; a null address is ``urn:page:<id>``; the first of
equal payloads is the one of smallest page_id, null ids last, then by place in the archives; an
empty table gives no files; other columns are ignored.
"""

from __future__ import annotations

import datetime
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelane.llm.common import positive, written
from quotelane.llm.files import open_fs, put
from quotelane.session import work_dir

LEAST_PAYLOAD = 100
FILE_BYTES = 16 << 20
LEVEL = 1
EPOCH = datetime.datetime(2024, 1, 1)
SPAN_SECONDS = 10 * 365 * 86400
# The fields of a record's header line in each version of the format.
FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: (
        "URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location",
        "Offset", "Filename", "Archive-length",
    ),
}


def arc_record(version: int, url: str, when: str, body: bytes, offset: int, name: str) -> bytes:
    values = {
        "URL": url.replace(" ", "%20").replace("\n", "%0A").replace("\r", "%0D").replace("\t", "%09"),
        "IP-address": "0.0.0.0",
        "Archive-date": when,
        "Content-type": "text/html",
        "Result-code": "200",
        "Checksum": hashlib.md5(body).hexdigest(),
        "Location": "-",
        "Offset": str(offset),
        "Filename": name,
        "Archive-length": str(len(body)),
    }
    line = " ".join(values[f] for f in FIELDS[version])
    return line.encode() + b"\n" + body + b"\n"


def arc_head(version: int, name: str) -> bytes:
    block = f"{version} 0 quotelane\n{' '.join(FIELDS[version])}\n".encode()
    return f"filedesc://{name} 0.0.0.0 20240101000000 text/plain {len(block)}\n".encode() + block + b"\n"


def read_arc(raw: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Place, header fields and body of every record after the version block."""
    at, version = 0, None
    while at < len(raw):
        if raw[at : at + 1] == b"\n":
            at += 1
            continue
        end = raw.index(b"\n", at)
        values = raw[at:end].decode("utf-8", "surrogateescape").split(" ")
        size = int(values[-1])
        body = raw[end + 1 : end + 1 + size]
        if len(body) < size:
            raise ValueError(f"record at {at} is cut short: {len(body)} of {size} bytes")
        if version is None:
            version = int(body.split(b" ", 1)[0])
            if version not in FIELDS:
                raise ValueError(f"version {version} of the format is not known")
        else:
            if len(values) != len(FIELDS[version]):
                raise ValueError(f"record at {at} has {len(values)} fields")
            yield at, dict(zip(FIELDS[version], values, strict=True)), body
        at = end + 1 + size


def http_split(body: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields, raw header and payload of an HTTP response."""
    head, _, payload = body.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogateescape").split("\r\n")[1:]
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    return fields, head + b"\r\n\r\n", payload


def _write_arcs(folder: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, count = TaskContext.get().partitionId(), 0
        name, version, parts, size = "", 1, [], 0

        def close() -> pa.RecordBatch:
            path = f"{folder}/{name}"
            put(path, parts)
            return pa.RecordBatch.from_pydict({"path": [path]})

        for batch in batches:
            for page, url, html in zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True):
                if not parts:
                    version = 1 + (part + count) % 2
                    name = f"pages-{part:06d}-{count:06d}.arc.gz"
                    head = arc_head(version, name)
                    parts, size, count = [gzip.compress(head, mtime=0)], len(head), count + 1
                payload = (html or "").encode()
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n"
                head += f"X-Page-Id: {page}\r\n\r\n" if page is not None else "\r\n"
                when = EPOCH + datetime.timedelta(seconds=(page or 0) % SPAN_SECONDS)
                record = arc_record(
                    version, url or f"urn:page:{page}", when.strftime("%Y%m%d%H%M%S"), head.encode() + payload, size, name
                )
                parts.append(gzip.compress(record, LEVEL, mtime=0))
                size += len(record)
                if size >= file_bytes:
                    yield close()
                    parts = []
        if parts:
            yield close()

    return run


def write_arcs(pages: DataFrame, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write pages as ARC files, in either version by turns; returns their paths."""
    folder = work_dir(pages.sparkSession, "arc")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return written(rows.mapInArrow(_write_arcs(folder, file_bytes), "path string"), "arc-files")


def gzip_members(raw: bytes, step: int = 1 << 15) -> Iterator[bytes]:
    """The content of each gzip member of a file; what follows a member is never copied whole."""
    view, at = memoryview(raw), 0
    while at < len(view):
        member, parts = zlib.decompressobj(31), []
        while not member.eof:
            if at >= len(view):
                raise ValueError("the last record is cut short")
            piece = view[at : at + step]
            parts.append(member.decompress(piece))
            at += len(piece)
        at -= len(member.unused_data)
        yield b"".join(parts)


def _slurp(path: str) -> bytes:
    system, place = open_fs(path)
    with system.open_input_file(place) as file:
        return file.read()


INDEX = pa.schema(
    [
        ("path", pa.string()), ("place", pa.int64()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()),
        ("digest", pa.string()), ("url", pa.string()), ("moment", pa.string()),
    ]
)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            rows = []
            for place, values, body in read_arc(b"".join(gzip_members(_slurp(path)))):
                fields, _, payload = http_split(body)
                page = fields.get("x-page-id")
                page, digest = None if page is None else int(page), hashlib.sha256(payload).hexdigest()
                rows.append((path, place, page, len(payload), digest, values["URL"], values["Archive-date"]))
            columns = list(zip(*rows, strict=True)) or [()] * len(INDEX)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, INDEX, strict=True)], schema=INDEX
            )


def record_id(url: str, when: str, digest: str) -> str:
    """The same for the same contents, so a revisit can name a record of another file."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {when} {digest}')}>"


def iso_time(when: str) -> str:
    return datetime.datetime.strptime(when, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    digest = hashlib.sha256(block).hexdigest()
    fields = [*fields, ("WARC-Block-Digest", f"sha256:{digest}"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    raw = head.encode("utf-8", "surrogateescape") + block + b"\r\n\r\n"
    return gzip.compress(raw, LEVEL, mtime=0)


def _convert(table: pa.Table) -> pa.Table:
    """One ARC file to one WARC file. ``table``: path, place, and the first record of the payload."""
    path = table.column("path")[0].as_py()
    plan = {r["place"]: r for r in table.to_pylist()}
    target = path.removesuffix(".arc.gz") + ".warc.gz"

    def records() -> Iterator[bytes]:
        info = b"software: quotelane\r\nformat: WARC File Format 1.1\r\n"
        yield warc_record(
            [
                ("WARC-Type", "warcinfo"),
                ("WARC-Record-ID", record_id(target.rsplit("/", 1)[1], "", "")),
                ("WARC-Date", iso_time("20240101000000")),
                ("Content-Type", "application/warc-fields"),
            ],
            info,
        )
        for place, values, body in read_arc(b"".join(gzip_members(_slurp(path)))):
            row = plan[place]
            _, head, _ = http_split(body)
            when, url, digest = values["Archive-date"], values["URL"], row["digest"]
            kind = "revisit" if row["revisit"] else "response"
            fields = [
                ("WARC-Type", kind),
                ("WARC-Record-ID", record_id(url, when, f"{digest} {row['page_id']}")),
                ("WARC-Date", iso_time(when)),
                ("WARC-Target-URI", url),
                ("WARC-IP-Address", values["IP-address"]),
                ("Content-Type", "application/http; msgtype=response"),
                ("WARC-Payload-Digest", f"sha256:{digest}"),
            ]
            if row["page_id"] is not None:
                fields.append(("X-Page-Id", str(row["page_id"])))
            if row["revisit"]:
                fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
                first = row["first"]
                fields += [
                    ("WARC-Refers-To", record_id(first["url"], first["moment"], f"{digest} {first['page_id']}")),
                    ("WARC-Refers-To-Target-URI", first["url"]),
                    ("WARC-Refers-To-Date", iso_time(first["moment"])),
                ]
                body = head
            yield warc_record(fields, body)

    put(target, records())
    return pa.table({"path": [target]})


def convert(arcs: DataFrame, least: int = LEAST_PAYLOAD) -> DataFrame:
    """Convert ARC files to WARC files; returns the new paths."""
    files = positive(arcs.count())  # a task per file
    spread = arcs.repartition(files, "path")
    index = written(spread.mapInArrow(_index, "path string, place long, page_id long, payload_bytes long, digest string, url string, moment string"), "arc-index")
    own = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "path", "place", "url", "moment")
    first = (
        index.where(F.col("payload_bytes") >= least)
        .groupBy("digest")
        .agg(F.min(own).alias("kept"))
        .select("digest", "kept")
    )
    revisit = F.col("kept").isNotNull() & ~((F.col("kept.path") == F.col("path")) & (F.col("kept.place") == F.col("place")))
    plan = index.join(first, "digest", "left").select(
        "path", "place", "page_id", "digest", revisit.alias("revisit"), F.when(revisit, F.struct("kept.page_id", "kept.url", "kept.moment")).alias("first")
    )
    return written(plan.repartition(files, "path").groupBy("path").applyInArrow(_convert, "path string"), "warc-files")


def read_warc(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of every record of a file of gzip members."""
    for record in gzip_members(raw):
        head, _, rest = record.partition(b"\r\n\r\n")
        lines = head.decode("utf-8", "surrogateescape").split("\r\n")[1:]
        fields = {k: v for k, _, v in (line.partition(": ") for line in lines)}
        yield fields, rest[: int(fields["Content-Length"])]


OUT = pa.schema(
    [
        ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
        ("refers_to_record", pa.string()), ("warc_record_id", pa.string()), ("warc_date", pa.string()),
    ]
)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    whole = lambda value: None if value is None else int(value)
    for batch in batches:
        for path in batch.column(0).to_pylist():
            rows = []
            for fields, block in read_warc(_slurp(path)):
                kind = fields["WARC-Type"]
                if kind not in ("response", "revisit"):
                    continue
                digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                http, _, payload = http_split(block)
                if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"{path}: {fields['WARC-Record-ID']} is damaged")
                rows.append(
                    (
                        whole(fields.get("X-Page-Id")), int(http["content-length"]), digest, kind,
                        fields.get("WARC-Refers-To"), fields["WARC-Record-ID"], fields["WARC-Date"],
                    )
                )
            columns = list(zip(*rows, strict=True)) or [()] * len(OUT)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, OUT, strict=True)], schema=OUT)


def read_warcs(warcs: DataFrame) -> DataFrame:
    """A row per response or revisit record; the digests of responses are checked.

    ``refers_to`` is the page of the record that a revisit names, in whichever file it is.
    """
    records = warcs.repartition(positive(warcs.count()), "path").mapInArrow(
        _read,
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to_record string, "
        "warc_record_id string, warc_date string",
    )
    records = written(records, "warc-records")
    named = (
        records.where("record_type = 'response'")
        .select(F.col("warc_record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to"))
        .dropDuplicates(["refers_to_record"])
    )
    found = records.join(named, "refers_to_record", "left")
    return found.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "warc_record_id", "warc_date", "refers_to_record"
    )
