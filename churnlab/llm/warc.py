"""Legacy archive converter: ARC files to WARC files, and a WARC reader."""

from __future__ import annotations

import gzip
import hashlib
import io
import os
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab.llm.common import mounted, picked, shared_folder, written

#: An archive file is closed at this many bytes before compression, or records.
FILE_BYTES, FILE_RECORDS = 32 << 20, 5000
GZIP_LEVEL = 4
#: Payloads of fewer bytes are stored again rather than referred to.
LEAST_REVISIT = 100
ARCHIVE_DATE = "20240101000000"

# Names of the fields of an ARC header line, by version, and of
# the profile of a WARC revisit record.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length".split(),
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length".split(),
}
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def safe_url(url: str | None) -> str:
    """A URL without white space or other characters that a header line cannot hold."""
    return quote(url, safe="%!#$&'()*+,/:;=?@[]~-._") if url else "about:blank"


def arc_version_block(name: str, version: int, date: str) -> bytes:
    fields = " ".join(ARC_FIELDS[version]).encode()
    body = f"{version} 0 churnlab\n".encode() + fields + b"\n"
    return _arc_line(version, f"filedesc://{name}", "0.0.0.0", date, "text/plain", "200", len(body)) + body + b"\n"


def _arc_line(version: int, url: str, ip: str, date: str, mime: str, status: str, length: int) -> bytes:
    more = [] if version == 1 else [status, "-", "-", "0", "-"]
    return " ".join([url, ip, date, mime, *more, str(length)]).encode() + b"\n"


def arc_record(version: int, url: str, ip: str, date: str, mime: str, block: bytes) -> bytes:
    return _arc_line(version, url, ip, date, mime, "200", len(block)) + block + b"\n"


def http_response(page_id: int | None, payload: bytes) -> bytes:
    named = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{named}Content-Length: {len(payload)}\r\n\r\n".encode() + payload


def split_http(block: bytes) -> tuple[bytes, dict[str, str], bytes]:
    """(status line and headers, headers by lower-case name, payload)."""
    head, _, payload = block.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ": " in line)
    return head + b"\r\n\r\n", {k.lower(): v for k, v in headers.items()}, payload


def read_arc(stream) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, block) of each record of an uncompressed ARC stream.

    The first record tells the version; by it the fields of the header lines
    are read. Blocks are as long as their line declares.
    """
    offset = 0
    fields = ARC_FIELDS[1]
    while line := stream.readline():
        if line == b"\n":
            offset += 1
            continue
        values = line.decode("utf-8", "replace").rstrip("\n").split(" ")
        if offset == 0:
            # Of the version record itself the length stands last in any version.
            header = dict(zip(ARC_FIELDS[1], values[:4])) | {"Archive-length": values[-1]}
        elif len(values) == len(fields):
            header = dict(zip(fields, values))
        else:
            raise ValueError(f"ARC record at {offset}: {len(values)} header fields, not {len(fields)}")
        length = int(header["Archive-length"])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError(f"ARC record at {offset}: {len(block)} bytes of {length}")
        if offset == 0:
            version = int(block.split(b" ", 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"ARC version {version}")
            fields = ARC_FIELDS[version]
        yield offset, header, block
        offset += len(line) + length


def record_id(file: str, offset: int) -> str:
    """An identifier that any task gives the same record."""
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{os.path.basename(file)}#{offset}')}"


def warc_date(archive_date: str) -> str:
    d = archive_date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(kind: str, headers: dict[str, str], block: bytes) -> bytes:
    lines = [f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers.items()), f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def converted(file: str, offset: int, header: dict[str, str], block: bytes, refers_to: dict | None) -> bytes:
    """The WARC record of an ARC record; with ``refers_to`` a revisit of that record."""
    own = {"WARC-Record-ID": f"<{record_id(file, offset)}>", "WARC-Date": warc_date(header["Archive-date"])}
    if header["URL"].startswith("filedesc:"):
        info = b"software: churnlab\r\nformat: WARC file version 1.1\r\n"
        return warc_record("warcinfo", own | {"WARC-Filename": os.path.basename(file), "Content-Type": "application/warc-fields"}, info)
    own |= {"WARC-Target-URI": header["URL"], "WARC-IP-Address": header["IP-address"]}
    head, _, payload = split_http(block)
    own |= {"WARC-Payload-Digest": f"sha256:{hashlib.sha256(payload).hexdigest()}", "Content-Type": "application/http; msgtype=response"}
    if refers_to is None:
        return warc_record("response", own | {"WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}"}, block)
    own |= {
        "WARC-Profile": SAME_PAYLOAD,
        "WARC-Refers-To": f"<{record_id(refers_to['file'], refers_to['offset'])}>",
        "WARC-Refers-To-Target-URI": refers_to["url"],
    }
    return warc_record("revisit", own, head)


def read_warc(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields by lower-case name, block) of each record of an uncompressed WARC stream."""
    while line := stream.readline():
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        header = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8", "replace").rstrip("\r\n").partition(": ")
            header[name.lower()] = value
        length = int(header["content-length"])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError(f"WARC record: {len(block)} bytes of {length}")
        yield header, block


class _Writer:
    """A gzip file of a member for each record; it gets its name when it is whole,
    so that a task that runs twice leaves the same file."""

    def __init__(self, path: str):
        self.path, self.part = path, f"{path}.{uuid.uuid4().hex}.part"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        self.out, self.size, self.records = open(self.part, "wb"), 0, 0

    def add(self, record: bytes) -> int:
        self.out.write(gzip.compress(record, GZIP_LEVEL, mtime=0))
        start, self.size = self.size, self.size + len(record)
        self.records += 1
        return start

    def close(self) -> None:
        self.out.close()
        os.replace(self.part, self.path)


def write_arcs(pages: DataFrame, folder: str, version: int = 1, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = ARCHIVE_DATE) -> DataFrame:
    """Write an ARC record for each page; returns an index, one row per record:
    file, offset (before compression), page_id, url, n_bytes, digest (SHA-256 of
    the payload). Null pages are empty payloads, null URLs about:blank."""
    rows = picked(pages, page_id=id_col, url=url_col, html=html_col).select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    target = mounted(folder)
    schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("n_bytes", pa.int64()), ("digest", pa.string())])

    def run(batches):
        task, number, writer = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            found = []
            for i in range(batch.num_rows):
                page_id, url, html = (batch.column(j)[i].as_py() for j in range(3))
                if writer is None:
                    name = f"part-{task:06d}-{number:05d}.arc.gz"
                    writer, number = _Writer(f"{target}/{name}"), number + 1
                    writer.add(arc_version_block(name, version, date))
                payload, url = (html or "").encode("utf-8", "replace"), safe_url(url)
                offset = writer.add(arc_record(version, url, "0.0.0.0", date, "text/html", http_response(page_id, payload)))
                found.append((writer.path, offset, page_id, url, len(payload), hashlib.sha256(payload).hexdigest()))
                if writer.size >= FILE_BYTES or writer.records >= FILE_RECORDS:
                    writer.close()
                    writer = None
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)] if found else [pa.array([], f.type) for f in schema], schema=schema)
        if writer:
            writer.close()

    return written(rows.mapInArrow(run, "file string, offset long, page_id long, url string, n_bytes long, digest string"), "arc-index")


def revisit_plan(index: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """The index with ``refers_to`` (file, offset, url): of records with equal
    payloads of at least ``least`` bytes, that with the smallest page_id (null
    last; then the first by place) is a response, to which the others refer."""
    place = F.struct(F.col("page_id").isNull().alias("unnamed"), "page_id", "file", "offset", "url")
    large = index.filter(F.col("n_bytes") >= least)
    first = large.groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "first")
    joined = index.join(first, "digest", "left")
    itself = (F.col("first.file") == F.col("file")) & (F.col("first.offset") == F.col("offset"))
    refers = F.when(F.col("first").isNotNull() & (F.col("n_bytes") >= least) & ~itself, F.struct("first.file", "first.offset", "first.url"))
    return joined.select("file", "offset", refers.alias("refers_to"))


def convert(plan: DataFrame, folder: str) -> DataFrame:
    """Convert each ARC file of the plan to a WARC file in ``folder``; returns
    (file, records). A file is read record by record as declared; its plan (at
    most FILE_RECORDS rows) tells which records are revisits."""
    target = mounted(folder)
    files = plan.groupBy("file").agg(F.collect_list(F.when(F.col("refers_to").isNotNull(), F.struct("offset", "refers_to"))).alias("revisits"))

    def run(batches):
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                refers = {r["offset"]: r["refers_to"] for r in row["revisits"]}
                writer = _Writer(f"{target}/{os.path.basename(row['file']).replace('.arc.gz', '.warc.gz')}")
                with gzip.open(row["file"], "rb") as stream:
                    for offset, header, block in read_arc(stream):
                        writer.add(converted(row["file"], offset, header, block, refers.get(offset)))
                writer.close()
                done.append((writer.path, writer.records))
            names, counts = zip(*done) if done else ((), ())
            yield pa.RecordBatch.from_pydict({"file": pa.array(names, pa.string()), "records": pa.array(counts, pa.int64())})

    # A shuffle of its own, by number: the plan is small however much there is to
    # convert, and partitions of so few bytes would be put together into one task.
    parts = int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(files.repartition(parts, F.xxhash64("file")).mapInArrow(run, "file string, records long"), "warc-files")


def read_warcs(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """Response and revisit records of the WARC files in a folder: record_id,
    record_type, target_uri, date, page_id, payload_bytes, payload_digest (of the
    full payload also for revisits), refers_to (a record id), and the payload.

    Raises where a stored payload is not what its digest says."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("content")
    fields = [("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("date", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string())]
    fields += [("payload", pa.binary())] * with_payload
    schema = pa.schema(fields)

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for header, block in read_warc(gzip.GzipFile(fileobj=io.BytesIO(content.as_py()))):
                    kind = header["warc-type"]
                    if kind not in ("response", "revisit"):
                        continue
                    _, http, payload = split_http(block)
                    digest = header["warc-payload-digest"].removeprefix("sha256:")
                    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"{header['warc-record-id']}: payload and digest differ")
                    n_bytes = len(payload) if kind == "response" else int(http["content-length"])
                    page_id = int(http["x-page-id"]) if "x-page-id" in http else None
                    row = [header["warc-record-id"].strip("<>"), kind, header["warc-target-uri"], header["warc-date"], page_id, n_bytes, digest]
                    row.append(header["warc-refers-to"].strip("<>") if kind == "revisit" else None)
                    rows.append(row + [payload if kind == "response" else None] * with_payload)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else [pa.array([], f.type) for f in schema], schema=schema)

    kinds = "record_id string, record_type string, target_uri string, date string, page_id long, payload_bytes long, payload_digest string, refers_to string"
    return files.mapInArrow(run, kinds + (", payload binary" if with_payload else ""))


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", version: int = 1, folder: str | None = None) -> DataFrame:
    """Write pages as a legacy ARC archive, convert it to WARC, and read that
    back: one row per page with page_id, payload_bytes, payload_digest,
    record_type and refers_to (the page_id of the response that a revisit refers
    to).

    Every input row is a record; null html is an empty payload; a null id stays
    null and is the last choice for a response; of rows with one id and payload,
    one is the response; no pages give no rows. ``folder`` (of the shared file
    system) gets the files.
    """
    spark = pages.sparkSession
    home = folder or shared_folder(spark, "archive")
    index = write_arcs(pages, f"{home}/arc", version, id_col, url_col, html_col)
    files = convert(revisit_plan(index), f"{home}/warc")
    kinds = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    if files.isEmpty():
        return spark.createDataFrame([], kinds)
    records = written(read_warcs(spark, f"{home}/warc").select("record_id", "record_type", "page_id", "payload_bytes", "payload_digest", "refers_to"), "warc-records")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    responses = records.filter("record_type = 'response'")
    named = responses.select(F.col("record_id").alias("response_id"), F.col("page_id").alias("response_page"))
    revisits = records.filter("record_type = 'revisit'").join(named, F.col("refers_to") == F.col("response_id"))
    return responses.select(*columns, F.lit(None).cast("long").alias("refers_to")).union(revisits.select(*columns, F.col("response_page").alias("refers_to")))
