"""WARC archives that are written with an index first, and read by it.

Writing. The payload of a page is its HTML. A narrow table of payload digests
says which payloads repeat; of records with equal payloads of ``revisit_from``
bytes or more, those with the largest id are ``response`` records, the others
``revisit`` records without the payload. Each task writes ``.warc.gz`` files of
its own under ``root``, one gzip member a record, and returns for every record
an index row: file, offset, length, URL and payload digest.

Reading. Any selection of index rows is ordered by (file, offset) over tasks of
about equal numbers of records; a task joins neighbouring ranges (up to ``gap``
bytes apart, ``span`` bytes at a time) into one read each, unpacks the members
that were asked for and checks payloads against their digests.

The files lie where executors and later jobs see them (the shared checkpoint
folder, or a ``root`` of your own) and are reached through pyarrow's file
systems. A task that is run again writes new files; the index names only those
of the attempt that counted, so files that it does not name are leftovers.

A null payload is empty; a null URL is written without a target; null ids are
smaller than any id, and where all ids of equal payloads are null all records
are responses. Rows that repeat the largest id with the same payload are all
responses. A record is packed and unpacked in memory whole, however long. An empty
table gives no files and an empty index. Other columns of the table are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime
from functools import partial
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ship_by_value, slices, written
from strata.session import checkpoint_dir

ship_by_value(__name__)

REVISIT_FROM = 1000
FILE_BYTES = 1 << 30  # a file is closed once it has this size
GAP, SPAN = 1 << 16, 8 << 20
TASK_BYTES = 128 << 20  # archive bytes for one reading task, where there is enough of them
# Fixed by the WARC 1.1 format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "id string, path string, offset long, length long, url string, record_type string, payload_digest string"
RECORD = "id string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string"


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """pyarrow's file system for a Hadoop-style URI, and the path in it."""
    return fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", uri))


def shared_root(df: DataFrame) -> str:
    """A new folder under the shared checkpoint folder, as a URI with its scheme."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _plain(value: str) -> str:
    """A header value without blanks and control characters."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), value)


def warc_record(kind: str, headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [f"WARC-Type: {kind}", *[f"{k}: {v}" for k, v in headers if v is not None], f"Content-Length: {len(block)}"]
    return b"WARC/1.1\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(_fields(head))
    return headers, rest[: int(headers["content-length"])]


def _fields(head: bytes) -> Iterator[tuple[str, str]]:
    for line in head.decode().split("\r\n")[1:]:
        name, _, value = line.partition(":")
        yield name.lower(), value.strip()


def packed(record: bytes) -> bytes:
    """One gzip member."""
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    return press.compress(record) + press.flush()


def page_record(row: dict, date: str, name: str) -> bytes:
    payload, size = row["payload"] or b"", row["size"]
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    own = [
        ("WARC-Record-ID", f"<urn:uuid:{name}>"), ("WARC-Date", date),
        ("WARC-Target-URI", None if row["url"] is None else _plain(row["url"])),
        ("X-Source-ID", None if row["id"] is None else quote(row["id"])),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(row["digest"])).decode()),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if row["refers_to"] is None:
        return warc_record("response", own, block + payload)
    other = row["refers_to_url"]
    first = [("WARC-Profile", PROFILE), ("WARC-Refers-To-Target-URI", None if other is None else _plain(other)),
             ("WARC-Refers-To-Date", date), ("X-Refers-To-ID", quote(row["refers_to"]))]
    return warc_record("revisit", own + first, block)


class _Archive:
    """The files that one task writes."""

    def __init__(self, root: str, date: str, file_bytes: int):
        self.store, self.folder = open_store(root)
        self.root, self.date, self.file_bytes = root, date, file_bytes
        self.out, self.at, self.attempt, self.files = None, 0, uuid.uuid4().hex, 0

    def add(self, record: bytes) -> tuple[str, int, int]:
        if self.out is None:
            context = TaskContext.get()
            self.name = f"part-{context.partitionId() if context else 0:05d}-{self.attempt}-{self.files:04d}.warc.gz"
            self.files += 1
            self.store.create_dir(self.folder, recursive=True)
            self.out, self.at = self.store.open_output_stream(f"{self.folder}/{self.name}", compression=None), 0
            info = [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, self.name)}>"),
                    ("WARC-Date", self.date), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")]
            self._put(packed(warc_record("warcinfo", info, b"format: WARC File Format 1.1\r\n")))
        at, data = self.at, packed(record)
        self._put(data)
        if self.at >= self.file_bytes:
            self.close()
        return f"{self.root}/{self.name}", at, len(data)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def _write(batches: Iterator[pa.RecordBatch], root: str, date: str, file_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows (id, url, payload, size, digest, refers_to, refers_to_url) to files; gives their index rows."""
    archive = _Archive(root, date, file_bytes)
    names = [f.split()[0] for f in INDEX.split(", ")]
    for batch in slices(batches, "payload"):
        rows = batch.to_pylist()
        places = [archive.add(page_record(r, date, str(uuid.uuid4()))) for r in rows]
        columns = [
            [r["id"] for r in rows], *zip(*places), [r["url"] for r in rows],
            ["response" if r["refers_to"] is None else "revisit" for r in rows], [r["digest"] for r in rows],
        ]
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)
    archive.close()


def write_archives(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", root: str | None = None,
    revisit_from: int = REVISIT_FROM, file_bytes: int = FILE_BYTES, date: str | None = None,
) -> DataFrame:
    """Write a record for each row of ``pages``; the index, itself a written table.

    The payloads are shuffled only where the repeated ones (one narrow row for
    each) are too many for Spark to broadcast.
    """
    root = root or shared_root(pages)
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    payload = F.coalesce(F.col(f"`{payload_col}`"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"), payload.alias("payload"),
    ).withColumns({"size": F.octet_length("payload").cast("long"), "digest": F.sha1("payload")})
    # Beside the SHA-1, for which unlike payloads can be made on purpose.
    rows = rows.withColumn("more", F.xxhash64("payload"))
    key = ["size", "digest", "more"]
    repeats = (
        rows.filter(F.col("size") >= revisit_from).groupBy(*key)
        .agg(F.max(F.struct("id", "url")).alias("best"), F.count("*").alias("n"))
        .filter("n > 1 and best.id is not null").select(*key, "best")
    )
    joined = rows.join(written(repeats, "repeated-payloads"), key, "left")
    again = F.col("best").isNotNull() & (F.col("id").isNull() | (F.col("id") < F.col("best.id")))
    ready = joined.select(
        F.col("id").cast("string").alias("id"), "url",
        F.when(~again, F.col("payload")).alias("payload"), "size", "digest",
        F.when(again, F.col("best.id").cast("string")).alias("refers_to"),
        F.when(again, F.col("best.url")).alias("refers_to_url"),
    )
    index = ready.mapInArrow(partial(_write, root=root, date=date, file_bytes=file_bytes), INDEX)
    return written(index.withColumn("id", F.col("id").cast(rows.schema["id"].dataType)), "warc-index")


def joined_ranges(places: Iterator[tuple[str, int, int]], gap: int, span: int) -> Iterator[tuple[str, int, list]]:
    """(path, start, [(offset, length)]) for places in order: neighbours on one
    file, up to ``gap`` bytes apart and ``span`` bytes in all, are one range."""
    path, start, held = None, 0, []
    for p, offset, length in places:
        end = max((o + n for o, n in held), default=0)
        if held and (p != path or offset - end > gap or offset + length - start > span):
            yield path, start, held
            held = []
        if not held:
            path, start = p, offset
        held.append((offset, length))
    if held:
        yield path, start, held


def _record_row(raw: bytes, where: str, payload: bool) -> tuple:
    headers, block = parse_record(raw)
    head, _, body = block.partition(b"\r\n\r\n")
    kind, digest = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha1:")
    digest = base64.b32decode(digest).hex()
    if kind == "response" and hashlib.sha1(body).hexdigest() != digest:
        raise ValueError(f"payload does not have its digest: {where}")
    size = len(body) if kind == "response" else int(dict(_fields(head))["content-length"])
    ids = [unquote(headers[h]) if h in headers else None for h in ("x-source-id", "x-refers-to-id")]
    row = (ids[0], headers.get("warc-target-uri"), kind, size, digest, ids[1])
    return (*row, body if kind == "response" else None) if payload else row


def _read(batches: Iterator[pa.RecordBatch], gap: int, span: int, payload: bool) -> Iterator[pa.RecordBatch]:
    places = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), *[pa.binary()] * payload]
    names = [f.split()[0] for f in RECORD.split(", ")] + ["payload"] * payload
    opened, file = None, None
    for path, start, held in joined_ranges(places, gap, span):
        if path != opened:
            store, inner = open_store(path)
            opened, file = path, store.open_input_file(inner)
        data = memoryview(file.read_at(max(o + n for o, n in held) - start, start))
        rows = []
        for offset, length in held:
            raw = zlib.decompress(data[offset - start : offset - start + length], 31)
            rows.append(_record_row(raw, f"{path} at {offset}", payload))
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)


def read_records(
    selected: DataFrame, payload: bool = True, gap: int = GAP, span: int = SPAN, task_bytes: int = TASK_BYTES
) -> DataFrame:
    """Records that the index rows in ``selected`` name, each as often as it is named.

    Columns: id (of the index's type), url (as written: blanks and control
    characters escaped), record_type, payload_bytes and payload_digest (of the
    full payload, revisits too), refers_to, and with ``payload`` the payload
    (null for a revisit; see ``with_payloads``).
    """
    total = selected.agg(F.sum("length")).first()[0] or 0
    cores = selected.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, total // task_bytes, min(2 * cores, total >> 20))
    places = selected.select("path", "offset", "length").repartitionByRange(tasks, "path", "offset")
    places = places.sortWithinPartitions("path", "offset")
    schema = RECORD + (", payload binary" if payload else "")
    found = places.mapInArrow(partial(_read, gap=gap, span=span, payload=payload), schema)
    kind = selected.schema["id"].dataType

    def typed(name: str) -> Column:
        return F.col(name).cast(kind).alias(name)

    return found.select(*[typed(c) if c in ("id", "refers_to") else F.col(c) for c in found.columns])


def with_payloads(records: DataFrame) -> DataFrame:
    """``records`` (read with payloads) where revisits have the payload of the response
    they refer to, if that is among them. A response that very many revisits name is
    one row of the join, whose other side Spark splits where it is skewed."""
    first = records.filter("record_type = 'response'").select(
        F.col("id").alias("refers_to"), "payload_digest", F.col("payload").alias("_payload")
    ).dropDuplicates(["refers_to", "payload_digest"])
    revisits = records.filter("record_type = 'revisit'").drop("payload").join(first, ["refers_to", "payload_digest"], "left")
    return records.filter("record_type = 'response'").unionByName(revisits.withColumnRenamed("_payload", "payload"))
