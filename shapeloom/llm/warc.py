"""Deterministic sharded WARC writer, and its reader.

Records are sorted by range of page_id, and where ranges end depends on the
records alone; each range is written to files of its own, which are rolled
once their compressed size passes ``roll_bytes``. Headers and
digests are made anew from the payload, nothing depends on the clock, and a
record is a gzip member of its own, so a task that runs again writes the same
bytes. A file is written under a temporary name and renamed when it is whole;
the manifest, a table of the files with their sizes and digests, is written
last, and readers take only what it names.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranges import ranges_of
from .storage import run_dir, written

#: A payload shorter than this is always written in full.
REVISIT_BYTES = 1000
DATE = "2000-01-01T00:00:00Z"
#: Compressed bytes that a reading task takes, about.
READ_BYTES = 8 << 20
MANIFEST = "file string, part int, records bigint, bytes bigint, sha256 string"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def _block(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    sha = base64.b32encode(hashlib.sha1(block).digest()).decode()
    lines = [("WARC-Type", kind), *headers, ("WARC-Date", DATE), ("WARC-Block-Digest", f"sha1:{sha}"),
             ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def warc_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None,
                revisit: bool = False) -> bytes:
    """One record: a response with its payload, or a revisit that names the response."""
    digest = hashlib.sha1(payload)
    headers = [("WARC-Record-ID", record_id(page_id, ("revisit:" if revisit else "") + digest.hexdigest())),
               ("WARC-Payload-Digest", "sha1:" + base64.b32encode(digest.digest()).decode()),
               ("Payload-Length", str(len(payload)))]
    if page_id is not None:
        headers.append(("Page-ID", str(page_id)))
    if url is not None:  # as a URI, and as it was
        headers.append(("Page-URL", quote(url, safe="")))
        headers.append(("WARC-Target-URI", quote(url, safe="%:/?#[]@!$&'()*+,;=~-._")))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if not revisit:
        return _block("response", [*headers, ("Content-Type", "application/http;msgtype=response")], http + payload)
    headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                ("WARC-Refers-To", record_id(refers_to, digest.hexdigest())), ("Refers-To-Page-ID", str(refers_to)),
                ("Content-Type", "application/http;msgtype=response")]
    return _block("revisit", headers, http)


class _Roll:
    """The open file of a task."""

    def __init__(self, folder: str, part: int, attempt: int, roll_bytes: int):
        self.store, self.base = fs.FileSystem.from_uri(folder)
        self.part, self.attempt, self.roll_bytes, self.number, self.out = part, attempt, roll_bytes, 0, None
        self.store.create_dir(f"{self.base}/data", recursive=True)
        self.store.create_dir(f"{self.base}/open", recursive=True)

    def add(self, record: bytes) -> dict | None:
        """Write a record; the manifest row of the file if that filled it."""
        if self.out is None:
            self.name = f"{self.part:06d}-{self.number:06d}.warc.gz"
            self.temporary = f"{self.base}/open/{self.name}.{self.attempt}"
            self.out, self.size, self.records, self.sha = self.store.open_output_stream(self.temporary, compression=None), 0, 0, hashlib.sha256()
            info = f"software: shapeloom\r\nformat: WARC File Format 1.1\r\npart: {self.part}\r\n".encode()
            self._put(_block("warcinfo", [("WARC-Record-ID", record_id(None, self.name)), ("WARC-Filename", self.name),
                                          ("Content-Type", "application/warc-fields")], info))
        self._put(record)
        self.records += 1
        return self.close() if self.size >= self.roll_bytes else None

    def _put(self, record: bytes) -> None:
        member = gzip.compress(record, 6, mtime=0)
        self.out.write(member)
        self.sha.update(member)
        self.size += len(member)

    def close(self) -> dict | None:
        if self.out is None:
            return None
        self.out.close()
        self.out = None
        self.number += 1
        self.store.move(self.temporary, f"{self.base}/data/{self.name}")
        return {"file": self.name, "part": self.part, "records": self.records, "bytes": self.size, "sha256": self.sha.hexdigest()}


def write_archives(pages: DataFrame, folder: str, roll_bytes: int = 8 << 20, part_bytes: int = 16 << 20,
                   revisit_bytes: int = REVISIT_BYTES, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html") -> DataFrame:
    """Write ``pages`` as WARC files under ``folder``; returns the manifest, read back.

    Of records with equal payloads of at least ``revisit_bytes`` bytes the one
    with the largest id is a response and the others revisit it; of rows that
    repeat that id too, the first is the response. A null payload is empty; a
    row without id is a response and no other row refers to it. An empty table
    writes an empty manifest and no file. Other columns are not read. A single
    record may exceed ``roll_bytes``; its file ends after it.
    """
    scratch = f"{folder}/work-{uuid.uuid4().hex}"
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    digests = written(rows.select("page_id", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("n")), scratch, "digests")
    ranges = ranges_of(digests.select(F.col("page_id").alias("id"), F.xxhash64("digest").alias("digest"),
                                      F.col("n").cast("long").alias("size")), part_bytes, scratch)
    # equal payloads: the group's largest id, combined before the shuffle
    whole = digests.where((F.col("n") >= revisit_bytes) & F.col("page_id").isNotNull())
    first = whole.groupBy("digest", "n").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("k")).where("k > 1")
    again = whole.join(first, ["digest", "n"]).where("page_id != refers_to").select("page_id", "digest", "refers_to").distinct()
    # a decision stands before its page in the sorted range
    both = rows.select("page_id", F.lit(1).alias("kind"), F.sha1("payload").alias("digest"), "url", "payload",
                       F.lit(None).cast("long").alias("refers_to")).unionByName(
        again.select("page_id", F.lit(0).alias("kind"), "digest", F.lit(None).cast("string").alias("url"),
                     F.lit(None).cast("binary").alias("payload"), "refers_to"))
    placed = both.withColumn("part", ranges.of(F.col("page_id"), F.xxhash64("digest"))["range"])
    ranged = placed.repartitionById(ranges.count, "part").sortWithinPartitions("part", "page_id", "kind", "digest", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt, out = TaskContext.get().taskAttemptId(), None
        schema = pa.schema([("file", pa.string()), ("part", pa.int32()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])
        page, targets, done = object(), {}, set()
        for batch in batches:
            ids, kinds, hexes = (batch.column(k).to_pylist() for k in range(3))
            parts = batch.column(6).to_pylist()
            for k, own in enumerate(ids):
                if out is None or parts[k] != out.part:
                    if out and (last := out.close()):
                        yield pa.RecordBatch.from_pylist([last], schema=schema)
                    out = _Roll(folder, parts[k], attempt, roll_bytes)
                if own != page:
                    page, targets, done = own, {}, set()
                if kinds[k] == 0:
                    targets[hexes[k]] = batch.column(5)[k].as_py()
                    continue
                payload = batch.column(4)[k].as_py()
                target = targets.get(hexes[k])
                if target is None and own is not None and len(payload) >= revisit_bytes:
                    target = own if hexes[k] in done else None
                    done.add(hexes[k])
                full = out.add(warc_record(own, batch.column(3)[k].as_py(), payload, target, target is not None))
                if full:
                    yield pa.RecordBatch.from_pylist([full], schema=schema)
        if out and (last := out.close()):
            yield pa.RecordBatch.from_pylist([last], schema=schema)
    manifest = ranged.mapInArrow(run, MANIFEST)
    return written(manifest, folder, "manifest")


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of a gzip-member WARC file."""
    at, view = 0, memoryview(data)
    while at < len(data):
        member, parts = zlib.decompressobj(31), []
        while not member.eof and at < len(data):  # in steps: what follows the member is copied by zlib
            step = view[at:at + 16_384]
            parts.append(member.decompress(step))
            at += len(step)
        at -= len(member.unused_data)
        record = b"".join(parts)
        head, _, rest = record.partition(b"\r\n\r\n")
        headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        yield headers, rest[:int(headers["Content-Length"])]


RECORDS = "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary"


def read_archives(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """One row per response or revisit of the manifest's files.

    ``payload`` is null for revisits (and without ``payloads``). The digest
    (bare lower-case hex SHA-1) of a response is that of the payload as read;
    a file or block that doesn't match its digest raises.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def number(text: str | None) -> int | None:
        return None if text is None else int(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, sha in zip(batch.column(0), batch.column(1), strict=True):
                with store.open_input_stream(f"{base}/data/{name.as_py()}", compression=None) as f:
                    data, rows, size = f.read(), [], 0
                if hashlib.sha256(data).hexdigest() != sha.as_py():
                    raise ValueError("a file differs from its manifest")
                for head, block in parse_records(data):
                    if base64.b32encode(hashlib.sha1(block).digest()).decode() != head["WARC-Block-Digest"][5:]:
                        raise ValueError("a block differs from its digest")
                    if head["WARC-Type"] == "warcinfo":
                        continue
                    digest, length, payload = base64.b32decode(head["WARC-Payload-Digest"][5:]).hex(), int(head["Payload-Length"]), None
                    if head["WARC-Type"] == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        digest, length = hashlib.sha1(payload).hexdigest(), len(payload)
                    rows.append({"page_id": number(head.get("Page-ID")), "url": unquote(head["Page-URL"]) if "Page-URL" in head else None, "record_type": head["WARC-Type"],
                                 "payload_bytes": length, "payload_digest": digest, "refers_to": number(head.get("Refers-To-Page-ID")),
                                 "payload": payload if payloads else None})
                    size += len(payload or b"") if payloads else 0
                    if size > 16 << 20 or len(rows) >= 10_000:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
    # a task reads about as much as a writer wrote, whatever the manifest's own files are
    total = manifest.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    return manifest.select("file", "sha256").repartition(max(1, total // READ_BYTES), "file").mapInArrow(run, RECORDS)


def archive_pages(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` to a folder of this call's own in the shared place and read the archives back, without payloads."""
    folder = run_dir(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, **options), folder, payloads=False).drop("payload")
