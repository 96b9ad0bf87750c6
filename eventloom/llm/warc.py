"""WARC archives: a record writer, and a sequential reader that checks what it reads.

Each record is a gzip member of its own. The reader inflates a member piece by piece, frames
the record by its Content-Length and compares the digests; it never seeks.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import whole_text
from eventloom.llm.files import committed, open_store
from eventloom.session import scratch_path, stage_table

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"

ID_PREFIX = "urn:page:"
READ_BYTES = 1 << 18


def _id(page_id: int | None) -> str:
    return f"<{ID_PREFIX}{'null' if page_id is None else page_id}>"


def _page(record_id: str) -> int | None:
    text = record_id.strip("<>").removeprefix(ID_PREFIX)
    return None if text == "null" else int(text)


def _one_line(text: str) -> str:
    return text.replace("\r", "%0D").replace("\n", "%0A")


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str, level: int = 6) -> bytes:
    """One gzip member: a response, or with ``refers_to`` a revisit without the payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    lines = [
        VERSION,
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_id(page_id)}",
        f"WARC-Date: {date}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest()}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        f"Content-Length: {len(block)}",
    ]
    if url:
        lines.append(f"WARC-Target-URI: {_one_line(url)}")
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_id(refers_to)}"]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + END + block + END) + packer.flush()


@dataclass
class Record:
    headers: dict[str, str] = field(default_factory=dict)
    http_head: bytes = b""
    payload_bytes: int = 0
    payload_digest: str = ""
    payload: bytes | None = None


def _headers(raw: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in raw.decode("utf-8").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


class _Framer:
    """One record from the inflated pieces of one member. Keeps the payload only if asked to."""

    def __init__(self, keep_payload: bool):
        self.record, self.keep = Record(), [] if keep_payload else None
        self.waiting, self.left = b"", -1
        self.block, self.payload = hashlib.sha256(), hashlib.sha256()
        self.in_payload, self.after = False, b""

    def feed(self, data: bytes) -> None:
        if self.left < 0:
            self.waiting += data
            head, found, data = self.waiting.partition(END)
            if not found:
                return
            if not head.startswith(b"WARC/"):
                raise ValueError("not a WARC record")
            self.record.headers = _headers(head)
            self.left, self.waiting = int(self.record.headers["content-length"]), b""
        own, rest = data[: self.left], data[self.left :]
        self.left -= len(own)
        self.after += rest
        self.block.update(own)
        if not self.in_payload:
            self.waiting += own
            head, found, own = self.waiting.partition(END)
            if not found:
                return
            self.record.http_head, self.in_payload, self.waiting = head, True, b""
        self.payload.update(own)
        self.record.payload_bytes += len(own)
        if self.keep is not None:
            self.keep.append(own)

    def close(self) -> Record:
        if self.left or self.after != END:
            raise ValueError("record and Content-Length differ")
        headers, record = self.record.headers, self.record
        if headers.get("warc-block-digest", "").removeprefix("sha256:") != self.block.hexdigest():
            raise ValueError(f"block digest differs in {headers.get('warc-record-id')}")
        record.payload_digest = headers["warc-payload-digest"].removeprefix("sha256:")
        if headers["warc-type"] == "revisit":
            record.payload_bytes = int(_headers(record.http_head)["content-length"])
        elif record.payload_digest != self.payload.hexdigest():
            raise ValueError(f"payload digest differs in {headers.get('warc-record-id')}")
        record.payload = b"".join(self.keep) if self.keep is not None else None
        return record


def read_records(stream, keep_payload: bool = False) -> Iterator[Record]:
    """Records of a stream with ``read(n)``, in order; raises ValueError on a damaged one."""
    waiting = b""
    while True:
        waiting = waiting or stream.read(READ_BYTES)
        if not waiting:
            return
        unpacker, framer = zlib.decompressobj(31), _Framer(keep_payload)
        while not unpacker.eof:
            if not waiting:
                waiting = stream.read(READ_BYTES)
                if not waiting:
                    raise ValueError("the last member is cut off")
            framer.feed(unpacker.decompress(waiting, READ_BYTES))
            waiting = unpacker.unconsumed_tail or unpacker.unused_data if not unpacker.eof else unpacker.unused_data
        yield framer.close()


def mark_revisits(pages: DataFrame, min_bytes: int = 100, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, payload, refers_to): null for the first of equal payloads and for short ones.

    The first is the smallest id, of all rows that have it. Equal payloads are counted by
    digest before anything is moved; then the pages are joined to the repeated digests only. A
    page that cannot be repeated has a join key of its own, so these do not meet in one
    task, and a hot digest is one row on the other side, which the adaptive join splits.
    """
    payload = F.encode(whole_text(html_col), "utf-8")
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload")
    ).withColumn(
        "digest",
        F.when(F.octet_length("payload") >= min_bytes, F.sha2("payload", 256)).otherwise(
            F.concat(F.lit("short "), F.xxhash64("page_id", "url").cast("string"))
        ),
    )
    repeated = (
        rows.where(F.octet_length("payload") >= min_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null")
        .drop("n")
    )
    later = F.coalesce(F.col("page_id") != F.col("first"), F.col("first").isNotNull())
    return rows.join(repeated, "digest", "left").select(
        "page_id", "url", "payload", F.when(later, F.col("first")).alias("refers_to")
    )


def write_archives(marked: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """One archive a partition; returns (path, records), one row a file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, n = f"{folder}/part-{TaskContext.get().partitionId():07d}.warc.gz", 0
        with committed(path) as out:
            for batch in batches:
                for page_id, url, payload, refers_to in zip(*(c for c in batch.columns)):
                    out.write(record_bytes(page_id.as_py(), url.as_py(), payload.as_py(), refers_to.as_py(), date))
                    n += 1
        if n:
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [n]})

    return stage_table(marked.mapInArrow(run, "path string, records bigint"), "archives")


def read_archives(archives: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url) of every record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(records: list[Record]) -> pa.RecordBatch:
            heads = [r.headers for r in records]
            refers = [h.get("warc-refers-to") for h in heads]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([_page(h["warc-record-id"]) for h in heads], pa.int64()),
                    pa.array([r.payload_bytes for r in records], pa.int64()),
                    pa.array([r.payload_digest for r in records], pa.string()),
                    pa.array([h["warc-type"] for h in heads], pa.string()),
                    pa.array([None if r is None else _page(r) for r in refers], pa.int64()),
                    pa.array([h.get("warc-target-uri") for h in heads], pa.string()),
                ],
                names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"],
            )

        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, name = open_store(path)
                with store.open_input_stream(name, compression=None) as stream:
                    held: list[Record] = []
                    for record in read_records(stream):
                        held.append(record)
                        if len(held) == 1000:
                            yield batch_of(held)
                            held = []
                    if held:
                        yield batch_of(held)

    schema = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string"
    return archives.select("path").repartition(max(1, archives.count())).mapInArrow(run, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    folder = scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(mark_revisits(pages), folder))
