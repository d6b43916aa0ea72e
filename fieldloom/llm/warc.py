"""WARC archives: a writer with revisit records, and a sequential reader.

Every record is a gzip member of its own.  The reader inflates step by step, frames records by
Content-Length and verifies block and payload digests.  Archives travel as rows of a binary column,
so any store that Spark reaches can hold them; ``spark.read.format("binaryFile")`` reads others.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, skew_safe_join

ARCHIVE_BYTES = 4 << 20
READ_BYTES = 1 << 16
#: A fixed date: archives of equal pages are equal bytes.
DATE = "2024-01-01T00:00:00Z"
RECORD_ID = "<urn:fieldloom:page:{}>"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class WarcError(ValueError):
    """The archive breaks the format or fails a digest."""


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, page_id: str, url: str | None, payload: bytes, refers_to: str | None = None, level: int = 3) -> bytes:
    """One gzip member with one record; a revisit keeps the HTTP header and drops the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {RECORD_ID.format(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {RECORD_ID.format(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: {_sha1(payload)}", f"WARC-Block-Digest: {_sha1(block)}", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def warcinfo(level: int = 3) -> bytes:
    body = b"software: fieldloom\r\nformat: WARC File Format 1.1\r\n"
    head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:fieldloom:warcinfo>\r\nWARC-Date: {DATE}\r\nContent-Type: application/warc-fields\r\nWARC-Block-Digest: {_sha1(body)}\r\nContent-Length: {len(body)}\r\n\r\n"
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + body + b"\r\n\r\n") + packer.flush()


class _Members:
    """Bytes of successive gzip members, inflated on demand."""

    def __init__(self, file: BinaryIO):
        self.file, self.raw, self.plain, self.inflate = file, b"", bytearray(), None

    def open_member(self) -> bool:
        """False at the end of the file."""
        if not self.raw:
            self.raw = self.file.read(READ_BYTES)
        if not self.raw:
            return False
        self.inflate, self.plain = zlib.decompressobj(31), bytearray()
        return True

    def _more(self) -> bool:
        if self.inflate.eof:
            return False
        if not self.raw:
            self.raw = self.file.read(READ_BYTES)
            if not self.raw:
                raise WarcError("the archive ends inside a gzip member")
        try:
            self.plain += self.inflate.decompress(self.raw)
        except zlib.error as e:
            raise WarcError(f"gzip member: {e}") from e
        self.raw = self.inflate.unused_data
        return True

    def until(self, mark: bytes) -> bytes:
        at = 0
        while (found := self.plain.find(mark, max(0, at - len(mark)))) < 0:
            at = len(self.plain)
            if not self._more():
                raise WarcError("a member ends inside a header")
        out = bytes(self.plain[:found])
        del self.plain[: found + len(mark)]
        return out

    def exactly(self, n: int) -> bytes:
        while len(self.plain) < n:
            if not self._more():
                raise WarcError("a member is shorter than its Content-Length")
        out = bytes(self.plain[:n])
        del self.plain[:n]
        return out

    def close_member(self) -> None:
        while self._more():
            pass
        if self.plain:
            raise WarcError("a gzip member holds more than one record")


def _check(head: dict[str, str], name: str, data: bytes) -> None:
    if name in head and head[name] != _sha1(data):
        raise WarcError(f"{name} of {head.get('warc-record-id')} does not fit")


def read_records(file: BinaryIO) -> Iterator[dict]:
    """Records in order: headers (lower-case names), HTTP header, payload; digests verified.

    A revisit's payload is None and its length the one that its HTTP header states.
    """
    members = _Members(file)
    while members.open_member():
        first, *lines = members.until(b"\r\n\r\n").decode("utf-8").split("\r\n")
        if not first.startswith("WARC/1."):
            raise WarcError(f"not a WARC record: {first[:40]!r}")
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        try:
            size = int(head["content-length"])
        except (KeyError, ValueError) as e:
            raise WarcError("no usable Content-Length") from e
        block = members.exactly(size)
        if members.exactly(4) != b"\r\n\r\n":
            raise WarcError("no blank lines after the block")
        members.close_member()
        _check(head, "warc-block-digest", block)
        out = {"type": head.get("warc-type"), "head": head, "http": b"", "payload": block, "payload_bytes": size}
        if head.get("content-type", "").startswith("application/http"):
            out["http"], _, payload = block.partition(b"\r\n\r\n")
            if out["type"] == "revisit":
                stated = re.search(rb"(?im)^content-length:\s*(\d+)", out["http"])
                out |= {"payload": None, "payload_bytes": int(stated[1]) if stated else None}
            else:
                _check(head, "warc-payload-digest", payload)
                out |= {"payload": payload, "payload_bytes": len(payload)}
        yield out


def plan_records(pages: DataFrame, least: int = 1000, id_col: str = "page_id", payload_col: str = "html") -> DataFrame:
    """The columns of the record plan: __id, __url, __payload, __type, __refers.

    Among rows with equal payloads of at least ``least`` bytes, those with the largest id are
    responses and the others revisit it; all smaller payloads are responses.
    """
    url = F.col("url").cast("string") if "url" in pages.columns else F.lit(None).cast("string")
    rows = pages.select(F.col(id_col).cast("long").alias("__id"), url.alias("__url"), F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("__payload"))
    rows = rows.withColumn("__digest", F.when(F.octet_length("__payload") >= least, F.sha1(F.col("__payload").cast("binary"))).otherwise(F.concat(F.lit("small:"), F.md5(F.concat_ws(":", F.col("__id").cast("string"), F.col("__payload"))))))
    groups = rows.select("__id", "__digest").where(~F.startswith("__digest", F.lit("small:"))).groupBy("__digest").agg(F.max("__id").alias("__last"), F.count("*").alias("__n"))
    groups = Scratch(pages.sparkSession, "warc").result(groups.where("__n > 1"), "groups")
    total = pages.count()
    joined = skew_safe_join(rows, groups, ["__digest"], "__n", total, "left")
    revisit = F.col("__n").isNotNull() & ~F.col("__id").eqNullSafe(F.col("__last"))
    return joined.select("__id", "__url", "__payload", F.when(revisit, "revisit").otherwise("response").alias("__type"), F.when(revisit, F.col("__last")).alias("__refers"))


def write_archives(plan: DataFrame, level: int = 3) -> DataFrame:
    """(archive, records, content): archives of about ``ARCHIVE_BYTES`` compressed bytes each."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, first = [], 0, None

        def archive() -> pa.RecordBatch:
            content = warcinfo(level) + b"".join(held)
            name = f"{hashlib.sha1(content).hexdigest()}.warc.gz"
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(held)], pa.int32()), pa.array([content], pa.binary())], ["archive", "records", "content"])

        for batch in batches:
            for page, url, payload, kind, refers in zip(*batch.columns, strict=True):
                raw = record(kind.as_py(), "" if page.as_py() is None else str(page.as_py()), url.as_py(), payload.as_buffer().to_pybytes(), None if refers.as_py() is None else str(refers.as_py()), level)
                held.append(raw)
                size += len(raw)
                if size >= ARCHIVE_BYTES:
                    yield archive()
                    held, size = [], 0
        if held:
            yield archive()

    return plan.select("__id", "__url", "__payload", "__type", "__refers").mapInArrow(pack, "archive string, records int, content binary")


def read_archives(archives: DataFrame, content_col: str = "content", with_payload: bool = True) -> DataFrame:
    """(page_id, url, record_type, payload_bytes, payload_digest, refers_to[, payload]) of all pages' records.

    Records of other writers have no page id; without a stated digest theirs is computed.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                if content.is_valid:
                    yield from _rows(content.as_buffer().to_pybytes(), with_payload)

    schema = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"
    return archives.select(content_col).mapInArrow(read, schema + ", payload binary" * with_payload)


def _hex_digest(stated: str | None, payload: bytes | None) -> str | None:
    """The SHA-1 that a record states, else that of its payload; null for a revisit that states none."""
    kind, _, value = (stated or "").partition(":")
    if kind.lower() == "sha1":
        return base64.b32decode(value.upper()).hex() if len(value) == 32 else value.lower()
    return None if payload is None else hashlib.sha1(payload).hexdigest()


def _rows(content: bytes, with_payload: bool) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"][: 6 + with_payload]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    page = lambda x: int(m[1]) if x and (m := re.fullmatch(r"<urn:fieldloom:page:(-?\d+)>", x)) else None
    rows: list[tuple] = []
    held = 0

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types[: len(names)], strict=True)], names)

    for r in read_records(io.BytesIO(content)):
        if r["type"] not in ("response", "revisit"):
            continue
        head = r["head"]
        digest = _hex_digest(head.get("warc-payload-digest"), r["payload"])
        rows.append((page(head.get("warc-record-id")), head.get("warc-target-uri"), r["type"], r["payload_bytes"], digest, page(head.get("warc-refers-to")), r["payload"])[: len(names)])
        held += (r["payload_bytes"] or 0) if with_payload else 100
        if held > 1 << 22:
            yield flush()
            rows, held = [], 0
    if rows:
        yield flush()


def archive_pages(pages: DataFrame, least: int = 1000, id_col: str = "page_id", payload_col: str = "html") -> DataFrame:
    """Write every page's record into archives in the shared folder and read them back.

    A null payload is empty.  Rows that repeat the largest id of their group are responses too; ids
    are integers, and null ids stay null.  A url column is written if there is one; other columns are
    ignored.  An empty table gives an empty result.
    """
    archives = Scratch(pages.sparkSession, "warc").result(write_archives(plan_records(pages, least, id_col, payload_col)), "archives")
    return read_archives(archives, with_payload=False)
