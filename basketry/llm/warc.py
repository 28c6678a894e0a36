"""WARC archives: one gzip member per record, written by tasks, read back by byte ranges.

Pages with equal long payloads are written once, as a response; the others are revisit records that refer to it. A
reading task owns the records that start inside its byte range: it looks for the gzip magic, takes a place for the
start of a record only if the member found there decodes to a WARC header, and from then on goes from member to member.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import partitions, pieces, record_batch, shared_path, stored

MAGIC = b"\x1f\x8b\x08"
#: Equal payloads from this size on are written once.
REVISIT_BYTES = 1000
#: Bytes of an archive that a task owns, and that it reads at a time.
RANGE_BYTES, BLOCK_BYTES = 8 << 20, 1 << 20
#: Bytes that are decoded at a time to see whether a member begins with a record's header, however long that is.
HEADER_BYTES = 1 << 16


def _header_text(value: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(urn: str | None) -> int | None:
    name = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(name) if name.lstrip("-").isdigit() else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, is_revisit: bool) -> bytes:
    """One WARC record. A revisit keeps the HTTP header, whose length field tells the size of the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header_text(url)}")
    if is_revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {_urn(refers_to)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(
    pages: DataFrame, folder: str, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html",
    level: int = 4,
) -> DataFrame:
    """Writes ``pages`` as archives below ``folder``, one per task; a table of ``path``, ``size`` and ``records``.

    Of pages with equal payloads of at least ``REVISIT_BYTES`` the one with the largest id is a response (as are its
    own repeated rows), the others revisit it; a group whose ids are all null has responses only. A null payload is
    empty. A task that is repeated writes a file of another name; only the files of tasks that ended well are listed.
    """
    payload = F.coalesce(F.col(f"`{payload_column}`").cast("string"), F.lit("")).cast("binary")
    own = pages.select(
        F.col(f"`{id_column}`").cast("long").alias("page_id"), F.col(f"`{url_column}`").cast("string").alias("url"),
        payload.alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    targets = (
        own.where(F.octet_length("payload") >= REVISIT_BYTES).groupBy("digest")
        .agg(F.max("page_id").alias("target"), F.count("*").alias("n")).where("n > 1 AND target IS NOT NULL").drop("n")
    )
    marked = own.join(targets, "digest", "left").withColumn(
        "is_revisit", F.col("target").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("target")))

    def write(batches):
        from pyspark import TaskContext

        context = TaskContext.get()
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}.warc.gz"
        out, size, n = None, 0, 0
        for piece in pieces(batches, "payload"):
            for row in piece.to_pylist():
                out = out or system.open_output_stream(f"{base}/{name}", compression=None)
                whole = record(row["page_id"], row["url"], row["payload"], row["digest"], row["target"], row["is_revisit"])
                packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                member = packer.compress(whole) + packer.flush()
                out.write(member)
                size, n = size + len(member), n + 1
        if out:
            out.close()
            yield record_batch({"path": [f"{folder}/{name}"], "size": pa.array([size]), "records": pa.array([n])})

    files = marked.select("page_id", "url", "payload", "digest", "target", "is_revisit")
    return stored(files.mapInArrow(write, "path string, size long, records long"), "archives")


def _member(file, start: int, header_only: bool = False) -> tuple[bytes, int] | None:
    """The record whose member begins at ``start`` and where the member ends; None if none begins there.

    With ``header_only`` decoding ends with the header, and neither the record nor its end is whole.
    """
    file.seek(start)
    unpack, out, at = zlib.decompressobj(31), bytearray(), start
    block = b""
    while not unpack.eof:
        if not block:
            block = file.read(HEADER_BYTES if at == start else BLOCK_BYTES)
            if not block:
                return None
            at += len(block)
        seen = max(len(out) - 3, 0)
        try:
            out += unpack.decompress(block, HEADER_BYTES if header_only else 0)
        except zlib.error:
            return None
        block = unpack.unconsumed_tail
        if len(out) >= 7 and not out.startswith(b"WARC/1."):
            return None
        if header_only and out.find(b"\r\n\r\n", seen) >= 0:
            break
    if b"\r\n\r\n" not in out or not out.startswith(b"WARC/1."):
        return None
    return bytes(out), at - len(unpack.unused_data)


def records_in(file, start: int, end: int) -> Iterator[bytes]:
    """The records whose members begin from ``start`` up to, not including, ``end``."""
    at, tail, first = start, b"", None
    while first is None and at < end:  # look for the first member
        file.seek(at)
        block = tail + file.read(BLOCK_BYTES)
        if len(block) == len(tail):
            return
        base, found = at - len(tail), block.find(MAGIC)
        while found >= 0 and base + found < end:
            if _member(file, base + found, header_only=True):
                first = base + found
                break
            found = block.find(MAGIC, found + 1)
        at, tail = base + len(block), block[-2:]
    while first is not None and first < end:
        whole = _member(file, first)
        if whole is None:
            file.seek(first)
            if not file.read(1):
                return
            raise ValueError(f"no readable record at byte {first}")
        yield whole[0]
        first = whole[1]


def parsed(raw: bytes) -> dict:
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.decode().lower()] = value.strip().decode()
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields["warc-type"]
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response":
        size, measured = len(payload), hashlib.sha1(payload).hexdigest()
        if measured != digest:
            raise ValueError(f"{fields['warc-record-id']}: the payload doesn't match its digest")
    else:
        lengths = [x.partition(b":")[2] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        size, payload = int(lengths[0]), None
    return {
        "page_id": _page(fields["warc-record-id"]), "url": fields.get("warc-target-uri"), "payload_bytes": size,
        "payload_digest": digest, "record_type": kind, "refers_to": _page(fields.get("warc-refers-to")), "payload": payload,
    }


def read_archives(files: DataFrame, with_payload: bool = True, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per record of the archives in ``files`` (path, size): ``page_id, url, payload_bytes, payload_digest,
    record_type, refers_to`` and, if asked for, ``payload`` (null for revisits).

    Each task reads a byte range. A payload that doesn't match its digest, or a record cut short, is an error.
    """
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(range_bytes).cast("long")))
    ranges = files.where("size > 0").select("path", "size", starts.alias("start"))
    ranges = ranges.repartition(partitions(files.sparkSession), "path", "start")
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", *["payload"] * with_payload]
    kinds = dict(page_id=pa.int64(), payload_bytes=pa.int64(), refers_to=pa.int64(), payload=pa.binary())

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                system, path = fs.FileSystem.from_uri(row["path"])
                with system.open_input_file(path) as file:
                    held, size = [], 0
                    for raw in records_in(file, row["start"], min(row["start"] + range_bytes, row["size"])):
                        held.append(parsed(raw))
                        size += len(raw)
                        if size >= BLOCK_BYTES:
                            yield record_batch({n: pa.array([x[n] for x in held], kinds.get(n, pa.string())) for n in names})
                            held, size = [], 0
                    if held:
                        yield record_batch({n: pa.array([x[n] for x in held], kinds.get(n, pa.string())) for n in names})

    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return ranges.mapInArrow(read, schema + ", payload binary" * with_payload)


def complete(rows: DataFrame, files: DataFrame) -> DataFrame:
    """``rows`` read from the archives in ``files`` (with ``records``), stored; an error if their numbers differ."""
    rows = stored(rows, "records")
    read, listed = rows.count(), files.agg(F.coalesce(F.sum("records"), F.lit(0)).alias("n")).first()["n"]
    if read != listed:
        raise ValueError(f"{read} records read, {listed} written")
    return rows


def round_trip(pages: DataFrame, folder: str | None = None, **columns: str) -> DataFrame:
    """Writes archives and reads them back, without the payloads; one row per page.

    Null payloads and urls, null ids, repeated pages and empty tables are fine; further columns are not written. As many
    records must be read as were written.
    """
    files = write_archives(pages, folder or shared_path(pages.sparkSession, "warc"), **columns)
    return complete(read_archives(files, with_payload=False), files)
