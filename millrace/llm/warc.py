"""Operator 5: WARC archives, written with revisit records and read in splits.

Every record is a gzip member of its own. A reading task scans its byte range for the gzip magic, takes a
candidate for a member only if its first bytes decode to a WARC header, and owns the records that start inside its
range; it reads the last of them to its end, wherever that is.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut, shared_dir, shuffle_width, small_batches
from millrace.llm.joins import attach, with_few

_MAGIC = b"\x1f\x8b\x08"
_VERSION = b"WARC/1."
_BLOCK = 256 << 10
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(page_id, url: str | None, payload: bytes, refers_to) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date": "2024-01-01T00:00:00Z",
        "WARC-Target-URI": quote(url or "", safe="".join(map(chr, range(0x21, 0x7F)))),
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
    }
    if refers_to is not None:
        head |= {"WARC-Profile": _REVISIT, "WARC-Refers-To": f"<urn:page:{refers_to}>"}
    head["Content-Length"] = str(len(block))
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n"
    return lines.encode() + block + b"\r\n\r\n"


def _writing(directory: str, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(directory)
        store.create_dir(folder, recursive=True)
        context = TaskContext.get()
        # every attempt writes a file of its own; only a finished attempt's name gets into the manifest
        name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}.warc.gz"
        size = records = 0
        with store.open_output_stream(f"{folder}/{name}", compression=None) as out:
            for batch in batches:
                for page_id, url, html, refers_to in zip(*(batch[c].to_pylist() for c in ("page_id", "url", "html", "refers_to"))):
                    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                    member = packer.compress(_record(page_id, url, (html or "").encode(), refers_to)) + packer.flush()
                    out.write(member)
                    size, records = size + len(member), records + 1
        yield pa.RecordBatch.from_arrays([pa.array([f"{directory}/{name}"]), pa.array([size]), pa.array([records])], ["path", "size", "records"])

    return run


def write_archives(df: DataFrame, directory: str, *, key: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0, level: int = 3) -> DataFrame:
    """Write an archive per partition; return the manifest (path, size, records).

    Of the records with equal payloads of ``least_bytes`` or more, those of the smallest key hold the payload and the others
    revisit them; shorter payloads are always held. A null payload is empty. A row of a null key is held and nothing
    refers to it; rows that repeat the smallest key are held as well. A null url is empty. ``key`` must be a long.
    An empty table writes at most empty archives. Other columns are ignored.
    """
    small_batches(df.sparkSession)
    pages = df.select(F.col(f"`{key}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html"))
    pages = pages.withColumn("digest", F.sha1(F.coalesce("html", F.lit("")).cast("binary")))
    prints = pages.where(F.col("page_id").isNotNull() & (F.octet_length(F.coalesce("html", F.lit(""))) >= least_bytes)).select("page_id", "digest")
    first = prints.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = cut(attach(prints, first, "digest").where("page_id > refers_to").distinct())
    rows = with_few(pages, again, ["page_id", "digest"], "left")
    return cut(rows.select("page_id", "url", "html", "refers_to").mapInArrow(_writing(directory, level), "path string, size long, records long"))


def members(file, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, decoded bytes) of the gzip members that start in [start, end) and begin like WARC records."""
    file.seek(start)
    held, at = b"", start  # what has been read and not passed, and where it begins

    def more() -> bool:
        nonlocal held
        block = file.read(_BLOCK)
        held += block
        return bool(block)

    while True:
        i = held.find(_MAGIC)
        if i < 0:
            keep = held[-2:]
            at, held = at + len(held) - len(keep), keep
            if at >= end or not more():
                return
            continue
        at, held = at + i, held[i:]
        if at >= end:
            return
        unpacker, fed, parts, seen = zlib.decompressobj(31), 0, [], b""
        valid = True
        try:
            while not unpacker.eof:
                if fed == len(held) and not more():
                    valid = False
                    break
                part = unpacker.decompress(held[fed:])
                fed = len(held)
                parts.append(part)
                if len(seen) < len(_VERSION):
                    seen += part[: len(_VERSION)]
                    if not _VERSION.startswith(seen[: len(_VERSION)]):
                        valid = False
                        break
        except zlib.error:
            valid = False
        if valid and seen[: len(_VERSION)] == _VERSION:
            yield at, b"".join(parts)
            used = fed - len(unpacker.unused_data)
        else:
            used = 1
        at, held = at + used, held[used:]


def parse(record: bytes) -> dict:
    """Header fields and payload of a record."""
    head, _, block = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    fields["http"] = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    return fields | {"payload": payload}


def _page(urn: str | None) -> int | None:
    number = (urn or "")[len("<urn:page:") : -1]
    return int(number) if number else None


def _reading(with_payload: bool):
    names = ["path", "offset", "page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to"] + ["payload"] * with_payload
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()] + [pa.binary()] * with_payload

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, end in zip(*(batch[c].to_pylist() for c in ("path", "start", "end"))):
                store, name = fs.FileSystem.from_uri(path)
                rows: list[tuple] = []
                held = 0
                with store.open_input_file(name) as file:
                    for offset, record in members(file, start, end):
                        f = parse(record)
                        own = f["WARC-Payload-Digest"].removeprefix("sha1:")
                        if f["WARC-Type"] == "response" and digest(f["payload"]) != own:
                            raise ValueError(f"{path}: the payload at {offset} does not have its digest")
                        row = (path, offset, _page(f["WARC-Record-ID"]), f["WARC-Target-URI"], f["WARC-Type"], int(f["http"]["Content-Length"]), own, _page(f.get("WARC-Refers-To")))
                        rows.append(row + (f["payload"],) * with_payload)
                        held += len(record) if with_payload else 200
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return run


def read_archives(archives: DataFrame, *, split_bytes: int = 4 << 20, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives (path, size): path, offset, page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload.

    payload is empty for revisits; payload_bytes and payload_digest are those of the full payload. Bytes that are no
    record are passed over. An archive of no bytes has no records.
    """
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(split_bytes).cast("long"))).alias("start")
    splits = archives.where("size > 0").select("path", "size", starts).select("path", "start", F.least(F.col("start") + split_bytes, "size").alias("end"))
    n = archives.select(F.sum(F.ceil(F.col("size") / split_bytes))).first()[0] or 1
    splits = splits.repartition(min(int(n), 8 * shuffle_width(archives.sparkSession)), "path", "start")
    schema = "path string, offset long, page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"
    return splits.mapInArrow(_reading(with_payload), schema + ", payload binary" * with_payload)


def new_directory(spark) -> str:
    """A new folder for archives in the shared folder; where that has no scheme it is a local one."""
    base = shared_dir(spark)
    return f"{base if '://' in base or base.startswith('file:') else 'file://' + base}/warc-{uuid.uuid4()}"
