"""WARC archives with a two-level capture index.

Pages are written as gzip members, one per record, into files below the shared folder. Of records
with equal payloads one is the response and the others revisit it. The index has a line per
capture: the reversed-host URL key with the page id, then file, offset and length. Lines are sorted
over all partitions and cut into compressed blocks; the sparse directory has only each block's
first key. A look-up binary-searches the partitions' first keys, then the directory of its
partition, opens the one or two blocks that can hold the key, and reads just the record's range.

Files are written and read through pyarrow's file systems, so the folder may be local, HDFS or an
object store. A file's name holds the task's attempt and only what a task returned is indexed, so a
task that is run again leaves at most an unused file.

Defined cases: a null html is an empty payload; a null URL is an empty one; rows without ``page_id``
are not archived; rows repeated under one id and URL are as many captures of it, and all come back;
an empty table gives an empty archive; other columns are not looked at.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import shared_path, stored

SAME_FROM = 1000
LINES_PER_BLOCK = 1024
BYTES_PER_FILE = 1 << 30
DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URL = re.compile(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?(?:[^/?#@]*@)?([^/?#:]*)(?::(\d+))?([^#]*)")


def url_key(url: str) -> str:
    """Host labels reversed, then port and path: ``http://www.a.org/x?y`` is ``org,a,www)/x?y``."""
    host, port, rest = URL.match(url).groups()
    labels = ",".join(reversed(host.lower().split(".")))
    return f"{labels}{':' + port if port else ''}){rest or '/'}".replace(" ", "%20").replace("\n", "%0A")


def capture_key(url: str | None, page_id: int) -> str:
    return f"{url_key(url or '')} {page_id:+020d}"


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder as Spark names it."""
    return fs.FileSystem.from_uri(re.sub(r"^(?:file:)?/+", "file:///", path))


def record(page_id: int, url: str, payload: bytes, refers_to: int | None) -> bytes:
    """One gzip member with the whole record; a revisit has the HTTP header but no payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    target = re.sub(r"\s", lambda m: f"%{ord(m[0]):02X}", url)
    head = [f"WARC/1.1\r\nWARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}",
            f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
            f"Content-Length: {len(block)}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT}"]
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def parsed(member: bytes) -> dict:
    """Fields of one record; its digest is checked against the payload if it has one."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind, refers = fields["WARC-Type"], fields.get("WARC-Refers-To")
    if kind == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"{fields['WARC-Record-ID']} does not hold its payload")
    return {"page_id": int(fields["WARC-Record-ID"][10:-1]), "url": fields["WARC-Target-URI"],
            "payload_bytes": length, "payload_digest": digest, "record_type": kind,
            "refers_to": int(refers[10:-1]) if refers else None, "payload": payload if kind == "response" else None}


def revisits(pages: DataFrame, least: int = SAME_FROM) -> DataFrame:
    """``page_id, refers_to`` of the pages whose payload of ``least`` bytes or more a page of larger id has too."""
    html = F.coalesce("html", F.lit(""))
    known = stored(pages.where(F.col("page_id").isNotNull() & (F.octet_length(html) >= least)).select(
        F.col("page_id").cast("long").alias("page_id"), F.sha1(html.cast("binary")).alias("digest")), "payload-digests")
    many = known.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("low")).where(
        "low < refers_to").select("digest", "refers_to")
    # One row per digest on one side; a digest of very many pages is split on the other.
    return stored(known.join(many, "digest").where("page_id < refers_to").select("page_id", "refers_to").distinct(), "revisits")


@dataclass
class Archive:
    """Capture lines in sorted compressed blocks: ``part, block, first_key, n, lines``."""

    blocks: DataFrame


def write(pages: DataFrame) -> Archive:
    """Archive all pages and index their captures."""
    spark = pages.sparkSession
    folder = shared_path(spark, "warc")
    where, path = filesystem(folder)
    where.create_dir(path, recursive=True)
    again = revisits(pages).withColumnRenamed("page_id", "__page")
    rows = pages.where(F.col("page_id").isNotNull()).select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("html", F.lit("")).alias("html")).join(
            again, F.col("page_id") == F.col("__page"), "left").select("page_id", "url", "html", "refers_to")

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = filesystem(folder)
        task, out, name, at = TaskContext.get(), None, "", 0
        try:
            for batch in batches:
                lines = []
                for page_id, url, html, refers in zip(*batch.columns, strict=True):
                    if out is None or at >= BYTES_PER_FILE:
                        if out is not None:
                            out.close()
                        name = f"pages-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}.warc.gz"
                        out, at = files.open_output_stream(f"{root}/{name}", compression=None), 0
                    member = record(page_id.as_py(), url.as_py(), html.as_py().encode(), refers.as_py())
                    out.write(member)
                    lines.append((capture_key(url.as_py(), page_id.as_py()), name, at, len(member)))
                    at += len(member)
                if lines:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c) for c in zip(*lines, strict=True)], ["key", "file", "at", "length"])
        finally:
            if out is not None:
                out.close()

    captures = stored(rows.mapInArrow(save, "key string, file string, at long, length long"), "captures")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held = TaskContext.get().partitionId(), 0, []

        def block(lines: list[tuple]) -> pa.RecordBatch:
            text = "\n".join(f"{key}\t{folder}/{file}\t{at}\t{n}" for key, file, at, n in lines)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "block": pa.array([number], pa.int64()),
                "first_key": [lines[0][0]], "n": pa.array([len(lines)], pa.int64()),
                "lines": pa.array([zlib.compress(text.encode())], pa.binary())})

        for batch in batches:
            held += zip(*(c.to_pylist() for c in batch.columns), strict=True)
            while len(held) >= LINES_PER_BLOCK:
                yield block(held[:LINES_PER_BLOCK])
                number, held = number + 1, held[LINES_PER_BLOCK:]
        if held:
            yield block(held)

    order = ("key", "file", "at")
    return Archive(stored(captures.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        pack, "part int, block long, first_key string, n long, lines binary"), "capture-index"))


def captured(lines: list[str], key: str) -> list[tuple[str, int, int]]:
    """File, offset and length of the captures under ``key`` in a block's lines."""
    found = []
    for line in lines[bisect.bisect_left(lines, f"{key}\t"):]:
        own, file, at, n = line.split("\t")
        if own != key:
            break
        found.append((file, int(at), int(n)))
    return found


def look_up(archive: Archive, wanted: DataFrame) -> DataFrame:
    """``file, at, length`` of the captures of ``wanted`` (``page_id, url``)."""
    # Level one: the first key of each partition of the index, as many as the sort had ranges.
    firsts = sorted((row["first_key"], row["part"]) for row in archive.blocks.where("block = 0").select(
        "first_key", "part").collect())
    keys, parts = [f[0] for f in firsts], [f[1] for f in firsts]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for page_id, url in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                key = capture_key(url, page_id)
                # Captures of one key may begin in the partition before the first that starts with it.
                for i in range(max(0, bisect.bisect_left(keys, key) - 1), bisect.bisect_right(keys, key)):
                    rows.append((parts[i], key))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                                  pa.array([r[1] for r in rows], pa.string())], ["part", "key"])

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        blocks = right.sort_by("block")
        first, rows, opened = blocks.column("first_key").to_pylist(), [], {}
        for key in sorted(left.column("key").to_pylist()):
            for i in range(max(0, bisect.bisect_left(first, key) - 1), bisect.bisect_right(first, key)):
                if i not in opened:
                    opened = {i: zlib.decompress(blocks.column("lines")[i].as_py()).decode().split("\n")}
                rows += captured(opened[i], key)
        file, at, length = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.table({"file": pa.array(file, pa.string()), "at": pa.array(at, pa.int64()),
                         "length": pa.array(length, pa.int64())})

    asked = wanted.where(F.col("page_id").isNotNull()).select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url")).distinct()
    return stored(asked.mapInArrow(route, "part int, key string").groupBy("part").cogroup(
        archive.blocks.groupBy("part")).applyInArrow(find, "file string, at long, length long"), "places")


def read(places: DataFrame) -> DataFrame:
    """The records at ``places``, each by one range read: page_id, url, payload fields, ``payload``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, opened, files = None, None, None
        for batch in batches:
            for first in range(0, batch.num_rows, 64):
                rows = []
                for file, at, length in zip(*(c.to_pylist() for c in batch.slice(first, 64).columns), strict=True):
                    if file != name:
                        if opened is not None:
                            opened.close()
                        files, path = filesystem(file)
                        name, opened = file, files.open_input_file(path)
                    rows.append(parsed(opened.read_at(length, at)))
                yield pa.RecordBatch.from_pylist(rows, kinds)
        if opened is not None:
            opened.close()

    kinds = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                       ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                       ("payload", pa.binary())])
    return places.repartitionByRange("file", "at").sortWithinPartitions("file", "at").mapInArrow(
        run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
             "refers_to long, payload binary")
