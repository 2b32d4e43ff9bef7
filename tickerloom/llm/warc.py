"""WARC archives: a writer that stores equal payloads once, and a splittable reader.

The archives are gzip files with a member per record.  Every reading task owns a byte range of a
file: it looks for the gzip magic inside, decodes the start of each candidate to see whether a WARC
header comes out, and reads the records that begin in its range, past its end where the last one
goes on.  Bytes that only look like a member inside another record are dropped afterwards: a record
that begins before the end of the one before it is no record.  Archives of any writer are read: what a
record lacks, or states wrongly, is null, and bytes that are no record are skipped and counted.

Files are opened through ``pyarrow.fs`` (local and mounted folders, HDFS, S3, GCS).  A writing task
opens a new file on every attempt; only the files named in the stored manifest are read, so what a
lost attempt left behind does no harm.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickerloom.llm.shared import stored
from tickerloom.session import work_folder

SHARED_BYTES = 1000                       # equal payloads of at least this size are stored once
RANGE_BYTES = 8 << 20
TASK_BYTES = 128 << 20                    # a reading task gets about as much, fewer where cores would idle
FILE_BYTES = 1 << 30                      # a new archive is begun beyond this
MAGIC = b"\x1f\x8b\x08"
CHUNK = 1 << 18
HEAD_BYTES = 512                          # decoded bytes that tell a record

MANIFEST = "path string, bytes long, records long"
RECORDS = ("path string, start long, stop long, record_id string, page_id long, record_type string, payload_bytes long, "
           "payload_digest string, refers_id string, refers_to long, payload binary")


def file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    if "://" not in uri:
        return pyarrow.fs.LocalFileSystem(), uri
    return pyarrow.fs.FileSystem.from_uri(uri)


def _name(page_id: int | None) -> str:
    return f"urn:page:{'none' if page_id is None else page_id}"


def _page(name: str | None) -> int | None:
    """The page of a record id that this module wrote, else None."""
    found = re.fullmatch(r"urn:page:(-?[0-9]{1,19})", name or "")
    return int(found[1]) if found and -1 << 63 <= int(found[1]) < 1 << 63 else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One gzip member: the record's WARC header, its HTTP header and, unless a revisit, the payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if revisit else http + payload
    target = (url or "").replace("\r", "").replace("\n", "")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{_name(page_id)}>",
             f"WARC-Target-URI: {target}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{_name(refers_to)}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    head = ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8", "replace")
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + body + b"\r\n\r\n") + packer.flush()


def _with_references(pages: DataFrame) -> DataFrame:
    """``pages(page_id, url, html)`` with ``refers_to``, equal rows in one partition.

    The digests are grouped before anything is joined, so a payload that a third of the rows share
    is one row then; the join back is on light rows and the pages are shuffled once, by page_id.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    light = rows.where(F.octet_length("html") >= SHARED_BYTES).select("page_id", F.sha1(F.encode("html", "utf-8")).alias("digest"))
    last = light.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1 and refers_to is not null")
    known = light.where("page_id is not null").join(last.select("digest", "refers_to"), "digest") \
        .groupBy("page_id", "digest").agg(F.first("refers_to").alias("refers_to"))
    # one shuffle of the pages; the join keeps it, so equal rows stay in one partition
    rows = rows.withColumn("digest", F.when(F.octet_length("html") >= SHARED_BYTES, F.sha1(F.encode("html", "utf-8")))).repartition("page_id", "digest")
    return rows.join(known, ["page_id", "digest"], "left").select("page_id", "digest", "url", "html", "refers_to")


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Archives of all ``pages`` in ``folder``; returns the manifest ``(path, bytes, records)``.

    Of records with equal payloads of at least ``SHARED_BYTES`` that with the largest page_id is a
    response and the others are revisits of it; smaller ones are all responses.  Null html counts as
    empty; a row without page_id is always a response; of repeated rows with the largest page_id the
    first is the response.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        fs.create_dir(base, recursive=True)
        done, out, seen = [], None, None
        path, size, records = "", 0, 0
        for batch in batches:
            for page_id, digest, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                # rows are sorted: a second row equal to the response follows it at once
                again = (page_id, digest) == seen
                revisit = refers_to is not None and (page_id != refers_to or again)
                seen = (page_id, digest)
                if out is None:
                    path = f"{base}/{uuid.uuid4().hex}.warc.gz"
                    out, size, records = fs.open_output_stream(path, compression=None), 0, 0
                member = record(page_id, url, html.encode("utf-8", "replace"), refers_to, revisit)
                out.write(member)
                size, records = size + len(member), records + 1
                if size >= FILE_BYTES:
                    out.close()
                    done.append((path, size, records))
                    out = None
        if out is not None:
            out.close()
            done.append((path, size, records))
        prefix = folder[: -len(base)] if folder.endswith(base) else ""
        paths, sizes, counts = zip(*done, strict=True) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array([prefix + p for p in paths], pa.string()), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
            names=["path", "bytes", "records"])

    rows = _with_references(pages).sortWithinPartitions("page_id", "digest", "url")
    return stored(rows.mapInArrow(run, MANIFEST), "manifest")


class _Bytes:
    """A file read forward from a place, kept from the oldest byte still needed."""

    def __init__(self, file, at: int, size: int):
        self.file, self.base, self.size, self.data = file, at, size, bytearray()
        file.seek(at)

    def need(self, end: int) -> bool:
        """Have bytes up to ``end``; false if the file is shorter."""
        while self.base + len(self.data) < min(end, self.size):
            more = self.file.read(CHUNK)
            if not more:
                break
            self.data += more
        return self.base + len(self.data) >= end

    def drop(self, before: int) -> None:
        if before - self.base > 4 * CHUNK:
            del self.data[: before - self.base]
            self.base = before


def _member(data: _Bytes, at: int) -> tuple[bytes, int] | None:
    """Content and end of the gzip member at ``at`` if it is a WARC record, else None."""
    unpack, parts, length, head = zlib.decompressobj(31), [], 0, b""
    place = at
    while not unpack.eof:
        if not data.need(place + 1):
            return None
        piece = bytes(data.data[place - data.base: place - data.base + CHUNK])
        try:
            got = unpack.decompress(piece)
        except zlib.error:
            return None
        place += len(piece)
        parts.append(got)
        length += len(got)
        if len(head) < HEAD_BYTES:
            head += got[:HEAD_BYTES]
            if not head.startswith(b"WARC/1."[: len(head)]):
                return None
    if not head.startswith(b"WARC/1."):
        return None
    return b"".join(parts), place - len(unpack.unused_data)


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def _number(text: str | None) -> int | None:
    return int(text) if text and text.isascii() and text.isdigit() and len(text) < 19 else None


def _stated_digest(text: str | None) -> str | None:
    """A stated SHA-1 in base 32 or hexadecimal as bare hexadecimal."""
    value = (text or "").rpartition(":")[2]
    if re.fullmatch("[0-9A-Fa-f]{40}", value):
        return value.lower()
    return base64.b32decode(value.upper()).hex() if re.fullmatch("[A-Za-z2-7]{32}", value) else None


def parse(content: bytes) -> tuple | None:
    """Fields of a record, or None if it is none: no header end, no usable length, cut short.

    The payload is what follows the HTTP header of an HTTP record, the whole block of any other.  Its
    size and digest are measured; those of a revisit are the ones its header and HTTP header state.
    Ids, types, sizes and digests that are missing or malformed are None."""
    head, gap, body = content.partition(b"\r\n\r\n")
    fields = _fields(head)
    length = _number(fields.get("content-length"))
    if not gap or length is None or len(body) < length:
        return None
    block, kind = body[:length], fields.get("warc-type")
    http, cut, rest = block.partition(b"\r\n\r\n")
    payload = rest if cut and http.startswith((b"HTTP/", b"GET ", b"POST ", b"HEAD ")) else block
    if kind == "revisit":
        size, digest, payload = _number(_fields(http).get("content-length")), _stated_digest(fields.get("warc-payload-digest")), None
    else:
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    return fields.get("warc-record-id", "").strip("<>") or None, kind, size, digest, fields.get("warc-refers-to", "").strip("<>") or None, payload


def read_range(path: str, start: int, stop: int, size: int) -> Iterator[tuple]:
    """Records of a file that begin in ``[start, stop)``."""
    fs, place = file_system(path)
    with fs.open_input_file(place) as file:
        data = _Bytes(file, start, size)
        at = start
        while at < stop:
            data.need(min(at + CHUNK, stop + len(MAGIC) - 1))
            hit = data.data.find(MAGIC, at - data.base)
            if hit < 0:
                at = max(at + 1, data.base + len(data.data) - len(MAGIC) + 1)
                data.drop(at)
                continue
            at = data.base + hit
            if at >= stop:
                return
            found = _member(data, at)
            fields = parse(found[0]) if found else None
            if fields is None:
                at += 1
                continue
            yield (at, found[1], *fields)
            at = found[1]
            data.drop(at)


def read_archives(manifest: DataFrame, range_bytes: int = RANGE_BYTES, with_payload: bool = True) -> DataFrame:
    """All records of the archives in ``manifest(path, bytes)``, each read by the task that owns its
    first byte; ``page_id`` and ``refers_to`` are the numbers in the record ids that ``write_archives``
    gives, null for others."""
    total = manifest.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.sum(F.ceil(F.col("bytes") / range_bytes)), F.lit(0))).first()
    cores = manifest.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, -(-int(total[0]) // TASK_BYTES), min(int(total[1]), 2 * cores))
    ranges = manifest.where("bytes > 0").select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long"))).alias("start"))
    names = [c.split()[0] for c in RECORDS.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for part in batches:
            for path, size, start in zip(*(c.to_pylist() for c in part.columns), strict=True):
                for at, end, name, kind, length, digest, refers, payload in read_range(path, start, min(start + range_bytes, size), size):
                    rows.append((path, at, end, name, _page(name), kind, length, digest, refers, _page(refers),
                                 payload if with_payload else None))
                    held += len(payload or b"") if with_payload else 64
                    if held > 4 << 20:
                        yield batch(rows)
                        rows, held = [], 0
        yield batch(rows)

    # dealt by number: rows of ranges are so small that they would all be put together
    found = ranges.repartition(tasks, "path", "start").mapInArrow(run, RECORDS)
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    light = found.withColumn("_before", F.max("stop").over(before))
    return light.where("_before is null or _before <= start").drop("_before")


def coverage(manifest: DataFrame, records: DataFrame) -> DataFrame:
    """``(path, bytes, records, skipped_bytes)`` of every archive: what no record of ``records`` covers."""
    held = records.groupBy("path").agg(F.count(F.lit(1)).alias("records"), F.sum(F.col("stop") - F.col("start")).alias("_held"))
    zero = F.lit(0).cast("long")
    return manifest.select("path", "bytes").join(held, "path", "left").select(
        "path", "bytes", F.coalesce("records", zero).alias("records"), (F.col("bytes") - F.coalesce("_held", zero)).alias("skipped_bytes"))


def archive_round_trip(spark: SparkSession, pages: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Writes the archives of ``pages``, reads them back, and gives a row per record."""
    manifest = write_archives(pages, work_folder(spark, "warc"))
    records = read_archives(manifest, range_bytes, with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
