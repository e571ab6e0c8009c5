"""Web archives packed in ZIP files: records are written, located through central directories, and range-read."""

from __future__ import annotations

import gzip
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdspark.llm.common import small_slices, written
from crowdspark.session import shared_folder

#: Payloads of fewer bytes are always written in full.
REVISIT_BYTES = 1000
#: An archive file is closed beyond so many compressed bytes.
ARCHIVE_BYTES = 64 << 20
#: Copies of a repeated payload's key, so that one payload of a third of all records is spread.
SALTS = 16
RECORD_ID = "<urn:page:{}>"
DATE = "1970-01-01T00:00:00Z"
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.jsonl"

# Fixed values of the ZIP format: signatures of its structures and the mark of a value kept in ZIP64 fields.
END, END64, END64_AT, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF

RECORDS = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "payload binary, archive string, offset long, length long")


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, also the ``file:/...`` form, and the path in it."""
    if path.startswith("file:/") and not path.startswith("file:///"):
        path = "file:///" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


# ---- writing ----

def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str,
                refers_to: int | None) -> bytes:
    """One gzip member with a response record, or with a revisit record if ``refers_to`` is given.

    Both carry the HTTP headers of the full payload; a revisit leaves the payload out.
    """
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    headers = [("WARC-Type", "revisit" if refers_to is not None else "response"),
               ("WARC-Record-ID", RECORD_ID.format("" if page_id is None else page_id)), ("WARC-Date", DATE)]
    if url is not None:
        headers.append(("WARC-Target-URI", target))
    headers += [("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if refers_to is not None:
        headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                    ("WARC-Refers-To", RECORD_ID.format(refers_to))]
    return gzip.compress(_record(headers, http if refers_to is not None else http + (payload or b"")), 5, mtime=0)


class _ArchiveFile:
    """A ZIP file with one stored archive member and one stored index member, written as a stream."""

    def __init__(self, path: str):
        fs, place = file_system(path)
        self.path, self.sink = path, fs.open_output_stream(place)
        self.zip = zipfile.ZipFile(self.sink, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True)
        self.lines, self.offset = [], 0

    def add(self, record: bytes) -> None:
        self.member.write(record)
        self.lines.append(json.dumps({"offset": self.offset, "length": len(record), "filename": ARCHIVE}))
        self.offset += len(record)

    def close(self) -> tuple[str, int]:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "".join(f"{x}\n" for x in self.lines))
        self.zip.close()
        self.sink.close()
        return self.path, len(self.lines)


def plan_records(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``page_id, url, payload, payload_bytes, payload_digest, refers_to`` of every page.

    Of equal payloads of at least ``revisit_bytes`` the one with the largest page_id is written in full, and
    the others refer to it. Equality is that of SHA-1, SHA-256 and length. Digests are counted before any
    payload moves; only digests that repeat are joined to the pages, under several salts.
    """
    rows = (
        pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
        .withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha1("payload"),
                      "_key": F.sha2("payload", 256)})
    )
    repeated = (
        rows.where(F.col("payload_bytes") >= revisit_bytes).groupBy("_key", "payload_bytes")
        .agg(F.count("*").alias("n"), F.max("page_id").alias("first")).where("n > 1 and first is not null")
        .select("_key", "payload_bytes", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    )
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    return salted.join(repeated, ["_key", "payload_bytes", "_salt"], "left").select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write planned records to ZIP archives in ``folder``; returns ``path, records`` of each archive.

    Each task writes files of its own under names that no other attempt uses; the returned table names only
    the files of the attempts that counted, and is itself written, so that nothing is written twice.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, done = None, []
        for batch in small_slices(batches, "payload"):
            for r in zip(*(batch.column(c).to_pylist() for c in (
                    "page_id", "url", "payload", "payload_bytes", "payload_digest", "refers_to"))):
                if out is None:
                    out = _ArchiveFile(f"{folder}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.wacz")
                out.add(page_record(*r))
                if out.offset >= archive_bytes:
                    done.append(out.close())
                    out = None
        if out is not None:
            done.append(out.close())
        if done:
            paths, counts = zip(*done)
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(counts, pa.int64())], names=["path", "records"])

    file_system(folder)[0].create_dir(file_system(folder)[1], recursive=True)
    return written(records.mapInArrow(run, "path string, records long"), "archives")


# ---- reading ----

def _at(source, offset: int, length: int) -> bytes:
    source.seek(offset)
    data = source.read(length)
    if len(data) != length:
        raise ValueError(f"archive ends early: {length} bytes wanted at {offset}")
    return data


def members(source, size: int) -> dict[str, tuple[int, int]]:
    """``name: (offset, length)`` of the stored members of a ZIP file, from its central directory.

    Reads the end record, the ZIP64 end record where the plain one is full, the directory, and the local
    headers; never a member. Compressed or encrypted members raise ValueError: they cannot be range-read.
    """
    tail = _at(source, max(0, size - 65557), min(size, 65557))
    at = tail.rfind(END)
    if at < 0:
        raise ValueError("no ZIP end record")
    count, length, start = struct.unpack("<HII", tail[at + 10: at + 20])
    base = size - len(tail) + at
    if FULL16 == count or FULL32 in (length, start):
        locator = _at(source, base - 20, 20)
        if locator[:4] != END64_AT:
            raise ValueError("no ZIP64 locator")
        record = _at(source, struct.unpack("<Q", locator[8:16])[0], 56)
        if record[:4] != END64:
            raise ValueError("no ZIP64 end record")
        count, length, start = struct.unpack("<QQQ", record[32:56])
    directory, found, at = _at(source, start, length), {}, 0
    for _ in range(count):
        if directory[at: at + 4] != ENTRY:
            raise ValueError("broken central directory")
        flags, method = struct.unpack("<HH", directory[at + 8: at + 12])
        packed, plain, name_size, extra_size, comment = struct.unpack("<IIHHH", directory[at + 20: at + 34])
        offset = struct.unpack("<I", directory[at + 42: at + 46])[0]
        name = directory[at + 46: at + 46 + name_size].decode("utf-8" if flags & 0x800 else "cp437")
        extra = directory[at + 46 + name_size: at + 46 + name_size + extra_size]
        while len(extra) >= 4:
            kind, size_ = struct.unpack("<HH", extra[:4])
            if kind == 1:  # 64-bit values, in this order, of those fields that are full
                wide = list(struct.unpack(f"<{size_ // 8}Q", extra[4: 4 + size_ // 8 * 8]))
                plain = wide.pop(0) if plain == FULL32 else plain
                packed = wide.pop(0) if packed == FULL32 else packed
                offset = wide.pop(0) if offset == FULL32 else offset
            extra = extra[4 + size_:]
        if flags & 1 or method != 0:
            raise ValueError(f"{name} is compressed or encrypted, not stored")
        head = _at(source, offset, 30)
        if head[:4] != LOCAL:
            raise ValueError(f"no local header of {name}")
        found[name] = (offset + 30 + sum(struct.unpack("<HH", head[26:30])), packed)
        at += 46 + name_size + extra_size + comment
    return found


def _number(record_id: str | None) -> int | None:
    digits = (record_id or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def parse_record(member: bytes) -> dict:
    """Headers of the record and of its HTTP block, and the payload."""
    head, _, block = gzip.decompress(member).partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    warc = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}
    http, _, payload = block[: int(warc["content-length"])].partition(b"\r\n\r\n")
    fields = {k.lower(): v for k, v in (x.split(": ", 1) for x in http.decode().split("\r\n")[1:])}
    return {"warc": warc, "http": fields, "payload": payload}


def read_archives(spark: SparkSession, archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records of ZIP archives, given their ``path``: one row per record of the index members.

    Columns: ``page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload, archive, offset,
    length``; size and digest are those of the full payload, for a revisit as its headers name them.
    ``payload`` is null for revisits, and for all if ``with_payload`` is false. The index is read first and
    spread over tasks in blocks of neighbouring records; a block is one range of the archive. A response
    whose payload does not match its headers raises.
    """
    block = 256

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, place = file_system(path)
                with fs.open_input_file(place) as source:
                    found = members(source, source.size())
                    for name, (start, length) in found.items():
                        if not name.startswith("indexes/"):
                            continue
                        lines = [json.loads(x) for x in _at(source, start, length).splitlines()]
                        for i in range(0, len(lines), block):
                            part = lines[i: i + block]
                            yield pa.RecordBatch.from_arrays([
                                pa.array([path]), pa.array([[found[x["filename"]][0] + x["offset"] for x in part]]),
                                pa.array([[x["length"] for x in part]])], names=["path", "offsets", "lengths"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha1
        for batch in batches:
            for path, offsets, lengths in zip(*(batch.column(c).to_pylist() for c in ("path", "offsets", "lengths"))):
                fs, place = file_system(path)
                out = []
                with fs.open_input_file(place) as source:
                    for offset, length in zip(offsets, lengths):
                        r = parse_record(_at(source, offset, length))
                        kind, size = r["warc"]["warc-type"], int(r["http"]["content-length"])
                        digest = r["warc"]["warc-payload-digest"].removeprefix("sha1:")
                        if kind == "response" and (len(r["payload"]) != size or sha1(r["payload"]).hexdigest() != digest):
                            raise ValueError(f"{path}: the record at {offset} does not match its digest")
                        out.append((_number(r["warc"]["warc-record-id"]), r["warc"].get("warc-target-uri"), size, digest,
                                    kind, _number(r["warc"].get("warc-refers-to")),
                                    r["payload"] if with_payload and kind == "response" else None, path, offset, length))
                types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string(),
                         pa.int64(), pa.int64()]
                names = [c.split()[0] for c in RECORDS.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    ranges = written(archives.select("path").mapInArrow(locate, "path string, offsets array<long>, lengths array<long>"),
                     "ranges")
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return ranges.repartition(tasks).mapInArrow(read, RECORDS)


def archive_round_trip(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Write a record for every page to ZIP archives in the shared folder and read the archives back.

    Of pages with equal payloads the largest page_id is the response; repeated rows of that page_id are
    responses too. A null page_id is kept, and a revisit where another page has its payload. Null html is an
    empty payload. Columns other than page_id, url and html are not read. The result does not hold payloads.
    """
    spark = pages.sparkSession
    archives = write_archives(plan_records(pages, revisit_bytes), shared_folder(spark, "warc"))
    return read_archives(spark, archives, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")
