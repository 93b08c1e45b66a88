"""Deterministic sharded WARC writer and its reader.

``write_warc`` sorts the records by page id over range partitions, and every
partition writes its stretch to gzip files (one member a record) that roll over
at a compressed size. Headers, lengths and digests are made anew from the payload,
dates are a parameter and gzip times are zero, so equal input gives equal
bytes. A file is written under a temporary name of its task attempt and renamed
when complete; a lost or repeated task renames the same bytes to the same
name. The partitions' file lists form a manifest table next to the files, whose
``_SUCCESS`` mark commits the whole; readers go by the manifest only.

Of records with equal payloads of at least ``min_revisit`` bytes, the one with the
smallest page id is a response, the others are revisits that refer to it. Only
(digest, page id) are aggregated and joined for that; payloads are shuffled once.

Files go to the folder named by the caller through ``pyarrow.fs``, which the
executors must share.

Edge cases: null html is an empty payload; a null url leaves its header out, line
breaks in one are percent-encoded; a null page id stays null and is always a
response; rows that repeat a page id are written each, and those that repeat the
smallest id of a payload are all responses; an empty table gives no records;
payloads of any length are written whole. Only the named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swipeflow.llm.common import settle, ship_package

ROLL_BYTES = 64 << 20
READ_BYTES = 1 << 20
#: Rows of one (id, payload) from which they may be split over tasks, and the share of all rows they must be.
HOT_ROWS, HOT_SHARE = 256, 2000
EPOCH = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """(file system, path) of a folder given as a path or as any URI that Arrow knows."""
    uri = re.sub(r"^file:/+", "/", uri)
    return (pafs.LocalFileSystem(), uri) if uri.startswith("/") else pafs.FileSystem.from_uri(uri)


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def _head(first: str, fields: list[tuple[str, str | None]]) -> bytes:
    return (first + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + "\r\n").encode("utf-8", "surrogatepass")


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record_bytes(page_id: int | None, url: str | None, payload: bytes | None, digest: str, length: int, refers_to: int | None, date: str) -> bytes:
    """One record; ``payload`` is None for a revisit, whose digest and length are those of the full payload."""
    url = None if url is None else re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", url)
    http = _head("HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(length))])
    block = http if payload is None else http + payload
    fields = [
        ("WARC-Type", "response" if payload is not None else "revisit"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", url),
        ("WARC-Refers-To", record_id(refers_to) if payload is None else None),
        ("WARC-Profile", PROFILE if payload is None else None),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
        ("WARC-Full-Payload-Length", str(length)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    return _head("WARC/1.1", fields) + block + b"\r\n\r\n"


def info_bytes(name: str, date: str) -> bytes:
    body = _head("software: swipeflow", [("format", "WARC File Format 1.1")])[:-2]
    fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:file:{name}>"), ("WARC-Date", date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(body)))]
    return _head("WARC/1.1", fields) + body + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class Roller:
    """Writes records to numbered files of about ``roll`` compressed bytes; ``files`` lists the finished ones."""

    def __init__(self, folder: str, partition: int, attempt: int, roll: int, date: str) -> None:
        self.fs, self.folder = file_system(folder)
        self.partition, self.attempt, self.roll, self.date = partition, attempt, roll, date
        self.files: list[dict] = []
        self.out = None

    def open(self) -> None:
        self.name = f"part-{self.partition:06d}-{len(self.files):05d}.warc.gz"
        self.temporary = f"{self.folder}/_temporary/{self.name}.{self.attempt}"
        self.out = self.fs.open_output_stream(self.temporary, compression=None)
        self.size, self.records, self.hash = 0, 0, hashlib.sha256()
        self.put(gzip_member(info_bytes(self.name, self.date)))

    def put(self, member: bytes) -> None:
        self.out.write(member)
        self.hash.update(member)
        self.size += len(member)

    def add(self, record: bytes) -> None:
        member = gzip_member(record)
        if self.out is not None and self.size + len(member) > self.roll and self.records:
            self.close()
        if self.out is None:
            self.open()
        self.put(member)
        self.records += 1

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        self.fs.move(self.temporary, f"{self.folder}/{self.name}")
        self.files.append({"file": self.name, "records": self.records, "bytes": self.size, "sha256": self.hash.hexdigest()})
        self.out = None


def plan_records(pages: DataFrame, id_col: str, url_col: str, html_col: str, min_revisit: int) -> DataFrame:
    """One row per page (_mark 1) and, before it in the order of (_id, _digest, _mark), one
    row without payload (_mark 0) for each (id, payload) that is a revisit of _refers.

    Ids and digests alone are joined by digest; payloads move once, to their place in the order. Rows that repeat one
    (id, payload) more often than ``HOT_ROWS`` and than one row in ``HOT_SHARE`` (so there are fewer than ``HOT_SHARE``
    such pairs, which are broadcast) tell _refers themselves and get a _place, by which they may be split; all others have none.
    """
    payload = F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "utf-8")
    rows = pages.select(F.col(id_col).cast("long").alias("_id"), F.col(url_col).cast("string").alias("_url"), payload.alias("_payload"))
    rows = rows.withColumn("_digest", F.sha1("_payload")).withColumn("_length", F.octet_length("_payload").cast("long"))
    long_enough = rows.filter(F.col("_length") >= min_revisit).select("_id", "_digest")
    firsts = settle(long_enough.groupBy("_digest").agg(F.min("_id").alias("_refers"), F.count("*").alias("_n")).filter("_n > 1").select("_digest", "_refers"))
    revisits = long_enough.join(firsts, "_digest").filter("_id <> _refers").select("_id", "_digest", "_refers").distinct()
    counts = rows.groupBy("_id", "_digest").agg(F.count("*").alias("_n"))
    repeated = settle(counts.filter(F.col("_n") > HOT_ROWS))
    if repeated.isEmpty():
        return rows.withColumns({"_mark": F.lit(1), "_hot_url": F.lit(None).cast("string"), "_place": F.lit(None).cast("long")}).unionByName(revisits.withColumn("_mark", F.lit(0)), allowMissingColumns=True)
    hot = repeated.filter(F.col("_n") > F.lit(pages.count() / HOT_SHARE)).select("_id", "_digest").join(firsts, "_digest", "left")
    hot = settle(hot.select(F.col("_id").alias("_hot_id"), F.col("_digest").alias("_hot_digest"), F.when(F.col("_id") != F.col("_refers"), F.col("_refers")).alias("_hot_refers"), F.lit(True).alias("_is_hot")))
    same = F.col("_id").eqNullSafe(F.col("_hot_id")) & (F.col("_digest") == F.col("_hot_digest"))
    rows = rows.withColumn("_row", F.monotonically_increasing_id()).join(F.broadcast(hot), same, "left")
    rows = rows.select("_id", "_url", "_payload", "_digest", "_length", F.lit(1).alias("_mark"), F.col("_hot_refers").alias("_refers"), F.when(F.col("_is_hot"), F.col("_url")).alias("_hot_url"), F.when(F.col("_is_hot"), F.col("_row")).alias("_place"))
    marks = revisits.join(F.broadcast(hot), same, "left_anti").withColumn("_mark", F.lit(0))
    return rows.unionByName(marks, allowMissingColumns=True)


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit: int = 0, roll: int = ROLL_BYTES, date: str = EPOCH) -> DataFrame:
    """Write every row as a record below ``folder``; returns the committed manifest (file, records, bytes, sha256)."""
    store, path = file_system(folder)
    store.create_dir(f"{path}/_temporary", recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        roller = Roller(folder, task.partitionId(), task.taskAttemptId(), roll, date)
        revisit = None  # (id, digest, response's id) of the last row with mark 0
        for batch in batches:
            for i in range(batch.num_rows):
                page, url, payload, digest, length, refers, mark = (batch.column(k)[i].as_py() for k in range(7))
                if mark == 0:
                    revisit = (page, digest, refers)
                    continue
                if refers is None:
                    refers = revisit[2] if revisit and revisit[:2] == (page, digest) else None
                roller.add(record_bytes(page, url, payload if refers is None else None, base64.b32encode(bytes.fromhex(digest)).decode("ascii"), length, refers, date))
        roller.close()
        if roller.files:
            yield pa.RecordBatch.from_pylist(roller.files, pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())]))

    ordered = plan_records(pages, id_col, url_col, html_col, min_revisit).repartitionByRange("_id", "_digest", "_hot_url", "_place").sortWithinPartitions("_id", "_digest", "_mark", "_url", "_place")
    ordered.select("_id", "_url", "_payload", "_digest", "_length", "_refers", "_mark").mapInArrow(run, "file string, records long, bytes long, sha256 string").write.parquet(f"{folder}/_manifest")
    return pages.sparkSession.read.parquet(f"{folder}/_manifest")


def parse_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record of an open gzip stream of members; one record is in memory at a time."""
    left = b""
    while True:
        member, parts = zlib.decompressobj(31), []
        while not member.eof:
            data = left or stream.read(READ_BYTES)
            left = b""
            if not data:
                if parts:
                    raise ValueError("the file ends inside a record")
                return
            parts.append(member.decompress(data))
        left = member.unused_data
        raw = b"".join(parts)
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode("utf-8", "surrogatepass").split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        yield fields, rest[: int(fields["Content-Length"])]


def _page(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def read_warc(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to (and payload, null for revisits) of
    every page record in the manifest's files. Digests and lengths are checked against the bytes read."""
    ship_package(spark)
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + (", payload binary" if payload else "")
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()][: len(names)]

    def rows_of(name: str) -> Iterator[tuple]:
        store, path = file_system(folder)
        with store.open_input_stream(f"{path}/{name}", compression=None) as stream:
            for fields, block in parse_records(stream):
                kind = fields["WARC-Type"]
                if kind not in ("response", "revisit"):
                    continue
                if fields["WARC-Block-Digest"] != f"sha1:{sha1_base32(block)}":
                    raise ValueError(f"{name}: block digest of {fields['WARC-Record-ID']}")
                body, length, digest = block.partition(b"\r\n\r\n")[2], int(fields["WARC-Full-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
                if kind == "response" and (len(body) != length or sha1_base32(body) != digest):
                    raise ValueError(f"{name}: payload digest of {fields['WARC-Record-ID']}")
                row = (_page(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), length, digest, kind, _page(fields.get("WARC-Refers-To")))
                yield (*row, body if kind == "response" else None) if payload else row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("file").to_pylist():
                held, size = [], 0
                for row in rows_of(name):
                    held.append(row)
                    size += row[2] if payload else 64
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names)

    files = spark.read.parquet(f"{folder}/_manifest").select("file")
    spread = files.repartitionByRange(max(1, min(files.count(), spark.sparkContext.defaultParallelism * 4)), "file")
    return spread.mapInArrow(run, schema)


def manifest_json(manifest: DataFrame) -> Iterator[str]:
    """The manifest as JSON lines, streamed."""
    return (json.dumps(r.asDict(), sort_keys=True) for r in manifest.orderBy("file").toLocalIterator())
