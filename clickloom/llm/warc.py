"""Web archives with a two-level capture index.

Writing: every page becomes one gzip member of a WARC file in the shared folder; a page whose
payload another record already holds becomes a revisit record. A task writes files of its own
name, so a task that runs twice leaves a file nobody refers to; what counts is the table of
records that the tasks return.

Indexing: records are range-partitioned by key, the host reversed and followed by the path. Each
partition writes its sorted lines in compressed blocks of ``BLOCK_LINES`` to one shard and a
directory with the first key and byte range of each block beside it. The driver keeps one row
per shard.

Reading: keys find their shards by their first and last keys, then in a task per group of
shards: binary search in the directory, range reads of the blocks that can hold the key, and the
matching lines. The records found are sorted by file and offset, ranges that touch are read
together, and the payload of a revisit is checked against its recorded digest.

Files are read and written through the file system that the shared folder's address names
(local, HDFS, S3 or GCS); pages only come through Spark. A key or host with most of the captures
spreads over many shards, as the page is part of the order.

Defined results: a null page has an empty payload; of equal payloads, the record with the
largest id is the response, and so are rows that repeat that id; with only null ids all are
responses, otherwise a null id is a revisit; a null url is filed under ``-``; an empty table
gives an empty one. A page of any length is one record; other columns of the input are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.llm.tables import beside, read, stage
from clickloom.plans import staging_root

BLOCK_LINES = 1000
FILE_BYTES = 1 << 30
# Ranges of one file that are at most this far apart are read together, up to READ_BYTES.
GAP_BYTES = 64 * 1024
READ_BYTES = 8 << 20
# Archive bytes that a reading task is dealt at a time.
TASK_BYTES = 128 << 20
DATE = "1970-01-01T00:00:00Z"

RECORDS = (
    "key string, page_id bigint, record_type string, payload_bytes bigint, "
    "refers_to bigint, file string, offset bigint, length bigint"
)
SHARDS = "first string, last string, shard string, directory string, lines bigint"
FOUND = "key string, page_id bigint, file string, offset bigint, length bigint"
CAPTURES = (
    "page_id bigint, url string, record_type string, payload_digest string, payload_bytes bigint, "
    "refers_to bigint, payload binary"
)


def file_system(address: str) -> tuple[fs.FileSystem, str]:
    address = re.sub(r"^s3[an]://", "s3://", address)
    return fs.FileSystem.from_uri(address if "://" in address or address.startswith("file:") else f"file://{address}")


def url_key(url: str | None) -> str:
    """Host labels in reverse, then the path and query: ``com,example,www)/a?b``."""
    if not url:
        return "-"
    found = re.match(r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::\d*)?([^#]*)", url)
    key = url
    if found:
        key = ",".join(reversed(found.group(1).lower().split("."))) + f"){found.group(2) or '/'}"
    return key.replace("\n", "%0A").replace("\t", "%09")


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header(fields: list[tuple[str, str]]) -> bytes:
    lines = ["WARC/1.1", *(f"{name}: {value}" for name, value in fields), "", ""]
    return "\r\n".join(lines).encode()


def _one_line(text: str) -> str:
    return text.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _unescaped(text: str) -> str:
    return text.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, response: bool) -> bytes:
    """One WARC record. A url is kept as it came, line breaks escaped; null has no field."""
    digest = sha1_base32(payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if response else head
    fields = [
        ("WARC-Type", "response" if response else "revisit"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if url is not None:
        fields.append(("WARC-Target-URI", _one_line(url)))
    if not response:
        fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        fields.append(("X-Refers-To-Page-ID", str(refers_to)))
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return _header(fields) + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """The fields of a record and its payload; the digest of a response is recomputed."""
    head, _, block = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http).group(1))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    response = fields["WARC-Type"] == "response"
    if response and (len(payload) != size or sha1_base32(payload) != digest):
        raise ValueError(f"damaged record of page {fields.get('X-Page-ID')}")
    page, other, url = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID"), fields.get("WARC-Target-URI")
    return {
        "page_id": int(page) if page else None,
        "url": _unescaped(url) if url is not None else None,
        "record_type": fields["WARC-Type"],
        "payload_digest": digest,
        "payload_bytes": size,
        "refers_to": int(other) if other else None,
        "payload": payload if response else None,
    }


def _gzip(raw: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def _gunzip(raw: bytes) -> bytes:
    return zlib.decompress(raw, 31)


def _write_files(
    folder: str, file_bytes: int, level: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Append records to files of this attempt; return where each of them is."""
    system, path = file_system(folder)
    task = TaskContext.get()
    name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
    out, file, at, number = None, "", 0, 0
    info = _header([
        ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE),
        ("Content-Type", "application/warc-fields"), ("Content-Length", "0"),
    ]) + b"\r\n\r\n"
    for batch in batches:
        rows = []
        columns = (batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to", "response"))
        for page_id, url, html, refers_to, response in zip(*columns, strict=True):
            if out is None or at >= file_bytes:
                if out is not None:
                    out.close()
                file, number, at = f"{name}-{number:04d}.warc.gz", number + 1, 0
                out = system.open_output_stream(f"{path}/{file}", compression=None)
                member = _gzip(info, level)
                out.write(member)
                at += len(member)
            payload = (html or "").encode("utf-8", "surrogatepass")
            member = _gzip(record(page_id, url, payload, refers_to, response), level)
            out.write(member)
            rows.append({
                "key": url_key(url), "page_id": page_id, "record_type": "response" if response else "revisit",
                "payload_bytes": len(payload), "refers_to": None if response else refers_to,
                "file": file, "offset": at, "length": len(member),
            })
            at += len(member)
        yield pa.RecordBatch.from_pylist(rows, schema=_RECORD_SCHEMA)
    if out is not None:
        out.close()


_RECORD_SCHEMA = pa.schema([
    ("key", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()),
    ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("file", pa.string()),
    ("offset", pa.int64()), ("length", pa.int64()),
])


def write_archives(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES, level: int = 6) -> DataFrame:
    """Write the archives of ``page_id, url, html`` into a folder; the table of records, staged.

    Which payloads repeat is found from digests alone; payloads are not shuffled unless the list
    of repeated digests is too large to be broadcast.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        html.alias("html"), F.unhex(F.sha1(html)).alias("sha"),
    )
    repeated = stage(
        rows.groupBy("sha").agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select(F.col("sha").alias("_sha"), "first_id")
    )
    joined = rows.join(beside(repeated), F.col("sha") == F.col("_sha"), "left")
    response = F.col("_sha").isNull() | F.col("page_id").eqNullSafe(F.col("first_id"))
    planned = joined.select(
        "page_id", "url", "html", F.col("first_id").alias("refers_to"), response.alias("response")
    )
    return stage(planned.mapInArrow(lambda b: _write_files(folder, file_bytes, level, b), RECORDS))


def _write_shard(folder: str, block_lines: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted lines to one shard of compressed blocks, and its directory."""
    system, path = file_system(folder)
    task = TaskContext.get()
    name = f"index-{task.partitionId():06d}-{task.taskAttemptId()}"
    out, at, lines, block, entries, first, last = None, 0, 0, [], [], None, None

    def flush() -> None:
        nonlocal at, block
        packed = zlib.compress("\n".join(block).encode("utf-8", "surrogatepass"))
        out.write(packed)
        entries.append(f"{block[0].split(chr(9), 1)[0]}\t{at}\t{len(packed)}")
        at += len(packed)
        block = []

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("key", "page_id", "file", "offset", "length"))
        for key, page_id, file, offset, length in zip(*columns, strict=True):
            if out is None:
                out, first = system.open_output_stream(f"{path}/{name}.blocks", compression=None), key
            block.append(f"{key}\t{'' if page_id is None else page_id}\t{file}\t{offset}\t{length}")
            last, lines = key, lines + 1
            if len(block) >= block_lines:
                flush()
    if out is None:
        return
    if block:
        flush()
    out.close()
    with system.open_output_stream(f"{path}/{name}.directory", compression=None) as directory:
        directory.write("\n".join(entries).encode("utf-8", "surrogatepass"))
    yield pa.RecordBatch.from_pylist([{
        "first": first, "last": last, "shard": f"{name}.blocks", "directory": f"{name}.directory", "lines": lines,
    }])


def write_index(
    records: DataFrame, folder: str, block_lines: int = BLOCK_LINES, shards: int | None = None
) -> list[tuple]:
    """The two-level index of a table of records; one row per shard, in order of keys."""
    number = [shards] if shards else []
    dealt = records.select("key", "page_id", "file", "offset", "length")
    dealt = dealt.repartitionByRange(*number, "key", "page_id", "file", "offset")
    ordered = dealt.sortWithinPartitions("key", "page_id", "file", "offset")
    written = stage(ordered.mapInArrow(lambda b: _write_shard(folder, block_lines, b), SHARDS))
    rows = written.select("first", "last", "shard", "directory").collect()
    return sorted((tuple(r) for r in rows), key=lambda r: (_order(r[0]), _order(r[1])))


def _order(key: str) -> bytes:
    return key.encode("utf-8", "surrogatepass")


def _shards_of(shards: list[tuple], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every key with the shards whose range holds it."""
    firsts, lasts = [_order(s[0]) for s in shards], [_order(s[1]) for s in shards]
    for batch in batches:
        keys, numbers = [], []
        for key in dict.fromkeys(map(url_key, batch.column("url").to_pylist())):
            # Ranges are in order and touch at most in their ends.
            for k in range(bisect_left(lasts, _order(key)), bisect_right(firsts, _order(key))):
                keys.append(key)
                numbers.append(k)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(numbers, pa.int32())], names=["key", "shard"])


def _look_up(folder: str, shards: list[tuple], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of keys, which come sorted by shard and key. One block is held at a time."""
    system, path = file_system(folder)
    number, blocks, directory, firsts = None, None, [], []
    held, lines, line_keys = None, [], []

    def load(k: int) -> None:
        nonlocal held, lines, line_keys
        if held != (number, k):
            _, offset, length = directory[k]
            text = zlib.decompress(blocks.read_at(length, offset)).decode("utf-8", "surrogatepass")
            lines = [line.split("\t") for line in text.split("\n")]
            line_keys = [_order(line[0]) for line in lines]
            held = (number, k)

    for batch in batches:
        rows = []
        for key, wanted in zip(batch.column("key").to_pylist(), batch.column("shard").to_pylist(), strict=True):
            if wanted != number:
                if blocks is not None:
                    blocks.close()
                number = wanted
                with system.open_input_stream(f"{path}/{shards[wanted][3]}", compression=None) as source:
                    text = source.read().decode("utf-8", "surrogatepass")
                directory = [(f, int(o), int(n)) for f, o, n in (line.split("\t") for line in text.split("\n"))]
                firsts = [_order(d[0]) for d in directory]
                blocks = system.open_input_file(f"{path}/{shards[wanted][2]}")
            sought = _order(key)
            # The key may begin in the last block that starts before it.
            for k in range(max(0, bisect_left(firsts, sought) - 1), bisect_right(firsts, sought)):
                load(k)
                for line in lines[bisect_left(line_keys, sought) : bisect_right(line_keys, sought)]:
                    rows.append((line[0], int(line[1]) if line[1] else None, line[2], int(line[3]), int(line[4])))
                if len(rows) >= 10_000:
                    yield _found(rows)
                    rows = []
        if rows:
            yield _found(rows)
    if blocks is not None:
        blocks.close()


def _found(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, names=["key", "page_id", "file", "offset", "length"])


def look_up(urls: DataFrame, folder: str, shards: list[tuple]) -> DataFrame:
    """``key, page_id, file, offset, length`` of all captures of the urls in column ``url``."""
    routed = urls.select(F.col("url").cast("string").alias("url")).mapInArrow(
        lambda b: _shards_of(shards, b), "key string, shard int"
    )
    dealt = routed.distinct().repartition("shard").sortWithinPartitions("shard", "key")
    return dealt.mapInArrow(lambda b: _look_up(folder, shards, b), FOUND)


def _range_reads(
    folder: str, with_payload: bool, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Records at places that come sorted by file and offset; neighbours are read together."""
    system, path = file_system(folder)
    name, source = None, None

    def chunks() -> Iterator[list[tuple[str, int, int]]]:
        chunk: list[tuple[str, int, int]] = []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("file", "offset", "length"))
            for file, offset, length in zip(*columns, strict=True):
                if chunk and (
                    file != chunk[0][0]
                    or offset - (chunk[-1][1] + chunk[-1][2]) > GAP_BYTES
                    or offset + length - chunk[0][1] > READ_BYTES
                ):
                    yield chunk
                    chunk = []
                chunk.append((file, offset, length))
        if chunk:
            yield chunk

    for chunk in chunks():
        if chunk[0][0] != name:
            if source is not None:
                source.close()
            name = chunk[0][0]
            source = system.open_input_file(f"{path}/{name}")
        begin = chunk[0][1]
        data = source.read_at(chunk[-1][1] + chunk[-1][2] - begin, begin)
        rows = [parse_record(_gunzip(data[o - begin : o - begin + n])) for _, o, n in chunk]
        if not with_payload:
            for row in rows:
                row["payload"] = None
        yield pa.RecordBatch.from_pylist(rows, schema=_CAPTURE_SCHEMA)
    if source is not None:
        source.close()


_CAPTURE_SCHEMA = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()),
    ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("payload", pa.binary()),
])


def read_records(
    places: DataFrame, folder: str, with_payload: bool = True, task_bytes: int = TASK_BYTES
) -> DataFrame:
    """The records at ``file, offset, length``; a revisit has no payload of its own.

    ``places`` should be a written table, as their lengths are summed first: the small rows say
    nothing of the bytes behind them, so tasks are dealt stretches of ``task_bytes`` of a file.
    """
    total = places.agg(F.sum("length")).first()[0] or 0
    stretch = F.floor(F.col("offset") / task_bytes)
    dealt = places.select("file", "offset", "length").repartition(-(-total // task_bytes) or 1, "file", stretch)
    ordered = dealt.sortWithinPartitions("file", "offset")
    return ordered.mapInArrow(lambda b: _range_reads(folder, with_payload, b), CAPTURES)


def archive_folder(spark: SparkSession) -> str:
    """A new folder in the shared one."""
    folder = f"{staging_root(spark)}/archive-{uuid.uuid4().hex}"
    system, path = file_system(folder)
    system.create_dir(path, recursive=True)
    return folder


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``pages`` written as records and read back; odd rows as the module says."""
    pages = read(spark, sf_dir, "pages")
    folder = archive_folder(spark)
    shards = write_index(write_archives(pages, folder), folder)
    places = stage(look_up(pages, folder, shards))
    captures = read_records(places, folder, with_payload=False)
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# Base32 of the digest, five bits at a time, from its 40 hex digits.
OP2_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
r AS (SELECT h, max(page_id) AS m FROM p GROUP BY h),
b AS (
  SELECT page_id, h, string_agg(lpad(bin(('0x' || h[k:k])::INT), 4, '0'), '' ORDER BY k) AS bits
  FROM p, generate_series(1, 40) AS s(k) GROUP BY page_id, h),
d AS (
  SELECT page_id, string_agg('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[v + 1 : v + 1], '' ORDER BY k) AS digest
  FROM (
    SELECT page_id, k, 16 * bits[k:k]::INT + 8 * bits[k + 1:k + 1]::INT + 4 * bits[k + 2:k + 2]::INT
      + 2 * bits[k + 3:k + 3]::INT + bits[k + 4:k + 4]::INT AS v
    FROM b, generate_series(1, 156, 5) AS s(k)) GROUP BY page_id)
SELECT p.page_id, CAST(strlen(p.html) AS BIGINT) AS payload_bytes, d.digest AS payload_digest,
  CASE WHEN r.m = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN r.m = p.page_id THEN NULL ELSE r.m END AS refers_to
FROM p JOIN r USING (h) JOIN d USING (page_id)
"""
