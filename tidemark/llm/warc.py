"""WARC archives as a chunked record table.

A payload is cut into chunks of bounded size; each chunk is a row (record, chunk number) and a WARC record of its own: the first is
the response, the others are continuations, as the format's segmentation has it. A chunk carries the digest of all bytes so far, so
the last one's is the payload's, and no step holds a whole payload beside its source row. Spark's text writer puts the records
into gzip files on any Hadoop file system (the blank line that ends a record is the line separator); a file has a bounded number
of records. Reading inflates and parses files as streams, and folds the digests of multi-chunk payloads over sorted chunks.

Equal payloads of at least min_bytes are stored once, by the largest key; the others are revisit records that name it. Smaller
payloads are all stored. Every record and segment has an id of its own, a name-based UUID under the archive's; a record that others
revisit is named by key and digest, so they can refer to it without having met it. Where the largest key repeats there are several
such records, and revisits name the key alone. Defined cases: a null payload is empty; null keys are records without a key, and respond only where no key
is there; rows that repeat the largest key all respond; null urls are left out; an empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import materialise

# fixed values: the syntax of the format
VERSION, GAP = "WARC/1.0", "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
FILE_RECORDS = 2048
SMALL = 100_000  # repeated payloads whose digests and keys may be broadcast


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def chunks(payload: bytes, size: int) -> Iterator[tuple[int, memoryview, str, bool]]:
    """(number from 1, bytes, digest of all bytes so far, whether it is the last); an empty payload is one chunk."""
    view, running = memoryview(payload), hashlib.sha1()
    count = max(1, -(-len(view) // size))
    for i in range(count):
        piece = view[i * size : (i + 1) * size]
        running.update(piece)
        yield i + 1, piece, _base32(running.copy().digest()), i + 1 == count


def _record(headers: list[tuple[str, object]], block: bytes | memoryview) -> bytes:
    lines = [VERSION, *(f"{k}: {v}" for k, v in headers if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + GAP.encode() + bytes(block)


def _writer(archive: uuid.UUID, chunk: int, date: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def name(*parts: object) -> str:
        return f"<urn:uuid:{uuid.uuid5(archive, repr(parts))}>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, out, held = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for row in range(batch.num_rows):
                key, url, refers, tops, payload, revisit, size, digest = (batch.column(c)[row].as_py() for c in ("key", "url", "refers", "tops", "payload", "revisit", "size", "digest"))
                number += 1
                named = tops == 1 and not revisit  # others refer to it
                record = name("payload", key, digest) if named else name("row", task, number)
                who = [("WARC-Date", date), ("WARC-Target-URI", None if url is None else quote(url, safe=":/?#[]@!$&'()*+,;=%~")), ("X-Key", key)]
                whole = [("WARC-Payload-Digest", "sha1:" + _base32(bytes.fromhex(digest))), ("X-Payload-Length", size)]
                if revisit:
                    target = [("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"), ("WARC-Refers-To", name("payload", refers, digest) if tops == 1 else None), ("X-Refers-To-Key", refers)]
                    out.append(_record([("WARC-Type", "revisit"), ("WARC-Record-ID", record), *who, *target, *whole], b""))
                else:
                    for i, piece, so_far, last in chunks(payload, chunk):
                        kind = [("WARC-Type", "response" if i == 1 else "continuation"), ("WARC-Record-ID", record if i == 1 else name(record, i)), *who]
                        split = [] if i == 1 and last else [("WARC-Segment-Number", i), ("WARC-Segment-Origin-ID", None if i == 1 else record), ("WARC-Segment-Total-Length", size if last else None)]
                        out.append(_record([*kind, *split, *whole, ("X-Running-Digest", "sha1:" + so_far)], piece))
                        held += len(out[-1])
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
                            out, held = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    return run


def write_archive(pages: DataFrame, key: str, url: str, payload: str, path: str, min_bytes: int = 0, chunk: int = 64 << 10, date: str = DATE) -> None:
    """Write one record for every row to gzip files under path."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), body.alias("payload"))
    rows = rows.withColumns({"size": F.octet_length("payload").cast("long"), "digest": F.sha1("payload")})
    # digests and keys alone are shuffled, counted before it; the payloads stay where they are if the table of repeats is small
    per_key = rows.select("key", "size", "digest").where(F.col("size") >= min_bytes).groupBy("digest", "key").agg(F.count("*").alias("n"))
    shared = per_key.groupBy("digest").agg(F.max("key").alias("refers"), F.max_by("n", "key").alias("tops"), F.sum("n").alias("n")).where("n > 1").select("digest", "refers", "tops")
    shared = materialise(shared, "repeats")
    joined = rows.join(F.broadcast(shared) if shared.count() <= SMALL else shared, "digest", "left")
    revisit = F.coalesce((F.col("size") >= min_bytes) & F.col("refers").isNotNull() & ~F.col("key").eqNullSafe(F.col("refers")), F.lit(False))
    tagged = joined.withColumn("revisit", revisit)
    ready = tagged.select("key", "url", F.when(F.col("revisit"), F.col("refers")).alias("refers"), F.when(F.col("key").isNotNull() | F.col("revisit"), F.col("tops")).alias("tops"), F.when(F.col("revisit"), F.lit(b"")).otherwise(F.col("payload")).alias("payload"), "revisit", "size", "digest")
    records = ready.mapInArrow(_writer(uuid.uuid4(), chunk, date), "value binary").select(F.col("value").cast("string").alias("value"))
    records.write.option("lineSep", GAP).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)


def parse(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of an inflated stream; holds one record and one piece at a time."""
    held, gap = b"", GAP.encode()
    for piece in pieces:
        held += piece
        while (end := held.find(gap)) >= 0:
            lines = held[:end].decode().split("\r\n")
            if lines[0] != VERSION:
                raise ValueError("not a WARC record")
            headers = dict(line.split(": ", 1) for line in lines[1:])
            stop = end + len(gap) + int(headers["Content-Length"])
            if len(held) < stop + len(gap):
                break
            if held[stop : stop + len(gap)] != gap:
                raise ValueError("a record does not end where its length says")
            yield headers, held[end + len(gap) : stop]
            held = held[stop + len(gap) :]
    if held:
        raise ValueError("the archive ends inside a record")


def inflate(content: bytes, step: int = 256 << 10) -> Iterator[bytes]:
    """A gzip file of any number of members, in pieces."""
    view, one = memoryview(content), zlib.decompressobj(31)
    for i in range(0, len(view), step):
        piece = bytes(view[i : i + step])
        while piece:
            yield one.decompress(piece)
            piece = one.unused_data
            if piece or one.eof:
                one = zlib.decompressobj(31)


_CHUNKS = "record string, chunk int, total bigint, key string, kind string, refers string, size bigint, digest string, block binary"


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _CHUNKS.split(", ")]
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    for batch in batches:
        for content in batch.column("content"):
            rows, held = [], 0
            for h, block in parse(inflate(content.as_py())):
                total = h.get("WARC-Segment-Total-Length")
                rows.append((h.get("WARC-Segment-Origin-ID", h["WARC-Record-ID"]), int(h.get("WARC-Segment-Number", 0)), None if total is None else int(total), h.get("X-Key"), h["WARC-Type"], h.get("X-Refers-To-Key"), int(h["X-Payload-Length"]), h["WARC-Payload-Digest"].removeprefix("sha1:"), block))
                held += len(block)
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunk table of an archive: one row for each record or segment; chunk is 0 for records that aren't segmented."""
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(_reader, _CHUNKS)


_RECORDS = "key string, payload_bytes bigint, payload_digest string, record_type string, refers_to string"


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unsegmented records: a response's size and digest come from its block, and must be those of its headers."""
    for batch in batches:
        sizes, digests = [], []
        for kind, size, digest, block in zip(*(batch.column(c).to_pylist() for c in ("kind", "size", "digest", "block")), strict=True):
            if kind == "response" and (len(block) != size or _base32(hashlib.sha1(block).digest()) != digest):
                raise ValueError("a payload does not match its digest")
            sizes.append(size)
            digests.append(digest)
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(sizes, pa.int64()), pa.array(digests), batch.column("kind"), batch.column("refers")], names=[c.split()[0] for c in _RECORDS.split(", ")])


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segmented records, sorted by record and chunk: the digest runs over the chunks; none is held after it."""
    record, running, length, expected = None, hashlib.sha1(), 0, 1
    for batch in batches:
        out: tuple[list, list, list] = ([], [], [])
        for name, chunk, total, key, digest, block in zip(*(batch.column(c).to_pylist() for c in ("record", "chunk", "total", "key", "digest", "block")), strict=True):
            if name != record:
                record, running, length, expected = name, hashlib.sha1(), 0, 1
            if chunk != expected:
                raise ValueError("a segment is missing")
            running.update(block)
            length += len(block)
            expected += 1
            if total is not None:
                if total != length or _base32(running.digest()) != digest:
                    raise ValueError("a payload does not match its digest")
                for held, value in zip(out, (key, length, digest), strict=True):
                    held.append(value)
        if out[0]:
            n = len(out[0])
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2]), pa.array(["response"] * n), pa.array([None] * n, pa.string())], names=[c.split()[0] for c in _RECORDS.split(", ")])


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(key, payload_bytes, payload_digest, record_type, refers_to) of every record, verified against the stored bytes; keys as text."""
    rows = read_chunks(spark, path)
    single = rows.where("chunk = 0").mapInArrow(_whole, _RECORDS)
    split = rows.where("chunk > 0").select("record", "chunk", "total", "key", "digest", "block").repartition("record").sortWithinPartitions("record", "chunk")
    return single.unionByName(split.mapInArrow(_folded, _RECORDS))
