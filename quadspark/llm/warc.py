"""Write documents to WARC archives and read archives back by boundary-chain verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadspark.llm import scratch

#: Payloads from this size on are stored once; what one task row of the reader scans by default.
LEAST_SHARED, RANGE_BYTES = 100, 4 << 20
#: Shared payloads, of about a hundred bytes here, up to which their table is broadcast; beyond it pages are shuffled by
#: digest and one of SALTS numbers, so that the copies of a very common page go to many tasks.
BROADCAST_SHARED, SALTS = 200_000, 32

_MAGIC, _HEAD_END, _TAIL = b"WARC/1.0\r\n", b"\r\n\r\n", b"\r\n\r\n"
#: What is read at a time of a header that goes on after the bytes at hand.
_HEAD_BLOCK = 1 << 20
_DATE = "2024-01-01T00:00:00Z"


def _clean(value: Column) -> Column:
    """A header value: line breaks would end it."""
    return F.regexp_replace(value, "[\r\n]+", " ")


def write(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> str:
    """Write one record per row and return the folder of the archives, one per task.

    The payload is the text in UTF-8; null counts as empty. Of equal payloads of LEAST_SHARED bytes and more, the
    one with the smallest id is a response and the others are revisits of it without a payload; rows that repeat
    that id are responses too, and so is a row without an id. Null urls and ids are left out of the headers.

    Spark's own text writer makes the files: a record's last line feed is the line separator, so the bytes are
    exactly the record's, and its commit protocol leaves no half-written or doubled archive.
    """
    own = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    own = own.withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload").cast("long")})
    shared = own.where(F.col("size") >= LEAST_SHARED).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").select("digest", "first")
    shared = scratch.write(shared, "shared")
    if shared.count() <= BROADCAST_SHARED:
        rows = own.join(F.broadcast(shared), "digest", "left")
    else:
        salted = shared.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = own.withColumn("salt", F.pmod(F.xxhash64("id", "url"), F.lit(SALTS)).cast("int")).join(salted, ["digest", "salt"], "left")
    rows = rows.withColumn("again", F.coalesce(F.col("first") != F.col("id"), F.lit(False)) & F.col("id").isNotNull())
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    body = F.when(F.col("again"), F.lit("")).otherwise(F.col("payload"))
    record = F.concat(
        F.lit("WARC/1.0\r\n"),
        F.concat(F.lit("WARC-Type: "), F.when(F.col("again"), "revisit").otherwise("response"), F.lit("\r\n")),
        line("WARC-Record-ID", urn(F.col("id"))),
        line("WARC-Target-URI", _clean(F.col("url"))),
        F.lit(f"WARC-Date: {_DATE}\r\n"),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        line("WARC-Payload-Length", F.col("size").cast("string")),
        line("WARC-Refers-To", F.when(F.col("again"), urn(F.col("first")))),
        F.when(F.col("again"), F.lit("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\n")).otherwise(""),
        F.lit("Content-Type: text/html; charset=utf-8\r\n"),
        line("Content-Length", F.octet_length(body).cast("string")),
        F.lit("\r\n"),
        body,
        F.lit("\r\n\r"),
    )
    into = scratch.folder(pages.sparkSession, "warc")
    rows.select(record.alias("value")).write.option("lineSep", "\n").text(into)
    return into


def _number(digits: bytes) -> int | None:
    """Digits as a number that fits 64 bits; None for anything else."""
    return int(digits) if digits.isdigit() and len(digits.lstrip(b"0")) < 19 and len(digits) < 1000 else None


def _header(file: pa.NativeFile, data: bytes, base: int, at: int, size: int) -> tuple[int, dict[bytes, bytes], int] | None:
    """Where the payload of the record at offset ``at`` starts, the fields and the payload's length.

    ``data`` are the bytes at hand from offset ``base`` on; a header that goes on after them is read to its end,
    however far. None if no header of a payload that ends within the file is there.
    """
    if not data.startswith(_MAGIC, at - base):
        return None
    stop = data.find(_HEAD_END, at - base)
    if stop < 0:
        data, base, seen = bytearray(data[at - base :]), at, 0
        while (stop := data.find(_HEAD_END, seen)) < 0:
            seen = max(0, len(data) - len(_HEAD_END) + 1)
            more = file.read_at(min(size - base - len(data), _HEAD_BLOCK), base + len(data))
            if not more:
                return None
            data += more
    fields = {}
    for field in bytes(data[at - base + len(_MAGIC) : stop]).split(b"\r\n"):
        name, colon, value = field.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    start, length = base + stop + len(_HEAD_END), _number(fields.get(b"content-length", b""))
    return (start, fields, length) if length is not None and start + length <= size else None


def _scan(file: pa.NativeFile, first: int, stop: int, size: int) -> tuple[list[int], list[int]]:
    """Candidate records that start in a range of a file, and the successor of each.

    A candidate stands at the start of the file or after the end of a record, so headers of candidates never
    overlap and all ranges together read each byte of a header once.
    """
    base = max(0, first - len(_TAIL))
    end = min(size, stop + len(_MAGIC))
    data, at, found, after = file.read_at(end - base, base), first - base, [], []
    while (at := data.find(_MAGIC, at)) >= 0 and base + at < stop:
        head = _header(file, data, base, base + at, size) if base + at == 0 or data.endswith(_TAIL, 0, at) else None
        if head is not None:
            found.append(base + at)
            after.append(head[0] + head[2] + len(_TAIL))
        at += 1
    return found, after


def _leap(found: list[int], after: list[int]) -> np.ndarray:
    """Follow the successors inside one range by pointer jumping, up to the first offset beyond its candidates."""
    at, to = np.array(found, np.int64), np.array(after, np.int64)
    while len(at):
        slot = np.minimum(np.searchsorted(at, to), len(at) - 1)
        inside = at[slot] == to
        if not inside.any():
            break
        to = np.where(inside, to[slot], to)
    return to


_HOP = "file string, size long, first long, stop long, at long, exit long"


def _hops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            store, path = scratch.opened(row["file"])
            with store.open_input_file(path) as file:
                found, after = _scan(file, row["first"], row["stop"], row["size"])
            n = len(found)
            same = [pa.array([row[c]] * n, pa.string() if c == "file" else pa.int64()) for c in ("file", "size", "first", "stop")]
            yield pa.RecordBatch.from_arrays([*same, pa.array(found, pa.int64()), pa.array(_leap(found, after), pa.int64())], names=["file", "size", "first", "stop", "at", "exit"])


_RECORD = pa.schema([("record_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("declared_digest", pa.string()), ("declared_bytes", pa.int64()), ("payload", pa.binary())])


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    said = lambda fields, name: fields[name].decode("utf-8", "replace") if name in fields else None
    for batch in batches:
        for row in batch.to_pylist():
            store, path = scratch.opened(row["file"])
            with store.open_input_file(path) as file:
                size, at, out, held = row["size"], row["at"], [], 0
                stop = row["stop"]
                data, base = file.read_at(min(stop + len(_MAGIC), size) - at, at), at
                while at < stop:
                    if (head := _header(file, data, base, at, size)) is None:
                        break  # also where the file ends inside this record
                    start, fields, length = head
                    if start + length > base + len(data):
                        data, base = file.read_at(start + length - at, at), at
                    payload = data[start - base : start - base + length]
                    declared = fields.get(b"warc-payload-length", str(length).encode())
                    out.append([said(fields, b"warc-record-id"), said(fields, b"warc-target-uri"), said(fields, b"warc-type"), said(fields, b"warc-refers-to"), said(fields, b"warc-payload-digest"), _number(declared), payload])
                    at, held = start + length + len(_TAIL), held + length
                    if at < stop and at - base + len(_MAGIC) > len(data):
                        data, base = file.read_at(min(stop + len(_MAGIC), size) - at, at), at
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _RECORD, strict=True)], schema=_RECORD)
                        out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _RECORD, strict=True)], schema=_RECORD)


def read(spark: SparkSession, folder: str, range_bytes: int = RANGE_BYTES, strict: bool = True) -> DataFrame:
    """Records of all archives in a folder: ``record_id, url, record_type, refers_to, declared_digest, declared_bytes, payload``.

    Tasks scan ranges of bytes for what looks like a record and emit it with the offset where its successor must
    start, already followed to the end of the range. Pointer jumping from the start of each file, doubling the
    hops in every round, keeps the offsets that are reachable, so a record's look-alike inside a payload is never
    one. Then each range is read from its verified entry on.

    A chain that ends before its file does, in a damaged or cut file, raises; without ``strict`` the file's records
    end there. Empty files have none; fields that are missing are null.
    """
    files = spark.read.format("binaryFile").load(folder).select(F.col("path").alias("file"), F.col("length").alias("size")).where("size > 0")
    firsts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(range_bytes).cast("long")))
    ranges = files.select("file", "size", firsts.alias("first")).withColumn("stop", F.least(F.col("first") + range_bytes, "size"))
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hops = scratch.write(ranges.repartition(count, "file", "first").mapInArrow(_hops, _HOP), "hops")
    # Only offsets where a chain leaves one range and enters another matter from here on.
    jump = hops.select("file", "at", F.col("exit").alias("to"))
    reached = scratch.write(hops.where("at = 0").select("file", "at"), "reached")
    while True:
        further = reached.join(jump, ["file", "at"]).select("file", F.col("to").alias("at")).join(reached, ["file", "at"], "left_anti").distinct()
        fresh = scratch.write(further.join(hops.select("file", "at"), ["file", "at"], "left_semi"), "reached")
        if fresh.isEmpty():
            break
        reached = reached.union(fresh)
        second = jump.select("file", F.col("at").alias("to"), F.col("to").alias("end"))
        jump = scratch.write(jump.join(second, ["file", "to"]).select("file", "at", F.col("end").alias("to")), "jump")
    entries = hops.join(reached, ["file", "at"], "left_semi")
    if strict:
        whole = entries.where("exit = size").select("file")
        if broken := files.join(whole, "file", "left_anti").count():
            raise ValueError(f"the chain of records ends early in {broken} archives")
    entries = entries.select("file", "size", "first", "stop", "at")
    return entries.repartition(count, "file", "at").mapInArrow(_records, ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'binary' if f.type == pa.binary() else 'string'}" for f in _RECORD))


def catalogue(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, intact`` of records of this module's writer.

    Size and digest of a response are taken from its payload, those of a revisit from its headers; intact says
    whether payload and headers agree.
    """
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    whole = F.col("record_type") == "response"
    declared = F.regexp_replace("declared_digest", "^sha256:", "")
    digest = F.when(whole, F.sha2("payload", 256)).otherwise(declared)
    return records.select(
        page("record_id").alias("page_id"), F.when(whole, F.octet_length("payload").cast("long")).otherwise(F.col("declared_bytes")).alias("payload_bytes"), digest.alias("payload_digest"), "record_type", page("refers_to").alias("refers_to"), (digest == declared).alias("intact")
    )


ORACLE_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, octet_length(encode(payload))::BIGINT AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d),
r AS (SELECT *, payload_bytes >= {LEAST_SHARED} AND first <> page_id AS again FROM f)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first END AS refers_to FROM r
"""
