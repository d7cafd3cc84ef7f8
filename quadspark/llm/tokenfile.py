"""Token ids in files of length-delimited binary records, with an offset index for shuffled reads.

A record is ``length (u64) | masked checksum of the length (u32) | payload | masked checksum of the payload (u32)``,
little-endian; the payload holds the ids as unsigned 16-bit integers where the vocabulary allows, else 32-bit. The
checksum is CRC-32 (zlib's), rotated right by 15 bits plus a constant. The index beside a file has one entry of
fixed size per record: document id, whether it is null, byte offset, first token within the file, tokens.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quadspark.llm import scratch

#: Default vocabulary, a parameter, and the id that ends every document.
VOCABULARY, END_ID = public_tokenizers.path("byte_bpe_50k.json"), 2
#: Documents that one reading task row covers.
READ_DOCS = 2_000

_INDEX = "<q?QQI"
_MASK = 0xA282EAD8
#: How byte-level vocabularies write bytes: printable Latin-1 as it is, the others from U+0100 on in order.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SHOWN_AS = np.arange(256, dtype="<u2")
_SHOWN_AS[sorted(set(range(256)) - set(_SHOWN))] = np.arange(256, 512 - len(_SHOWN))
_SHOWN_BREAK, _SHOWN_SPACE = chr(_SHOWN_AS[10]), chr(_SHOWN_AS[32])
#: Punctuation that may end a part.
_TAIL = ".,;:!?%$*&#)"


def masked(data: bytes) -> int:
    """Checksum of data that may itself hold checksums."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + _MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """One record."""
    head = struct.pack("<Q", len(payload))
    return b"".join([head, struct.pack("<I", masked(head)), payload, struct.pack("<I", masked(payload))])


def unframe(record: bytes) -> bytes:
    """Payload of one record; a wrong length or checksum raises."""
    (length,), (of_head,) = struct.unpack_from("<Q", record), struct.unpack_from("<I", record, 8)
    payload = record[12 : 12 + length]
    if masked(record[:8]) != of_head or len(record) < 16 + length or masked(payload) != struct.unpack_from("<I", record, 12 + length)[0]:
        raise ValueError("a token record is damaged")
    return payload


class _Encoder:
    """Ids of texts as bytes, by the tokenizers library, with a cache of what stands between two single spaces.

    A single space between two other characters always starts a pre-token, and so does punctuation after a
    letter, so a text can be cut there and the parts encoded alone. Texts that hold an added token of the
    vocabulary go through the library whole, as such tokens are found before anything is cut.

    Only parts that neither start nor end with white space are kept, so a text all of whose parts are known was cut
    at single spaces alone. The cache has two generations: the older one goes when the newer is full.
    """

    limit, longest = 500_000, 64

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.split, self.model = tokenizer.pre_tokenizer.pre_tokenize_str, tokenizer.model.tokenize
        self.added, self.library = [t.content for t in tokenizer.get_added_tokens_decoder().values()], tokenizer
        self.code = "I" if tokenizer.get_vocab_size() > 1 << 16 else "H"
        self.width = 4 if self.code == "I" else 2
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.tail = lru_cache(10_000)(self.alone)

    def ids(self, pieces: list[str]) -> bytes:
        """Ids of pre-tokens that are written in the vocabulary's alphabet."""
        return array(self.code, [t.id for piece in pieces for t in self.model(piece)]).tobytes()

    def alone(self, part: str) -> bytes:
        """Ids of a part of a text that starts and ends where pre-tokens do."""
        return self.ids([piece for piece, _ in self.split(part)])

    def learn(self, parts: set[str]) -> None:
        """Put parts that follow a space into the cache."""
        ends = {part: core for part in parts if (core := part.rstrip(_TAIL)) != part and core[-1:].isalpha()}
        bare = parts.difference(ends).union(ends.values()).difference(self.known)
        fresh = []
        for part in bare:
            if (ids := self.older.get(part)) is not None:
                self.known[part] = ids
            elif part and len(part) < self.longest and part == part.strip():
                fresh.append(part)
        words = [part for part in fresh if part.isalpha()]
        if words:
            shown = _SHOWN_AS[np.frombuffer("\n".join(words).encode(), np.uint8)].tobytes().decode("utf-16-le")
            for part, piece in zip(words, shown.split(_SHOWN_BREAK), strict=True):
                self.known[part] = self.ids([_SHOWN_SPACE + piece])
        for part in fresh:
            if part not in self.known:
                self.known[part] = self.alone(" " + part)
        for part, core in ends.items():
            if (ids := self.known.get(core)) is not None:
                self.known[part] = ids + self.tail(part[len(core) :])

    def slowly(self, parts: list[str]) -> bytes:
        """Ids of a text cut at its spaces, some of which may be no safe cut: those beside other white space."""
        safe: list[str] = []
        for part in parts:
            if safe and not (safe[-1] and part and not safe[-1][-1].isspace() and not part[0].isspace()):
                safe[-1] += " " + part
            else:
                safe.append(part)
        first, *rest = safe
        return b"".join([self.alone(first), *[self.known[p] if p in self.known else self.alone(" " + p) for p in rest]])

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.limit:
            self.older, self.known = self.known, {}
        cut = [text.split(" ") for text in texts]
        self.learn(set().union(*[parts[1:] for parts in cut]).difference(self.known))
        out, known = [], self.known.__getitem__
        for text, parts in zip(texts, cut, strict=True):
            if any(token in text for token in self.added):
                out.append(array(self.code, self.library.encode(text, add_special_tokens=False).ids).tobytes())
                continue
            try:
                rest = iter(parts)
                first = next(rest)
                if first[-1:].isspace() and len(parts) > 1 or not first:
                    raise KeyError(first)
                out.append(b"".join([self.alone(first), *map(known, rest)]))
            except KeyError:
                out.append(self.slowly(parts))
        return out


@lru_cache(4)
def _encoder(path: str) -> _Encoder:
    return _Encoder(path)


def write(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = VOCABULARY, end_id: int = END_ID, partitions: int | None = None) -> DataFrame:
    """Encode whole texts and write them in ascending id order; returns the manifest, one row per file.

    Null ids come first, equal ids in the order of their texts; a null text is empty and has the end id alone.
    Files are named by attempt and only the manifest, written after all tasks have ended, says which ones count,
    so a task that runs twice leaves no double records. Columns: ``shard, file, start, n_docs, n_tokens, width``.
    """
    spark = docs.sparkSession
    into = scratch.folder(spark, "tokens")
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = pa.schema([("shard", pa.int64()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("width", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, files, n_docs, tokens, at = _encoder(path), None, 0, 0, 0
        shard = TaskContext.get().partitionId()
        end = array(encoder.code, [end_id]).tobytes()
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                if files is None:
                    store, base = scratch.opened(into)
                    store.create_dir(base, recursive=True)
                    name = f"shard-{shard:06d}-{uuid.uuid4().hex}"
                    files = store.open_output_stream(f"{base}/{name}.rec"), store.open_output_stream(f"{base}/{name}.idx")
                for doc, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist()), strict=True):
                    record = frame(ids + end)
                    n = len(ids) // encoder.width + 1
                    files[0].write(record)
                    files[1].write(struct.pack(_INDEX, doc or 0, doc is None, at, tokens, n))
                    at, tokens, n_docs = at + len(record), tokens + n, n_docs + 1
        if files:
            for f in files:
                f.close()
            yield pa.RecordBatch.from_pylist([{"shard": shard, "file": f"{into}/{name}", "n_docs": n_docs, "n_tokens": tokens, "width": encoder.width}], schema=schema)

    written = own.repartitionByRange(count, "doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(run, "shard long, file string, n_docs long, n_tokens long, width int")
    manifest = scratch.write(written, "manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Read files back by their index: ``doc_id, start, n_tokens, ids`` per record.

    start counts the ids of all records before it, ids is binary, little-endian unsigned 32-bit. Each task row
    covers READ_DOCS records, reads their index entries and then their bytes, and checks every checksum.
    """
    spans = manifest.select("file", "start", "width", "n_docs", F.explode(F.sequence(F.lit(0), F.col("n_docs") - 1, F.lit(READ_DOCS))).alias("first"))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, base = scratch.opened(row["file"])
                count = min(READ_DOCS, row["n_docs"] - row["first"])
                with store.open_input_file(f"{base}.idx") as index:
                    entries = list(struct.iter_unpack(_INDEX, index.read_at(count * struct.calcsize(_INDEX), row["first"] * struct.calcsize(_INDEX))))
                with store.open_input_file(f"{base}.rec") as records:
                    for k in range(0, count, 256):
                        part = entries[k : k + 256]
                        first, (_, _, last, _, n) = part[0][2], part[-1]
                        data = records.read_at(last + 16 + n * row["width"] - first, first)
                        ids = [np.frombuffer(unframe(data[at - first : at - first + 16 + n * row["width"]]), f"<u{row['width']}").astype("<u4").tobytes() for _, _, at, _, n in part]
                        yield pa.RecordBatch.from_arrays([pa.array([None if none else doc for doc, none, *_ in part], pa.int64()), pa.array([row["start"] + e[3] for e in part], pa.int64()), pa.array([e[4] for e in part], pa.int64()), pa.array(ids, pa.binary())], schema=schema)

    return spans.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
