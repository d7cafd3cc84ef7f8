"""Place documents in shards by jump consistent hashing, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quadspark.llm import scratch
from quadspark.llm.ordering import ranked

SHARDS, LAW = 24, "key"

# Fixed value: the multiplier of the 64-bit linear congruential generator that jump consistent hashing draws from.
MULTIPLIER = 2862933555777941757

_HALF, _LOW16, _LOW32 = 32, 0xFFFF, 0xFFFFFFFF
#: Draws after which a key is as good as always settled; the rest of the walk is there for those that are not.
_FEW = 64


def key_of(doc_id: Column) -> Column:
    """A stable key below 2^60 of an id: the first 15 hex digits of the SHA-256 of its decimal form; null has one too."""
    return F.conv(F.substring(F.sha2(F.coalesce(doc_id.cast("string"), F.lit("null")), 256), 1, 15), 16, 10).cast("long")


def _drawn(state: Column, shards: int) -> Column:
    """The next state of the walk: the generator's 64 bits in two halves, so that no product passes a long, and the jump."""
    low, high = state["low"], state["high"]
    m = (MULTIPLIER & _LOW16, MULTIPLIER >> 16 & _LOW16, MULTIPLIER >> _HALF)
    upper = low * F.lit(m[1])
    sum_ = low * F.lit(m[0]) + F.shiftleft(upper.bitwiseAND(F.lit(_LOW16)), 16) + 1
    carry = F.shiftright(sum_, _HALF) + F.shiftright(upper, 16)
    cross = (low * F.lit(m[2])).bitwiseAND(F.lit(_LOW32)) + high * F.lit(m[0]) + F.shiftleft((high * F.lit(m[1])).bitwiseAND(F.lit(_LOW16)), 16)
    new_high = (carry + cross).bitwiseAND(F.lit(_LOW32))
    jump = F.floor((state["j"] + 1).cast("double") * (F.lit(float(1 << 31)) / (F.shiftright(new_high, 1) + 1).cast("double"))).cast("long")
    following = F.struct(new_high.alias("high"), sum_.bitwiseAND(F.lit(_LOW32)).alias("low"), state["j"].alias("b"), jump.alias("j"))
    return F.when(state["j"] >= F.lit(shards).cast("long"), state).otherwise(following)


def jump(key: Column, shards: int) -> Column:
    """The shard, 0 to ``shards`` - 1, of a key from 0 to 2^63 - 1, by jump consistent hashing.

    The walk jumps from shard to shard by draws that depend on the key alone and ends before the first jump to
    ``shards`` or beyond, so with more shards it goes on where it stopped: keys move to the new shards or not at all.
    No walk has more jumps than shards; most have about their logarithm.
    """
    if shards < 1:
        raise ValueError("there must be a shard")
    none = F.lit(0).cast("long")
    state = F.struct(F.shiftright(key, _HALF).alias("high"), key.bitwiseAND(F.lit(_LOW32)).alias("low"), none.alias("b"), none.alias("j"))
    walk = lambda start, steps: F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, lambda at, _: _drawn(at, shards))
    state = walk(state, min(shards, _FEW) + 1)
    if shards > _FEW:
        state = F.transform(F.array(state), lambda at: F.when(at["j"] >= F.lit(shards).cast("long"), at).otherwise(walk(at, shards - _FEW)))[0]
    return state["b"].cast("int")


def _slots(rows: DataFrame, shards: int) -> DataFrame:
    """Add ``_slot``, the place of a row in its ``_shard`` from 0 on, by id (null last), checksum and size of the text.

    Rows are ranked over range partitions, and a shard's slots start where the counts of the shards before it end.
    Repeated rows are told apart by where they were read, so that they too are dealt over partitions.
    """
    placed = ranked(rows, F.col("_shard"), F.col("_id").isNull(), F.col("_id"), F.col("_crc"), F.col("_size"), F.col("_read"), name="_rank")
    before = Window.orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("_shard").agg(F.count("*").alias("_n")).select("_shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    # One row per shard at most, whatever the table's size.
    starts = F.broadcast(starts) if shards <= 100_000 else starts
    return placed.join(starts, "_shard").withColumn("_slot", F.col("_rank") - 1 - F.col("_start")).drop("_rank", "_start", "_read")


def _marked(docs: DataFrame, shards: int, id_col: str, text_col: str, *more: Column) -> DataFrame:
    own, text = F.col(f"`{id_col}`").cast("long"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(own.alias("_id"), (F.octet_length(text) + 8).cast("long").alias("_size"), F.crc32(text.cast("binary")).alias("_crc"), *more)
    return rows.withColumns({"_key": key_of(F.col("_id")), "_read": F.monotonically_increasing_id()}).withColumn("_shard", jump(F.col("_key"), shards))


def plan(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row; texts are not shuffled.

    The shard follows from the id and the number of shards alone, so rows that repeat an id share it and all rows
    without an id are one key. ``grown_shard`` is the shard with one more of them: the same, or the new one. Slots are
    gapless in each shard, by id, null last, then by the text's checksum and size. Null texts count as empty, other
    columns don't matter and an empty table gives no rows.
    """
    rows = _marked(docs, shards, id_col, text_col)
    rows = scratch.write(rows.withColumn("_grown", jump(F.col("_key"), shards + 1)).drop("_key"), "keys")
    own = _slots(rows, shards)
    return own.select(F.col("_id").alias("doc_id"), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), F.lit(LAW).alias("law"), F.col("_shard").alias("shard"), F.col("_slot").alias("slot"), F.col("_grown").alias("grown_shard"))


def write(docs: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write every row, with all its columns, into the folder ``shard=N`` of its shard below ``path``, by slot.

    Files hold ranges of one shard, so a shard of any size is written by many tasks. A shard without rows has no folder.
    """
    rows = scratch.write(_marked(docs, shards, id_col, text_col, F.struct("*").alias("row")).drop("_key"), "rows")
    _slots(rows, shards).select("row", F.col("_slot").alias("slot"), F.col("_shard").alias("shard")).write.partitionBy("shard").parquet(path)


def read(spark: SparkSession, path: str, shard: int | None = None) -> DataFrame:
    """``row, slot, shard`` of what ``write`` wrote; of one shard only that folder is read."""
    rows = spark.read.parquet(path)
    return rows if shard is None else rows.where(F.col("shard") == shard)


def moves(docs: DataFrame, before: int, after: int, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that go elsewhere when ``before`` shards become ``after``, with ``_from`` and ``_to``.

    When shards are appended these are about (after - before) / after of the ids, all to the new shards.
    """
    key = key_of(F.col(f"`{id_col}`").cast("long"))
    return docs.withColumns({"_from": jump(key, before), "_to": jump(key, after)}).where("_from != _to")


ORACLE_SQL = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
bits AS (SELECT i::UBIGINT AS i, i::UBIGINT AS c, 0 AS k FROM range(256) t(i) UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS c FROM bits WHERE k = 8),
bytes AS (SELECT r, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::UBIGINT) AS b FROM d),
sums AS (SELECT r, xor(list_reduce(b, lambda a, x: xor(a >> 8, c[((xor(a, x) & 255) + 1)::BIGINT]), 4294967295::UBIGINT), 4294967295::UBIGINT)::BIGINT AS text_crc32 FROM bytes, crc WHERE len(b) > 0 UNION ALL SELECT r, 0 FROM bytes WHERE len(b) = 0),
draws AS (SELECT r, ('0x' || substr(sha256(coalesce(doc_id::VARCHAR, 'null')), 1, 15))::HUGEINT AS k, 0::BIGINT AS b, 0::BIGINT AS j FROM d
      UNION ALL SELECT r, n AS k, j AS b, floor((j + 1)::DOUBLE * (2147483648::DOUBLE / ((n >> 33) + 1)::DOUBLE))::BIGINT AS j FROM (SELECT r, j, (k * {MULTIPLIER}::HUGEINT + 1) % 18446744073709551616::HUGEINT AS n FROM draws WHERE j < {SHARDS + 1})),
placed AS (SELECT r, max(b) FILTER (WHERE b < {SHARDS})::INT AS shard, max(b) FILTER (WHERE b < {SHARDS + 1})::INT AS grown_shard FROM draws GROUP BY r)
SELECT doc_id, octet_length(encode(text)) + 8 AS size, text_crc32, '{LAW}' AS law, shard,
row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS LAST, text_crc32, octet_length(encode(text))) - 1 AS slot, grown_shard
FROM d JOIN sums USING (r) JOIN placed USING (r)
"""
