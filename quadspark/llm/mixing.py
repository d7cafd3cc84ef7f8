"""Mix sources to target weights by repeating documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadspark.llm import scratch
from quadspark.llm.ordering import ranked, running

#: A source is repeated so many times at most; weights go round in the order of the sources.
MOST_REPEATS, WEIGHTS, SEED = 3, (1, 2, 3), "mix-1"
#: Rows of the table of sources up to which it is broadcast; a larger one is joined by a shuffle.
BROADCAST_SOURCES = 10_000


def words(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _draw(doc_id: Column, text: Column) -> Column:
    """A number from 0 to 1, below 1, that depends on the id, the text and the seed alone."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(f"|{SEED}|"), F.sha2(F.coalesce(text, F.lit("")), 256))
    return F.conv(F.substring(F.sha2(key, 256), 1, 13), 16, 10).cast("double") / float(1 << 52)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source, source_size, target`` from rows of ``source, size``.

    Sources by code point, null last, take the weights in turn and share the sum of all sizes. A target stops at
    MOST_REPEATS times its source's size and what is cut goes to the others by weight, until none is above: that
    is one level, target = least(cap, level * weight), raised step by step; each step sums the small table once.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = (F.col("source").isNull(), F.col("source"))
    turn = F.array(*[F.lit(w) for w in weights])
    table = scratch.write(ranked(totals, *order).select("source", "source_size", F.element_at(turn, ((F.col("rank") - 1) % len(weights) + 1).cast("int")).cast("double").alias("weight")), "sources")
    cap = F.col("source_size") * float(MOST_REPEATS)
    level = 0.0
    while True:
        capped = cap <= F.lit(level) * F.col("weight")
        whole, used, open_ = table.agg(F.sum("source_size").cast("double"), F.sum(F.when(capped, cap)), F.sum(F.when(~capped, F.col("weight")))).first()
        raised = (whole - (used or 0.0)) / open_ if open_ else level
        if raised <= level:
            break
        level = raised
    return table.select("source", "source_size", F.least(cap, F.lit(level) * F.col("weight")).alias("target"))


def rates(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target, whole, last`` from rows of ``source, draw, size``.

    Every document is taken ``whole`` times, floor(target / source_size), and once more if its draw is at most
    ``last``. The draws are walked in order and stop where the words taken come nearest to what the whole copies
    leave of the target, so the chance of the extra copy is the fraction and a source misses its target by half a
    document at most. The walk is a running sum over range partitions, so a source of any size is spread over tasks.
    """
    table = targets(sizes)
    rate = F.when(F.col("source_size") > 0, F.least(F.lit(float(MOST_REPEATS)), F.col("target") / F.col("source_size"))).otherwise(0.0)
    named = _keyed(table.withColumn("whole", F.floor(rate)).withColumn("need", F.col("target") - F.col("whole") * F.col("source_size")))
    if small := table.count() <= BROADCAST_SOURCES:
        named = F.broadcast(named)
    walked = running(_keyed(sizes).select("_none", "_name", "draw", "size"), "size", "_none", "_name", "draw", before="_before", same="_same")
    starts = walked.groupBy("_none", "_name").agg(F.min("_before").alias("_start"))
    joined = walked.join(F.broadcast(starts) if small else starts, ["_none", "_name"]).join(named, ["_none", "_name"])
    within = (F.col("need") > 0) & (F.col("_before") - F.col("_start") + F.col("_same") / 2 <= F.col("need"))
    last = joined.where(within).groupBy("_none", "_name").agg(F.max("draw").alias("last"))
    return scratch.write(named.join(last, ["_none", "_name"], "left").select("source", "source_size", "target", "whole", "last"), "rates")


def _keyed(rows: DataFrame) -> DataFrame:
    """Add ``_none, _name``: the source as a key under which null is a source as well, the last one."""
    return rows.withColumns({"_none": F.col("source").isNull().cast("int"), "_name": F.coalesce("source", F.lit(""))})


def _rated(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Join the sources' rates to rows of ``source, _draw``, as ``_source_size, _target, _copies``."""
    found = rates(sizes)
    right = _keyed(found).select("_none", "_name", F.col("source_size").alias("_source_size"), F.col("target").alias("_target"), F.col("whole").alias("_whole"), F.col("last").alias("_last"))
    if found.count() <= BROADCAST_SOURCES:
        right = F.broadcast(right)
    extra = F.coalesce(F.col("_draw") <= F.col("_last"), F.lit(False)).cast("long")
    return _keyed(rows).join(right, ["_none", "_name"]).withColumn("_copies", F.col("_whole") + extra)


def _sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), words(F.col(text_col)).alias("size"), _draw(F.col(id_col).cast("long"), F.col(text_col)).alias("draw"))
    return scratch.write(own, "sizes")


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """How often the mix takes each document: ``doc_id, source, size, source_size, target, copies, taken`` per row.

    copies is floor(rate) plus one with the fraction of the rate as probability, rate = target / source_size, drawn
    from a hash of id, text and a seed, so reruns agree; rows that repeat id and text have the same draw. Null or
    empty texts have size 0; a source without words has target 0 and no copies. An empty table gives no rows.
    """
    sizes = _sizes(docs, id_col, text_col, source_col)
    rated = _rated(sizes.withColumnRenamed("draw", "_draw"), sizes).withColumn("taken", F.col("size") * F.col("_copies"))
    return rated.select("doc_id", "source", "size", F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), F.col("_copies").alias("copies"), "taken")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed documents: every row of ``docs`` as often as ``plan`` takes it, with the same columns.

    Nulls, repeated rows and empty tables are taken as in ``plan``; columns of any name are kept as they are. Texts
    are not shuffled: the table of sources comes to the documents.
    """
    own = docs.select(F.struct("*").alias("_own"), F.col(source_col).cast("string").alias("source"), _draw(F.col(id_col).cast("long"), F.col(text_col)).alias("_draw"))
    taken = _rated(own, _sizes(docs, id_col, text_col, source_col)).where("_copies > 0")
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_own.*")


ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, sha256(coalesce(text, '')) AS digest FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1)::DOUBLE AS weight FROM s),
r AS (SELECT *, {MOST_REPEATS}.0::DOUBLE * source_size AS cap, row_number() OVER (ORDER BY {MOST_REPEATS}.0 * source_size / weight, source NULLS LAST) AS k FROM w),
c AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
      sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight, sum(source_size) OVER () AS whole FROM r),
l AS (SELECT arg_min((whole - used) / open_weight, k) FILTER (WHERE (whole - used) / open_weight <= cap / weight) AS level FROM c),
t AS (SELECT source, source_size, least(cap, level * weight) AS target FROM c, l),
p AS (SELECT d.doc_id, d.source, d.size, t.source_size, t.target,
      floor(CASE WHEN t.source_size > 0 THEN least({MOST_REPEATS}.0::DOUBLE, t.target / t.source_size) ELSE 0.0 END) AS whole,
      ('0x' || substr(sha256(coalesce(d.doc_id::VARCHAR, 'null') || '|{SEED}|' || d.digest), 1, 13))::BIGINT::DOUBLE / {1 << 52} AS draw
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
g AS (SELECT source, draw, any_value(target - whole * source_size) AS need, sum(size) AS same FROM p GROUP BY source, draw),
b AS (SELECT *, coalesce(sum(same) OVER (PARTITION BY source ORDER BY draw ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g),
h AS (SELECT source, max(draw) AS last FROM b WHERE need > 0 AND before + same / 2 <= need GROUP BY source)
SELECT doc_id, size, source_size, target, (size * (whole + coalesce(draw <= last, false)::INT))::BIGINT AS taken FROM p LEFT JOIN h ON p.source IS NOT DISTINCT FROM h.source
"""
