"""Ranked lexical search of documents for a table of queries, over impact vectors in buckets by norm."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quadspark.llm import scratch
from quadspark.llm.ordering import partitions, ranked, running

TOP_K = 50
#: Terms of the queries that go over the documents together; a block holds so many and one query's more at most.
BLOCK_TERMS = 200_000
#: Documents of a bucket of near norms, and numbers that the best of many tasks are dealt by before they meet.
BUCKET, SALTS = 1024, 32
#: Bytes of text that are cut into terms at once, and entries of a bucket unless one document has more.
WINDOW, MOST_ENTRIES = 1 << 20, 1 << 21
#: Terms of a query are looked at by falling weight until those left hold so much of its squared norm.
REST = 0.25
#: What rounding may take off a bound.
SLACK = 1.0 + 1e-9

#: Bytes to themselves, capitals to small letters, all other ASCII but digits to spaces; bytes of longer characters stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: bytes | None, window: int = WINDOW) -> Iterator[list[bytes]]:
    """Terms of a UTF-8 text: runs of letters, digits and characters beyond ASCII; only A-Z are lower-cased.

    They come in lists, so that those of a very long text are never there at once.
    """
    folded, at = (text or b"").translate(_FOLD), 0
    while at < len(folded):
        stop = folded.find(b" ", at + window)
        stop = len(folded) if stop < 0 else stop
        yield folded[at:stop].split()
        at = stop


# Queries


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sorted({t for some in terms(text) for t in some}) for text in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.binary())), pa.array([len(f) for f in found], pa.int64())], names=["number", "terms", "n_terms"])


def _blocks(queries: DataFrame, item_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Queries as ``number, item_id`` and their distinct terms as ``number, terms, block``."""
    own = queries.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    own = scratch.write(ranked(own, F.col("item_id").isNull(), F.col("item_id"), F.col("text"), name="number"), "queries")
    cut = own.select("number", "text").mapInArrow(_asked, "number long, terms array<binary>, n_terms long")
    sums = running(cut, "n_terms", "number", before="before", same="same")
    return own.select("number", "item_id"), scratch.write(sums.select("number", "terms", F.floor(F.col("before") / BLOCK_TERMS).alias("block")), "terms")


# Documents as bags of the terms that are asked for


def _bags(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                lengths, codes, times = [], [], []
                for text in part.column(2):
                    n, hits = 0, Counter()
                    for some in terms(text.as_py()):
                        n += len(some)
                        hits.update(filter(known.__contains__, some))
                    lengths.append(n)
                    codes.append([known[t] for t in hits])
                    times.append(list(hits.values()))
                made = [part.column(0), part.column(1), pa.array(lengths, pa.int64()), pa.array(codes, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(made, names=["read", "doc_id", "n", "codes", "times"]).filter(pa.array([n > 0 for n in lengths]))

    return run


@dataclass(frozen=True)
class Corpus:
    """Documents with a term, all their terms, and the weight of each code."""

    documents: int
    length: int
    weights: np.ndarray

    def impacts(self, times: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Whole-number impact of a term by its occurrences and its document's length."""
        m = 100 - 50 + (50 * lengths * self.documents) // max(1, self.length)
        return (1_000_000_000 * times) // (1000 * times + 20 * m)


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _cut(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    """Slices of so many rows at most and of MOST_ENTRIES entries unless one row has more."""
    ends = batch.column(batch.schema.get_field_index("codes")).offsets.to_numpy()
    at = 0
    while at < batch.num_rows:
        stop = min(at + rows, max(at + 1, int(np.searchsorted(ends, ends[at] + MOST_ENTRIES, side="right")) - 1))
        yield batch.slice(at, stop - at)
        at = stop


def _vectors(batch: pa.RecordBatch, corpus: Corpus) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, code and impact of every entry, and the squared norm of every row."""
    column = batch.column(batch.schema.get_field_index("codes"))
    sizes = np.diff(column.offsets.to_numpy())
    rows = np.repeat(np.arange(batch.num_rows), sizes)
    codes = column.flatten().to_numpy(zero_copy_only=False)
    times = batch.column(batch.schema.get_field_index("times")).flatten().to_numpy(zero_copy_only=False)
    x = corpus.impacts(times, batch.column(batch.schema.get_field_index("n")).to_numpy(zero_copy_only=False)[rows])
    squares = corpus.weights[codes] * x.astype(float) ** 2
    return rows, codes, x, np.bincount(rows, weights=squares, minlength=batch.num_rows)


def _normed(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _cut(batch, batch.num_rows):
                norms = np.sqrt(_vectors(part, held.value)[3])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(norms)], names=[*part.schema.names, "norm"])

    return run


# Search


@dataclass(frozen=True)
class Query:
    """A query's number and its codes and weights, heaviest first; ``focus`` of them are looked at for the bound."""

    number: int
    codes: np.ndarray
    weights: np.ndarray
    focus: int
    norm: float
    rest: float


def _query(number: int, codes: list[int], corpus: Corpus) -> Query:
    own = np.array(sorted(codes, key=lambda c: (-corpus.weights[c], c)), dtype=np.int64)
    weights = corpus.weights[own]
    left = weights.sum() - np.cumsum(weights)
    focus = int(np.searchsorted(-left, -REST * weights.sum())) + 1 if len(own) else 0
    return Query(number, own, weights, focus, math.sqrt(weights.sum()), float(left[focus - 1]) if focus else 0.0)


class Best:
    """The best documents of one query so far, and the score that another must reach."""

    def __init__(self, k: int, least: int):
        self.k, self.least = k, least
        self.scores, self.last, self.ids = np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64)

    def add(self, scores: np.ndarray, last: np.ndarray, ids: np.ndarray) -> None:
        scores, last, ids = np.append(self.scores, scores), np.append(self.last, last), np.append(self.ids, ids)
        order = np.lexsort((ids, last, -scores))[: self.k]
        self.scores, self.last, self.ids = scores[order], last[order], ids[order]
        if len(order) == self.k:
            self.least = max(self.least, int(self.scores[-1]))


def _search_bucket(bucket: pa.RecordBatch, corpus: Corpus, queries: list[Query], best: dict[int, Best]) -> list[Query]:
    """Search one bucket, whose documents have falling norms; returns the queries that later buckets may still serve."""
    rows, codes, x, squares = _vectors(bucket, corpus)
    order = np.argsort(codes, kind="stable")
    rows, codes, x = rows[order], codes[order], x[order]
    own, starts = np.unique(codes, return_index=True)
    ends = np.append(starts[1:], len(codes))
    place = {int(c): i for i, c in enumerate(own)}
    most = np.maximum.reduceat(x, starts) if len(own) else x
    ids = bucket.column(bucket.schema.get_field_index("doc_id"))
    last = ids.is_null().to_numpy(zero_copy_only=False)
    ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
    longest = math.sqrt(squares.max())
    left = []
    for q in queries:
        top = best[q.number]
        # By Cauchy and Schwarz no document of this bucket, or of a later one, scores more than this.
        if q.norm * longest * SLACK < top.least:
            continue
        left.append(q)
        there = [(place[int(c)], int(w), i < q.focus) for i, (c, w) in enumerate(zip(q.codes, q.weights, strict=True)) if int(c) in place]
        if not there:
            continue
        focus = [(p, w) for p, w, first in there if first]
        others = sum(w * int(most[p]) for p, w, first in there if not first)
        seen, part = np.zeros(len(squares)), np.zeros(len(squares))
        for p, w in focus:
            at = rows[starts[p] : ends[p]]
            value = x[starts[p] : ends[p]].astype(float)
            seen[at] += w * value
            part[at] += w * value * value
        # What the other coordinates can add: by the norms that are left, and by their greatest impacts here.
        bound = seen + np.minimum(np.sqrt(q.rest * np.maximum(squares * SLACK - part, 0.0)), float(others))
        wanted = bound * SLACK >= max(top.least, 1)
        if not wanted.any():
            continue
        scores = np.zeros(len(squares), np.int64)
        for p, w, _ in there:
            scores[rows[starts[p] : ends[p]]] += w * x[starts[p] : ends[p]]
        found = np.flatnonzero(wanted & (scores > 0) & (scores >= top.least))
        if len(found):
            top.add(scores[found], last[found], ids[found])
    return left


def _search(held, k: int, rows: int):
    """Search the buckets of a partition whose documents come by falling norm."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus, queries, least = held.value
        best = {q.number: Best(k, least.get(q.number, 0)) for q in queries}
        for batch in batches:
            for bucket in _cut(batch, rows):
                if queries:
                    queries = _search_bucket(bucket, corpus, queries, best)
        for number, top in best.items():
            if len(top.ids):
                ids = pa.array(top.ids, pa.int64(), mask=top.last)
                yield pa.RecordBatch.from_arrays([pa.array([number] * len(top.ids), pa.int64()), ids, pa.array(top.scores)], names=["number", "doc_id", "score"])

    return run


_FOUND = "number long, doc_id long, score long"


def _best(found: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy("number", *by).orderBy(F.desc("score"), F.col("doc_id").isNull(), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _block(spark: SparkSession, docs: DataFrame, asked: list, k: int, bucket: int) -> DataFrame:
    """The best of all documents for the queries of one block: ``number, doc_id, score``, k for each at most per task."""
    vocabulary = {t: i for i, t in enumerate(sorted({bytes(t) for row in asked for t in row.terms}))}
    words = spark.sparkContext.broadcast(vocabulary)
    bags = scratch.write(docs.mapInArrow(_bags(words), "read long, doc_id long, n long, codes array<int>, times array<long>"), "bags")
    documents, length = bags.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = dict(bags.select(F.explode("codes").alias("code")).groupBy("code").count().collect())
    corpus = Corpus(documents, length, np.array([weight(documents, holding.get(c, 0)) for c in range(len(vocabulary))], dtype=np.int64))
    queries = [_query(row.number, [vocabulary[bytes(t)] for t in row.terms], corpus) for row in asked]

    held = spark.sparkContext.broadcast(corpus)
    normed = bags.where("size(codes) > 0").mapInArrow(_normed(held), "read long, doc_id long, n long, codes array<int>, times array<long>, norm double")
    dealt = normed.repartitionByRange(partitions(bags), F.desc("norm"), F.col("read")).sortWithinPartitions(F.desc("norm"), "read")
    vectors = scratch.write(dealt.withColumn("part", F.spark_partition_id()), "vectors")
    scratch.discard(bags)
    own = ["doc_id", "n", "codes", "times"]
    # The longest vectors tell what the others must reach.
    seeds = spark.sparkContext.broadcast((corpus, queries, {}))
    first = scratch.write(vectors.where("part = 0").select(*own).mapInArrow(_search(seeds, k, bucket), _FOUND), "found")
    least = {r.number: r.score for r in _best(first, k).where(F.col("rank") == k).select("number", "score").collect()}
    rest = spark.sparkContext.broadcast((corpus, queries, least))
    return first.unionByName(scratch.write(vectors.where("part > 0").select(*own).mapInArrow(_search(rest, k, bucket), _FOUND), "found"))


def search(docs: DataFrame, queries: DataFrame, k: int = TOP_K, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", query_col: str = "text", bucket: int = BUCKET) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``k`` best documents of each row of ``queries``.

    A document's score is the sum of weight times impact over the query's distinct terms, in whole numbers; documents
    of equal score come by id, null last, and those of score 0 not at all. Null and empty texts have no terms: such a
    document counts nowhere, such a query has no results. Rows that repeat an id, of documents or queries, are ranked
    each for itself; other columns don't matter and an empty table gives no rows.

    Texts are read once per block of queries (see BLOCK_TERMS) and leave only occurrences of asked terms. Documents
    are then ordered by the norm of their impact vector over range partitions. The longest ones are searched first;
    after that a bucket is skipped for a query if the product of norms can't reach the k-th best score so far, and
    inside a bucket only documents whose bound by coordinates reaches it are scored.
    """
    spark = docs.sparkSession
    own = docs.select(F.monotonically_increasing_id().alias("read"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    items, cut = _blocks(queries, item_col, query_col)
    found = spark.createDataFrame([], _FOUND)
    for (block,) in cut.where("size(terms) > 0").select("block").distinct().orderBy("block").collect():
        asked = cut.where((F.col("block") == block) & (F.size("terms") > 0)).collect()
        found = found.unionByName(_block(spark, own, asked, k, bucket))
    dealt = _best(found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS))), k, "salt").drop("salt", "rank")
    return _best(dealt, k).join(items, "number").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_TERM}') AS terms FROM documents),
q AS (SELECT item_id, unnest(list_distinct(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_TERM}'))) AS term FROM benchmark),
size AS (SELECT count(*)::BIGINT AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d WHERE len(terms) > 0),
p AS (SELECT doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM d),
tf AS (SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM p WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, size GROUP BY term, n_docs),
s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score FROM q JOIN tf USING (term) JOIN w USING (term), size GROUP BY item_id, doc_id),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= {TOP_K}
"""
