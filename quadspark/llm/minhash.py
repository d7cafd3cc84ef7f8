"""Near-duplicate documents by min-max hashing, banding and exact confirmation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadspark.llm import scratch
from quadspark.llm.components import components
from quadspark.llm.recent import Recent

#: A shingle has so many words; documents link from this similarity in hundredths.
SHINGLE_WORDS, SIMILARITY = 5, 75
#: Each permutation gives two values, the minimum and the maximum. A band holds ROWS of them from different
#: permutations: a pair at similarity 0.75 shares one with probability 0.1 and misses all with about 3e-5, at 0.8
#: with less than 1e-7; a pair that has a passage in common, at 0.25, shares any with probability 0.002.
PERMUTATIONS, BANDS, ROWS = 128, 128, 8
#: Rounds that compare the members of a bucket with one of them; then members of one block of a larger bucket.
LEADER_ROUNDS, BLOCK = 2, 1024
#: Shingles of the members of one block, so a cell is bounded in bytes as well: two blocks are 32 MB of hashes.
BLOCK_SHINGLES = 2_000_000
#: Partners of one leader that are one share of work; numbers that a large leader's pairs are dealt by before.
PARTNERS, DEALS = 4096, 64

_STEP = 2048


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit affects every output bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class _Words(Recent):
    """Hashes of words."""

    def make(self, word: bytes) -> int:
        return xxhash.xxh3_64_intdigest(word)


_WORDS = _Words()
_RNG = np.random.default_rng(20_240_501)
_MULTIPLY = _RNG.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _RNG.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)
_PLACE = _RNG.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: For every band, which values of the signature it holds: 2 k is the minimum and 2 k + 1 the maximum of the k-th.
_HELD = np.array([2 * _RNG.permutation(PERMUTATIONS)[:ROWS] + _RNG.integers(0, 2, ROWS) for _ in range(BANDS)])


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text, A-Z lower-cased.

    With fewer words than a shingle has, the whole sequence is the one shingle; without words the set is empty.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    width = min(SHINGLE_WORDS, len(ids))
    total = np.full(len(ids) - width + 1, width, np.uint64)
    for k in range(width):
        total += _mix(ids[k : len(ids) - width + 1 + k]) * _PLACE[k]
    return np.unique(_mix(total))


def signature(hashes: np.ndarray) -> np.ndarray:
    """Minimum and maximum of the set under every permutation, one row per permutation."""
    low = np.full(len(_MULTIPLY), np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(len(_MULTIPLY), np.uint64)
    for at in range(0, len(hashes), _STEP):
        moved = (hashes[at : at + _STEP, None] ^ _FLIP) * _MULTIPLY
        np.minimum(low, moved.min(axis=0), out=low)
        np.maximum(high, moved.max(axis=0), out=high)
    return np.stack([low, high], axis=1)


def bands(hashes: np.ndarray) -> np.ndarray:
    """One signed 64-bit bucket key per band."""
    rows = signature(hashes).ravel()[_HELD]
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(rows.shape[1]):
        key = _mix(key + rows[:, k] * _PLACE[k + 8])
    return key.view(np.int64)


_SIGNED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("bands", pa.list_(pa.int64()))])


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            n, digest, keys = [], [], []
            for text in part.column(1):
                found = shingles(text.as_py())
                n.append(len(found))
                digest.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                keys.append(bands(found) if len(found) else None)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], schema=_SIGNED)


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, digest, bands`` of every row; digest and bands are null for an empty set."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return own.mapInArrow(_signed, "doc_id long, n_shingles long, digest binary, bands array<long>")


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare partners with the leader whose row stands before theirs; one batch and one set are held at a time."""
    at, own = None, np.empty(0, np.uint64)
    for batch in batches:
        a, b = [], []
        for lead, variant, share, partner, text in zip(*(column.to_pylist() for column in batch.columns[:4]), batch.column(4), strict=True):
            found = shingles(text.as_py())
            if partner is None:
                at, own = (lead, variant, share), found
                continue
            if at != (lead, variant, share):
                raise ValueError(f"no text of document {lead}")
            both = len(np.intersect1d(own, found, assume_unique=True))
            if 100 * both >= SIMILARITY * (len(own) + len(found) - both):
                a.append(lead)
                b.append(partner)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full shingle sets reach the similarity; ``texts`` has doc_id, variant and text.

    A text stands once before all its partners, which are read in order and never held together. Leaders of more than
    PARTNERS pairs are dealt over shares of so many, so none is one task. An id of several texts, told apart by
    ``variant``, is compared by each of them.
    """
    counts = pairs.groupBy("a").agg(F.ceil(F.count("*") / PARTNERS).cast("int").alias("shares"))
    several = texts.groupBy("doc_id").agg(F.min("variant").alias("low"), F.max("variant").alias("high")).where("low != high").select(F.col("doc_id").alias("a"))
    variants = texts.select(F.col("doc_id").alias("a"), "variant").join(several, "a", "left_semi").distinct()
    special = counts.where("shares > 1").join(variants, "a", "full").select("a", F.coalesce("shares", F.lit(1)).alias("shares"), "variant")
    special = special.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(DEALS - 1))))
    deal = F.pmod(F.xxhash64("b"), F.lit(DEALS)).cast("int").alias("deal")
    share = F.pmod(F.xxhash64("b", F.lit(1)), F.coalesce("shares", F.lit(1))).cast("int").alias("share")
    dealt = pairs.select("a", "b", deal).join(special, ["a", "deal"], "left").select("a", "variant", share, "b")
    partners = dealt.join(texts.select(F.col("doc_id").alias("b"), "text"), "b").select("a", "variant", "share", "b", "text")
    leaders = texts.withColumnRenamed("doc_id", "a").join(counts, "a").join(several.withColumn("several", F.lit(True)), "a", "left")
    leaders = leaders.select("a", F.when(F.col("several"), F.col("variant")).alias("variant"), F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.lit(None).cast("long").alias("b"), "text")
    rows = leaders.unionByName(partners).repartition("a", "variant", "share")
    return rows.sortWithinPartitions("a", "variant", "share", F.asc_nulls_first("b")).mapInArrow(_confirmed, "a long, b long")


def _close(a: str, b: str) -> str:
    """Sets whose sizes differ too much can't reach the similarity."""
    return f"100 * least({a}, {b}) >= {SIMILARITY} * greatest({a}, {b})"


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Intersection size of every two sets."""
    terms, at = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    seen = np.bincount(at)
    at, owner = at[keep := seen[at] > 1], owner[keep]  # terms of one set meet no other
    total = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    column = np.cumsum(np.concatenate([[0], at[1:] != at[:-1]])) if len(at) else at
    for first in range(0, int(column[-1]) + 1 if len(at) else 0, 4096):
        here = slice(*np.searchsorted(column, (first, first + 4096)))
        part = np.zeros((len(sets), 4096), np.float32)
        part[owner[here], column[here] - first] = 1
        total += part @ part.T
    return total


_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _todo(table: pa.Table) -> np.ndarray:
    """Which members of a cell, a bucket or two blocks of it, are to be compared: different components, likely sizes.

    A pair that shares several buckets is compared in the first of them alone, the largest; ``earlier`` are those
    that stand before this one.
    """
    low, high = (table.column(c)[0].as_py() for c in ("low", "high"))
    part, block, n = (table.column(c).to_numpy() for c in ("component", "block", "n"))
    todo = part[:, None] != part[None, :]
    todo &= 100 * np.minimum.outer(n, n) >= SIMILARITY * np.maximum.outer(n, n)
    if low != high:
        todo &= block[:, None] != block[None, :]
    used = np.flatnonzero(todo.any(axis=1))
    if len(used):
        earlier = table.column("earlier").take(pa.array(used))
        todo[np.ix_(used, used)] &= _overlaps([own.values.to_numpy() for own in earlier]) == 0
    return todo


def _needed(table: pa.Table) -> pa.Table:
    """The members of a cell that have anything to be compared with there."""
    return table.filter(pa.array(_todo(table).any(axis=1)))


def _celled(table: pa.Table) -> pa.Table:
    """Compare the members of a cell; emit star edges."""
    table = table.sort_by("rep")
    todo, rep = _todo(table), table.column("rep").to_numpy()
    used = np.flatnonzero(todo.any(axis=1))
    if not len(used):
        return _LINK.empty_table()
    todo, rep = todo[np.ix_(used, used)], rep[used]
    sets = [shingles(t) for t in table.column("text").take(pa.array(used)).to_pylist()]
    both, n = _overlaps(sets), np.array([len(s) for s in sets])
    close = todo & (100 * both >= SIMILARITY * (n[:, None] + n[None, :] - both))
    top = np.arange(len(rep))
    while True:
        least = np.minimum(top, np.where(close, top[None, :], len(rep)).min(axis=1))
        least = least[least]
        if (least == top).all():
            break
        top = least
    moved = top != np.arange(len(rep))
    return pa.Table.from_arrays([pa.array(rep[top][moved], pa.int64()), pa.array(rep[moved], pa.int64())], schema=_LINK)


def confirm_cells(left: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) that join components within the buckets of ``left`` (key, rep, n, component); no pair is emitted.

    A bucket of one block is one cell. In a larger one the largest component is not compared with itself: its members
    go to blocks of their own, which meet the blocks of the others only, so a stray member beside a large group costs
    as much as the group is long. Cells are first formed of ids and sizes; a text goes only to those where it has
    something to be compared with. Buckets stand in one order, the largest first, and a pair counts in the first that
    it shares, so pairs of a large group gather in few buckets and a text goes to few of those that it is in. A
    document's buckets, one per band at most, are gathered and dealt out again with those that stand before each.
    """
    parts = left.groupBy("key", "component").agg(F.count("*").alias("m"), F.sum("n").alias("shingles"))
    sizes = parts.groupBy("key").agg(F.max(F.struct("m", "component", "shingles")).alias("top"), F.sum("m").alias("all"), F.sum("shingles").alias("shingles"))
    blocks = lambda count, shingles: F.greatest(F.ceil(count / BLOCK), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")
    split = (F.col("all") > BLOCK) | (F.col("shingles") > BLOCK_SHINGLES)
    apart, long = F.when(split, F.col("top.m")).otherwise(0), F.when(split, F.col("top.shingles")).otherwise(0)
    outer = F.when(F.col("all") > apart, blocks(F.col("all") - apart, F.col("shingles") - long)).otherwise(0)
    sizes = sizes.select("key", "all", F.when(split, F.col("top.component")).alias("top"), blocks(apart, long).alias("inner"), outer.alias("outer"))
    own, deal = F.coalesce(F.col("component") == F.col("top"), F.lit(False)), F.xxhash64("rep")
    block = F.when(own, F.col("outer") + F.pmod(deal, "inner")).otherwise(F.pmod(deal, "outer")).cast("int").alias("block")
    meets = (F.col("outer") + F.when(own, 0).otherwise(F.col("inner"))).alias("meets")
    place = F.struct((-F.col("all")).alias("order"), "key", block, meets)
    places = left.join(sizes, "key").groupBy("rep", "n", "component").agg(F.sort_array(F.collect_list(place)).alias("places"))
    placed = places.select("rep", "n", "component", F.col("places.key").alias("keys"), F.posexplode("places").alias("at", "place"))
    placed = placed.select("rep", "n", "component", "place.*", F.slice("keys", 1, F.col("at")).alias("earlier"))
    cells = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("meets") - 1)))
    cells = cells.select("key", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"), "block", "rep", "n", "component", "earlier")
    used = cells.groupBy("key", "low", "high").applyInArrow(_needed, cells.schema)
    return used.join(texts.select(F.col("doc_id").alias("rep"), "text"), "rep").groupBy("key", "low", "high").applyInArrow(_celled, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Link documents of similar shingle sets and name each one's group.

    Returns ``doc_id, n_shingles, component_id, kept`` for every row. Null or empty texts link with nothing.
    Rows that repeat an id are judged each by its own text; a null id has a null component and is kept. Extra columns of
    ``docs`` don't matter. An empty table gives an empty result.

    Equal sets are one class first. Band buckets of classes then give pairs: every member with the smallest id of
    its bucket, then, in buckets whose members are not yet one component, with a random member. At last members of
    a bucket that are still in different components are compared block by block inside tasks, which emit star
    edges only. Every link is confirmed on the full sets, and no bucket has a cap.
    """
    signed = scratch.write(signatures(docs, id_col, text_col), "signed")
    classes = signed.where("digest is not null and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"))
    classes = scratch.write(classes, "classes")
    chosen = signed.withColumnRenamed("doc_id", "rep").join(classes, ["digest", "rep"])
    chosen = scratch.write(chosen.select("rep", F.col("n_shingles").alias("n"), "bands"), "chosen")
    sized = scratch.write(signed.select("doc_id", "n_shingles", "digest"), "sized")
    scratch.discard(signed)
    members = chosen.select("rep", "n", F.explode("bands").alias("key"))
    shared = members.groupBy("key").agg(F.min("rep").alias("lead"), F.max("rep").alias("last")).where("lead != last")
    buckets = scratch.write(members.join(shared.select("key", "lead"), "key").distinct(), "buckets")
    scratch.discard(chosen)

    wanted = buckets.select(F.col("rep").alias("doc_id")).distinct()
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("text is not null")
    texts = scratch.write(own.join(wanted, "doc_id", "left_semi").select("doc_id", F.xxhash64("text").alias("variant"), "text"), "texts")

    size = buckets.select(F.col("rep").alias("lead"), F.col("n").alias("lead_n")).distinct()
    pairs = buckets.where("rep != lead").select(F.col("lead"), "rep", "n").distinct().join(size, "lead").where(_close("n", "lead_n"))
    tested = scratch.write(pairs.select(F.col("lead").alias("a"), F.col("rep").alias("b")).distinct(), "pairs")
    links = scratch.write(confirm(tested, texts), "links")
    groups = scratch.write(components(links), "groups")

    for turn in range(1, LEADER_ROUNDS + 1):
        named = buckets.join(groups.withColumnRenamed("node", "rep"), "rep", "left").select("key", "rep", "n", F.coalesce("component", "rep").alias("component"))
        mixed = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min_by(F.struct("rep", "n", "component"), F.xxhash64("rep", "key", F.lit(turn))).alias("lead")).where("low != high")
        left = scratch.write(named.join(mixed.select("key", "lead"), "key"), "mixed")
        if turn < LEADER_ROUNDS:
            pairs = left.where("component != lead.component").where(_close("n", "lead.n")).select(F.least("rep", "lead.rep").alias("a"), F.greatest("rep", "lead.rep").alias("b"))
            found = confirm(pairs.distinct().join(tested, ["a", "b"], "left_anti"), texts)
        else:
            found = confirm_cells(left.drop("lead"), texts)
        more = scratch.write(found, "links")
        if not more.isEmpty():
            groups = scratch.write(components(more.union(groups.select(F.col("node").alias("a"), F.col("component").alias("b")))), "groups")

    named = classes.select("digest", "rep").join(groups.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("digest", F.coalesce("component", "rep").alias("component_id"))
    joined = sized.join(named, "digest", "left")
    group = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return joined.select("doc_id", "n_shingles", group.alias("component_id"), F.coalesce(F.col("doc_id") == group, F.lit(True)).alias("kept"))
