"""Near-duplicate vectors by a forest of random-projection trees with spill, exact confirmation and union."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadspark.llm import scratch
from quadspark.llm.components import components

#: Vectors of one label link from this cosine.
COSINE = 0.93
#: A leaf of more vectors is split; rows of one block of a leaf that can't be; vectors of a leaf that its splits are
#: learned from, and those of them that a further split needs.
LEAF, BLOCK, SAMPLE, LEAST = 400, 1024, 8192, 48
#: All widths are in units of what a pair at COSINE differs by along a direction (its standard deviation). A vector
#: within SPILL of a cut goes both ways. A cut may have at most CROWDED of the vectors within 1 of it, else it would
#: part vectors that link with each other, as in a group of near-copies, which stays one leaf.
SPILL, CROWDED = 0.15, 0.5
#: Part of the pairs at COSINE that all trees together may miss; pairs above it are missed far more seldom.
MISSED = 0.002
#: Bytes of splits up to which they are broadcast.
BROADCAST_SPLITS = 32 << 20
_SEED, _TRIES = 11, 4

# Of pairs at COSINE a cut parts _PARTED, and it doubles _DOUBLED of the vectors, if _NEAR of them are within 1 of it.
_NEAR = 0.35
_PARTED = _NEAR * (math.exp(-2 * SPILL**2) / math.sqrt(2 * math.pi) - SPILL * math.erfc(2 * SPILL / math.sqrt(2)))
_DOUBLED = _NEAR * SPILL


def trees(n: Column) -> Column:
    """How many trees keep the share of missed pairs below MISSED among ``n`` vectors: about n to the power of 0.2."""
    depth = F.ceil(F.greatest(F.lit(0.0), F.log(n / LEAF) / math.log(2 / (1 + _DOUBLED))))
    kept = F.pow(F.lit(1 - _PARTED), depth)
    return F.when(n <= LEAF, F.lit(1)).otherwise(F.ceil(F.log(F.lit(MISSED)) / F.log1p(-kept))).cast("int")


@lru_cache(4096)
def _direction(tree: int, depth: int, size: int) -> np.ndarray:
    way = np.random.default_rng([_SEED, tree, depth]).normal(size=size)
    return way / np.linalg.norm(way)


def _width(size: int) -> float:
    """Standard deviation of the difference of a pair at COSINE along a random direction."""
    return math.sqrt(2 * (1 - COSINE) / size)


def _cut(along: np.ndarray, width: float) -> float | None:
    """Where to cut values: between the quartiles if it is sparse enough there, else anywhere; None if it is nowhere."""
    values = np.sort(along)
    for low, high in ((0.25, 0.75), (0.05, 0.95)):
        at = values[np.unique(np.linspace(low * (len(values) - 1), high * (len(values) - 1), 33).astype(int))]
        near = np.searchsorted(values, at + width, "right") - np.searchsorted(values, at - width, "left")
        best = np.lexsort((np.abs(at - np.median(values)), near // max(1, len(values) // 50)))[0]
        if near[best] <= CROWDED * len(values) and values[0] < at[best] - SPILL * width and values[-1] > at[best] + SPILL * width:
            return float(at[best])
    return None


def _grow(unit: np.ndarray, share: float, tree: int, depth: int) -> list | int:
    """Splits learned from a sample of a leaf: [depth, cut, left, right], 0 where more rows may split further, 1 for good."""
    if len(unit) * share <= LEAF:
        return 1
    if len(unit) < LEAST:
        return 0
    width = _width(unit.shape[1])
    for at in range(depth, depth + _TRIES):
        along = unit @ _direction(tree, at, unit.shape[1])
        if (cut := _cut(along, width)) is not None:
            sides = unit[along <= cut + SPILL * width], unit[along >= cut - SPILL * width]
            return [at, cut, *[_grow(side, share, tree, at + 1) for side in sides]]
    return 1


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _units(vecs: list[bytes]) -> np.ndarray:
    return _unit(np.frombuffer(b"".join(vecs), "<f4").reshape(len(vecs), -1))


_SPLITS = pa.schema([("code", pa.int64()), ("splits", pa.string())])


def _learned(table: pa.Table) -> pa.Table:
    """Splits of one leaf from its sampled rows."""
    code, n, tree, depth = (table.column(c)[0].as_py() for c in ("code", "n", "tree", "depth"))
    splits = _grow(_units(sorted(table.column("vec").to_pylist())), n / table.num_rows, tree, depth)
    return pa.Table.from_arrays([pa.array([code]), pa.array([json.dumps(splits)])], schema=_SPLITS)


_PLACED = pa.schema([("cid", pa.int64()), ("code", pa.int64()), ("tree", pa.int32()), ("depth", pa.int32()), ("done", pa.bool_())])


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Send rows of leaves down the splits of these."""
    for batch in batches:
        if not batch.num_rows:
            continue
        cid, code, tree = (batch.column(c).to_numpy() for c in ("cid", "code", "tree"))
        vecs, order, ends = batch.column("vec").to_pylist(), np.argsort(code, kind="stable"), []
        for rows in np.split(order, np.flatnonzero(np.diff(code[order])) + 1):
            own, unit, t = int(code[rows[0]]), _units([vecs[i] for i in rows]), int(tree[rows[0]])
            todo = [(json.loads(batch.column("splits")[int(rows[0])].as_py()), np.arange(len(rows)), int(batch.column("depth")[int(rows[0])].as_py()), "")]
            while todo:
                node, at, depth, path = todo.pop()
                if not isinstance(node, int):
                    way, cut, left, right = node
                    along, slack = unit[at] @ _direction(t, way, unit.shape[1]), SPILL * _width(unit.shape[1])
                    todo += [(left, at[along <= cut + slack], way + 1, path + "0"), (right, at[along >= cut - slack], way + 1, path + "1")]
                elif len(at):
                    leaf = xxhash.xxh3_64_intdigest(f"{own}|{path}") >> 1 if path else own
                    ends.append((cid[rows[at]], leaf, t, depth, bool(node)))
        sizes = [len(e[0]) for e in ends]
        same = [pa.array(np.repeat(np.array([e[k] for e in ends]), sizes), _PLACED[k].type) for k in range(1, 5)]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([e[0] for e in ends]), pa.int64()), *same], schema=_PLACED)


def leaves(classes: DataFrame) -> DataFrame:
    """``cid, code`` of every leaf that a vector is in, from ``cid, label, size, vec``.

    A tree starts as one leaf per label and length. In each round every leaf that is still too large learns splits
    from a sample of its own rows, in a task of its own, and sends its rows down; a round makes leaves more than a
    hundred times smaller, so few rounds do at any size. Splits are broadcast up to a checked size, else joined. Rows
    of leaves compress to a byte or two, so Spark would take millions for a table to broadcast; joins of them are told
    not to.
    """
    counts = classes.groupBy("label", "size").agg(F.count("*").alias("n"))
    roots = classes.join(counts, ["label", "size"]).select("cid", "label", "size", F.explode(F.sequence(F.lit(0), trees(F.col("n")) - 1)).alias("tree"))
    found = scratch.write(roots.select("cid", F.xxhash64("label", "size", "tree").alias("code"), "tree", F.lit(0).alias("depth"), F.lit(False).alias("done")), "leaves")
    while True:
        large = found.where("not done").groupBy("code").agg(F.count("*").alias("n")).where(F.col("n") > LEAF)
        large = scratch.write(large, "large")
        if large.isEmpty():
            return found.select("cid", "code")
        few = large.count() <= BROADCAST_SPLITS // 100
        large = F.broadcast(large) if few else large.hint("merge")
        vecs = classes.select("cid", "vec").hint("merge")
        joined = found.where("not done").join(large, "code")
        chosen = joined.where(F.pmod(F.xxhash64("cid", "code"), F.lit(1 << 30)) < F.lit(float(SAMPLE << 30)) / F.col("n"))
        splits = chosen.join(vecs, "cid").groupBy("code").applyInArrow(_learned, "code long, splits string")
        splits = scratch.write(splits, "splits")
        size = splits.agg(F.coalesce(F.sum(F.length("splits")), F.lit(0))).first()[0]
        moved = found.where("not done").join(vecs, "cid").join(F.broadcast(splits) if size <= BROADCAST_SPLITS else splits.hint("merge"), "code")
        moved = moved.select("cid", "code", "tree", "depth", "vec", "splits").mapInArrow(_placed, "cid long, code long, tree int, depth int, done boolean")
        rest = found.join(large, "code", "left_anti")
        after = scratch.write(rest.select("cid", "code", "tree", "depth", "done").unionByName(moved), "leaves")
        scratch.discard(found)
        found = after


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes; null where a vector links with nothing."""
    for batch in batches:
        out = []
        for v in batch.column(1):
            if not v.is_valid or v.values.null_count:
                out.append(None)
                continue
            x = np.asarray(v.values, np.float32)
            out.append(x.astype("<f4").tobytes() if len(x) and np.isfinite(x).all() and x.any() else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(out, pa.binary()), pa.array([len(o) // 4 if o else None for o in out], pa.int32())], names=["vec_id", "label", "vec", "size"])


_FOUND = pa.schema([("cid", pa.int64()), ("links", pa.int64()), ("other", pa.int64())])


def _compared(table: pa.Table) -> pa.Table:
    """Compare the vectors of one cell: how much each gains in links, and star edges of what hangs together.

    A pair that shares several leaves counts in the one of smallest code alone. In a cell of two blocks only pairs
    across them are compared.
    """
    code, r, s = (table.column(c)[0].as_py() for c in ("code", "low", "high"))
    rep = table.column("cid").to_numpy()
    order = np.argsort(rep, kind="stable")
    table, rep = table.take(pa.array(order)), rep[order]
    weight, block = table.column("weight").to_numpy(), table.column("block").to_numpy()
    unit = _units(table.column("vec").to_pylist())
    close = unit @ unit.T >= COSINE
    np.fill_diagonal(close, False)
    if r != s:
        close &= block[:, None] != block[None, :]
    if not close.any():
        return _FOUND.empty_table()
    earlier = [np.array(c, np.int64) for c in table.column("codes").to_pylist()]
    known = {c: k for k, c in enumerate(sorted({int(x) for own in earlier for x in own[own < code]}))}
    counted = close
    if known:
        member = np.zeros((len(rep), len(known)), np.float32)
        for i, own in enumerate(earlier):
            member[i, [known[int(x)] for x in own[own < code]]] = 1
        counted = close & ~(member @ member.T > 0)
    gain = counted @ weight
    low = np.arange(len(rep))
    while True:
        least = np.minimum(low, np.where(close, low[None, :], len(rep)).min(axis=1))
        least = np.minimum(least, least[least])
        if (least == low).all():
            break
        low = least
    keep = (gain > 0) | (low != np.arange(len(rep)))
    return pa.Table.from_arrays([pa.array(rep[keep], pa.int64()), pa.array(gain[keep], pa.int64()), pa.array(rep[low][keep], pa.int64())], schema=_FOUND)


def near_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Link vectors of equal label by cosine: ``vec_id, n_links, component_id, kept`` for every row.

    Vectors that are null, empty, zero or hold null or non-finite components, or whose label or id is null, link
    with nothing; a null id has a null component and is kept. Vectors of different length don't link. Rows that
    repeat an id are vectors of their own. Other columns don't matter and an empty table gives no rows.

    Equal vectors are one class first, so a large group of copies is one vector with a weight. Each class goes to
    its leaves, leaves of more than BLOCK classes are compared in pairs of blocks, and a cell emits sums and star
    edges, never its pairs. Cosines are exact, in double precision.
    """
    own = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<float>").alias("v"), F.col(label_col).cast("long").alias("label"))
    read = own.mapInArrow(_read, "vec_id long, label long, vec binary, size int")
    usable = "vec is not null and label is not null and vec_id is not null"
    read = scratch.write(read.withColumn("digest", F.when(F.expr(usable), F.sha2("vec", 256))), "vectors")
    classes = read.where("digest is not null").groupBy("label", "digest").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"), F.first("size").alias("size"), F.first("vec").alias("vec"))
    classes = scratch.write(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    placed = leaves(classes.select("cid", "label", "size", "vec"))
    sizes = placed.groupBy("code").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), F.count("*").alias("n")).where("n > 1").select("code", "blocks")
    # Leaves get their blocks before the vectors join, which are then shipped to their cells only
    own = placed.join(sizes.hint("merge"), "code").groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("code", "blocks"))).alias("own"))
    cells = classes.select("cid", "weight", "label", "size", "vec").join(own.hint("merge"), "cid").withColumn("codes", F.col("own.code")).withColumn("leaf", F.explode("own"))
    cells = cells.select("cid", "weight", "label", "size", "vec", "codes", "leaf.code", "leaf.blocks")
    cells = cells.withColumn("block", F.pmod(F.xxhash64("cid"), "blocks").cast("int")).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = cells.select("code", "label", "size", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"), "block", "cid", "weight", "vec", "codes")
    found = scratch.write(cells.groupBy("code", "label", "size", "low", "high").applyInArrow(_compared, "cid long, links long, other long"), "found")
    groups = components(found.select(F.col("cid").alias("a"), F.col("other").alias("b"))).withColumnRenamed("node", "cid")
    groups = groups.join(classes.select("cid", "rep").hint("merge"), "cid")
    least = groups.groupBy("component").agg(F.min("rep").alias("least"))
    groups = groups.join(least, "component").select("cid", "least")
    gained = found.groupBy("cid").agg(F.sum("links").alias("links"))
    named = classes.select("label", "digest", "cid", "rep", "weight").join(gained.hint("merge"), "cid", "left").join(groups, "cid", "left")
    named = named.select("label", "digest", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("least", "rep").alias("component_id"))
    joined = read.select("vec_id", "label", "digest").join(named, ["label", "digest"], "left")
    group = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), group.alias("component_id"), F.coalesce(F.col("vec_id") == group, F.lit(True)).alias("kept"))
