"""Patches, imports and transactions as pure functions of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quadspark.functions.terms import COLUMNS
from quadspark.operators.match import QuadFilter


def present(ids: DataFrame, quads: DataFrame) -> DataFrame:
    """Those of ``ids`` (quad_id) that are stored."""
    return ids.select("quad_id").distinct().join(quads, "quad_id", "left_semi")


def delete_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows (quads or chunks) without those of the given quads."""
    return rows.join(ids.select("quad_id"), "quad_id", "left_anti")


def commit_patch(current: DataFrame, insertions: DataFrame, deletions: DataFrame, keep: QuadFilter | None = None) -> tuple[DataFrame, DataFrame]:
    """Delete, then insert what is new; returns the next state and the novel quads.

    A filter drops both sides of the patch outside of it. A quad that is stored, deleted and inserted in one patch
    stays and counts as novel; repeats collapse by id. Applying a patch twice gives the same state.
    """
    if keep is not None:
        insertions, deletions = keep.apply(insertions), keep.apply(deletions)
    left = delete_ids(current, deletions)
    novel = insertions.select(*COLUMNS).dropDuplicates(["quad_id"]).join(left.select("quad_id"), "quad_id", "left_anti").select(*COLUMNS)
    return left.select(*COLUMNS).unionByName(novel), novel


def add(current: DataFrame, quads: DataFrame) -> DataFrame:
    """Upsert by id."""
    return commit_patch(current, quads, quads.limit(0))[0]


def remove(current: DataFrame, quads: DataFrame) -> DataFrame:
    return delete_ids(current, quads)


def replace(insertions: DataFrame, keep: QuadFilter | None = None) -> DataFrame:
    """A replace import: the insertions alone."""
    rows = keep.apply(insertions) if keep is not None else insertions
    return rows.select(*COLUMNS).dropDuplicates(["quad_id"])


def wipe(current: DataFrame) -> DataFrame:
    return current.limit(0)


def net_effect(log: DataFrame) -> DataFrame:
    """Net operation per quad of an ordered log (seq, op 'add' or 'delete', quad columns): rows with ``op``.

    The last two operations of a quad decide: a last add inserts, an add and then a delete nets to nothing, and any
    other last delete deletes. At equal ``seq`` deletions come before insertions.
    """
    order = Window.partitionBy("quad_id").orderBy("seq", F.desc("op"))
    last = log.select("*", F.lag("op").over(order).alias("_before"), F.lead("op").over(order).isNull().alias("_last")).where("_last")
    return last.where("op = 'add' or coalesce(_before, 'delete') = 'delete'").drop("_before", "_last", "seq")


def commit_log(current: DataFrame, log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Apply a transaction's log."""
    net = net_effect(log)
    return commit_patch(current, net.where("op = 'add'"), net.where("op = 'delete'"))
