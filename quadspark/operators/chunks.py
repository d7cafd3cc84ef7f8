"""The searchable chunks of literal text and their upkeep."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadspark.functions.terms import LITERAL, valid
from quadspark.functions.text import chunked
from quadspark.operators.match import QuadFilter
from quadspark.operators.patch import delete_ids

MOST_DIMENSIONS = 1536


def project(quads: DataFrame, splitter: Callable[[str], list[str]] | None = None, datatypes: tuple[str, ...] = (), whole: bool = False) -> DataFrame:
    """Chunks of the objects that are literals, of any datatype unless some are named; vectors stay null."""
    rows = quads.where(F.col("o_type") == LITERAL)
    if datatypes:
        rows = rows.where(F.coalesce("o_datatype", F.lit("")).isin(*datatypes))
    cut = rows.select("quad_id", F.col("s").alias("subject"), F.col("p").alias("predicate"), F.col("g").alias("graph"), "g_type", F.posexplode(chunked(F.col("o"), splitter, whole)).alias("pos", "value"))
    return cut.select(F.concat("quad_id", F.lit("#"), F.lpad(F.col("pos").cast("string"), 6, "0")).alias("chunk_id"), "quad_id", "pos", "subject", "predicate", "graph", "value", F.col("value").alias("fts_value"), F.lit(None).cast("array<float>").alias("vector"), "g_type")


def refresh(chunks: DataFrame, quads: DataFrame, splitter: Callable[[str], list[str]] | None = None, whole: bool = False) -> DataFrame:
    """Rebuild the chunks of the given quads."""
    return delete_ids(chunks, quads).unionByName(project(quads, splitter, whole=whole))


def reindex(quads: DataFrame, chunks: DataFrame | None = None, keep: QuadFilter | None = None, full: bool = False, splitter: Callable[[str], list[str]] | None = None, whole: bool = False) -> DataFrame:
    """Rebuild from stored quads. A filter refreshes what passes it and keeps the other live quads' chunks.

    ``full`` drops those as well. Rows that form no quad are skipped; chunks of quads that are gone never stay.
    """
    sound = quads.where(valid())
    fresh = project(keep.apply(sound) if keep else sound, splitter, whole=whole)
    if keep is None or full or chunks is None:
        return fresh
    others = sound.select("quad_id").join(keep.apply(sound).select("quad_id"), "quad_id", "left_anti")
    return chunks.join(others, "quad_id", "left_semi").select(*fresh.columns).unionByName(fresh)


def report(quads: DataFrame, keep: QuadFilter | None = None, splitter: Callable[[str], list[str]] | None = None, whole: bool = False) -> DataFrame:
    """One row of a reindex's counts: all readable quads, filtered out or not, and chunks written."""
    used = F.col("o_type") == LITERAL
    if keep is not None:
        used = used & F.coalesce(keep.column(), F.lit(False))
    cut = F.size(chunked(F.when(used, F.col("o")), splitter, whole))
    return quads.where(valid()).agg(F.count("*").alias("processed_quads"), F.coalesce(F.sum(F.when(used, cut)), F.lit(0)).cast("long").alias("chunk_rows"))


def follow_commit(chunks: DataFrame, state: DataFrame, novel: DataFrame, policy: str = "deferred", importing: bool = False, whole: bool = False) -> DataFrame:
    """Chunks after a commit. 'incremental' adds those of novel quads, 'deferred' rebuilds after imports and adds
    after other commits, 'disabled' leaves them alone."""
    if policy not in ("incremental", "deferred", "disabled"):
        raise ValueError(policy)
    if policy == "disabled":
        return chunks
    if policy == "deferred" and importing:
        return reindex(state, whole=whole)
    return refresh(chunks.join(state.select("quad_id"), "quad_id", "left_semi"), novel, whole=whole)


def check_dimensions(dimensions: float) -> int:
    """A whole number from 1 to MOST_DIMENSIONS; fractions are cut off."""
    if not dimensions == dimensions or not 1 <= int(dimensions) <= MOST_DIMENSIONS:
        raise ValueError(f"vector dimensions must be from 1 to {MOST_DIMENSIONS}")
    return int(dimensions)


def wrong_vectors(chunks: DataFrame, dimensions: int) -> DataFrame:
    """Chunks whose vector has another length."""
    return chunks.where(F.col("vector").isNotNull() & (F.size("vector") != check_dimensions(dimensions)))
