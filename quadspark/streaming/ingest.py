"""Streams of quads into a store, one micro-batch after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quadspark.functions.terms import COLUMNS
from quadspark.operators.match import QuadFilter
from quadspark.sources.snapshot import Store

#: Seconds for which old versions stay readable.
KEEP_SECONDS = 3600.0


def ingest(stream: DataFrame, store: Store, checkpoint: str, policy: str = "incremental", keep_seconds: float = KEEP_SECONDS, splitter=None, whole: bool = False, keep: QuadFilter | None = None, **trigger) -> StreamingQuery:
    """Apply a stream of quads with an ``op`` ('add' or 'delete') to a store.

    Rows of a batch are netted in the order of ``seq``, if there is one. Batches run one at a time, and a batch that
    is replayed after a failure changes nothing, as commits are idempotent by id. A batch writes what it changes,
    quads and chunks in one version. Runs of like size are merged, and versions of more than ``keep_seconds`` deleted,
    in a thread beside the stream.
    """
    ordered = "seq" in stream.columns

    def apply(batch: DataFrame, _: int) -> None:
        store.commit(batch.select(*COLUMNS, "op", (F.col("seq") if ordered else F.lit(0)).alias("seq")), policy, splitter, whole=whole, keep=keep)
        if store.due():
            store.maintain_beside(keep_seconds)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def add_all(stream: DataFrame, store: Store, checkpoint: str, **options) -> StreamingQuery:
    """Every arriving quad is added."""
    return ingest(stream.withColumn("op", F.lit("add")), store, checkpoint, **options)


def remove_all(stream: DataFrame, store: Store, checkpoint: str, **options) -> StreamingQuery:
    """Every arriving quad is removed."""
    return ingest(stream.withColumn("op", F.lit("delete")), store, checkpoint, **options)


def flush(query: StreamingQuery) -> None:
    """Wait until what has arrived is applied."""
    query.processAllAvailable()
