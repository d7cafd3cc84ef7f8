"""New folders for tables that live between jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_OWN: list[str] = []


def new_folder(spark: SparkSession, kind: str) -> str:
    """A path in the folder that spark.checkpoint.dir names, which all executors share; a temporary one only locally."""
    named = (spark.conf.get("spark.checkpoint.dir", "") or "").rstrip("/")
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        if not _OWN:
            _OWN.append("file://" + tempfile.mkdtemp(prefix="quadspark-"))
        named = _OWN[0]
    return f"{named}/{kind}-{uuid.uuid4().hex}"
