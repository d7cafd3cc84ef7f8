"""Intermediate tables in the folder that every executor and the driver share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []
#: Deletes the shuffle files of a finished job, else kept until the driver collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Names of one scheme that Hadoop and Arrow call differently.
_OTHER_NAME = re.compile("^s3[an]://")


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme and host, as Spark's file systems resolve it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()


def root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; a temporary one only on a local master, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", "") or ""
    if named:
        return qualified(spark, named).rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    if not _OWN:
        _OWN.append("file://" + tempfile.mkdtemp(prefix="quadspark-"))
    return _OWN[0]


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path inside it of a qualified path, for tasks that read or write parts of files."""
    return fs.FileSystem.from_uri(_OTHER_NAME.sub("s3://", uri))


def folder(spark: SparkSession, kind: str) -> str:
    """A new path below the shared folder."""
    return f"{root(spark)}/{kind}-{uuid.uuid4().hex}"


def write(df: DataFrame, kind: str = "table") -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet to the shared folder and read it back.

    Shuffle files of the job are deleted as soon as the table is complete; nothing reads them after that. The setting
    that does so is the session's, for as long as the job runs.
    """
    spark, path = df.sparkSession, folder(df.sparkSession, kind)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files behind a table made by ``write`` that nothing reads any more."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "-" in path.rsplit("/", 1)[-1] and path.split(":", 1)[-1].lstrip("/").startswith(root(spark).split(":", 1)[-1].lstrip("/")):
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
