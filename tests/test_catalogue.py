"""Queries of the catalogue on tables of other shapes."""

import shutil

from quadspark.plans import catalogue
from quadspark.sources.tables import quads


def test_streams_read_tables_that_are_folders(spark, tmp_path):
    own = "/root/testdata/sf0.001"
    shutil.copy(f"{own}/events.parquet", tmp_path)
    spark.read.parquet(f"{own}/documents.parquet").limit(40).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    want = quads(spark, str(tmp_path), "documents").distinct().count()
    assert catalogue.QUERIES["stream_index"](spark, str(tmp_path)).count() == want > 30
    (tmp_path / "events.parquet").unlink()
    spark.read.parquet(f"{own}/events.parquet").repartition(2).write.parquet(f"{tmp_path}/events.parquet")
    assert catalogue.QUERIES["stream_import"](spark, f"file://{tmp_path}").count() == quads(spark, str(tmp_path), "events").distinct().count()
