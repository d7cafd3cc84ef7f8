"""Order over a whole table without one task that holds it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadspark.llm import scratch


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ranked(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """Add the 1-based place of each row under ``order``, a total order, as a long column.

    Rows go to range partitions, are numbered inside them, and each partition's start is the sum of the counts
    before it; only those counts, one row per partition, are summed in one place.
    """
    dealt = scratch.write(df.repartitionByRange(partitions(df), *order).withColumn("_part", F.spark_partition_id()), "ranked")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    numbered = dealt.withColumn("_row", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    return numbered.join(F.broadcast(starts), "_part").withColumn(name, F.col("_row") + F.col("_start")).drop("_part", "_row", "_start")


def running(df: DataFrame, value: str, *order: str, before: str, same: str) -> DataFrame:
    """Add the sums of a long column over all rows before those of equal ``order``, and over those of equal order.

    As in ``ranked``, rows go to range partitions and only one total per partition is summed in one place; rows of
    equal order share a partition.
    """
    dealt = scratch.write(df.repartitionByRange(partitions(df), *order).withColumn("_part", F.spark_partition_id()), "running")
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("_part").agg(F.sum(value).alias("_sum")).select("_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    upto = F.sum(value).over(Window.partitionBy("_part").orderBy(*order))
    summed = dealt.withColumns({"_upto": upto, same: F.sum(value).over(Window.partitionBy("_part", *order))})
    return summed.join(F.broadcast(starts), "_part").withColumn(before, F.col("_start") + F.col("_upto") - F.col(same)).drop("_part", "_upto", "_start")
