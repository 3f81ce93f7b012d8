"""Top rows, by group or over all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from digestlake.sources.tables import written


def top_per_group(rows: DataFrame, group: list[str], order: list[Column], most: int, name: str = "rn") -> DataFrame:
    """The first rows of each group with their number; Spark prunes each group before the shuffle."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(name) <= most)


def top(rows: DataFrame, order: list[Column], most: int) -> DataFrame:
    return rows.orderBy(*order).limit(most)


def numbered(rows: DataFrame, order: list[Column], most: int, name: str = "rn") -> DataFrame:
    """The first rows with their number; no more than most rows reach the one task that numbers them."""
    return top(rows, order, most).withColumn(name, F.row_number().over(Window.orderBy(*order)))


def ranked(rows: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """All rows with their number, by a range sort: a row's number is its place in its partition and the rows of the partitions before. No task sees all rows.

    rows are written before their ranges are drawn from a sample, so they are computed once, and the sorted ones with their places, as another draw would give other ranges.
    """
    sorted_ = written(rows, "unranked").repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(sorted_.withColumn("_part", F.spark_partition_id()).withColumn("_nth", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "ranked")
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_nth") + 1).drop("_part", "_nth", "_before")
