"""Places in a total order without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lettrine.workspace import persisted


def placed(df: DataFrame, order: list[Column], out: str = "place") -> DataFrame:
    """Rows with their place from 1 on.

    Rows are range-partitioned and sorted; a row's place is its place in its
    partition plus the sizes of the partitions before.  Only those sizes, one number
    for each partition, pass through a single window.  Ties have no defined order:
    end ``order`` with a unique column.
    """
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = persisted(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).withColumn("_inside", inside), "ranged")
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return ranged.join(F.broadcast(before), "_part").withColumn(out, F.col("_before") + F.col("_inside") + 1).drop("_part", "_inside", "_before")


def numbered(df: DataFrame, keys: list[str], order: list[str], out: str = "number") -> DataFrame:
    """Rows with their number from 1 on within their key, by columns ``order`` that are unique in it.

    A row's number is its place in the total order less the first place of its key,
    so a key that holds a third of all rows is numbered by many tasks.
    """
    p = placed(df, [F.col(c) for c in (*keys, *order)], "_place")
    first = p.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.min("_place").alias("_first"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return p.join(first, same).withColumn(out, F.col("_place") - F.col("_first") + 1).drop("_place", "_first", *(f"_{k}" for k in keys))
