"""Gapless ranks within groups that may be far larger than one task should hold."""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a group that one task numbers, about.
BUCKET_ROWS = 4096


def buckets_for(rows: int, groups: int = 1) -> int:
    """Number of buckets per group that keeps a bucket at about ``BUCKET_ROWS`` rows."""
    return max(4, math.ceil(rows / max(1, groups) / BUCKET_ROWS))


def ranked(df: DataFrame, groups: list[str], by: list[str], buckets: int, name: str = "rank") -> DataFrame:
    """``df`` with ``name``: 0, 1, 2, ... within the columns ``groups``, in an order that keeps equal ``by[0]`` together.

    A row's bucket is a hash of ``by[0]``; rows are numbered inside their bucket and moved on by
    the counts of the buckets before it.  Only those counts are summed up across a whole group.
    ``by`` as a whole must tell the rows of a group apart for a fixed order.
    """
    cut = df.withColumn("__bucket", F.pmod(F.xxhash64(by[0]), F.lit(buckets)))
    counts = cut.groupBy(*groups, "__bucket").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*groups).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*groups, "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy(*groups, "__bucket").orderBy(*by)
    numbered = cut.withColumn("__number", F.row_number().over(inside) - 1)
    return (numbered.join(offsets, [*groups, "__bucket"]).withColumn(name, F.col("__offset") + F.col("__number"))
            .drop("__bucket", "__offset", "__number"))
