"""Positions in a keyed pseudo-random order, without one task per group.

The order is by the md5 of seed and key, so it is the same on every run and in
any SQL engine.  The first three hex digits cut a group into 4096 even buckets:
rows are numbered inside their bucket, and bucket offsets come from a table
of at most 4096 rows a group.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_key(seed: int, key: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))


def positions(df: DataFrame, group: str, key: str, seed: int, position: str = "position", size: str = "size") -> DataFrame:
    """``df`` with the 0-based position of each row in its group and the group's size; ties by ``key``."""
    keyed = df.withColumn("_key", order_key(seed, F.col(key))).withColumn("_cut", F.substring("_key", 1, 3))
    counts = keyed.groupBy(group, "_cut").agg(F.count("*").alias("_n"))
    w = Window.partitionBy(group)
    before = w.orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(group, "_cut", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(w).alias(size))
    inside = F.row_number().over(Window.partitionBy(group, "_cut").orderBy("_key", key)) - 1
    return keyed.join(offsets, [group, "_cut"]).withColumn(position, (F.col("_before") + inside).cast("long")).drop("_cut", "_before", "_key")
