"""Surrogate ids that never change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges that keys are numbered in. A range's cut points are keys themselves, so the driver holds as many keys at most.
RANGES = 256


def cut_points(keys: DataFrame, key: str, ranges: int = RANGES) -> list:
    """Up to ranges - 1 keys, in order, that cut the distinct keys into ranges of about equal size: those of lowest hash. They
    follow from the keys alone, so any later reading of the same keys is cut alike."""
    low = keys.select(key).distinct().select(key, F.xxhash64(key).alias("_h")).orderBy("_h", key).limit(ranges - 1)
    return sorted(r[0] for r in low.select(key).collect())


def range_of(key: Column, cuts: list) -> Column:
    """The number of cut points that are no greater than the key, by halving."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(key < F.lit(cuts[mid]), search(low, mid)).otherwise(search(mid + 1, high))

    return search(0, len(cuts))


def numbered(keys: DataFrame, key: str, name: str = "n", ranges: int = RANGES) -> DataFrame:
    """keys with their place from 1 in the order of the key. Keys are distinct and not null.

    A row's range is a search in stored cut points and its number a count within the range, plus what stands in the ranges
    before: functions of the keys, whichever task computes them and however often. No task sees all keys."""
    cuts = cut_points(keys, key, ranges)
    own = keys.withColumn("_range", range_of(F.col(key), cuts))
    placed = own.withColumn("_at", F.row_number().over(Window.partitionBy("_range").orderBy(key)))
    size = own.groupBy("_range").agg(F.count("*").alias("_n"))
    before = size.select("_range", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(before), "_range").select(*keys.columns, (F.col("_before") + F.col("_at")).alias(name))


def stable_ids(keys: DataFrame, held: DataFrame, key: str = "code", name: str = "id") -> DataFrame:
    """held's ids, and for keys that it lacks the next ones in the order of the key; null keys get none. Ids follow from keys and
    held alone: a lost executor's rows get the same ids when they are computed again."""
    new = keys.select(key).where(F.col(key).isNotNull()).distinct().join(held, key, "left_anti")
    edge = held.agg(F.coalesce(F.max(name), F.lit(0)).alias("_top"))
    out = numbered(new, key, "_place").crossJoin(F.broadcast(edge))
    return held.select(key, name).unionByName(out.select(key, (F.col("_top") + F.col("_place")).cast(held.schema[name].dataType).alias(name)))
