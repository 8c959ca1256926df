"""Exact percentiles of a column that no task holds as a whole."""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of one round, and values that one task puts in order at most.
RANGES, MOST = 128, 1 << 17


def counted(values: DataFrame, cuts: list[float]) -> DataFrame:
    """k (how many cut points are no greater), n, first and last of the values of each range that has any."""

    def run(batches):
        for batch in batches:
            v = np.sort(batch.column(0).to_numpy())
            ends = np.concatenate([[0], np.searchsorted(v, cuts), [len(v)]])
            k = np.flatnonzero(np.diff(ends))
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(np.diff(ends)[k], pa.int64()), pa.array(v[ends[k]]), pa.array(v[ends[k + 1] - 1])], ["k", "n", "first", "last"])

    own = values.mapInArrow(run, "k long, n long, first double, last double")
    return own.groupBy("k").agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"))


def at_ranks(values: DataFrame, ranks: list[int], ranges: int = RANGES, most: int = MOST) -> dict[int, float]:
    """The values (column v, a double, no nulls) at these places from 0 in their order.

    A sketch gives cut points, one pass counts the ranges between them, and only a range that holds a wanted place is looked at
    again: put in order where it is short, cut anew where it is long. Each cut point is a range of its own, so a value that very
    many rows share is found by its count. Every step reads the values again, so they should be stored."""
    shares = [k / ranges for k in range(1, ranges)]
    low, high, sketch = values.agg(F.min("v"), F.max("v"), F.percentile_approx("v", shares, 10 * ranges)).first()
    points = sorted({low, high, *sketch} - {None})
    cuts = sorted({c for p in points for c in (p, math.nextafter(p, math.inf))})
    found, short, before = {}, {}, 0
    for _, n, first, last in sorted(tuple(r) for r in counted(values, cuts).collect()):
        inside = [r for r in ranks if before <= r < before + n]
        if inside and first == last:
            found |= dict.fromkeys(inside, first)
        elif inside and n <= most:
            short[first, last] = {r - before: r for r in inside}
        elif inside:
            found |= {r + before: v for r, v in at_ranks(values.where(F.col("v").between(first, last)), [r - before for r in inside], ranges, most).items()}
        before += n
    if short:
        # Ranges don't overlap: their first values tell them apart.
        within = F.coalesce(*(F.when(F.col("v").between(*ends), ends[0]) for ends in short))
        some = values.withColumn("_range", within).where("_range is not null").withColumn("_at", F.row_number().over(Window.partitionBy("_range").orderBy("v")) - 1)
        wanted = [(F.col("_range") == ends[0]) & F.col("_at").isin(list(at)) for ends, at in short.items()]
        places = {(ends[0], at): r for ends, held in short.items() for at, r in held.items()}
        found |= {places[r["_range"], r["_at"]]: r["v"] for r in some.where(reduce(or_, wanted)).collect()}
    return found


def percentiles(df: DataFrame, column: str, shares: tuple[float, ...], ranges: int = RANGES, most: int = MOST) -> dict[float, float | None]:
    """Percentiles of a column by share, interpolated between neighbours; nulls and NaN don't count, None without values. The
    driver holds a count for each range."""
    values = df.select(F.col(column).cast("double").alias("v")).where("v is not null and not isnan(v)")
    n = values.count()
    if not n:
        return dict.fromkeys(shares)
    place = {s: s * (n - 1) for s in shares}
    got = at_ranks(values, sorted({r for p in place.values() for r in (math.floor(p), math.ceil(p))}), ranges, most)
    return {s: got[math.floor(p)] + (got[math.ceil(p)] - got[math.floor(p)]) * (p - math.floor(p)) for s, p in place.items()}
