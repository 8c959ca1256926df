"""Rolling trend scan, forward returns, fractional differencing weights."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

RUNGS = (5, 10, 21, 42, 63, 84, 126, 168, 210, 252)
FLAT = 1e-12


#: Weights of a fractional difference below this end its window.
THRESHOLD = 1e-4
#: Windows of so many rows are arrays of the plan; wider ones go through a grouped function.
NARROW = 64


def window_moments(y: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of `length` rows, by its last row: sums of squares of y about its mean, and of products of y and time about theirs.

    Rows are cut in blocks of the window's length. A window is the end of one block and the start of the next, so its sums are one
    running sum from the cut backwards plus one forwards: nothing is subtracted, and what lies outside a window has no part in it.
    Values and times count from the row at the cut, which the window holds."""
    blocks = -(-len(y) // length)
    own = np.full(blocks * length, np.nan)
    own[: len(y)] = y
    own = own.reshape(blocks, length)
    cut, after = own[:, :1], np.arange(length)
    ahead, behind = own - cut, (own[:-1] - cut[1:])[:, ::-1]
    s, ss, st = np.cumsum(ahead, axis=1), np.cumsum(ahead * ahead, axis=1), np.cumsum(ahead * after, axis=1)
    for total, part in ((s, behind), (ss, behind * behind), (st, behind * (-1 - after))):
        total[1:, :-1] += np.cumsum(part, axis=1)[:, -2::-1]
    middle = after - (length - 1) / 2
    syy, sty = ss - s * s / length, st - middle * s
    return syy.ravel()[length - 1 : len(y)], sty.ravel()[length - 1 : len(y)]


def trend_scan(panel: DataFrame, rungs: tuple[int, ...] = RUNGS, scale: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """security_id, seg, date, y, the columns to keep, and the t statistic tb_L (and residual deviation sd_L with scale) of the slope of
    y on time over the last L bars of the segment; null before L bars, for a flat window, one that holds a null, and a line without residual.

    One exchange and one sort for all rungs; a task holds one segment at a time. A rung costs two running sums of three quantities whatever
    its length (window_moments), which lie within the window: errors don't grow with the series or with what moved before."""
    names = [n for L in rungs for n in ((f"tb_{L}", f"sd_{L}") if scale else (f"tb_{L}",))]
    own = panel.select("security_id", "seg", "date", F.col("y").cast("double").alias("y"), *keep)

    def run(key, rows):
        rows = rows.sort_by("date")
        y = rows.column("y").to_numpy(zero_copy_only=False).astype(np.float64)
        changes = np.concatenate([[0], np.cumsum(y[1:] != y[:-1])])
        for L in rungs:
            tb, sd = np.full(len(y), np.nan), np.full(len(y), np.nan)
            if len(y) >= L:
                suu = L * (L * L - 1) / 12.0
                syy, suy = window_moments(y, L)
                sse = syy - suy * suy / suu
                ok = (changes[L - 1 :] > changes[: len(y) - L + 1]) & (sse > FLAT * syy)
                dev = np.sqrt(sse[ok] / (L - 2))
                at = np.flatnonzero(ok) + L - 1
                sd[at], tb[at] = dev, suy[ok] / suu**0.5 / dev
            rows = rows.append_column(f"tb_{L}", pa.array(tb, from_pandas=True))
            if scale:
                rows = rows.append_column(f"sd_{L}", pa.array(sd, from_pandas=True))
        return rows

    return own.groupBy("security_id", "seg").applyInArrow(run, StructType([*own.schema.fields, *(StructField(n, DoubleType()) for n in names)]))


def rolling_deviation(panel: DataFrame, column: str, length: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """security_id, date, the columns to keep and deviation: of the last `length` values of the column, null before there are so many.
    Rows without a value are no part of the series."""
    own = panel.select("security_id", "date", F.col(column).cast("double").alias("_x"), *keep).where("_x is not null")

    def run(key, rows):
        rows = rows.sort_by("date")
        x = rows.column("_x").to_numpy().astype(np.float64)
        out = np.full(len(x), np.nan)
        if len(x) >= length:
            out[length - 1 :] = np.sqrt(window_moments(x, length)[0] / (length - 1))
        return rows.drop_columns(["_x"]).append_column("deviation", pa.array(out, from_pandas=True))

    kinds = [f for f in own.schema.fields if f.name != "_x"]
    return own.groupBy("security_id").applyInArrow(run, StructType([*kinds, StructField("deviation", DoubleType())]))


def skipped(bars: DataFrame, skip: int = 21, length: int = 252) -> DataFrame:
    """security_id, date, skip (the log return from `length` bars back to `skip` bars back) and skip_vol (the same over the deviation of the
    `length` daily log returns up to `skip` bars back); null where the series doesn't reach so far."""
    w = Window.partitionBy("security_id").orderBy("date")
    own = bars.select("security_id", "date", "close", F.ln(F.col("close") / F.lag("close").over(w)).alias("_r"))
    vol = rolling_deviation(own, "_r", length)
    own = own.join(vol, ["security_id", "date"], "left")
    gone = F.ln(F.lag("close", skip).over(w) / F.lag("close", length).over(w))
    return own.select("security_id", "date", gone.alias("skip"), F.when(F.lag("deviation", skip).over(w) > 0, gone / F.lag("deviation", skip).over(w)).alias("skip_vol"))


def skipped_surface(scanned: DataFrame, rungs: tuple[int, ...] = RUNGS, skip: int = 21) -> DataFrame:
    """security_id, seg, date and tb_L of `skip` bars before."""
    w = Window.partitionBy("security_id", "seg").orderBy("date")
    return scanned.select("security_id", "seg", "date", *(F.lag(f"tb_{L}", skip).over(w).alias(f"tb_{L}") for L in rungs))


def dollar_volume_mean(panel: DataFrame, bars: int = 21, by: tuple[str, ...] = ("security_id",)) -> DataFrame:
    """adv21: mean of close * volume over the last `bars` rows of a series, fewer at its start. by: what a series is; a trend panel
    has a segment besides the security."""
    w = Window.partitionBy(*by).orderBy("date").rowsBetween(-(bars - 1), 0)
    return panel.withColumn("adv21", F.avg(F.col("close") * F.col("volume")).over(w))


def forward_returns(panel: DataFrame, horizons: tuple[int, ...] = (1, 5, 21, 63), by: tuple[str, ...] = ("security_id",)) -> DataFrame:
    """fwd{h}: log return over the next h rows of the series, null past its end."""
    w = Window.partitionBy(*by).orderBy("date")
    return panel.withColumns({f"fwd{h}": F.lead(F.ln("adj"), h).over(w) - F.ln("adj") for h in horizons})


def weights(d: float, threshold: float = THRESHOLD, most: int = 4096, zero_sum: bool = True) -> tuple[list[float], float]:
    """Fractional differencing weights down to the threshold, and their sum before the oldest one is corrected for it."""
    w = [1.0]
    while len(w) < most and abs(x := -w[-1] * (d - len(w) + 1) / len(w)) >= threshold:
        w.append(x)
    leak = sum(w)
    if zero_sum:
        w[-1] -= leak
    return w, leak


def differenced(panel: DataFrame, d: float, threshold: float = THRESHOLD, zero_sum: bool = True, y: str = "y", name: str = "ffd") -> DataFrame:
    """security_id, date, y and its fixed-width fractional difference over its series; null for the first rows."""
    w, _ = weights(d, threshold, zero_sum=zero_sum)
    if len(w) > NARROW:
        from .fracdiff import differenced_wide

        return differenced_wide(panel, w, y, name)
    by = Window.partitionBy("security_id").orderBy("date")
    held = F.collect_list(y).over(by.rowsBetween(-(len(w) - 1), 0))
    total = F.aggregate(F.zip_with(held, F.array(*map(F.lit, reversed(w))), lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    return panel.select("security_id", "date", y, held.alias("_held")).withColumn(name, F.when(F.size("_held") == len(w), total)).drop("_held")
