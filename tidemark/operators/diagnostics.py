"""Signal diagnostics on panels: neutralised residuals, robust paths, rank correlations, position maps, purged folds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The standard deviation of the slope's t over the root of its length, for a driftless random walk.
NULL_SCALE = {5: 1.83}
NULL_SCALE_LONG = 1.39


def neutralised(panel: DataFrame, signal: str, controls: list[str], least: int = 10) -> DataFrame:
    """security_id, date, residual of the signal's regression on the controls and a constant over the rows of a date; dates of
    fewer than `least` rows have none. A date is a cross-section, of which a task holds one at a time."""

    def run(key, own):
        n = own.num_rows
        if n < least:
            return own.slice(0, 0).select(["security_id", "date"]).append_column("residual", pa.array([], pa.float64()))
        y = own.column(signal).to_numpy().astype(float)
        x = np.column_stack([own.column(c).to_numpy().astype(float) for c in controls])
        x, y = x - x.mean(axis=0), y - y.mean()
        # Controls in turn, each less what the earlier ones explain; a constant one explains nothing.
        for k in range(x.shape[1]):
            if (size := x[:, k] @ x[:, k]) > 1e-12:
                y = y - x[:, k] * (x[:, k] @ y / size)
                x[:, k + 1 :] -= np.outer(x[:, k], x[:, k] @ x[:, k + 1 :] / size)
        return own.select(["security_id", "date"]).append_column("residual", pa.array(y))

    kind = panel.schema["security_id"].dataType.simpleString()
    return panel.select("security_id", "date", signal, *controls).dropna().groupBy("date").applyInArrow(run, f"security_id {kind}, date date, residual double")


def rolling_mad(r: np.ndarray, window: int, least: int, abreast: int = 1024) -> np.ndarray:
    """Median absolute deviation from the median of the last `window` values, of as many as there are from `least` on. Windows lie side
    by side as a view of the series, those at its start filled up with infinity, and are sorted once. The values nearest to the median
    are neighbours in that order, so the middle deviation is found by halving where they begin, for all windows together."""
    out = np.full(len(r), np.nan)
    views = np.lib.stride_tricks.sliding_window_view(np.concatenate([np.full(window - 1, np.inf), r]), window)

    def nearest(held, middle, n, k):
        """The k-th smallest distance from the middle."""
        at, low, high = np.arange(len(held)), np.zeros(len(held), np.int64), n - k
        while (open_ := low < high).any():
            half = (low + high) // 2
            right = open_ & (middle - held[at, half] > held[at, np.minimum(half + k, window - 1)] - middle)
            low, high = np.where(right, half + 1, low), np.where(open_ & ~right, half, high)
        return np.maximum(middle - held[at, low], held[at, low + k - 1] - middle)

    for start in range(0, len(r), abreast):
        held = np.sort(views[start : start + abreast], axis=1)
        n = np.minimum(np.arange(start, start + len(held)) + 1, window)
        at = np.arange(len(held))
        middle = (held[at, (n - 1) // 2] + held[at, n // 2]) / 2
        out[start : start + len(held)] = (nearest(held, middle, n, (n - 1) // 2 + 1) + nearest(held, middle, n, n // 2 + 1)) / 2
    out[: least - 1] = np.nan
    return out


def robust_paths(returns: DataFrame, window: int = 252, bound: float = 3.0, least: int = 21) -> DataFrame:
    """security_id, date, clipped (the return within bound median absolute deviations of the last `window` rows, null before
    `least` of them) and signs (the running sum of the returns' signs). Nothing after a row decides it."""

    def run(key, own):
        own = own.sort_by("date")
        r = own.column("r").to_numpy().astype(float)
        m = bound * rolling_mad(r, window, least)
        out = np.minimum(np.maximum(r, -m), m)
        return pa.table({"security_id": own.column("security_id"), "date": own.column("date"), "clipped": pa.array(out, from_pandas=True), "signs": pa.array(np.cumsum(np.sign(r)).astype(np.int64))})

    kind = returns.schema["security_id"].dataType.simpleString()
    return returns.where("r is not null").groupBy("security_id").applyInArrow(run, f"security_id {kind}, date date, clipped double, signs long")


def average_rank(value: str, by: list[str]) -> Column:
    """Ranks of which ties have the mean."""
    return F.rank().over(Window.partitionBy(*by).orderBy(value)) + (F.count("*").over(Window.partitionBy(*by, value)) - 1) / 2


def rank_ic(panel: DataFrame, by: list[str], signal: str, target: str, least: int) -> DataFrame:
    """by, ic, n: rank correlation within each group of `least` rows or more in which neither is constant."""
    own = panel.withColumns({"_a": average_rank(signal, by), "_b": average_rank(target, by)})
    # Not corr: it is an error in ANSI mode where one is constant, before such groups are left out.
    each = own.groupBy(*by).agg(F.covar_samp("_a", "_b").alias("_ab"), F.count("*").alias("n"), F.stddev_samp("_a").alias("_sa"), F.stddev_samp("_b").alias("_sb"))
    return each.where((F.col("n") >= least) & (F.col("_sa") > 0) & (F.col("_sb") > 0)).select(*by, (F.col("_ab") / (F.col("_sa") * F.col("_sb"))).alias("ic"), "n")


def newey_west(series: DataFrame, value: str, lags: int) -> DataFrame:
    """n, mean and t of the mean of a series by date, with Bartlett weights. One row a date, so one task orders them."""
    w = Window.orderBy("date")
    every = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    centred = series.withColumn("mean", F.avg(value).over(every)).withColumn("_x", F.col(value) - F.col("mean"))
    with_lags = centred.withColumns({f"_x{k}": F.coalesce(F.lag("_x", k).over(w), F.lit(0.0)) for k in range(1, lags + 1)})
    long_run = sum((2 * (1 - k / (lags + 1)) * F.sum(F.col("_x") * F.col(f"_x{k}")) for k in range(1, lags + 1)), F.sum(F.col("_x") * F.col("_x")))
    return with_lags.agg(F.count(value).alias("n"), F.max("mean").alias("mean"), long_run.alias("_g")).select("n", "mean", (F.col("mean") / F.sqrt(F.col("_g") / F.col("n") / F.col("n"))).alias("t"))


def unit_null(tb: str, length: int) -> Column:
    """A slope's t in standard deviations of a random walk's."""
    return F.col(tb) / (NULL_SCALE.get(length, NULL_SCALE_LONG) * length**0.5)


def bucket_ic(panel: DataFrame, signal: str, target: str, least: int = 10, width: float = 0.5, last: int = 4) -> DataFrame:
    """bucket (of |z|, `width` wide, all beyond in the last), n, n_dates and the mean rank correlation within date and bucket."""
    own = panel.withColumn("bucket", F.least(F.floor(F.abs("z") / width), F.lit(last)).cast("int"))
    each = rank_ic(own, ["date", "bucket"], signal, target, least)
    return each.groupBy("bucket").agg(F.sum("n").alias("n"), F.count("*").alias("n_dates"), F.avg("ic").alias("mean_ic"))


def position_maps(panel: DataFrame, signal: str, top: float = 0.2) -> DataFrame:
    """panel with weights by date: neutral (demeaned, absolute weights add up to 1), long_only (the positive part, adds up to 1; null
    without one) and top (equal weights on the best share of names); dates whose signals are all equal have no rows."""
    day = Window.partitionBy("date")
    own = panel.withColumns({"_m": F.avg(signal).over(day), "_n": F.count("*").over(day), "_pos": F.sum(F.greatest(signal, F.lit(0.0))).over(day), "_at": F.row_number().over(day.orderBy(F.desc(signal), "security_id"))})
    own = own.withColumns({"_l1": F.sum(F.abs(F.col(signal) - F.col("_m"))).over(day), "_k": F.ceil(top * F.col("_n"))})
    return own.where("_l1 > 1e-9").withColumns({
        "neutral": (F.col(signal) - F.col("_m")) / F.col("_l1"), "long_only": F.when(F.col("_pos") > 0, F.greatest(signal, F.lit(0.0)) / F.col("_pos")),
        "top": F.when(F.col("_at") <= F.col("_k"), 1 / F.col("_k")).otherwise(0.0),
    }).drop("_m", "_n", "_pos", "_at", "_l1", "_k")


def purged_folds(days: DataFrame, groups: int = 5, purge: int = 252, embargo: int = 21) -> DataFrame:
    """one, two (the groups that are tested), date, t, role: every pair of groups of the calendar is a split. A row is a test row
    within them, dropped up to `purge` rows before and `embargo` rows after one of them, else a training row."""
    n = days.agg(F.max("t").alias("_n"))
    own = days.crossJoin(F.broadcast(n)).withColumn("_g", F.floor((F.col("t") - 1) * groups / F.col("_n")).cast("int"))
    ends = own.groupBy("_g").agg(F.min("t").alias("a"), F.max("t").alias("b"))
    one, two = (ends.select(F.col("_g").alias(name), F.col("a").alias(f"a{k}"), F.col("b").alias(f"b{k}")) for k, name in ((1, "one"), (2, "two")))
    pairs = one.join(F.broadcast(two), F.col("one") < F.col("two"))
    rows = own.select("date", "t").crossJoin(F.broadcast(pairs))
    inside = F.col("t").between(F.col("a1"), F.col("b1")) | F.col("t").between(F.col("a2"), F.col("b2"))
    near = F.col("t").between(F.col("a1") - purge, F.col("b1") + embargo) | F.col("t").between(F.col("a2") - purge, F.col("b2") + embargo)
    return rows.select("one", "two", "date", "t", F.when(inside, "test").when(near, "dropped").otherwise("train").alias("role"))
