"""Fractional differencing, unit-root tests, optimal orders and memory estimates: real per-series fits, one grouped function each.

A series is one security; a task holds one series at a time, a few thousand rows. Rows without y are no part of a series.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .trend import THRESHOLD, dollar_volume_mean, forward_returns, weights

# Fixed MacKinnon (2010) response-surface values, constant and no trend: 1, 5 and 10 per cent.
CRITICAL = {1: (-3.43035, -6.5393, -16.786, -79.433), 5: (-2.86154, -2.8903, -4.234, -40.040), 10: (-2.56677, -1.5384, -2.809, 0.0)}
#: The grid of orders, halvings after it, and the fewest rows of a series that is searched.
GRID, HALVINGS, LEAST_ROWS = tuple(round(0.05 * k, 2) for k in range(21)), 6, 252


#: A share of a column's squares that others leave unexplained, below which products have lost too many digits.
DEPENDENT = 1e-6


def critical(n: int, level: int = 5) -> float:
    b = CRITICAL[level]
    return b[0] + b[1] / n + b[2] / n**2 + b[3] / n**3


def critical_column(n, level: int = 5):
    b = CRITICAL[level]
    return F.lit(b[0]) + b[1] / n + b[2] / F.pow(n, 2) + b[3] / F.pow(n, 3)


def lag_bound(n: int) -> int:
    """Schwert's rule, 20 at most."""
    return max(1, min(20, int(np.ceil(12 * (max(n, 1) / 100) ** 0.25))))


def _design(x: np.ndarray, lag: int, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Level and lagged differences, and the difference they explain, from row `start` on, each less its mean: that is the
    regression with a constant."""
    dx = np.diff(x)
    cols = np.column_stack([x[start:-1], *(dx[start - j : len(dx) - j] for j in range(1, lag + 1))])
    y = dx[start:]
    return cols - cols.mean(axis=0), y - y.mean()


def _products(x: np.ndarray, dx: np.ndarray, lag: int, start: int, stop: int) -> np.ndarray:
    """Sums of products, over the differences from start to stop, of one, level, the lagged differences and the difference that they
    explain."""
    z = np.empty((lag + 3, stop - start))
    z[0], z[1] = 1.0, x[start:stop]
    for j in range(1, lag + 1):
        z[1 + j] = dx[start - j : stop - j]
    z[-1] = dx[start:stop]
    return z @ z.T


def _factor(products: np.ndarray) -> np.ndarray:
    """Triangular factor of the products of columns less their means; the first column is the one of ones."""
    own = products[1:, 1:] - products[0, 1:, None] * (products[0, 1:] / products[0, 0])
    low = np.linalg.cholesky(own)
    if (low.diagonal() ** 2 < DEPENDENT * own.diagonal()).any():
        raise np.linalg.LinAlgError("columns are nearly dependent")
    return low


def adf(x: np.ndarray, most: int | None = None) -> tuple[float, int, int, float] | None:
    """Statistic, lag, rows and 5 per cent value; the lag has the lowest AIC on the rows that all lags have and is then fitted on
    its own rows. None where the series is short or leaves nothing to test.

    One triangular factor serves every lag: the explained sum of squares of the first k columns is a running sum."""
    most = lag_bound(len(x)) if most is None else most
    if len(x) < most + 12:
        return None
    # Means are near nothing from the start, so that taking them out of the products loses no digits.
    given, x = x, x - x.mean()
    dx = np.diff(x)
    dx -= dx.mean()
    try:
        # The last row of the factor holds what each column adds to the sum of squares that is explained, then what is left.
        wide, m = _products(x, dx, most, most, len(dx)), len(dx) - most
        # Lags for which there are too few rows aren't looked at.
        keep = [*range(min(most + 2, m - 2)), -1]
        left = np.cumsum(_factor(wide[keep][:, keep])[-1, ::-1] ** 2)[-2::-1]
        lag = int(np.argmin(m * np.log(left / m) + 2.0 * np.arange(len(left))))
        # Fewer lags have more rows: only those are added. The level comes last, and its statistic stands in the last row.
        at = [0, *range(2, lag + 2), 1, -1]
        own = wide[at][:, at]
        if lag < most:
            own += _products(x, dx, lag, lag, most)[at][:, at]
        low, m = _factor(own), len(dx) - lag
    except np.linalg.LinAlgError:
        return _adf_by_solving(given, most)
    if m <= lag + 3:
        return None
    return float(low[-1, -2] / np.sqrt(low[-1, -1] ** 2 / (m - lag - 2))), lag, m, critical(m)


def _adf_by_solving(x: np.ndarray, most: int) -> tuple[float, int, int, float] | None:
    """The same where columns are nearly dependent or nothing is left."""
    a, y = _design(x, most, most)
    m, lag = len(y), most
    try:
        part = np.linalg.solve(np.linalg.cholesky(a.T @ a), a.T @ y)
        left = y @ y - np.cumsum(part**2)
        size = np.arange(most + 1) + 2
        with np.errstate(invalid="ignore", divide="ignore"):
            aic = np.where((left > 0) & (m > size + 1), m * np.log(left / m) + 2.0 * size, np.inf)
        if np.isfinite(aic).any():
            lag = int(np.argmin(aic))
        a, y = _design(x, lag, lag)
        inverse = np.linalg.inv(a.T @ a)
    except np.linalg.LinAlgError:
        return None
    b = inverse @ (a.T @ y)
    m, left = len(y), y @ y - b @ (a.T @ y)
    if m <= lag + 3 or left <= 0 or inverse[0, 0] <= 0:
        return None
    return float(b[0] / np.sqrt(left / (m - lag - 2) * inverse[0, 0])), lag, m, critical(m)


@lru_cache(maxsize=4096)
def _weights(d: float, threshold: float) -> tuple[np.ndarray, float]:
    w, leak = weights(d, threshold)
    return np.array(w), leak


def difference(y: np.ndarray, d: float, threshold: float = THRESHOLD) -> np.ndarray:
    """The rows that have a whole window; none where the series is shorter."""
    w, _ = _weights(d, threshold)
    return np.convolve(y, w, mode="valid") if len(y) >= len(w) else np.zeros(0)


def _correlation(x: np.ndarray, y: np.ndarray) -> float | None:
    if len(x) < 3:
        return None
    x, y = x - x.mean(), y - y.mean()
    xx, yy = x @ x, y @ y
    return float(min(max(x @ y / np.sqrt(xx) / np.sqrt(yy), -1.0), 1.0)) if xx > 0 and yy > 0 else None


def tested(y: np.ndarray, d: float, threshold: float, most: int) -> dict:
    """The test of y differenced at d. The bound on lags is that of y, before it lost rows."""
    w, leak = _weights(d, threshold)
    x = difference(y, d, threshold)
    got = adf(x, most) if len(x) else None
    stat, _, nobs, crit = got or (None, None, 0, None)
    return {"d": d, "adf": stat, "crit": crit, "corr": _correlation(x, y[len(y) - len(x) :]) if len(x) else None, "width": len(w), "nobs": nobs, "leak": leak}


def optimal_order(y: np.ndarray, threshold: float = THRESHOLD, least: int = LEAST_ROWS) -> dict | None:
    """The first order of the grid at which the test rejects, then halvings between it and the last one that failed. Orders
    without a statistic are passed over."""
    if len(y) < least:
        return None
    most, failed = lag_bound(len(y)), None
    for d in GRID:
        got = tested(y, d, threshold, most)
        if got["adf"] is None:
            continue
        if got["adf"] <= got["crit"]:
            for _ in range(HALVINGS if failed is not None else 0):
                mid = (failed + got["d"]) / 2
                now = tested(y, mid, threshold, most)
                if now["adf"] is not None and now["adf"] <= now["crit"]:
                    got = now
                else:
                    failed = mid
            return got
        failed = d
    return None


def each_series(panel: DataFrame, rows, schema: str, columns: tuple[str, ...] = ("y",)) -> DataFrame:
    """rows(name, date, *columns) -> columns of the result as a dictionary, for each series in the order of date; rows of which
    a column is null are left out."""

    def run(key, own):
        own = own.sort_by("date")
        values = [own.column(c).to_numpy().astype(float) for c in columns]
        return pa.table(rows(key[0].as_py(), own.column("date"), *values), schema=kinds)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    kinds = to_arrow_schema(_parse_datatype_string(schema))
    return panel.select("security_id", "date", *columns).dropna(subset=["date", *columns]).groupBy("security_id").applyInArrow(run, schema)


def adf_tests(panel: DataFrame) -> DataFrame:
    """security_id, stat, lag, nobs, crit5; null statistics for a series that can't be tested."""

    def rows(name, _, y):
        stat, lag, nobs, crit = adf(y) or (None,) * 4
        return {"security_id": [name], "stat": [stat], "lag": [lag], "nobs": [nobs], "crit5": [crit]}

    return each_series(panel, rows, "security_id long, stat double, lag int, nobs int, crit5 double")


ORDER = ("d", "adf", "crit", "corr", "width", "nobs", "leak")


def optimal_orders(panel: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """d, adf, crit, corr, width, nobs, leak for each series, null where no order is stationary or the series is short."""

    def rows(name, _, y):
        got = optimal_order(y, threshold) or {}
        return {"security_id": [name]} | {c: [got.get(c)] for c in ORDER}

    return each_series(panel, rows, "security_id long, d double, adf double, crit double, corr double, width int, nobs int, leak double")


def order_curve(panel: DataFrame, grid: tuple[float, ...] = GRID, threshold: float = THRESHOLD) -> DataFrame:
    """d, mean_stat, stationary (share), mean_corr and kept (share of rows with a whole window) over the series."""

    def rows(name, _, y):
        most = lag_bound(len(y))
        got = [tested(y, d, threshold, most) for d in grid]
        return {
            "security_id": [name] * len(grid), "d": list(grid), "stat": [g["adf"] for g in got], "passed": [None if g["adf"] is None else g["adf"] <= g["crit"] for g in got],
            "corr": [g["corr"] for g in got], "n": [len(y)] * len(grid), "kept": [max(len(y) - g["width"] + 1, 0) for g in got],
        }

    each = each_series(panel, rows, "security_id long, d double, stat double, passed boolean, corr double, n long, kept long")
    return each.groupBy("d").agg(F.avg("stat").alias("mean_stat"), F.avg(F.col("passed").cast("double")).alias("stationary"), F.avg("corr").alias("mean_corr"), (F.sum("kept") / F.sum("n")).alias("kept"))


def own_order(panel: DataFrame, orders: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """security_id, date, ffdown: each series that has an order differenced at its own, rounded to 3 digits."""

    def rows(name, date, y, d):
        x = difference(y, float(d[0]), threshold)
        return {"security_id": [name] * len(y), "date": date, "ffdown": pa.array(np.concatenate([np.full(len(y) - len(x), np.nan), x]), from_pandas=True)}

    joined = panel.join(orders.where("d is not null").select("security_id", F.round("d", 3).alias("d")), "security_id")
    return each_series(joined, rows, "security_id long, date date, ffdown double", ("y", "d"))


def gph(panel: DataFrame, power: float = 0.5) -> DataFrame:
    """security_id, d, se: memory from the slope of the log periodogram at the lowest n^power frequencies; no row for series of
    fewer than 64 rows or 8 frequencies."""

    def rows(name, _, y):
        n, m = len(y), int(np.floor(len(y) ** power + 1e-9))
        if n < 64 or m < 8:
            return {"security_id": [], "d": [], "se": []}
        f = 2 * np.pi * np.arange(1, m + 1) / n
        level = np.log(np.abs(np.fft.rfft(y)[1 : m + 1]) ** 2)
        x = -np.log(4 * np.sin(f / 2) ** 2)
        x = x - x.mean()
        return {"security_id": [name], "d": [float(x @ level / (x @ x))], "se": [float(np.pi / np.sqrt(24 * m))]}

    return each_series(panel, rows, "security_id long, d double, se double")


def pooled(orders: DataFrame, column: str = "d") -> float | None:
    """The median order of the series that have one: one number."""
    return orders.agg(F.median(column)).first()[0]


def feature_table(panel: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """panel: security_id, date, close, adj, volume. One row for each row with adj and close above 0: close, adv21, logp, logv; for
    price (p) and volume (v) the series differenced at the pooled order (ffd_) and at its own (ffdown_), its order, statistic
    and leak (d_, adf_, leak_); forward returns. The orders, one row a series, are searched once and stay persisted."""
    own = panel.where("adj > 0 and close > 0").withColumns({"logp": F.ln("adj"), "logv": F.log1p("volume")})
    legs = ("p", "v")

    def search(name, _, *values):
        got = {t: optimal_order(y, threshold) or {} for t, y in zip(legs, values, strict=True)}
        return {"security_id": [name]} | {f"{c}_{t}": [got[t].get(c)] for t in legs for c in ("d", "adf", "leak")}

    orders = each_series(own, search, "security_id long, " + ", ".join(f"{c}_{t} double" for t in legs for c in ("d", "adf", "leak")), ("logp", "logv"))
    orders = orders.persist()
    pool = {t: pooled(orders, f"d_{t}") for t in legs}
    # One row a series joins, and what is made of a series is put beside its rows: no join of rows with rows.
    rows = forward_returns(dollar_volume_mean(own)).dropna(subset=["date", "logp", "logv"])
    rows = rows.join(orders.withColumns({f"_d_{t}": F.round(f"d_{t}", 3) for t in legs}), "security_id")

    def transform(key, rows):
        rows = rows.sort_by("date")
        for t in legs:
            y, d = rows.column(f"log{t}").to_numpy(), rows.column(f"_d_{t}")[0].as_py()
            for label, order in ((f"ffd_{t}", pool[t]), (f"ffdown_{t}", d)):
                x = difference(y, float(order), threshold) if order is not None else np.zeros(0)
                rows = rows.append_column(label, pa.array(np.concatenate([np.full(len(y) - len(x), np.nan), x]), from_pandas=True))
        return rows

    made = [StructField(f"{c}_{t}", DoubleType()) for t in legs for c in ("ffd", "ffdown")]
    out = rows.groupBy("security_id").applyInArrow(transform, StructType([*rows.schema.fields, *made]))
    return out.select(
        "security_id", "date", "close", "adv21", "logp", "logv", *(f"{c}_{t}" for t in legs for c in ("ffd", "ffdown", "d", "adf", "leak")), *(f"fwd{h}" for h in (1, 5, 21, 63)),
    )


def differenced_wide(panel: DataFrame, w: list[float], y: str, name: str) -> DataFrame:
    """security_id, date, y and the convolution of each series with w; null for the first rows."""
    own = panel.select("security_id", "date", y)

    def run(key, rows):
        rows = rows.sort_by("date")
        v = rows.column(y).to_numpy(zero_copy_only=False).astype(float)
        x = np.convolve(v, np.array(w), mode="valid") if len(v) >= len(w) else np.zeros(0)
        return rows.append_column(name, pa.array(np.concatenate([np.full(len(v) - len(x), np.nan), x]), from_pandas=True))

    return own.groupBy("security_id").applyInArrow(run, StructType([*own.schema.fields, StructField(name, DoubleType())]))
