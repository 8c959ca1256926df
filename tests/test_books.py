"""Books against a loop over days and names."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import portfolio as p

DAY = dt.date(2021, 1, 4)


def made(seed, n_days=40, n_assets=5, n_slots=4):
    rng = np.random.default_rng(seed)
    price = 20 * np.exp(np.cumsum(rng.normal(0, 0.03, (n_days, n_assets)), axis=0))
    price[rng.random(price.shape) < 0.08] = np.nan
    price[25:, 0] = np.nan  # a name that stops
    signal = sorted(rng.choice(np.arange(1, n_days - 3), n_slots, replace=False).tolist())
    weight = {t: rng.normal(0.2, 0.3, n_assets) for t in signal}
    return price, signal, weight


def loop(price, signal, weight, rate, volume, capital, per_share, least, share, coefficient, short, fee, mask):
    """Day by day: trade at the start of the day after the signal, earn, pay, drift."""
    n, m = price.shape
    known = price.copy()
    for t in range(1, n):
        known[t] = np.where(np.isnan(known[t]), known[t - 1], known[t])
    w, equity, out, costs = np.zeros(m), 1.0, {}, {}
    for t in range(n):
        cost = 0.0
        if t - 1 in signal:
            book, fees, moved = equity * capital, 0.0, 0.0
            for j in range(m):
                target = weight[t - 1][j] if not (mask and np.isnan(price[t - 1, j])) else 0.0
                size = abs(target - w[j])
                if size > 0:
                    each = rate[j] * (short if target < 0 else 1.0)
                    if book > 0:
                        notional = book * size
                        if known[t - 1, j] > 0:
                            charge = min(max(per_share * notional / known[t - 1, j], least), share * notional)
                            each += charge / notional
                            fees += charge / book
                        if volume[j] > 0:
                            each += coefficient * math.sqrt(notional / volume[j])
                            moved += coefficient * math.sqrt(notional / volume[j]) * size
                    cost += each * size
                w[j] = target
            cost = min(cost, 0.999)
            costs[t] = cost, fees, moved
        if costs:
            r = np.array([(price[t, j] / known[t - 1, j] - 1) if t and price[t, j] == price[t, j] and known[t - 1, j] == known[t - 1, j] else 0.0 for j in range(m)])
            gain = float(w @ r)
            borrow = min(float(np.maximum(-w, 0).sum()) * fee / 252, 0.999)
            equity *= (1 + gain) * (1 - cost) * (1 - borrow)
            w = w * (1 + r) / (1 + gain)
            out[t] = equity
    return out, costs


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("mask", [False, True])
def test_net_equity_against_a_loop(spark, seed, mask):
    price, signal, weight = made(seed)
    n, m = price.shape
    rate, volume = np.array([0.001, 0.002, 0.0005, 0.01, 0.003]), np.array([1e6, 5e6, 0.0, 2e6, 8e5])
    dates = [DAY + dt.timedelta(days=t) for t in range(n)]
    prices = spark.createDataFrame([(j, dates[t], None if np.isnan(price[t, j]) else float(price[t, j])) for t in range(n) for j in range(m)], "asset int, date date, price double")
    days = p.calendar(prices)
    targets = spark.createDataFrame([(1, j, dates[t], float(weight[t][j])) for t in signal for j in range(m)], "strategy int, asset int, date date, weight double")
    rets = p.returns(prices, days)
    held = p.slots(targets, p.schedule(targets.select("strategy", "date").distinct(), days))
    held = p.tradable(held, rets) if mask else held
    drift = p.drifted(held, rets)
    fees = p.borrowed(drift, F.lit(0.05))
    at = held.select("asset", "exec_t", F.col("fill_t").alias("t")).distinct().join(rets.select("asset", "t", F.col("known").alias("price")), ["asset", "t"], "left").drop("t")
    info = spark.createDataFrame([(j, float(rate[j]), float(volume[j])) for j in range(m)], "asset int, rate double, volume double")
    moves = p.trades(held, drift).join(at, ["asset", "exec_t"]).join(info, "asset")
    costs = p.sized_costs(moves, drift, fees, 5e4, 0.01, 1.0, 0.02, 0.1, 1.5).cache()
    got = {r.t - 1: r.equity for r in p.equity(drift, costs, fees).collect()}
    want, charged = loop(price, signal, weight, rate, volume, 5e4, 0.01, 1.0, 0.02, 0.1, 1.5, 0.05, mask)
    assert got.keys() == want.keys() and all(math.isclose(got[t], want[t], rel_tol=1e-9) for t in want)
    for r in costs.collect():
        assert np.allclose((r.cost, r.commission, r.impact), charged[r.exec_t - 1], rtol=1e-9)
    # Without size the curve is that of the spreads alone.
    plain = {r.t - 1: r.equity for r in p.equity(drift, p.rebalances(moves, F.col("rate"), 1.5), fees).collect()}
    want, _ = loop(price, signal, weight, rate, volume, 0.0, 0, 0, 0, 0, 1.5, 0.05, mask)
    assert all(math.isclose(plain[t], want[t], rel_tol=1e-9) for t in want)
    none = {r.strategy: r.n for r in p.vanished(held, rets).collect()}
    assert none == {1: sum(bool(np.isnan(price[-1, j])) for j in range(m))}


def test_a_return_of_nothing_is_no_win(spark):
    curve = spark.createDataFrame([(1, t, 1.0 + x, x) for t, x in enumerate([0.0, 1e-16, -1e-16, 0.01, -0.01])], "strategy int, t int, equity double, ret double")
    assert p.metrics(curve).first().win_rate == 0.25
