"""Fits against literal computations, row by row."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import diagnostics, fracdiff, identities, series, trend

DAY = dt.date(2020, 1, 1)


def walk(n, seed=0, scale=0.02):
    return np.cumsum(np.random.default_rng(seed).normal(0, scale, n))


def panel(spark, named):
    return spark.createDataFrame([(k, DAY + dt.timedelta(days=i), float(v)) for k, y in named.items() for i, v in enumerate(y)], "security_id long, date date, y double")


def plain_adf(x, most):
    """Least squares by numpy for every lag, the constant as a column."""

    def fit(lag, start):
        dx = np.diff(x)
        a = np.column_stack([x[start:-1], *(dx[start - j : len(dx) - j] for j in range(1, lag + 1)), np.ones(len(dx) - start)])
        y = dx[start:]
        beta = np.linalg.lstsq(a, y, rcond=None)[0]
        left = float(((y - a @ beta) ** 2).sum())
        m, p = a.shape
        return beta[0] / math.sqrt(left / (m - p) * np.linalg.inv(a.T @ a)[0, 0]), m * math.log(left / m) + 2 * p, m

    lag = min(range(most + 1), key=lambda k: fit(k, most)[1])
    stat, _, m = fit(lag, lag)
    return stat, lag, m


def test_adf_against_least_squares():
    for seed, n in enumerate((60, 130, 400, 900)):
        for x in (walk(n, seed), np.random.default_rng(seed).normal(size=n)):
            most = fracdiff.lag_bound(n)
            stat, lag, m, crit = fracdiff.adf(x)
            want = plain_adf(x, most)
            assert math.isclose(stat, want[0], rel_tol=1e-7) and (lag, m) == want[1:] and crit == fracdiff.critical(m)
    assert fracdiff.adf(walk(15)) is None and fracdiff.adf(np.zeros(100)) is None


def plain_difference(y, d, threshold):
    w = [1.0]
    while abs(x := -w[-1] * (d - len(w) + 1) / len(w)) >= threshold and len(w) < 4096:
        w.append(x)
    leak = sum(w)
    w[-1] -= leak
    return [sum(w[k] * y[t - k] for k in range(len(w))) for t in range(len(w) - 1, len(y))], len(w), leak


def test_orders_against_a_plain_search(spark):
    named = {1: walk(500, 1), 2: np.random.default_rng(2).normal(size=420), 3: walk(100, 3), 4: walk(700, 4) + np.linspace(0, 3, 700)}
    got = {r.security_id: r for r in fracdiff.optimal_orders(panel(spark, named), 1e-3).collect()}
    for k, y in named.items():
        want = None
        if len(y) >= 252:
            most, failed = fracdiff.lag_bound(len(y)), None

            def at(d, y=y, most=most):
                x, width, leak = plain_difference(y, d, 1e-3)
                # At d = 0 the one weight is corrected to nothing.
                return None if len(x) < most + 12 or not np.ptp(x) else (*plain_adf(np.array(x), most), width, leak, x)

            for step in range(21):
                d = step * 0.05
                one = at(d)
                if one is None:
                    continue
                if one[0] <= fracdiff.critical(one[2]):
                    for _ in range(6 if failed is not None else 0):
                        mid = (failed + d) / 2
                        if (now := at(mid)) is not None and now[0] <= fracdiff.critical(now[2]):
                            d, one = mid, now
                        else:
                            failed = mid
                    want = d, one
                    break
                failed = d
        r = got[k]
        if want is None:
            assert r.d is None and r.adf is None
        else:
            d, (stat, _, nobs, width, leak, x) = want
            assert math.isclose(r.d, d, abs_tol=1e-9) and math.isclose(r.adf, stat, rel_tol=1e-6) and (r.nobs, r.width) == (nobs, width) and math.isclose(r.leak, leak, abs_tol=1e-9)
            assert math.isclose(r.corr, np.corrcoef(x, y[len(y) - len(x) :])[0, 1], rel_tol=1e-6) and r.crit == fracdiff.critical(nobs)


def test_curve_pooled_and_own_order(spark):
    named = {1: walk(400, 1), 2: walk(300, 2), 3: walk(90, 3)}
    p = panel(spark, named)
    got = {round(r.d, 2): r for r in fracdiff.order_curve(p, (0.4, 1.0), 1e-2).collect()}
    for d in (0.4, 1.0):
        stats, kept = [], 0
        for y in named.values():
            x, width, _ = plain_difference(y, d, 1e-2)
            stats.append(plain_adf(np.array(x), fracdiff.lag_bound(len(y))))
            kept += max(len(y) - width + 1, 0)
        assert math.isclose(got[d].mean_stat, np.mean([s[0] for s in stats]), rel_tol=1e-6) and math.isclose(got[d].kept, kept / 790)
        assert math.isclose(got[d].stationary, np.mean([s[0] <= fracdiff.critical(s[2]) for s in stats]))
    orders = spark.createDataFrame([(1, 0.40004), (2, 0.6), (3, None)], "security_id long, d double")
    assert math.isclose(fracdiff.pooled(orders), 0.50002)
    own = {(r.security_id, r.date): r.ffdown for r in fracdiff.own_order(p, orders, 1e-2).collect()}
    for k, d in ((1, 0.4), (2, 0.6)):
        x, width, _ = plain_difference(named[k], d, 1e-2)
        values = [own[k, DAY + dt.timedelta(days=i)] for i in range(len(named[k]))]
        assert values[: width - 1] == [None] * (width - 1) and np.allclose(values[width - 1 :], x)
    assert len(own) == 700


def test_wide_and_narrow_windows_agree(spark):
    y = {1: walk(800, 1), 2: walk(50, 2)}
    for threshold in (1e-2, 1e-4):
        got = {(r.security_id, r.date): r.ffd for r in trend.differenced(panel(spark, y), 0.4, threshold).collect()}
        for k, v in y.items():
            x, width, _ = plain_difference(v, 0.4, threshold)
            values = [got[k, DAY + dt.timedelta(days=i)] for i in range(len(v))]
            first = min(width - 1, len(v))
            assert values[:first] == [None] * first and np.allclose(values[first:], x)


def test_feature_table(spark):
    named = {1: walk(420, 1), 2: walk(300, 2)}
    rows = [(k, DAY + dt.timedelta(days=i), 50 * math.exp(v), 50 * math.exp(v), 100 + (7 * i * k) % 50) for k, y in named.items() for i, v in enumerate(y)] + [(1, DAY - dt.timedelta(days=1), 0.0, 3.0, 5)]
    df = spark.createDataFrame(rows, "security_id long, date date, close double, adj double, volume long")
    out = fracdiff.feature_table(df, 1e-2).collect()
    assert len(out) == 720
    one = sorted((r for r in out if r.security_id == 1), key=lambda r: r.date)
    logp = [math.log(50 * math.exp(v)) for v in named[1]]
    assert np.allclose([r.logp for r in one], logp) and math.isclose(one[0].fwd21, logp[21] - logp[0], abs_tol=1e-12) and one[-1].fwd1 is None
    orders = {k: fracdiff.optimal_order(np.log(50 * np.exp(y)), 1e-2) for k, y in named.items()}
    pool = np.median([o["d"] for o in orders.values() if o])
    assert math.isclose(one[0].d_p, orders[1]["d"]) and math.isclose(one[0].adf_p, orders[1]["adf"])
    x, width, _ = plain_difference(logp, float(pool), 1e-2)
    assert np.allclose([r.ffd_p for r in one[width - 1 :]], x) and one[0].ffd_p is None
    x, width, _ = plain_difference(logp, round(orders[1]["d"], 3), 1e-2)
    assert np.allclose([r.ffdown_p for r in one[width - 1 :]], x)


def test_gph_against_sums(spark):
    y = {1: walk(300, 5), 2: walk(60, 6)}
    got = {r.security_id: r for r in fracdiff.gph(panel(spark, y)).collect()}
    n, m, v = 300, 17, y[1]
    f = [2 * math.pi * j / n for j in range(1, m + 1)]
    level = [math.log(sum(v[k] * math.cos(w * k) for k in range(n)) ** 2 + sum(v[k] * math.sin(w * k) for k in range(n)) ** 2) for w in f]
    slope = np.polyfit([-math.log(4 * math.sin(w / 2) ** 2) for w in f], level, 1)[0]
    assert list(got) == [1] and math.isclose(got[1].d, slope, rel_tol=1e-8) and math.isclose(got[1].se, math.pi / math.sqrt(24 * m))


def test_flat_windows_are_absent(spark):
    """A scan over moving bars, then 30 equal ones, then moving ones, against a fit of each window by itself."""
    y = [*walk(2000, 7), *[walk(2000, 7)[-1]] * 30, *(walk(2000, 7)[-1] + walk(60, 8))]
    df = panel(spark, {1: y}).withColumn("seg", F.lit(0))
    got = {r.date: r for r in trend.trend_scan(df, (5, 21), scale=True).collect()}
    for i in range(len(y)):
        r = got[DAY + dt.timedelta(days=i)]
        for L, tb, sd in ((5, r.tb_5, r.sd_5), (21, r.tb_21, r.sd_21)):
            held = np.array(y[i - L + 1 : i + 1]) if i >= L - 1 else None
            if held is None or np.ptp(held) == 0:
                assert tb is None and sd is None
            else:
                u = np.arange(L) - (L - 1) / 2
                b = u @ held / (u @ u)
                want = math.sqrt(((held - held.mean() - b * u) ** 2).sum() / (L - 2))
                assert math.isclose(sd, want, rel_tol=1e-9) and math.isclose(tb, b * math.sqrt(u @ u) / want, rel_tol=1e-9, abs_tol=1e-9)


@pytest.mark.parametrize("step", [1e-3, 1e-4, 1e-5, 1e-6])
def test_quiet_windows_after_wild_ones(spark, step):
    """6,900 bars with a quiet stretch of 400, against direct least squares of each window."""
    rng = np.random.default_rng(9)
    move = rng.normal(0, 0.02, 6900)
    move[4000:4400] = rng.normal(0, step, 400)
    y = np.cumsum(move)
    df = panel(spark, {1: y.tolist()}).withColumn("seg", F.lit(0))
    got = trend.trend_scan(df, scale=True).orderBy("date").collect()
    for L in trend.RUNGS:
        u = np.arange(L) - (L - 1) / 2
        held = np.lib.stride_tricks.sliding_window_view(y, L)
        held = held - held[:, -1:]
        held = held - held.mean(axis=1, keepdims=True)
        slope = held @ u / (u @ u)
        sd = np.sqrt(((held - slope[:, None] * u) ** 2).sum(axis=1) / (L - 2))
        tb = slope * math.sqrt(u @ u) / sd
        mine = np.array([r[f"tb_{L}"] for r in got[L - 1 :]])
        assert np.abs(mine - tb).max() < 1e-6
        assert np.abs(np.array([r[f"sd_{L}"] for r in got[L - 1 :]]) / sd - 1).max() < 1e-9
        assert all(r[f"tb_{L}"] is None for r in got[: L - 1])


def test_segments_are_scanned_apart(spark):
    y = walk(60, 4)
    rows = [(1, s, DAY + dt.timedelta(days=30 * s + i), float(y[30 * s + i])) for s in (0, 1) for i in range(30)] + [(2, 0, DAY, 1.0), (3, 0, DAY, None), (3, 0, DAY + dt.timedelta(days=1), 2.0)]
    df = spark.createDataFrame(rows, "security_id long, seg int, date date, y double")
    got = {(r.security_id, r.date): r.tb_5 for r in trend.trend_scan(df, (5,)).collect()}
    alone = {(1, r.date): r.tb_5 for s in (0, 1) for r in trend.trend_scan(df.where(f"security_id = 1 and seg = {s}"), (5,)).collect()}
    assert len(got) == 63 and {k: v for k, v in got.items() if k[0] == 1} == alone and sum(v is None for v in got.values()) == 11


def test_returns_and_means_stay_within_a_segment(spark):
    rows = [(1, s, DAY + dt.timedelta(days=10 * s + i), math.exp(i + s), 1.0 + i, 1) for s in (0, 1) for i in range(4)]
    df = spark.createDataFrame(rows, "security_id long, seg int, date date, adj double, close double, volume long")
    by = ("security_id", "seg")
    out = sorted(trend.dollar_volume_mean(trend.forward_returns(df, (1,), by), 2, by).collect(), key=lambda r: r.date)
    assert [None if r.fwd1 is None else round(r.fwd1, 9) for r in out] == [1, 1, 1, None] * 2 and [r.adv21 for r in out] == [1.0, 1.5, 2.5, 3.5] * 2


def test_controls_are_taken_out(spark):
    rng = np.random.default_rng(3)
    rows = [(i, DAY + dt.timedelta(days=d), *map(float, rng.normal(size=4))) for d in range(3) for i in range(12 if d else 5)]
    df = spark.createDataFrame(rows, "security_id long, date date, s double, a double, b double, c double").withColumn("flat", F.lit(1.0))
    got = {(r.security_id, r.date): r.residual for r in diagnostics.neutralised(df, "s", ["a", "flat", "b", "c"]).collect()}
    for d in (1, 2):
        own = [r for r in rows if r[1] == DAY + dt.timedelta(days=d)]
        a = np.array([[1, *r[3:]] for r in own])
        y = np.array([r[2] for r in own])
        assert np.allclose([got[r[0], r[1]] for r in own], y - a @ np.linalg.lstsq(a, y, rcond=None)[0])
    assert len(got) == 24


def test_new_ids_follow_in_the_order_of_keys(spark):
    held = spark.createDataFrame([("m", 7), ("z", 3)], "code string, id int")
    names = [f"k{i:04d}" for i in range(500)]
    keys = spark.createDataFrame([(x,) for x in [*names[::-1], "m", "m", None, "k0000"]], "code string").repartition(5)
    got = {r.code: r.id for r in identities.stable_ids(keys, held).collect()}
    assert got == {"m": 7, "z": 3} | {x: 8 + k for k, x in enumerate(names)}
    assert {r.code: r.id for r in identities.stable_ids(keys.limit(0), held).collect()} == {"m": 7, "z": 3}


BAR = "security_id long, date date, open double, high double, low double, close double, adjusted_close double, volume long"


def chain(rows, splits, floor):
    """The cleaning chain of one series, row by row. rows: [date, o, h, l, c, adjusted, volume]."""
    rows = sorted(list(r) for r in rows if r[0] >= floor)
    for r in rows:
        if min(r[1:5]) <= 0:
            r[1:] = [None] * 6
        else:
            r[2], r[3] = max(r[1:5]), min(r[1:5])
    parts = []
    for r in rows:
        if not parts or (r[0] - parts[-1][-1][0]).days > 365:
            parts.append([])
        parts[-1].append(r)
    if not parts:
        return []
    rows = next((p for p in parts if len(p) > 5), None) or max(parts, key=len)
    while True:
        live = [k for k, r in enumerate(rows) if r[5] and r[5] > 0]
        found = []
        for a, b, c in zip(live, live[1:], live[2:]):
            jump = abs(math.log(rows[b][5] / rows[a][5]))
            if jump > 0.8 and abs(math.log(rows[c][5] / rows[a][5])) < 0.15 * jump:
                found.append((jump, b))
        gone = set()
        for _, b in sorted(found, reverse=True):
            at = live.index(b)
            if not {live[at - 1], live[at + 1]} & gone:
                gone.add(b)
        if not gone:
            break
        for b in gone:
            rows[b][1:] = [None] * 6
    out, before = [], None
    for r in rows:
        if r[5] and r[5] > 0:
            if before and abs(math.log(r[5]) - math.log(before)) > 2.0 and all(abs((r[0] - d).days) > 5 for d in splits):
                break
            before = r[5]
        out.append(tuple(r))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_build_bars_against_row_by_row(spark, seed):
    rng = np.random.default_rng(seed)
    rows, splits, want = [], [], []
    for k in range(25):
        day, price, own = DAY - dt.timedelta(days=int(rng.integers(0, 60))), 10.0, []
        for _ in range(int(rng.integers(3, 60))):
            day += dt.timedelta(days=int(rng.choice([1, 1, 1, 2, 400], p=[0.5, 0.2, 0.19, 0.1, 0.01])))
            price *= math.exp(rng.normal(0, 0.05))
            shown = price * float(rng.choice([1, 1, 12, 0.05, 0], p=[0.84, 0.06, 0.04, 0.03, 0.03]))
            if rng.random() < 0.02:
                price *= 30
            own.append((day, shown, shown * 1.01, shown * 0.98, shown * float(rng.choice([1.0, 1.05])), shown, 10))
        days = [own[int(rng.integers(len(own)))][0] for _ in range(int(rng.integers(0, 3)))]
        rows += [(k, *r) for r in own]
        splits += [(k, d, 2.0) for d in days]
        want += [(k, *r) for r in chain(own, days, DAY)]
    got = series.build_bars(spark.createDataFrame(rows, BAR).repartition(3), spark.createDataFrame(splits, "security_id long, date date, ratio double"), DAY.isoformat())
    plain = lambda r: tuple(None if x is None or isinstance(x, float) and math.isnan(x) else round(x, 9) if isinstance(x, float) else x for x in r)
    assert sorted(map(plain, map(tuple, got.collect())), key=str) == sorted(map(plain, want), key=str)
