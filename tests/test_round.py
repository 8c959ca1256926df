"""Walk forward, blotter and delistings; percentiles, manifests, ingest, documents, ids and rolling deviations against plain versions."""

import datetime as dt
import hashlib
import json
import math
import shutil
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.test_books import loop, made
from tidemark.operators import diagnostics, documents, identities, quantiles, trend
from tidemark.operators import portfolio as p
from tidemark.sources import stored
from tidemark.streaming import requests

DAY = dt.date(2021, 1, 4)


def priced(spark, price):
    n, m = price.shape
    return spark.createDataFrame([(j, DAY + dt.timedelta(days=t), None if np.isnan(price[t, j]) else float(price[t, j])) for t in range(n) for j in range(m)], "asset int, date date, price double")


# ---- walk forward


def walk(n=50, m=3, seed=0):
    rng = np.random.default_rng(seed)
    return 20 * np.exp(np.cumsum(rng.normal(0, 0.03, (n, m)), axis=0))


def test_a_fit_sees_its_training_rows_alone(spark):
    price = walk()
    seen = p.walk_forward(priced(spark, price), lambda own: pd.DataFrame({"asset": own["asset"].unique(), "weight": own["price"].sum() + own.groupby("asset")["date"].count().max()}), 20, 8)
    got = {(r.fold, r.asset): (r.date, r.weight) for r in seen.collect()}
    starts = list(range(20, 50, 8))  # the last test has 6 rows
    assert set(got) == {(k, j) for k in range(len(starts)) for j in range(3)}
    for k, start in enumerate(starts):
        assert got[k, 0][0] == DAY + dt.timedelta(days=start)
        assert math.isclose(got[k, 0][1], price[start - 20 : start].sum() + 20)
    # Whatever comes later changes nothing that was decided before.
    later = price.copy()
    later[36:] *= 3
    again = {(r.fold, r.asset): r.weight for r in p.walk_forward(priced(spark, later), lambda own: pd.DataFrame({"asset": own["asset"].unique(), "weight": own["price"].sum()}), 20, 8).collect()}
    first = {(r.fold, r.asset): r.weight for r in p.walk_forward(priced(spark, price), lambda own: pd.DataFrame({"asset": own["asset"].unique(), "weight": own["price"].sum()}), 20, 8).collect()}
    assert all(again[k, j] == first[k, j] for k, j in first if k <= 2) and again[3, 0] != first[3, 0]


def test_dated_weights_count_in_their_test_alone(spark):
    def fit(own):
        days = pd.date_range(own["date"].max(), periods=12).date  # one training row, then beyond the test
        return pd.DataFrame([(a, d, 1.0) for a in own["asset"].unique()[:2] for d in days], columns=["asset", "date", "weight"])

    out = p.walk_forward(priced(spark, walk(36)), fit, 20, 8).collect()
    assert sorted({(r.fold, (r.date - DAY).days) for r in out}) == [(k, t) for k, a, b in ((0, 20, 28), (1, 28, 36)) for t in range(a, b)]
    assert {r.asset for r in out} == {0, 1}


def test_walk_forward_refuses(spark):
    prices = priced(spark, walk(20))
    with pytest.raises(Exception, match="train and test take 28 rows, there are 20"):
        p.folds(p.calendar(prices), 20, 8).collect()
    with pytest.raises(ValueError, match="positive"):
        p.folds(p.calendar(prices), 0, 8)


# ---- books


def test_blotter_and_sized_costs_with_bounds(spark):
    """Commissions of which all three bounds hold for some trades, against the loop over days."""
    price, signal, weight = made(5, n_days=60, n_slots=8)
    n, m = price.shape
    rate, volume = np.array([0.001, 0.002, 0.0005, 0.01, 0.003]), np.array([1e6, 5e6, 0.0, 2e6, 8e5])
    prices = priced(spark, price)
    days = p.calendar(prices)
    targets = spark.createDataFrame([(1, j, DAY + dt.timedelta(days=t), float(weight[t][j])) for t in signal for j in range(m)], "strategy int, asset int, date date, weight double")
    rets = p.returns(prices, days)
    held = p.slots(targets, p.schedule(targets.select("strategy", "date").distinct(), days))
    drift = p.drifted(held, rets)
    fees = p.borrowed(drift, F.lit(0.05))
    at = held.select("asset", "exec_t", F.col("fill_t").alias("t")).distinct().join(rets.select("asset", "t", F.col("known").alias("price")), ["asset", "t"], "left").drop("t")
    info = spark.createDataFrame([(j, float(rate[j]), float(volume[j])) for j in range(m)], "asset int, rate double, volume double")
    moves = p.trades(held, drift).join(at, ["asset", "exec_t"]).join(info, "asset")
    terms = (5e4, 0.02, 12.0, 0.004, 0.1, 1.5)
    costs = p.sized_costs(moves, drift, fees, *terms).cache()
    want, charged = loop(price, signal, weight, rate, volume, *terms, 0.05, False)
    for r in costs.collect():
        assert np.allclose((r.cost, r.commission, r.impact), charged[r.exec_t - 1], rtol=1e-9)
    got = p.blotter(moves, costs, days, *terms).collect()
    book = {r.exec_t: r.book for r in costs.collect()}
    kinds = set()
    for r in got:
        t = (r.date - DAY).days + 2
        notional = 5e4 * book[t] * r.weight_traded
        assert math.isclose(r.notional, notional, rel_tol=1e-9) and math.isclose(r.dw, r.w_after - r.w_before, abs_tol=1e-15)
        fee = 0.0
        if r.price is not None:
            fee = min(max(0.02 * notional / r.price, 12.0), 0.004 * notional)
            kinds.add((fee == 12.0, math.isclose(fee, 0.004 * notional)))
            assert math.isclose(r.shares, notional / r.price)
        each = rate[r.asset] * (1.5 if r.w_after < 0 else 1.0) + fee / notional + (0.1 * math.sqrt(notional / volume[r.asset]) if volume[r.asset] else 0.0)
        assert math.isclose(r.cost_frac, each, rel_tol=1e-9) and math.isclose(r.cost, notional * each, rel_tol=1e-9)
        assert r.action == ("OPEN" if r.w_before == 0 else "CLOSE" if r.w_after == 0 else "REBALANCE") and r.side == ("BUY" if r.dw > 0 else "SELL")
    assert len(kinds) >= 2
    # A day's trades cost what the execution was charged.
    by_day = {}
    for r in got:
        by_day[(r.date - DAY).days + 2] = by_day.get((r.date - DAY).days + 2, 0.0) + r.cost
    assert all(math.isclose(by_day[t] / (5e4 * book[t]), charged[t - 1][0], rel_tol=1e-9) for t in by_day)
    bare = p.blotter(moves, costs, days, 0.0).first()
    assert bare.notional is None and bare.cost is None and bare.cost_frac > 0


def test_delistings(spark):
    price = np.full((6, 4), 100.0)
    price[3:, 0] = np.nan
    price[4:, 1] = np.nan
    rets = p.returns(priced(spark, price), p.calendar(priced(spark, price)))

    def off(*how):
        return {(r.asset, r.t - 1): r.ret for r in p.written_off(rets, *how).collect() if r.ret}

    assert off(-0.5) == {(0, 3): -0.5, (1, 4): -0.5}
    named = spark.createDataFrame([(0, -1.0), (1, None), (2, -0.25)], "asset int, loss double")
    assert off(named) == {(0, 3): -1.0}  # no return: held flat; a name that prints to the end stays
    dates = spark.createDataFrame([(0, DAY + dt.timedelta(days=4)), (1, None), (2, DAY - dt.timedelta(days=3)), (3, DAY + dt.timedelta(days=9))], "asset int, date date")
    assert off(-0.5, dates) == {(0, 5): -0.5}  # before the calendar, at its end and without a date: none
    gap = spark.createDataFrame([(a, DAY + dt.timedelta(days=t), 10.0) for a in (0, 1) for t in (0, 1, 2, 6, 7)], "asset int, date date, price double")
    own = p.returns(gap, p.calendar(gap))
    weekend = spark.createDataFrame([(1, DAY + dt.timedelta(days=4))], "asset int, date date")
    assert {(r.asset, r.date): r.ret for r in p.written_off(own, -0.3, weekend).collect() if r.ret} == {(1, DAY + dt.timedelta(days=6)): -0.3}
    with pytest.raises(ValueError, match="-1 or more"):
        p.written_off(rets, -1.5)
    with pytest.raises(Exception, match="a delisting return must be -1 or more, not -1.5"):
        p.written_off(rets, spark.createDataFrame([(0, -1.5)], "asset int, loss double")).collect()


def test_what_books_refuse(spark):
    twice = spark.createDataFrame([(1, DAY, 10.0), (1, DAY, 11.0)], "asset int, date date, price double")
    with pytest.raises(Exception, match="two prices of an asset on 2021-01-04"):
        p.calendar(twice).collect()
    with pytest.raises(Exception, match="prices without a date"):
        p.calendar(spark.createDataFrame([(1, None, 10.0)], "asset int, date date, price double")).collect()
    points = spark.createDataFrame([(1, DAY), (2, DAY)], "asset int, date date")
    with pytest.raises(ValueError, match="rate must be 0 or more"):
        p.in_force(points, -0.1, "rate")
    assert {r.asset: r.rate for r in p.in_force(points, 0.2, "rate").collect()} == {1: 0.2, 2: 0.2}
    by_name = spark.createDataFrame([(1, 0.3)], "asset int, rate double")
    assert {r.asset: r.rate for r in p.in_force(points, by_name, "rate").collect()} == {1: 0.3, 2: None}
    assert {r.asset: r.rate for r in p.in_force(points, by_name, "rate", "max").collect()} == {1: 0.3, 2: 0.3}


# ---- statistics


@pytest.mark.parametrize("ranges,most", [(4, 3), (128, 1 << 17)])
def test_percentiles(spark, ranges, most):
    rng = np.random.default_rng(1)
    shares = (0.0, 0.05, 0.25, 0.5, 0.99, 1.0)
    for x in (rng.normal(size=500), np.round(rng.normal(size=400), 1), np.concatenate([np.full(300, 2.0), rng.exponential(1e6, 60), [-1e300, 1e300]]), np.full(9, 7.0), np.array([3.0])):
        df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),)], "e double").repartition(5)
        got = quantiles.percentiles(df, "e", shares, ranges, most)
        assert np.allclose([got[s] for s in shares], np.quantile(x, shares), rtol=1e-12)
    assert quantiles.percentiles(df.limit(0), "e", (0.5,)) == {0.5: None}


def test_rolling_deviation_from_the_median():
    for seed, window, least in ((0, 252, 21), (1, 10, 3), (2, 7, 7)):
        r = np.round(np.random.default_rng(seed).normal(size=1500), 2 if seed else 9)
        want = np.full(len(r), np.nan)
        for t in range(least - 1, len(r)):
            held = r[max(0, t - window + 1) : t + 1]
            want[t] = np.median(np.abs(held - np.median(held)))
        assert np.allclose(diagnostics.rolling_mad(r, window, least, 256), want, rtol=0, atol=1e-15, equal_nan=True)


def test_skip_needs_its_history(spark):
    y = 100 * np.exp(np.cumsum(np.random.default_rng(2).normal(0, 0.01, 300)))
    df = spark.createDataFrame([(1, DAY + dt.timedelta(days=t), float(v)) for t, v in enumerate(y)], "security_id long, date date, close double")
    got = trend.skipped(df).orderBy("date").collect()
    r = np.diff(np.log(y))
    for t, row in enumerate(got):
        assert (row.skip is None) == (t < 252) and (row.skip_vol is None) == (t < 273)
        if t >= 273:
            assert math.isclose(row.skip, math.log(y[t - 21] / y[t - 252]), rel_tol=1e-9)
            assert math.isclose(row.skip_vol, row.skip / r[t - 21 - 252 : t - 21].std(ddof=1), rel_tol=1e-9)


def test_ids_are_the_same_however_often_they_are_computed(spark):
    codes = [f"c{k * 7919 % 1000:04d}" for k in range(600)]
    keys = spark.createDataFrame([(c,) for c in codes], "code string")
    held = spark.createDataFrame([("c0007", 3), ("zz", 9)], "code string, id long")
    new = sorted(set(codes) - {"c0007"})
    want = {"c0007": 3, "zz": 9} | {c: 10 + k for k, c in enumerate(new)}
    out = identities.stable_ids(keys, held)
    assert {r.code: r.id for r in out.collect()} == want
    spark.catalog.clearCache()  # nothing is kept from the first time
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    assert {r.code: r.id for r in out.collect()} == want == {r.code: r.id for r in identities.stable_ids(keys.repartition(11), held).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert {r.code: r.n for r in identities.numbered(keys.distinct(), "code", "n", ranges=5).collect()} == {c: k + 1 for k, c in enumerate(sorted(set(codes)))}
    assert identities.numbered(keys.limit(0), "code").count() == 0


# ---- storage and documents


def test_a_manifest_comes_from_the_write(spark, tmp_path):
    rows = [(i % 5, DAY + dt.timedelta(days=i), None if i % 11 == 0 else float(i % 7 - 1)) for i in range(200)]
    df = spark.createDataFrame(rows, "security_id int, date date, close double")
    path = str(tmp_path / "bars")
    got = stored.build(df, path, {"early": F.col("date") >= DAY + dt.timedelta(days=20), "unpriced": F.col("close") > 0}, {"top": F.max("close")}).first()
    late = [r for r in rows if (r[1] - DAY).days >= 20]
    kept = [r for r in late if r[2] is not None and r[2] > 0]
    assert (got.n_rows, got.dropped_early, got.dropped_unpriced, got.top) == (len(kept), 20, len(late) - len(kept), 5.0)
    assert spark.read.parquet(path).count() == len(kept)
    files = [f.read_bytes() for f in Path(path).rglob("*.parquet")]
    assert (got.n_files, got.bytes) == (len(files), sum(map(len, files)))
    assert got.sha256 == hashlib.sha256(",".join(sorted(hashlib.sha256(f).hexdigest() for f in files)).encode()).hexdigest()


def test_ingest_does_not_read_its_target(spark, tmp_path):
    source, target, check = tmp_path / "in", str(tmp_path / "archive"), str(tmp_path / "check")
    source.mkdir()

    def load(name, rows):
        (source / name).write_text("".join(json.dumps(r) + "\n" for r in rows))
        query = requests.ingest(spark.readStream.schema("key string, body string").json(str(source)), ["key"], target, check)
        query.awaitTermination()
        return query.recentProgress

    load("1.json", [{"key": f"k{i}", "body": "1"} for i in range(50)])
    # The archive moves away: keys are known without it.
    shutil.move(target, tmp_path / "moved")
    load("2.json", [{"key": f"k{i}", "body": "2"} for i in range(45, 55)])
    assert sorted(r.key for r in spark.read.parquet(target).collect()) == ["k50", "k51", "k52", "k53", "k54"]
    last = load("3.json", [{"key": "k54", "body": "3"}, {"key": "k54", "body": "4"}, {"key": "k60", "body": "3"}])
    assert sorted((r.key, r.body) for r in spark.read.parquet(target).collect())[-1] == ("k60", "3")
    assert sum(x["numInputRows"] for x in last) == 3


def test_verification_by_existence(spark):
    ledger = spark.createDataFrame([(1, hashlib.sha256(b"a").hexdigest()), (2, "x"), (3, "y")], "key int, sha string")
    archive = spark.createDataFrame([(1, "a"), (2, "b")], "key int, body string")
    assert {r.outcome: r.n for r in documents.verified(ledger, archive, ["key"]).collect()} == {"ok": 1, "corrupt": 1, "missing": 1}
    there = documents.verified(ledger, archive, ["key"], full=False)
    assert {r.outcome: r.n for r in there.collect()} == {"ok": 2, "missing": 1}
    archive.write.mode("overwrite").parquet(f"{stored.shared_dir(spark)}/verify")
    plan = documents.verified(ledger, spark.read.parquet(f"{stored.shared_dir(spark)}/verify"), ["key"], full=False)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<key:int>" in plan


def test_documents_as_variants(spark):
    full = {"General": {"UpdatedAt": "2026-01-02"}, "Financials": {"Income_Statement": {"yearly": {"2020-12-31": {}, "2018-12-31": {"a": 1}}, "quarterly": {"2020-03-31": None}}}, "outstandingShares": {"annual": {}, "quarterly": {"0": {"shares": 1}}}}
    bodies = {1: json.dumps(full), 2: '{"General": {', 3: "{}", 4: json.dumps({"Financials": {"Income_Statement": {"yearly": {}, "quarterly": None}}, "outstandingShares": None}), 5: "[]"}
    universe = spark.createDataFrame([(i, "ETF" if i == 3 else "Common Stock", False) for i in range(1, 7)], "security_id int, type string, is_delisted boolean")
    docs = spark.createDataFrame(list(bodies.items()), "security_id int, body string")
    got = {r.security_id: r for r in documents.coverage(universe, docs).collect()}
    assert set(got) == {1, 3, 4, 5, 6}  # what can't be read has no row, what isn't there has one
    one = got[1]
    assert (one.n_annual_periods, one.n_quarterly_periods, one.first_fiscal_year, one.last_fiscal_year, one.has_financials, one.has_shares, one.updated_at, one.doc_bytes) == (2, 1, "2018-12-31", "2020-12-31", True, True, "2026-01-02", len(bodies[1]))
    assert got[3].is_etf and not one.is_etf
    for k in (3, 4, 5, 6):
        assert (got[k].n_annual_periods, got[k].has_financials, got[k].has_shares, got[k].first_fiscal_year) == (0, False, False, None)
    lists = spark.createDataFrame([(json.dumps([{"Code": "A", "Name": "One", "Currency": None}, {"Code": "B", "CountryISO2": "BB"}]),), ("no list",), ("[]",)], "body string")
    assert sorted((r.code, r.name, r.currency, r.country_iso2) for r in documents.exchanges(lists, "2026-01-01").where("code is not null").collect()) == [("A", "One", None, None), ("B", None, None, "BB")]


def test_a_block_that_is_not_there(spark):
    df = spark.createDataFrame([(1, "NYSE", "ETF"), (2, "NYSE", "Fund"), (3, None, "ETF")], "security_id int, venue string, type string")
    assert sorted(r.security_id for r in documents.block_selector(df, " etf ").collect()) == [1, 3]
    assert [r.security_id for r in documents.block_selector(df, "fund · nyse").collect()] == [2]
    with pytest.raises(Exception, match="no block is named bond"):
        documents.block_selector(df, "bond").collect()
