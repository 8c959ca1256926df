"""Queries of the portfolio operators on the wide panel: two strategies, rebalanced at month ends."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import portfolio as p
from ..sources.stored import written
from .registry import both, query, rounded

DAYS = "SELECT date, CAST(row_number() OVER (ORDER BY date) AS INT) AS t FROM (SELECT DISTINCT date FROM {wide}) q"
ENDS = "SELECT CAST(date_trunc('month', date) AS DATE) AS month, max(date) AS date FROM {wide} GROUP BY 1"
PLAN = f"SELECT s AS strategy, e.date, d.t AS fill_t, d.t + 1 AS exec_t FROM (SELECT unnest([1, 2]) AS s) x, ({ENDS}) e JOIN ({DAYS}) d ON d.date = e.date WHERE d.t + 1 <= (SELECT max(t) FROM ({DAYS}) m)"
ASSETS = "SELECT asset, CAST(row_number() OVER (ORDER BY asset) AS INT) AS k FROM (SELECT DISTINCT asset FROM {wide}) q"
HELD = f"""SELECT l.strategy, a.asset, l.exec_t, l.fill_t, l.end_t, CASE WHEN l.strategy = 1 THEN 0.15e0 ELSE (a.k % 3 - 0.9e0) / 6 END AS weight
FROM (SELECT *, lead(exec_t) OVER (PARTITION BY strategy ORDER BY exec_t) - 1 AS end_t FROM ({PLAN}) q) l, ({ASSETS}) a"""
RETS = f"""SELECT asset, t, date, price, price / lag(known) OVER (PARTITION BY asset ORDER BY t) - 1 AS ret FROM (
  SELECT a.asset, d.t, d.date, w.price, last_value(w.price IGNORE NULLS) OVER (PARTITION BY a.asset ORDER BY d.t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS known
  FROM ({ASSETS}) a CROSS JOIN ({DAYS}) d LEFT JOIN {{wide}} w ON w.asset = a.asset AND w.date = d.date) q"""
GROWN = f"""SELECT h.*, r.t, product(1e0 + coalesce(r.ret, 0e0)) OVER (PARTITION BY h.strategy, h.exec_t, h.asset ORDER BY r.t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS growth
FROM ({HELD}) h JOIN ({RETS}) r ON r.asset = h.asset AND r.t >= h.exec_t AND (h.end_t IS NULL OR r.t <= h.end_t)"""
DRIFT = f"SELECT *, weight * growth / value AS drift FROM (SELECT *, 1 + sum(weight * (growth - 1)) OVER (PARTITION BY strategy, exec_t, t) AS value FROM ({GROWN}) q) q"
MOVES = f"""SELECT h.strategy, h.asset, h.exec_t, coalesce(b.drift, 0e0) AS w_before, h.weight AS w_after, abs(h.weight - coalesce(b.drift, 0e0)) AS traded
FROM ({HELD}) h LEFT JOIN (SELECT * FROM ({DRIFT}) q WHERE t = end_t) b ON b.strategy = h.strategy AND b.asset = h.asset AND b.end_t + 1 = h.exec_t"""
COSTS = f"SELECT strategy, exec_t, sum(traded) / 2 AS turnover, least(sum(0.001e0 * traded * CASE WHEN w_after < 0 THEN 1.5e0 ELSE 1e0 END), 0.999e0) AS cost FROM ({MOVES}) q GROUP BY ALL"
CURVE = f"""SELECT strategy, t, equity, equity / coalesce(lag(equity) OVER (PARTITION BY strategy ORDER BY t), 1e0) - 1 AS ret FROM (
  SELECT v.strategy, v.t, v.value * s.start AS equity FROM (SELECT DISTINCT strategy, exec_t, t, value FROM ({DRIFT}) q) v JOIN (
    SELECT strategy, exec_t, product(1 - cost) OVER w * coalesce(product(done) OVER (PARTITION BY strategy ORDER BY exec_t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1e0) AS start
    FROM (SELECT c.*, x.value AS done FROM ({COSTS}) c LEFT JOIN (SELECT DISTINCT strategy, exec_t, value FROM ({DRIFT}) q WHERE t = end_t) x ON x.strategy = c.strategy AND x.exec_t = c.exec_t) q
    WINDOW w AS (PARTITION BY strategy ORDER BY exec_t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) s ON s.strategy = v.strategy AND s.exec_t = v.exec_t) q"""


def parts(i):
    """Calendar, schedule, holdings and returns of two strategies, each stored once: every book below reads these."""
    from pyspark.sql import Window

    prices = written(i.wide, "prices")
    days = written(p.calendar(prices), "days")
    ends = p.month_ends(prices).select("date", F.explode(F.array(F.lit(1), F.lit(2))).alias("strategy"))
    plan = written(p.schedule(ends, days), "plan")
    k = F.row_number().over(Window.orderBy("asset"))
    assets = prices.select("asset").distinct().withColumn("k", k)
    weight = F.when(F.col("strategy") == 1, 0.15).otherwise((F.col("k") % 3 - 0.9) / 6)
    # Every strategy holds every asset at every month's end: as many rows as targets.
    targets = plan.select("strategy", "date").join(F.broadcast(assets), F.lit(True)).select("strategy", "asset", "date", weight.alias("weight"))
    held = written(p.slots(targets, plan), "held")
    return days, plan, held, written(p.returns(prices, days), "rets")


def moved(i):
    days, _, held, rets = parts(i)
    drift = written(p.drifted(held, rets), "drift")
    moves = p.trades(held, drift)
    return days, held, drift, moves, p.rebalances(moves, F.lit(0.001), 1.5)


def curve(i):
    days, _, drift, _, costs = moved(i)
    return days, p.equity(drift, costs)


@query("p02_schedule", f"SELECT strategy, date, fill_t, exec_t FROM ({PLAN}) q")
def _(i):
    return parts(i)[1].select("strategy", "date", "fill_t", "exec_t")


@query("p04_returns", f"SELECT asset, t, round(ret, 6) + 0.0 AS ret FROM ({RETS}) q")
def _(i):
    return rounded(parts(i)[3].select("asset", "t", "ret"))


@query("p01_weights_in_force", f"SELECT h.strategy, h.asset, r.t, round(h.weight, 6) AS weight FROM ({HELD}) h JOIN ({RETS}) r ON r.asset = h.asset AND r.t >= h.exec_t AND (h.end_t IS NULL OR r.t <= h.end_t)")
def _(i):
    _, _, held, rets = parts(i)
    return rounded(p.drifted(held, rets).select("strategy", "asset", "t", "weight"))


@query("p10_drifted_weights", f"SELECT strategy, asset, t, round(drift, 6) + 0.0 AS drift, round(value, 6) AS value FROM ({DRIFT}) q")
def _(i):
    return rounded(moved(i)[2].select("strategy", "asset", "t", "drift", "value"))


@query("p11_rebalance_costs", f"SELECT strategy, exec_t, round(turnover, 6) AS turnover, round(cost, 6) AS cost FROM ({COSTS}) q")
def _(i):
    return rounded(moved(i)[4])


METRICS = f"""SELECT strategy, n, f - 1 AS total_return, pow(f, 252e0 / n) - 1 AS ann_return, sd * sqrt(252e0) AS ann_vol, m * 252 / (sd * sqrt(252e0)) AS sharpe, m * 252 / (down * sqrt(252e0)) AS sortino, m AS expectancy, win AS win_rate, dd AS max_drawdown, add AS avg_drawdown FROM (
  SELECT strategy, count(r) AS n, max_by(equity, t) / min_by(equity, t) AS f, avg(r) AS m, stddev_samp(r) AS sd, stddev_samp(CASE WHEN r < -1e-12 THEN r END) AS down, avg(CASE WHEN r > 1e-12 THEN 1e0 WHEN r IS NOT NULL THEN 0e0 END) AS win, min(d) AS dd, coalesce(avg(CASE WHEN d < -1e-12 THEN d END), 0e0) AS add
  FROM (SELECT *, CASE WHEN row_number() OVER (PARTITION BY strategy ORDER BY t) > 1 THEN ret END AS r, equity / max(equity) OVER (PARTITION BY strategy ORDER BY t) - 1 AS d FROM ({CURVE}) q) q GROUP BY strategy) q"""
NAMES = ("total_return", "ann_return", "ann_vol", "sharpe", "sortino", "expectancy", "win_rate", "max_drawdown", "avg_drawdown")


@query("p16_metrics", f"SELECT strategy, n, {', '.join(f'round({c}, 6) AS {c}' for c in NAMES)} FROM ({METRICS}) q")
def _(i):
    return rounded(p.metrics(curve(i)[1]))


@query("p17_tail_means", f"SELECT strategy, round(avg(ret), 6) AS tail_mean FROM (SELECT *, row_number() OVER (PARTITION BY strategy ORDER BY ret) AS r, ceil(0.05e0 * count(*) OVER (PARTITION BY strategy) - 1e-9) AS k FROM ({CURVE}) q) q WHERE k <= 0 OR r <= k GROUP BY strategy")
def _(i):
    return rounded(p.tail_mean(curve(i)[1], "ret", ["strategy"]))


@query("p07_spreads", "SELECT asset, date, CASE WHEN dv >= 1e9 THEN 0.0005e0 WHEN dv >= 1e8 THEN 0.001e0 WHEN dv >= 1e7 THEN 0.0025e0 WHEN dv >= 1e6 THEN 0.006e0 ELSE 0.015e0 END AS spread FROM (SELECT asset, date, avg(dollar_volume) OVER (PARTITION BY asset ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS dv FROM {wide}) q")
def _(i):
    from pyspark.sql import Window

    w = Window.partitionBy("asset").orderBy("date").rowsBetween(-2, 0)
    return i.wide.select("asset", "date", p.spread(F.avg("dollar_volume").over(w)).alias("spread"))


both("p09_impact", "SELECT asset, date, CASE WHEN adv > 0 THEN round(0.1e0 * sqrt(dollar_volume / adv), 6) END AS impact FROM (SELECT asset, date, dollar_volume, avg(dollar_volume) OVER (PARTITION BY asset ORDER BY date ROWS BETWEEN 20 PRECEDING AND CURRENT ROW) AS adv FROM {wide}) q")
PER_YEAR = "SELECT count(*) - count(DISTINCT date) AS duplicates, count(DISTINCT date) / ({} / 365.25e0) AS a_year FROM {{wide}}"
CALENDAR_CHECK = "SELECT duplicates, round(a_year, 4) AS rows_per_year, NOT a_year BETWEEN 0.5e0 * 252 AND 2e0 * 252 AS off_frequency FROM ({}) q"
both("p23_calendar_checks", CALENDAR_CHECK.format(PER_YEAR.format("datediff(max(date), min(date))")), CALENDAR_CHECK.format(PER_YEAR.format("(max(date) - min(date))")))


@query("p24_month_ends", f"SELECT month, date FROM ({ENDS}) q")
def _(i):
    return p.month_ends(i.wide)


OFF = f"SELECT asset, t, CASE WHEN t = last + 1 THEN -0.3e0 ELSE ret END AS ret FROM ({RETS}) r JOIN (SELECT asset AS a, max(t) AS last FROM ({RETS}) q WHERE price IS NOT NULL GROUP BY asset) l ON l.a = r.asset"


@query("p05_write_off", f"SELECT asset, t, round(ret, 6) + 0.0 AS ret FROM ({OFF}) q")
def _(i):
    return rounded(p.written_off(parts(i)[3], -0.3).select("asset", "t", "ret"))


# ---- what a trade costs: books of 1,000,000 with tiered spreads, commission, impact and borrow fees
CAPITAL, PER_SHARE, LEAST, SHARE, IMPACT, BORROW = 1e6, 0.0037, 0.35, 0.005, 0.1, 0.02
#: Volumes as a source with holes: every fifth day of a month is unknown.
THIN = "SELECT asset, date, CASE WHEN day(date) % 5 <> 0 THEN dollar_volume END AS volume FROM {wide}"
RATES = "SELECT asset, date, CASE WHEN dv >= 1e9 THEN 0.0005e0 WHEN dv >= 1e8 THEN 0.001e0 WHEN dv >= 1e7 THEN 0.0025e0 WHEN dv >= 1e6 THEN 0.006e0 ELSE 0.015e0 END AS rate FROM (SELECT asset, date, avg(dollar_volume) OVER (PARTITION BY asset ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS dv FROM {wide}) q"
AT = f"SELECT h.strategy, h.asset, h.exec_t, h.fill_t, d.date, h.weight FROM ({HELD}) h JOIN ({DAYS}) d ON d.t = h.fill_t"


def thin(i):
    return i.wide.select("asset", "date", F.when(F.dayofmonth("date") % 5 != 0, F.col("dollar_volume")).alias("volume"))


def rates(i):
    from pyspark.sql import Window

    w = Window.partitionBy("asset").orderBy("date").rowsBetween(-2, 0)
    return i.wide.select("asset", "date", p.spread(F.avg("dollar_volume").over(w)).alias("rate"))


def fills(i):
    """held by execution with the date of its fill row."""
    days, _, held, rets = parts(i)
    return held.join(F.broadcast(days.select(F.col("t").alias("fill_t"), "date")), "fill_t"), rets, days


@query("p03_tradable_targets", f"""SELECT a.strategy, a.asset, a.exec_t, round(CASE WHEN r.price IS NULL THEN 0e0 ELSE a.weight END, 6) AS weight, round(r.known, 6) AS fill_price
FROM ({AT}) a LEFT JOIN ({RETS.replace("ret FROM (", "ret, known FROM (", 1)}) r ON r.asset = a.asset AND r.t = a.fill_t""")
def _(i):
    _, _, held, rets = parts(i)
    return rounded(p.tradable(held, rets).select("strategy", "asset", "exec_t", "weight", "fill_price"))


@query("p06_vanished_holdings", f"SELECT h.strategy, count(DISTINCT CASE WHEN l.last < (SELECT max(t) FROM ({DAYS}) m) THEN h.asset END) AS n FROM ({HELD}) h JOIN (SELECT w.asset, max(d.t) AS last FROM {{wide}} w JOIN ({DAYS}) d ON d.date = w.date WHERE w.price IS NOT NULL GROUP BY w.asset) l ON l.asset = h.asset WHERE h.weight <> 0 GROUP BY h.strategy")
def _(i):
    _, _, held, rets = parts(i)
    return p.vanished(held, rets)


@query("p22_fail_closed_fill", f"""
SELECT a.asset, a.date, round(coalesce(r.rate, (SELECT max(rate) FROM ({RATES}) x)), 6) AS rate, round(coalesce(v.volume, (SELECT min(volume) FROM ({THIN}) y)), 4) AS volume
FROM (SELECT DISTINCT asset, date FROM ({AT}) q) a ASOF LEFT JOIN ({RATES}) r ON r.asset = a.asset AND a.date >= r.date ASOF LEFT JOIN ({THIN}) v ON v.asset = a.asset AND a.date >= v.date""")
def _(i):
    points = fills(i)[0].select("asset", "date").distinct()
    rate, volume = p.in_force(points, rates(i), "rate", "max"), p.in_force(points, thin(i), "volume", "min")
    return rate.join(volume, ["asset", "date"]).select("asset", "date", F.round("rate", 6).alias("rate"), F.round("volume", 4).alias("volume"))


def priced(i):
    """Trades with the rate, price and volume in force at their fill row; drifted weights; borrow fees; the calendar. All stored."""
    at, rets, days = fills(i)
    drift = written(p.drifted(at.drop("date"), rets), "drift")
    points = at.select("asset", "exec_t", "fill_t", "date").distinct()
    met = points.join(p.in_force(points, rates(i), "rate", "max"), ["asset", "date"]).join(p.in_force(points, thin(i), "volume", "min"), ["asset", "date"])
    known = rets.select("asset", F.col("t").alias("fill_t"), F.col("known").alias("price"))
    moves = p.trades(at, drift).join(met.join(known, ["asset", "fill_t"], "left"), ["asset", "exec_t"], "left")
    return written(moves, "moves"), drift, written(p.borrowed(drift, F.lit(BORROW)), "fees"), days


PRICED = f"""SELECT m.strategy, m.asset, m.exec_t, m.w_after, m.traded, coalesce(r.rate, (SELECT max(rate) FROM ({RATES}) x)) AS rate, coalesce(v.volume, (SELECT min(volume) FROM ({THIN}) y)) AS volume, k.known AS price
FROM ({MOVES}) m JOIN (SELECT DISTINCT asset, exec_t, fill_t, date FROM ({AT}) q) a ON a.asset = m.asset AND a.exec_t = m.exec_t
ASOF LEFT JOIN ({RATES}) r ON r.asset = a.asset AND a.date >= r.date ASOF LEFT JOIN ({THIN}) v ON v.asset = a.asset AND a.date >= v.date
LEFT JOIN ({RETS.replace("ret FROM (", "ret, known FROM (", 1)}) k ON k.asset = a.asset AND k.t = a.fill_t"""
FEES = f"""SELECT strategy, t, least(sum(greatest(-w, 0e0)) * 0.02e0 / 252, 0.999e0) AS borrow FROM (
  SELECT strategy, t, CASE WHEN t = exec_t THEN weight ELSE lag(drift) OVER (PARTITION BY strategy, exec_t, asset ORDER BY t) END AS w FROM ({DRIFT}) q) q GROUP BY strategy, t"""


@query("p08_commission", f"SELECT strategy, asset, exec_t, round(CASE WHEN price > 0 AND traded > 0 THEN least(greatest(0.0037e0 * (1e6 * traded) / price, 0.35e0), 0.005e0 * (1e6 * traded)) END, 6) AS commission FROM ({PRICED}) q")
def _(i):
    fee = p.commission(CAPITAL * F.col("traded"), F.col("price"), PER_SHARE, LEAST, SHARE)
    return priced(i)[0].select("strategy", "asset", "exec_t", F.round(fee, 6).alias("commission"))


@query("p09_trade_impact", f"SELECT strategy, asset, exec_t, round(CASE WHEN volume > 0 THEN 0.1e0 * sqrt(1e6 * traded / volume) ELSE 0 END, 6) AS impact FROM ({PRICED}) q")
def _(i):
    return priced(i)[0].select("strategy", "asset", "exec_t", F.round(p.impact(CAPITAL * F.col("traded"), F.col("volume"), IMPACT), 6).alias("impact"))


@query("p12_borrow_cost", f"SELECT strategy, t, round(borrow, 9) AS borrow FROM ({FEES}) q")
def _(i):
    return rounded(priced(i)[2], 9)


# Spread costs alone don't depend on the book's size, so SQL has the whole net curve.
NET_COSTS = f"SELECT strategy, exec_t, sum(traded) / 2 AS turnover, least(sum(rate * traded * CASE WHEN w_after < 0 THEN 1.5e0 ELSE 1e0 END), 0.999e0) AS cost FROM ({PRICED}) q GROUP BY ALL"
NET = f"""SELECT strategy, t, equity, equity / coalesce(lag(equity) OVER (PARTITION BY strategy ORDER BY t), 1e0) - 1 AS ret FROM (
  SELECT c.strategy, c.t, c.equity * product(1 - f.borrow) OVER (PARTITION BY c.strategy ORDER BY c.t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS equity
  FROM ({CURVE.replace(COSTS, NET_COSTS)}) c JOIN ({FEES}) f ON f.strategy = c.strategy AND f.t = c.t) q"""


def net(i):
    moves, drift, fees, _ = priced(i)
    costs = p.rebalances(moves, F.col("rate"), 1.5)
    return p.equity(drift, costs, fees), costs, fees


@query("p13_equity", f"SELECT strategy, t, round(equity, 6) AS equity, round(ret, 6) + 0.0 AS ret FROM ({NET}) q")
def _(i):
    return rounded(net(i)[0])


# With commission and impact a book's costs depend on what it is worth, so SQL goes through the executions one after another.
SIZED = f"""trades AS MATERIALIZED (SELECT m.*, h.k FROM ({PRICED}) m JOIN (SELECT strategy, exec_t, row_number() OVER (PARTITION BY strategy ORDER BY exec_t) AS k FROM (SELECT DISTINCT strategy, exec_t FROM ({HELD}) q) q) h ON h.strategy = m.strategy AND h.exec_t = m.exec_t),
fees AS MATERIALIZED (SELECT * FROM ({FEES}) q), drift AS MATERIALIZED (SELECT DISTINCT strategy, exec_t, end_t, t, value FROM ({DRIFT}) q),
held AS MATERIALIZED (
  SELECT d.strategy, d.exec_t, row_number() OVER (PARTITION BY d.strategy ORDER BY d.exec_t) AS k, coalesce(max(d.value) FILTER (d.t = d.end_t), 1e0) * product(1 - f.borrow) AS held
  FROM drift d JOIN fees f ON f.strategy = d.strategy AND f.t = d.t GROUP BY d.strategy, d.exec_t),
path(strategy, k, exec_t, book, turnover, cost, commission, impact) AS (
  SELECT strategy, 0::BIGINT, NULL::BIGINT, 1e0, 0e0, 0e0, 0e0, 0e0 FROM (SELECT DISTINCT strategy FROM trades) q
  UNION ALL
  SELECT strategy, k, exec_t, book, turnover, least(spread + impact + commission, 0.999e0), commission, impact FROM (
    SELECT b.strategy, t.k, any_value(t.exec_t)::BIGINT AS exec_t, b.book, sum(t.traded) / 2 AS turnover, sum(t.rate * t.traded * CASE WHEN t.w_after < 0 THEN 1.5e0 ELSE 1e0 END) AS spread,
      coalesce(sum(CASE WHEN t.price > 0 AND t.traded > 0 THEN least(greatest(0.0037e0 * (1e6 * b.book * t.traded) / t.price, 0.35e0), 0.005e0 * (1e6 * b.book * t.traded)) END), 0) / (1e6 * b.book) AS commission,
      sum(CASE WHEN t.volume > 0 THEN 0.1e0 * sqrt(1e6 * b.book * t.traded / t.volume) * t.traded ELSE 0 END) AS impact
    FROM (SELECT p.strategy, p.k + 1 AS k, p.book * (1 - p.cost) * coalesce(h.held, 1e0) AS book FROM path p LEFT JOIN held h ON h.strategy = p.strategy AND h.k = p.k) b JOIN trades t ON t.strategy = b.strategy AND t.k = b.k
    GROUP BY b.strategy, t.k, b.book) q)"""
CHARGED = "SELECT strategy, exec_t, book, turnover, cost, commission, impact FROM path WHERE k > 0"
SIZED_CURVE = f"""line AS MATERIALIZED (SELECT strategy, t, equity, equity / coalesce(lag(equity) OVER (PARTITION BY strategy ORDER BY t), 1e0) - 1 AS ret FROM (
  SELECT d.strategy, d.t, c.book * (1 - c.cost) * d.value * product(1 - f.borrow) OVER (PARTITION BY d.strategy, d.exec_t ORDER BY d.t) AS equity
  FROM drift d JOIN ({CHARGED}) c ON c.strategy = d.strategy AND c.exec_t = d.exec_t JOIN fees f ON f.strategy = d.strategy AND f.t = d.t) q)"""


def charged(i):
    """Curve, costs, borrow fees, trades and calendar of books of CAPITAL."""
    moves, drift, fees, days = priced(i)
    costs = p.sized_costs(moves, drift, fees, CAPITAL, PER_SHARE, LEAST, SHARE, IMPACT, 1.5)
    return p.equity(drift, costs, fees), costs, fees, moves, days


def trades_of(moves, costs, days):
    return p.blotter(moves, costs, days, CAPITAL, PER_SHARE, LEAST, SHARE, IMPACT, 1.5)


@query("p14_sized_costs", f"WITH RECURSIVE {SIZED} SELECT strategy, exec_t, round(book, 8) AS book, round(turnover, 8) AS turnover, round(cost, 8) AS cost, round(commission, 8) AS commission, round(impact, 8) AS impact FROM ({CHARGED}) q")
def _(i):
    return rounded(charged(i)[1], 8)


@query("p14_net_equity", f"WITH RECURSIVE {SIZED}, {SIZED_CURVE} SELECT strategy, t, round(equity, 6) AS equity, round(ret, 6) + 0.0 AS ret FROM line")
def _(i):
    return rounded(charged(i)[0])


MONEY = """SELECT m.strategy, d.date, m.asset, CASE WHEN w_before = 0 THEN 'OPEN' WHEN w_after = 0 THEN 'CLOSE' ELSE 'REBALANCE' END AS action, CASE WHEN w_after > w_before THEN 'BUY' ELSE 'SELL' END AS side, w_before, w_after,
    w_after - w_before AS dw, traded AS weight_traded, price, rate * CASE WHEN w_after < 0 THEN 1.5e0 ELSE 1e0 END + CASE WHEN price > 0 THEN least(greatest(0.0037e0 * n / price, 0.35e0), 0.005e0 * n) / n ELSE 0 END
    + CASE WHEN volume > 0 THEN 0.1e0 * sqrt(n / volume) ELSE 0 END AS cost_frac, n AS notional, CASE WHEN price > 0 THEN n / price END AS shares"""
BLOTTER = f"""SELECT *, notional * cost_frac AS cost FROM ({MONEY}
  FROM (SELECT t.*, x.w_before, 1e6 * c.book * t.traded AS n FROM trades t JOIN ({CHARGED}) c ON c.strategy = t.strategy AND c.exec_t = t.exec_t JOIN ({MOVES}) x ON x.strategy = t.strategy AND x.asset = t.asset AND x.exec_t = t.exec_t WHERE t.traded > 1e-12) m
  JOIN ({DAYS}) d ON d.t = m.exec_t - 1) q"""
MONEY_NAMES = {"w_before": 6, "w_after": 6, "dw": 6, "weight_traded": 6, "price": 6, "cost_frac": 8, "notional": 2, "shares": 3, "cost": 3}


@query("p15_blotter", f"WITH RECURSIVE {SIZED} SELECT strategy, date, asset, action, side, {', '.join(f'round({c}, {n}) + 0.0 AS {c}' for c, n in MONEY_NAMES.items())} FROM ({BLOTTER}) q")
def _(i):
    _, costs, _, moves, days = charged(i)
    out = trades_of(moves, costs, days)
    return out.select("strategy", "date", "asset", "action", "side", *(F.round(c, n).alias(c) for c, n in MONEY_NAMES.items()))


def drag_sql(column: str, table: str) -> str:
    return f"(SELECT strategy, product(1 - least(greatest({column}, 0e0), 0.999e0)) AS kept FROM {table} GROUP BY strategy)"


DRAGS = {"cost": f"({CHARGED}) q", "commission": f"({CHARGED}) q", "impact": f"({CHARGED}) q", "borrow": "fees"}
DRAG_SQL = f"""SELECT n.strategy, {', '.join(f'1 - pow({c}_t.kept, 252e0 / n) AS {c}_drag' for c in DRAGS)} FROM (SELECT strategy, count(*) - 1 AS n FROM line GROUP BY strategy) n
  {' '.join(f'JOIN {drag_sql(c, t)} {c}_t ON {c}_t.strategy = n.strategy' for c, t in DRAGS.items())}"""


@query("p18_cost_drag", f"WITH RECURSIVE {SIZED}, {SIZED_CURVE} SELECT strategy, {', '.join(f'round({c}_drag, 6) AS {c}_drag' for c in DRAGS)} FROM ({DRAG_SQL}) q")
def _(i):
    line, costs, fees, *_ = charged(i)
    return rounded(p.comparison(line, costs, fees).select("strategy", *(f"{c}_drag" for c in DRAGS)))


MORE = ("cdar", "cvar_ann", "downside_deviation", "ann_turnover")
COMPARED = f"""SELECT m.*, x.cdar, x.cvar_ann, x.downside_deviation, x.ann_turnover, {', '.join(f'g.{c}_drag' for c in DRAGS)} FROM ({METRICS.replace(f"({CURVE}) q", "line")}) m JOIN (
  SELECT l.strategy, avg(d) FILTER (deep <= ceil(0.05e0 * total - 1e-9)) AS cdar, avg(r) FILTER (low <= ceil(0.05e0 * (total - 1) - 1e-9)) * sqrt(252e0) AS cvar_ann, stddev_samp(r) FILTER (r < -1e-12) * sqrt(252e0) AS downside_deviation, avg(coalesce(c.turnover, 0)) * 252 AS ann_turnover
  FROM (SELECT *, row_number() OVER (PARTITION BY strategy ORDER BY d) AS deep, row_number() OVER (PARTITION BY strategy ORDER BY r NULLS LAST) AS low, count(*) OVER (PARTITION BY strategy) AS total FROM (
    SELECT *, CASE WHEN row_number() OVER (PARTITION BY strategy ORDER BY t) > 1 THEN ret END AS r, equity / max(equity) OVER (PARTITION BY strategy ORDER BY t) - 1 AS d FROM line) q) l
  LEFT JOIN ({CHARGED}) c ON c.strategy = l.strategy AND c.exec_t = l.t GROUP BY l.strategy) x ON x.strategy = m.strategy JOIN ({DRAG_SQL}) g ON g.strategy = m.strategy"""
ALL = (*NAMES, *MORE, *(f"{c}_drag" for c in DRAGS))


@query("p20_comparison", f"WITH RECURSIVE {SIZED}, {SIZED_CURVE} SELECT strategy, {', '.join(f'round({c}, 4) + 0.0 AS {c}' for c in ALL)}, CAST(rank() OVER (ORDER BY sharpe DESC) AS INT) AS place FROM ({COMPARED}) q")
def _(i):
    from pyspark.sql import Window

    line, costs, fees, *_ = charged(i)
    # One row a strategy.
    return rounded(p.comparison(line, costs, fees).drop("n").withColumn("place", F.rank().over(Window.orderBy(F.desc("sharpe")))), 4)


YEARLY = ("total", "vol", "sharpe", "sortino", "max_drawdown", "best", "worst", "win_rate", "turnover", "cost", "borrow", "commission", "impact")


@query("p19_yearly", f"""WITH RECURSIVE {SIZED}, {SIZED_CURVE}
SELECT y.strategy, y.year, periods, {', '.join(f'round({c}, 6) + 0.0 AS {c}' for c in YEARLY)}, coalesce(trades, 0) AS trades, coalesce(rebalances, 0) AS rebalances FROM (
  SELECT l.strategy, l.year, count(*) AS periods, product(1 + ret) - 1 AS total, stddev_samp(ret) * sqrt(252e0) AS vol, avg(ret) * 252 / (stddev_samp(ret) * sqrt(252e0)) AS sharpe, avg(ret) * 252 / (stddev_samp(ret) FILTER (ret < -1e-12) * sqrt(252e0)) AS sortino,
    min(d) AS max_drawdown, max(ret) AS best, min(ret) AS worst, avg(CASE WHEN ret > 1e-12 THEN 1e0 ELSE 0e0 END) AS win_rate, sum(coalesce(turnover, 0)) AS turnover, sum(coalesce(c.cost, 0)) AS cost, sum(f.borrow) AS borrow, sum(coalesce(commission, 0)) AS commission, sum(coalesce(impact, 0)) AS impact
  FROM (SELECT l.*, CAST(year(date) AS INT) AS year, equity / max(equity) OVER (PARTITION BY strategy, year(date) ORDER BY l.t) - 1 AS d FROM line l JOIN ({DAYS}) d ON d.t = l.t) l
  JOIN fees f ON f.strategy = l.strategy AND f.t = l.t LEFT JOIN ({CHARGED}) c ON c.strategy = l.strategy AND c.exec_t = l.t GROUP BY l.strategy, l.year) y
LEFT JOIN (SELECT strategy, CAST(year(date) AS INT) AS year, count(*) AS trades, count(DISTINCT date) AS rebalances FROM ({BLOTTER}) q GROUP BY ALL) b ON b.strategy = y.strategy AND b.year = y.year""")
def _(i):
    line, costs, fees, moves, days = charged(i)
    return rounded(p.yearly(line, days, costs, fees, trades_of(moves, costs, days)))


# ---- walk forward: weights by the inverse of each asset's volatility over 252 rows, held for 63
@query("p21_walk_forward_folds", f"SELECT CAST(fold AS INT) AS fold, CAST(fold * 63 + 1 AS INT) AS train_from, CAST(fold * 63 + 252 AS INT) AS train_to, CAST(fold * 63 + 253 AS INT) AS test_from, CAST(least(fold * 63 + 315, last) AS INT) AS test_to FROM (SELECT last, unnest(range(CAST(ceil((last - 252) / 63e0) AS BIGINT))) AS fold FROM (SELECT max(t) AS last FROM ({DAYS}) q) q) q")
def _(i):
    return p.folds(p.calendar(i.wide), 252, 63)


WALK = f"""SELECT fold, asset, (SELECT date FROM ({DAYS}) d WHERE d.t = fold * 63 + 253) AS date, (1 / sd) / sum(1 / sd) OVER (PARTITION BY fold) AS weight FROM (
  SELECT CAST(fold AS INT) AS fold, asset, stddev_samp(r) AS sd FROM (
    SELECT f.fold, w.asset, w.price / lag(w.price) OVER (PARTITION BY f.fold, w.asset ORDER BY w.date) - 1 AS r
    FROM (SELECT unnest(range(CAST(ceil((max(t) - 252) / 63e0) AS BIGINT))) AS fold FROM ({DAYS}) q) f JOIN ({DAYS}) d ON d.t BETWEEN f.fold * 63 + 1 AND f.fold * 63 + 252 JOIN {{wide}} w ON w.date = d.date) q GROUP BY fold, asset) q"""
WALK_PLAN = f"SELECT 1 AS strategy, w.date, d.t + 1 AS fill_t, d.t + 2 AS exec_t FROM (SELECT DISTINCT date FROM ({WALK}) q) w JOIN ({DAYS}) d ON d.date = w.date WHERE d.t + 2 <= (SELECT max(t) FROM ({DAYS}) m)"
WALK_HELD = f"SELECT l.strategy, w.asset, l.exec_t, l.fill_t, l.end_t, w.weight FROM (SELECT *, lead(exec_t) OVER (PARTITION BY strategy ORDER BY exec_t) - 1 AS end_t FROM ({WALK_PLAN}) q) l JOIN ({WALK}) w ON w.date = l.date"


def steady(rows):
    """Weights of a slice: the inverse of the deviation of an asset's returns."""
    sd = rows.assign(r=rows.groupby("asset")["price"].pct_change(fill_method=None)).groupby("asset")["r"].std()
    inverse = 1 / sd
    return (inverse / inverse.sum()).rename("weight").reset_index()


@query("p21_walk_forward_targets", f"SELECT fold, asset, date, round(weight, 6) AS weight FROM ({WALK}) q")
def _(i):
    prices = written(i.wide.select("asset", "date", "price"), "prices")
    return rounded(p.walk_forward(prices, steady, 252, 63))


@query("p21_walk_forward", f"SELECT t, round(equity, 6) AS equity, round(ret, 6) + 0.0 AS ret FROM ({CURVE.replace(HELD, WALK_HELD)}) q")
def _(i):
    prices = written(i.wide.select("asset", "date", "price"), "prices")
    days = written(p.calendar(prices), "days")
    targets = written(p.walk_forward(prices, steady, 252, 63, days).withColumn("strategy", F.lit(1)), "targets")
    held = p.slots(targets, p.schedule(targets.select("strategy", "date").distinct(), days, lag=1))
    drift = written(p.drifted(held, p.returns(prices, days)), "drift")
    return rounded(p.equity(drift, p.rebalances(p.trades(held, drift), F.lit(0.001), 1.5)).select("t", "equity", "ret"))
