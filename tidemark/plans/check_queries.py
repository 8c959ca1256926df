"""Checks and plans whose figures come from other operators: reconciliation with the factors, duplicates, jumps, coverage against
the universe, and the verdict over all checks. The Spark side uses the DataFrame API, the SQL beside it is written apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import factors, quantiles
from ..sources.fixtures import frame, holding
from ..sources.stored import written
from .registry import ORACLE, QUERIES, query, rounded
from .series_queries import FACTORS

DONE = ("ok", "empty", "not_found")


def graded(row: DataFrame, level) -> DataFrame:
    return row.withColumn("level", level)


def factor_rows(i) -> DataFrame:
    return factors.adjustment_factors(i.bars, i.splits, i.dividends)


@query("j01_bars_with_factors", f"SELECT b.security_id, b.date, b.close, round(b.close * f.price_factor, 5) AS adj FROM {{bars}} b JOIN ({FACTORS}) f ON f.security_id = b.security_id AND f.date = b.date")
def _(i):
    return i.bars.join(factor_rows(i), ["security_id", "date"]).select("security_id", "date", "close", F.round(F.col("close") * F.col("price_factor"), 5).alias("adj"))


@query("q11_bar_integrity", """
SELECT *, CASE WHEN duplicates + non_positive + inconsistent = 0 THEN 'PASS' ELSE 'FAIL' END AS level FROM (SELECT
  (SELECT count(*) FROM (SELECT 1 FROM {bars_twice} GROUP BY security_id, date HAVING count(*) > 1) q) AS duplicates,
  (SELECT count(*) FROM {bars_twice} WHERE close <= 0 OR open <= 0 OR high <= 0 OR low <= 0) AS non_positive,
  (SELECT count(*) FROM {bars_twice} WHERE high < low OR close > high OR close < low OR open > high OR open < low) AS inconsistent) q""")
def _(i):
    prices = [F.col(c) for c in ("open", "high", "low", "close")]
    bad = (F.col("high") < F.greatest("open", "low", "close")) | (F.col("low") > F.least("open", "close"))
    # One pass: a key's rows are counted where they meet, its other figures ride along.
    by_key = i.bars_twice.groupBy("security_id", "date").agg(F.count("*").alias("n"), F.count_if(F.least(*prices) <= 0).alias("low"), F.count_if(bad).alias("off"))
    row = by_key.agg(F.count_if(F.col("n") > 1).alias("duplicates"), F.sum("low").alias("non_positive"), F.sum("off").alias("inconsistent"))
    return graded(row, F.when(F.col("duplicates") + F.col("non_positive") + F.col("inconsistent") == 0, "PASS").otherwise("FAIL"))


@query("q13_unexplained_jumps", """
SELECT *, CASE WHEN jumps / CAST(greatest(n, 1) AS DOUBLE) < 0.001e0 THEN 'PASS' ELSE 'WARN' END AS level FROM (
  SELECT count(*) FILTER (WHERE prev > 0 AND close / prev > 2 AND NOT EXISTS (SELECT 1 FROM {splits} s WHERE s.security_id = r.security_id AND s.date = r.date)) AS jumps, count(*) AS n
  FROM (SELECT security_id, date, close, lag(close) OVER (PARTITION BY security_id ORDER BY date) AS prev FROM {bars_dirty}) r) q""")
def _(i):
    prev = F.lag("close").over(Window.partitionBy("security_id").orderBy("date"))
    jumps = i.bars_dirty.select("security_id", "date", "close", prev.alias("prev")).where("prev > 0 and close / prev > 2")
    row = jumps.join(i.splits, ["security_id", "date"], "left_anti").agg(F.count("*").alias("jumps")).crossJoin(F.broadcast(i.bars_dirty.agg(F.count("*").alias("n"))))
    return graded(row, F.when(F.col("jumps") / F.greatest("n", F.lit(1)) < 0.001, "PASS").otherwise("WARN"))


def compared(i) -> DataFrame:
    """Rebuilt against the vendor's adjusted closes. Where the fixture has no vendor value it is the rebuilt one, off by the day."""
    rows = i.vendor.join(factor_rows(i), ["security_id", "date"]).withColumn("rebuilt", F.col("close") * F.col("price_factor"))
    vendor = F.coalesce("vendor", F.col("rebuilt") * (1 + F.pmod(F.dayofmonth("date"), F.lit(4)) / 250))
    return rows.withColumn("vendor", vendor).where("vendor > 0").withColumn("err", F.abs(F.col("rebuilt") - F.col("vendor")) / F.col("vendor"))


COMPARED = f"""SELECT security_id, date, close, vendor, abs(rebuilt - vendor) / vendor AS err FROM (
  SELECT v.security_id, v.date, v.close, f.price_factor * v.close AS rebuilt, coalesce(v.vendor, f.price_factor * v.close * (1 + (day(v.date) % 4) / 250e0)) AS vendor
  FROM {{vendor}} v JOIN ({FACTORS}) f ON f.security_id = v.security_id AND f.date = v.date) q WHERE vendor > 0"""


@query("q17_reconciliation", f"SELECT *, CASE WHEN pct >= 95 THEN 'PASS' ELSE 'WARN' END AS level FROM (SELECT count(*) AS n, round(100e0 * sum(CASE WHEN err <= 0.01e0 THEN 1 ELSE 0 END) / greatest(count(*), 1), 4) AS pct FROM ({COMPARED}) q) q")
def _(i):
    row = compared(i).agg(F.count("*").alias("n"), F.count_if(F.col("err") <= 0.01).alias("within"))
    row = row.select("n", F.round(100.0 * F.col("within") / F.greatest("n", F.lit(1)), 4).alias("pct"))
    return graded(row, F.when(F.col("pct") >= 95, "PASS").otherwise("WARN"))


@query("q18_never_adjusted", f"SELECT c.security_id FROM ({COMPARED}) c JOIN (SELECT DISTINCT security_id AS id FROM {{splits}}) s ON s.id = c.security_id GROUP BY c.security_id HAVING max(abs(vendor - close) / close) < 1e-9")
def _(i):
    own = compared(i).join(i.splits, "security_id", "left_semi")
    return own.groupBy("security_id").agg(F.max(F.abs(F.col("vendor") - F.col("close")) / F.col("close")).alias("off")).where("off < 1e-9").select("security_id")


@query("q19_reconcile", f"SELECT security_id, sum(CASE WHEN err > 0.01e0 THEN 1 ELSE 0 END) AS bad, count(*) AS n, round(max(err), 6) AS worst FROM ({COMPARED}) q GROUP BY security_id HAVING sum(CASE WHEN err > 0.01e0 THEN 1 ELSE 0 END) > 0 ORDER BY bad DESC, security_id LIMIT 25")
def _(i):
    own = compared(i).groupBy("security_id").agg(F.count_if(F.col("err") > 0.01).alias("bad"), F.count("*").alias("n"), F.round(F.max("err"), 6).alias("worst"))
    return own.where("bad > 0").orderBy(F.desc("bad"), "security_id").limit(25)


@query("q19_reconcile_summary", f"SELECT count(*) AS n, sum(CASE WHEN err <= 0.01e0 THEN 1 ELSE 0 END) AS within, round(median(err), 6) AS mid, round(quantile_cont(err, 0.99), 6) AS p99, round(max(err), 6) AS worst, count(DISTINCT security_id) AS n_series, count(DISTINCT CASE WHEN err > 0.01e0 THEN security_id END) AS n_off FROM ({COMPARED}) q")
def _(i):
    off = F.when(F.col("err") > 0.01, F.col("security_id"))
    own = written(compared(i).select("security_id", "err"), "compared")
    at = quantiles.percentiles(own, "err", (0.5, 0.99))
    out = own.agg(F.count("*").alias("n"), F.count_if(F.col("err") <= 0.01).alias("within"), F.lit(at[0.5]).alias("mid"), F.lit(at[0.99]).alias("p99"), F.max("err").alias("worst"), F.countDistinct("security_id").alias("n_series"), F.countDistinct(off).alias("n_off"))
    return rounded(out)


# ---- request log against the universe
@query("l05_coverage", """
SELECT endpoint, done, expected, greatest(expected - done, 0) AS remaining, CASE WHEN done >= expected THEN 'complete' WHEN done = 0 THEN 'not started' ELSE 'partial' END AS state
FROM (SELECT l.endpoint, count(DISTINCT CASE WHEN l.status IN ('ok', 'empty', 'not_found') THEN l.key END) AS done, (SELECT count(*) FROM {securities}) AS expected FROM {ledger} l GROUP BY l.endpoint) q""")
def _(i):
    done = i.ledger.groupBy("endpoint").agg(F.countDistinct(F.when(F.col("status").isin(*DONE), F.col("key"))).alias("done"))
    out = done.crossJoin(F.broadcast(i.securities.agg(F.count("*").alias("expected"))))
    state = F.when(F.col("done") >= F.col("expected"), "complete").when(F.col("done") == 0, "not started").otherwise("partial")
    return out.select("endpoint", "done", "expected", F.greatest(F.col("expected") - F.col("done"), F.lit(0)).alias("remaining"), state.alias("state"))


@query("l06_remaining_plan", """
WITH r AS (SELECT endpoint, max(call_cost) AS cost, greatest((SELECT count(*) FROM {securities}) - count(DISTINCT CASE WHEN status IN ('ok', 'empty', 'not_found') THEN key END), 0) AS remaining FROM {ledger} GROUP BY endpoint)
SELECT a.endpoint, a.remaining, CAST(a.remaining * a.cost AS BIGINT) AS calls, CAST((SELECT sum(b.remaining * b.cost) FROM r b WHERE b.endpoint <= a.endpoint) AS BIGINT) AS running,
  (SELECT sum(b.remaining * b.cost) FROM r b WHERE b.endpoint <= a.endpoint) <= 2000 AS fits FROM r a""")
def _(i):
    held = i.ledger.groupBy("endpoint").agg(F.countDistinct(F.when(F.col("status").isin(*DONE), F.col("key"))).alias("done"), F.max("call_cost").alias("cost"))
    out = held.crossJoin(F.broadcast(i.securities.agg(F.count("*").alias("expected")))).withColumn("remaining", F.greatest(F.col("expected") - F.col("done"), F.lit(0)))
    out = out.withColumn("calls", F.col("remaining") * F.col("cost"))
    # One row an endpoint, so one task orders them.
    return out.withColumn("running", F.sum("calls").over(Window.orderBy("endpoint"))).select("endpoint", "remaining", "calls", "running", (F.col("running") <= 2000).alias("fits"))


@query("r02_delisting_years", """
WITH pick AS (SELECT security_id FROM {securities} WHERE is_delisted ORDER BY md5(CAST(security_id AS VARCHAR) || '|5') LIMIT 20),
y AS (SELECT b.security_id, CAST(year(max(b.date)) AS INT) AS y FROM {bars_gap} b JOIN pick USING (security_id) GROUP BY b.security_id)
SELECT y, count(*) AS n, CAST(round_even(count(*) * ((SELECT count(*) FROM {securities} WHERE is_delisted) / CAST((SELECT count(*) FROM y) AS DOUBLE)), 0) AS BIGINT) AS scaled FROM y GROUP BY y""")
def _(i):
    gone = i.securities.where("is_delisted").select("security_id")
    pick = gone.orderBy(F.md5(F.concat(F.col("security_id").cast("string"), F.lit("|5")).cast("binary"))).limit(20)
    last = i.bars_gap.join(F.broadcast(pick), "security_id").groupBy("security_id").agg(F.year(F.max("date")).alias("y"))
    scale = gone.agg(F.count("*").alias("all")).crossJoin(last.agg(F.count("*").alias("held")))
    return last.groupBy("y").agg(F.count("*").alias("n")).crossJoin(F.broadcast(scale)).select("y", "n", F.bround(F.col("n") * (F.col("all") / F.col("held")), 0).cast("long").alias("scaled"))


# ---- positions n div 4 and n div 2, from counts by value: no group's values are gathered
def positions(rows: DataFrame, group: str, value: str) -> DataFrame:
    """n, p25 and mid of each group: the values at places n div 4 and n div 2 from 0 in ascending order."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("c"))
    upto = Window.partitionBy(group).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    at = counts.withColumns({"end": F.sum("c").over(upto), "n": F.sum("c").over(Window.partitionBy(group))})
    place = lambda k: F.min(F.when(F.col("end") > F.floor(F.col("n") / k), F.col(value)))
    return at.groupBy(group).agg(F.max("n").alias("n"), F.min(value).alias("first"), place(4).alias("p25"), place(2).alias("mid"))


@query("a12_positional_statistics", "SELECT type, v[n // 4 + 1] AS p25, v[n // 2 + 1] AS mid FROM (SELECT type, list_sort(list(security_id)) AS v, count(*) AS n FROM {securities} GROUP BY type) q")
def _(i):
    return positions(i.securities, "type", "security_id").select("type", "p25", "mid")


@query("r01_history_depth", """
SELECT q.type, count(*) AS n, min(q.y) AS earliest, list_sort(list(q.y))[count(*) // 4 + 1] AS p25, list_sort(list(q.y))[count(*) // 2 + 1] AS mid, list_sort(list(q.m))[count(*) // 2 + 1] AS months FROM (
  SELECT s.type, CAST(year(min(b.date)) AS INT) AS y, CAST((year(max(b.date)) - year(min(b.date))) * 12 + month(max(b.date)) - month(min(b.date)) + 1 AS INT) AS m FROM {securities} s JOIN {bars} b ON b.security_id = s.security_id GROUP BY s.type, s.security_id) q GROUP BY q.type""")
def _(i):
    span = i.bars.groupBy("security_id").agg(F.min("date").alias("lo"), F.max("date").alias("hi")).join(i.securities.select("security_id", "type"), "security_id")
    months = (F.year("hi") - F.year("lo")) * 12 + F.month("hi") - F.month("lo") + 1
    own = span.select("type", F.year("lo").alias("y"), months.cast("int").alias("m"))
    y, m = positions(own, "type", "y"), positions(own, "type", "m").select("type", F.col("mid").alias("months"))
    return y.join(m, "type").select("type", "n", F.col("first").alias("earliest"), "p25", "mid", "months")


@query("t03_top_series", "SELECT security_id, count(*) AS n FROM {bars} GROUP BY security_id ORDER BY n DESC, security_id LIMIT 10")
def _(i):
    return i.bars.groupBy("security_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "security_id").limit(10)


# ---- the verdict over every registered check; this module is read after those that register them
CHECKS = [k for k, sql in ORACLE.items() if k[0] == "q" and "level" in sql]


def verdict(spark, sf_dir) -> DataFrame:
    """PASS, WARN or FAIL: the worst of the checks' levels, with how many have each."""
    # Most checks look at the bars, so they are stored once before.
    with holding({"bars": written(frame(spark, sf_dir, "bars"), "bars")}):
        levels = [QUERIES[k](spark, sf_dir).select("level") for k in CHECKS]
    every = levels[0]
    for one in levels[1:]:
        every = every.union(one)
    counts = every.agg(*(F.count_if(F.col("level") == x).alias(x.lower()) for x in ("PASS", "WARN", "FAIL")))
    return counts.withColumn("verdict", F.when(F.col("fail") > 0, "FAIL").when(F.col("warn") > 0, "WARN").otherwise("PASS"))


QUERIES["q20_gate_verdict"] = verdict
ORACLE["q20_gate_verdict"] = (
    "SELECT pass, warn, fail, CASE WHEN fail > 0 THEN 'FAIL' WHEN warn > 0 THEN 'WARN' ELSE 'PASS' END AS verdict FROM (SELECT count_if(level = 'PASS') AS pass, count_if(level = 'WARN') AS warn, count_if(level = 'FAIL') AS fail FROM ("
    + " UNION ALL ".join(f"SELECT level FROM ({ORACLE[k]}) {k}" for k in CHECKS)
    + ") q) q"
)
