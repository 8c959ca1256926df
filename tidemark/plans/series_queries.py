"""Queries of the cleaning, factor, trend and differencing operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import factors, series, trend
from .registry import both, query, rounded

FLOOR = "1996-01-01"
ROWS = "security_id, date, round(open, 8) AS open, round(high, 8) AS high, round(low, 8) AS low, round(close, 8) AS close, round(adjusted_close, 8) AS adjusted_close, volume"
BAR_COLUMNS = ("security_id", "date", *series.PRICES, "adjusted_close", "volume")


def bar_rows(df):
    return rounded(df.select(*BAR_COLUMNS), 8)


@query("f03_date_floor", f"SELECT {ROWS} FROM {{bars}} WHERE date >= DATE '{FLOOR}'")
def _(i):
    return bar_rows(series.date_floor(i.bars, FLOOR))


BLANK = "SELECT security_id, date, " + ", ".join(f"CASE WHEN least(open, high, low, close) <= 0 THEN NULL ELSE {c} END AS {c}" for c in series.BLANKED) + " FROM {bars_dirty}"
CLAMP = f"SELECT security_id, date, open, greatest(open, high, low, close) AS high, least(open, high, low, close) AS low, close, adjusted_close, volume FROM ({BLANK}) q"


@query("c01_blank_non_positive", f"SELECT {ROWS} FROM ({BLANK}) q")
def _(i):
    return bar_rows(series.blank_non_positive(i.bars_dirty))


@query("c02_clamp_range", f"SELECT {ROWS} FROM ({CLAMP}) q")
def _(i):
    return bar_rows(series.clamp_range(series.blank_non_positive(i.bars_dirty)))


SEG = """SELECT *, sum(CASE WHEN date - before > 365 THEN 1 ELSE 0 END) OVER (PARTITION BY security_id ORDER BY date) AS seg
FROM (SELECT *, lag(date) OVER (PARTITION BY security_id ORDER BY date) AS before FROM {bars_gap}) q"""


@query("c03_gap_segments", f"SELECT security_id, date, CAST(seg AS BIGINT) AS seg FROM ({SEG}) q")
def _(i):
    return series.gap_segments(i.bars_gap).select("security_id", "date", "seg")


@query("c04_listing_span", f"""
WITH s AS ({SEG}), n AS (SELECT security_id, seg, count(*) AS n FROM s GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY security_id ORDER BY (n > 5) DESC, CASE WHEN n > 5 THEN seg ELSE 0 END, n DESC, seg) AS k FROM n)
SELECT s.security_id, s.date, round(close, 8) AS close FROM s JOIN r ON s.security_id = r.security_id AND s.seg = r.seg AND k = 1""")
def _(i):
    return rounded(series.listing_span(i.bars_gap).select("security_id", "date", "close"), 8)


ISOLATED = """SELECT security_id, date, adjusted_close FROM (SELECT *, lag(adjusted_close) OVER w AS prev, lead(adjusted_close) OVER w AS next
FROM {bars_dirty} WHERE adjusted_close > 0 WINDOW w AS (PARTITION BY security_id ORDER BY date)) q
WHERE abs(ln(adjusted_close / prev)) > 0.8 AND abs(ln(next / prev)) < 0.15 * abs(ln(adjusted_close / prev))"""


@query("c05_isolated_prints", ISOLATED)
def _(i):
    return series.isolated_prints(i.bars_dirty).select("security_id", "date", "adjusted_close")


@query("c06_neutralize_prints")
def _(i):
    return bar_rows(series.neutralize_prints(i.bars_dirty))


GUARD = "SELECT DISTINCT security_id, CAST(unnest(range(date - INTERVAL 5 DAY, date + INTERVAL 6 DAY, INTERVAL 1 DAY)) AS DATE) AS date FROM {splits}"


@query("c07_guard_days", GUARD)
def _(i):
    return series.guard_days(i.splits)


@query("j08_bars_near_splits", f"SELECT security_id, date FROM {{bars}} b WHERE EXISTS (SELECT 1 FROM {{splits}} s WHERE s.security_id = b.security_id AND b.date BETWEEN s.date - 5 AND s.date + 5)")
def _(i):
    return i.bars.join(series.guard_days(i.splits), ["security_id", "date"], "left_semi").select("security_id", "date")


@query("c08_splice_cut", f"""
WITH g AS ({GUARD}), p AS (SELECT security_id, date, abs(ln(adjusted_close) - ln(lag(adjusted_close) OVER (PARTITION BY security_id ORDER BY date))) AS m FROM {{bars_dirty}} WHERE adjusted_close > 0),
c AS (SELECT p.security_id, min(p.date) AS cut FROM p LEFT JOIN g ON g.security_id = p.security_id AND g.date = p.date WHERE m > 2.0 AND g.date IS NULL GROUP BY p.security_id)
SELECT b.security_id, b.date, b.adjusted_close FROM {{bars_dirty}} b LEFT JOIN c ON c.security_id = b.security_id WHERE cut IS NULL OR b.date < cut""")
def _(i):
    return series.splice_cut(i.bars_dirty, i.splits).select("security_id", "date", "adjusted_close")


TRIM = """SELECT e.event_id, e.security_id, e.date FROM {%s} e LEFT JOIN (SELECT security_id, min(date) AS lo, max(date) AS hi FROM {bars_gap} GROUP BY security_id) s ON s.security_id = e.security_id,
(SELECT max(date) AS last FROM {bars_gap}) x WHERE lo IS NULL OR ((e.date <= hi OR hi >= last - 7) AND (e.date >= lo OR lo <= DATE '1996-01-01' + 365))"""


@query("c09_trim_events", TRIM % "dividends")
def _(i):
    return series.trim_events(i.dividends, i.bars_gap, FLOOR).select("event_id", "security_id", "date")


@query("c10_build_bars")
def _(i):
    return bar_rows(series.build_bars(i.bars_dirty, i.splits, FLOOR))


# The dirty bars as a panel, for the reversal rule.
PANEL = "SELECT security_id, date, close, adjusted_close AS adj, volume FROM {bars_dirty} WHERE adjusted_close > 0 AND close > 0"
FLAGS = f"""SELECT security_id, date, adj, close, volume, coalesce(reach > 0 OR lag(reach) OVER w > 1 OR lag(reach, 2) OVER w > 2, false) AS bad FROM (
  SELECT *, CASE WHEN abs(y - p) >= 0.8 THEN CASE WHEN abs(y1 - p) < 0.15 * abs(y - p) THEN 1 WHEN abs(y2 - p) < 0.15 * abs(y - p) THEN 2 WHEN abs(y3 - p) < 0.15 * abs(y - p) THEN 3 ELSE 0 END ELSE 0 END AS reach
  FROM (SELECT *, ln(adj) AS y, lag(ln(adj)) OVER w AS p, lead(ln(adj)) OVER w AS y1, lead(ln(adj), 2) OVER w AS y2, lead(ln(adj), 3) OVER w AS y3 FROM ({PANEL}) q WINDOW w AS (PARTITION BY security_id ORDER BY date)) q) q
WINDOW w AS (PARTITION BY security_id ORDER BY date)"""
LEVELS = f"""SELECT *, sum(CASE WHEN abs(ln(adj) - ln(q0)) > 1.6 OR date - d0 > 365 THEN 1 ELSE 0 END) OVER (PARTITION BY security_id ORDER BY date) AS seg
FROM (SELECT *, lag(adj) OVER w AS q0, lag(date) OVER w AS d0 FROM ({FLAGS}) q WHERE NOT bad WINDOW w AS (PARTITION BY security_id ORDER BY date)) q"""
KEPT = f"SELECT *, ln(adj) - avg(ln(adj)) OVER (PARTITION BY security_id, seg) AS y FROM (SELECT *, count(*) OVER (PARTITION BY security_id, seg) AS n FROM ({LEVELS}) q) q WHERE n >= 5"


def panel(i):
    return i.bars_dirty.select("security_id", "date", "close", F.col("adjusted_close").alias("adj"), "volume")


@query("f04_admissible", f"SELECT security_id, date, adj, close FROM ({PANEL}) q")
def _(i):
    return series.admissible(panel(i)).select("security_id", "date", "adj", "close")


@query("c11_reversal_flags", f"SELECT security_id, date, bad FROM ({FLAGS}) q")
def _(i):
    return series.reversal_flags(series.admissible(panel(i))).select("security_id", "date", F.coalesce("bad", F.lit(False)).alias("bad"))


@query("c12_level_segments", f"SELECT security_id, date, CAST(seg AS BIGINT) AS seg FROM ({LEVELS}) q")
def _(i):
    return series.level_segments(series.reversal_flags(series.admissible(panel(i))).where("not coalesce(bad, false)")).select("security_id", "date", "seg")


@query("c13_long_segments", f"SELECT security_id, date, CAST(seg AS BIGINT) AS seg FROM (SELECT *, count(*) OVER (PARTITION BY security_id, seg) AS n FROM ({LEVELS}) q) q WHERE n >= 5")
def _(i):
    cut = series.level_segments(series.reversal_flags(series.admissible(panel(i))).where("not coalesce(bad, false)"))
    return series.long_segments(cut).select("security_id", "date", "seg")


@query("c14_centred", f"SELECT security_id, date, round(y, 6) + 0.0 AS y FROM ({KEPT}) q")
def _(i):
    return rounded(series.trend_panel(panel(i)).select("security_id", "date", "y"))


@query("c15_filing_date", "SELECT document, line, period_end, CASE WHEN filing_date >= period_end THEN filing_date END AS filing_date, count(*) AS n FROM {statements} GROUP BY ALL")
def _(i):
    own = i.laid("statements", lineitem="l_orderkey", orders="o_orderkey")
    return own.select("document", "line", "period_end", series.filing_date().alias("filing_date")).groupBy("document", "line", "period_end", "filing_date").agg(F.count("*").alias("n"))


PREV = "SELECT *, lag(close IGNORE NULLS) OVER (PARTITION BY security_id ORDER BY date) AS prev_close FROM {bars}"
DIV = f"""SELECT d.event_id, d.security_id, d.date, b.date AS bar_date, coalesce(d.unadjusted_value, d.value) AS val, b.prev_close
FROM {{dividends}} d ASOF JOIN ({PREV}) b ON d.security_id = b.security_id AND b.date >= d.date"""
DIV_OK = f"SELECT * FROM ({DIV}) q WHERE bar_date - date <= 7 AND val > 0 AND prev_close > 0 AND val / prev_close < 0.95"
FACTORS = f"""
SELECT security_id, date, exp(sum(ln(sf)) OVER a - sum(ln(sf)) OVER u) AS split_factor, exp(sum(ln(pf)) OVER a - sum(ln(pf)) OVER u) AS price_factor FROM (
  SELECT b.security_id, b.date, coalesce(s.f, 1e0) AS sf, coalesce(s.f, 1e0) * coalesce(v.f, 1e0) AS pf FROM {{bars}} b
  LEFT JOIN (SELECT security_id, date, product(1e0 / ratio) AS f FROM {{splits}} WHERE ratio > 0 GROUP BY ALL) s ON s.security_id = b.security_id AND s.date = b.date
  LEFT JOIN (SELECT security_id, bar_date AS date, product(1e0 - val / prev_close) AS f FROM ({DIV_OK}) q GROUP BY ALL) v ON v.security_id = b.security_id AND v.date = b.date) q
WINDOW a AS (PARTITION BY security_id), u AS (PARTITION BY security_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


@query("w02_previous_close", f"SELECT security_id, date, round(prev_close, 6) AS prev_close FROM ({PREV}) q")
def _(i):
    return rounded(factors.with_previous_close(i.bars).select("security_id", "date", "prev_close"))


@query("j03_asof_forward", f"SELECT event_id, security_id, date, bar_date, round(prev_close, 6) AS prev_close FROM ({DIV}) q")
def _(i):
    out = factors.asof_forward(i.dividends, factors.with_previous_close(i.bars), ["prev_close"]).where("bar_date is not null")
    return rounded(out.select("event_id", "security_id", "date", "bar_date", "prev_close"))


@query("j03_matched_dividends", f"SELECT event_id, bar_date, round(val, 6) AS val FROM ({DIV_OK}) q")
def _(i):
    return rounded(factors.matched_dividends(i.dividends, i.bars).select("event_id", "bar_date", "val"))


@query("a06_split_products", "SELECT security_id, date, round(product(1e0 / ratio), 6) AS f FROM {splits} WHERE ratio > 0 GROUP BY ALL")
def _(i):
    return rounded(factors.split_products(i.splits))


@query("w03_adjustment_factors", f"SELECT security_id, date, round(split_factor, 6) AS split_factor, round(price_factor, 6) AS price_factor FROM ({FACTORS}) q")
def w03(i):
    return rounded(factors.adjustment_factors(i.bars, i.splits, i.dividends))


@query("w04_split_factors", f"SELECT security_id, date, round(split_factor, 6) AS split_factor, round(split_factor, 6) AS price_factor FROM ({FACTORS}) q")
def _(i):
    return rounded(factors.adjustment_factors(i.bars, i.splits))


ALPHA = f"SELECT security_id, date, close, high, low, volume, close * price_factor AS adj, split_factor FROM {{bars}} JOIN ({FACTORS}) f USING (security_id, date)"


def alpha(i):
    return factors.alpha_panel(i.bars, factors.adjustment_factors(i.bars, i.splits, i.dividends))


@query("s11_alpha_panel", f"SELECT security_id, date, round(close, 8) AS close, volume, round(adj, 5) AS adj, round(split_factor, 6) AS split_factor FROM ({ALPHA}) q")
def _(i):
    return alpha(i).select("security_id", "date", F.round("close", 8).alias("close"), "volume", F.round("adj", 5).alias("adj"), F.round("split_factor", 6).alias("split_factor"))


@query("w05_adv21", "SELECT security_id, date, round(avg(close * volume) OVER (PARTITION BY security_id ORDER BY date ROWS BETWEEN 20 PRECEDING AND CURRENT ROW), 6) AS adv21 FROM {bars}")
def _(i):
    return rounded(trend.dollar_volume_mean(i.bars).select("security_id", "date", "adv21"), 6)


CALM = "SELECT security_id, date, 0 AS seg, ln(close) - avg(ln(close)) OVER (PARTITION BY security_id) AS y, close AS adj, close, volume FROM {bars}"


def calm(i):
    return series.centred(i.by_security().select("security_id", "date", F.lit(0).alias("seg"), F.col("close").alias("adj"), "close", "volume"))


@query("w06_forward_returns", "SELECT security_id, date, " + ", ".join(f"round(lead(ln(close), {h}) OVER w - ln(close), 6) + 0.0 AS fwd{h}" for h in (1, 5, 21, 63)) + " FROM {bars} WINDOW w AS (PARTITION BY security_id ORDER BY date)")
def _(i):
    return rounded(trend.forward_returns(calm(i)).select("security_id", "date", "fwd1", "fwd5", "fwd21", "fwd63"))


def scan_sql(scale: bool) -> str:
    cols = []
    for L in trend.RUNGS:
        fit = f"CASE WHEN n >= {L} AND syy{L} * (1 - r{L}) > 1e-12 * syy{L} THEN round({{}}, {{}}) END"
        cols.append(fit.format(f"b{L} * sqrt({L * (L * L - 1) / 12.0}e0) / sqrt(syy{L} * (1 - r{L}) / {L - 2})", 4 if L > 10 else 3) + f" + 0.0 AS tb_{L}" if not scale else fit.format(f"sqrt(syy{L} * (1 - r{L}) / {L - 2})", 6) + f" AS sd_{L}")
    inner = ", ".join(f"regr_slope(y, i) OVER w{L} AS b{L}, regr_r2(y, i) OVER w{L} AS r{L}, regr_syy(y, i) OVER w{L} AS syy{L}" for L in trend.RUNGS)
    windows = ", ".join(f"w{L} AS (PARTITION BY security_id, seg ORDER BY date ROWS BETWEEN {L - 1} PRECEDING AND CURRENT ROW)" for L in trend.RUNGS)
    return f"SELECT security_id, date, {', '.join(cols)} FROM (SELECT security_id, date, n, {inner} FROM (SELECT *, row_number() OVER (PARTITION BY security_id, seg ORDER BY date) AS n, CAST(row_number() OVER (PARTITION BY security_id, seg ORDER BY date) AS DOUBLE) AS i FROM ({CALM}) q) q WINDOW {windows}) q"


@query("w07_trend_scan", scan_sql(False))
def _(i):
    out = trend.trend_scan(calm(i))
    return out.select("security_id", "date", *(F.round(f"tb_{L}", 4 if L > 10 else 3).alias(f"tb_{L}") for L in trend.RUNGS))


@query("w08_trend_residuals", scan_sql(True))
def _(i):
    return rounded(trend.trend_scan(calm(i), scale=True).select("security_id", "date", *(f"sd_{L}" for L in trend.RUNGS)))


def ffd_sql(zero: bool, digits: int = 6) -> str:
    """The oldest weight meets the oldest row of a whole window."""
    w, _ = trend.weights(0.4, zero_sum=zero)
    return f"SELECT security_id, date, CASE WHEN len(v) = {len(w)} THEN round(list_inner_product(v, {[float(x) for x in reversed(w)]}::DOUBLE[]), {digits}) + 0.0 END AS ffd FROM (SELECT security_id, date, list(y) OVER (PARTITION BY security_id ORDER BY date ROWS BETWEEN {len(w) - 1} PRECEDING AND CURRENT ROW) AS v FROM ({CALM}) q) q"


@query("d02_fractional_difference", ffd_sql(True))
def _(i):
    return rounded(trend.differenced(calm(i), 0.4).select("security_id", "date", "ffd"))


@query("d03_zero_sum_identity", ffd_sql(True))
def _(i):
    from pyspark.sql import Window

    w, leak = trend.weights(0.4)
    cut = trend.differenced(calm(i), 0.4, zero_sum=False)
    by = Window.partitionBy("security_id").orderBy("date")
    return rounded(cut.select("security_id", "date", (F.col("ffd") - leak * F.lag("y", len(w) - 1).over(by)).alias("ffd")))


@query("d11_memory_correlation", f"SELECT security_id, round(corr(ffd, y), 6) AS memory, count(ffd) AS n FROM (SELECT f.security_id, f.ffd, c.y FROM ({ffd_sql(True, 15)}) f JOIN ({CALM}) c USING (security_id, date)) q GROUP BY security_id")
def _(i):
    return rounded(trend.differenced(calm(i), 0.4).where("ffd is not null").groupBy("security_id").agg(F.corr("ffd", "y").alias("memory"), F.count("ffd").alias("n")))


both("w01_lag_lead", "SELECT security_id, date, round(lag(close) OVER (PARTITION BY security_id ORDER BY date), 6) AS before, round(lead(close) OVER (PARTITION BY security_id ORDER BY date), 6) AS after FROM {bars}")
both("w09_drawdown", "SELECT security_id, date, round(close / max(close) OVER (PARTITION BY security_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1, 6) + 0.0e0 AS drawdown FROM {bars}")
both("w13_trailing_volume", "SELECT asset, date, round(avg(dollar_volume) OVER (PARTITION BY asset ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 3) AS dv3 FROM {wide}")
both("w10_last_known", "SELECT security_id, date, last_value(close) IGNORE NULLS OVER (PARTITION BY security_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM (SELECT security_id, date, CASE WHEN close > 0 THEN close END AS close FROM {bars_dirty}) q",
     "SELECT security_id, date, last_value(close IGNORE NULLS) OVER (PARTITION BY security_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM (SELECT security_id, date, CASE WHEN close > 0 THEN close END AS close FROM {bars_dirty}) q")


@query("q16_factors_valid", f"SELECT *, CASE WHEN invalid = 0 AND not_one = 0 THEN 'PASS' ELSE 'FAIL' END AS level FROM (SELECT count_if(price_factor IS NULL OR price_factor <= 0) AS invalid, count_if(date = last AND abs(price_factor - 1) > 1e-9) AS not_one FROM (SELECT *, max(date) OVER (PARTITION BY security_id) AS last FROM ({FACTORS}) q) q) q")
def _(i):
    f = factors.adjustment_factors(i.bars, i.splits, i.dividends)
    latest = f.groupBy("security_id").agg(F.max_by("price_factor", "date").alias("latest")).agg(F.count_if(F.abs(F.col("latest") - 1) > 1e-9).alias("not_one"))
    out = f.agg(F.count_if(F.col("price_factor").isNull() | (F.col("price_factor") <= 0)).alias("invalid")).crossJoin(latest)
    return out.withColumn("level", F.when((F.col("invalid") == 0) & (F.col("not_one") == 0), "PASS").otherwise("FAIL"))


@query("e07_tent_weighted_return", "SELECT security_id, date, round(" + " + ".join(f"{j * (21 - j)} * lag(r, {j - 1}) OVER w" for j in range(1, 21)) + f", 5) + 0.0 AS tent FROM (SELECT security_id, date, y - lag(y) OVER (PARTITION BY security_id ORDER BY date) AS r FROM ({CALM}) q) q WINDOW w AS (PARTITION BY security_id ORDER BY date)")
def _(i):
    from pyspark.sql import Window

    w = Window.partitionBy("security_id").orderBy("date")
    own = calm(i).withColumn("r", F.col("y") - F.lag("y").over(w))
    total = sum((j * (21 - j) * F.lag("r", j - 1).over(w) for j in range(2, 21)), 20 * F.col("r"))
    return rounded(own.select("security_id", "date", total.alias("tent")), 5)
