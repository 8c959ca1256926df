"""Queries of the per-series fits, streams' batch twins, documents to tables, and signal diagnostics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import diagnostics, documents, factors, fracdiff, identities, trend
from ..sources import stored
from ..streaming import requests
from .registry import both, query, rounded
from .series_queries import CALM, calm, scan_sql


@query("d04_adf_tests")
def _(i):
    return rounded(fracdiff.adf_tests(calm(i)))


@query("d04_adf_lag0", f"""SELECT security_id, round(slope / sqrt(sse / (n - 2) / sxx), 4) AS stat, n FROM (
  SELECT security_id, regr_slope(dy, y0) AS slope, regr_syy(dy, y0) - regr_slope(dy, y0) * regr_sxy(dy, y0) AS sse, regr_sxx(dy, y0) AS sxx, regr_count(dy, y0) AS n
  FROM (SELECT security_id, y - lag(y) OVER w AS dy, lag(y) OVER w AS y0 FROM ({CALM}) q WINDOW w AS (PARTITION BY security_id ORDER BY date)) q GROUP BY security_id) q""")
def _(i):
    from pyspark.sql import Window

    y0 = F.lag("y").over(Window.partitionBy("security_id").orderBy("date"))
    own = calm(i).select("security_id", (F.col("y") - y0).alias("dy"), y0.alias("y0"))
    a = own.groupBy("security_id").agg(F.regr_slope("dy", "y0").alias("b"), F.regr_syy("dy", "y0").alias("syy"), F.regr_sxy("dy", "y0").alias("sxy"), F.regr_sxx("dy", "y0").alias("sxx"), F.regr_count("dy", "y0").alias("n"))
    return a.select("security_id", F.round(F.col("b") / F.sqrt((F.col("syy") - F.col("b") * F.col("sxy")) / (F.col("n") - 2) / F.col("sxx")), 4).alias("stat"), "n")


@query("d05_critical_values", "SELECT security_id, n, round(-2.86154e0 - 2.8903e0 / n - 4.234e0 / (n * n) - 40.04e0 / (n * n * n), 8) AS crit5 FROM (SELECT security_id, CAST(count(*) AS DOUBLE) AS n FROM {bars} GROUP BY security_id) q")
def _(i):
    n = i.bars.groupBy("security_id").agg(F.count("*").cast("double").alias("n"))
    return n.select("security_id", "n", F.round(fracdiff.critical_column(F.col("n")), 8).alias("crit5"))


@query("d06_optimal_orders")
def _(i):
    return rounded(fracdiff.optimal_orders(calm(i)))


@query("d07_order_curve")
def _(i):
    return rounded(fracdiff.order_curve(calm(i)), 4)


@query("d08_pooled_order")
def _(i):
    own = fracdiff.optimal_orders(calm(i)).where("d is not null")
    return rounded(own.agg(F.count("*").alias("n"), F.median("d").alias("pooled"), *(F.percentile("d", q).alias(f"p{int(q * 100)}") for q in (0.05, 0.25, 0.75, 0.95))))


@query("d09_gph", f"""SELECT security_id, round(regr_slope(ln(i), -ln(4 * pow(sin(f / 2), 2))), 4) AS d, round(pi() / sqrt(24e0 * m), 6) AS se FROM (
  SELECT security_id, m, f, pow(sum(y * cos(f * k)), 2) + pow(sum(y * sin(f * k)), 2) AS i FROM (
    SELECT *, 2 * pi() * j / n AS f FROM (SELECT *, unnest(range(1, m + 1)) AS j FROM (SELECT security_id, y, row_number() OVER (PARTITION BY security_id ORDER BY date) - 1 AS k, count(*) OVER (PARTITION BY security_id) AS n, CAST(floor(sqrt(count(*) OVER (PARTITION BY security_id))) AS INT) AS m FROM ({CALM}) q) q WHERE n >= 64 AND m >= 8) q) q
  GROUP BY security_id, m, n, j, f) q GROUP BY security_id, m""")
def _(i):
    return fracdiff.gph(calm(i)).select("security_id", F.round("d", 4).alias("d"), F.round("se", 6).alias("se"))


@query("d10_own_order")
def _(i):
    panel = calm(i)
    return rounded(fracdiff.own_order(panel, fracdiff.optimal_orders(panel)))


# ---- streams' batch twins
@query("z02_ledger_state", "SELECT endpoint, key, max_by(status, ts) AS status, max_by(bytes, ts) AS bytes, count(*) AS attempts, CAST(sum(call_cost) AS BIGINT) AS call_cost FROM {ledger} GROUP BY endpoint, key")
def _(i):
    return requests.ledger_state(i.ledger)


@query("z03_spend_per_day", "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(sum(call_cost) AS BIGINT) AS calls FROM {ledger} GROUP BY 1")
def _(i):
    return requests.spend_per_day(i.ledger).withColumn("day", F.col("day").cast("date").cast("string"))


@query("z03_rate_over_cap", "SELECT CAST(epoch(s) AS BIGINT) AS start_s, count(*) AS n FROM (SELECT unnest([time_bucket(INTERVAL 10 SECOND, ts) - INTERVAL 10 SECOND * k FOR k IN range(6)]) AS s FROM {ledger}) q GROUP BY s HAVING count(*) > 1")
def _(i):
    return requests.rate_over_cap(i.ledger, 1).select(F.unix_timestamp("start").alias("start_s"), "n")


# ---- documents to tables
@query("b02_securities_merge", """SELECT c_custkey AS code, active, delisted, delisted AND NOT active AS is_delisted, coalesce(nullif(a, ''), nullif(d, '')) AS name FROM (
  SELECT c_custkey, bool_or(o_orderstatus = 'O') AS active, bool_or(o_orderstatus = 'F') AS delisted, max(CASE WHEN o_orderstatus = 'O' THEN CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_name END END) AS a, max(CASE WHEN o_orderstatus = 'F' THEN c_name END) AS d
  FROM {orders} JOIN {customer} ON c_custkey = o_custkey WHERE o_orderstatus IN ('O', 'F') GROUP BY c_custkey) q""")
def _(i):
    listed = i.orders.where("o_orderstatus in ('O', 'F')").join(i.customer, F.col("c_custkey") == F.col("o_custkey"))
    rows = listed.select(F.col("c_custkey").alias("code"), (F.col("o_orderstatus") == "O").alias("a"), F.when((F.col("o_orderstatus") == "O") & (F.col("c_custkey") % 4 == 0), "").otherwise(F.col("c_name")).alias("name"))
    out = rows.groupBy("code").agg(F.bool_or("a").alias("active"), F.bool_or(~F.col("a")).alias("delisted"), F.min_by("name", F.when(F.col("name") != "", F.when(F.col("a"), 0).otherwise(1)).otherwise(9)).alias("name"))
    return out.select("code", "active", "delisted", (F.col("delisted") & ~F.col("active")).alias("is_delisted"), F.nullif(F.col("name"), F.lit("")).alias("name"))


@query("b03_stable_ids", "SELECT code, CAST(CASE WHEN security_id < 60 THEN security_id ELSE 59 + row_number() OVER (PARTITION BY security_id >= 60 ORDER BY code) END AS BIGINT) AS id FROM {securities}")
def _(i):
    held = i.securities.where("security_id < 60").select("code", F.col("security_id").alias("id"))
    return identities.stable_ids(i.securities.select("code"), held)


STATED = "SELECT document, statement, period_end, max(flag) AS flag, sum(quantity) AS quantity, sum(price) AS price, sum(tax) AS tax FROM {statements} GROUP BY document, statement, period_end"


@query("b08_financials_unpivot", f"SELECT document, statement, period_end, item, round(value, 4) AS value FROM (SELECT document, statement, period_end, unnest(['quantity', 'price', 'tax', 'flag']) AS item, TRY_CAST(unnest([CAST(quantity AS VARCHAR), CAST(price AS VARCHAR), CAST(tax AS VARCHAR), flag]) AS DOUBLE) AS value FROM ({STATED}) q) q WHERE value IS NOT NULL")
def _(i):
    # As the documents come: JSON of statement to period to items, read back as maps.
    s = i.statements.groupBy("document", "statement", "period_end").agg(F.max("flag").alias("flag"), F.sum("quantity").alias("quantity"), F.sum("price").alias("price"), F.sum("tax").alias("tax"))
    items = F.create_map(*(x for c in ("quantity", "price", "tax", "flag") for x in (F.lit(c), F.col(c).cast("string"))))
    doc = s.groupBy("document").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("statement", F.create_map(F.col("period_end").cast("string"), items))))).alias("body"))
    read = doc.select("document", F.explode(F.from_json("body", "map<string,map<string,map<string,string>>>")).alias("statement", "periods"))
    flat = read.select("document", "statement", F.explode("periods").alias("period_end", "items")).select("document", "statement", F.col("period_end").try_cast("date").alias("period_end"), F.explode("items").alias("item", "raw"))
    return flat.select("document", "statement", "period_end", "item", F.round(F.col("raw").try_cast("double"), 4).alias("value")).where("value is not null")


#: What a document says of a security: yearly and quarterly periods of its statements, and whether any has shares.
PERIODS = "SELECT security_id, concat(CAST(year(period_end) AS STRING), '-12-31') AS y, CASE WHEN month(period_end) % 3 = 0 THEN CAST(period_end AS STRING) END AS q, quantity > 49 AS shares FROM {statements} WHERE security_id % 5 <> 4"


@query("b06_coverage", f"""
SELECT s.security_id, s.type, s.is_delisted, s.type = 'ETF' AS is_etf, coalesce(p.n_annual_periods, 0) > 0 AS has_financials, coalesce(p.n_annual_periods, 0) AS n_annual_periods, coalesce(p.n_quarterly_periods, 0) AS n_quarterly_periods,
  p.first_fiscal_year, p.last_fiscal_year, coalesce(p.has_shares, false) AS has_shares, p.updated_at
FROM {{securities}} s LEFT JOIN (SELECT security_id, count(DISTINCT y) AS n_annual_periods, count(DISTINCT q) AS n_quarterly_periods, min(y) AS first_fiscal_year, max(y) AS last_fiscal_year, bool_or(shares) AS has_shares, '2026-01-02' AS updated_at FROM ({PERIODS}) q GROUP BY security_id) p ON p.security_id = s.security_id
WHERE NOT (s.security_id % 5 = 3 AND p.security_id IS NOT NULL)""")
def _(i):
    rows = i.statements.where("security_id % 5 <> 4").select("security_id", F.concat(F.year("period_end").cast("string"), F.lit("-12-31")).alias("y"), F.when(F.month("period_end") % 3 == 0, F.col("period_end").cast("string")).alias("q"), (F.col("quantity") > 49).alias("shares"))
    part = lambda c: F.transform(F.collect_set(c), lambda k: F.struct(k.alias("k"), F.create_map(F.lit("totalRevenue"), F.lit("1")).alias("v")))
    held = rows.groupBy("security_id").agg(part("y").alias("y"), part("q").alias("q"), F.bool_or("shares").alias("shares"))
    shares = F.when(F.col("shares"), F.create_map(F.lit("0"), F.lit("10"))).otherwise(F.from_json(F.lit("{}"), "map<string,string>"))
    body = F.to_json(F.struct(
        F.struct(F.lit("2026-01-02").alias("UpdatedAt")).alias("General"), F.struct(F.struct(F.map_from_entries("y").alias("yearly"), F.map_from_entries("q").alias("quarterly")).alias("Income_Statement")).alias("Financials"), F.struct(shares.alias("annual")).alias("outstandingShares")
    ))
    # Every fifth document is broken off.
    docs = held.select("security_id", F.when(F.col("security_id") % 5 == 3, F.substring(body, 1, 20)).otherwise(body).alias("body"))
    return documents.coverage(i.securities.select("security_id", "type", "is_delisted"), docs).drop("doc_bytes")

both("b09_shares_long", "SELECT DISTINCT security_id, coalesce(filing_date, period_end) AS date, CAST(quantity AS BIGINT) AS shares FROM {statements} WHERE quantity IS NOT NULL")
both("b04_splits_table", "SELECT event_id, security_id, date, raw, CAST(split_part(raw, '/', 1) AS DOUBLE) AS split_to, CAST(split_part(raw, '/', 2) AS DOUBLE) AS split_from FROM {splits}")
both("b05_dividends_table", "SELECT event_id, security_id, date, round(value, 8) AS value, round(unadjusted_value, 8) AS unadjusted_value FROM {dividends} WHERE date IS NOT NULL")
@query("b01_exchanges_table", "SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name AS name, CASE WHEN n_nationkey % 3 <> 0 THEN concat('X', CAST(n_nationkey AS VARCHAR)) END AS operating_mic, r_name AS country, 'USD' AS currency, CAST(NULL AS VARCHAR) AS country_iso2, upper(substr(n_name, 1, 3)) AS country_iso3, DATE '2026-01-01' AS snapshot_date FROM {nation} JOIN {region} ON r_regionkey = n_regionkey")
def _(i):
    # A document for each region: a list of its exchanges.
    one = F.struct(F.col("n_nationkey").cast("string").alias("Code"), F.col("n_name").alias("Name"), F.when(F.col("n_nationkey") % 3 != 0, F.concat(F.lit("X"), F.col("n_nationkey").cast("string"))).alias("OperatingMIC"), F.col("r_name").alias("Country"), F.lit("USD").alias("Currency"), F.upper(F.substring("n_name", 1, 3)).alias("CountryISO3"))
    docs = i.nation.join(i.region, F.col("r_regionkey") == F.col("n_regionkey")).groupBy("r_regionkey").agg(F.to_json(F.collect_list(one)).alias("body"))
    return documents.exchanges(docs, "2026-01-01")



# ---- diagnostics: the signal is minus the last 5 bars' return, screened and lagged by one bar
SIGNAL = "SELECT security_id, date, lag(s) OVER (PARTITION BY security_id ORDER BY date) AS signal, fwd FROM (SELECT security_id, date, ln(lag(close, 5) OVER w / close) AS s, ln(lead(close, 5) OVER w / close) AS fwd FROM {bars} WINDOW w AS (PARTITION BY security_id ORDER BY date)) q"
both("e01_screen", f"SELECT security_id, date, round(signal, 8) AS signal FROM ({SIGNAL}) q WHERE signal IS NOT NULL AND fwd IS NOT NULL")
RANKED = f"SELECT date, rank() OVER (PARTITION BY date ORDER BY signal) + (count(*) OVER (PARTITION BY date, signal) - 1) / 2e0 AS a, rank() OVER (PARTITION BY date ORDER BY fwd) + (count(*) OVER (PARTITION BY date, fwd) - 1) / 2e0 AS b, signal, fwd FROM (SELECT security_id, date, round(signal, 8) AS signal, round(fwd, 8) AS fwd FROM ({SIGNAL}) q WHERE signal IS NOT NULL AND fwd IS NOT NULL) q"
IC = f"SELECT date, corr(a, b) AS ic, count(*) AS n FROM ({RANKED}) q GROUP BY date HAVING count(*) >= 10 AND stddev_samp(a) > 0 AND stddev_samp(b) > 0"
both("e02_rank_ic", f"SELECT date, n, round(ic, 6) + 0.0e0 AS ic FROM ({IC}) q")
both("e10_era_ic", f"SELECT CAST(year(date) AS INT) AS era, count(*) AS n, round(avg(ic), 6) + 0.0e0 AS mean_ic FROM ({IC}) q GROUP BY year(date)")
both("e04_deciles", f"SELECT decile, count(*) AS n, round(avg(fwd), 6) AS mean_fwd FROM (SELECT fwd, ntile(10) OVER (PARTITION BY date ORDER BY signal, security_id) AS decile FROM (SELECT security_id, date, round(signal, 8) AS signal, fwd FROM ({SIGNAL}) q WHERE signal IS NOT NULL AND fwd IS NOT NULL) q) q GROUP BY decile")
LAGS = 8
both("e03_newey_west", f"SELECT n, round(mean, 6) AS mean, round(mean / sqrt(({' + '.join(['g0', *(f'2 * (1 - {k}e0 / {LAGS + 1}) * g{k}' for k in range(1, LAGS + 1))])}) / n), 4) AS t FROM (SELECT count(*) AS n, max(m) AS mean, " + ", ".join(f"sum(x * coalesce(x{k}, 0e0)) / count(*) AS g{k}" for k in range(LAGS + 1)) + " FROM (SELECT m, x, " + ", ".join(f"lag(x, {k}) OVER (ORDER BY date) AS x{k}" for k in range(LAGS + 1)) + f" FROM (SELECT date, avg(ic) OVER () AS m, ic - avg(ic) OVER () AS x FROM ({IC}) q) q) q) q")
@query("e06_skip_return", """
SELECT security_id, date, round(skip, 6) + 0.0 AS skip, CASE WHEN n >= 252 AND sd > 0 THEN round(skip / sd, 4) + 0.0 END AS skip_vol FROM (
  SELECT security_id, date, ln(lag(close, 21) OVER w / lag(close, 252) OVER w) AS skip, stddev_samp(r) OVER (PARTITION BY security_id ORDER BY date ROWS BETWEEN 272 PRECEDING AND 21 PRECEDING) AS sd, count(r) OVER (PARTITION BY security_id ORDER BY date ROWS BETWEEN 272 PRECEDING AND 21 PRECEDING) AS n
  FROM (SELECT security_id, date, close, ln(close / lag(close) OVER (PARTITION BY security_id ORDER BY date)) AS r FROM {bars}) q WINDOW w AS (PARTITION BY security_id ORDER BY date)) q""")
def _(i):
    return trend.skipped(i.bars).select("security_id", "date", F.round("skip", 6).alias("skip"), F.round("skip_vol", 4).alias("skip_vol"))


@query("e06_skip_surface", f"SELECT security_id, date, {', '.join(f'lag(tb_{L}, 21) OVER (PARTITION BY security_id ORDER BY date) AS tb_{L}' for L in trend.RUNGS)} FROM ({scan_sql(False)}) q")
def _(i):
    out = trend.skipped_surface(trend.trend_scan(calm(i)))
    return out.select("security_id", "date", *(F.round(f"tb_{L}", 4 if L > 10 else 3).alias(f"tb_{L}") for L in trend.RUNGS))

both("e11_truncated_targets", "SELECT count(*) AS n, count(fwd) AS n_known, round(1 - count(fwd) / CAST(count(*) AS DOUBLE), 6) AS truncated FROM (SELECT lead(close, 63) OVER (PARTITION BY security_id ORDER BY date) AS fwd FROM {bars}) q")
both("e13_volatility_target", "SELECT asset, date, CASE WHEN sd > 1e-9 THEN round(least(0.1e0 / (sd * sqrt(252e0)), 2e0), 6) END AS leverage FROM (SELECT asset, date, stddev_samp(r) OVER (PARTITION BY asset ORDER BY date ROWS BETWEEN 21 PRECEDING AND 1 PRECEDING) AS sd FROM (SELECT asset, date, price / lag(price) OVER (PARTITION BY asset ORDER BY date) - 1 AS r FROM {wide}) q) q")


@query("e15_point_in_time", "SELECT b.security_id, b.date, s.filing_date AS as_of, round(s.value, 6) AS value FROM {bars} b ASOF JOIN (SELECT security_id % 100 AS security_id, filing_date, sum(price) AS value FROM {statements} GROUP BY security_id % 100, filing_date) s ON s.security_id = b.security_id AND b.date >= s.filing_date")
def _(i):
    s = i.statements.groupBy((F.col("security_id") % 100).alias("security_id"), F.col("filing_date").alias("date")).agg(F.sum("price").alias("value"))
    out = factors.asof_backward(i.bars.select("security_id", "date"), s, ["security_id"], ["value"]).where("as_of is not null")
    return rounded(out)


@query("j09_asof_backward", "SELECT b.security_id, b.date, s.date AS as_of, s.ratio FROM {bars} b ASOF JOIN (SELECT security_id, date, max(ratio) AS ratio FROM {splits} GROUP BY security_id, date) s ON s.security_id = b.security_id AND b.date >= s.date")
def _(i):
    s = i.splits.groupBy("security_id", "date").agg(F.max("ratio").alias("ratio"))
    return factors.asof_backward(i.bars.select("security_id", "date"), s, ["security_id"], ["ratio"]).where("as_of is not null")


# ---- documents: scan, facts
@query("s01_document_scan", """
SELECT l.key AS doc_id, CASE WHEN d.doc_id IS NULL THEN 'missing' WHEN d.doc_id % 7 = 0 THEN 'unreadable' ELSE 'ok' END AS outcome
FROM (SELECT doc_id + CASE WHEN doc_id % 50 = 3 THEN 1000000000 ELSE 0 END AS key FROM {documents} WHERE doc_id % 3 <> 0) l LEFT JOIN {documents} d ON d.doc_id = l.key""")
def _(i):
    key = F.col("doc_id") + F.when(F.col("doc_id") % 50 == 3, 1_000_000_000).otherwise(0)
    ledger = i.documents.select(key.alias("key"), F.when(F.col("doc_id") % 3 == 0, "http_error").otherwise("ok").alias("status"))
    body = F.when(F.col("doc_id") % 7 == 0, "{\"cut").otherwise(F.to_json(F.struct("doc_id", "lang")))
    read, skipped = documents.scan(ledger, i.documents.select(F.col("doc_id").alias("key"), body.alias("body")), ["key"])
    return read.select(F.col("key").alias("doc_id"), F.lit("ok").alias("outcome")).union(skipped.select("key", "reason"))


@query("b07_general", """
SELECT s.s_suppkey AS security_id, s.s_name || '.' || CAST(s.s_nationkey AS VARCHAR) AS api_ticker, s.s_name AS name, CASE WHEN s.s_suppkey % 9 <> 0 THEN n.n_name END AS sector, DATE '1990-01-01' + CAST(s.s_suppkey AS INT) AS ipo_date,
  s.s_suppkey % 3 = 0 AS is_delisted, CASE WHEN s.s_suppkey % 3 = 0 THEN DATE '2020-01-01' + CAST(s.s_suppkey AS INT) END AS delisted_date, s.s_suppkey * 3 AS full_time_employees,
  round(s.s_acctbal, 2) AS market_cap, round(s.s_acctbal / 7, 4) AS pe_ratio, CASE WHEN s.s_suppkey % 4 <> 1 THEN round(s.s_acctbal / 9, 4) END AS trailing_pe, CAST(s.s_suppkey * 1000 AS DOUBLE) AS shares_outstanding, round(s.s_suppkey / 8e0, 4) AS beta
FROM {supplier} s JOIN {nation} n ON n.n_nationkey = s.s_nationkey WHERE s.s_suppkey % 5 <> 1""")
def _(i):
    k = F.col("s_suppkey")
    own = i.supplier.join(i.nation, F.col("n_nationkey") == F.col("s_nationkey"))
    text = lambda c: c.cast("string")
    general = F.create_map(
        F.lit("Type"), F.when(k % 5 == 1, "ETF").otherwise("Common Stock"), F.lit("Name"), F.col("s_name"), F.lit("Sector"), F.when(k % 9 == 0, "").otherwise(F.col("n_name")), F.lit("IPODate"), text(F.date_add(F.lit("1990-01-01").cast("date"), k.cast("int"))),
        F.lit("IsDelisted"), text(k % 3 == 0), F.lit("DelistedDate"), F.when(k % 3 == 0, text(F.date_add(F.lit("2020-01-01").cast("date"), k.cast("int")))).otherwise("0000-00-00"), F.lit("FullTimeEmployees"), text((k * 3).cast("double")),
    )
    figures = F.create_map(F.lit("MarketCapitalization"), text(F.round("s_acctbal", 2)), F.lit("PERatio"), text(F.round(F.col("s_acctbal") / 7, 4)))
    valuation = F.when(k % 4 != 1, F.create_map(F.lit("TrailingPE"), text(F.round(F.col("s_acctbal") / 9, 4))))
    body = F.to_json(F.create_map(F.lit("General"), general, F.lit("Highlights"), figures, F.lit("Valuation"), valuation, F.lit("SharesStats"), F.create_map(F.lit("SharesOutstanding"), text(k * 1000)), F.lit("Technicals"), F.create_map(F.lit("Beta"), text(F.round(k / 8.0, 4)))))
    docs = own.select(k.alias("security_id"), F.concat_ws(".", "s_name", F.col("s_nationkey").cast("string")).alias("api_ticker"), body.alias("body"))
    out = documents.company_facts(docs)
    return out.select("security_id", "api_ticker", "name", "sector", "ipo_date", "is_delisted", "delisted_date", "full_time_employees", "market_cap", "pe_ratio", "trailing_pe", "shares_outstanding", "beta")


@query("s05_declared_schema", "SELECT CAST(security_id AS INTEGER) AS security_id, date, TRY_CAST(raw_close AS DOUBLE) AS close, CAST(volume AS BIGINT) AS volume, CAST(NULL AS DOUBLE) AS open FROM (SELECT *, CASE WHEN volume % 3 = 0 THEN 'n/a' ELSE CAST(CAST(volume AS BIGINT) * 2 AS VARCHAR) END AS raw_close FROM {bars} WHERE security_id % 4 <> 0) q")
def _(i):
    close = F.when(F.col("volume") % 3 == 0, "n/a").otherwise((F.col("volume") * 2).cast("string"))
    raw = i.bars.select(F.when(F.col("security_id") % 4 != 0, F.col("security_id").cast("string")).alias("security_id"), F.col("date").cast("string").alias("date"), close.alias("close"), F.col("volume").cast("double").alias("volume"), "adjusted_close")
    return stored.declared(raw, stored.BARS).select("security_id", "date", "close", "volume", "open")


# ---- diagnostics with controls, robust paths, buckets, maps and folds
CONTROLS = f"SELECT q.security_id, q.date, q.signal, ln(b.volume + 1) AS c1, ln(b.close) AS c2, ln(b.high / b.low) AS c3 FROM ({SIGNAL}) q JOIN {{bars}} b ON b.security_id = q.security_id AND b.date = q.date WHERE signal IS NOT NULL"
_ON = "CASE WHEN regr_sxx({y}, {x}) OVER d > 1e-12 THEN regr_slope({y}, {x}) OVER d ELSE 0e0 END"
_LESS = "{y} - avg({y}) OVER d - (" + _ON + ") * ({x} - avg({x}) OVER d)"


def _orthogonal() -> str:
    """SQL of one control after the other: what is left of the later ones, and of the signal, after the earlier."""
    one = f"SELECT *, {_LESS.format(y='c2', x='c1')} AS r2, {_LESS.format(y='c3', x='c1')} AS q3, {_LESS.format(y='signal', x='c1')} AS s1 FROM ({CONTROLS}) q WINDOW d AS (PARTITION BY date)"
    two = f"SELECT *, {_LESS.format(y='q3', x='r2')} AS r3, {_LESS.format(y='s1', x='r2')} AS s2 FROM ({one}) q WINDOW d AS (PARTITION BY date)"
    return f"SELECT *, {_LESS.format(y='s2', x='r3')} AS s3, count(*) OVER d AS n FROM ({two}) q WINDOW d AS (PARTITION BY date)"


def signal(i):
    from pyspark.sql import Window

    w = Window.partitionBy("security_id").orderBy("date")
    own = i.bars.withColumns({"s": F.ln(F.lag("close", 5).over(w) / F.col("close")), "fwd": F.ln(F.lead("close", 5).over(w) / F.col("close"))})
    return own.withColumn("signal", F.lag("s").over(w))


@query("e05_neutralised", f"SELECT security_id, date, round(s3, 6) + 0.0 AS residual FROM ({_orthogonal()}) q WHERE n >= 10")
def _(i):
    own = signal(i).where("signal is not null").select("security_id", "date", "signal", F.ln(F.col("volume") + 1).alias("c1"), F.ln("close").alias("c2"), F.ln(F.col("high") / F.col("low")).alias("c3"))
    return rounded(diagnostics.neutralised(own, "signal", ["c1", "c2", "c3"], least=10))


@query("e08_winsorised", """
SELECT security_id, date, round(CASE WHEN n >= 21 THEN greatest(least(r, 3 * m), -3 * m) END, 6) + 0.0 AS clipped, CAST(sum(sign(r)) OVER (PARTITION BY security_id ORDER BY date) AS BIGINT) AS signs FROM (
  SELECT *, mad(r) OVER w AS m, count(r) OVER w AS n FROM (SELECT security_id, date, round(ln(close / lag(close) OVER (PARTITION BY security_id ORDER BY date)), 9) AS r FROM {bars}) q WHERE r IS NOT NULL
  WINDOW w AS (PARTITION BY security_id ORDER BY date ROWS BETWEEN 251 PRECEDING AND CURRENT ROW)) q""")
def _(i):
    from pyspark.sql import Window

    r = F.round(F.ln(F.col("close") / F.lag("close").over(Window.partitionBy("security_id").orderBy("date"))), 9)
    return rounded(diagnostics.robust_paths(i.bars.select("security_id", "date", r.alias("r"))))


BUCKETED = f"""SELECT t.security_id, t.date, t.tb_21, t.tb_21 / (1.39e0 * sqrt(21e0)) AS z, f.fwd FROM ({scan_sql(False)}) t
JOIN (SELECT security_id, date, round(ln(lead(close, 5) OVER (PARTITION BY security_id ORDER BY date) / close), 8) AS fwd FROM {{bars}}) f ON f.security_id = t.security_id AND f.date = t.date WHERE t.tb_21 IS NOT NULL AND f.fwd IS NOT NULL"""


@query("e09_z_buckets", f"""
SELECT CAST(bucket AS INT) AS bucket, CAST(sum(n) AS BIGINT) AS n, count(*) AS n_dates, round(avg(ic), 6) + 0.0 AS mean_ic FROM (
  SELECT date, bucket, count(*) AS n, corr(a, b) AS ic FROM (
    SELECT *, rank() OVER (PARTITION BY date, bucket ORDER BY tb_21) + (count(*) OVER (PARTITION BY date, bucket, tb_21) - 1) / 2e0 AS a, rank() OVER (PARTITION BY date, bucket ORDER BY fwd) + (count(*) OVER (PARTITION BY date, bucket, fwd) - 1) / 2e0 AS b
    FROM (SELECT *, least(floor(abs(z) * 2), 4) AS bucket FROM ({BUCKETED}) q) q) q GROUP BY date, bucket HAVING count(*) >= 5 AND stddev_samp(a) > 0 AND stddev_samp(b) > 0) q GROUP BY bucket""")
def _(i):
    from pyspark.sql import Window

    # The bars lie by security: what comes next is taken before the scan, after which they would be dealt out again.
    fwd = F.round(F.ln(F.lead("close", 5).over(Window.partitionBy("security_id").orderBy("date")) / F.col("close")), 8)
    scanned = trend.trend_scan(calm(i).withColumn("fwd", fwd), (21,), keep=("fwd",)).withColumn("tb_21", F.round("tb_21", 4))
    own = i.dealt(scanned.select("date", "tb_21", "fwd").where("tb_21 is not null and fwd is not null"), "date")
    return rounded(diagnostics.bucket_ic(own.withColumn("z", diagnostics.unit_null("tb_21", 21)), "tb_21", "fwd", least=5))


@query("e12_position_maps", f"""
SELECT security_id, date, round((signal - m) / nullif(l1, 0), 6) + 0.0 AS neutral, CASE WHEN pos > 0 THEN round(greatest(signal, 0e0) / pos, 6) + 0.0 END AS long_only, CASE WHEN place <= ceil(0.2e0 * n) THEN round(1 / ceil(0.2e0 * n), 6) ELSE 0 END AS top
FROM (SELECT *, sum(abs(signal - m)) OVER (PARTITION BY date) AS l1, sum(greatest(signal, 0e0)) OVER (PARTITION BY date) AS pos FROM (
  SELECT security_id, date, signal, avg(signal) OVER (PARTITION BY date) AS m, count(*) OVER (PARTITION BY date) AS n, row_number() OVER (PARTITION BY date ORDER BY signal DESC, security_id) AS place FROM (SELECT security_id, date, round(signal, 8) AS signal FROM ({SIGNAL}) q WHERE signal IS NOT NULL) q) q) q WHERE l1 > 1e-9""")
def _(i):
    own = signal(i).where("signal is not null").select("security_id", "date", F.round("signal", 8).alias("signal"))
    return rounded(diagnostics.position_maps(own, "signal", 0.2).select("security_id", "date", "neutral", "long_only", "top"))


@query("e14_purged_folds", """
WITH d AS (SELECT row_number() OVER (ORDER BY date) AS t, count(*) OVER () AS n FROM (SELECT DISTINCT date FROM {wide}) q), g AS (SELECT t, (t - 1) * 5 // n AS g FROM d),
e AS (SELECT g, min(t) AS a, max(t) AS b FROM g GROUP BY g), s AS (SELECT x.g AS one, y.g AS two, x.a AS a1, x.b AS b1, y.a AS a2, y.b AS b2 FROM e x JOIN e y ON x.g < y.g)
SELECT CAST(one AS INT) AS one, CAST(two AS INT) AS two, count(*) FILTER (WHERE t BETWEEN a1 AND b1 OR t BETWEEN a2 AND b2) AS n_test, count(*) FILTER (WHERE NOT (t BETWEEN a1 - 252 AND b1 + 21 OR t BETWEEN a2 - 252 AND b2 + 21)) AS n_train FROM s, g GROUP BY one, two""")
def _(i):
    from ..operators import portfolio

    return diagnostics.purged_folds(portfolio.calendar(i.wide)).groupBy("one", "two").agg(F.count_if(F.col("role") == "test").alias("n_test"), F.count_if(F.col("role") == "train").alias("n_train"))


def ic_of(bars: int) -> str:
    """SQL: date and rank correlation of minus the last `bars` bars' return, a bar late, with the next five."""
    s = f"SELECT security_id, date, round(lag(s) OVER (PARTITION BY security_id ORDER BY date), 8) AS signal, round(fwd, 8) AS fwd FROM (SELECT security_id, date, ln(lag(close, {bars}) OVER w / close) AS s, ln(lead(close, 5) OVER w / close) AS fwd FROM {{bars}} WINDOW w AS (PARTITION BY security_id ORDER BY date)) q"
    ranked = f"SELECT date, rank() OVER (PARTITION BY date ORDER BY signal) + (count(*) OVER (PARTITION BY date, signal) - 1) / 2e0 AS a, rank() OVER (PARTITION BY date ORDER BY fwd) + (count(*) OVER (PARTITION BY date, fwd) - 1) / 2e0 AS b FROM ({s}) q WHERE signal IS NOT NULL AND fwd IS NOT NULL"
    return f"SELECT date, corr(a, b) AS ic FROM ({ranked}) q GROUP BY date HAVING count(*) >= 10 AND stddev_samp(a) > 0 AND stddev_samp(b) > 0"


@query("e03_paired_difference", f"SELECT n, round(m, 6) AS mean, round(m / sqrt(({' + '.join(['g0', *(f'2 * (1 - {k}e0 / {LAGS + 1}) * g{k}' for k in range(1, LAGS + 1))])}) / n), 4) AS t FROM (SELECT count(*) AS n, max(m) AS m, " + ", ".join(f"sum(x * coalesce(x{k}, 0e0)) / count(*) AS g{k}" for k in range(LAGS + 1)) + " FROM (SELECT m, x, " + ", ".join(f"lag(x, {k}) OVER (ORDER BY date) AS x{k}" for k in range(LAGS + 1)) + f" FROM (SELECT date, avg(v) OVER () AS m, v - avg(v) OVER () AS x FROM (SELECT a.date, a.ic - b.ic AS v FROM ({ic_of(5)}) a JOIN ({ic_of(20)}) b ON b.date = a.date) q) q) q) q")
def _(i):
    from pyspark.sql import Window

    w = Window.partitionBy("security_id").orderBy("date")
    back = lambda bars: F.ln(F.lag("close", bars).over(w) / F.col("close"))
    own = i.by_security().withColumns({"s5": back(5), "s20": back(20), "fwd": F.round(F.ln(F.lead("close", 5).over(w) / F.col("close")), 8)})
    own = own.select("date", "fwd", *(F.round(F.lag(f"s{k}").over(w), 8).alias(f"s{k}") for k in (5, 20)))
    own = own.select("date", "fwd", F.explode(F.array(*(F.struct(F.lit(k).alias("bars"), F.col(f"s{k}").alias("signal")) for k in (5, 20)))).alias("_s"))
    own = own.select("date", "fwd", "_s.*").where("signal is not null and fwd is not null")
    each = diagnostics.rank_ic(i.dealt(own, "date", "bars"), ["date", "bars"], "signal", "fwd", 10)
    days = each.groupBy("date").agg(*(F.max(F.when(F.col("bars") == k, F.col("ic"))).alias(f"ic{k}") for k in (5, 20)))
    both_ = days.select("date", (F.col("ic5") - F.col("ic20")).alias("v")).where("v is not null")
    return diagnostics.newey_west(both_, "v", LAGS).select("n", F.round("mean", 6).alias("mean"), F.round("t", 4).alias("t"))


@query("d12_feature_table")
def _(i):
    return rounded(fracdiff.feature_table(i.by_security().select("security_id", "date", "close", F.col("close").alias("adj"), "volume")))
