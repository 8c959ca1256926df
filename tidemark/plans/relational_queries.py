"""Queries whose SQL is plain relational work: selections, joins, aggregates, set operations, scalar functions, checks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import documents, quantiles
from ..sources import stored
from .registry import both, query, rounded

# ---- sources
both("s02_scan_columns", "SELECT l_orderkey, l_linenumber, l_shipdate FROM {lineitem} WHERE l_quantity > 45")
@query("s06_manifest", """SELECT count(*) FILTER (WHERE NOT early AND NOT blank) AS n_rows, count(*) FILTER (WHERE early) AS dropped_early, count(*) FILTER (WHERE NOT early AND blank) AS dropped_non_positive,
  count(*) FILTER (WHERE NOT early AND NOT blank AND (high <> greatest(open, high, low, close) OR low <> least(open, high, low, close))) AS clamped_ohlc,
  count(*) FILTER (WHERE NOT early AND NOT blank) AS n_stored, true AS has_files FROM (SELECT *, date < DATE '2024-01-05' AS early, least(open, high, low, close) <= 0 AS blank FROM {bars_dirty}) q""")
def _(i):
    # What a build drops and stores, counted by the job that stores it, beside what is read back.
    prices = [F.col(c) for c in ("open", "high", "low", "close")]
    path = f"{stored.shared_dir(i.spark)}/bars-{uuid.uuid4().hex}"
    off = (F.col("high") != F.greatest(*prices)) | (F.col("low") != F.least(*prices))
    made = stored.build(i.bars_dirty, path, {"early": F.col("date") >= "2024-01-05", "non_positive": F.least(*prices) > 0}, {"clamped_ohlc": F.count_if(off)})
    back = i.spark.read.parquet(path).agg(F.count("*").alias("n_stored"))
    return made.crossJoin(back).select("n_rows", "dropped_early", "dropped_non_positive", "clamped_ohlc", "n_stored", ((F.col("n_files") > 0) & (F.col("bytes") > 0) & (F.length("sha256") == 64)).alias("has_files"))


TABLES_HELD = ("customer", "events", "lineitem", "nation", "orders", "part", "region", "supplier")


@query("s07_stored_inventory", " UNION ALL ".join(f"SELECT '{t}' AS dataset, count(*) AS n_rows, true AS has_files FROM {{{t}}}" for t in TABLES_HELD))
def _(i):
    out = stored.inventory(i.spark, {t: f"{i.sf_dir}/{t}.parquet" for t in TABLES_HELD})
    return out.select("dataset", "n_rows", ((F.col("n_files") > 0) & (F.col("bytes") > 0)).alias("has_files"))


both("s07_inventory", " UNION ALL ".join(f"SELECT '{t}' AS dataset, count(*) AS n_rows FROM {{{t}}}" for t in ("customer", "events", "lineitem", "nation", "orders", "part", "region", "supplier")))
both("s10_seeded_sample", "SELECT b.security_id, b.date, b.volume FROM {bars} b JOIN (SELECT security_id FROM (SELECT DISTINCT security_id FROM {bars}) d ORDER BY md5(concat(CAST(security_id AS STRING), '|7')), security_id LIMIT 5) s ON s.security_id = b.security_id")
both("s09_unresolved_keys", "SELECT DISTINCT endpoint, key FROM {ledger} l WHERE NOT EXISTS (SELECT 1 FROM {ledger} r WHERE r.endpoint = l.endpoint AND r.key = l.key AND r.status IN ('ok', 'empty', 'not_found'))")
both("s08_verify_archive", """SELECT outcome, count(*) AS n FROM (
  SELECT CASE WHEN d.doc_id IS NULL THEN 'missing' WHEN sha2(d.text, 256) = l.sha THEN 'ok' ELSE 'corrupt' END AS outcome
  FROM (SELECT doc_id + CASE WHEN doc_id % 50 = 0 THEN 1000000000 ELSE 0 END AS key, CASE WHEN doc_id % 37 = 1 THEN 'x' ELSE sha2(text, 256) END AS sha FROM {documents}) l
  LEFT JOIN {documents} d ON d.doc_id = l.key) q GROUP BY outcome""", """SELECT outcome, count(*) AS n FROM (
  SELECT CASE WHEN d.doc_id IS NULL THEN 'missing' WHEN sha256(d.text) = l.sha THEN 'ok' ELSE 'corrupt' END AS outcome
  FROM (SELECT doc_id + CASE WHEN doc_id % 50 = 0 THEN 1000000000 ELSE 0 END AS key, CASE WHEN doc_id % 37 = 1 THEN 'x' ELSE sha256(text) END AS sha FROM {documents}) l
  LEFT JOIN {documents} d ON d.doc_id = l.key) q GROUP BY outcome""")

#: The log's digests: some keys aren't in the archive, some digests aren't their body's.
LOGGED = "SELECT doc_id + CASE WHEN doc_id % 50 = 0 THEN 1000000000 ELSE 0 END AS key, CASE WHEN doc_id % 37 = 1 THEN 'x' ELSE sha256(text) END AS sha FROM {documents}"


def logged(i):
    key = F.col("doc_id") + F.when(F.col("doc_id") % 50 == 0, 1000000000).otherwise(0)
    return i.documents.select(key.alias("key"), F.when(F.col("doc_id") % 37 == 1, "x").otherwise(F.sha2("text", 256)).alias("sha"))


@query("s08_verify_existence", f"SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN d.doc_id IS NULL THEN 'missing' ELSE 'ok' END AS outcome FROM ({LOGGED}) l LEFT JOIN {{documents}} d ON d.doc_id = l.key) q GROUP BY outcome")
def _(i):
    return documents.verified(logged(i), i.documents.select(F.col("doc_id").alias("key"), F.col("text").alias("body")), ["key"], full=False)


# ---- selections
both("f01_universe", "SELECT security_id, code, venue, type, is_delisted FROM {securities} WHERE source_exchange = 'US' AND venue IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'REGION_0', 'REGION_1', 'REGION_2') AND type IN ('Common Stock', 'ETF', 'Preferred Stock')")
both("f05_whitelist_or_prefix", "SELECT DISTINCT code FROM {securities} WHERE code IN ('Supplier#000000001', 'Supplier#000000005') OR code LIKE 'Supplier#00000002%'")
@query("f06_block_selector", "SELECT security_id, venue, type FROM {securities} WHERE lower(venue) = lower('etf') OR lower(type) = lower('etf') OR lower(concat(type, ' · ', venue)) = lower('etf')")
def _(i):
    return documents.block_selector(i.securities, "ETF").select("security_id", "venue", "type")

both("f07_other_series", "SELECT security_id, concat(code, '.', source_exchange) AS ticker FROM {securities} WHERE source_exchange IN ('FOREX', 'CC', 'GBOND', 'MONEY')")


@query("f02_test_instruments", r"""
SELECT code, name, regexp_matches(code, '^(Z[A-Z]ZZ[TC](NX)?|ZXYZ(-[A-Z])?|ZBZX|ZTST|ZEXIT|ZIEXT)$') OR regexp_matches(upper(name), '(NYSE|NASDAQ|NYSE ARCA|BATS|CBOE)\b.*TEST|LISTED TEST|TEST STOCK|TEST CONTROL|TEST INSTRUMENT|TE?ST SECURITY|TEST SYMBOL')
  OR (regexp_matches(code, '^([A-Z]?TEST(-[A-Z]{{1,2}})?|TEST[A-Z])(_old)?$') AND regexp_replace(upper(name), '[^A-Z0-9]', '', 'g') = regexp_replace(upper(code), '[^A-Z0-9]', '', 'g')) AS is_test
FROM (SELECT CASE p_partkey % 5 WHEN 0 THEN 'ZVZZT' WHEN 1 THEN 'ATEST' WHEN 2 THEN 'TESTA' WHEN 3 THEN concat('P', CAST(p_partkey AS VARCHAR)) ELSE '' END AS code,
  CASE p_partkey % 7 WHEN 0 THEN 'Atest' WHEN 1 THEN 'NYSE Arca Test' WHEN 2 THEN 'Test-A' WHEN 3 THEN '' ELSE p_name END AS name FROM {part}) q""")
def _(i):
    k = F.col("p_partkey")
    code = F.when(k % 5 == 0, "ZVZZT").when(k % 5 == 1, "ATEST").when(k % 5 == 2, "TESTA").when(k % 5 == 3, F.concat(F.lit("P"), k.cast("string"))).otherwise("")
    name = F.when(k % 7 == 0, "Atest").when(k % 7 == 1, "NYSE Arca Test").when(k % 7 == 2, "Test-A").when(k % 7 == 3, "").otherwise(F.col("p_name"))
    own = i.part.select(code.alias("code"), name.alias("name"))
    return own.withColumn("is_test", scalars.is_test_instrument("code", "name"))


# ---- joins
both("j02_unexplained_jumps", "SELECT security_id, date, round(move, 6) AS move FROM (SELECT security_id, date, close / lag(close) OVER (PARTITION BY security_id ORDER BY date) AS move FROM {bars_dirty}_ok) q WHERE move > 2.0e0 AND NOT EXISTS (SELECT 1 FROM {splits} s WHERE s.security_id = q.security_id AND s.date = q.date)".replace("{bars_dirty}_ok", "(SELECT * FROM {bars_dirty} WHERE close > 0) b"))
both("j04_edge_cross_join", "SELECT security_id, date, datediff(last, date) AS days_left FROM {bars}, (SELECT max(date) AS last FROM {bars}) e", "SELECT security_id, date, CAST(last - date AS INT) AS days_left FROM {bars}, (SELECT max(date) AS last FROM {bars}) e")
both("j05_semi_join", "SELECT security_id, date FROM {bars} WHERE security_id IN (SELECT security_id FROM {splits} WHERE ratio > 1)")
both("j06_outstanding_keys", "SELECT security_id FROM {securities} s WHERE NOT EXISTS (SELECT 1 FROM {ledger} l WHERE l.key = CAST(s.security_id AS STRING) AND l.endpoint = 'purchase')")
both("j07_dimension_lookup", "SELECT l.event_id, s.security_id, s.code FROM {ledger} l JOIN {securities} s ON l.key = CAST(s.security_id AS STRING)")
both("j10_request_grid", "SELECT n_name AS country, p AS indicator FROM {nation} CROSS JOIN (SELECT DISTINCT p_type AS p FROM {part}) q")

# ---- aggregates
both("a01_bar_counts", "SELECT count(*) AS n, count(DISTINCT security_id) AS n_series, min(date) AS first, max(date) AS last FROM {bars}")
both("a02_filtered_counts", "SELECT count(*) FILTER (WHERE status = 'ok') AS n_ok, count(DISTINCT key) FILTER (WHERE status <> 'ok') AS n_keys_failed FROM {ledger}")
@query("a03_relative_error", "SELECT round(median(e), 6) AS mid, round(quantile_cont(e, 0.99), 6) AS p99, round(max(e), 6) AS top FROM (SELECT abs(close - adjusted_close) / adjusted_close AS e FROM {bars}) q")
def _(i):
    own = stored.written(i.bars.select((F.abs(F.col("close") - F.col("adjusted_close")) / F.col("adjusted_close")).alias("e")), "errors")
    at = quantiles.percentiles(own, "e", (0.5, 0.99))
    return rounded(own.agg(F.lit(at[0.5]).alias("mid"), F.lit(at[0.99]).alias("p99"), F.max("e").alias("top")))

both("a04_duplicate_keys", "SELECT count(*) AS n FROM (SELECT l_orderkey, l_linenumber FROM {lineitem} GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) q")
both("a05_spans", "SELECT security_id, min(date) AS first, max(date) AS last FROM {bars} GROUP BY security_id")
both("a07_worst_offenders", "SELECT security_id, count(*) AS n, count(*) FILTER (WHERE close - adjusted_close > 1.5e0) AS bad FROM {bars} GROUP BY security_id HAVING count(*) FILTER (WHERE close - adjusted_close > 1.5e0) > 0 ORDER BY bad DESC, security_id LIMIT 25")
both("a08_conditional_share", "SELECT round(sum(CASE WHEN is_delisted THEN 1 ELSE 0 END) / CAST(greatest(count(*), 1) AS DOUBLE), 6) AS share FROM {securities}")
both("a09_categories", "SELECT coalesce(isin_kind, 'NULL') AS kind, count(*) AS n FROM (SELECT CASE WHEN security_id % 6 = 0 THEN NULL ELSE type END AS isin_kind FROM {securities}) q GROUP BY coalesce(isin_kind, 'NULL') ORDER BY n DESC, kind LIMIT 8")
both("a10_status_pivot", "SELECT endpoint, count_if(status = 'ok') AS ok, count_if(status = 'empty') AS empty, count_if(status = 'not_found') AS not_found, count_if(status NOT IN ('ok', 'empty', 'not_found')) AS failed FROM {ledger} GROUP BY endpoint")
both("a11_histograms", "SELECT CAST(floor(year(date) / 10) * 10 AS INT) AS decade, year(date) AS year, count(*) AS n FROM {bars} GROUP BY year(date)", "SELECT CAST(year(date) // 10 * 10 AS INT) AS decade, CAST(year(date) AS INT) AS year, count(*) AS n FROM {bars} GROUP BY year(date)")
@query("a13_percentiles", "SELECT " + ", ".join(f"round(quantile_cont(close, {p}), 6) AS p{int(p * 100)}" for p in (0.05, 0.25, 0.5, 0.75, 0.95)) + ", round(avg(close), 6) AS mean FROM {bars}")
def _(i):
    own = stored.written(i.bars.select("close"), "closes")
    at = quantiles.percentiles(own, "close", (0.05, 0.25, 0.5, 0.75, 0.95))
    return rounded(own.agg(*(F.lit(v).alias(f"p{int(p * 100)}") for p, v in at.items()), F.avg("close").alias("mean")))

both("a14_correlation", "SELECT security_id, CASE WHEN count(*) >= 3 THEN round(corr(close, volume), 6) END AS r FROM {bars} GROUP BY security_id")
both("a15_completeness_gate", "SELECT u.n AS expected, r.n AS resolved, r.n >= u.n AS complete FROM (SELECT count(*) AS n FROM {securities}) u, (SELECT count(DISTINCT key) AS n FROM {ledger} WHERE status IN ('ok', 'empty', 'not_found')) r")
both("w12_stratified_sample", "SELECT type, security_id FROM (SELECT type, security_id, row_number() OVER (PARTITION BY type ORDER BY md5(concat(CAST(security_id AS STRING), '|3')), security_id) AS k FROM {securities}) q WHERE k <= 4")
both("w11_running_budget", "SELECT endpoint, calls, sum(calls) OVER (ORDER BY endpoint) AS running, sum(calls) OVER (ORDER BY endpoint) <= 20000 AS fits FROM (SELECT endpoint, CAST(sum(call_cost) AS BIGINT) AS calls FROM {ledger} GROUP BY endpoint) q", "SELECT endpoint, calls, CAST(sum(calls) OVER (ORDER BY endpoint) AS BIGINT) AS running, sum(calls) OVER (ORDER BY endpoint) <= 20000 AS fits FROM (SELECT endpoint, CAST(sum(call_cost) AS BIGINT) AS calls FROM {ledger} GROUP BY endpoint) q")

# ---- sorts and sets
both("t01_multi_key_sort", "SELECT date, security_id, volume FROM {bars} ORDER BY date, security_id")
both("t02_custom_order", "SELECT type, venue, n, row_number() OVER (ORDER BY CASE type WHEN 'Common Stock' THEN 0 WHEN 'ETF' THEN 1 ELSE 2 END, n DESC, type, venue) AS place FROM (SELECT type, venue, count(*) AS n FROM {securities} GROUP BY type, venue) q")
both("u01_union_events", "SELECT security_id, date, 'split' AS kind FROM {splits} UNION ALL SELECT security_id, date, 'dividend' AS kind FROM {dividends}")
both("u02_set_difference", "SELECT security_id FROM {securities} EXCEPT SELECT CAST(key AS BIGINT) FROM {ledger} WHERE endpoint = 'purchase'")
both("u03_set_union", "SELECT key FROM {ledger} WHERE status = 'ok' UNION SELECT key FROM {ledger} WHERE status = 'empty'")
both("u04_intersection", "SELECT date FROM {bars} INTERSECT SELECT date FROM {splits}")


# ---- scalar functions
@query("x01_split_ratio", "SELECT raw, n, TRY_CAST(a AS DOUBLE) AS split_to, TRY_CAST(b AS DOUBLE) AS split_from, CASE WHEN TRY_CAST(b AS DOUBLE) <> 0 AND TRY_CAST(a AS DOUBLE) <> 0 THEN TRY_CAST(a AS DOUBLE) / TRY_CAST(b AS DOUBLE) END AS ratio FROM (SELECT raw, n, CASE WHEN contains(raw, '/') THEN split_part(raw, '/', 1) END AS a, CASE WHEN contains(raw, '/') THEN split_part(raw, '/', 2) END AS b FROM (SELECT CASE security_id % 11 WHEN 0 THEN '' WHEN 1 THEN '2' WHEN 2 THEN '0/1' WHEN 3 THEN 'x/2' ELSE raw END AS raw, count(*) AS n FROM {splits} GROUP BY ALL) q) q")
def _(i):
    raw = F.when(F.col("security_id") % 11 == 0, "").when(F.col("security_id") % 11 == 1, "2").when(F.col("security_id") % 11 == 2, "0/1").when(F.col("security_id") % 11 == 3, "x/2").otherwise(F.col("raw"))
    return i.splits.groupBy(raw.alias("raw")).agg(F.count("*").alias("n")).select("raw", "n", *scalars.split_ratio("raw"))


@query("x02_tolerant_casts", "SELECT l_orderkey, s, TRY_CAST(s AS DOUBLE) AS as_double, CAST(trunc(TRY_CAST(s AS DOUBLE)) AS BIGINT) AS as_long, count(*) AS n FROM (SELECT l_orderkey, CASE l_linenumber WHEN 1 THEN '' WHEN 2 THEN 'n/a' ELSE CAST(l_quantity + 0.5 AS VARCHAR) END AS s FROM {lineitem}) q GROUP BY ALL")
def _(i):
    s = F.when(F.col("l_linenumber") == 1, "").when(F.col("l_linenumber") == 2, "n/a").otherwise((F.col("l_quantity") + 0.5).cast("string"))
    own = i.lineitem.select("l_orderkey", s.alias("s"))
    return own.select("l_orderkey", "s", scalars.to_double("s").alias("as_double"), scalars.to_long("s").alias("as_long")).groupBy("l_orderkey", "s", "as_double", "as_long").agg(F.count("*").alias("n"))


@query("x03_request_hash", """SELECT event_id, substr(sha256('{{"endpoint":"' || endpoint || '","key":"' || key || '"}}'), 1, 16) AS request_hash FROM {ledger}""")
def _(i):
    return i.ledger.select("event_id", scalars.request_hash({"key": F.col("key"), "endpoint": F.col("endpoint"), "api_token": F.lit("secret")}).alias("request_hash"))


@query("x04_safe_key", "SELECT p_partkey, substr(regexp_replace(p_name || ' / ' || p_brand, '[^A-Za-z0-9._=-]+', '_', 'g'), 1, 180) AS k FROM {part}")
def _(i):
    return i.part.select("p_partkey", scalars.safe_key(F.concat_ws(" / ", "p_name", "p_brand")).alias("k"))


@query("x05_squash", "SELECT p_partkey, regexp_replace(regexp_replace(upper(p_name || '_old'), '[^A-Z0-9]', '', 'g'), 'OLD$', '') AS k FROM {part}")
def _(i):
    return i.part.select("p_partkey", scalars.squash(F.concat("p_name", F.lit("_old"))).alias("k"))


both("x06_month_ranges", "SELECT security_id, m AS start, least(last_day(m), last) AS end FROM (SELECT security_id, last, explode(sequence(CAST(trunc(first, 'MM') AS DATE), last, INTERVAL 1 MONTH)) AS m FROM (SELECT security_id, min(date) AS first, max(date) AS last FROM {bars} GROUP BY security_id) q) q",
     "SELECT security_id, m AS start, least(last_day(m), last) AS \"end\" FROM (SELECT security_id, last, CAST(unnest(range(CAST(date_trunc('month', first) AS TIMESTAMP), CAST(last AS TIMESTAMP) + INTERVAL 1 SECOND, INTERVAL 1 MONTH)) AS DATE) AS m FROM (SELECT security_id, min(date) AS first, max(date) AS last FROM {bars} GROUP BY security_id) q) q")
both("x07_month_count", "SELECT security_id, CAST((year(last) - year(first)) * 12 + month(last) - month(first) + 1 AS INT) AS months FROM (SELECT security_id, min(date) AS first, max(date) AS last FROM {bars} GROUP BY security_id) q")
both("x08_json_access", "SELECT event_id, coalesce(get_json_object(props, '$.k'), '0') AS k, get_json_object(props, '$.missing.x') AS x FROM {events}", "SELECT event_id, coalesce(json_extract_string(props, '$.k'), '0') AS k, json_extract_string(props, '$.missing.x') AS x FROM {events}")
both("x10_human_bytes", "SELECT endpoint, CASE WHEN b < 1073741824 THEN format_string('%.1f MB', b / 1048576.0e0) ELSE format_string('%.2f GB', b / 1073741824.0e0) END AS size FROM (SELECT endpoint, sum(bytes) * 50 AS b FROM {ledger} GROUP BY endpoint) q", "SELECT endpoint, CASE WHEN b < 1073741824 THEN printf('%.1f MB', b / 1048576.0e0) ELSE printf('%.2f GB', b / 1073741824.0e0) END AS size FROM (SELECT endpoint, sum(bytes) * 50 AS b FROM {ledger} GROUP BY endpoint) q")
both("x11_math", "SELECT l_orderkey, l_linenumber, round(sum(ln(l_quantity) + ln(1 + l_tax) + exp(l_discount) + sqrt(l_quantity) + abs(l_tax - l_discount)), 6) AS x FROM {lineitem} GROUP BY l_orderkey, l_linenumber")
both("x12_empty_answer", "SELECT event_id, CASE WHEN trim(body) IN ('[]', '{{}}', '\"\"') THEN 'empty' ELSE 'ok' END AS answer FROM (SELECT event_id, CASE event_id % 5 WHEN 0 THEN '[]' WHEN 1 THEN ' {{}} ' WHEN 2 THEN '\"\"' ELSE props END AS body FROM {events}) q")


@query("x09_payload_shape", """SELECT event_id, CASE WHEN body IS NULL OR trim(body) = '' THEN 'empty' WHEN NOT json_valid(body) THEN 'non-json' WHEN json_type(body) = 'ARRAY' THEN 'list[' || json_array_length(body) || ']' WHEN json_type(body) = 'OBJECT' THEN 'dict:' || array_to_string(json_keys(body), ',') ELSE 'value' END AS shape
FROM (SELECT event_id, CASE event_id % 5 WHEN 0 THEN '[1,2]' WHEN 1 THEN '' WHEN 2 THEN 'oops' ELSE props END AS body FROM {events}) q""")
def _(i):
    k = F.col("event_id") % 5
    own = i.events.select("event_id", F.when(k == 0, "[1,2]").when(k == 1, "").when(k == 2, "oops").otherwise(F.col("props")).alias("body"))
    return own.select("event_id", scalars.payload_shape("body").alias("shape"))


# ---- checks
def check(name: str, metrics: str, level: str) -> None:
    """A check is one row: its metrics and PASS, WARN or FAIL."""
    both(name, f"SELECT *, {level} AS level FROM ({metrics}) q")


check("q01_universe_size", "SELECT count(*) AS n, count(DISTINCT source_exchange) AS exchanges FROM {securities}", "CASE WHEN n > 0 THEN 'PASS' ELSE 'FAIL' END")
check("q02_delisted_coverage", "SELECT round(avg(CASE WHEN is_delisted THEN 1.0e0 ELSE 0.0e0 END), 6) AS share, round(avg(CASE WHEN source_exchange = 'US' THEN CASE WHEN is_delisted THEN 1.0e0 ELSE 0.0e0 END END), 6) AS us_share FROM {securities}", "CASE WHEN us_share >= 0.30e0 THEN 'PASS' ELSE 'FAIL' END")
check("q03_list_overlap", "SELECT count(*) AS n FROM (SELECT o_custkey FROM {orders} WHERE o_orderstatus = 'O' INTERSECT SELECT o_custkey FROM {orders} WHERE o_orderstatus = 'F') q", "CASE WHEN n = 0 THEN 'PASS' ELSE 'WARN' END")
check("q04_uniqueness", "SELECT count(*) - count(DISTINCT code) AS repeated_codes, count(*) - count(DISTINCT security_id) AS repeated_ids FROM {securities}", "CASE WHEN repeated_codes = 0 AND repeated_ids = 0 THEN 'PASS' ELSE 'FAIL' END")
check("q05_isin_completeness", "SELECT round(avg(CASE WHEN coalesce(isin, '') = '' THEN 1.0e0 ELSE 0.0e0 END), 6) AS missing FROM {securities}", "CASE WHEN missing > 0.5e0 THEN 'WARN' ELSE 'PASS' END")
both("q06_instrument_types", "SELECT coalesce(type, 'NULL') AS type, count(*) AS n FROM {securities} GROUP BY coalesce(type, 'NULL') ORDER BY n DESC, type LIMIT 8")
check("q07_fetch_failures", "SELECT count_if(status = 'empty') AS empty, count_if(status NOT IN ('ok', 'empty')) AS failures FROM {ledger} WHERE endpoint IN ('purchase', 'error')", "CASE WHEN failures = 0 THEN 'PASS' ELSE 'WARN' END")
check("q08_bar_volume", "SELECT count(*) AS n, min(date) AS first, count(DISTINCT security_id) AS n_series FROM {bars}", "CASE WHEN n > 0 AND first >= DATE '1995-01-01' THEN 'PASS' ELSE 'FAIL' END")
check("q09_universe_coverage", "SELECT (SELECT count(*) FROM {securities}) AS universe, count(DISTINCT key) AS attempted FROM {ledger}", "CASE WHEN attempted >= universe THEN 'PASS' ELSE 'WARN' END")
check("q10_survivorship", "SELECT round(avg(CASE WHEN is_delisted THEN 1.0e0 ELSE 0.0e0 END), 6) AS share FROM {securities} WHERE security_id IN (SELECT security_id FROM {bars})", "CASE WHEN share >= 0.30e0 THEN 'PASS' ELSE 'FAIL' END")
check("q12_listing_continuity", "SELECT count(DISTINCT security_id) AS n FROM (SELECT security_id, date, lag(date) OVER (PARTITION BY security_id ORDER BY date) AS d0 FROM {bars_gap} WHERE close IS NOT NULL) q WHERE date > d0 + INTERVAL 365 DAY", "CASE WHEN n = 0 THEN 'PASS' ELSE 'WARN' END")
check("q14_isolated_prints", "SELECT count(*) AS n FROM (SELECT adjusted_close AS p, lag(adjusted_close) OVER (PARTITION BY security_id ORDER BY date) AS a, lead(adjusted_close) OVER (PARTITION BY security_id ORDER BY date) AS b FROM {bars_dirty} WHERE adjusted_close > 0) q WHERE abs(ln(p / a)) > 0.8e0 AND abs(ln(b / a)) < 0.15e0 * abs(ln(p / a))", "CASE WHEN n = 0 THEN 'PASS' ELSE 'WARN' END")
check("q15_spliced_tickers", """SELECT count(DISTINCT CASE WHEN outside THEN security_id END) AS n, count(DISTINCT security_id) AS n_series FROM (
  SELECT e.security_id, NOT ((e.date <= hi OR hi >= last - INTERVAL 7 DAY) AND (e.date >= lo OR lo <= DATE '1996-01-01' + INTERVAL 365 DAY)) AS outside
  FROM (SELECT security_id, date FROM {splits} UNION ALL SELECT security_id, date FROM {dividends}) e JOIN (SELECT security_id, min(date) AS lo, max(date) AS hi FROM {bars_gap} GROUP BY security_id) s ON s.security_id = e.security_id, (SELECT max(date) AS last FROM {bars_gap}) x) q""", "CASE WHEN n < 0.02e0 * n_series THEN 'PASS' ELSE 'WARN' END")

# ---- request log
both("l01_ledger_state", "SELECT endpoint, key, max_by(status, ts) AS status, max_by(bytes, ts) AS bytes, count(*) AS attempts, CAST(sum(call_cost) AS BIGINT) AS call_cost FROM {ledger} GROUP BY endpoint, key")
both("l02_summary", "SELECT endpoint, status, count(*) AS n, CAST(sum(call_cost) AS BIGINT) AS calls, CAST(sum(bytes) AS BIGINT) AS bytes FROM {ledger} GROUP BY endpoint, status")
both("l03_failures", "SELECT event_id, endpoint, key, status FROM {ledger} WHERE status NOT IN ('ok', 'empty')")
both("l04_spend_per_day", "SELECT CAST(ts AS DATE) AS day, CAST(sum(call_cost) AS BIGINT) AS calls FROM {ledger} GROUP BY CAST(ts AS DATE)")
both("l07_blocks", "SELECT type, coalesce(venue, '?') AS venue, count(*) AS n, count_if(l.key IS NULL) AS outstanding FROM {securities} s LEFT JOIN (SELECT DISTINCT key FROM {ledger} WHERE endpoint = 'purchase' AND status = 'ok') l ON l.key = CAST(s.security_id AS STRING) GROUP BY type, coalesce(venue, '?')")
both("l08_access", "SELECT endpoint, count_if(status IN ('ok', 'empty')) > 0 AS accessible, count(*) AS n FROM {ledger} GROUP BY endpoint")
both("l09_strata", "SELECT type, count_if(is_delisted) AS delisted, count_if(NOT is_delisted) AS listed FROM {securities} GROUP BY type")

# ---- probes
both("r03_start_verdict", "SELECT start, CASE WHEN min(y) > start OR count(DISTINCT CASE WHEN y >= start AND y < start + 10 THEN y END) < 8 THEN 'FAIL' ELSE 'PASS' END AS verdict, count_if(y < start + 5) AS before FROM (SELECT year(date) AS y FROM {bars}) b, (SELECT DISTINCT CAST(1990 + n_nationkey AS INT) AS start FROM {nation}) s GROUP BY start")
