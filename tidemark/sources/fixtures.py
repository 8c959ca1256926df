"""Input views on the given tables: daily bars, events, listings, a request log. Their SQL runs on Spark and on DuckDB alike."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")

#: Rows of a table that one task takes, about, where tables are dealt out by their size.
ROWS_A_TASK = 1 << 19

VIEWS: dict[str, str] = {
    # 100.0371 keeps rounded results off ties.
    "bars": """
SELECT l_suppkey AS security_id, CAST(l_shipdate AS DATE) AS date, 100.0371e0 + (min(l_quantity) + max(l_quantity)) / 2 AS open,
  100.0371e0 + max(l_quantity) AS high, 100.0371e0 + min(l_quantity) AS low, 100.0371e0 + avg(l_quantity) AS close,
  (100.0371e0 + avg(l_quantity)) * (1 - avg(l_discount) / 5) AS adjusted_close, CAST(sum(l_quantity) AS BIGINT) AS volume
FROM {lineitem} GROUP BY l_suppkey, CAST(l_shipdate AS DATE)""",
    "bars_dirty": """
SELECT user_id AS security_id, CAST(ts AS DATE) AS date, min_by(value, ts) AS open, max(value) AS high, min(value) AS low,
  CASE WHEN (user_id + day(CAST(ts AS DATE))) % 17 = 0 THEN 0.0e0 ELSE max_by(value, ts) END AS close,
  max_by(value, ts) AS adjusted_close, count(*) AS volume
FROM {events} GROUP BY user_id, CAST(ts AS DATE)""",
    # A vendor's adjusted closes: never adjusted for every tenth security, and near the factors of this library for most others.
    "vendor": """
SELECT security_id, date, close, CASE WHEN security_id % 10 = 3 THEN close WHEN security_id % 10 = 4 THEN adjusted_close END AS vendor FROM {bars}""",
    # The bars as they are, a few of them twice.
    "bars_twice": """
SELECT security_id, date, open, high, low, close FROM {bars_dirty} UNION ALL SELECT security_id, date, open, high, low, close FROM {bars_dirty} WHERE (security_id + day(date)) % 29 = 0""",
    "bars_gap": """
SELECT * FROM {bars} WHERE NOT (security_id % 7 = 0 AND year(date) IN (1997, 1998))
  OR (security_id % 14 = 0 AND year(date) = 1997 AND month(date) = 6 AND day(date) <= 10)""",
    "splits": """
SELECT o_orderkey AS event_id, o_custkey % (SELECT count(*) FROM {supplier}) AS security_id, CAST(o_orderdate AS DATE) AS date,
  concat(CAST(1 + o_orderkey % 3 AS STRING), '.000000/', CAST(1 + o_orderkey % 2 AS STRING), '.000000') AS raw,
  CAST(1 + o_orderkey % 3 AS DOUBLE) / CAST(1 + o_orderkey % 2 AS DOUBLE) AS ratio
FROM {orders} WHERE o_orderkey % 35 = 0""",
    "dividends": """
SELECT o_orderkey AS event_id, o_custkey % (SELECT count(*) FROM {supplier}) AS security_id, CAST(o_orderdate AS DATE) AS date,
  0.5e0 + (o_orderkey % 10) / 10.0e0 AS value,
  CASE WHEN o_orderkey % 3 <> 0 THEN 0.4e0 + (o_orderkey % 7) / 10.0e0 END AS unadjusted_value
FROM {orders} WHERE o_orderkey % 19 = 1""",
    "securities": """
SELECT s_suppkey AS security_id, s_name AS code, CASE s_suppkey % 4 WHEN 0 THEN 'US' WHEN 1 THEN 'FOREX' WHEN 2 THEN 'US' ELSE 'GBOND' END AS source_exchange,
  r_name AS venue, CASE s_suppkey % 5 WHEN 0 THEN 'Common Stock' WHEN 1 THEN 'ETF' WHEN 2 THEN 'Preferred Stock' WHEN 3 THEN 'Fund' ELSE 'Bond' END AS type,
  CASE WHEN s_suppkey % 6 <> 0 THEN concat('XX', CAST(s_suppkey AS STRING)) WHEN s_suppkey % 12 = 0 THEN '' END AS isin,
  s_suppkey % 3 = 0 AS is_delisted
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "ledger": """
SELECT event_id, event_type AS endpoint, CAST(user_id AS STRING) AS key, ts,
  CASE WHEN k <= 5 THEN 'ok' WHEN k = 6 THEN 'empty' WHEN k = 7 THEN 'not_found' WHEN k = 8 THEN 'http_error' ELSE 'transport_error' END AS status,
  CASE event_type WHEN 'purchase' THEN 10 WHEN 'error' THEN 5 ELSE 1 END AS call_cost, CAST(round(value * 100) AS BIGINT) AS bytes
FROM (SELECT *, CAST(event_id % 10 AS INT) AS k FROM {events}) q""",
    "wide": """
SELECT p_type AS asset, CAST(l_shipdate AS DATE) AS date, 100.0371e0 + avg(l_quantity) AS price, sum(l_extendedprice) AS dollar_volume
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey GROUP BY p_type, CAST(l_shipdate AS DATE)""",
    "statements": """
SELECT o_custkey AS security_id, o_orderpriority AS statement, CAST(o_orderdate AS DATE) AS period_end, CAST(l_shipdate AS DATE) AS filing_date,
  l_orderkey AS document, l_linenumber AS line, l_quantity AS quantity, l_extendedprice AS price, l_tax AS tax, l_returnflag AS flag
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
}


def needs(text: str) -> list[str]:
    return [n for n in (*VIEWS, *TABLES) if "{" + n + "}" in text]


#: Views that `holding` has put in the place of their SQL.
_HELD: dict[str, DataFrame] = {}


@contextmanager
def holding(views: dict[str, DataFrame]):
    """Within it, frames are made from these views, which are stored, wherever they are read."""
    _HELD.update(views)
    try:
        yield
    finally:
        _HELD.clear()


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of sf_dir or a view on it."""
    if name in _HELD:
        return _HELD[name]
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spark.sql(VIEWS[name], **{n: frame(spark, sf_dir, n) for n in needs(VIEWS[name])})


def tasks(spark: SparkSession, sf_dir: str, *names: str) -> int:
    """How many tasks the largest of these tables calls for."""
    return max(frame(spark, sf_dir, n).count() for n in names) // ROWS_A_TASK + 1


def dealt(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """df dealt over n tasks by its keys, or over the session's tasks where these are as many."""
    return df.repartition(n, *keys) if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df.repartition(*keys)


def laid(spark: SparkSession, sf_dir: str, name: str, by: dict[str, str]) -> DataFrame:
    """A view whose tables are first dealt out by these columns, over more tasks the more rows they have: what a task holds doesn't
    grow with them, and joins, groups and windows by the column need no further shuffle."""
    n = tasks(spark, sf_dir, *by)
    own = {t: frame(spark, sf_dir, t) for t in needs(VIEWS[name])}
    return spark.sql(VIEWS[name], **{t: dealt(df, n, by[t]) if t in by else df for t, df in own.items()})


def duck(text: str) -> str:
    """SQL for DuckDB: the views that text names in braces come first, as common table expressions."""
    order: list[str] = []

    def add(t: str) -> None:
        for n in needs(t):
            if n in VIEWS and n not in order:
                add(VIEWS[n])
                order.append(n)

    add(text)
    names = {n: n for n in (*VIEWS, *TABLES)}
    views = ", ".join(f"{n} AS ({VIEWS[n].format(**names)})" for n in order)
    body = text.format(**names).strip()
    for start in ("WITH RECURSIVE ", "WITH "):
        if views and body.upper().startswith(start):
            return f"{start}{views}, {body[len(start):]}"
    return f"WITH {views} {body}" if views else body
