"""Sinks, schemas, documents and streams on files."""

import datetime as dt
import hashlib
import json
from pathlib import Path

from pyspark.sql import functions as F

from tidemark.operators import documents
from tidemark.sources import stored
from tidemark.streaming import requests

DAY = dt.date(2020, 12, 20)


def bars(spark, n=60):
    return spark.createDataFrame([(k, DAY + dt.timedelta(days=i), float(i), 7) for i in range(n) for k in (3, 1, 2)], "security_id int, date date, close double, volume long")


def test_yearly_sink_is_sorted_and_replaced(spark, tmp_path):
    path = str(tmp_path / "eod")
    stored.store_by_year(bars(spark), path)
    stored.store_by_year(bars(spark, 30), path)
    assert sorted(x.name for x in Path(path).iterdir() if x.is_dir()) == ["year=2020", "year=2021"]
    back = spark.read.parquet(path)
    assert back.count() == 90 and back.where("year <> year(date)").count() == 0
    for file in Path(path).rglob("*.parquet"):
        own = [(r.date, r.security_id) for r in spark.read.parquet(str(file)).collect()]
        assert own == sorted(own) and ".zstd." in file.name


def test_sorted_sink_and_inventory(spark, tmp_path):
    path = str(tmp_path / "flat")
    stored.store_sorted(bars(spark).repartition(4), path)
    files = sorted(Path(path).glob("*.parquet"))
    order = [(r.security_id, r.date) for f in files for r in spark.read.parquet(str(f)).collect()]
    assert order == sorted(order) and len(order) == 180
    one = stored.inventory(spark, {"flat": path}).first()
    assert (one.dataset, one.n_rows, one.n_files, one.bytes) == ("flat", 180, len(files), sum(f.stat().st_size for f in files))
    got = {r.file: (r.bytes, r.sha256) for r in stored.inventory(spark, {"flat": path}, digests=True).collect()}
    assert got == {f.name: (f.stat().st_size, hashlib.sha256(f.read_bytes()).hexdigest()) for f in files}


def test_declared_schema(spark):
    df = spark.createDataFrame([("1", "2020-01-02", "x", 5.0, "no"), (None, "2020-01-02", "1.5", 1.0, "no"), ("2", "bad", "1", 1.0, "no")], "security_id string, date string, close string, volume double, other string")
    out = stored.declared(df, stored.BARS)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in stored.BARS]
    assert [tuple(r) for r in out.collect()] == [(1, dt.date(2020, 1, 2), None, None, None, None, None, 5)]
    assert stored.declared(df.limit(0), stored.BARS).count() == 0


def test_documents_that_cannot_be_read_are_passed_over(spark):
    bodies = spark.createDataFrame([(1, '{"a": 1}'), (2, '{"a": '), (3, "[]"), (4, ""), (5, "oops"), (6, '{"late": 1}')], "key int, body string")
    ledger = spark.createDataFrame([(k, "ok") for k in (1, 2, 3, 4, 5, 9)] + [(6, "http_error"), (1, "ok")], "key int, status string")
    read, skipped = documents.scan(ledger, bodies, ["key"])
    assert sorted(r.key for r in read.collect()) == [1, 3]
    assert sorted((r.key, r.reason) for r in skipped.collect()) == [(2, "unreadable"), (4, "unreadable"), (5, "unreadable"), (9, "missing")]


def test_company_facts(spark):
    whole = {s: {} for s, *_ in documents.FACTS}
    for k, (section, key, _, kind) in enumerate(documents.FACTS):
        whole[section][key] = {"string": f"t{k}", "double": str(k / 4), "long": f"{k}.0", "boolean": "true", "date": f"2020-01-{k % 28 + 1:02d}"}[kind]
    docs = [(1, "a.US", json.dumps(whole)), (2, "b.US", json.dumps({"General": {"Type": "ETF"}})), (3, "c.US", json.dumps({"General": {"Name": "", "FullTimeEmployees": "n/a", "IPODate": "0000-00-00"}, "Highlights": None})), (4, "d.US", "oops"), (5, "e.US", None)]
    out = {r.security_id: r for r in documents.company_facts(spark.createDataFrame(docs, "security_id int, api_ticker string, body string")).collect()}
    assert set(out) == {1, 3} and len(documents.FACTS) == 41
    for k, (_, _, column, kind) in enumerate(documents.FACTS):
        want = {"string": f"t{k}", "double": k / 4, "long": k, "boolean": True, "date": dt.date(2020, 1, k % 28 + 1)}[kind]
        assert out[1][column] == want and out[3][column] == (False if kind == "boolean" else None)


ATTEMPT = "event_id long, endpoint string, key string, status string, ts timestamp, call_cost long, bytes long"


def attempts(n):
    at = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)
    return [(k, f"e{k % 3}", str(k % 7), "ok" if k % 4 else "http_error", at + dt.timedelta(minutes=11 * k), 1 + k % 3, 10 * k) for k in range(n)]


def streamed(spark, tmp_path, make, mode):
    """What a stream over two files leaves, the second written while the first was loaded."""
    source, target = tmp_path / "in", str(tmp_path / "out")
    rows = attempts(200)
    spark.createDataFrame(rows[:120], ATTEMPT).coalesce(1).write.parquet(str(source / "a"))
    spark.createDataFrame(rows[100:], ATTEMPT).coalesce(1).write.parquet(str(source / "b"))

    def put(batch, number):
        batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(target)

    stream = spark.readStream.schema(ATTEMPT).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(source))
    make(stream).writeStream.foreachBatch(put).outputMode(mode).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()
    return spark.createDataFrame(list({r[0]: r for r in rows}.values()), ATTEMPT), spark.read.parquet(target)


def latest(rows, keys):
    """The last update of each key, as a sink that replaces rows holds it."""
    last = rows.groupBy(*keys).agg(F.max("batch").alias("batch"))
    return sorted(map(tuple, rows.join(last, [*keys, "batch"]).drop("batch").select(*sorted(c for c in rows.columns if c != "batch")).collect()))


def test_ledger_stream_is_its_batch_twin(spark, tmp_path):
    whole, out = streamed(spark, tmp_path, lambda s: requests.ledger_state(s, "30 days"), "update")
    twin = requests.ledger_state(whole)
    assert latest(out, ["endpoint", "key"]) == sorted(map(tuple, twin.select(*sorted(twin.columns)).collect()))


def test_spend_and_rate_streams(spark, tmp_path):
    whole, out = streamed(spark, tmp_path / "spend", lambda s: requests.spend_per_day(s.dropDuplicates(["event_id"]), "30 days"), "update")
    twin = requests.spend_per_day(whole)
    assert latest(out, ["day"]) == sorted(map(tuple, twin.select(*sorted(twin.columns)).collect()))
    whole, out = streamed(spark, tmp_path / "rate", lambda s: requests.rate_over_cap(s.dropDuplicates(["event_id"]), 0, "30 days"), "update")
    twin = requests.rate_over_cap(whole, 0)
    assert latest(out, ["start"]) == sorted(map(tuple, twin.select(*sorted(twin.columns)).collect())) and twin.count() > 100


def test_ingest_loads_each_key_once(spark, tmp_path):
    source, target, check = tmp_path / "in", str(tmp_path / "archive"), str(tmp_path / "check")

    def load():
        stream = spark.readStream.schema("key string, body string").json(str(source))
        requests.ingest(stream, ["key"], target, check).awaitTermination()
        return sorted((r.key, r.body) for r in spark.read.parquet(target).collect())

    source.mkdir()
    (source / "1.json").write_text('{"key": "a", "body": "1"}\n{"key": "b", "body": "1"}\n')
    assert load() == [("a", "1"), ("b", "1")]
    (source / "2.json").write_text('{"key": "b", "body": "2"}\n{"key": "c", "body": "2"}\n')
    assert load() == load() == [("a", "1"), ("b", "1"), ("c", "2")]
