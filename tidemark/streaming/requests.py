"""The request log as streams. Each has a batch twin with the same result when nothing is late."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ledger_state(attempts: DataFrame, late: str = "1 day") -> DataFrame:
    """Latest status and bytes, attempts and cost by endpoint and key; re-delivered attempts (event_id) count once."""
    if attempts.isStreaming:
        attempts = attempts.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])
    else:
        attempts = attempts.dropDuplicates(["event_id"])
    return attempts.groupBy("endpoint", "key").agg(F.max_by("status", "ts").alias("status"), F.max_by("bytes", "ts").alias("bytes"), F.count("*").alias("attempts"), F.sum("call_cost").cast("long").alias("call_cost"))


def spend_per_day(attempts: DataFrame, late: str = "1 day") -> DataFrame:
    own = attempts.withWatermark("ts", late) if attempts.isStreaming else attempts
    return own.groupBy(F.window("ts", "1 day")).agg(F.sum("call_cost").cast("long").alias("calls")).select(F.col("window.start").alias("day"), "calls")


def rate_over_cap(attempts: DataFrame, cap: int, late: str = "10 minutes") -> DataFrame:
    """Sliding minutes with more than cap requests."""
    own = attempts.withWatermark("ts", late) if attempts.isStreaming else attempts
    return own.groupBy(F.window("ts", "1 minute", "10 seconds")).agg(F.count("*").alias("n")).where(F.col("n") > cap).select(F.col("window.start").alias("start"), "n")


#: Keeps a stream's state on disk and in its checkpoint, changes only, instead of whole in memory.
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def ingest(stream: DataFrame, keys: list[str], target: str, checkpoint: str):
    """Loads what is new, once. The keys that were loaded are the stream's state, kept by key in its checkpoint: a batch looks up its own
    keys and never reads the target, whatever that holds. A batch's rows are written under its own number, so one that runs again, from
    the state of the batch before it, replaces its own rows. Rows without a key are one key."""
    conf = stream.sparkSession.conf
    provider, changes = "spark.sql.streaming.stateStore.providerClass", "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
    before = conf.get(provider, None), conf.get(changes, None)
    conf.set(provider, ROCKS)
    conf.set(changes, "true")

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    try:  # a query keeps the settings that it starts with
        return stream.dropDuplicates(keys).writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        for name, value in zip((provider, changes), before, strict=True):
            conf.unset(name) if value is None else conf.set(name, value)
