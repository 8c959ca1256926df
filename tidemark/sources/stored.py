"""Declared schemas, sorted sinks and what is known of a stored dataset."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType


def _schema(keys: dict, rest: dict) -> StructType:
    return StructType([StructField(n, t, False) for n, t in keys.items()] + [StructField(n, t) for n, t in rest.items()])


_ID, _TEXT, _DAY, _REAL, _WHOLE = IntegerType(), StringType(), DateType(), DoubleType(), LongType()
# Columns, types and keys of the stored datasets.
BARS = _schema({"security_id": _ID, "date": _DAY}, dict.fromkeys(("open", "high", "low", "close", "adjusted_close"), _REAL) | {"volume": _WHOLE})
SPLITS = _schema({"security_id": _ID, "date": _DAY}, dict.fromkeys(("split_to", "split_from", "ratio"), _REAL) | {"raw": _TEXT})
DIVIDENDS = _schema({"security_id": _ID, "date": _DAY}, {"value": _REAL, "unadjusted_value": _REAL, "currency": _TEXT, "declaration_date": _DAY, "record_date": _DAY, "payment_date": _DAY, "period": _TEXT})
FACTORS = _schema({"security_id": _ID, "date": _DAY}, {"split_factor": _REAL, "price_factor": _REAL})
SECURITIES = _schema({"security_id": _ID, "code": _TEXT, "source_exchange": _TEXT}, {"venue": _TEXT, "type": _TEXT, "isin": _TEXT, "is_delisted": BooleanType()})


def declared(df: DataFrame, schema: StructType) -> DataFrame:
    """df's columns as declared: order and types of the schema, null where a value doesn't fit or a column is missing; rows with
    a null key go."""
    cast = df.select(*((F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema))
    keys = [f.name for f in schema if not f.nullable]
    return cast.dropna(subset=keys) if keys else cast


def store_by_year(df: DataFrame, path: str, day: str = "date", sort: tuple[str, ...] = ("date", "security_id"), tasks_a_year: int = 8) -> None:
    """df under path, a folder a year, sorted within files, in place of what was there. A year's rows are dealt over tasks by
    the day, so that no year is one task; files hold whole days."""
    own = df.withColumn("year", F.year(day))
    deal = F.pmod(F.xxhash64(day), F.lit(tasks_a_year))
    own.repartition("year", deal).sortWithinPartitions("year", *sort).write.partitionBy("year").option("compression", "zstd").mode("overwrite").parquet(path)


def store_sorted(df: DataFrame, path: str, sort: tuple[str, ...] = ("security_id", "date")) -> None:
    """df under path in the order of sort over all files, in place of what was there."""
    df.orderBy(*sort).write.option("compression", "zstd").mode("overwrite").parquet(path)


def inventory(spark: SparkSession, paths: dict[str, str], digests: bool = False) -> DataFrame:
    """dataset, n_rows, n_files, bytes of stored datasets by name; with digests, file rows (dataset, file, bytes, sha256) instead,
    read whole by the executors."""
    out = None
    for name, path in paths.items():
        if digests:
            file = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path)
            one = file.select(F.lit(name).alias("dataset"), F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
        else:
            # Files without rows count too, so files are listed apart from what they hold.
            file = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path)
            held = file.agg(F.count("*").alias("n_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
            one = spark.read.parquet(path).agg(F.count("*").alias("n_rows")).crossJoin(held).select(F.lit(name).alias("dataset"), "n_rows", "n_files", "bytes")
        out = one if out is None else out.union(one)
    return out


def build(df: DataFrame, path: str, keep: dict[str, Column], count: dict[str, Column], put=store_by_year, **how) -> DataFrame:
    """Stores what passes the rules and says what went with it: dataset's n_rows, n_files, bytes, sha256 (of the files' digests, in order),
    dropped_<rule> for each rule of `keep`, in the order in which they fail rows, and the counters `count` over the rows that stay.

    All figures of rows come from the job that writes them, observed as they pass, so put() must go through its rows once: a sort
    over all files samples them before. Files are read once by the executors for their digests."""
    spark, before, after = df.sparkSession, Observation(), Observation()
    failed, passed = {}, F.lit(True)
    for name, rule in keep.items():
        ok = F.coalesce(rule, F.lit(False))
        failed[name], passed = F.count_if(passed & ~ok).alias(f"dropped_{name}"), passed & ok
    own = df.observe(before, F.count("*").alias("_read"), *failed.values()).where(passed)
    put(own.observe(after, F.count("*").alias("n_rows"), *(c.alias(n) for n, c in count.items())), path, **how)
    rows = {n: v for n, v in before.get.items() if n != "_read"} | after.get
    file = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path)
    held = file.select(F.length("content").cast("long").alias("n"), F.sha2("content", 256).alias("h")).agg(F.count("*").alias("n_files"), F.coalesce(F.sum("n"), F.lit(0)).alias("bytes"), F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ",").cast("binary"), 256).alias("sha256"))
    return held.select(F.lit(int(rows.pop("n_rows"))).alias("n_rows"), "n_files", "bytes", "sha256", *(F.lit(v).alias(n) for n, v in rows.items()))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, as in tests, one is made for a
    local session; a cluster without the setting is an error, for a machine-local folder would lose data there."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written once to the shared folder and read again. This cuts the lineage: a lost executor costs a reread of files,
    never the work behind them."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out
