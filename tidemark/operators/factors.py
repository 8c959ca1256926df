"""As-of joins and adjustment factors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_forward(events: DataFrame, bars: DataFrame, value: list[str]) -> DataFrame:
    """events with bar_date and the value columns of the first bar on or after their date, null without one. One pass over
    the union of both, latest first, instead of a join of all pairs."""
    left = events.select("security_id", "date", F.struct(*events.columns).alias("_event"), F.lit(None).cast(_struct(bars, value)).alias("_bar"), F.lit(1).alias("_side"))
    right = bars.select("security_id", "date", F.lit(None).cast(left.schema["_event"].dataType).alias("_event"), F.struct("date", *value).alias("_bar"), F.lit(0).alias("_side"))
    w = Window.partitionBy("security_id").orderBy(F.desc("date"), "_side").rowsBetween(Window.unboundedPreceding, 0)
    met = left.unionByName(right).withColumn("_met", F.last("_bar", ignorenulls=True).over(w)).where("_side = 1")
    return met.select("_event.*", F.col("_met.date").alias("bar_date"), *(F.col(f"_met.{c}") for c in value))


def _struct(df: DataFrame, value: list[str]):
    return df.select(F.struct("date", *value).alias("x")).schema["x"].dataType


def asof_backward(points: DataFrame, rows: DataFrame, keys: list[str], value: list[str]) -> DataFrame:
    """points (keys, date) with the value columns of the last row on or before their date: of the row, nulls included."""
    kind = rows.select(F.struct("date", *value).alias("x")).schema["x"].dataType
    left = points.select(*keys, "date", F.lit(None).cast(kind).alias("_row"), F.lit(1).alias("_side"))
    right = rows.select(*keys, "date", F.struct("date", *value).alias("_row"), F.lit(0).alias("_side"))
    w = Window.partitionBy(*keys).orderBy("date", "_side").rowsBetween(Window.unboundedPreceding, 0)
    met = left.unionByName(right).withColumn("_met", F.last("_row", ignorenulls=True).over(w)).where("_side = 1")
    return met.select(*keys, "date", F.col("_met.date").alias("as_of"), *(F.col(f"_met.{c}") for c in value))


def with_previous_close(bars: DataFrame) -> DataFrame:
    w = Window.partitionBy("security_id").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    return bars.withColumn("prev_close", F.last("close", ignorenulls=True).over(w))


def split_products(splits: DataFrame) -> DataFrame:
    """f: product of 1 / ratio of a day's splits."""
    return splits.where("ratio > 0").groupBy("security_id", "date").agg(F.exp(F.sum(-F.ln("ratio"))).alias("f"))


def matched_dividends(dividends: DataFrame, bars: DataFrame, days: int = 7, most: float = 0.95) -> DataFrame:
    """Payments on their first bar on or after the date: bar_date, val, prev_close."""
    met = asof_forward(dividends, with_previous_close(bars), ["prev_close"]).withColumn("val", F.coalesce("unadjusted_value", "value"))
    return met.where((F.datediff("bar_date", "date") <= days) & (F.col("val") > 0) & (F.col("prev_close") > 0) & (F.col("val") / F.col("prev_close") < most))


def adjustment_factors(bars: DataFrame, splits: DataFrame, dividends: DataFrame | None = None) -> DataFrame:
    """security_id, date, split_factor, price_factor: products of the events strictly after each bar. Without dividends the
    price factor is the split factor."""
    s = split_products(splits).withColumnRenamed("f", "sf")
    out = bars.select("security_id", "date").join(s, ["security_id", "date"], "left")
    if dividends is not None:
        d = matched_dividends(dividends, bars).groupBy("security_id", F.col("bar_date").alias("date")).agg(F.exp(F.sum(F.ln(1 - F.col("val") / F.col("prev_close")))).alias("df"))
        out = out.join(d, ["security_id", "date"], "left")
    else:
        out = out.withColumn("df", F.lit(None).cast("double"))
    # Latest first, the rows before a bar are those after it in time; the latest has none and a factor of 1.
    after = Window.partitionBy("security_id").orderBy(F.desc("date")).rowsBetween(Window.unboundedPreceding, -1)
    sf, pf = F.ln(F.coalesce("sf", F.lit(1.0))), F.ln(F.coalesce("sf", F.lit(1.0)) * F.coalesce("df", F.lit(1.0)))
    factor = lambda x: F.exp(F.coalesce(F.sum(x).over(after), F.lit(0.0)))
    return out.select("security_id", "date", factor(sf).alias("split_factor"), factor(pf).alias("price_factor"))


def alpha_panel(bars: DataFrame, factors: DataFrame) -> DataFrame:
    return bars.join(factors, ["security_id", "date"]).select("security_id", "date", "close", "high", "low", "volume", (F.col("close") * F.col("price_factor")).alias("adj"), "split_factor")
