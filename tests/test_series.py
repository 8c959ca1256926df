"""Hand-made cases of the cleaning rules and factors."""

import datetime as dt

from tidemark.operators import factors, series, trend

BAR = "security_id long, date date, open double, high double, low double, close double, adjusted_close double, volume long"


def bars(spark, closes, start=dt.date(2020, 1, 1), step=1):
    return spark.createDataFrame([(1, start + dt.timedelta(days=step * k), c, c, c, c, c, 10) for k, c in enumerate(closes)], BAR)


def closes(df):
    return [r.close for r in df.orderBy("date").collect()]


def test_one_spike_goes(spark):
    assert closes(series.neutralize_prints(bars(spark, [31.0, 31.5, 880.0, 31.2, 30.9]))) == [31.0, 31.5, None, 31.2, 30.9]


def test_chained_junk(spark):
    assert closes(series.neutralize_prints(bars(spark, [44.0, 0.07, 17.0, 46.5, 46.0]))) == [44.0, None, None, 46.5, 46.0]


def test_plateau_stays(spark):
    values = [0.31, 0.30, 0.32, 75.0, 77.0, 74.0]
    assert closes(series.neutralize_prints(bars(spark, values))) == values


def test_zero_bar_is_blanked_and_kept(spark):
    assert closes(series.blank_non_positive(bars(spark, [6.5, 0.0, 6.6]))) == [6.5, None, 6.6]


def test_splice_cut_and_guard(spark):
    b = bars(spark, [2.0, 2.0, 2.0, 90.0, 91.0])
    none = spark.createDataFrame([], "security_id long, date date, ratio double")
    guard = spark.createDataFrame([(1, dt.date(2020, 1, 4), 0.01)], "security_id long, date date, ratio double")
    assert closes(series.splice_cut(b, none)) == [2.0, 2.0, 2.0]
    assert len(closes(series.splice_cut(b, guard))) == 5


def test_listing_span_ties_go_to_the_earliest(spark):
    two = bars(spark, [1.0, 1.0]).union(bars(spark, [2.0, 2.0], dt.date(2024, 1, 1)))
    assert closes(series.listing_span(two)) == [1.0, 1.0]


def test_latest_factor_is_one(spark, sf_dir):
    from tidemark.plans.registry import Inputs

    i = Inputs(spark, sf_dir)
    f = factors.adjustment_factors(i.bars, i.splits, i.dividends)
    from pyspark.sql import functions as F

    last = f.groupBy("security_id").agg(F.max_by("price_factor", "date").alias("f"))
    assert last.where("abs(f - 1) > 1e-9").count() == 0


def test_weights_sum_to_zero():
    w, leak = trend.weights(0.4)
    assert abs(sum(w)) < 1e-12 and leak > 0
