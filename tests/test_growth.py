"""What must not grow faster than the tables: how often a view is computed, rows and memory of a task, calls of a fit."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import diagnostics, fracdiff, quantiles
from tidemark.plans import registry
from tidemark.sources import fixtures


def tallied(spark, df, seen):
    """df, with its rows added up whenever they are computed."""

    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema)


@pytest.mark.parametrize("name", ["a03_relative_error", "a13_percentiles"])
def test_percentiles_compute_their_bars_once(spark, monkeypatch, name):
    seen = spark.sparkContext.accumulator(0)
    bars = tallied(spark, spark.range(3000).select((F.col("id") * 7919 % 3001 + 1.0).alias("close"), F.lit(2000.0).alias("adjusted_close")), seen)
    monkeypatch.setattr(registry, "frame", lambda *_: bars)
    assert len(registry.QUERIES[name](spark, "").collect()) == 1
    assert seen.value == 3000


def test_counts_by_range(spark):
    values = spark.createDataFrame([(float(v),) for v in (5, 1, 2, 2, 9, -3)], "v double").repartition(3)
    assert sorted(tuple(r) for r in quantiles.counted(values, [2.0, 9.0]).collect()) == [(0, 2, -3.0, 1.0), (1, 3, 2.0, 5.0), (2, 1, 9.0, 9.0)]


def test_a_task_holds_as_many_rows_however_large_the_tables(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(fixtures, "ROWS_A_TASK", 500)
    n = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    out = registry.QUERIES["c15_filing_date"](spark, sf_dir)
    held = out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("rows"), F.sum("n").alias("n")).collect()
    assert sum(r.n for r in held) == n and max(r.rows for r in held) < 1000


def test_rank_correlation_where_one_is_constant(spark):
    """In ANSI mode too, such groups have no row and are no error."""
    rows = [(1, float(k), float(k * k % 7)) for k in range(7)] + [(2, float(k), 1.0) for k in range(7)]
    got = diagnostics.rank_ic(spark.createDataFrame(rows, "date int, a double, b double"), ["date"], "a", "b", 5).collect()
    assert [(r.date, r.n) for r in got] == [(1, 7)] and abs(got[0].ic - np.corrcoef(range(7), [0, 1.5, 5.5, 3.5, 3.5, 5.5, 1.5])[0, 1]) < 1e-12


def test_newey_west_computes_its_series_once(spark):
    seen = spark.sparkContext.accumulator(0)
    series = tallied(spark, spark.range(40).select(F.col("id").alias("date"), (F.col("id") * 7 % 11).cast("double").alias("v")), seen)
    row = diagnostics.newey_west(series, "v", 3).first()
    assert (row.n, row["mean"]) == (40, sum(k * 7 % 11 for k in range(40)) / 40) and seen.value == 40


def test_unit_root_fit_builds_one_design(monkeypatch):
    """Its products serve every lag, and the statistic is that of least squares."""
    rng = np.random.default_rng(1)
    for x in (rng.normal(size=400), np.cumsum(rng.normal(size=300)) + 50, rng.normal(size=33)):
        most = fracdiff.lag_bound(len(x))
        want = fracdiff._adf_by_solving(x, most)
        with monkeypatch.context() as m:
            m.setattr(fracdiff, "_design", None)
            got = fracdiff.adf(x, most)
        assert got[1:] == want[1:] and abs(got[0] - want[0]) < 1e-9 * abs(want[0])
    assert fracdiff.adf(np.arange(100.0)) == fracdiff._adf_by_solving(np.arange(100.0), fracdiff.lag_bound(100))


def test_unit_root_fit_with_fewer_rows_than_lags():
    """What rounding leaves of a design without full rank doesn't decide whether there is a statistic."""
    for n in range(32, 48):
        x = np.random.default_rng(n).normal(size=n)
        one, other = fracdiff.adf(x, 19), fracdiff.adf(x + 1e-15, 19)
        assert one and other and one[1:] == other[1:] and abs(one[0] - other[0]) < 1e-9 * abs(one[0])


def test_feature_table_joins_no_rows_with_rows(spark):
    panel = spark.range(900).select((F.col("id") % 3).alias("security_id"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") / 3).cast("int")).alias("date"), (F.col("id") * 7919 % 101 + 50.0).alias("close")).selectExpr("*", "close AS adj", "100 AS volume")
    out = fracdiff.feature_table(panel)
    assert out.count() == 900 and "date" not in "".join(line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line)


def test_the_verdict_stores_its_bars_once(spark, sf_dir):
    plan = registry.QUERIES["q20_gate_verdict"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_suppkey" not in plan and not fixtures._HELD


@pytest.mark.parametrize("name", ["e03_paired_difference", "e09_z_buckets"])
def test_securities_and_days_are_dealt_out_by_rows(spark, sf_dir, monkeypatch, name):
    monkeypatch.setattr(fixtures, "ROWS_A_TASK", 500)
    plan = registry.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") >= 2 and plan.count("Scan parquet") == 1
    assert "hashpartitioning(security_id" not in plan
