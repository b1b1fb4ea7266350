"""Queries against their SQL where values are zero, times have fractions and figures lie between two roundings."""

from pathlib import Path

import duckdb
import pytest

from tapeloom.functions.columns import ieee_div
from tapeloom.plans import QUERIES, SQL
from tests.test_plans import SF, plain


@pytest.fixture(scope="module")
def zeros(tmp_path_factory):
    """The smallest tables, with every third value of the events zero."""
    folder = tmp_path_factory.mktemp("zeros")
    for f in Path(SF).iterdir():
        if f.name != "events.parquet":
            (folder / f.name).symlink_to(f)
    con = duckdb.connect()
    con.execute(f"copy (select event_id, ts, user_id, event_type, case when event_id % 3 = 0 then 0e0 else value end as value, props from '{SF}/events.parquet') to '{folder}/events.parquet'")
    con.execute("set timezone = 'UTC'")
    for f in folder.iterdir():
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return str(folder), con


def equal(spark, zeros, name):
    folder, con = zeros
    got, want = QUERIES[name](spark, folder), con.sql(SQL[name])
    assert sorted(tuple(plain(r[c]) for c in want.columns) for r in got.collect()) == sorted(tuple(map(plain, r)) for r in want.fetchall())


def test_ieee_div(spark):
    rows = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (1.0, 4.0), (None, 0.0), (1.0, None)], "a double, b double")
    got = [str(r[0]) for r in rows.select(ieee_div(rows.a, rows.b)).collect()]
    assert got == ["inf", "-inf", "nan", "0.25", "None", "None"]


@pytest.mark.parametrize("name", ["m06_stablecoin_hourly", "m07_stablecoin_daily", "t15_lead_lag", "t08_bull_trap", "t13_order_flow", "t15_lead_lag_live"])
def test_zero_divisors(spark, zeros, name):
    equal(spark, zeros, name)


@pytest.mark.parametrize("name", ["m01_trades_hourly", "m16_wide_features", "m29_exchange_risk_daily", "m32_kpi_latest", "s13_market_hours_in_steps"])
def test_trades_of_price_zero_are_trades(spark, zeros, name):
    equal(spark, zeros, name)


def test_age_counts_whole_seconds(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from tapeloom.mlops.registry import metric_rows

    at = dt.datetime(2024, 1, 1, 0, 0, 0, 400_000)  # less than an hour before as_of, but in the second an hour before
    runs = spark.createDataFrame([("m", "1", "t", "test", at, at, "a", 10, 0.9, 0.6, 0.6)], "model_name string, model_version string, target_name string, split_name string, trained_at timestamp_ntz, evaluated_at timestamp_ntz, run_id string, row_count int, accuracy double, f1_macro double, auc_ovr double")
    models = spark.createDataFrame([("m", "1", "f", "a", "p", "t", True)], "model_name string, model_version string, model_family string, algorithm string, problem_type string, primary_target string, is_active boolean")
    assert [r["metric_age_hours"] for r in metric_rows(runs, models, F.lit("2024-01-01 01:00:00").cast("timestamp_ntz")).collect()] == [1]


def test_figures_between_two_roundings(spark):
    """Numbers whose hundredfold as a double lies elsewhere than their digits say."""
    from tapeloom.plans.wide import _FIGURE, _SPARK_FIGURE

    numbers = [66.475, 87.16499999999999, 66.225, 65.225, 27.474999999999998, 26.314999999999998, 73.445, 0.125, 1.005, -66.475, -0.125, 100.0, 0.0, 0.004]
    spark.createDataFrame([(x,) for x in numbers], "x double").createOrReplaceTempView("figures")
    for digits in (2, 4):
        got = spark.sql(f"select x, {_SPARK_FIGURE('x', digits)} from figures").collect()
        want = duckdb.connect().execute(f"select x, {_FIGURE('x', digits)} from (select unnest({numbers}::double[]) as x)").fetchall()
        assert sorted(map(tuple, got)) == sorted(want)
