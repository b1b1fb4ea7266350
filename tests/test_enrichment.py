"""Hand-worked rows on both sides of each bound: enrichment, buckets, found statuses, runs of checks, the rule suite."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tapeloom.functions import enrichment as E
from tapeloom.quality import rules as Q
from tapeloom.quality import suite

RUN = dt.datetime(2024, 1, 1, 6)


def test_coin_bounds(spark):
    rows = [  # price, cap, volume, circulating, total -> regime, tier, outliers, turnover
        (1, 1.0051, 5e10, 1e9, 1.0, 2.0, "premium", "mega", 0, 0),
        (2, 1.0049, 5e10 - 1, 1e9, 1.0, 2.0, "stable", "large", 0, 0),
        (3, 0.9949, 5e9, 7.5e9, 1.0, 0.0, "depeg_risk", "large", 0, 0),
        (4, 0.9951, 5e9 - 1, 7.6e9, 1.0, None, "stable", "medium", 0, 1),
        (5, 1.0201, 5e8, 1e8, 1.0, 2.0, "premium", "medium", 1, 0),
        (6, None, 5e8 - 1, None, 1.0, 2.0, "stable", "small", 0, 0),
        (7, 0.0, 0.0, 1e8, 1.0, 2.0, "stable", "small", 0, 0),
    ]
    df = spark.createDataFrame([(r[0], RUN, *r[1:6]) for r in rows], "i int, run_ts timestamp_ntz, price_usd double, market_cap_usd double, volume_24h_usd double, circulating_supply double, total_supply double")
    got = {r["i"]: r for r in E.coin_features(df, ["run_ts"], "run_ts").collect()}
    for i, *_, regime, tier, peg, volume in rows:
        r = got[i]
        assert (r["peg_regime"], r["liquidity_tier"], r["is_peg_outlier"], r["is_volume_outlier"]) == (regime, tier, peg, volume), i
    assert sum(r["stablecoin_dominance_pct"] for r in got.values()) == pytest.approx(100)
    assert got[3]["utilization_ratio"] is None and got[4]["utilization_ratio"] is None and got[1]["utilization_ratio"] == 0.5
    assert got[7]["volume_to_marketcap"] is None and got[7]["liquidity_score"] is None and got[7]["depeg_risk_score"] == 0
    assert got[5]["depeg_risk_score"] == pytest.approx(2.01 * 0.2) and got[1]["hour_sin"] == pytest.approx(1)


def test_reserve_bounds(spark):
    rows = [  # first, second, volume, normalised, trust -> reserve, source, risk, tier
        (1, 1e10, 5.0, 1e10, 9e9, 8.0, 1e10, "DefiLlama", "MODERATE", "tier_1"),
        (2, 0.0, 1e9, 1.1e9, 1e9, 7.9, 1e9, "DefiLlama", "HIGH_RISK", "tier_2"),
        (3, None, 1e9, 4.9e8, 4e8, 9.0, 1e9, "Arkham", "SAFE", "tier_3"),
        (4, None, 1e9, 5e8, 4e8, 9.0, 1e9, "Arkham", "MODERATE", "tier_3"),
        (5, None, None, 9.9e7, 9.9e7, 1.0, 0.0, "Missing", "HIGH_RISK", "tier_4"),
        (6, 1e9, None, 4e8, 4e8, 8.9, 1e9, "DefiLlama", "MODERATE", "tier_3"),
    ]
    df = spark.createDataFrame([(r[0], 1, *r[1:6], 1.0) for r in rows], "i int, run int, first_reserve_usd double, second_reserve_usd double, trade_volume_24h_btc double, trade_volume_24h_btc_normalized double, trust_score double, btc_price_usd double")
    got = {r["i"]: r for r in E.reserve_features(df, ["run"]).collect()}
    for i, *_, reserve, source, risk, tier in rows:
        r = got[i]
        assert (r["actual_reserve_usd"], r["data_source"], r["bank_run_risk"], r["exchange_tier"]) == (reserve, source, risk, tier), i
    assert got[5]["reserve_utilization"] == 9.9e7 and got[5]["reserve_dominance_pct"] == 0
    assert got[2]["wash_trading_volume_usd"] == pytest.approx(1e8) and got[2]["whale_withdrawal_risk"] == pytest.approx(1.1e8)
    nothing = df.withColumns({"first_reserve_usd": F.lit(None).cast("double"), "second_reserve_usd": F.lit(None).cast("double")})
    assert {r["reserve_dominance_pct"] for r in E.reserve_features(nothing, ["run"]).collect()} == {0.0}


def test_bucket_bounds(spark):
    rows = [(1, 101.0, 100.0, 1.0, 1.0, 1.0, 0.75, "ABOVE_PRICE", "NEAR_SPOT", "EXTREME_CLUSTER"), (2, 97.0, 100.0, -3.0, 3.0, None, 0.749, "BELOW_PRICE", "MID_RANGE", "HIGH_CLUSTER"), (3, 100.0, 100.0, 7.0, 0.0, 0.0, 0.25, "AT_PRICE", "FAR_RANGE", "MEDIUM_CLUSTER"), (4, 100.0, None, None, None, 2.0, None, "UNKNOWN", "TAIL_RANGE", "LOW_CLUSTER"), (5, 100.0, 0.0, -7.1, 1.0, 1.0, 0.5, "ABOVE_PRICE", "TAIL_RANGE", "HIGH_CLUSTER")]
    df = spark.createDataFrame([(*r[:7], 2.0, -2.0) for r in rows], "i int, price_bucket double, close_price double, distance_pct double, long_sum double, short_sum double, rank_score double, panic_norm double, magnet_norm double")
    got = {r["i"]: r for r in E.bucket_labels(df).collect()}
    for i, *_, where, band, heat in rows:
        assert (got[i]["bucket_location"], got[i]["distance_band"], got[i]["heatmap_intensity_label"]) == (where, band, heat), i
    assert got[2]["long_liq_share"] == 1 and got[3]["long_short_bucket_imbalance"] is None and got[5]["bucket_distance_ratio"] is None
    assert got[1]["heatmap_intensity_score"] == 100 and got[4]["heatmap_intensity_score"] == 80


def test_found_status_and_latest(spark):
    one = lambda df: tuple(Q.found_status(df).first())
    assert one(spark.createDataFrame([("3", False), ("x", True)], "bad_freshness_count string, is_fresh boolean").select("bad_freshness_count", "is_fresh").where("bad_freshness_count = '3'")) == (3, "bad_freshness_count")
    assert one(spark.createDataFrame([(None,)], "bad_freshness_count int")) == (0, "bad_freshness_count_null")
    assert one(spark.createDataFrame([(True, "bad"), (None, "bad"), (False, "ok")], "is_fresh boolean, status string")) == (2, "is_fresh")
    assert one(spark.createDataFrame([(" OK ",), ("Fresh",), ("stale",), (None,)], "quality_status string")) == (2, "quality_status")
    assert one(spark.createDataFrame([("old", "ok")], "status string, freshness_status string")) == (0, "freshness_status")
    assert one(spark.createDataFrame([(1,)], "x int")) == (0, "no_explicit_status_column")
    df = spark.createDataFrame([(None, "2024-01-02 00:00:00"), (None, "nothing")], "latest_data_ts timestamp, updated_at string")
    assert tuple(Q.found_latest(df).first()) == (dt.datetime(2024, 1, 2), "updated_at")
    assert tuple(Q.found_latest(df.select("latest_data_ts")).first()) == (None, None) == tuple(Q.found_latest(df.select(F.lit(1).alias("x"))).first())


def test_recent_runs(spark):
    at = dt.datetime(2024, 1, 8)
    rows = [("a", at, "critical", True), ("a", at, "warning", None), ("b", at, "warning", False), ("c", at, "warning", False), ("c", at, "critical", False), (None, at, "critical", False), ("d", at - dt.timedelta(days=7, seconds=1), "critical", False), ("e", at - dt.timedelta(days=7), "critical", True)]
    got = {r["run_id"]: (r["pipeline_health_status"], r["total_checks"], r["failed_checks"]) for r in Q.recent_runs(spark.createDataFrame(rows, "run_id string, check_ts timestamp_ntz, severity string, success boolean"), F.lit(at).cast("timestamp_ntz")).collect()}
    assert got == {"a": ("HEALTHY", 2, 0), "b": ("WARNING", 1, 1), "c": ("FAILED", 2, 2), "e": ("HEALTHY", 1, 0)}


def test_suite_nulls_combinations_and_offenders(spark):
    child = spark.createDataFrame([(1, "a", 10), (1, "a", 10), (2, None, 20), (2, None, 20), (3, "c", None), (4, "d", 40), (5, "e", 50), (5, "f", 60)], "k int, part string, parent int")
    parent = spark.createDataFrame([(10, True), (20, False), (40, True)], "id int, live boolean")
    tables = {"child": suite.Table(child, [Q.Rule("unique", ["k", "part"]), Q.Rule("accepted", ["part"], values=["a", "c"]), Q.Rule("unique", ["absent"])], [suite.Relationship(["parent"], "parent", ["id"]), suite.Relationship(["parent"], "parent", ["id"], "live", "warning")]), "parent": suite.Table(parent)}
    got = {(r["rule_name"], r["severity"]): (r["violations"], r["passed"], r["offenders"]) for r in suite.run(tables, 2).collect()}
    assert got == {
        ("unique:k,part", "error"): (1, False, "1|a"),  # keys with a null aren't compared
        ("accepted:part", "error"): (3, False, "d,e"),
        ("unique:absent", "error"): (1, False, ""),
        ("relationship:parent->parent(id)", "error"): (2, False, "50,60"),
        ("relationship:parent->parent(id)[live]", "warning"): (4, False, "20,50"),
    }
