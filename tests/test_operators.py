"""Edge rows of the market operators: nulls, ties, gaps, empty tables, leaks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tapeloom.functions import columns as C
from tapeloom.mlops import metrics, training
from tapeloom.operators import alerts, dedupe, joins, series, staging
from tapeloom.quality import rules as Q


def test_arg_first_ignores_nulls(spark):
    df = spark.createDataFrame([("k", None, 5), ("k", 1, 3)], "k string, v int, o int").groupBy("k")
    assert df.agg(C.arg_first(F.col("v"), F.col("o")).alias("v")).first()["v"] == 1
    assert df.agg(C.arg_first(F.col("v"), F.col("o"), ignore_nulls=False).alias("v")).first()["v"] is None


def test_zero_denominators_are_null(spark):
    r = spark.createDataFrame([(1.0, 0.0)], "x double, w double").agg(C.weighted_avg(F.col("x"), F.col("w")).alias("a"), F.first(C.safe_div(F.col("x"), F.col("w"))).alias("b")).first()
    assert r["a"] is None and r["b"] is None


def test_clamp_keeps_null(spark):
    rows = spark.createDataFrame([(None,), (-5.0,), (5.0,), (0.5,)], "x double").select(C.clamp(F.col("x"), 0, 1).alias("c")).collect()
    assert [r["c"] for r in rows] == [None, 0.0, 1.0, 0.5]


def test_gap_keeps_row_semantics(spark):
    df = spark.createDataFrame([("s", h, float(h + 1)) for h in (0, 1, 3)], "symbol string, h int, px double")
    out = series.forward_labels(df, "px", series.by(["symbol"], ["h"]), {1: 0.1}).orderBy("h").collect()
    assert [r["future_direction_1"] for r in out] == ["UP", "UP", None]
    assert out[1]["future_return_1"] == 1.0


def test_single_row_windows(spark):
    df = spark.createDataFrame([("s", 0, 1.0)], "symbol string, h int, px double")
    w = series.last_rows(series.by(["symbol"], ["h"]), 24)
    assert df.select(C.zscore(F.col("px"), w).alias("z")).first()["z"] is None


def test_past_features_see_no_future(spark):
    rows = [("s", h, float((h * 7) % 11)) for h in range(40)]
    w = series.by(["symbol"], ["h"])
    make = lambda r: spark.createDataFrame(r, "symbol string, h int, px double").select("h", series.past_rolling(F.col("px"), w, 4, "mean", 2).alias("m"), series.past_zscore(F.col("px"), w, None, 5).alias("z"))
    whole = {r["h"]: (r["m"], r["z"]) for r in make(rows).collect()}
    cut = {r["h"]: (r["m"], r["z"]) for r in make(rows[:20]).collect()}
    assert all(whole[h] == cut[h] for h in cut)


def ts(minute):
    return dt.datetime(2024, 1, 1, 0, 0) + dt.timedelta(minutes=minute)


def test_asof_edges(spark):
    left = spark.createDataFrame([("a", ts(10), 1), ("a", ts(0), 2), ("b", ts(10), 3), ("a", ts(500), 4), (None, ts(10), 5)], "k string, t timestamp_ntz, id int")
    right = spark.createDataFrame([("a", ts(10), "x", "same"), ("a", ts(5), "x", "old"), ("a", ts(10), "y", "same2"), ("a", ts(11), "z", "late")], "k string, r timestamp_ntz, tie string, v string")
    got = {r["id"]: r["v"] for r in joins.asof_join(left, right, ["k"], "t", "r", ["tie"], ["v"], "1 hour").collect()}
    assert got == {1: "same2", 2: None, 3: None, 4: None, 5: None}
    assert joins.asof_join(left, right.limit(0), ["k"], "t", "r", ["tie"], ["v"]).count() == 5


@pytest.mark.parametrize("how", ["inner", "left"])
def test_interval_join_matches_range_join(spark, how):
    left = spark.createDataFrame([(f"s{i % 2}", ts(i * 7), i) for i in range(60)], "symbol string, lt timestamp_ntz, lid int")
    right = spark.createDataFrame([(f"s{i % 2}", ts(i * 5), i) for i in range(80)], "symbol string, rt timestamp_ntz, rid int")
    got = {(r["lid"], r["rid"]) for r in joins.interval_join(left, right, ["symbol"], "lt", "rt", -600, 300, how).collect()}
    want = {(i, j) for i in range(60) for j in range(80) if i % 2 == j % 2 and -10 <= j * 5 - i * 7 <= 5}
    if how == "left":
        want |= {(i, None) for i in range(60) if not any(x == i for x, _ in want)}
    assert got == want


@pytest.mark.parametrize("how", ["inner", "left"])
def test_interval_join_keeps_every_left_row_however_it_is_partitioned(spark, how):
    left = spark.range(2000).select(F.col("id").alias("lid"), F.lit("s").alias("k"), F.timestamp_seconds(F.col("id") * 10).alias("lt")).repartition(7)
    right = spark.range(0, 2000, 4).select(F.col("id").alias("rid"), F.lit("s").alias("k"), F.timestamp_seconds(F.col("id") * 10).alias("rt")).repartition(5)
    got = sorted(((r["lid"], r["rid"]) for r in joins.interval_join(left, right, ["k"], "lt", "rt", -5, 5, how).collect()), key=str)
    want = [(i, i if i % 4 == 0 else None) for i in range(2000) if i % 4 == 0 or how == "left"]
    assert got == sorted(want, key=str)


def test_points_in_long_spans_and_empty_ones(spark):
    points = spark.createDataFrame([("a", ts(5), 1), ("a", ts(90), 2), ("a", ts(400), 3), ("b", ts(5), 4)], "k string, at timestamp_ntz, p int").repartition(3)
    spans = spark.createDataFrame([("a", ts(0), ts(120), 1), ("a", ts(90), ts(90), 2), ("a", ts(200), ts(100), 3), ("a", None, ts(9), 4)], "k string, a timestamp_ntz, e timestamp_ntz, s int").repartition(2)
    got = {(r["p"], r["s"]) for r in joins.point_in_interval(points, spans, ["k"], "at", "a", "e").collect()}
    assert got == {(1, 1), (2, 1), (2, 2)}


def test_dimension_with_fallback(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    first = spark.createDataFrame([(1, "a", None), (2, None, "x")], "k int, v string, w string")
    second = spark.createDataFrame([(1, "b", "y"), (3, "c", None)], "k int, v string, w string")
    assert sorted(map(tuple, joins.join_with_fallback(left, first, second, ["k"]).collect())) == [(1, "a", "y"), (2, None, "x"), (3, "c", None)]


@pytest.mark.parametrize(("low", "high"), [(-60, 0), (-7, 0), (0, 10), (-5, 5)])
def test_near_finds_what_a_range_join_finds(spark, low, high):
    import random

    from tapeloom.streaming import alerts as A

    rng = random.Random(low)
    rows = [(rng.choice("ab"), rng.randrange(3000), rng.randrange(4)) for _ in range(400)]
    ends = [(s, e) for s in "abc" for e in range(0, 3000, 5)]
    secs = lambda x: F.timestamp_seconds(x).cast("timestamp_ntz")
    other = spark.createDataFrame(rows, "symbol string, t int, v int").select("symbol", secs(F.col("t")).alias("ts"), "v")
    windows = spark.createDataFrame(ends, "symbol string, e int").select("symbol", secs(F.col("e")).alias("event_time"), "e")
    hit = lambda s, e, v: any(x == s and w == v and e + low <= t <= e + high for x, t, w in rows)
    got = {(r["symbol"], r["e"]): r["f"] for r in A.near(windows, other, "ts", low, high, "f", F.col("v") == 1).collect()}
    assert got == {(s, e): hit(s, e, 1) for s, e in ends}
    either = A.near(windows, other, "ts", low, high, "f", A.Either(F.col("e") % 2 == 0, F.col("v") == 1, F.col("v") == 2))
    assert {(r["symbol"], r["e"]): r["f"] for r in either.collect()} == {(s, e): hit(s, e, 1 if e % 2 == 0 else 2) for s, e in ends}


def test_first_rows_of_a_group_as_json(spark):
    from tapeloom.functions import columns as C

    df = spark.createDataFrame([("a", 3, None), ("a", 1, "x"), ("a", 2, "y"), ("b", 9, "z"), (None, 1, "n")], "k string, n int, v string")
    got = {r["k"]: r["j"] for r in C.top_n_json(df, ["k"], ["n", "v"], [F.col("n").desc()], 2, "j").collect()}
    assert got == {"a": '[{"n":3,"v":null},{"n":2,"v":"y"}]', "b": '[{"n":9,"v":"z"}]', None: '[{"n":1,"v":"n"}]'}


def test_correlation_of_what_does_not_vary_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 7.0, 5.0), (None, 1.0, 5.0)], "y double, a double, c double")
    got = {r["feature"]: r["correlation"] for r in metrics.target_correlation(df, "y", ["a", "c"]).collect()}
    assert got["c"] is None and got["a"] == pytest.approx(0.9933992678)


def test_keep_latest_and_priorities(spark):
    df = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new"), (None, 1, "n"), ("b", 1, None)], "k string, at int, v string")
    assert {(r["k"], r["v"]) for r in dedupe.keep_latest(df, ["k"], [F.col("at")]).collect()} == {("a", "new"), (None, "n"), ("b", None)}
    assert dedupe.keep_latest(df.limit(0), ["k"], [F.col("at")]).count() == 0
    u = dedupe.union_by_priority([df.where("k = 'a' and at = 1"), df.where("at = 2")], ["k"])
    assert [r["v"] for r in u.collect()] == ["old"]


def test_stages_keep_rows_on_their_bounds_and_drop_rows_beyond(spark):
    """Each domain rule alone turns a good row away; a good row passes; the later of two versions stays."""
    from tapeloom.plans.staged import RAW

    good = {
        "options": {"instrument_name": "I", "timestamp": "2024-01-01 00:00:00", "underlying": "btc", "option_type": "c", "strike": "1", "index_price": "1", "underlying_price": "1", "mark_price": "0", "mark_iv": "0", "mid_iv": "0", "open_interest": "0", "delta": "-1.05"},
        "funding": {"exchange": "X", "symbol": "eth", "timestamp": "2024-01-01 00:00:00", "mark_price": "1", "spot_price": "1", "basis_pct": "20", "funding_rate_coin": "-10", "funding_rate_usdt": "10"},
        "telegram": {"channel": "C", "message_id": "7", "text": "t", "nlp_compound": "1", "signal_type": "bullish", "views": "0", "engagement_score": "0.99"},
    }
    bad = {
        "options": {"underlying": "sol", "option_type": "x", "strike": "0", "index_price": "0", "underlying_price": "bad", "mark_price": "-0.1", "mark_iv": "-1", "mid_iv": None, "open_interest": "-1", "delta": "1.051", "instrument_name": None},
        "funding": {"symbol": "SOL", "mark_price": "0", "spot_price": None, "basis_pct": "20.1", "funding_rate_coin": "-10.1", "funding_rate_usdt": "11", "exchange": None},
        "telegram": {"text": "", "nlp_compound": "1.1", "signal_type": "odd", "views": "-1", "engagement_score": "0.98", "message_id": "x"},
    }
    assert {k for k, _ in RAW.values()} == set(staging.STAGES) - {"trades"}
    for kind, row in good.items():
        spec = staging.STAGES[kind]
        rows = [row | {"ingestion_time": "2024-02-01 00:00:00", "run_id": "old"}, row | {"ingestion_time": "2024-02-02 00:00:00", "run_id": "new"}]
        rows += [row | {c: v, "ingestion_time": "2024-03-01 00:00:00", "run_id": c} for c, v in bad[kind].items()]
        out = staging.stage(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in rows[0])), spec)
        assert [r["run_id"] for r in out.collect()] == ["new"], kind
        assert out.columns == [c for c in spec.columns if c not in spec.helpers]


def test_rule_alerts_fire_only_where_met(spark):
    rule = alerts.Rule("HIGH", "x", [(F.col("v") > 10, "CRITICAL"), (F.col("v") > 5, "HIGH")], F.lit("m"), F.col("v"), "act")
    got = alerts.rule_alerts(spark.createDataFrame([(1, 20.0), (2, 7.0), (3, 1.0), (4, None)], "id int, v double"), ["id"], [rule]).collect()
    assert {(r["id"], r["alert_severity"]) for r in got} == {(1, "CRITICAL"), (2, "HIGH")}


def test_quality_rules_report_all_failures(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (1, "b", None), (None, "zz", 50.0)], "id int, kind string, x double")
    spec = {"required_columns": ["id", "gone"], "min_rows": 5, "not_null": ["id", "x"], "accepted_values": {"kind": ["a", "b"]}, "unique_key": ["id"], "ranges": {"x": {"min": 0, "max": 10}}}
    got = {r["rule_name"]: r["violations"] for r in Q.run_rules(df, Q.parse(spec), "t").collect()}
    assert got == {"columns:id,gone": 1, "min_rows": 2, "not_null:id": 1, "not_null:x": 1, "accepted:kind": 1, "unique:id": 1, "between:x": 1}
    with pytest.raises(Q.RulesFailed, match="not_null:id"):
        Q.enforce(df, Q.parse(spec), "t")
    assert Q.enforce(df, [Q.Rule("min_rows", low=1)], "t") is df
    assert [r["kind"] for r in Q.offenders(df, "kind", ["a", "b"]).collect()] == ["zz"]


def test_walk_forward_folds_do_not_overlap(spark):
    df = spark.createDataFrame([(i,) for i in range(36)], "t int")
    rows = series.walk_forward(df, "t", 3, window=6).collect()
    for f in range(3):
        train = [r["t"] for r in rows if r["fold"] == f and r["role"] == "train"]
        test = [r["t"] for r in rows if r["fold"] == f and r["role"] == "test"]
        assert len(train) == 6 and max(train) < min(test)
    assert sorted(r["t"] for r in rows if r["role"] == "test") == list(range(18, 36))


def test_auc_with_ties_matches_pairs(spark):
    rows = [(1, 0.9), (0, 0.9), (1, 0.3), (0, 0.1), (0, 0.3), (1, 0.3)]
    want = sum(1.0 if p > n else 0.5 if p == n else 0.0 for a, p in rows if a for b, n in rows if not b) / 9
    assert metrics.auc(spark.createDataFrame(rows, "a int, s double"), [], "a", "s").first()["auc"] == pytest.approx(want)


def test_validate_importance_and_unknown_categories(spark):
    rows = [("UP" if i % 2 else "DOWN", float(i % 2) + (i % 5) / 10, None if i % 7 == 0 else float(i), "a" if i % 3 else "b", "train" if i < 40 else "test") for i in range(60)]
    df = spark.createDataFrame(rows, "y string, f1 double, f2 double, c string, split_name string")
    frame = training.training_frame(df, ["f1", "f2"], ["c"], "y", ["UP", "DOWN"], ["split_name"])
    assert all(r["is_valid"] for r in training.validate(frame, "split_name", 50, 20, 2).collect())
    for kind in ("logistic", "forest"):
        model = training.pipeline(["f1", "f2"], ["c"], kind).fit(training.balanced_weights(frame.where("split_name = 'train'")))
        scored = training.score(model, frame.withColumn("c", F.lit("NEW")), ["DOWN", "UP"])
        assert scored.where("predicted = label_text").count() > 50
        assert training.importance(model, ["f1", "f2"], ["c"])[0][0] == "f1"
    with pytest.raises(ValueError, match="missing"):
        training.training_frame(df, ["nope"], [], "y", ["UP"])


def test_latest_run_and_full_outer(spark):
    df = spark.createDataFrame([("r1", 1, "a"), ("r2", 2, "b"), ("r2", 2, "c")], "run_id string, at int, v string")
    assert {r["v"] for r in dedupe.latest_run(df, "run_id", "at").collect()} == {"b", "c"}
    both = joins.full_outer(df.where("v = 'a'").select("v"), df.where("v = 'b'").select("v"), ["v"], "l", "r").collect()
    assert {(r["v"], r["l"], r["r"]) for r in both} == {("a", True, False), ("b", False, True)}
    assert [r["column_name"] for r in joins.missing_columns(df, ["v", "w"]).collect()] == ["w"]
