"""Strategies in folds, boosted trees, threshold policy and class-wise curves on planted rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tapeloom.mlops import metrics as M
from tapeloom.mlops import training as T

START = dt.datetime(2024, 1, 1)
SCHEMA = "hour_ts timestamp_ntz, a double, b double, leak double, symbol string, label_text string"


def planted(n=900, seed=4):
    """The label is a ring of a and b, which no linear model tells; ``leak`` gives it away, but only in the first 60 %."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b = rng.uniform(-1, 1), rng.uniform(-1, 1)
        r = a * a + b * b
        label = "DOWN" if r < 0.35 else "FLAT" if r < 0.8 else "UP"
        leak = {"DOWN": -1.0, "FLAT": 0.0, "UP": 1.0}[label] if i < 0.6 * n else rng.uniform(-1, 1)
        out.append((START + dt.timedelta(hours=i // 3), a, b, leak, rng.choice("XY"), label))
    return out


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(planted(), SCHEMA)


def accuracy(scored):
    return scored.agg(F.avg((F.col("predicted") == F.col("label_text")).cast("double"))).first()[0]


def test_boosted_trees_beat_the_linear_model(rows):
    train = T.balanced_weights(rows.where(F.col("hour_ts") < START + dt.timedelta(hours=200)))
    test = rows.where(F.col("hour_ts") >= START + dt.timedelta(hours=200))
    labels = ["DOWN", "FLAT", "UP"]
    boosted = T.score(T.fit_boosted(train, ["a", "b"], ["symbol"], labels), test, labels)
    total = boosted.select(sum(F.col(f"prob_{x.lower()}") for x in labels).alias("s")).agg(F.min("s"), F.max("s")).first()
    assert total[0] == pytest.approx(1.0) and total[1] == pytest.approx(1.0)
    linear = T.score(T.pipeline(["a", "b"], ["symbol"]).fit(train), test, labels)
    assert accuracy(boosted) > 0.85 > 0.6 > accuracy(linear)


def test_folds_and_strategies_flag_a_planted_leak(rows):
    strategies = [T.Strategy("linear", "logistic", None), T.Strategy("boosted", "boosted", None), T.Strategy("recent", "boosted", 2)]
    clean = {(r["strategy"], r["fold"]): r for r in T.strategy_folds(rows, "hour_ts", ["a", "b"], ["symbol"], ["DOWN", "FLAT", "UP"], 2, strategies, gap=0.25, spread=0.2).collect()}
    assert set(clean) == {(s.name, k) for s in strategies for k in (0, 1)}
    assert {r["strategy"] for r in clean.values() if r["is_best"]} == {"boosted"} and not clean["boosted", 0]["is_overfit"]
    assert clean["boosted", 0]["train_rows"] == 450 and clean["boosted", 1]["train_rows"] == 675 and clean["recent", 1]["train_rows"] == 144
    assert sum(clean["boosted", k]["validation_rows"] for k in (0, 1)) == 450
    leaky = T.strategy_folds(rows, "hour_ts", ["leak"], [], ["DOWN", "FLAT", "UP"], 2, [T.Strategy("boosted", "boosted", None)], gap=0.25).collect()
    assert all(r["is_overfit"] for r in leaky) and max(r["train_macro_f1"] for r in leaky) > 0.95


def test_fold_bounds(spark, rows):
    bounds = T.fold_bounds(rows, "hour_ts", 4)
    hours = [START + dt.timedelta(hours=h) for h in range(300)]
    assert bounds == [(0, hours[150], hours[186]), (1, hours[187], hours[223]), (2, hours[224], hours[260]), (3, hours[261], hours[299])]
    with pytest.raises(ValueError, match="too few times"):
        T.fold_bounds(rows.where(F.col("hour_ts") < hours[2]), "hour_ts", 4)


def test_classification_works_scores_out_once(spark):
    """as a filter, the check for nulls copied a model's prediction below its scores, 144 calls of functions a row."""
    from pyspark.sql.types import DoubleType

    slow = F.udf(lambda x: x, DoubleType())
    p = slow("x")
    scored = spark.createDataFrame([("a", 0.2), ("b", 0.7), (None, 0.9), ("a", None)], "actual string, x double").withColumn("p", p).withColumn("predicted", F.when(F.col("p") == F.greatest("p", F.lit(0.5)), "b").when(F.col("p").isNotNull(), "a"))
    got = M.classification(scored, [], ["a", "b"])
    assert got._jdf.queryExecution().optimizedPlan().toString().count("<lambda>(") == 1
    assert (got.first()["row_count"], got.first()["macro_f1"]) == (2, 1.0)
    keyed = M.classification(scored.withColumn("k", F.coalesce("actual", F.lit("none"))), ["k"], ["a", "b"])
    assert {r["k"]: (r["row_count"], r["accuracy"]) for r in keyed.collect()} == {"a": (1, 1.0), "b": (1, 1.0)}  # none: no row that has both


def test_threshold_grid_against_brute_force(spark):
    rng = random.Random(6)
    classes = ("DOWN", "FLAT", "UP")
    rows = []
    for _ in range(300):
        p = [rng.choice([0.2, 0.3, 0.31, 0.5, 0.55, 0.7]) for _ in classes]
        rows.append((rng.choice([*classes, None]), *(x / sum(p) for x in p)))
    df = spark.createDataFrame(rows, "actual string, prob_down double, prob_flat double, prob_up double")

    def measured(threshold):
        pairs = [(r[0], "DOWN" if threshold is not None and r[1] >= threshold else classes[max(range(3), key=lambda i: (r[1 + i], -i))]) for r in rows if r[0]]
        f1, recall = [], []
        for c in classes:
            hit, is_, said = (sum(w(a, b) for a, b in pairs) for w in (lambda a, b: a == b == c, lambda a, b: a == c, lambda a, b: b == c))
            f1.append(2 * hit / (is_ + said) if is_ + said else 0.0)
            recall.append(hit / is_ if is_ else 0.0)
        return sum(f1) / 3, recall[0], min(recall)

    grid = {r["threshold"]: (r["macro_f1"], r["target_recall"], r["min_recall"]) for r in M.threshold_grid(df, classes, "DOWN", M.POLICY_THRESHOLDS, "actual").collect()}
    assert set(grid) == {None, *M.POLICY_THRESHOLDS}
    for t, got in grid.items():
        assert got == pytest.approx(measured(t))
    for drop in (0.0, 0.03, -1.0):
        fine = [t for t in M.POLICY_THRESHOLDS if grid[t][0] >= grid[None][0] - drop]
        want = max(fine or M.POLICY_THRESHOLDS, key=lambda t: (grid[t][1], grid[t][0], grid[t][2], -t))
        got = M.threshold_policy(M.threshold_grid(df, classes, "DOWN", M.POLICY_THRESHOLDS, "actual"), drop).first()
        assert (got["threshold"], got["eligible"], got["reason"]) == (want, bool(fine), M.WITHIN if fine else M.DIAGNOSTIC)


def test_class_auc_with_ties(spark):
    rows = [("A", 0.9, 0.1), ("A", 0.5, 0.5), ("B", 0.5, 0.5), ("B", 0.2, 0.8), (None, 1.0, 0.0)]
    got = {r["class_name"]: (r["row_count"], r["auc"]) for r in M.class_auc(spark.createDataFrame(rows, "actual string, prob_a double, prob_b double"), ["A", "B"], "actual").collect()}
    assert got == {"A": (4, 0.875), "B": (4, 0.875)}


def test_choose_best_and_rolling(spark, rows):
    board = spark.createDataFrame([("x", 0.5, 0.1), ("y", 0.5, 0.2), ("z", 0.4, 0.9)], "candidate string, f1 double, recall double")
    assert T.choose_best(board, "f1", "recall").first()["candidate"] == "y"
    assert T.rolling_train(rows, "hour_ts", 1).count() == 75 and T.rolling_train(rows, "hour_ts", None).count() == 900
