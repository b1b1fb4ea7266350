"""Datasets, models and scoring on pyspark.ml."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Imputer, OneHotEncoder, OneHotEncoderModel, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.mlops import metrics
from tapeloom.operators.chunked import ranked
from tapeloom.sources.shared import written


def training_frame(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str, labels: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The contract's columns in their order, numbers cast, categories upper-case with UNKNOWN for null; valid labels only."""
    missing = [c for c in [*numeric, *categorical, label, *keep] if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}")
    return df.where(F.col(label).isin(*labels)).select(
        *keep, *[F.col(c).try_cast("double").alias(c) for c in numeric], *[F.coalesce(F.upper(F.trim(F.col(c).cast("string"))), F.lit("UNKNOWN")).alias(c) for c in categorical], F.col(label).alias("label_text")
    )


def validate(df: DataFrame, split: str, min_total: int, min_split: int, min_classes: int) -> DataFrame:
    """A row a split: rows, classes and whether they suffice, for the split and in total."""
    g = df.groupBy(split).agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("label_text").alias("class_count"))
    total = F.sum("row_count").over(Window.partitionBy())  # a row a split
    return g.withColumn("is_valid", (F.col("row_count") >= min_split) & (F.col("class_count") >= min_classes) & (total >= min_total))


def balanced_weights(df: DataFrame, weight: str | None = None, low: float = 0.1, high: float = 10.0) -> DataFrame:
    """Adds weight: rows / (classes * rows of the class), times the sample weight within [low, high]."""
    counts = df.groupBy("label_text").agg(F.count(F.lit(1)).alias("_n"))
    all_ = Window.partitionBy()  # a row a class
    scale = counts.select("label_text", (F.sum("_n").over(all_) / (F.count(F.lit(1)).over(all_) * F.col("_n"))).alias("_scale"))
    own = F.greatest(F.lit(low), F.least(F.lit(high), F.coalesce(F.col(weight), F.lit(1.0)))) if weight else F.lit(1.0)
    return df.join(F.broadcast(scale), "label_text").withColumn("weight", F.col("_scale") * own).drop("_scale")


def preparation(numeric: Sequence[str], categorical: Sequence[str]) -> list:
    """Median imputation, scaling and one-hot with room for unknown categories, into ``features``."""
    filled = [f"{c}__f" for c in numeric]
    stages = [Imputer(strategy="median", inputCols=list(numeric), outputCols=filled), VectorAssembler(inputCols=filled, outputCol="_num"), StandardScaler(inputCol="_num", outputCol="_scaled", withMean=True)]
    parts = ["_scaled"]
    for c in categorical:
        stages += [StringIndexer(inputCol=c, outputCol=f"{c}__i", handleInvalid="keep"), OneHotEncoder(inputCols=[f"{c}__i"], outputCols=[f"{c}__o"], handleInvalid="keep")]
        parts.append(f"{c}__o")
    return [*stages, VectorAssembler(inputCols=parts, outputCol="features")]


def pipeline(numeric: Sequence[str], categorical: Sequence[str], kind: str = "logistic", seed: int = 42) -> Pipeline:
    """Preparation, then the classifier."""
    model = (
        LogisticRegression(weightCol="weight", family="multinomial", maxIter=50, regParam=0.01)
        if kind == "logistic"
        else RandomForestClassifier(weightCol="weight", numTrees=40, maxDepth=6, seed=seed)
    )
    return Pipeline(stages=[*preparation(numeric, categorical), StringIndexer(inputCol="label_text", outputCol="label", handleInvalid="keep", stringOrderType="alphabetAsc"), model])


@dataclass(frozen=True)
class Boosted:
    """Gradient-boosted trees, one class against the rest each; probabilities are normalised over the classes."""

    prepared: PipelineModel
    labels: tuple[str, ...]
    trees: tuple

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.prepared.transform(df)
        for i, tree in enumerate(self.trees):
            out = tree.transform(out).withColumn(f"_p{i}", F.get(vector_to_array("probability"), F.lit(1))).drop("rawPrediction", "probability", "prediction")
        total = sum((F.col(f"_p{i}") for i in range(len(self.labels))), F.lit(0.0))
        return out.withColumn("probability", F.array(*[F.col(f"_p{i}") / total for i in range(len(self.labels))])).drop(*[f"_p{i}" for i in range(len(self.labels))])


def fit_boosted(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], labels: Sequence[str], trees: int = 20, depth: int = 4, rate: float = 0.2, seed: int = 42) -> Boosted:
    """Boosted trees for several classes, with the rows' ``weight`` (class and sample weights); the classes' fits run side by side."""
    prepared = Pipeline(stages=preparation(numeric, categorical)).fit(train)
    ready = written(prepared.transform(train).select("features", "weight", "label_text"), "boosted")  # every tree scans it

    def one(label: str):
        own = ready.withColumn("label", (F.col("label_text") == label).cast("double"))
        return GBTClassifier(weightCol="weight", maxIter=trees, maxDepth=depth, stepSize=rate, subsamplingRate=0.8, minInstancesPerNode=10, seed=seed).fit(own)

    with ThreadPoolExecutor(max_workers=len(labels)) as pool:
        fitted = list(pool.map(inheritable_thread_target(train.sparkSession)(one), labels))
    return Boosted(prepared, tuple(labels), tuple(fitted))


def score(model: PipelineModel | Boosted, df: DataFrame, labels: Sequence[str], least: float = 0.6, completeness: str | None = None, min_completeness: float = 0.0) -> DataFrame:
    """Probabilities, prediction, confidence and a signal: the class where the confidence suffices, else NO_SIGNAL.

    labels: in alphabetical order, as the model has them. Rows less complete than the gate asks for have no signal.
    """
    scored = model.transform(df.withColumn("weight", F.lit(1.0)) if "weight" not in df.columns else df)
    p = F.col("probability") if isinstance(model, Boosted) else vector_to_array("probability")
    out = scored.withColumns({f"prob_{x.lower()}": F.get(p, F.lit(i)) for i, x in enumerate(labels)})
    best = F.greatest(*[F.col(f"prob_{x.lower()}") for x in labels])
    picked = F.lit(None).cast("string")
    for x in reversed(labels):
        picked = F.when(F.col(f"prob_{x.lower()}") == best, x).otherwise(picked)
    gate = F.coalesce(F.col(completeness), F.lit(0.0)) >= min_completeness if completeness else F.lit(True)
    out = out.withColumns({"confidence": best, "predicted": picked})
    return out.withColumn("signal", F.when(gate & (F.col("confidence") >= least), F.col("predicted")).otherwise("NO_SIGNAL"))


def rolling_train(df: DataFrame, ts: str, days: int | None) -> DataFrame:
    """The last ``days`` of the rows, all for None: one of the training strategies."""
    if days is None:
        return df
    last = df.agg(F.max(ts).alias("_last"))
    return df.crossJoin(F.broadcast(last)).where(F.col(ts) >= F.col("_last") - F.make_dt_interval(F.lit(days))).drop("_last")  # one row


def importance(model: PipelineModel, numeric: Sequence[str], categorical: Sequence[str]) -> list[tuple[str, float]]:
    """Importance of the source columns from coefficients or tree gains, categories summed to their column."""
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        values = last.featureImportances.toArray()
    else:
        values = abs(last.coefficientMatrix.toArray()).mean(axis=0)
    out, at = [], len(numeric)
    named = list(zip(numeric, values[:at].tolist(), strict=True))
    for c in categorical:
        size = next(s for s in model.stages if isinstance(s, OneHotEncoderModel) and s.getOutputCols() == [f"{c}__o"]).categorySizes[0]
        named.append((c, float(values[at : at + size].sum())))
        at += size
    return sorted(named, key=lambda x: (-x[1], x[0]))


def choose_best(metrics: DataFrame, metric: str, tie: str) -> DataFrame:
    """The candidate with the best metric; ties by the second, then by name."""
    return metrics.agg(F.max_by("candidate", F.struct(metric, tie, "candidate")).alias("candidate"))


@dataclass(frozen=True)
class Strategy:
    name: str
    kind: str  # logistic, boosted or forest
    days: int | None  # of training before the validation; all for None


#: Names, kinds and training windows of the strategies.
STRATEGIES = (
    Strategy("logistic_baseline_all_history", "logistic", None),
    Strategy("lightgbm_all_history_fixed_params", "boosted", None),
    Strategy("lightgbm_rolling_180d", "boosted", 180),
    Strategy("lightgbm_rolling_90d", "boosted", 90),
)


def fold_bounds(df: DataFrame, ts: str, folds: int, warm_up: float = 0.5) -> list[tuple[int, object, object]]:
    """(fold, first time, last time) of each fold's validation: the distinct times after the warm-up in equal runs, the
    last one to the end. Times are ranked by range partitions, and two rows a fold come to the driver."""
    times = written(ranked(df.select(ts).where(F.col(ts).isNotNull()).distinct(), [], [ts], "_n"), "times")
    total = times.count()
    start = max(1, int(total * warm_up))
    folds = min(folds, total - start)
    if total < 4 or folds < 1:
        raise ValueError("too few times for walk-forward folds")
    size = max(1, (total - start) // folds)
    edges = [(k, start + k * size, total - 1 if k == folds - 1 else start + (k + 1) * size - 1) for k in range(folds)]
    at = {r["_n"]: r[ts] for r in times.where(F.col("_n").isin([n for _, a, b in edges for n in (a, b)])).collect()}
    return [(k, at[a], at[b]) for k, a, b in edges]


def strategy_folds(
    df: DataFrame, ts: str, numeric: Sequence[str], categorical: Sequence[str], labels: Sequence[str], folds: int = 3, strategies: Sequence[Strategy] = STRATEGIES, sample_weight: str | None = None, gap: float = 0.08, spread: float = 0.06, workers: int = 4
) -> DataFrame:
    """Every strategy fitted and validated in every walk-forward fold: a row a fold and strategy.

    df: ``ts``, features and label_text (see ``training_frame``). A fold trains on rows before its validation, or on
    the last days of them; rows of equal time are never on both sides. Fits are Spark jobs that run side by side, a
    few at a time, over one written table. Returns strategy, fold, train_rows, validation_rows, train_macro_f1,
    validation_macro_f1, validation_balanced_accuracy, fold_spread (deviation over the strategy's folds), is_overfit
    (train above validation by ``gap``, or folds apart by ``spread``) and is_best (highest mean validation F1; of equal
    ones boosted trees, then by name). Folds without rows of two classes to train on have null metrics.
    """
    spark = df.sparkSession
    table = written(df, "folds")
    bounds = fold_bounds(table, ts, folds)

    def one(job: tuple[Strategy, tuple]) -> tuple:
        strategy, (fold, first, last) = job
        before = F.col(ts) < F.lit(first)
        if strategy.days is not None:
            before = before & (F.col(ts) >= F.lit(first) - F.make_dt_interval(F.lit(strategy.days)))
        train, test = table.where(before), table.where((F.col(ts) >= F.lit(first)) & (F.col(ts) <= F.lit(last)))
        classes = {r[0]: r[1] for r in train.groupBy("label_text").count().collect()}
        present, counts = sorted(classes), (sum(classes.values()), test.count())
        if len(present) < 2 or not counts[1]:
            return (strategy.name, fold, *counts, None, None, None)
        weighed = balanced_weights(train, sample_weight)
        model = fit_boosted(weighed, numeric, categorical, present) if strategy.kind == "boosted" else pipeline(numeric, categorical, strategy.kind).fit(weighed)
        both = train.withColumn("_seen", F.lit(True)).unionAll(test.withColumn("_seen", F.lit(False)))
        scored = score(model, both, present).select("_seen", F.col("label_text").alias("actual"), "predicted")
        got = {r["_seen"]: r for r in metrics.classification(scored, ["_seen"], labels).collect()}  # two rows
        return (strategy.name, fold, *counts, got[True]["macro_f1"], got[False]["macro_f1"], got[False]["balanced_accuracy"])

    jobs = [(s, b) for s in strategies for b in bounds]
    with ThreadPoolExecutor(max_workers=workers) as pool:
        rows = list(pool.map(inheritable_thread_target(spark)(one), jobs))
    found = spark.createDataFrame(rows, "strategy string, fold long, train_rows long, validation_rows long, train_macro_f1 double, validation_macro_f1 double, validation_balanced_accuracy double")
    own = Window.partitionBy("strategy")  # a row a fold
    boosted = F.col("strategy").isin([s.name for s in strategies if s.kind == "boosted"])
    each = found.withColumns({"fold_spread": F.stddev_samp("validation_macro_f1").over(own), "_mean": F.coalesce(F.avg("validation_macro_f1").over(own), F.lit(-1.0))})
    best = each.agg(F.max_by("strategy", F.struct("_mean", boosted.alias("b"), "strategy")).alias("_best"))
    flagged = each.withColumn("is_overfit", F.coalesce(F.col("train_macro_f1") - F.col("validation_macro_f1") > gap, F.lit(False)) | F.coalesce(F.col("fold_spread") > spread, F.lit(False)))
    return flagged.crossJoin(F.broadcast(best)).withColumn("is_best", F.col("strategy") == F.col("_best")).drop("_best", "_mean")
