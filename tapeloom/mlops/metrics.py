"""Model evaluation as aggregates: every metric is a few counts, no prediction reaches the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions.columns import safe_div


def confusion(df: DataFrame, keys: Sequence[str], actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    return df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull()).groupBy(*keys, F.col(actual).cast("string").alias("actual"), F.col(predicted).cast("string").alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def classification(df: DataFrame, keys: Sequence[str], labels: Sequence, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Accuracy, macro precision, recall and F1, least recall and balanced accuracy by key, of rows that have both.

    A class without predictions has precision 0, one without rows recall 0 and stays out of balanced accuracy. Rows are
    told apart in the counts: as a filter, a model's prediction would be pushed below its scores and work them out anew
    at each mention.
    """
    a, p = F.col(actual).cast("string"), F.col(predicted).cast("string")
    has = a.isNotNull() & p.isNotNull()
    counts = []
    for i, x in enumerate(map(str, labels)):
        counts += [F.count_if((a == x) & (p == x)).alias(f"t{i}"), F.count_if(has & (a == x)).alias(f"a{i}"), F.count_if(has & (p == x)).alias(f"p{i}")]
    g = df.groupBy(*keys).agg(F.count_if(has).alias("row_count"), F.count_if(a == p).alias("correct"), *counts)
    if keys:
        g = g.where("row_count > 0")
    k = len(labels)
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    prec = [zero(safe_div(F.col(f"t{i}"), F.col(f"p{i}"))) for i in range(k)]
    rec = [zero(safe_div(F.col(f"t{i}"), F.col(f"a{i}"))) for i in range(k)]
    f1 = [zero(safe_div(F.lit(2.0) * F.col(f"t{i}"), F.col(f"a{i}") + F.col(f"p{i}"))) for i in range(k)]
    present = [(F.col(f"a{i}") > 0).cast("int") for i in range(k)]
    mean = lambda xs: sum(xs, F.lit(0.0)) / k
    return g.select(
        *keys, "row_count", (F.col("correct") / F.col("row_count")).alias("accuracy"), mean(prec).alias("macro_precision"), mean(rec).alias("macro_recall"), mean(f1).alias("macro_f1"), F.least(*rec).alias("min_recall"),
        safe_div(sum(rec, F.lit(0.0)), sum(present, F.lit(0))).alias("balanced_accuracy"),
    )


def auc(df: DataFrame, keys: Sequence[str], actual: str, score: str) -> DataFrame:
    """Area under the ROC curve by ranks; ties share their mean rank. actual is 0 or 1.

    Scores are counted first, so the window runs over distinct scores by key, not over rows.
    """
    by = df.where(F.col(actual).isNotNull() & F.col(score).isNotNull()).groupBy(*keys, F.col(score).alias("_s")).agg(F.count_if(F.col(actual) == 1).alias("_p"), F.count_if(F.col(actual) == 0).alias("_n"))
    below = F.coalesce(F.sum("_n").over(Window.partitionBy(*keys).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    won = by.withColumn("_won", F.col("_p") * (below + F.col("_n") / 2))
    return won.groupBy(*keys).agg(safe_div(F.sum("_won"), F.sum("_p") * F.sum("_n")).alias("auc"))


def log_loss(actual: Column, prob: Column, eps: float = 1e-15) -> Column:
    p = F.greatest(F.lit(eps), F.least(F.lit(1 - eps), prob))
    return F.avg(-F.when(actual == 1, F.ln(p)).otherwise(F.ln(1 - p)))


def brier(actual: Column, prob: Column) -> Column:
    return F.avg(F.pow(prob - actual, F.lit(2)))


def calibration(df: DataFrame, actual: str, score: str, bins: int = 10) -> DataFrame:
    """Mean score and hit rate by score bin."""
    b = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(b.alias("score_bin")).agg(F.count(F.lit(1)).alias("row_count"), F.avg(score).alias("mean_score"), F.avg(F.col(actual).cast("double")).alias("hit_rate"))


def threshold_search(df: DataFrame, actual: str, score: str, low: float, high: float, steps: int) -> DataFrame:
    """Precision, recall and F1 for each threshold: scores are counted by step first, so cost doesn't grow with steps."""
    width = (high - low) / (steps - 1)
    step = F.floor((F.col(score) - low) / width + 1e-9)
    step = F.when(step < 0, -1).otherwise(F.least(step, F.lit(steps - 1))).cast("int")
    by = df.groupBy(step.alias("_step")).agg(F.count_if(F.col(actual) == 1).alias("_p"), F.count_if(F.col(actual) == 0).alias("_n"))
    grid = df.sparkSession.range(steps).select(F.col("id").cast("int").alias("step"), F.round(low + F.col("id") * width, 6).alias("threshold"))
    j = grid.crossJoin(F.broadcast(by)).groupBy("step", "threshold").agg(*[F.sum(F.when(F.col("_step") >= F.col("step"), F.col(c)).otherwise(0)).alias(n) for c, n in (("_p", "tp"), ("_n", "fp"))], F.sum("_p").alias("pos"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return j.select("threshold", zero(safe_div(F.col("tp"), F.col("tp") + F.col("fp"))).alias("precision"), zero(safe_div(F.col("tp"), F.col("pos"))).alias("recall"), zero(safe_div(F.lit(2.0) * F.col("tp"), F.col("tp") + F.col("fp") + F.col("pos"))).alias("f1"))


def class_auc(df: DataFrame, classes: Sequence[str], actual: str, probability: str = "prob_{}") -> DataFrame:
    """Each class against the rest: its area under the ROC curve, rows and share, all classes in one pass by ranks.

    probability: the columns' names with the class in lower case put in. Rows without the label are left out.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("class_name"), F.col(probability.format(c.lower())).alias("_score"), (F.col(actual) == c).cast("int").alias("_is")) for c in classes])
    each = df.where(F.col(actual).isNotNull()).select(F.inline(pairs))
    counts = each.groupBy("class_name").agg(F.count(F.lit(1)).alias("row_count"), F.avg(F.col("_is").cast("double")).alias("class_share"))
    return counts.join(auc(each, ["class_name"], "_is", "_score"), "class_name", "left")


def threshold_grid(df: DataFrame, classes: Sequence[str], target: str, thresholds: Sequence[float], actual: str, probability: str = "prob_{}") -> DataFrame:
    """What each threshold gives if the target class is predicted from it on and the likeliest class elsewhere.

    Rows are counted once, by how many thresholds their target probability reaches, likeliest class (the first of
    equals) and label: some steps × classes² counts, from which every threshold's confusion follows. ``threshold`` is
    null for the likeliest class alone, the baseline. Returns threshold, macro_f1, target_recall, min_recall.
    """
    p = {c: F.col(probability.format(c.lower())) for c in classes}
    best = F.greatest(*p.values())
    likeliest = F.lit(None).cast("string")
    for c in reversed(classes):
        likeliest = F.when(p[c] == best, c).otherwise(likeliest)
    steps = sorted(thresholds)
    reached = F.size(F.filter(F.array(*map(F.lit, steps)), lambda t: t <= p[target]))
    counts = df.where(F.col(actual).isNotNull() & best.isNotNull()).groupBy(reached.alias("_reached"), likeliest.alias("_likeliest"), F.col(actual).alias("_actual")).agg(F.count(F.lit(1)).alias("_n"))
    grid = df.sparkSession.createDataFrame([(i + 1, t) for i, t in enumerate(steps)] + [(len(steps) + 1, None)], "_step int, threshold double")
    met = counts.crossJoin(F.broadcast(grid)).withColumn("_predicted", F.when(F.col("_reached") >= F.col("_step"), target).otherwise(F.col("_likeliest")))  # counts, not rows
    sums = []
    for i, c in enumerate(classes):
        is_, said = F.col("_actual") == c, F.col("_predicted") == c
        sums += [F.sum(F.when(w, F.col("_n")).otherwise(0)).alias(f"{n}{i}") for n, w in (("t", is_ & said), ("a", is_), ("p", said))]
    g = met.groupBy("threshold").agg(*sums)
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    recall = {c: zero(safe_div(F.col(f"t{i}"), F.col(f"a{i}"))) for i, c in enumerate(classes)}
    f1 = sum((zero(safe_div(F.lit(2.0) * F.col(f"t{i}"), F.col(f"a{i}") + F.col(f"p{i}"))) for i in range(len(classes))), F.lit(0.0)) / len(classes)
    return g.select("threshold", f1.alias("macro_f1"), recall[target].alias("target_recall"), F.least(*recall.values()).alias("min_recall"))


#: Thresholds that are tried, and why one is chosen.
POLICY_THRESHOLDS = tuple(round(0.20 + 0.01 * i, 2) for i in range(36))
WITHIN, DIAGNOSTIC = "within_macro_f1_drop_budget", "diagnostic_only_no_threshold_met_f1_drop_budget"


def threshold_policy(grid: DataFrame, max_drop: float = 0.03) -> DataFrame:
    """The threshold with the highest recall of the target among those that cost at most ``max_drop`` of macro F1, or of
    all if none does; ties by F1, then least recall of a class, then the lower threshold. One row, with the baseline's."""
    base = grid.where("threshold is null").select(F.col("macro_f1").alias("baseline_macro_f1"), F.col("target_recall").alias("baseline_target_recall"))
    tried = grid.where("threshold is not null").crossJoin(F.broadcast(base)).withColumn("eligible", F.col("macro_f1") >= F.col("baseline_macro_f1") - max_drop)
    order = F.struct("eligible", "target_recall", "macro_f1", "min_recall", (-F.col("threshold")).alias("low"))
    row = F.struct("threshold", "eligible", "macro_f1", "target_recall", "min_recall", "baseline_macro_f1", "baseline_target_recall")
    chosen = tried.agg(F.max_by(row, order).alias("r")).where("r is not null").select("r.*")  # a row a threshold
    return chosen.withColumn("reason", F.when(F.col("eligible"), WITHIN).otherwise(DIAGNOSTIC))


def promotion(candidate: DataFrame, champion: DataFrame, keys: Sequence[str], margin: float = 0.0, min_rows: int = 20, min_recall: float = 0.0, max_drop: float = 0.05) -> DataFrame:
    """Candidate rows against the champion's: promoted, and all reasons against it.

    Metric columns: row_count, validation_f1, min_recall, test_f1. Without a champion only the absolute rules hold.
    """
    c = champion.select(*keys, F.col("validation_f1").alias("_v"), F.col("test_f1").alias("_t"))
    j = candidate.join(c, list(keys), "left")
    tests = [
        (F.col("validation_f1").isNull(), "validation f1 missing"),
        (F.col("row_count") < min_rows, "too few rows"),
        (F.col("min_recall") < min_recall, "a class has too low a recall"),
        (F.col("validation_f1") < F.col("_v") + margin, "not better than the champion"),
        (F.col("test_f1") < F.col("_t") - max_drop, "worse on the test split"),
    ]
    reasons = F.concat_ws("; ", *[F.when(w, F.lit(t)) for w, t in tests])
    return j.select(*keys, (reasons == "").alias("promoted"), reasons.alias("reasons"))


def parity(left: DataFrame, right: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Two implementations of the same features: matched rows, largest difference and EXACT (1e-9), CLOSE (1e-6), MISMATCH."""
    sides = [df.select(*keys, F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v")) for f in features])).alias("x")).select(*keys, "x.feature", F.col("x.v").alias(n)) for df, n in ((left, "a"), (right, "b"))]
    j = sides[0].join(sides[1], [*keys, "feature"])
    gap = F.abs(F.col("a") - F.col("b"))
    g = j.groupBy("feature").agg(F.count(F.lit(1)).alias("matched"), F.max(gap).alias("max_abs_diff"), F.count_if(F.col("a").isNull() != F.col("b").isNull()).alias("null_mismatches"))
    worst = F.coalesce(F.col("max_abs_diff"), F.lit(0.0))
    return g.withColumn("verdict", F.when((worst <= 1e-9) & (F.col("null_mismatches") == 0), "EXACT").when((worst <= 1e-6) & (F.col("null_mismatches") == 0), "CLOSE").otherwise("MISMATCH"))


def target_correlation(df: DataFrame, target: str, features: Sequence[str]) -> DataFrame:
    """Correlation with the target (null where either doesn't vary) and missing rate of each feature: one pass."""

    def corr(name: str) -> Column:
        x, y = F.when(F.col(target).isNotNull(), F.col(name)), F.when(F.col(name).isNotNull(), F.col(target))
        return safe_div(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))

    row = df.agg(*[corr(f).alias(f"c{i}") for i, f in enumerate(features)], *[F.avg(F.col(f).isNull().cast("double")).alias(f"m{i}") for i, f in enumerate(features)])
    return row.select(F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"c{i}").alias("correlation"), F.col(f"m{i}").alias("missing_rate")) for i, f in enumerate(features)])))


def leaderboard(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Candidates ranked by the metrics in turn, nulls last; candidates are few."""
    return df.withColumn("rank", F.row_number().over(Window.orderBy(*[F.col(m).desc_nulls_last() for m in metrics], "candidate")))


def split_ranges(df: DataFrame, split: str, ts: str) -> DataFrame:
    """First and last time of each split, and whether it starts after the one before has ended (no leakage)."""
    r = df.groupBy(split).agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("row_count"))
    before = F.max("last_ts").over(Window.orderBy("first_ts", split).rowsBetween(Window.unboundedPreceding, -1))
    return r.withColumn("starts_after_previous", F.coalesce(F.col("first_ts") > before, F.lit(True)))
