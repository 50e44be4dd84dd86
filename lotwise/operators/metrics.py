"""Model metrics, release gate, fairness and drift, each as one small result frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from .quantiles import exact_quantiles

SCORE_BUCKETS = 16_384
PSI_FLOOR = 1e-6
NAN = float("nan")


def gate(model_mae: Column, baseline_mae: Column,
         min_improvement: float = config.GATE_MIN_IMPROVEMENT) -> Column:
    improved = (baseline_mae - model_mae) / baseline_mae >= min_improvement
    return F.when(baseline_mae > 0, improved).otherwise(False)


def regression_metrics(df: DataFrame, truth: str, predicted: str,
                       baseline: str | None = None) -> DataFrame:
    """One row: mae, mape, rmsle, r2 and, given a baseline column, its MAE and the gate."""
    y, p = F.col(truth), F.col(predicted)
    error = F.avg((y - p) * (y - p))
    spread = F.var_pop(y)
    aggs = [
        F.avg(F.abs(y - p)).alias("mae"),
        F.coalesce(F.avg(F.when(y > 0, F.abs((y - p) / F.when(y > 0, y)))), F.lit(NAN)).alias("mape"),
        F.sqrt(F.avg(F.pow(F.log1p(F.greatest(p, F.lit(0.0))) - F.log1p(y), 2))).alias("rmsle"),
        F.when(spread > 0, 1 - error / spread)
        .when(error == 0, 1.0).otherwise(0.0).alias("r2"),
    ]
    if baseline:
        aggs.append(F.avg(F.abs(y - F.col(baseline))).alias("mmr_baseline_mae"))
    out = df.agg(*aggs)
    if baseline:
        out = out.withColumn("beats_mmr_baseline",
                             gate(F.col("mae"), F.col("mmr_baseline_mae")))
    return out


def state_mae(df: DataFrame, truth: str, predicted: str, state: str = "state",
              min_rows: int = config.MIN_STATE_ROWS) -> DataFrame:
    """MAE per state with enough rows, worst first: state, mae, n."""
    return (df.where(F.col(state).isNotNull()).groupBy(F.col(state).alias("state"))
            .agg(F.avg(F.abs(F.col(truth) - F.col(predicted))).alias("mae"),
                 F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= min_rows)
            .orderBy(F.desc("mae"), "state"))


def state_gap(errors: DataFrame, min_states: int = 2) -> DataFrame:
    """Best and worst state and their gap; NULLs when there are too few states."""
    order = F.struct("mae", "state")
    row = errors.agg(
        F.min_by("state", order).alias("best_state"), F.min("mae").alias("best_mae"),
        F.max_by("state", order).alias("worst_state"), F.max("mae").alias("worst_mae"),
        F.count(F.lit(1)).alias("_n"))
    row = row.withColumns({
        "gap": F.col("worst_mae") - F.col("best_mae"),
        "gap_ratio": F.when(F.col("best_mae") > 0,
                            F.col("worst_mae") / F.when(F.col("best_mae") > 0, F.col("best_mae")))
        .when(F.col("best_mae").isNotNull(), float("inf")),
    })
    enough = F.col("_n") >= min_states
    return row.select(*[F.when(enough, F.col(c)).alias(c) for c in row.columns if c != "_n"])


def class_scores(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Per label seen in truth or prediction: label, tp, fp, fn, f1."""
    pairs = df.groupBy(F.col(truth).alias("y"), F.col(predicted).alias("p")).agg(
        F.count(F.lit(1)).alias("n"))
    sides = F.explode(F.when(
        F.col("y") == F.col("p"),
        F.array(F.struct(F.col("y").alias("label"), F.lit("tp").alias("kind"))),
    ).otherwise(F.array(
        F.struct(F.col("y").alias("label"), F.lit("fn").alias("kind")),
        F.struct(F.col("p").alias("label"), F.lit("fp").alias("kind")))))
    long = pairs.select("n", sides.alias("s")).select("n", "s.label", "s.kind")

    def total(kind: str) -> Column:
        return F.sum(F.when(F.col("kind") == kind, F.col("n")).otherwise(0)).alias(kind)

    counts = long.groupBy("label").agg(total("tp"), total("fp"), total("fn"))
    return counts.withColumn("f1", _f1(F.col("tp"), F.col("fp"), F.col("fn")))


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    below = 2 * tp + fp + fn
    return F.when(below > 0, 2 * tp / F.when(below > 0, below)).otherwise(0.0)


def classification_metrics(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """One row: accuracy and macro_f1."""
    scores = class_scores(df, truth, predicted)
    return scores.agg((F.sum("tp") / (F.sum("tp") + F.sum("fn"))).alias("accuracy"),
                      F.avg("f1").alias("macro_f1"))


def score_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """Running counts by descending score: score, tp, fp, ctp, cfp, np, nn.

    Rows are first counted per distinct score, then per score bucket. Only the bucket
    totals (a fixed number of rows) meet in one task; exact running counts are taken
    inside each bucket in parallel. A NULL score, or one outside [0, 1], is an error.
    """
    inside = F.coalesce(F.col(score).between(0, 1), F.lit(False))
    checked = F.when(inside, F.col(score)).otherwise(F.raise_error(F.lit("score is NULL or outside [0, 1]")).cast("double"))
    cells = df.groupBy(checked.alias("score")).agg(
        F.sum(F.col(label).cast("long")).alias("tp"),
        F.sum(1 - F.col(label).cast("long")).alias("fp"))
    cells = cells.withColumn("_b", F.floor(F.col("score") * SCORE_BUCKETS))
    everything = Window.partitionBy(F.lit(0))
    higher = everything.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    buckets = (cells.groupBy("_b").agg(F.sum("tp").alias("_tp"), F.sum("fp").alias("_fp"))
               .select("_b",
                       F.coalesce(F.sum("_tp").over(higher), F.lit(0)).alias("_tp_before"),
                       F.coalesce(F.sum("_fp").over(higher), F.lit(0)).alias("_fp_before"),
                       F.sum("_tp").over(everything).alias("np"),
                       F.sum("_fp").over(everything).alias("nn")))
    inside = (Window.partitionBy("_b").orderBy(F.desc("score"))
              .rowsBetween(Window.unboundedPreceding, 0))
    # buckets has at most SCORE_BUCKETS + 1 rows for scores in [0, 1].
    return cells.join(F.broadcast(buckets), "_b").select(
        "score", "tp", "fp",
        (F.col("_tp_before") + F.sum("tp").over(inside)).alias("ctp"),
        (F.col("_fp_before") + F.sum("fp").over(inside)).alias("cfp"), "np", "nn")


def choose_threshold(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row: the score with the largest F1 (lowest on ties); 0.5 with one class only."""
    precision = F.col("ctp") / (F.col("ctp") + F.col("cfp"))
    recall = F.col("ctp") / F.when(F.col("np") > 0, F.col("np"))
    f1 = 2 * precision * recall / (precision + recall + 1e-12)
    best = score_curve(df, label, score).withColumn("_f1", f1).agg(
        F.max_by("score", F.struct(F.col("_f1"), -F.col("score"))).alias("_best"),
        F.max("_f1").alias("_f1"), F.max("np").alias("_np"), F.max("nn").alias("_nn"))
    both = (F.col("_np") > 0) & (F.col("_nn") > 0)
    return best.select(F.when(both, F.col("_best")).otherwise(0.5).alias("threshold"),
                       F.when(both, F.col("_f1")).alias("best_f1"))


def trivial_f1(positive_rate: Column) -> Column:
    """F1 of always predicting positive."""
    return F.when(positive_rate > 0, 2 * positive_rate / (positive_rate + 1)).otherwise(0.0)


def binary_metrics(df: DataFrame, label: str, score: str,
                   threshold: float | Column = 0.5) -> DataFrame:
    """One row of threshold, curve and reference metrics of a binary score."""
    curve = score_curve(df, label, score)
    cut = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    tp, fp, s = F.col("tp"), F.col("fp"), F.col("score")
    pos = F.when(F.col("np") > 0, F.col("np"))
    neg = F.when(F.col("nn") > 0, F.col("nn"))

    def above(c: Column, limit: Column | float) -> Column:
        return F.sum(F.when(s >= limit, c).otherwise(0))

    totals = curve.withColumn("threshold", cut).agg(
        F.max("threshold").alias("threshold"),
        above(tp, F.col("threshold")).alias("_tp"), above(fp, F.col("threshold")).alias("_fp"),
        above(tp, 0.5).alias("_tp5"), above(fp, 0.5).alias("_fp5"),
        F.sum((fp * (F.col("ctp") - tp) + 0.5 * tp * fp) / (pos * neg)).alias("_auc"),
        F.sum((tp / pos) * (F.col("ctp") / (F.col("ctp") + F.col("cfp")))).alias("_ap"),
        F.sum(tp * (1 - s) * (1 - s) + fp * s * s).alias("_sq"),
        F.max("np").alias("_np"), F.max("nn").alias("_nn"))
    n = F.col("_np") + F.col("_nn")
    both = (F.col("_np") > 0) & (F.col("_nn") > 0)
    rate = F.col("_np") / n
    return totals.select(
        "threshold",
        ((F.col("_tp") + F.col("_nn") - F.col("_fp")) / n).alias("accuracy"),
        _f1(F.col("_tp"), F.col("_fp"), F.col("_np") - F.col("_tp")).alias("f1"),
        _f1(F.col("_tp5"), F.col("_fp5"), F.col("_np") - F.col("_tp5")).alias("f1_at_0_5"),
        trivial_f1(rate).alias("trivial_f1_baseline"),
        F.when(both, F.col("_auc")).otherwise(NAN).alias("roc_auc"),
        F.when(both, F.col("_ap")).otherwise(NAN).alias("auc_pr"),
        F.when(both, F.col("_sq") / n).otherwise(NAN).alias("brier"),
        rate.alias("positive_rate"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight per class: label, n, weight = rows / (classes * n)."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    classes = Window.partitionBy(F.lit(0))  # one row per class
    return counts.withColumn(
        "weight", F.sum("n").over(classes) / (F.count(F.lit(1)).over(classes) * F.col("n")))


def population_stability(expected: DataFrame, actual: DataFrame, column: str,
                         bins: int = 10) -> DataFrame:
    """One row: psi between two samples of ``column``, bins from the expected one.

    NULLs are dropped and reported as expected_nulls / actual_nulls; values outside the
    expected range count only in the denominator.
    """
    c = F.col(column).cast("double")
    value = F.when(~F.isnan(c), c)
    reference = expected.select(value.alias("x"))
    probs = [i / bins for i in range(bins + 1)]
    spread = exact_quantiles(reference, [], "x", probs)
    edges = spread.select(F.array_sort(F.array_distinct(F.array(
        *[F.col(f"q{i}") for i in range(bins + 1)]))).alias("edges")).scalar()

    both = (reference.withColumn("side", F.lit("e"))
            .unionByName(actual.select(value.alias("x")).withColumn("side", F.lit("a"))))
    tagged = both.withColumn("_edges", edges)
    last = F.element_at("_edges", -1)
    reached = F.size(F.filter("_edges", lambda e: e <= F.col("x")))
    bucket = F.when(F.col("x") == last, F.size("_edges") - 1).when(F.col("x") < last, reached)
    counts = tagged.select("side", F.col("x").isNull().alias("missing"),
                           F.size("_edges").alias("edges"), bucket.alias("bucket"))
    counts = counts.groupBy("side", "missing", "edges", "bucket").agg(
        F.count(F.lit(1)).alias("n"))

    def per(side: str, missing: bool) -> Column:
        hit = (F.col("side") == side) & (F.col("missing") == missing)
        return F.sum(F.when(hit, F.col("n")).otherwise(0))

    everything = Window.partitionBy(F.lit(0))  # at most one row per bin and side
    totals = (counts.groupBy("bucket", "edges")
              .agg(per("e", False).alias("e"), per("a", False).alias("a"),
                   per("e", True).alias("e_null"), per("a", True).alias("a_null"))
              .withColumns({k: F.sum(k[4:]).over(everything) for k in ("all_e", "all_a")}))
    e = F.greatest(F.col("e") / F.greatest("all_e", F.lit(1)), F.lit(PSI_FLOOR))
    a = F.greatest(F.col("a") / F.greatest("all_a", F.lit(1)), F.lit(PSI_FLOOR))
    term = F.when((F.col("edges") >= 3) & (F.col("bucket") >= 1), (a - e) * F.log(a / e))
    return totals.agg(F.coalesce(F.sum(term), F.lit(0.0)).alias("psi"),
                      F.sum("e_null").alias("expected_nulls"),
                      F.sum("a_null").alias("actual_nulls"))
