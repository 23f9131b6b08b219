"""Classification metrics, curves and comparison tables over long-form predictions.

Rows are first counted per (group, score); curves are running totals over those counts
in score buckets, so the number of distinct scores does not matter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyridge.columns import PREDICTIONS, PredictionColumns
from tallyridge.functions.numeric import order_bin, ratio, ratio0
from tallyridge.operators.prefix import running_totals

CELLS = ("tn", "fp", "fn", "tp")
RATES = ("accuracy", "balanced_accuracy", "macro_f1", "precision_p", "recall_p", "f1_p", "specificity_e")


def cells(truth: Column, label: Column) -> dict[str, Column]:
    t, p = truth == 1, label == 1
    return {"tn": F.count_if(~t & ~p), "fp": F.count_if(~t & p), "fn": F.count_if(t & ~p), "tp": F.count_if(t & p)}


def confusion(preds: DataFrame, by, cols: PredictionColumns = PREDICTIONS) -> DataFrame:
    return preds.groupBy(*by).agg(*[e.alias(k) for k, e in cells(F.col(cols.truth), F.col(cols.label)).items()])


def rates(tn: Column, fp: Column, fn: Column, tp: Column) -> dict[str, Column]:
    """Class metrics from the four cells; an empty denominator counts as 0."""
    recall, spec = ratio0(tp, tp + fn), ratio0(tn, tn + fp)
    f1, f1_other = ratio0(2 * tp, 2 * tp + fp + fn), ratio0(2 * tn, 2 * tn + fp + fn)
    return {
        "accuracy": ratio0(tp + tn, tp + tn + fp + fn), "balanced_accuracy": (recall + spec) / 2,
        "macro_f1": (f1 + f1_other) / 2, "precision_p": ratio0(tp, tp + fp), "recall_p": recall, "f1_p": f1, "specificity_e": spec,
    }


def with_rates(df: DataFrame) -> DataFrame:
    return df.withColumns(rates(*[F.col(c) for c in CELLS]))


def classification_metrics(preds: DataFrame, by, cols: PredictionColumns = PREDICTIONS) -> DataFrame:
    return with_rates(confusion(preds, by, cols))


def score_curve(preds: DataFrame, by, cols: PredictionColumns = PREDICTIONS) -> DataFrame:
    """One point per distinct score, from high to low: cumulative hits and rates."""
    per_score = preds.groupBy(*by, F.col(cols.score).alias("score")).agg(
        F.count_if(F.col(cols.truth) == 1).alias("pos"), F.count_if(F.col(cols.truth) == 0).alias("neg"))
    run = running_totals(per_score, by, "score", ["pos", "neg"], order_bin(F.col("score")), descending=True)
    tp, fp = F.col("pos_cum"), F.col("neg_cum")
    return run.select(
        *by, "score", "pos", "neg", tp.alias("tp"), fp.alias("fp"), F.col("pos_all"), F.col("neg_all"),
        ratio(tp, F.col("pos_all")).alias("tpr"), ratio(fp, F.col("neg_all")).alias("fpr"), ratio(tp, tp + fp).alias("precision"))


def roc_auc(curve: DataFrame, by) -> DataFrame:
    """Rank AUC: every positive above a negative counts one, a tie counts one half."""
    below = F.col("neg_all") - F.col("fp")
    won = F.sum(F.col("pos") * (below + F.col("neg") / 2.0))
    return curve.groupBy(*by).agg(ratio(won, F.max(F.col("pos_all").cast("double") * F.col("neg_all"))).alias("roc_auc"))


def average_precision(curve: DataFrame, by) -> DataFrame:
    gain = F.sum(F.col("precision") * F.col("pos"))
    return curve.groupBy(*by).agg(ratio(gain, F.max("pos_all")).alias("average_precision"))


def ranking_metrics(preds: DataFrame, by, cols: PredictionColumns = PREDICTIONS) -> DataFrame:
    """Cells, rates, AUC and average precision per group."""
    curve = score_curve(preds, by, cols)
    below = F.col("neg_all") - F.col("fp")
    areas = curve.groupBy(*by).agg(
        ratio(F.sum(F.col("pos") * (below + F.col("neg") / 2.0)), F.max(F.col("pos_all").cast("double") * F.col("neg_all"))).alias("roc_auc"),
        ratio(F.sum(F.col("precision") * F.col("pos")), F.max("pos_all")).alias("average_precision"))
    return classification_metrics(preds, by, cols).join(areas, list(by))


def model_summary(fold_metrics: DataFrame, metrics=RATES, model: str = "model") -> DataFrame:
    """Mean and sample deviation over folds, and the summed cells."""
    return fold_metrics.groupBy(model).agg(
        F.count(F.lit(1)).alias("folds"),
        *[F.avg(m).alias(f"{m}_mean") for m in metrics], *[F.stddev_samp(m).alias(f"{m}_sd") for m in metrics],
        *[F.sum(c).alias(f"{c}_total") for c in CELLS])


def fold_pivot(fold_metrics: DataFrame, metric: str, models, model: str = "model", fold: str = "fold") -> DataFrame:
    return fold_metrics.groupBy(fold).agg(*[F.max(F.when(F.col(model) == m, F.col(metric))).alias(m) for m in models])


def overfit_gap(scores: DataFrame, model: str = "model") -> DataFrame:
    mean = scores.groupBy(model).agg(*[F.avg(c).alias(c) for c in ("train_score", "validation_score", "fit_seconds")])
    return mean.withColumn("gap", F.col("train_score") - F.col("validation_score"))


def tuning_summary(fold_metrics: DataFrame, metric: str, config: str = "model") -> DataFrame:
    """Mean and population deviation over the splits, and the rank of the mean."""
    out = fold_metrics.groupBy(config).agg(F.avg(metric).alias("mean_score"), F.stddev_pop(metric).alias("sd_score"))
    return out.withColumn("rank", F.rank().over(Window.partitionBy(F.lit(1)).orderBy(F.desc(F.round("mean_score", 12)))))


def rank_models(summary: DataFrame, order, model: str = "model", declared=()) -> DataFrame:
    """Rank by metrics (descending), then by the declared order of the models."""
    place = F.array_position(F.array(*[F.lit(d) for d in declared]), F.col(model)) if declared else F.col(model)
    keys = [F.desc(F.round(o, 12)) for o in order]
    return summary.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*keys, place)))


def tied_best(summary: DataFrame, order) -> DataFrame:
    keys = [F.desc(F.round(o, 12)) for o in order]
    return summary.withColumn("__r", F.rank().over(Window.partitionBy(F.lit(1)).orderBy(*keys))).where("__r = 1").drop("__r")


def paired_delta(fold_metrics: DataFrame, metric: str, reference: str, model: str = "model", fold: str = "fold") -> DataFrame:
    """Per model: metric minus the reference model on the same folds, mean and folds won."""
    ref = fold_metrics.where(F.col(model) == reference).select(fold, F.col(metric).alias("__ref"))
    rows = fold_metrics.where(F.col(model) != reference).join(ref, fold).withColumn("d", F.col(metric) - F.col("__ref"))
    return rows.groupBy(model).agg(F.avg("d").alias("mean_delta"), F.count_if(F.col("d") > 0).alias("folds_won"), F.count(F.lit(1)).alias("folds"))


def group_errors(preds: DataFrame, group: str, cols: PredictionColumns = PREDICTIONS) -> DataFrame:
    out = confusion(preds, [cols.model, group], cols)
    return out.select(cols.model, group, (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("records"),
                      (F.col("tn") + F.col("tp")).alias("correct"), "fn", "fp")


def error_counts(preds: DataFrame, cols: PredictionColumns = PREDICTIONS) -> DataFrame:
    return preds.groupBy(cols.model, cols.truth, cols.label).agg(F.count(F.lit(1)).alias("n"))


def missing_bins(n: Column) -> Column:
    """Fixed bins for the number of empty fields in a row."""
    return F.when(n <= 2, "0-2").when(n <= 4, "3-4").otherwise("5+")


def errors_by_level(rows: DataFrame, level: Column, cols: PredictionColumns = PREDICTIONS) -> DataFrame:
    out = confusion(rows.withColumn("level", level), [cols.model, "level"], cols)
    return out.select(cols.model, "level", (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("rows"),
                      "fn", "fp", ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"))


def recall_by_level(rows: DataFrame, level: str, cols: PredictionColumns = PREDICTIONS) -> DataFrame:
    positives = rows.where(F.col(cols.truth) == 1)
    out = positives.groupBy(cols.model, level).agg(F.count(F.lit(1)).alias("positives"), F.count_if(F.col(cols.label) == 0).alias("fn"))
    return out.withColumn("recall", ratio(F.col("positives") - F.col("fn"), F.col("positives")))


def discordant(preds: DataFrame, selected: str, others, cols: PredictionColumns = PREDICTIONS) -> DataFrame:
    """Rows only the selected model gets right, and rows only the other one does, per other model."""
    right = {m: F.max(F.when(F.col(cols.model) == m, (F.col(cols.label) == F.col(cols.truth)).cast("int"))).alias(f"m{i}")
             for i, m in enumerate([selected, *others])}
    wide = preds.groupBy(cols.row).agg(*right.values())
    pairs = []
    for i, _ in enumerate(others, 1):
        pairs += [F.count_if((F.col("m0") == 1) & (F.col(f"m{i}") == 0)).alias(f"a{i}"), F.count_if((F.col("m0") == 0) & (F.col(f"m{i}") == 1)).alias(f"b{i}")]
    one = wide.agg(*pairs)
    rows = F.array(*[F.struct(F.lit(m).alias("other"), F.col(f"a{i}").alias("only_selected_correct"), F.col(f"b{i}").alias("only_other_correct"))
                     for i, m in enumerate(others, 1)])
    return one.select(F.lit(selected).alias("selected"), F.inline(rows))


def soft_vote(preds: DataFrame, weights: dict[str, float], cols: PredictionColumns = PREDICTIONS) -> DataFrame:
    """Weighted mean probability per row over the named models (weights sum to one)."""
    if abs(sum(weights.values()) - 1) > 1e-9:
        raise ValueError("vote weights must sum to one")
    wide = preds.where(F.col(cols.model).isin(*weights)).groupBy(cols.row).agg(
        F.max(cols.fold).alias(cols.fold), F.max(cols.truth).alias(cols.truth),
        *[F.max(F.when(F.col(cols.model) == m, F.col(cols.score))).alias(f"__{m}") for m in weights])
    mix = reduce(lambda a, b: a + b, [F.col(f"__{m}") * w for m, w in weights.items()])
    return wide.select(cols.row, cols.fold, cols.truth, mix.alias(cols.score))


def comparison_table(fold_metrics: DataFrame, test_metrics: DataFrame, metric: str, baseline: str, model: str = "model") -> DataFrame:
    """Cross-validation mean, test value and improvement over the baseline, per model."""
    cv = fold_metrics.groupBy(model).agg(F.avg(metric).alias("cv_mean"), F.stddev_samp(metric).alias("cv_sd"))
    joined = cv.join(test_metrics.select(model, F.col(metric).alias("test")), model)
    base = test_metrics.where(F.col(model) == baseline).select(metric).scalar()
    return joined.withColumn("improvement_percent", ratio((F.col("test") - base) * 100, base))
