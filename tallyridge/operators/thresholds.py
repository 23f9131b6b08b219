"""Decision thresholds, vote weights and acceptance gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyridge.columns import PREDICTIONS, PredictionColumns
from tallyridge.operators.metrics import rates, score_curve

GRID = tuple((20 + j) / 100 for j in range(51))
AUDIT_CUTOFFS = (0.5, 0.1, 0.05, 0.025, 0.01, 0.005, 0.0)


def just_above(x: Column) -> Column:
    """The next larger double of a non-negative score."""
    return F.when(x > 0, x + x * (1.5 * 2.0**-53)).otherwise(F.lit(5e-324))


def recall_target(preds: DataFrame, by, target: float = 0.9, cols: PredictionColumns = PREDICTIONS) -> DataFrame:
    """Highest specificity with enough recall; ties: higher recall, then higher threshold."""
    curve = score_curve(preds, by, cols).where(F.col("tpr") >= target)
    best = F.min(F.struct("fpr", (-F.col("tpr")).alias("r"), (-F.col("score")).alias("t"))).alias("b")
    return curve.groupBy(*by).agg(best).select(*by, (-F.col("b.t")).alias("threshold"), (-F.col("b.r")).alias("recall"), F.col("b.fpr").alias("fpr"))


def fpr_budget(preds: DataFrame, by, budget: float = 0.14, cols: PredictionColumns = PREDICTIONS) -> DataFrame:
    """Highest recall within the false-positive budget; ties: lower rate, then higher threshold.

    When no score fits the budget the threshold lies just above the largest score.
    """
    fits = F.col("fpr") <= budget
    best = F.max(F.when(fits, F.struct("tpr", (-F.col("fpr")).alias("f"), F.col("score").alias("t")))).alias("b")
    out = score_curve(preds, by, cols).groupBy(*by).agg(best, F.max("score").alias("top"))
    return out.select(*by, F.coalesce(F.col("b.t"), just_above(F.col("top"))).alias("threshold"),
                      F.coalesce(F.col("b.tpr"), F.lit(0.0)).alias("recall"), F.coalesce(-F.col("b.f"), F.lit(0.0)).alias("fpr"))


def grid_metrics(preds: DataFrame, by, grid=GRID, cols: PredictionColumns = PREDICTIONS) -> DataFrame:
    """Metrics at every grid threshold.

    Rows are reduced to (group, number of thresholds reached) first; only those few
    counts meet the grid.
    """
    marks = F.array(*[F.lit(float(t)) for t in grid])
    per_score = preds.groupBy(*by, F.col(cols.score).alias("score")).agg(
        F.count_if(F.col(cols.truth) == 1).alias("pos"), F.count_if(F.col(cols.truth) == 0).alias("neg"))
    reached = F.size(F.filter(marks, lambda t: t <= F.col("score")))
    few = per_score.groupBy(*by, reached.alias("k")).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    spread = few.select(*by, "k", "pos", "neg", F.posexplode(marks).alias("j", "threshold"))
    hit = F.col("k") > F.col("j")
    zero = F.lit(0)
    cells = spread.groupBy(*by, "threshold").agg(
        F.sum(F.when(hit, F.col("pos")).otherwise(zero)).alias("tp"), F.sum(F.when(hit, F.col("neg")).otherwise(zero)).alias("fp"),
        F.sum(F.when(~hit, F.col("pos")).otherwise(zero)).alias("fn"), F.sum(F.when(~hit, F.col("neg")).otherwise(zero)).alias("tn"))
    return cells.withColumns(rates(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp")))


def _best_f1(metrics: DataFrame, by) -> DataFrame:
    key = F.struct(F.col("macro_f1"), (-F.round(F.abs(F.col("threshold") - 0.5), 9)).alias("near"), F.col("threshold"))
    return metrics.groupBy(*by).agg(F.max(key).alias("b")).select(*by, F.col("b.threshold").alias("threshold"), F.col("b.macro_f1").alias("macro_f1"))


def macro_f1_grid(preds: DataFrame, by, grid=GRID, cols: PredictionColumns = PREDICTIONS) -> DataFrame:
    """Best macro F1 on the grid; ties: nearest one half, then the larger threshold."""
    return _best_f1(grid_metrics(preds, by, grid, cols), by)


def vote_weights(preds: DataFrame, by, models, options, grid=GRID, cols: PredictionColumns = PREDICTIONS) -> DataFrame:
    """Weights and threshold with the best macro F1; equal scores keep the earlier option."""
    wide = preds.groupBy(*by, cols.row).agg(
        F.max(cols.truth).alias(cols.truth),
        *[F.max(F.when(F.col(cols.model) == m, F.col(cols.score))).alias(m) for m in models])
    variants = []
    for i, w in enumerate(options):
        mix = sum((F.col(m) * x for m, x in zip(models, w)), F.lit(0.0))
        variants.append(F.struct(F.lit(i).alias("option"), F.round(mix, 9).alias(cols.score)))
    long = wide.select(*by, cols.truth, F.explode(F.array(*variants)).alias("v")).select(*by, cols.truth, "v.*")
    best = _best_f1(grid_metrics(long, [*by, "option"], grid, cols), [*by, "option"])
    pick = F.max(F.struct("macro_f1", (-F.col("option")).alias("o"), "threshold")).alias("b")
    return best.groupBy(*by).agg(pick).select(*by, (-F.col("b.o")).alias("option"), F.col("b.threshold").alias("threshold"), F.col("b.macro_f1").alias("macro_f1"))


def threshold_audit(preds: DataFrame, by, cutoffs=AUDIT_CUTOFFS, cols: PredictionColumns = PREDICTIONS) -> DataFrame:
    """Safe calls, missed positives and rejected negatives at fixed cutoffs, in one pass."""
    s, t = F.col(cols.score), F.col(cols.truth)
    aggs = []
    for i, c in enumerate(cutoffs):
        aggs += [F.count_if(s <= c).alias(f"c{i}"), F.count_if((s <= c) & (t == 1)).alias(f"m{i}"), F.count_if((s > c) & (t == 0)).alias(f"r{i}")]
    one = preds.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *aggs)
    rows = F.array(*[F.struct(F.lit(float(c)).alias("cutoff"), F.col(f"c{i}").alias("safe_calls"), F.col(f"m{i}").alias("missed"), F.col(f"r{i}").alias("rejected"))
                     for i, c in enumerate(cutoffs)])
    return one.select(*by, "rows", F.inline(rows))


def _of(summary: DataFrame, model: str, field: str) -> Column:
    return F.max(F.when(F.col("model") == model, F.col(field)))


def acceptance_gate(summary: DataFrame, deltas: DataFrame, candidate: str, reference: str, gain: float = 0.005, wins: int = 3) -> DataFrame:
    """Enough gain, recall not lower, enough folds won."""
    won = deltas.where(F.col("model") == candidate).select("folds_won").scalar()
    f1 = [_of(summary, m, "macro_f1_mean") for m in (candidate, reference)]
    recall = [_of(summary, m, "recall_p_mean") for m in (candidate, reference)]
    one = summary.agg((f1[0] >= f1[1] + gain).alias("gain_ok"), (recall[0] >= recall[1]).alias("recall_ok"),
                      (f1[0] - f1[1]).alias("macro_f1_gain"), (recall[0] - recall[1]).alias("recall_gain"))
    return one.withColumn("wins_ok", won >= wins).withColumn("accepted", F.col("gain_ok") & F.col("recall_ok") & F.col("wins_ok"))


def dominance_gate(summary: DataFrame, candidates, baseline: str) -> DataFrame:
    """Best candidate that beats the baseline on F1 and misses without more false alarms, else the best one."""
    base = {f: summary.where(F.col("model") == baseline).select(f).scalar() for f in ("macro_f1_mean", "fn_total", "fp_total")}
    rows = summary.where(F.col("model").isin(*candidates))
    ok = (F.col("macro_f1_mean") > base["macro_f1_mean"]) & (F.col("fn_total") < base["fn_total"]) & (F.col("fp_total") <= base["fp_total"])
    order = F.struct(ok.cast("int").alias("ok"), F.col("macro_f1_mean"), F.col("model"))
    return rows.agg(F.max(order).alias("b")).select(F.col("b.model").alias("selected"), (F.col("b.ok") == 1).alias("goal_met"))


def minimum_gate(summary: DataFrame, minimums: dict[str, float], tolerance: float = 1e-9) -> DataFrame:
    """One boolean per configured minimum and whether all hold."""
    out = summary.select("model", *[(F.col(k) + tolerance >= v).alias(f"{k}_ok") for k, v in minimums.items()])
    every = F.lit(True)
    for k in minimums:
        every = every & F.col(f"{k}_ok")
    return out.withColumn("passes", every)
