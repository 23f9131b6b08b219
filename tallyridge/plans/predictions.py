"""Registered queries over the long prediction view: metrics, thresholds, comparisons, gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyridge.functions.numeric import ratio
from tallyridge.operators import joins as J
from tallyridge.operators import metrics as M
from tallyridge.operators import profile as Q
from tallyridge.operators import scoring as G
from tallyridge.operators import splits as P
from tallyridge.operators import stats as T
from tallyridge.operators import thresholds as H
from tallyridge.plans.catalog import query
from tallyridge.plans.items import INPUTS
from tallyridge.plans.views import MODELS

RATE_SQL = {
    "accuracy": "coalesce((tp + tn) / nullif(tp + tn + fp + fn, 0), 0)",
    "balanced_accuracy": "(coalesce(tp / nullif(tp + fn, 0), 0) + coalesce(tn / nullif(tn + fp, 0), 0)) / 2",
    "macro_f1": "(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) + coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0)) / 2",
    "precision_p": "coalesce(tp / nullif(tp + fp, 0), 0)", "recall_p": "coalesce(tp / nullif(tp + fn, 0), 0)",
    "f1_p": "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)", "specificity_e": "coalesce(tn / nullif(tn + fp, 0), 0)",
}


def cells_sql(by, source="preds", label="prediction"):
    keys = f"{by}, " if by else ""
    tail = f"GROUP BY {by}" if by else ""
    return (f"SELECT {keys}count_if(true_class = 0 AND {label} = 0)::BIGINT AS tn, count_if(true_class = 0 AND {label} = 1)::BIGINT AS fp, "
            f"count_if(true_class = 1 AND {label} = 0)::BIGINT AS fn, count_if(true_class = 1 AND {label} = 1)::BIGINT AS tp FROM {source} {tail}")


def rates_sql(by, source="preds", digits=None):
    cols = ", ".join(f"round({e}, 6) AS {k}" if digits else f"{e} AS {k}" for k, e in RATE_SQL.items())
    return f"SELECT *, {cols} FROM ({cells_sql(by, source)})"


FOLDS_SQL = f"fm AS ({rates_sql('model, fold')})"
SUMMARY_SQL = f"""{FOLDS_SQL},
summary AS (SELECT model, count(*) AS folds, {', '.join(f'avg({m}) AS {m}_mean, stddev_samp({m}) AS {m}_sd' for m in RATE_SQL)},
  {', '.join(f'sum({c})::BIGINT AS {c}_total' for c in M.CELLS)} FROM fm GROUP BY 1)"""


def fold_metrics(v):
    return M.classification_metrics(v.preds, ["model", "fold"])


def summary(v):
    return M.model_summary(fold_metrics(v))


# ---------------------------------------------------------------- metrics


@query("agg_classification_metrics", rates_sql("model", digits=6))
def _(v):
    return M.classification_metrics(v.preds, ["model"])


AUC_SQL = """
ranked AS (SELECT model, true_class, rank() OVER (PARTITION BY model ORDER BY probability_p) + (count(*) OVER (PARTITION BY model, probability_p) - 1) / 2.0 AS r FROM preds),
auc AS (SELECT model, (sum(r) FILTER (WHERE true_class = 1) - count_if(true_class = 1)::DOUBLE * (count_if(true_class = 1) + 1) / 2) / (count_if(true_class = 1)::DOUBLE * count_if(true_class = 0)) AS roc_auc FROM ranked GROUP BY 1)"""
CURVE_SQL = """
scores AS (SELECT model, probability_p AS score, count_if(true_class = 1) AS pos, count_if(true_class = 0) AS neg FROM preds GROUP BY ALL),
curve AS (SELECT model, score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, pos, sum(pos) OVER (PARTITION BY model) AS pall, sum(neg) OVER (PARTITION BY model) AS nall
  FROM scores WINDOW w AS (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""


@query("agg_roc_auc", f"WITH {AUC_SQL} SELECT model, round(roc_auc, 6) AS roc_auc FROM auc")
def _(v):
    return M.roc_auc(M.score_curve(v.preds, ["model"]), ["model"])


@query("agg_average_precision", f"WITH {CURVE_SQL} SELECT model, round(sum(pos * tp / (tp + fp)) / max(pall), 6) AS average_precision FROM curve GROUP BY 1")
def _(v):
    return M.average_precision(M.score_curve(v.preds, ["model"]), ["model"])


@query("agg_roc_pr_curve", f"""
WITH {CURVE_SQL} SELECT model, score, round(tp / pall, 6) AS tpr, round(fp / nall, 6) AS fpr, round(tp / (tp + fp), 6) AS precision FROM curve""")
def _(v):
    return M.score_curve(v.preds, ["model"]).select("model", "score", "tpr", "fpr", "precision")


@query("win_cumulative_counts", f"WITH {CURVE_SQL} SELECT model, score, tp::BIGINT AS tp, fp::BIGINT AS fp FROM curve")
def _(v):
    return M.score_curve(v.preds, ["model"]).select("model", "score", "tp", "fp")


@query("agg_model_summary", f"""
WITH {SUMMARY_SQL} SELECT model, folds, {', '.join(f'round({m}_mean, 6) AS {m}_mean, round({m}_sd, 6) AS {m}_sd' for m in RATE_SQL)}, {', '.join(f'{c}_total' for c in M.CELLS)} FROM summary""")
def _(v):
    return summary(v)


@query("agg_fold_pivot", f"WITH {FOLDS_SQL} SELECT fold, {', '.join(f'''round(max(macro_f1) FILTER (WHERE model = '{m}'), 6) AS {m}''' for m in MODELS)} FROM fm GROUP BY 1")
def _(v):
    return M.fold_pivot(fold_metrics(v), "macro_f1", MODELS)


@query("agg_overfit_gap", f"""
WITH {FOLDS_SQL}, s AS (SELECT model, fold, accuracy AS va, (sum(accuracy) OVER (PARTITION BY model) - accuracy) / (count(*) OVER (PARTITION BY model) - 1) AS ta, (tn + fp + fn + tp) / 1000.0 AS sec FROM fm)
SELECT model, round(avg(ta), 6) AS train_score, round(avg(va), 6) AS validation_score, round(avg(sec), 6) AS fit_seconds, round(avg(ta) - avg(va), 6) + 0 AS gap FROM s GROUP BY 1""")
def _(v):
    fm = fold_metrics(v)
    all_folds = fm.groupBy("model").agg(F.sum("accuracy").alias("s"), F.count(F.lit(1)).alias("k"))
    scores = fm.join(all_folds, "model").select(
        "model", "fold", F.col("accuracy").alias("validation_score"), ((F.col("s") - F.col("accuracy")) / (F.col("k") - 1)).alias("train_score"),
        ((F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")) / 1000.0).alias("fit_seconds"))
    return M.overfit_gap(scores)


@query("agg_tuning_summary", f"""
WITH {FOLDS_SQL} SELECT model, round(avg(macro_f1), 6) AS mean_score, round(stddev_pop(macro_f1), 6) AS sd_score, rank() OVER (ORDER BY round(avg(macro_f1), 12) DESC)::INT AS rank FROM fm GROUP BY 1""")
def _(v):
    return M.tuning_summary(fold_metrics(v), "macro_f1")


@query("agg_group_errors", """
SELECT model, grp, count(*) AS records, count_if(true_class = prediction)::BIGINT AS correct, count_if(true_class = 1 AND prediction = 0)::BIGINT AS fn, count_if(true_class = 0 AND prediction = 1)::BIGINT AS fp FROM preds GROUP BY 1, 2""")
def _(v):
    return M.group_errors(v.preds, "grp")


@query("agg_error_counts", "SELECT model, true_class, prediction, count(*) AS n FROM preds GROUP BY ALL")
def _(v):
    return M.error_counts(v.preds)




MISSING_SQL = f"joined AS (SELECT p.*, {' + '.join(f'(i.{c} IS NULL)::INT' for c in INPUTS)} AS missing FROM preds p JOIN items i ON i.row_id = p.source_row)"


def with_missing(v):
    counts = v.items.select(F.col("row_id").alias("source_row"), Q.missing_count(INPUTS).alias("missing"))
    return v.preds.join(counts, "source_row")


@query("agg_error_by_missing", f"""
WITH {MISSING_SQL}, l AS (SELECT *, CASE WHEN missing <= 2 THEN '0-2' WHEN missing <= 4 THEN '3-4' ELSE '5+' END AS level FROM joined)
SELECT model, level, tn + fp + fn + tp AS rows, fn, fp, round(tp / nullif(tp + fn, 0), 6) AS recall FROM ({cells_sql('model, level', 'l')})""")
def _(v):
    return M.errors_by_level(with_missing(v), M.missing_bins(F.col("missing")))


@query("agg_missing_level_recall", f"""
WITH {MISSING_SQL} SELECT model, missing, count(*) AS positives, count_if(prediction = 0)::BIGINT AS fn, round(count_if(prediction = 1) / count(*), 6) AS recall FROM joined WHERE true_class = 1 GROUP BY 1, 2""")
def _(v):
    return M.recall_by_level(with_missing(v), "missing")


@query("agg_threshold_audit", f"""
SELECT model, split, rows, cutoff::DOUBLE AS cutoff, safe_calls, missed, rejected FROM (
 SELECT model, CASE WHEN fold = 5 THEN 'test' ELSE 'train' END AS split, cutoff, count(*) AS rows, count_if(probability_p <= cutoff)::BIGINT AS safe_calls,
  count_if(probability_p <= cutoff AND true_class = 1)::BIGINT AS missed, count_if(probability_p > cutoff AND true_class = 0)::BIGINT AS rejected
 FROM preds CROSS JOIN (VALUES {', '.join(f'({c}::DOUBLE)' for c in H.AUDIT_CUTOFFS)}) AS t(cutoff) GROUP BY ALL)""")
def _(v):
    rows = v.preds.withColumn("split", F.when(F.col("fold") == 5, "test").otherwise("train"))
    return H.threshold_audit(rows, ["model", "split"])


# ---------------------------------------------------------------- joins


@query("join_one_to_one", """
SELECT a.source_row, a.probability_p AS rf_score, b.probability_p AS gb_score FROM preds a JOIN preds b ON a.source_row = b.source_row AND a.model = 'rf' AND b.model = 'gb'""")
def _(v):
    side = lambda m: v.preds.where(F.col("model") == m).select("source_row", F.col("probability_p").alias(f"{m}_score"))
    return J.one_to_one(side("rf"), side("gb"), "source_row")


@query("join_lookup_dimension", """
WITH g AS (SELECT model, grp, count(*) AS records, count_if(true_class = 1 AND prediction = 0)::BIGINT AS fn FROM preds GROUP BY 1, 2)
SELECT model, grp, name, records, fn FROM g LEFT JOIN (SELECT DISTINCT o_orderpriority AS grp, substr(o_orderpriority, 3) AS name FROM orders WHERE o_orderpriority <> '3-MEDIUM') d USING (grp)""")
def _(v):
    names = v.table("orders").where("o_orderpriority <> '3-MEDIUM'").select(
        F.col("o_orderpriority").alias("grp"), F.expr("substr(o_orderpriority, 3)").alias("name")).distinct()
    return J.lookup_dimension(M.group_errors(v.preds, "grp").select("model", "grp", "records", "fn"), names, "grp").select("model", "grp", "name", "records", "fn")


@query("join_prediction_alignment", """
SELECT a.prediction = a.true_class AS first_correct, b.prediction = b.true_class AS second_correct, count(*) AS n
FROM preds a JOIN preds b ON a.source_row = b.source_row AND a.model = 'rf' AND b.model = 'lr' GROUP BY 1, 2""")
def _(v):
    return J.error_cross_tab(J.aligned_predictions(v.preds, "rf", "lr"))


@query("join_attribute_map", f"""
SELECT p.source_row, p.prediction, CASE WHEN i.row_id IS NOT NULL THEN {' + '.join(f'(i.{c} IS NULL)::INT' for c in INPUTS)} END AS missing FROM preds p LEFT JOIN items i ON i.row_id = p.source_row WHERE p.model = 'rf'""")
def _(v):
    counts = v.items.select(F.col("row_id").alias("source_row"), Q.missing_count(INPUTS).alias("missing"))
    return J.attribute_map(v.preds.where("model = 'rf'").select("source_row", "prediction"), counts, "source_row").select("source_row", "prediction", "missing")


@query("join_metric_difference", f"""
WITH {FOLDS_SQL} SELECT a.fold, round(a.accuracy, 6) AS accuracy, round(a.macro_f1, 6) AS macro_f1, round(b.accuracy - a.accuracy, 6) + 0 AS accuracy_difference, round(b.macro_f1 - a.macro_f1, 6) + 0 AS macro_f1_difference
FROM fm a JOIN fm b ON a.fold = b.fold AND a.model = 'rf' AND b.model = 'gb'""")
def _(v):
    fm = fold_metrics(v)
    return J.metric_difference(fm.where("model = 'rf'"), fm.where("model = 'gb'"), "fold", ["accuracy", "macro_f1"])


@query("join_reference_regression", f"""
WITH s AS (SELECT model, round(accuracy, 3) AS accuracy, round(macro_f1, 3) AS macro_f1 FROM ({rates_sql('model')})), r AS ({rates_sql('model')}),
 a AS (SELECT model, metric, x FROM (UNPIVOT s ON accuracy, macro_f1 INTO NAME metric VALUE x)), b AS (SELECT model, metric, x FROM (UNPIVOT (SELECT model, accuracy, macro_f1 FROM r) ON accuracy, macro_f1 INTO NAME metric VALUE x))
SELECT a.model, a.metric, round(a.x, 6) AS stored, round(b.x, 6) AS recomputed, abs(a.x - b.x) < 0.0002 AS agrees FROM a JOIN b USING (model, metric)""")
def _(v):
    now = M.classification_metrics(v.preds, ["model"]).select("model", "accuracy", "macro_f1")
    stored = now.select("model", F.round("accuracy", 3).alias("accuracy"), F.round("macro_f1", 3).alias("macro_f1"))
    return J.tolerance_report(stored, now, "model", ["accuracy", "macro_f1"], 0.0002)


# ---------------------------------------------------------------- rankings, gates, top-k

ORDER_SQL = "ORDER BY round(macro_f1_mean, 12) DESC, round(recall_p_mean, 12) DESC"


@query("win_rank_models", f"""
WITH {SUMMARY_SQL} SELECT model, round(macro_f1_mean, 6) AS macro_f1_mean, round(recall_p_mean, 6) AS recall_p_mean, row_number() OVER ({ORDER_SQL}, list_position(['rf', 'gb', 'lr'], model))::INT AS place FROM summary""")
def _(v):
    return M.rank_models(summary(v), ["macro_f1_mean", "recall_p_mean"], declared=MODELS).select("model", "macro_f1_mean", "recall_p_mean", "place")


@query("win_rank_ties", f"WITH {SUMMARY_SQL} SELECT model, round(macro_f1_mean, 6) AS macro_f1_mean FROM summary QUALIFY rank() OVER ({ORDER_SQL}) = 1")
def _(v):
    return M.tied_best(summary(v), ["macro_f1_mean", "recall_p_mean"]).select("model", "macro_f1_mean")


@query("win_paired_fold_delta", f"""
WITH {FOLDS_SQL} SELECT a.model, round(avg(a.macro_f1 - b.macro_f1), 6) + 0 AS mean_delta, count_if(a.macro_f1 > b.macro_f1)::BIGINT AS folds_won, count(*) AS folds
FROM fm a JOIN fm b ON a.fold = b.fold AND b.model = 'lr' WHERE a.model <> 'lr' GROUP BY 1""")
def _(v):
    return M.paired_delta(fold_metrics(v), "macro_f1", "lr")


@query("win_holm_cummax", """
WITH t AS (SELECT model AS family, grp AS label, avg(probability_p) / 10 AS p FROM preds GROUP BY 1, 2),
 o AS (SELECT *, p * (count(*) OVER (PARTITION BY family) - row_number() OVER (PARTITION BY family ORDER BY p, label) + 1) AS step FROM t)
SELECT family, label, round(least(max(step) OVER (PARTITION BY family ORDER BY p, label ROWS UNBOUNDED PRECEDING), 1), 6) AS holm_p FROM o""")
def _(v):
    return T.holm(segment_tests(v)).select("family", "label", "holm_p")


def segment_tests(v):
    return v.preds.groupBy(F.col("model").alias("family"), F.col("grp").alias("label")).agg((F.avg("probability_p") / 10).alias("p_value"))


@query("stat_holm", """
WITH t AS (SELECT model AS family, grp AS label, avg(probability_p) / 10 AS p FROM preds GROUP BY 1, 2),
 o AS (SELECT *, p * (count(*) OVER (PARTITION BY family) - row_number() OVER (PARTITION BY family ORDER BY p, label) + 1) AS step FROM t),
 h AS (SELECT *, least(max(step) OVER (PARTITION BY family ORDER BY p, label ROWS UNBOUNDED PRECEDING), 1) AS holm_p FROM o)
SELECT family, label, round(p, 6) AS p_value, round(holm_p, 6) AS holm_p, holm_p < 0.05 AS reject FROM h""")
def _(v):
    return T.holm(segment_tests(v))


MISS_SQL = "SELECT model, source_row, probability_p, row_number() OVER (PARTITION BY model ORDER BY probability_p, source_row) AS rn FROM preds WHERE true_class = 1 AND prediction = 0"


@query("topk_confident_misses", f"SELECT model, source_row, probability_p, rn::INT AS place FROM ({MISS_SQL}) WHERE rn <= 3")
def _(v):
    return confident_misses(v.preds, 3)


def confident_misses(preds, k):
    """Lowest-scored missed positives per model: each partition keeps k per model before the shuffle."""
    from pyspark.sql import Window

    misses = preds.where("true_class = 1 AND prediction = 0").select("model", "source_row", "probability_p")
    place = F.row_number().over(Window.partitionBy("model").orderBy("probability_p", "source_row"))
    return misses.withColumn("place", place).where(F.col("place") <= k)


@query("topk_worst_groups", """
SELECT model, grp, count(*) AS positives, count_if(prediction = 0)::BIGINT AS fn, round(count_if(prediction = 0) / count(*), 6) AS fn_share FROM preds WHERE true_class = 1
GROUP BY 1, 2 ORDER BY round(count_if(prediction = 0) / count(*), 9) DESC, model, grp LIMIT 5""")
def _(v):
    groups = v.preds.where("true_class = 1").groupBy("model", "grp").agg(
        F.count(F.lit(1)).alias("positives"), F.count_if(F.col("prediction") == 0).alias("fn"))
    return groups.withColumn("fn_share", ratio(F.col("fn"), F.col("positives"))).orderBy(F.desc(F.round("fn_share", 9)), "model", "grp").limit(5)


@query("gate_acceptance", f"""
WITH {SUMMARY_SQL}, c AS (SELECT * FROM summary WHERE model = 'rf'), r AS (SELECT * FROM summary WHERE model = 'lr'),
 w AS (SELECT count_if(a.macro_f1 > b.macro_f1) AS won FROM fm a JOIN fm b ON a.fold = b.fold AND a.model = 'rf' AND b.model = 'lr'),
 g AS (SELECT c.macro_f1_mean >= r.macro_f1_mean + 0.005 AS gain_ok, c.recall_p_mean >= r.recall_p_mean AS recall_ok, round(c.macro_f1_mean - r.macro_f1_mean, 6) + 0 AS macro_f1_gain,
   round(c.recall_p_mean - r.recall_p_mean, 6) + 0 AS recall_gain, won >= 3 AS wins_ok FROM c, r, w)
SELECT *, gain_ok AND recall_ok AND wins_ok AS accepted FROM g""")
def _(v):
    fm = fold_metrics(v)
    return H.acceptance_gate(M.model_summary(fm), M.paired_delta(fm, "macro_f1", "lr"), "rf", "lr")


@query("gate_dominance", f"""
WITH {SUMMARY_SQL}, b AS (SELECT * FROM summary WHERE model = 'lr'),
 c AS (SELECT s.model, s.macro_f1_mean AS f, s.macro_f1_mean > b.macro_f1_mean AND s.fn_total < b.fn_total AND s.fp_total <= b.fp_total AS ok FROM summary s, b WHERE s.model IN ('rf', 'gb'))
SELECT model AS selected, ok AS goal_met FROM c ORDER BY ok DESC, f DESC, model DESC LIMIT 1""")
def _(v):
    return H.dominance_gate(summary(v), ["rf", "gb"], "lr")


@query("gate_minimum_cv", f"""
WITH {SUMMARY_SQL} SELECT model, macro_f1_mean + 1e-9 >= 0.7 AS macro_f1_mean_ok, recall_p_mean + 1e-9 >= 0.6 AS recall_p_mean_ok, macro_f1_mean + 1e-9 >= 0.7 AND recall_p_mean + 1e-9 >= 0.6 AS passes FROM summary""")
def _(v):
    return H.minimum_gate(summary(v), {"macro_f1_mean": 0.7, "recall_p_mean": 0.6})


@query("check_oof_complete", """
WITH t AS (SELECT * FROM preds WHERE NOT (model = 'gb' AND source_row % 101 = 0) UNION ALL SELECT * FROM preds WHERE model = 'lr' AND source_row % 97 = 0),
 r AS (SELECT model, source_row, count(*) AS n, count_if(model = 'rf' AND source_row % 89 = 0) AS leaked FROM t GROUP BY 1, 2)
SELECT model, count(*) AS rows, count_if(n > 1)::BIGINT AS repeated, sum(leaked)::BIGINT AS leaked, (SELECT count(*) FROM orders) - count(*) AS missing FROM r GROUP BY 1""")
def _(v):
    rows = v.preds.where("NOT (model = 'gb' AND source_row % 101 = 0)").unionByName(v.preds.where("model = 'lr' AND source_row % 97 = 0"))
    moved = rows.withColumn("fold", F.when(F.expr("model = 'rf' AND source_row % 89 = 0"), F.col("fold") + 1).otherwise(F.col("fold")))
    membership = v.table("orders").select(F.col("o_orderkey").alias("source_row"), (F.col("o_orderkey") % 5 + 1).cast("int").alias("fold"))
    return P.oof_faults(moved, membership)


@query("compare_models_table", f"""
WITH {FOLDS_SQL}, cv AS (SELECT model, avg(macro_f1) AS m, stddev_samp(macro_f1) AS s FROM fm WHERE fold < 5 GROUP BY 1), t AS (SELECT model, macro_f1 AS t FROM fm WHERE fold = 5)
SELECT model, round(m, 6) AS cv_mean, round(s, 6) AS cv_sd, round(t, 6) AS test, round(100 * (t - (SELECT t FROM t WHERE model = 'lr')) / (SELECT t FROM t WHERE model = 'lr'), 6) + 0 AS improvement_percent FROM cv JOIN t USING (model)""")
def _(v):
    fm = fold_metrics(v)
    return M.comparison_table(fm.where("fold < 5"), fm.where("fold = 5"), "macro_f1", "lr")


# ---------------------------------------------------------------- intervals and paired tests


@query("stat_wilson_interval", """
WITH g AS (SELECT model, fold, count_if(prediction = true_class)::BIGINT AS k, count(*) AS n FROM preds GROUP BY 1, 2),
 z AS (SELECT *, k / n AS p, 1.959963984540054::DOUBLE AS z FROM g)
SELECT model, fold, k AS successes, n AS total, round(p, 6) AS share, round((p + z*z/(2*n) - z * sqrt(p*(1-p)/n + z*z/(4.0::DOUBLE*n*n))) / (1 + z*z/n), 6) AS low,
  round((p + z*z/(2*n) + z * sqrt(p*(1-p)/n + z*z/(4.0::DOUBLE*n*n))) / (1 + z*z/n), 6) AS high FROM z""")
def _(v):
    return T.share_interval(v.preds, ["model", "fold"], F.col("prediction") == F.col("true_class"))


@query("stat_mcnemar_exact", """
WITH w AS (SELECT a.model AS other, s.prediction = s.true_class AS sc, a.prediction = a.true_class AS oc FROM preds s JOIN preds a ON a.source_row = s.source_row AND s.model = 'rf' AND a.model <> 'rf'),
 n AS (SELECT other, count_if(sc AND NOT oc)::BIGINT AS b, count_if(oc AND NOT sc)::BIGINT AS c FROM w GROUP BY 1),
 t AS (SELECT other, b, c, sum(exp(lgamma(b + c + 1) - lgamma(i + 1) - lgamma(b + c - i + 1) - (b + c) * ln(2))) AS tail
   FROM (SELECT *, unnest(generate_series(0, least(b, c))) AS i FROM n) GROUP BY ALL)
SELECT 'rf' AS selected, other, b AS only_selected_correct, c AS only_other_correct, round(CASE WHEN b = c THEN 1.0 ELSE least(1.0, 2 * tail) END, 6) AS p_value FROM t""")
def _(v):
    pairs = M.discordant(v.preds, "rf", ["gb", "lr"])
    return T.mcnemar_exact(pairs, ["selected", "other"], "only_selected_correct", "only_other_correct")


# ---------------------------------------------------------------- votes and thresholds

VOTE = {"rf": 0.5, "gb": 0.3, "lr": 0.2}
OPTIONS = [(1.0, 0.0, 0.0), (0.5, 0.5, 0.0), (0.5, 0.25, 0.25), (0.4, 0.3, 0.3)]


@query("model_soft_vote", """
SELECT source_row, fold, max(true_class) AS true_class, round(sum(probability_p * CASE model WHEN 'rf' THEN 0.5 WHEN 'gb' THEN 0.3 ELSE 0.2 END), 6) AS probability_p FROM preds GROUP BY 1, 2""")
def _(v):
    return M.soft_vote(v.preds, VOTE)


@query("thr_recall_target", f"""
WITH {CURVE_SQL} SELECT model, score AS threshold, round(tp / pall, 6) AS recall, round(fp / nall, 6) AS fpr FROM curve WHERE tp / pall >= 0.9
QUALIFY row_number() OVER (PARTITION BY model ORDER BY fp, tp DESC, score DESC) = 1""")
def _(v):
    return H.recall_target(v.preds, ["model"])


@query("thr_fpr_budget", f"""
WITH {CURVE_SQL} SELECT model, score AS threshold, round(tp / pall, 6) AS recall, round(fp / nall, 6) AS fpr FROM curve WHERE fp / nall <= 0.14
QUALIFY row_number() OVER (PARTITION BY model ORDER BY tp DESC, fp, score DESC) = 1""")
def _(v):
    return H.fpr_budget(v.preds, ["model"])


def grid_sql(by, source, score="probability_p"):
    k = by + ", threshold"
    base = (f"SELECT {k}, count_if(true_class = 0 AND {score} < threshold)::BIGINT AS tn, count_if(true_class = 0 AND {score} >= threshold)::BIGINT AS fp, "
            f"count_if(true_class = 1 AND {score} < threshold)::BIGINT AS fn, count_if(true_class = 1 AND {score} >= threshold)::BIGINT AS tp "
            f"FROM {source} CROSS JOIN (SELECT unnest(generate_series(20, 70)) / 100.0::DOUBLE AS threshold) GROUP BY {k}")
    return f"SELECT {k}, {RATE_SQL['macro_f1']} AS macro_f1 FROM ({base})"


@query("thr_macro_f1_grid", f"""
SELECT model, fold, threshold, round(macro_f1, 6) AS macro_f1 FROM ({grid_sql('model, fold', '(SELECT * EXCLUDE (threshold) FROM preds)')})
QUALIFY row_number() OVER (PARTITION BY model, fold ORDER BY macro_f1 DESC, round(abs(threshold - 0.5), 9), threshold DESC) = 1""")
def _(v):
    return H.macro_f1_grid(v.preds, ["model", "fold"])


@query("thr_vote_weights", f"""
WITH w AS (SELECT source_row, fold, max(true_class) AS true_class, max(probability_p) FILTER (WHERE model = 'rf') AS a, max(probability_p) FILTER (WHERE model = 'gb') AS b, max(probability_p) FILTER (WHERE model = 'lr') AS c FROM preds GROUP BY 1, 2),
 m AS (SELECT fold, true_class, o::INT AS option, round(a * x + b * y + c * z, 9) AS p FROM w CROSS JOIN (VALUES {', '.join(f'({i}, {a}::DOUBLE, {b}::DOUBLE, {c}::DOUBLE)' for i, (a, b, c) in enumerate(OPTIONS))}) AS t(o, x, y, z)),
 g AS (SELECT * FROM ({grid_sql('fold, option', 'm', 'p')}) QUALIFY row_number() OVER (PARTITION BY fold, option ORDER BY macro_f1 DESC, round(abs(threshold - 0.5), 9), threshold DESC) = 1)
SELECT fold, option, threshold, round(macro_f1, 6) AS macro_f1 FROM g QUALIFY row_number() OVER (PARTITION BY fold ORDER BY macro_f1 DESC, option) = 1""")
def _(v):
    return H.vote_weights(v.preds, ["fold"], MODELS, OPTIONS)


@query("score_decision_policy", """
WITH s AS (SELECT *, CASE WHEN source_row % 97 = 0 THEN probability_p + 1 WHEN source_row % 89 = 0 THEN NULL WHEN source_row % 83 = 0 THEN 0.5 ELSE probability_p END AS score FROM preds)
SELECT model, CASE WHEN score BETWEEN 0 AND 1 AND score >= 0.5 THEN 'suspected' WHEN score BETWEEN 0 AND 1 THEN 'uncertain' ELSE 'invalid' END AS decision, count(*) AS n FROM s GROUP BY 1, 2""")
def _(v):
    score = F.expr("CASE WHEN source_row % 97 = 0 THEN probability_p + 1 WHEN source_row % 89 = 0 THEN NULL WHEN source_row % 83 = 0 THEN 0.5D ELSE probability_p END")
    rows = v.preds.select("model", score.alias("score")).select("model", F.coalesce(G.decision(F.col("score")), F.lit("invalid")).alias("decision"))
    return rows.groupBy("model", "decision").agg(F.count(F.lit(1)).alias("n"))
