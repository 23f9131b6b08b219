import hashlib
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyridge.operators import features as E
from tallyridge.operators import joins as J
from tallyridge.operators import metrics as M
from tallyridge.operators import profile as Q
from tallyridge.operators import scoring as G
from tallyridge.operators import splits as P
from tallyridge.operators import stats as T
from tallyridge.operators import thresholds as H


def labelled(spark, n=1000, hot=0.34):
    return spark.range(n).select(F.col("id").alias("row_id"), F.when(F.col("id") < n * hot, "p").otherwise("e").alias("label"))


def preds(spark, truth, score, model="m"):
    rows = [(i, 1, int(t), model, float(s), int(s > 0.5)) for i, (t, s) in enumerate(zip(truth, score))]
    return spark.createDataFrame(rows, "source_row long, fold int, true_class int, model string, probability_p double, prediction int")


# ---------------------------------------------------------------- splits


def test_holdout_shares_are_exact_and_reproducible(spark):
    df = labelled(spark)
    a = P.stratified_holdout(df, "label", "row_id", 0.18, 42)
    counts = {(r.label, r.split): r["count"] for r in a.groupBy("label", "split").count().collect()}
    assert counts[("p", "test")] == round(340 * 0.18) and counts[("e", "test")] == round(660 * 0.18)
    b = P.stratified_holdout(df.repartition(7), "label", "row_id", 0.18, 42)
    assert a.exceptAll(b).count() == 0
    assert a.exceptAll(P.stratified_holdout(df, "label", "row_id", 0.18, 43)).count() > 0


def test_folds_are_balanced(spark):
    sizes = P.stratified_folds(labelled(spark, 997), "label", "row_id", 5, 1).groupBy("label", "fold").count().toPandas()
    spread = sizes.groupby("label")["count"].agg(lambda s: s.max() - s.min())
    assert (spread <= 1).all() and len(sizes) == 10


def test_groups_stay_whole(spark):
    df = labelled(spark).withColumn("g", F.floor(F.col("row_id") / 17))
    out = P.group_folds(df, "g", "label", 5, 42)
    assert out.count() == 1000
    assert out.groupBy("g").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0
    assert out.select("fold").distinct().count() == 5


def test_nested_folds_stay_inside_training(spark):
    df = labelled(spark, 300)
    nested = P.nested_folds(df, "label", "row_id", 5, 3, 9)
    assert nested.count() == 300 * 4
    per_row = nested.groupBy("row_id").agg(F.count_distinct("outer").alias("k"))
    assert per_row.where("k <> 4").count() == 0


def test_manifest_orders_training_rows(spark):
    m = P.split_manifest(labelled(spark, 200), "label", "row_id", 0.2, 5, 3)
    train = m.where("split = 'train'").toPandas()
    assert sorted(train.training_order) == list(range(160))
    assert m.where("split = 'test' AND (training_order IS NOT NULL OR cv_validation_fold IS NOT NULL)").count() == 0


def test_out_of_fold_faults(spark):
    members = spark.createDataFrame([(i, i % 2 + 1) for i in range(6)], "source_row int, fold int")
    good = members.withColumn("model", F.lit("m"))
    assert P.oof_faults(good, members).first()[1:] == (6, 0, 0, 0)
    bad = good.where("source_row > 0").unionByName(good.where("source_row = 3")).withColumn("fold", F.when(F.col("source_row") == 5, 9).otherwise(F.col("fold")))
    r = P.oof_faults(bad, members).first()
    assert (r.rows, r.repeated, r.leaked, r.missing) == (5, 1, 1, 1)


def test_simpler_model_wins_within_one_percent(spark):
    def pick(rows):
        return P.simplest_within(spark.createDataFrame([("f", *r) for r in rows], "family string, model string, rmse double, simplicity int")).first().model

    assert pick([("naive", 120.0, 0), ("ridge", 100.9, 1), ("forest", 100.0, 2)]) == "ridge"
    assert pick([("naive", 120.0, 0), ("ridge", 101.0, 1), ("forest", 100.0, 2)]) == "forest"


# ---------------------------------------------------------------- metrics


def test_curves_against_brute_force(spark):
    rng = np.random.default_rng(0)
    y = (rng.random(400) < 0.3).astype(int)
    s = np.round(np.clip(rng.normal(0.4 + 0.2 * y, 0.2), 0, 1), 2)
    curve = M.score_curve(preds(spark, y, s), ["model"])
    pos, neg = s[y == 1], s[y == 0]
    auc = np.mean([(p > neg).mean() + (p == neg).mean() / 2 for p in pos])
    assert M.roc_auc(curve, ["model"]).first().roc_auc == pytest.approx(auc)
    levels = np.unique(s)[::-1]
    tp = np.array([(pos >= t).sum() for t in levels])
    ap = np.sum(np.diff(np.r_[0, tp]) / len(pos) * tp / np.array([(s >= t).sum() for t in levels]))
    assert M.average_precision(curve, ["model"]).first().average_precision == pytest.approx(ap)
    full = M.ranking_metrics(preds(spark, y, s), ["model"]).first()
    assert full.roc_auc == pytest.approx(auc) and full.tp + full.fn == len(pos)


def test_empty_denominators_count_as_zero(spark):
    r = M.classification_metrics(preds(spark, [0, 0], [0.1, 0.2]), ["model"]).first()
    assert (r.precision_p, r.recall_p, r.f1_p, r.accuracy) == (0.0, 0.0, 0.0, 1.0)
    assert r.macro_f1 == 0.5


def test_one_half_is_class_zero_but_suspected(spark):
    df = preds(spark, [1], [0.5])
    assert df.first().prediction == 0
    assert df.select(G.decision(F.col("probability_p"))).first()[0] == "suspected"
    decided, invalid = G.with_decision(spark.createDataFrame([(0.49,), (1.2,), (float("nan"),), (None,)], "p double"), "p")
    assert [r.decision for r in decided.collect()] == ["uncertain"] and invalid.count() == 3


def test_fold_deviation_is_the_sample_one(spark):
    df = preds(spark, [1, 0, 1, 0], [0.9, 0.1, 0.2, 0.1]).withColumn("fold", (F.col("source_row") / 2).cast("int"))
    fm = M.classification_metrics(df, ["model", "fold"])
    s = M.model_summary(fm).first()
    assert s.accuracy_sd == pytest.approx(np.std([1.0, 0.5], ddof=1))
    assert M.tuning_summary(fm, "accuracy").first().sd_score == pytest.approx(np.std([1.0, 0.5]))
    assert M.model_summary(fm.where("fold = 0")).first().accuracy_sd is None


# ---------------------------------------------------------------- thresholds


def test_threshold_within_budget(spark):
    y = [0] * 12 + [1] * 5
    p = [0.05, 0.07, 0.11, 0.16, 0.22, 0.27, 0.31, 0.44, 0.52, 0.58, 0.81, 0.93, 0.25, 0.55, 0.62, 0.88, 0.97]
    r = H.fpr_budget(preds(spark, y, p), ["model"], 0.2).first()
    assert r.recall == pytest.approx(3 / 5) and r.threshold == 0.62 and r.fpr == pytest.approx(2 / 12)
    none = H.fpr_budget(preds(spark, [0, 1], [0.9, 0.1]), ["model"], 0.1).first()
    assert none.threshold == np.nextafter(0.9, 1) and none.recall == 0


def test_recall_target_prefers_specificity_then_threshold(spark):
    r = H.recall_target(preds(spark, [1, 1, 0, 0, 1], [0.9, 0.8, 0.7, 0.3, 0.6]), ["model"], 0.66).first()
    assert r.threshold == 0.8 and r.fpr == 0


def test_grid_ties_go_to_one_half_then_up(spark):
    r = H.macro_f1_grid(preds(spark, [0, 1], [0.1, 0.9]), ["model"]).first()
    assert r.threshold == 0.5 and r.macro_f1 == 1
    up = H.macro_f1_grid(preds(spark, [0, 0, 1, 1], [0.1, 0.495, 0.505, 0.9]), ["model"]).first()
    assert up.threshold == 0.5


def test_grid_metrics_equal_direct_count(spark):
    rng = np.random.default_rng(3)
    y, s = rng.integers(0, 2, 200), np.round(rng.random(200), 3)
    for r in H.grid_metrics(preds(spark, y, s), ["model"]).collect():
        hit = s >= r.threshold
        assert (r.tp, r.fp, r.fn, r.tn) == ((hit & (y == 1)).sum(), (hit & (y == 0)).sum(), (~hit & (y == 1)).sum(), (~hit & (y == 0)).sum())


def test_just_above(spark):
    values = [0.1, 0.5, 0.25, 1.0, 0.999999, 1e-9, 0.0]
    got = spark.createDataFrame([(v,) for v in values], "x double").select(H.just_above(F.col("x"))).collect()
    assert [r[0] for r in got] == [float(np.nextafter(v, np.inf)) for v in values]


def test_vote_weights_keep_the_earlier_option_on_ties(spark):
    both = preds(spark, [0, 1], [0.1, 0.9], "a").unionByName(preds(spark, [0, 1], [0.2, 0.8], "b"))
    r = H.vote_weights(both, ["fold"], ["a", "b"], [(1.0, 0.0), (0.5, 0.5)]).first()
    assert r.option == 0 and r.macro_f1 == 1
    with pytest.raises(ValueError):
        M.soft_vote(both, {"a": 0.5, "b": 0.6})


# ---------------------------------------------------------------- statistics


def test_holm(spark):
    df = spark.createDataFrame([("f", "a", 0.004), ("f", "b", 0.02), ("f", "c", 0.013), ("f", "d", 0.3), ("g", "a", 0.5)], "family string, label string, p_value double")
    got = {(r.family, r.label): r.holm_p for r in T.holm(df).collect()}
    assert got == {("f", "a"): pytest.approx(0.016), ("f", "b"): pytest.approx(0.04), ("f", "c"): pytest.approx(0.039), ("f", "d"): pytest.approx(0.3),
                   ("g", "a"): pytest.approx(0.5)}


@pytest.mark.parametrize("b, c", [(0, 0), (1, 0), (5, 5), (3, 12), (40, 61), (700, 640), (20, 0), (120000, 121500)])
def test_mcnemar_is_exact(spark, b, c):
    row = T.mcnemar_exact(spark.createDataFrame([(b, c)], "b long, c long"), [], "b", "c").first()
    n, k = b + c, min(b, c)
    if b == c:
        want = 1.0
    elif n < 5000:
        want = min(1.0, 2 * sum(math.comb(n, i) for i in range(k + 1)) / 2**n)
    else:
        logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) - n * math.log(2) for i in range(k + 1)]
        want = 2 * math.fsum(map(math.exp, logs))
    assert row.p_value == pytest.approx(want, rel=1e-7)


def test_wilson(spark):
    low, high = T.wilson(F.lit(8), F.lit(10))
    r = spark.range(1).select(low.alias("l"), high.alias("h")).first()
    assert (r.l, r.h) == (pytest.approx(0.4901625), pytest.approx(0.9433178))


def test_chi_square_with_and_without_correction(spark):
    two = spark.createDataFrame([("t", "a", "x", 10), ("t", "a", "y", 20), ("t", "b", "x", 30), ("t", "b", "y", 5)], "t string, r string, c string, n long")
    obs = np.array([[10, 20], [30, 5]])
    e = obs.sum(1, keepdims=True) * obs.sum(0) / obs.sum()
    r = T.chi_square(two, ["t"], "r", "c").first()
    assert r.chi2 == pytest.approx((((abs(obs - e) - 0.5) ** 2) / e).sum()) and r.dof == 1 and r.min_expected == pytest.approx(e.min())
    three = two.unionByName(spark.createDataFrame([("t", "z", "x", 7)], "t string, r string, c string, n long"))
    obs = np.array([[10, 20], [30, 5], [7, 0]])
    e = obs.sum(1, keepdims=True) * obs.sum(0) / obs.sum()
    assert T.chi_square(three, ["t"], "r", "c").first().chi2 == pytest.approx((((obs - e) ** 2) / e).sum())


def weekly(spark, values):
    days = pd.date_range("2020-01-06", periods=len(values), freq="7D")
    return spark.createDataFrame(pd.DataFrame({"week": days, "effect": values})).withColumn("week", F.col("week").cast("timestamp_ntz"))


def test_block_test_separates_effect_from_noise(spark):
    strong = T.block_test(weekly(spark, [5.0 + (i % 3) for i in range(82)]), "strong", repetitions=2000).first()
    assert strong.blocks == 20 and strong.p_value < 0.01 and strong.ci_low > 5
    noise = T.block_test(weekly(spark, [(-1.0) ** (i // 4) for i in range(80)]), "noise", repetitions=2000).first()
    assert noise.p_value > 0.5 and noise.ci_low < 0 < noise.ci_high


def test_latest_weeks_fill_the_blocks(spark):
    blocks = T.week_blocks(weekly(spark, [100.0, 1, 1, 1, 1])).collect()
    assert [b.effect for b in blocks] == [1.0]


# ---------------------------------------------------------------- features and profile


def test_statistics_come_from_training_rows_only(spark):
    train = spark.createDataFrame([(1.0, "a"), (3.0, "a"), (5.0, "b")], "x double, c string")
    df = spark.createDataFrame([(None, None), (1000.0, "z")], "x double, c string")
    assert E.impute_median(df, train, ["x"]).collect()[0].x == 3.0
    assert E.impute_mode(df, train, ["c"]).collect()[0].c == "a"
    assert [r.c for r in E.training_levels(df, train, ["c"]).collect()] == [None, None]
    scaled = E.standard_scale(df, train, ["x"]).collect()[1].x_z
    assert scaled == pytest.approx((1000 - 3) / np.std([1, 3, 5]))


def test_one_hot_rejects_unknown_values(spark):
    df = spark.createDataFrame([("a",), ("b",)], "c string")
    rows = E.one_hot(df, {"c": ["a", "b", "d"]}).collect()
    assert [(r.c_a, r.c_b, r.c_d) for r in rows] == [(1, 0, 0), (0, 1, 0)]
    with pytest.raises(Exception, match="vocabulary"):
        E.one_hot(df, {"c": ["a"]}).collect()


def test_geometry_guards_zero(spark):
    df = spark.createDataFrame([(4.0, 2.0, 10.0), (4.0, 0.0, 0.0)], "cap double, h double, w double")
    a, b = E.geometry(df, "cap", "h", "w").collect()
    assert (a.cap_to_stem_height, a.stem_slenderness) == (2.0, 2.0)
    assert b.cap_to_stem_height is None and b.stem_slenderness is None


def test_subset_does_not_change_the_input(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert E.column_subset(df, ["b"]).columns == ["a"] and df.columns == ["a", "b"]


def test_conflicts_and_modes(spark):
    df = spark.createDataFrame([("e", None, 1), ("p", None, 1), ("e", "x", 2), ("e", "x", 2), ("p", "y", 2)], "label string, c string, n int")
    r = Q.label_conflicts(df, ["c", "n"], "label").first()
    assert (r.conflicting_inputs, r.rows) == (1, 2)
    assert Q.modes(df, ["c"]).first()["mode"] == "x"
    assert {r.label: r.repeated_rows for r in Q.duplicate_profile(df, ["label", "c", "n"], "label").collect()} == {"e": 1, "p": 0}


def test_one_to_one_stops_on_repeats(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    assert J.one_to_one(a, a.withColumnRenamed("v", "w"), "k").first()[:] == (1, "x", "x")
    with pytest.raises(Exception, match="not unique"):
        J.one_to_one(a.union(a), a.withColumnRenamed("v", "w"), "k").collect()


def test_chi_square_p_values(spark):
    def exact(a, x):  # finite sums for whole and half a
        logs = [-x + (i - (a % 1)) * math.log(x) - math.lgamma(i - (a % 1) + 1) for i in range(1 if a % 1 else 0, int(a + a % 1))]
        return math.fsum(map(math.exp, logs)) + (math.erfc(math.sqrt(x)) if a % 1 else 0.0)

    rows = [(dof, dof * share + more) for dof in range(1, 201) for share in (0.2, 0.9, 1.0, 1.2, 3.0) for more in (0.01, 10.0)]
    df = spark.createDataFrame(rows, "dof long, chi2 double").select("dof", "chi2", T.chi_square_p(F.col("chi2"), F.col("dof")).alias("p"))
    for r in df.collect():
        assert r.p == pytest.approx(exact(r.dof / 2, r.chi2 / 2), abs=1e-9)
    edge = spark.createDataFrame([(0, 0.0), (3, 0.0), (2, 1e6), (None, 1.0)], "dof long, chi2 double")
    assert [r.p for r in edge.select(T.chi_square_p(F.col("chi2"), F.col("dof")).alias("p")).collect()] == [1.0, 1.0, 0.0, None]


def plain_permutation(rows, repetitions, seed):
    known = sorted((o, x, g) for o, x, g in rows if x is not None)
    n1 = sum(g for *_, g in known)
    gap = lambda first, rest: sum(first) / len(first) - sum(rest) / len(rest)
    observed = gap([x for _, x, g in known if g], [x for _, x, g in known if not g])
    hits = 0
    for rep in range(1, repetitions + 1):
        keyed = sorted((hashlib.md5(f"{rep}|{i}|{seed}".encode()).hexdigest(), x) for i, (_, x, _) in enumerate(known))
        hits += gap([x for _, x in keyed[:n1]], [x for _, x in keyed[n1:]]) >= observed - 1e-12
    return observed, n1, len(known) - n1, (hits + 1) / (repetitions + 1)


@pytest.mark.parametrize("bucket_rows", [1_000, 20, 2])
def test_permutation_by_digits_equals_sorting(spark, bucket_rows):
    rng = np.random.default_rng(6)
    rows = [(int(i * 3), None if i % 31 == 0 else float(rng.normal()), int(i % 3 == 0)) for i in range(400)]
    df = spark.createDataFrame(rows, "o long, x double, g int")
    plan = T.permutation_two_sample(df, "x", F.col("g") == 1, "o", 60, 7, bucket_rows)
    assert tuple(plan.first()) == pytest.approx(plain_permutation(rows, 60, 7))
    assert "collect_list" not in plan._jdf.queryExecution().toString()


def test_permutation_of_one_empty_group_and_no_rows(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 3.0)], "o long, x double")
    for frame, sizes in ((df, (0, 2)), (df.where("o > 5"), (0, 0))):
        r = T.permutation_two_sample(frame, "x", F.lit(False), "o", 9).first()
        assert r.observed is None and (r.first_n, r.second_n) == sizes and r.p_value == pytest.approx(0.1)
