from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from tallyridge.operators import models as L
from tallyridge.operators import proximity as X
from tallyridge.operators import series as S
from tallyridge.operators import splits as P


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(2)
    rows = [(datetime(2024, 1, 1) + timedelta(hours=i), float(round(50 + 30 * np.sin(i * 2 * np.pi / 24) + rng.normal(0, 3))), "NYC") for i in range(28 * 24)]
    series = spark.createDataFrame(rows, "timestamp timestamp_ntz, rides double, area string")
    return S.demand_frame(series).cache()


def test_regressors_beat_the_naive_model_and_repeat(frame):
    cut = F.expr("day < timestamp_ntz'2024-01-24'")
    train, valid = frame.where(cut), frame.where(~cut)
    naive = L.rmse_of(L.seasonal_naive().fit(train), valid)
    ridge = L.ridge(S.FEATURES).fit(train)
    assert L.rmse_of(ridge, valid) < naive
    forests = [L.forest_regressor(S.FEATURES, trees=10, depth=6).fit(train) for _ in range(2)]
    assert L.rmse_of(forests[0], valid) == L.rmse_of(forests[1], valid) < naive
    assert forests[0].transform(valid).where("predicted_rides < 0").count() == 0


def test_chronological_cv_and_selection(frame):
    folds = P.chronological_folds(frame, 2, 3)
    table = L.best_configuration(frame, folds, {"ridge": lambda: L.ridge(S.FEATURES), "naive": lambda: L.seasonal_naive()})
    assert [r["selected"] for r in table] == [True, False]


def test_importance_finds_the_used_feature(frame, spark):
    df = frame.withColumn("rides", F.col("hour_sin") * 10 + 50)
    model = L.ridge(["hour_sin", "weekday_sin"], alpha=0.001).fit(df)
    got = {r.feature: r.importance for r in L.permutation_importance(model, df, "timestamp", ["hour_sin", "weekday_sin"], repeats=2).collect()}
    assert got["hour_sin"] > 1 and abs(got["weekday_sin"]) < 0.1


def test_permuted_columns_are_permutations(spark):
    df = spark.range(100).select(F.col("id").alias("r"), (F.col("id") * 2).alias("a"), F.concat(F.lit("v"), (F.col("id") % 7).cast("string")).alias("b"))
    out = L.permuted_columns(df, "r", ["a", "b"], "s").toPandas()
    assert sorted(out.a) == sorted(out.a__perm) and sorted(out.b) == sorted(out.b__perm)
    assert (out.a == out.a__perm).mean() < 0.2


def test_shuffles_send_no_rows_to_the_driver(spark, tmp_path):
    spark.range(500).select("id", (F.col("id") % 2).alias("y"), (F.col("id") % 3).alias("g")).write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))  # far below the limit of a broadcast
    for made in (L.shuffled_labels(df, "id", "y"), P.stratified_holdout(df, "g", "id", 0.2, 7)):
        assert "BroadcastExchange" not in made._jdf.queryExecution().executedPlan().toString()
        assert made.count() == 500


def study(spark, n=240):
    rng = np.random.default_rng(4)
    kind = rng.choice(["a", "b", "c"], n)
    size = np.where(kind == "a", 1.0, 5.0) + rng.normal(0, 0.3, n)
    color = [k.upper() if rng.random() < 0.7 else None for k in kind]
    y = ((kind == "a") ^ (rng.random(n) < 0.05)).astype(int)
    return spark.createDataFrame([(i, float(s), str(k), c, int(t)) for i, (s, k, c, t) in enumerate(zip(size, kind, color, y))],
                                 "row_id int, size double, kind string, color string, y int")


def test_classifiers_learn_and_the_control_does_not(spark):
    df = L.balanced_weight(study(spark))
    model = L.classifier("decision_tree", ["size"], ["kind"], unknown="missing").fit(df)
    scored = L.score_classifier(model, df, ["row_id", "y"])
    assert L.MacroF1().evaluate(scored) > 0.85
    unseen = L.score_classifier(model, spark.createDataFrame([(1, None, "never", None, 0)], df.drop("weight").schema), ["row_id"])
    assert 0 <= unseen.first().probability_p <= 1
    control = L.balanced_weight(L.shuffled_labels(study(spark), "row_id", "y"))
    fitted = L.classifier("decision_tree", ["size"], ["kind"], unknown="missing", maxDepth=2).fit(control)
    fresh = L.shuffled_labels(study(spark), "row_id", "y", "other")
    assert L.MacroF1().evaluate(L.score_classifier(fitted, fresh, ["row_id", "y"])) < 0.7


def test_pipeline_parts(spark):
    df = spark.createDataFrame([(2.0, 0.0, 4.0, "n")], "cap_diameter double, stem_height double, stem_width double, noise string")
    row = L.DropColumns(["noise"]).transform(L.Geometry().transform(L.ZeroToNull().transform(df))).first()
    assert row.stem_height is None and row.cap_to_stem_height is None and "noise" not in row.asDict()


def test_fitted_pipelines_survive_storage(spark, frame, tmp_path):
    from pyspark.ml import PipelineModel

    rows = spark.createDataFrame([(i, 2.0 * i, 0.0 if i % 3 else 3.0, 1.0 + i % 4, "ab"[i % 2], "noise", i % 2) for i in range(40)],
                                 "row_id int, cap_diameter double, stem_height double, stem_width double, kind string, veil string, y int")
    df = L.balanced_weight(rows)
    before = [L.ZeroToNull(["stem_height"]), L.Geometry(), L.DropColumns(["veil"])]
    model = L.classifier("decision_tree", ["cap_diameter", "stem_height"], ["kind"], before, unknown="missing").fit(df)
    model.write().overwrite().save(str(tmp_path / "c"))
    again = PipelineModel.load(str(tmp_path / "c"))
    assert "veil" not in again.transform(df).columns
    one, two = (sorted(map(tuple, L.score_classifier(m, df, ["row_id"]).collect())) for m in (model, again))
    assert one == two
    for estimator in (L.ridge(S.FEATURES), L.forest_regressor(S.FEATURES, trees=5, depth=4), L.seasonal_naive()):
        fitted = estimator.fit(frame)
        fitted.write().overwrite().save(str(tmp_path / "r"))
        stored = PipelineModel.load(str(tmp_path / "r"))
        assert L.rmse_of(stored, frame) == L.rmse_of(fitted, frame)


def test_forest_of_parts_learns_and_survives_storage(spark, tmp_path):
    from pyspark.ml import PipelineModel

    df = L.balanced_weight(study(spark))
    model = L.classifier("random_forest", ["size"], ["kind"], unknown="missing", numTrees=23, maxDepth=4).fit(df)
    *parts, _mean = model.stages[-1].stages
    assert [m.getNumTrees for m in parts] == [10, 10, 3] and len({t.toDebugString for m in parts for t in m.trees}) > 3
    whole = model.transform(df)
    assert not [c for c in whole.columns if c.startswith("__")] and L.MacroF1().evaluate(whole) > 0.85
    mixed = parts[2].transform(parts[1].transform(parts[0].transform(whole.drop("probability", "prediction"))))
    model.write().overwrite().save(str(tmp_path / "f"))
    one, two = ({r.row_id: r.probability_p for r in L.score_classifier(m, df, ["row_id"]).collect()} for m in (model, PipelineModel.load(str(tmp_path / "f"))))
    assert one == two
    assert one == pytest.approx({r.row_id: (10 * r["__probability_0"][1] + 10 * r["__probability_1"][1] + 3 * r["__probability_2"][1]) / 23 for r in mixed.collect()})


def test_ridge_weight_is_that_of_the_whole_sum_of_squares(frame):
    half = frame.where("hour(timestamp) < 12")
    for rows in (frame, half):
        model = L.ridge(["lag_7d"]).fit(rows).stages[2]
        facts = rows.agg(F.count(F.lit(1)).alias("n"), F.corr("lag_7d", "rides").alias("r"), F.stddev("rides").alias("sd")).first()
        assert model.coefficients[0] == pytest.approx((facts.n - 1) * facts.r * facts.sd / (facts.n - 1 + 10.0))


def test_nearest_values_equal_brute_force(spark):
    rng = np.random.default_rng(7)
    known = [([int(x) for x in rng.integers(0, 3, 6)], str(rng.choice(["r", "g"]))) for _ in range(60)]
    known += [known[0]] * 25  # many copies of one row
    queries = [[int(x) for x in rng.integers(0, 3, 6)] for _ in range(9)]
    q = spark.createDataFrame([(p,) for p in queries], "profile array<int>")
    r = spark.createDataFrame(known, "profile array<int>, value string")
    got = X.nearest_values(q, r, k=10, block_rows=7)
    votes = {(x.query, x.value): x.weight for x in got.collect()}
    keys = {tuple(x.profile): x.k for x in q.select("profile", F.md5(F.array_join("profile", ",")).alias("k")).collect()}
    tie = {tuple(x.profile): x.k for x in r.select("profile", F.md5(F.array_join("profile", ",")).alias("k")).distinct().collect()}
    for p in queries:
        ranked = sorted(known, key=lambda t: (-sum(a == b for a, b in zip(p, t[0])), tie[tuple(t[0])], t[1]))[:10]
        want = {}
        for profile, value in ranked:
            want[value] = want.get(value, 0) + sum(a == b for a, b in zip(p, profile)) / 6
        for value, weight in want.items():
            assert votes[(keys[tuple(p)], value)] == pytest.approx(weight)


def test_few_profiles_are_compared_and_none_is_lost(spark):
    rng = np.random.default_rng(9)
    centres = rng.integers(0, 40, (25, 30))
    make = lambda n: [[int(x) if rng.random() < 0.8 else int(rng.integers(0, 40)) for x in centres[i % 25]] for i in range(n)]
    known, asked = make(600), make(40)
    r = spark.createDataFrame([(str(i), p, 1 + i % 3) for i, p in enumerate(known)], "known string, profile array<int>, rows int")
    q = spark.createDataFrame([(str(i), p) for i, p in enumerate(asked)], "query string, profile array<int>")
    got = {(x.query, x.known): x.matches for x in X.candidates(q, r, 12, 16).collect()}
    assert len(got) < 0.1 * len(known) * len(asked)
    for i, p in enumerate(asked):
        equal = [sum(a == b for a, b in zip(p, other)) for other in known]
        places, rows, floor = sorted(range(len(known)), key=lambda j: -equal[j]), 0, 0
        for j in places:
            rows += 1 + j % 3
            if rows >= 12:
                floor = equal[j]
                break
        for j in range(len(known)):
            assert got.get((str(i), str(j)), equal[j]) == equal[j] and ((str(i), str(j)) in got or equal[j] < floor)


def test_hot_leaves_are_compared_by_blocks_and_every_core_grows_trees(spark, monkeypatch):
    """With few leaves per tree nearly every profile shares one with every other."""
    rng = np.random.default_rng(3)
    known, asked = rng.integers(0, 2, (90, 40)), rng.integers(0, 2, (20, 40))
    frames = (pd.DataFrame({"query": [str(i) for i in range(20)], "profile": list(asked)}),
              pd.DataFrame({"known": [str(i) for i in range(90)], "profile": list(known), "rows": 1}))
    got = X._best_of_block(5)(*frames)
    equal = (asked[:, None] == known[None]).sum(2)
    want = {(str(i), str(j)): equal[i, j] for i in range(20) for j in range(90) if equal[i, j] >= np.sort(equal[i])[-5]}
    assert {(q, k): m for q, k, m, _t in got.itertuples(index=False)} == want
    seen, held = [], X.held
    monkeypatch.setattr(X, "held", lambda df, trees=False: seen.append((alone, trees)) or held(df, trees))
    for alone in (79, 80):  # 40 rows and their shuffles
        monkeypatch.setattr(X, "ROWS_ALONE", alone)
        X.fit_proximity_forest(study(spark, 40), "row_id", ["size"], ["kind"], trees=2, depth=2)
    assert seen == [(79, True)]


def test_nothing_known_and_no_equal_leaf(spark):
    q = spark.createDataFrame([([1, 2],), ([5, 6],)], "profile array<int>")
    r = spark.createDataFrame([([1, 3], "a"), ([9, 9], "b")], "profile array<int>, value string")
    assert [(x.value, x.weight) for x in X.nearest_values(q, r).collect()] == [("a", 0.5)]
    assert X.nearest_values(q, r.limit(0)).count() == 0 and X.nearest_values(q.limit(0), r).count() == 0


def test_proximity_fills_every_hole(spark):
    df = study(spark)
    model = X.fit_proximity_forest(df, "row_id", ["size"], ["kind"], trees=10, depth=4)
    out = X.proximity_impute(model, df, df, "row_id", "color").toPandas()
    assert out.color.notna().all()
    holes = df.where("color IS NULL").toPandas().row_id
    filled = out[out.row_id.isin(holes)]
    assert (filled.color == filled.kind.str.upper()).mean() > 0.8
    kept = out[~out.row_id.isin(holes)]
    assert (kept.color == kept.kind.str.upper()).all()


def test_mllib_chi_square_agrees_on_wide_tables(spark):
    from tallyridge.operators import profile as Q
    from tallyridge.operators import stats as T

    df = study(spark)
    ours = T.chi_square(Q.value_counts(df, ["kind"], ["y"]), ["column"], "value", "y").first()
    indexed = StringIndexer(inputCol="kind", outputCol="ix").fit(df).transform(df).withColumn("v", L.as_vector(["ix"]))
    theirs = ChiSquareTest.test(indexed, "v", "y", flatten=True).first()
    assert ours.chi2 == pytest.approx(theirs.statistic) and ours.dof == theirs.degreesOfFreedom


def test_draws_are_seeded_and_without_replacement():
    space = {"a": [1, 2, 3], "b": ["x", "y"]}
    every = L.drawn(space, 99)
    assert len(every) == 6 and {(p["a"], p["b"]) for p in every} == {(a, b) for a in (1, 2, 3) for b in "xy"}
    assert L.drawn(space, 2) == every[:2] and L.drawn(space, 6, 1) != every


def test_random_search_selects_the_first_best(frame):
    folds = P.chronological_folds(frame, 2, 3)
    table = L.random_search(frame, folds, [{"alpha": 1e7}, {"alpha": 1.0}, {"alpha": 1.0}], lambda alpha: L.ridge(S.FEATURES, alpha))
    assert [r["selected"] for r in table] == [False, True, False] and [r["configuration"] for r in table] == [1, 2, 3]
    single = L.chronological_cv(frame, folds, lambda: L.ridge(S.FEATURES, 1.0))
    assert table[1]["cv_rmse"] == pytest.approx(L.mean_rmse(single)) and table[1]["folds"] == 2


def test_ridge_query_takes_the_penalty_of_the_grid(spark, monkeypatch):
    """Where the label is noise, ten is not the best penalty of the grid; the query must find what fitting every penalty on every fold finds."""
    from types import SimpleNamespace

    from tallyridge.operators import gram as R
    from tallyridge.plans import catalog, learning

    rng = np.random.default_rng(5)
    rows = [(datetime(2024, 1, 1) + timedelta(hours=i), float(rng.integers(40, 60)), "NYC") for i in range(31 * 24)]
    v = SimpleNamespace(hourly=spark.createDataFrame(rows, "timestamp timestamp_ntz, rides double, area string").cache())
    used, ridge = [], L.ridge
    monkeypatch.setattr(L, "ridge", lambda columns, alpha=10.0: used.append(alpha) or ridge(columns, alpha))
    facts = catalog._PLANS["model_ridge"](v).first()
    assert facts.rows == facts.usable_predictions == 7 * 24 and len(used) == 1
    _rows, train, _valid = learning.frame(v)
    with L.held(train) as known:
        folds = P.chronological_folds(known, learning.GRID_FOLDS, learning.GRID_FOLD_DAYS)
        errors = {p: L.mean_rmse(L.chronological_cv(known, folds, lambda p=p: ridge(S.FEATURES, p))) for p in (R.PENALTIES[0], 10.0, used[0], R.PENALTIES[-1])}
        few = learning.chosen_penalty(known.where("day < timestamp_ntz'2024-01-16'"), S.FEATURES)
    assert used[0] in R.PENALTIES and min(errors, key=errors.get) == used[0] and few == 10.0


@pytest.mark.parametrize("top", [3, 60, 10**6])
def test_bit_sets_count_equal_leaves_of_all_pairs(monkeypatch, top):
    """Several parts of known profiles and of queries, hot and rare leaves, leaves nobody has, rows that stand for many."""
    monkeypatch.setattr(X, "KNOWN_AT_ONCE", 100)
    monkeypatch.setattr(X, "QUERIES_AT_ONCE", 7)
    rng = np.random.default_rng(top)
    known, asked = (rng.integers(0, top, (n, 37)) for n in (330, 40))
    asked[:30, :20] = known[:30, :20]
    asked[31] = -5
    rows = rng.integers(1, 4, len(known))
    for k in (1, 12, 5000):
        q, r, m = X._matches(known, asked, rows, k)
        got = {(int(a), int(b)): int(c) for a, b, c in zip(q, r, m)}
        equal = (asked[:, None] == known[None]).sum(2)
        want = {}
        for i, line in enumerate(equal):
            order = np.argsort(-line, kind="stable")
            upto = np.searchsorted(np.cumsum(rows[order]), k)
            floor = max(line[order[upto]], 1) if upto < len(order) else 1
            want |= {(i, int(j)): int(line[j]) for j in np.flatnonzero(line >= floor)}
        assert got == want and len(got) == len(q)


def test_larger_proximity_forests_are_grown_whole_in_tasks(spark, monkeypatch):
    from pyspark.ml.classification import RandomForestClassifier

    monkeypatch.setattr(X, "ROWS_ALONE", 10)
    sizes, fit = [], RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, df, *a: sizes.append(df.count()) or fit(self, df, *a))
    model = X.fit_proximity_forest(study(spark), "row_id", ["size"], ["kind"], trees=6, depth=4)
    assert sizes == [2]  # the library saw one empty row per class, for the form of the model
    profiles = [r.profile for r in X.leaf_profiles(model, study(spark), ["row_id"]).collect()]
    assert len(profiles) == 240 and {len(p) for p in profiles} == {6} and len(set(map(tuple, profiles))) > 3
