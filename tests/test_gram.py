from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from tallyridge.operators import gram as R
from tallyridge.operators import models as L
from tallyridge.operators import splits as P

COLUMNS = ["a", "b", "c", "flat"]


def frame(spark, days=220):
    rng = np.random.default_rng(12)
    rows = []
    for i in range(days):
        for h in range(3):
            a, b = rng.normal(), rng.normal() * 50 + 1000
            rows.append((datetime(2023, 1, 1) + timedelta(days=i), float(a), float(b), float(a * 0.5 + rng.normal()), 7.0, float(max(0, 20 + 4 * a - 0.1 * (b - 1000) + rng.normal())), 0 if i % 40 == 3 and h == 2 else 1))
    rows += [(datetime(2023, 2, 1), None, 1.0, 1.0, 7.0, 3.0, 1), (datetime(2023, 2, 1), 1.0, 1.0, 1.0, 7.0, None, 1)]
    return spark.createDataFrame(rows, "day timestamp_ntz, a double, b double, c double, flat double, rides double, clock_hours int")


def test_search_equals_fits_by_mllib(spark):
    df = frame(spark).cache()
    folds = P.chronological_folds(df, 3, 20)
    recent = P.chronological_folds(P.training_window(df, "2023-08-09", None).where("day >= timestamp_ntz'2023-03-01'"), 2, 20)
    got = {(r.plan, r.fold, r.subset, r.penalty): (r.rows, r.rmse) for r in R.search(df, {"all": folds, "recent": recent}, COLUMNS, {"all": COLUMNS[:3], "two": ["b", "a"]}, [0.01, 10.0, 1000.0]).collect()}
    assert len(got) == (3 + 2) * 2 * 3
    clean = df.dropna()
    for plan, table in (("all", folds), ("recent", recent)):
        for b in table.collect():
            train = clean.where((F.col("day") >= F.lit(b.train_start)) & (F.col("day") < F.lit(b.train_end)))
            valid = clean.where((F.col("day") >= F.lit(b.valid_start)) & (F.col("day") < F.lit(b.valid_end)))
            for subset, columns in (("all", COLUMNS[:3]), ("two", ["b", "a"])):
                for penalty in (0.01, 1000.0):
                    rmse = L.rmse_of(L.ridge(columns, penalty).fit(train), valid)
                    rows, ours = got[plan, b.fold, subset, penalty]
                    assert rows == valid.count() and ours == pytest.approx(rmse, abs=1e-6)


def test_weights_equal_linear_regression(spark):
    df = frame(spark, 60).dropna()
    grams = R.day_grams(df, COLUMNS)
    (intercept, weights), = grams.ridge(grams.between(datetime(2023, 1, 1), datetime(2023, 2, 20)), ["a", "b", "c"], [5.0])
    train = df.where("day < timestamp_ntz'2023-02-20'")
    fitted = Pipeline(stages=[*L.scaled(["a", "b", "c"]), L.RidgeRegression(5.0)]).fit(train)
    scale, line = fitted.stages[1], fitted.stages[2]
    plain = np.array(line.coefficients) / np.array(scale.std)
    assert weights[:3] == pytest.approx(plain.tolist(), abs=1e-6) and weights[3] == 0
    assert intercept == pytest.approx(line.intercept - float(plain @ np.array(scale.mean)), abs=1e-6)


def test_selection_ties_and_errors(spark):
    scores = spark.createDataFrame([("p", 1, "s", 1.0, 4, 2.0), ("p", 2, "s", 1.0, 4, 4.0), ("p", 1, "s", 0.5, 4, 3.0), ("p", 2, "s", 0.5, 4, 3.0), ("p", 1, "t", 9.0, 4, 9.0)],
                                   "plan string, fold int, subset string, penalty double, rows long, rmse double")
    table = {(r.subset, r.penalty): (r.folds, r.cv_rmse, r.selected) for r in R.mean_scores(scores).collect()}
    assert table == {("s", 1.0): (2, 3.0, False), ("s", 0.5): (2, 3.0, True), ("t", 9.0): (1, 9.0, False)}
    df = frame(spark, 30)
    with pytest.raises(ValueError, match="rows"):
        R.day_grams(df.where("a > 99"), COLUMNS)
    grams = R.day_grams(df, COLUMNS)
    with pytest.raises(ValueError, match="two rows"):
        grams.ridge(grams.between(datetime(2020, 1, 1), datetime(2020, 2, 1)), ["a"], [1.0])
