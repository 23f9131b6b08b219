import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyridge.functions.hashing import hash_bucket, md5_key
from tallyridge.functions.numeric import order_bin
from tallyridge.operators.prefix import exact_rank, running_totals, value_profile


def skewed(n=3000, seed=5):
    rng = np.random.default_rng(seed)
    group = np.where(rng.random(n) < 0.7, "hot", rng.choice(list("abc"), n))
    value = np.round(np.where(rng.random(n) < 0.3, 7.25, rng.normal(0, 100, n)), 2)
    value[rng.random(n) < 0.05] = np.nan
    return pd.DataFrame({"id": np.arange(n), "g": group, "v": value})


@pytest.mark.parametrize("value", [0.0, 1e-300, -1e-300, 0.1, 0.125, 1.0, 1.9999999999, 2.0, 1024.0, 1e300, -5.5, float("inf"), float("-inf")])
def test_order_bin_is_monotone_around(spark, value):
    near = sorted({value, np.nextafter(value, np.inf), np.nextafter(value, -np.inf), value * 1.001 if np.isfinite(value) else value})
    rows = spark.createDataFrame([(float(x),) for x in near], "x double").select("x", order_bin(F.col("x")).alias("b")).toPandas().sort_values("x")
    assert rows.b.is_monotonic_increasing


def test_order_bin_is_monotone_on_random_values(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 1, 2000), rng.lognormal(0, 20, 2000), -rng.lognormal(0, 20, 2000), 2.0 ** np.arange(-50, 50)])
    rows = spark.createDataFrame(pd.DataFrame({"x": x})).select("x", order_bin(F.col("x")).alias("b")).toPandas().sort_values("x")
    assert rows.b.is_monotonic_increasing


def test_value_profile_equals_pandas(spark):
    pdf = skewed()
    df = spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    got = value_profile(df, ["g"], "v", {"q25": 0.25, "q50": 0.5, "q99": 0.99}).toPandas().set_index("g")
    for g, part in pdf.groupby("g"):
        assert got.loc[g, "rows"] == len(part)
        assert got.loc[g, "valid"] == part.v.notna().sum()
        for name, p in (("q25", 0.25), ("q50", 0.5), ("q99", 0.99)):
            assert got.loc[g, name] == pytest.approx(part.v.quantile(p), abs=1e-9)
        assert got.loc[g, "mean"] == pytest.approx(part.v.mean())
        assert got.loc[g, "sd"] == pytest.approx(part.v.std())
        assert (got.loc[g, "minimum"], got.loc[g, "maximum"]) == (part.v.min(), part.v.max())


def test_value_profile_of_one_value_and_of_none(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", None)], "g string, v double")
    got = {r.g: r for r in value_profile(df, ["g"], "v", {"m": 0.5}).collect()}
    assert got["a"].m == 3.0 and got["a"].sd is None
    assert got["b"].m is None and got["b"].rows == 1 and got["b"].valid == 0


def test_exact_rank_equals_one_sort(spark):
    pdf = skewed()
    df = spark.createDataFrame(pdf).withColumn("k", md5_key(F.col("id"), "s"))
    got = exact_rank(df, ["g"], ["k", "id"], hash_bucket(F.col("k"))).toPandas()
    want = got.sort_values("k").groupby("g").cumcount() + 1
    assert (got["rank"] == want.reindex(got.index)).all()
    assert (got.groupby("g")["rank_of"].nunique() == 1).all()
    assert (got.groupby("g").size() == got.groupby("g")["rank_of"].first()).all()


def test_running_totals_descending_with_null_keys(spark):
    df = spark.createDataFrame([(None, 1.0, 2), (None, 2.0, 3), ("x", 5.0, 7)], "g string, v double, n long")
    rows = running_totals(df, ["g"], "v", ["n"], order_bin(F.col("v")), descending=True).orderBy("g", "v").collect()
    assert [(r.g, r.v, r.n_cum, r.n_all) for r in rows] == [(None, 1.0, 5, 5), (None, 2.0, 3, 5), ("x", 5.0, 7, 7)]
