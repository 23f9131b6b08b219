import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyridge.operators import sketches as K
from tallyridge.operators import summaries as A


def table(spark, n=6000):
    rng = np.random.default_rng(4)
    rows = [(i % 5, int(rng.integers(0, 900)), None if i % 50 == 0 else float(rng.lognormal()), "ab"[i % 2]) for i in range(n)]
    return spark.createDataFrame(rows, "part int, key int, x double, g string")


def test_sketches_are_stored_merged_and_replaced(spark, tmp_path):
    df = table(spark)
    K.distinct_parts(df, "part", ["key", "g"]).write.partitionBy("part").parquet(str(tmp_path / "d"))
    stored = spark.read.parquet(str(tmp_path / "d"))
    for parts in ([0, 1, 2, 3, 4], [2], [1, 4]):
        got = {r["column"]: r["distinct"] for r in K.merged_distinct(stored.where(F.col("part").isin(parts))).collect()}
        exact = df.where(F.col("part").isin(parts)).agg(F.count_distinct("key").alias("key"), F.count_distinct("g").alias("g")).first()
        assert got["key"] == pytest.approx(exact.key, rel=0.05) and got["g"] == exact.g


def test_quantiles_from_parts_lie_within_the_rank_error(spark, tmp_path):
    df = table(spark)
    K.quantile_parts(df, "part", F.col("x"), ["g"]).write.parquet(str(tmp_path / "q"))
    got = K.merged_quantiles(spark.read.parquet(str(tmp_path / "q")), ["g"], {"q1": 0.25, "median": 0.5, "q99": 0.99}).collect()
    for r in got:
        values = np.array([x.x for x in df.where(F.col("g") == r.g).select("x").collect() if x.x is not None])
        assert r.rows == 3000 and r.valid == len(values)
        for share, value in ((0.25, r.q1), (0.5, r.median), (0.99, r.q99)):
            assert abs((values <= value).mean() - share) < 0.015


def test_groups_without_values_and_empty_tables(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 2.0, "b"), (2, None, "a")], "part int, x double, g string")
    got = {r.g: (r.rows, r.valid, r.m) for r in K.merged_quantiles(K.quantile_parts(df, "part", F.col("x"), ["g"]), ["g"], {"m": 0.5}).collect()}
    assert got == {"a": (2, 0, None), "b": (1, 1, 2.0)}
    assert K.merged_distinct(K.distinct_parts(df.limit(0), "part", ["g"])).count() == 0


def test_hexagons_take_the_nearest_centre(spark):
    rng = np.random.default_rng(3)
    points = [(float(a), float(b)) for a, b in zip(rng.uniform(0, 3, 500), rng.uniform(10, 14, 500))]
    df = spark.createDataFrame([*points, (None, 11.0), (float("nan"), 11.0)], "lat double, lng double")
    got = {(round(r.lat, 6), round(r.lng, 6)): r.n for r in A.hexagon_bins(df, "lat", "lng", (0, 3, 10, 14), 9).collect()}
    wide, high = 4 / 9, 3 / 5
    centres = [(j * high + s * high, 10 + i * wide + s * wide) for i in range(-1, 11) for j in range(-1, 7) for s in (0, 0.5)]
    want = {}
    for lat, lng in points:
        near = min(centres, key=lambda c: ((lng - c[1]) / wide) ** 2 + 3 * ((lat - c[0]) / high) ** 2)
        key = (round(near[0], 6), round(near[1], 6))
        want[key] = want.get(key, 0) + 1
    assert got == want
