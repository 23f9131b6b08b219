"""Training, tuning and scoring on MLlib with the operators' data rules."""

from __future__ import annotations

import hashlib
import heapq
import json
import math
from collections.abc import Callable, Iterable
from contextlib import contextmanager
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, GeneralizedLinearRegression,
                                   LinearRegression, RandomForestRegressor)
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyridge.operators import features as E
from tallyridge.operators import forest
from tallyridge.operators.boosting import BoostedTrees
from tallyridge.operators.metrics import cells, rates
from tallyridge.operators.scoring import operational
from tallyridge.operators.splits import shuffled_rank, training_window
from tallyridge.operators.summaries import regression_metrics

SEED = 42


ROWS_PER_TASK = 250_000


def dealt_out(df: DataFrame) -> DataFrame:
    """Rows over at least as many partitions as there are cores: adaptive execution would merge a small table into one
    partition, and trees are grown and rows scored by one task per partition."""
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS_PER_TASK))
    return df.repartition(parts)


@contextmanager
def held(df: DataFrame, trees: bool = False):
    """Keep a training frame in memory or on disk while several fits read it; for ``trees`` dealt out over the cores."""
    df = (dealt_out(df) if trees else df).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


# ---------------------------------------------------------------- pipeline parts


def _param(name: str, doc: str, kind) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=kind)


class ZeroToNull(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Zero measurements become unknown."""

    columns = _param("columns", "measures", TypeConverters.toListString)

    def __init__(self, columns=("stem_height", "stem_width")):
        super().__init__()
        self._set(columns=list(columns))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns({c: F.nullif(F.col(c), F.lit(0.0)) for c in self.getOrDefault(self.columns)})


class Geometry(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the two shape ratios."""

    names = _param("names", "columns of cap diameter, stem height and stem width", TypeConverters.toListString)

    def __init__(self, cap="cap_diameter", height="stem_height", width="stem_width"):
        super().__init__()
        self._set(names=[cap, height, width])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return E.geometry(dataset, *self.getOrDefault(self.names))


class DropColumns(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Hides columns from the model without asking callers to leave them out."""

    columns = _param("columns", "columns to hide", TypeConverters.toListString)

    def __init__(self, columns=()):
        super().__init__()
        self._set(columns=list(columns))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return E.column_subset(dataset, self.getOrDefault(self.columns))


class FittedImputer(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Training medians for measures; training mode or a constant level for categories."""

    measures = _param("measures", "numeric columns", TypeConverters.toListString)
    categories = _param("categories", "text columns", TypeConverters.toListString)
    constant = _param("constant", "level of unknown categories", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, measures=(), categories=(), constant=None):
        super().__init__()
        self._set(measures=list(measures), categories=list(categories), **({} if constant is None else {"constant": constant}))

    def _fit(self, dataset: DataFrame) -> "FittedImputerModel":
        values: dict = {}
        measures, categories = (self.getOrDefault(p) for p in (self.measures, self.categories))
        if measures:
            values |= {r["column"]: r["median"] for r in E.fitted_medians(dataset, measures).collect()}
        if self.isDefined(self.constant):
            values |= {c: self.getOrDefault(self.constant) for c in categories}
        elif categories:
            values |= {r["column"]: r["mode"] for r in E.modes(dataset, categories).collect()}
            values |= {c: "missing" for c in categories if c not in values}
        return FittedImputerModel(values)


class FittedImputerModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """The fitted values, one per column, as a JSON parameter."""

    values = _param("values", "fill value of each column, as JSON", TypeConverters.toString)

    def __init__(self, values: dict | None = None):
        super().__init__()
        self._set(values=json.dumps(values or {}))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.fillna({k: v for k, v in json.loads(self.getOrDefault(self.values)).items() if v is not None})


class Operational(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Clips a column of predictions at zero, makes it zero in the clock gap, and drops the columns in between."""

    source = _param("source", "column of raw predictions", TypeConverters.toString)
    output = _param("output", "column of the final predictions", TypeConverters.toString)

    def __init__(self, source="prediction", output="predicted_rides"):
        super().__init__()
        self._set(source=source, output=output)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        source = self.getOrDefault(self.source)
        out = dataset.withColumn(self.getOrDefault(self.output), operational(F.col(source), F.col("clock_hours")))
        return out.drop("prediction", "features", "raw_features")


class RidgeRegression(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Least squares with the L2 weight ``alpha`` on the whole sum of squares. The library's own weight is per row and
    per standard deviation of the label, so ``alpha`` is converted to that."""

    alpha = _param("alpha", "L2 weight of the whole sum of squares", TypeConverters.toFloat)
    label = _param("label", "column to learn", TypeConverters.toString)

    def __init__(self, alpha: float = 10.0, label: str = "rides"):
        super().__init__()
        self._set(alpha=alpha, label=label)

    def _fit(self, dataset: DataFrame) -> Model:
        facts = dataset.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(self.getOrDefault(self.label)).alias("sd")).first()
        weight = self.getOrDefault(self.alpha) * (facts["sd"] or 1.0) / max(facts["n"], 1)
        return LinearRegression(labelCol=self.getOrDefault(self.label), elasticNetParam=0.0, regParam=weight, standardization=False).fit(dataset)


class MeanProbability(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Probability and class of a whole forest from those of its parts, which are dropped."""

    weights = _param("weights", "trees of each part", TypeConverters.toListInt)

    def __init__(self, weights=()):
        super().__init__()
        self._set(weights=list(weights))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        weights = self.getOrDefault(self.weights)

        def weighted(column: str, weight: int) -> Column:
            return F.transform(vector_to_array(column), lambda p: p * weight)

        total = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), [weighted(part_column(i), w) for i, w in enumerate(weights)])
        mean = F.transform(total, lambda x: x / sum(weights))
        out = dataset.withColumn("__mean", mean).drop(*[part_column(i) for i in range(len(weights))])
        likeliest = (F.array_position("__mean", F.array_max("__mean")) - 1).cast("double")
        return out.withColumns({"probability": array_to_vector("__mean"), "prediction": likeliest}).drop("__mean")


def part_column(i: int) -> str:
    return f"__probability_{i}"


TREES_PER_PART = 10


class ForestClassifier(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """A random forest grown tree by tree: every task holds the binned rows and learns whole trees from bootstraps of them
    (``operators/forest.py``). Tables too large for that are left to the library, as several smaller forests with seeds of
    their own, side by side. Fitted, it is a pipeline of parts of the forest and their mean, which can be saved and loaded."""

    trees = _param("trees", "number of trees", TypeConverters.toInt)
    depth = _param("depth", "levels of splits", TypeConverters.toInt)
    memory = _param("memory", "MB of statistics per pass", TypeConverters.toInt)

    def __init__(self, numTrees: int = 300, maxDepth: int = 20, maxMemoryInMB: int = 1024):
        super().__init__()
        self._set(trees=numTrees, depth=maxDepth, memory=maxMemoryInMB)

    def _forest(self, trees: int, seed: int, column: str) -> RandomForestClassifier:
        return RandomForestClassifier(labelCol="y", weightCol="weight", seed=seed, numTrees=trees, maxDepth=self.getOrDefault(self.depth),
                                      maxMemoryInMB=self.getOrDefault(self.memory), featureSubsetStrategy="sqrt" if self.getOrDefault(self.trees) > 1 else "all",
                                      rawPredictionCol="", predictionCol="", probabilityCol=column)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        trees = self.getOrDefault(self.trees)
        shares = [min(TREES_PER_PART, trees - at) for at in range(0, trees, TREES_PER_PART)]
        whole = forest.fitted(self._forest(trees, SEED, part_column(0)), dataset)
        if whole is None:
            parts = self._by_levels(dataset, shares)
        else:
            parts = [part.setProbabilityCol(part_column(i)) for i, part in enumerate(forest.parts_of(whole, shares))]
        return PipelineModel([*parts, MeanProbability(shares)])

    def _by_levels(self, dataset: DataFrame, shares: list[int]) -> list[Model]:
        """Every partition sends statistics of all nodes, and deep forests have millions. So the table is only cut where
        its size asks for it, and the cores work on different parts."""
        spark = dataset.sparkSession
        cuts = max(1, -(-dataset.count() // ROWS_PER_TASK))
        with held(dataset.select("features", "y", "weight").repartition(cuts)) as rows:
            with ThreadPool(max(1, min(16, spark.sparkContext.defaultParallelism // cuts))) as pool:
                return pool.map(inheritable_thread_target(spark)(lambda i: self._forest(shares[i], SEED + i, part_column(i)).fit(rows)), range(len(shares)), chunksize=1)


def operational_regressor(stages, output: str = "predicted_rides") -> Pipeline:
    """The stages and the rules that make their predictions operational; fitted, it can be saved and loaded."""
    return Pipeline(stages=[*stages, Operational("prediction", output)])


def seasonal_naive(output: str = "predicted_rides") -> Pipeline:
    """Last week's value; nothing to learn."""
    return Pipeline(stages=[Operational("lag_7d", output)])


class MacroF1(Evaluator):
    """Macro F1 of 0/1 predictions, computed from the four cells."""

    def __init__(self, label="y", prediction="prediction"):
        super().__init__()
        self.label, self.prediction = label, prediction

    def _evaluate(self, dataset: DataFrame) -> float:
        four = dataset.agg(*[e.alias(k) for k, e in cells(F.col(self.label), F.col(self.prediction)).items()])
        return float(four.select(rates(*[F.col(c) for c in ("tn", "fp", "fn", "tp")])["macro_f1"].alias("f")).first().f)

    def isLargerBetter(self) -> bool:
        return True


# ---------------------------------------------------------------- estimators


def assembled(columns) -> list:
    return [VectorAssembler(inputCols=list(columns), outputCol="features")]


def scaled(columns) -> list:
    return [VectorAssembler(inputCols=list(columns), outputCol="raw_features"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)]


def ridge(columns, alpha: float = 10.0, label: str = "rides") -> Pipeline:
    """Squared loss with L2 weight ``alpha`` spread over the rows of each fit, on scaled features."""
    return operational_regressor([*scaled(columns), RidgeRegression(alpha, label)])


def forest_regressor(columns, trees: int = 160, depth: int = 16, leaf: int = 8, share: str = "0.8", label: str = "rides") -> Pipeline:
    model = RandomForestRegressor(labelCol=label, numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf,
                                  featureSubsetStrategy=share, seed=SEED, maxMemoryInMB=512)
    return operational_regressor([*assembled(columns), model])


def boosted_regressor(columns, rounds: int = 250, depth: int = 5, step: float = 0.05, leaf: int = 40, loss: str = "squared", label: str = "rides") -> Pipeline:
    model = GBTRegressor(labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=step, minInstancesPerNode=leaf, lossType=loss, seed=SEED)
    return operational_regressor([*assembled(columns), model])


def boosted_trees(columns, loss: str, rounds: int = 250, depth: int = 5, step: float = 0.05, leaf: int = 40, label: str = "rides") -> Pipeline:
    """Boosting with the library's own loop: counts (``poisson``) or robust errors (``huber``)."""
    return operational_regressor([*assembled(columns), BoostedTrees(loss, rounds, depth, step, leaf, label=label)])


def poisson_regressor(columns, label: str = "rides") -> Pipeline:
    return operational_regressor([*scaled(columns), GeneralizedLinearRegression(labelCol=label, family="poisson", link="log", regParam=0.01)])


def huber_regressor(columns, label: str = "rides") -> Pipeline:
    return operational_regressor([*scaled(columns), LinearRegression(labelCol=label, loss="huber", standardization=False)])


def tree_regressor(columns, depth: int = 5, leaf: int = 8, label: str = "rides") -> Pipeline:
    return operational_regressor([*assembled(columns), DecisionTreeRegressor(labelCol=label, maxDepth=depth, minInstancesPerNode=leaf, seed=SEED)])


def encoders(measures, categories, unknown: str | None = None) -> list:
    """Impute, index and one-hot encode; levels unseen in training get their own slot."""
    return [
        FittedImputer(measures=measures, categories=categories, constant=unknown),
        StringIndexer(inputCols=list(categories), outputCols=[f"{c}_ix" for c in categories], handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=[f"{c}_ix" for c in categories], outputCols=[f"{c}_hot" for c in categories], dropLast=False),
        VectorAssembler(inputCols=[*measures, *[f"{c}_hot" for c in categories]], outputCol="features"),
    ]


def balanced_weight(df: DataFrame, label: str = "y", name: str = "weight") -> DataFrame:
    """Weight n / (2 n_class) per row."""
    n = df.agg(F.count(F.lit(1))).scalar()
    positives = df.agg(F.count_if(F.col(label) == 1)).scalar()
    own = F.when(F.col(label) == 1, positives).otherwise(n - positives)
    return df.withColumn(name, n / (own * 2.0))


CLASSIFIERS: dict[str, Callable[..., Estimator]] = {
    "random_forest": lambda **k: ForestClassifier(**k),
    "boosted": lambda **k: GBTClassifier(labelCol="y", seed=SEED, **{"maxIter": 200, "maxDepth": 3, "stepSize": 0.1, "subsamplingRate": 0.8, **k}),
    "logistic": lambda **k: LogisticRegression(labelCol="y", weightCol="weight", **{"elasticNetParam": 1.0, "regParam": 0.001, "maxIter": 100, **k}),
    "decision_tree": lambda **k: DecisionTreeClassifier(labelCol="y", weightCol="weight", seed=SEED, **{"maxDepth": 5, **k}),
}


def classifier(name: str, measures, categories, before=(), unknown: str | None = None, **params) -> Pipeline:
    return Pipeline(stages=[*before, *encoders(measures, categories, unknown), CLASSIFIERS[name](**params)])


def positive_probability() -> Column:
    return vector_to_array(F.col("probability"))[1]


def score_classifier(model: PipelineModel, df: DataFrame, keep: Iterable[str]) -> DataFrame:
    """Whole-table probability and label; exactly one half goes to class 0."""
    return model.transform(df).select(*keep, positive_probability().alias("probability_p")).withColumn(
        "prediction", (F.col("probability_p") > 0.5).cast("int"))


# ---------------------------------------------------------------- tuning


def rmse_of(model: Model, rows: DataFrame, label: str = "rides", output: str = "predicted_rides") -> float:
    return float(regression_metrics(model.transform(rows), label, output).first().rmse)


def chronological_cv(frame: DataFrame, folds: DataFrame, estimator: Callable[[], Estimator], day: str = "day") -> list[dict]:
    """Fit and score per expanding fold; the fold table has one row per fold."""
    out = []
    for b in folds.orderBy("fold").collect():
        d = F.col(day)
        train = frame.where((d >= F.lit(b.train_start)) & (d < F.lit(b.train_end)))
        valid = frame.where((d >= F.lit(b.valid_start)) & (d < F.lit(b.valid_end)))
        out.append({"fold": b.fold, "rmse": rmse_of(estimator().fit(train), valid)})
    return out


def mean_rmse(scores: list[dict]) -> float:
    return sum(s["rmse"] for s in scores) / len(scores)


def best_configuration(frame: DataFrame, folds: DataFrame, options: dict[str, Callable[[], Estimator]]) -> list[dict]:
    """Mean fold RMSE per configuration, the first best marked."""
    with held(frame) as rows:
        table = [{"configuration": k, "cv_rmse": mean_rmse(chronological_cv(rows, folds, make))} for k, make in options.items()]
    best = min(r["cv_rmse"] for r in table)
    first = next(r["configuration"] for r in table if r["cv_rmse"] == best)
    return [{**r, "selected": r["configuration"] == first} for r in table]


def drawn(space: dict[str, list], n: int, seed=SEED) -> list[dict]:
    """``n`` different points of a product space: those with the smallest md5 of (place, seed), places counted with the
    last parameter running fastest. All points, if there are fewer."""
    names, sizes = list(space), [len(v) for v in space.values()]
    places = heapq.nsmallest(n, range(math.prod(sizes)), key=lambda i: (hashlib.md5(f"{i}|{seed}".encode()).hexdigest(), i))
    points = []
    for place in places:
        point = {}
        for name, size in zip(reversed(names), reversed(sizes)):
            place, at = divmod(place, size)
            point[name] = space[name][at]
        points.append({name: point[name] for name in names})
    return points


def random_search(frame: DataFrame, folds: DataFrame, points: list[dict], estimator: Callable[..., Estimator], parallelism: int | None = None) -> list[dict]:
    """Every point fitted and scored on every fold, several at once over one cached table; the first best is selected.

    The cores work on different fits, as many at once as there are cores (at most 16) unless ``parallelism`` says
    otherwise, so the table is only cut where its size asks for it: every further partition repeats the statistics of
    all nodes. Returns configuration (1-based), the point's parameters, folds, cv_rmse and selected."""
    bounds = folds.orderBy("fold").collect()  # a few folds
    parallelism = parallelism or min(16, frame.sparkSession.sparkContext.defaultParallelism)
    with held(frame.repartition(max(1, -(-frame.count() // ROWS_PER_TASK)))) as rows:

        def scored(job: tuple[dict, object]) -> float:
            point, b = job
            d = F.col("day")
            train = rows.where((d >= F.lit(b["train_start"])) & (d < F.lit(b["train_end"])))
            valid = rows.where((d >= F.lit(b["valid_start"])) & (d < F.lit(b["valid_end"])))
            return rmse_of(estimator(**point).fit(train), valid)

        jobs = [(point, b) for point in points for b in bounds]
        with ThreadPool(parallelism) as pool:
            errors = pool.map(inheritable_thread_target(frame.sparkSession)(scored), jobs, chunksize=1)
    means = [sum(errors[k * len(bounds):(k + 1) * len(bounds)]) / len(bounds) for k in range(len(points))]
    first = means.index(min(means)) if means else -1
    return [{"configuration": k + 1, **point, "folds": len(bounds), "cv_rmse": m, "selected": k == first} for k, (point, m) in enumerate(zip(points, means))]


def window_search(frame: DataFrame, cutoff: str, years, folds_of: Callable[[DataFrame], DataFrame], estimator: Callable[[], Estimator]) -> list[dict]:
    """Training length with the lowest mean fold RMSE."""
    table = []
    for y in years:
        with held(training_window(frame, cutoff, y)) as rows:
            table.append({"years": str(y or "all"), "cv_rmse": mean_rmse(chronological_cv(rows, folds_of(rows), estimator))})
    best = min(table, key=lambda r: r["cv_rmse"])["years"]
    return [{**r, "selected": r["years"] == best} for r in table]


def grid_search(pipeline: Pipeline, grid: list[dict], df: DataFrame, folds: int, fold: str = "cv_fold", parallelism: int = 2):
    """Grid over a declared fold column (0-based); returns the fitted cross-validator model."""
    cv = CrossValidator(estimator=pipeline, estimatorParamMaps=grid, evaluator=MacroF1(), numFolds=folds, foldCol=fold,
                        parallelism=parallelism, seed=SEED)
    with held(df) as rows:
        return cv.fit(rows)


def param_grid(**choices) -> list[dict]:
    builder = ParamGridBuilder()
    for param, values in choices.values():
        builder = builder.addGrid(param, values)
    return builder.build()


# ---------------------------------------------------------------- shuffles


def permuted_columns(df: DataFrame, row: str, columns, seed, suffix: str = "__perm") -> DataFrame:
    """Every column shuffled on its own, for all columns in one exchange.

    Rows get one shuffled rank; column j takes its value from the row a column-specific
    number of ranks away, so each column is a permutation of itself.
    """
    ranked = shuffled_rank(df, [], row, seed)
    moved = []
    for j, c in enumerate(columns):
        offset = F.conv(F.substring(F.md5(F.lit(f"{seed}|{c}|{j}")), 1, 7), 16, 10).cast("bigint")
        target = F.pmod(F.col("rank") - 1 + 1 + F.pmod(offset, F.greatest(F.col("rank_of") - 1, F.lit(1))), F.col("rank_of"))
        moved.append(F.struct(target.alias("to"), F.lit(c).alias("c"), F.col(c).cast("string").alias("v")))
    long = ranked.select(F.explode(F.array(*moved)).alias("m")).select("m.*")
    types = dict(df.dtypes)
    wide = long.groupBy("to").agg(*[F.max(F.when(F.col("c") == c, F.col("v"))).cast(types[c]).alias(f"{c}{suffix}") for c in columns])
    return ranked.withColumn("to", F.col("rank") - 1).hint("merge").join(wide, "to").drop("to", "rank", "rank_of")


def permutation_importance(model: Model, df: DataFrame, row: str, columns, repeats: int = 5, label: str = "rides", output: str = "predicted_rides") -> DataFrame:
    """RMSE increase when one feature is shuffled: mean and deviation over the repeats.

    All features of one repeat are scored in a single transform: each row is repeated
    once per feature with only that feature replaced.
    """
    runs = []
    for r in range(repeats):
        both = permuted_columns(df, row, columns, f"imp{r}")
        swaps = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), *[F.col(f"{c}__perm" if c == f else c).alias(c) for c in columns]) for f in columns])).alias("s")
        rest = [c for c in df.columns if c not in columns]
        runs.append(both.select(*rest, swaps).select(*rest, "s.*", F.lit(r).alias("run")))
    scored = model.transform(reduce(DataFrame.unionByName, runs))
    per = regression_metrics(scored, label, output, ["feature", "run"])
    base = rmse_of(model, df, label, output)
    return per.groupBy("feature").agg(F.avg(F.col("rmse") - base).alias("importance"), F.stddev_pop("rmse").alias("sd"))


def shuffled_labels(df: DataFrame, row: str, label: str, seed="control") -> DataFrame:
    """The label column shuffled over the rows: a negative control."""
    out = permuted_columns(df, row, [label], seed)
    return out.withColumn(label, F.col(f"{label}__perm")).drop(f"{label}__perm")


def as_vector(columns) -> Column:
    return array_to_vector(F.array(*[F.col(c).cast("double") for c in columns]))
