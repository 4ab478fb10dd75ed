"""Classifiers on Spark ML, their comparison and their use."""

from __future__ import annotations

import dataclasses
import itertools
import random
from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    OneVsRest,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import store
from .columns import class_labels
from .forest import Forest, ForestModel, Growth
from .metrics import accuracy, macro_f1
from .split import row_uniform, stratified_kfold

# The search grid; a depth of None is no limit.
SEARCH_GRID = {
    "numTrees": (100, 200, 300, 500),
    "maxDepth": (10, 20, 30, 50, None),
    "minSamplesSplit": (2, 5, 10),
    "minInstancesPerNode": (1, 2, 4),
    "featureSubsetStrategy": ("sqrt", "log2", 0.1, 0.2),
}
SEARCH_ITERATIONS, SEARCH_FOLDS = 30, 3

_GROWTH_NAMES = {
    "numTrees": "trees", "maxDepth": "max_depth", "minSamplesSplit": "min_split", "minInstancesPerNode": "min_leaf",
    "featureSubsetStrategy": "max_features", "bootstrap": "bootstrap", "seed": "seed",
}


def _forest(features: str, label: str, drawn: bool, settings: Mapping[str, object]) -> Forest:
    return Forest(Growth(drawn=drawn, **{_GROWTH_NAMES[k]: v for k, v in settings.items()}), features, label)


def logit(features: str = "features", label: str = "label", n_train: int | None = None, **params) -> LogisticRegression:
    """Multinomial logistic regression, 1000 iterations, unscaled L2 penalty of strength 1.

    The penalty of 1 on the summed loss is ``1 / n_train`` on the mean loss; without ``n_train``
    there is no penalty.
    """
    settings = {
        "family": "multinomial", "maxIter": 1000, "standardization": False,
        "regParam": 1.0 / n_train if n_train else 0.0, **params,
    }
    return LogisticRegression(featuresCol=features, labelCol=label, **settings)


def random_forest(features: str = "features", label: str = "label", **params) -> Forest:
    """300 trees, depth 20, at least 5 rows per leaf."""
    return _forest(features, label, False, {"numTrees": 300, "maxDepth": 20, "minInstancesPerNode": 5, "seed": 42, **params})


def random_forest_serving(features: str = "features", label: str = "label", **params) -> Forest:
    """100 trees without a limit of depth."""
    return _forest(features, label, False, {"numTrees": 100, "maxDepth": None, "seed": 1, **params})


def extra_trees(features: str = "features", label: str = "label", **params) -> Forest:
    """500 extremely randomised trees, depth 20, 5 rows per leaf, every tree on all rows: a node draws one threshold for each
    of its features, between their smallest and greatest values there, and takes the best."""
    settings = {"numTrees": 500, "maxDepth": 20, "minInstancesPerNode": 5, "bootstrap": False, "seed": 42, **params}
    return _forest(features, label, True, settings)


def decision_tree(features: str = "features", label: str = "label", **params) -> DecisionTreeClassifier:
    """Depth 15, at least 10 rows per leaf."""
    settings = {"maxDepth": 15, "minInstancesPerNode": 10, "seed": 42, **params}
    return DecisionTreeClassifier(featuresCol=features, labelCol=label, **settings)


def gradient_boosting(features: str = "features", label: str = "label", **params) -> OneVsRest:
    """300 rounds, depth 5, rate 0.05; one binary model per class, as the library's is binary."""
    settings = {"maxIter": 300, "maxDepth": 5, "stepSize": 0.05, "seed": 42, **params}
    return OneVsRest(classifier=GBTClassifier(**settings), featuresCol=features, labelCol=label)


def dummy_stratified(train: DataFrame, test: DataFrame, label: str, id_col: str, seed: int = 42) -> DataFrame:
    """Add ``prediction``: a class drawn by its share in training, from the hash of the row id."""
    classes = class_labels(train, label)
    shares = train.where(F.col(label).isNotNull()).agg(
        *[F.avg((F.col(label) <= F.lit(c)).cast("int")) for c in classes]
    ).first()  # one cumulative share per class
    u = row_uniform(id_col, seed)
    drawn = F.coalesce(*[F.when(u < F.lit(s), F.lit(c)) for c, s in zip(classes, shares)])
    return test.withColumn("prediction", drawn)


@dataclasses.dataclass
class SearchResult:
    """The best point's forest on all training rows, the points tried and the mean macro F1 of each."""

    bestModel: ForestModel
    points: list[dict]
    avgMetrics: list[float]


def random_forest_search(
    train: DataFrame,
    id_col: str,
    grid: Mapping[str, Sequence[object]] = SEARCH_GRID,
    *,
    n_iter: int = SEARCH_ITERATIONS,
    folds: int = SEARCH_FOLDS,
    seed: int = 1,
    features: str = "features",
    label: str = "label",
) -> SearchResult:
    """Best forest of ``n_iter`` random grid points by cross-validated macro F1, refitted on all training rows; of equal
    points the first drawn."""
    points = [dict(zip(grid, p)) for p in itertools.product(*grid.values())]
    drawn = random.Random(seed).sample(points, min(n_iter, len(points)))
    folded = store(stratified_kfold(train, label, id_col, folds, seed, output="__fold"))
    means = []
    for point in drawn:
        forest = _forest(features, label, False, {"seed": seed, **point})
        scores = []
        for i in range(folds):
            scored = forest.fit(folded.where(F.col("__fold") != i)).transform(folded.where(F.col("__fold") == i))
            scores.append(float(macro_f1(scored, label, "prediction").first()[0]))
        means.append(sum(scores) / folds)
    best = drawn[means.index(max(means))]
    return SearchResult(_forest(features, label, False, {"seed": seed, **best}).fit(train), drawn, means)


def cv_score(
    df: DataFrame, estimator: Estimator, id_col: str, label: str = "label", k: int = 5, seed: int = 42
) -> DataFrame:
    """``(folds, mean_accuracy, std_accuracy)`` over class-balanced folds."""
    folded = stratified_kfold(df, label, id_col, k, seed, output="__fold").persist()
    try:
        scores = []
        for i in range(k):
            model = estimator.fit(folded.where(F.col("__fold") != i))
            held_out = model.transform(folded.where(F.col("__fold") == i))
            scores.append(accuracy(held_out, label, "prediction").first()[0])
    finally:
        folded.unpersist()
    values = df.sparkSession.createDataFrame([(float(s),) for s in scores], "score double")
    return values.agg(
        F.count("score").alias("folds"),
        F.avg("score").alias("mean_accuracy"),
        F.stddev_pop("score").alias("std_accuracy"),
    )


def compare_models(
    train: DataFrame, test: DataFrame, estimators: Mapping[str, Estimator], label: str = "label",
    id_col: str | None = None, k: int = 0,
) -> DataFrame:
    """Test accuracy per model, best first; with ``k`` also the cross-validated mean and spread."""
    out = None
    for name, estimator in estimators.items():
        scored = estimator.fit(train).transform(test)
        row = accuracy(scored, label, "prediction").select(F.lit(name).alias("model"), "accuracy")
        if k:
            cv = cv_score(train, estimator, id_col, label, k).withColumn("model", F.lit(name))
            row = row.join(cv, "model")
        out = row if out is None else out.unionByName(row)
    return out.orderBy(F.desc("accuracy"), "model")


def predict(model: Model, df: DataFrame) -> DataFrame:
    """Add ``prediction`` and, where the model has probabilities, ``probability`` as an array."""
    out = model.transform(df)
    if "probability" in out.columns:
        out = out.withColumn("probability", vector_to_array("probability"))
    return out.drop("rawPrediction").withColumn("prediction", F.col("prediction").cast("int"))


def score_report(scored: DataFrame, prediction: str = "prediction", label: str | None = None) -> DataFrame:
    """Rows per predicted class, and with labels the correct ones and their share."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if label:
        hit = F.coalesce(F.col(label) == F.col(prediction), F.lit(False))
        aggs += [F.count_if(hit).alias("correct"), F.avg(hit.cast("int")).alias("accuracy")]
    return scored.groupBy(prediction).agg(*aggs)


def batch_score(model: Model, df: DataFrame, label: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Predicted rows (with ``correct`` when there are labels) and the report per class."""
    scored = predict(model, df)
    if label:
        scored = scored.withColumn(
            "correct", F.coalesce(F.col(label) == F.col("prediction"), F.lit(False))
        )
    return scored, score_report(scored, "prediction", label)


def feature_importance(model: Model, features: Sequence[str], k: int | None = None) -> DataFrame:
    """``(feature, importance)``, highest first; ``k`` keeps the top."""
    spark_rows = [(f, float(model.featureImportances[i])) for i, f in enumerate(features)]
    out = SparkSession.active().createDataFrame(spark_rows, "feature string, importance double")
    out = out.orderBy(F.desc("importance"), "feature")
    return out if k is None else out.limit(k)
