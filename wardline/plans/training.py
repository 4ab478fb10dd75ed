"""Training runs: split, fit features, fit model, score."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.bias import BIAS_GROUPS, BiasGroup, BiasModel, apply_bias_features, fit_bias_features
from ..operators.columns import label_encode, select_feature_vector
from ..operators.encoders import (
    target_encode_apply,
    target_encode_fit,
    target_encode_full,
    target_means,
)
from ..operators.lookup import not_in_set
from ..operators.metrics import accuracy
from ..operators.models import extra_trees, predict
from ..operators.split import stratified_split, train_test
from ..session import materialize
from .ports import ENCODED_PORTS, PORT_FEATURES, ports_features
from .preprocess import serving_preprocess


@dataclass
class TrainedModel:
    """A fitted classifier, the classes by code, its features, and the scored test rows."""

    model: Model
    classes: DataFrame
    features: list[str]
    predictions: DataFrame
    side: dict[str, DataFrame]
    bias: BiasModel | None = None


def train_bias_classifier(
    df: DataFrame,
    target: str,
    id_col: str,
    estimator: Callable[[int], Estimator],
    *,
    groups: Sequence[BiasGroup] = BIAS_GROUPS,
    only: Sequence[str] | None = None,
    test_share: float = 0.1,
    seed: int = 50,
    n_obs: int = 15,
    fit_on_all: bool = False,
    **settings,
) -> TrainedModel:
    """Classifier on bias levels. ``estimator`` gets the number of training rows.

    Bins and crosstabs come from the training rows. ``fit_on_all`` takes them from all rows, as in
    earlier tooling, which leaks the class of the test rows into their features.
    """
    labelled, classes = label_encode(df, target)
    flagged = stratified_split(labelled, target, id_col, test_share, seed)
    keep = [id_col, "label", "is_test"]
    if fit_on_all:
        rows, bias = fit_bias_features(flagged, target, groups, n_obs=n_obs, only=only, **settings)
        train_rows, test_rows = rows.where(~F.col("is_test")), rows.where("is_test")
    else:
        train_rows, bias = fit_bias_features(
            flagged.where(~F.col("is_test")), target, groups, n_obs=n_obs, only=only, **settings
        )
        test_rows = apply_bias_features(flagged.where("is_test"), bias)
    train = materialize(select_feature_vector(train_rows, bias.feature_columns, keep))
    test = select_feature_vector(test_rows, bias.feature_columns, keep)
    model = estimator(train.count()).fit(train)
    return TrainedModel(model, classes, bias.feature_columns, predict(model, test), {}, bias)


def train_ports_model(
    df: DataFrame,
    target: str,
    id_col: str,
    estimator: Estimator | None = None,
    *,
    test_share: float = 0.2,
    seed: int = 42,
    full_ports: bool = False,
) -> TrainedModel:
    """Port model with the fixed feature list, scored on the held-out rows."""
    labelled, classes = label_encode(df, target)
    rows = ports_features(labelled, "label", id_col, seed=seed, full_ports=full_ports)
    vectors = select_feature_vector(rows, PORT_FEATURES, [id_col, target, "label"])
    vectors = materialize(stratified_split(vectors, "label", id_col, test_share, seed))
    model = (estimator or extra_trees()).fit(vectors.where(~F.col("is_test")))
    means = target_means(labelled, ENCODED_PORTS, "label")
    side = {
        "src_port_means": means.where(F.col("feature") == "Source Port").select("value", "te"),
        "dst_port_means": means.where(F.col("feature") == "Destination Port").select("value", "te"),
        "classes": classes,
    }
    return TrainedModel(model, classes, list(PORT_FEATURES), predict(model, vectors.where("is_test")), side)


def serving_bias_features(df: DataFrame, trained: TrainedModel, keep: Sequence[str] = ()) -> DataFrame:
    """Raw new rows to the feature vector of a bias classifier."""
    scored = apply_bias_features(serving_preprocess(df), trained.bias)
    return select_feature_vector(scored, trained.features, keep)


def leakage_comparison(
    df: DataFrame, cols: Sequence[str], target: str, id_col: str, estimator: Estimator, *,
    p: float = 0.2, seed: int = 42,
) -> DataFrame:
    """Same model twice: encoded on all rows before the split, and on training rows only.

    ``(approach, accuracy, unseen_pct)``; the last is the share of test rows with some unseen key,
    averaged over the columns.
    """
    features = [f"{c}_te" for c in cols]
    rows = df.select(id_col, target, *cols).withColumn("label", F.col(target))

    train, test = train_test(rows, target, id_col, p, seed)
    before = target_encode_full(rows, cols, target)
    leaky_train, leaky_test = train_test(before, target, id_col, p, seed)
    means, overall = target_encode_fit(train, cols, target)
    clean = [target_encode_apply(part, means, overall, cols) for part in (train, test)]

    unseen = [not_in_set(test, train, c).select("pct") for c in cols]
    share = unseen[0]
    for u in unseen[1:]:
        share = share.unionByName(u)
    unseen_pct = share.agg(F.avg("pct")).scalar()

    out = None
    for name, parts, pct in (
        ("all_rows", (leaky_train, leaky_test), F.lit(0.0)),
        ("train_only", clean, unseen_pct),
    ):
        fit_rows, score_rows = [select_feature_vector(x, features, ["label"]) for x in parts]
        scored = estimator.fit(fit_rows).transform(score_rows)
        row = accuracy(scored, "label", "prediction").select(
            F.lit(name).alias("approach"), "accuracy", pct.alias("unseen_pct")
        )
        out = row if out is None else out.unionByName(row)
    return out
