"""Target encoding of categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, store
from .joins import attach, is_small
from .ordered import long_form
from .split import stratified_kfold


def _mean(df: DataFrame, target: str):
    return df.agg(F.avg(target).alias("m")).scalar()


def _join_codes(df: DataFrame, codes: DataFrame, cols: Sequence[str], extra: Sequence[str], suffix: str):
    """Join stored ``(feature, value, extra..., te)`` rows once per column."""
    out, small = df, is_small(codes) or None
    for c in cols:
        one = codes.where(F.col("feature") == c).select(
            F.col("value").alias("__v"), *extra, F.col("te").alias(f"{c}{suffix}")
        )
        keyed = out.withColumn("__v", F.col(f"`{c}`").cast("string"))
        out = attach(keyed, one, ["__v", *extra], small=small).drop("__v")
    return out


def target_encode_cv(
    df: DataFrame,
    cols: Sequence[str],
    target: str,
    id_col: str,
    n_splits: int = 5,
    seed: int = 42,
    suffix: str = "_te",
    fold_col: str | None = None,
) -> DataFrame:
    """``{col}_te``: mean of the numeric target over the other folds' rows with the same value.

    ``fold_col`` names folds already assigned.

    Values seen in one fold only, and nulls, get the overall mean. Sums per (column, value, fold) are
    taken in one pass for all columns; subtracting a row's own fold gives the other folds.
    """
    folded = (
        df.withColumn("__fold", F.col(fold_col))
        if fold_col
        else stratified_kfold(df, target, id_col, n_splits, seed, output="__fold")
    )
    sums = (
        long_form(folded, cols, keep=["__fold", target])
        .where(F.col("value").isNotNull())
        .groupBy("feature", "value", "__fold")
        .agg(F.sum(F.col(target).cast("double")).alias("s"), F.count(target).alias("n"))
    )
    sums = materialize(sums)
    whole = sums.groupBy("feature", "value").agg(F.sum("s").alias("ws"), F.sum("n").alias("wn"))
    codes = sums.join(whole, ["feature", "value"]).select(
        "feature",
        "value",
        "__fold",
        ((F.col("ws") - F.col("s")) / F.nullif(F.col("wn") - F.col("n"), F.lit(0))).alias("te"),
    )
    out = _join_codes(folded, store(codes), cols, ["__fold"], suffix).drop("__fold")
    overall = _mean(df, target)
    return out.withColumns({f"{c}{suffix}": F.coalesce(f"`{c}{suffix}`", overall) for c in cols})


def target_means(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """``(feature, value, te, n)``: mean target per value, for all columns in one pass."""
    return (
        long_form(df, cols, keep=[target])
        .where(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.avg(target).alias("te"), F.count(F.lit(1)).alias("n"))
    )


def target_encode_full(df: DataFrame, cols: Sequence[str], target: str, suffix: str = "_te") -> DataFrame:
    """Mean target per value over all rows. Leaks the target into training; null stays null."""
    return _join_codes(df, store(target_means(df, cols, target)), cols, [], suffix)


def target_encode_fit(train: DataFrame, cols: Sequence[str], target: str) -> tuple[DataFrame, float]:
    """Means per value from training rows, and the overall mean."""
    overall = train.agg(F.avg(target)).first()[0]
    return store(target_means(train, cols, target)), overall


def target_encode_apply(
    df: DataFrame, means: DataFrame, overall: float, cols: Sequence[str], suffix: str = "_te"
) -> DataFrame:
    """Encode with fitted means; unseen and null values get the overall mean."""
    out = _join_codes(df, means, cols, [], suffix)
    return out.withColumns({f"{c}{suffix}": F.coalesce(f"`{c}{suffix}`", F.lit(overall)) for c in cols})
