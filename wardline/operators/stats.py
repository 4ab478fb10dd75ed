"""Association between categories and the class."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, store
from .columns import category_codes
from .joins import attach
from .ordered import long_form


def contingency(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """``(feature, value, class, n)`` for all columns in one pass; nulls are left out."""
    return (
        long_form(df, cols, keep=[target])
        .where(F.col("value").isNotNull() & F.col(target).isNotNull())
        .groupBy("feature", "value", F.col(target).cast("string").alias("class"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _with_margins(cells: DataFrame) -> DataFrame:
    rows = cells.groupBy("feature", "value").agg(F.sum("n").alias("n_value"))
    classes = cells.groupBy("feature", "class").agg(F.sum("n").alias("n_class"))
    totals = cells.groupBy("feature").agg(F.sum("n").alias("total"))
    # Few classes and features against many values: those two are attached, not shuffled.
    out = attach(cells.join(rows, ["feature", "value"]), store(classes), ["feature", "class"])
    return attach(out, store(totals), ["feature"])


def mcc(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """Multi-class Matthews correlation of the class and each column, over the union of labels.

    0 when a denominator is 0 and when the label sets share nothing. Values are compared as text.
    """
    cells = materialize(contingency(df, cols, target))
    agree = cells.groupBy("feature").agg(
        F.sum("n").cast("double").alias("s"),
        F.sum(F.when(F.col("value") == F.col("class"), F.col("n")).otherwise(0)).cast("double").alias("c"),
    )
    sides = F.array(
        F.struct(F.col("value").alias("label"), F.col("n").alias("p"), F.lit(0).cast("long").alias("t")),
        F.struct(F.col("class").alias("label"), F.lit(0).cast("long").alias("p"), F.col("n").alias("t")),
    )
    margins = (
        cells.select("feature", F.inline(sides))
        .groupBy("feature", "label")
        .agg(F.sum("p").cast("double").alias("p"), F.sum("t").cast("double").alias("t"))
        .groupBy("feature")
        .agg(
            F.sum(F.col("p") * F.col("t")).alias("pt"),
            F.sum(F.col("p") * F.col("p")).alias("pp"),
            F.sum(F.col("t") * F.col("t")).alias("tt"),
        )
    )
    s = F.col("s")
    below = F.sqrt((s * s - F.col("pp")) * (s * s - F.col("tt")))
    value = (F.col("c") * s - F.col("pt")) / F.nullif(below, F.lit(0.0))
    return agree.join(margins, "feature").select("feature", F.coalesce(value, F.lit(0.0)).alias("mcc"))


def chi_square_codes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Chi-square of the columns-by-records matrix of category codes.

    One row ``(statistic, dof)``. A record or a column whose codes are all 0 has zero expected
    counts; the statistic is then null.
    """
    codes = [F.col(f"`{c}_code`").cast("double") for c in cols]
    record = sum(codes[1:], codes[0])
    sums = category_codes(df.select(*[F.col(f"`{c}`") for c in cols]), cols).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(record).alias("smallest"),
        F.sum(record).alias("total"),
        *[F.sum(code).alias(f"r{i}") for i, code in enumerate(codes)],
        *[F.sum(code * code / F.nullif(record, F.lit(0.0))).alias(f"q{i}") for i, code in enumerate(codes)],
    )
    rows = [F.col(f"r{i}") for i in range(len(cols))]
    inner = sum(
        (F.col(f"q{i}") / F.nullif(r, F.lit(0.0)) for i, r in enumerate(rows)), F.lit(0.0)
    )
    statistic = F.when(F.col("smallest") > 0, F.col("total") * inner - F.col("total"))
    dof = (F.col("n") - 1) * F.lit(len(cols) - 1)
    return sums.select(statistic.alias("statistic"), dof.alias("dof"))


def chi_square_features(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Independence test per feature: ``(feature, statistic, dof)``."""
    cells = _with_margins(materialize(contingency(df, cols, target)))
    # sum (o-e)^2/e = total * (sum o^2 / (row * column) - 1), so empty cells need no rows.
    weight = F.col("n").cast("double") * F.col("n") / (F.col("n_value").cast("double") * F.col("n_class"))
    return cells.groupBy("feature").agg(
        (F.max("total") * (F.sum(weight) - 1.0)).alias("statistic"),
        ((F.count_distinct("value") - 1) * (F.count_distinct("class") - 1)).alias("dof"),
    )


def chi_square_upper(statistic: float, dof: int) -> float:
    """Probability that a chi-squared variable is above ``statistic``, by the finite sums for whole and half
    numbers of ``dof / 2``; the terms are added in logarithms."""
    x = statistic / 2
    if x <= 0:
        return 1.0
    start, total = (0.5, math.erfc(math.sqrt(x))) if dof % 2 else (0.0, 0.0)
    steps = np.arange(dof // 2)
    if len(steps):
        # lgamma(start + 1 + i) as a running sum of logarithms.
        gammas = math.lgamma(start + 1) + np.concatenate(([0.0], np.cumsum(np.log(start + steps[1:]))))
        terms = (start + steps) * math.log(x) - x - gammas
        total += math.exp(terms.max()) * float(np.exp(terms - terms.max()).sum())
    return min(1.0, total)


def chi_square_pvalues(df: DataFrame, cols: Sequence[str], target: str, alpha: float = 0.05) -> DataFrame:
    """``(feature, statistic, dof, p_value, significant)`` for columns with any number of values.

    The p-value is null without a degree of freedom.
    """

    def upper(statistic: pd.Series, dof: pd.Series) -> pd.Series:
        return pd.Series([chi_square_upper(s, int(d)) if d > 0 else None for s, d in zip(statistic, dof)], dtype="float64")

    # One row per feature.
    tested = chi_square_features(df, cols, target)
    p_value = F.pandas_udf(upper, "double")(F.col("statistic"), F.col("dof"))
    return tested.select("feature", "statistic", "dof", p_value.alias("p_value")).withColumn("significant", F.col("p_value") < alpha)


def mutual_information(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Discrete mutual information (nats) of each feature and the class, highest first."""
    cells = _with_margins(materialize(contingency(df, cols, target)))
    p = F.col("n") / F.col("total")
    ratio = F.col("n").cast("double") * F.col("total") / (F.col("n_value").cast("double") * F.col("n_class"))
    return (
        cells.groupBy("feature")
        .agg(F.greatest(F.sum(p * F.ln(ratio)), F.lit(0.0)).alias("mi"))
        .orderBy(F.desc("mi"), "feature")
    )
