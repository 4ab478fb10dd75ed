"""Daily series and their autocorrelation."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import store
from .columns import class_labels
from .joins import attach
from .ordered import running

BLOCK_ROWS = 100_000


def daily_counts(
    df: DataFrame, ts: str, target: str, classes: Sequence[object] | None = None
) -> DataFrame:
    """Rows per day, one column per class."""
    return daily_counts_by(df, ts, None, target, classes)


def daily_counts_by(
    df: DataFrame, ts: str, col: str | None, target: str, classes: Sequence[object] | None = None
) -> DataFrame:
    """Rows per day and category value, one column per class; 0 where a class is absent from an
    existing (day, value) row."""
    classes = list(classes) if classes is not None else class_labels(df, target)
    keys = [F.to_date(ts).alias("day"), *([F.col(col)] if col else [])]
    rows = df.dropna(subset=[ts, target, *([col] if col else [])])
    return rows.groupBy(*keys).agg(
        *[F.count_if(F.col(target) == F.lit(c)).alias(str(c)) for c in classes]
    )


def daily_series(
    df: DataFrame, ts: str, target: str, col: str | None = None, classes: Sequence[object] | None = None
) -> DataFrame:
    """Long form ``(series, day, x)``; with ``col`` the series is ``"class x value"``. A class has 0
    on the days where only other classes occur."""
    classes = list(classes) if classes is not None else class_labels(df, target)
    wide = daily_counts_by(df, ts, col, target, classes)
    name = (lambda c: F.concat(F.lit(f"{c} x "), F.col(col).cast("string"))) if col else F.lit
    cells = F.array(
        *[F.struct(name(str(c)).alias("series"), F.col(f"`{c}`").cast("double").alias("x")) for c in classes]
    )
    return wide.select("day", F.inline(cells)).select("series", "day", "x")


def lagged_products(
    series: DataFrame, key: str, t: str, x: str, nlags: int, center: bool = True, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``(key, lag, n, product)``: sum of x(t) x(t+lag) for lags 0..nlags, and the series length.

    Positions count the rows of a series by ``t``; lags longer than the series do not appear, null values
    add nothing. A series may have any length: its positions come from prefix sums over range partitions, and products
    from blocks of positions that also hold the first ``nlags`` rows of the next block.
    """
    size = max(block_rows, 4 * nlags, 1)
    value = F.col(x).cast("double")
    rows = series.select(F.col(key), F.col(t).alias("t"), value.alias("x"), F.lit(1).cast("long").alias("one"))
    placed = running(rows, ["t"], sums=["one"], by=[key])
    if center:
        means = store(rows.groupBy(key).agg(F.avg("x").alias("mean")))
        placed = attach(placed, means, [key], spread_by=["t"]).withColumn("x", F.col("x") - F.col("mean"))
    block = F.floor(F.col("one_before") / size)
    place = F.col("one_before") % size
    # A row stands in its own block, and behind the block before where that needs it.
    homes = F.when((place < nlags) & (block > 0), F.array(block, block - 1)).otherwise(F.array(block))
    blocks = placed.select(
        key, F.col("one_total").alias("n"), F.explode(homes).alias("block"), F.col("one_before").alias("pos"), F.coalesce("x", F.lit(0.0)).alias("x")
    )

    def products(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        values = pdf["x"].to_numpy()
        own = int((pdf["pos"] < (pdf["block"].iloc[0] + 1) * size).sum())
        lags = np.arange(min(nlags, len(values) - 1) + 1)
        sums = [float(values[: min(own, len(values) - lag)] @ values[lag : lag + own]) for lag in lags]
        return pd.DataFrame({key: [pdf[key].iloc[0]] * len(lags), "lag": lags, "n": pdf["n"].iloc[0], "product": sums})

    kind = series.schema[key].dataType.simpleString()
    parts = blocks.groupBy(key, "block").applyInPandas(products, f"`{key}` {kind}, lag int, n long, product double")
    return parts.groupBy(key, "lag").agg(F.max("n").alias("n"), F.sum("product").alias("product"))


def acf(series: DataFrame, key: str, t: str, x: str, nlags: int = 100) -> DataFrame:
    """Autocorrelation per series and lag (biased form); null for a constant series."""
    products = lagged_products(series, key, t, x, nlags)
    zero = products.where("lag = 0").select(key, F.col("product").alias("c0"))
    return products.join(zero, key).select(
        key, "lag", (F.col("product") / F.nullif(F.col("c0"), F.lit(0.0))).alias("acf")
    )


def pacf(series: DataFrame, key: str, t: str, x: str, nlags: int = 100) -> DataFrame:
    """Partial autocorrelation per series and lag: Yule-Walker on autocovariances divided by the
    number of products, by the Durbin-Levinson recursion over at most ``nlags + 1`` numbers."""
    products = lagged_products(series, key, t, x, nlags)
    adjusted = products.select(
        F.col(key), "lag", (F.col("product") / (F.col("n") - F.col("lag"))).alias("c")
    )

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        c = pdf.sort_values("lag")["c"].to_numpy()
        out = np.full(len(c), np.nan)
        out[0] = 1.0
        phi = np.zeros(0)
        variance = c[0]
        for k in range(1, len(c)):
            if not variance:  # constant or perfectly predicted series
                break
            reflection = (c[k] - phi @ c[k - 1 : 0 : -1]) / variance
            phi = np.append(phi - reflection * phi[::-1], reflection)
            variance *= 1.0 - reflection**2
            out[k] = reflection
        return pd.DataFrame({key: pdf[key].iloc[0], "lag": np.arange(len(c)), "pacf": out})

    key_type = series.schema[key].dataType.simpleString()
    solved = adjusted.groupBy(key).applyInPandas(solve, f"{key} {key_type}, lag int, pacf double")
    return solved.withColumn("pacf", F.nanvl("pacf", F.lit(None).cast("double")))
