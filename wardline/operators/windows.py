"""Runs of equal values in sort order, and partition extremes.

Equal values form one run, so run numbers, sizes and the change flag follow from value counts; no
window over all rows is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import store
from .joins import attach
from .ordered import running


def runs(df: DataFrame, col: str) -> DataFrame:
    """``(col, run, run_size, first_row)``: run number from 1 in value order, rows in the run and
    the row number (from 0) where it begins."""
    counts = (
        df.where(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("run_size"))
        .withColumn("one", F.lit(1).cast("long"))
    )
    ranked = running(counts, [col], sums=["one", "run_size"])
    return ranked.select(
        col, (F.col("one_before") + 1).alias("run"), "run_size", F.col("run_size_before").alias("first_row")
    )


def run_group_id(df: DataFrame, col: str) -> DataFrame:
    """Add ``run``, the running count of changes in sort order."""
    return attach(df, store(runs(df, col).select(col, "run")), [col])


def run_sizes(df: DataFrame, col: str) -> DataFrame:
    """``(run, run_size)`` in sort order."""
    return runs(df, col).select("run", "run_size")


def change_flag(df: DataFrame, col: str, tie_break: Sequence[str]) -> DataFrame:
    """Add ``changed``: 1 on the first row of each run, rows of a run ordered by ``tie_break``.

    The first row is the one with the smallest ``tie_break``, which a grouped minimum finds.
    """
    first = (
        df.where(F.col(col).isNotNull()).groupBy(col).agg(F.min(F.struct(*tie_break)).alias("__first"))
    )
    here = F.struct(*tie_break) == F.col("__first")
    return (
        attach(df, store(first), [col])
        .withColumn("changed", F.coalesce(here, F.lit(False)).cast("int"))
        .drop("__first")
    )


def partition_min_max(df: DataFrame, part: str, col: str) -> DataFrame:
    """Add the smallest and largest value of the row's partition."""
    extremes = df.groupBy(part).agg(F.min(col).alias(f"{col}_min"), F.max(col).alias(f"{col}_max"))
    return attach(df, store(extremes), [part])


def row_argmax(df: DataFrame, part: str, value: str, order: str) -> DataFrame:
    """Per partition the ``value`` with the greatest ``order``; ties to the smaller value."""
    best = F.min(F.struct((-F.col(order)).alias("o"), F.col(value).alias("v")))
    return df.groupBy(part).agg(best.alias("b")).select(
        part, F.col("b.v").alias(value), (-F.col("b.o")).alias(order)
    )
