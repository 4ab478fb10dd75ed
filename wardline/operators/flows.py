"""Flow links between categories, and full category paths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, store
from .columns import class_labels
from .joins import attach
from .ordered import dense_codes

OTHER = "other"


def _paths(df: DataFrame, cols: Sequence[str], n: int, top_cols: Sequence[str]) -> DataFrame:
    """``(cols..., n)``: rows per combination without nulls, ``top_cols`` cut to their n top values.

    The rows are read once; the top values are then found from the combinations. A value's rank
    counts all its rows, also those whose other columns are null.
    """
    paths = materialize(df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")))
    out = paths
    for c in top_cols:
        top = (
            paths.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("__top")).agg(F.sum("n").alias("__n"))
            .orderBy(F.desc("__n"), "__top").limit(n).select("__top")
        )
        kept = F.when(F.col(c).isNull() | F.col("__top").isNotNull(), F.col(c).cast("string"))
        out = (
            out.join(F.broadcast(top), F.col(c) == F.col("__top"), "left")  # n rows
            .withColumn(c, kept.otherwise(F.lit(OTHER)))
            .drop("__top")
        )
    return out.dropna(subset=list(cols)).groupBy(*cols).agg(F.sum("n").alias("n"))


def flow_counts(df: DataFrame, levels: Sequence[str], n: int = 10) -> DataFrame:
    """Rows per path over the levels, each level reduced to its n top values and ``other``.

    Paths with a null level are dropped. The usual levels are source, proxy and destination country.
    """
    return _paths(df, levels, n, levels)


def flow_links(paths: DataFrame, levels: Sequence[str], weight: str = "n", labelled: bool = True) -> DataFrame:
    """``(level, src, dst, weight)``: summed weight between neighbouring levels."""

    def node(c: str):
        text = F.col(f"`{c}`").cast("string")
        return F.concat(F.lit(f"{c} "), text) if labelled else text

    steps = F.array(
        *[
            F.struct(
                F.lit(i).alias("level"),
                node(a).alias("src"),
                node(b).alias("dst"),
                F.col(f"`{weight}`").cast("long").alias("weight"),
            )
            for i, (a, b) in enumerate(zip(levels, levels[1:]))
        ]
    )
    return paths.select(F.inline(steps)).groupBy("level", "src", "dst").agg(F.sum("weight").alias("weight"))


def feature_flow_links(
    df: DataFrame, cols: Sequence[str], target: str, n: int = 10, top_cols: Sequence[str] = ()
) -> DataFrame:
    """Links through the chosen columns to the class; ``top_cols`` are first cut to n values."""
    return flow_links(_paths(df, [*cols, target], n, top_cols), [*cols, target])


def feature_flow_table(
    df: DataFrame, cols: Sequence[str], target: str, n: int = 10, top_cols: Sequence[str] = (),
    classes: Sequence[object] | None = None,
) -> DataFrame:
    """The same combinations as percentages of the grand total, one column per class."""
    paths = materialize(_paths(df, [*cols, target], n, top_cols))
    classes = list(classes) if classes is not None else class_labels(paths, target)
    total = paths.agg(F.sum("n")).scalar()
    return paths.groupBy(*cols).agg(
        *[
            (F.sum(F.when(F.col(target) == F.lit(c), F.col("n")).otherwise(0)) * 100.0 / F.first(total)).alias(str(c))
            for c in classes
        ]
    )


def category_paths(
    df: DataFrame, dims: Sequence[str], target: str, n: int = 10, top_cols: Sequence[str] = (),
    color_by: str | None = None,
) -> DataFrame:
    """Count and probability of every combination, with a 0-based colour code (sorted values)."""
    color_by = color_by or target
    if color_by not in (*dims, target):
        raise ValueError("color_by must be one of the dimensions or the class")
    paths = materialize(_paths(df, [*dims, target], n, top_cols))
    codes = store(
        dense_codes(paths, [color_by]).select(F.col("value").alias("__c"), F.col("code").alias("color"))
    )
    return (
        attach(paths.withColumn("__c", F.col(color_by).cast("string")), codes, ["__c"])
        .drop("__c")
        .withColumn("probability", F.col("n") / paths.agg(F.sum("n")).scalar())
    )
