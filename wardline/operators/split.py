"""Class-balanced splits and folds by row hash.

Rows of a class are ordered by ``md5("seed:id")``. A row's place follows from a few cut hashes per
class, which are found from bucket counts and the rows of the buckets that hold a cut; the full table
is neither sorted nor shuffled, and the same seed gives the same rows on any cluster.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import store
from .joins import attach

_HEX = 4  # leading hex digits of the hash that form the bucket: 65,536 buckets per class


def row_hash(id_col: Column | str, seed: int) -> Column:
    c = F.col(f"`{id_col}`") if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string")))


def row_uniform(id_col: Column | str, seed: int) -> Column:
    """Reproducible number in [0, 1) per row: the first 32 hash bits."""
    digits = F.substring(row_hash(id_col, seed), 1, 8)
    return F.conv(digits, 16, 10).cast("long") / F.lit(2.0**32)


def _class_cuts(
    df: DataFrame, target: str, id_col: str, seed: int, positions: Callable[[Column], Sequence[Column]]
) -> DataFrame:
    """``(target, cuts)``: the hash and id of the rows at the given 1-based ranks per class."""
    t = F.col(f"`{target}`")
    rows = df.where(t.isNotNull()).select(
        t.alias("__class"), row_hash(id_col, seed).alias("h"), F.col(f"`{id_col}`").alias("id")
    ).withColumn("bucket", F.substring("h", 1, _HEX))
    counts = rows.groupBy("__class", "bucket").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("__class")
    upto = w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.select(
        "__class", "bucket", "n", F.sum("n").over(upto).alias("upto"), F.sum("n").over(w).alias("total")
    )
    wanted = F.array(*[p.cast("long") for p in positions(F.col("total"))])
    places = store(
        ranked.withColumn("place", F.explode(wanted))
        .where((F.col("place") > F.col("upto") - F.col("n")) & (F.col("place") <= F.col("upto")))
        .groupBy("__class", "bucket")
        .agg(F.collect_list((F.col("place") - F.col("upto") + F.col("n"))).alias("nths"))
    )
    # A few rows per class: only the rows of the buckets with a cut are shuffled.
    wanted_rows = attach(rows, places, ["__class", "bucket"]).where("nths IS NOT NULL")
    rank = F.row_number().over(Window.partitionBy("__class", "bucket").orderBy("h", "id"))
    return store(
        wanted_rows.withColumn("rank", rank)
        .withColumn("nth", F.explode("nths"))
        .where("rank = nth")
        .groupBy("__class")
        .agg(F.array_sort(F.collect_list(F.struct("h", "id"))).alias("__cuts"))
    )


def _cuts_passed(df: DataFrame, target: str, id_col: str, seed: int, cuts: DataFrame) -> DataFrame:
    """Add ``__passed``: how many cuts of its class the row lies beyond (null without cuts)."""
    here = F.struct(row_hash(id_col, seed).alias("h"), F.col(f"`{id_col}`").alias("id"))
    joined = attach(df.withColumn("__class", F.col(f"`{target}`")), cuts, ["__class"])
    passed = F.size(F.filter("__cuts", lambda c: here > c))
    return joined.withColumn("__passed", F.when(F.col("__cuts").isNotNull(), passed)).drop("__class", "__cuts")


def stratified_split(
    df: DataFrame, target: str, id_col: str, p: float, seed: int = 42, output: str = "is_test"
) -> DataFrame:
    """Flag ``round(p * n)`` rows of each class as test rows."""
    cuts = _class_cuts(df, target, id_col, seed, lambda n: [F.round(n * F.lit(p))])
    passed = _cuts_passed(df, target, id_col, seed, cuts)
    return passed.withColumn(output, F.coalesce(F.col("__passed") == 0, F.lit(False))).drop("__passed")


def train_test(df: DataFrame, target: str, id_col: str, p: float, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    flagged = stratified_split(df, target, id_col, p, seed)
    return flagged.where(~F.col("is_test")).drop("is_test"), flagged.where("is_test").drop("is_test")


def stratified_kfold(
    df: DataFrame, target: str, id_col: str, k: int = 5, seed: int = 42, output: str = "fold"
) -> DataFrame:
    """Add a fold 0..k-1; fold sizes within a class differ by at most one row."""
    cuts = _class_cuts(
        df, target, id_col, seed, lambda n: [F.ceil(n * F.lit(i) / F.lit(k)) for i in range(1, k)]
    )
    passed = _cuts_passed(df, target, id_col, seed, cuts)
    return passed.withColumnRenamed("__passed", output)
