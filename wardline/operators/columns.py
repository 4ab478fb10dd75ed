"""Projection, filtering and encoding of whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.encoding import equals_flag
from ..session import store
from .joins import attach, is_small
from .ordered import dense_codes

# The two renamed raw columns.
RAW_RENAMES = {"Timestamp": "date", "Alerts/Warnings": "Alert Trigger"}


def rename_columns(df: DataFrame, mapping: Mapping[str, str] = RAW_RENAMES) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop the listed columns; missing ones are ignored."""
    return df.drop(*cols)


def drop_by_pattern(df: DataFrame, substring: str = " max n d") -> DataFrame:
    return df.drop(*[c for c in df.columns if substring in c])


def feature_matrix(df: DataFrame, feature_cols: Sequence[str]) -> list[Column]:
    """The features in order, as doubles; absent columns and nulls are 0."""
    present = set(df.columns)
    return [
        (F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) if c in present else F.lit(0.0)).alias(c)
        for c in feature_cols
    ]


def select_feature_vector(
    df: DataFrame, feature_cols: Sequence[str], keep: Sequence[str] = (), output: str = "features"
) -> DataFrame:
    """``keep`` columns plus one ML vector of the features in the given order."""
    # Plain names inside the assembler: feature names may hold dots or blanks.
    plain = [f"__f{i}" for i in range(len(feature_cols))]
    named = [c.alias(p) for c, p in zip(feature_matrix(df, feature_cols), plain)]
    assembled = VectorAssembler(inputCols=plain, outputCol=output).transform(
        df.select(*[F.col(f"`{c}`") for c in keep], *named)
    )
    return assembled.drop(*plain)


def te_features(df: DataFrame) -> list[str]:
    """Names of the target-encoded columns."""
    return [c for c in df.columns if c.endswith("_te")]


def filter_class(df: DataFrame, target: str, value: object) -> DataFrame:
    return df.where(F.col(target) == F.lit(value))


def equality_indicator(
    df: DataFrame, col: str, values: Sequence[object], name: Sequence[str] | None = None
) -> DataFrame:
    """One 0/1 column per value.

    Several values add ``"{col} {name}"`` columns. One name renames the column to ``"{col} {name}"``
    and overwrites it, the name ``/`` overwrites it in place, and one value without a name adds a
    column called like the value.
    """
    if name is None:
        if len(values) == 1:
            return df.withColumn(str(values[0]), equals_flag(F.col(f"`{col}`"), values[0]))
        name = [str(v) for v in values]
    if len(name) == 1:
        flagged = df.withColumn(col, equals_flag(F.col(f"`{col}`"), values[0]))
        return flagged if name[0] == "/" else flagged.withColumnRenamed(col, f"{col} {name[0]}")
    return df.withColumns(
        {f"{col} {n}": equals_flag(F.col(f"`{col}`"), v) for v, n in zip(values, name)}
    )


def class_labels(df: DataFrame, target: str) -> list:
    """Sorted distinct classes on the driver, for results with a column per class. For an open-ended column
    pass the wanted classes to the operator, or use its long form."""
    return sorted(r[0] for r in df.select(target).where(F.col(target).isNotNull()).distinct().collect())


def label_encode(df: DataFrame, target: str, output: str = "label") -> tuple[DataFrame, DataFrame]:
    """Class to 0..k-1 in sorted order: the encoded rows and the ``(class, code)`` map, the class in its own type.

    Numbers sort as numbers, everything else as text.
    """
    codes = store(
        dense_codes(df, [target]).select(
            F.col("value").cast(df.schema[target].dataType).alias(target), F.col("code").cast("int").alias(output)
        )
    )
    return attach(df, codes, [target]), codes


def label_decode(df: DataFrame, codes: DataFrame, target: str, code: str = "label") -> DataFrame:
    """Codes back to class names."""
    return attach(df, codes.select(F.col("label").alias(code), F.col(target)), [code])


def one_hot_labels(df: DataFrame, label: str, classes: Sequence[object]) -> DataFrame:
    """``{label}_{class}`` 0/1 columns, the input of one-vs-rest curves."""
    return df.withColumns(
        {f"{label}_{c}": F.coalesce(F.col(label) == F.lit(c), F.lit(False)).cast("int") for c in classes}
    )


def category_codes(df: DataFrame, cols: Sequence[str], suffix: str = "_code") -> DataFrame:
    """Sorted category code per column, -1 for null. Numbers sort as numbers, everything else as text."""
    codes = store(dense_codes(df, cols))
    out, small = df, is_small(codes) or None
    for c in cols:
        one = codes.where(F.col("feature") == c).select(
            F.col("value").alias("__v"), F.col("code").alias(f"{c}{suffix}")
        )
        out = attach(out.withColumn("__v", F.col(f"`{c}`").cast("string")), one, ["__v"], small=small).drop("__v")
        out = out.withColumn(f"{c}{suffix}", F.coalesce(f"`{c}{suffix}`", F.lit(-1)).cast("long"))
    return out


def fill_missing(df: DataFrame, value: object = 0, cols: Sequence[str] | None = None) -> DataFrame:
    return df.fillna(value, subset=list(cols) if cols is not None else None)


def drop_missing(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(subset=list(subset) if subset is not None else None)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct().orderBy(col)


def pick_row(df: DataFrame, id_col: str, row_id: object) -> DataFrame:
    return df.where(F.col(id_col) == F.lit(row_id))


def page(df: DataFrame, number: int, order_by: Sequence[str], size: int = 10) -> DataFrame:
    """Page ``number`` (from 1) of the ordered rows."""
    return df.orderBy(*order_by).offset((max(number, 1) - 1) * size).limit(size)


def page_count(df: DataFrame, size: int = 10) -> DataFrame:
    pages = F.ceil(F.count(F.lit(1)) / F.lit(size))
    return df.agg(F.greatest(pages, F.lit(1)).cast("long").alias("pages"))


def preview(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    return df.orderBy(*order_by).limit(n)


def sort_rows(df: DataFrame, cols: Sequence[str], descending: bool = False) -> DataFrame:
    return df.orderBy(*[F.col(c).desc() if descending else F.col(c).asc() for c in cols])
