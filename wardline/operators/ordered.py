"""Order-dependent work without a single-task window.

``running`` gives prefix sums and prefix maxima over a totally ordered table: rows are range
partitioned by the order key, every partition is scanned on its own, and one offset row per
partition carries the state of the earlier partitions. Exact quantiles, dense ranks, interval
lookups and the curve metrics are all built on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

_PART = "__part"


def running(
    df: DataFrame,
    order_by: Sequence[str],
    *,
    sums: Sequence[str] = (),
    maxes: Sequence[str] = (),
    by: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Add ``{m}_before`` and ``{m}_total`` for ``sums`` and ``{m}_upto`` for ``maxes``.

    ``df`` should hold one row per ``(by, order_by)``, so pre-aggregate first; a value that fills a
    third of the input is then a single row here. ``_before`` excludes the row itself, ``_upto``
    includes it. Rows with a null in ``by`` are dropped.
    """
    order = [F.col(c).desc() if descending else F.col(c).asc() for c in order_by]
    keep = df.dropna(subset=list(by)) if by else df
    # Stored once: the partition number must be the same for the rows and for the offsets.
    rows = materialize(
        keep.repartitionByRange(*[F.col(c) for c in by], *order).withColumn(
            _PART, F.spark_partition_id()
        )
    )
    parts = rows.groupBy(_PART, *by).agg(
        *[F.sum(m).alias(m) for m in sums], *[F.max(m).alias(m) for m in maxes]
    )
    # One row per range partition and group, so these windows stay small however big df is.
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    earlier = group.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        _PART,
        *by,
        *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"__{m}_off") for m in sums],
        *[F.sum(m).over(group).alias(f"{m}_total") for m in sums],
        *[F.max(m).over(earlier).alias(f"__{m}_off") for m in maxes],
    )
    inside = Window.partitionBy(_PART, *by).orderBy(*order)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = rows.join(offsets, [_PART, *by]).withColumns(
        {
            **{
                f"{m}_before": F.coalesce(F.sum(m).over(before), F.lit(0)) + F.col(f"__{m}_off")
                for m in sums
            },
            **{
                # greatest() skips nulls: the first partition has no earlier maximum.
                f"{m}_upto": F.greatest(F.max(m).over(upto), F.col(f"__{m}_off"))
                for m in maxes
            },
        }
    )
    return out.drop(_PART, *[f"__{m}_off" for m in (*sums, *maxes)])


def ordered_counts(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., col, n, n_before, n_total)``: rows per value and rows with a smaller value.

    Null and, in floating columns, NaN are missing values and left out.
    """
    there = F.col(col).isNotNull()
    if isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType)):
        there = there & ~F.isnan(col)
    counts = df.where(there).groupBy(*by, col).agg(F.count(F.lit(1)).alias("n"))
    return running(counts, [col], sums=["n"], by=by)


def exact_quantiles(
    df: DataFrame, col: str, probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact quantiles with linear interpolation: ``(by..., prob, quantile)``.

    Works on value counts and keeps two rows per quantile, where the built-in exact percentile
    would hold all distinct values of a group in one task.
    """
    ranked = ordered_counts(df.select(*by, col), col, by)
    return quantiles_of_counts(ranked, col, probs, by)


def quantiles_of_counts(
    ranked: DataFrame, col: str, probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Quantiles from the output of ``ordered_counts``."""
    first, last = F.col("n_before"), F.col("n_before") + F.col("n") - 1

    def hits(p: Column) -> Column:
        position = (F.col("n_total") - 1) * p
        return F.floor(position).between(first, last) | F.ceil(position).between(first, last)

    wanted = F.array(*[F.lit(float(p)) for p in probs])
    picked = (
        ranked.withColumn("__probs", F.filter(wanted, hits))
        .where(F.size("__probs") > 0)
        .withColumn("prob", F.explode("__probs"))
        .withColumn("__pos", (F.col("n_total") - 1) * F.col("prob"))
    )
    value = F.col(col).cast("double")
    low = F.max(F.when(F.floor("__pos").between(first, last), value))
    high = F.max(F.when(F.ceil("__pos").between(first, last), value))
    share = F.max(F.col("__pos") - F.floor("__pos"))
    return picked.groupBy(*by, "prob").agg((low + (high - low) * share).alias("quantile"))


def floor_lookup(values: DataFrame, col: str, starts: DataFrame, start: str) -> DataFrame:
    """For every distinct value the greatest ``start`` that is not above it.

    Returns ``(col, start)``, ``start`` null when all starts are above. Values and starts are merged
    in one range-partitioned pass, so neither side has to fit on one machine.
    """
    merged = (
        values.where(F.col(col).isNotNull())
        .select(F.col(col).alias("__x"), F.lit(True).alias("__is_value"))
        .distinct()
        .withColumn("__start", F.when(~F.col("__is_value"), F.col("__x")))
        .unionByName(
            starts.where(F.col(start).isNotNull()).select(
                F.col(start).alias("__x"),
                F.lit(False).alias("__is_value"),
                F.col(start).alias("__start"),
            )
        )
        .groupBy("__x")
        .agg(F.max("__is_value").alias("__is_value"), F.max("__start").alias("__start"))
    )
    found = running(merged, ["__x"], maxes=["__start"]).where("__is_value")
    return found.select(F.col("__x").alias(col), F.col("__start_upto").alias(start))


def dense_codes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(feature, value, code)``: 0-based rank of each distinct non-null value of each column.

    Numbers are ranked as numbers, everything else as text; ``value`` is the value as text.
    """
    kinds: dict[str, list[str]] = {}
    for c in cols:
        kind = df.schema[c].dataType
        whole = isinstance(kind, T.IntegralType)
        key = "long" if whole else "double" if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType) else kind.simpleString()
        kinds.setdefault(key if whole or isinstance(kind, T.FractionalType) else "string", []).append(c)
    out = None
    for key, group in kinds.items():
        pairs = [
            F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("string").alias("value"), F.col(f"`{c}`").cast(key).alias("key"))
            for c in group
        ]
        values = df.select(F.inline(F.array(*pairs))).where(F.col("value").isNotNull()).distinct()
        ranked = running(values.withColumn("n", F.lit(1).cast("long")), ["key"], sums=["n"], by=["feature"])
        coded = ranked.select("feature", "value", F.col("n_before").alias("code"))
        out = coded if out is None else out.unionByName(coded)
    return out


def long_form(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``(keep..., feature, value)`` with values as strings; one scan for any number of columns."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("string").alias("value"))
            for c in cols
        ]
    )
    return df.select(*[F.col(f"`{c}`") for c in keep], F.inline(pairs))
