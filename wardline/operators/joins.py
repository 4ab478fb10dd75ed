"""Attaching a keyed table to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes of a table as stored; in memory it may take several times as much.
BROADCAST_BYTES = 8 << 20
DEFAULT_SALTS = 16


def is_small(table: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the table has at most ``limit`` bytes by the optimizer's statistics: for a stored table its files, less
    the columns not read. Tables of unknown size are not small. Runs no job."""
    return table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() <= limit


def attach(
    df: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    *,
    spread_by: Sequence[str] = (),
    salts: int = DEFAULT_SALTS,
    small: bool | None = None,
) -> DataFrame:
    """Left join of ``dim`` (a stored table with one row per key tuple); a null key never matches.

    A ``dim`` of checked size is broadcast, so ``df`` is not shuffled. A larger one is joined by
    shuffle: rows with a null key are dealt out by their other columns, and adaptive execution splits skewed partitions; when one key may hold a large part of
    ``df``, name in ``spread_by`` columns that differ between the rows of a key (a row id): each key
    is then spread over ``salts`` partitions and ``dim`` is repeated that often. ``small`` passes on the
    result of a size check already made.
    """
    if is_small(dim) if small is None else small:
        return df.join(F.broadcast(dim), list(keys), "left")
    if spread_by:
        salted = df.withColumn("__salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
        repeated = dim.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        return salted.join(repeated, [*keys, "__salt"], "left").drop("__salt")
    # A null key matches nothing, so its rows need not meet: deal them out by their other columns.
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(f"`{k}`").isNull()
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    salted = df.withColumn("__salt", F.when(missing, F.pmod(F.xxhash64(*plain), F.lit(1 << 20)) + 1).otherwise(F.lit(0).cast("long")))
    # Not a literal, which the optimizer would take out of the join keys.
    single = dim.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(1)).cast("long"))
    return salted.join(single, [*keys, "__salt"], "left").drop("__salt")
