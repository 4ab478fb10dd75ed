"""Lookup tables that grow by the keys not seen before."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import attach
from ..session import store
from .tables import try_read_parquet


def incremental_dimension(
    df: DataFrame,
    path: str,
    key: str,
    resolve: Callable[[DataFrame], DataFrame],
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Resolve the keys missing from the Parquet lookup at ``path``, append them, and return ``df``
    with the lookup's columns.

    Each new key is resolved once, however many rows carry it; a run that dies before its append is
    simply repeated. Null keys stay unresolved.
    """
    spark = df.sparkSession
    keys = df.select(key).where(F.col(f"`{key}`").isNotNull()).distinct()
    known = try_read_parquet(spark, path)
    new = keys if known is None else keys.join(known.select(key), key, "left_anti")
    resolve(new).write.mode("append").parquet(path)
    # Two runs at the same time may append the same key: its smallest row counts, whichever comes first.
    lookup = spark.read.parquet(path)
    others = [c for c in lookup.columns if c != key]
    lookup = lookup.groupBy(key).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in others])).alias("__row")).select(key, "__row.*")
    return attach(df, store(lookup), [key], spread_by=spread_by)
