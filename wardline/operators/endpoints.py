"""Set operations on traffic endpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .crosstab import crosstab_row_pct
from .lookup import in_set


def _side(df: DataFrame, col: str) -> DataFrame:
    return df.select(F.col(f"`{col}`").alias("ip")).where("ip IS NOT NULL").distinct()


def bidirectional_ips(df: DataFrame, src: str, dst: str) -> DataFrame:
    """Addresses that occur as source and as destination."""
    return _side(df, src).intersect(_side(df, dst))


def endpoint_roles(df: DataFrame, src: str, dst: str) -> DataFrame:
    """``(ip, as_src, as_dst)`` for every address, in one pass over the rows."""
    pairs = F.array(
        F.struct(F.col(f"`{src}`").alias("ip"), F.lit(True).alias("s"), F.lit(False).alias("d")),
        F.struct(F.col(f"`{dst}`").alias("ip"), F.lit(False).alias("s"), F.lit(True).alias("d")),
    )
    return (
        df.select(F.inline(pairs))
        .where("ip IS NOT NULL")
        .groupBy("ip")
        .agg(F.bool_or("s").alias("as_src"), F.bool_or("d").alias("as_dst"))
    )


def endpoint_union(df: DataFrame, src: str, dst: str) -> DataFrame:
    """Counts of sources, destinations, both, all, and the share of both in percent."""
    both = F.col("as_src") & F.col("as_dst")
    return (
        endpoint_roles(df, src, dst)
        .agg(
            F.count_if("as_src").alias("sources"),
            F.count_if("as_dst").alias("destinations"),
            F.count_if(both).alias("bidirectional"),
            F.count(F.lit(1)).alias("endpoints"),
        )
        .withColumn("bidirectional_pct", F.col("bidirectional") * 100.0 / F.col("endpoints"))
    )


def flag_bidirectional(df: DataFrame, src: str, dst: str, output: str = "is_bidirectional") -> DataFrame:
    """True where either end is a bidirectional address."""
    return in_set(df, [src, dst], bidirectional_ips(df, src, dst), output)


def bidirectional_by_class(df: DataFrame, src: str, dst: str, target: str) -> DataFrame:
    """Per class the percentage of rows without and with a bidirectional end."""
    flagged = flag_bidirectional(df.select(src, dst, target), src, dst)
    return crosstab_row_pct(flagged, target, "is_bidirectional", classes=[False, True]).withColumnsRenamed(
        {"False": "one_way_pct", "True": "bidirectional_pct"}
    )
