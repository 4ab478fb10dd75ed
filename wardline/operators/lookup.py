"""Key lookups, set membership and address ranges."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.network import ip_to_key, ip_to_long, network_bounds
from ..functions.useragent import with_user_agent_fields
from .binning import range_lookup
from ..session import materialize, store
from .joins import attach, is_small

GEO_FIELDS = ("latitude", "longitude", "country", "city")


def map_lookup(
    df: DataFrame,
    key: str,
    lookup: DataFrame,
    value: str,
    *,
    output: str | None = None,
    fill: object = None,
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Value per key from ``lookup`` (one row per key); absent keys give ``fill`` or null."""
    output = output or value
    dim = lookup.select(F.col(f"`{key}`"), F.col(f"`{value}`").alias(output))
    out = attach(df, dim, [key], spread_by=spread_by)
    return out if fill is None else out.withColumn(output, F.coalesce(F.col(f"`{output}`"), F.lit(fill)))


def in_set(df: DataFrame, cols: Sequence[str], members: DataFrame, output: str = "in_set") -> DataFrame:
    """True where any of the columns holds a member; ``members`` has one column."""
    unique = store(members.distinct())
    small = is_small(unique)
    out, flags = df, []
    for i, c in enumerate(cols):
        flag = f"__m{i}"
        unique_i = unique.toDF(f"__k{i}").withColumn(flag, F.lit(True))
        out = out.join(F.broadcast(unique_i) if small else unique_i, F.col(f"`{c}`") == F.col(f"__k{i}"), "left").drop(f"__k{i}")
        flags.append(flag)
    hit = F.greatest(*[F.coalesce(f, F.lit(False)) for f in flags]) if len(flags) > 1 else F.coalesce(flags[0], F.lit(False))
    return out.withColumn(output, hit).drop(*flags)


def in_set_multi(df: DataFrame, keys: Sequence[str], members: DataFrame, output: str = "in_set") -> DataFrame:
    """True where the key tuple is in ``members``; a tuple with a null is never a member."""
    unique = store(members.select(*[F.col(f"`{k}`") for k in keys]).distinct())
    flagged = attach(df, unique.withColumn("__hit", F.lit(True)), keys)
    return flagged.withColumn(output, F.coalesce("__hit", F.lit(False))).drop("__hit")


def not_in_set(test: DataFrame, train: DataFrame, key: str) -> DataFrame:
    """Test rows whose key never occurs in train: ``(unseen, total, pct)``."""
    seen = train.select(key).distinct().withColumn("__seen", F.lit(True))
    per_key = test.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    unseen = F.sum(F.when(F.col("__seen").isNull(), F.col("n")).otherwise(0))
    return (
        per_key.join(seen, key, "left")
        .agg(unseen.cast("long").alias("unseen"), F.sum("n").alias("total"))
        .withColumn("pct", F.col("unseen") * 100.0 / F.col("total"))
    )


def enrich_distinct(
    df: DataFrame, key: str, resolve: Callable[[DataFrame], DataFrame], spread_by: Sequence[str] = ()
) -> DataFrame:
    """Run a costly lookup once per distinct key and bring the result back to all rows.

    ``resolve`` gets a table with the one column ``key`` and returns it with added columns.
    """
    keys = df.select(key).where(F.col(f"`{key}`").isNotNull()).distinct()
    return attach(df, store(resolve(keys)), [key], spread_by=spread_by)


def parse_user_agent(df: DataFrame, ua_col: str, spread_by: Sequence[str] = ()) -> DataFrame:
    """Add the eleven user-agent fields; each distinct text is matched once."""
    return enrich_distinct(df, ua_col, lambda keys: with_user_agent_fields(keys, ua_col), spread_by)


def geo_dimension(ranges: DataFrame, start: str, end: str) -> DataFrame:
    """Address ranges with dotted bounds to the numeric form used by ``ip_geolocate``."""
    return ranges.withColumns({"ip_start": ip_to_long(start), "ip_end": ip_to_long(end)})


def geo_networks(networks: DataFrame, network: str) -> DataFrame:
    """IPv4 and IPv6 networks (``address/bits``) to the binary form used by ``ip_geolocate``; others are left out."""
    bounded = networks.withColumn("__bounds", network_bounds(network)).where("__bounds IS NOT NULL")
    # Stored, so that the bounds are computed once and not wherever they are used.
    return store(bounded.withColumns({"ip_start": F.col("__bounds.first"), "ip_end": F.col("__bounds.last")}).drop("__bounds"))


def ip_geolocate(
    df: DataFrame,
    ip: str,
    ranges: DataFrame,
    *,
    prefix: str = "",
    fields: Sequence[str] = GEO_FIELDS,
    country_ranges: DataFrame | None = None,
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Add the geo fields of the narrowest range ``[ip_start, ip_end]`` that holds the address.

    Bounds are IPv4 numbers, or the 16-byte keys of ``geo_networks`` for both families.
    Any miss (bad address, no range) gives nulls. Where the city table has nothing,
    ``country_ranges`` may still supply the country. Each distinct address is resolved once.
    """
    return ip_geolocate_all(
        df, {ip: prefix}, ranges, fields=fields, country_ranges=country_ranges, spread_by=spread_by
    )


def ip_geolocate_all(
    df: DataFrame,
    ips: Mapping[str, str],
    ranges: DataFrame,
    *,
    fields: Sequence[str] = GEO_FIELDS,
    country_ranges: DataFrame | None = None,
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Geolocate several address columns; ``ips`` maps each to the prefix of its fields.

    The addresses of all columns are collected in one pass and resolved together.
    """
    pairs = F.array(*[F.col(f"`{c}`") for c in ips])
    keys = df.select(F.explode(pairs).alias("__text")).where(F.col("__text").isNotNull()).distinct()
    number = lambda table: ip_to_key if isinstance(table.schema["ip_start"].dataType, T.BinaryType) else ip_to_long
    numbered = materialize(keys.withColumn("__ip", number(ranges)("__text")))
    hits = range_lookup(numbered, "__ip", ranges, "ip_start", "ip_end", list(fields))
    found = numbered.join(hits.select("__ip", *fields), "__ip", "left")
    if country_ranges is not None:
        if number(country_ranges) is not number(ranges):
            raise ValueError("both range tables must have bounds of one kind")
        coarse = range_lookup(numbered, "__ip", country_ranges, "ip_start", "ip_end", ["country"])
        found = found.join(coarse.select("__ip", F.col("country").alias("__country")), "__ip", "left")
        found = found.withColumn("country", F.coalesce("country", "__country"))
    located = store(found.select("__text", *fields))
    out, small = df, is_small(located)
    for ip, prefix in ips.items():
        dim = located.select(F.col("__text").alias(ip), *[F.col(f).alias(f"{prefix}{f}") for f in fields])
        out = attach(out, dim, [ip], spread_by=spread_by, small=small)
    return out


def column_join(tables: Sequence[DataFrame], row_id: str) -> DataFrame:
    """Tables that share a row id, side by side."""
    out, *rest = tables
    for t in rest:
        out = out.join(t, row_id)
    return out
