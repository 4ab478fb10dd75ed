"""The engineered columns as a table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.encoding import null_flag
from ..functions.network import is_private_ip, port_category
from ..operators.binning import cut_fixed, cut_quartiles
from ..operators.endpoints import flag_bidirectional


def engineered_export(df: DataFrame, roles: Mapping[str, str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Eight engineered columns; ``roles`` names ``proxy, src, dst, length, src_port, dst_port, score``."""
    r = roles
    needed = list(dict.fromkeys([*keep, *[r[k] for k in ("proxy", "src", "dst", "length", "src_port", "dst_port", "score")]]))
    out = flag_bidirectional(df.select(*[F.col(f"`{c}`") for c in needed]), r["src"], r["dst"])
    out = cut_quartiles(out, r["score"], output="anomaly_category")
    return out.select(
        *keep,
        null_flag(r["proxy"]).alias("has_proxy"),
        "is_bidirectional",
        is_private_ip(r["src"]).alias("src_is_private"),
        is_private_ip(r["dst"]).alias("dst_is_private"),
        cut_fixed(r["length"]).alias("packet_length_bin"),
        port_category(r["dst_port"], "long").alias("dst_port_category"),
        port_category(r["src_port"], "long").alias("src_port_category"),
        "anomaly_category",
    )
