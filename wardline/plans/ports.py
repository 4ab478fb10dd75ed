"""The port model's features, in training and in scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.encoding import null_flag, total_alerts
from ..functions.network import port_category, port_diff
from ..functions.timeparts import parse_ts, time_features
from ..operators.encoders import target_encode_cv, target_encode_full
from ..operators.joins import attach
from ..session import store
from ..operators.lookup import parse_user_agent
from ..operators.split import stratified_kfold

# Alert columns, numeric and binary features, encoded categories, dropped columns.
ALERT_COLUMNS = ("Malware Indicators", "Alerts/Warnings", "Firewall Logs", "IDS/IPS Alerts")
NUMERIC_FEATURES = (
    "Packet Length", "Anomaly Scores", "Source Port", "Destination Port", "port_diff", "hour", "dayofweek",
)
BINARY_FEATURES = (*ALERT_COLUMNS, "has_proxy", "is_weekend", "total_alerts")
ENCODED_CATEGORIES = (
    "Protocol", "Packet Type", "Traffic Type", "Attack Signature", "Action Taken", "Severity Level",
    "Network Segment", "Log Source", "src_port_cat", "dst_port_cat", "OS family", "Browser family",
    "Device type",
)
ENCODED_PORTS = ("Source Port", "Destination Port")
DROPPED = (
    "Timestamp", "Payload Data", "User Information", "Proxy Information", "Geo-location Data",
    "Source IP Address", "Destination IP Address",
)
PORT_FEATURES = (
    *NUMERIC_FEATURES, *BINARY_FEATURES, *[f"{c}_te" for c in (*ENCODED_CATEGORIES, *ENCODED_PORTS)],
)
# Defaults when scoring rows without time, device or encoding.
DEFAULT_HOUR_AND_DAY, DEFAULT_ENCODING = (12, 0), 1.0
DEFAULT_DEVICE, OTHER_DEVICE = {"OS family": "Windows", "Browser family": "Chrome", "Device type": "PC"}, "Other"


def base_features(df: DataFrame, serving: bool = False) -> DataFrame:
    """Flags, time parts, port classes, device fields and the alert sum; no target needed."""
    present = set(df.columns)
    flags = {c: null_flag(f"`{c}`") if c in present else F.lit(0) for c in ALERT_COLUMNS}
    flags["has_proxy"] = null_flag("Proxy Information") if "Proxy Information" in present else F.lit(0)
    out = df.withColumns(flags)
    if "Timestamp" not in present:
        out = out.withColumn("Timestamp", F.lit(None).cast("timestamp"))
    elif dict(df.dtypes)["Timestamp"] == "string":
        out = out.withColumn("Timestamp", parse_ts("Timestamp"))
    out = time_features(out, "Timestamp", DEFAULT_HOUR_AND_DAY if serving else None)
    style = "serving" if serving else "short"
    out = out.withColumns(
        {
            "src_port_cat": port_category("Source Port", style),
            "dst_port_cat": port_category("Destination Port", style),
            "port_diff": port_diff("Source Port", "Destination Port"),
            "total_alerts": total_alerts([F.col(f"`{c}`") for c in ALERT_COLUMNS]),
        }
    )
    if "Device Information" in present:
        out = parse_user_agent(out, "Device Information")
    if not serving:
        return out
    # Rows without the column count as the commonest device, a null or unknown user agent as another one.
    if "Device Information" not in present:
        return out.withColumns({c: F.lit(v) for c, v in DEFAULT_DEVICE.items()})
    return out.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(OTHER_DEVICE)) for c in DEFAULT_DEVICE})


def ports_features(
    df: DataFrame, target: str, id_col: str, *, n_splits: int = 5, seed: int = 42, full_ports: bool = False
) -> DataFrame:
    """All features of the port model; ``target`` is the numeric class code.

    Categories are encoded out of fold. Ports too, unless ``full_ports`` asks for the means over all
    rows, which leak the class.
    """
    # Folds first, while the rows are still cheap to read.
    folded = stratified_kfold(df, target, id_col, n_splits, seed, output="fold")
    out = base_features(folded).drop(*DROPPED)
    cv_cols = ENCODED_CATEGORIES if full_ports else (*ENCODED_CATEGORIES, *ENCODED_PORTS)
    out = target_encode_cv(out, cv_cols, target, id_col, fold_col="fold").drop("fold")
    return target_encode_full(out, ENCODED_PORTS, target) if full_ports else out


def serving_ports_features(df: DataFrame, src_means: DataFrame, dst_means: DataFrame) -> DataFrame:
    """Features for new rows: stored port means, a constant for the other encodings.

    The means tables are ``(value, te)`` per port.
    """
    out = base_features(df, serving=True)
    for col, means in (("Source Port", src_means), ("Destination Port", dst_means)):
        dim = store(means.select(F.col("value").cast("string").alias("__port"), F.col("te").alias(f"{col}_te")))
        out = attach(out.withColumn("__port", F.col(f"`{col}`").cast("string")), dim, ["__port"]).drop("__port")
        out = out.withColumn(f"{col}_te", F.coalesce(F.col(f"`{col}_te`"), F.lit(DEFAULT_ENCODING)))
    return out.withColumns({f"{c}_te": F.lit(DEFAULT_ENCODING) for c in ENCODED_CATEGORIES})
