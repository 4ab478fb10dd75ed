"""Raw log to the columns the feature operators expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.encoding import SEVERITY_ORDER, equals_flag, null_flag, ordinal_encode
from ..functions.network import ipv4_prefix
from ..functions.text import signature_prefix, split_city_state
from ..functions.timeparts import parse_ts, serving_time_buckets, time_buckets, time_indicators
from ..operators.columns import drop_columns, equality_indicator, rename_columns
from ..operators.lookup import ip_geolocate_all, parse_user_agent
from ..operators.profile import daily_mode

# Columns with a daily mode.
DAILY_MODE_COLUMNS = (
    "Attack Type", "Protocol", "Source Port", "Traffic Type", "Alert Trigger", "Firewall Logs",
    "Attack Signature patA", "Action Taken", "Browser family",
)


def enrich_log(df: DataFrame, geo_ranges: DataFrame | None = None, daily: bool = True) -> DataFrame:
    """Rename and drop, time parts, geolocation, indicators, device fields, flags and daily modes."""
    out = drop_columns(rename_columns(df), ["User Information", "Payload Data"])
    out = out.withColumn("date dd", F.date_trunc("day", "date"))
    out = time_buckets(time_indicators(out, "date"), "date")
    for side in ("Source", "Destination"):
        ip = F.col(f"{side} IP Address")
        out = out.withColumns({f"{side} IP {n}octet": ipv4_prefix(ip, n) for n in (1, 2, 3)})
    out = out.withColumn("Proxy usage", null_flag("Proxy Information"))
    # Indicator columns, their values and names.
    for col, values, names in (
        ("Protocol", ["UDP", "ICMP"], None),
        ("Packet Type", ["Control"], ["Control"]),
        ("Traffic Type", ["DNS", "HTTP"], None),
        ("Malware Indicators", ["IoC Detected"], ["/"]),
        ("Alert Trigger", ["Alert Triggered"], ["/"]),
        ("Attack Signature", ["Known Pattern A"], ["patA"]),
        ("Action Taken", ["Logged", "Blocked"], None),
        ("Network Segment", ["Segment A", "Segment B"], ["segA", "segB"]),
        ("Firewall Logs", ["Log Data"], ["/"]),
        ("IDS/IPS Alerts", ["Alert Data"], ["/"]),
        ("Log Source", ["Firewall"], ["Firewall"]),
    ):
        out = equality_indicator(out, col, values, names)
    out = out.withColumn("Severity Level", ordinal_encode("Severity Level", SEVERITY_ORDER))
    out = parse_user_agent(out, "Device Information")
    city, state = split_city_state(F.col("`Geo-location Data`"))
    out = out.withColumns({"Geo-location City": city, "Geo-location State": state})
    if daily:
        out = daily_mode(out, "date", DAILY_MODE_COLUMNS)
    if geo_ranges is not None:
        prefixes = {
            "Source IP Address": "Source IP ",
            "Destination IP Address": "Destination IP ",
            "Proxy Information": "Proxy ",
        }
        out = ip_geolocate_all(out, prefixes, geo_ranges)
    return out


def serving_preprocess(df: DataFrame) -> DataFrame:
    """Raw rows to model columns at scoring time; columns that are absent get their default."""
    present = set(df.columns)
    out = rename_columns(df)
    if dict(out.dtypes)["date"] == "string":
        out = out.withColumn("date", parse_ts("date"))
    out = out.withColumn("date dd", F.date_trunc("day", "date"))
    out = serving_time_buckets(out, "date")
    if "Device Information" in present:
        out = parse_user_agent(out, "Device Information").withColumns(
            {
                c: F.coalesce(F.col(f"`{c}`"), F.lit("Other"))
                for c in ("Browser family", "OS family", "Device type")
            }
        )
    else:
        out = out.withColumns({c: F.lit("Other") for c in ("Browser family", "OS family", "Device type")})

    def flag_text(column: Column) -> Column:
        return column.cast("string")

    proxy = flag_text(null_flag("Proxy Information")) if "Proxy Information" in present else F.lit("0")
    signature = signature_prefix("Attack Signature") if "Attack Signature" in present else F.lit("Unknown")
    source = flag_text(equals_flag("Log Source", "Firewall")) if "Log Source" in present else F.lit("0")
    out = out.withColumns(
        {"Proxy usage": proxy, "Attack Signature patA": signature, "Log Source Firewall": source}
    )
    flags = [c for c in ("Alert Trigger", "Malware Indicators") if c in out.columns]
    return out.withColumns({c: flag_text(null_flag(c)) for c in flags})
