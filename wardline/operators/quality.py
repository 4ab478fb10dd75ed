"""Row validation of raw log rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.network import IPV4_PATTERN, PORT_MAX
from ..functions.timeparts import parse_any_ts

# Allowed entries of the required columns.
REQUIRED_DOMAINS = {
    "Protocol": ("TCP", "UDP", "ICMP"),
    "Packet Type": ("Data", "Control"),
    "Traffic Type": ("HTTP", "DNS", "FTP"),
    "Severity Level": ("Low", "Medium", "High"),
    "Action Taken": ("Blocked", "Logged", "Ignored"),
    "Attack Signature": ("Known Pattern A", "Known Pattern B"),
    "Network Segment": ("Segment A", "Segment B", "Segment C"),
    "Log Source": ("Firewall", "Server"),
}
# Allowed entries of the columns that may be empty.
OPTIONAL_DOMAINS = {
    "Malware Indicators": ("None", "IoC Detected"),
    "Alerts/Warnings": ("None", "Alert Triggered"),
    "Firewall Logs": ("None", "Log Data"),
    "IDS/IPS Alerts": ("None", "Alert Data"),
}
# Limits of the numeric columns and of the device text.
PACKET_LENGTH_MAX, SCORE_MAX, USER_AGENT_MIN = 2000, 100.0, 10
# Message texts.
BAD_TIMESTAMP = "Invalid timestamp. Use formats like: YYYY-MM-DD HH:MM:SS or M/D/YYYY H:MM:SS AM/PM"
FUTURE_DATE = "Date cannot be in the future"
BAD_IP = "Invalid IPv4 address (e.g., 192.168.1.1)"
BAD_PORT = "Port must be 0-65535"
BAD_LENGTH = "Packet length must be 0-2000"
BAD_SCORE = "Score must be 0.0-100.0"
SHORT_DEVICE = "Device Information too short (min 10 chars)"
BULLET = "\n  • "


def _col(c: Column | str) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def _blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c.cast("string")) == "")


def _whole(c: Column) -> Column:
    """Text or number to a whole number, fractions cut off; null when not numeric."""
    number = c.cast("string").try_cast("double")
    return F.when(~F.isnan(number), number).try_cast("long")


def valid_timestamp(col: Column | str, as_of: date | Column) -> Column:
    """Readable in one of the accepted layouts and not after ``as_of``."""
    day = F.to_date(parse_any_ts(_col(col).cast("string")))
    limit = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return F.coalesce(day <= limit, F.lit(False))


def valid_ipv4(col: Column | str) -> Column:
    """Four octets 0-255 without leading zeros."""
    return F.coalesce(_col(col).rlike(IPV4_PATTERN), F.lit(False))


def valid_ip_optional(col: Column | str) -> Column:
    c = _col(col)
    return _blank(c) | valid_ipv4(c)


def valid_port(col: Column | str) -> Column:
    return F.coalesce(_whole(_col(col)).between(0, PORT_MAX), F.lit(False))


def valid_packet_length(col: Column | str) -> Column:
    return F.coalesce(_whole(_col(col)).between(0, PACKET_LENGTH_MAX), F.lit(False))


def valid_score(col: Column | str, null_ok: bool = True) -> Column:
    """Number in 0..100; missing and NaN pass when ``null_ok``."""
    c = _col(col)
    number = c.cast("string").try_cast("double")
    in_range = F.when(F.isnan(number), F.lit(null_ok)).otherwise(number.between(0.0, SCORE_MAX))
    return F.when(c.isNull(), F.lit(null_ok)).otherwise(F.coalesce(in_range, F.lit(False)))


def valid_user_agent(col: Column | str, optional: bool = True) -> Column:
    c = _col(col)
    return F.when(_blank(c), F.lit(optional)).otherwise(F.length(c) >= USER_AGENT_MIN)


def valid_time_hms(col: Column | str) -> Column:
    """``HH:MM:SS`` within the day; leading zeros may be left out."""
    pattern = r"^([01]?[0-9]|2[0-3]):[0-5]?[0-9]:([0-5]?[0-9]|6[01])$"
    c = _col(col)
    seconds = F.substring_index(c, ":", -1).try_cast("int")
    return F.coalesce(c.rlike(pattern) & (seconds <= 59), F.lit(False))


def valid_domain(col: Column | str, allowed: Sequence[str], optional: bool = False) -> Column:
    """Trimmed value is one of ``allowed``; a missing value passes when ``optional``."""
    c = _col(col)
    return F.when(_blank(c), F.lit(optional)).otherwise(F.trim(c.cast("string")).isin(*allowed))


def _rules(df: DataFrame, day: Column, as_of, required, optional) -> list[Column]:
    """One message-or-null column per rule, in reporting order; ``day`` is the parsed timestamp."""
    present = set(df.columns)

    def get(name: str, default: str = "") -> Column:
        return F.col(f"`{name}`").cast("string") if name in present else F.lit(default)

    ts = get("Timestamp")
    limit = as_of if isinstance(as_of, Column) else F.lit(as_of)
    out = [
        F.when(_blank(ts), F.lit("Timestamp is required"))
        .when(day.isNull(), F.lit(f"Timestamp: {BAD_TIMESTAMP}"))
        .when(day > limit, F.lit(f"Timestamp: {FUTURE_DATE}"))
    ]
    for name in ("Source IP Address", "Destination IP Address"):
        ip = get(name)
        out.append(
            F.when(_blank(ip), F.lit(f"{name} is required")).when(
                ~valid_ipv4(ip), F.lit(f"{name}: {BAD_IP}")
            )
        )
    for name, message, top in (
        ("Source Port", BAD_PORT, PORT_MAX),
        ("Destination Port", BAD_PORT, PORT_MAX),
        ("Packet Length", BAD_LENGTH, PACKET_LENGTH_MAX),
    ):
        number = _whole(get(name, "0"))
        out.append(
            F.when(number.isNull(), F.lit(f"{name} must be numeric")).when(
                ~number.between(0, top), F.lit(f"{name}: {message}")
            )
        )
    score = get("Anomaly Scores", "0")
    out.append(
        F.when(
            score.isNotNull() & score.try_cast("double").isNull(),
            F.lit("Anomaly Scores must be numeric"),
        ).when(~valid_score(score), F.lit(f"Anomaly Scores: {BAD_SCORE}"))
    )
    for name, allowed in required.items():
        value, choice = get(name), " or ".join(allowed)
        out.append(
            F.when(_blank(value), F.lit(f"{name} is required and must be {choice}")).when(
                ~valid_domain(value, allowed), F.lit(f"{name} must be {choice}")
            )
        )
    for name, allowed in optional.items():
        message = F.lit(f"{name} must be {' or '.join(allowed)}")
        out.append(F.when(~valid_domain(get(name), allowed, optional=True), message))
    device = get("Device Information")
    out.append(
        F.when(_blank(device), F.lit("Device Information is required")).when(
            F.length(device) < USER_AGENT_MIN, F.lit(f"Device Information: {SHORT_DEVICE}")
        )
    )
    proxy = get("Proxy Information")
    out.append(F.when(~valid_ip_optional(proxy), F.lit(f"Proxy Information: {BAD_IP}")))
    return out


def validate_rows(
    df: DataFrame,
    *,
    as_of: date | Column,
    row_id: str | None = None,
    required: Mapping[str, Sequence[str]] = REQUIRED_DOMAINS,
    optional: Mapping[str, Sequence[str]] = OPTIONAL_DOMAINS,
) -> DataFrame:
    """Add ``errors`` (messages), ``is_valid`` and, with ``row_id`` (counted from 0), the report
    text ``message``. Row-local, so it also runs on a streaming DataFrame."""
    text = F.col("Timestamp").cast("string") if "Timestamp" in df.columns else F.lit("")
    rules = _rules(df, F.col("__day"), as_of, required, optional)
    # The day is a column of its own, so that the layouts are tried once per row.
    out = df.withColumn("__day", F.to_date(parse_any_ts(text)))
    out = out.withColumn("errors", F.array_compact(F.array(*rules))).drop("__day")
    out = out.withColumn("is_valid", F.size("errors") == 0)
    if row_id is None:
        return out
    text = F.concat(
        F.lit("Row "),
        (F.col(f"`{row_id}`") + 1).cast("string"),
        F.lit(":" + BULLET),
        F.concat_ws(BULLET, "errors"),
    )
    return out.withColumn("message", F.when(F.col("is_valid"), F.lit("")).otherwise(text))


def validation_summary(validated: DataFrame) -> DataFrame:
    """Field errors, bad rows, and whether scoring may go on."""
    return validated.agg(
        F.coalesce(F.sum(F.size("errors")), F.lit(0)).cast("long").alias("field_errors"),
        F.count_if(~F.col("is_valid")).alias("bad_rows"),
    ).withColumn("may_score", F.col("bad_rows") == 0)


def first_bad_rows(validated: DataFrame, row_id: str, n: int = 15) -> DataFrame:
    """The first ``n`` rows with errors."""
    return validated.where(~F.col("is_valid")).orderBy(row_id).limit(n)
