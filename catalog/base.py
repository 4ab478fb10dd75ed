"""Shared inputs of the registered queries.

The test tables have no network log, so one is derived from ``events`` with integer arithmetic. The
same expression text runs in Spark and in the check SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the equivalent text for the check engine."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _ip(x: str) -> str:
    return (
        f"concat(CAST(CASE {x} % 7 WHEN 0 THEN 10 WHEN 1 THEN 172 WHEN 2 THEN 192 ELSE 20 + {x} * 53 % 150 END AS STRING), '.', "
        f"CAST(CASE {x} % 7 WHEN 1 THEN 10 + {x} % 30 WHEN 2 THEN 168 ELSE {x} * 31 % 256 END AS STRING), '.', "
        f"CAST({x} * 17 % 256 AS STRING), '.', CAST({x} * 7 % 256 AS STRING))"
    )


_K = "CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT)"

_UA = """CASE user_id % 8
 WHEN 0 THEN concat('Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/', CAST(80 + k % 40 AS STRING), '.0.4430.', CAST(user_id AS STRING), ' Safari/537.36')
 WHEN 1 THEN concat('Mozilla/5.0 (iPhone; CPU iPhone OS 14_', CAST(k % 8 AS STRING), ' like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/14.', CAST(k % 5 AS STRING), ' Mobile/15E148 Safari/604.1')
 WHEN 2 THEN concat('Mozilla/5.0 (X11; Linux x86_64; rv:', CAST(70 + k % 30 AS STRING), '.0) Gecko/20100101 Firefox/', CAST(70 + k % 30 AS STRING), '.0')
 WHEN 3 THEN concat('Mozilla/5.0 (iPad; CPU OS 13_3 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) CriOS/', CAST(80 + k % 10 AS STRING), '.0.3987.95 Mobile/15E148 Safari/604.1')
 WHEN 4 THEN concat('Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_', CAST(k % 8 AS STRING), ') AppleWebKit/605.1.15 (KHTML, like Gecko) Version/13.1 Safari/605.1.15')
 WHEN 5 THEN concat('Mozilla/5.0 (compatible; MSIE ', CAST(6 + k % 5 AS STRING), '.0; Windows NT 6.1; Trident/5.0)')
 WHEN 6 THEN concat('Mozilla/5.0 (Linux; Android 9; SM-G960F) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/', CAST(70 + k % 20 AS STRING), '.0.3729.157 Mobile Safari/537.36')
 ELSE concat('Mozilla/5.0 (compatible; Googlebot/2.', CAST(k % 3 AS STRING), '; +http://www.google.com/bot.html)') END"""

# (column, expression) over events plus k
NETLOG_COLUMNS = (
    ("event_id", "event_id"),
    ("ts", "ts"),
    ("user_id", "user_id"),
    ("k", "k"),
    ("value", "value"),
    ("attack_type", "CASE WHEN event_type = 'error' THEN 'DDoS' WHEN event_type IN ('click', 'view') THEN 'Intrusion' ELSE 'Malware' END"),
    ("src_ip", _ip("user_id")),
    ("dst_ip", _ip("k")),
    ("src_port", "CAST(event_id * 7919 % 65536 AS INT)"),
    ("dst_port", "CAST(k * 661 % 65536 AS INT)"),
    ("protocol", "CASE (event_id + user_id) % 4 WHEN 0 THEN 'TCP' WHEN 1 THEN 'UDP' WHEN 2 THEN 'TCP' ELSE 'ICMP' END"),
    ("packet_length", "CAST(floor(value * 4) AS INT)"),
    ("packet_type", "CASE WHEN event_id % 3 = 0 THEN 'Control' ELSE 'Data' END"),
    ("traffic_type", "CASE (user_id + k) % 3 WHEN 0 THEN 'HTTP' WHEN 1 THEN 'DNS' ELSE 'FTP' END"),
    ("malware", "CASE WHEN k % 2 = 0 THEN 'IoC Detected' END"),
    ("anomaly", "value * CAST(0.2 AS DOUBLE)"),
    ("alert", "CASE WHEN k % 10 < 4 THEN 'Alert Triggered' END"),
    ("signature", "CASE WHEN user_id % 2 = 0 THEN 'Known Pattern A' ELSE 'Known Pattern B' END"),
    ("action", "CASE event_id % 5 WHEN 0 THEN 'Blocked' WHEN 1 THEN 'Blocked' WHEN 2 THEN 'Logged' ELSE 'Ignored' END"),
    ("severity", "CASE (event_id + k) % 3 WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' ELSE 'High' END"),
    ("device", _UA),
    ("segment", "CASE user_id % 3 WHEN 0 THEN 'Segment A' WHEN 1 THEN 'Segment B' ELSE 'Segment C' END"),
    ("geo", "CASE WHEN event_id % 16 <> 0 THEN concat('City ', CAST(user_id % 25 AS STRING), ', State ', CAST(user_id % 5 AS STRING)) END"),
    ("proxy", f"CASE WHEN k % 2 = 1 THEN {_ip('event_id')} END"),
    ("firewall", "CASE WHEN (user_id + k) % 2 = 0 THEN 'Log Data' END"),
    ("ids", "CASE WHEN event_id % 2 = 0 THEN 'Alert Data' END"),
    ("log_source", "CASE WHEN (event_id + user_id) % 2 = 0 THEN 'Firewall' ELSE 'Server' END"),
)

_EVENTS_K = f"(SELECT *, {_K} AS k FROM events)"
NETLOG_SQL = "SELECT " + ",\n ".join(f"{e} AS {c}" for c, e in NETLOG_COLUMNS) + f" FROM {_EVENTS_K} e0"
# Start of a check text that reads the derived log as a table.
WITH_LOG = f"WITH netlog AS ({NETLOG_SQL})"

# Raw column name of each derived column.
RAW_NAMES = {
    "ts": "Timestamp", "src_ip": "Source IP Address", "dst_ip": "Destination IP Address",
    "src_port": "Source Port", "dst_port": "Destination Port", "protocol": "Protocol",
    "packet_length": "Packet Length", "packet_type": "Packet Type", "traffic_type": "Traffic Type",
    "malware": "Malware Indicators", "anomaly": "Anomaly Scores", "alert": "Alerts/Warnings",
    "attack_type": "Attack Type", "signature": "Attack Signature", "action": "Action Taken",
    "severity": "Severity Level", "device": "Device Information", "segment": "Network Segment",
    "geo": "Geo-location Data", "proxy": "Proxy Information", "firewall": "Firewall Logs",
    "ids": "IDS/IPS Alerts", "log_source": "Log Source",
}


def netlog(spark: SparkSession, sf: str) -> DataFrame:
    """The derived log."""
    events = table(spark, sf, "events").withColumn("k", F.expr(_K))
    return events.selectExpr(*[f"{e} AS {c}" for c, e in NETLOG_COLUMNS])


def raw_log(spark: SparkSession, sf: str, keep_id: bool = True) -> DataFrame:
    """The derived log under the raw column names."""
    log = netlog(spark, sf)
    names = [F.col(c).alias(n) for c, n in RAW_NAMES.items()]
    extra = [F.lit(None).cast("string").alias("Payload Data"), F.lit(None).cast("string").alias("User Information")]
    return log.select(*(["event_id"] if keep_id else []), *names, *extra)


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    """Round the floating results, which differ in the last bits between engines."""
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in cols})


# 25 equal address ranges with a gap at the end of each, from nation.
GEO_SQL = """SELECT CAST(n_nationkey AS BIGINT) * 171798691 AS ip_start,
 CAST(n_nationkey AS BIGINT) * 171798691 + 150000000 AS ip_end,
 CAST(n_nationkey AS DOUBLE) * 5 - 60 AS latitude, CAST(n_nationkey AS DOUBLE) * 11 - 130 AS longitude,
 n_name AS country, concat('City of ', n_name) AS city FROM nation"""


def geo_ranges(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").selectExpr(
        "CAST(n_nationkey AS BIGINT) * 171798691 AS ip_start",
        "CAST(n_nationkey AS BIGINT) * 171798691 + 150000000 AS ip_end",
        "CAST(n_nationkey AS DOUBLE) * 5 - 60 AS latitude",
        "CAST(n_nationkey AS DOUBLE) * 11 - 130 AS longitude",
        "n_name AS country",
        "concat('City of ', n_name) AS city",
    )


def ip_number_sql(col: str) -> str:
    """Check text: dotted address to its number."""
    part = lambda i: f"CAST(split_part({col}, '.', {i}) AS BIGINT)"
    return f"({part(1)} * 16777216 + {part(2)} * 65536 + {part(3)} * 256 + {part(4)})"
