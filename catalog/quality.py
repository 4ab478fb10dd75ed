"""Row validation."""

from datetime import date

from pyspark.sql import functions as F

from wardline.operators import quality as Q

from .base import RAW_NAMES, WITH_LOG, netlog, query, table

AS_OF = date(2024, 1, 20)

# Bad entries planted by row number, the same expressions on both sides.
_BAD = {
    "Timestamp": "CASE WHEN event_id % 97 = 0 THEN '' WHEN event_id % 97 = 1 THEN 'not a time' WHEN event_id % 97 = 2 THEN concat('2024-01-', CAST(10 + event_id % 19 AS STRING), '   06:33:58') ELSE '1/15/2024 06:33' END",
    "Source IP Address": "CASE WHEN event_id % 89 = 0 THEN '256.1.1.1' WHEN event_id % 89 = 1 THEN NULL WHEN event_id % 89 = 2 THEN '01.2.3.4' ELSE src_ip END",
    "Source Port": "CASE WHEN event_id % 83 = 0 THEN '70000' WHEN event_id % 83 = 1 THEN 'http' WHEN event_id % 83 = 2 THEN '80.7' WHEN event_id % 83 = 3 THEN NULL ELSE CAST(src_port AS STRING) END",
    "Anomaly Scores": "CASE WHEN event_id % 79 = 0 THEN '100.5' WHEN event_id % 79 = 1 THEN NULL WHEN event_id % 79 = 2 THEN 'high' WHEN event_id % 79 = 3 THEN 'NaN' ELSE '28.67' END",
    "Protocol": "CASE WHEN event_id % 73 = 0 THEN 'SCTP' WHEN event_id % 73 = 1 THEN '  ' ELSE protocol END",
    "Malware Indicators": "CASE WHEN event_id % 71 = 0 THEN 'maybe' ELSE malware END",
    "Device Information": "CASE WHEN event_id % 67 = 0 THEN 'short' ELSE device END",
    "Proxy Information": "CASE WHEN event_id % 61 = 0 THEN '1.2.3' ELSE proxy END",
}


def _bad_log(spark, sf):
    names = {n: F.col(c) for c, n in RAW_NAMES.items()} | {n: F.expr(e) for n, e in _BAD.items()}
    return netlog(spark, sf).select("event_id", *[c.alias(n) for n, c in names.items()])


_B = ", ".join(f'{e} AS "{n}"' for n, e in _BAD.items())
_BAD_SQL = WITH_LOG + f", bad AS (SELECT event_id, packet_length, {_B} FROM netlog)"
_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IPV4 = f"regexp_full_match({{0}}, '({_OCTET}\\.){{{{3}}}}{_OCTET}')"


def _ipv4(c):
    return _IPV4.format(c)


_NUM = "CAST(trunc(CASE WHEN lower({0}) <> 'nan' THEN TRY_CAST({0} AS DOUBLE) END) AS BIGINT)"
_TS_BAD = """CASE WHEN event_id % 97 = 0 OR event_id % 97 = 1 THEN 1 WHEN event_id % 97 = 2 AND 10 + event_id % 19 > 20 THEN 1 ELSE 0 END"""
_ERRORS = f"""({_TS_BAD}
 + CASE WHEN "Source IP Address" IS NULL OR NOT {_ipv4('"Source IP Address"')} THEN 1 ELSE 0 END
 + CASE WHEN {_NUM.format('"Source Port"')} BETWEEN 0 AND 65535 THEN 0 ELSE 1 END
 + CASE WHEN packet_length BETWEEN 0 AND 2000 THEN 0 ELSE 1 END
 + CASE WHEN "Anomaly Scores" IN ('100.5', 'high') THEN 1 ELSE 0 END
 + CASE WHEN trim("Protocol") IN ('TCP', 'UDP', 'ICMP') THEN 0 ELSE 1 END
 + CASE WHEN "Malware Indicators" IS NULL OR "Malware Indicators" = 'IoC Detected' THEN 0 ELSE 1 END
 + CASE WHEN length("Device Information") >= 10 THEN 0 ELSE 1 END
 + CASE WHEN "Proxy Information" IS NULL OR {_ipv4('"Proxy Information"')} THEN 0 ELSE 1 END)"""


@query("validate_rows", f"{_BAD_SQL} SELECT event_id, CAST({_ERRORS} AS INT) AS n_errors, {_ERRORS} = 0 AS is_valid FROM bad")
def _(spark, sf):
    out = Q.validate_rows(_bad_log(spark, sf), as_of=AS_OF)
    return out.select("event_id", F.size("errors").alias("n_errors"), "is_valid")


@query(
    "validate_rows_messages",
    f"""{_BAD_SQL}, m AS (SELECT event_id, list_filter([
 CASE WHEN event_id % 97 = 0 THEN 'Timestamp is required' WHEN event_id % 97 = 1 THEN 'Timestamp: {Q.BAD_TIMESTAMP}'
  WHEN event_id % 97 = 2 AND 10 + event_id % 19 > 20 THEN 'Timestamp: {Q.FUTURE_DATE}' END,
 CASE WHEN "Source IP Address" IS NULL THEN 'Source IP Address is required' WHEN NOT {_ipv4('"Source IP Address"')} THEN 'Source IP Address: {Q.BAD_IP}' END,
 CASE WHEN {_NUM.format('"Source Port"')} IS NULL THEN 'Source Port must be numeric' WHEN {_NUM.format('"Source Port"')} > 65535 THEN 'Source Port: {Q.BAD_PORT}' END,
 CASE WHEN packet_length NOT BETWEEN 0 AND 2000 THEN 'Packet Length: {Q.BAD_LENGTH}' END,
 CASE WHEN "Anomaly Scores" = '100.5' THEN 'Anomaly Scores: {Q.BAD_SCORE}' WHEN "Anomaly Scores" = 'high' THEN 'Anomaly Scores must be numeric' END,
 CASE WHEN trim("Protocol") = '' THEN 'Protocol is required and must be TCP or UDP or ICMP' WHEN "Protocol" = 'SCTP' THEN 'Protocol must be TCP or UDP or ICMP' END,
 CASE WHEN "Malware Indicators" = 'maybe' THEN 'Malware Indicators must be None or IoC Detected' END,
 CASE WHEN "Device Information" = 'short' THEN 'Device Information: {Q.SHORT_DEVICE}' END,
 CASE WHEN "Proxy Information" = '1.2.3' THEN 'Proxy Information: {Q.BAD_IP}' END], lambda x: x IS NOT NULL) AS e FROM bad)
 SELECT event_id, CASE WHEN len(e) = 0 THEN '' ELSE concat('Row ', event_id + 1, ':', chr(10), '  • ', array_to_string(e, concat(chr(10), '  • '))) END AS message FROM m""",
)
def _(spark, sf):
    return Q.validate_rows(_bad_log(spark, sf), as_of=AS_OF, row_id="event_id").select("event_id", "message")


@query(
    "validation_summary",
    f"""{_BAD_SQL} SELECT CAST(sum({_ERRORS}) AS BIGINT) AS field_errors, CAST(count(*) FILTER ({_ERRORS} > 0) AS BIGINT) AS bad_rows,
 count(*) FILTER ({_ERRORS} > 0) = 0 AS may_score FROM bad""",
)
def _(spark, sf):
    return Q.validation_summary(Q.validate_rows(_bad_log(spark, sf), as_of=AS_OF))


@query(
    "first_bad_rows",
    f"{_BAD_SQL} SELECT event_id, CAST({_ERRORS} AS INT) AS n_errors FROM bad WHERE {_ERRORS} > 0 ORDER BY event_id LIMIT 15",
)
def _(spark, sf):
    bad = Q.first_bad_rows(Q.validate_rows(_bad_log(spark, sf), as_of=AS_OF), "event_id")
    return bad.select("event_id", F.size("errors").alias("n_errors"))


@query("valid_timestamp", f"{_BAD_SQL} SELECT event_id, {_TS_BAD} = 0 AS ok FROM bad")
def _(spark, sf):
    return _bad_log(spark, sf).select("event_id", Q.valid_timestamp("Timestamp", AS_OF).alias("ok"))


@query("valid_ipv4", f"""{_BAD_SQL} SELECT event_id, coalesce({_ipv4('"Source IP Address"')}, false) AS ok FROM bad""")
def _(spark, sf):
    return _bad_log(spark, sf).select("event_id", Q.valid_ipv4("Source IP Address").alias("ok"))


@query("valid_ip_optional", f"""{_BAD_SQL} SELECT event_id, coalesce({_ipv4('"Proxy Information"')}, true) AS ok FROM bad""")
def _(spark, sf):
    return _bad_log(spark, sf).select("event_id", Q.valid_ip_optional("Proxy Information").alias("ok"))


@query(
    "valid_port",
    f"""{_BAD_SQL} SELECT event_id, coalesce({_NUM.format('"Source Port"')} BETWEEN 0 AND 65535, false) AS ok FROM bad""",
)
def _(spark, sf):
    return _bad_log(spark, sf).select("event_id", Q.valid_port("Source Port").alias("ok"))


@query(
    "valid_packet_length",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, trunc(l_extendedprice / 40) BETWEEN 0 AND 2000 AS ok FROM lineitem",
)
def _(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        Q.valid_packet_length(F.col("l_extendedprice") / 40).alias("ok"),
    )


@query(
    "valid_score",
    f"""{_BAD_SQL} SELECT event_id, "Anomaly Scores" IS NULL OR "Anomaly Scores" NOT IN ('100.5', 'high') AS ok,
 "Anomaly Scores" = '28.67' IS TRUE AS ok_required FROM bad""",
)
def _(spark, sf):
    return _bad_log(spark, sf).select(
        "event_id", Q.valid_score("Anomaly Scores").alias("ok"), Q.valid_score("Anomaly Scores", null_ok=False).alias("ok_required")
    )


@query(
    "valid_user_agent",
    f"""{_BAD_SQL} SELECT event_id, length("Device Information") >= 10 AS ok, coalesce(length("Proxy Information") >= 10, true) AS optional_ok,
 coalesce(length("Proxy Information") >= 10, false) AS required_ok FROM bad""",
)
def _(spark, sf):
    return _bad_log(spark, sf).select(
        "event_id", Q.valid_user_agent("Device Information", False).alias("ok"),
        Q.valid_user_agent("Proxy Information").alias("optional_ok"),
        Q.valid_user_agent("Proxy Information", False).alias("required_ok"),
    )


_HMS = "concat(CAST(event_id % 30 AS STRING), ':', CAST(event_id % 70 AS STRING), ':', CAST(event_id % 65 AS STRING))"


@query(
    "valid_time_hms",
    "SELECT event_id, event_id % 30 < 24 AND event_id % 70 < 60 AND event_id % 65 < 60 AS ok FROM events",
)
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", Q.valid_time_hms(F.expr(_HMS)).alias("ok"))


@query(
    "valid_domain",
    f"""{_BAD_SQL} SELECT event_id, trim("Protocol") IN ('TCP', 'UDP', 'ICMP') AS ok,
 "Malware Indicators" IS NULL OR "Malware Indicators" = 'IoC Detected' AS optional_ok FROM bad""",
)
def _(spark, sf):
    return _bad_log(spark, sf).select(
        "event_id", Q.valid_domain("Protocol", Q.REQUIRED_DOMAINS["Protocol"]).alias("ok"),
        Q.valid_domain("Malware Indicators", Q.OPTIONAL_DOMAINS["Malware Indicators"], True).alias("optional_ok"),
    )
