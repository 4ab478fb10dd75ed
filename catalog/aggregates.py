"""Counts, cross tabulations, profiles."""

from pyspark.sql import functions as F

from wardline.operators import crosstab as X
from wardline.operators import profile as P

from .base import WITH_LOG, geo_ranges, ip_number_sql, netlog, query, rounded, table
from .scalars import _BUCKET_SQL, _PRIVATE
from wardline.functions.network import is_private_ip
from wardline.functions.timeparts import hour_bucket
from wardline.operators.lookup import ip_geolocate_all
from .base import GEO_SQL

_CLASSES = ("DDoS", "Intrusion", "Malware")


def _counts(row: str, classes=_CLASSES, target: str = "attack_type") -> str:
    return ", ".join(f'count(*) FILTER ({target} = \'{c}\') AS "{c}"' for c in classes)


def _pcts(classes=_CLASSES, target: str = "attack_type", digits: int = 6) -> str:
    return ", ".join(
        f'round(count(*) FILTER ({target} = \'{c}\') * 100.0 / count(*), {digits}) AS "{c}"' for c in classes
    )


@query(
    "value_counts",
    WITH_LOG
    + """ SELECT protocol AS value, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS share,
 CASE protocol WHEN 'TCP' THEN 'Transmission' ELSE protocol END AS label FROM netlog GROUP BY protocol""",
)
def _(spark, sf):
    return P.value_counts(netlog(spark, sf), "protocol", share=True, labels={"TCP": "Transmission"})


@query("value_counts_nulls_dropped", WITH_LOG + " SELECT proxy AS value, count(*) AS n FROM netlog WHERE proxy IS NOT NULL GROUP BY 1")
def _(spark, sf):
    return P.value_counts(netlog(spark, sf), "proxy")


@query(
    "value_counts_null_sorted",
    WITH_LOG
    + """ SELECT malware AS value, attack_type AS class, count(*) AS n FROM netlog GROUP BY 1, 2
 UNION ALL SELECT malware, NULL, count(*) FROM netlog GROUP BY 1""",
)
def _(spark, sf):
    return P.value_counts_null_sorted(netlog(spark, sf), "malware", "attack_type")


@query("group_mean", WITH_LOG + " SELECT attack_type, round(avg(packet_length), 6) AS mean FROM netlog GROUP BY 1")
def _(spark, sf):
    return rounded(P.group_mean(netlog(spark, sf), "attack_type", "packet_length"), "mean")


def _describe_sql(cols):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
 CAST(min({c}) AS DOUBLE) AS min, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median,
 quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3, CAST(max({c}) AS DOUBLE) AS max FROM lineitem"""
        for c in cols
    )


@query(
    "describe",
    "SELECT feature, n, mean, std, min, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, max FROM ("
    + _describe_sql(["l_quantity", "l_extendedprice", "l_discount", "l_partkey"]) + ") s",
)
def _(spark, sf):
    out = P.describe(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_partkey"])
    return rounded(out, "mean", "std", "q1", "median", "q3")


def _missing_sql(cols):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, count(*) - count({c}) AS nulls, round((count(*) - count({c})) * 100.0 / count(*), 6) AS null_pct,
 count(DISTINCT {c}) AS distinct_values, round(count(DISTINCT {c}) * 100.0 / count(*), 6) AS distinct_pct FROM netlog"""
        for c in cols
    )


_PROFILED = ["event_id", "attack_type", "src_ip", "proxy", "malware", "alert", "geo", "dst_port"]


@query("missing_profile", WITH_LOG + " " + _missing_sql(_PROFILED))
def _(spark, sf):
    return rounded(P.missing_profile(netlog(spark, sf), _PROFILED), "null_pct", "distinct_pct")


@query("missing_profile_approx")
def _(spark, sf):
    return P.missing_profile(netlog(spark, sf), _PROFILED, approx=True)


@query("date_range", "SELECT min(ts) AS first_ts, max(ts) AS last_ts FROM events")
def _(spark, sf):
    return P.date_range(table(spark, sf, "events"), "ts")


@query(
    "quantile_thresholds",
    """SELECT p AS prob, round(quantile, 6) AS quantile FROM (SELECT 0.95::DOUBLE AS p, quantile_cont(l_extendedprice, 0.95) AS quantile FROM lineitem
 UNION ALL SELECT 0.99::DOUBLE, quantile_cont(l_extendedprice, 0.99) FROM lineitem) s""",
)
def _(spark, sf):
    return rounded(P.quantile_thresholds(table(spark, sf, "lineitem"), "l_extendedprice"), "quantile")


@query("crosstab_counts", WITH_LOG + f" SELECT protocol, {_counts('protocol')} FROM netlog GROUP BY protocol")
def _(spark, sf):
    return X.crosstab_counts(netlog(spark, sf), "protocol", "attack_type")


@query("crosstab_row_pct", WITH_LOG + f" SELECT severity, {_pcts()} FROM netlog GROUP BY severity")
def _(spark, sf):
    return rounded(X.crosstab_row_pct(netlog(spark, sf), "severity", "attack_type"), *_CLASSES)


@query(
    "crosstab_margins",
    WITH_LOG + f' SELECT protocol, severity, {_counts("")}, count(*) AS "n obs" FROM netlog GROUP BY 1, 2',
)
def _(spark, sf):
    return X.crosstab_margins(netlog(spark, sf), ["protocol", "severity"], "attack_type")


@query(
    "crosstab_bias",
    WITH_LOG
    + f""" SELECT hour, {_pcts()}, count(*) AS "n obs", round(count(*) * 100.0 / (SELECT count(*) FROM netlog), 6) AS "% obs"
 FROM (SELECT *, {_BUCKET_SQL['hour_bucket']} AS hour FROM netlog) s GROUP BY hour""",
)
def _(spark, sf):
    log = netlog(spark, sf).withColumn("hour", hour_bucket("ts"))
    return rounded(X.crosstab_bias(log, ["hour"], "attack_type"), *_CLASSES, "% obs")


@query(
    "crosstab_bias_many_keys",
    WITH_LOG
    + f""" SELECT protocol, severity, traffic_type, coalesce(malware, 'nan') AS ioc, {_pcts()}, count(*) AS "n obs",
 round(count(*) / 27.0, 6) AS "% obs" FROM netlog GROUP BY 1, 2, 3, 4""",
)
def _(spark, sf):
    log = netlog(spark, sf).withColumnRenamed("malware", "ioc")
    out = X.crosstab_bias(
        log, ["protocol", "severity", "traffic_type", "ioc"], "attack_type", null_key="nan", pct_denominator="columns"
    )
    return rounded(out, *_CLASSES, "% obs")


@query(
    "crosstab_grand_pct",
    "SELECT l_linenumber, "
    + ", ".join(f"round(count(*) FILTER (l_returnflag = '{c}') * 100.0 / (SELECT count(*) FROM lineitem), 6) AS \"{c}\"" for c in "ANR")
    + " FROM lineitem GROUP BY 1",
)
def _(spark, sf):
    return rounded(X.crosstab_grand_pct(table(spark, sf, "lineitem"), ["l_linenumber"], "l_returnflag"), "A", "N", "R")


@query(
    "grouped_flags",
    WITH_LOG
    + f""", s AS (SELECT attack_type, CAST({_PRIVATE.format('src_ip')} AS INT) AS src, CAST({_PRIVATE.format('dst_ip')} AS INT) AS dst FROM netlog)
 SELECT attack_type, CAST(sum(src) AS BIGINT) AS src_count, round(avg(src) * 100, 6) AS src_pct, CAST(sum(dst) AS BIGINT) AS dst_count,
 round(avg(dst) * 100, 6) AS dst_pct FROM s GROUP BY 1""",
)
def _(spark, sf):
    log = netlog(spark, sf).select("attack_type", is_private_ip("src_ip").alias("src"), is_private_ip("dst_ip").alias("dst"))
    return rounded(P.grouped_flags(log, "attack_type", ["src", "dst"]), "src_pct", "dst_pct")


@query(
    "flag_totals",
    WITH_LOG + " SELECT count(malware) AS malware, count(alert) AS alert, count(proxy) AS proxy FROM netlog",
)
def _(spark, sf):
    flags = ["malware", "alert", "proxy"]
    return P.flag_totals(netlog(spark, sf).select(*[F.col(c).isNotNull().cast("int").alias(c) for c in flags]), flags)


@query(
    "private_ip_stats",
    WITH_LOG
    + f""", s AS (SELECT {_PRIVATE.format('src_ip')} AS a, {_PRIVATE.format('dst_ip')} AS b FROM netlog)
 SELECT count(*) FILTER (a) AS private_src, round(avg(a::INT) * 100, 6) AS private_src_pct, count(*) FILTER (b) AS private_dst,
 round(avg(b::INT) * 100, 6) AS private_dst_pct, count(*) FILTER (a OR b) AS private_any FROM s""",
)
def _(spark, sf):
    return rounded(P.private_ip_stats(netlog(spark, sf), "src_ip", "dst_ip"), "private_src_pct", "private_dst_pct")


@query("location_stats", WITH_LOG + " SELECT count(DISTINCT geo) AS locations, count(*) - count(geo) AS missing FROM netlog")
def _(spark, sf):
    return P.location_stats(netlog(spark, sf), "geo")


@query(
    "class_rate_report",
    WITH_LOG
    + """ SELECT attack_type, count(*) AS total, count(proxy) AS with_flag, round(count(proxy) * 100.0 / count(*), 6) AS with_pct,
 count(*) - count(proxy) AS without_flag, round(100.0 - count(proxy) * 100.0 / count(*), 6) AS without_pct FROM netlog GROUP BY 1""",
)
def _(spark, sf):
    log = netlog(spark, sf).select("attack_type", F.col("proxy").isNotNull().alias("has_proxy"))
    return rounded(P.class_rate_report(log, "attack_type", "has_proxy"), "with_pct", "without_pct")


@query(
    "rate_over_time",
    WITH_LOG
    + " SELECT CAST(ts AS DATE) AS day, count(*) AS n, count(proxy) AS with_flag, round(count(proxy) * 100.0 / count(*), 6) AS pct FROM netlog GROUP BY 1",
)
def _(spark, sf):
    log = netlog(spark, sf).select("ts", F.col("proxy").isNotNull().alias("has_proxy"))
    return rounded(P.rate_over_time(log, "ts", "has_proxy"), "pct")


@query("fan_out", WITH_LOG + " SELECT src_ip AS key, count(DISTINCT dst_ip) AS degree FROM netlog GROUP BY 1")
def _(spark, sf):
    return P.fan_out(netlog(spark, sf), "src_ip", "dst_ip")


@query("fan_in", WITH_LOG + " SELECT dst_ip AS key, count(DISTINCT src_ip) AS degree FROM netlog GROUP BY 1")
def _(spark, sf):
    return P.fan_in(netlog(spark, sf), "src_ip", "dst_ip")


@query(
    "fan_threshold_report",
    """WITH d AS (SELECT l_partkey AS key, count(DISTINCT l_suppkey) AS degree FROM lineitem GROUP BY 1),
 t AS (SELECT avg(degree) AS mean, quantile_cont(degree, 0.5) AS median, quantile_cont(degree, 0.95) AS p95, quantile_cont(degree, 0.99) AS p99,
  count(*) AS keys FROM d),
 a AS (SELECT count(*) FILTER (degree > p95) AS a95, count(*) FILTER (degree > p99) AS a99 FROM d, t)
 SELECT round(mean, 6) AS mean, median, round(p95, 6) AS p95, round(p99, 6) AS p99, a95 AS above_p95, a99 AS above_p99, keys,
  round(a95 * 100.0 / keys, 6) AS above_p95_pct, round(a99 * 100.0 / keys, 6) AS above_p99_pct FROM t, a""",
)
def _(spark, sf):
    degrees = P.fan_out(table(spark, sf, "lineitem"), "l_partkey", "l_suppkey")
    return rounded(P.fan_threshold_report(degrees), "mean", "p95", "p99", "above_p95_pct", "above_p99_pct")


@query(
    "suspicious_ips",
    """WITH d AS (SELECT l_partkey AS key, count(DISTINCT l_suppkey) AS degree FROM lineitem GROUP BY 1)
 SELECT key, degree FROM d WHERE degree > (SELECT quantile_cont(degree, 0.95) FROM d)""",
)
def _(spark, sf):
    return P.suspicious_ips(P.fan_out(table(spark, sf, "lineitem"), "l_partkey", "l_suppkey"), 0.95)


@query(
    "ip_stats",
    WITH_LOG
    + """ SELECT count(DISTINCT src_ip) AS sources, count(DISTINCT dst_ip) AS destinations, count(*) AS connections,
 round(count(*) / count(DISTINCT src_ip), 6) AS per_source, round(count(*) / count(DISTINCT dst_ip), 6) AS per_destination FROM netlog""",
)
def _(spark, sf):
    return rounded(P.ip_stats(netlog(spark, sf), "src_ip", "dst_ip"), "per_source", "per_destination")


_MODES = """, {0}_m AS (SELECT day, {0} FROM (SELECT day, c.{0}, row_number() OVER (PARTITION BY day ORDER BY c.n DESC, g.n DESC, c.{0}) AS r
 FROM (SELECT CAST(ts AS DATE) AS day, {0}, count(*) AS n FROM netlog WHERE {0} IS NOT NULL GROUP BY 1, 2) c
 JOIN (SELECT {0}, count(*) AS n FROM netlog GROUP BY 1) g USING ({0})) s WHERE r = 1)"""


@query(
    "daily_mode",
    WITH_LOG
    + _MODES.format("attack_type") + _MODES.format("dst_port") + _MODES.format("alert")
    + """ SELECT event_id, concat('{ ', a.attack_type, ' }') AS "attack_type max n d", concat('{ ', CAST(p.dst_port AS STRING), ' }') AS "dst_port max n d",
 concat('{ ', l.alert, ' }') AS "alert max n d" FROM netlog n LEFT JOIN attack_type_m a ON CAST(ts AS DATE) = a.day
 LEFT JOIN dst_port_m p ON CAST(ts AS DATE) = p.day LEFT JOIN alert_m l ON CAST(ts AS DATE) = l.day""",
)
def _(spark, sf):
    cols = ["attack_type", "dst_port", "alert"]
    out = P.daily_mode(netlog(spark, sf).select("event_id", "ts", *cols), "ts", cols)
    return out.select("event_id", *[F.col(f"`{c} max n d`") for c in cols])


@query(
    "mode_all_ties",
    """WITH c AS (SELECT CAST(o_orderdate AS DATE) AS day, o_orderpriority AS v, count(*) AS n FROM orders GROUP BY 1, 2),
 t AS (SELECT day, v FROM c QUALIFY n = max(n) OVER (PARTITION BY day))
 SELECT day, concat('{ ', string_agg(v, ' + ' ORDER BY v), ' }') AS label FROM t GROUP BY day""",
)
def _(spark, sf):
    return P.mode_all_ties(table(spark, sf, "orders"), "o_orderdate", "o_orderpriority")


@query(
    "top_value_per_class",
    WITH_LOG
    + """, c AS (SELECT attack_type, geo AS value, count(*) AS n FROM netlog WHERE geo IS NOT NULL GROUP BY 1, 2)
 SELECT attack_type, value, n FROM c QUALIFY row_number() OVER (PARTITION BY attack_type ORDER BY n DESC, value) = 1""",
)
def _(spark, sf):
    return P.top_value_per_class(netlog(spark, sf), "attack_type", "geo")


@query("pivot_daily", WITH_LOG + " SELECT CAST(ts AS DATE) AS day, " + _counts("", ("ICMP", "TCP", "UDP"), "protocol") + " FROM netlog GROUP BY 1")
def _(spark, sf):
    return P.pivot_daily(netlog(spark, sf), "ts", "protocol", ["ICMP", "TCP", "UDP"])


@query("pivot_daily_open", WITH_LOG + " SELECT CAST(ts AS DATE) AS day, src_port AS value, count(*) AS n FROM netlog GROUP BY 1, 2")
def _(spark, sf):
    return P.pivot_daily(netlog(spark, sf), "ts", "src_port")


@query(
    "box_stats",
    """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3
  FROM events GROUP BY 1),
 w AS (SELECT *, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM q)
 SELECT event_type, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, min(value) FILTER (value BETWEEN low AND high) AS whisker_low,
  max(value) FILTER (value BETWEEN low AND high) AS whisker_high, count(*) FILTER (value NOT BETWEEN low AND high) AS outliers
 FROM events JOIN w USING (event_type) GROUP BY event_type, q1, median, q3""",
)
def _(spark, sf):
    return rounded(P.box_stats(table(spark, sf, "events"), "value", "event_type"), "q1", "median", "q3")


@query(
    "strip_points",
    """SELECT CAST(dense_rank() OVER (ORDER BY event_type) - 1 AS INT) AS class_rank, event_type AS class, value,
 count(*) OVER (PARTITION BY event_type) AS n_class FROM events""",
)
def _(spark, sf):
    return P.strip_points(table(spark, sf, "events"), "value", "event_type")


_GEO_POINTS = """SELECT '{0}' AS side, attack_type AS class, latitude AS lat, longitude AS lon, anomaly AS score FROM netlog
 JOIN g ON {1} BETWEEN ip_start AND ip_end"""


@query(
    "geo_points",
    WITH_LOG
    + f""", g AS ({GEO_SQL}), p AS ({_GEO_POINTS.format('source', ip_number_sql('src_ip'))} UNION ALL {_GEO_POINTS.format('destination', ip_number_sql('dst_ip'))})
 SELECT side, class, lat, lon, score, min(score) OVER (PARTITION BY side, class) AS min_score, max(score) OVER (PARTITION BY side, class) AS max_score FROM p""",
)
def _(spark, sf):
    log, ranges = netlog(spark, sf).select("attack_type", "anomaly", "src_ip", "dst_ip"), geo_ranges(spark, sf)
    log = ip_geolocate_all(log, {"src_ip": "src_", "dst_ip": "dst_"}, ranges)
    sides = {"source": ("src_latitude", "src_longitude"), "destination": ("dst_latitude", "dst_longitude")}
    return P.geo_points(log, "attack_type", "anomaly", sides)


@query(
    "dataset_summary",
    WITH_LOG
    + """, t AS (SELECT count(*) AS n FROM netlog)
 SELECT 'rows' AS metric, '' AS name, CAST(count(*) AS DOUBLE) AS value FROM netlog
 UNION ALL SELECT 'proxy_rate', '', round(count(proxy) * 100.0 / count(*), 6) FROM netlog
 UNION ALL SELECT 'sources', '', CAST(count(DISTINCT src_ip) AS DOUBLE) FROM netlog
 UNION ALL SELECT 'destinations', '', CAST(count(DISTINCT dst_ip) AS DOUBLE) FROM netlog
 UNION ALL SELECT 'mean_length', '', round(avg(packet_length), 6) FROM netlog
 UNION ALL SELECT 'class_share', attack_type, round(count(*) * 100.0 / max(n), 6) FROM netlog, t GROUP BY attack_type
 UNION ALL SELECT * FROM (SELECT 'top_protocol', protocol, round(count(*) * 100.0 / max(n), 6) FROM netlog, t GROUP BY protocol ORDER BY count(*) DESC, protocol LIMIT 1)
 UNION ALL SELECT * FROM (SELECT 'top_port', CAST(dst_port AS STRING), CAST(count(*) AS DOUBLE) FROM netlog GROUP BY 2 ORDER BY count(*) DESC, 2 LIMIT 1)""",
)
def _(spark, sf):
    roles = {"target": "attack_type", "proxy": "proxy", "src": "src_ip", "dst": "dst_ip", "length": "packet_length",
             "protocol": "protocol", "dst_port": "dst_port"}
    return rounded(P.dataset_summary(netlog(spark, sf), roles), "value")


@query("encoding_stats", """SELECT 'l_discount' AS feature, round(avg(l_discount), 6) AS mean, round(stddev_samp(l_discount), 6) AS std FROM lineitem
 UNION ALL SELECT 'l_tax', round(avg(l_tax), 6), round(stddev_samp(l_tax), 6) FROM lineitem""")
def _(spark, sf):
    return rounded(P.encoding_stats(table(spark, sf, "lineitem"), ["l_discount", "l_tax"]), "mean", "std")


@query("top_k", "SELECT l_partkey AS value, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, value LIMIT 15")
def _(spark, sf):
    return P.top_k(table(spark, sf, "lineitem"), "l_partkey", 15)


@query(
    "top_k_other",
    WITH_LOG
    + """, t AS (SELECT geo FROM netlog WHERE geo IS NOT NULL GROUP BY geo ORDER BY count(*) DESC, geo LIMIT 10)
 SELECT event_id, CASE WHEN geo IS NULL OR geo IN (SELECT geo FROM t) THEN geo ELSE 'other' END AS geo FROM netlog""",
)
def _(spark, sf):
    return P.top_k_other(netlog(spark, sf).select("event_id", "geo"), "geo", 10)


@query(
    "share_of_total",
    "SELECT o_orderpriority AS value, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS share FROM orders GROUP BY 1",
)
def _(spark, sf):
    return P.share_of_total(P.value_counts(table(spark, sf, "orders"), "o_orderpriority"))
