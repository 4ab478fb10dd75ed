"""Flow links and category paths."""

from pyspark.sql import functions as F

from wardline.operators import flows as W
from wardline.operators.lookup import ip_geolocate_all

from .base import GEO_SQL, WITH_LOG, geo_ranges, ip_number_sql, netlog, query, rounded, table


def _countries(spark, sf):
    log, ranges = netlog(spark, sf).select("src_ip", "proxy", "dst_ip"), geo_ranges(spark, sf)
    sides = {"src_ip": "source_", "proxy": "via_", "dst_ip": "destination_"}
    log = ip_geolocate_all(log, sides, ranges, fields=["country"])
    return log.select(*[F.col(f"{p}country").alias(p[:-1]) for p in sides.values()])


_GEO_JOIN = " ".join(
    f"LEFT JOIN g {a} ON {ip} IS NOT NULL AND {ip_number_sql(ip)} BETWEEN {a}.ip_start AND {a}.ip_end"
    for ip, a in (("src_ip", "s"), ("proxy", "v"), ("dst_ip", "d"))
)


def _top_sql(col: str, n: int, source: str = "c") -> str:
    return f"""{col}_t AS (SELECT {col} FROM {source} WHERE {col} IS NOT NULL GROUP BY {col} ORDER BY count(*) DESC, {col} LIMIT {n})"""


def _other_sql(col: str) -> str:
    return f"CASE WHEN {col} IS NULL OR {col} IN (SELECT {col} FROM {col}_t) THEN {col} ELSE 'other' END AS {col}"


_LEVELS = ("source", "via", "destination")
_FLOW_SQL = (
    WITH_LOG
    + f", g AS ({GEO_SQL}), c AS (SELECT s.country AS source, v.country AS via, d.country AS destination FROM netlog {_GEO_JOIN}), "
    + ", ".join(_top_sql(c, 5) for c in _LEVELS)
    + f", r AS (SELECT {', '.join(_other_sql(c) for c in _LEVELS)} FROM c)"
    + ", p AS (SELECT source, via, destination, count(*) AS n FROM r WHERE source IS NOT NULL AND via IS NOT NULL AND destination IS NOT NULL GROUP BY 1, 2, 3)"
)


@query("flow_counts", _FLOW_SQL + " SELECT * FROM p")
def _(spark, sf):
    return W.flow_counts(_countries(spark, sf), _LEVELS, 5)


def _links_sql(levels, source: str = "p") -> str:
    return " UNION ALL ".join(
        f"""SELECT {i} AS level, concat('{a} ', CAST({a} AS STRING)) AS src, concat('{b} ', CAST({b} AS STRING)) AS dst,
 CAST(sum(n) AS BIGINT) AS weight FROM {source} GROUP BY 2, 3"""
        for i, (a, b) in enumerate(zip(levels, levels[1:]))
    )


@query("flow_links", _FLOW_SQL + " " + _links_sql(_LEVELS))
def _(spark, sf):
    return W.flow_links(W.flow_counts(_countries(spark, sf), _LEVELS, 5), _LEVELS)


_FEATURES = ("geo", "protocol", "malware", "severity")
_FEATURE_SQL = (
    WITH_LOG
    + ", c AS (SELECT geo, protocol, malware, severity, attack_type FROM netlog), "
    + _top_sql("geo", 10)
    + f", r AS (SELECT {_other_sql('geo')}, protocol, malware, severity, attack_type FROM c WHERE malware IS NOT NULL AND geo IS NOT NULL)"
)


@query(
    "feature_flow_links",
    _FEATURE_SQL + ", p AS (SELECT geo, protocol, malware, severity, attack_type, count(*) AS n FROM r GROUP BY ALL) " + _links_sql((*_FEATURES, "attack_type")),
)
def _(spark, sf):
    return W.feature_flow_links(netlog(spark, sf), _FEATURES, "attack_type", 10, top_cols=["geo"])


@query(
    "feature_flow_table",
    _FEATURE_SQL + " SELECT geo, protocol, malware AS malware, severity, "
    + ", ".join(f"round(count(*) FILTER (attack_type = '{c}') * 100.0 / (SELECT count(*) FROM r), 6) AS pct_{c.lower()}" for c in ("DDoS", "Intrusion", "Malware"))
    + " FROM r GROUP BY 1, 2, 3, 4",
)
def _(spark, sf):
    log = netlog(spark, sf).withColumnRenamed("malware", "ioc")
    out = W.feature_flow_table(log, ("geo", "protocol", "ioc", "severity"), "attack_type", 10, top_cols=["geo"])
    names = {"DDoS": "pct_ddos", "Intrusion": "pct_intrusion", "Malware": "pct_malware"}
    return rounded(out.withColumnsRenamed(names), *names.values()).withColumnRenamed("ioc", "malware")


@query(
    "category_paths",
    """SELECT l_linestatus, l_linenumber, l_tax, l_returnflag, count(*) AS n, CAST(dense_rank() OVER (ORDER BY l_returnflag) - 1 AS BIGINT) AS color,
 round(count(*) / (SELECT count(*) FROM lineitem), 8) AS probability FROM lineitem GROUP BY 1, 2, 3, 4""",
)
def _(spark, sf):
    out = W.category_paths(table(spark, sf, "lineitem"), ["l_linestatus", "l_linenumber", "l_tax"], "l_returnflag")
    return rounded(out, "probability", digits=8)
