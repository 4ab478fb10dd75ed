"""Set operations on endpoints."""

from wardline.operators import endpoints as E

from .base import WITH_LOG, netlog, query, rounded

_BOTH = "(SELECT src_ip FROM netlog INTERSECT SELECT dst_ip FROM netlog)"


@query("bidirectional_ips", WITH_LOG + " SELECT src_ip AS ip FROM netlog INTERSECT SELECT dst_ip FROM netlog")
def _(spark, sf):
    return E.bidirectional_ips(netlog(spark, sf), "src_ip", "dst_ip")


@query(
    "endpoint_union",
    WITH_LOG
    + f""", u AS (SELECT src_ip FROM netlog UNION SELECT dst_ip FROM netlog), b AS {_BOTH}
 SELECT (SELECT count(DISTINCT src_ip) FROM netlog) AS sources, (SELECT count(DISTINCT dst_ip) FROM netlog) AS destinations,
 (SELECT count(*) FROM b) AS bidirectional, (SELECT count(*) FROM u) AS endpoints,
 round((SELECT count(*) FROM b) * 100.0 / (SELECT count(*) FROM u), 6) AS bidirectional_pct""",
)
def _(spark, sf):
    return rounded(E.endpoint_union(netlog(spark, sf), "src_ip", "dst_ip"), "bidirectional_pct")


@query(
    "flag_bidirectional",
    WITH_LOG + f" SELECT event_id, src_ip IN {_BOTH} OR dst_ip IN {_BOTH} AS is_bidirectional FROM netlog",
)
def _(spark, sf):
    log = netlog(spark, sf).select("event_id", "src_ip", "dst_ip")
    return E.flag_bidirectional(log, "src_ip", "dst_ip").select("event_id", "is_bidirectional")


@query(
    "bidirectional_by_class",
    WITH_LOG
    + f""", f AS (SELECT attack_type, src_ip IN {_BOTH} OR dst_ip IN {_BOTH} AS b FROM netlog)
 SELECT attack_type, round(count(*) FILTER (NOT b) * 100.0 / count(*), 6) AS one_way_pct,
 round(count(*) FILTER (b) * 100.0 / count(*), 6) AS bidirectional_pct FROM f GROUP BY 1""",
)
def _(spark, sf):
    out = E.bidirectional_by_class(netlog(spark, sf), "src_ip", "dst_ip", "attack_type")
    return rounded(out, "one_way_pct", "bidirectional_pct")
