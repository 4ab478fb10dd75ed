"""Projection, filter, encoding, sort."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from wardline.functions.encoding import null_flag, ordinal_encode
from wardline.operators import columns as C

from .base import WITH_LOG, netlog, query, raw_log, table


@query("rename_columns", WITH_LOG + ' SELECT event_id, ts AS date, alert AS "Alert Trigger" FROM netlog')
def _(spark, sf):
    return C.rename_columns(raw_log(spark, sf).select("event_id", "Timestamp", "Alerts/Warnings"))


@query("drop_columns", "SELECT event_id, event_type, ts FROM events")
def _(spark, sf):
    return C.drop_columns(table(spark, sf, "events"), ["user_id", "value", "props", "not a column"])


@query("drop_by_pattern", "SELECT event_id, event_type FROM events")
def _(spark, sf):
    log = table(spark, sf, "events").select(
        "event_id", "event_type", F.col("value").alias("value max n d"), F.col("ts").alias("ts max n d")
    )
    return C.drop_by_pattern(log)


@query(
    "select_feature_vector",
    WITH_LOG
    + """ SELECT event_id, CAST(packet_length AS DOUBLE) AS f0, coalesce(CAST(nullif(k % 3, 0) AS DOUBLE), 0.0) AS f1,
 CAST(0 AS DOUBLE) AS f2 FROM netlog""",
)
def _(spark, sf):
    log = netlog(spark, sf).select("event_id", "packet_length", F.expr("nullif(k % 3, 0)").alias("a_te"))
    out = C.select_feature_vector(log, ["packet_length", *C.te_features(log), "absent"], ["event_id"])
    v = vector_to_array("features")
    return out.select("event_id", *[v[i].alias(f"f{i}") for i in range(3)])


@query("filter_class", "SELECT event_id, user_id, value FROM events WHERE event_type = 'error'")
def _(spark, sf):
    return C.filter_class(table(spark, sf, "events"), "event_type", "error").select("event_id", "user_id", "value")


@query(
    "null_flag",
    WITH_LOG
    + """ SELECT event_id, CAST(proxy IS NOT NULL AS INT) AS has_proxy, CAST(malware IS NOT NULL AS INT) AS malware,
 CAST(alert IS NOT NULL AS INT) AS alert FROM netlog""",
)
def _(spark, sf):
    return netlog(spark, sf).select(
        "event_id", null_flag("proxy").alias("has_proxy"), null_flag("malware").alias("malware"),
        null_flag("alert").alias("alert"),
    )


@query(
    "equality_indicator",
    WITH_LOG
    + """ SELECT event_id, protocol, CAST(protocol = 'UDP' AS BIGINT) AS "protocol UDP",
 CAST(protocol = 'ICMP' AS BIGINT) AS "protocol ICMP", CAST(packet_type = 'Control' AS BIGINT) AS "packet_type Control",
 CAST(coalesce(malware = 'IoC Detected', false) AS BIGINT) AS malware FROM netlog""",
)
def _(spark, sf):
    out = netlog(spark, sf).select("event_id", "protocol", "packet_type", "malware")
    out = C.equality_indicator(out, "protocol", ["UDP", "ICMP"])
    out = C.equality_indicator(out, "packet_type", ["Control"], ["Control"])
    return C.equality_indicator(out, "malware", ["IoC Detected"], ["/"])


@query(
    "ordinal_encode",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN '1' WHEN '3-MEDIUM' THEN '0' WHEN '5-LOW' THEN '-1'
 ELSE o_orderpriority END AS priority FROM orders""",
)
def _(spark, sf):
    levels = {"5-LOW": -1, "3-MEDIUM": 0, "1-URGENT": 1}
    return table(spark, sf, "orders").select("o_orderkey", ordinal_encode("o_orderpriority", levels).alias("priority"))


@query(
    "label_encode",
    "SELECT event_id, event_type, CAST(dense_rank() OVER (ORDER BY event_type) - 1 AS INT) AS label FROM events",
)
def _(spark, sf):
    return C.label_encode(table(spark, sf, "events").select("event_id", "event_type"), "event_type")[0]


@query("label_decode", "SELECT event_id, event_type FROM events")
def _(spark, sf):
    encoded, codes = C.label_encode(table(spark, sf, "events").select("event_id", "event_type"), "event_type")
    return C.label_decode(encoded.drop("event_type"), codes, "event_type").select("event_id", "event_type")


@query("label_encode_numbers", "SELECT event_id, user_id, CAST(dense_rank() OVER (ORDER BY user_id) - 1 AS INT) AS label FROM events")
def _(spark, sf):
    return C.label_encode(table(spark, sf, "events").select("event_id", "user_id"), "user_id")[0]


@query(
    "one_hot_labels",
    """SELECT event_id, CAST(event_type = 'click' AS INT) AS event_type_click, CAST(event_type = 'view' AS INT) AS event_type_view
 FROM events""",
)
def _(spark, sf):
    out = C.one_hot_labels(table(spark, sf, "events"), "event_type", ["click", "view"])
    return out.select("event_id", "event_type_click", "event_type_view")


@query(
    "category_codes",
    WITH_LOG
    + """, s AS (SELECT event_id, protocol, malware, dst_port AS dp FROM netlog)
 SELECT event_id, CAST(dense_rank() OVER (ORDER BY protocol) - 1 AS BIGINT) AS protocol_code,
 CAST(CASE WHEN malware IS NULL THEN -1 ELSE 0 END AS BIGINT) AS malware_code,
 CAST(dense_rank() OVER (ORDER BY dp) - 1 AS BIGINT) AS dst_port_code FROM s""",
)
def _(spark, sf):
    cols = ["protocol", "malware", "dst_port"]
    out = C.category_codes(netlog(spark, sf).select("event_id", *cols), cols)
    return out.select("event_id", *[f"{c}_code" for c in cols])


@query(
    "fill_missing",
    WITH_LOG + " SELECT event_id, coalesce(malware, 'none') AS malware, coalesce(proxy, 'none') AS proxy FROM netlog",
)
def _(spark, sf):
    return C.fill_missing(netlog(spark, sf).select("event_id", "malware", "proxy"), "none", ["malware", "proxy"])


@query(
    "drop_missing",
    WITH_LOG + " SELECT event_id, malware, proxy FROM netlog WHERE malware IS NOT NULL AND geo IS NOT NULL",
)
def _(spark, sf):
    out = C.drop_missing(netlog(spark, sf).select("event_id", "malware", "proxy", "geo"), ["malware", "geo"])
    return out.drop("geo")


@query("distinct_values", "SELECT DISTINCT l_shipdate FROM lineitem")
def _(spark, sf):
    return C.distinct_values(table(spark, sf, "lineitem"), "l_shipdate")


@query("pick_row", "SELECT event_id, event_type, value FROM events WHERE event_id = 77")
def _(spark, sf):
    return C.pick_row(table(spark, sf, "events"), "event_id", 77).select("event_id", "event_type", "value")


@query("page", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10 OFFSET 20")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return C.page(orders, 3, [F.desc("o_totalprice"), F.asc("o_orderkey")])


@query("page_count", "SELECT CAST(greatest(ceil(count(*) / 10.0), 1) AS BIGINT) AS pages FROM orders")
def _(spark, sf):
    return C.page_count(table(spark, sf, "orders"))


@query("sort_rows", "SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal DESC, s_suppkey DESC")
def _(spark, sf):
    return C.sort_rows(table(spark, sf, "supplier").select("s_suppkey", "s_acctbal"), ["s_acctbal", "s_suppkey"], True)
