"""Column expressions."""

from pyspark.sql import functions as F

from wardline.functions import encoding as E
from wardline.functions import network as N
from wardline.functions import text as X
from wardline.functions import timeparts as T
from wardline.functions.useragent import device_type
from wardline.operators.lookup import parse_user_agent

from .base import WITH_LOG, netlog, query, rounded, table

_TEXT_TS = """CASE WHEN event_id % 4 = 0 THEN concat('2024-01-', CAST(10 + event_id % 19 AS STRING), ' 06:33:58')
 WHEN event_id % 4 = 1 THEN concat('1/', CAST(10 + event_id % 19 AS STRING), '/2024 06:33')
 WHEN event_id % 4 = 2 THEN 'no time' END"""


@query(
    "parse_ts",
    f"""SELECT event_id, try_strptime({_TEXT_TS}, '%Y-%m-%d %H:%M:%S') AS ts FROM events""",
)
def _(spark, sf):
    out = table(spark, sf, "events").select("event_id", F.expr(_TEXT_TS).alias("t"))
    return out.select("event_id", T.parse_ts("t").cast("timestamp_ntz").alias("ts"))


@query("day_floor", "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", T.day_floor("ts").alias("day"))


_BUCKET_SQL = {
    "week_of_month_bucket": "CASE WHEN day(ts) <= 7 THEN 'MW1' WHEN day(ts) <= 14 THEN 'MW2' WHEN day(ts) <= 22 THEN 'MW3' ELSE 'MW4' END",
    "weekday_bucket": "concat('WD', isodow(ts))",
    "hour_bucket": "CASE WHEN hour(ts) >= 3 AND hour(ts) < 9 THEN 'H1' WHEN hour(ts) >= 9 AND hour(ts) < 15 THEN 'H2' WHEN hour(ts) >= 15 AND hour(ts) < 21 THEN 'H3' ELSE 'H4' END",
    "month_bucket": "concat('M', month(ts))",
}


def _bucket(name):
    @query(name, f"SELECT event_id, {_BUCKET_SQL[name]} AS bucket FROM events")
    def _(spark, sf):
        return table(spark, sf, "events").select("event_id", getattr(T, name)("ts").alias("bucket"))


for _name in _BUCKET_SQL:
    _bucket(_name)


def _indicator_sql() -> str:
    levels = {"MW": 3, "WD": 6, "H": 3, "M": 11}
    source = dict(zip(levels, _BUCKET_SQL.values()))
    cells = [f"CAST({source[f]} = '{f}{i}' AS INT) AS \"date {f}{i}\"" for f, n in levels.items() for i in range(1, n + 1)]
    return "SELECT l_orderkey, l_linenumber, " + ", ".join(cells) + " FROM (SELECT *, l_shipdate AS ts FROM lineitem) s"


@query("time_indicators", _indicator_sql())
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return T.time_indicators(rows, "l_shipdate").drop("l_shipdate")


@query(
    "serving_time_buckets",
    f"""SELECT event_id, CASE WHEN hour(ts) < 7 THEN 'MW1' WHEN hour(ts) < 14 THEN 'MW2' WHEN hour(ts) < 22 THEN 'MW3' ELSE 'MW4' END AS "date MW",
 {_BUCKET_SQL['weekday_bucket']} AS "date WD", {_BUCKET_SQL['hour_bucket']} AS "date H",
 concat('M', CAST(floor(minute(ts) / 5.0) AS INT) + 1) AS "date M" FROM events""",
)
def _(spark, sf):
    return T.serving_time_buckets(table(spark, sf, "events").select("event_id", "ts"), "ts").drop("ts")


@query(
    "time_features",
    """SELECT event_id, CAST(coalesce(hour(t), 12) AS INT) AS hour, CAST(coalesce(isodow(t) - 1, 0) AS INT) AS dayofweek,
 CAST(coalesce(isodow(t) >= 6, false) AS INT) AS is_weekend
 FROM (SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN ts END AS t FROM events) s""",
)
def _(spark, sf):
    rows = table(spark, sf, "events").selectExpr("event_id", "CASE WHEN event_id % 9 <> 0 THEN ts END AS t")
    return T.time_features(rows, "t", (12, 0)).drop("t")


@query(
    "split_city_state",
    """SELECT c_custkey, split_part(g, ', ', 1) AS city, split_part(g, ', ', 2) AS state FROM
 (SELECT c_custkey, concat(n_name, ', ', r_name) AS g FROM customer JOIN nation ON c_nationkey = n_nationkey
 JOIN region ON n_regionkey = r_regionkey) s""",
)
def _(spark, sf):
    g = (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(table(spark, sf, "region"), F.expr("n_regionkey = r_regionkey"))
        .select("c_custkey", F.concat("n_name", F.lit(", "), "r_name").alias("g"))
    )
    city, state = X.split_city_state("g")
    return g.select("c_custkey", city.alias("city"), state.alias("state"))


@query(
    "ipv4_prefix",
    WITH_LOG
    + """ SELECT event_id, split_part(src_ip, '.', 1) AS p1, concat(split_part(src_ip, '.', 1), '.', split_part(src_ip, '.', 2)) AS p2,
 regexp_replace(src_ip, '\\.[0-9]+$', '') AS p3 FROM netlog""",
)
def _(spark, sf):
    return netlog(spark, sf).select("event_id", *[N.ipv4_prefix("src_ip", n).alias(f"p{n}") for n in (1, 2, 3)])


_PRIVATE = "coalesce(regexp_matches({0}, '^(10\\.|172\\.(1[6-9]|2[0-9]|3[01])\\.|192\\.168\\.)'), false)"


@query("is_private_ip", WITH_LOG + f" SELECT event_id, {_PRIVATE.format('src_ip')} AS src, {_PRIVATE.format('proxy')} AS proxy FROM netlog")
def _(spark, sf):
    return netlog(spark, sf).select("event_id", N.is_private_ip("src_ip").alias("src"), N.is_private_ip("proxy").alias("proxy"))


def _port_sql(p):
    return f"CASE WHEN {p} <= 1023 THEN 'wellknown' WHEN {p} <= 49151 THEN 'registered' ELSE 'dynamic' END"


def _long_port_sql(p):
    return f"""CASE WHEN {p} <= 1023 THEN 'Well-known (0-1023)' WHEN {p} <= 49151 THEN 'Registered (1024-49151)'
 WHEN {p} <= 65535 THEN 'Dynamic (49152-65535)' ELSE 'Unknown' END"""


@query(
    "port_category",
    WITH_LOG
    + f""" SELECT event_id, {_port_sql('src_port')} AS short, {_long_port_sql('src_port + event_id % 3 * 10000')} AS long,
 CASE WHEN event_id % 7 = 0 THEN 'registered' ELSE {_port_sql('src_port')} END AS serving FROM netlog""",
)
def _(spark, sf):
    log = netlog(spark, sf)
    text = F.when(F.col("event_id") % 7 == 0, F.lit("n/a")).otherwise(F.col("src_port").cast("string"))
    return log.select(
        "event_id",
        N.port_category("src_port").alias("short"),
        N.port_category(F.col("src_port") + F.col("event_id") % 3 * 10000, "long").alias("long"),
        N.port_category(text, "serving").alias("serving"),
    )


@query("port_diff", WITH_LOG + " SELECT event_id, abs(src_port - dst_port) AS port_diff FROM netlog")
def _(spark, sf):
    return netlog(spark, sf).select("event_id", N.port_diff("src_port", "dst_port").alias("port_diff"))


@query(
    "total_alerts",
    WITH_LOG
    + """ SELECT event_id, CAST(malware IS NOT NULL AS INT) + CAST(alert IS NOT NULL AS INT) + CAST(firewall IS NOT NULL AS INT)
 + CAST(ids IS NOT NULL AS INT) AS total_alerts FROM netlog""",
)
def _(spark, sf):
    flags = [E.null_flag(c) for c in ("malware", "alert", "firewall", "ids")]
    return netlog(spark, sf).select("event_id", E.total_alerts(flags).alias("total_alerts"))


@query("signature_prefix", WITH_LOG + " SELECT event_id, split_part(signature, ' ', 1) AS a, coalesce(split_part(malware, ' ', 1), 'Unknown') AS b FROM netlog")
def _(spark, sf):
    return netlog(spark, sf).select("event_id", X.signature_prefix("signature").alias("a"), X.signature_prefix("malware").alias("b"))


@query("safe_ln", "SELECT event_id, round(CASE WHEN v = 0 THEN 0.0 ELSE ln(v) END, 6) AS ln FROM (SELECT event_id, event_id % 50 AS v FROM events) s")
def _(spark, sf):
    v = F.col("event_id") % 50
    return rounded(table(spark, sf, "events").select("event_id", E.safe_ln(v).alias("ln")), "ln")


@query(
    "parse_user_agent",
    WITH_LOG
    + r""" SELECT event_id,
 CASE user_id % 8 WHEN 0 THEN 'Chrome' WHEN 1 THEN 'Mobile Safari' WHEN 2 THEN 'Firefox' WHEN 3 THEN 'Chrome Mobile iOS'
  WHEN 4 THEN 'Safari' WHEN 5 THEN 'IE' WHEN 6 THEN 'Chrome Mobile' ELSE 'Googlebot' END AS browser,
 CASE user_id % 8 WHEN 0 THEN regexp_extract(device, 'Chrome/(\d+)', 1) WHEN 1 THEN '14' WHEN 2 THEN regexp_extract(device, 'Firefox/(\d+)', 1)
  WHEN 3 THEN regexp_extract(device, 'CriOS/(\d+)', 1) WHEN 4 THEN '13' WHEN 5 THEN regexp_extract(device, 'MSIE (\d+)', 1)
  WHEN 6 THEN regexp_extract(device, 'Chrome/(\d+)', 1) ELSE '2' END AS major,
 CASE user_id % 8 WHEN 0 THEN 'Windows' WHEN 1 THEN 'iOS' WHEN 2 THEN 'Linux' WHEN 3 THEN 'iOS' WHEN 4 THEN 'Mac OS X'
  WHEN 5 THEN 'Windows' WHEN 6 THEN 'Android' ELSE 'Other' END AS os,
 CASE user_id % 8 WHEN 0 THEN 'PC' WHEN 1 THEN 'Mobile' WHEN 2 THEN 'PC' WHEN 3 THEN 'Tablet' WHEN 4 THEN 'PC'
  WHEN 5 THEN 'PC' WHEN 6 THEN 'Mobile' END AS type,
 user_id % 8 = 7 AS bot,
 CASE user_id % 8 WHEN 1 THEN 'Apple' WHEN 3 THEN 'Apple' WHEN 4 THEN 'Apple' WHEN 6 THEN 'Samsung' WHEN 7 THEN 'Spider' END AS brand
 FROM netlog""",
)
def _(spark, sf):
    out = parse_user_agent(netlog(spark, sf).select("event_id", "device"), "device", spread_by=["event_id"])
    c = lambda n: F.col(f"`{n}`")
    return out.select(
        "event_id", c("Browser family").alias("browser"), c("Browser major").alias("major"), c("OS family").alias("os"),
        c("Device type").alias("type"), c("Device bot").alias("bot"), c("Device brand").alias("brand"),
    )


@query(
    "device_type",
    WITH_LOG
    + """ SELECT event_id, CASE user_id % 8 WHEN 1 THEN 'Mobile' WHEN 6 THEN 'Mobile' WHEN 3 THEN 'Tablet' WHEN 7 THEN 'Other' ELSE 'PC' END AS type
 FROM netlog""",
)
def _(spark, sf):
    return netlog(spark, sf).select("event_id", device_type("device", "Other").alias("type"))


# Whole texts; one document in ten gets placeholder words appended so that both outcomes occur.
_LOREM_TEXT = "CASE WHEN doc_id % 10 = 0 THEN concat(text, ' Lorem IPSUM dolor') ELSE text END"


@query(
    "lorem_ipsum_flag",
    "SELECT doc_id, ("
    + " + ".join(f"CAST(contains(lower({_LOREM_TEXT}), '{m}') AS INT)" for m in X.LOREM_MARKERS)
    + ") >= 3 AS is_lorem FROM documents",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.expr(_LOREM_TEXT).alias("t"))
    return docs.select("doc_id", X.lorem_ipsum_flag("t").alias("is_lorem"))


@query(
    "text_entropy",
    """WITH chars AS (SELECT doc_id, unnest(string_split(text, '')) AS ch FROM documents),
 freq AS (SELECT doc_id, ch, count(*) AS n FROM chars GROUP BY ALL),
 tot AS (SELECT doc_id, sum(n) AS t FROM freq GROUP BY doc_id)
 SELECT d.doc_id, round(coalesce(e.h, 0.0), 6) AS entropy FROM documents d LEFT JOIN
 (SELECT f.doc_id, -sum(n / t * log2(n / t)) AS h FROM freq f JOIN tot USING (doc_id) GROUP BY f.doc_id) e USING (doc_id)""",
)
def _(spark, sf):
    return rounded(table(spark, sf, "documents").select("doc_id", X.text_entropy("text").alias("entropy")), "entropy")


@query(
    "script_flag",
    r"""SELECT doc_id, CASE WHEN lat > 0 AND lat * 2 >= let THEN 'latin' ELSE 'not_latin' END AS script FROM
 (SELECT doc_id, length(regexp_replace(text, '[^\p{L}]', '', 'g')) AS let, length(regexp_replace(text, '[^\p{Latin}]', '', 'g')) AS lat
 FROM documents) s""",
)
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.script_flag("text").alias("script"))


@query(
    "class_confidence",
    """SELECT event_id, CASE WHEN a >= b THEN 'DDoS' ELSE 'Malware' END AS label, printf('%d.%d%%', greatest(a, b), 0) AS confidence
 FROM (SELECT event_id, event_id % 101 AS a, 100 - event_id % 101 AS b FROM events) s""",
)
def _(spark, sf):
    a = (F.col("event_id") % 101) / 100.0
    rows = table(spark, sf, "events").select("event_id", F.array(a, (100 - F.col("event_id") % 101) / 100.0).alias("p"))
    label, confidence = E.class_confidence("p", ["DDoS", "Malware"])
    return rows.select("event_id", label.alias("label"), confidence.alias("confidence"))
