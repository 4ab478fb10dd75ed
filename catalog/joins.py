"""Lookups, membership, address ranges."""

from pyspark.sql import functions as F

from wardline.functions.text import signature_prefix
from wardline.operators import lookup as L
from wardline.operators.bias import crosstab_score
from wardline.operators.binning import range_lookup
from wardline.operators.crosstab import crosstab_bias
from wardline.session import store
from wardline.operators.profile import fan_out, suspicious_ips

from .base import GEO_SQL, WITH_LOG, geo_ranges, ip_number_sql, netlog, query, rounded, table


@query(
    "map_lookup",
    """WITH m AS (SELECT l_suppkey, round(avg(l_extendedprice), 4) AS te FROM lineitem GROUP BY 1)
 SELECT p_partkey, coalesce(te, -1.0) AS te FROM part LEFT JOIN m ON p_partkey = l_suppkey""",
)
def _(spark, sf):
    means = (
        table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("p_partkey"))
        .agg(F.round(F.avg("l_extendedprice"), 4).alias("te"))
    )
    return L.map_lookup(table(spark, sf, "part").select("p_partkey"), "p_partkey", means, "te", fill=-1.0)


@query(
    "in_set",
    """WITH d AS (SELECT l_partkey AS key, count(DISTINCT l_suppkey) AS degree FROM lineitem GROUP BY 1),
 s AS (SELECT key FROM d WHERE degree > (SELECT quantile_cont(degree, 0.95) FROM d))
 SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_partkey IN (SELECT key FROM s) OR l_suppkey IN (SELECT key FROM s) AS in_set FROM lineitem""",
)
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    members = suspicious_ips(fan_out(rows, "l_partkey", "l_suppkey"), 0.95).select("key")
    return L.in_set(rows, ["l_partkey", "l_suppkey"], members)


@query(
    "in_set_multi",
    WITH_LOG
    + """, s AS (SELECT protocol, severity, traffic_type, malware FROM netlog WHERE anomaly > 97 AND malware IS NOT NULL)
 SELECT event_id, EXISTS (SELECT 1 FROM s WHERE s.protocol = n.protocol AND s.severity = n.severity AND s.traffic_type = n.traffic_type
  AND s.malware = n.malware) AS in_set FROM netlog n""",
)
def _(spark, sf):
    keys = ["protocol", "severity", "traffic_type", "malware"]
    log = netlog(spark, sf).select("event_id", "anomaly", *keys)
    return L.in_set_multi(log, keys, log.where("anomaly > 97")).select("event_id", "in_set")


@query(
    "not_in_set",
    """WITH train AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1995-03-01'),
 test AS (SELECT l_partkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '1995-03-01')
 SELECT count(*) FILTER (l_partkey NOT IN (SELECT l_partkey FROM train)) AS unseen, count(*) AS total,
 round(count(*) FILTER (l_partkey NOT IN (SELECT l_partkey FROM train)) * 100.0 / count(*), 6) AS pct FROM test""",
)
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_partkey", "l_shipdate")
    early = F.col("l_shipdate") < F.lit("1995-03-01").cast("timestamp_ntz")
    return rounded(L.not_in_set(rows.where(~early), rows.where(early), "l_partkey"), "pct")


@query(
    "range_lookup",
    """WITH r AS (SELECT p_partkey, p_partkey * 60.0::DOUBLE AS lo, p_partkey * 60.0::DOUBLE + 45 AS hi FROM part),
 v AS (SELECT DISTINCT l_extendedprice FROM lineitem)
 SELECT l_extendedprice, lo, hi, p_partkey FROM v LEFT JOIN r ON l_extendedprice BETWEEN lo AND hi""",
)
def _(spark, sf):
    key = F.col("p_partkey")
    ranges = table(spark, sf, "part").select("p_partkey", (key * 60.0).alias("lo"), (key * 60.0 + 45).alias("hi"))
    return range_lookup(table(spark, sf, "lineitem"), "l_extendedprice", ranges, "lo", "hi", ["p_partkey"])


@query(
    "range_lookup_nested",
    """WITH r AS (SELECT p_partkey * 60.0::DOUBLE AS lo, p_partkey * 60.0::DOUBLE + 45 AS hi, p_name AS name FROM part
 UNION ALL SELECT n_nationkey * 4000.0::DOUBLE, n_nationkey * 4000.0::DOUBLE + 4000, n_name FROM nation
 UNION ALL SELECT r_regionkey * 15000.0::DOUBLE, r_regionkey * 15000.0::DOUBLE + 31000, r_name FROM region),
 v AS (SELECT DISTINCT l_extendedprice FROM lineitem)
 SELECT l_extendedprice, lo, hi, name FROM v LEFT JOIN r ON l_extendedprice BETWEEN lo AND hi
 QUALIFY row_number() OVER (PARTITION BY l_extendedprice ORDER BY hi - lo, lo DESC, name) = 1""",
)
def _(spark, sf):
    """Parts inside touching ranges of nations, these across overlapping ones of regions."""
    part, nation, region = (table(spark, sf, t) for t in ("part", "nation", "region"))
    ranges = part.selectExpr("p_partkey * 60.0D AS lo", "p_partkey * 60.0D + 45 AS hi", "p_name AS name").unionByName(
        nation.selectExpr("n_nationkey * 4000.0D AS lo", "n_nationkey * 4000.0D + 4000 AS hi", "n_name AS name")
    ).unionByName(region.selectExpr("r_regionkey * 15000.0D AS lo", "r_regionkey * 15000.0D + 31000 AS hi", "r_name AS name"))
    return range_lookup(table(spark, sf, "lineitem"), "l_extendedprice", ranges, "lo", "hi", ["name"])


@query(
    "ip_geolocate_networks",
    """WITH e AS (SELECT event_id, event_id % 3 AS kind, event_id % 40 AS site, event_id % 5 AS sub FROM events)
 SELECT event_id,
 CASE WHEN n.n_name IS NOT NULL THEN n.n_name ELSE (SELECT r_name FROM region WHERE r_regionkey = CASE WHEN kind = 0 THEN 0 ELSE 1 END) END AS country,
 CASE WHEN n.n_name IS NULL THEN 'wide' WHEN kind > 0 THEN 'v4' WHEN n.n_regionkey = sub THEN 'sub' ELSE 'site' END AS city
 FROM e LEFT JOIN nation n ON n.n_nationkey = site""",
)
def _(spark, sf):
    """IPv6 and IPv4 networks on three levels, and addresses in plain, shortened and mapped form."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    networks = region.where("r_regionkey < 2").selectExpr(
        "CASE WHEN r_regionkey = 0 THEN '2001:db8::/32' ELSE '10.0.0.0/8' END AS network", "r_name AS country", "'wide' AS city"
    )
    for text, city in (
        ("format_string('2001:DB8:%x::/48', n_nationkey)", "site"), ("format_string('2001:db8:%x:%x::/64', n_nationkey, n_regionkey)", "sub"),
        ("format_string('10.%d.0.0/16', n_nationkey)", "v4"),
    ):
        networks = networks.unionByName(nation.selectExpr(f"{text} AS network", "n_name AS country", f"'{city}' AS city"))
    log = table(spark, sf, "events").selectExpr(
        "event_id",
        """CASE event_id % 3 WHEN 0 THEN format_string('2001:db8:%x:%x::%x', event_id % 40, event_id % 5, event_id % 65535 + 1)
 WHEN 1 THEN format_string('10.%d.%d.%d', event_id % 40, event_id % 256, event_id % 200)
 ELSE format_string('::ffff:10.%d.0.%d', event_id % 40, event_id % 256) END AS ip""",
    )
    return L.ip_geolocate(log, "ip", L.geo_networks(networks, "network"), fields=["country", "city"], spread_by=["event_id"]).drop("ip")


@query(
    "ip_geolocate",
    WITH_LOG
    + f""", g AS ({GEO_SQL}) SELECT event_id, latitude, longitude, country, city FROM netlog
 LEFT JOIN g ON proxy IS NOT NULL AND {ip_number_sql('proxy')} BETWEEN ip_start AND ip_end""",
)
def _(spark, sf):
    log = netlog(spark, sf).select("event_id", "proxy")
    return L.ip_geolocate(log, "proxy", geo_ranges(spark, sf), spread_by=["event_id"]).drop("proxy")


@query(
    "ip_geolocate_country_fallback",
    WITH_LOG
    + f""", g AS ({GEO_SQL}) SELECT event_id, g.city, coalesce(g.country, w.r_name) AS country FROM netlog
 LEFT JOIN g ON {ip_number_sql('src_ip')} BETWEEN g.ip_start AND g.ip_end
 LEFT JOIN (SELECT r_name, CAST(r_regionkey AS BIGINT) * 858993459 AS a, CAST(r_regionkey AS BIGINT) * 858993459 + 858993458 AS b FROM region) w
  ON {ip_number_sql('src_ip')} BETWEEN a AND b""",
)
def _(spark, sf):
    coarse = table(spark, sf, "region").selectExpr(
        "CAST(r_regionkey AS BIGINT) * 858993459 AS ip_start", "CAST(r_regionkey AS BIGINT) * 858993459 + 858993458 AS ip_end",
        "r_name AS country",
    )
    log = netlog(spark, sf).select("event_id", "src_ip")
    out = L.ip_geolocate(log, "src_ip", geo_ranges(spark, sf), fields=["city", "country"], country_ranges=coarse)
    return out.drop("src_ip")


@query(
    "enrich_distinct",
    WITH_LOG + " SELECT event_id, coalesce(split_part(malware, ' ', 1), NULL) AS first_word FROM netlog",
)
def _(spark, sf):
    log = netlog(spark, sf).select("event_id", "malware")
    out = L.enrich_distinct(log, "malware", lambda k: k.withColumn("first_word", signature_prefix("malware")), ["event_id"])
    return out.drop("malware")


@query("column_join", WITH_LOG + " SELECT event_id, ts, protocol, geo FROM netlog")
def _(spark, sf):
    log = netlog(spark, sf)
    return L.column_join([log.select("event_id", c) for c in ("ts", "protocol", "geo")], "event_id")


def tier_sql(pct: str, n: str) -> str:
    """Check text of the bias level for tiers 37.5 to 90 above the line 162.5 - 12.5 n."""
    return f"""CASE WHEN {pct} >= 162.5 - 12.5 * {n} THEN CASE WHEN {pct} >= 90 THEN 6 WHEN {pct} >= 75 THEN 5 WHEN {pct} >= 60 THEN 4
 WHEN {pct} >= 50 THEN 3 WHEN {pct} >= 40 THEN 2 WHEN {pct} >= 37.5 THEN 1 ELSE 0 END ELSE 0 END"""


@query(
    "crosstab_score",
    WITH_LOG
    + f""", c AS (SELECT dst_port, severity, count(*) AS n, count(*) FILTER (attack_type = 'Malware') * 100.0 / count(*) AS pct FROM netlog
  WHERE packet_type = 'Data' GROUP BY 1, 2)
 SELECT event_id, CAST(coalesce({tier_sql('pct', 'n')}, 0) AS TINYINT) AS level FROM netlog LEFT JOIN c USING (dst_port, severity)""",
)
def _(spark, sf):
    log = netlog(spark, sf).select("event_id", "dst_port", "severity", "attack_type", "packet_type")
    stored = store(crosstab_bias(log.where("packet_type = 'Data'"), ["dst_port", "severity"], "attack_type"))
    stored = stored.withColumn("dst_port", F.col("dst_port").cast("string"))  # stored keys are text
    return crosstab_score(log, ["dst_port", "severity"], stored, "Malware", output="level").select("event_id", "level")
