"""Bias levels, target encodings, exports, scoring features."""

import re

from pyspark.sql import functions as F

from wardline.functions.encoding import dynamic_threshold
from wardline.operators import bias as B
from wardline.operators import encoders as E
from wardline.operators.binning import bin_min_count
from wardline.operators.columns import label_encode
from wardline.operators.crosstab import crosstab_bias
from wardline.operators.split import row_uniform, stratified_kfold, stratified_split
from wardline.plans import ports
from wardline.plans.export import engineered_export
from wardline.plans.preprocess import enrich_log, serving_preprocess

from .base import GEO_SQL, WITH_LOG, geo_ranges, ip_number_sql, netlog, query, raw_log, rounded, table
from .bins import _CUT, _QUARTILE, min_count_sql
from .joins import tier_sql
from .scalars import _BUCKET_SQL, _PRIVATE, _long_port_sql

_LINE = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(
    "dynamic_threshold",
    "SELECT l_partkey, 162.5 - 12.5 * count(*)::DOUBLE AS line, greatest(162.5 - 12.5 * count(*), 37.5)::DOUBLE AS floored FROM lineitem GROUP BY 1",
)
def _(spark, sf):
    counts = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"))
    return counts.select(
        "l_partkey", dynamic_threshold("n").alias("line"), dynamic_threshold("n", floor=37.5).alias("floored")
    )


def _bias_sql(tiers=None) -> str:
    level = (lambda c: tier_sql(f"p{c}", "n")) if tiers is None else tiers
    cells = ", ".join(f"CAST({level(c)} AS TINYINT) AS bias_{c.lower()}" for c in "ANR")
    pcts = ", ".join(f"count(*) FILTER (l_returnflag = '{c}') * 100.0 / count(*) AS p{c}" for c in "ANR")
    return f"""WITH {min_count_sql('lineitem', 'l_extendedprice', 20)},
 b AS (SELECT l.*, lo FROM lineitem l ASOF JOIN bins ON l.l_extendedprice >= bins.lo),
 c AS (SELECT lo, count(*) AS n, {pcts} FROM b GROUP BY lo)
 SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {cells} FROM b JOIN c USING (lo)"""


def _bias(spark, sf, **settings):
    rows = table(spark, sf, "lineitem").select(*_LINE, "l_extendedprice", "l_returnflag")
    binned = bin_min_count(rows, "l_extendedprice", 20, prefix="price")
    crosstab = crosstab_bias(binned, ["price_lo"], "l_returnflag", classes=["A", "N", "R"])
    out = B.bias_levels(binned, ["price_lo"], crosstab, ["A", "N", "R"], **settings)
    return out.select(*_LINE, *[F.col(f"`price_lo , bias {c}`").alias(f"bias_{c.lower()}") for c in "ANR"])


@query("bias_levels", _bias_sql())
def _(spark, sf):
    return _bias(spark, sf)


def _unordered(c: str) -> str:
    p = f"p{c}"
    return f"""CASE WHEN {p} >= 162.5 - 12.5 * n THEN CASE WHEN {p} >= 60 THEN 6 WHEN {p} >= 50 THEN 4 WHEN {p} >= 40 THEN 2
 WHEN {p} >= 37.5 THEN 1 ELSE 0 END ELSE 0 END"""


@query("bias_levels_unordered", _bias_sql(_unordered))
def _(spark, sf):
    return _bias(spark, sf, tiers=B.UNORDERED_TIERS)


_GROUPS = (
    B.BiasGroup("port", binned=("src_port",)),
    B.BiasGroup("score", binned=("anomaly",)),
    B.BiasGroup("network", keys=("protocol", "traffic_type", "severity", "dst_port")),
)
_CLASSES = ("DDoS", "Intrusion", "Malware")


def _group_cells(group: str, name: str) -> str:
    return ", ".join(
        f"CAST({tier_sql(f'{group}.p{i}', f'{group}.n')} AS TINYINT) AS {name}_{c.lower()}" for i, c in enumerate(_CLASSES)
    )


_P3 = ", ".join(f"count(*) FILTER (attack_type = '{c}') * 100.0 / count(*) AS p{i}" for i, c in enumerate(_CLASSES))


def _named_bins(col: str, n_obs: int) -> str:
    """The bins of one column as CTEs with their own names."""
    text = min_count_sql("netlog", col, n_obs).removeprefix("RECURSIVE ")
    for cte in ("vc", "pre", "nxt", "starts", "edges", "bins"):
        text = re.sub(rf"\b{cte}\b", f"{col}_{cte}", text)
    return text


@query(
    "bias_feature_groups",
    WITH_LOG.replace("WITH ", "WITH RECURSIVE ", 1)
    + f", {_named_bins('src_port', 15)}, {_named_bins('anomaly', 15)}"
    + f""", l AS (SELECT n.*, sb.lo AS slo, ab.lo AS alo FROM netlog n JOIN src_port_bins sb ON src_port BETWEEN sb.lo AND sb.hi
  JOIN anomaly_bins ab ON anomaly BETWEEN ab.lo AND ab.hi),
 a AS (SELECT slo, count(*) AS n, {_P3} FROM l GROUP BY 1), b AS (SELECT alo, count(*) AS n, {_P3} FROM l GROUP BY 1),
 c AS (SELECT protocol, traffic_type, severity, dst_port, count(*) AS n, {_P3} FROM l GROUP BY 1, 2, 3, 4)
 SELECT event_id, {_group_cells('a', 'port')}, {_group_cells('b', 'score')}, {_group_cells('c', 'network')}
 FROM l JOIN a USING (slo) JOIN b USING (alo) JOIN c USING (protocol, traffic_type, severity, dst_port)""",
)
def _(spark, sf):
    log = netlog(spark, sf).select(
        "event_id", "attack_type", "src_port", "anomaly", "protocol", "traffic_type", "severity", "dst_port"
    )
    out, model = B.fit_bias_features(log, "attack_type", _GROUPS, n_obs=15)
    names = [f"{g.name}_{c.lower()}" for g in _GROUPS for c in _CLASSES]
    return out.select("event_id", *[F.col(f"`{old}`").alias(new) for old, new in zip(model.feature_columns, names)])


# Columns of the log that part the rows as the key columns of each of the eleven crosstabs do; bins are added as ``<column>_lo``.
# A crawler has no device type, so it has no key.
_ALERT_KEYS = ("malware", "alert", "action", "severity", "log_source", "firewall", "ids")
_NINE = (
    ("src_port_lo",), ("dst_port_lo",), ("s_lon_lo", "s_lat_lo", *_ALERT_KEYS), ("d_lon_lo", "d_lat_lo", *_ALERT_KEYS), ("s_country", "d_country"),
    ("day",), ("protocol", "control", "traffic_type", "signature", "segment", "has_proxy", "device"), (*_ALERT_KEYS, "device"),
    ("mw", "wd", "h", "mo"), ("anomaly_lo",), ("packet_length_lo",),
)
_NINE_BINNED = ("src_port", "dst_port", "s_lon", "s_lat", "d_lon", "d_lat", "anomaly", "packet_length")


def _nine_sql() -> str:
    keys = f"""event_id, attack_type, src_port, dst_port, anomaly, packet_length, protocol, packet_type = 'Control' AS control, traffic_type, signature,
 segment, proxy IS NOT NULL AS has_proxy, CASE WHEN user_id % 8 <> 7 THEN user_id % 8 END AS device, {', '.join(f"coalesce({c}, '') AS {c}" for c in _ALERT_KEYS)}, CAST(ts AS DATE) AS day,
 {_BUCKET_SQL['week_of_month_bucket']} AS mw, {_BUCKET_SQL['weekday_bucket']} AS wd, {_BUCKET_SQL['hour_bucket']} AS h, {_BUCKET_SQL['month_bucket']} AS mo"""
    geo = ", ".join(f"{p}.longitude AS {p}_lon, {p}.latitude AS {p}_lat, {p}.country AS {p}_country" for p in "sd")
    ranges = " ".join(
        f"LEFT JOIN geo {p} ON {ip_number_sql(c)} BETWEEN {p}.ip_start AND {p}.ip_end" for p, c in (("s", "src_ip"), ("d", "dst_ip"))
    )
    bins = ", ".join(_named_bins(c, 15).replace("netlog", "nine") for c in _NINE_BINNED)
    binned = " ".join(f"LEFT JOIN {c}_bins ON nine.{c} BETWEEN {c}_bins.lo AND {c}_bins.hi" for c in _NINE_BINNED)
    tables, joins, cells = "", "", ""
    for i, names in enumerate(_NINE):
        there = " AND ".join(f"{c} IS NOT NULL" for c in names)
        tables += f", g{i} AS (SELECT {', '.join(names)}, count(*) AS n, {_P3} FROM b WHERE {there} GROUP BY ALL)"
        joins += f" LEFT JOIN g{i} USING ({', '.join(names)})"
        for j, c in enumerate(_CLASSES):
            cells += f", CAST(coalesce({tier_sql(f'g{i}.p{j}', f'g{i}.n')}, 0) AS TINYINT) AS g{i}_{c.lower()}"
    return f"""{WITH_LOG.replace('WITH ', 'WITH RECURSIVE ', 1)}, geo AS ({GEO_SQL}),
 nine AS MATERIALIZED (SELECT {keys}, {geo} FROM netlog {ranges}), {bins},
 b AS MATERIALIZED (SELECT nine.*, {', '.join(f'{c}_bins.lo AS {c}_lo' for c in _NINE_BINNED)} FROM nine {binned}){tables}
 SELECT event_id{cells} FROM b{joins}"""


@query("bias_all_groups", _nine_sql())
def _(spark, sf):
    log = enrich_log(raw_log(spark, sf), geo_ranges(spark, sf), daily=False)
    out, model = B.fit_bias_features(log, "Attack Type", B.BIAS_GROUPS, n_obs=15)
    names = [f"g{i}_{c.lower()}" for i in range(len(B.BIAS_GROUPS)) for c in _CLASSES]
    return out.select("event_id", *[F.col(f"`{old}`").alias(new) for old, new in zip(model.feature_columns, names)])


def _md5_rank(target: str, seed: int, source: str, id_col: str = "event_id") -> str:
    return f"""(SELECT *, row_number() OVER (PARTITION BY {target} ORDER BY md5(concat('{seed}:', CAST({id_col} AS STRING))), {id_col}) AS rn,
 count(*) OVER (PARTITION BY {target}) AS cn FROM {source})"""


@query(
    "stratified_split",
    f"SELECT event_id, rn <= round(cn * 0.2::DOUBLE) AS is_test FROM {_md5_rank('event_type', 42, 'events')} s",
)
def _(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "event_type")
    return stratified_split(rows, "event_type", "event_id", 0.2, 42).select("event_id", "is_test")


@query(
    "stratified_kfold",
    f"SELECT event_id, CAST(floor((rn - 1) * 5 / cn) AS INT) AS fold FROM {_md5_rank('event_type', 42, 'events')} s",
)
def _(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "event_type")
    return stratified_kfold(rows, "event_type", "event_id", 5, 42).select("event_id", "fold")


_CV_COLS = ("protocol", "dst_port", "malware", "geo")


def _cv_sql(cols) -> str:
    base = f"""l AS (SELECT n.*, CASE attack_type WHEN 'DDoS' THEN 0 WHEN 'Intrusion' THEN 1 ELSE 2 END AS y FROM netlog n),
 f AS (SELECT *, CAST(floor((rn - 1) * 5 / cn) AS INT) AS fold FROM {_md5_rank('y', 42, 'l')} s)"""
    joins, cells = "", ""
    for i, c in enumerate(cols):
        joins += f""" LEFT JOIN (SELECT {c} AS v, fold, (sum(sum(y)) OVER (PARTITION BY {c}) - sum(y)) / nullif(sum(count(*)) OVER (PARTITION BY {c}) - count(*), 0) AS te
 FROM f WHERE {c} IS NOT NULL GROUP BY {c}, fold) t{i} ON f.{c} = t{i}.v AND f.fold = t{i}.fold"""
        cells += f", round(coalesce(t{i}.te, (SELECT avg(y) FROM l)), 6) AS {c}_te"
    return f", {base} SELECT event_id{cells} FROM f{joins}"


def _coded(spark, sf, cols):
    code = F.expr("CASE attack_type WHEN 'DDoS' THEN 0 WHEN 'Intrusion' THEN 1 ELSE 2 END").alias("y")
    return netlog(spark, sf).select("event_id", "attack_type", code, *cols)


@query("target_encode_cv", WITH_LOG + _cv_sql(_CV_COLS))
def _(spark, sf):
    out = E.target_encode_cv(_coded(spark, sf, _CV_COLS), _CV_COLS, "y", "event_id")
    return rounded(out.select("event_id", *[f"{c}_te" for c in _CV_COLS]), *[f"{c}_te" for c in _CV_COLS])


_Y = "CASE attack_type WHEN 'DDoS' THEN 0 WHEN 'Intrusion' THEN 1 ELSE 2 END"


@query(
    "target_encode_full",
    WITH_LOG
    + f""" SELECT event_id, round(avg({_Y}) OVER (PARTITION BY dst_port), 6) AS dst_port_te,
 round(CASE WHEN geo IS NOT NULL THEN avg({_Y}) OVER (PARTITION BY geo) END, 6) AS geo_te FROM netlog""",
)
def _(spark, sf):
    out = E.target_encode_full(_coded(spark, sf, ["dst_port", "geo"]), ["dst_port", "geo"], "y")
    return rounded(out.select("event_id", "dst_port_te", "geo_te"), "dst_port_te", "geo_te")


@query(
    "target_encode_train",
    WITH_LOG
    + f""", l AS (SELECT event_id, dst_port, user_id, {_Y} AS y, severity = 'Low' AS held_out FROM netlog),
 m AS (SELECT user_id, avg(y) AS te FROM l WHERE NOT held_out GROUP BY 1)
 SELECT event_id, round(coalesce(te, (SELECT avg(y) FROM l WHERE NOT held_out)), 6) AS user_id_te FROM l LEFT JOIN m USING (user_id) WHERE held_out""",
)
def _(spark, sf):
    rows = _coded(spark, sf, ["user_id", "severity"])
    means, overall = E.target_encode_fit(rows.where("severity <> 'Low'"), ["user_id"], "y")
    out = E.target_encode_apply(rows.where("severity = 'Low'"), means, overall, ["user_id"])
    return rounded(out.select("event_id", "user_id_te"), "user_id_te")


@query(
    "engineered_export",
    WITH_LOG
    + f""", q AS (SELECT quantile_cont(anomaly, 0.25) AS q1, quantile_cont(anomaly, 0.5) AS q2, quantile_cont(anomaly, 0.75) AS q3 FROM netlog),
 b AS (SELECT src_ip FROM netlog INTERSECT SELECT dst_ip FROM netlog)
 SELECT event_id, CAST(proxy IS NOT NULL AS INT) AS has_proxy, src_ip IN (SELECT src_ip FROM b) OR dst_ip IN (SELECT src_ip FROM b) AS is_bidirectional,
 {_PRIVATE.format('src_ip')} AS src_is_private, {_PRIVATE.format('dst_ip')} AS dst_is_private, {_CUT.format('packet_length')} AS packet_length_bin,
 {_long_port_sql('dst_port')} AS dst_port_category, {_long_port_sql('src_port')} AS src_port_category, {_QUARTILE.format('anomaly')} AS anomaly_category
 FROM netlog, q""",
)
def _(spark, sf):
    roles = {"proxy": "proxy", "src": "src_ip", "dst": "dst_ip", "length": "packet_length", "src_port": "src_port",
             "dst_port": "dst_port", "score": "anomaly"}
    return engineered_export(netlog(spark, sf), roles, keep=("event_id",))


@query(
    "serving_preprocess",
    WITH_LOG
    + """ SELECT event_id, CASE WHEN hour(ts) < 7 THEN 'MW1' WHEN hour(ts) < 14 THEN 'MW2' WHEN hour(ts) < 22 THEN 'MW3' ELSE 'MW4' END AS mw,
 concat('M', CAST(floor(minute(ts) / 5.0) AS INT) + 1) AS m, CAST(CAST(proxy IS NOT NULL AS INT) AS STRING) AS proxy_usage,
 split_part(signature, ' ', 1) AS pat_a, CAST(CAST(log_source = 'Firewall' AS INT) AS STRING) AS firewall,
 CAST(CAST(alert IS NOT NULL AS INT) AS STRING) AS alert, CAST(CAST(malware IS NOT NULL AS INT) AS STRING) AS malware,
 CASE user_id % 8 WHEN 1 THEN 'Mobile' WHEN 6 THEN 'Mobile' WHEN 3 THEN 'Tablet' WHEN 7 THEN 'Other' ELSE 'PC' END AS type FROM netlog""",
)
def _(spark, sf):
    out = serving_preprocess(raw_log(spark, sf))
    names = {"date MW": "mw", "date M": "m", "Proxy usage": "proxy_usage", "Attack Signature patA": "pat_a",
             "Log Source Firewall": "firewall", "Alert Trigger": "alert", "Malware Indicators": "malware", "Device type": "type"}
    return out.select("event_id", *[F.col(f"`{a}`").alias(b) for a, b in names.items()])


@query(
    "ports_features",
    WITH_LOG
    + """, x AS (SELECT *, CASE WHEN src_port <= 1023 THEN 'wellknown' WHEN src_port <= 49151 THEN 'registered' ELSE 'dynamic' END AS src_cat FROM netlog),
 l AS (SELECT n.*, CASE attack_type WHEN 'DDoS' THEN 0 WHEN 'Intrusion' THEN 1 ELSE 2 END AS y FROM x n),
 f AS (SELECT *, CAST(floor((rn - 1) * 5 / cn) AS INT) AS fold FROM """
    + _md5_rank("y", 42, "l")
    + """ s) SELECT event_id, CAST(hour(ts) AS INT) AS hour, CAST(isodow(ts) - 1 AS INT) AS dayofweek, CAST(isodow(ts) >= 6 AS INT) AS is_weekend,
 abs(src_port - dst_port) AS port_diff, CAST(proxy IS NOT NULL AS INT) AS has_proxy,
 CAST(malware IS NOT NULL AS INT) + CAST(alert IS NOT NULL AS INT) + CAST(firewall IS NOT NULL AS INT) + CAST(ids IS NOT NULL AS INT) AS total_alerts"""
    + "".join(f", round(coalesce(t{i}.te, (SELECT avg(y) FROM l)), 6) AS {n}" for i, n in enumerate(("protocol_te", "src_cat_te", "dst_port_te")))
    + " FROM f"
    + "".join(
        f""" LEFT JOIN (SELECT {c} AS v, fold, (sum(sum(y)) OVER (PARTITION BY {c}) - sum(y)) / nullif(sum(count(*)) OVER (PARTITION BY {c}) - count(*), 0) AS te
 FROM f GROUP BY {c}, fold) t{i} ON f.{c} = t{i}.v AND f.fold = t{i}.fold"""
        for i, c in enumerate(("protocol", "src_cat", "dst_port"))
    ),
)
def _(spark, sf):
    labelled, _ = label_encode(raw_log(spark, sf), "Attack Type")
    out = ports.ports_features(labelled, "label", "event_id")
    names = {"Protocol_te": "protocol_te", "src_port_cat_te": "src_cat_te", "Destination Port_te": "dst_port_te"}
    cols = [F.round(F.col(f"`{a}`"), 6).alias(b) for a, b in names.items()]
    return out.select("event_id", "hour", "dayofweek", "is_weekend", "port_diff", "has_proxy", "total_alerts", *cols)


@query(
    "serving_ports_features",
    WITH_LOG
    + f""", m AS (SELECT dst_port, avg({_Y}) AS te FROM netlog WHERE severity <> 'Low' GROUP BY 1),
 s AS (SELECT src_port, avg({_Y}) AS te FROM netlog WHERE severity <> 'Low' GROUP BY 1)
 SELECT event_id, round(coalesce(s.te, 1.0), 6) AS src_port_te, round(coalesce(m.te, 1.0), 6) AS dst_port_te, CAST(1.0 AS DOUBLE) AS protocol_te,
 CAST(malware IS NOT NULL AS INT) + CAST(alert IS NOT NULL AS INT) + CAST(firewall IS NOT NULL AS INT) + CAST(ids IS NOT NULL AS INT) AS total_alerts
 FROM netlog LEFT JOIN s USING (src_port) LEFT JOIN m USING (dst_port)""",
)
def _(spark, sf):
    raw = raw_log(spark, sf)
    y = F.expr("CASE `Attack Type` WHEN 'DDoS' THEN 0 WHEN 'Intrusion' THEN 1 ELSE 2 END")
    train = raw.withColumn("y", y).where("`Severity Level` <> 'Low'")
    means = [E.target_means(train, [c], "y").select("value", "te") for c in ports.ENCODED_PORTS]
    out = ports.serving_ports_features(raw, *means)
    return rounded(
        out.select(
            "event_id", F.col("`Source Port_te`").alias("src_port_te"), F.col("`Destination Port_te`").alias("dst_port_te"),
            F.col("`Protocol_te`").cast("double").alias("protocol_te"), "total_alerts",
        ),
        "src_port_te", "dst_port_te",
    )


@query(
    "enrich_log",
    WITH_LOG
    + """, m AS (SELECT day, attack_type FROM (SELECT CAST(ts AS DATE) AS day, attack_type, row_number() OVER (PARTITION BY CAST(ts AS DATE)
  ORDER BY count(*) DESC, max(g.n) DESC, attack_type) AS r FROM netlog JOIN (SELECT attack_type, count(*) AS n FROM netlog GROUP BY 1) g USING (attack_type) GROUP BY 1, 2) s WHERE r = 1)
 SELECT event_id, CASE severity WHEN 'Low' THEN '-1' WHEN 'Medium' THEN '0' ELSE '1' END AS severity, CAST(protocol = 'UDP' AS BIGINT) AS udp,
 CAST(packet_type = 'Control' AS BIGINT) AS control, CAST(signature = 'Known Pattern A' AS BIGINT) AS pat_a, CAST(malware IS NOT NULL AS BIGINT) AS malware,
 split_part(geo, ', ', 1) AS city, split_part(src_ip, '.', 1) AS octet1, concat('{ ', m.attack_type, ' }') AS daily FROM netlog LEFT JOIN m ON CAST(ts AS DATE) = day""",
)
def _(spark, sf):
    out = enrich_log(raw_log(spark, sf), geo_ranges(spark, sf))
    names = {"Severity Level": "severity", "Protocol UDP": "udp", "Packet Type Control": "control", "Attack Signature patA": "pat_a",
             "Malware Indicators": "malware", "Geo-location City": "city", "Source IP 1octet": "octet1", "Attack Type max n d": "daily"}
    return out.select("event_id", *[F.col(f"`{a}`").alias(b) for a, b in names.items()])


@query(
    "row_uniform",
    "SELECT event_id, CAST(concat('0x', substr(md5(concat('7:', CAST(event_id AS STRING))), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE AS u FROM events",
)
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", row_uniform("event_id", 7).alias("u"))
