"""Bins and histograms."""

from pyspark.sql import functions as F

from wardline.operators import binning as B

from .base import WITH_LOG, netlog, query, table

_CUT = """CASE WHEN {0} > 0 AND {0} <= 64 THEN '0-64' WHEN {0} > 64 AND {0} <= 128 THEN '64-128' WHEN {0} > 128 AND {0} <= 256 THEN '128-256'
 WHEN {0} > 256 AND {0} <= 512 THEN '256-512' WHEN {0} > 512 AND {0} <= 1024 THEN '512-1024' WHEN {0} > 1024 AND {0} <= 2048 THEN '1024-2048'
 WHEN {0} > 2048 THEN '2048+' END"""
_QUARTILE = """CASE WHEN {0} <= q1 THEN 'Low (0-25%)' WHEN {0} <= q2 THEN 'Medium (25-50%)' WHEN {0} <= q3 THEN 'High (50-75%)'
 WHEN {0} IS NOT NULL THEN 'Critical (75-100%)' END"""


@query("cut_fixed", WITH_LOG + f" SELECT event_id, {_CUT.format('packet_length')} AS bin FROM netlog")
def _(spark, sf):
    return netlog(spark, sf).select("event_id", B.cut_fixed("packet_length").alias("bin"))


@query(
    "cut_quartiles",
    f"""WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS q2, quantile_cont(value, 0.75) AS q3 FROM events)
 SELECT event_id, {_QUARTILE.format('value')} AS quartile FROM events, q""",
)
def _(spark, sf):
    return B.cut_quartiles(table(spark, sf, "events").select("event_id", "value"), "value").drop("value")


@query(
    "bin_equal_width",
    """WITH b AS (SELECT CAST(floor(min(l_extendedprice)) AS BIGINT) AS lo, CAST(ceil(max(l_extendedprice)) AS BIGINT) AS hi FROM lineitem
  WHERE l_linestatus = 'F'),
 s AS (SELECT lo, hi, CAST(floor((hi - lo) / 7.0) AS BIGINT) AS step FROM b),
 n AS (SELECT lo, hi, step, CAST(ceil((hi - lo) * 1.0 / step) AS BIGINT) AS bins FROM s),
 i AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, lo, step, bins,
  greatest(least(CAST(floor((l_extendedprice - lo) / step) AS BIGINT), bins - 1), 0) AS ix FROM lineitem, n)
 SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CASE WHEN ix > 0 THEN lo + ix * step END AS price_lo,
  CASE WHEN ix < bins - 1 THEN lo + (ix + 1) * step END AS price_hi,
  concat('class : ', CASE WHEN ix > 0 THEN CAST(lo + ix * step AS STRING) ELSE 'min' END, ' - ',
   CASE WHEN ix < bins - 1 THEN CAST(lo + (ix + 1) * step AS STRING) ELSE 'max' END) AS "l_extendedprice classes" FROM i""",
)
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_linestatus"
    )
    train = rows.where("l_linestatus = 'F'")
    return B.bin_equal_width(rows, train, "l_extendedprice", 7, prefix="price").drop("l_linestatus")


def min_count_sql(source: str, col: str, n_obs: int) -> str:
    """Check text: bins ``(lo, hi, n)`` by walking from bin start to bin start."""
    return f"""RECURSIVE vc AS (SELECT {col} AS v, count(*) AS n FROM {source} WHERE {col} IS NOT NULL GROUP BY {col}),
 pre AS (SELECT v, n, sum(n) OVER (ORDER BY v) - n AS c FROM vc),
 nxt AS (SELECT v, n, c, first_value(v) OVER (ORDER BY c RANGE BETWEEN {n_obs} FOLLOWING AND UNBOUNDED FOLLOWING) AS nv FROM pre),
 starts AS (SELECT min(v) AS v FROM pre UNION ALL SELECT nxt.nv FROM starts JOIN nxt ON nxt.v = starts.v WHERE nxt.nv IS NOT NULL),
 edges AS (SELECT v AS lo, lead(v) OVER (ORDER BY v) AS nlo FROM starts),
 bins AS (SELECT lo, max(pre.v) AS hi, CAST(sum(pre.n) AS BIGINT) AS n FROM edges JOIN pre ON pre.v >= lo AND (nlo IS NULL OR pre.v < nlo) GROUP BY lo)"""


@query("min_count_bins", f"WITH {min_count_sql('lineitem', 'l_extendedprice', 500)} SELECT lo, hi, n FROM bins")
def _(spark, sf):
    return B.min_count_bins(table(spark, sf, "lineitem"), "l_extendedprice", 500)[1]


@query(
    "bin_min_count",
    f"""WITH {min_count_sql('lineitem', 'l_partkey', 300)} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, lo AS l_partkey_lo, hi AS l_partkey_hi,
 concat('class : ', lo, ' - ', hi) AS "l_partkey classes" FROM lineitem JOIN bins ON l_partkey BETWEEN lo AND hi""",
)
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return B.bin_min_count(rows, "l_partkey", 300)


@query(
    "bin_min_count_chunked",
    f"WITH {min_count_sql('lineitem', 'l_extendedprice', 100)} SELECT lo, hi, n FROM bins",
)
def _(spark, sf):
    # Many chunks, as on a large table.
    return B.min_count_bins(table(spark, sf, "lineitem"), "l_extendedprice", 100, chunk_rows=5000)[1]


@query(
    "bin_equal_count",
    """WITH vc AS (SELECT l_quantity AS v, count(*) AS n FROM lineitem GROUP BY 1),
 p AS (SELECT v, n, sum(n) OVER (ORDER BY v) - n AS before, sum(n) OVER () AS total FROM vc),
 b AS (SELECT v, floor(before * 6 / total) AS bin FROM p),
 e AS (SELECT bin, min(v) AS lo, max(v) AS hi FROM b GROUP BY bin)
 SELECT l_quantity, lo AS l_quantity_lo, hi AS l_quantity_hi, count(*) AS n FROM lineitem JOIN b ON l_quantity = v JOIN e USING (bin) GROUP BY ALL""",
)
def _(spark, sf):
    out = B.bin_equal_count(table(spark, sf, "lineitem").select("l_quantity"), "l_quantity", 6)
    return out.groupBy("l_quantity", "l_quantity_lo", "l_quantity_hi").agg(F.count("*").alias("n"))


def hist_sql(v: str, n: int) -> str:
    return f"least(CAST(floor(({v} - lo) / (hi - lo) * {n}) AS BIGINT) + 1, {n})"


@query(
    "histogram",
    f"""WITH b AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
 SELECT {hist_sql('l_extendedprice', 50)} AS bin, count(*) AS n FROM lineitem, b GROUP BY 1""",
)
def _(spark, sf):
    return B.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 50)


@query(
    "histogram_by_class",
    f"""WITH b AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
 SELECT l_returnflag, {hist_sql('l_extendedprice', 200)} AS bin, count(*) AS n FROM lineitem, b GROUP BY 1, 2""",
)
def _(spark, sf):
    return B.histogram_by_class(table(spark, sf, "lineitem"), "l_extendedprice", "l_returnflag", 200)


@query(
    "bias_level_histogram",
    WITH_LOG
    + f""", b AS (SELECT min(anomaly) AS lo, max(anomaly) AS hi FROM netlog),
 l AS (SELECT attack_type, anomaly, 'a' AS feature, CAST(k % 4 AS INT) AS level FROM netlog
  UNION ALL SELECT attack_type, anomaly, 'b', CAST(user_id % 3 AS INT) FROM netlog)
 SELECT attack_type, feature, level, {hist_sql('anomaly', 20)} AS bin, count(*) AS n FROM l, b WHERE level > 0 GROUP BY 1, 2, 3, 4""",
)
def _(spark, sf):
    log = netlog(spark, sf).select("attack_type", "anomaly", F.expr("k % 4").alias("a"), F.expr("user_id % 3").alias("b"))
    return B.bias_level_histogram(log, "anomaly", "attack_type", ["a", "b"], 20)


@query(
    "assign_trained_bins",
    f"""WITH {min_count_sql('lineitem', 'l_extendedprice', 500)},
 e AS (SELECT min(lo) AS first_lo, max(lo) AS last_lo FROM bins),
 a AS (SELECT o_orderkey, coalesce(b.lo, CASE WHEN o_totalprice < first_lo THEN first_lo ELSE last_lo END) AS lo
  FROM orders CROSS JOIN e LEFT JOIN bins b ON o_totalprice BETWEEN b.lo AND b.hi)
 SELECT o_orderkey, a.lo AS price_lo, bins.hi AS price_hi FROM a JOIN bins USING (lo)""",
)
def _(spark, sf):
    # Bins of line prices; order totals fall into bins, between them and above them.
    _, bins = B.min_count_bins(table(spark, sf, "lineitem"), "l_extendedprice", 500)
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return B.assign_trained_bins(orders, "o_totalprice", bins, output="price").select("o_orderkey", "price_lo", "price_hi")
