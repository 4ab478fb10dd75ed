"""Daily series."""

from wardline.operators import series as S

from .base import WITH_LOG, netlog, query, rounded, table

_CLASSES = ("DDoS", "Intrusion", "Malware")
_COUNTS = ", ".join(f"count(*) FILTER (attack_type = '{c}') AS \"{c}\"" for c in _CLASSES)


@query("daily_counts", WITH_LOG + f" SELECT CAST(ts AS DATE) AS day, {_COUNTS} FROM netlog GROUP BY 1")
def _(spark, sf):
    return S.daily_counts(netlog(spark, sf), "ts", "attack_type")


@query("daily_counts_by", WITH_LOG + f" SELECT CAST(ts AS DATE) AS day, segment, {_COUNTS} FROM netlog GROUP BY 1, 2")
def _(spark, sf):
    return S.daily_counts_by(netlog(spark, sf), "ts", "segment", "attack_type")


_SERIES = """s AS (SELECT day, f AS series, CAST(count(*) FILTER (l_returnflag = f) AS DOUBLE) AS x FROM
 (SELECT CAST(l_shipdate AS DATE) AS day, l_returnflag FROM lineitem) r, (SELECT unnest(['A', 'N', 'R']) AS f) c GROUP BY 1, 2)"""


@query("daily_series", f"WITH {_SERIES} SELECT series, day, x FROM s")
def _(spark, sf):
    return S.daily_series(table(spark, sf, "lineitem"), "l_shipdate", "l_returnflag")


_ACF = """i AS (SELECT series, row_number() OVER (PARTITION BY series ORDER BY day) AS t, x - avg(x) OVER (PARTITION BY series) AS x FROM s),
 p AS (SELECT a.series, CAST(b.t - a.t AS INT) AS lag, sum(a.x * b.x) AS p FROM i a JOIN i b ON a.series = b.series AND b.t - a.t BETWEEN 0 AND {0} GROUP BY 1, 2),
 r AS (SELECT series, lag, p / first_value(p) OVER (PARTITION BY series ORDER BY lag) AS acf FROM p)"""


@query("acf", f"WITH {_SERIES}, {_ACF.format(100)} SELECT series, lag, round(acf, 6) AS acf FROM r")
def _(spark, sf):
    series = S.daily_series(table(spark, sf, "lineitem"), "l_shipdate", "l_returnflag")
    return rounded(S.acf(series, "series", "day", "x", 100), "acf")


@query(
    "acf_by_variable",
    WITH_LOG
    + f""", s AS (SELECT day, concat(f, ' x ', segment) AS series, CAST(count(*) FILTER (attack_type = f) AS DOUBLE) AS x FROM
 (SELECT CAST(ts AS DATE) AS day, segment, attack_type FROM netlog) r, (SELECT unnest(['DDoS', 'Intrusion', 'Malware']) AS f) c GROUP BY 1, 2),
 {_ACF.format(10)} SELECT series, lag, round(acf, 6) AS acf FROM r""",
)
def _(spark, sf):
    series = S.daily_series(netlog(spark, sf), "ts", "attack_type", "segment")
    return rounded(S.acf(series, "series", "day", "x", 10), "acf")


@query(
    "pacf_two_lags",
    f"""WITH {_SERIES}, i AS (SELECT series, row_number() OVER (PARTITION BY series ORDER BY day) AS t, x - avg(x) OVER (PARTITION BY series) AS x,
  count(*) OVER (PARTITION BY series) AS n FROM s),
 c AS (SELECT a.series, b.t - a.t AS lag, sum(a.x * b.x) / (max(a.n) - (b.t - a.t)) AS c FROM i a JOIN i b ON a.series = b.series AND b.t - a.t BETWEEN 0 AND 2 GROUP BY 1, 2),
 r AS (SELECT series, max(c) FILTER (lag = 1) / max(c) FILTER (lag = 0) AS r1, max(c) FILTER (lag = 2) / max(c) FILTER (lag = 0) AS r2 FROM c GROUP BY 1)
 SELECT series, 0 AS lag, 1.0::DOUBLE AS pacf FROM r UNION ALL SELECT series, 1, round(r1, 6) FROM r
 UNION ALL SELECT series, 2, round((r2 - r1 * r1) / (1 - r1 * r1), 6) FROM r""",
)
def _(spark, sf):
    series = S.daily_series(table(spark, sf, "lineitem"), "l_shipdate", "l_returnflag")
    return rounded(S.pacf(series, "series", "day", "x", 2), "pacf")


@query("pacf")
def _(spark, sf):
    series = S.daily_series(table(spark, sf, "lineitem"), "l_shipdate", "l_returnflag")
    return rounded(S.pacf(series, "series", "day", "x", 100), "pacf")
