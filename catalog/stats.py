"""Association statistics."""

from pyspark.sql import functions as F

from wardline.operators import stats as S

from .base import WITH_LOG, netlog, query, rounded, table


def _mcc_sql(col: str, target: str, source: str) -> str:
    return f"""SELECT '{col}' AS feature, CASE WHEN (s * s - pp) * (s * s - tt) = 0 THEN 0.0 ELSE (c * s - pt) / sqrt((s * s - pp) * (s * s - tt)) END AS mcc FROM
 (SELECT (SELECT count(*)::DOUBLE FROM {source}) AS s, (SELECT count(*) FILTER ({target} = {col})::DOUBLE FROM {source}) AS c,
  (SELECT sum(n * n)::DOUBLE FROM (SELECT count(*) AS n FROM {source} GROUP BY {col}) a) AS pp,
  (SELECT sum(n * n)::DOUBLE FROM (SELECT count(*) AS n FROM {source} GROUP BY {target}) a) AS tt,
  (SELECT coalesce(sum(a.n * b.n), 0)::DOUBLE FROM (SELECT {col} AS l, count(*) AS n FROM {source} GROUP BY {col}) a
   JOIN (SELECT {target} AS l, count(*) AS n FROM {source} GROUP BY {target}) b USING (l)) AS pt) q"""


# A guessed class next to the true one, so that label sets overlap.
_GUESS = "CASE WHEN event_id % 3 = 0 THEN event_type WHEN event_id % 3 = 1 THEN 'click' ELSE 'other' END"


@query(
    "mcc",
    f"WITH g AS (SELECT event_type, {_GUESS} AS guess, CASE WHEN event_id % 2 = 0 THEN 'x' ELSE 'y' END AS foreign_label FROM events) "
    + "SELECT feature, round(mcc, 6) AS mcc FROM ("
    + _mcc_sql("guess", "event_type", "g") + " UNION ALL " + _mcc_sql("foreign_label", "event_type", "g") + ") s",
)
def _(spark, sf):
    rows = table(spark, sf, "events").select(
        "event_type", F.expr(_GUESS).alias("guess"), F.expr("CASE WHEN event_id % 2 = 0 THEN 'x' ELSE 'y' END").alias("foreign_label")
    )
    return rounded(S.mcc(rows, "event_type", ["guess", "foreign_label"]), "mcc")


_CODED = ("l_linenumber", "l_tax", "l_discount", "l_returnflag", "l_linestatus", "l_suppkey")


@query(
    "chi_square_codes",
    f"""WITH k AS (SELECT {', '.join(f'CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS DOUBLE) AS {c}' for c in _CODED)} FROM lineitem),
 r AS (SELECT *, {' + '.join(_CODED)} AS c FROM k),
 a AS (SELECT count(*) AS n, min(c) AS smallest, sum(c) AS total, {', '.join(f'sum({c} * {c} / nullif(c, 0)) / sum({c}) AS q_{c}' for c in _CODED)} FROM r)
 SELECT CASE WHEN smallest > 0 THEN round(total * ({' + '.join(f'q_{c}' for c in _CODED)}) - total, 3) END AS statistic, (n - 1) * {len(_CODED) - 1} AS dof FROM a""",
)
def _(spark, sf):
    return rounded(S.chi_square_codes(table(spark, sf, "lineitem"), _CODED), "statistic", digits=3)


_FEATURES = ("protocol", "severity", "segment", "log_source", "dst_port")


def _cells(col: str, target: str = "attack_type") -> str:
    return f"""(SELECT '{col}' AS feature, CAST({col} AS STRING) AS v, {target} AS c, count(*)::DOUBLE AS n FROM netlog GROUP BY 2, 3)"""


_MARGINS = f""", cells AS ({' UNION ALL '.join('SELECT * FROM ' + _cells(c) for c in _FEATURES)}),
 m AS (SELECT *, sum(n) OVER (PARTITION BY feature, v) AS nv, sum(n) OVER (PARTITION BY feature, c) AS nc, sum(n) OVER (PARTITION BY feature) AS t FROM cells)"""


@query(
    "chi_square_features",
    WITH_LOG
    + _MARGINS
    + """ SELECT feature, round(max(t) * (sum(n * n / (nv * nc)) - 1), 4) AS statistic, (count(DISTINCT v) - 1) * (count(DISTINCT c) - 1) AS dof
 FROM m GROUP BY feature""",
)
def _(spark, sf):
    return rounded(S.chi_square_features(netlog(spark, sf), _FEATURES, "attack_type"), "statistic", digits=4)


_OPEN = (*_FEATURES, "src_port")


@query(
    "chi_square_pvalues",
    # With three classes the degrees of freedom are even, so the upper tail is a finite sum.
    WITH_LOG
    + _MARGINS.replace("cells AS (", "cells AS (SELECT * FROM " + _cells("src_port") + " UNION ALL ", 1)
    + """, x AS (SELECT feature, max(t) * (sum(n * n / (nv * nc)) - 1) AS statistic, (count(DISTINCT v) - 1) * (count(DISTINCT c) - 1) AS dof FROM m GROUP BY feature),
 p AS (SELECT *, list_sum(list_transform(range(0, dof // 2), lambda i: exp(i * ln(statistic / 2) - statistic / 2 - lgamma(i + 1)))) AS p_value FROM x)
 SELECT feature, round(statistic, 4) AS statistic, dof, round(p_value, 6) AS p_value, p_value < 0.05 AS significant FROM p""",
)
def _(spark, sf):
    out = rounded(S.chi_square_pvalues(netlog(spark, sf), _OPEN, "attack_type"), "statistic", digits=4)
    return rounded(out, "p_value")


@query(
    "mutual_information",
    WITH_LOG + _MARGINS + " SELECT feature, round(greatest(sum(n / t * ln(n * t / (nv * nc))), 0), 6) AS mi FROM m GROUP BY feature",
)
def _(spark, sf):
    return rounded(S.mutual_information(netlog(spark, sf), _FEATURES, "attack_type"), "mi")
