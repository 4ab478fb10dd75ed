"""Runs in sort order and partition extremes."""

from pyspark.sql import functions as F

from wardline.operators import windows as W
from wardline.operators.series import lagged_products

from .base import query, rounded, table

_ROWS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@query(
    "change_flag",
    """SELECT event_id, user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1 AS INT) AS changed FROM events""",
)
def _(spark, sf):
    return W.change_flag(table(spark, sf, "events").select("event_id", "user_id"), "user_id", ["event_id"])


@query(
    "run_group_id",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, dense_rank() OVER (ORDER BY l_quantity) AS run FROM lineitem",
)
def _(spark, sf):
    return W.run_group_id(table(spark, sf, "lineitem").select(*_ROWS), "l_quantity")


@query(
    "run_sizes",
    "SELECT row_number() OVER (ORDER BY l_extendedprice) AS run, count(*) AS run_size FROM lineitem GROUP BY l_extendedprice",
)
def _(spark, sf):
    return W.run_sizes(table(spark, sf, "lineitem"), "l_extendedprice")


@query(
    "partition_min_max",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, min(l_partkey) OVER (PARTITION BY l_quantity) AS l_partkey_min,
 max(l_partkey) OVER (PARTITION BY l_quantity) AS l_partkey_max FROM lineitem""",
)
def _(spark, sf):
    return W.partition_min_max(table(spark, sf, "lineitem").select(*_ROWS), "l_quantity", "l_partkey")


@query(
    "row_argmax",
    """WITH c AS (SELECT CAST(l_shipdate AS DATE) AS day, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2)
 SELECT day, l_suppkey, n FROM c QUALIFY row_number() OVER (PARTITION BY day ORDER BY n DESC, l_suppkey) = 1""",
)
def _(spark, sf):
    counts = (
        table(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("day"), "l_suppkey").agg(F.count("*").alias("n"))
    )
    return W.row_argmax(counts, "day", "l_suppkey", "n")


@query(
    "lagged_products",
    """WITH s AS (SELECT event_type, CAST(ts AS DATE) AS day, CAST(count(*) AS DOUBLE) AS x FROM events GROUP BY 1, 2),
 i AS (SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY day) AS t, x - avg(x) OVER (PARTITION BY event_type) AS x,
  count(*) OVER (PARTITION BY event_type) AS n FROM s)
 SELECT a.event_type, CAST(b.t - a.t AS INT) AS lag, max(a.n) AS n, round(sum(a.x * b.x), 4) AS product FROM i a JOIN i b
  ON a.event_type = b.event_type AND b.t - a.t BETWEEN 0 AND 7 GROUP BY 1, 2""",
)
def _(spark, sf):
    series = (
        table(spark, sf, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("x"))
    )
    return rounded(lagged_products(series, "event_type", "day", "x", 7), "product", digits=4)
