"""Readers, writers, stored lookups."""

from pyspark.sql import functions as F

from wardline.operators.columns import preview
from wardline.session import scratch_path
from wardline.functions.useragent import with_user_agent_fields
from wardline.sources.dimension import incremental_dimension
from wardline.sources.tables import (
    RAW_COLUMNS,
    checkpoint_table,
    read_parquet,
    read_processed_csv,
    read_raw_csv,
    write_csv,
    write_parquet_coerced,
)

from .base import RAW_NAMES, WITH_LOG, netlog, query, raw_log, table


@query("read_parquet", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def _(spark, sf):
    return read_parquet(spark, f"{sf}/orders.parquet").select("o_orderkey", "o_orderpriority", "o_totalprice")


_RAW_SQL = ", ".join(f"{'date_trunc(\'second\', ts)' if c == 'ts' else c} AS {c}" for c in RAW_NAMES)


@query("read_raw_csv", WITH_LOG + f" SELECT {_RAW_SQL}, CAST(NULL AS VARCHAR) AS payload, CAST(NULL AS VARCHAR) AS user_info FROM netlog")
def _(spark, sf):
    path = scratch_path(spark, "raw-csv")
    raw = raw_log(spark, sf, keep_id=False)
    # Written in another order than the fixed one: the header decides.
    write_csv(raw.select(*[F.col(f"`{n}`") for n, _ in reversed(RAW_COLUMNS)]), path)
    c = lambda n: F.col(f"`{n}`")
    named = {k: c(n).cast("timestamp_ntz") if k == "ts" else c(n) for k, n in RAW_NAMES.items()}
    named |= {"payload": c("Payload Data"), "user_info": c("User Information")}
    return read_raw_csv(spark, path).select(*[v.alias(k) for k, v in named.items()])


@query(
    "read_processed_csv",
    WITH_LOG
    + """ SELECT attack_type, anomaly, date_trunc('second', ts) AS date,
 CAST(date_trunc('day', ts) AS TIMESTAMP) AS "date dd" FROM netlog""",
)
def _(spark, sf):
    path = scratch_path(spark, "processed-csv")
    log = netlog(spark, sf).select(
        F.col("event_id").alias("index"), "attack_type", "anomaly", F.col("ts").alias("date"),
        F.date_trunc("day", "ts").alias("date dd"),
    )
    write_csv(log, path, sep="|")
    schema = "`index` long, attack_type string, anomaly double, `date` string, `date dd` string"
    read = read_processed_csv(spark, path, schema)
    return read.withColumns({c: F.col(f"`{c}`").cast("timestamp_ntz") for c in ("date", "date dd")})


@query(
    "write_parquet_coerced",
    WITH_LOG + " SELECT event_id, coalesce(malware, 'nan') AS malware, coalesce(proxy, 'nan') AS proxy, anomaly FROM netlog",
)
def _(spark, sf):
    path = scratch_path(spark, "coerced")
    write_parquet_coerced(netlog(spark, sf).select("event_id", "malware", "proxy", "anomaly"), path, null_text="nan")
    return read_parquet(spark, path)


@query("write_csv", WITH_LOG + " SELECT event_id, attack_type, anomaly, malware FROM netlog")
def _(spark, sf):
    path = scratch_path(spark, "csv")
    write_csv(netlog(spark, sf).select("event_id", "attack_type", "anomaly", "malware"), path)
    schema = "event_id long, attack_type string, anomaly double, malware string"
    return spark.read.schema(schema).option("header", True).csv(path)


@query(
    "checkpoint_table",
    WITH_LOG + " SELECT attack_type, protocol, count(*) AS n FROM netlog GROUP BY ALL",
)
def _(spark, sf):
    path = scratch_path(spark, "table")
    build = lambda: netlog(spark, sf).groupBy("attack_type", "protocol").agg(F.count("*").alias("n"))
    checkpoint_table(spark, path, build)
    return checkpoint_table(spark, path, build)


@query(
    "incremental_dimension",
    WITH_LOG
    + """ SELECT event_id, CASE WHEN device LIKE '%iPhone%' THEN 'iPhone' WHEN device LIKE '%iPad%' THEN 'iPad'
 WHEN device LIKE '%Macintosh%' THEN 'Mac' WHEN device LIKE '%Googlebot%' THEN 'Spider'
 WHEN device LIKE '%SM-G960F%' THEN 'Samsung' ELSE 'Other' END AS family FROM netlog""",
)
def _(spark, sf):
    path = scratch_path(spark, "devices")
    resolve = lambda keys: with_user_agent_fields(keys, "device").select("device", F.col("`Device family`").alias("family"))
    log = netlog(spark, sf).select("event_id", "device")
    # The lookup starts with the texts of one browser; the second run resolves the others.
    incremental_dimension(log.where(F.col("device").contains("Firefox")), path, "device", resolve).count()
    return incremental_dimension(log, path, "device", resolve).select("event_id", "family")


@query("preview", "SELECT event_id, ts, event_type FROM events ORDER BY ts, event_id LIMIT 5")
def _(spark, sf):
    return preview(table(spark, sf, "events").select("event_id", "ts", "event_type"), 5, ["ts", "event_id"])
