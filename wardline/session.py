"""Session set-up and lineage cuts."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "wardline", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution and UTC timestamps; ``conf`` overrides any setting."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    A local session without the setting gets a fresh folder of its own; on a cluster the setting is
    required, because a machine-local folder would be lost with its machine.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    context = spark.sparkContext
    path = context.getCheckpointDir()
    if path is None:
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        path = tempfile.mkdtemp(prefix="wardline-")
        context.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for a written table in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/wardline-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable checkpoint storage and continue from the stored rows.

    Used where later steps must all see one and the same set of rows (partition numbers, rounds of
    an iteration), also when an executor is lost in between.
    """
    folder, context = shared_dir(df.sparkSession), df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint()


def store(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    For lookup tables that are joined to many rows: they are computed once, and their row count is
    in the file footers, so a join can check it before it broadcasts. ``compression`` is the files' codec, the
    session's by default.
    """
    path = scratch_path(df.sparkSession, "step")
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_by(df: DataFrame, part: str) -> dict:
    """Write ``df`` once, in one folder per value of ``part``, and give the stored rows of each value, without ``part``.

    Each part is a table of its own size, as a size check sees it. For a whole-number column of few values.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "parts")
    df.write.partitionBy(part).parquet(path)
    schema = df.drop(part).schema
    found = [r[0] for r in spark.read.schema(df.schema).parquet(path).select(part).distinct().collect()]
    return {value: spark.read.schema(schema).parquet(f"{path}/{part}={value}") for value in found}
