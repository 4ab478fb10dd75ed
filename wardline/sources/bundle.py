"""A fitted model with its side tables, stored together."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.ml import PipelineModel
from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession

from .tables import try_read_parquet


def save_model_bundle(
    model: MLWritable, tables: Mapping[str, DataFrame], path: str, info: Mapping[str, object] | None = None
) -> None:
    """Write the model, one Parquet table per name, and a small JSON record (columns, metrics).

    Every save writes a version folder of its own and the record, which names it, last: until then an earlier
    bundle stays whole, and a bundle without a record counts as missing.
    """
    pipeline = model if isinstance(model, PipelineModel) else PipelineModel([model])
    version = uuid.uuid4().hex
    pipeline.write().save(f"{path}/{version}/model")
    for name, table in tables.items():
        table.write.parquet(f"{path}/{version}/tables/{name}")
    record = json.dumps({"version": version, "tables": sorted(tables), "info": dict(info or {})})
    spark = SparkSession.active()
    spark.createDataFrame([(record,)], "record string").coalesce(1).write.mode("overwrite").parquet(f"{path}/record")


def load_model_bundle(
    spark: SparkSession,
    path: str,
    train: Callable[[], tuple[MLWritable, Mapping[str, DataFrame], Mapping[str, object]]] | None = None,
) -> tuple[PipelineModel, dict[str, DataFrame], dict]:
    """``(model, tables, info)``. A missing bundle is trained and saved first when ``train`` is given."""
    stored = try_read_parquet(spark, f"{path}/record")
    if stored is None:
        if train is None:
            raise FileNotFoundError(f"no complete model bundle at {path}")
        model, tables, info = train()
        save_model_bundle(model, tables, path, info)
        stored = spark.read.parquet(f"{path}/record")
    record = json.loads(stored.first()[0])
    folder = f"{path}/{record['version']}"
    tables = {n: spark.read.parquet(f"{folder}/tables/{n}") for n in record["tables"]}
    return PipelineModel.load(f"{folder}/model"), tables, record["info"]
