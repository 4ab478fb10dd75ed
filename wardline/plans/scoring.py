"""Stored training runs, and scoring a raw file with one, end to end."""

from __future__ import annotations

from dataclasses import asdict, dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bias import BiasGroup, BiasModel, apply_bias_features
from ..operators.columns import label_decode, select_feature_vector
from ..operators.models import predict, score_report
from ..operators.quality import validate_rows, validation_summary
from ..session import store
from ..sources.bundle import load_model_bundle, save_model_bundle
from ..sources.tables import raw_schema, read_raw_csv, write_csv
from .ports import serving_ports_features
from .preprocess import serving_preprocess
from .training import TrainedModel


def save_trained(trained: TrainedModel, path: str) -> None:
    """Model, classes, scored test rows, side tables and, for bias classifiers, bins, crosstabs and settings."""
    tables = {"classes": trained.classes, "predictions": trained.predictions}
    tables |= {f"side_{n}": t for n, t in trained.side.items()}
    info: dict[str, object] = {"features": trained.features, "side": list(trained.side)}
    if (bias := trained.bias) is not None:
        # Tables are named by number, as columns may hold blanks and slashes.
        tables |= {f"bins_{i}": t for i, t in enumerate(bias.bins.values())}
        tables |= {f"crosstab_{i}": t for i, t in enumerate(bias.crosstabs.values())}
        info["bias"] = {
            "classes": bias.classes, "groups": [asdict(g) for g in bias.groups], "bins": list(bias.bins), "crosstabs": list(bias.crosstabs),
            "tiers": list(bias.tiers), "pars": list(bias.pars), "floor": bias.floor, "null_key": bias.null_key,
        }
    save_model_bundle(trained.model, tables, path, info)


def load_trained(spark: SparkSession, path: str) -> TrainedModel:
    """What ``save_trained`` wrote, ready for scoring in any session."""
    model, tables, info = load_model_bundle(spark, path)
    bias = None
    if (kept := info.get("bias")) is not None:
        bias = BiasModel(
            kept["classes"], [BiasGroup(**g) for g in kept["groups"]],
            {c: tables[f"bins_{i}"] for i, c in enumerate(kept["bins"])},
            {c: tables[f"crosstab_{i}"] for i, c in enumerate(kept["crosstabs"])},
            kept["tiers"], kept["pars"], kept["floor"], kept["null_key"],
        )
    side = {n: tables[f"side_{n}"] for n in info["side"]}
    return TrainedModel(model, tables["classes"], info["features"], tables["predictions"], side, bias)


@dataclass
class ScoredFile:
    """Errors in the file, the rows that have some, and, if there are none, the scored rows and their report."""

    summary: DataFrame
    bad_rows: DataFrame
    scored: DataFrame | None = None
    report: DataFrame | None = None


def score_file(
    spark: SparkSession, trained: TrainedModel, source: str, out: str, *, target: str, as_of: date | Column, multi_line: bool = False,
) -> ScoredFile:
    """Read a raw CSV file as text, validate it, and if every row is valid score it with a bias classifier or a port model.

    The scored rows, with ``prediction`` as a class, go to ``out`` as CSV. Where the file has the class, the report tells the
    share of hits. With any invalid row nothing is scored or written.
    """
    # One parse of the file: validation and scoring read the stored rows.
    validated = store(validate_rows(read_raw_csv(spark, source, as_text=True, multi_line=multi_line), as_of=as_of))
    result = ScoredFile(validation_summary(validated), validated.where(~F.col("is_valid")))
    if not result.summary.first()["may_score"]:
        return result
    numeric = [f for f in raw_schema() if f.dataType.simpleString() in ("int", "bigint", "double")]
    typed = validated.drop("errors", "is_valid").withColumns(
        {f.name: F.col(f"`{f.name}`").try_cast("double").cast(f.dataType) for f in numeric}
    )
    if trained.bias is not None:
        prepared = serving_preprocess(typed)
        featured = apply_bias_features(prepared, trained.bias)
    else:
        prepared, featured = typed, serving_ports_features(typed, trained.side["src_port_means"], trained.side["dst_port_means"])
    rows = select_feature_vector(featured, trained.features, prepared.columns)
    coded = predict(trained.model, rows).drop("features").withColumnRenamed("prediction", "__code")
    known = trained.classes.select(F.col(f"`{target}`").alias("prediction"), "label")
    scored = store(label_decode(coded, known, "prediction", "__code").drop("__code"))
    result.report = score_report(scored, "prediction", target if target in scored.columns else None)
    result.scored = scored
    flat = scored.withColumn("probability", F.to_json("probability")) if "probability" in scored.columns else scored
    write_csv(flat, out)
    return result
