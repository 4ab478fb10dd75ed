"""Classification metrics over predicted rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import class_labels
from .ordered import running


def _labels(df: DataFrame, label: str, prediction: str) -> list:
    both = df.select(F.explode(F.array(F.col(label), F.col(prediction))).alias("c"))
    return class_labels(both, "c")


def confusion_matrix(
    pred: DataFrame, label: str, prediction: str, classes: Sequence[object] | None = None
) -> DataFrame:
    """``(label, prediction, n)`` for every pair of classes, 0 where none."""
    classes = list(classes) if classes is not None else _labels(pred, label, prediction)
    names = F.array(*[F.lit(c) for c in classes])
    grid = (
        pred.sparkSession.range(1)
        .select(F.explode(names).alias("label"))
        .select("label", F.explode(names).alias("prediction"))
    )
    counts = pred.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return grid.join(counts, ["label", "prediction"], "left").select(
        "label", "prediction", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


def accuracy(pred: DataFrame, label: str, prediction: str) -> DataFrame:
    hit = F.coalesce(F.col(label) == F.col(prediction), F.lit(False))
    return pred.agg(F.avg(hit.cast("int")).alias("accuracy"))


def classification_report(pred: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class, plus ``macro avg``, ``weighted avg`` and
    ``accuracy`` rows. A class without rows or predictions scores 0."""
    cells = pred.groupBy(F.col(label).alias("l"), F.col(prediction).alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    sides = F.array(
        F.struct(F.col("l").cast("string").alias("class"), F.col("n").alias("support"),
                 F.lit(0).cast("long").alias("predicted"), F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("p").cast("string").alias("class"), F.lit(0).cast("long").alias("support"),
                 F.col("n").alias("predicted"), F.lit(0).cast("long").alias("hit")),
    )
    zero = F.lit(0.0)
    per = (
        cells.select(F.inline(sides))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hit")])
        .withColumn("precision", F.coalesce(F.col("hit") / F.nullif("predicted", F.lit(0)), zero))
        .withColumn("recall", F.coalesce(F.col("hit") / F.nullif("support", F.lit(0)), zero))
        .withColumn(
            "f1",
            F.coalesce(
                2.0 * F.col("hit") / F.nullif(F.col("predicted") + F.col("support"), F.lit(0)), zero
            ),
        )
    )
    scores = ("precision", "recall", "f1")
    total = F.sum("support")
    share = (F.sum("hit") / total)

    def row(name: str, values):
        return F.struct(
            F.lit(name).alias("class"), *[v.alias(s) for v, s in zip(values, scores)],
            total.cast("long").alias("support"),
        )

    summary = per.agg(
        F.array(
            row("macro avg", [F.avg(s) for s in scores]),
            row("weighted avg", [F.sum(F.col(s) * F.col("support")) / total for s in scores]),
            row("accuracy", [share, share, share]),
        ).alias("rows")
    ).select(F.inline("rows"))
    return per.select("class", *scores, "support").unionByName(summary)


def macro_f1(pred: DataFrame, label: str, prediction: str) -> DataFrame:
    report = classification_report(pred, label, prediction)
    return report.where("class = 'macro avg'").select(F.col("f1").alias("macro_f1"))


def one_vs_rest(df: DataFrame, label: str, probability: str, classes: Sequence[object]) -> DataFrame:
    """``(class, score, positive)``: one row per input row and class of an array of probabilities."""
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("class"),
                F.get(probability, F.lit(i)).alias("score"),
                F.coalesce(F.col(label) == F.lit(c), F.lit(False)).cast("long").alias("positive"),
            )
            for i, c in enumerate(classes)
        ]
    )
    return df.select(F.inline(cells))


def score_steps(df: DataFrame, score: str, positive: str, by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score, highest first: positives and negatives at it and above it.

    Tied scores form one step, so the curve does not depend on row order.
    """
    steps = (
        df.where(F.col(score).isNotNull())
        .groupBy(*by, F.col(score).alias("threshold"))
        .agg(F.sum(positive).cast("long").alias("pos"), F.sum(1 - F.col(positive)).cast("long").alias("neg"))
    )
    return running(steps, ["threshold"], sums=["pos", "neg"], by=by, descending=True)


def roc_curve(df: DataFrame, score: str, positive: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., threshold, fpr, tpr)`` at every distinct score, plus the origin (null threshold)."""
    steps = score_steps(df, score, positive, by)
    points = steps.select(
        *by,
        "threshold",
        ((F.col("neg_before") + F.col("neg")) / F.nullif("neg_total", F.lit(0))).alias("fpr"),
        ((F.col("pos_before") + F.col("pos")) / F.nullif("pos_total", F.lit(0))).alias("tpr"),
    )
    first = steps.where("pos_before + neg_before = 0").select(
        *by, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.withColumn("threshold", F.col("threshold").cast("double")).unionByName(first)


def auc(df: DataFrame, score: str, positive: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve by trapezoids: each step adds its negatives times the mean height."""
    steps = score_steps(df, score, positive, by)
    area = F.sum(F.col("neg") * (F.col("pos_before") + F.col("pos") / 2.0))
    whole = F.max("pos_total").cast("double") * F.max("neg_total")
    return steps.groupBy(*by).agg((area / F.nullif(whole, F.lit(0.0))).alias("auc"))


def pr_curve(df: DataFrame, score: str, positive: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., threshold, recall, precision)`` at every distinct score, plus the end point (0, 1)
    with a null threshold."""
    steps = score_steps(df, score, positive, by)
    hits = F.col("pos_before") + F.col("pos")
    points = steps.select(
        *by,
        F.col("threshold").cast("double").alias("threshold"),
        (hits / F.nullif("pos_total", F.lit(0))).alias("recall"),
        (hits / (hits + F.col("neg_before") + F.col("neg"))).alias("precision"),
    )
    end = steps.where("pos_before + neg_before = 0").select(
        *by, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("recall"), F.lit(1.0).alias("precision")
    )
    return points.unionByName(end)


def average_precision(df: DataFrame, score: str, positive: str, by: Sequence[str] = ()) -> DataFrame:
    """Sum over the steps of the recall gained times the precision reached."""
    steps = score_steps(df, score, positive, by)
    hits = F.col("pos_before") + F.col("pos")
    gained = F.col("pos") / F.nullif("pos_total", F.lit(0))
    precision = hits / (hits + F.col("neg_before") + F.col("neg"))
    return steps.groupBy(*by).agg(F.sum(gained * precision).alias("average_precision"))
