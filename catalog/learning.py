"""Metrics, models, training and scoring runs."""

from pyspark.sql import functions as F

from wardline.functions.encoding import class_confidence
from wardline.operators import metrics as M
from wardline.operators import models as L
from wardline.operators.bias import RAW_ROW_GROUPS
from wardline.operators.columns import select_feature_vector
from wardline.operators.split import train_test
from wardline.plans.preprocess import serving_preprocess
from wardline.plans.scoring import load_trained, save_trained, score_file
from wardline.plans.training import (
    leakage_comparison,
    serving_bias_features,
    train_bias_classifier,
    train_ports_model,
)
from wardline.session import materialize, scratch_path
from wardline.sources.bundle import load_model_bundle, save_model_bundle
from wardline.sources.tables import write_csv

from .base import WITH_LOG, netlog, query, raw_log, rounded, table

# --- metrics, on a prediction and scores made from the row number -------------------------------

_PRED = {
    "label": "CAST(CASE event_type WHEN 'error' THEN 0 WHEN 'click' THEN 1 WHEN 'view' THEN 1 ELSE 2 END AS INT)",
    "prediction": "CAST(CASE WHEN event_id * 7 % 10 < 6 THEN CASE event_type WHEN 'error' THEN 0 WHEN 'click' THEN 1 WHEN 'view' THEN 1 ELSE 2 END ELSE event_id % 3 END AS INT)",
    "score": "CAST((event_id * 7919 % 1000 + CASE WHEN event_type = 'error' THEN 300 ELSE 0 END) AS DOUBLE)",
    "positive": "CAST(event_type = 'error' AS INT)",
}
_P = ", ".join(f"{e} AS {n}" for n, e in _PRED.items())
_WITH_PRED = f"WITH p AS (SELECT event_id, event_type, {_P} FROM events)"


def _pred(spark, sf):
    return table(spark, sf, "events").selectExpr("event_id", "event_type", *[f"{e} AS {n}" for n, e in _PRED.items()])


@query(
    "confusion_matrix",
    _WITH_PRED
    + """ SELECT l.c AS label, r.c AS prediction, count(p.event_id) AS n FROM (SELECT unnest([0, 1, 2]) AS c) l CROSS JOIN (SELECT unnest([0, 1, 2]) AS c) r
 LEFT JOIN p ON p.label = l.c AND p.prediction = r.c GROUP BY 1, 2""",
)
def _(spark, sf):
    return M.confusion_matrix(_pred(spark, sf), "label", "prediction")


@query("accuracy", _WITH_PRED + " SELECT round(avg(CAST(label = prediction AS INT)), 6) AS accuracy FROM p")
def _(spark, sf):
    return rounded(M.accuracy(_pred(spark, sf), "label", "prediction"), "accuracy")


_REPORT = (
    _WITH_PRED
    + """, k AS (SELECT unnest([0, 1, 2]) AS c),
 s AS (SELECT CAST(c AS STRING) AS class, count(*) FILTER (label = c) AS support, count(*) FILTER (prediction = c) AS predicted,
  count(*) FILTER (label = c AND prediction = c) AS hit FROM p, k GROUP BY c),
 f AS (SELECT class, hit / predicted AS precision, hit / support AS recall, 2.0::DOUBLE * hit / (predicted + support) AS f1, support, hit FROM s)"""
)


@query(
    "classification_report",
    _REPORT
    + """ SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM f
 UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM f
 UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
  round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f
 UNION ALL SELECT 'accuracy', round(sum(hit) / sum(support), 6), round(sum(hit) / sum(support), 6), round(sum(hit) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f""",
)
def _(spark, sf):
    return rounded(M.classification_report(_pred(spark, sf), "label", "prediction"), "precision", "recall", "f1")


@query("macro_f1", _REPORT + " SELECT round(avg(f1), 6) AS macro_f1 FROM f")
def _(spark, sf):
    return rounded(M.macro_f1(_pred(spark, sf), "label", "prediction"), "macro_f1")


_STEPS = """g AS (SELECT score AS threshold, sum(positive) AS pos, count(*) - sum(positive) AS neg FROM p GROUP BY 1),
 w AS (SELECT threshold, pos, neg, sum(pos) OVER (ORDER BY threshold DESC) AS tp, sum(neg) OVER (ORDER BY threshold DESC) AS fp,
  sum(pos) OVER () AS ap, sum(neg) OVER () AS an FROM g)"""


@query(
    "roc_curve",
    f"{_WITH_PRED}, {_STEPS} SELECT threshold, round(fp / an, 6) AS fpr, round(tp / ap, 6) AS tpr FROM w UNION ALL SELECT NULL, 0.0, 0.0",
)
def _(spark, sf):
    return rounded(M.roc_curve(_pred(spark, sf), "score", "positive"), "fpr", "tpr")


@query("auc", f"{_WITH_PRED}, {_STEPS} SELECT round(sum(neg * (tp - pos + pos / 2.0::DOUBLE)) / max(ap * an), 6) AS auc FROM w")
def _(spark, sf):
    return rounded(M.auc(_pred(spark, sf), "score", "positive"), "auc")


@query(
    "pr_curve",
    f"{_WITH_PRED}, {_STEPS} SELECT threshold, round(tp / ap, 6) AS recall, round(tp / (tp + fp), 6) AS precision FROM w UNION ALL SELECT NULL, 0.0, 1.0",
)
def _(spark, sf):
    return rounded(M.pr_curve(_pred(spark, sf), "score", "positive"), "recall", "precision")


@query("average_precision", f"{_WITH_PRED}, {_STEPS} SELECT round(sum(pos / ap * (tp / (tp + fp))), 6) AS average_precision FROM w")
def _(spark, sf):
    return rounded(M.average_precision(_pred(spark, sf), "score", "positive"), "average_precision")


@query(
    "auc_one_vs_rest",
    _WITH_PRED
    + """, o AS (SELECT c, CASE c WHEN 0 THEN score ELSE (score * (c + 1)) % 997 END AS s, CAST(label = c AS INT) AS positive FROM p, (SELECT unnest([0, 1, 2]) AS c) k),
 g AS (SELECT c, s, sum(positive) AS pos, count(*) - sum(positive) AS neg FROM o GROUP BY 1, 2),
 w AS (SELECT c, pos, neg, sum(pos) OVER (PARTITION BY c ORDER BY s DESC) AS tp, sum(pos) OVER (PARTITION BY c) AS ap, sum(neg) OVER (PARTITION BY c) AS an FROM g)
 SELECT c AS class, round(sum(neg * (tp - pos + pos / 2.0::DOUBLE)) / max(ap * an), 6) AS auc FROM w GROUP BY c""",
)
def _(spark, sf):
    scores = F.array("score", F.expr("score * 2 % 997"), F.expr("score * 3 % 997"))
    rows = M.one_vs_rest(_pred(spark, sf).withColumn("scores", scores), "label", "scores", [0, 1, 2])
    return rounded(M.auc(rows, "score", "positive", by=["class"]), "auc")


@query(
    "dummy_stratified",
    _WITH_PRED
    + """, u AS (SELECT event_id, CAST(concat('0x', substr(md5(concat('42:', CAST(event_id AS STRING))), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE AS u FROM p),
 c AS (SELECT label, sum(count(*)) OVER (ORDER BY label) / (SELECT count(*) FROM p) AS upto FROM p GROUP BY label)
 SELECT event_id, min(label) AS prediction FROM u JOIN c ON u.u < c.upto GROUP BY event_id""",
)
def _(spark, sf):
    rows = _pred(spark, sf).select("event_id", "label")
    return L.dummy_stratified(rows, rows, "label", "event_id").select("event_id", "prediction")


@query(
    "score_report",
    _WITH_PRED
    + """ SELECT prediction, count(*) AS n, count(*) FILTER (label = prediction) AS correct, round(avg(CAST(label = prediction AS INT)), 6) AS accuracy FROM p GROUP BY 1""",
)
def _(spark, sf):
    return rounded(L.score_report(_pred(spark, sf), "prediction", "label"), "accuracy")


# --- fitted models ----------------------------------------------------------------------------------

_NUMERIC = ("packet_length", "anomaly", "src_port", "dst_port", "hour", "k", "user")


def _vectors(spark, sf):
    log = netlog(spark, sf).select(
        "event_id", "packet_length", "anomaly", "src_port", "dst_port", F.hour("ts").alias("hour"), "k",
        F.col("user_id").alias("user"),
        # A label with structure to learn, from the same columns.
        F.expr("CAST(CASE WHEN packet_length > 1200 THEN 0 WHEN k % 3 = 0 THEN 1 ELSE 2 END AS INT)").alias("label"),
    )
    return select_feature_vector(log, _NUMERIC, ["event_id", "label"])


def _split(spark, sf):
    return train_test(_vectors(spark, sf), "label", "event_id", 0.2, 42)


def _fit(spark, sf, estimator):
    train, test = _split(spark, sf)
    return L.predict(estimator.fit(train), test).select("event_id", "label", "prediction")


@query("logit")
def _(spark, sf):
    train, test = _split(spark, sf)
    model = L.logit(n_train=train.count()).fit(train)
    return L.predict(model, test).select("event_id", "label", "prediction")


@query("random_forest")
def _(spark, sf):
    return _fit(spark, sf, L.random_forest())


@query("extra_trees")
def _(spark, sf):
    return _fit(spark, sf, L.extra_trees())


@query("decision_tree")
def _(spark, sf):
    return _fit(spark, sf, L.decision_tree())


@query("gradient_boosting")
def _(spark, sf):
    return _fit(spark, sf, L.gradient_boosting(maxIter=3, maxDepth=4))


@query("random_forest_search")
def _(spark, sf):
    train, test = _split(spark, sf)
    grid = {"numTrees": (5, 10), "maxDepth": (6, None), "minSamplesSplit": (2, 10), "featureSubsetStrategy": ("sqrt", 0.5)}
    search = L.random_forest_search(train, "event_id", grid, n_iter=2)
    return L.predict(search.bestModel, test).select("event_id", "label", "prediction")


@query("cv_score")
def _(spark, sf):
    return L.cv_score(_vectors(spark, sf), L.decision_tree(), "event_id", k=5)


@query("compare_models")
def _(spark, sf):
    train, test = _split(spark, sf)
    return L.compare_models(
        train, test, {"tree": L.decision_tree(), "forest": L.random_forest(numTrees=5, maxDepth=5)}
    )


@query("predict")
def _(spark, sf):
    train, test = _split(spark, sf)
    scored = L.predict(L.decision_tree().fit(train), test)
    name, confidence = class_confidence("probability", ["long", "third", "other"])
    return scored.select("event_id", "prediction", name.alias("class"), confidence.alias("confidence"))


@query("batch_score")
def _(spark, sf):
    train, test = _split(spark, sf)
    return L.batch_score(L.decision_tree().fit(train), test, "label")[1]


@query("feature_importance")
def _(spark, sf):
    train, _ = _split(spark, sf)
    return L.feature_importance(L.random_forest().fit(train), _NUMERIC, 5)


@query(
    "save_model_bundle",
    WITH_LOG
    + """ SELECT CASE WHEN packet_length > 1200 THEN 0 WHEN k % 3 = 0 THEN 1 ELSE 2 END AS label, count(*) AS n FROM netlog GROUP BY 1""",
)
def _(spark, sf):
    path = scratch_path(spark, "bundle")
    rows = _vectors(spark, sf)
    classes = rows.groupBy("label").agg(F.count("*").alias("n"))
    save_model_bundle(L.decision_tree().fit(rows), {"classes": classes}, path, {"features": list(_NUMERIC)})
    return load_model_bundle(spark, path)[1]["classes"]


@query("load_model_bundle")
def _(spark, sf):
    path = scratch_path(spark, "bundle")
    train, test = _split(spark, sf)
    fit = lambda: (L.decision_tree().fit(train), {}, {"features": list(_NUMERIC)})
    load_model_bundle(spark, path, fit)  # trains and saves
    model, _, _ = load_model_bundle(spark, path)
    return L.predict(model, test).select("event_id", "label", "prediction")


def _bias_model(spark, sf, **settings):
    """Trained on raw rows prepared as they are for scoring, with all groups that need no geolocation."""
    return train_bias_classifier(
        serving_preprocess(raw_log(spark, sf)), "Attack Type", "event_id", lambda n: L.logit(n_train=n),
        groups=RAW_ROW_GROUPS, **settings,
    )


@query("train_bias_classifier")
def _(spark, sf):
    return _bias_model(spark, sf).predictions.select("event_id", "label", "prediction")


@query("train_bias_classifier_on_all")
def _(spark, sf):
    return _bias_model(spark, sf, fit_on_all=True).predictions.select("event_id", "label", "prediction")


@query("serving_bias_features")
def _(spark, sf):
    trained = _bias_model(spark, sf)
    return L.predict(trained.model, serving_bias_features(raw_log(spark, sf), trained, ["event_id"])).select(
        "event_id", "prediction"
    )


@query("train_ports_model")
def _(spark, sf):
    trained = train_ports_model(raw_log(spark, sf), "Attack Type", "event_id", L.extra_trees(numTrees=5, maxDepth=6))
    return trained.predictions.select("event_id", "label", "prediction")


@query("score_file")
def _(spark, sf):
    """A stored port model, loaded again, scores the log written as a raw CSV file; the share of hits by class."""
    raw, run, source, out = raw_log(spark, sf), *(scratch_path(spark, n) for n in ("run", "log", "scored"))
    save_trained(train_ports_model(raw, "Attack Type", "event_id", L.decision_tree()), run)
    write_csv(raw.drop("event_id"), source)
    done = score_file(spark, load_trained(spark, run), source, out, target="Attack Type", as_of=raw.agg(F.max("Timestamp").cast("date")).scalar())
    return done.summary if done.report is None else done.report


@query("leakage_comparison")
def _(spark, sf):
    log = materialize(
        netlog(spark, sf).selectExpr(
            "event_id", "src_port", "dst_port",
            "CASE attack_type WHEN 'DDoS' THEN 0 WHEN 'Intrusion' THEN 1 ELSE 2 END AS target",
        )
    )
    return leakage_comparison(log, ["src_port", "dst_port"], "target", "event_id", L.random_forest(numTrees=5, maxDepth=5))
