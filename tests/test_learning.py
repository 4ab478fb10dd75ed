from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardline.operators import metrics as M
from wardline.operators import models as L
from wardline.operators import series as T
from wardline.operators.columns import equality_indicator, label_encode, page_count, select_feature_vector
from wardline.sources.bundle import load_model_bundle
from wardline.sources.dimension import incremental_dimension
from wardline.sources.tables import checkpoint_table, read_raw_csv, raw_schema, write_csv


def brute_auc(rows):
    pos = [s for s, y in rows if y]
    neg = [s for s, y in rows if not y]
    return np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])


def test_auc_with_ties_equals_pair_counting(spark, many_partitions):
    rng = np.random.default_rng(5)
    rows = [(float(s), int(y)) for s, y in zip(rng.integers(0, 20, 300), rng.integers(0, 2, 300))]
    df = spark.createDataFrame(rows, "s double, y int")
    assert M.auc(df, "s", "y").first().auc == pytest.approx(brute_auc(rows))
    curve = sorted((r.fpr, r.tpr) for r in M.roc_curve(df, "s", "y").collect())
    assert curve[0] == (0, 0) and curve[-1] == (1, 1)
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(curve, curve[1:]))
    assert area == pytest.approx(brute_auc(rows))


def test_single_class_has_no_auc(spark):
    df = spark.createDataFrame([(0.5, 1), (0.6, 1)], "s double, y int")
    assert M.auc(df, "s", "y").first().auc is None


def test_average_precision_by_hand(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.7, 1), (0.6, 0)], "s double, y int")
    assert M.average_precision(df, "s", "y").first()[0] == pytest.approx(0.5 * 1 + 0.5 * 2 / 3)


def test_confusion_and_report_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "l int, p int")
    cells = {(r.label, r.prediction): r.n for r in M.confusion_matrix(df, "l", "p").collect()}
    assert len(cells) == 9 and cells[2, 2] == 0 and cells[2, 1] == 1
    report = {r["class"]: r for r in M.classification_report(df, "l", "p").collect()}
    assert (report["2"].precision, report["2"].recall, report["2"].f1) == (0.0, 0.0, 0.0)
    assert report["1"].precision == pytest.approx(1 / 3) and report["accuracy"].f1 == 0.5
    assert report["macro avg"].f1 == pytest.approx((2 / 3 + 0.5 + 0) / 3)


def yule_walker(x, nlags):
    x, n = np.asarray(x) - np.mean(x), len(x)
    r = np.array([x[: n - k] @ x[k:] / (n - k) for k in range(nlags + 1)])
    out = [1.0]
    for k in range(1, nlags + 1):
        out.append(np.linalg.solve([[r[abs(i - j)] for j in range(k)] for i in range(k)], r[1 : k + 1])[-1])
    return out


def test_acf_and_pacf_equal_numpy(spark):
    rng = np.random.default_rng(6)
    x = np.cumsum(rng.normal(size=80)).round(3)
    first = date(2024, 1, 1)
    data = [("a", first + timedelta(days=i), float(v)) for i, v in enumerate(x)]
    data += [("flat", first + timedelta(days=i), 3.0) for i in range(6)]
    df = spark.createDataFrame(data, "k string, d date, x double")
    c = x - x.mean()
    got = {(r.k, r.lag): r.acf for r in T.acf(df, "k", "d", "x", 20).collect()}
    assert [got["a", k] for k in range(21)] == pytest.approx([c[: 80 - k] @ c[k:] / (c @ c) for k in range(21)])
    # A constant series has no correlation, a series shorter than the lags stops early.
    assert sorted(k for s, k in got if s == "flat") == list(range(6)) and got["flat", 1] is None
    part = {(r.k, r.lag): r.pacf for r in T.pacf(df, "k", "d", "x", 12).collect()}
    assert [part["a", k] for k in range(13)] == pytest.approx(yule_walker(x, 12))
    assert part["flat", 0] == 1.0 and part["flat", 1] is None


def test_indicator_naming(spark):
    df = spark.createDataFrame([("u",), ("v",), (None,)], "c string")
    assert equality_indicator(df, "c", ["u", "v"]).columns == ["c", "c u", "c v"]
    assert equality_indicator(df, "c", ["u", "v"], ["1", "2"]).columns == ["c", "c 1", "c 2"]
    one = equality_indicator(df, "c", ["u"], ["U"])
    assert one.columns == ["c U"] and [r[0] for r in one.collect()] == [1, 0, 0]
    assert equality_indicator(df, "c", ["u"], ["/"]).columns == ["c"]
    assert equality_indicator(df, "c", ["u"]).columns == ["c", "u"]


def test_feature_vector_defaults(spark):
    df = spark.createDataFrame([(1, 2.0, None)], "a int, `b.x` double, c double")
    v = select_feature_vector(df, ["b.x", "missing", "c", "a"]).first().features
    assert list(v.toArray()) == [2.0, 0.0, 0.0, 1.0]


def test_label_encode_and_page_count(spark):
    df = spark.createDataFrame([("m",), ("d",), ("i",), ("d",)], "c string")
    encoded, _ = label_encode(df, "c")
    assert {(r.c, r.label) for r in encoded.collect()} == {("d", 0), ("i", 1), ("m", 2)}
    assert page_count(df).first()[0] == 1 and page_count(df.limit(0)).first()[0] == 1


def training(spark):
    df = spark.range(300).selectExpr("id", "CAST(id % 30 AS DOUBLE) AS a", "CAST(id * 7 % 11 AS DOUBLE) AS b", "CAST(id % 30 DIV 10 AS INT) AS label")
    return select_feature_vector(df, ["a", "b"], ["id", "label"])


def test_models_learn_a_simple_rule(spark):
    data = training(spark)
    for estimator in (L.decision_tree(), L.random_forest(numTrees=5), L.extra_trees(numTrees=5),
                      L.logit(n_train=300), L.gradient_boosting(maxIter=5)):
        scored = L.predict(estimator.fit(data), data)
        assert M.accuracy(scored, "label", "prediction").first()[0] > 0.9


def test_search_cv_dummy_and_importance(spark):
    data = training(spark)
    best = L.random_forest_search(data, "id", {"numTrees": (2, 5), "maxDepth": (1, 6)}, n_iter=3)
    assert max(best.avgMetrics) > 0.9 and len(best.avgMetrics) == 3
    assert L.cv_score(data, L.decision_tree(), "id", k=3).first().mean_accuracy > 0.9
    top = L.feature_importance(best.bestModel, ["a", "b"], 1).collect()
    assert [r.feature for r in top] == ["a"]
    guess = L.dummy_stratified(data, data, "label", "id")
    assert 0.2 < M.accuracy(guess, "label", "prediction").first()[0] < 0.5


def test_bundle_round_trip(spark, tmp_path):
    data, calls = training(spark), []

    def train():
        calls.append(1)
        return L.decision_tree().fit(data), {"classes": data.groupBy("label").count()}, {"features": ["a", "b"]}

    path = str(tmp_path / "bundle")
    with pytest.raises(FileNotFoundError):
        load_model_bundle(spark, path)
    for _ in range(2):
        model, tables, info = load_model_bundle(spark, path, train)
    assert calls == [1] and info == {"features": ["a", "b"]} and tables["classes"].count() == 3
    assert M.accuracy(L.predict(model, data), "label", "prediction").first()[0] == 1.0


def test_incremental_dimension_resolves_new_keys_only(spark, tmp_path):
    path, seen = str(tmp_path / "dim"), []

    def resolve(keys):
        seen.append({r.k for r in keys.collect()})
        return keys.withColumn("n", F.length("k"))

    first = spark.createDataFrame([("a",), ("bb",), ("a",), (None,)], "k string")
    second = spark.createDataFrame([("bb",), ("ccc",)], "k string")
    assert sorted(((r.k, r.n) for r in incremental_dimension(first, path, "k", resolve).collect()), key=str) == [
        ("a", 1), ("a", 1), ("bb", 2), (None, None)]
    assert {(r.k, r.n) for r in incremental_dimension(second, path, "k", resolve).collect()} == {("bb", 2), ("ccc", 3)}
    assert seen == [{"a", "bb"}, {"ccc"}]


def test_raw_csv_with_commas_quotes_and_line_breaks(spark, tmp_path):
    names = raw_schema(as_text=True).fieldNames()
    row = {n: None for n in names} | {"Timestamp": "2023-05-30 06:33:58", "Source Port": "31225",
                                      "Payload Data": 'said "hi",\nthen left', "Anomaly Scores": "28.67"}
    write_csv(spark.createDataFrame([tuple(row[n] for n in names)], raw_schema(as_text=True)), str(tmp_path / "raw"))
    got = read_raw_csv(spark, str(tmp_path / "raw"), multi_line=True).collect()
    assert len(got) == 1 and got[0]["Payload Data"] == row["Payload Data"]
    assert got[0]["Source Port"] == 31225 and str(got[0]["Timestamp"]) == "2023-05-30 06:33:58"


def test_checkpoint_table_builds_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)

    for _ in range(2):
        assert checkpoint_table(spark, str(tmp_path / "t"), build).count() == 5
    assert calls == [1]


def test_raw_csv_takes_columns_by_header(spark, tmp_path):
    names = raw_schema(as_text=True).fieldNames()
    rows = [tuple(str(1000 * i + k) for k in range(len(names))) for i in range(2000)]
    table = spark.createDataFrame(rows, raw_schema(as_text=True)).coalesce(1)
    write_csv(table.select(*[f"`{n}`" for n in sorted(names)]), str(tmp_path / "raw"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        got = read_raw_csv(spark, str(tmp_path / "raw"), corrupt="bad")
        assert got.rdd.getNumPartitions() > 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got.columns == [*names, "bad"]
    first = got.where("`Source Port` = 3").first()
    assert first["Destination Port"] == 4 and first["Log Source"] == "24"
    assert first["bad"] is not None  # "0" is no timestamp
    write_csv(table.drop("Log Source"), str(tmp_path / "short"))
    with pytest.raises(ValueError, match="Log Source"):
        read_raw_csv(spark, str(tmp_path / "short"))
