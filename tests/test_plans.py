"""Training and scoring runs on a small raw log."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from wardline.operators import models as L
from wardline.operators.bias import RAW_ROW_GROUPS
from wardline.operators.columns import select_feature_vector
from wardline.operators.metrics import accuracy
from wardline.plans.export import engineered_export
from wardline.plans.ports import DEFAULT_DEVICE, PORT_FEATURES, base_features, serving_ports_features
from wardline.plans.preprocess import enrich_log, serving_preprocess
from wardline.plans.scoring import load_trained, save_trained, score_file
from wardline.plans.training import leakage_comparison, serving_bias_features, train_bias_classifier, train_ports_model
from wardline.session import store
from wardline.sources.tables import write_csv


@pytest.fixture(scope="module")
def raw(spark):
    pick = lambda *values: "CASE " + " ".join(f"WHEN id % {len(values)} = {i} THEN '{v}'" for i, v in enumerate(values)) + " END"
    return store(
        spark.range(900).selectExpr(
            "id", "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, CAST(id AS INT)) AS Timestamp",
            "concat('103.216.', id % 9, '.12') AS `Source IP Address`", "concat('84.9.', id % 7, '.252') AS `Destination IP Address`",
            "CAST(id * 97 % 65536 AS INT) AS `Source Port`", "CAST(id % 30 * 2000 AS INT) AS `Destination Port`",
            f"{pick('TCP', 'UDP', 'ICMP')} AS Protocol", "CAST(id * 13 % 1500 AS INT) AS `Packet Length`",
            f"{pick('Data', 'Control')} AS `Packet Type`", f"{pick('HTTP', 'DNS', 'FTP')} AS `Traffic Type`",
            "'text' AS `Payload Data`", "CASE WHEN id % 2 = 0 THEN 'IoC Detected' END AS `Malware Indicators`",
            "CAST(id * 31 % 1000 / 10 AS DOUBLE) AS `Anomaly Scores`", "CASE WHEN id % 4 = 0 THEN 'Alert Triggered' END AS `Alerts/Warnings`",
            "CASE WHEN id % 30 < 10 THEN 'DDoS' WHEN id % 30 < 20 THEN 'Intrusion' ELSE 'Malware' END AS `Attack Type`",
            f"{pick('Known Pattern A', 'Known Pattern B')} AS `Attack Signature`", f"{pick('Blocked', 'Logged', 'Ignored')} AS `Action Taken`",
            f"{pick('Low', 'Medium', 'High')} AS `Severity Level`", "'somebody' AS `User Information`",
            "'Mozilla/5.0 (compatible; MSIE 8.0; Windows NT 6.2; Trident/5.0)' AS `Device Information`",
            f"{pick('Segment A', 'Segment B', 'Segment C')} AS `Network Segment`", "'Mumbai, Maharashtra' AS `Geo-location Data`",
            "CASE WHEN id % 2 = 1 THEN '150.9.97.135' END AS `Proxy Information`", "CASE WHEN id % 3 = 0 THEN 'Log Data' END AS `Firewall Logs`",
            "CAST(NULL AS STRING) AS `IDS/IPS Alerts`", f"{pick('Firewall', 'Server')} AS `Log Source`",
        )
    )


def test_enrich_log_columns(spark, raw):
    ranges = spark.createDataFrame(
        [(0, 2**31, 1.0, 2.0, "A", "a")], "ip_start long, ip_end long, latitude double, longitude double, country string, city string"
    )
    out = enrich_log(raw, ranges)
    assert out.count() == 900 and not {"Payload Data", "User Information", "Timestamp"} & set(out.columns)
    row = out.where("id = 1").first()
    assert row["Protocol UDP"] == 1 and row["Packet Type Control"] == 1 and row["Attack Signature patA"] == 0
    assert row["Source IP country"] == "A" and row["Proxy country"] is None and row["Proxy usage"] == 1
    assert row["Browser family"] == "IE" and row["Severity Level"] == "0" and row["Geo-location State"] == "Maharashtra"
    assert row["date WD"] == "WD1" and row["date H"] == "H4" and row["date H1"] == 0 and row["date WD1"] == 1


def test_bias_classifier_and_scoring(raw):
    prepared = serving_preprocess(raw)
    trained = train_bias_classifier(
        prepared, "Attack Type", "id", lambda n: L.logit(n_train=n), groups=RAW_ROW_GROUPS, only=("ports", "time")
    )
    assert trained.predictions.count() == 90 and len(trained.features) == 9
    # The destination port decides the class in this log.
    assert accuracy(trained.predictions, "label", "prediction").first()[0] > 0.95
    scored = L.predict(trained.model, serving_bias_features(raw, trained, ["id"]))
    joined = scored.join(raw.select("id", "Attack Type"), "id").join(trained.classes, "Attack Type")
    assert joined.count() == 900 and accuracy(joined, "label", "prediction").first()[0] > 0.95


def test_stored_run_scores_a_file(spark, raw, tmp_path):
    trained = train_bias_classifier(
        serving_preprocess(raw), "Attack Type", "id", lambda n: L.logit(n_train=n), groups=RAW_ROW_GROUPS, only=("ports", "security"),
        null_key="none",
    )
    save_trained(trained, str(tmp_path / "run"))
    again = load_trained(spark, str(tmp_path / "run"))
    assert again.features == trained.features and again.bias.null_key == "none"
    columns = lambda t: L.predict(t.model, serving_bias_features(raw, t, ["id"])).select("id", "features", "prediction")
    assert columns(again).exceptAll(columns(trained)).count() == 0
    assert again.predictions.select("id", "prediction").exceptAll(trained.predictions.select("id", "prediction")).count() == 0

    write_csv(raw.drop("id"), str(tmp_path / "log.csv"))
    done = score_file(spark, again, str(tmp_path / "log.csv"), str(tmp_path / "scored"), target="Attack Type", as_of=date(2025, 1, 1))
    assert done.summary.first()["bad_rows"] == 0 and done.scored.count() == 900
    direct = columns(trained).join(trained.classes.withColumnRenamed("label", "prediction"), "prediction").groupBy("Attack Type").count()
    assert {r["prediction"]: r["n"] for r in done.report.collect()} == {r[0]: r[1] for r in direct.collect()}
    written = spark.read.option("header", True).csv(str(tmp_path / "scored"))
    assert written.count() == 900 and "prediction" in written.columns

    write_csv(raw.withColumn("Source Port", F.when(F.col("id") == 4, 70000).otherwise(F.col("Source Port"))).drop("id"), str(tmp_path / "bad.csv"))
    refused = score_file(spark, again, str(tmp_path / "bad.csv"), str(tmp_path / "none"), target="Attack Type", as_of=date(2025, 1, 1))
    assert refused.scored is None and not (tmp_path / "none").exists()
    assert [r["Source Port"] for r in refused.bad_rows.collect()] == ["70000"]


def test_ports_model_features(raw):
    trained = train_ports_model(raw, "Attack Type", "id", L.decision_tree())
    assert trained.features == list(PORT_FEATURES) and len(PORT_FEATURES) == 29
    assert trained.predictions.count() == 180
    assert accuracy(trained.predictions, "label", "prediction").first()[0] > 0.95
    assert trained.side["dst_port_means"].count() == 30


def test_stored_port_model_scores_a_file(spark, raw, tmp_path):
    trained = train_ports_model(raw, "Attack Type", "id", L.decision_tree())
    save_trained(trained, str(tmp_path / "run"))
    again = load_trained(spark, str(tmp_path / "run"))
    assert again.bias is None and again.features == list(PORT_FEATURES)
    write_csv(raw.drop("id"), str(tmp_path / "log.csv"))
    done = score_file(spark, again, str(tmp_path / "log.csv"), str(tmp_path / "scored"), target="Attack Type", as_of=date(2025, 1, 1))
    assert done.scored.count() == 900 and spark.read.option("header", True).csv(str(tmp_path / "scored")).count() == 900
    rows = serving_ports_features(raw, trained.side["src_port_means"], trained.side["dst_port_means"])
    direct = L.predict(trained.model, select_feature_vector(rows, trained.features, ["id"])).join(
        trained.classes.withColumnRenamed("label", "prediction"), "prediction"
    ).groupBy("Attack Type").count()
    assert {r["prediction"]: r["n"] for r in done.report.collect()} == {r[0]: r[1] for r in direct.collect()}


def test_port_scoring_without_user_agent(raw):
    bare = base_features(raw.drop("Device Information"), serving=True)
    assert {tuple(r) for r in bare.select(*DEFAULT_DEVICE).distinct().collect()} == {("Windows", "Chrome", "PC")}
    empty = base_features(raw.where("id < 3").withColumn("Device Information", F.lit(None).cast("string")), serving=True)
    assert {tuple(r) for r in empty.select(*DEFAULT_DEVICE).distinct().collect()} == {("Other", "Other", "Other")}


def test_leakage_shows(raw):
    rows = raw.select("id", F.col("Source Port").alias("port"), (F.hash("id") % 2 + 1).alias("noise")).withColumn(
        "target", F.abs("noise") % 2
    )
    out = {r.approach: r for r in leakage_comparison(rows, ["port"], "target", "id", L.decision_tree(minInstancesPerNode=1)).collect()}
    # Every port occurs once: encoded on all rows it gives the label away, on training rows it says nothing.
    assert out["all_rows"].accuracy == 1.0 and out["train_only"].accuracy < 0.7
    assert out["train_only"].unseen_pct == 100.0


def test_export_columns(raw):
    roles = {"proxy": "Proxy Information", "src": "Source IP Address", "dst": "Destination IP Address", "length": "Packet Length",
             "src_port": "Source Port", "dst_port": "Destination Port", "score": "Anomaly Scores"}
    out = engineered_export(raw, roles)
    assert out.columns == ["has_proxy", "is_bidirectional", "src_is_private", "dst_is_private", "packet_length_bin",
                           "dst_port_category", "src_port_category", "anomaly_category"]
    assert out.count() == 900
