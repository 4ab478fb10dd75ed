from datetime import date

from wardline.operators import quality as Q

GOOD = {
    "Timestamp": "2023-05-30 06:33:58", "Source IP Address": "103.216.15.12", "Destination IP Address": "84.9.164.252",
    "Source Port": "31225", "Destination Port": "17616", "Protocol": "ICMP", "Packet Length": "503", "Packet Type": "Data",
    "Traffic Type": "HTTP", "Malware Indicators": None, "Anomaly Scores": "28.67", "Alerts/Warnings": None,
    "Attack Signature": "Known Pattern B", "Action Taken": "Logged", "Severity Level": "Low",
    "Device Information": "Mozilla/5.0 (compatible)", "Network Segment": "Segment A", "Proxy Information": None,
    "Firewall Logs": "Log Data", "IDS/IPS Alerts": None, "Log Source": "Server",
}


def frame(spark, *changes):
    names = list(GOOD)
    rows = [(i, *[{**GOOD, **c}[n] for n in names]) for i, c in enumerate(changes)]
    return spark.createDataFrame(rows, ", ".join(["row long", *[f"`{n}` string" for n in names]]))


def errors(spark, *changes):
    out = Q.validate_rows(frame(spark, *changes), as_of=date(2024, 1, 1), row_id="row").orderBy("row").collect()
    return [r.errors for r in out], [r.message for r in out]


def test_good_row_and_messages(spark):
    found, text = errors(
        spark, {}, {"Timestamp": "2024-01-02 00:00:00"}, {"Timestamp": " "}, {"Timestamp": "soon"},
        {"Source IP Address": "256.1.1.1", "Protocol": "SCTP", "Proxy Information": "1.2.3"},
        {"Source Port": "80.7", "Destination Port": "70000", "Packet Length": None, "Anomaly Scores": "NaN"},
        {"Severity Level": " ", "Malware Indicators": "maybe", "Device Information": "short"},
        {"Protocol": " TCP ", "Malware Indicators": "None", "Anomaly Scores": None},
    )
    assert found[0] == [] and text[0] == ""
    assert found[1] == ["Timestamp: Date cannot be in the future"]
    assert found[2] == ["Timestamp is required"]
    assert found[3] == [f"Timestamp: {Q.BAD_TIMESTAMP}"]
    assert found[4] == [f"Source IP Address: {Q.BAD_IP}", "Protocol must be TCP or UDP or ICMP", f"Proxy Information: {Q.BAD_IP}"]
    assert found[5] == ["Destination Port: Port must be 0-65535", "Packet Length must be numeric"]
    assert found[6] == [
        "Severity Level is required and must be Low or Medium or High", "Malware Indicators must be None or IoC Detected",
        "Device Information: Device Information too short (min 10 chars)",
    ]
    assert found[7] == []
    assert text[4].startswith("Row 5:\n  • Source IP Address: ")


def test_absent_columns(spark):
    df = spark.createDataFrame([("2023-05-30 06:33:58",)], "Timestamp string")
    got = Q.validate_rows(df, as_of=date(2024, 1, 1)).first().errors
    # Absent numbers count as 0; absent required columns are reported.
    assert "Source IP Address is required" in got and "Device Information is required" in got
    assert not any("Port" in e or "Length" in e or "Scores" in e for e in got)


def test_summary_and_first_bad_rows(spark):
    v = Q.validate_rows(frame(spark, {}, {"Timestamp": ""}, {"Timestamp": "", "Protocol": ""}), as_of=date(2024, 1, 1))
    assert tuple(Q.validation_summary(v).first()) == (3, 2, False)
    assert [r.row for r in Q.first_bad_rows(v, "row", 1).collect()] == [1]
    assert tuple(Q.validation_summary(v.where("row = 0")).first()) == (0, 0, True)


def test_single_checks(spark):
    df = spark.createDataFrame([("06:33:58",), ("6:3:8",), ("24:00:00",), ("06:60:00",), ("06:33",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(Q.valid_time_hms("t")).collect()] == [True, True, False, False, False, False, False]
    df = spark.createDataFrame([("0",), ("65535",), ("65536",), ("-1",), ("80.7",), ("x",), (None,)], "p string")
    assert [r[0] for r in df.select(Q.valid_port("p")).collect()] == [True, True, False, False, True, False, False]
    df = spark.createDataFrame([("100",), ("100.1",), ("NaN",), ("x",), (None,)], "s string")
    assert [r[0] for r in df.select(Q.valid_score("s")).collect()] == [True, False, True, False, True]
    assert [r[0] for r in df.select(Q.valid_score("s", False)).collect()] == [True, False, False, False, False]


def test_streaming_rows(spark, tmp_path):
    frame(spark, {}, {"Protocol": "SCTP"}).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frame(spark).schema).parquet(str(tmp_path / "in"))
    checked = Q.validate_rows(stream, as_of=date(2024, 1, 1)).select("row", "is_valid")
    q = checked.writeStream.format("memory").queryName("checked").option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert {tuple(r) for r in spark.table("checked").collect()} == {(0, True), (1, False)}
