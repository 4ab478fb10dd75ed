import math
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wardline.functions import encoding as E
from wardline.functions import network as N
from wardline.functions import text as X
from wardline.functions import timeparts as T
from wardline.functions.useragent import with_user_agent_fields


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def test_private_addresses(spark):
    cases = {
        "10.1.2.3": True, "172.16.0.1": True, "172.31.9.9": True, "172.32.0.1": False, "192.168.5.5": True,
        "192.169.1.1": False, "8.8.8.8": False, "10.0.0": False, "1.2.3.4.5": False, "x.y.z.w": False,
        "10.x.1.1": False, "": False, None: False,
    }
    got = {r.v: r.p for r in column(spark, cases).withColumn("p", N.is_private_ip("v")).collect()}
    assert got == cases


def test_address_numbers_and_prefix(spark):
    df = column(spark, ["0.0.0.0", "255.255.255.255", "1.2.3.4", "256.1.1.1", "01.2.3.4", "1.2.3", None])
    got = {r.v: r.n for r in df.withColumn("n", N.ip_to_long("v")).collect()}
    assert got == {"0.0.0.0": 0, "255.255.255.255": 2**32 - 1, "1.2.3.4": 16909060, "256.1.1.1": None,
                   "01.2.3.4": None, "1.2.3": None, None: None}
    with pytest.raises(ValueError):
        N.ipv4_prefix("v", 4)


def test_port_category_styles(spark):
    df = column(spark, [0, 1023, 1024, 49151, 49152, 65535, 65536, -1, None], "int")
    rows = df.select("v", N.port_category("v").alias("s"), N.port_category("v", "long").alias("l")).collect()
    assert [r.s for r in rows] == ["wellknown"] * 2 + ["registered"] * 2 + ["dynamic"] * 3 + ["wellknown", None]
    assert [r.l[:3] for r in rows] == ["Wel", "Wel", "Reg", "Reg", "Dyn", "Dyn", "Unk", "Unk", "Unk"]
    text = column(spark, ["80", "x", None, "50000"])
    got = [r[0] for r in text.select(N.port_category("v", "serving")).collect()]
    assert got == ["wellknown", "registered", "registered", "dynamic"]


def test_time_buckets(spark):
    times = [datetime(2024, 1, 1, 2, 59), datetime(2024, 12, 7, 3), datetime(2024, 2, 8, 20, 59), datetime(2024, 3, 14, 21),
             datetime(2024, 3, 22, 9), datetime(2024, 3, 23, 15), None]
    got = [tuple(r) for r in T.time_buckets(column(spark, times, "timestamp_ntz"), "v", "d").drop("v").collect()]
    assert got == [("MW1", "WD1", "H4", "M1"), ("MW1", "WD6", "H1", "M12"), ("MW2", "WD4", "H3", "M2"),
                   ("MW2", "WD4", "H4", "M3"), ("MW3", "WD5", "H2", "M3"), ("MW4", "WD6", "H3", "M3"),
                   ("MW4", "WD7", "H4", "M12")]
    serving = [tuple(r) for r in T.serving_time_buckets(column(spark, times, "timestamp_ntz"), "v", "d").drop("v").collect()]
    assert serving[0] == ("MW1", "WD1", "H4", "M12") and serving[1] == ("MW1", "WD6", "H1", "M1")
    assert serving[-1] == ("MW4", "WD7", "H4", "M12")


def test_entropy_equals_counting(spark):
    texts = ["", "a", "aabb", "hello world", "éà😀😀x", "aaaaaaaaab" * 100, None]
    got = {r.v: r.h for r in column(spark, texts).withColumn("h", X.text_entropy("v")).collect()}
    for t in texts:
        if t is None:
            assert got[t] is None
        else:
            n = len(t)
            want = -sum(c / n * math.log2(c / n) for c in Counter(t).values()) if n else 0.0
            assert got[t] == pytest.approx(want, abs=1e-9)


def test_text_flags(spark):
    df = column(spark, ["Lorem ipsum DOLOR", "lorem only", "dolore", "", None])
    assert [r[0] for r in df.select(X.lorem_ipsum_flag("v")).collect()] == [True, False, False, False, None]
    df = column(spark, ["hello", "привет", "abcд", "123", "", None])
    assert [r[0] for r in df.select(X.script_flag("v")).collect()] == ["latin", "not_latin", "latin", "not_latin", "not_latin", None]


def test_city_state(spark):
    df = column(spark, ["Mumbai, Maharashtra", "Mumbai", "A, B, C", None])
    city, state = X.split_city_state("v")
    assert [tuple(r) for r in df.select(city, state).collect()] == [
        ("Mumbai", "Maharashtra"), ("Mumbai", None), ("A", "B, C"), (None, None)]
    city, state = X.split_city_state_strict("v")
    assert [tuple(r) for r in df.select(city, state).collect()] == [
        ("Mumbai", "Maharashtra"), (None, None), (None, None), (None, None)]


def test_small_encodings(spark):
    df = column(spark, ["Low", "High", "Other", None])
    assert [r[0] for r in df.select(E.ordinal_encode("v")).collect()] == ["-1", "1", "Other", None]
    assert [r[0] for r in df.select(E.equals_flag("v", "Low")).collect()] == [1, 0, 0, 0]
    nums = column(spark, [0.0, 1.0, math.e, None], "double")
    assert [r[0] for r in nums.select(E.safe_ln("v")).collect()] == [0.0, 0.0, pytest.approx(1.0), None]
    lines = column(spark, [5, 10, 20], "int")
    assert [r[0] for r in lines.select(E.dynamic_threshold("v")).collect()] == [100.0, 37.5, -87.5]
    assert [r[0] for r in lines.select(E.dynamic_threshold("v", floor=37.5)).collect()] == [100.0, 37.5, 37.5]


def test_class_confidence_first_of_equal_wins(spark):
    df = spark.createDataFrame([([0.2, 0.4, 0.4],), ([0.7, 0.2, 0.1],)], "p array<double>")
    label, text = E.class_confidence("p", ["a", "b", "c"])
    assert [tuple(r) for r in df.select(label, text).collect()] == [("b", "40.0%"), ("a", "70.0%")]


def test_user_agent_families(spark):
    cases = {
        "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/90.0.4430.93 Safari/537.36 Edg/90.0.818":
            ("Edge", "90", "Windows", "10", "PC", False),
        "Opera/8.94.(X11; Linux x86_64; nl-NL) Presto/2.9.173 Version/11.00": ("Opera", "8", "Linux", None, "PC", False),
        "Mozilla/5.0 (iPod; U; CPU iPhone OS 4_2 like Mac OS X; en) AppleWebKit/535.1 (KHTML, like Gecko) Version/4.0.5 Mobile/8B115 Safari/6535":
            ("Mobile Safari", "4", "iOS", "4", "Mobile", False),
        "Mozilla/5.0 (Linux; Android 11; Pixel 5) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/91.0.4472.77 Mobile Safari/537.36":
            ("Chrome Mobile", "91", "Android", "11", "Mobile", False),
        "Mozilla/5.0 (compatible; bingbot/2.0; +http://www.bing.com/bingbot.htm)": ("bingbot", "2", "Other", None, None, True),
        "something else": ("Other", None, "Other", None, None, False),
        "": (None,) * 6,
        None: (None,) * 6,
    }
    rows = with_user_agent_fields(column(spark, cases), "v").collect()
    for r in rows:
        got = tuple(r[c] for c in ("Browser family", "Browser major", "OS family", "OS major", "Device type", "Device bot"))
        assert got == cases[r.v], r.v


def test_parse_any_ts(spark):
    good = ["2023-05-30 06:33:58", "2023-05-30 23:33:58", "5/30/2023 06:33:58 AM", "5/30/2023 06:33:58 pm", "5/30/2023  06:33",
            "5/30/2023 18:33:58", " 2023/05/30 6:33:58", "2023-05-30 03:33:58 PM", "2023-05-30 03:33"]
    bad = ["nope", None, "", "2023-02-30 06:33:58", "13/30/2023 06:33", "2023-05-30 13:33", "5/30/2023 13:33:58 PM", "2023-05-30"]
    df = column(spark, good + bad)
    got = [r[0] for r in df.select(F.to_date(T.parse_any_ts("v")).cast("string")).collect()]
    assert got == ["2023-05-30"] * len(good) + [None] * len(bad)
