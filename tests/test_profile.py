from collections import Counter
from datetime import datetime

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from wardline.operators import crosstab as X
from wardline.operators import endpoints as N
from wardline.operators import flows as W
from wardline.operators import lookup as L
from wardline.operators import profile as P
from wardline.operators import stats as S
from wardline.operators import windows as R
from wardline.operators.columns import category_codes, label_encode
from wardline.operators.joins import attach


def rows(spark):
    data = [("a", "x"), ("a", "y"), ("a", "x"), ("b", "x"), (None, "y"), ("b", None)]
    return spark.createDataFrame(data, "k string, c string")


def test_value_counts_order_share_and_nulls(spark):
    got = [tuple(r) for r in P.value_counts(rows(spark), "k", share=True).collect()]
    assert got == [("a", 3, 60.0), ("b", 2, 40.0)]


def test_null_sorted_counts(spark):
    got = {(r.value, r["class"]): r.n for r in P.value_counts_null_sorted(rows(spark), "k", "c").collect()}
    assert got == {("a", "x"): 2, ("a", "y"): 1, ("a", None): 3, ("b", "x"): 1, ("b", None): 1, (None, "y"): 1, (None, None): 1}


def test_crosstab_null_keys_and_margins(spark):
    dropped = {r.k: tuple(r)[1:] for r in X.crosstab_margins(rows(spark), ["k"], "c").collect()}
    assert dropped == {"a": (2, 1, 3), "b": (1, 0, 1)}
    kept = {r.k: tuple(r)[1:] for r in X.crosstab_margins(rows(spark), ["k"], "c", null_key="nan").collect()}
    assert kept == {"a": (2, 1, 3), "b": (1, 0, 1), "nan": (0, 1, 1)}


def test_crosstab_rows_sum_to_100(spark):
    for r in X.crosstab_bias(rows(spark), ["k"], "c").collect():
        assert r.x + r.y == pytest.approx(100)
    assert {r["% obs"] for r in X.crosstab_bias(rows(spark), ["k"], "c", pct_denominator="columns").collect()} == {1.5, 0.5}


def test_daily_mode_ties(spark):
    t = datetime(2024, 1, 1, 5)
    u = datetime(2024, 1, 2, 5)
    data = [(t, "p", 10), (t, "q", 9), (u, "q", 9), (u, "q", 10), (u, "p", 10), (u, None, None), (None, "p", 10)]
    df = spark.createDataFrame(data, "ts timestamp_ntz, v string, n int")
    out = {r.ts: (r["v max n d"], r["n max n d"]) for r in P.daily_mode(df, "ts", ["v", "n"]).collect()}
    # v: p and q tie on the first day and overall (3 each), the smaller text wins; n: 10 wins by overall count.
    assert out == {t: ("{ p }", "{ 10 }"), u: ("{ q }", "{ 10 }"), None: (None, None)}
    ties = {str(r.day): r.label for r in P.mode_all_ties(df, "ts", "v").collect()}
    assert ties == {"2024-01-01": "{ p + q }", "2024-01-02": "{ q }"}


def test_fan_threshold_report_equals_numpy(spark, many_partitions):
    rng = np.random.default_rng(3)
    degrees = [int(v) for v in rng.zipf(2.0, 400) % 60]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(degrees)], "key long, degree long")
    r = P.fan_threshold_report(df).first()
    p95, p99 = np.quantile(degrees, [0.95, 0.99])
    assert (r.mean, r.p95, r.p99) == pytest.approx((np.mean(degrees), p95, p99))
    assert (r.above_p95, r.above_p99, r["keys"]) == (sum(d > p95 for d in degrees), sum(d > p99 for d in degrees), 400)


def test_top_k_other_keeps_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("b",), ("c",), (None,)], "v string")
    got = Counter(r.v for r in P.top_k_other(df, "v", 1).collect())
    assert got == {"a": 2, "other": 3, None: 1}


def test_link_weights_per_level_equal_the_rows(spark):
    df = spark.range(500).selectExpr("concat('s', id % 7) AS s", "concat('v', id % 5) AS v", "CASE WHEN id % 10 > 0 THEN concat('d', id % 3) END AS d")
    paths = W.flow_counts(df, ["s", "v", "d"], 2)
    per_level = {r.level: r.w for r in W.flow_links(paths, ["s", "v", "d"]).groupBy("level").agg(F.sum("weight").alias("w")).collect()}
    assert per_level == {0: 450, 1: 450}
    shares = W.feature_flow_table(df, ["s", "v"], "d", 2, top_cols=["s"])
    assert sum(sum(r[c] for c in ("d0", "d1", "d2")) for r in shares.collect()) == pytest.approx(100)


def test_mcc_equals_pairwise_formula(spark):
    rng = np.random.default_rng(4)
    t, p = rng.integers(0, 3, 200), rng.integers(0, 4, 200)
    p[:100] = t[:100]
    df = spark.createDataFrame([(str(a), str(b), "z") for a, b in zip(t, p)], "t string, p string, z string")
    got = {r.feature: r.mcc for r in S.mcc(df, "t", ["p", "z"]).collect()}
    hot = lambda x: np.array([[v == k for k in range(4)] for v in x], float)
    a, b = hot(t) - hot(t).mean(0), hot(p) - hot(p).mean(0)
    want = (a * b).sum() / np.sqrt((a * a).sum() * (b * b).sum())
    assert got["p"] == pytest.approx(want) and got["z"] == 0.0


def test_chi_square_codes_zero_record_is_null(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y"), ("b", "x")], "p string, q string")
    assert tuple(S.chi_square_codes(df, ["p", "q"]).first()) == (None, 2)
    df = spark.createDataFrame([("a", "y"), ("b", "y"), ("b", "x")], "p string, q string")
    o = np.array([[0, 1, 1], [1, 1, 0]], float)
    e = o.sum(1, keepdims=True) * o.sum(0) / o.sum()
    got = S.chi_square_codes(df, ["p", "q"]).first()
    assert got.statistic == pytest.approx(((o - e) ** 2 / e).sum()) and got.dof == 2


def test_chi_square_agrees_with_the_library(spark):
    df = spark.range(600).selectExpr("id % 4 AS a", "CAST(id * id % 7 AS INT) AS b", "id % 3 AS t")
    ours = {r.feature: (r.statistic, r.dof) for r in S.chi_square_features(df, ["a", "b"], "t").collect()}
    ready = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    tested = ChiSquareTest.test(ready.withColumn("label", df["t"].cast("double")), "features", "label").first()
    for r in S.chi_square_pvalues(df, ["a", "b"], "t").collect():
        i = ["a", "b"].index(r.feature)
        assert (r.statistic, r.dof) == pytest.approx(ours[r.feature], abs=1e-6)
        assert (r.statistic, r.dof, r.p_value) == pytest.approx((tested.statistics[i], tested.degreesOfFreedom[i], tested.pValues[i]))
        assert r.significant == (r.p_value < 0.05)


def test_chi_square_upper_tail():
    # Known values of the distribution, whole and half numbers of dof / 2.
    assert S.chi_square_upper(3.841458820694124, 1) == pytest.approx(0.05)
    assert S.chi_square_upper(5.991464547107979, 2) == pytest.approx(0.05)
    assert S.chi_square_upper(11.070497693516351, 5) == pytest.approx(0.05)
    assert S.chi_square_upper(131070.0, 131070) == pytest.approx(0.5, abs=1e-3)
    assert S.chi_square_upper(0.0, 4) == 1.0


def test_many_values_are_no_obstacle(spark):
    df = spark.range(20_000).selectExpr("id AS v", "id % 3 AS t", "timestamp'2024-01-01' AS ts")
    assert P.pivot_daily(df, "ts", "v").count() == 20_000
    assert P.strip_points(df, "t", "v").agg({"class_rank": "max"}).first()[0] == 19_999
    assert S.chi_square_pvalues(df, ["v"], "t").first().dof == 2 * 19_999


def test_numbers_are_ranked_as_numbers(spark):
    df = spark.createDataFrame([(10, 2.5), (9, 10.0), (2, None), (None, 2.5)], "k int, x double")
    encoded, codes = label_encode(df, "k")
    assert {r.k: r.label for r in encoded.collect()} == {2: 0, 9: 1, 10: 2, None: None}
    assert codes.schema["k"].dataType == df.schema["k"].dataType
    assert [r.x_code for r in category_codes(df, ["x"]).orderBy("k").collect()] == [0, -1, 1, 0]


def test_nan_is_a_missing_value(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "x double")
    r = P.describe(df, ["x"]).first()
    assert (r.n, r.mean, r.min, r.median, r.max) == (2, 2.0, 1.0, 2.0, 3.0)


def test_null_keys_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr("wardline.operators.joins.is_small", lambda *_: False)
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(8000).selectExpr("id", "CASE WHEN id % 10 = 0 THEN id % 7 END AS k")
        out = attach(df, spark.range(7).selectExpr("id AS k", "id * 2 AS v"), ["k"])
        assert out.where("k IS NOT NULL AND v <> 2 * k OR k IS NULL AND v IS NOT NULL").count() == 0 and out.count() == 8000
        sizes = out.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 3500
    finally:
        spark.conf.set(key, old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_mutual_information_bounds(spark):
    df = spark.range(400).selectExpr("id % 4 AS same", "(id div 4) % 5 AS free", "id % 4 AS t")
    got = {r.feature: r.mi for r in S.mutual_information(df, ["same", "free"], "t").collect()}
    assert got["same"] == pytest.approx(np.log(4)) and got["free"] == pytest.approx(0, abs=1e-9)


def test_runs(spark, many_partitions):
    df = spark.createDataFrame([(3,), (1,), (3,), (2,), (None,)], "v int")
    got = {r.v: (r.run, r.run_size, r.first_row) for r in R.runs(df, "v").collect()}
    assert got == {1: (1, 1, 0), 2: (2, 1, 1), 3: (3, 2, 2)}


def test_bidirectional(spark):
    df = spark.createDataFrame([("a", "b", "t"), ("b", "c", "t"), ("d", "e", "u"), (None, "b", "u")], "s string, d string, c string")
    assert {r.ip for r in N.bidirectional_ips(df, "s", "d").collect()} == {"b"}
    flags = {(r.s, r.d): r.is_bidirectional for r in N.flag_bidirectional(df, "s", "d").collect()}
    assert flags == {("a", "b"): True, ("b", "c"): True, ("d", "e"): False, (None, "b"): True}
    assert tuple(N.endpoint_union(df, "s", "d").first()) == (3, 3, 1, 5, 20.0)


def test_null_keys_never_match(spark):
    df = spark.createDataFrame([("a", 1), (None, 1), ("a", None)], "p string, q int")
    members = df
    got = [r.in_set for r in L.in_set_multi(df, ["p", "q"], members).orderBy("p", "q").collect()]
    assert sorted(got) == [False, False, True]


def test_attach_three_ways(spark, monkeypatch):
    df = spark.range(300).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS k")
    dim = spark.range(0, 300, 2).selectExpr("id AS k", "id * 10 AS v")
    want = {r.id: r.v for r in df.join(dim, "k", "left").collect()}
    assert {r.id: r.v for r in attach(df, dim, ["k"]).collect()} == want
    monkeypatch.setattr("wardline.operators.joins.is_small", lambda *_: False)
    assert {r.id: r.v for r in attach(df, dim, ["k"]).collect()} == want
    assert {r.id: r.v for r in attach(df, dim, ["k"], spread_by=["id"]).collect()} == want


def test_geolocation_misses(spark):
    ranges = spark.createDataFrame(
        [(16777216, 16777300, 1.0, 2.0, "A", "a"), (3232235520, 3232301055, 3.0, 4.0, "B", "b")],
        "ip_start long, ip_end long, latitude double, longitude double, country string, city string")
    df = spark.createDataFrame([(1, "1.0.0.5"), (2, "1.0.0.200"), (3, "192.168.1.1"), (4, "0.0.0.1"), (5, "bad"), (6, None)], "id int, ip string")
    got = {r.id: r.country for r in L.ip_geolocate(df, "ip", ranges).collect()}
    assert got == {1: "A", 2: None, 3: "B", 4: None, 5: None, 6: None}
    world = ranges.limit(0).select("ip_start", "ip_end", "country").union(spark.createDataFrame([(0, 2**32 - 1, "W")], "a long, b long, c string"))
    got = {r.id: (r.country, r.city) for r in L.ip_geolocate(df, "ip", ranges, country_ranges=world).collect()}
    assert got == {1: ("A", "a"), 2: ("W", None), 3: ("B", "b"), 4: ("W", None), 5: (None, None), 6: (None, None)}
