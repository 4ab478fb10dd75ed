import numpy as np
import pytest

from wardline.operators.ordered import dense_codes, exact_quantiles, floor_lookup, ordered_counts, running


def test_running_sums_cross_partition_borders(spark, many_partitions):
    rng = np.random.default_rng(1)
    rows = [(g, int(x), int(n)) for g in ("a", "b", "c") for x, n in zip(rng.permutation(300), rng.integers(1, 9, 300))]
    df = spark.createDataFrame(rows, "g string, x int, n long")
    got = {(r.g, r.x): (r.n_before, r.n_total) for r in running(df, ["x"], sums=["n"], by=["g"]).collect()}
    for g in ("a", "b", "c"):
        before, mine = 0, sorted((x, n) for gg, x, n in rows if gg == g)
        total = sum(n for _, n in mine)
        for x, n in mine:
            assert got[g, x] == (before, total)
            before += n


def test_running_descending_and_max(spark, many_partitions):
    df = spark.createDataFrame([(i, (i * 37) % 101) for i in range(200)], "x int, v int")
    got = {r.x: r.v_upto for r in running(df, ["x"], maxes=["v"], descending=True).collect()}
    best = -1
    for i in range(199, -1, -1):
        best = max(best, (i * 37) % 101)
        assert got[i] == best


def test_hot_value_is_one_row(spark):
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS v")
    hot = ordered_counts(df, "v").where("v = 7").first()
    assert (hot.n, hot.n_total) == (1001, 3000)


@pytest.mark.parametrize("probs", [[0.0, 0.25, 0.5, 0.95, 0.99, 1.0]])
def test_quantiles_equal_numpy(spark, many_partitions, probs):
    rng = np.random.default_rng(2)
    rows = [(g, float(v)) for g, size in (("a", 1), ("b", 2), ("c", 501)) for v in np.round(rng.normal(size=size), 1)]
    df = spark.createDataFrame(rows, "g string, v double")
    for r in exact_quantiles(df, "v", probs, by=["g"]).collect():
        assert r.quantile == pytest.approx(np.quantile([v for g, v in rows if g == r.g], r.prob))


def test_quantiles_of_empty_and_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    assert exact_quantiles(df, "v", [0.5]).collect() == []


def test_floor_lookup(spark, many_partitions):
    values = spark.range(0, 1000, 7).toDF("v")
    starts = spark.range(50, 900, 33).toDF("s")
    got = {r.v: r.s for r in floor_lookup(values, "v", starts, "s").collect()}
    for v in range(0, 1000, 7):
        below = [s for s in range(50, 900, 33) if s <= v]
        assert got[v] == (max(below) if below else None)


def test_dense_codes(spark, many_partitions):
    df = spark.createDataFrame([("b", "x"), ("a", None), ("c", "y"), ("b", "x")], "p string, q string")
    got = {(r.feature, r.value): r.code for r in dense_codes(df, ["p", "q"]).collect()}
    assert got == {("p", "a"): 0, ("p", "b"): 1, ("p", "c"): 2, ("q", "x"): 0, ("q", "y"): 1}
