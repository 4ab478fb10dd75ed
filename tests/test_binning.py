import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardline.operators import binning as B


def greedy(values, n_obs):
    bins, current = [], []
    for v in sorted(values):
        if current and v != current[-1] and len(current) >= n_obs:
            bins.append(current)
            current = []
        current.append(v)
    if current:
        bins.append(current)
    return [(b[0], b[-1], len(b)) for b in bins]


@pytest.mark.parametrize("seed,n_obs,chunk", [(0, 5, 20), (1, 1, 3), (2, 13, 13), (3, 7, 1000), (4, 40, 41)])
def test_min_count_bins_equal_a_sequential_walk(spark, many_partitions, seed, n_obs, chunk):
    rng = np.random.default_rng(seed)
    values = [int(v) for v in rng.integers(0, 120, 400)]
    values += [60] * 200  # one value with a third of the rows
    df = spark.createDataFrame([(v,) for v in values], "v int")
    by_value, bins = B.min_count_bins(df, "v", n_obs, chunk_rows=chunk)
    assert sorted(tuple(r) for r in bins.collect()) == greedy(values, n_obs)
    spans = {lo: hi for lo, hi, _ in greedy(values, n_obs)}
    rows = by_value.collect()
    assert len(rows) == len(set(values))
    assert all(r.lo <= r.v <= r.hi and spans[r.lo] == r.hi for r in rows)


def test_chunks_of_many_bins_end_in_time(spark):
    """The bins of a chunk are followed by doubling; one by one, 200,000 bins of a chunk took minutes."""
    began = time.monotonic()
    _, bins = B.min_count_bins(spark.range(400_000).select(F.col("id").alias("v")), "v", 1, chunk_rows=200_000)
    assert bins.where("lo = hi AND n = 1").count() == bins.count() == 400_000
    assert time.monotonic() - began < 40


def test_min_count_bins_edge_cases(spark):
    one = spark.createDataFrame([(3.5,)], "v double")
    assert [tuple(r) for r in B.min_count_bins(one, "v", 10)[1].collect()] == [(3.5, 3.5, 1)]
    empty = one.where("v > 9")
    assert B.min_count_bins(empty, "v", 10)[1].collect() == []
    nulls = spark.createDataFrame([(1.0,), (None,), (2.0,)], "v double")
    out = B.bin_min_count(nulls, "v", 1).orderBy("v").collect()
    assert [r["v classes"] for r in out] == [None, "class : 1.0 - 1.0", "class : 2.0 - 2.0"]


def test_cut_fixed_borders(spark):
    df = spark.createDataFrame([(v,) for v in (0, 1, 64, 65, 2048, 2049)] + [(None,)], "v int")
    got = [r[0] for r in df.select(B.cut_fixed("v")).collect()]
    assert got == [None, "0-64", "0-64", "64-128", "1024-2048", "2048+", None]


def test_cut_quartiles_constant_column(spark):
    df = spark.createDataFrame([(1.0,)] * 5 + [(None,)], "v double")
    assert {r.quartile for r in B.cut_quartiles(df, "v").collect()} == {"Low (0-25%)", None}


def equal_width(values, train, n):
    """The bin labels by a loop over the lower bounds."""
    lo, hi = int(np.floor(min(train))), int(np.ceil(max(train)))
    step, out = int((hi - lo) / n), {}
    for low in range(lo, hi, step):
        for v in values:
            if low == lo and v < low + step:
                out[v] = f"class : min - {low + step}"
            elif low > lo and low + step >= hi and v >= low:
                out[v] = f"class : {low} - max"
            elif low > lo and low + step < hi and low <= v < low + step:
                out[v] = f"class : {low} - {low + step}"
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7])
def test_bin_equal_width(spark, n):
    train, values = [0.5, 3.0, 10.2], [-5.0, 0.0, 2.0, 3.0, 5.5, 9.0, 10.0, 11.0, 40.0]
    df, tr = (spark.createDataFrame([(v,) for v in x], "v double") for x in (values, train))
    want = equal_width(values, train, n)
    got = {r.v: r["v classes"] for r in B.bin_equal_width(df, tr, "v", n).collect()}
    assert got == {v: want.get(v) for v in values}


def test_bin_equal_width_without_a_step(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "v double")
    assert {r["v classes"] for r in B.bin_equal_width(df, df, "v", 5).collect()} == {None}


def test_histogram_counts_every_row_and_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)] + [(None,)], "v double")
    got = {r.bin: r.n for r in B.histogram(df, "v", 5).collect()}
    assert got == {1: 2, 2: 2, 3: 2, 4: 2, 5: 3}
    constant = df.select(F.lit(4.0).alias("v"))
    assert [tuple(r) for r in B.histogram(constant, "v", 5).collect()] == [(1, 12)]


def test_assign_trained_bins_gaps_and_outside(spark):
    bins = spark.createDataFrame([(0.0, 5.0), (10.0, 15.0), (20.0, 25.0)], "lo double, hi double")
    df = spark.createDataFrame([(-3.0,), (0.0,), (5.0,), (7.0,), (10.0,), (25.0,), (99.0,), (None,)], "v double")
    got = {r.v: r.v_lo for r in B.assign_trained_bins(df, "v", bins).collect()}
    assert got == {-3.0: 0.0, 0.0: 0.0, 5.0: 0.0, 7.0: 20.0, 10.0: 10.0, 25.0: 20.0, 99.0: 20.0, None: None}


def test_bin_equal_count_keeps_equal_values_together(spark):
    df = spark.createDataFrame([(1,)] * 50 + [(2,)] * 10 + [(3,)] * 40, "v int")
    got = {(r.v, r.v_lo, r.v_hi) for r in B.bin_equal_count(df, "v", 2).collect()}
    assert got == {(1, 1, 1), (2, 2, 3), (3, 2, 3)}


def test_trained_bins_compare_numbers_across_types(spark):
    bins = spark.createDataFrame([(1, 5), (8, 20)], "lo int, hi int")
    values = spark.createDataFrame([(1.0,), (5.0,), (8.5,), (0.2,), (6.0,), (99.0,), (None,)], "v double")
    got = {r.v: (r.v_lo, r["v classes"]) for r in B.assign_trained_bins(values, "v", bins).collect()}
    assert got[1.0] == got[5.0] == got[0.2] == (1, "class : 1 - 5")
    assert got[8.5] == got[6.0] == got[99.0] == (8, "class : 8 - 20")
    assert got[None] == (None, None)
