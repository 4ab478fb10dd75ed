"""Lagged products over blocks, and scoring a stream by a crosstab that changes."""

import numpy as np
import pytest

from wardline.operators import series as S
from wardline.operators.bias import crosstab_score, score_stream
from wardline.operators.crosstab import crosstab_bias


@pytest.mark.parametrize("nlags", [0, 3, 40])
def test_lagged_products_over_blocks(spark, nlags):
    draw = np.random.default_rng(1)
    lengths = {"long": 501, "edge": 160, "short": 5, "one": 1}
    x = {k: draw.normal(size=n) for k, n in lengths.items()}
    rows = [(k, i * 3, None if i == 7 else float(v)) for k, values in x.items() for i, v in enumerate(values)] + [(None, 1, 1.0)]
    table = spark.createDataFrame(rows, "k string, t int, x double").repartition(5)
    for center in (True, False):
        got = {(r.k, r.lag): (r.n, r["product"]) for r in S.lagged_products(table, "k", "t", "x", nlags, center, block_rows=1).collect()}
        want = {}
        for k, values in x.items():
            there = np.arange(len(values)) != 7
            c = np.where(there, values - (values[there].mean() if center else 0), 0)
            want |= {(k, lag): (len(c), c[: len(c) - lag] @ c[lag:]) for lag in range(min(nlags, len(c) - 1) + 1)}
        assert got.keys() == want.keys()
        for key, (n, product) in want.items():
            assert got[key] == (n, pytest.approx(product, abs=1e-9))
    assert S.lagged_products(table.limit(0), "k", "t", "x", 3).count() == 0


def test_stream_is_scored_by_the_newest_crosstab(spark, tmp_path):
    def history(name, rows):
        return spark.createDataFrame(rows, "proto string, kind string").write.mode("overwrite").parquet(str(tmp_path / name))

    history("log", [("tcp", "bad")] * 40 + [("udp", "good")] * 40)
    rows = lambda: crosstab_bias(spark.read.parquet(str(tmp_path / "log")), ["proto"], "kind")
    source, seen = str(tmp_path / "in"), {}
    batch = spark.createDataFrame([(1, "tcp"), (2, "udp"), (3, None), (4, "icmp")], "id int, proto string").coalesce(1)
    batch.write.parquet(source)
    stream = spark.readStream.schema(batch.schema).parquet(source)
    writer = score_stream(stream, ["proto"], rows, "bad", lambda df, number: seen.update({number: {r.id: r.level for r in df.collect()}}), output="level")
    query = writer.option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        query.processAllAvailable()
        history("log", [("udp", "bad")] * 40 + [("tcp", "good")] * 40)
        batch.write.mode("append").parquet(source)
        query.processAllAvailable()
    finally:
        query.stop()
    assert sorted(seen) == [0, 1]
    assert seen[0] == {1: 6, 2: 0, 3: 0, 4: 0} and seen[1] == {1: 0, 2: 6, 3: 0, 4: 0}
    assert {r.id: r.level for r in crosstab_score(batch, ["proto"], rows(), "bad", output="level").collect()} == seen[1]
